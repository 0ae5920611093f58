import datetime as dt

import pytest
from pyspark.sql import functions as F

from plymill import schemas
from plymill.functions.text import parse_blocks
from plymill.operators import keyed
from plymill.plans import bronze, models, openings, players, queries, silver, time_pressure
from plymill.sources import lake, tables

GAMES_TEXT = """[Event "A"]
[Site "https://games.example/one"]
[White "alice"]
[Black "bob"]
[Result "1-0"]
[UTCDate "2024.01.01"]
[WhiteElo "1500"]
[BlackElo "1450"]
[ECO "B20"]
[Opening "Sicilian Defense"]
[TimeControl "300+0"]
[Termination "Normal"]

1. e4 { [%clk 0:05:00] } c5 { [%clk 0:00:04] } 1-0

[Event "B"]
[Site "https://games.example/two"]
[White "carol"]
[Black "daveBot"]
[Result "0-1"]
[UTCDate "2024.01.02"]
[WhiteElo "?"]
[BlackElo "1620"]
[ECO "C20"]
[Opening "Odd: Line"]
[TimeControl "180+2"]
[Termination "Time forfeit"]

1. e4 e5 2. O-O O-O 0-1

[Event "C"]
[White "erin"]
[Black "frank"]
[Result "1/2-1/2"]
[UTCDate "2024.02.03"]
[TimeControl "600+5"]

nonsense 1/2-1/2
"""


@pytest.fixture
def raw(spark, tmp_path):
    path = tmp_path / "games.pgn"
    path.write_text(GAMES_TEXT)
    return parse_blocks(lake.read_game_blocks(spark, str(path)), batch_id="2024-01", ingested_at=dt.datetime(2024, 3, 1))


def test_text_file_to_gold(spark, raw, tmp_path):
    assert raw.count() == 3
    metrics = bronze.parser_metrics(raw).first()
    assert (metrics["games_seen"], metrics["missing_game_id"], metrics["suspicious_rows"]) == (3, 1, 1)

    lake.write_landing(raw.union(raw), str(tmp_path / "landing"), rows_per_file=2)
    report = bronze.run(
        spark, str(tmp_path / "landing"), str(tmp_path / "bronze"),
        metrics_output=str(tmp_path / "m"), quarantine_output=str(tmp_path / "q"),
    ).first()
    assert (report["input_count"], report["output_count"], report["duplicate_rows_removed"]) == (6, 2, 2)
    assert spark.read.parquet(str(tmp_path / "q")).count() == 2
    assert lake.read_metrics(spark, str(tmp_path / "m")).first()["partitions"][0]["rows"] == 2

    (tmp_path / "eco.csv").write_text("ECO,Name\nB20,Sicilian Defense: Bowdler\nB20,Zzz\n")
    counts = silver.run(
        spark, str(tmp_path / "bronze"), str(tmp_path / "silver"), reference_path=str(tmp_path / "eco.csv"),
        quarantine_output=str(tmp_path / "sq"),
    )
    assert counts == {"quarantine_count": 0, "silver_count": 2}
    one, two = lake.read_month(spark, str(tmp_path / "silver"), "2024-01").orderBy("game_id").collect()
    assert (one["opening_family"], one["opening_variation"], one["clock_seconds"]) == ("Sicilian Defense", "Bowdler", [300, 4])
    assert (two["opening_family"], two["opening_variation"], two["white_elo"], two["elo_bucket"]) == ("Odd", "Odd: Line", None, "1600-1800")
    assert two["has_bot_player"] and two["white_castled"] and two["black_castled"] and two["result_reason"] == "timeout"
    months = players.player_months(spark.read.parquet(str(tmp_path / "silver")))
    assert months.count() == 4


def test_silver_filters_and_quarantine(spark, raw):
    clean = raw.withColumn("game_id", F.coalesce("game_id", F.lit("three")))
    kept = lambda **options: {r[0] for r in silver.silver_games(clean, **options).select("game_id").collect()}
    assert kept() == {"one", "two", "three"}
    assert kept(exclude_bots=True) == {"one", "three"}
    assert kept(exclude_unrated=True) == {"one"}
    assert kept(drop_corrupt=True) == {"one", "two"}
    broken = clean.withColumn("result", F.lit("*")).withColumn("utc_date", F.lit("????.??.??"))
    rejected = silver.quarantined(broken).first()
    assert rejected["reject_reason"] == "null_required_column"
    assert rejected["missing_columns"] == ["result", "year", "month"]
    assert silver.silver_games(broken).count() == 0


def test_partition_overwrite_keeps_other_months(spark, tmp_path):
    rows = spark.createDataFrame([(1, 2024, 1), (2, 2024, 2)], "v int, year int, month int")
    path = str(tmp_path / "t")
    lake.write_partitions(rows, path, "year", "month")
    lake.write_partitions(rows.filter("month = 1").withColumn("v", F.lit(9)), path, "year", "month")
    assert sorted((r["v"], r["month"]) for r in spark.read.parquet(path).collect()) == [(2, 2), (9, 1)]
    scanned = lake.read_month(spark, path, "2024-02")
    plan = scanned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan


def test_missing_tables_and_columns(spark, tmp_path):
    nothing = lake.read_or_empty(spark, str(tmp_path / "no"), schemas.OPENINGS)
    assert nothing.count() == 0 and nothing.columns == schemas.column_names(schemas.OPENINGS)
    grown = lake.with_defaults(nothing, {"year": F.lit(1), "extra": F.lit(0)})
    assert grown.columns == [*nothing.columns, "extra"]
    assert lake.register_views(spark, str(tmp_path)) == []
    assert spark.table("analytics_time_pressure").columns == schemas.column_names(schemas.TIME_PRESSURE)
    assert queries.opening_stats(spark.table("analytics_opening_stats")).count() == 0


def test_views_read_files_of_any_age_by_contract(spark, tmp_path):
    folder = tmp_path / "gold" / "opening_performance"
    old = spark.createDataFrame([("A00", 3)], "eco_code string, games_count bigint")
    new = spark.createDataFrame([("B00", "F", 5, 0.5, "extra")], "eco_code string, opening_family string, games_count bigint, draw_rate double, later string")
    old.write.parquet(str(folder / "year=2020"))
    new.write.parquet(str(folder / "year=2021"))
    spark.sparkContext.setJobGroup("views", "views")
    assert lake.register_views(spark, str(tmp_path)) == ["gold_opening_performance"]
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("views")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    rows = spark.table("analytics_opening_stats").orderBy("year").collect()
    assert [(r["eco_code"], r["opening_family"], r["year"], r["games_count"], r["draw_rate"]) for r in rows] == [("A00", None, 2020, 3, None), ("B00", "F", 2021, 5, 0.5)]


def test_malformed_texts_are_rejected_with_a_reason(spark, tmp_path):
    good = '[Event "x"]\n[Site "https://g/abc"]\n[White "a"]\n[Black "b"]\n[Result "1-0"]\n\n1. e4 { [%clk 0:01:00] } 1-0'
    texts = [good, good.replace('[White "a"]', '[White "a'), "1. e4 e5", good.replace('[Result "1-0"]', ""), good]
    blocks = spark.createDataFrame([(t,) for t in texts], "block string")
    paths = {name: str(tmp_path / name) for name in ("out", "metrics", "rejects")}
    counts = bronze.parse(spark, blocks, paths["out"], batch_id="b", metrics_output=paths["metrics"], quarantine_output=paths["rejects"])
    assert counts == {
        "games_seen": 5, "rows_written": 3, "missing_game_id": 0, "missing_players": 0, "missing_result": 1, "missing_moves": 0,
        "parse_errors": 2, "suspicious_rows": 3,
    }
    assert lake.read_landing(spark, paths["out"]).count() == 3
    assert lake.read_metrics(spark, paths["metrics"]).first()["parse_errors"] == 2
    found = spark.read.parquet(paths["rejects"])
    assert sorted((r["reject_reason"], r["block"]) for r in found.collect()) == [("broken_tag", texts[1]), ("no_tags", texts[2])]


def test_dedupe_does_not_depend_on_order(spark):
    rows = [("a", "2", None), ("a", "1", "z"), ("a", "1", None), (None, "x", "y"), ("b", "q", "q")]
    frame = spark.createDataFrame(rows, "game_id string, p string, q string")
    found = {tuple(r) for r in bronze.bronze_games(frame).collect()}
    assert found == {("a", "1", None), ("b", "q", "q")}
    assert found == {tuple(r) for r in bronze.bronze_games(frame.repartition(3)).collect()}
    assert bronze.bronze_games(frame, "copies").filter("game_id = 'a'").first()["copies"] == 3


def test_openings(spark):
    played = [("draw", 31, ["Nf3", "d5", "g3"]), ("draw", 70, ["Nf3", "g6"]), ("black_win", 22, ["Nf3", "g6"]), ("white_win", 2, ["Nf3", "d5"]), ("draw", 5, ["Nf3"])]
    frame = spark.createDataFrame(played, "result string, game_length int, moves_san array<string>").withColumns(
        {"eco_code": F.lit("A06"), "opening_family": F.lit("Reti"), "elo_bucket": F.lit("2000+"), "time_control_type": F.lit("rapid"), "year": F.lit(2019)}
    )
    found = openings.opening_performance(frame.unionByName(frame.withColumns({"year": F.lit(2020), "moves_san": F.lit(None).cast("array<string>")})))
    row, without = found.orderBy("year").collect()
    assert (row["games_count"], row["draw_rate"], row["white_win_rate"], row["black_win_rate"], row["avg_game_length"]) == (5, 0.6, 0.2, 0.2, 26.0)
    assert row["most_common_response"] == "d5"  # as often as g6, and smaller
    assert without["most_common_response"] is None and without["games_count"] == 5


def test_favourite_opening_breaks_ties_by_name(spark):
    rows = [("a", "b", "white_win", 1500, 1400, e) for e in ("C", "B", "C", "B", None)]
    kinds = "white string, black string, result string, white_elo int, black_elo int, eco_code string"
    frame = spark.createDataFrame(rows, kinds).withColumns({"year": F.lit(2024), "month": F.lit(1)})
    found = {r["player"]: r for r in players.player_months(frame).collect()}
    assert found["a"]["most_played_opening_white"] == "B" and found["a"]["most_played_opening_black"] is None
    assert found["b"]["most_played_opening_black"] == "B" and found["b"]["losses"] == 5


def test_time_pressure_joins_by_plain_equality(spark):
    clocks = [("x", [90, 61, 60, 29, 3], "classical"), ("y", [0, 31], "classical"), ("z", [17, 17], None), ("n", None, "classical")]
    rows = [(g, c is not None, c, t, 2031) for g, c, t in clocks]
    games = spark.createDataFrame(rows, "game_id string, has_clock_data boolean, clock_seconds array<int>, time_control_type string, year int")
    losses = [(61, "classical", 7, False), (500, "classical", 301, True), (2, "classical", 0, False), (5, "classical", 210, True), (1, "classical", None, None), (17, None, 400, True)]
    scored = spark.createDataFrame(
        [("opening", t, 2031, left, loss, blunder) for left, t, loss, blunder in losses],
        "game_phase string, time_control_type string, year int, time_remaining_seconds int, cp_loss int, is_blunder boolean",
    )
    found = {(r["time_remaining_bucket"], r["time_control_type"]): r for r in time_pressure.time_pressure(games, scored).collect()}
    figures = {k: (r["games_count"], r["evaluated_positions"], r["blunder_count"], r["avg_cp_loss"], r["blunder_rate"]) for k, r in found.items()}
    assert figures == {
        ("60s+", "classical"): (2, 2, 1, 154.0, 0.5), ("31-60s", "classical"): (2, 0, 0, None, None), ("16-30s", "classical"): (1, 0, 0, None, None),
        ("0-5s", "classical"): (2, 2, 1, 105.0, 0.5), ("16-30s", None): (2, 0, 0, None, None),  # no key, no match
    }
    assert all(r["blunder_rate"] is None and r["evaluated_positions"] == 0 for r in time_pressure.time_pressure(games).collect())


def test_invariants_on_the_tables(spark, small):
    raw_rows = tables.raw_games(spark, small)
    rows = silver.candidates(bronze.bronze_games(raw_rows)).persist()
    accepted = rows.filter(~silver.is_rejected())
    total = players.player_months(accepted).agg(
        F.sum("games_played").alias("g"), F.sum(F.col("wins") + F.col("losses") + F.col("draws")).alias("r")
    ).first()
    assert total["g"] == total["r"] == 2 * accepted.count()
    assert accepted.count() + rows.filter(silver.is_rejected()).count() == rows.count()
    assert bronze.id_metrics(raw_rows).first()["output_count"] == rows.count()
    rows.unpersist()


def test_models(spark, small):
    games = silver.silver_games(bronze.bronze_games(tables.raw_games(spark, small)), tables.opening_reference(spark, small))
    staged = models.staged_games(games)
    assert models.dim_players(staged).filter(F.col("player_key") != F.md5("player")).count() == 0
    history = models.player_rating_history(staged)
    firsts = history.groupBy("player").agg(F.count_if(F.col("elo_change").isNull() & F.col("avg_elo").isNotNull()).alias("n"))
    assert firsts.filter("n = 0").join(history, "player").filter("avg_elo is not null").count() == 0


def test_keyed_helpers_against_brute_force(spark):
    rows = [(f"k{i}", float((i * 37) % 11) if i % 5 else None, i % 3) for i in range(200)]
    frame = spark.createDataFrame(rows, "k string, v double, c int")
    known = sorted(v for _, v, _ in rows if v is not None)
    middle = (known[(len(known) - 1) // 2] + known[len(known) // 2]) / 2
    assert keyed.exact_medians(frame, ["v"]).first()["median"] == middle
    counted = frame.filter("v is not null").groupBy("v").agg(F.count("*").alias("n"))
    for row in keyed.running_totals(counted, [], "v", ["n"], parts=3).collect():
        assert row["n_upto"] == sum(v <= row["v"] for v in known)
        assert row["n_before"] == sum(v < row["v"] for v in known)
    split = keyed.stratified_split(frame, "c", "k", 0.25).groupBy("c").agg(F.count("*").alias("n"), F.count_if("is_test").alias("t"))
    for row in split.collect():
        assert row["t"] == int(row["n"] * 0.25 + 0.5)


def test_hot_key_collapses_before_the_shuffle(spark):
    frame = spark.range(0, 30000, numPartitions=4).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), "id")).alias("game_id"), F.col("id").cast("string").alias("p")
    )
    assert bronze.bronze_games(frame, "n").filter("game_id = 'hot'").first()["n"] == 10000
    plan = bronze.bronze_games(frame)._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan and "Window" not in plan


def test_no_python_in_the_core_plans(spark, small):
    games = silver.silver_games(bronze.bronze_games(tables.raw_games(spark, small)), tables.opening_reference(spark, small))
    for frame in (games, players.player_months(games), openings.opening_performance(games), time_pressure.time_pressure(games)):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_rereading_texts_grows_with_the_input(spark, small, capsys):
    from plymill import catalog

    catalog.QUERIES["s01_split_game_texts"](spark, small).explain()
    assert "RoundRobin" not in capsys.readouterr().out  # the reader splits plain files
    catalog.QUERIES["s02_compressed_game_texts"](spark, small).explain()
    tasks = spark.conf.get("spark.sql.shuffle.partitions")
    assert f"RoundRobinPartitioning({tasks})" in capsys.readouterr().out
