import datetime as dt

import pytest
from pyspark.sql import functions as F

from plymill import cli
from plymill.plans import gate, quality, queries

SILVER = "game_id string, white string, black string, result string, white_elo int, black_elo int, game_date date, year int, month int, moves_uci array<string>, game_length int"
GOOD = ("g1", "a", "b", "white_win", 1500, 1400, dt.date(2024, 1, 1), 2024, 1, ["e2e4"], 1)


def silver(spark, *rows):
    return spark.createDataFrame([GOOD, *rows], SILVER)


def bronze(spark, *ids):
    return spark.createDataFrame([(i, "2024-01") for i in ids], "game_id string, batch_id string")


def failure(spark, before, after, **options):
    with pytest.raises(quality.QualityError) as caught:
        quality.enforce(quality.gate_checks(quality.gate_metrics(before, after), **options))
    return str(caught.value)


def changed(**values):
    names = [part.split()[0] for part in SILVER.split(", ")]
    return tuple({**dict(zip(names, GOOD, strict=True)), "game_id": "g2", **values}.values())


def test_gate_passes_and_counts(spark):
    metrics = quality.gate_metrics(bronze(spark, "g1", "g2"), silver(spark, changed(result="draw", white_elo=None)))
    quality.enforce(quality.gate_checks(metrics))
    row = metrics.first()
    assert (row["bronze_count"], row["silver_count"], row["retention"], row["elo_mean"]) == (2, 2, 1.0, 1450.0)


@pytest.mark.parametrize(
    "values, message",
    [
        ({"result": "odd"}, "1 rows with an unknown result"),
        ({"white": None}, "1 rows without white"),
        ({"white_elo": 399}, "1 rows with a rating outside the accepted range"),
        ({"month": 2}, "1 rows in the partition of another month"),
        ({"game_length": 5}, "1 rows whose length is not their number of moves"),
        ({"game_id": "g1"}, "1 ids on more than one row"),
    ],
)
def test_gate_failures(spark, values, message):
    assert failure(spark, bronze(spark, "g1", "g2"), silver(spark, changed(**values))) == message


def test_gate_volume(spark):
    assert failure(spark, bronze(spark, "g1", "g2"), silver(spark)) == "only 50.00% of the bronze rows reached silver, less than 95.00%"
    none = silver(spark).limit(0)
    assert failure(spark, bronze(spark), none) == "no rows in bronze"
    quality.enforce(quality.gate_checks(quality.gate_metrics(bronze(spark), none), allow_empty=True))
    with pytest.raises(quality.QualityError, match="cannot be checked without: game_date"):
        quality.gate_metrics(bronze(spark, "g1"), silver(spark).drop("game_date"))


def test_gate_job_selects_a_month(spark, tmp_path):
    silver(spark, changed(game_date=dt.date(2024, 2, 1), month=2, result="odd")).write.partitionBy("year", "month").parquet(str(tmp_path / "s"))
    bronze(spark, "g1").write.parquet(str(tmp_path / "b"))
    found = cli.run_gate(spark, str(tmp_path / "b"), str(tmp_path / "s"), batch_id="2024-01", month="2024-01", metrics_output=str(tmp_path / "m"))
    assert found.count() == 0
    with pytest.raises(quality.QualityError):
        cli.run_gate(spark, str(tmp_path / "b"), str(tmp_path / "s"), month="2024-02")


def test_only_audited_months_are_published(spark, tmp_path):
    paths = {name: str(tmp_path / name) for name in ("bronze", "silver", "records")}
    february = {"game_date": dt.date(2024, 2, 3), "month": 2}
    ids = [f"h{i}" for i in range(9)]
    spark.createDataFrame([("g1", "2024-01")] + [(i, "2024-02") for i in ids], "game_id string, batch_id string").write.partitionBy("batch_id").parquet(paths["bronze"])
    silver(spark).write.partitionBy("year", "month").parquet(paths["silver"])
    staged = silver(spark, *[changed(game_id=i, **february) for i in ids]).filter("month = 2")
    options = {"month": "2024-02", "metrics_output": paths["records"]}
    broken = staged.withColumn("result", F.when(F.col("game_id") != "h3", F.col("result")))
    assert gate.publish_month(spark, paths["bronze"], broken, paths["silver"], **options) == "1 rows without result"
    assert spark.read.parquet(paths["silver"]).count() == 1
    for _ in range(2):  # a rerun replaces the month
        assert gate.publish_month(spark, paths["bronze"], staged, paths["silver"], **options) is None
        assert spark.read.parquet(paths["silver"]).count() == 10
    records = spark.read.json(paths["records"]).collect()
    assert sorted(r["status"] for r in records) == ["fail", "pass", "pass"]
    assert all({a["check"] for a in r["anomalies"]} == {"volume"} and r["result_counts"] and r["partition_counts"][0]["rows"] == 9 for r in records)
    assert gate.month_before("2024-01") == "2023-12" and gate.month_before("2024-12") == "2024-11"


def test_gate_reads_two_months_only(spark, tmp_path):
    rows = silver(spark, *[changed(game_id=f"m{m}", game_date=dt.date(2024, m, 1), month=m) for m in range(2, 7)])
    rows.write.partitionBy("year", "month").parquet(str(tmp_path / "s"))
    previous = spark.read.parquet(str(tmp_path / "s")).filter(gate.lake.in_month(gate.month_before("2024-04")))
    _, month = quality.scope(bronze(spark), spark.read.parquet(str(tmp_path / "s")), month="2024-04")
    files = [r[0] for r in previous.unionByName(month).select(F.input_file_name()).distinct().collect()]
    assert sorted(f.split("month=")[1][0] for f in files) == ["3", "4"]


def months(spark, *rows):
    kinds = "year int, month int, silver_count bigint, white_win bigint, black_win bigint, draw bigint, elo_mean double, elo_stddev double"
    return spark.createDataFrame(list(rows), kinds)


def anomalies(spark, *rows):
    found = quality.drift(quality.with_previous_month(months(spark, *rows)))
    return [(r["period"], r["check"]) for r in found.orderBy("period", "check").collect()]


BASE = (2023, 12, 1000, 450, 450, 100, 1500.0, 100.0)


def test_drift(spark):
    assert anomalies(spark, BASE, (2024, 1, 1200, 540, 540, 120, 1600.0, 90.0)) == []
    assert anomalies(spark, BASE, (2024, 1, 2000, 900, 900, 200, 1500.0, 90.0)) == [("2024-01", "volume")]
    assert anomalies(spark, BASE, (2024, 1, 1000, 700, 200, 100, 1500.0, 90.0)) == [("2024-01", "result_distribution")] * 2
    assert anomalies(spark, BASE, (2024, 1, 1000, 450, 450, 100, 1801.0, 90.0)) == [("2024-01", "elo_distribution")]
    # a gap in the calendar is no comparison
    assert anomalies(spark, BASE, (2024, 2, 9, 9, 0, 0, 9.0, 1.0)) == []


def test_diagnostics_cards(spark):
    rows = [("q/parser.json", 0, 0.99, 3, None), ("q/silver_quality.json", 0, 0.5, None, 7), ("q/bronze/part-0.json", 2, None, None, 5), ("x.json", None, None, None, None)]
    frame = spark.createDataFrame(rows, "path string, duplicate_game_ids int, retention double, games_seen int, output_count int")
    cards = {r["path"]: r for r in quality.diagnostics_cards(frame).collect()}
    assert [(cards[p[0]]["kind"], cards[p[0]]["status"], cards[p[0]]["primary_count"]) for p in rows] == [
        ("parser", "pass", 3), ("silver", "warn", 7), ("bronze", "warn", 5), ("quality", "pass", None),
    ]
    assert tuple(quality.cards_summary(quality.diagnostics_cards(frame)).first()) == (2, 2, 0)


OPENINGS = "eco_code string, opening_family string, elo_bucket string, time_control_type string, year int, games_count bigint, white_win_rate double, black_win_rate double, draw_rate double, avg_game_length double, most_common_response string"


def test_queries_on_small_tables(spark):
    rows = [
        ("B20", "Sicilian Defense", "1400-1600", "blitz", 2024, 10, 0.5, 0.4, 0.1, 40.0, "c5"),
        ("C20", "King's Pawn", "1400-1600", "blitz", 2023, 8, 0.6, 0.1, 0.3, 30.0, "e5"),
        ("D00", "Queen's Pawn", "1600-1800", "rapid", 2024, 4, 0.9, 0.0, 0.1, 50.0, None),
    ]
    table = spark.createDataFrame(rows, OPENINGS)
    codes = lambda df: [r["eco_code"] for r in df.collect()]
    assert codes(queries.opening_stats(table)) == ["B20", "C20", "D00"]
    assert codes(queries.opening_stats(table, opening="sicil%DEF", year=2024)) == ["B20"]
    assert codes(queries.opening_stats(table, code="D00", limit=1)) == ["D00"]
    assert codes(queries.recommendations(table, 1500, "blitz")) == ["C20", "B20"]
    assert codes(queries.recommendations(table, goal="draw")) == ["C20", "B20"]
    assert codes(queries.recommendations(table, goal="nonsense", limit=1)) == ["C20"]
    long = queries.outcome_long(table)
    assert long.count() == 9 and {r[0] for r in long.select("outcome").distinct().collect()} == {"White wins", "Black wins", "Draws"}


def test_board_grid(spark):
    heat = spark.createDataFrame([("f3", 4), ("e4", 1)], "square string, blunders int")
    grid = {r["square"]: r for r in queries.board_grid(heat).collect()}
    assert len(grid) == 64 and grid["e4"]["intensity"] == 0.25 and grid["a1"]["value"] == 0.0
    empty = queries.board_grid(heat.limit(0))
    assert empty.count() == 64 and empty.filter("intensity <> 0").count() == 0


def test_expectations(spark):
    frame = spark.createDataFrame([("a", "x"), ("a", "y"), (None, "x"), (None, None)], "k string, v string")
    assert [tuple(r) for r in quality.expect_unique(frame, "k").collect()] == [("a", 2)]
    assert [tuple(r) for r in quality.expect_accepted(frame, "v", ["x"]).collect()] == [("y", 1)]
    assert quality.expect_not_null(frame, "k").count() == 2
    assert frame.filter(F.col("k").isNull()).count() == 2


def test_model_tests_see_positions(spark, small, monkeypatch):
    from plymill import catalog

    given = []
    build = catalog.models.build
    monkeypatch.setattr(catalog.models, "build", lambda *tables: given.append(tables[-1]) or build(*tables))
    found = catalog.QUERIES["c09_model_tests"](spark, small).collect()
    assert not given[0].isEmpty() and len(found) == 7 and all(r["failures"] == 0 for r in found)
