"""Every operator as a named query over the given tables.

Each query takes ``(spark, folder)`` and returns a frame.  Doubles are rounded
to six digits, and per-row operators are tallied by input and output, so that
results stay small however large the tables are.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plymill import cli, schemas
from plymill.functions import moves as M
from plymill.functions import scalars as S
from plymill.functions import sqlfuncs, text
from plymill.ml import baselines, cluster, frames, metrics, prep, train
from plymill.operators import board, keyed
from plymill.operators.roles import player_rows
from plymill.plans import bronze as B
from plymill.plans import corpus, gate, models, openings, players, positions, quality, queries, silver, time_pressure
from plymill.session import scratch_path, shared_folder, use_checkpoints
from plymill.sources import lake, tables
from plymill.streaming import events

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
c = F.col


def query(name: str) -> Callable[[Query], Query]:
    def register(job: Query) -> Query:
        QUERIES[name] = job
        return job

    return register


def rounded(df: DataFrame) -> DataFrame:
    doubles = [name for name, kind in df.dtypes if kind == "double"]
    return df.withColumns({name: S.stable_round(c(name), 6) for name in doubles}) if doubles else df


def tally(df: DataFrame) -> DataFrame:
    return rounded(df).groupBy(*df.columns).agg(F.count("*").alias("n"))


# ---- the tables of the pipeline -------------------------------------------------


def raw(spark, folder):
    return tables.raw_games(spark, folder)


def bronze(spark, folder):
    return B.bronze_games(tables.raw_games(spark, folder, dealt=True))


def reference(spark, folder):
    """The opening reference with one row per code, stored first: its known size lets the games stay where they are."""
    codes = silver.opening_dimension(tables.opening_reference(spark, folder))
    return prep.stored(codes.select(c("ref_code").alias("eco"), c("ref_name").alias("name")), "reference")


def candidates(spark, folder):
    return silver.candidates(bronze(spark, folder), reference(spark, folder))


def games(spark, folder):
    return silver.silver_games(bronze(spark, folder), reference(spark, folder))


def plain_games(spark, folder):
    """Silver without the reference join, for queries that do not look at opening names."""
    return silver.silver_games(bronze(spark, folder))


def staged(spark, folder):
    return models.staged_games(games(spark, folder))


def player_months(spark, folder):
    return players.player_months(plain_games(spark, folder))


def opening_rows(spark, folder):
    return openings.opening_performance(games(spark, folder))


def evaluated(spark, folder):
    return positions.evaluated_positions(plain_games(spark, folder), tables.score_lists(spark, folder))


def pressure(spark, folder):
    # both sides read the same shuffle of narrow rows; a stored table would be shuffled twice with its texts
    return time_pressure.time_pressure(plain_games(spark, folder), evaluated(spark, folder))


def written_lake(spark, folder) -> str:
    """Silver and two gold tables below a fresh root in the shared folder."""
    root = scratch_path(spark, "lake")
    silver.store(bronze(spark, folder), f"{root}/silver/games", reference(spark, folder))
    stored = spark.read.parquet(f"{root}/silver/games")
    lake.write_partitions(
        players.player_months(stored), f"{root}/gold/player_monthly_stats", "year", "month"
    )
    lake.write_partitions(openings.opening_performance(stored), f"{root}/gold/opening_performance", "year")
    return root


# ---- sources and sinks ------------------------------------------------------------


def _parsed(spark, folder, blocks=None):
    blocks = tables.game_blocks(spark, folder) if blocks is None else blocks
    return text.parse_blocks(blocks, batch_id="2024-01")


def _reread(spark, folder, **options):
    path = scratch_path(spark, "blocks")
    tables.game_blocks(spark, folder).write.options(**options).text(path)
    # plain files are split by their size; a compressed one is one task, so its rows are dealt after it
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions")) if "compression" in options else None
    return _parsed(spark, folder, lake.read_game_blocks(spark, path, partitions=tasks))


BLOCK_COLUMNS = ["game_id", "white", "black", "result", "utc_date", "moves", "clock_annotations"]


@query("s01_split_game_texts")
def _(spark, folder):
    return tally(_reread(spark, folder).select(*BLOCK_COLUMNS))


@query("s02_compressed_game_texts")
def _(spark, folder):
    parsed = _reread(spark, folder, compression="gzip")
    return tally(parsed.select("result", "termination", F.length("moves").alias("move_chars")))


def _landed(spark, folder) -> str:
    path = scratch_path(spark, "landing")
    lake.write_landing(raw(spark, folder), path, rows_per_file=10_000)
    return path


@query("s03_landing_files")
def _(spark, folder):
    landed = lake.read_landing(spark, _landed(spark, folder)).groupBy(F.input_file_name().alias("f"))
    sizes = landed.agg(F.count("*").alias("n"))
    return sizes.agg(F.sum("n").alias("n_rows"), (F.max("n") <= 10_000).alias("within_limit"))


@query("s04_landing_scan")
def _(spark, folder):
    return tally(lake.read_landing(spark, _landed(spark, folder)).select("batch_id", "source", "result"))


@query("s05_partitioned_sink")
def _(spark, folder):
    path = scratch_path(spark, "silver")
    rows = plain_games(spark, folder)
    lake.write_partitions(rows, path, "year", "month")
    # a second write of one year must leave the others alone and not double its own rows
    lake.write_partitions(rows.filter(c("year") == 1998), path, "year", "month")
    return tally(spark.read.parquet(path).select("year", "month"))


@query("s06_month_partition")
def _(spark, folder):
    path = scratch_path(spark, "silver")
    lake.write_partitions(plain_games(spark, folder), path, "year", "month")
    return lake.read_month(spark, path, "1998-03").select("game_id", "result", "year", "month")


@query("s07_reference_csv")
def _(spark, folder):
    path = scratch_path(spark, "reference")
    lake.export_csv(tables.opening_reference(spark, folder), path)
    return tally(lake.read_opening_csv(spark, path))


@query("s08_lake_views")
def _(spark, folder):
    lake.register_views(spark, written_lake(spark, folder))
    return spark.sql("select year, month, count(*) as n from silver_games group by year, month")


@query("s09_empty_placeholder")
def _(spark, folder):
    absent = lake.read_or_empty(spark, scratch_path(spark, "absent"), schemas.OPENINGS)
    return tally(absent.unionByName(opening_rows(spark, folder)).select("eco_code", "year"))


@query("s10_default_columns")
def _(spark, folder):
    old = positions.played_positions(plain_games(spark, folder)).drop("year")
    full = lake.with_defaults(old, {"year": F.lit(None).cast("int"), "square": F.lit("unused")})
    return tally(full.select("square", "year", "game_phase"))


@query("s11_presentation_views")
def _(spark, folder):
    lake.register_views(spark, written_lake(spark, folder))
    return rounded(spark.table("analytics_player_profiles"))


def _month_metrics(spark, folder):
    return quality.month_metrics(plain_games(spark, folder))


@query("s12_metrics_history")
def _(spark, folder):
    path = scratch_path(spark, "metrics")
    lake.append_metrics(_month_metrics(spark, folder), path)
    kinds = "year int, month int, silver_count bigint, white_win bigint, black_win bigint, draw bigint"
    history = lake.read_metrics(spark, path, kinds + ", elo_mean double, elo_stddev double")
    return quality.with_previous_month(history).select("period", "silver_count", "prev_silver_count")


def _diagnostics(spark, folder) -> DataFrame:
    """Parser and bronze diagnostics per month batch, written and scanned as JSON."""
    path = scratch_path(spark, "quality")
    per_batch = raw(spark, folder).groupBy("batch_id").agg(
        F.count("*").alias("games_seen"),
        F.count("*").alias("rows_written"),
        F.count_if(B.missing("game_id")).alias("missing_game_id"),
        F.count_if(B.missing("moves")).alias("missing_moves"),
    )
    lake.append_metrics(per_batch, f"{path}/parser")
    kinds = "batch_id string, games_seen bigint, rows_written bigint, missing_game_id bigint, missing_moves bigint"
    return lake.read_metrics(spark, path, kinds)


@query("s13_diagnostics_scan")
def _(spark, folder):
    scanned = _diagnostics(spark, folder)
    return scanned.filter(c("path").isNotNull()).select("batch_id", "games_seen", "missing_game_id", "missing_moves")


@query("s14_month_coverage")
def _(spark, folder):
    return lake.month_coverage(plain_games(spark, folder), "1994-11", "2002-02")


@query("s15_csv_export")
def _(spark, folder):
    path = scratch_path(spark, "export")
    lake.export_csv(rounded(opening_rows(spark, folder)), path)
    kinds = schemas.OPENINGS
    return spark.read.schema(kinds).option("header", True).csv(path)


# ---- columns ------------------------------------------------------------------------


@query("p01_tag_columns")
def _(spark, folder):
    columns = ["white", "black", "result", "white_elo", "black_elo", "eco", "opening", "time_control", "utc_time"]
    return tally(_parsed(spark, folder).select("game_id", *columns))


@query("p02_move_text")
def _(spark, folder):
    return tally(_parsed(spark, folder).select("moves"))


@query("p03_clock_comments")
def _(spark, folder):
    return tally(raw(spark, folder).select(text.clocks_of(c("moves")).alias("clocks"), "result"))


@query("p04_id_of_url")
def _(spark, folder):
    pages = tables.table(spark, folder, "pages")
    return tally(pages.select("url", text.id_of_url(c("url")).alias("page"), text.id_of_url(F.concat("url", F.lit("//"))).alias("page2")))


@query("p05_date_fallback")
def _(spark, folder):
    first = F.when(c("source") == "stream", F.lit("")).when(c("white_elo") != "?", c("utc_date"))
    rows = raw(spark, folder).select(text.first_filled(first, c("batch_id")).alias("day"))
    return tally(rows)


@query("p06_ingest_stamps")
def _(spark, folder):
    parsed = _parsed(spark, folder)
    return tally(parsed.select("batch_id", "source", c("ingested_at").isNotNull().alias("stamped")))


def _on_raw(name: str, source: str, function) -> None:
    QUERIES[name] = lambda spark, folder: tally(
        raw(spark, folder).select(c(source), function(c(source)).alias("parsed"))
    )


_on_raw("p07_result", "result", S.normalise_result)
_on_raw("p08_termination", "termination", S.normalise_termination)
_on_raw("p09_result_reason", "termination", S.result_reason)
_on_raw("p10_rating", "white_elo", S.parse_rating)
_on_raw("p24_bot_name", "white", S.is_bot)
_on_raw("p25_opening_family", "opening", S.opening_family)
_on_raw("p40_previous_month", "batch_id", S.previous_period)
_on_raw("p15_clean_tokens", "moves", lambda m: F.array_join(F.split(M.clean_tokens(m), " "), " "))
_on_raw("p14_strip_noise", "moves", M.strip_noise)
_on_raw("p16_move_tokens", "moves", lambda m: F.array_join(M.parse_tokens(m), " "))
_on_raw("p17_valid_prefix", "moves", lambda m: F.array_join(M.parse_moves(m), " "))
_on_raw("p18_captures", "moves", lambda m: M.capture_count(M.parse_moves(m)))
_on_raw("p13_clock_list", "clock_annotations", lambda t: F.array_join(S.parse_clocks(t).cast("array<string>"), " "))
_on_raw("p21_game_date", "utc_date", S.parse_game_date)


@query("p11_time_control")
def _(spark, folder):
    parsed = raw(spark, folder).select("time_control", S.parse_time_control(c("time_control")).alias("t"))
    return tally(parsed.select("time_control", "t.*"))


@query("p12_clock")
def _(spark, folder):
    tokens = raw(spark, folder).select(F.explode(F.split(F.trim("clock_annotations"), r"\s+")).alias("token"))
    return tally(tokens.select("token", S.parse_clock(c("token")).alias("seconds")))


@query("p19_castling")
def _(spark, folder):
    moves = raw(spark, folder).select(M.parse_moves(c("moves")).alias("m"))
    return tally(moves.select(M.castled(c("m"), 0).alias("white_castled"), M.castled(c("m"), 1).alias("black_castled")))


@query("p20_length_and_clock_flag")
def _(spark, folder):
    return tally(plain_games(spark, folder).select("game_length", "legal_prefix_length", "has_clock_data"))


@query("p22_rating_bucket")
def _(spark, folder):
    pair = raw(spark, folder).select(S.parse_rating(c("white_elo")).alias("w"), S.parse_rating(c("black_elo")).alias("b"))
    only_black = F.when(c("b") % 3 != 0, c("b"))
    return tally(pair.select("w", only_black.alias("b"), S.rating_bucket(c("w"), only_black).alias("bucket")))


@query("p23_numeric_rating_bucket")
def _(spark, folder):
    rows = plain_games(spark, folder)
    return tally(rows.select(S.numeric_rating_bucket(c("white_elo"), c("black_elo")).alias("bucket")))


@query("p26_first_existing_column")
def _(spark, folder):
    reference = tables.opening_reference(spark, folder)
    odd = reference.select(F.when(c("eco") > "C", c("eco")).alias("ECO"), c("eco").alias("code"), c("name").alias("Opening"))
    # only one spelling of a header may be resolved at a time
    chosen = silver.first_existing(odd, silver.CODE_NAMES[1:])
    return tally(odd.select(chosen.alias("eco"), silver.first_existing(odd, silver.TITLE_NAMES[3:]).alias("name")))


def _clock_readings(spark, folder):
    rows = raw(spark, folder).select(F.posexplode(S.parse_clocks(c("clock_annotations"))).alias("i", "seconds"))
    return rows.withColumn("ply", c("i") + 1)


@query("p27_time_left_bucket")
def _(spark, folder):
    seconds = F.when(c("seconds") != 59, c("seconds"))
    return tally(_clock_readings(spark, folder).select(S.time_left_bucket(seconds).alias("bucket")))


@query("p28_phase_of_ply")
def _(spark, folder):
    return tally(_clock_readings(spark, folder).select("ply", S.phase_of_ply(c("ply")).alias("phase")))


@query("p29_phase_of_move")
def _(spark, folder):
    lines = tables.table(spark, folder, "lineitem")
    rows = lines.select(
        F.when(c("l_partkey") % 13 != 0, (c("l_quantity")).cast("int")).alias("move_number"),
        F.when(c("l_suppkey") % 4 != 0, (c("l_suppkey") % 33).cast("int")).alias("piece_count"),
    )
    return tally(rows.select("*", S.phase_of_move(c("move_number"), c("piece_count")).alias("phase")))


@query("p30_winner")
def _(spark, folder):
    rows = plain_games(spark, folder)
    won = S.winner(c("result"), c("white"), c("black"))
    return tally(rows.select("result", won.alias("winner")))


@query("p31_surrogate_keys")
def _(spark, folder):
    rows = raw(spark, folder)
    return tally(rows.select("eco", S.surrogate_key(c("eco")).alias("one"), S.surrogate_key(c("eco"), c("opening"), c("time_control")).alias("three")))


@query("p32_staged_games")
def _(spark, folder):
    return staged(spark, folder).drop("clock_seconds", "moves_san")


@query("p33_period_label")
def _(spark, folder):
    return tally(plain_games(spark, folder).select("year", "month", S.period(c("year"), c("month")).alias("period")))


@query("p34_outcome_long")
def _(spark, folder):
    return rounded(queries.outcome_long(opening_rows(spark, folder)))


@query("p35_display_order")
def _(spark, folder):
    shown = queries.in_display_order(queries.time_pressure_stats(time_pressure.time_pressure(plain_games(spark, folder))))
    return rounded(shown.select("time_remaining_bucket", "game_phase", "time_control_type", "bucket_rank", "phase_rank", "games_count"))


@query("p36_rating_difference")
def _(spark, folder):
    return tally(frames.outcome_frame(plain_games(spark, folder)).select("elo_diff", "abs_elo_diff"))


@query("p37_opening_sentences")
def _(spark, folder):
    return corpus.opening_documents(opening_rows(spark, folder), min_games=5)


@query("p38_mart_player_profile")
def _(spark, folder):
    return rounded(models.mart_player_profile(player_months(spark, folder)))


@query("p38_mart_opening_analysis")
def _(spark, folder):
    return rounded(models.mart_opening_analysis(opening_rows(spark, folder)))


@query("p38_mart_time_pressure")
def _(spark, folder):
    return rounded(models.mart_time_pressure(pressure(spark, folder)))


@query("p39_enriched_results")
def _(spark, folder):
    return models.enriched_results(staged(spark, folder))


@query("p41_rating_label")
def _(spark, folder):
    orders = tables.table(spark, folder, "orders")
    return tally(orders.select(S.rating_label((c("o_custkey") % 3100 + 400).cast("int")).alias("label")))


# ---- filters ------------------------------------------------------------------------


@query("f01_bronze_rejects")
def _(spark, folder):
    return tally(B.rejected(raw(spark, folder)).select("white", "black", "result", "reject_reason"))


@query("f02_silver_quarantine")
def _(spark, folder):
    rejects = silver.quarantined(bronze(spark, folder), tables.opening_reference(spark, folder))
    return rejects.select("game_id", "white", "result", "year", "month", "reject_reason", F.array_join("missing_columns", ",").alias("missing"))


def _filtered(name: str, **options) -> None:
    def job(spark, folder):
        rows = silver.silver_games(bronze(spark, folder), **options)
        return rows.select("game_id", "white", "white_elo", "black_elo", "game_length")

    QUERIES[name] = job


_filtered("f03_without_bots", exclude_bots=True)
_filtered("f04_rated_only", exclude_unrated=True)
_filtered("f05_without_corrupt", drop_corrupt=True)
_filtered("c02_silver_all_filters", exclude_bots=True, exclude_unrated=True, drop_corrupt=True)


@query("f06_batch_and_month")
def _(spark, folder):
    before, after = quality.scope(
        bronze(spark, folder), plain_games(spark, folder), batch_id="1997-05", month="1997-05"
    )
    counts = after.agg(F.count("*").alias("silver_count"))
    return before.agg(F.count("*").alias("bronze_count")).withColumn("silver_count", counts.scalar())


@query("f07_optional_predicates")
def _(spark, folder):
    rows = opening_rows(spark, folder)
    return rounded(queries.opening_stats(rows, code="B02", opening="conom", year=1998, limit=40))


@query("f08_player_any_case")
def _(spark, folder):
    return rounded(queries.player_profile(player_months(spark, folder), "S17"))


@query("f09_hash_sample")
def _(spark, folder):
    return keyed.hash_sample(bronze(spark, folder), "game_id", 0.05, seed=7).select("game_id")


@query("f10_games_with_clocks")
def _(spark, folder):
    rows = plain_games(spark, folder).filter(c("has_clock_data") & (F.size("clock_seconds") > 0))
    return tally(rows.select("time_control_type", F.size("clock_seconds").alias("readings")))


@query("f11_group_threshold")
def _(spark, folder):
    return frames.player_style_frame(plain_games(spark, folder), min_games=40).select("player", "games_played")


# ---- joins ----------------------------------------------------------------------------


@query("j01_opening_dimension")
def _(spark, folder):
    return silver.opening_dimension(tables.opening_reference(spark, folder))


@query("j02_enriched_openings")
def _(spark, folder):
    return tally(games(spark, folder).select("eco_code", "opening_family", "opening_variation"))


@query("j03_time_pressure")
def _(spark, folder):
    return rounded(pressure(spark, folder))


@query("j04_player_opening_summary")
def _(spark, folder):
    rows = plain_games(spark, folder)
    style = frames.player_style_frame(rows, min_games=1).select("player", "games_played")
    joined = style.join(frames.opening_summary(rows), "player", "left")
    return joined.withColumns({n: F.coalesce(n, F.lit(0)) for n in ("opening_diversity", "top_opening_games")})


@query("j05_label_map")
def _(spark, folder):
    customers = tables.table(spark, folder, "customer").select((c("c_custkey") % 6).cast("int").alias("cluster"))
    return tally(cluster.with_labels(customers, dict(enumerate(list(cluster.PERSONAS)[:5]))))


@query("j06_orphan_keys")
def _(spark, folder):
    """Players with monthly figures who are no registered customer or supplier: the bots."""
    customers = tables.table(spark, folder, "customer").select(F.concat(F.lit("c"), "c_custkey").alias("player"))
    suppliers = tables.table(spark, folder, "supplier").select(F.concat(F.lit("s"), "s_suppkey").alias("player"))
    return models.orphans(player_months(spark, folder), "player", customers.union(suppliers), "player")


@query("j07_board_grid")
def _(spark, folder):
    return rounded(queries.board_grid(queries.blunder_heatmap(evaluated(spark, folder))))


# ---- aggregations ---------------------------------------------------------------------


@query("a01_dedupe")
def _(spark, folder):
    return B.bronze_games(raw(spark, folder)).drop("ingested_at", "moves", "clock_annotations")


@query("a02_bronze_diagnostics")
def _(spark, folder):
    return B.id_metrics(raw(spark, folder))


@query("a02_bronze_partitions")
def _(spark, folder):
    return B.partition_counts(bronze(spark, folder)).withColumnRenamed("rows", "n")


@query("a03_parser_diagnostics")
def _(spark, folder):
    """Counters of a parser run over game texts of which some have a tag without its end, or no tag at all."""
    block = c("block")
    cut = F.regexp_replace(block, r'(?m)^(\[White "c[^"]*)"\]$', "$1")
    bare = F.regexp_replace(block, r"(?m)^\[.*\]$", "")
    broken = F.when(F.contains(block, F.lit("7_1/")), cut).when(F.contains(block, F.lit("3_2/")), bare).otherwise(block)
    blocks = tables.game_blocks(spark, folder).select(broken.alias("block"))
    report, rejects = scratch_path(spark, "parser"), scratch_path(spark, "rejects")
    B.parse(spark, blocks, scratch_path(spark, "landing"), batch_id="2024-01", metrics_output=report, quarantine_output=rejects)
    reasons = spark.read.parquet(rejects).agg(
        F.count_if(c("reject_reason") == "broken_tag").alias("broken_tags"), F.count_if(c("reject_reason") == "no_tags").alias("without_tags")
    )
    return spark.read.json(report).crossJoin(F.broadcast(reasons))  # one row each


@query("a04_player_months")
def _(spark, folder):
    return rounded(player_months(spark, folder))


@query("a05_opening_performance")
def _(spark, folder):
    return rounded(opening_rows(spark, folder))


@query("a06_clock_histogram")
def _(spark, folder):
    return time_pressure.clock_histogram(plain_games(spark, folder))


@query("a07_position_quality")
def _(spark, folder):
    return rounded(time_pressure.position_quality(evaluated(spark, folder)))


@query("a08_time_pressure_without_evaluations")
def _(spark, folder):
    return time_pressure.time_pressure(plain_games(spark, folder))


@query("a09_player_dimension")
def _(spark, folder):
    return rounded(models.dim_players(staged(spark, folder)))


@query("a10_opening_dimension")
def _(spark, folder):
    return rounded(models.dim_openings(staged(spark, folder)))


@query("a11_time_controls")
def _(spark, folder):
    return models.dim_time_controls(staged(spark, folder))


@query("a12_blunder_mart")
def _(spark, folder):
    return rounded(models.mart_blunder_heatmap(evaluated(spark, folder)))


@query("a13_blunder_heatmap")
def _(spark, folder):
    return queries.blunder_heatmap(evaluated(spark, folder), year=1998)


@query("a13_heatmap_totals")
def _(spark, folder):
    return queries.heatmap_totals(queries.blunder_heatmap(evaluated(spark, folder)))


@query("a14_opening_stats")
def _(spark, folder):
    return queries.opening_stats(opening_rows(spark, folder), limit=100)


@query("a14_opening_summary_weighted")
def _(spark, folder):
    return queries.opening_summary(opening_rows(spark, folder))


@query("a15_time_pressure_stats")
def _(spark, folder):
    return queries.time_pressure_stats(pressure(spark, folder), year=1999)


@query("a16_player_leaderboard")
def _(spark, folder):
    return queries.player_leaderboard(player_months(spark, folder), search="c1", limit=50)


@query("a17_overview")
def _(spark, folder):
    # the texts are parsed again for each table, from the same shuffle of narrow rows
    plain = plain_games(spark, folder)
    return queries.overview(
        players.player_months(plain), opening_rows(spark, folder), time_pressure.time_pressure(plain), evaluated(spark, folder)
    )


@query("a18_table_counts")
def _(spark, folder):
    counts = queries.table_counts(
        {
            "opening_stats": opening_rows(spark, folder),
            "player_profiles": player_months(spark, folder),
            "blunder_positions": evaluated(spark, folder),
        }
    )
    return counts.withColumnRenamed("rows", "n")


@query("a19_opening_kpis")
def _(spark, folder):
    return queries.opening_kpis(opening_rows(spark, folder))


@query("a19_player_kpis")
def _(spark, folder):
    return queries.player_kpis(queries.player_profile(player_months(spark, folder), "s5"))


@query("a19_heatmap_kpis")
def _(spark, folder):
    return queries.heatmap_kpis(queries.blunder_heatmap(evaluated(spark, folder)))


@query("a19_time_pressure_kpis")
def _(spark, folder):
    shown = queries.time_pressure_stats(pressure(spark, folder))
    return queries.time_pressure_kpis(shown, ["blitz", "rapid"])


@query("a20_player_style")
def _(spark, folder):
    return rounded(frames.player_style_frame(plain_games(spark, folder), min_games=10))


@query("a21_opening_diversity")
def _(spark, folder):
    return frames.opening_summary(plain_games(spark, folder))


@query("a22_opening_documents")
def _(spark, folder):
    return corpus.opening_documents(opening_rows(spark, folder), min_games=8, limit=50)


@query("a23_player_documents")
def _(spark, folder):
    return corpus.player_documents(player_months(spark, folder))


@query("a24_class_shares")
def _(spark, folder):
    return rounded(frames.class_shares(plain_games(spark, folder), "result").withColumnRenamed("rows", "n"))


# ---- windows, sorts, sets ---------------------------------------------------------------


@query("w01_player_rating_history")
def _(spark, folder):
    return rounded(models.player_rating_history(staged(spark, folder)))


@query("w02_previous_month")
def _(spark, folder):
    return rounded(quality.with_previous_month(_month_metrics(spark, folder)))


@query("w03_evaluation_change")
def _(spark, folder):
    rows = evaluated(spark, folder).select("ply_number", "eval_before_cp", "eval_after_cp", "cp_loss")
    return tally(rows)


@query("w04_in_check")
def _(spark, folder):
    rows = positions.played_positions(plain_games(spark, folder))
    return tally(rows.select("ply_number", "move", "is_in_check"))


@query("w05_material_balance")
def _(spark, folder):
    rows = positions.played_positions(plain_games(spark, folder))
    return tally(rows.select("ply_number", "move", "square", "material_balance"))


@query("o01_top_openings")
def _(spark, folder):
    return queries.opening_stats(opening_rows(spark, folder), limit=25)


@query("o02_recommendations_win")
def _(spark, folder):
    rows = queries.recommendations(opening_rows(spark, folder), player_rating=1500, time_control="blitz", limit=10)
    return rounded(rows)


@query("o02_recommendations_draw")
def _(spark, folder):
    return rounded(queries.recommendations(opening_rows(spark, folder), goal="draw", limit=15))


@query("o03_player_history")
def _(spark, folder):
    return rounded(queries.player_profile(player_months(spark, folder), "s42"))


@query("o05_years")
def _(spark, folder):
    return queries.years(opening_rows(spark, folder), player_months(spark, folder))


@query("o06_nearest_vectors")
def _(spark, folder):
    vectors = tables.table(spark, folder, "embeddings")
    probe = vectors.filter(c("vec_id") == 3).select("embedding").scalar()
    return corpus.nearest(vectors, probe, k=6)


@query("x01_player_rows")
def _(spark, folder):
    rows = player_rows(plain_games(spark, folder), ["year"])
    return rows.groupBy("player", "seat", "year").agg(
        F.count("*").alias("n"), *[F.count_if(c(x)).alias(x) for x in ("won", "lost", "drew")], F.sum("elo").alias("elo")
    )


@query("x02_distinct_years")
def _(spark, folder):
    rows = raw(spark, folder).select(F.substring("batch_id", 1, 4).alias("y"))
    other = tables.table(spark, folder, "orders").select(F.year("o_orderdate").cast("string").alias("y"))
    return rows.union(other).distinct()


# ---- quality ------------------------------------------------------------------------------


def _gate(spark, folder):
    # the gate reads finished tables: write silver once instead of deriving it per check
    path = scratch_path(spark, "silver")
    lake.write_partitions(plain_games(spark, folder), path, "year", "month")
    return quality.gate_metrics(bronze(spark, folder), spark.read.parquet(path))


@query("q02_gate_retention")
def _(spark, folder):
    return rounded(_gate(spark, folder).select("bronze_count", "silver_count", "retention"))


@query("q03_gate_checks")
def _(spark, folder):
    checks = quality.gate_checks(_gate(spark, folder), min_retention=0.99)
    return checks.select("position", "check", "bad_rows", "passed", F.coalesce("message", F.lit("")).alias("message"))


@query("q03_gate_on_candidates")
def _(spark, folder):
    rows = candidates(spark, folder).select(*quality.GATE_COLUMNS, "moves_san", "has_clock_data")
    return rounded(quality.gate_metrics(raw(spark, folder), rows).drop("elo_mean", "elo_stddev"))


@query("q04_gate_metrics")
def _(spark, folder):
    return rounded(_gate(spark, folder).select("clock_rows", "clock_coverage", "elo_mean", "elo_stddev"))


@query("q04_result_counts")
def _(spark, folder):
    return quality.result_counts(plain_games(spark, folder)).withColumnRenamed("rows", "n")


@query("q04_month_counts")
def _(spark, folder):
    return quality.month_counts(plain_games(spark, folder)).withColumnRenamed("rows", "n")


@query("q05_drift")
def _(spark, folder):
    return rounded(quality.drift(quality.with_previous_month(_month_metrics(spark, folder))))


@query("q06_expectations")
def _(spark, folder):
    rows = raw(spark, folder)
    repeated = quality.expect_unique(rows, "game_id").select(c("game_id").alias("value"), c("copies").alias("n"))
    wrong = quality.expect_accepted(rows, "result", ["1-0", "0-1"]).select(c("result").alias("value"), c("rows").alias("n"))
    absent = quality.expect_not_null(rows, "eco").groupBy(c("eco").alias("value")).agg(F.count("*").alias("n"))
    return repeated.unionByName(wrong).unionByName(absent)


@query("q07_rating_range_violations")
def _(spark, folder):
    rows = bronze(spark, folder).select("game_id", *[c(x).try_cast("int").alias(x) for x in ("white_elo", "black_elo")])
    return quality.expect_rating_range(rows)


def _four_records(spark, folder) -> DataFrame:
    """One record of each kind, as the parser, the bronze, the silver and the gate job write them."""
    top = scratch_path(spark, "records")
    landing, bronze_path, silver_path = (scratch_path(spark, x) for x in ("landing", "bronze", "silver"))
    lake.append_metrics(B.parser_metrics(raw(spark, folder)), f"{top}/parser")
    lake.write_landing(raw(spark, folder), landing)
    B.run(spark, landing, bronze_path, metrics_output=f"{top}/bronze")
    silver.run(spark, bronze_path, silver_path, metrics_output=f"{top}/silver")
    month = lake.read_month(spark, silver_path, "1996-11")
    before = lake.read_month(spark, silver_path, "1996-10")
    batch = spark.read.parquet(bronze_path).filter(c("batch_id") == "1996-11")
    lake.append_metrics(gate.record(batch, month, before, month="1996-11"), f"{top}/quality")
    return lake.read_metrics(spark, top)


@query("q08_diagnostics_cards")
def _(spark, folder):
    cards = quality.diagnostics_cards(_four_records(spark, folder)).drop("path")
    return rounded(cards.select("kind", "status", "primary_count", "retention", "clock_coverage", "rows_removed", "duplicate_game_ids", "anomaly_count"))


@query("q08_cards_summary")
def _(spark, folder):
    return quality.cards_summary(quality.diagnostics_cards(_four_records(spark, folder)))


@query("q01_contract")
def _(spark, folder):
    """What the contract check says of a table without a column that the gate reads."""
    rows = plain_games(spark, folder)
    said = []
    for name in quality.GATE_COLUMNS:
        try:
            quality.check_contract(rows.drop(name), quality.GATE_COLUMNS, "silver")
        except quality.QualityError as error:
            said.append((name, name in str(error), rows.schema[name].dataType.simpleString()))
    found = spark.createDataFrame(said, "column string, named boolean, kind string")
    return found.withColumn("rows", rows.agg(F.count("*")).scalar())


@query("q09_class_validation")
def _(spark, folder):
    frame = frames.outcome_frame(plain_games(spark, folder))
    counts = frames.validate_classes(frame, "result", schemas.RESULTS, frames.outcome_features("post_game"))
    return spark.createDataFrame(sorted(counts.items()), "result string, n bigint")


# ---- evaluated positions --------------------------------------------------------------------


@query("e01_half_moves")
def _(spark, folder):
    return tally(positions.played_positions(plain_games(spark, folder), max_plies=None).select("ply_number", "move"))


@query("e02_target_square")
def _(spark, folder):
    return tally(positions.played_positions(plain_games(spark, folder)).select("move", "square"))


@query("e03_mover_rating")
def _(spark, folder):
    rows = positions.played_positions(plain_games(spark, folder))
    return rows.groupBy("ply_number").agg(F.count("player_elo").alias("n"), F.sum("player_elo").alias("elo"))


@query("e04_time_remaining")
def _(spark, folder):
    rows = positions.played_positions(plain_games(spark, folder))
    return tally(rows.select("ply_number", "time_remaining_seconds"))


@query("e05_evaluations")
def _(spark, folder):
    rows = evaluated(spark, folder)
    return rows.groupBy("ply_number").agg(
        F.count("eval_before_cp").alias("n"), F.sum("eval_before_cp").alias("before"), F.sum("eval_after_cp").alias("after")
    )


@query("e06_loss_and_blunder")
def _(spark, folder):
    return tally(evaluated(spark, folder).select("cp_loss", "is_blunder"))


@query("e07_phase")
def _(spark, folder):
    return tally(positions.played_positions(plain_games(spark, folder)).select("game_phase", "time_control_type"))


@query("e08_e09_position_features")
def _(spark, folder):
    rows = evaluated(spark, folder)
    return tally(rows.select("game_phase", "square", "is_in_check", "material_balance", "is_blunder"))


@query("e10_sampled_positions")
def _(spark, folder):
    rows = positions.evaluated_positions(
        plain_games(spark, folder), tables.evaluations(spark, folder), fraction=0.02, seed=11
    )
    return rows


# ---- learning -----------------------------------------------------------------------------------


def _outcomes(spark, folder):
    return frames.outcome_frame(games(spark, folder), "game_id")


def _scored(spark, folder):
    """Labels and scores from plain arithmetic on the order lines."""
    lines = tables.table(spark, folder, "lineitem")
    score = ((c("l_partkey") * 7 + c("l_orderkey") * 3 + F.when(c("l_returnflag") == "R", 90).otherwise(0)) % 1000) / 1000
    rows = lines.select((c("l_returnflag") == "R").cast("int").alias("label"), score.alias("score"))
    return rows.withColumn("prediction", (c("score") >= 0.5).cast("int"))


def _scored_classes(spark, folder):
    lines = tables.table(spark, folder, "lineitem")
    parts = [1 + c("l_partkey") % 7, 1 + c("l_suppkey") % 5, 1 + c("l_linenumber") % 6]
    total = parts[0] + parts[1] + parts[2]
    label = F.when(c("l_returnflag") == "A", 0).when(c("l_returnflag") == "N", 1).otherwise(2)
    best = F.when((parts[0] >= parts[1]) & (parts[0] >= parts[2]), 0).when(parts[1] >= parts[2], 1).otherwise(2)
    return lines.select(
        label.alias("label"), best.alias("prediction"), F.array(*[p / total for p in parts]).alias("probabilities")
    )


@query("m01_blunder_frame")
def _(spark, folder):
    frame = frames.blunder_frame(evaluated(spark, folder))
    return rounded(
        frame.groupBy("is_blunder", "game_phase", "time_control_type").agg(
            F.count("*").alias("n"),
            *[F.sum(x).alias(x) for x in frames.BLUNDER_NUMERIC],
            F.count_distinct("square").alias("squares"),
        )
    )


@query("m02_outcome_frame")
def _(spark, folder):
    names = frames.OUTCOME_NUMERIC + frames.OUTCOME_PLAYED
    frame = _outcomes(spark, folder)
    return rounded(
        frame.groupBy("result", "time_control_type").agg(
            F.count("*").alias("n"), *[F.sum(c(x).cast("double")).alias(x) for x in names], F.count_distinct("opening_variation").alias("variations")
        )
    )


@query("m03_medians")
def _(spark, folder):
    return rounded(keyed.exact_medians(_outcomes(spark, folder), frames.OUTCOME_NUMERIC + frames.OUTCOME_PLAYED))


@query("m04_most_frequent_levels")
def _(spark, folder):
    return prep.most_frequent_levels(_outcomes(spark, folder), frames.OUTCOME_CATEGORIES)


@query("m05_one_hot")
def _(spark, folder):
    """Of each category: its levels, the vector's width, and how many rows and ones it has."""
    names = frames.OUTCOME_CATEGORIES
    # the levels are counted first and filled in after it, so the rows are stored rather than derived twice
    plain = prep.stored(_outcomes(spark, folder).select("year", *names), "categories")
    frame = prep.stored(prep.impute_levels(plain, names), "levels")
    coded = prep.encoder(["year"], names).fit(frame).transform(frame)

    def facts(name):
        ones = vector_to_array(f"{name}_onehot")
        total = F.aggregate(ones, F.lit(0.0), lambda x, y: x + y)
        return F.struct(
            F.lit(name).alias("feature"), F.count_distinct(name).alias("levels"), F.max(F.size(ones)).alias("width"),
            F.count("*").alias("n"), F.sum(total).cast("long").alias("ones"),
        )

    return coded.agg(F.array(*[facts(name) for name in names]).alias("f")).select(F.explode("f").alias("f")).select("f.*")


@query("m06_rare_levels")
def _(spark, folder):
    frame = _outcomes(spark, folder).select("opening_variation", "time_control_type")
    return tally(prep.fold_rare(frame, "opening_variation", 400))


@query("m07_stratified_split")
def _(spark, folder):
    split = keyed.stratified_split(_outcomes(spark, folder).select("result", "game_id"), "result", "game_id")
    return split.groupBy("result", "is_test").agg(
        F.count("*").alias("n"), F.min("game_id").alias("first_id"), F.max("game_id").alias("last_id")
    )


@query("m08_class_weights")
def _(spark, folder):
    return rounded(prep.class_weights(_outcomes(spark, folder), "result"))


@query("m08_positive_weight")
def _(spark, folder):
    return rounded(prep.class_weights(_scored(spark, folder), "label", balanced=False))


def _blunder_training(spark, folder):
    rows = evaluated(spark, folder).withColumn("row_id", F.concat_ws("-", "game_id", "ply_number"))
    path = scratch_path(spark, "blunder-frame")
    lake.write_partitions(frames.blunder_frame(rows, "row_id"), path)
    return spark.read.parquet(path)


def model_path(spark, folder, name):
    """Where jobs that read the same files share a fitted model."""
    sources = [lake.fingerprint(tables.table(spark, folder, t)) for t in ("lineitem", "orders", "part")]
    return f"{shared_folder(spark)}/models/{name}-{'-'.join(s[:8] for s in sources)}"


def _blunder_model(spark, folder):
    use_checkpoints(spark)
    path = model_path(spark, folder, "blunder")
    return train.fitted_once(spark, path, lambda: train.train_blunder(_blunder_training(spark, folder), "row_id"))


@query("m09_blunder_model")
def _(spark, folder):
    """Rows by class, and what has to hold of a fitted model and its six metrics."""
    trained = _blunder_model(spark, folder)
    booster = trained.model.stages[-1]
    six = F.array("accuracy", "precision", "recall", "f1", "roc_auc", "pr_auc")
    sound = F.forall(six, lambda m: m.between(0, 1))
    facts = trained.metrics.select(sound.alias("metrics_in_range"), (c("roc_auc") > 0.5).alias("beats_chance"))
    facts = facts.withColumns({"trees": F.lit(booster.getNumTrees), "depth": F.lit(booster.getMaxDepth())})
    return trained.sizes.crossJoin(F.broadcast(facts))  # one row


@query("m11_batch_scoring")
def _(spark, folder):
    """The test rows of each class, all scored: four digits, calls that follow the threshold."""
    scored = _blunder_model(spark, folder).scored
    digits = F.abs(c("score") * 10_000 - F.round(c("score") * 10_000)) < 1e-6
    follows = (c("score") == 0.5) | ((c("score") > 0.5).cast("int") == c("prediction"))
    return scored.groupBy("label").agg(
        F.count("*").alias("n"), F.count_if(c("score").between(0, 1) & digits).alias("n_scored"),
        F.count_if(follows).alias("n_called"), F.min("row_id").alias("first_id"), F.max("row_id").alias("last_id"),
    )


@query("m26_o04_importances")
def _(spark, folder):
    """Importances add up to 1; each number and each category has its share."""
    found = _blunder_model(spark, folder).importances
    groups = [*frames.BLUNDER_NUMERIC, *frames.BLUNDER_CATEGORIES]
    name = F.coalesce(*[F.when(F.startswith("feature", F.lit(g)), g) for g in groups])
    known = found.groupBy(name.alias("feature")).agg(F.sum("importance").alias("share"), F.min("importance").alias("least"))
    return rounded(
        known.agg(
            F.count("*").alias("features"), F.sum("share").alias("total"), F.count_if(c("least") < 0).alias("negative"),
            F.count_if(c("feature").isNull()).alias("unnamed"),
        )
    )


def _outcome_training(spark, folder):
    path = scratch_path(spark, "outcome-frame")
    lake.write_partitions(_outcomes(spark, folder), path)
    return spark.read.parquet(path)


def _outcome_models(spark, folder, boosted):
    """Of each feature set and class: its rows, and how many test rows have sound probabilities and calls."""
    use_checkpoints(spark)
    paths = {s: model_path(spark, folder, f"outcome-{s}-{'boosted' if boosted else 'forest'}") for s in frames.OUTCOME_SETS}
    missing = any(not train.complete(spark, path) for path in paths.values())
    frame = _outcome_training(spark, folder) if missing else None  # holds the features of all sets

    def fit(name):
        return train.fitted_once(spark, paths[name], lambda: train.train_outcome(frame, "game_id", name, boosted=boosted))

    with ThreadPool(len(paths)) as pool:  # a fit is a thousand short jobs, which leave most cores idle
        fits = pool.map(inheritable_thread_target(spark)(fit), paths)
    found = []
    for name, trained in zip(paths, fits, strict=True):
        p = c("probabilities")
        total = F.aggregate(p, F.lit(0.0), lambda x, y: x + y)
        sound = (F.size(p) == 3) & F.forall(p, lambda x: x.between(0, 1)) & (F.abs(total - 1) < 1e-9)
        scored = trained.scored.groupBy(c("label").alias("class")).agg(
            F.count_if(sound).alias("n_sound"), F.count_if(F.get(p, c("prediction")) == F.array_max(p)).alias("n_called")
        )
        loss = trained.metrics.select((c("log_loss") > 0).alias("loss_known"))
        found.append(trained.sizes.join(scored, "class").crossJoin(F.broadcast(loss)).withColumn("feature_set", F.lit(name)))
    return reduce(DataFrame.unionByName, found)


@query("m10_outcome_models")
def _(spark, folder):
    return _outcome_models(spark, folder, boosted=False)


@query("m10_boosted_outcome_models")
def _(spark, folder):
    return _outcome_models(spark, folder, boosted=True)


@query("m12_binary_metrics")
def _(spark, folder):
    return rounded(metrics.binary_metrics(_scored(spark, folder)))


@query("m13_ranking_metrics")
def _(spark, folder):
    return rounded(metrics.ranking_metrics(_scored(spark, folder)))


@query("m13_curve_points")
def _(spark, folder):
    points = metrics.curve_points(_scored(spark, folder))
    return rounded(points.select((-c("position")).alias("score"), "pos", "neg", "pos_upto", "neg_upto"))


@query("m14_threshold_sweep")
def _(spark, folder):
    return rounded(metrics.threshold_sweep(_scored(spark, folder)))


@query("m15_multiclass_metrics")
def _(spark, folder):
    return rounded(metrics.multiclass_metrics(_scored_classes(spark, folder)))


@query("m16_confusion_matrix")
def _(spark, folder):
    return metrics.confusion_matrix(_scored_classes(spark, folder), [0, 1, 2])


@query("m16_per_class_f1")
def _(spark, folder):
    return rounded(metrics.per_class_metrics(_scored_classes(spark, folder)).drop("hits"))


@query("m17_blunder_baselines")
def _(spark, folder):
    frame = frames.blunder_frame(evaluated(spark, folder)).select("is_blunder", "time_remaining_seconds", "material_balance")
    path = scratch_path(spark, "blunder-frame")
    lake.write_partitions(frame, path)
    return rounded(baselines.blunder_baseline_metrics(spark.read.parquet(path)))


@query("m18_m25_outcome_baselines")
def _(spark, folder):
    frame = _outcomes(spark, folder).select(
        prep.label_index(c("result"), schemas.RESULTS).alias("label"), "white_elo", "black_elo"
    )
    path = scratch_path(spark, "labels")
    lake.write_partitions(frame, path)
    return rounded(baselines.outcome_baseline_metrics(spark.read.parquet(path)))


def _style(spark, folder):
    return frames.player_style_frame(plain_games(spark, folder), min_games=10)


@query("m19_standardised")
def _(spark, folder):
    scores = prep.standardised(_style(spark, folder), ["win_rate", "avg_elo", "castle_rate", "opening_diversity"])
    return rounded(scores.select("player", *[x for x in scores.columns if x.endswith("_z")]))


def _style_table(spark, folder):
    path = scratch_path(spark, "style")
    lake.write_partitions(_style(spark, folder), path)
    return spark.read.parquet(path)


@query("m20_m22_clustered_players")
def _(spark, folder):
    """Every eligible player has one cluster and a place; clusters differ in label; sizes add up."""
    found = cluster.cluster_players(_style_table(spark, folder), clusters=4)
    placed = c("pca_x").isNotNull() & c("pca_y").isNotNull()
    each = found.assignments.groupBy("cluster").agg(
        F.count("*").alias("n"), F.count_distinct("player").alias("own"), F.count_if(placed).alias("placed"),
        F.min("style_label").alias("one"), F.max("style_label").alias("other"),
    )
    sizes = found.profiles.agg(F.sum("cluster_size")).scalar()
    explained = found.metrics["pca_explained_variance_ratio"]
    return each.agg(
        F.sum("n").alias("players"), F.sum("own").alias("distinct_players"), F.sum("placed").alias("placed"),
        F.count("*").alias("clusters"), F.count_distinct("one").alias("labels"), F.count_if(c("one") != c("other")).alias("mixed"),
    ).withColumns({"profiled": sizes, "explained_in_range": F.lit(0 < explained <= 1)})


@query("m21_cluster_sweep")
def _(spark, folder):
    """Every number of clusters with a sound silhouette and less inertia than the smallest has."""
    found = cluster.sweep(cluster.scaled(_style_table(spark, folder)))
    first = F.max_by("inertia", -c("clusters")).over(Window.partitionBy(F.lit(0)))
    return found.select(
        "clusters", c("silhouette_score").between(-1, 1).alias("silhouette_in_range"),
        ((c("inertia") < first) | (c("inertia") == first) & (c("clusters") == 3)).alias("inertia_falls"),
    )


@query("m23_cluster_profiles")
def _(spark, folder):
    assigned = _style(spark, folder).withColumn("cluster", (F.length("player") % 4).cast("int"))
    return rounded(cluster.profiles(assigned))


@query("m24_persona_scores")
def _(spark, folder):
    assigned = _style(spark, folder).withColumn("cluster", (F.length("player") % 4).cast("int"))
    return rounded(cluster.persona_scores(cluster.profiles(assigned)))


@query("m27_knowledge_corpus")
def _(spark, folder):
    items = tables.table(spark, folder, "benchmark")
    concepts = items.select(F.concat(F.lit("concept_"), "item_id").alias("doc_id"), "text")
    return corpus.knowledge_corpus(
        opening_rows(spark, folder), player_months(spark, folder), concepts, min_opening_games=8
    )


@query("m28_label_index")
def _(spark, folder):
    return tally(plain_games(spark, folder).select("result", prep.label_index(c("result"), schemas.RESULTS).alias("label")))


# ---- streams --------------------------------------------------------------------------------------


def _lines_folder(spark, folder) -> str:
    path = scratch_path(spark, "events")
    tables.game_events(spark, folder).select("value").write.text(path)
    return path


@query("t01_t04_published_events")
def _(spark, folder):
    lines = events.read_event_lines(spark, _lines_folder(spark, folder))
    out, mark = scratch_path(spark, "topic"), scratch_path(spark, "mark")
    events.publish(events.encode(lines, "live"), out, mark).awaitTermination()
    sent = spark.read.schema("key string, value string").json(out)
    return tally(sent.select("key", F.get_json_object("value", "$.source").alias("source"), F.get_json_object("value", "$.event.status").alias("status")))


def _envelopes(spark, folder):
    return events.encode(tables.game_events(spark, folder), "live", c("ts"))


@query("t02_envelopes")
def _(spark, folder):
    return _envelopes(spark, folder).select("value")


@query("t03_event_keys")
def _(spark, folder):
    return tally(tables.game_events(spark, folder).select(events.event_key(c("value")).alias("key")))


@query("t04_capped_publishing")
def _(spark, folder):
    path, mark = scratch_path(spark, "topic"), scratch_path(spark, "mark")
    lines = scratch_path(spark, "events")
    events.capped(tables.game_events(spark, folder).select("value"), 500).write.text(lines)
    events.publish(events.encode(events.read_event_lines(spark, lines), "live"), path, mark).awaitTermination()
    return spark.read.schema("key string, value string").json(path).agg(F.count("*").alias("n"), F.count("value").alias("envelopes"))


def _envelope_stream(spark, folder) -> DataFrame:
    """The envelopes in four parts, oldest first, a file at a time."""
    path = scratch_path(spark, "envelopes")
    rows = tables.game_events(spark, folder)
    first, last = rows.agg(F.min("ts"), F.max("ts")).first()
    cuts = [first + (last - first) * i / 4 for i in range(1, 4)]
    place = sum((c("ts") >= F.lit(cut)).cast("int") for cut in cuts)
    for part in range(4):
        own = rows.filter(place == part)
        events.encode(own, "live", c("ts")).select("value").write.mode("append").text(path)
    return events.decode(spark.readStream.format("text").option("maxFilesPerTrigger", 1).load(path))


@query("t05_unique_events")
def _(spark, folder):
    out, mark, rejects = (scratch_path(spark, x) for x in ("bronze", "mark", "rejects"))
    events.ingest(_envelope_stream(spark, folder), out, mark, rejects).awaitTermination()
    return events.accepted_events(spark, out).select("key", "source")


@query("t05_keyless_events")
def _(spark, folder):
    out, mark = scratch_path(spark, "keyless"), scratch_path(spark, "mark")
    events.quarantine(_envelope_stream(spark, folder), out, mark).awaitTermination()
    return tally(spark.read.parquet(out).select("status", "reject_reason"))


def _utc_text(column) -> F.Column:
    return F.date_format(F.convert_timezone(None, F.lit("UTC"), column.cast("timestamp_ntz")), "yyyy-MM-dd HH:mm")


@query("t06_status_counts")
def _(spark, folder):
    counts = events.status_counts(events.decode(_envelopes(spark, folder)), "6 hours")
    return counts.select(_utc_text(c("window_start")).alias("window_start"), "status", "n_events")


@query("t06_status_counts_streamed")
def _(spark, folder):
    out, mark = scratch_path(spark, "counts"), scratch_path(spark, "mark")
    events.count_stream(_envelope_stream(spark, folder), out, mark, "6 hours", "7 days").awaitTermination()
    counts = events.latest_counts(spark, out)
    return counts.select(_utc_text(c("window_start")).alias("window_start"), "status", "n_events")


# ---- surfaces and composites ------------------------------------------------------------------------


@query("u02_sql_functions")
def _(spark, folder):
    sqlfuncs.register(spark)
    raw(spark, folder).createOrReplaceTempView("raw_games")
    return spark.sql(
        """
        select ply_normalize_result(result) as result, ply_normalize_termination(termination) as termination,
          ply_result_reason(termination) as reason, ply_parse_elo(white_elo) as elo,
          ply_elo_bucket(ply_parse_elo(white_elo), ply_parse_elo(black_elo)) as bucket,
          cast(size(ply_parse_clock_seconds(clock_annotations)) as bigint) as clocks,
          array_join(ply_parse_san_tokens(moves), ' ') as tokens, array_join(ply_parse_moves(moves), ' ') as moves,
          ply_classify_game_phase(cast(length(moves) as int) div 8, 24) as phase, count(*) as n
        from raw_games group by all
        """
    )


@query("u03_partition_scorer")
def _(spark, folder):
    """A scorer with a table of letter values that it opens once per partition; one score per half-move."""

    @contextmanager
    def letters():
        yield {letter: i + 1 for i, letter in enumerate("abcdefghKQRBN")}

    def score(values, game_id, moves):
        return [(i + 1, 10 * values.get(move[0], 0) * (-1) ** i) for i, move in enumerate(moves)]

    return tally(positions.score_with(plain_games(spark, folder), letters, score).select("ply", "eval_cp"))


@query("u04_adhoc_select")
def _(spark, folder):
    plain_games(spark, folder).createOrReplaceTempView("adhoc_games")
    return sqlfuncs.run_select(
        spark, "SELECT result, year, count(*) AS n FROM adhoc_games GROUP BY result, year ORDER BY n DESC, result, year"
    )


@query("c01_bronze_job")
def _(spark, folder):
    out, rejects = scratch_path(spark, "bronze"), scratch_path(spark, "rejects")
    report = scratch_path(spark, "report")
    B.run(spark, _landed(spark, folder), out, metrics_output=report, quarantine_output=rejects)
    kept = spark.read.parquet(out).select("source", F.lit("kept").alias("state"))
    return tally(kept.unionByName(spark.read.parquet(rejects).select("source", F.lit("rejected").alias("state"))))


@query("c02_silver_job")
def _(spark, folder):
    path, out, rejects = (scratch_path(spark, x) for x in ("bronze", "silver", "rejects"))
    lake.write_partitions(bronze(spark, folder), path, "batch_id", "source")
    silver.run(spark, path, out, quarantine_output=rejects)
    kept = spark.read.parquet(out).select("result", F.lit("kept").alias("state"))
    return tally(kept.unionByName(spark.read.parquet(rejects).select("result", F.lit("rejected").alias("state"))))


@query("c02_silver_games")
def _(spark, folder):
    rows = games(spark, folder)
    return rows.withColumns({"clock_seconds": F.array_join(c("clock_seconds").cast("array<string>"), " "), "moves_san": F.array_join("moves_san", " ")})


@query("c03_gate_and_publish")
def _(spark, folder):
    """Three staged months: one like the month before, one rated on another scale, one with broken results."""
    bronze_path, silver_path, staged, records = (scratch_path(spark, x) for x in ("bronze", "silver", "staged", "records"))
    lake.write_partitions(bronze(spark, folder).select("game_id", "batch_id"), bronze_path, "batch_id")
    silver.store(bronze(spark, folder), staged)
    lake.write_partitions(lake.read_month(spark, staged, "1996-09"), silver_path, "year", "month")
    months = ["1996-10", "1996-11", "1996-12"]
    for month in months:
        rows = lake.read_month(spark, staged, month)
        if month == "1996-12":
            rows = rows.withColumn("result", F.when(c("white") < "c5", c("result")))
        gate.publish_month(spark, bronze_path, rows, silver_path, month=month, metrics_output=records, min_retention=0.5)
    stored = spark.read.parquet(silver_path).groupBy("year", "month").agg(F.count("*").alias("stored_rows"))
    stored = stored.select(S.period(c("year"), c("month")).alias("period"), "stored_rows")
    found = lake.read_metrics(spark, records).select(
        "period", "status", "silver_count", F.size("anomalies").alias("anomalies"),
        F.array_join(F.transform(F.filter("checks", lambda x: ~x["passed"]), lambda x: x["check"]), ",").alias("failed"),
    )
    return found.join(stored, "period", "left").withColumn("stored_rows", F.coalesce("stored_rows", F.lit(0).cast("long")))


def _job(spark, folder, stage, output, *keys, **options):
    """Run a job of the command line twice on silver, as a rerun must not change its table."""
    source, out = scratch_path(spark, "silver"), scratch_path(spark, stage)
    lake.write_partitions(games(spark, folder), source)  # read whole, so no shuffle by month
    for _ in range(2):
        cli.run(spark, [stage, "--input", source, "--output", out, *[x for k, v in options.items() for x in (f"--{k}", v)]])
    rows = spark.read.parquet(out)
    return rows.select(*schemas.column_names(output))


@query("c04_players_job")
def _(spark, folder):
    return rounded(_job(spark, folder, "players", schemas.PLAYER_MONTHS))


@query("c05_openings_job")
def _(spark, folder):
    return rounded(_job(spark, folder, "openings", schemas.OPENINGS))


@query("c06_time_pressure_job")
def _(spark, folder):
    source = scratch_path(spark, "positions")
    evaluated(spark, folder).write.parquet(source)
    return rounded(_job(spark, folder, "time-pressure", schemas.TIME_PRESSURE, positions=source))


@query("u05_c10_cluster_job")
def _(spark, folder):
    """The clustering job, from the style table to written assignments."""
    source, out = scratch_path(spark, "silver"), scratch_path(spark, "clusters")
    lake.write_partitions(plain_games(spark, folder), source, "year", "month")
    cli.run(spark, ["cluster", "--input", source, "--output", out, "--clusters", "4"])
    found = spark.read.parquet(f"{out}/assignments")
    return found.agg(F.count("*").alias("players"), F.count_distinct("player").alias("distinct_players"), F.count_distinct("cluster").alias("clusters"))


@query("u05_corpus_job")
def _(spark, folder):
    source, out = scratch_path(spark, "silver"), scratch_path(spark, "corpus")
    openings_path, players_path = scratch_path(spark, "openings"), scratch_path(spark, "players")
    lake.write_partitions(games(spark, folder), source)
    cli.run(spark, ["openings", "--input", source, "--output", openings_path])
    cli.run(spark, ["players", "--input", source, "--output", players_path])
    cli.run(spark, ["corpus", "--openings", openings_path, "--players", players_path, "--output", out, "--min-opening-games", "8"])
    return spark.read.parquet(out)


@query("u05_coverage_job")
def _(spark, folder):
    source, out = scratch_path(spark, "silver"), scratch_path(spark, "coverage")
    lake.write_partitions(plain_games(spark, folder), source, "year", "month")
    cli.run(spark, ["coverage", "--input", source, "--output", out, "--start", "1994-11", "--end", "2002-02"])
    return spark.read.json(out)


@query("c07_evaluated_positions")
def _(spark, folder):
    rows = evaluated(spark, folder)
    return rows.groupBy("game_id").agg(
        F.count("*").alias("n"), F.sum("cp_loss").alias("loss"), F.count_if("is_blunder").alias("blunders"),
        F.sum("material_balance").alias("material"), F.max("square").alias("last_square"),
    )


@query("c09_model_tests")
def _(spark, folder):
    path = scratch_path(spark, "silver")
    lake.write_partitions(games(spark, folder), path, "year", "month")
    stored = spark.read.parquet(path)
    built = models.build(
        stored,
        players.player_months(stored),
        openings.opening_performance(stored),
        time_pressure.time_pressure(stored),
        evaluated(spark, folder),
    )
    return quality.model_tests(built)
