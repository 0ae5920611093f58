"""Silver: typed, enriched games; rows without required values are set aside with the reason."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from plymill import schemas
from plymill.functions import moves as M
from plymill.functions import scalars as S
from plymill.operators.keyed import any_of
from plymill.sources import lake

REQUIRED = ["game_id", "white", "black", "result", "year", "month"]

# Accepted header spellings of the opening reference.
CODE_NAMES = ["eco", "ECO", "eco_code", "code"]
TITLE_NAMES = ["name", "Name", "opening", "Opening"]


def first_existing(df: DataFrame, names: list[str]) -> Column:
    """First non-null value among the named columns the frame has; null when it has none."""
    present = [F.col(f"`{name}`") for name in names if name in df.columns]
    return F.coalesce(*present) if present else F.lit(None).cast("string")


def opening_dimension(reference: DataFrame) -> DataFrame:
    """One row per opening code (smallest name on repeats), split into family and variation."""
    named = reference.select(
        first_existing(reference, CODE_NAMES).alias("ref_code"),
        first_existing(reference, TITLE_NAMES).alias("ref_name"),
    )
    unique = named.filter(F.col("ref_code").isNotNull()).groupBy("ref_code").agg(F.min("ref_name").alias("ref_name"))
    return unique.select(
        "ref_code",
        "ref_name",
        S.opening_family(F.col("ref_name")).alias("ref_family"),
        S.opening_variation(F.col("ref_name")).alias("ref_variation"),
    )


def enrich_openings(games: DataFrame, reference: DataFrame) -> DataFrame:
    """Left join on the opening code; reference names win over the game's own."""
    # adaptive execution broadcasts the codes if their bytes allow it, and splits hot ones otherwise
    joined = games.join(opening_dimension(reference), F.col("eco_code") == F.col("ref_code"), "left")
    return joined.withColumns(
        {
            "opening_family": F.coalesce("ref_family", "opening_family"),
            "opening_variation": F.coalesce("ref_variation", "opening_variation"),
        }
    ).select(*games.columns)


def typed_games(bronze: DataFrame) -> DataFrame:
    """All silver columns by expression; no row is dropped here."""
    parsed = M.with_moves(bronze).withColumns(
        {
            "white_elo": S.parse_rating(F.col("white_elo")),
            "black_elo": S.parse_rating(F.col("black_elo")),
            "tc": S.parse_time_control(F.col("time_control")),
            "clock_seconds": S.parse_clocks(F.col("clock_annotations")),
            "game_date": S.parse_game_date(F.col("utc_date")),
        }
    )
    return parsed.select(
        "game_id",
        "white",
        "black",
        "white_elo",
        "black_elo",
        S.normalise_result(F.col("result")).alias("result"),
        S.normalise_termination(F.col("termination")).alias("termination"),
        S.result_reason(F.col("termination")).alias("result_reason"),
        F.col("eco").alias("eco_code"),
        F.col("opening").alias("opening_variation"),
        S.opening_family(F.col("opening")).alias("opening_family"),
        "tc.time_control_type",
        F.col("tc.base_seconds").alias("base_time_seconds"),
        "tc.increment_seconds",
        "game_date",
        F.size("moves_san").alias("game_length"),
        (F.size("clock_seconds") > 0).alias("has_clock_data"),
        "clock_seconds",
        "features.has_capture",
        "features.capture_count",
        "features.white_castled",
        "features.black_castled",
        "features.legal_prefix_length",
        S.has_bot(F.col("white"), F.col("black")).alias("has_bot_player"),
        "moves_san",
        "batch_id",
        F.year("game_date").alias("year"),
        F.month("game_date").alias("month"),
        S.rating_bucket(F.col("white_elo"), F.col("black_elo")).alias("elo_bucket"),
        F.col("moves").isNotNull().alias("had_moves"),
    )


def by_month(bronze: DataFrame) -> DataFrame:
    """Bronze rows gathered by the month that silver is written under: they are much narrower than the silver rows made of them."""
    dated = bronze.withColumn("_month", F.trunc(S.parse_game_date(F.col("utc_date")), "month"))
    return lake.gathered(dated, "_month").drop("_month")


def missing_required() -> Column:
    """Names of the required columns that are null, as an array."""
    return F.array_compact(F.array(*[F.when(F.col(name).isNull(), name) for name in REQUIRED]))


def is_rejected() -> Column:
    return any_of(*[F.col(name).isNull() for name in REQUIRED])


def candidates(
    bronze: DataFrame,
    reference: DataFrame | None = None,
    *,
    exclude_bots: bool = False,
    exclude_unrated: bool = False,
    drop_corrupt: bool = False,
) -> DataFrame:
    """Silver columns of all rows that pass the optional filters, accepted or not."""
    games = typed_games(bronze)
    if exclude_bots:
        games = games.filter(~F.col("has_bot_player"))
    if exclude_unrated:
        games = games.filter(F.col("white_elo").isNotNull() & F.col("black_elo").isNotNull())
    if drop_corrupt:
        games = games.filter(~F.col("had_moves") | (F.col("game_length") > 0))
    games = games.drop("had_moves")
    return enrich_openings(games, reference) if reference is not None else games


def silver_games(bronze: DataFrame, reference: DataFrame | None = None, **filters: bool) -> DataFrame:
    return candidates(bronze, reference, **filters).filter(~is_rejected())


def quarantined(bronze: DataFrame, reference: DataFrame | None = None, **filters: bool) -> DataFrame:
    rows = candidates(bronze, reference, **filters).filter(is_rejected())
    return rows.withColumns(
        {"reject_reason": F.lit("null_required_column"), "missing_columns": missing_required()}
    )


def store(bronze: DataFrame, path: str, reference: DataFrame | None = None, **filters: bool) -> None:
    """Write the silver games of bronze rows by year and month."""
    lake.write_partitions(silver_games(by_month(bronze), reference, **filters), path, "year", "month", gather=False)


def run(
    spark: SparkSession,
    input_path: str,
    output_path: str,
    *,
    reference_path: str | None = None,
    quarantine_output: str | None = None,
    metrics_output: str | None = None,
    **filters: bool,
) -> dict[str, int]:
    """Write silver and, when asked for, the rejects and a record of both counts; returns the counts.

    The counts come from the write itself.  The rejects are a second, cheap
    plan: their filter sits below the text parsing, so only rejected rows are
    parsed, and it does not run when the first pass saw none.
    """
    bronze = spark.read.parquet(input_path)
    reference = lake.read_opening_csv(spark, reference_path) if reference_path else None
    seen = Observation()
    flagged = candidates(by_month(bronze), reference, **filters).observe(
        seen,
        F.count_if(is_rejected()).alias("quarantine_count"),
        F.count_if(~is_rejected()).alias("silver_count"),
    )
    accepted = flagged.filter(~is_rejected()).select(*schemas.column_names(schemas.SILVER_GAMES))
    lake.write_partitions(accepted, output_path, "year", "month", gather=False)
    counts = dict(seen.get)
    if quarantine_output and counts["quarantine_count"]:
        lake.write_partitions(quarantined(bronze, reference, **filters), quarantine_output)
    if metrics_output:
        row = spark.createDataFrame([tuple(counts.values())], ", ".join(f"{name} bigint" for name in counts))
        lake.append_metrics(row, metrics_output)
    return counts
