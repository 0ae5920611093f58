"""Bronze: rows with an id, one per id, rejects kept apart."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from plymill.functions.text import parse_blocks
from plymill.operators.keyed import dedupe
from plymill.sources import lake


def bronze_games(raw: DataFrame, count_as: str | None = None) -> DataFrame:
    return dedupe(raw.filter(F.col("game_id").isNotNull()), "game_id", count_as)


def rejected(raw: DataFrame) -> DataFrame:
    return raw.filter(F.col("game_id").isNull()).withColumn("reject_reason", F.lit("null_game_id"))


def missing(column: str) -> F.Column:
    """Text columns count as missing when null or empty."""
    return F.coalesce(F.col(column), F.lit("")) == ""


GAPS = ["missing_game_id", "missing_players", "missing_result", "missing_moves", "parse_errors"]


def parser_counters(judged: bool) -> list[F.Column]:
    """The counters of a parser run as aggregates; rejected texts count as parse errors and nowhere else."""
    fine = F.col("reject_reason").isNull() if judged else F.lit(True)
    return [
        F.count("*").alias("games_seen"),
        F.count_if(fine).alias("rows_written"),
        F.count_if(fine & missing("game_id")).alias("missing_game_id"),
        F.count_if(fine & (missing("white") | missing("black"))).alias("missing_players"),
        F.count_if(fine & missing("result")).alias("missing_result"),
        F.count_if(fine & missing("moves")).alias("missing_moves"),
        F.count_if(~fine).alias("parse_errors"),
    ]


def parser_metrics(raw: DataFrame) -> DataFrame:
    """Counters of one parser run; a row with several gaps is counted once per gap.

    ``raw`` may have a ``reject_reason``, as parsed texts that were judged do.
    """
    counts = raw.agg(*parser_counters("reject_reason" in raw.columns))
    total = sum((F.col(name) for name in GAPS[1:]), F.col(GAPS[0]))
    return counts.withColumn("suspicious_rows", total)


def parse(
    spark: SparkSession,
    blocks: DataFrame,
    output_path: str,
    *,
    batch_id: str,
    source: str = "batch",
    rows_per_file: int = 100_000,
    metrics_output: str | None = None,
    quarantine_output: str | None = None,
) -> dict[str, int]:
    """Write the landing files of game texts; malformed texts go to the rejects with their reason.

    The counters come from the write itself.  The rejects are a second plan, which runs
    only when the first pass saw some.
    """
    judged = parse_blocks(blocks, batch_id=batch_id, source=source, judged=True)
    seen = Observation()
    counted = judged.observe(seen, *parser_counters(True)).filter(F.col("reject_reason").isNull())
    lake.write_landing(counted.drop("block", "reject_reason"), output_path, rows_per_file=rows_per_file)
    counts = dict(seen.get)
    counts["suspicious_rows"] = sum(counts[name] for name in GAPS)
    if quarantine_output and counts["parse_errors"]:
        rejects = judged.filter(F.col("reject_reason").isNotNull())
        lake.write_partitions(rejects.select("block", "reject_reason", "batch_id", "source"), quarantine_output)
    if metrics_output:
        row = spark.createDataFrame([tuple(counts.values())], ", ".join(f"{name} bigint" for name in counts))
        lake.append_metrics(row, metrics_output)
    return counts


def id_metrics(raw: DataFrame) -> DataFrame:
    """Volume and duplicate diagnostics of the dedupe, from one count per id."""
    per_id = raw.groupBy("game_id").agg(F.count("*").alias("copies"))
    known, repeated = F.col("game_id").isNotNull(), F.col("game_id").isNotNull() & (F.col("copies") > 1)

    def total(value) -> F.Column:
        return F.coalesce(F.sum(value), F.lit(0)).cast("bigint")

    return per_id.agg(
        total(F.col("copies")).alias("input_count"),
        total(F.when(~known, F.col("copies"))).alias("missing_game_id"),
        F.count_if(repeated).alias("duplicate_game_ids"),
        total(F.when(repeated, F.col("copies") - 1)).alias("duplicate_rows_removed"),
        F.count_if(known).alias("output_count"),
    ).withColumns(
        {
            "rows_removed": F.col("input_count") - F.col("output_count"),
            "quarantine_count": F.col("missing_game_id"),
        }
    )


def partition_counts(bronze: DataFrame) -> DataFrame:
    return bronze.groupBy("batch_id", "source").agg(F.count("*").alias("rows"))


def run(
    spark: SparkSession,
    input_path: str,
    output_path: str,
    *,
    metrics_output: str | None = None,
    quarantine_output: str | None = None,
) -> DataFrame:
    """Read the landing files, write bronze, optionally rejects and diagnostics."""
    raw = lake.read_landing(spark, input_path)
    lake.write_partitions(bronze_games(raw), output_path, "batch_id", "source")
    written = spark.read.parquet(output_path)
    metrics = id_metrics(raw).withColumn("quarantine_path", F.lit(quarantine_output))
    if quarantine_output:
        lake.write_partitions(rejected(raw), quarantine_output)
    if metrics_output:
        parts = partition_counts(written).agg(
            F.array_sort(F.collect_list(F.struct("batch_id", "source", "rows"))).alias("partitions")
        )
        lake.append_metrics(metrics.select("*", parts.scalar().alias("partitions")), metrics_output)
    return metrics
