"""Readers, writers and views of the lake."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plymill import schemas


def read_game_blocks(spark: SparkSession, path: str, partitions: int | None = None) -> DataFrame:
    """Game texts as one row each (column ``block``) from plain or compressed files.

    The record delimiter makes the reader split plain files of any size among
    tasks.  A compressed file is one task, so give ``partitions`` to spread the
    parsing work that follows it.
    """
    head = "[Event "
    lines = spark.read.option("lineSep", "\n" + head).text(path)
    if partitions:
        lines = lines.repartition(partitions)
    text = F.regexp_replace(F.col("value"), r"^\s+|\s+$", "")
    block = F.when(F.startswith(text, F.lit(head)), text).otherwise(F.concat(F.lit(head), text))
    return lines.filter(F.length(text) > 0).select(block.alias("block"))


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Deal a narrow scan by the keys of the join that follows, which then needs no shuffle of its own.

    A single file of one row group would otherwise be one task; adaptive execution sizes the partitions.
    """
    return df.repartition(*keys)


def fingerprint(df: DataFrame) -> str:
    """A digest of the files a scan reads: their paths, sizes and times of change."""
    files = df.select("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time").distinct()
    digest = F.md5(F.array_join(F.array_sort(F.collect_list(F.md5(F.concat_ws("|", *files.columns)))), ""))
    return files.agg(digest.alias("digest")).first()["digest"]


def write_landing(raw: DataFrame, path: str, *, rows_per_file: int = 100_000) -> None:
    raw.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).option(
        "compression", "snappy"
    ).parquet(path)


def read_landing(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.RAW_GAMES).parquet(path)


def gathered(df: DataFrame, *keys: str) -> DataFrame:
    """Rows gathered by partition key, with the hot partitions split by the adaptive rebalance."""
    return df.hint("rebalance", *[F.col(key) for key in keys])


def write_partitions(df: DataFrame, path: str, *keys: str, gather: bool = True) -> None:
    """Replace exactly the partitions present in ``df``; other partitions stay.

    Rows are first gathered by partition key, so that the number of files does not explode; rows
    that were gathered when they were narrower need no second time.
    """
    if not keys:
        df.write.mode("overwrite").parquet(path)
        return
    rows = gathered(df, *keys) if gather else df
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)


def in_month(month: str) -> Column:
    """Predicate on the partition columns year and month for one ``yyyy-MM``."""
    first = datetime.strptime(month, "%Y-%m")
    return (F.col("year") == first.year) & (F.col("month") == first.month)


def read_month(spark: SparkSession, path: str, month: str) -> DataFrame:
    """One ``yyyy-MM`` of a table partitioned by year and month (pruned, not path-joined)."""
    return spark.read.parquet(path).filter(in_month(month))


def read_opening_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).csv(path)


def empty(spark: SparkSession, ddl: str) -> DataFrame:
    return spark.createDataFrame([], ddl)


def _scan(spark: SparkSession, path: str, ddl: str) -> DataFrame | None:
    """The table at ``path`` in the columns of its contract, None when the path does not exist; other failures are raised."""
    try:
        return spark.read.schema(ddl).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    except Py4JJavaError as error:
        if "FileNotFoundException" in str(error):
            return None
        raise


def read_or_empty(spark: SparkSession, path: str | None, ddl: str) -> DataFrame:
    """The table at ``path`` in the columns of its contract, or a typed empty frame when there is none.

    The contract is the schema: no footer is read for it, and files of any age fit, as columns
    that a file lacks are null.
    """
    found = _scan(spark, path, ddl) if path else None
    return empty(spark, ddl) if found is None else found


def with_defaults(df: DataFrame, defaults: Mapping[str, Column]) -> DataFrame:
    """Append the default columns the frame does not have yet."""
    return df.withColumns({name: value for name, value in defaults.items() if name not in df.columns})


def append_metrics(metrics: DataFrame, path: str) -> None:
    """Append one diagnostics record; the folder of records is the history."""
    metrics.write.mode("append").json(path)


def read_metrics(spark: SparkSession, path: str, ddl: str | None = None) -> DataFrame:
    """Diagnostics records with the file each came from; unreadable records are kept and flagged."""
    reader = spark.read.option("recursiveFileLookup", True)
    if ddl:
        reader = reader.schema(ddl + ", _corrupt_record string")
    return reader.json(path).withColumn("path", F.input_file_name())


def export_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


# View name -> folder below the lake root, contract, and values for what older files lack.
LAKE_VIEWS = {
    "silver_games": ("silver/games", schemas.SILVER_GAMES, {}),
    "gold_player_monthly_stats": ("gold/player_monthly_stats", schemas.PLAYER_MONTHS, {}),
    "gold_opening_performance": ("gold/opening_performance", schemas.OPENINGS, {}),
    "gold_time_pressure_analysis": (
        "gold/time_pressure_analysis",
        schemas.TIME_PRESSURE,
        {"evaluated_positions": "cast(0 as bigint)", "blunder_count": "cast(0 as bigint)"},
    ),
    "gold_blunder_positions": ("gold/blunder_positions", schemas.POSITIONS, {}),
}
ANALYTICS_VIEWS = {
    "analytics_opening_stats": ("gold_opening_performance", schemas.OPENINGS),
    "analytics_player_profiles": ("gold_player_monthly_stats", schemas.PLAYER_MONTHS),
    "analytics_time_pressure": ("gold_time_pressure_analysis", schemas.TIME_PRESSURE),
    "analytics_blunder_positions": ("gold_blunder_positions", schemas.POSITIONS),
}


def present(df: DataFrame, ddl: str) -> DataFrame:
    """The columns of a contract in contract order; missing ones raise."""
    return df.select(*schemas.column_names(ddl))


def register_views(spark: SparkSession, root: str) -> list[str]:
    """Temporary views over the lake tables and their presentation twins; starts no job.

    Absent tables become typed empty views.  Returns the names of the tables that exist.
    """
    found = []
    for name, (folder, ddl, defaults) in LAKE_VIEWS.items():
        df = _scan(spark, f"{root.rstrip('/')}/{folder}", ddl)
        if df is not None:
            found.append(name)
        df = empty(spark, ddl) if df is None else df
        filled = {key: F.coalesce(F.col(key), F.expr(rule)) for key, rule in defaults.items()}
        df.withColumns(filled).createOrReplaceTempView(name)
    for name, (base, ddl) in ANALYTICS_VIEWS.items():
        present(spark.table(base), ddl).createOrReplaceTempView(name)
    return found


def month_coverage(lake: DataFrame, start: str, end: str) -> DataFrame:
    """Every month from ``start`` to ``end`` (``yyyy-MM``) with its row count and status.

    ``lake`` needs ``year`` and ``month``; months without rows are ``missing``.
    """
    spark = lake.sparkSession
    first, last = F.to_date(F.lit(start), "yyyy-MM"), F.to_date(F.lit(end), "yyyy-MM")
    months = spark.range(1).select(F.explode(F.sequence(first, last, F.expr("interval 1 month"))).alias("day"))
    counted = lake.groupBy("year", "month").agg(F.count("*").alias("rows"))
    wanted = months.select(
        F.date_format("day", "yyyy-MM").alias("period"), F.year("day").alias("year"), F.month("day").alias("month")
    )
    return wanted.join(counted, ["year", "month"], "left").select(
        "period",
        F.coalesce("rows", F.lit(0)).cast("bigint").alias("rows"),
        F.when(F.col("rows") > 0, "success").otherwise("missing").alias("status"),
    )
