"""Stored tables, bounded batches and connected components on Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plymill.llm.blocks import bucket_count
from plymill.session import scratch_path

FILE_ROWS = 100_000
LEAST_FILES = 16


def stored(frame: DataFrame, label: str, rows: int | None = None) -> DataFrame:
    """Write to the shared folder and read again, which cuts the lineage.

    ``rows`` is the most that the frame can have, where that is known.  It then has a file per FILE_ROWS rows, LEAST_FILES
    at least, however many partitions its last shuffle has, as a file costs more than thousands of narrow rows.
    """
    path = scratch_path(frame.sparkSession, label)
    if rows is not None:
        frame = frame.coalesce(max(LEAST_FILES, bucket_count(rows, FILE_ROWS)))
    frame.write.parquet(path)
    return frame.sparkSession.read.parquet(path)


def small_batches(spark: SparkSession) -> None:
    """Let batches for Python hold at most 2000 rows and 8 MB, so that workers stay small on long texts.

    Settings that the caller has changed stay as they are.
    """
    for key, default, most in (("maxRecordsPerBatch", "10000", "2000"), ("maxBytesPerBatch", "67108864b", "8m")):
        name = f"spark.sql.execution.arrow.{key}"
        if spark.conf.get(name, default) == default:
            spark.conf.set(name, most)


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for all nodes of ``edges(a, b)``; the root is the least node of the component.

    Each round joins every node's label to its neighbours, keeps the least, and then
    follows labels once (pointer jumping), so rounds grow with the logarithm of a
    component's width.  Hot nodes are joined by key, which adaptive execution splits, and
    the minimum is combined map-side.
    """
    both = edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct()
    both = stored(both, "edges", 2 * edges.count())
    size = both.count()  # a node has an edge at least
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("root")), "labels", size)
    while True:
        seen = both.join(labels, both["b"] == labels["node"]).groupBy(F.col("a").alias("n")).agg(F.min("root").alias("near"))
        lower = labels.join(seen, labels["node"] == seen["n"]).select("node", F.least("root", "near").alias("next"), "root")
        above = labels.select(F.col("node").alias("up"), F.col("root").alias("top"))
        jumped = lower.join(above, F.col("next") == F.col("up"), "left").select(
            "node", F.least("next", F.coalesce("top", "next")).alias("root"), F.col("root").alias("old")
        )
        kept = stored(jumped, "labels", size)
        labels = kept.select("node", "root")
        if kept.where("root <> old").isEmpty():
            return labels
