"""Line dedup: lines found in many documents go from all of them.

Native: DataFrame functions only.  Null and empty texts are one empty line, which has
an empty key and therefore stays.  Rows with the same or no ``doc_id`` are separate
documents for the text, but one document for the count of a line (no id: one id).
Other columns pass unchanged.  An empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plymill.session import scratch_path

WHITE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_keys(lines: Column) -> Column:
    """64-bit hashes of the normalised lines; 0 stands for a key without a code point."""

    def key(line: Column) -> Column:
        bare = F.translate(F.btrim(line, F.lit(WHITE)), UPPER, LOWER)
        return F.when(bare == "", F.lit(0).cast("long")).otherwise(F.xxhash64(bare))

    return F.transform(lines, key)


def _lines(docs: DataFrame) -> Column:
    return F.split(F.coalesce(docs["text"], F.lit("")), "\n")


def shared_keys(occurrences: DataFrame, min_docs: int) -> DataFrame:
    """Keys of ``occurrences(doc_id, key)`` found in at least ``min_docs`` documents.

    Repeats within a document vanish first, so a hot key is one row per document and
    is then counted map-side.
    """
    distinct = occurrences.where("key <> 0").select("doc_id", "key").distinct()
    return distinct.groupBy("key").agg(F.count("*").alias("docs")).where(F.col("docs") >= min_docs).select("key")


def drop_common_lines(docs: DataFrame, *, min_docs: int = 10) -> DataFrame:
    """All columns of ``docs``, with ``line_result``: struct(n_lines, n_dropped, kept).

    Positions of lines are exploded with their hashes only; the texts move once, to meet
    the positions they lose.  The row of a text is told by its id and its key sequence,
    so equal ids with other texts do not mix.
    """
    spark = docs.sparkSession
    keyed = docs.select("doc_id", line_keys(_lines(docs)).alias("keys"))
    keyed = keyed.select("doc_id", F.xxhash64("keys").alias("row_key"), "keys")
    path = scratch_path(spark, "lines")
    keyed.select("doc_id", "row_key", F.posexplode("keys").alias("pos", "key")).write.parquet(path)
    stored = spark.read.parquet(path)
    lost = (
        stored.where("key <> 0")
        .join(shared_keys(stored, min_docs), "key", "left_semi")
        .groupBy("doc_id", "row_key")
        .agg(F.collect_set("pos").alias("lost"))
    )
    lines = _lines(docs)
    rows = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"),
        docs["doc_id"].alias("left_id"),
        F.xxhash64(line_keys(lines)).alias("left_key"),
        lines.alias("lines"),
    )
    joined = rows.join(
        lost, rows["left_id"].eqNullSafe(lost["doc_id"]) & (rows["left_key"] == lost["row_key"]), "left"
    )
    none = F.array().cast("array<int>")
    positions = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.coalesce("lost", none))
    kept = F.when(F.col("lost").isNull(), F.array_join("lines", "\n")).otherwise(
        F.array_join(F.transform(positions, lambda p: F.get(F.col("lines"), p)), "\n")
    )
    result = F.struct(
        F.size("lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("lost"), F.lit(0)).cast("long").alias("n_dropped"),
        kept.alias("kept"),
    )
    return joined.select("row", result.alias("line_result")).select("row.*", "line_result")


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = drop_common_lines(docs)
    return found.select(
        "doc_id",
        "line_result.n_lines",
        "line_result.n_dropped",
        F.sha2(F.col("line_result.kept"), 256).alias("kept_sha256"),
    )


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without their common lines; a document that loses all lines keeps an empty text."""
    found = drop_common_lines(docs)
    kept = F.when(F.col("text").isNotNull(), F.col("line_result.kept"))
    return found.select(*[kept.alias(c) if c == "text" else found[c] for c in docs.columns])
