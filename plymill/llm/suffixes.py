"""Long passages that documents share, from minimisers and windows.

The dealt method, sparse suffix arrays, is kept in part: only suffixes at minimiser positions are retained, about one
word in eighteen, and compared with the others that begin alike.  But they are not sorted by their words and
matches are not extended word by word from a pair of neighbours: suffixes meet by a hash of their first 16 words, and
in place of the extension all windows of 50 words around a matched suffix are hashed and meet by equal hash.
A neighbour in suffix order knows its longest match only, while the result needs every window that any other
document holds; so all members of a run of equal prefixes would have to be compared, which the windows do
without pairs.  Every shared passage of 50 words or more holds a shared minimiser, so none is lost.

Copies of a whole text are one text, and a passage over its full length in each of them.
Null, empty and short texts, and rows without ``doc_id``, have no passages.  Rows that
repeat an id are one document unless their texts differ, and then each has its own.  An empty table
gives no passages.  Texts may have any length.  Only ``doc_id`` and ``text`` are read, so other columns cannot clash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plymill.llm.blocks import bucket_count
from plymill.llm.graphs import small_batches, stored
from plymill.llm.repeats import FIRST, by_text, repeated_windows, texts

WIDTH = 50
ANCHOR = 16


def shared_passages(docs: DataFrame, *, width: int = WIDTH, anchor: int = ANCHOR) -> DataFrame:
    """(doc_id, start_word, end_word, n_words, is_first): maximal stretches whose every window another document holds.

    ``is_first`` is true where no document with a smaller id holds any of the windows.
    """
    small_batches(docs.sparkSession)
    own = stored(texts(docs.where("doc_id is not null")).distinct(), "texts")
    total = own.agg(F.sum("n_words")).first()[0] or 0
    known = own.groupBy("sid").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("docs"), F.first("n_words").alias("size"))
    windows = repeated_windows(
        docs.where("doc_id is not null").select("doc_id", "text"), known, width=width, k=anchor, buckets=bucket_count(total)
    )

    def stretches(table: pa.Table) -> pa.Table:
        sid, pos, _, flags = by_text(table)
        new = np.ones(len(pos), bool)
        new[1:] = (sid[1:] != sid[:-1]) | (pos[1:] != pos[:-1] + 1)
        start = np.flatnonzero(new)
        last = np.append(start[1:], len(pos)) - 1
        later = np.add.reduceat((flags & FIRST) == 0, start) > 0 if len(start) else np.zeros(0, bool)
        columns = [sid[start], pos[start], pos[last] + width, ~later]
        return pa.Table.from_arrays([pa.array(c) for c in columns], ["sid", "start_word", "end_word", "lead"])

    found = windows.groupBy("bucket").applyInArrow(stretches, "sid long, start_word long, end_word long, lead boolean")
    alone = found.join(known.where("docs = 1"), "sid").select(
        F.col("first_id").alias("doc_id"), "start_word", "end_word", F.col("lead").alias("is_first")
    )
    earlier = found.where("not lead").select("sid").distinct().withColumn("earlier", F.lit(True))
    groups = known.where((F.col("docs") > 1) & (F.col("size") >= width)).join(earlier, "sid", "left")
    copies = own.select("doc_id", "sid").join(groups, "sid").select(
        "doc_id",
        F.lit(0).cast("long").alias("start_word"),
        F.col("size").alias("end_word"),
        ((F.col("doc_id") == F.col("first_id")) & F.col("earlier").isNull()).alias("is_first"),
    )
    both = alone.unionByName(copies)
    return both.select("doc_id", "start_word", "end_word", (F.col("end_word") - F.col("start_word")).alias("n_words"), "is_first")


def op3_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return shared_passages(docs)
