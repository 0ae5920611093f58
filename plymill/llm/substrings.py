"""Substring dedup by de Bruijn compaction.

The words of 13-word windows that two texts hold are the edges of a de Bruijn graph, whose
nodes are 12-word sequences.  Where all occurrences of an edge go on to one and the same edge, and
that one is always reached from it, the two are one path: branches and the ends of
texts cut paths.  Each text is so a few stretches of compact paths, and every path
occurs whole wherever one of its edges does.  Joins on paths find the first document of each; the
coordinates kept with every stretch then tell which words of a document repeat.

A path is named by its first window, its length and a hash of all its windows, so stretches
are only joined when their words agree.  Copies of a whole text are one text; all but the
least ``doc_id`` lose every word if the text has a window.

Null, empty and short texts lose nothing.  Rows without ``doc_id`` have no order among
documents: they take no part and lose nothing.  Rows that repeat an id get the result of
their own text, and are never earlier than each other.  Other columns pass unchanged.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plymill.llm.blocks import bucket_count
from plymill.llm.graphs import small_batches, stored
from plymill.llm.repeats import ONE_AFTER, ONE_BEFORE, by_text, repeated_windows, text_digests, texts
from plymill.llm.words import slices, spans

WIDTH = 13
ANCHOR = 8
CUTS = "array<struct<sid:long,start:int,end:int>>"


def paths(windows: DataFrame) -> DataFrame:
    """(path, size, words, sid, start): every stretch of every text, one row per compact path."""

    def compacted(table: pa.Table) -> pa.Table:
        sid, pos, key, flags = by_text(table)
        joined = np.zeros(len(pos), bool)  # the window goes on from the one before
        joined[1:] = (sid[1:] == sid[:-1]) & (pos[1:] == pos[:-1] + 1)
        joined[1:] &= ((flags[:-1] & ONE_AFTER) > 0) & ((flags[1:] & ONE_BEFORE) > 0)
        start = np.flatnonzero(~joined)
        end = np.append(start[1:], len(pos))
        whole = spans(key.view(np.uint64), start, end).view(np.int64)
        columns = [key[start], (end - start).astype(np.int32), whole, sid[start], pos[start].astype(np.int32)]
        return pa.Table.from_arrays([pa.array(c) for c in columns], ["path", "size", "words", "sid", "start"])

    return windows.groupBy("bucket").applyInArrow(compacted, "path long, size int, words long, sid long, start int")


def covered(found: DataFrame, known: DataFrame, width: int) -> DataFrame:
    """(first_id, sid, cuts): the stretches of each text's least document that a smaller one holds."""
    placed = found.join(known.select("sid", "first_id"), "sid")
    least = placed.groupBy("path", "size", "words").agg(F.min("first_id").alias("least"))
    later = placed.join(least, ["path", "size", "words"]).where("least < first_id")
    end = F.col("start") + F.col("size") + (width - 1)
    return later.groupBy("first_id", "sid").agg(F.collect_list(F.struct("sid", "start", end.cast("int").alias("end"))).alias("cuts"))


def remove_repeats(docs: DataFrame, *, width: int = WIDTH, anchor: int = ANCHOR) -> DataFrame:
    """All columns of ``docs``, with ``substring_result``: struct(n_words, n_removed, kept), kept words joined by a space."""
    small_batches(docs.sparkSession)
    own = stored(texts(docs), "texts")
    words = own.agg(F.sum("n_words")).first()[0] or 0
    ided = docs.where("doc_id is not null")
    known = own.where("doc_id is not null").groupBy("sid").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("rows"))
    windows = repeated_windows(ided.select("doc_id", "text"), known, width=width, k=anchor, buckets=bucket_count(words))
    cuts = covered(paths(windows), known, width).select(F.col("first_id").alias("c_id"), "cuts")
    copies = (
        own.join(known.where("rows > 1"), "sid")
        .where((F.col("doc_id") > F.col("first_id")) & (F.col("n_words") >= width))
        .select(F.col("doc_id").alias("c_id"), F.array(F.struct("sid", F.lit(0).alias("start"), F.col("n_words").cast("int").alias("end"))).alias("cuts"))
    )
    lost = cuts.unionByName(copies).groupBy("c_id").agg(F.flatten(F.collect_list("cuts")).cast(CUTS).alias("cuts"))
    row = F.struct(*[docs[c] for c in docs.columns]).alias("row")
    # the texts are dealt by id as for the windows, so that one shuffle of them serves both
    joined = ided.join(lost, ided["doc_id"] == lost["c_id"], "left")
    joined = joined.select(F.struct(*[ided[c] for c in docs.columns]).alias("row"), lost["cuts"].alias("cuts"))
    free = docs.where("doc_id is null").select(row, F.lit(None).cast(CUTS).alias("cuts"))
    both = joined.union(free)
    result = F.arrow_udf(_kept, "struct<n_words:long,n_removed:long,kept:string>")(F.col("row")["text"].cast("binary"), F.col("cuts"))
    return both.select("row", result.alias("substring_result")).select("row.*", "substring_result")


def _kept(texts: pa.Array, cuts: pa.Array) -> pa.Array:
    """What is left of each text; cuts of another text under the same id are passed over."""
    n_words, n_removed, kept = [], [], []
    batch = pa.RecordBatch.from_arrays([texts, cuts], ["text", "cuts"])
    for piece in slices(iter([batch]), lower=False):
        sid = text_digests(piece, piece.hashes()).view(np.int64)
        data = piece.data.tobytes()
        lists = piece.rows.column("cuts")
        bounds = np.concatenate([[0], np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))]).astype(np.int64)
        flat = lists.flatten()
        c_sid, c_start, c_end = (flat.field(i).to_numpy(zero_copy_only=False) for i in range(3))
        for i, n in enumerate(piece.counts.tolist()):
            words = data[piece.bounds[i] : piece.bounds[i + 1]].split()
            mine = slice(bounds[i], bounds[i + 1])
            own = c_sid[mine] == sid[i]
            edges = np.zeros(n + 1, np.int64)
            np.add.at(edges, c_start[mine][own], 1)
            np.add.at(edges, c_end[mine][own], -1)
            gone = np.cumsum(edges)[:n] > 0
            n_words.append(n)
            n_removed.append(int(gone.sum()))
            kept.append(b" ".join(w for w, g in zip(words, gone.tolist(), strict=True) if not g))
    columns = [pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())]
    return pa.StructArray.from_arrays(columns, ["n_words", "n_removed", "kept"])


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = remove_repeats(docs)
    r = "substring_result"
    return found.select("doc_id", f"{r}.n_words", f"{r}.n_removed", F.sha2(F.col(f"{r}.kept"), 256).alias("kept_sha256"))
