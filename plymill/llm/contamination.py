"""Benchmark decontamination by size-partitioned MinHash containment search.

An item is contained in a document when at least 75 % of its distinct shingles of five
words (lower-cased; a shorter item is one shingle of all its words) are in the document.
Items fall into size classes by powers of two.  For a class, documents are cut into
overlapping windows twice as wide as its largest item, so that the windows that can
hold an item have about its size and their sketches are comparable.  Sketches are
one-permutation MinHash of a bounded number of bins.  A document and an item are a candidate pair when at least a share of the
item's bins agree with some window, about half of what an item at the threshold has in expectation; most items that merely share
some shingles with a document fall through.  Only for candidates are the shingles of the whole document counted exactly.  The search can in principle miss an item
at the threshold by chance of the hashes; tests measure its recall and how many pairs it prunes.

Items are handled in blocks of a bounded number of shingles, each against all documents:
a block is the only thing sent to all tasks.  Documents never move.  Null, empty and
blank texts on either side match nothing; repeated items and repeated rows are reported for each; an empty table on
either side gives no rows.  Texts may have any length.  Other columns pass unchanged, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plymill.llm.blocks import runs
from plymill.llm.graphs import small_batches
from plymill.llm.words import Slice, mix, shingle_sets, slices, spans

WIDTH = 5
THRESHOLD = 75
BLOCK_SHINGLES = 1_000_000
PERMUTATIONS = 4
BINS = 512
KIND = "array<struct<item:int,n_shared:int>>"


@dataclass
class Items:
    """A block of items: sorted distinct ``tokens`` of one shingle width, and the items that hold each."""

    width: int
    size: np.ndarray
    tokens: np.ndarray
    offset: np.ndarray
    holder: np.ndarray
    by_item: tuple[np.ndarray, np.ndarray] | None = None

    def tokens_of(self, item: int) -> np.ndarray:
        """The places of an item's tokens."""
        if self.by_item is None:
            order = np.argsort(self.holder, kind="stable")
            token = np.repeat(np.arange(len(self.tokens)), np.diff(self.offset))[order]
            self.by_item = token, np.searchsorted(self.holder[order], np.arange(len(self.size) + 1))
        token, bounds = self.by_item
        return token[bounds[item] : bounds[item + 1]]

    @property
    def klass(self) -> np.ndarray:
        return np.floor(np.log2(np.maximum(self.size, 1))).astype(np.int64)


def index_items(rows: list[tuple[int, int, list[int]]]) -> list[Items]:
    """``(item number, shingle width, shingles)`` to one index per width."""
    out = []
    for width in sorted({r[1] for r in rows}):
        own = [r for r in rows if r[1] == width]
        token = np.concatenate([np.array(r[2], np.int64).view(np.uint64) for r in own])
        item = np.repeat(np.array([r[0] for r in own]), [len(r[2]) for r in own])
        order = np.lexsort((item, token))
        tokens, first = np.unique(token[order], return_index=True)
        size = np.zeros(max(r[0] for r in rows) + 1, np.int64)
        for number, _, found in own:
            size[number] = len(found)
        out.append(Items(width, size, tokens, np.append(first, len(token)), item[order]))
    return out


def _sketch(group: np.ndarray, values: np.ndarray, bins: int, salt: int) -> np.ndarray:
    """True for the members that are the least of their bin in their group."""
    spread = mix(values, salt)
    order = np.lexsort((spread, spread % np.uint64(bins), group))
    least = np.zeros(len(values), bool)
    new = runs(group[order], (spread % np.uint64(bins))[order])
    run = np.cumsum(new) - 1
    least[order] = spread[order] == spread[order][np.flatnonzero(new)][run]  # equal shingles are all least
    return least


def agreeing_share(threshold: int, bins: int, klass: int) -> float:
    """Half the share of an item's bins that agree, in expectation, with a window that holds ``threshold`` percent of it.

    A bin agrees if the item's least shingle there is in the window, and no other shingle of the
    window is less; ``load`` is how many others a bin holds on average, at most.
    """
    load = (4 << klass) / bins
    alone = (1 - np.exp(-load)) / load if load else 1.0
    return threshold / 100 * alone / 2


def _near(items: Items, doc: np.ndarray, place: np.ndarray, found: np.ndarray, hit: np.ndarray, threshold: int) -> np.ndarray:
    """Candidate (document, item) pairs, as document * items + item, in one slice.

    ``doc``, ``place`` and ``found`` describe all shingles, ``hit`` those that items hold.
    """
    pairs = []
    for klass in np.unique(items.klass[items.size > 0]).tolist():
        stride = 2 << klass
        bins = min(8 * stride, BINS)
        of_class = np.flatnonzero((items.size > 0) & (items.klass == klass))
        mine = np.zeros(len(items.size), bool)
        mine[of_class] = True
        entry = np.flatnonzero(mine[items.holder])
        token_of = np.repeat(np.arange(len(items.tokens)), np.diff(items.offset))[entry]
        touched = hit & np.isin(found, items.tokens[np.unique(token_of)])
        if not touched.any():
            continue
        block = doc * (1 << 40) + place // stride
        starts = np.unique(np.concatenate([block[touched], block[touched] - 1]))
        halves = []
        for shift in (0, 1):  # a window is a block and the next one
            start = block - shift
            at = np.searchsorted(starts, start)
            inside = np.flatnonzero((at < len(starts)) & (starts[np.minimum(at, len(starts) - 1)] == start))
            halves.append((inside, at[inside]))
        members, window = (np.concatenate(x) for x in zip(*halves, strict=True))
        held, wanted = [], np.zeros(len(items.size))
        for salt in range(1, PERMUTATIONS + 1):
            least = _sketch(window, found[members], bins, salt)
            signed = _sketch(items.holder[entry], items.tokens[token_of], bins, salt)
            wanted += np.bincount(items.holder[entry][signed], minlength=len(wanted))
            keep = least & touched[members]
            token = np.searchsorted(items.tokens, found[members[keep]])
            owner, token = np.divmod(np.unique(doc[members[keep]] * len(items.tokens) + token), len(items.tokens))
            by_token = np.argsort(token_of[signed], kind="stable")
            holders, tokens = items.holder[entry][signed][by_token], token_of[signed][by_token]
            a, b = np.searchsorted(tokens, token), np.searchsorted(tokens, token, "right")
            which = np.repeat(a, b - a) + np.arange((b - a).sum()) - np.repeat(np.cumsum(b - a) - (b - a), b - a)
            held.append(np.repeat(owner, b - a) * len(items.size) + holders[which])
        agreed, times = np.unique(np.concatenate(held), return_counts=True)
        item = agreed % len(items.size)
        pairs.append(agreed[times >= agreeing_share(threshold, bins, klass) * wanted[item]])
    return np.unique(np.concatenate(pairs)) if pairs else np.zeros(0, np.int64)


def _search(piece: Slice, items: Items, threshold: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Verified (document, item, shared shingles) of one slice: candidates first, exact counts for them alone."""
    words = piece.hashes()
    first, found = piece.windows(words, items.width)
    none = np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(items.tokens, found), len(items.tokens) - 1)
    hit = items.tokens[at] == found
    if not hit.any():
        return none, none, none
    doc = piece.owners()[first]
    near = _near(items, doc, first - piece.offset[doc], found, hit, threshold)
    if not len(near):
        return none, none, none
    owner, item = near // len(items.size), near % len(items.size)
    key = np.unique(doc[hit] * len(items.tokens) + at[hit])  # each shingle of a document once
    bounds = np.searchsorted(key, np.arange(len(piece.counts) + 1) * len(items.tokens))
    shared = np.array(
        [
            np.isin(items.tokens_of(i), key[bounds[d] : bounds[d + 1]] - d * len(items.tokens), assume_unique=True).sum()
            for d, i in zip(owner.tolist(), item.tolist(), strict=True)
        ]
    )
    good = shared * 100 >= threshold * items.size[item]
    return owner[good], item[good], shared[good]


def finder(index: list[Items], threshold: int):
    """A vectorised function from texts to the items that each one contains."""

    def contained(texts: pa.Array) -> pa.Array:
        base, docs, items, shared = 0, [], [], []
        for piece in slices(iter([pa.RecordBatch.from_arrays([texts], ["text"])]), lower=True):
            for one in index:
                d, i, n = _search(piece, one, threshold)
                docs.append(d + base)
                items.append(i)
                shared.append(n)
            base += len(piece.counts)
        doc = np.concatenate(docs or [np.zeros(0, np.int64)])
        order = np.argsort(doc, kind="stable")
        offset = np.searchsorted(doc[order], np.arange(len(texts) + 1)).astype(np.int32)
        columns = [np.concatenate(x or [np.zeros(0)])[order].astype(np.int32) for x in (items, shared)]
        rows = pa.StructArray.from_arrays([pa.array(c) for c in columns], ["item", "n_shared"])
        return pa.ListArray.from_arrays(pa.array(offset), rows)

    return F.arrow_udf(contained, KIND)


def item_shingles(benchmark: DataFrame, item_id: str = "item_id") -> DataFrame:
    """(item_id, width, shingles) of the items that have words."""

    def shingled(texts: pa.Array) -> pa.Array:
        widths, lists = [], []
        for piece in slices(iter([pa.RecordBatch.from_arrays([texts], ["text"])]), lower=True):
            found, offset = shingle_sets(piece, WIDTH)
            widths += np.minimum(piece.counts, WIDTH).tolist()
            lists += [found[a:b].view(np.int64) for a, b in zip(offset[:-1], offset[1:], strict=True)]
        columns = [pa.array(widths, pa.int32()), pa.array(lists, pa.list_(pa.int64()))]
        return pa.StructArray.from_arrays(columns, ["width", "shingles"])

    made = F.arrow_udf(shingled, "struct<width:int,shingles:array<bigint>>")(benchmark["text"].cast("binary"))
    return benchmark.select(benchmark[item_id].alias("item_id"), made.alias("s")).select("item_id", "s.*").where("width > 0")


def item_blocks(benchmark: DataFrame):
    """Blocks of items as ``(ids, rows for index_items)``, each of about BLOCK_SHINGLES shingles at most."""
    small_batches(benchmark.sparkSession)
    shingled = item_shingles(benchmark)
    total = shingled.agg(F.sum(F.size("shingles"))).first()[0] or 0
    n = -(-total // BLOCK_SHINGLES)
    for k in range(n):
        rows = shingled.where(F.pmod(F.xxhash64("item_id", "shingles"), F.lit(n)) == k).collect()
        yield [r[0] for r in rows], [(i, r[1], r[2]) for i, r in enumerate(rows)]


def contained_items(docs: DataFrame, benchmark: DataFrame, *, threshold: int = THRESHOLD) -> DataFrame:
    """(doc_id, item_id, n_shared, n_item) for every document and item that it contains."""
    spark = docs.sparkSession
    out = None
    id_type = benchmark.schema["item_id"].dataType.simpleString()
    for ids, rows in item_blocks(benchmark):
        found = docs.select("doc_id", F.explode(finder(index_items(rows), threshold)(F.col("text").cast("binary"))).alias("m"))
        names = spark.createDataFrame(
            [(i, ids[i], len(r[2])) for i, r in enumerate(rows)], f"item int, item_id {id_type}, n_item int"
        )
        part = found.select("doc_id", "m.*").join(F.broadcast(names), "item")  # one block of items
        out = part if out is None else out.unionByName(part)
    if out is None:
        out = docs.select("doc_id", F.lit(None).cast(id_type).alias("item_id"), F.lit(0).alias("n_shared"), F.lit(0).alias("n_item")).where("false")
    return out.select("doc_id", "item_id", "n_shared", "n_item")


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return contained_items(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that contain no item of the benchmark."""
    out = docs
    for _, rows in item_blocks(spark.read.parquet(f"{sf_dir}/benchmark.parquet")):
        found = finder(index_items(rows), THRESHOLD)(F.col("text").cast("binary"))
        out = out.where(F.coalesce(F.size(found), F.lit(0)) <= 0)
    return out
