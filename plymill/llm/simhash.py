"""SimHash near-dedup: fingerprints, pigeonhole blocks, Hamming verification, components.

A fingerprint has one bit for each bit of the shingles' XXH64 hashes: 1 if the bit is set in over
half of them.  Shingles are three words joined by one space, repeats included; a shorter text
is one shingle, and a text without words has fingerprint zero.

Fingerprints are cut into BLOCKS blocks of bits.  Two that differ in at most ``distance`` bits
agree in at least ``BLOCKS - distance`` blocks, so each fingerprint is joined by every choice of so many
blocks, and the pairs found are verified.  More blocks make longer keys and fewer
chance candidates; every choice of BLOCKS gives the same links.

A key that more than SMALL fingerprints share (near copies of one text) never becomes pairs.  Its
members are dealt again by *centres*: the values within one changed bit outside the key's
blocks, which two members differing in two such bits share.  Members that share a centre are all within
two bits of each other, so each is linked with the least of them: the links grow with
the members, not with their square, and none between components is lost.

Equal fingerprints are one node.  Null texts are texts without words.  Rows without ``doc_id`` take part; the component's
id is its least ``doc_id`` (null if all lack one).  Repeated rows are equal nodes.  An empty table gives an
empty table.  Texts are hashed whole, a slice of about a megabyte of texts at a time.
Only ``doc_id`` and ``text`` are read, so other columns cannot clash.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plymill.llm.graphs import components, small_batches, stored
from plymill.llm.words import Slice, slices

WIDTH = 3
SEED = 42
DISTANCE = 2
BLOCKS = 5
SMALL = 64
#: A fingerprint of more than one row in so many is joined by broadcast; there are fewer than SHARE of them.
SHARE = 1000


def shingle_hashes(piece: Slice, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 of all shingles of a slice, and the offsets of its documents.

    White space between words becomes one space, so every shingle is a range of the slice's bytes.
    """
    inside = np.zeros(len(piece.data) + 1, np.int8)
    inside[piece.start] += 1  # starts are distinct, and so are ends
    inside[piece.end] -= 1
    white = np.cumsum(inside) == 0
    keep = ~white
    keep[piece.end] |= white[piece.end]
    place = np.concatenate([[0], np.cumsum(keep)])
    joined = np.where(white, np.uint8(32), np.append(piece.data, np.uint8(32)))
    # a document may begin right where the last one ends: its words then follow without a space, which no shingle spans
    buffer = joined[keep].tobytes()
    start, end = place[piece.start], place[piece.end]
    counts = piece.counts
    sizes = np.where(counts >= width, counts - width + 1, counts > 0)
    offset = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    owner = np.repeat(np.arange(len(counts)), sizes)
    first = piece.offset[owner] + np.arange(offset[-1]) - offset[owner]
    last = first + np.minimum(counts[owner], width) - 1
    digest = xxhash.xxh64_intdigest
    found = (digest(buffer[a:b], SEED) for a, b in zip(start[first].tolist(), end[last].tolist(), strict=True))
    return np.fromiter(found, np.uint64, len(first)), offset


def majority_bits(hashes: np.ndarray, offset: np.ndarray) -> np.ndarray:
    """One 64-bit fingerprint for each run of hashes; 0 for an empty run."""
    out = np.zeros(len(offset) - 1, np.uint64)
    sizes = np.diff(offset)
    full = np.flatnonzero(sizes)
    if not len(full):
        return out
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    ones = np.add.reduceat(bits, offset[:-1][full], axis=0, dtype=np.int64)
    packed = np.packbits(2 * ones > sizes[full, None], axis=1, bitorder="little")
    out[full] = np.ascontiguousarray(packed).view(np.uint64).ravel()
    return out


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp): the fingerprint of every row as a signed 64-bit number."""

    def made(batches):
        for piece in slices(batches, lower=True):
            fp = majority_bits(*shingle_hashes(piece)).view(np.int64)
            yield pa.RecordBatch.from_arrays([piece.rows.column("doc_id"), pa.array(fp)], ["doc_id", "fp"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    return texts.mapInArrow(made, f"doc_id {kind}, fp long")


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def key_masks(blocks: int = BLOCKS, distance: int = DISTANCE) -> list[int]:
    """The bits of every choice of ``blocks - distance`` blocks."""
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    own = [(1 << b) - (1 << a) for a, b in zip(cuts, cuts[1:], strict=False)]
    return [sum(chosen) for chosen in combinations(own, blocks - distance)]


def _choose(which: Column, values: list) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), which)


def links(nodes: DataFrame, *, blocks: int = BLOCKS, small: int = SMALL) -> DataFrame:
    """(a, b): links within two bits that connect ``nodes(fp)``, which are distinct.

    Every pair in a small key, and a star around each centre of a large one.
    """
    masks = key_masks(blocks)
    keys = F.array(*[F.struct(F.lit(i).alias("which"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("part")) for i, m in enumerate(masks)])
    dealt = stored(nodes.select("fp", F.explode(keys).alias("key")).select("fp", "key.*"), "blocks")
    sizes = dealt.groupBy("which", "part").agg(F.count("*").alias("members")).where("members > 1")
    sizes = stored(sizes, "block-sizes")
    few = dealt.join(sizes.where(F.col("members") <= small), ["which", "part"]).select("which", "part", "fp")
    groups = few.groupBy("which", "part").agg(F.collect_list("fp").alias("own"))  # at most ``small`` of them
    pairs = groups.select(F.explode("own").alias("a"), "own").select("a", F.explode("own").alias("b"))
    near = pairs.where((F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= DISTANCE))

    many = dealt.join(sizes.where(F.col("members") > small), ["which", "part"]).select("which", "fp")
    free = [[_signed(1 << b) for b in range(64) if not m >> b & 1] + [0] for m in masks]
    flips = _choose(F.col("which"), [F.array(*[F.lit(v).cast("long") for v in own]) for own in free])
    centres = many.select("fp", F.explode(flips).alias("flip")).select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("centre"))
    # only 65 values lie within one bit of a centre, so a group is no larger
    stars = centres.groupBy("centre").agg(F.collect_set("fp").alias("own")).where(F.size("own") > 1)
    star = stars.select(F.array_min("own").alias("a"), F.explode("own").alias("b")).where("a <> b")
    return near.unionByName(star).distinct()


def _joined(rows: DataFrame, facts: DataFrame) -> DataFrame:
    """``rows(fp, ...)`` with the columns of ``facts(fp, n, ...)``, one per fp; ``n`` is its number of rows.

    A key of more than a SHARE-th of all rows is joined by broadcast: there are fewer than
    SHARE such keys, whatever the input.  The others are joined by shuffle.
    """
    total = F.coalesce(facts.agg(F.sum("n").alias("total")).scalar(), F.lit(0))
    split = stored(facts.withColumn("hot", F.col("n") * SHARE > total), "facts")
    hot, cold = (split.where(c).drop("n", "hot") for c in ("hot", "not hot"))
    one = rows.join(F.broadcast(hot), "fp")
    two = rows.join(F.broadcast(hot.select("fp")), "fp", "left_anti").join(cold, "fp")
    return one.unionByName(two)


def near_duplicates(docs: DataFrame, *, blocks: int = BLOCKS, small: int = SMALL) -> DataFrame:
    """(doc_id, fp, component_id): one row per row of ``docs``."""
    small_batches(docs.sparkSession)
    rows = stored(fingerprints(docs), "fingerprints")
    nodes = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")), "nodes")
    labels = components(stored(links(nodes.select("fp"), blocks=blocks, small=small), "links"))
    rooted = nodes.join(labels, nodes["fp"] == labels["node"])
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    linked = rooted.join(least, "root").select("fp", "n", "component_id")
    alone = nodes.join(labels, nodes["fp"] == labels["node"], "left_anti").select("fp", "n", F.col("least").alias("component_id"))
    return _joined(rows, linked.unionByName(alone))


def op12_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = near_duplicates(docs)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
