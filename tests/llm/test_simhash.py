"""SimHash near-dedup against brute force over all pairs."""

import random

import pytest
import xxhash
from pyspark.sql import functions as F

from plymill.llm import simhash
from plymill.llm.simhash import BLOCKS, DISTANCE, op12_simhash_near_dedup

SCHEMA = "doc_id long, text string, fp int"


def fingerprint(text):
    low = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode())
    words = [w for w in low.replace(b"\t", b" ").replace(b"\n", b" ").replace(b"\v", b" ").replace(b"\f", b" ").replace(b"\r", b" ").split(b" ") if w]
    grams = [b" ".join(words[i : i + 3]) for i in range(max(len(words) - 2, 1))] if words else []
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute(rows):
    fp = [fingerprint(t) for _, t, *_ in rows]
    group = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if (fp[a] ^ fp[b]).bit_count() <= 2:
                old, new = group[a], group[b]
                group = [new if g == old else g for g in group]
    least = {}
    for g, (i, *_) in zip(group, rows, strict=True):
        if i is not None:
            least[g] = min(least.get(g, i), i)
    return sorted(((i, f"{f:016x}", least.get(g)) for f, g, (i, *_) in zip(fp, group, rows, strict=True)), key=str)


def found(frame, **more):
    out = simhash.near_duplicates(frame, **more).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0"), "component_id")
    return sorted(map(tuple, out.collect()), key=str)


def corpus():
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(300)]
    long = " ".join(rng.choices(vocabulary, k=900))
    rows = [(i, t, 1) for i, t in enumerate([None, "", " \n\t", "one", "ONE", "one two", "É ü\x0bx", "a b c", "A  b\r\nC", "a b c d"])]
    for i in range(60):
        words = long.split()
        for _ in range(i % 6):
            words[rng.randrange(len(words))] = "changed"
        rows.append((100 + i, " ".join(words), 1))
    rows += [(300 + i, " ".join(rng.choices(vocabulary, k=rng.randrange(1, 60))), 1) for i in range(80)]
    return rows + [(None, long, 1), (None, None, None), (100, long, 1), (100, long, 1), (7, long + " end", 1)]


def test_hashes_are_those_of_the_engine(spark):
    """The library's XXH64 and Spark's agree, and a text of one shingle has its hash as fingerprint."""
    texts = ["a b c", "one two", "é ü x", "x" * 100 + " y z"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    engine = {r[0]: r[1] for r in rows.select("doc_id", F.xxhash64("text")).collect()}
    assert {r.doc_id: r.fp for r in simhash.fingerprints(rows).collect()} == engine
    assert all(xxhash.xxh64_intdigest(t.encode(), 42) == engine[i] % (1 << 64) for i, t in enumerate(texts))


@pytest.mark.parametrize(("blocks", "small"), [(5, 64), (3, 64), (5, 2), (3, 1)])
def test_components(spark, blocks, small):
    rows = corpus()
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert found(frame, blocks=blocks, small=small) == brute(rows)


def test_large_groups_are_not_paired(spark):
    """Values around few centres, in chains that only the centres of a large key connect."""
    rng = random.Random(1)
    values = {rng.getrandbits(64) for _ in range(50)}
    for _ in range(600):
        values.add(rng.choice(sorted(values)) ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)))
    signed = sorted(v - (1 << 64) if v >> 63 else v for v in values)
    group = {v: v for v in signed}

    def top(v):
        while group[v] != v:
            v = group[v]
        return v

    for i, a in enumerate(signed):
        for b in signed[:i]:
            if ((a ^ b) % (1 << 64)).bit_count() <= DISTANCE:
                x, y = sorted((top(a), top(b)))
                group[y] = x
    nodes = spark.createDataFrame([(v,) for v in signed], "fp long")
    for small in (2, 1000):
        edges = simhash.links(nodes, small=small)
        assert edges.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) > DISTANCE).count() == 0
        got = {r.node: r.root for r in simhash.components(edges).collect()}
        assert {v: got.get(v, v) for v in signed} == {v: top(v) for v in signed}


def test_masks_cover_every_pair_of_bits():
    masks = simhash.key_masks(BLOCKS, DISTANCE)
    assert all(any(not m >> i & 1 and not m >> j & 1 for m in masks) for i in range(64) for j in range(64))


def test_edges(spark):
    nothing = spark.createDataFrame([], SCHEMA)
    assert found(nothing) == []
    rows = corpus()
    frame = spark.createDataFrame(rows, SCHEMA)
    for name in ("n", "least", "which", "part", "own", "component_id", "node"):
        frame = frame.withColumn(name, F.lit("x"))
    assert found(frame) == brute(rows)
    same = [(i, "the same text again", 1) for i in range(3000)]
    assert found(spark.createDataFrame(same, SCHEMA)) == sorted(((i, f"{fingerprint('the same text again'):016x}", 0) for i in range(3000)), key=str)


def test_long_text(spark):
    rng = random.Random(8)
    text = " ".join(f"w{rng.randrange(9000)}" for _ in range(450_000))
    assert len(text) > 1 << 21
    got = found(spark.createDataFrame([(1, text, 1), (2, "x", 1)], SCHEMA))
    assert got[0] == (1, f"{fingerprint(text):016x}", 1)


def test_query(spark, small):
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    got = op12_simhash_near_dedup(spark, small)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)
