"""Spelling variants against brute force over all pairs of words."""

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from plymill.llm import variants
from plymill.llm.variants import op13_spelling_variants

SCHEMA = "doc_id long, text string"


def lower(run):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in run)


def counted(rows, shortest=7, often=2, noise=31):
    words = Counter()
    for i, text in rows:
        for run in map(lower, re.findall("[A-Za-zÀ-ÿ]+", text or "")):
            if i is not None and (h := zlib.crc32(f"{i}:{run}".encode())) % noise == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            words[run] += 1
    return {w: n for w, n in words.items() if len(w) >= shortest and n >= often}


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(words, ratio=10):
    by_shape = {}
    for w in words:
        for i in range(len(w) + 1):
            by_shape.setdefault(w[:i] + w[i + 1 :], set()).add(w)
    facts, form = {}, {}
    for w, n in words.items():
        cousins = {v for i in range(len(w) + 1) for v in by_shape[w[:i] + w[i + 1 :]] if v != w}
        cousins |= by_shape.get(w, set()) - {w}
        cousins = {v for v in cousins if near(w, v)}
        best = min(cousins, key=lambda v: (-words[v], v), default=None)
        if best is not None and words[best] >= ratio * n:
            form[w] = best
        facts[w] = len(cousins)
    out = []
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n, facts[w], words[form[w]] if w in form else None))
    return sorted(out, key=str)


def rows(frame):
    return sorted(map(tuple, frame.collect()), key=str)


@pytest.mark.parametrize("small", [32, 2])
@pytest.mark.parametrize("letters", ["ab", "abcdefgh", "aé×"])
def test_all_pairs_are_found_once(spark, small, letters):
    rng = random.Random(len(letters))
    words = {"".join(rng.choices(letters, k=rng.randrange(1, 12))): rng.choice([2, 3, 30, 400, 5000]) for _ in range(500)}
    frame = spark.createDataFrame(list(words.items()), "word string, n long").repartition(3)
    pairs = rows(variants.near_pairs(frame, small=small))
    own = sorted(words)
    expected = {frozenset((a, b)) for i, a in enumerate(own) for b in own[:i] if near(a, b)}
    assert len(pairs) == len(expected) and {frozenset(p[:2]) for p in pairs} == expected
    assert all(words[a] == an and words[b] == bn for a, b, an, bn in pairs)
    assert rows(variants.variants(frame, small=small)) == brute(words)


def corpus():
    rng = random.Random(2)
    stems = ["".join(rng.choices("abcdefgáéñß", k=rng.randrange(6, 13))) for _ in range(120)]
    data = [(i, " ".join(rng.choices(stems, [1 / (k + 1) for k in range(120)], k=200)).replace(" a", " A")) for i in range(60)]
    long = "x".join(["abcdefghij"] * 400)
    data += [(100, f"{long} {long} {long[:-1]} {long[:-1]}"), (101, None), (102, ""), (103, "1234567 ()"), (None, f"{stems[0]}-{stems[1]}_{stems[0]}")]
    return data + [data[0], data[0], (104, "ÀÁÂÃÄÅÆ ÀÁÂÃÄÅÆ àáâãäåæ àáâãäåæ straße12straße")]


def test_words_and_forms(spark):
    data = corpus()
    frame = spark.createDataFrame(data, SCHEMA).repartition(4)
    words = variants.word_counts(frame)
    assert {r.word: r.n for r in words.collect()} == counted(data)
    assert any(r[1] for r in brute(counted(data)))
    assert rows(variants.variants(words)) == brute(counted(data))
    crowded = frame
    for name in ("word", "n", "run", "id", "h", "lo", "key", "extra"):
        crowded = crowded.withColumn(name, F.lit(1))
    assert rows(variants.word_counts(crowded)) == rows(words)


def test_roots_follow_chains(spark):
    words = {"abcdefgh": 100_000, "abcdefgx": 10_000, "abcdefyx": 1000, "abcdezyx": 100, "abcduzyx": 10}
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    assert {r.word: r.root for r in variants.variants(frame).collect()} == dict.fromkeys(words, "abcdefgh")


def test_one_chunk_in_a_third_of_all_words(spark):
    rng = random.Random(4)
    words = {"prefix" + "".join(rng.choices("abcdefghij", k=6)): 2 for _ in range(900)}
    words |= {"".join(rng.choices("abcdefghij", k=12)): 2 for _ in range(1800)}
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    assert rows(variants.variants(frame)) == brute(words)


def test_nothing(spark):
    assert rows(variants.variants(variants.word_counts(spark.createDataFrame([], SCHEMA)))) == []
    assert rows(variants.variants(variants.word_counts(spark.createDataFrame([(1, "short words")], SCHEMA)))) == []


def test_query(spark, small):
    data = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    got = op13_spelling_variants(spark, small)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert rows(got) == brute(counted(data))
