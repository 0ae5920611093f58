"""Language ID with hyperdimensional profiles.

A letter is a random vector of signs.  A letter n-gram binds its letters' vectors, each
permuted by its place, by multiplication; a text or a language bundles its n-grams by
addition.  A text gets the language whose prototype has the largest cosine.

Bundles are whole numbers, so sums do not depend on the order of tasks.  Letters are
lower-cased; all else is one space.  Texts that are null or have no letter are ``und`` with
score 0.  Equal cosines go to the first language by code point; without any
training text everything is ``und``.  Repeated rows train and are predicted each time; a row without ``doc_id`` has no
remainder, is neither held out nor learned from, and is predicted.  An empty table gives an empty table.  Texts are read whole, at any
length.  Only ``doc_id``, ``text`` and ``lang`` are read, so other columns cannot clash.
"""

from __future__ import annotations

import functools
import sys

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plymill.llm.graphs import small_batches

SIZE = 512
ORDER = 3
SEED = 71
GROUP_CHARS = 1 << 20
GROUP_DOCS = 512
COLUMNS = 8192


def letter_vectors(codes: np.ndarray, size: int = SIZE) -> np.ndarray:
    """A row of signs for each code point; the same in every task."""
    return np.stack([np.random.default_rng([SEED, int(c)]).choice([-1, 1], size) for c in codes]).astype(np.float32)


@functools.cache
def letter_table() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.array([chr(c).isalpha() for c in range(sys.maxunicode + 1)], bool)


def clean(text: str) -> np.ndarray:
    """Code points: lower-cased letters, single spaces for the rest, a space at both ends; empty without letters."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = letter_table()[codes]
    if not letter.any():
        return np.zeros(0, np.uint32)
    codes = np.concatenate([[32], np.where(letter, codes, 32), [32]]).astype(np.uint32)
    keep = np.ones(len(codes), bool)
    keep[1:] = (codes[1:] != 32) | (codes[:-1] != 32)
    return codes[keep]


def groups(texts: pa.Array):
    """Cleaned texts, some at a time: (first document, list of code arrays)."""
    first, held, chars = 0, [], 0
    for i, text in enumerate(texts):
        codes = clean(text.as_py() or "")
        held.append(codes)
        chars += len(codes)
        if chars >= GROUP_CHARS or len(held) >= GROUP_DOCS:
            yield first, held
            first, held, chars = i + 1, [], 0
    if held:
        yield first, held


class Profiles:
    """Vectors of n-grams; keeps those of the letters it has met."""

    def __init__(self):
        self.seen: dict[int, np.ndarray] = {}

    def vectors(self, letters: np.ndarray, places: np.ndarray) -> np.ndarray:
        """The vector of each n-gram, whose letters ``places`` are rows of ``letters``."""
        fresh = [c for c in letters.tolist() if c not in self.seen]
        if fresh:
            if len(self.seen) > 50_000:
                self.seen.clear()
                fresh = letters.tolist()
            self.seen.update(zip(fresh, letter_vectors(np.array(fresh)), strict=True))
        table = np.stack([self.seen[c] for c in letters.tolist()])
        out = table[places[:, -1]]
        for k in range(ORDER - 1):
            out *= np.roll(table, ORDER - 1 - k, axis=1)[places[:, k]]
        return out

    def bundle(self, held: list[np.ndarray], owner: np.ndarray | None = None) -> np.ndarray:
        """The bundle of each document, or of the documents with each number in ``owner``; a block of n-grams at a time."""
        owner = np.arange(len(held)) if owner is None else owner
        owners = int(owner.max(initial=-1)) + 1
        out = np.zeros((owners, SIZE), np.float64)
        sizes = np.array([len(h) for h in held])
        if not sizes.sum():
            return out
        codes = np.concatenate(held)
        letters, index = numbered(codes)
        room = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(codes))
        start = np.flatnonzero(room >= ORDER)
        gram = np.zeros(len(start), np.int64)
        for k in range(ORDER):
            gram = gram * len(letters) + index[start + k]
        kinds, gram = numbered(gram)
        places = np.stack([kinds // len(letters) ** k % len(letters) for k in range(ORDER - 1, -1, -1)], axis=1)
        owner = np.repeat(owner, sizes)[start]
        exact = np.float32 if len(codes) < 1 << 24 else np.float64
        for a in range(0, len(kinds), COLUMNS):
            part = places[a : a + COLUMNS]
            here = slice(None) if len(kinds) <= COLUMNS else (gram >= a) & (gram < a + COLUMNS)
            cell = owner[here] * len(part) + (gram[here] - a)
            counts = np.bincount(cell, minlength=owners * len(part)).astype(exact).reshape(owners, len(part))
            out += counts @ self.vectors(letters, part)
        return out


def numbered(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values in order, and the place of each value among them; by a table where the range is short."""
    top = int(values.max(initial=0))
    if top > 1 << 22:
        return np.unique(values, return_inverse=True)
    found = np.zeros(top + 1, bool)
    found[values] = True
    return np.flatnonzero(found), (np.cumsum(found) - 1)[values]


def prototypes(training: DataFrame) -> dict[str, np.ndarray]:
    """The bundle of all texts of each ``lang`` of ``training(lang, text)``; one vector per language is collected."""

    def bundled(batches):
        profiles, total = Profiles(), {}
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            for first, held in groups(batch.column("text")):
                names, owner = np.unique(np.array(langs[first : first + len(held)], object), return_inverse=True)
                merged = np.rint(profiles.bundle(held, owner)).astype(np.int64)
                for lang, vector in zip(names.tolist(), merged, strict=True):
                    if vector.any():
                        total[lang] = total.get(lang, 0) + vector
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.string()), pa.array([v.tolist() for v in total.values()], pa.list_(pa.int64()))],
            ["lang", "bundle"],
        )

    parts = training.select("lang", "text").where("lang is not null").mapInArrow(bundled, "lang string, bundle array<long>")
    summed = parts.select("lang", F.posexplode("bundle").alias("place", "x")).groupBy("lang", "place").agg(F.sum("x").alias("x"))
    out: dict[str, np.ndarray] = {}
    for lang, place, x in summed.collect():
        out.setdefault(lang, np.zeros(SIZE))[place] = x
    return out


def predict(text: Column, learned: dict[str, np.ndarray]) -> Column:
    """struct(lang, score) of a text."""
    langs = sorted(lang for lang, v in learned.items() if v.any())
    table = np.stack([learned[k] / np.linalg.norm(learned[k]) for k in langs]) if langs else None
    profiles = Profiles()

    def predicted(texts: pa.Array) -> pa.Array:
        names, scores = [], []
        for _, held in groups(texts):
            bundle = profiles.bundle(held)
            norm = np.linalg.norm(bundle, axis=1)
            for i, codes in enumerate(held):
                if not len(codes) or table is None:
                    names.append("und")
                    scores.append(0.0)
                    continue
                cosine = table @ bundle[i] / (norm[i] or 1.0)
                best = int(np.argmax(cosine))
                names.append(langs[best])
                scores.append(float(np.clip(cosine[best], 0.0, 1.0)))
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["lang", "score"])

    return F.arrow_udf(predicted, "struct<lang:string,score:double>")(text)


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2
    learned = prototypes(docs.where(~held_out & F.col("lang").isNotNull()))
    found = docs.select("doc_id", held_out.alias("held_out"), predict(F.col("text"), learned).alias("p"))
    return found.select("doc_id", "held_out", F.col("p.lang").alias("lang_pred"), "p.score")
