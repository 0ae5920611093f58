"""Quality rules with adaptive thresholds.

Each document gets a few whole-number measures.  Per language and source, a sketch of
each measure counts its values in buckets that are exact below 64 and within 1/32
above.  Sketches merge by adding counts, so the sketches of small groups are merged to
the language and to the corpus, and hot groups combine map-side.  Fences of
the quartiles replace fixed cutoffs; a join brings them back to the documents.

Null languages and sources are groups of their own.  Null or empty texts have no words
and fail the base rule.  Repeated rows count as often as they occur.  Equal values share a bucket, so ties are
judged alike.  An empty table gives an empty result.  Texts are read whole, at any length, a slice at a time.
Other columns pass unchanged, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from plymill.llm.blocks import runs
from plymill.llm.graphs import small_batches, stored
from plymill.llm.words import Slice, slices

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_text_lines"]
SYMBOLS = b"#*$%&|<>"
_SYMBOL, _UPPER = np.zeros(256, bool), np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True
_UPPER[65:91] = True


@dataclass(frozen=True)
class Rule:
    """A measure ``scale * numerator // denominator`` and the least distance of its fences from the quartiles."""

    name: str
    numerator: str
    denominator: str
    scale: int
    room: int
    both_sides: bool = False


#: The distances keep a fence from closing in on a measure that hardly varies.
RULES = (
    Rule("symbols", "n_symbols", "word_chars", 10_000, 600),
    Rule("dup_lines", "n_dup_lines", "n_text_lines", 10_000, 3_000),
    Rule("repeats", "n_repeat_words", "n_words", 10_000, 2_500),
    Rule("upper", "n_upper", "word_chars", 10_000, 2_500),
    Rule("length", "word_chars", "n_words", 100, 300, both_sides=True),
)
PRIOR = 50
SPREAD = 3


def _per_document(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags)])
    return total[bounds[1:]] - total[bounds[:-1]]


def _repeated_words(piece: Slice, width: int = 3) -> np.ndarray:
    """Words inside windows that the same document holds twice or more."""
    first, found = piece.windows(piece.hashes(), width)
    owner = piece.owners()[first] if len(first) else first
    order = np.lexsort((found, owner))
    new = runs(owner[order], found[order]) if len(order) else np.zeros(0, bool)
    alone = new & np.append(new[1:], True)
    edges = np.zeros(len(piece.start) + 1, np.int64)
    twice = first[order[~alone]]
    np.add.at(edges, twice, 1)
    np.add.at(edges, twice + width, -1)
    return _per_document(np.cumsum(edges[:-1]) > 0, piece.offset)


def text_counts(texts: pa.Array) -> pa.Array:
    """The counts of each text, as a struct of longs."""
    found: dict[str, list[np.ndarray]] = {name: [] for name in COUNTS}
    batch = pa.RecordBatch.from_arrays([texts], ["text"])
    for piece in slices(iter([batch]), lower=False):
        data = piece.data
        lead = (data & 0xC0) != 0x80
        inside = np.zeros(len(data) + 1, np.int8)
        inside[piece.start] = 1
        inside[piece.end] -= 1
        word = np.cumsum(inside[:-1], dtype=np.int8) > 0
        text, n_lines, n_dup = data.tobytes(), [], []
        for a, b in zip(piece.bounds[:-1].tolist(), piece.bounds[1:].tolist(), strict=True):
            lines = [x for x in text[a:b].split(b"\n") if x.strip(b" \t\n\x0b\x0c\r")]
            n_lines.append(len(lines))
            n_dup.append(len(lines) - len(set(lines)))
        for name, values in {
            "n_words": piece.counts,
            "word_chars": _per_document(lead & word, piece.bounds),
            "n_symbols": _per_document(_SYMBOL[data], piece.bounds),
            "n_dup_lines": np.array(n_dup),
            "n_repeat_words": _repeated_words(piece),
            "n_upper": _per_document(_UPPER[data], piece.bounds),
            "n_text_lines": np.array(n_lines),
        }.items():
            found[name].append(values)
    columns = [np.concatenate(found[c] or [np.zeros(0)]).astype(np.int64) for c in COUNTS]
    return pa.StructArray.from_arrays([pa.array(c) for c in columns], COUNTS)


def counts_of(text: Column) -> Column:
    kind = ", ".join(f"{c} long" for c in COUNTS)
    return F.arrow_udf(text_counts, f"struct<{kind}>")(text.cast("binary"))


def base_failed(m: Column) -> Column:
    return (m["n_words"] < 50) | (m["n_repeat_words"] * 100 > m["n_words"] * 50)


def measure(rule: Rule, m: Column) -> Column:
    top, below = m[rule.numerator] * rule.scale, m[rule.denominator]
    return F.when(below > 0, F.floor(top / below)).otherwise(0).cast("long")


def bucket(value: Column) -> Column:
    """Whole numbers to sketch buckets; the order is kept."""
    shift = F.length(F.bin(value)) - 6
    return F.when(value < 64, value).otherwise(
        shift * 64 + F.floor(value / F.pow(F.lit(2.0), shift))
    ).cast("long")


def bucket_floor(found: Column) -> Column:
    """The least value of a bucket."""
    shift = F.floor(found / 64)
    return F.when(found < 64, found).otherwise(
        (found - shift * 64) * F.pow(F.lit(2.0), shift)
    ).cast("long")


def sketches(measured: DataFrame) -> DataFrame:
    """(lang, source, rule, bucket, n) over the documents that pass the base rule."""
    m = F.col("m")
    rules = F.array(*[
        F.struct(F.lit(r.name).alias("rule"), bucket(measure(r, m)).alias("bucket")) for r in RULES
    ])
    rows = measured.where(~base_failed(m)).select("lang", "source", F.explode(rules).alias("x"))
    return rows.groupBy("lang", "source", "x.rule", "x.bucket").agg(F.count("*").alias("n"))


def fences(sketch: DataFrame, *keys: str) -> DataFrame:
    """(keys, rule, n, lo, hi): quartile fences of merged sketches."""
    merged = sketch.groupBy(*keys, "rule", "bucket").agg(F.sum("n").alias("n"))
    group = W.partitionBy(*keys, "rule")
    ranked = merged.select(
        *keys,
        "rule",
        bucket_floor(F.col("bucket")).alias("value"),
        F.sum("n").over(group.orderBy("bucket")).alias("upto"),
        F.sum("n").over(group).alias("n"),
    )
    quartile = [F.min(F.when(F.col("upto") * 4 >= F.col("n") * i, F.col("value"))) for i in (1, 3)]
    cut = ranked.groupBy(*keys, "rule").agg(F.first("n").alias("n"), quartile[0].alias("q1"), quartile[1].alias("q3"))
    room = F.create_map(*[F.lit(x) for r in RULES for x in (r.name, r.room)])[F.col("rule")]
    both = F.col("rule").isin([r.name for r in RULES if r.both_sides])
    reach = F.greatest(room, (F.col("q3") - F.col("q1")) * SPREAD)
    return cut.select(*keys, "rule", "n", F.when(both, F.col("q1") - reach).alias("lo"), (F.col("q3") + reach).alias("hi"))


def thresholds(sketch: DataFrame) -> DataFrame:
    """One row per (lang, source): fences by rule, mixed with those of the language and of the corpus."""
    own = fences(sketch, "lang", "source").withColumnsRenamed({"n": "n0", "lo": "lo0", "hi": "hi0"})
    lang = fences(sketch, "lang").withColumnsRenamed({"rule": "r1", "lang": "l1", "n": "n1", "lo": "lo1", "hi": "hi1"})
    every = fences(sketch).withColumnsRenamed({"rule": "r2", "n": "n2", "lo": "lo2", "hi": "hi2"})
    joined = own.join(lang, (F.col("rule") == F.col("r1")) & F.col("lang").eqNullSafe(F.col("l1")))
    joined = joined.join(F.broadcast(every), F.col("rule") == F.col("r2"))  # one row per rule

    def mixed(own: Column, n: Column, wider: Column) -> Column:
        return (own * n + wider * PRIOR) / (n + PRIOR)

    def pick(name: str) -> Column:
        lang_fence = mixed(F.col(f"{name}1").cast("double"), F.col("n1"), F.col(f"{name}2").cast("double"))
        return mixed(F.col(f"{name}0").cast("double"), F.col("n0"), lang_fence)

    fence = F.struct(pick("lo").alias("lo"), pick("hi").alias("hi"))
    return (
        joined.groupBy(F.col("lang").alias("t_lang"), F.col("source").alias("t_source"))
        .pivot("rule", [r.name for r in RULES])
        .agg(F.first(fence))
    )


def judge(docs: DataFrame) -> DataFrame:
    """All columns of ``docs`` with ``quality``: struct(counts, base_failed, kept)."""
    small_batches(docs.sparkSession)
    row = F.struct(*[docs[c] for c in docs.columns])
    measured = docs.select(row.alias("row"), docs["lang"], docs["source"], counts_of(docs["text"]).alias("m"))
    narrow = docs.select("lang", "source", counts_of(docs["text"]).alias("m"))
    limits = stored(thresholds(sketches(narrow)), "thresholds")  # its known size decides how it is joined
    joined = measured.join(
        limits,
        measured["lang"].eqNullSafe(limits["t_lang"]) & measured["source"].eqNullSafe(limits["t_source"]),
        "left",
    )
    m, failed = F.col("m"), base_failed(F.col("m"))
    fits = F.lit(True)
    for rule in RULES:
        value, fence = measure(rule, m), F.col(rule.name)
        fits = fits & F.coalesce(value <= fence["hi"], F.lit(True)) & F.coalesce(value >= fence["lo"], F.lit(True))
    quality = F.struct(m.alias("counts"), failed.alias("base_failed"), (~failed & fits).alias("kept"))
    return joined.select("row", quality.alias("quality")).select("row.*", "quality")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang", "source", "text")
    judged = judge(docs)
    return judged.select(
        "doc_id", *[f"quality.counts.{c}" for c in COUNTS[:5]], "quality.base_failed", "quality.kept"
    )


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the rules keep."""
    return judge(docs).where("quality.kept").select(*docs.columns)
