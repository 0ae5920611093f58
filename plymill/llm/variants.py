"""Spelling variant grouping: words within one edit, by asymmetric q-chunks.

A word is cut into two disjoint chunks, its halves.  One inserted, deleted or replaced code point
touches only one of them, so the other stands in the partner as a gram, at the same place or one
place on.  The shorter word of a pair (the smaller one of equal lengths) contributes its two chunks,
the other its positional grams; grams at places that no chunk within shift one can have
are not dealt.  Both sides are joined by (length of the shorter, place, chunk), and the rest of the two
words is verified.

A chunk that more than SMALL words share is split by the same method: the words under it agree
outside one region, so the region is halved again, and the words are joined by what they agree on
and one half of the region.  Regions end at one code point, where the words that agree outside
it are no more than the alphabet allows.  So no join grows with the square of a group.  Several
keys can hold a pair; it counts under the key whose region has the first place where the words differ.

All expressions are native.  Null texts hold no words.  A row without ``doc_id`` has no hash, so its runs keep all code points.
Repeated rows count each time.  An empty table, or one without words, gives an empty table.  Ties of form
go to the smallest word in code-point order.  Texts and words may have any length.  Only ``doc_id`` and
``text`` are read, so other columns cannot clash.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plymill.llm.graphs import stored
from plymill.llm.lines import LOWER, UPPER

LETTERS = "[A-Za-zÀ-ÿ]"
SHORTEST = 7
OFTEN = 2
RATIO = 10
NOISE = 31
SMALL = 32


def runs(docs: DataFrame, shortest: int = SHORTEST, noise: int = NOISE) -> DataFrame:
    """(word): a row per occurrence; where ``noise`` divides the hash of a run, it loses one code point."""
    found = F.regexp_extract_all("text", F.lit(f"{LETTERS}{{{shortest},}}"), F.lit(0))
    run = docs.select(F.col("doc_id").cast("string").alias("id"), F.explode(found).alias("run"))
    run = run.select("id", F.translate("run", UPPER, LOWER).alias("run"))
    hashed = run.select("run", F.crc32(F.concat("id", F.lit(":"), "run")).alias("h"))
    place = F.pmod("h", F.length("run")).cast("int")
    shorter = F.concat(F.expr("left(run, cut)"), F.expr("substring(run, cut + 2)"))
    word = F.when(F.col("h") % noise == 0, shorter).otherwise(F.col("run"))
    return hashed.withColumn("cut", place).select(word.alias("word")).where(F.length("word") >= shortest)


def word_counts(docs: DataFrame, shortest: int = SHORTEST, often: int = OFTEN, noise: int = NOISE) -> DataFrame:
    """(word, n) of words with at least ``often`` occurrences."""
    return runs(docs, shortest, noise).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= often)


def _halves(rows: DataFrame) -> DataFrame:
    """Each row twice: the edit lies in the second or in the first half of its region, and the other half is the chunk."""
    middle = F.expr("lo + (hi - lo) div 2")
    regions = F.array(F.struct(middle.alias("lo"), F.col("hi")), F.struct("lo", middle.alias("hi")))
    return rows.select("word", "n", "extra", "size", F.explode(regions).alias("region")).select("word", "n", "extra", "size", "region.*")


def _keyed(rows: DataFrame) -> DataFrame:
    """With the hash of all that a word has outside its region; ``extra`` is 1 if the region is longer by the inserted code point."""
    outside = F.xxhash64("size", "lo", "hi", F.expr("left(word, lo)"), F.expr("substring(word, hi + extra + 1)"))
    return rows.withColumn("key", outside)


def _pairs(cold: DataFrame) -> DataFrame:
    """(a, b, a_n, b_n): the verified pairs of keys with few words."""
    member = F.struct("word", "n")
    group = cold.groupBy("key", "size", "lo", "hi").agg(
        F.collect_list(F.when(F.col("extra") == 0, member)).alias("chunks"),
        F.collect_list(F.struct("word", "n", "extra")).alias("grams"),
    )
    one = group.select("lo", "hi", "size", F.explode("chunks").alias("a"), "grams")
    both = one.select("lo", "hi", "size", "a", F.explode("grams").alias("b"))
    same = F.expr("left(a.word, lo) = left(b.word, lo) AND substring(a.word, hi + 1) = substring(b.word, hi + b.extra + 1)")
    here = F.expr("hi = size OR left(a.word, hi) <> left(b.word, hi)")
    ordered = F.expr("b.extra = 1 OR a.word < b.word")
    near = F.levenshtein("a.word", "b.word", 1) == 1
    return both.where(ordered & same & here & near).select(
        F.col("a.word").alias("a"), F.col("b.word").alias("b"), F.col("a.n").alias("a_n"), F.col("b.n").alias("b_n")
    )


def near_pairs(words: DataFrame, *, small: int = SMALL) -> DataFrame:
    """(a, b, a_n, b_n): every pair of ``words(word, n)`` that differ by one edit, once."""
    length = F.length("word")
    rows = words.select("word", "n", F.explode(F.array(F.lit(0), F.lit(1))).alias("extra"))
    rows = rows.withColumn("size", length - F.col("extra")).where("size > 0")
    rows = rows.withColumns({"lo": F.lit(0), "hi": F.col("size")})
    found = []
    while True:
        dealt = stored(_keyed(_halves(rows)), "chunks")
        sizes = dealt.groupBy("key").agg(F.sum(1 - F.col("extra")).alias("chunks"), F.count("*").alias("members"))
        sizes = sizes.where("chunks > 0 AND members > 1").select("key", (F.col("members") > small).alias("many"))
        kept = dealt.join(sizes, "key")
        wide = F.col("many") & (F.col("hi") - F.col("lo") > 1)
        found.append(stored(_pairs(kept.where(~wide)), "pairs"))
        rows = stored(kept.where(wide).drop("key", "many"), "wide")
        if rows.isEmpty():
            return reduce(DataFrame.unionByName, found)


def variants(words: DataFrame, *, ratio: int = RATIO, small: int = SMALL) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for each of ``words(word, n)``."""
    pairs = near_pairs(words, small=small)
    sides = F.array(
        F.struct(F.col("a").alias("word"), F.col("b").alias("near"), F.col("b_n").alias("near_n")),
        F.struct(F.col("b").alias("word"), F.col("a").alias("near"), F.col("a_n").alias("near_n")),
    )
    sided = pairs.select(F.explode(sides).alias("s")).select("s.*")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form"))).alias("best")
    facts = sided.groupBy("word").agg(F.count("*").alias("n_near"), best)
    joined = words.join(facts, "word", "left")
    is_form: Column = -F.col("best.less") >= ratio * F.col("n")
    formed = joined.select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(is_form, F.col("best.form")).alias("form"),
        F.when(is_form, -F.col("best.less")).alias("form_n"),
    )
    formed = stored(formed, "forms")
    roots = _roots(formed.where("form IS NOT NULL").select("word", F.col("form").alias("root")))
    named = formed.join(roots, "word", "left")
    return named.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def _roots(links: DataFrame) -> DataFrame:
    """Follow links to their ends.  Each round doubles the steps; counts grow tenfold a step, so rounds are few."""
    while True:
        up = links.select(F.col("word").alias("root"), F.col("root").alias("top"))
        jumped = stored(links.join(up, "root", "left").select("word", F.coalesce("top", "root").alias("root"), F.col("top").isNotNull().alias("moved")), "roots")
        links = jumped.select("word", "root")
        if jumped.where("moved").isEmpty():
            return links


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return variants(stored(word_counts(docs), "words"))
