"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

The documents of a source fall by a seeded hash into blocks, of which there are more where there are
more documents, so that a block stays small.  A target is drawn as whole
passes over all blocks and one part pass: permuted blocks until the rest is reached, the
last of them cut inside, document by document, the last document at a word.  The exact
block quotas of the sources are then split among output shards: a seeded tree halves the
shards and draws each half's share of every quota from the multivariate hypergeometric
distribution.  The drawn blocks of a source, permuted again, are dealt to the shards by
these shares, and rows are shuffled inside a shard by a random key.

Everything follows from hashes and the seed, so reruns agree.  Null texts have size 0 and
null sources form one source, last in order.  Sources without words take nothing.
Identical rows are drawn as separate documents; rows that differ only in other columns are cut in the order of a hash of
all columns.  An empty table gives an empty mix.  Texts may have any length; columns of any name pass unchanged.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from plymill.llm.graphs import stored
from plymill.session import scratch_path

WORD = r"[^\x20\x09-\x0D]+"
BLOCKS = 1024
BLOCK_ROWS = 50_000
WEIGHTS = (5, 2, 1)
PLAN = "source string, source_size long, target double, passes int, part long"


def targets(sizes: list[tuple[str | None, int]], share: float, cap: float, weights=WEIGHTS) -> dict:
    """Words to take from each source: by weight, at most ``cap`` times its size, the excess reshared."""
    order = sorted(sizes, key=lambda x: (x[0] is None, x[0] or ""))
    weight = {s: weights[i % len(weights)] for i, (s, _) in enumerate(order)}
    rest, left, found = share * sum(n for _, n in sizes), dict(order), {}
    while left:
        unit = rest / sum(weight[s] for s in left)
        full = [s for s, n in left.items() if unit * weight[s] > cap * n]
        if not full:
            return found | {s: unit * weight[s] for s in left}
        for s in full:
            found[s] = cap * left.pop(s)
            rest -= found[s]
    return found


def split_quotas(quotas: np.ndarray, shards: int, seed: int) -> np.ndarray:
    """``(sources, shards)`` whole numbers that add up to the quotas; equal shards in expectation and total."""
    out = np.zeros((len(quotas), shards), np.int64)

    def halve(counts: np.ndarray, first: int, last: int) -> None:
        if last - first == 1:
            out[:, first] = counts
            return
        middle = (first + last) // 2
        draws = int(counts.sum()) * (middle - first) // (last - first)
        rng = np.random.default_rng([seed, first, last])
        left = rng.multivariate_hypergeometric(counts, draws, method="marginals")
        halve(left, first, middle)
        halve(counts - left, middle, last)

    if len(quotas):
        halve(quotas, 0, shards)
    return out


def block_count(rows: int) -> int:
    """At least BLOCKS, and so many that a block of one source has no more than about BLOCK_ROWS documents."""
    return max(BLOCKS, -(-rows // BLOCK_ROWS))


def _measured(docs: DataFrame, seed: int, blocks: int) -> DataFrame:
    draw = F.xxhash64(F.lit(seed), docs["doc_id"], docs["text"])
    return docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"),
        docs["source"].alias("m_source"),
        docs["doc_id"].alias("m_id"),
        F.coalesce(F.regexp_count(docs["text"], F.lit(WORD)), F.lit(0)).cast("long").alias("m_size"),
        draw.alias("draw"),
        F.pmod(draw, F.lit(blocks)).cast("int").alias("block"),
    )


def _draws(blocks: DataFrame, plan: DataFrame, seed: int) -> DataFrame:
    """(source, block, epoch, need): one row per drawn block; ``need`` words where it is cut, else null."""
    keyed = blocks.join(plan, blocks["m_source"].eqNullSafe(plan["source"]))
    upto = F.sum("words").over(W.partitionBy("source").orderBy(F.xxhash64(F.lit(seed + 1), "block"), "block"))
    cut = keyed.select("source", "block", "words", "passes", "part", upto.alias("upto"))
    before = F.col("upto") - F.col("words")
    need = F.when((before < F.col("part")) & (F.col("upto") > F.col("part")), F.col("part") - before)
    extra = F.when((F.col("upto") <= F.col("part")) | need.isNotNull(), 1).otherwise(0)
    epochs = F.when(F.col("passes") + extra > 0, F.sequence(F.lit(0), F.col("passes") + extra - 1))
    return cut.select("source", "block", "passes", need.alias("need"), F.explode(epochs).alias("epoch")).select(
        "source", "block", "epoch", F.when(F.col("epoch") == F.col("passes"), F.col("need")).alias("need")
    )


def _cut(part: DataFrame) -> DataFrame:
    """The rows of the cut blocks, one block of each source, with ``cut``: how many of their words the part pass takes.

    Only (draw, id, size) with their number of rows are put in order; the words that are left before them
    come back to the rows by a join.
    """
    place = ["m_source", "draw", "m_id", "m_size"]
    alike = part.groupBy(*place).agg(F.count("*").alias("rows"), F.max("need").alias("wanted"))
    words = F.col("m_size") * F.col("rows")
    upto = F.sum(words).over(W.partitionBy("m_source").orderBy("draw", "m_id", "m_size"))
    left = alike.select(*[F.col(c).alias(f"of_{c}") for c in place], "rows", (F.col("wanted") - upto + words).alias("left"))
    left = stored(left, "cuts")
    same = F.lit(True)
    for c in place:
        same = same & part[c].eqNullSafe(left[f"of_{c}"])
    joined = part.join(left, same).drop(*[f"of_{c}" for c in place])
    nth = F.row_number().over(W.partitionBy(*place).orderBy(F.xxhash64("row"))) - 1
    one, more = joined.where("rows = 1").withColumn("nth", F.lit(0)), joined.where("rows > 1").withColumn("nth", nth)
    both = one.unionByName(more)
    cut = F.greatest(F.lit(0), F.least(F.col("m_size"), F.col("left") - F.col("nth") * F.col("m_size")))
    return both.withColumn("cut", cut.cast("long")).drop("rows", "left", "nth")


def assign(docs: DataFrame, **options) -> DataFrame:
    """All columns of ``docs`` with ``mix``: struct(size, source_size, target, draws); options as below."""
    return _assigned(docs, **options).select("row.*", "mix")


def _assigned(docs: DataFrame, *, share: float = 1.5, cap: float = 2.0, shards: int = 16, seed: int = 20_240) -> DataFrame:
    """(row, mix) for each document.

    ``draws`` has a struct(shard, epoch, words) for each time the document is taken.
    Tables per source, and per source and block, are small; only the one row per source comes to
    the driver, so ``source`` has to name sources, not documents.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "mix")
    n = block_count(docs.count())
    _measured(docs, seed, n).groupBy("m_source", "block").agg(F.sum("m_size").alias("words")).write.parquet(path)
    blocks = spark.read.parquet(path)
    sizes = [(r[0], r[1]) for r in blocks.groupBy("m_source").agg(F.sum("words")).collect()]
    goal = targets(sizes, share, cap)
    rows = []
    for source, size in sizes:
        passes = int(goal[source] // size) if size else 0
        rows.append((source, size, float(goal[source]), passes, int(goal[source] - passes * size)))
    plan = spark.createDataFrame(rows, PLAN)
    draws = _draws(blocks, plan, seed)
    quota = {r[0]: r[1] for r in draws.groupBy("source").count().collect()}
    order = sorted(quota, key=lambda s: (s is None, s or ""))
    ends = np.cumsum(split_quotas(np.array([quota[s] for s in order], np.int64), shards, seed), axis=1)
    share_rows = [
        (s, k, int(ends[i, k - 1]) if k else 0, int(ends[i, k])) for i, s in enumerate(order) for k in range(shards)
    ]
    shares = spark.createDataFrame(share_rows, "s_source string, shard int, lo int, hi int").where("hi > lo")
    shares = shares.select("s_source", "shard", F.explode(F.sequence("lo", F.col("hi") - 1)).alias("rank"))
    deal = W.partitionBy("source").orderBy(F.xxhash64(F.lit(seed + 2), "block", "epoch"), "block", "epoch")
    ranked = draws.withColumn("rank", F.row_number().over(deal) - 1)
    dealt = ranked.join(
        shares, ranked["source"].eqNullSafe(shares["s_source"]) & (ranked["rank"] == shares["rank"])
    )
    by_block = stored(dealt.groupBy(F.col("source").alias("d_source"), F.col("block").alias("d_block")).agg(
        F.max("need").alias("need"), F.array_sort(F.collect_list(F.struct("epoch", "shard", "need"))).alias("draws")
    ), "draws")  # its known size decides how it is joined
    documents = _measured(docs, seed, n)
    taken = documents.join(
        by_block, documents["m_source"].eqNullSafe(by_block["d_source"]) & (documents["block"] == by_block["d_block"]), "left"
    )
    whole = taken.where("need is null").withColumn("cut", F.lit(None).cast("long"))
    part = _cut(taken.where("need is not null"))
    both = whole.unionByName(part)

    def drawn(x: Column) -> Column:
        words = F.when(x["need"].isNull(), F.col("m_size")).otherwise(F.col("cut"))
        return F.struct(x["shard"].alias("shard"), x["epoch"].alias("epoch"), words.alias("words"))

    none = F.array().cast("array<struct<shard:int,epoch:int,words:bigint>>")
    draws_of = F.coalesce(F.filter(F.transform("draws", drawn), lambda x: x["words"] > 0), none)
    out = both.join(F.broadcast(plan), both["m_source"].eqNullSafe(plan["source"]))  # one row per source
    return out.select(
        "row",
        F.struct(F.col("m_size").alias("size"), "source_size", "target", draws_of.alias("draws")).alias("mix"),
    )


def mixture(docs: DataFrame, *, seed: int = 20_240, **options) -> DataFrame:
    """One row per taken document: all columns, with shard, epoch, words and order_key.

    A document cut at a word has only its first ``words`` words.  Partitions are ranges of
    (shard, order_key), so a large shard takes many tasks.
    """
    rows = _assigned(docs, seed=seed, **options).select("row", "mix", F.explode("mix.draws").alias("taken"))
    own = F.col("row")
    pieces = F.regexp_extract_all(own["text"], F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0))
    cut = F.array_join(F.slice(pieces, F.lit(1), F.col("taken.words").cast("int")), "")
    text = F.when(F.col("taken.words") < F.col("mix.size"), cut).otherwise(own["text"])
    key = F.xxhash64(F.lit(seed + 3), own["doc_id"], "taken.epoch")
    out = rows.select(
        *[(text if c == "text" else own[c]).alias(c) for c in docs.columns],
        F.col("taken.shard").alias("shard"),
        F.col("taken.epoch").alias("epoch"),
        F.col("taken.words").alias("words"),
        key.alias("order_key"),
    )
    return out.repartitionByRange("shard", "order_key").sortWithinPartitions("shard", "order_key")


def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text")
    taken = F.aggregate("mix.draws", F.lit(0).cast("long"), lambda a, x: a + x["words"])
    return assign(docs).select("doc_id", "mix.size", "mix.source_size", "mix.target", taken.alias("taken"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixed documents in training order."""
    return mixture(docs)
