"""N-gram Jaccard join: prefix filters under several global orders, then exact counts.

Two texts with similarity t share a token among the first ``n - ceil(t n) + 1`` of each, in
whatever order all tokens stand.  The orders here have three classes: tokens of one
text only, shared tokens, and the most frequent tokens.  The first class cannot link
anything, so a text whose prefix fits into it is done; most texts are.  Inside
the second class, the first order is by document frequency, the others by hashes; a
candidate has to share a prefix token in every one.

Texts with equal shingle sets are one node.  The document frequencies are exact
and come from blocks dealt by token.  Tokens found in about a fiftieth of all texts or
more (at most a hundred times the mean number of shingles per text; see ``frequent``) are
known to all tasks, so no block holds a hot token.

Groups of near copies never become all pairs: each token links its members to the one
with the fewest tokens of its own, and only pairs that are still in different
components are compared further.

Null texts, and texts without words, have no set and are linked with nothing.  Rows
without ``doc_id`` take part; the component's id is its least ``doc_id``.  Repeated rows
are nodes of equal sets.  An empty table gives an empty table.  Texts may have any length.  Other columns pass unchanged.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plymill.llm.blocks import bucket_count, buckets_of, deal, gather, runs
from plymill.llm.graphs import components, small_batches, stored
from plymill.llm.words import digests, mix, shingle_sets, slices

WIDTH = 5
THRESHOLD = 75
FREQUENT = 0.02
KEY_BITS = 48
PIVOT_ROUNDS = 3
CANDIDATE = "sid long, n long, own double, p1 array<long>, p2 array<long>, p3 array<long>, tokens array<long>"
_T_SCHEMA = "bucket int, sid array<long>, owner array<short>, high array<int>, low array<short>"
_S_SCHEMA = "bucket int, sid array<long>, owner array<short>, token array<long>, df array<int>"


def frequent(docs: DataFrame) -> list[int]:
    """Shingles in about FREQUENT or more of the texts, rarest first.

    Each slice reports the shingles that are frequent in it; one that is frequent over
    all is frequent in some slice.  The sums are at least half the limit, so the list has
    at most ``2 / FREQUENT`` times the mean number of shingles per text.
    """

    def local(batches):
        for piece in slices(batches, lower=True):
            found, offset = shingle_sets(piece, WIDTH)
            token, times = np.unique(found, return_counts=True)
            often = times >= max(8, FREQUENT * (len(offset) - 1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(token[often].view(np.int64)), pa.array(times[often].astype(np.int64))], ["token", "times"]
            )

    texts = docs.select(F.col("text").cast("binary").alias("text"))
    counted = texts.mapInArrow(local, "token long, times long").groupBy("token").agg(F.sum("times").alias("times"))
    limit = max(8, docs.count() * FREQUENT / 2)
    rows = counted.where(F.col("times") >= limit).collect()
    return [r[0] for r in sorted(rows, key=lambda r: (r[1], r[0]))]


def prefix_size(n, threshold: int = THRESHOLD):
    return n - (-(-threshold * n // 100)) + 1


def token_sets(docs: DataFrame, common: np.ndarray) -> DataFrame:
    """(doc_id, sid, n, hot): the set's digest and size, and the places of its frequent tokens."""
    order = np.argsort(common)
    ascending = common[order]

    def made(batches):
        for piece in slices(batches, lower=True):
            found, offset = shingle_sets(piece, WIDTH)
            n = np.diff(offset)
            at, hit = _places(ascending, found)
            place = order[at[hit]]
            owner = np.repeat(np.arange(len(n)), n)[hit]
            by_owner = np.lexsort((place, owner))
            bounds = np.searchsorted(owner[by_owner], np.arange(len(n) + 1)).astype(np.int32)
            sid = digests(found, offset).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    piece.rows.column("doc_id"),
                    pa.array(sid, mask=n == 0),
                    pa.array(n.astype(np.int64)),
                    pa.ListArray.from_arrays(pa.array(bounds), pa.array(place[by_owner].astype(np.int32))),
                ],
                ["doc_id", "sid", "n_shingles", "hot"],
            )

    texts = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(made, f"doc_id {kind}, sid long, n_shingles long, hot array<int>")


def _places(ascending: np.ndarray, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(ascending):
        return np.zeros(len(found), np.int64), np.zeros(len(found), bool)
    at = np.minimum(np.searchsorted(ascending, found), len(ascending) - 1)
    return at, ascending[at] == found


def _blocks(docs: DataFrame, common: np.ndarray, buckets: int) -> DataFrame:
    """All tokens but the frequent ones, dealt by token; equal sets of a slice come once."""
    ascending = np.sort(common)

    def made(batches):
        for piece in slices(batches, lower=True):
            found, offset = shingle_sets(piece, WIDTH)
            sid = digests(found, offset)
            once = np.zeros(len(sid), bool)
            once[np.unique(sid, return_index=True)[1]] = True
            owner = np.repeat(np.arange(len(sid)), np.diff(offset))
            use = once[owner] & ~_places(ascending, found)[1]
            if use.any():
                token, owner = found[use], owner[use]
                yield deal(
                    buckets_of(token, buckets),
                    owner,
                    {"sid": sid.view(np.int64)},
                    {"high": (token >> np.uint64(16)).astype(np.uint32).view(np.int32), "low": token.astype(np.uint16).view(np.int16)},
                )

    return docs.select(F.col("text").cast("binary").alias("text")).mapInArrow(made, _T_SCHEMA)


def _identity(token: np.ndarray, buckets: int) -> np.ndarray:
    """What stays of a token: its bucket and its last 48 bits."""
    return (buckets_of(token, buckets) << KEY_BITS) | (token & np.uint64((1 << KEY_BITS) - 1)).astype(np.int64)


def _shared(blocks: DataFrame, set_buckets: int) -> DataFrame:
    """Tokens of two or more sets with their number of sets, dealt by set."""
    schema = pa.schema({
        "bucket": pa.int32(), "sid": pa.list_(pa.int64()), "owner": pa.list_(pa.int16()),
        "token": pa.list_(pa.int64()), "df": pa.list_(pa.int32()),
    })

    def found(table: pa.Table) -> pa.Table:
        got = gather(table, ["sid"], ["high", "low"])
        bucket = np.int64(table.column("bucket")[0].as_py()) << np.int64(KEY_BITS)  # its last 16 bits stay
        token = (got["high"].view(np.uint32).astype(np.int64) << 16) | got["low"].view(np.uint16)
        sid = got["sid"][got["owner"]]
        order = np.lexsort((sid, token))
        token, sid = token[order], sid[order]
        first = runs(token, sid)  # equal sets of other slices
        token, sid = token[first], sid[first]
        new = runs(token)
        size = np.diff(np.append(np.flatnonzero(new), len(token)))
        df = np.repeat(size, size)
        token, sid, df = token[df > 1] | bucket, sid[df > 1], df[df > 1]
        if not len(token):
            return schema.empty_table()
        names, owner = np.unique(sid, return_inverse=True)
        order = np.argsort(owner, kind="stable")
        parts = []
        for a in range(0, len(names), 30_000):  # owners are counted in 16 bits
            lo, hi = np.searchsorted(owner[order], [a, a + 30_000])
            pick = order[lo:hi]
            to = mix(names.view(np.uint64), 3) % np.uint64(set_buckets)
            parts.append(deal(to[owner[pick]].astype(np.int64), owner[pick], {"sid": names}, {"token": token[pick], "df": df[pick].astype(np.int32)}))
        return pa.Table.from_batches(parts).select(schema.names).cast(schema)

    return blocks.groupBy("bucket").applyInArrow(found, _S_SCHEMA)


def candidates(docs: DataFrame, sets: DataFrame, common: list[int], threshold: int = THRESHOLD) -> DataFrame:
    """Sets whose prefix holds a shared token: three prefixes, and all tokens that can be shared."""
    frequent_tokens = np.array(common, np.int64).view(np.uint64)
    entries = sets.agg(F.sum("n_shingles")).first()[0] or 0
    buckets = bucket_count(entries)
    often_keys = _identity(frequent_tokens, buckets)
    dealt = _shared(_blocks(docs, frequent_tokens, buckets), buckets)
    nodes = sets.where("sid is not null").groupBy("sid").agg(F.first("n_shingles").alias("n"), F.first("hot").alias("hot"))

    def bucket_of(batches):
        for batch in batches:
            sid = batch.column("sid").to_numpy()
            bucket = mix(sid.view(np.uint64), 3) % np.uint64(buckets)
            yield pa.RecordBatch.from_arrays([pa.array(bucket.astype(np.int32)), *batch.columns], ["bucket", *batch.schema.names])

    keyed = nodes.mapInArrow(bucket_of, "bucket int, sid long, n long, hot array<int>")
    longs = pa.list_(pa.int64())
    schema = pa.schema({"sid": pa.int64(), "n": pa.int64(), "own": pa.float64(), "p1": longs, "p2": longs, "p3": longs, "tokens": longs})

    def prefixes(shared: pa.Table, known: pa.Table) -> pa.Table:
        if not known.num_rows:
            return schema.empty_table()
        sid = known.column("sid").to_numpy()
        n, hot = known.column("n").to_numpy(), known.column("hot").combine_chunks()
        hots = np.diff(hot.offsets.to_numpy())
        hot_start, hot_flat = hot.offsets.to_numpy(), hot.values.to_numpy()
        if shared.num_rows:
            got = gather(shared, ["sid"], ["token", "df"])
            rank = np.argsort(sid)
            node = rank[np.searchsorted(sid[rank], got["sid"][got["owner"]])]
            order = np.lexsort((got["token"], got["df"], node))
            token, node = got["token"][order], node[order]
        else:
            token, node = np.zeros(0, np.int64), np.zeros(0, np.int64)
        bounds = np.searchsorted(node, np.arange(len(sid) + 1))
        shared_n = np.diff(bounds)
        own = n - hots - shared_n
        room = prefix_size(n, threshold) - own
        rows = []
        for i in np.flatnonzero((room > 0) & (shared_n + hots > 0)).tolist():
            mine = token[bounds[i] : bounds[i + 1]]
            often = often_keys[hot_flat[hot_start[i] : hot_start[i + 1]]]
            width = int(room[i])
            row = {"sid": int(sid[i]), "n": int(n[i]), "own": float(own[i] / n[i]), "tokens": np.concatenate([mine, often])}
            for name, turn in (("p1", None), ("p2", 21), ("p3", 22)):
                turned = mine if turn is None else mine[np.argsort(mix(mine.view(np.uint64), turn))]
                row[name] = np.concatenate([turned, often])[:width]
            rows.append(row)
        return pa.Table.from_pylist(rows, schema) if rows else schema.empty_table()

    return dealt.groupBy("bucket").cogroup(keyed.groupBy("bucket")).applyInArrow(prefixes, CANDIDATE)


def _verified(pairs: DataFrame, found: DataFrame, threshold: int) -> DataFrame:
    """Of ``pairs(a, b)``, those that pass the other orders and then the exact count."""
    left = found.select(*[F.col(c).alias(f"{c}_a") for c in ("sid", "n", "p2", "p3")])
    right = found.select(*[F.col(c).alias(f"{c}_b") for c in ("sid", "n", "p2", "p3")])
    narrow = (
        pairs.join(left, F.col("a") == F.col("sid_a"))
        .join(right, F.col("b") == F.col("sid_b"))
        .where(
            (F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * threshold)
            & F.arrays_overlap("p2_a", "p2_b")
            & F.arrays_overlap("p3_a", "p3_b")
        )
        .select("a", "b", "n_a", "n_b")
    )
    tokens = found.select("sid", "tokens")
    whole = narrow.join(tokens, F.col("a") == tokens["sid"]).withColumnRenamed("tokens", "t_a").drop("sid")
    whole = whole.join(tokens, F.col("b") == tokens["sid"])
    both = F.size(F.array_intersect("t_a", "tokens"))
    return whole.where(both * 100 >= (F.col("n_a") + F.col("n_b") - both) * threshold).select("a", "b")


def links(found: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """(node, root): components of the candidate sets."""
    placed = found.select(F.posexplode("p1").alias("place", "token"), "sid", "own", "n")
    tokens = placed.select("token", "sid", "own", "n", (F.col("n") - F.round(F.col("own") * F.col("n")) - F.col("place")).cast("long").alias("left"))
    shared = tokens.groupBy("token").agg(F.count("*").alias("m")).where("m > 1").select("token")
    most = found.agg(F.sum(F.size("p1"))).first()[0] or 0
    rows = stored(tokens.join(shared, "token"), "prefixes", most)
    most = rows.count()  # a turn only takes rows away
    labels = None
    for turn in range(PIVOT_ROUNDS + 1):
        if labels is not None:
            known = rows.join(labels.withColumnRenamed("node", "sid"), "sid", "left")
            known = known.withColumn("root", F.coalesce("root", "sid"))
            mixed = known.groupBy("token").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x <> y")
            rows = stored(known.join(mixed.select("token"), "token"), "mixed", most)
            most = rows.count()
            if not most:
                break
        root = F.col("root") if "root" in rows.columns else F.col("sid")
        current = rows.select("token", "sid", "own", "n", "left", root.alias("root"))
        bound = None
        if turn < PIVOT_ROUNDS:
            bound = most  # a pair per row
            pivots = current.groupBy("token").agg(F.min(F.struct("own", "sid", "root", "n", "left")).alias("pivot"))
            pairs = current.join(pivots, "token").where("sid <> pivot.sid and root <> pivot.root")
            pairs = pairs.where(_can_link("", "pivot.", threshold))
            pairs = pairs.select(F.least("sid", "pivot.sid").alias("a"), F.greatest("sid", "pivot.sid").alias("b"))
            rest = pivots.select("token", "pivot.sid")
            rows = rows.join(rest, ["token", "sid"], "left_anti").drop("root")
        else:
            other = current.select("token", *[F.col(c).alias(f"o_{c}") for c in ("sid", "root", "n", "left")])
            pairs = current.join(other, "token").where("sid < o_sid and root <> o_root")
            pairs = pairs.where(_can_link("", "o_", threshold)).select(F.col("sid").alias("a"), F.col("o_sid").alias("b"))
        fresh = stored(_verified(pairs.distinct(), found, threshold), "links", bound)
        if labels is None:
            labels = components(fresh)
        elif not fresh.isEmpty():
            labels = components(fresh.union(labels.select(F.col("node").alias("a"), F.col("root").alias("b"))))
    return labels


def _can_link(one: str, two: str, threshold: int) -> Column:
    """Whether two sets can reach the threshold if this is their first common token.

    ``left`` counts the tokens of a set from this one on, in the first order; no more than
    the lesser of the two can be common.
    """
    a, b = F.col(f"{one}n"), F.col(f"{two}n")
    return F.least(f"{one}left", f"{two}left") * (100 + threshold) >= (a + b) * threshold


def near_duplicates(docs: DataFrame, *, threshold: int = THRESHOLD) -> DataFrame:
    """(doc_id, sid, n_shingles, component_id): one row per row of ``docs``."""
    small_batches(docs.sparkSession)
    common = frequent(docs)
    sets = stored(token_sets(docs, np.array(common, np.int64).view(np.uint64)), "sets")
    found = stored(candidates(docs, sets, common, threshold), "candidates")
    labels = links(found, threshold)
    nodes = sets.where("sid is not null").groupBy("sid").agg(F.min("doc_id").alias("least"))
    rooted = nodes.join(labels, nodes["sid"] == labels["node"], "left").select("sid", "least", F.coalesce("root", "sid").alias("root"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    known = rooted.join(named, "root").select(F.col("sid").alias("k_sid"), "component_id")
    return sets.join(known, sets["sid"] == known["k_sid"], "left").select(
        "doc_id", "sid", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")
    )


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return near_duplicates(docs).select("doc_id", "n_shingles", "component_id")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: the one with the least id; documents without a set all stay.

    A document is known by its ``doc_id`` here, so rows that repeat an id stay or go together.
    """
    kept = near_duplicates(docs).where("sid is null or doc_id = component_id or component_id is null")
    kept = kept.select(F.col("doc_id").alias("k_id"), F.col("sid").alias("k_sid")).distinct()
    return docs.join(kept, docs["doc_id"].eqNullSafe(kept["k_id"]), "left_semi")
