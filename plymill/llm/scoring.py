"""LM scoring by deleted interpolation.

Tokens are lower-cased words and one end per text.  The probability of a token after a
context mixes three estimates: its share after that context, its share of all tokens, and
an even share.  The mixture weights depend on how often the context was seen: contexts
fall into buckets by powers of two, and each bucket's weights come from
expectation-maximisation on counts of a held-out seventh of the training texts, against
estimates from the other training texts.  For that step alone, estimates are rounded to eighths of a power of two, so that
held-out tokens become a small histogram.  The final estimates use all training texts, unrounded.

A context is the word before, whatever its frequency, or the start of a text.  A word that
the training texts lack counts as a context seen 0 times.

Texts are dealt once, by whole slices, in pieces of about PIECE_TOKENS tokens.  A piece counts its own distinct words and pairs,
so a frequent pair is one entry per piece; the entries are dealt by ranges of their 56-bit keys, summed, and answered to the
pieces that asked.  Texts, keys and counts travel compressed.  A piece then has all counts of its texts at hand, first for the weights, then for
the scores.  Nothing but counts of tokens and the weights is known to all tasks.  The answers are matched by place, so ``docs``
has to give the same rows each time, as a table does.

Equal texts of a slice are one, with the list of their rows.  Null and blank texts are a lone end.
Rows without ``doc_id`` count as training; repeated rows count each time.  Without
training texts the base score is 0 and only the even share remains.  An empty table gives an empty table.  Texts are read whole, at
any length.  Only ``doc_id``, ``text`` and the given condition are read, so other columns cannot clash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from plymill.llm.graphs import small_batches
from plymill.llm.words import Slice, mix, slices, spans

PIECE_TOKENS = 1_500_000
#: Entries of a bucket of keys, about.
ENTRIES = 2_000_000
KEY_BITS = 56
END = np.uint64(0x0E0F)
START = np.uint64(0x57A7)
TEST, CORE, FOLD = 0, 1, 2
STEPS = 8
ROUNDS = 60
_NONE = -10_000


def tokens(piece: Slice) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens of a slice, ends included, and their offsets."""
    words, counts = piece.hashes(), piece.counts
    offset = piece.offset + np.arange(len(piece.offset))
    out = np.full(offset[-1], END, np.uint64)
    out[np.arange(len(words)) + np.repeat(np.arange(len(counts)), counts)] = words
    return out, offset


def digests(token: np.ndarray, offset: np.ndarray) -> np.ndarray:
    return spans(token, offset[:-1], offset[1:])


def token_totals(rows: DataFrame) -> tuple[int, int, int]:
    """Tokens of all texts, of training texts, and of training texts outside the fold."""

    def counted(batches):
        for piece in slices(batches, lower=True):
            n = piece.counts + 1
            kind = piece.column("kind")
            yield pa.RecordBatch.from_pydict({k: [int(n[own].sum())] for k, own in (("n", kind >= 0), ("train", kind != TEST), ("core", kind == CORE))})

    found = rows.select("text", "kind").mapInArrow(counted, "n long, train long, core long")
    return tuple(x or 0 for x in found.agg(F.sum("n"), F.sum("train"), F.sum("core")).first())


def packed(*arrays: np.ndarray) -> bytes:
    return pa.compress(b"".join(a.tobytes() for a in arrays), codec="zstd", asbytes=True)


def unpacked(blob: pa.Scalar, dtype: type, n: int, arrays: int = 2) -> np.ndarray:
    """The ``arrays`` arrays of ``n`` values that were packed, as rows."""
    raw = pa.decompress(blob.as_buffer(), n * arrays * np.dtype(dtype).itemsize, codec="zstd")
    return np.frombuffer(raw, dtype).reshape(arrays, n)


def _dealt(rows: DataFrame, pieces: int) -> DataFrame:
    """Slices with their piece: the distinct texts, how many core and fold rows each has, and those rows."""

    def made(batches):
        for piece in slices(batches, lower=True):
            sid = digests(*tokens(piece))
            names, first, back = np.unique(sid, return_index=True, return_inverse=True)
            kind = piece.column("kind")
            counts = [np.bincount(back[kind == k], minlength=len(names)).astype(np.int32) for k in (CORE, FOLD)]
            size = (piece.bounds[first + 1] - piece.bounds[first]).astype(np.int32)
            texts = [piece.data[a:b] for a, b in zip(piece.bounds[first].tolist(), piece.bounds[first + 1].tolist(), strict=True)]
            to = int(mix(names.sum(keepdims=True), 5)[0] % np.uint64(pieces))
            lists = [size, *counts, back.astype(np.int32)]
            lists = [pa.array([v], pa.list_(pa.int32())) for v in lists]
            lists += [pa.ListArray.from_arrays([0, len(back)], piece.rows.column(c)) for c in ("doc_id", "held_out")]
            columns = [pa.array([to], pa.int32()), pa.array([packed(*texts)], pa.binary()), *lists]
            yield pa.RecordBatch.from_arrays(columns, ["piece", "texts", "size", "core", "fold", "place", "ids", "held"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    lists = "size array<int>, core array<int>, fold array<int>, place array<int>"
    return rows.mapInArrow(made, f"piece int, texts binary, {lists}, ids array<{kind}>, held array<boolean>")


class _Keys:
    """The distinct keys of a piece, ascending, and the place of each token's key among them."""

    def __init__(self, key: np.ndarray, buckets: int):
        self.key, place = np.unique(key >> np.uint64(64 - KEY_BITS), return_inverse=True)
        self.place = place.astype(np.int32)
        self.buckets = buckets

    def asked(self, piece: int, is_word: bool, core: np.ndarray, fold: np.ndarray) -> pa.Table:
        """A row for each bucket with the gaps between its keys, and how often this piece has them in core and fold texts."""
        cuts = np.arange(1, self.buckets, dtype=np.uint64) * np.uint64((1 << KEY_BITS) // self.buckets)
        row = np.concatenate([[0], np.searchsorted(self.key, cuts), [len(self.key)]])
        sums = [np.bincount(self.place, weights=w, minlength=len(self.key)).astype(np.int32) for w in (core, fold)]
        found = []
        for bucket in np.flatnonzero(np.diff(row)).tolist():
            own = slice(row[bucket], row[bucket + 1])
            gap = np.diff(self.key[own], prepend=np.uint64(0))
            halves = gap.astype(np.uint32), (gap >> np.uint64(32)).astype(np.uint32)
            found.append((bucket, piece, is_word, own.stop - own.start, packed(*halves), packed(*(v[own] for v in sums))))
        names = ["bucket", "piece", "is_word", "size", "keys", "counts"]
        kinds = [pa.int32(), pa.int32(), pa.bool_(), pa.int32(), pa.binary(), pa.binary()]
        return pa.table({c: pa.array(v, t) for c, v, t in zip(names, zip(*found, strict=True), kinds, strict=True)})

    def answers(self, table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        """Counts of each key over all training texts, and over the fold."""
        order = np.argsort(table.column("bucket").to_numpy())
        blobs, sizes = table.column("counts"), table.column("size").to_numpy()
        if sizes.sum() != len(self.key):
            raise RuntimeError("the texts of a piece changed between two readings; write them to a table first")
        return tuple(np.concatenate([unpacked(blobs[i], np.int64, sizes[i]) for i in order.tolist()], axis=1))


class _Piece:
    """The tokens of a group of slices; ``words`` and ``pairs`` are their keys."""

    def __init__(self, table: pa.Table, buckets: int):
        self.table = table
        found = [tokens(piece) for piece in slices(self._texts(), lower=False)]
        token = np.concatenate([t for t, _ in found])
        self.size = np.concatenate([np.diff(offset) for _, offset in found])
        del found
        self.first = np.concatenate([[0], np.cumsum(self.size)[:-1]])
        before = np.empty_like(token)
        before[1:] = token[:-1]
        before[self.first] = START
        self.words = _Keys(mix(token, 9), buckets)
        self.pairs = _Keys(mix(mix(before, 3) ^ token, 5), buckets)
        self.core, self.fold = (table.column(c).combine_chunks().flatten().to_numpy() for c in ("core", "fold"))

    def _texts(self):
        for blob, size in zip(self.table.column("texts"), self.table.column("size"), strict=True):
            offset = np.concatenate([[0], np.cumsum(size.values.to_numpy())]).astype(np.int32)
            raw = pa.py_buffer(unpacked(blob, np.uint8, int(offset[-1]), 1))
            texts = pa.BinaryArray.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(offset), raw])
            yield pa.RecordBatch.from_arrays([texts], ["text"])

    def rows(self, values: dict[str, np.ndarray]) -> pa.Table:
        """Values of the texts, for each row that has the text."""
        place = self.table.column("place").combine_chunks()
        texts = np.array([len(size) for size in self.table.column("size")])
        base = np.repeat(np.cumsum(texts) - texts, np.diff(place.offsets.to_numpy()))
        at = place.flatten().to_numpy() + base
        ids, held = (self.table.column(c).combine_chunks().flatten() for c in ("ids", "held"))
        return pa.table({"doc_id": ids, "held_out": held} | {c: pa.array(v[at]) for c, v in values.items()})

    def each(self, values: np.ndarray) -> np.ndarray:
        return np.repeat(values, self.size)

    def counted(self, answers: pa.Table) -> tuple[list, list, list]:
        """Of each token (all, fold) counts: of itself, of itself after its context, and of its context."""
        is_word = answers.column("is_word")
        word = self.words.answers(answers.filter(is_word))
        pair = self.pairs.answers(answers.filter(pc.invert(is_word)))
        word, pair = ([v[keys.place] for v in found] for found, keys in ((word, self.words), (pair, self.pairs)))
        context = [np.empty_like(v) for v in word]
        for v, c in zip(word, context, strict=True):
            c[1:] = v[:-1]
            c[self.first] = v[-1]  # texts start as often as they end, and the last token is an end
        return word, pair, context

    def level(self, seen: np.ndarray) -> np.ndarray:
        """Frequency bucket of each token's context; the start has its own."""
        level = np.floor(np.log2(seen + 1.0)).astype(np.int64)
        level[self.first] = 63
        return level

    def sums(self, values: np.ndarray) -> np.ndarray:
        return np.add.reduceat(values, self.first)


def _summed(table: pa.Table) -> pa.Table:
    """Answers to all rows of a bucket; ``types``, on one row, counts the words that training texts hold."""
    heads = [table.column(c).to_numpy() for c in ("is_word", "size")]
    keys, counts = table.column("keys"), table.column("counts")
    answers: list[bytes | None] = [None] * table.num_rows
    types = 0
    for is_word in (True, False):
        own = np.flatnonzero(heads[0] == is_word).tolist()
        if not own:
            continue
        key = []
        for i in own:
            low, high = unpacked(keys[i], np.uint32, heads[1][i]).astype(np.uint64)
            key.append(np.cumsum((high << np.uint64(32)) | low))
        names, back = np.unique(np.concatenate(key), return_inverse=True)
        del key
        core, fold = np.concatenate([unpacked(counts[i], np.int32, heads[1][i]) for i in own], axis=1)
        folds = np.bincount(back, weights=fold).astype(np.int64)
        n = np.bincount(back, weights=core).astype(np.int64) + folds
        if is_word:
            types = int((n > 0).sum())
        stop = np.cumsum(heads[1][own])
        for i, a, b in zip(own, (stop - heads[1][own]).tolist(), stop.tolist(), strict=True):
            answers[i] = packed(n[back[a:b]], folds[back[a:b]])
    found = table.select(["piece", "bucket", "is_word", "size"])
    found = found.append_column("counts", pa.array(answers, pa.binary()))
    return found.append_column("types", pa.array([types] + [0] * (found.num_rows - 1), pa.int64()))


def _ratio(a: np.ndarray, b) -> np.ndarray:
    return np.divide(a, b, out=np.zeros(len(a)), where=np.asarray(b) > 0)


def learn(level: np.ndarray, p2: np.ndarray, p1: np.ndarray, p0: float, times: np.ndarray) -> np.ndarray:
    """Mixture weights of each level by expectation-maximisation, as a (64, 3) table."""
    out = np.tile([0.4, 0.5, 0.1], (64, 1))
    for b in np.unique(level):
        own = level == b
        parts, n = np.stack([p2[own], p1[own], np.full(own.sum(), p0)]), times[own]
        w = out[b]
        for _ in range(ROUNDS):
            mixed = w[:, None] * parts
            mass = (mixed / mixed.sum(axis=0) * n).sum(axis=1) + 0.5  # a little of each stays
            w = mass / mass.sum()
        out[b] = w
    return out


def with_kinds(docs: DataFrame, held_out: Column) -> DataFrame:
    """(doc_id, text, kind, held_out); the held-out seventh of the training texts is told by the text's hash."""
    test = F.coalesce(held_out, F.lit(False))
    fold = F.pmod(F.xxhash64("text"), F.lit(7)) == 3
    kind = F.when(test, TEST).when(F.coalesce(fold, F.lit(False)), FOLD).otherwise(CORE)
    return docs.select("doc_id", F.col("text").cast("binary").alias("text"), kind.cast("int").alias("kind"), test.alias("held_out"))


def scores(docs: DataFrame, held_out: Column) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for each row of ``docs``."""
    spark = docs.sparkSession
    small_batches(spark)
    rows = with_kinds(docs, held_out)
    everything, total, core = token_totals(rows)
    pieces = max(1, -(-everything // PIECE_TOKENS))
    buckets = max(1, -(-everything // ENTRIES))
    dealt = _dealt(rows, pieces)

    def asked(table: pa.Table) -> pa.Table:
        piece, number = _Piece(table, buckets), table.column("piece")[0].as_py()
        weights = [piece.each(w) for w in (piece.core, piece.fold)]
        return pa.concat_tables([piece.words.asked(number, True, *weights), piece.pairs.asked(number, False, *weights)])

    ask = "bucket int, piece int, is_word boolean, size int, keys binary, counts binary"
    answer = "piece int, bucket int, is_word boolean, size int, counts binary, types long"
    answers = dealt.groupBy("piece").applyInArrow(asked, ask).groupBy("bucket").applyInArrow(_summed, answer)

    def histogram(table: pa.Table, found: pa.Table) -> pa.Table:
        piece = _Piece(table, buckets)
        times = piece.each(piece.fold)
        use = times > 0
        word, pair, seen = (n - fold for n, fold in piece.counted(found))
        p2, p1 = _ratio(pair[use], seen[use]), word[use] / max(core, 1)
        with np.errstate(divide="ignore"):
            q = [np.where(p > 0, np.rint(np.log2(p) * STEPS), _NONE).astype(np.int64) for p in (p2, p1)]
        level = piece.level(seen)[use]
        key, back = np.unique((level * 20_001 + q[0] + 10_000) * 20_001 + q[1] + 10_000, return_inverse=True)
        n = np.bincount(back, weights=times[use], minlength=len(key)).astype(np.int64)
        types = pc.sum(found.column("types")).as_py()
        return pa.Table.from_arrays([pa.array([-1, *key.tolist()], pa.int64()), pa.array([types, *n.tolist()], pa.int64())], ["key", "n"])

    def weights(table: pa.Table) -> pa.Table:
        key, n = table.column("key").to_numpy(), table.column("n").to_numpy()
        types = int(n[key < 0].sum())
        key, n = key[key >= 0], n[key >= 0]
        order = np.argsort(key)
        key, n = key[order], n[order]
        q2, q1 = key // 20_001 % 20_001 - 10_000, key % 20_001 - 10_000
        p2, p1 = (np.where(q > _NONE, np.exp2(q / STEPS), 0.0) for q in (q2, q1))
        found = learn(key // (20_001 * 20_001), p2, p1, 1.0 / (types + 1), n)
        return pa.Table.from_pydict({"weights": [found.ravel().tolist()], "all_types": pa.array([types], pa.int64())})

    def cogrouped(other: DataFrame, made, kind: str) -> DataFrame:
        return dealt.groupBy("piece").cogroup(other.groupBy("piece")).applyInArrow(made, kind)

    # at most a few hundred steps of each estimate for each of 64 levels, whatever the input
    steps = cogrouped(answers, histogram, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    learned = steps.groupBy().applyInArrow(weights, "weights array<double>, all_types long")
    learned = learned.select(F.explode(F.sequence(F.lit(0), F.lit(pieces - 1))).alias("piece"), "weights", "all_types")
    kind = docs.schema["doc_id"].dataType.simpleString()
    result = f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, base_score double, score double"
    types = {"n_tokens": pa.int64(), "n_known": pa.int64(), "base_score": pa.float64(), "score": pa.float64()}
    nothing = pa.schema({"doc_id": to_arrow_schema(docs.select("doc_id").schema).field(0).type, "held_out": pa.bool_(), **types}).empty_table()

    def scored(table: pa.Table, found: pa.Table) -> pa.Table:
        if not table.num_rows:
            return nothing
        own = found.filter(pc.is_valid(found.column("weights")))
        mixture, types = np.array(own.column("weights")[0].as_py()).reshape(64, 3), own.column("all_types")[0].as_py()
        piece = _Piece(table, buckets)
        (word, _), (pair, _), (seen, _) = piece.counted(found.filter(pc.is_null(found.column("weights"))))
        w = mixture[piece.level(seen)]
        p = w[:, 0] * _ratio(pair, seen) + w[:, 1] * word / max(total, 1) + w[:, 2] / (types + 1)
        known, base, score = piece.sums((word > 0).astype(np.int64)), piece.sums(np.log10((word + 1) / (total + types + 1))), piece.sums(np.log10(p))
        return piece.rows({"n_tokens": piece.size, "n_known": known, "base_score": base, "score": score})

    found = cogrouped(answers.unionByName(learned, allowMissingColumns=True), scored, result)
    return found.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score")


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return scores(docs, F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(7)) == 2)
