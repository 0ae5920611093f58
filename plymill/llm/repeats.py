"""Windows of words that several documents hold, found without moving all windows.

The least k-word hash of a window (its minimiser) depends on the window's words alone.  So
equal windows have equal minimisers, and only windows whose minimiser occurs in two
different texts need to be compared in full.  Minimisers are a few percent of all
positions; they are dealt by key in blocks, as are the remaining windows.

A text is told by ``sid``, the digest of its words; copies are one text here.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plymill.llm.blocks import buckets_of, deal, gather, runs
from plymill.llm.words import Slice, mix, slices, spans

_INT, _LONG = pa.int32(), pa.int64()


def text_digests(piece: Slice, words: np.ndarray) -> np.ndarray:
    return spans(words, piece.offset[:-1], piece.offset[1:])


def texts(docs: DataFrame) -> DataFrame:
    """(doc_id, sid, n_words): one row per row of ``docs``."""

    def made(batches):
        for piece in slices(batches, lower=False):
            sid = text_digests(piece, piece.hashes()).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [piece.rows.column("doc_id"), pa.array(sid), pa.array(piece.counts.astype(np.int64))], ["doc_id", "sid", "n_words"]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(made, f"doc_id {kind}, sid long, n_words long")


def minimisers(piece: Slice, words: np.ndarray, width: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First words of all windows, the position of each one's minimiser, and k-word hashes by position."""
    first, found = piece.windows(words, k)
    gram = np.zeros(len(words), np.uint64)
    gram[first] = found
    window, _ = piece.windows(words, width)
    least, best = window.copy(), gram[window]
    for step in range(1, width - k + 1):
        other = gram[window + step]
        lower = other < best
        least[lower] += step - (least[lower] - window[lower])
        best = np.minimum(best, other)
    return window, least, gram


def _anchor_blocks(docs: DataFrame, width: int, k: int, buckets: int) -> DataFrame:
    """Minimisers by bucket; 32 bits tell the keys of one apart, as a wrong match only adds windows to compare."""

    def made(batches):
        for piece in slices(batches, lower=False):
            words = piece.hashes()
            sid = text_digests(piece, words)
            _, least, gram = minimisers(piece, words, width, k)
            at = np.unique(least)
            owner = piece.owners()[at] if len(at) else at
            once = np.zeros(len(sid), bool)
            once[np.unique(sid, return_index=True)[1]] = True
            use = once[owner]
            if use.any():
                at, owner = at[use], owner[use]
                yield deal(
                    buckets_of(gram[at], buckets),
                    owner,
                    {"sid": sid.view(np.int64)},
                    {"key": gram[at].astype(np.uint32).view(np.int32), "pos": (at - piece.offset[owner]).astype(np.int32)},
                )

    kind = "bucket int, sid array<long>, owner array<short>, key array<int>, pos array<int>"
    return docs.select(F.col("text").cast("binary").alias("text")).mapInArrow(made, kind)


def _matched(blocks: DataFrame, buckets: int) -> DataFrame:
    """(sid, pos list) of the suffixes that share their first k words with another text's."""
    schema = pa.schema({"bucket": _INT, "sid": pa.list_(_LONG), "owner": pa.list_(pa.int16()), "pos": pa.list_(_INT)})

    def compared(table: pa.Table) -> pa.Table:
        got = gather(table, ["sid"], ["key", "pos"])
        sid = got["sid"][got["owner"]]
        order = np.lexsort((got["pos"], sid, got["key"]))
        key, sid, pos = got["key"][order], sid[order], got["pos"][order]
        same = ~runs(key)
        other = same & runs(sid)  # equal key, other text than the neighbour before
        run = np.cumsum(~same) - 1
        keep = np.bincount(run, weights=other, minlength=run[-1] + 1)[run] > 0
        keep &= runs(key, sid, pos)  # copies in other slices
        return _reply(sid[keep], {"pos": pos[keep]}, buckets, schema)

    def listed(table: pa.Table) -> pa.Table:
        got = gather(table, ["sid"], ["pos"])
        sid = got["sid"][got["owner"]]
        order = np.lexsort((got["pos"], sid))
        sid, pos = sid[order], got["pos"][order]
        start = np.flatnonzero(runs(sid))
        lists = pa.ListArray.from_arrays(pa.array(np.append(start, len(sid)).astype(np.int32)), pa.array(pos))
        return pa.Table.from_arrays([pa.array(sid[start]), lists], ["sid", "matched"])

    replies = blocks.groupBy("bucket").applyInArrow(compared, "bucket int, sid array<long>, owner array<short>, pos array<int>")
    return replies.groupBy("bucket").applyInArrow(listed, "sid long, matched array<int>")


def _reply(sid: np.ndarray, entries: dict, buckets: int, schema: pa.Schema) -> pa.Table:
    """Entries dealt by their text."""
    if not len(sid):
        return schema.empty_table()
    names, owner = np.unique(sid, return_inverse=True)
    order = np.argsort(owner, kind="stable")
    parts = []
    for a in range(0, len(names), 30_000):  # owners are counted in 16 bits
        lo, hi = np.searchsorted(owner[order], [a, a + 30_000])
        pick = order[lo:hi]
        to = (mix(names.view(np.uint64), 3) % np.uint64(buckets)).astype(np.int64)
        parts.append(deal(to[owner[pick]], owner[pick], {"sid": names}, {n: v[pick] for n, v in entries.items()}))
    return pa.Table.from_batches(parts).select(schema.names).cast(schema)


def _window_blocks(rows: DataFrame, width: int, k: int, buckets: int) -> DataFrame:
    """Windows of ``rows(doc_id, text, sid, matched)`` whose minimiser is matched.

    Each has the hashes of the words before and after it; 0 stands for the text's edge.
    """

    def made(batches):
        for piece in slices(batches, lower=False):
            words = piece.hashes()
            fits = text_digests(piece, words).view(np.int64) == piece.column("sid")
            matched = piece.rows.column("matched")
            flat = matched.flatten().to_numpy(zero_copy_only=False)
            sizes = matched.value_lengths().to_numpy(zero_copy_only=False)
            own = np.repeat(np.arange(len(sizes)), sizes)
            flat, own = flat[fits[own]], own[fits[own]]
            window, least, _ = minimisers(piece, words, width, k)
            marked = np.zeros(len(words) + 1, bool)
            marked[piece.offset[own] + flat] = True
            at = window[marked[least]]
            if not len(at):
                continue
            owner = piece.owners()[at]
            edge = np.concatenate([words, np.zeros(1, np.uint64)])
            before = np.where(at > piece.offset[owner], edge[at - 1] | np.uint64(1), 0)
            after = np.where(at + width < piece.offset[owner + 1], edge[np.minimum(at + width, len(words))] | np.uint64(1), 0)
            found = spans(words, at, at + width)
            yield deal(
                buckets_of(found, buckets),
                owner,
                {"sid": piece.column("sid"), "doc": piece.column("doc_id")},
                {
                    "key": found.view(np.int64),
                    "pos": (at - piece.offset[owner]).astype(np.int32),
                    "before": before.astype(np.uint32).view(np.int32),
                    "after": after.astype(np.uint32).view(np.int32),
                },
            )

    kind = "bucket int, sid array<long>, doc array<long>, owner array<short>, key array<long>, pos array<int>, before array<int>, after array<int>"
    return rows.mapInArrow(made, kind)


#: Flags of a window: the least document holds it here; all its occurrences have one word before, one word after.
FIRST, ONE_BEFORE, ONE_AFTER = 1, 2, 4


def repeated_windows(docs: DataFrame, known: DataFrame, *, width: int, k: int, buckets: int) -> DataFrame:
    """Dealt by text: all windows of ``width`` words that two texts hold, as (bucket, sid, owner, pos, key, flags).

    ``known(sid, first_id)`` names the least document of each text; ``docs(doc_id, text)``
    has no null ids.  Only the least documents are read a second time.
    """
    matched = _matched(_anchor_blocks(docs, width, k, buckets), buckets)
    named = matched.join(known, "sid").select(F.col("first_id").alias("m_id"), "sid", "matched")
    rows = docs.join(named, docs["doc_id"] == named["m_id"])
    rows = rows.select("doc_id", F.col("text").cast("binary").alias("text"), "sid", "matched")
    schema = pa.schema({"bucket": _INT, "sid": pa.list_(_LONG), "owner": pa.list_(pa.int16()), "pos": pa.list_(_INT), "key": pa.list_(_LONG), "flags": pa.list_(pa.int16())})

    def compared(table: pa.Table) -> pa.Table:
        got = gather(table, ["sid", "doc"], ["key", "pos", "before", "after"])
        sid, doc = got["sid"][got["owner"]], got["doc"][got["owner"]]
        order = np.lexsort((got["pos"], sid, doc, got["key"]))
        key, sid, doc, pos = got["key"][order], sid[order], doc[order], got["pos"][order]
        once = runs(key, sid, doc, pos)  # rows that repeat an id and a text
        order, key, sid, doc, pos = order[once], key[once], sid[once], doc[once], pos[once]
        new = runs(key)
        run, start = np.cumsum(new) - 1, np.flatnonzero(new)
        n = len(start)
        many = np.bincount(run, weights=~new & runs(sid), minlength=n)[run] > 0
        flags = np.where(doc == doc[start][run], FIRST, 0)
        for name, bit in (("before", ONE_BEFORE), ("after", ONE_AFTER)):
            word = got[name][order]
            differs = np.bincount(run, weights=word != word[start][run], minlength=n)[run] > 0
            flags |= np.where(~differs & (word[start][run] != 0), bit, 0)
        return _reply(sid[many], {"pos": pos[many], "key": key[many], "flags": flags[many].astype(np.int16)}, buckets, schema)

    dealt = _window_blocks(rows, width, k, buckets)
    kind = "bucket int, sid array<long>, owner array<short>, pos array<int>, key array<long>, flags array<short>"
    return dealt.groupBy("bucket").applyInArrow(compared, kind)


def by_text(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sorted (sid, pos, key, flags) of a group of ``repeated_windows``."""
    got = gather(table, ["sid"], ["pos", "key", "flags"])
    sid = got["sid"][got["owner"]]
    order = np.lexsort((got["pos"], sid))
    return sid[order], got["pos"][order].astype(np.int64), got["key"][order], got["flags"][order]
