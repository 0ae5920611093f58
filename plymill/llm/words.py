"""Words of whole texts, hashed a slice of documents at a time.

A word is a longest run of ``[^\\x20\\x09-\\x0D]``.  All functions take the bytes of
many documents at once and stay in numpy; nothing loops over words in Python.
Hashes have 64 bits and depend on the bytes alone, so every task agrees.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
SLICE_ROWS = 30_000

_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


class _Tables(list):
    """Kept by each process for itself: never pickled with a function."""

    def __reduce__(self):
        return _Tables, ()


_powers = _Tables()


def _power_tables(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base modulo 2^64 and of its inverse, at least ``size`` of each."""
    if not _powers or len(_powers[0]) < size:
        size = max(size, SLICE_BYTES + 1)
        tables = []
        for base in (_BASE, _INVERSE):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            tables.append(np.cumprod(table, dtype=np.uint64))
        _powers[:] = tables
    return _powers[0], _powers[1]


def mix(values: np.ndarray, salt: int = 0) -> np.ndarray:
    """Spread the bits of 64-bit values; another salt gives another random order."""
    x = values + np.uint64(salt * 0x632BE59BD9B4E019 & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def spans(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of ``values[start:end]`` for each pair, from one running sum."""
    power, inverse = _power_tables(len(values) + 1)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * power[: len(values)], out=total[1:])
    found = (total[ends] - total[starts]) * inverse[starts]
    return mix(found + (ends - starts).astype(np.uint64))


@dataclass
class Slice:
    """Some consecutive documents: ``offset[i]:offset[i + 1]`` are the words of document i."""

    rows: pa.RecordBatch
    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    offset: np.ndarray
    bounds: np.ndarray

    def column(self, name: str) -> np.ndarray:
        return self.rows.column(name).to_numpy(zero_copy_only=False)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.offset)

    def hashes(self) -> np.ndarray:
        return spans(self.data, self.start, self.end)

    def owners(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def windows(self, hashes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """First words (as positions in the slice) and hashes of all windows inside one document."""
        room = np.repeat(self.offset[1:], self.counts) - np.arange(len(hashes))
        first = np.flatnonzero(room >= width)
        return first, spans(hashes, first, first + width)


def slices(batches: Iterator[pa.RecordBatch], *, text: str = "text", lower: bool) -> Iterator[Slice]:
    """Cut batches into slices of about a megabyte; a longer document is a slice of its own."""
    for batch in batches:
        column = batch.column(text)
        if column.null_count:
            column = pc.fill_null(column, b"")
        wide = pa.types.is_large_binary(column.type) or pa.types.is_large_string(column.type)
        bounds = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
        raw = column.buffers()[2]
        data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
        row = 0
        while row < len(batch):
            stop = int(np.searchsorted(bounds, bounds[row] + SLICE_BYTES, "right")) - 1
            stop = min(max(stop, row + 1), row + SLICE_ROWS, len(batch))
            part = data[bounds[row] : bounds[stop]]
            yield _cut(batch.slice(row, stop - row), _LOWER[part] if lower else part, bounds[row : stop + 1] - bounds[row])
            row = stop


def _cut(rows: pa.RecordBatch, data: np.ndarray, bounds: np.ndarray) -> Slice:
    white = _WHITE[data]
    first, last = ~white, ~white
    first[1:] &= white[:-1]
    last[:-1] &= white[1:]
    inner = bounds[(bounds > 0) & (bounds < len(data))]
    first[inner] = ~white[inner]
    last[inner - 1] = ~white[inner - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return Slice(rows, data, start, end, np.searchsorted(start, bounds), bounds)


def shingle_sets(piece: Slice, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each document, ascending, and their offsets.

    A document with fewer words than ``width`` has its whole sequence as the only
    shingle; one without words has none.
    """
    words = piece.hashes()
    counts = piece.counts
    first, found = piece.windows(words, width)
    short = np.flatnonzero((counts > 0) & (counts < width))
    sizes = np.where(counts >= width, counts - width + 1, counts > 0)
    offset = np.concatenate([[0], np.cumsum(sizes)])
    out = np.empty(offset[-1], np.uint64)
    whole = np.zeros(len(out), bool)
    whole[offset[short]] = True
    out[~whole] = found
    out[whole] = spans(words, piece.offset[short], piece.offset[short + 1])
    for a, b in zip(offset[:-1].tolist(), offset[1:].tolist(), strict=True):
        out[a:b].sort()
    new = np.ones(len(out), bool)
    new[1:] = out[1:] != out[:-1]
    new[offset[:-1][sizes > 0]] = True
    kept = np.concatenate([[0], np.cumsum(new)])
    return out[new], kept[offset]


def digests(values: np.ndarray, offset: np.ndarray) -> np.ndarray:
    """One 64-bit digest for each run of values, whatever their order."""
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(values, 7), dtype=np.uint64)])
    size = np.diff(offset).astype(np.uint64)
    return mix(total[offset[1:]] - total[offset[:-1]] + size, 11)
