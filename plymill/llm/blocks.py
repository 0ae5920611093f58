"""Keys of many documents, dealt out by key in blocks instead of single rows.

A row ``(bucket, <header arrays>, owner, <entry arrays>)`` holds all entries that one
slice of documents has for one bucket of the key space.  Spark shuffles and groups
the rows; a group is a bucket, whose expected number of entries is fixed, as the number of
buckets grows with the input.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

BUCKET_ENTRIES = 2_000_000


def bucket_count(entries: int, each: int = BUCKET_ENTRIES) -> int:
    return int(max(1, -(-entries // each)))


def buckets_of(hashes: np.ndarray, n: int) -> np.ndarray:
    """Buckets by the upper bits of the hashes: 16, or 32 where there are too many buckets for 16."""
    return ((hashes >> np.uint64(48 if n <= 1 << 15 else 32)) % np.uint64(n)).astype(np.int64)


def _lists(values: np.ndarray, offset: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offset.astype(np.int32)), pa.array(values))


def deal(bucket: np.ndarray, owner: np.ndarray, header: dict, entries: dict) -> pa.RecordBatch:
    """Rows of one slice.  ``header`` has a value for each owner, ``entries`` one for each entry.

    The owners that a row names are only those with an entry in it, in ascending order.
    """
    order = np.argsort(bucket, kind="stable")
    bucket, owner = bucket[order], owner[order]
    change = np.ones(len(bucket), bool)
    change[1:] = bucket[1:] != bucket[:-1]
    row = np.concatenate([np.flatnonzero(change), [len(bucket)]])
    fresh = change.copy()
    fresh[1:] |= owner[1:] != owner[:-1]
    seen = np.concatenate([[0], np.cumsum(fresh)])
    local = seen[1:] - 1 - np.repeat(seen[row[:-1]], np.diff(row))
    columns = {"bucket": pa.array(bucket[row[:-1]].astype(np.int32))}
    columns |= {name: _lists(values[owner[fresh]], seen[row]) for name, values in header.items()}
    columns["owner"] = _lists(local.astype(np.int16), row)
    columns |= {name: _lists(values[order], row) for name, values in entries.items()}
    return pa.RecordBatch.from_pydict(columns)


def pack(bucket: np.ndarray, entries: dict) -> pa.RecordBatch:
    """Rows ``(bucket, <entry arrays>)`` of entries without owners."""
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    row = np.concatenate([np.flatnonzero(runs(bucket)), [len(bucket)]])
    columns = {"bucket": pa.array(bucket[row[:-1]].astype(np.int32))}
    return pa.RecordBatch.from_pydict(columns | {name: _lists(values[order], row) for name, values in entries.items()})


def gather(table: pa.Table, header: list[str], entries: list[str]) -> dict[str, np.ndarray]:
    """All entries of a group as flat arrays; ``owner`` counts the headers of the whole group."""
    out = {}
    for name in [*header, *entries]:
        out[name] = np.concatenate([_flat(c) for c in table.column(name).chunks] or [np.zeros(0)])
    heads = np.concatenate([_sizes(c) for c in table.column(header[0]).chunks])
    sizes = np.concatenate([_sizes(c) for c in table.column("owner").chunks])
    owner = np.concatenate([_flat(c) for c in table.column("owner").chunks]).astype(np.int64)
    base = np.concatenate([[0], np.cumsum(heads)[:-1]])
    out["owner"] = owner + np.repeat(base, sizes)
    return out


def _flat(chunk: pa.Array) -> np.ndarray:
    return chunk.flatten().to_numpy(zero_copy_only=False)


def _sizes(chunk: pa.Array) -> np.ndarray:
    return np.diff(chunk.offsets.to_numpy())


def runs(*columns: np.ndarray) -> np.ndarray:
    """True where sorted columns begin a new value."""
    new = np.ones(len(columns[0]), bool)
    new[1:] = False
    for column in columns:
        new[1:] |= column[1:] != column[:-1]
    return new


def empty(schema: pa.Schema) -> pa.Table:
    return schema.empty_table()
