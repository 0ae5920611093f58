"""Embedding whitening by blockwise QR and a bidiagonal qd solver.

Vectors become whole numbers x (see ``grid``), so their count n and sums S are exact.  Each task centres
its rows exactly as ``(n x - S) / n`` and folds them block by block into one triangular factor;
the factors of the tasks are folded in groups of FAN until one is left, whose product with itself is n times the
covariance.  The last factor is as wide as a vector, whatever the input; Householder
reflections make it bidiagonal, dqds finds its singular values, and twisted factorisations
the directions (``bidiagonal.py``).  No product of vectors is ever summed, so small
directions keep their digits.

Rows go whose vector is null, or holds null or non-finite entries, or entries of LARGEST or more in size (they
do not fit the whole numbers), or whose length differs from the most common length of the others (ties: the longer).  Repeated rows count each time.  Components whose eigenvalue is
zero within rounding are left out, so equal vectors, a single one, or empty ones give no rows, as does an empty
table.  Equal eigenvalues have any orthonormal directions, the same for all rows.  ``deviation`` is null where it does not fit 64 bits.  Rows without ``vec_id`` take
part.  Only ``vec_id`` and ``embedding`` are read, so other columns cannot clash.
"""

from __future__ import annotations

import pickle
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plymill.llm.bidiagonal import right_directions
from plymill.llm.graphs import stored

STEPS = 1024
MOVED = 100_000
LARGEST = 2.0**40
MOST = 8
FAN = 64
BLOCK = 4096


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, x): the remaining rows as whole numbers."""
    entry = F.transform("embedding", lambda c: c.cast("double"))
    fine = F.forall(entry, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < LARGEST), F.lit(False)))
    whole = F.transform(entry, lambda c: F.floor(c * STEPS) + MOVED)
    rows = vectors.where(fine).select("vec_id", whole.alias("x"))
    sizes = rows.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("m"))
    wide = sizes.agg(F.max(F.struct("m", "d"))["d"].alias("d")).scalar()
    return rows.where(F.size("x") == wide)


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0), np.int64)


def sums(rows: DataFrame) -> tuple[int, np.ndarray]:
    """The count and the exact sum of each dimension; one number for each dimension comes back."""

    def added(batches):
        n, total = 0, None
        for batch in batches:
            if len(batch):
                x = _matrix(batch.column("x"))
                part = [sum(x[a : a + 1024, i].sum().item() for a in range(0, len(x), 1024)) for i in range(x.shape[1])]
                n, total = n + len(x), part if total is None else [a + b for a, b in zip(total, part, strict=True)]
        if n:
            rows = {"i": pa.array(range(-1, len(total)), pa.int32()), "s": pa.array([Decimal(v) for v in (n, *total)], pa.decimal128(38, 0))}
            yield pa.RecordBatch.from_pydict(rows)

    found = rows.select("x").mapInArrow(added, "i int, s decimal(38,0)").groupBy("i").agg(F.sum("s").alias("s")).collect()
    of = {r["i"]: int(r["s"]) for r in found}
    n = of.pop(-1, 0)
    total = [of[i] for i in sorted(of)]
    return n, np.array(total, object if max(map(abs, total), default=0) >> 61 else np.int64)


def centred(x: np.ndarray, n: int, total: np.ndarray) -> np.ndarray:
    """``x - S / n``, from the exact ``n x - S``."""
    if total.dtype != object and n * (int(np.abs(x).max(initial=0)) + 1) < 1 << 62:
        return (n * x - total) / n
    exact = n * x.astype(object) - total.astype(object)
    return np.array([[v / n for v in row] for row in exact], float).reshape(x.shape)


def deviations(x: np.ndarray, n: int, total: np.ndarray) -> np.ndarray:
    """Squared lengths of ``n x - S`` as whole numbers, None beyond 64 bits."""
    if total.dtype != object and n * int(np.abs(x).max(initial=0)) < 1 << 62:
        far = n * x - total
        if int(np.abs(far).max(initial=0)) ** 2 * x.shape[1] < 1 << 63:
            return np.square(far).sum(axis=1)
    exact = np.square(n * x.astype(object) - total.astype(object)).sum(axis=1)
    return np.array([v if v < 1 << 63 else None for v in exact], object)


def _folded(frame: DataFrame, fold) -> DataFrame:
    """Fold rows ``(id, part)`` in groups of FAN neighbours by id until one row is left."""

    def joined(table: pa.Table) -> pa.Table:
        parts = sorted(zip(table.column("id").to_pylist(), table.column("part").to_pylist(), strict=True))
        whole = fold([pickle.loads(p) for _, p in parts])
        return pa.table({"id": pa.array([parts[0][0] // FAN], pa.int64()), "part": pa.array([pickle.dumps(whole)], pa.binary())})

    frame = stored(frame, "parts")
    while True:
        most = frame.agg(F.max("id")).first()[0]
        frame = stored(frame.groupBy(F.expr(f"id div {FAN}")).applyInArrow(joined, "id long, part binary"), "parts")
        if not most or most < FAN:
            return frame


def _parts(rows: DataFrame, start, step) -> DataFrame:
    """(id, part): ``step`` over the matrices of each task, beginning with ``start``."""

    def made(batches):
        part, place = start, None
        for batch in batches:
            if len(batch):
                place = batch.column("task")[0].as_py()
                x = _matrix(batch.column("x"))
                for a in range(0, len(x), BLOCK):
                    part = step(part, x[a : a + BLOCK])
        if place is not None:
            yield pa.RecordBatch.from_pydict({"id": pa.array([place], pa.int64()), "part": pa.array([pickle.dumps(part)], pa.binary())})

    return rows.select("x", F.spark_partition_id().alias("task")).mapInArrow(made, "id long, part binary")


def _triangle(parts: list[np.ndarray]) -> np.ndarray:
    r = np.linalg.qr(np.concatenate(parts), mode="r")
    return r * np.where(np.diag(r) < 0, -1.0, 1.0)[: len(r), None]


def factor(rows: DataFrame, n: int, total: np.ndarray) -> np.ndarray:
    """The triangular factor of all centred rows."""

    def step(r, x):
        return _triangle([r, centred(x, n, total)])

    d = len(total)
    last = _folded(_parts(rows, np.zeros((0, d)), step), _triangle).select("part").collect()  # one square of a vector's width
    return pickle.loads(last[0][0]) if last else np.zeros((0, d))


def identity_error(rows: DataFrame, n: int, total: np.ndarray, project: np.ndarray) -> float:
    """Largest absolute entry of the whitened rows' covariance minus the identity, measured on all rows."""
    k = project.shape[1]

    def step(part, x):
        y = centred(x, n, total) @ project
        return part[0] + y.sum(axis=0), part[1] + y.T @ y

    def added(parts):
        return sum(p[0] for p in parts), sum(p[1] for p in parts)

    last = _folded(_parts(rows, (np.zeros(k), np.zeros((k, k))), step), added).select("part").first()
    mean, product = pickle.loads(last[0])
    return float(np.abs(product / n - np.outer(mean, mean) / n**2 - np.eye(k)).max())


def whiten(vectors: DataFrame, *, most: int = MOST) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) for each remaining row and component."""
    spark = vectors.sparkSession
    kind = vectors.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    rows = stored(usable(vectors.select("vec_id", "embedding")), "vectors")
    n, total = sums(rows)
    if not len(total):
        return spark.createDataFrame([], schema)
    r = factor(rows, n, total)
    squares, directions = right_directions(r, most)
    values = squares / n
    if not len(values):
        return spark.createDataFrame([], schema)
    directions = directions * np.sign(directions[np.abs(directions).argmax(axis=0), np.arange(len(values))])
    project = directions / np.sqrt(values)
    explained = squares / np.square(r).sum()
    error = identity_error(rows, n, total, project)
    k = len(values)

    def made(batches):
        for batch in batches:
            if len(batch):
                x = _matrix(batch.column("x"))
                each = np.repeat(np.arange(len(x)), k)
                yield pa.RecordBatch.from_pydict(
                    {
                        "vec_id": batch.column("vec_id").take(pa.array(each)),
                        "component": pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                        "n": pa.array(np.full(len(each), n)),
                        "deviation": pc.take(pa.array(deviations(x, n, total), pa.int64()), pa.array(each)),
                        "whitened": pa.array((centred(x, n, total) @ project).ravel()),
                        "explained": pa.array(np.tile(explained, len(x))),
                        "identity_error": pa.array(np.full(len(each), error)),
                    }
                )

    return rows.mapInArrow(made, schema)


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"))
