"""Embedding whitening against eigenvectors of the exact covariance."""

import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from plymill.llm import whitening
from plymill.llm.bidiagonal import bidiagonalise, dqds, right_directions
from plymill.llm.whitening import op11_embedding_whitening

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, most=8):
    """{vec_id: (x, deviation)}, n, and the values and vectors of the exactly centred covariance."""
    fine = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    x = [(i, [math.floor(1024 * float(np.float32(c))) + 100_000 for c in v]) for i, v in fine]
    n, sums = len(x), [sum(c) for c in zip(*[v for _, v in x], strict=True)]
    deviation = [(i, sum((n * c - s) ** 2 for c, s in zip(v, sums, strict=True))) for i, v in x]
    centred = np.array([[float(Fraction(n * c - s, n)) for c, s in zip(v, sums, strict=True)] for _, v in x])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    return deviation, n, centred, values[::-1][:most], vectors[:, ::-1][:, :most]


def check(frame, rows, most=8):
    deviation, n, centred, values, vectors = brute(rows, most)
    got = whitening.whiten(frame, most=most).collect()
    assert sorted((r.vec_id, r.component, r.n, r.deviation) for r in got) == sorted((i, k + 1, n, d) for i, d in deviation for k in range(len(values)))
    total = np.square(centred).sum() / n
    ids = [i for i, _ in deviation]
    for k in range(len(values)):
        mine = {r.vec_id: r for r in got if r.component == k + 1}
        white = np.array([mine[i].whitened for i in ids])
        expected = centred @ vectors[:, k] / math.sqrt(values[k])
        sign = np.sign(white @ expected)
        assert np.abs(white - sign * expected).max() < 1e-8
        assert all(r.explained == pytest.approx(values[k] / total, rel=1e-9) for r in mine.values())
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-10


def test_against_eigenvectors(spark):
    rng = np.random.default_rng(2)
    scale = np.linspace(3, 0.2, 12)
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(rng.standard_normal((400, 12)) * scale)]
    bad = [(900, None), (901, [None] + [1.0] * 11), (902, [float("nan")] * 12), (903, [1.0] * 11 + [float("inf")])]
    frame = spark.createDataFrame([(i, v, 1) for i, v in rows + bad], SCHEMA).repartition(7)
    check(frame, rows + bad)
    crowded = frame.withColumns({c: F.lit(3) for c in ("x", "task", "n", "component", "part", "id", "s")})
    check(crowded, rows + bad)


def test_more_tasks_than_one_fold(spark, monkeypatch):
    monkeypatch.setattr(whitening, "FAN", 2)
    monkeypatch.setattr(whitening, "BLOCK", 5)
    rng = np.random.default_rng(3)
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(rng.standard_normal((200, 5)) * [9, 4, 2, 1, 0.5])]
    check(spark.createDataFrame([(i, v, 1) for i, v in rows], SCHEMA).repartition(11), rows)


def test_degenerate(spark):
    def out(rows):
        return whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()

    assert out([]) == [] and out([(1, None, 1)]) == [] and out([(1, [1.0, 2.0], 1)] * 4) == [] and out([(1, [], 1), (2, [], 1)]) == []
    rank_one = out([(i, [float(i), 2.0 * i, 5.0], 1) for i in range(50)] + [(99, [1.0], 1)])
    assert {r.component for r in rank_one} == {1} and len(rank_one) == 50
    assert all(r.explained == pytest.approx(1) for r in rank_one)
    copies = out([(1, [0.0, 1.0], 1), (1, [0.0, 1.0], 1), (None, [1.0, 0.0], 1), (2, [1.0, 0.5], 1)])
    assert len(copies) == 8 and {r.n for r in copies} == {4}
    huge = out([(i, [1e9 * i, float(i % 3)], 1) for i in range(40)])
    assert len(huge) == 80 and all(r.deviation is None or r.deviation >= 0 for r in huge) and any(r.deviation is None for r in huge)


def test_same_components_in_any_layout(spark):
    rng = np.random.default_rng(5)
    frame = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(rng.standard_normal((300, 6)) * [6, 5, 4, 3, 2, 1])], SCHEMA)
    one, two = ({(r.vec_id, r.component): r.whitened for r in whitening.whiten(frame.repartition(p)).collect()} for p in (1, 6))
    assert one.keys() == two.keys() and all(abs(one[k] - two[k]) < 1e-10 for k in one)


@pytest.mark.parametrize("kind", ["plain", "graded", "equal", "rank", "zero", "wide", "clusters"])
def test_solver(kind):
    rng = np.random.default_rng(1)
    x = rng.standard_normal((120, 24))
    if kind == "graded":
        x = x * np.logspace(0, -8, 24)
    elif kind == "equal":
        x = np.linalg.qr(x)[0]
    elif kind == "rank":
        x = x[:, :5] @ rng.standard_normal((5, 24))
    elif kind == "zero":
        x[:, 3], x[:, 7] = 0, x[:, 8]
    elif kind == "wide":
        x = x[:6]
    elif kind == "clusters":
        x = np.linalg.qr(x)[0] * np.repeat([5, 3, 3 + 1e-9, 1, 1e-3, 1e-9], 4) @ np.linalg.qr(rng.standard_normal((24, 24)))[0]
    exact = np.linalg.svd(x, compute_uv=False)
    r = np.linalg.qr(x, mode="r")
    a, b, w = bidiagonalise(r)
    assert np.allclose(w.T @ w, np.eye(24), atol=1e-13)
    assert np.abs(np.sqrt(dqds(a, b))[: len(exact)] - exact).max() < 1e-13 * exact[0]
    values, vectors = right_directions(r, 24)
    assert {"rank": 5, "wide": 6, "zero": 22}.get(kind, 24) == len(values)
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-12
    assert np.abs(r.T @ (r @ vectors) - vectors * values).max() < 1e-13 * values[0]


def test_query(spark, small):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{small}/embeddings.parquet").select("vec_id", "embedding").collect()]
    got = op11_embedding_whitening(spark, small)
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    check(spark.read.parquet(f"{small}/embeddings.parquet"), rows)
    assert got.count() == 8 * len(rows)
