"""Singular values and right directions of a small upper triangular factor.

Householder reflections make it bidiagonal, dqds finds the squared singular values to high
relative accuracy, and twisted factorisations give the directions.  Sizes are those of one
vector, never of a corpus.
"""

from __future__ import annotations

import numpy as np

EPS = np.finfo(float).eps


def bidiagonalise(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a, b, w): diagonal, superdiagonal, and the right factor with ``r = u B w.T``."""
    d = r.shape[1]
    m = np.zeros((max(d, r.shape[0]), d))
    m[: r.shape[0]] = r
    w = np.eye(d)
    for k in range(d):
        _reflect(m[k:, k:])
        if k + 2 < d:
            v = _reflect(m[k:, k + 1 :].T)
            w[:, k + 1 :] -= 2 * np.outer(w[:, k + 1 :] @ v, v)
    return np.diag(m).copy(), np.diag(m, 1).copy(), w


def _reflect(m: np.ndarray) -> np.ndarray:
    """Zero the first column of ``m`` below its head, in place; the unit vector of the reflection."""
    v = m[:, 0].copy()
    scale = np.abs(v).max(initial=0.0)
    if scale == 0 or not np.any(v[1:]):
        return np.zeros_like(v)
    v /= scale
    v[0] += np.copysign(np.linalg.norm(v), v[0])
    v /= np.linalg.norm(v)
    m -= 2 * np.outer(v, v @ m)
    m[1:, 0] = 0.0
    return v


def _step(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], float] | None:
    """One differential qd transform with a shift; None if the shift was too large."""
    new_q, new_e = [], []
    d = q[0] - shift
    least = d
    for i in range(len(e)):
        if d < 0:
            return None
        total = d + e[i]
        ratio = q[i + 1] / total if total > 0 else 0.0
        new_q.append(total)
        new_e.append(e[i] * ratio)
        d = d * ratio - shift if total > 0 else q[i + 1] - shift
        least = min(least, d)
    if d < 0:
        return None
    return [*new_q, d], new_e, least


def _pair(a: float, b: float, c: float) -> tuple[float, float]:
    """Squared singular values of [[sqrt(a), sqrt(b)], [0, sqrt(c)]], the larger first."""
    total = a + b + c
    root = np.sqrt(max((a + b - c) ** 2 + 4 * b * c, 0.0))
    large = (total + root) / 2
    return large, a * (c / large) if large > 0 else 0.0


def dqds(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared singular values of the bidiagonal matrix, largest first."""
    found: list[float] = []
    parts = [((np.square(a)).tolist(), (np.square(b)).tolist(), 0.0)]
    while parts:
        q, e, moved = parts.pop()
        least = 0.0
        while q:
            n = len(q)
            small = [i for i in range(n - 1) if e[i] <= EPS**2 * (moved + min(q[i], q[i + 1])) or e[i] == 0]
            if small:
                cut = small[-1] + 1
                parts.append((q[:cut], e[: cut - 1], moved))
                q, e, least = q[cut:], e[cut:], 0.0
                continue
            if n <= 2:
                found += [moved + x for x in ((q[0],) if n == 1 else _pair(q[0], e[0], q[1]))]
                break
            # a lower bound of the least value: what the last pair has, less what it is joined to
            last = _pair(q[-2], e[-1], q[-1])[1]
            shift = max(0.0, min(last, least if least > 0 else last) * 0.99 - 1e-3 * e[-2] if e[-2] < last else min(last, least) * 0.25)
            after = None
            for _ in range(4):
                after = _step(q, e, shift)
                if after is not None or shift == 0:
                    break
                shift *= 0.25
            if after is None:
                shift, after = 0.0, _step(q, e, 0.0)
            (q, e, least), moved = after, moved + shift
    return np.sort(np.array(found))[::-1]


def twisted(a: np.ndarray, b: np.ndarray, value: float) -> tuple[np.ndarray, float]:
    """A unit vector z with ``B.T B z`` close to ``value z``, and the value's correction.

    The factorisations from the top and from the bottom meet where the pivot is least.
    """
    n = len(a)
    tiny = EPS * max(np.abs(a).max(), np.abs(b).max(initial=0.0), 1e-150)
    a = np.where(np.abs(a) < tiny, tiny, a)
    d, low = np.square(a), b / a[:-1]
    guard = np.finfo(float).tiny / EPS
    plus, s = np.zeros(max(n - 1, 0)), np.zeros(n)
    s[0] = -value
    for i in range(n - 1):
        pivot = d[i] + s[i]
        pivot = pivot if abs(pivot) > guard else guard
        plus[i] = low[i] * d[i] / pivot
        s[i + 1] = plus[i] * low[i] * s[i] - value
    up, p = np.zeros(max(n - 1, 0)), np.zeros(n)
    p[-1] = d[-1] - value
    for i in range(n - 2, -1, -1):
        pivot = d[i] * low[i] ** 2 + p[i + 1]
        pivot = pivot if abs(pivot) > guard else guard
        up[i] = low[i] * d[i] / pivot
        p[i] = p[i + 1] * (d[i] / pivot) - value
    gamma = s + p + value
    gamma[~np.isfinite(gamma)] = np.inf
    k = int(np.argmin(np.abs(gamma)))
    z = np.zeros(n)
    z[k] = 1.0
    for i in range(k - 1, -1, -1):
        z[i] = -plus[i] * z[i + 1]
    for i in range(k, n - 1):
        z[i + 1] = -up[i] * z[i]
    size = np.linalg.norm(z)
    return z / size, gamma[k] / size**2


def right_directions(r: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(values, vectors): the largest squared singular values of ``r`` and unit right directions as columns.

    Values that are zero next to the largest one, within rounding, are left out.  Directions of
    values too close for separate factorisations are made orthogonal to each other.
    """
    a, b, w = bidiagonalise(r)
    scale = max(np.abs(a).max(initial=0.0), np.abs(b).max(initial=0.0))
    if not scale:
        return np.zeros(0), np.zeros((r.shape[1], 0))
    cuts = [0, *(np.flatnonzero(np.abs(b) <= EPS * scale * 1e-3) + 1).tolist(), len(a)]
    pairs = []
    for lo, hi in zip(cuts, cuts[1:], strict=False):
        for value in dqds(a[lo:hi], b[lo : hi - 1]):
            pairs.append((float(value), lo, hi))
    pairs.sort(key=lambda x: -x[0])
    floor = pairs[0][0] * (EPS * len(a)) ** 2 * 16
    pairs = [x for x in pairs[:most] if x[0] > floor]
    vectors = np.zeros((len(a), len(pairs)))
    for i, (value, lo, hi) in enumerate(pairs):
        own = np.zeros(len(a))
        near = [j for j in range(i) if pairs[j][1:] == (lo, hi) and pairs[j][0] - value < 1e-3 * pairs[0][0]]
        z, more = twisted(a[lo:hi], b[lo : hi - 1], value)
        if abs(more) < 1e-10 * value:
            z, _ = twisted(a[lo:hi], b[lo : hi - 1], value + more)
        own[lo:hi] = z
        own = _apart(own, vectors[:, near], a, b, value, lo, hi)
        vectors[:, i] = own
    return np.array([x[0] for x in pairs]), w @ vectors


def _apart(z: np.ndarray, others: np.ndarray, a: np.ndarray, b: np.ndarray, value: float, lo: int, hi: int) -> np.ndarray:
    """``z`` without its parts along ``others``; a random start is refined where little is left of it."""
    if not others.shape[1]:
        return z
    rng = np.random.default_rng(hi - lo)
    start = z
    for _ in range(6):
        left = start - others @ (others.T @ start)
        left -= others @ (others.T @ left)
        size = np.linalg.norm(left)
        if size > 0.1:
            return left / size
        start = np.zeros(len(z))
        start[lo:hi] = _solve(a[lo:hi], b[lo : hi - 1], value, (left[lo:hi] / size) if size > 1e-8 else rng.standard_normal(hi - lo))
    return left / size


def _solve(a: np.ndarray, b: np.ndarray, value: float, right: np.ndarray) -> np.ndarray:
    """One step of inverse iteration with ``B.T B - value``, slightly moved off the value."""
    matrix = np.diag(np.square(a) + np.append(0.0, np.square(b)))
    matrix += np.diag(a[:-1] * b, 1) + np.diag(a[:-1] * b, -1)
    moved = value * (1 + 4 * EPS) + EPS * np.abs(np.diag(matrix)).max()
    found = np.linalg.solve(matrix - moved * np.eye(len(a)), right)
    return found / np.linalg.norm(found)
