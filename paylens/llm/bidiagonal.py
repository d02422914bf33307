"""Singular values and right singular vectors of a square matrix: bidiagonalisation, dqds, twisted factorisations.

A matrix R becomes an upper bidiagonal B by Householder reflections from both sides. The squares of B's entries are a *qd array*
(q_i = b_ii**2, e_i = b_i,i+1**2), of which dqds finds the eigenvalues of B'B to high relative accuracy. The eigenvector of one of
them comes from the twisted factorisation of B'B minus the eigenvalue: the forward and the backward qd transform meet
at the row with the smallest pivot. Vectors of eigenvalues that are nearly equal are made orthogonal within their group.
"""

from __future__ import annotations

import numpy as np

EPS = float(np.finfo(np.float64).eps)
#: A coupling below this share of the diagonal is none; relative, for squares of entries.
SMALL = (16 * EPS) ** 2
#: Eigenvalues with a smaller relative gap form a group.
GAP = 1e-3


def _reflector(x: np.ndarray) -> tuple[np.ndarray, float]:
    """Unit vector of the Householder reflection that maps x to a multiple of the first axis, and that multiple."""
    norm = float(np.sqrt(x @ x))
    if norm == 0 or len(x) == 1:
        return np.zeros(len(x)), float(x[0])
    v = x.copy()
    alpha = -np.copysign(norm, x[0])
    v[0] -= alpha
    return v / np.sqrt(v @ v), float(alpha)


def bidiagonalise(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(diagonal, superdiagonal, V): matrix = U B V' for some orthogonal U."""
    a = np.array(matrix, np.float64)
    n = len(a)
    v = np.eye(n)
    for k in range(n):
        u, a[k, k] = _reflector(a[k:, k])
        a[k + 1:, k] = 0
        a[k:, k + 1:] -= 2 * np.outer(u, u @ a[k:, k + 1:])
        if k + 1 < n:
            w, a[k, k + 1] = _reflector(a[k, k + 1:])
            a[k, k + 2:] = 0
            a[k + 1:, k + 1:] -= 2 * np.outer(a[k + 1:, k + 1:] @ w, w)
            v[:, k + 1:] -= 2 * np.outer(v[:, k + 1:] @ w, w)
    return np.diag(a).copy(), np.diag(a, 1).copy(), v


def _transform(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], float]:
    """One dqds transform: the new array and its least pivot; negative or NaN if the shift was too large."""
    out_q, out_e = [], []
    d = least = q[0] - shift
    for i, coupling in enumerate(e):
        pivot = d + coupling
        if not pivot > 0:
            return q, e, float("nan")
        ratio = q[i + 1] / pivot
        out_q.append(pivot)
        out_e.append(coupling * ratio)
        d = d * ratio - shift
        least = min(least, d)
    out_q.append(d)
    return out_q, out_e, least


def _last_two(q: list[float], e: list[float]) -> float:
    """The smaller eigenvalue of the last two rows of BB', a guess of the smallest one of all."""
    a, b, c = q[-2] + e[-1], q[-1], e[-1] * q[-1]
    larger = (a + b) / 2 + np.sqrt(((a - b) / 2) ** 2 + c)
    return (a * b - c) / larger if larger > 0 else 0.0


def dqds(q: np.ndarray, e: np.ndarray) -> np.ndarray:
    """Eigenvalues of B'B, descending, from its qd array with positive q.

    Shifts are a guess from the end of the array. Where one turns out too large, the transform is repeated with a smaller one, at last with
    none, which cannot fail. The array splits wherever a coupling has become negligible.
    """
    found: list[float] = []
    stack = [(list(map(float, q)), list(map(float, e)), 0.0)]
    while stack:
        q, e, total = stack.pop()
        if not e:
            found += [x + total for x in q]
            continue
        for _ in range(100 * len(q) + 1000):
            split = next((i for i in reversed(range(len(e))) if e[i] <= SMALL * (total + min(q[i], q[i + 1]))), None)
            if split is not None:
                stack += [(q[:split + 1], e[:split], total), (q[split + 1:], e[split + 1:], total)]
                break
            if q[0] < q[-1]:
                # small entries belong at the end
                q, e = q[::-1], e[::-1]
            shift = max(0.0, min(_last_two(q, e), *q) * (1 - 1e-10))
            for attempt in range(5):
                new_q, new_e, least = _transform(q, e, shift)
                if least >= 0:
                    break
                # a negative last pivot tells how much was too much
                shift = 0.0 if attempt == 3 else max(0.0, (shift + least) * 0.99) if least < 0 and attempt == 0 else shift / 4
            q, e, total = new_q, new_e, total + shift
        else:
            raise ArithmeticError("dqds does not converge")
    return np.sort(np.maximum(found, 0.0))[::-1]


def _twist(pivots: np.ndarray, low: np.ndarray, value: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of LDL' minus ``value``: multipliers from above and from below, and the pivot of the twist at each row."""
    n = len(pivots)
    above, below = np.zeros(n - 1), np.zeros(n - 1)
    s, p = np.empty(n), np.empty(n)
    tiny = EPS * EPS * float(pivots.max())
    s[0] = -value
    for i in range(n - 1):
        d = s[i] + pivots[i]
        above[i] = pivots[i] * low[i] / (d if abs(d) > tiny else tiny)
        s[i + 1] = above[i] * low[i] * s[i] - value
    p[-1] = pivots[-1] - value
    for i in reversed(range(n - 1)):
        d = pivots[i] * low[i] ** 2 + p[i + 1]
        t = pivots[i] / (d if abs(d) > tiny else tiny)
        below[i] = low[i] * t
        p[i] = p[i + 1] * t - value
    return above, below, s + p + value


def _vector(above: np.ndarray, below: np.ndarray, row: int) -> np.ndarray:
    """Unit vector of the twist at ``row``."""
    z = np.zeros(len(above) + 1)
    z[row] = 1
    for i in reversed(range(row)):
        z[i] = -above[i] * z[i + 1]
    for i in range(row, len(below)):
        z[i + 1] = -below[i] * z[i]
    return z / np.sqrt(z @ z)


def vectors(diagonal: np.ndarray, upper: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Columns: unit eigenvectors of B'B for its descending eigenvalues, orthogonal also where these are nearly equal."""
    pivots, low = diagonal ** 2, upper / diagonal[:-1]
    out = np.zeros((len(diagonal), len(values)))
    group = 0
    # what is zero but for rounding is one group, whatever its ratios
    zero = (len(diagonal) * EPS) ** 2 * values.max(initial=0)
    for j, value in enumerate(values):
        if j and values[j - 1] - value > GAP * values[j - 1] and values[j - 1] > zero:
            group = j
        above, below, twists = _twist(pivots, low, float(value))
        mates = out[:, group:j]
        for row in np.argsort(np.abs(twists), kind="stable"):
            z = _vector(above, below, int(row))
            for _ in range(2):
                z = z - mates @ (mates.T @ z)
            norm = float(np.sqrt(z @ z))
            # what its mates hold already is no new direction: the next twist
            if norm > 0.1:
                break
        out[:, j] = z / norm
    return out


def right_singular(matrix: np.ndarray, k: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """All singular values, descending, and the first ``k`` right singular vectors as columns (all by default)."""
    n = len(matrix)
    scale = float(np.abs(matrix).max(initial=0))
    if scale == 0:
        return np.zeros(n), np.eye(n)[:, :k]
    d, f, v = bidiagonalise(matrix / scale)
    # a zero on the diagonal would end the recurrences; so small a value changes no digit of the others
    d = np.where(np.abs(d) < 2.0**-200, 2.0**-200, d)
    values = dqds(d ** 2, f ** 2)
    return scale * np.sqrt(values), v @ vectors(d, f, values[:k])
