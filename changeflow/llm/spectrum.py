"""Leading eigenpairs of a symmetric matrix by spectrum slicing.

The number of eigenvalues above a shift is read off the signs of the shifted matrix's
LDLᵀ factors.  Such counts isolate each leading eigenvalue in an interval, Rayleigh
quotient iteration converges inside it, and counts on both sides certify its number.
"""

from __future__ import annotations

import numpy as np

#: The pivot bound of Bunch and Kaufman: (1 + sqrt(17)) / 8.
_ALPHA = (1 + 17**0.5) / 8
#: An interval this narrow, relative to the largest eigenvalue, is one multiple eigenvalue.
_NARROW = 1e-12


def above(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues are greater than ``shift``: positive ones of D in the LDLᵀ
    factors of ``matrix - shift * I``, pivoted symmetrically in blocks of order 1 or 2."""
    d = len(matrix)
    work = matrix - shift * np.eye(d)
    tiny = max(np.abs(matrix).max(initial=0.0), abs(shift), 1e-300) * np.finfo(float).eps
    positive = at = 0
    while at < d:
        size = _pivot(work, at)
        end = at + size
        block, below = work[at:end, at:end], work[end:, at:end]
        if size == 1:
            if abs(block[0, 0]) < tiny:
                block[0, 0] = -tiny  # the shift is an eigenvalue to working precision: not above it
            positive += int(block[0, 0] > 0)
            work[end:, end:] -= np.outer(below[:, 0], below[:, 0] / block[0, 0])
        else:
            positive += 1  # chosen only where the determinant is negative: one of each sign
            work[end:, end:] -= below @ np.linalg.solve(block, below.T)
        at = end
    return positive


def _swap(work: np.ndarray, a: int, b: int) -> None:
    if a != b:
        work[[a, b]] = work[[b, a]]
        work[:, [a, b]] = work[:, [b, a]]


def _pivot(work: np.ndarray, at: int) -> int:
    """The order of the next block, whose rows are moved to ``at``."""
    column = np.abs(work[at + 1 :, at])
    most = column.max(initial=0.0)
    if abs(work[at, at]) >= _ALPHA * most:
        return 1
    r = at + 1 + int(column.argmax())
    row = np.abs(work[r, at:])
    row[r - at] = 0
    if abs(work[at, at]) * row.max() >= _ALPHA * most**2:
        return 1
    if abs(work[r, r]) >= _ALPHA * row.max():
        _swap(work, at, r)
        return 1
    _swap(work, at + 1, r)
    return 2


def _isolated(matrix: np.ndarray, wanted: int, low: float, high: float) -> list[tuple[float, float, int, int]]:
    """Disjoint intervals ``(low, high, first, number)``, greatest first, that hold the
    ``wanted`` greatest eigenvalues: one each, or several that lie too close to be told apart."""
    narrow = _NARROW * max(abs(low), abs(high))
    waiting = [(low, high, above(matrix, low), above(matrix, high))]
    found = []
    while waiting:
        a, b, over_a, over_b = waiting.pop()
        if over_a == over_b or over_b >= wanted:
            continue
        if over_a - over_b == 1 and b - a < 0.1 * max(abs(a), abs(b)) or b - a <= narrow:
            found.append((a, b, over_b + 1, over_a - over_b))
            continue
        mid = (a + b) / 2
        over = above(matrix, mid)
        waiting += [(a, mid, over_a, over), (mid, b, over, over_b)]
    return sorted(found, key=lambda f: f[2])


def _solve(matrix: np.ndarray, shift: float, right: np.ndarray, scale: float) -> np.ndarray:
    shifted = matrix - shift * np.eye(len(matrix))
    try:
        out = np.linalg.solve(shifted, right)
    except np.linalg.LinAlgError:
        out = np.linalg.solve(shifted + scale * np.finfo(float).eps * np.eye(len(matrix)), right)
    return out


def _refined(matrix: np.ndarray, a: float, b: float, start: np.ndarray, known: np.ndarray, scale: float) -> tuple[float, np.ndarray]:
    """Rayleigh quotient iteration inside (a, b).  While the quotient is outside, the shift
    is the middle of the interval, which counts keep halving."""

    def unit(v: np.ndarray) -> np.ndarray:
        for _ in range(2):
            v = v - known @ (known.T @ v)
        return v / np.linalg.norm(v)

    v = unit(start)
    last = np.inf
    for _ in range(200):
        value = float(v @ matrix @ v)
        residual = float(np.linalg.norm(matrix @ v - value * v))
        inside = a <= value <= b
        if inside and (residual <= 4 * np.finfo(float).eps * scale or residual >= last and residual <= 1e-11 * scale):
            break
        last = residual if inside else np.inf
        if inside and residual <= (b - a):
            shift = value
        else:
            shift = (a + b) / 2
            if b - a > _NARROW * scale:
                if above(matrix, shift) > known.shape[1]:
                    a = shift
                else:
                    b = shift
        v = unit(_solve(matrix, shift, v, scale))
    return float(v @ matrix @ v), v


def leading(matrix: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` greatest eigenvalues of a positive semidefinite matrix, falling, and
    their unit eigenvectors as columns.

    Only eigenvalues above the rounding of the matrix are returned, so a matrix of lower rank
    gives fewer.  Raises if counts do not certify a number.
    """
    d = len(matrix)
    scale = float(np.abs(matrix).sum(axis=1).max(initial=0.0))
    floor = scale * d * np.finfo(float).eps * 4
    if scale == 0 or not wanted:
        return np.zeros(0), np.zeros((d, 0))
    values: list[float] = []
    vectors = np.zeros((d, 0))
    start = np.random.default_rng(11).standard_normal((d, d))
    for a, b, first, number in _isolated(matrix, min(wanted, d), floor, scale * (1 + 1e-9)):
        for k in range(number):
            value, vector = _refined(matrix, a, b, start[:, first - 1 + k], vectors, scale)
            values.append(value)
            vectors = np.column_stack([vectors, vector])
        gap = max(1e-10 * scale, b - a if number > 1 else 0.0)
        low, high = max(min(values[first - 1 :]) - gap, 0.0), max(values[first - 1 :]) + gap
        if above(matrix, high) > first - 1 or above(matrix, low) < first - 1 + number:
            raise ArithmeticError(f"eigenvalue {first} is not certified by inertia counts")
    order = np.argsort(-np.array(values), kind="stable")[:wanted]
    return np.array(values)[order], vectors[:, order]
