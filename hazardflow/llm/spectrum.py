"""Leading eigenpairs of a symmetric matrix by spectrum slicing.

A factorisation L D L' of V - s I has as many positive pivots as V has eigenvalues above s. Such counts
bisect the axis until an eigenvalue stands alone between two shifts; Rayleigh quotient iteration then
converges cubically to it and its vector, and two more counts certify its number. Eigenvalues that
no shift of double precision can part count as equal, and get vectors orthogonal to each other.
"""

from __future__ import annotations

import numpy as np

EPS = np.finfo(float).eps
#: Growth bound of the pivoting strategy, (1 + sqrt 17) / 8. Fixed value.
ALPHA = (1 + 17**0.5) / 8


def _swap(a: np.ndarray, i: int, j: int) -> None:
    if i != j:
        a[[i, j]] = a[[j, i]]
        a[:, [i, j]] = a[:, [j, i]]


def count_above(matrix: np.ndarray, shift: float) -> int:
    """Number of eigenvalues above ``shift``: positive pivots of L D L' with 1x1 and 2x2 blocks."""
    a = matrix - shift * np.eye(len(matrix))
    found = 0
    while len(a):
        below = np.abs(a[1:, 0])
        top = abs(a[0, 0])
        width = 1
        if len(below) and below.max() > 0:
            at = 1 + int(below.argmax())
            largest = below[at - 1]
            if top < ALPHA * largest:
                others = np.abs(a[at])
                others[at] = 0
                reach = others.max()
                if top * reach < ALPHA * largest * largest:
                    if abs(a[at, at]) >= ALPHA * reach:
                        _swap(a, 0, at)
                    else:
                        _swap(a, 1, at)
                        width = 2
        elif top == 0:
            a = a[1:, 1:]
            continue
        if width == 1:
            found += a[0, 0] > 0
            side = a[1:, 0]
            a = a[1:, 1:] - np.outer(side / a[0, 0], side)
        else:
            block, side = a[:2, :2], a[2:, :2]
            determinant = block[0, 0] * block[1, 1] - block[0, 1] * block[1, 0]
            found += 1 if determinant < 0 else 2 * (block[0, 0] > 0)
            turned = np.array([[block[1, 1], -block[0, 1]], [-block[1, 0], block[0, 0]]]) / determinant
            a = a[2:, 2:] - side @ turned @ side.T
    return int(found)


class _Axis:
    """Shifts counted so far."""

    def __init__(self, matrix: np.ndarray):
        self.matrix = matrix
        self.size = max(float(np.abs(matrix).sum(axis=1).max()), np.finfo(float).tiny)
        self.least = 8 * len(matrix) * EPS * self.size
        self.counts = {-self.size - self.least: len(matrix), self.size + self.least: 0}

    def count(self, shift: float) -> int:
        if shift not in self.counts:
            self.counts[shift] = count_above(self.matrix, shift)
        return self.counts[shift]

    def bracket(self, k: int) -> tuple[float, float]:
        """Closest counted shifts with eigenvalue ``k`` (from 1, falling) between them."""
        return max(s for s, c in self.counts.items() if c >= k), min(s for s, c in self.counts.items() if c < k)

    def isolated(self, k: int) -> bool:
        low, high = self.bracket(k)
        return self.counts[low] == k and self.counts[high] == k - 1


def _solve(matrix: np.ndarray, shift: float, x: np.ndarray, least: float) -> np.ndarray:
    shifted = matrix - shift * np.eye(len(matrix))
    try:
        y = np.linalg.solve(shifted, x)
    except np.linalg.LinAlgError:
        y = np.linalg.solve(shifted + least * np.eye(len(matrix)), x)
    return y if np.isfinite(y).all() else x


def _unit(x: np.ndarray, apart_from: np.ndarray) -> np.ndarray:
    for _ in range(2):
        x = x - apart_from @ (apart_from.T @ x)
        x = x / np.linalg.norm(x)
    return x


def _iterate(axis: _Axis, k: int, found: np.ndarray, rnd: np.random.Generator) -> tuple[float, np.ndarray] | None:
    """Rayleigh quotient iteration from the bracket's middle; None if it leaves the bracket."""
    v, (low, high) = axis.matrix, axis.bracket(k)
    x = _unit(rnd.standard_normal(len(v)), found)
    for _ in range(3):
        x = _unit(_solve(v, (low + high) / 2, x, axis.least), found)
    best = None
    for _ in range(12):
        value = float(x @ (v @ x))
        if not low - axis.least <= value <= high + axis.least:
            return None
        residual = float(np.linalg.norm(v @ x - value * x))
        if best is not None and residual >= best[0] / 2:
            break
        if best is None or residual < best[0]:
            best = residual, value, x
        x = _unit(_solve(v, value, x, axis.least), found)
    residual, value, x = best if best is not None else (np.inf, 0.0, x)
    if residual > 64 * axis.least and high - low > axis.least:
        return None
    reach = residual + axis.least
    return (value, x) if axis.count(value - reach) >= k > axis.count(value + reach) else None


def leading(matrix: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``most`` greatest eigenvalues, falling, and their unit vectors as columns; all if there are fewer."""
    most = min(most, len(matrix))
    axis, rnd = _Axis(matrix), np.random.default_rng(1)
    values, vectors = [], np.zeros((len(matrix), 0))
    for k in range(1, most + 1):
        pair = None
        while pair is None:
            low, high = axis.bracket(k)
            if axis.isolated(k) or high - low <= axis.least:
                pair = _iterate(axis, k, vectors, rnd)
                if pair is None and high - low <= axis.least:
                    # parted by no shift: any vector of what is left of the eigenspace
                    x = _unit(rnd.standard_normal(len(matrix)), vectors)
                    for _ in range(6):
                        x = _unit(_solve(matrix, (low + high) / 2, x, axis.least), vectors)
                    pair = float(x @ (matrix @ x)), x
            if pair is None:
                middle = (low + high) / 2
                axis.count(middle)
        values.append(pair[0])
        vectors = np.column_stack([vectors, pair[1]])
    return np.array(values), vectors
