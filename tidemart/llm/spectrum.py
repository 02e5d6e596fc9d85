"""Eigendecomposition of a sum of outer products that grows by one vector at a time, in numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

EPS = float(np.finfo(np.float64).eps)
# Roots are bracketed from the start, so that halving alone would end within these steps.
STEPS = 200


def secular_roots(poles: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The roots of 1 + sum(weights / (poles - x)), and the matrix poles[i] - root[j].

    ``poles`` rise strictly and ``weights`` are positive: one root lies above every pole, below the next one.
    Each is sought as its distance from the nearer of the two, so that small distances keep all their digits.
    A step solves the quadratic of a function with the same two poles, and halves the bracket where it
    leaves it.
    """
    k = len(poles)
    if k == 1:
        return poles + weights, -weights[:, None]
    above = np.append(poles[1:], poles[-1] + weights.sum())
    width = above - poles
    column = np.arange(k)
    f = 1 + (weights[:, None] / (poles[:, None] - poles[None, :] - width[None, :] / 2)).sum(axis=0)
    left = f >= 0
    left[-1] = True
    origin = np.where(left, column, np.minimum(column + 1, k - 1))
    low, high = np.where(left, 0.0, -width / 2), np.where(left, width / 2, 0.0)
    if f[-1] < 0:
        low[-1], high[-1] = width[-1] / 2, width[-1]
    from_origin = poles[:, None] - poles[origin][None, :]
    upper = np.where(left, width, 0.0)
    below = (column[:, None] <= column[None, :]).astype(np.float64)
    x = (low + high) / 2
    for _ in range(STEPS):
        apart = from_origin - x[None, :]
        inverse = 1 / apart
        terms = weights[:, None] * inverse
        slopes = terms * inverse
        total = terms.sum(axis=0)
        f = 1 + total
        # Poles up to the root's own give negative terms, the others positive ones.
        size = total - 2 * (terms * below).sum(axis=0)
        psi = (slopes * below).sum(axis=0)
        phi = slopes.sum(axis=0) - psi
        noise = EPS * (8 * size + 1 + np.abs(x) * (psi + phi))
        done = (np.abs(f) <= noise) | (high - low <= 2 * EPS * np.maximum(np.abs(low), np.abs(high)))
        if done.all():
            break
        low, high = np.where(f < 0, x, low), np.where(f < 0, high, x)
        one, two = apart[column, column], upper - x
        a = (one + two) * f - one * two * (psi + phi)
        b = one * two * f
        c = f - one * psi - two * phi
        with np.errstate(all="ignore"):
            root = np.sqrt(np.maximum(a * a - 4 * b * c, 0))
            step = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
            tried = x + step
        inside = (tried > low) & (tried < high)
        x = np.where(done, x, np.where(inside, tried, (low + high) / 2))
    return poles[origin] + x, from_origin - x[None, :]


def _without_equal_poles(poles, z, vectors, live, tolerance):
    """Turns pairs of (nearly) equal poles so that one of the two is left out of the update."""
    kept = []
    last = None
    for i in np.flatnonzero(live):
        if last is not None:
            size = np.hypot(z[last], z[i])
            c, s = z[i] / size, z[last] / size
            if abs((poles[i] - poles[last]) * c * s) <= tolerance:
                z[i], z[last] = size, 0.0
                one, two = vectors[:, last].copy(), vectors[:, i].copy()
                vectors[:, last], vectors[:, i] = c * one - s * two, s * one + c * two
                p, q = poles[last], poles[i]
                poles[last], poles[i] = c * c * p + s * s * q, s * s * p + c * c * q
            else:
                kept.append(last)
        last = i
    if last is not None:
        kept.append(last)
    return np.array(kept, np.int64)


def rank_one(values: np.ndarray, vectors: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rising eigenvalues and eigenvectors of ``vectors diag(values) vectors' + v v'``."""
    z = vectors.T @ v
    size = float(z @ z)
    if size == 0 or not np.isfinite(size):
        return values, vectors
    z /= np.sqrt(size)
    tolerance = 8 * EPS * max(float(np.abs(values).max()), size)
    live = size * np.abs(z) > tolerance
    index = np.flatnonzero(live)
    if not len(index):
        return values, vectors
    squares = z[index] ** 2
    close = np.diff(values[index]) * np.sqrt(squares[1:] * squares[:-1]) <= tolerance * (squares[1:] + squares[:-1])
    if close.any():
        values, vectors = values.copy(), vectors.copy()
        index = _without_equal_poles(values, z, vectors, live, tolerance)
        index = index[np.argsort(values[index], kind="stable")]
    poles, part = values[index], z[index]
    roots, apart = secular_roots(poles, size * part**2)
    # Weights that have these roots exactly: with them the vectors are orthogonal to working precision.
    between = poles[None, :] - poles[:, None]
    np.fill_diagonal(between, 1.0)
    exact = np.sqrt(np.abs(np.prod(-apart / between, axis=1))) * np.sign(part)
    turned = exact[:, None] / apart
    turned /= np.sqrt((turned * turned).sum(axis=0))
    if len(index) == len(values):
        values, vectors = roots, vectors[:, index] @ turned
    else:
        values, vectors = values.copy(), vectors.copy()
        values[index], vectors[:, index] = roots, vectors[:, index] @ turned
    if (np.diff(values) < 0).any():
        order = np.argsort(values, kind="stable")
        values, vectors = values[order], vectors[:, order]
    return values, vectors


@dataclass
class Spectrum:
    """Number and mean of vectors, and the eigensystem of the sum of their centred outer products."""

    n: int
    mean: np.ndarray
    values: np.ndarray
    vectors: np.ndarray

    @classmethod
    def empty(cls, dim: int) -> Spectrum:
        return cls(0, np.zeros(dim), np.zeros(dim), np.eye(dim))

    def add(self, x: np.ndarray) -> None:
        """One more vector: an outer product of its distance from the mean so far."""
        away = x - self.mean
        self.n += 1
        if self.n > 1:
            self.values, self.vectors = rank_one(self.values, self.vectors, away * np.sqrt((self.n - 1) / self.n))
        self.mean = self.mean + away / self.n

    def merge(self, other: Spectrum) -> None:
        """The vectors of another spectrum: an update per eigenpair of it, and one for the means."""
        if not other.n:
            return
        n = self.n + other.n
        for value, vector in zip(other.values, other.vectors.T):
            if value > 0:
                self.values, self.vectors = rank_one(self.values, self.vectors, np.sqrt(value) * vector)
        away = other.mean - self.mean
        if self.n:
            self.values, self.vectors = rank_one(
                self.values, self.vectors, away * np.sqrt(self.n / n * other.n)
            )
        self.mean = self.mean + away * (other.n / n)
        self.n = n
