"""Shallot search (numpy): nearest centroids of integer vectors by bounds and a shrinking ball.

A vector remembers its nearest and its second-nearest centroid, an upper bound of the distance to the nearest and a lower bound of
the distance to all others. While the bounds are apart nothing is computed. Otherwise the distances to both remembered
centroids are taken, and the search starts from the closer one: the other centroids are scanned in order of their distance to it
and the scan ends outside the ball in which a centroid could still be among the two nearest; the ball shrinks with each find.
Bounds are doubles, rounded to the safe side; survivors are compared by exact squared distances in integers,
and of equally near centroids the one of smaller number wins.
"""

from __future__ import annotations

import numpy as np

#: Largest absolute component: squared distances of up to 64 components then fit 64 bits.
LARGEST = 1 << 27
#: Bounds are loosened by this share and this length, which is far above what rounding can lose.
_SHARE, _LENGTH = 1e-12, 1e-6


class Centroids:
    """Centroids (k, d) with what the search needs: their distances and, for each, the others by distance."""

    def __init__(self, points: np.ndarray):
        self.points = points.astype(np.int64)
        k = len(points)
        square = np.array([((self.points - p) ** 2).sum(1) for p in self.points], np.int64).reshape(k, k)
        self.apart = np.sqrt(square.astype(np.float64))
        other = np.where(np.eye(k, dtype=bool), np.inf, self.apart)
        self.order = np.argsort(other, axis=1, kind="stable")[:, :max(k - 1, 0)]
        self.half = other.min(1) / 2 if k > 1 else np.full(k, np.inf)


def moved(old: np.ndarray, new: np.ndarray) -> np.ndarray:
    """How far each centroid has moved, rounded up."""
    return np.sqrt(((new.astype(np.int64) - old) ** 2).sum(1).astype(np.float64)) * (1 + _SHARE) + np.where((new == old).all(1), 0, _LENGTH)


def begin(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """State of vectors that haven't been searched: nearest, second, upper and lower bound."""
    return np.zeros(n, np.int32), np.zeros(n, np.int32), np.full(n, np.inf), np.zeros(n)


def drift(state, shift: np.ndarray):
    """The state after the centroids moved by ``shift``: bounds give way by what they can have lost."""
    near, second, upper, lower = state
    if len(shift) < 2:
        return near, second, upper + shift[near], lower
    top = int(np.argmax(shift))
    rest = np.max(np.delete(shift, top))
    return near, second, upper + shift[near], lower - np.where(near == top, rest, shift[top])


def _square(x: np.ndarray, points: np.ndarray, which: np.ndarray) -> np.ndarray:
    diff = x - points[which]
    return np.einsum("ij,ij->i", diff, diff)


def search(x: np.ndarray, state, c: Centroids):
    """(state, number of vectors searched) after the search; ``x`` is (n, d) int64."""
    near, second, upper, lower = (a.copy() for a in state)
    k = len(c.points)
    if k == 1:
        return (np.zeros(len(x), np.int32), np.zeros(len(x), np.int32), np.full(len(x), np.inf), np.full(len(x), np.inf)), len(x)
    loose = upper * (1 + _SHARE) + _LENGTH
    todo = np.flatnonzero(~(loose < np.maximum(lower, c.half[near])))
    if len(todo):  # the upper bound made exact may settle it
        exact = np.sqrt(_square(x[todo], c.points, near[todo]).astype(np.float64))
        upper[todo] = exact
        todo = todo[~(exact * (1 + _SHARE) + _LENGTH < np.maximum(lower[todo], c.half[near[todo]]))]
    if len(todo):
        a, b = near[todo].astype(np.int64), second[todo].astype(np.int64)
        b = np.where(a == b, c.order[a, 0], b)  # not searched before: the centroid next to it
        v = x[todo]
        da, db = _square(v, c.points, a), _square(v, c.points, b)
        swap = (db < da) | ((db == da) & (b < a))
        a, b, da, db = np.where(swap, b, a), np.where(swap, a, b), np.where(swap, db, da), np.where(swap, da, db)
        start, also = a.copy(), b.copy()
        from_start = np.sqrt(da.astype(np.float64))
        live = np.arange(len(v))
        for t in range(k - 1):
            j = c.order[start[live], t]
            ball = (from_start[live] + np.sqrt(db[live].astype(np.float64))) * (1 + _SHARE) + _LENGTH
            near_enough = c.apart[start[live], j] <= ball  # else all later ones are farther out
            live, j = live[near_enough], j[near_enough]
            if not len(live):
                break
            new = also[live] != j
            some, j = live[new], j[new]
            d = _square(v[some], c.points, j)
            first = (d < da[some]) | ((d == da[some]) & (j < a[some]))
            then = ~first & ((d < db[some]) | ((d == db[some]) & (j < b[some])))
            f, r = some[first], some[then]
            b[f], db[f] = a[f], da[f]
            a[f], da[f] = j[first], d[first]
            b[r], db[r] = j[then], d[then]
        near[todo], second[todo] = a, b
        upper[todo] = np.sqrt(da.astype(np.float64))
        lower[todo] = np.sqrt(db.astype(np.float64)) * (1 - _SHARE) - _LENGTH
    return (near, second, upper, lower), len(todo)


def distances(x: np.ndarray, near: np.ndarray, c: Centroids) -> np.ndarray:
    """Squared distance of each vector to its centroid."""
    return _square(x, c.points, near)
