"""Cutting-stock column generation over a histogram of lengths (numpy, size bounded by the window)."""

from __future__ import annotations

import numpy as np

#: The linear program is solved until its value is within this share of a lower bound on it.
GAP = 0.01
#: Columns are priced at duals moved by this share towards those of the best bound, which steadies them.
SMOOTH = 0.8
_PIVOT = 1e-7
_DRIFT = 1e-7  # the basis is inverted anew where rounding has moved the solution by more


def _knapsack(sizes: np.ndarray, worth: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Unbounded knapsack by dynamic programming over the room, ``sizes`` ascending: the best value of each room
    and the item taken last there (-2: one unit stays empty)."""
    best, last = np.zeros(window + 1), np.full(window + 1, -1)
    reach = np.searchsorted(sizes, np.arange(window + 1), "right")
    for room in range(1, window + 1):
        best[room], last[room] = best[room - 1], -2
        n = reach[room]
        if n:
            got = best[room - sizes[:n]] + worth[:n]
            k = int(got.argmax())
            if got[k] > best[room] + 1e-12:
                best[room], last[room] = got[k], k
    return best, last


def _traced(sizes: np.ndarray, last: np.ndarray, room: int) -> np.ndarray:
    """Copies of each item in the best filling of ``room``."""
    copies = np.zeros(len(sizes), np.int64)
    while room > 0:
        if last[room] == -2:
            room -= 1
        else:
            copies[last[room]] += 1
            room -= sizes[last[room]]
    return copies


def best_pattern(lengths: np.ndarray, value: np.ndarray, window: int) -> tuple[float, np.ndarray]:
    """The multiset of lengths that fits the window with the largest value, as (value, copies of each length)."""
    order = np.argsort(lengths)
    best, last = _knapsack(lengths[order], value[order], window)
    copies = np.zeros(len(lengths), np.int64)
    copies[order] = _traced(lengths[order], last, window)
    return float(best[window]), copies


def first_fit(lengths: np.ndarray, demand: np.ndarray, window: int) -> list[tuple[np.ndarray, int]]:
    """Patterns that serve the demand greedily: each takes the longest lengths still open that fit, and is repeated
    while all of it is open. (copies of each length, times)."""
    open_, found = demand.astype(np.int64).copy(), []
    while open_.any():
        copies, room = np.zeros(len(lengths), np.int64), window
        for k in np.flatnonzero(open_)[::-1]:
            if lengths[k] <= room:
                copies[k] = min(open_[k], room // lengths[k])
                room -= copies[k] * lengths[k]
                if not room:
                    break
        some = copies > 0
        times = int((open_[some] // copies[some]).min())
        open_ -= times * copies
        found.append((copies, times))
    return found


def _held(rows: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The lengths that each pattern holds, as places (those it doesn't hold come last, with 0 copies), and their copies."""
    item = np.argsort(rows == 0, axis=1, kind="stable")[:, :width]
    return item, np.take_along_axis(rows, item, 1)


def patterns(lengths: np.ndarray, demand: np.ndarray, window: int, max_columns: int | None = None,
             gap: float = GAP, columns_a_round: int = 64) -> list[tuple[np.ndarray, float]]:
    """A basic solution of: least number of windows, each filled by a pattern, that covers the demand; lengths ascend.

    The first basis repeats one length each, and the first columns to come in are those of ``first_fit``. Each round
    one knapsack at smoothed dual values (at the plain ones where that finds nothing) prices the best pattern around every length; up to
    ``columns_a_round`` that improve join the pool, and pool columns are pivoted in while any improves. value / (worth of the best pattern) is a lower bound on the program,
    as are the lengths' sum and the number of lengths over half a window. It ends when the value is within ``gap`` of the best bound
    seen, or no pattern improves, or ``max_columns`` (none: without such a limit) have come in. Returns (copies per length, uses).
    """
    m = len(lengths)
    if not m:
        return []
    repeat = window // lengths
    columns, inverse = np.diag(repeat).astype(float), np.diag(1.0 / repeat)
    # a little more of each length, so that no step of the simplex method has length 0
    goal = demand + 1e-6 * (1 + np.arange(m) * 0.6180339887 % 1)
    uses, dual = goal / repeat, 1.0 / repeat
    # a pattern holds no more different lengths than the shortest ones that fit together; the pool keeps the held ones alone
    width = max(1, int(np.searchsorted(np.cumsum(lengths), window, "right")))
    item, held = _held(np.array([c for c, _ in first_fit(lengths, demand, window)], float).reshape(-1, m), width)
    bound = max(float(lengths @ demand) / window, float(demand[2 * lengths > window].sum()))
    pivots, centre = 0, None
    while True:
        while True:
            gain = (dual[item] * held).sum(1) - 1
            worth = np.argsort(-gain, kind="stable")[:columns_a_round]
            worth = worth[gain[worth] > _PIVOT]
            if not len(worth):
                break
            while True:
                gain = (dual[item[worth]] * held[worth]).sum(1) - 1
                pick = int(gain.argmax())
                if gain[pick] <= _PIVOT:
                    break
                some, copies = item[worth[pick]], held[worth[pick]]
                step = (inverse[:, some] * copies).sum(1)
                ok = step > 1e-9
                ratio = np.full(m, np.inf)
                ratio[ok] = uses[ok] / step[ok]
                out = int(ratio.argmin())
                grown = ratio[out]
                uses -= grown * step
                np.maximum(uses, 0, out=uses)
                uses[out] = grown
                columns[:, out] = 0
                columns[some, out] = copies
                row = inverse[out] / step[out]
                dual = dual - gain[pick] * row
                step[out] -= 1
                r, c = np.flatnonzero(np.abs(step) > 1e-14), np.flatnonzero(np.abs(row) > 1e-14)
                if 4 * len(r) * len(c) < m * m:
                    inverse[np.ix_(r, c)] -= np.multiply.outer(step[r], row[c])
                else:
                    inverse -= np.multiply.outer(step, row)
                pivots += 1
                if pivots % 500 == 0 and (np.abs((columns * uses).sum(1) - goal).max() > _DRIFT * goal.max()
                                          or np.abs((columns * dual[:, None]).sum(0) - 1).max() > _DRIFT):
                    inverse = np.linalg.inv(columns)
                    uses, dual = np.maximum(inverse @ goal, 0), inverse.sum(0)
        centre = dual if centre is None else centre
        for share in (SMOOTH, 0.0):
            at = share * centre + (1 - share) * dual
            best, last = _knapsack(lengths, at, window)
            reached = float(goal @ at) / max(best[window], 1.0)
            if reached > bound:
                bound, centre = reached, at
            around, new = at + best[window - lengths], {}
            for k in np.argsort(-around, kind="stable")[:columns_a_round]:
                copies = _traced(lengths, last, int(window - lengths[k]))
                copies[k] += 1
                if dual @ copies > 1 + _PIVOT:
                    new[copies.tobytes()] = copies
            if new:
                break
        if not new or uses.sum() <= (1 + gap) * bound or (max_columns is not None and pivots >= max_columns):
            break
        # no pattern of the pool prices above 1 now, so no new one is among them
        more = _held(np.array(list(new.values()), float), width)
        item, held = np.concatenate([item, more[0]]), np.concatenate([held, more[1]])
    return [(columns[:, k].astype(np.int64), float(uses[k])) for k in range(m) if uses[k] > 1e-5]


def plan(histogram: dict[int, int], window: int, max_padding: int, max_columns: int | None = None, gap: float = GAP):
    """Whole uses of the patterns. Returns (allocations, left, sequences): an allocation (length, lo, hi, copies,
    sequence, offset) gives the documents of a length with rank in [lo, hi) to sequences from
    ``sequence`` on, ``copies`` in each, the first at ``offset``; ``left`` has the rank from which a
    length is left over.

    The program's uses are rounded down, and its patterns, those with the largest rest first, are used again while what is open
    allows; the program is then solved anew for what is open, until none of its patterns can be used
    whole. Patterns that leave more than ``max_padding`` of the window empty aren't used."""
    lengths = np.array(sorted(histogram), np.int64)
    demand = np.array([histogram[int(x)] for x in lengths], np.int64)
    given, sequence, allocations = np.zeros(len(lengths), np.int64), 0, []
    while True:
        open_ = np.flatnonzero(demand > given)
        found = patterns(lengths[open_], (demand - given)[open_].astype(float), window, max_columns, gap)
        found = [(c, u) for c, u in found if window - int(c @ lengths[open_]) <= max_padding]
        whole = sorted(found, key=lambda p: (-int(p[1] + 1e-4), p[0].tolist()))
        again = sorted(found, key=lambda p: (int(p[1] + 1e-4) - p[1], p[0].tolist()))
        before = sequence
        for copies, limit in [(c, int(u + 1e-4)) for c, u in whole] + [(c, None) for c, _ in again]:
            some = np.flatnonzero(copies)
            times = int(((demand - given)[open_[some]] // copies[some]).min())
            times = times if limit is None else min(times, limit)
            if not times:
                continue
            offset = 0
            for k in some[::-1]:
                at, n = open_[k], int(copies[k])
                allocations.append((int(lengths[at]), int(given[at]), int(given[at] + n * times), n, sequence, offset))
                given[at] += n * times
                offset += n * int(lengths[at])
            sequence += times
        if sequence == before:
            break
    return allocations, {int(x): int(g) for x, g in zip(lengths, given, strict=True)}, sequence
