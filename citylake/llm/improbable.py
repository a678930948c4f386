"""Improbable-feature digests (numpy): rare byte windows of a text in chained Bloom filters.

Every window of ``WINDOW`` bytes has an entropy in thousandths of the largest one. The rarer an entropy is in the whole
corpus, the lower is its rank. Each run of ``RUN`` consecutive windows votes for its leftmost window of least rank, and windows
with ``VOTES`` votes or more are the features. Distinct features enter Bloom filters of ``BITS`` bits in text order; a filter that holds
``CAPACITY`` features is followed by the next one.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np

_U = np.uint64
WINDOW = 16
RUN = 16
VOTES = 4
#: Where fewer windows have a vote, or that many votes, selection is widened: to all windows with a rank, or with a vote.
FEWEST = 16
BITS = 2048
PROBES = 5
CAPACITY = 160
#: Entropies below this (of 1000) carry no feature: runs of one character and the like.
LEAST_ENTROPY = 100
LEVELS = 1001
_SCALE = 1 << 20
_NONE = 1 << 10  # above every rank


def _gain(window: int) -> np.ndarray:
    """What the c-th equal byte of a window adds to the sum of c * log2(c), scaled to integers."""
    c = np.arange(window + 2, dtype=np.float64)
    return np.diff(np.concatenate([[0], np.round(c * np.log2(np.maximum(c, 1)) * _SCALE)])).astype(np.int64)


def entropies(raw: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Entropy, 0 to 1000, of each window of ``window`` consecutive bytes.

    A step to the next window takes away one byte and adds one, and the sum of c * log2(c) changes by what the counts of these two
    bytes say; the counts come from comparisons at each of ``window`` distances, in exact integers.
    """
    n = len(raw)
    if n < window:
        return np.zeros(0, np.int64)
    gain = _gain(window)
    same = np.zeros(n, np.uint8)  # equal bytes among a byte and the window - 1 before it
    after = np.zeros(n, np.uint8)  # and after it
    for lo in range(0, n, 1 << 16):
        hi = min(n, lo + (1 << 16))
        for k in range(1, window):
            start = max(lo, k)
            if start < hi:
                equal = raw[start:hi] == raw[start - k:hi - k]
                same[start:hi] += equal
                after[start - k:hi - k] += equal
    first = np.bincount(raw[:window], minlength=256)
    begin = int(sum(gain[:c + 1].sum() for c in first))
    total = np.empty(n - window + 1, np.int64)
    total[0] = begin
    total[1:] = begin + np.cumsum(gain[same[window:].astype(np.int64) + 1] - gain[after[:n - window].astype(np.int64) + 1])
    most = int(window * np.log2(window) * _SCALE)
    return np.clip(1000 - (total * 1000 + most // 2) // most, 0, 1000)


def slices(texts: list[bytes], most: int = 1 << 20):
    """(first, last) ranges of texts of about ``most`` bytes together, at least one each."""
    first = total = 0
    for i, t in enumerate(texts):
        if total and total + len(t) > most:
            yield first, i
            first, total = i, 0
        total += len(t)
    if first < len(texts):
        yield first, len(texts)


def entropy_counts(texts: list[bytes], window: int = WINDOW) -> np.ndarray:
    """Number of windows of each entropy in all texts."""
    out = np.zeros(LEVELS, np.int64)
    for first, last in slices(texts):
        part = texts[first:last]
        got = entropies(np.frombuffer(b"".join(part), np.uint8), window)
        inside = _inside(np.array([len(t) for t in part]), window)
        out += np.bincount(got[inside], minlength=LEVELS)
    return out


def _inside(sizes: np.ndarray, window: int) -> np.ndarray:
    """Which windows of the joined texts lie in one text."""
    ends = np.cumsum(sizes)
    n = int(ends[-1]) if len(ends) else 0
    if n < window:
        return np.zeros(0, bool)
    stop = np.repeat(ends, sizes)[:n - window + 1]
    return np.arange(n - window + 1) + window <= stop


def ranks_of(counts: np.ndarray) -> np.ndarray:
    """Rank of each entropy: the fewest windows first, ties by entropy; too small entropies have none."""
    rank = np.full(LEVELS, _NONE, np.int64)
    order = np.lexsort((np.arange(LEVELS), counts))
    order = order[order >= LEAST_ENTROPY]
    rank[order] = np.arange(len(order))
    return rank


def _mix(x: np.ndarray) -> np.ndarray:
    x = x + _U(0x9E3779B97F4A7C15)
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _hash_windows(raw: np.ndarray, at: np.ndarray, window: int) -> np.ndarray:
    got = np.zeros(len(at), np.uint64)
    for k in range(0, window, 8):
        word = np.zeros(len(at), np.uint64)
        for j in range(k, min(k + 8, window)):
            word = (word << _U(8)) | raw[at + j].astype(np.uint64)
        got = _mix(got ^ word)
    return got


def features(part: list[bytes], ranks: np.ndarray, window: int = WINDOW, run: int = RUN, votes: int = VOTES) -> tuple[np.ndarray, np.ndarray]:
    """(text, feature hash) of the features of each text, in text order, each feature of a text once.

    A text in which fewer than ``FEWEST`` windows get ``votes`` has all windows with a vote, and one in which fewer get a vote all windows
    with a rank; one without such a window (shorter than a window, or of one character) is itself its only feature; an empty
    text has none. ``run`` is at most ``window``.
    """
    sizes = np.array([len(t) for t in part], np.int64)
    ends = np.cumsum(sizes)
    raw = np.frombuffer(b"".join(part), np.uint8)
    n = len(raw)
    owner, at = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if n >= window:
        rank = np.where(_inside(sizes, window), ranks[entropies(raw, window)], _NONE)
        shift = max(int(n).bit_length(), 1)
        key = (rank << shift) | np.arange(len(rank))
        key = np.concatenate([key, np.full(run, _NONE << shift)])
        if shift <= 20:
            key = key.astype(np.int32)
        done = 1
        while done < run:  # the least of `done` consecutive keys, in doubling steps
            step = min(done, run - done)
            key = np.minimum(key[:-step], key[step:])
            done += step
        have = np.where(sizes >= window, np.maximum(sizes - window + 1 - run + 1, 1), 0)
        begin = np.repeat(ends - sizes, have) + np.arange(have.sum()) - np.repeat(np.cumsum(have) - have, have)
        best = key[begin].astype(np.int64)
        best = best[(best >> shift) < _NONE] & ((1 << shift) - 1)
        got = np.bincount(best, minlength=n)
        voted = np.flatnonzero(got)
        whose = np.searchsorted(ends, voted, "right")
        enough = np.bincount(whose[got[voted] >= votes], minlength=len(part)) >= FEWEST
        some = np.bincount(whose, minlength=len(part)) >= FEWEST
        keep = ((got[voted] >= votes) | ~enough[whose]) & some[whose]
        ranked = np.flatnonzero(rank < _NONE)
        theirs = np.searchsorted(ends, ranked, "right")
        short = ~some[theirs]
        at = np.concatenate([voted[keep], ranked[short]])
        owner = np.concatenate([whose[keep], theirs[short]])
        order = np.argsort(at)
        at, owner = at[order], owner[order]
    hashes = _hash_windows(raw, at, window)
    without = np.setdiff1d(np.flatnonzero(sizes > 0), owner)
    if len(without):
        whole = np.array([int.from_bytes(hashlib.blake2b(part[i], digest_size=8).digest(), "little") for i in without], np.uint64)
        owner, hashes = np.concatenate([owner, without]), np.concatenate([hashes, whole])
        order = np.argsort(owner, kind="stable")
        owner, hashes = owner[order], hashes[order]
    order = np.lexsort((np.arange(len(owner)), hashes, owner))  # a feature's first place stays
    o, h = owner[order], hashes[order]
    new = np.ones(len(o), bool)
    new[1:] = (o[1:] != o[:-1]) | (h[1:] != h[:-1])
    keep = np.sort(order[new])
    return owner[keep], hashes[keep]


def filters(owner: np.ndarray, hashes: np.ndarray, n: int) -> list[tuple[np.ndarray, int]]:
    """Per text: its chained filters as rows of 64-bit words, and the number of features in the last one."""
    count = np.bincount(owner, minlength=n)
    chains = -(-count // CAPACITY)
    first = np.cumsum(chains) - chains
    number = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    row = first[owner] + number // CAPACITY
    bits = np.zeros((int(chains.sum()), BITS), bool)
    width = BITS.bit_length() - 1
    for k in range(PROBES):
        bits[row, ((hashes >> _U(width * k)) & _U(BITS - 1)).astype(np.int64)] = True
    words = np.packbits(bits, axis=1, bitorder="little").view(np.uint64)
    return [(words[first[i]:first[i] + chains[i]], int(count[i] - (chains[i] - 1) * CAPACITY) if chains[i] else 0) for i in range(n)]


def digests(texts: list[bytes], ranks: np.ndarray, window: int = WINDOW, run: int = RUN, votes: int = VOTES) -> list[tuple[np.ndarray, int]]:
    """The digest of each text: its chained filters and the features in the last."""
    out = []
    for first, last in slices(texts):
        owner, hashes = features(texts[first:last], ranks, window, run, votes)
        out += filters(owner, hashes, last - first)
    return out


def as_text(digest: tuple[np.ndarray, int]) -> str:
    """``<features in the last filter>:<base64 of the filters>``, empty for a text without features."""
    words, last = digest
    return f"{last}:{base64.b64encode(words.astype('<u8').tobytes()).decode()}" if len(words) else ""


def from_text(text: str) -> tuple[np.ndarray, int]:
    if not text:
        return np.zeros((0, BITS // 64), np.uint64), 0
    last, bits = text.split(":", 1)
    return np.frombuffer(base64.b64decode(bits), "<u8").reshape(-1, BITS // 64).astype(np.uint64), int(last)


def likeness(a: tuple[np.ndarray, int], b: tuple[np.ndarray, int], block: int = 256) -> float:
    """0 to 1: for each filter of either digest its best match among the other's, averaged by features.

    A match is the overlap of two filters' bits above what chance gives, against that of filters of their sizes that are alike
    (the geometric mean of their sizes). Two empty digests are alike, an empty one and another are not.
    """
    (x, nx), (y, ny) = a, b
    if not len(x) or not len(y):
        return float(len(x) == len(y))
    if x.shape == y.shape and nx == ny and (x == y).all():
        return 1.0
    sx, sy = np.bitwise_count(x).sum(1, dtype=np.int64), np.bitwise_count(y).sum(1, dtype=np.int64)
    best_x, best_y = np.zeros(len(x)), np.zeros(len(y))
    for i in range(0, len(x), block):
        for j in range(0, len(y), block):
            both = np.zeros((len(x[i:i + block]), len(y[j:j + block])), np.int64)
            for k in range(x.shape[1]):
                both += np.bitwise_count(x[i:i + block, k, None] & y[None, j:j + block, k])
            size = sx[i:i + block, None] * sy[None, j:j + block]
            chance, top = size / BITS, np.sqrt(size)
            match = np.clip((both - chance) / np.maximum(top - chance, 1e-9), 0, 1)
            best_x[i:i + block] = np.maximum(best_x[i:i + block], match.max(1))
            best_y[j:j + block] = np.maximum(best_y[j:j + block], match.max(0))
    wx, wy = np.full(len(x), CAPACITY), np.full(len(y), CAPACITY)
    wx[-1], wy[-1] = nx, ny
    return float(((best_x * wx).sum() + (best_y * wy).sum()) / (wx.sum() + wy.sum()))
