"""DartMinHash signatures of weighted sets (numpy).

Darts are thrown at the plane of (weight, rank) over every element, one per unit of area on average, from
hashes of the element alone, so every document throws the same darts. A document of total weight W
keeps those of its elements' darts that land below the element's weight and below rank t / W: about t
darts, whatever the number of elements. Each dart hashes to one of k coordinates, and the dart of the
least rank per coordinate is the signature. Two documents agree in a coordinate with the
probability of their weighted Jaccard similarity.
"""

from __future__ import annotations

import re
import unicodedata

import numpy as np

_U = np.uint64
#: Words of a text: runs of ASCII digits and letters, in lower case, and of all other characters.
_CLASS = np.zeros(256, np.uint8)
for _b in range(256):
    if 48 <= _b <= 57 or 97 <= _b <= 122 or _b >= 128:
        _CLASS[_b] = _b
    elif 65 <= _b <= 90:
        _CLASS[_b] = _b + 32
#: Scripts written without spaces: Thai, Lao, Myanmar, Khmer, Tai, kana, Bopomofo, Han, Yi.
_UNSPACED = ((0xE00, 0xEFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x1950, 0x19DF), (0x1A20, 0x1AAF), (0x2E80, 0x2FDF), (0x3005, 0x3007), (0x3021, 0x312F),
             (0x31A0, 0x31BF), (0x31F0, 0x31FF), (0x3400, 0x4DBF), (0x4E00, 0xA4CF), (0xF900, 0xFAFF), (0xFF66, 0xFF9F), (0x1AFF0, 0x1B16F), (0x20000, 0x3FFFF))


def _apart_rules():
    """Patterns of what separates words beyond ASCII and of the characters that are words alone, with their
    marks; and the bytes that begin none of these."""
    kinds = {c: unicodedata.category(chr(c)) for c in range(0x80, 0x20000)}
    between = [c for c, k in kinds.items() if k[0] in "PZ" or chr(c).isspace()]
    marks = {c for c, k in kinds.items() if k[0] == "M"} | {*range(0xE0100, 0xE01F0)}
    odd = {*between} | marks
    alone = [c for a, b in _UNSPACED if b < 0x20000 for c in range(a, b + 1) if c not in odd]
    leads = {chr(c).encode("utf-8", "surrogatepass")[0] for c in between + alone} | {*range(0xF0, 0xF5)}

    def of(codes):
        return "".join(re.escape(chr(c)) for c in sorted(codes))

    return (re.compile(f"[{of(between)}]"), re.compile(f"[{of(alone)}\U00020000-\U0003ffff][{of(marks)}]*"),
            bytes(b for b in range(256) if b not in leads))


_BETWEEN, _ALONE, _PLAIN = _apart_rules()


def apart(texts: list[bytes]) -> list[bytes]:
    """The texts with spaces for Unicode white space and punctuation, and around each character (with its marks)
    of a script that is written without spaces, so that ``split_words`` finds words there too."""
    return [t if t.isascii() or not t.translate(None, _PLAIN) else
            _ALONE.sub(r" \g<0> ", _BETWEEN.sub(" ", t.decode("utf-8", "surrogatepass"))).encode("utf-8", "surrogatepass") for t in texts]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer (splitmix64)."""
    x = x + _U(0x9E3779B97F4A7C15)
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _unit(x: np.ndarray) -> np.ndarray:
    """A hash as a number in (0, 1)."""
    return ((x >> _U(11)).astype(np.float64) + 0.5) * (1.0 / (1 << 53))


_BASE = 0xD6E8FEB86659FD93
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(n: int):
    """The first n + 1 powers of the base and of its inverse; made for each call, so that a long text leaves nothing behind."""
    return [np.concatenate([[_U(1)], np.cumprod(np.full(n, base, np.uint64), dtype=np.uint64)]) for base in (_BASE, _INVERSE)]


def split_words(texts: list[bytes]):
    """(lower-cased bytes, first and last byte of every word, hashes of the words, words of each text)."""
    raw = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    low = _CLASS[raw]
    inside = low > 0
    edge = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]])))
    first, last = edge[::2], edge[1::2]
    up, down = _powers(len(raw) + 1)
    total = np.concatenate([[_U(0)], np.cumsum(low.astype(np.uint64) * up[:len(low)], dtype=np.uint64)])
    hashes = mix((total[last] - total[first]) * down[first] + (last - first).astype(np.uint64))
    bounds = np.cumsum([len(t) + 1 for t in texts])
    return low, first, last, hashes, np.diff(np.concatenate([[0], np.searchsorted(first, bounds)])).astype(np.int64)


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, in order, and the number of words of each text."""
    return split_words(texts)[3:]


def shingles(hashes: np.ndarray, counts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of ``width`` words per text (a text of fewer words, but not none, is one
    shingle): (text, shingle, occurrences), in order of text and shingle."""
    ends = np.cumsum(counts)
    n = np.where(counts > 0, np.maximum(counts - width + 1, 1), 0)
    text = np.repeat(np.arange(len(counts)), n)
    at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(ends - counts, n)
    stop = np.repeat(ends, n)
    got = np.full(len(at), _U(width))
    for k in range(width):
        there = at + k < stop
        got = np.where(there, mix(got * _U(0x100000001B3) ^ hashes[np.minimum(at + k, max(len(hashes) - 1, 0))]), got) if len(at) else got
    order = np.lexsort((got, text))
    text, got = text[order], got[order]
    new = np.ones(len(got), bool)
    new[1:] = (text[1:] != text[:-1]) | (got[1:] != got[:-1])
    first = np.flatnonzero(new)
    return text[first], got[first], np.diff(np.append(first, len(got)))


def signatures(sets: np.ndarray, elements: np.ndarray, weights: np.ndarray, n_sets: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(n_sets, k) signatures, and which sets are not empty. ``sets`` ascends; ``weights`` are above 0.

    The weight axis is cut into [0, 1), [1, 2), [2, 4), ...; in each cell the darts of an element come
    as a Poisson process in rank, by exponential steps, so raising the rank limit only adds darts. A set
    with an empty coordinate is thrown again with twice the limit until none is empty.
    """
    total = np.bincount(sets, weights, n_sets)
    some = total > 0
    out = np.zeros((n_sets, k), np.uint64)
    limit = np.where(some, k * (np.log(k) + 3.0) / np.where(some, total, 1), 0.0)
    todo = some.copy()
    while todo.any():
        pick = todo[sets]
        _throw(sets[pick], elements[pick], weights[pick], limit, out, todo, k)
        limit *= 2
    return out, some


def _throw(sets, elements, weights, limit, out, todo, k):
    n = len(todo)
    slot = np.cumsum(todo) - 1
    m = int(todo.sum())
    rows, ranks, marks = [], [], []
    cell, low = 0, 0.0
    while len(sets):
        high = 1.0 if cell == 0 else low * 2
        size = high - low
        e, s, w = elements, sets, weights
        seed = mix(e ^ _U((0xA24BAED4963EE407 * (cell + 1)) & (2 ** 64 - 1)))
        rank, top = np.zeros(len(e)), limit[s]
        while len(seed):
            seed = mix(seed)
            rank = rank - np.log(_unit(seed)) / size
            go = rank < top
            seed, rank, top, s, w = seed[go], rank[go], top[go], s[go], w[go]
            mark = mix(seed ^ _U(0x5851F42D4C957F2D))
            hit = np.ones(len(seed), bool) if high <= 1 and (w >= 1).all() else low + size * _unit(mix(mark)) < w
            rows.append(slot[s[hit]] * k + (mark[hit] % _U(k)).astype(np.int64))
            ranks.append(rank[hit])
            marks.append(mark[hit])
        more = weights > high
        sets, elements, weights = sets[more], elements[more], weights[more]
        cell, low = cell + 1, high
    rows, ranks, marks = np.concatenate(rows), np.concatenate(ranks), np.concatenate(marks)
    best = np.full(m * k, np.inf)
    np.minimum.at(best, rows, ranks)
    first = ranks == best[rows]
    sign = np.zeros(m * k, np.uint64)
    sign[rows[first]] = marks[first]
    full = np.isfinite(best).reshape(m, k).all(1)
    index = np.flatnonzero(todo)
    out[index[full]] = sign.reshape(m, k)[full]
    todo[index[full]] = False


def band_keys(signature: np.ndarray, bands: int) -> np.ndarray:
    """One 64-bit key per band of consecutive coordinates (and its number)."""
    rows = signature.shape[1] // bands
    got = np.tile(np.arange(1, bands + 1, dtype=np.uint64), (len(signature), 1))
    for r in range(rows):
        got = mix(got * _U(0x9E3779B97F4A7C15) ^ signature[:, r:bands * rows:rows])
    return got.view(np.int64)
