"""Canonical length-limited Huffman code over integer ids, vectorised in numpy."""

from __future__ import annotations

import numpy as np


def code_lengths(counts: np.ndarray, limit: int = 16) -> np.ndarray:
    """Optimal code lengths of at most ``limit`` bits (package-merge); 0 where the count is 0.

    Each level merges the leaves, in order of weight, with the pairs of the level before. What an
    optimal choice takes of a level is always a prefix, so counting the leaves of the prefixes gives
    the lengths.
    """
    counts = np.asarray(counts, np.int64)
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << limit:
        raise ValueError(f"{len(used)} symbols need more than {limit} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[order].astype(float)
    level, is_leaf = leaves, [np.ones(len(leaves), bool)]
    for _ in range(limit - 1):
        pairs = level[:len(level) // 2 * 2].reshape(-1, 2).sum(1)
        both = np.concatenate([leaves, pairs])
        at = np.argsort(both, kind="stable")
        level = both[at]
        is_leaf.append(at < len(leaves))
    take = 2 * len(leaves) - 2
    for flags in reversed(is_leaf):
        n = int(flags[:take].sum())
        lengths[order[:n]] += 1
        take = 2 * (take - n)
    return lengths


class Code:
    """Canonical code of the given lengths: codes ascend by (length, id), so the lengths are all a
    reader needs. Decoding looks up ``limit`` bits at once in one table."""

    def __init__(self, lengths: np.ndarray, limit: int = 16):
        lengths = np.asarray(lengths, np.int64)
        used = np.flatnonzero(lengths)
        order = used[np.lexsort((used, lengths[used]))]
        span = 1 << (limit - lengths[order])
        first = np.cumsum(span) - span
        self.limit, self.lengths = limit, lengths
        self.codes = np.zeros(len(lengths), np.uint64)
        self.codes[order] = (first >> (limit - lengths[order])).astype(np.uint64)
        self.symbol, self.step = np.zeros(1 << limit, np.uint32), np.ones(1 << limit, np.int64)
        n = int(span.sum())
        if n > 1 << limit:
            raise ValueError("lengths of no prefix code")
        self.symbol[:n], self.step[:n] = np.repeat(order, span), np.repeat(lengths[order], span)

    def encode(self, ids: np.ndarray, block: int) -> tuple[bytes, np.ndarray]:
        """The bits, and the bit offset at which each run of ``block`` ids begins."""
        if not len(ids):
            return b"", np.zeros(0, np.int64)
        size, code = self.lengths[ids], self.codes[ids]
        if not size.all():
            raise ValueError("an id has no code")
        offsets = np.cumsum(np.add.reduceat(size, np.arange(0, len(ids), block)))
        offsets = np.concatenate([[0], offsets[:-1]])
        # neighbours are joined while two of the longest fit a word, so that fewer codes are placed
        most = self.limit
        while 2 * most <= 64:
            if len(size) % 2:
                size, code = np.append(size, 0), np.append(code, np.uint64(0))
            code = code[::2] << size[1::2].astype(np.uint64) | code[1::2]
            size = size[::2] + size[1::2]
            most *= 2
        ends = np.cumsum(size)
        at = ends - size
        word, room = at >> 6, 64 - (at & 63) - size
        here = np.where(room >= 0, code << np.maximum(room, 0).astype(np.uint64), code >> np.maximum(-room, 0).astype(np.uint64))
        out = np.zeros((int(ends[-1]) + 63) // 64, np.uint64)
        firsts = np.concatenate([[0], np.flatnonzero(np.diff(word)) + 1])
        out[word[firsts]] = np.add.reduceat(here, firsts)  # bits of different ids don't overlap
        over = np.flatnonzero(room < 0)
        out[word[over] + 1] |= code[over] << (64 + room[over]).astype(np.uint64)
        return out.astype(">u8").tobytes()[:(int(ends[-1]) + 7) // 8], offsets

    def decode(self, bits: bytes, offsets: np.ndarray, n: int, block: int) -> np.ndarray:
        """``n`` ids. The blocks are independent; one step decodes one id of every block."""
        if not n:
            return np.zeros(0, np.uint32)
        raw = np.frombuffer(bits + b"\0\0\0\0", np.uint8).astype(np.uint32)
        three = (raw[:-2] << 16) | (raw[1:-1] << 8) | raw[2:]
        at = np.array(offsets, np.int64)
        out = np.zeros((block, len(at)), np.uint32)
        short = n - block * (len(at) - 1)
        down, mask = 24 - self.limit, (1 << self.limit) - 1
        for k in range(min(block, n)):
            if k == short:
                at = at[:-1]
            seen = (three[at >> 3] >> (down - (at & 7)).astype(np.uint32)) & mask
            out[k, :len(at)] = self.symbol[seen]
            at = at + self.step[seen]
        return out.T.reshape(-1)[:n]
