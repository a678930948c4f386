"""Top documents of an item by presence masks (numpy).

For an item, each document of a block gets a bitmap of the item's distinct terms that it holds. Documents of
one bitmap form a group, whose scores the bitmap bounds: by the greatest part that each of its terms has in the block.
Groups are scored by descending bound until the next bound is below the least of the best scores so far.
"""

from __future__ import annotations

import numpy as np

#: Documents that are scored together, at least, unless fewer are left.
CHUNK = 256


class Best:
    """The ``top`` best (score, id) of an item: higher scores first, then smaller ids, null ids before others."""

    def __init__(self, top: int):
        self.top = top
        self.score = np.zeros(0, np.int64)
        self.id = np.zeros(0, np.int64)
        self.some = np.zeros(0, bool)  # the id isn't null

    def floor(self) -> int:
        """No document below this score gets in."""
        return int(self.score[-1]) if len(self.score) == self.top else 1

    def add(self, score: np.ndarray, ids: np.ndarray, some: np.ndarray) -> None:
        go = score >= self.floor()
        if go.any():
            s, i, n = np.concatenate([self.score, score[go]]), np.concatenate([self.id, ids[go]]), np.concatenate([self.some, some[go]])
            order = np.lexsort((i, n, -s))[:self.top]
            self.score, self.id, self.some = s[order], i[order], n[order]


class Block:
    """The postings of a block of documents, by term."""

    def __init__(self, ids, some, sizes: np.ndarray, doc: np.ndarray, term: np.ndarray, tf: np.ndarray, n_terms: int):
        self.ids, self.some, self.n = ids, some, len(ids)
        order = np.argsort(term, kind="stable")  # documents ascend within a term
        self.doc = doc[order]
        self.part = (1_000_000_000 * tf[order]) // (1000 * tf[order] + 12 * sizes[self.doc])
        self.bounds = np.searchsorted(term[order], np.arange(n_terms + 1))
        self.most = np.zeros(n_terms, np.int64)
        have = np.flatnonzero(np.diff(self.bounds))
        if len(have):
            self.most[have] = np.maximum.reduceat(self.part, self.bounds[have])

    def of(self, t: int) -> tuple[np.ndarray, np.ndarray]:
        lo, hi = self.bounds[t], self.bounds[t + 1]
        return self.doc[lo:hi], self.part[lo:hi]

    def masks(self, terms: np.ndarray) -> np.ndarray:
        """(documents, 64-bit words): bit j of a row says that the document holds ``terms[j]``."""
        out = np.zeros((self.n, max(1, -(-len(terms) // 64))), np.uint64)
        for j, t in enumerate(terms):
            out[self.of(t)[0], j // 64] |= np.uint64(1 << (j % 64))
        return out


def groups(masks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct masks that aren't empty, documents ordered by their group, first document of each group and the end)."""
    held = np.flatnonzero(masks.any(1))
    rows = np.ascontiguousarray(masks[held])
    key = rows[:, 0] if rows.shape[1] == 1 else rows.view(np.dtype((np.void, rows.dtype.itemsize * rows.shape[1])))[:, 0]
    order = np.argsort(key, kind="stable") if rows.shape[1] == 1 else np.lexsort(rows.T)
    key = key[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    return rows[order][first], held[order], np.append(first, len(key))


def search(block: Block, terms: np.ndarray, weights: np.ndarray, best: Best) -> int:
    """Add the block's documents to ``best``; returns how many were scored. ``weights`` count a term's repeats in the item."""
    distinct, docs, first = groups(block.masks(terms))
    if not len(distinct):
        return 0
    reach = weights * block.most[terms]
    bound = np.zeros(len(distinct), np.int64)
    for j in range(len(terms)):
        bound += np.where((distinct[:, j // 64] >> np.uint64(j % 64)) & np.uint64(1) > 0, reach[j], 0)
    order = np.argsort(-bound, kind="stable")
    sizes = np.diff(first)[order]
    at = scored = 0
    while at < len(order) and bound[order[at]] >= best.floor():
        stop = at + 1 + int(np.searchsorted(np.cumsum(sizes[at:]), CHUNK))
        chunk = order[at:stop]
        some = np.concatenate([docs[first[g]:first[g + 1]] for g in chunk])
        some.sort()
        any_mask = np.bitwise_or.reduce(distinct[chunk], axis=0)
        score = np.zeros(len(some), np.int64)
        for j, t in enumerate(terms):
            if any_mask[j // 64] >> np.uint64(j % 64) & np.uint64(1):
                have, part = block.of(t)
                place = np.minimum(np.searchsorted(have, some), len(have) - 1)
                score += np.where(have[place] == some, weights[j] * part[place], 0)
        best.add(score, block.ids[some], block.some[some])
        scored += len(some)
        at = stop
    return scored
