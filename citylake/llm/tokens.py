"""Whole-text encoding with public tokenizers, with a bounded cache of chunks.

A byte-pair tokenizer splits a text into pre-tokens before it merges, and no pre-token crosses
certain white space. ``ChunkEncoder`` cuts a text only at such places, so that the ids of the chunks,
joined, are exactly the ids of the whole text, and encodes each distinct chunk once while it stays
in the cache. Texts for which the cut could matter (special-token strings, control characters that
libraries class differently) are given to the tokenizer whole.
"""

from __future__ import annotations

import os
import re
from itertools import chain

import numpy as np

_SPLIT = re.compile(r" (?=\S)")
_CONTROL = re.compile("[\x1c-\x1f]")
_ABOVE_LATIN = re.compile("[^\x00-ɏ]")
_TAIL = frozenset(".,;:!?")
#: New chunks that are given to the library at a time: what it returns is many times as large as the ids.
SLICE = 4_096


class _Odd(Exception):
    pass


class _Table(dict):
    """Chunk -> index; an unknown chunk is registered when it is looked up."""

    def __init__(self, owner, prefix):
        super().__init__()
        self.owner, self.prefix = owner, prefix

    def __missing__(self, piece):
        owner = self.owner
        if self.prefix and (not piece or piece[0].isspace()):
            raise _Odd
        index = owner.known + len(owner.fresh)
        if not self.prefix and owner.kind == "bytes":
            owner.alone.add(len(owner.fresh))
        owner.fresh.append(self.prefix + piece)
        if len(piece) <= 64:
            self[piece] = index
        return index


def _words(piece: str) -> int:
    """1 for letters alone, 2 for letters and a mark after them (so many pre-tokens), else 0."""
    letters = piece[:-1] if piece[-1] in _TAIL else piece
    return (1 + (len(letters) < len(piece))) if letters.isalpha() and (letters.isascii() or max(letters) < "ɐ") else 0


class ChunkEncoder:
    """``encode_many``: list of strings -> list of id lists. ``kind``: "bytes" for byte-level BPE
    whose pre-tokens take one leading space, "words" for a lower-casing tokenizer that drops white
    space. ``special``: strings that make a text go whole. ``max_chunks`` bounds the cache: beyond it the
    chunks used least go. ``encode_joined``: for chunks that may be joined; it also gets each chunk's size, in
    bytes or words, and returns all ids as one uint16 array, and how many each chunk has."""

    def __init__(self, encode_many, kind: str, special=(), max_chunks: int = 1_000_000, encode_joined=None):
        self.encode_many, self.kind, self.special, self.max_chunks = encode_many, kind, tuple(special), max_chunks
        self.encode_joined = encode_joined
        self.clear()

    def clear(self):
        self.plain, self.spaced = _Table(self, ""), _Table(self, " ")
        self.fresh, self.alone = [], set()  # chunks that have no ids yet, and places there of those that are never joined
        self.known = 0
        self.hits = np.zeros(0, np.int64)
        self.pool = np.zeros(0, np.uint16)
        self.start = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int64)

    def forget(self):
        """Keep the half of ``max_chunks`` that was used most."""
        keep = np.zeros(self.known, bool)
        keep[np.argsort(self.hits, kind="stable")[-(self.max_chunks // 2):]] = True
        tables, hits, pool, start, size = (self.plain, self.spaced), self.hits // 2, self.pool, self.start, self.size
        self.clear()
        kept = []
        for table, old in zip((self.plain, self.spaced), tables, strict=True):
            for piece, i in old.items():
                if keep[i]:
                    table[piece] = len(kept)
                    kept.append(i)
            old.clear()
        kept = np.array(kept, np.int64)
        self.known, self.hits, self.size = len(kept), hits[kept], size[kept]
        self.pool = pool[_spans(start[kept], self.size)]
        self.start = np.cumsum(self.size) - self.size

    def _whole(self, text):
        self.alone.add(len(self.fresh))
        self.fresh.append(text)
        return np.array([self.known + len(self.fresh) - 1], np.int64)

    def _chunks(self, text):
        if any(s in text for s in self.special):
            return self._whole(text)
        if self.kind == "words":
            if _CONTROL.search(text):
                return self._whole(text)
            if text.isascii() or not _ABOVE_LATIN.search(text):
                low = text.lower()
                if any(s in low for s in self.special):  # ordinary text that lower case would make special
                    return self._whole(text)
                text = low
            pieces = text.split()
            return np.fromiter(map(self.plain.__getitem__, pieces), np.int64, len(pieces))
        if not text:
            return np.zeros(0, np.int64)
        pieces = text.split(" ")
        try:
            rest = np.fromiter(map(self.spaced.__getitem__, pieces[1:]), np.int64, len(pieces) - 1)
        except _Odd:  # a space before other white space: cut only before spaces that start a word
            pieces = _SPLIT.split(text)
            rest = np.fromiter(map(self.spaced.__getitem__, pieces[1:]), np.int64, len(pieces) - 1)
        return np.concatenate([[self.plain[pieces[0]]] if pieces[0] else [], rest]).astype(np.int64)

    def _resolve(self):
        fresh, alone = self.fresh, self.alone
        self.fresh, self.alone = [], set()
        if not fresh:
            return
        joint = np.zeros(len(fresh), np.int64)
        if self.encode_joined:
            joint[:] = [_words(c) for c in fresh] if self.kind == "words" else [len(c.encode("utf-8", "surrogatepass")) for c in fresh]
            joint[list(alone)] = 0
        order, parts, counts = [], [], []
        for index in (np.flatnonzero(joint == 0), np.flatnonzero(joint)):
            for at in range(0, len(index), SLICE):
                some = index[at:at + SLICE]
                chunks = [fresh[i] for i in some.tolist()]
                ids, n = self.encode_joined(chunks, joint[some]) if joint[some[0]] else _flat(self.encode_many(chunks))
                order.append(some)
                parts.append(ids)
                counts.append(n)
        order, counts = np.concatenate(order), np.concatenate(counts)
        start, size = np.zeros(len(fresh), np.int64), np.zeros(len(fresh), np.int64)
        start[order], size[order] = len(self.pool) + np.cumsum(counts) - counts, counts
        self.pool = np.concatenate([self.pool, *parts])
        self.start, self.size = np.concatenate([self.start, start]), np.concatenate([self.size, size])
        self.hits = np.concatenate([self.hits, np.zeros(len(fresh), np.int64)])
        self.known += len(fresh)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids as one uint16 array, and the number of ids of each text."""
        if self.known > self.max_chunks or len(self.pool) > 16 * self.max_chunks:
            self.forget()
        chunks = [self._chunks(t) for t in texts]
        self._resolve()
        every = np.concatenate([np.zeros(0, np.int64), *chunks])
        self.hits += np.bincount(every, minlength=len(self.hits))
        size = self.size[every]
        last = np.cumsum(np.fromiter(map(len, chunks), np.int64, len(chunks)))
        counts = np.diff(np.concatenate([[0], np.cumsum(size)])[last], prepend=0)
        return self.pool[_spans(self.start[every], size)], counts


def _flat(lists) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all lists as one array, and how many each has."""
    counts = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter(chain.from_iterable(lists), np.uint16, int(counts.sum())), counts


def _spans(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places start, start + 1, ... of each of the spans, one span after another."""
    ends = np.cumsum(size)
    return np.repeat(start - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)


_KEPT: dict = {}


def drop_encoders() -> None:
    """Free what this Python worker keeps for encoding."""
    _KEPT.clear()


def tokenizers_encoder(path: str, kind: str) -> ChunkEncoder:
    """The tokenizers library with the vocabulary file at ``path``, one per Python worker."""
    if (path, kind) not in _KEPT:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tok = Tokenizer.from_file(path)
        special = [t.content for t in tok.get_added_tokens_decoder().values()]
        width = np.zeros(tok.get_vocab_size(), np.int64)  # bytes of an id, or 1 where an id ends a word
        for token, i in tok.get_vocab().items():
            width[i] = len(token) if kind == "bytes" else token.endswith("</w>")
        bare = _bare(tok) if kind == "words" else None
        _KEPT[path, kind] = ChunkEncoder(
            lambda texts: [e.ids for e in tok.encode_batch_fast(texts, add_special_tokens=False)], kind, special,
            encode_joined=lambda chunks, sizes: _joined(tok, chunks, sizes, width, bare))
    return _KEPT[path, kind]


def _bare(tok):
    """The model of ``tok`` behind a cut at white space alone. Lower-case letters and marks after them, with white space between, are
    what the normalizer and the patterns of a "words" tokenizer make of ``_words``, so the ids are the same."""
    from tokenizers import Tokenizer, pre_tokenizers

    bare = Tokenizer(tok.model)
    bare.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    return bare


def _joined(tok, chunks, sizes, width: np.ndarray, bare=None, group: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """Ids of chunks that are encoded many at a time, and how many each has. Chunks that begin with a space are told apart in the
    ids by their bytes, words of letters (where there is a ``bare`` tokenizer for them) by the ids that end a word."""
    parts = [(chunks[i:i + group], sizes[i:i + group]) for i in range(0, len(chunks), group)]
    if bare is None:
        found = tok.encode_batch_fast(["".join(g) for g, _ in parts], add_special_tokens=False)
    else:
        joined = [" ".join([c if n == 1 else f"{c[:-1]} {c[-1]}" for c, n in zip(g, s.tolist(), strict=True)]) for g, s in parts]
        low = [t == t.lower() for t in joined]  # texts with characters beyond Latin come as they are written
        found = [bare.encode_batch_fast([t for t, b in zip(joined, low, strict=True) if b], add_special_tokens=False),
                 tok.encode_batch_fast([t for t, b in zip(joined, low, strict=True) if not b], add_special_tokens=False)]
        found = [found[not b].pop(0) for b in low]
    found = [e.ids for e in found]
    ids, lengths = _flat(found)
    ends = _ends(ids, sizes, width)
    if ends is not None and (ends[group - 1::group] == np.cumsum(lengths)[:len(ends) // group]).all():
        return ids, np.diff(ends, prepend=0)
    all_ids, counts = [], []
    for (g, s), one in zip(parts, found, strict=True):
        ids = np.array(one, np.uint16)
        ends = _ends(ids, s, width)
        ids, n = _flat([e.ids for e in tok.encode_batch_fast(g, add_special_tokens=False)]) if ends is None else (ids, np.diff(ends, prepend=0))
        all_ids.append(ids)
        counts.append(n)
    return np.concatenate(all_ids), np.concatenate(counts)


def _ends(ids: np.ndarray, sizes: np.ndarray, width: np.ndarray) -> np.ndarray | None:
    """Where each chunk's ids end, if the ids tell it."""
    done, goal = np.cumsum(width[ids]), np.cumsum(sizes)
    if not len(done) or done[-1] != goal[-1]:
        return None
    ends = np.searchsorted(done, goal)
    return ends + 1 if (done[ends] == goal).all() and ends[-1] + 1 == len(ids) else None


def tiktoken_encoder(path: str) -> tuple[ChunkEncoder, np.ndarray]:
    """tiktoken with the ranks file at ``path`` (special strings are plain text), and the bytes of
    each id as lengths."""
    if path not in _KEPT:
        import base64

        import public_tokenizers
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        lengths = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            lengths[rank] = len(token)
        _KEPT[path] = ChunkEncoder(lambda texts: [enc.encode_ordinary(t) for t in texts], "bytes"), lengths
    return _KEPT[path]
