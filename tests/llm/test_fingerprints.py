import hashlib
import math
import random
from collections import Counter

import numpy as np

from citylake.llm import improbable as I
from citylake.llm.fingerprints import entropy_ranks, fingerprint_report
from tests.llm.helpers import docs, with_extra


def slow_entropy(window):
    total = sum(round(c * math.log2(c) * (1 << 20)) for c in Counter(window).values())
    most = int(len(window) * math.log2(len(window)) * (1 << 20))
    return min(1000, max(0, 1000 - (total * 1000 + most // 2) // most))


def slow_features(raw, ranks, window=I.WINDOW, run=I.RUN, votes=I.VOTES):
    """The hashes of a text's features, text by text and window by window."""
    rank = [int(ranks[slow_entropy(raw[i:i + window])]) for i in range(len(raw) - window + 1)]
    got = Counter()
    for s in range(max(len(rank) - run + 1, min(len(rank), 1))):
        near = rank[s:s + run]
        if min(near) < I._NONE:
            got[s + near.index(min(near))] += 1
    picked = [p for p in got if got[p] >= votes]
    if len(picked) < I.FEWEST:
        picked = list(got)
    if len(got) < I.FEWEST:
        picked = [p for p in range(len(rank)) if rank[p] < I._NONE]
    arr = np.frombuffer(raw, np.uint8)
    hashes = I._hash_windows(arr, np.array(sorted(picked), np.int64), window).tolist()
    if not picked and raw:
        hashes = [int.from_bytes(hashlib.blake2b(raw, digest_size=8).digest(), "little")]
    return list(dict.fromkeys(hashes))


def slow_digest(raw, ranks):
    hashes = slow_features(raw, ranks)
    chain = [set() for _ in range(-(-len(hashes) // I.CAPACITY))]
    for k, h in enumerate(hashes):
        chain[k // I.CAPACITY].update((h >> (11 * j)) & 2047 for j in range(I.PROBES))
    return chain, len(hashes) - (len(chain) - 1) * I.CAPACITY if chain else 0


def slow_likeness(a, b):
    (x, nx), (y, ny) = a, b
    if not x or not y:
        return float(not x and not y)

    def match(f, g):
        chance, top = len(f) * len(g) / 2048, math.sqrt(len(f) * len(g))
        return min(1, max(0, (len(f & g) - chance) / (top - chance)))

    wx, wy = [I.CAPACITY] * (len(x) - 1) + [nx], [I.CAPACITY] * (len(y) - 1) + [ny]
    total = sum(w * max(match(f, g) for g in y) for f, w in zip(x, wx)) + sum(w * max(match(f, g) for f in x) for g, w in zip(y, wy))
    return total / (sum(wx) + sum(wy))


def some_texts(seed=3):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdeéñ") for _ in range(rng.randrange(1, 9))) for _ in range(300)]
    out = ["", None, "a", "short", "exactly16 bytes!", "a" * 500, "ab" * 40, "same text " * 30, "日本語のテキスト" * 9, "\U0001f600 x" * 12]
    for n in (5, 9, 20, 40, 90, 300, 900):
        out += [" ".join(rng.choice(words) for _ in range(n)) for _ in range(3)]
    return out + [out[-1], out[-2]]  # equal texts


def test_against_a_slow_form(spark):
    texts = some_texts()
    counts = np.zeros(I.LEVELS, np.int64)
    for t in texts:
        raw = (t or "").encode()
        for i in range(len(raw) - I.WINDOW + 1):
            counts[slow_entropy(raw[i:i + I.WINDOW])] += 1
    ranks = I.ranks_of(counts)
    assert (entropy_ranks(docs(spark, texts)) == ranks).all()
    rows = {r.doc_id: r for r in fingerprint_report(with_extra(docs(spark, texts).repartition(5))).collect()}
    assert len(rows) == len(texts)
    for i, t in enumerate(texts):
        t, follow = t or "", texts[i - 1] or ""  # descending ids; after the least comes the greatest
        k = len(t) // 3
        changed = t[:len(t) - k] + follow[:k]
        mine, other, near = (slow_digest(x.encode(), ranks) for x in (t, changed, follow))
        r = rows[i]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        for text, want in ((r.fingerprint, mine), (r.edited_fingerprint, other)):
            words, last = I.from_text(text)
            bits = np.unpackbits(words.view(np.uint8), bitorder="little").reshape(-1, I.BITS) if len(words) else []
            assert [set(np.flatnonzero(b)) for b in bits] == want[0] and last == want[1], repr(t)
        assert abs(r.near_edited - slow_likeness(mine, other)) < 1e-9 and abs(r.near_next - slow_likeness(mine, near)) < 1e-9
    assert rows[len(texts) - 2].fingerprint == rows[len(texts) - 3].fingerprint


def test_ties_nulls_empty_and_single(spark):
    assert fingerprint_report(docs(spark, [])).count() == 0
    one = fingerprint_report(docs(spark, ["abcdef"])).collect()
    assert len(one) == 1 and one[0].edited_sha256 == hashlib.sha256(b"abcdab").hexdigest() and one[0].near_next == 1.0
    texts = ["x y z " * 30, "x y z " * 30, None, "", "other words here " * 9]
    rows = fingerprint_report(docs(spark, texts, ids=[7, 7, None, 7, None])).collect()
    assert sorted((r.doc_id is None, r.n_chars) for r in rows) == [(False, 0), (False, 180), (False, 180), (True, 0), (True, 153)]
    empty = fingerprint_report(docs(spark, [None, ""])).collect()
    assert [(r.fingerprint, r.near_edited, r.near_next) for r in empty] == [("", 1.0, 1.0)] * 2


def test_order_holds_over_many_partitions(spark):
    texts = [f"text number {i} " * (i % 7) for i in range(400)]
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        rows = {r.doc_id: r for r in fingerprint_report(docs(spark, texts, ids=[3 * i for i in range(400)])).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    for i, t in enumerate(texts):
        follow = texts[i - 1]
        k = len(t) // 3
        assert rows[3 * i].edited_sha256 == hashlib.sha256((t[:len(t) - k] + follow[:k]).encode()).hexdigest()


def test_copies_and_clean_texts_are_told_apart(spark):
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(2, 9))) for _ in range(3000)]
    texts = [" ".join(rng.choice(words) for _ in range(200)) for _ in range(60)]
    rows = fingerprint_report(docs(spark, texts)).collect()
    assert min(r.near_edited for r in rows) > 0.45 and max(r.near_next for r in rows) < 0.15


def test_a_very_long_text_in_linear_passes():
    rng = np.random.default_rng(2)
    raw = rng.integers(97, 123, 3_000_000, dtype=np.uint8).tobytes()
    ranks = I.ranks_of(I.entropy_counts([raw]))
    words, last = I.digests([raw], ranks)[0]
    assert len(words) > 500 and I.likeness((words, last), (words, last)) == 1.0
