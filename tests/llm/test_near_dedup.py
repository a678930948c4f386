import random
import re

import numpy as np
import pytest

from citylake.llm import dartminhash as D
from citylake.llm.components import components
from citylake.llm.near_dedup import deduplicate, near_duplicates
from tests.llm.helpers import docs, with_extra

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def slow_words(t):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t))


def test_words_and_shingles():
    texts = ["Hello, World hello", "", "!!", "Été 日本 a1-b2", "x " * 20, "one two three four five six"]
    hashes, counts = D.word_hashes([t.encode() for t in texts])
    words = [slow_words(t) for t in texts]
    assert counts.tolist() == [len(w) for w in words]
    flat = [w for ws in words for w in ws]
    assert len(set(zip(flat, hashes.tolist()))) == len(set(flat)) == len(set(hashes.tolist()))
    text, shingle, count = D.shingles(hashes, counts, 5)
    for i, w in enumerate(words):
        grams = [tuple(w[k:k + 5]) for k in range(max(len(w) - 4, 1))] if w else []
        mine = shingle[text == i]
        assert len(mine) == len(set(grams)) == len(set(mine.tolist()))
        assert sorted(count[text == i]) == sorted(grams.count(g) for g in set(grams))


@pytest.mark.parametrize("kind", ["set", "count", "real", "short"])
def test_agreement_is_weighted_jaccard(kind):
    rng = np.random.default_rng(7)
    n, k = (400, 4000) if kind != "short" else (6, 4000)
    a = {"set": np.ones(n), "count": rng.integers(1, 9, n).astype(float), "real": rng.random(n) * 3 + 0.01, "short": np.ones(n)}[kind]
    b = a.copy()
    b[: n // 5] = 0
    b[n // 5: n // 3] *= 2
    e = rng.integers(1, 2 ** 63, n).astype(np.uint64)
    order = np.argsort(e)
    e, a, b = e[order], a[order], b[order]
    keep = b > 0
    sig, some = D.signatures(np.concatenate([np.zeros(n, int), np.ones(keep.sum(), int)]), np.concatenate([e, e[keep]]),
                             np.concatenate([a, b[keep]]), 3, k)
    assert some.tolist() == [True, True, False]
    want = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    assert abs((sig[0] == sig[1]).mean() - want) < 4 * np.sqrt(want * (1 - want) / k) + 0.01
    alone, _ = D.signatures(np.zeros(n, int), e, a, 1, k)
    assert (alone[0] == sig[0]).all()  # a set's signature doesn't depend on its batch


def test_words_beyond_ascii(spark):
    texts = ["日本語、テスト。", "全\u3000角 か\u3099", "l\u2019été\u00a0«là»", "สวัสดี", "Été 日a本1", "ascii, only", "straße \u2026 x", "\U00020000\U00020001"]
    want = [6, 3, 3, 4, 5, 2, 2, 2]
    assert D.word_hashes(D.apart([t.encode() for t in texts]))[1].tolist() == want
    rng = random.Random(2)
    base = [chr(0x4E00 + rng.randrange(3000)) for _ in range(400)]
    near = list(base)
    near[100], near[300] = "一", "丁"
    other = [chr(0x4E00 + rng.randrange(3000)) for _ in range(400)]
    rows = near_duplicates(docs(spark, ["".join(base), "".join(near) + "。", "".join(other)])).collect()
    assert {r.doc_id: r.class_id for r in rows} == {0: 0, 1: 0, 2: 2}


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(500 + i, 501 + i) for i in range(60)] + [(900, x) for x in range(901, 960)]
    parent = {}
    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x
    for a, b in edges:
        if a != b:
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    nodes = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: find(x) for x in nodes}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute(texts, width=5, threshold=0.8):
    sets = {}
    for d, t in texts:
        if t is not None:
            w = slow_words(t)
            sets[d] = {tuple(w[k:k + width]) for k in range(max(len(w) - width + 1, 1))} if w else set()
    root = {d: d for d, _ in texts}
    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    text = dict(texts)
    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            both = len(sets[a] & sets[b])
            if text[a] == text[b] or (both and both >= threshold * (len(sets[a]) + len(sets[b]) - both) - 1e-9):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {d: find(d) for d, _ in texts}


def make(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)] + ["été", "straße"]
    texts = []
    for _ in range(25):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([3, 4, 5, 30, 120, 200]))]
        texts.append(" ".join(base))
        for _ in range(rng.choice([0, 1, 4])):
            copy = list(base)
            for _ in range(rng.randrange(0, 4)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            texts.append(" ".join(copy).capitalize())
    many = [rng.choice(vocabulary) for _ in range(150)]
    for _ in range(40):  # a chain: members of one bucket that aren't all alike
        many = list(many)
        for _ in range(2):
            many[rng.randrange(150)] = rng.choice(vocabulary)
        texts.append(" ".join(many))
    return list(enumerate(texts + ["", "", None, None, "!!", "??", "one", "One", "x " * 400, "x " * 300]))


@pytest.mark.parametrize("seed", [1, 2])
def test_classes_against_all_pairs(spark, seed):
    texts = make(seed)
    df = with_extra(docs(spark, [t for _, t in texts])).repartition(5)
    rows = near_duplicates(df).collect()
    assert {r.doc_id: r.class_id for r in rows} == brute(texts)
    by = {}
    for r in rows:
        by.setdefault(r.class_id, []).append(r)
    assert all(sum(r.kept for r in c) == 1 and {r.class_size for r in c} == {len(c)} for c in by.values())


def test_edges_of_the_input(spark):
    assert near_duplicates(docs(spark, [])).count() == 0
    rows = near_duplicates(docs(spark, ["a b c d e f"] * 4 + [None], ids=[3, 3, None, 7, None])).collect()
    assert sum(r.kept for r in rows) == 2 and len(rows) == 5
    near = near_duplicates(docs(spark, ["q " * 5 + "a b c"] * 3), weighting="count").collect()
    assert {r.class_id for r in near} == {0}


def classes_by_all_pairs(texts, width=5, threshold=0.8):
    """Classes of distinct texts by all pairs, by a matrix over the shingles that two texts or more have."""
    sets = [{tuple(t.split()[k:k + width]) for k in range(len(t.split()) - width + 1)} for t in texts]
    held = {}
    for i, s in enumerate(sets):
        for x in s:
            held.setdefault(x, []).append(i)
    common = [v for v in held.values() if len(v) > 1]
    m = np.zeros((len(texts), len(common)), np.float32)
    for k, v in enumerate(common):
        m[v, k] = 1
    both, size = m @ m.T, np.array([len(s) for s in sets])
    linked = both >= threshold * (size[:, None] + size[None] - both) - 1e-6
    np.fill_diagonal(linked, True)
    root = np.arange(len(texts))
    while True:
        new = np.array([root[linked[i]].min() for i in range(len(texts))])
        new = new[new]
        if (new == root).all():
            return root
        root = new


@pytest.mark.parametrize("seed", [1, 2])
def test_a_large_group_around_the_threshold_loses_no_link(spark, seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(4000)]
    base = [rng.choice(vocabulary) for _ in range(150)]
    variant = [w if k % 50 else "variant" for k, w in enumerate(base)]  # a second form, just apart from the first
    texts = []
    for i in range(1500):
        copy = list(rng.choice([base, base, variant]))
        for _ in range(rng.choice([1, 2, 2, 3, 4, 5, 6])):
            copy[rng.randrange(150)] = rng.choice(vocabulary)
        texts.append(" ".join(copy))
    texts = sorted(set(texts))
    want = classes_by_all_pairs(texts)
    assert len(set(want.tolist())) > 50
    rows = near_duplicates(docs(spark, texts)).collect()
    assert {r.doc_id: r.class_id for r in rows} == dict(enumerate(want.tolist()))


def test_clashing_names_and_many_short_texts(spark):
    from citylake.llm.near_dedup import deduplicate
    from pyspark.sql import functions as F
    df = docs(spark, [f"a b c d e f g {i % 9}" for i in range(3000)] + [None])
    for name in ("near_key", "NEAR_KEY_", "_kept_id", "_kept_digest", "_text_digest", "leader", "member", "root", "place"):
        df = df.withColumn(name, F.lit("clash"))
    kept = deduplicate(df)
    assert kept.columns == df.columns and kept.count() == 10


def test_a_very_long_text(spark):
    rng = random.Random(6)
    words = [f"w{rng.randrange(50_000)}" for _ in range(300_000)]
    other = list(words)
    other[1000] = other[200_000] = "changed"
    rows = near_duplicates(docs(spark, [" ".join(words), " ".join(other), "short one " * 9])).collect()
    assert {r.doc_id: r.class_id for r in rows} == {0: 0, 1: 0, 2: 2}


def _exchanged(plan):
    """Bytes that the exchanges of a query that has run were given."""
    if plan.nodeName() == "Exchange":
        return plan.metrics().apply("dataSize").value()
    inner = plan.executedPlan() if plan.nodeName() == "AdaptiveSparkPlan" else plan.plan() if "QueryStage" in plan.nodeName() else None
    children = [inner] if inner else [plan.children().apply(i) for i in range(plan.children().size())]
    return sum(_exchanged(c) for c in children)


def test_rows_of_which_no_copy_goes_are_not_shuffled(spark):
    rng = random.Random(11)
    texts = [" ".join(f"w{rng.randrange(10 ** 6)}" for _ in range(300)) for _ in range(200)]
    got = deduplicate(docs(spark, texts + [texts[3], texts[3] + " tail", None, texts[7]], ids=[*range(200), 900, 901, 902, 7]))
    rows = got.collect()
    assert sorted((r["doc_id"], r["text"]) for r in rows if r["text"]) == list(enumerate(texts))
    assert [r["doc_id"] for r in rows if r["text"] is None] == [902]
    assert _exchanged(got._jdf.queryExecution().executedPlan()) < sum(map(len, texts)) / 4
