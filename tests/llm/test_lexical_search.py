import math
import random
import re
from collections import Counter

import numpy as np

from citylake.llm import presence as P
from citylake.llm.lexical_search import search_report, terms_of
from tests.llm.helpers import docs, with_extra

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def slow(rows, items, top=20):
    lists = [(i, terms(t)) for i, t in rows if terms(t)]
    n_docs, total = len(lists), sum(len(t) for _, t in lists)
    df = Counter(w for _, t in lists for w in set(t))
    out = []
    for item, text in items:
        scored = []
        for i, words in lists:
            tf, m = Counter(words), 75 + (25 * len(words) * n_docs) // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * ((10 ** 9 * tf[w]) // (1000 * tf[w] + 12 * m)) for w in terms(text) if tf[w])
            if score > 0:
                scored.append((-score, i is not None, i or 0))
        out += [(item, r + 1, i if some else None, -s) for r, (s, some, i) in enumerate(sorted(scored)[:top])]
    return sorted(out, key=repr)


def corpus(seed, n, vocabulary=60):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(vocabulary)] + ["Ünï", "ÉCOLE", "日本", "x\xa0y", "A1"]
    return [rng.choice([" ", "\n", ", ", "--"]).join(rng.choice(words[:rng.choice([5, 20, 65])]) for _ in range(rng.randrange(0, 90))) for _ in range(n)]


def test_terms_follow_the_pattern():
    for text in corpus(1, 50) + ["", "A-B_c\x7fd\x00e", " é\x85Z"]:
        assert terms_of(text.encode()) == [t.encode() for t in terms(text)]


def check(spark, rows, items, **options):
    d = with_extra(docs(spark, [t for _, t in rows], ids=[i for i, _ in rows]).repartition(3))
    b = spark.createDataFrame(items, "item_id long, text string").selectExpr("item_id", "text", "'x' AS item", "1 AS rank", "2 AS doc_id")
    got = sorted(((r.item_id, r.rank, r.doc_id, r.score) for r in search_report(d, b, **options).collect()), key=repr)
    assert got == slow(rows, items, options.get("top", 20))


def test_against_a_slow_form(spark):
    texts = corpus(2, 250)
    rows = list(enumerate(texts)) + [(900, None), (901, ""), (902, "?!"), (None, texts[3]), (903, texts[3]), (902, texts[3])]
    long_item = " ".join(f"w{i % 60} extra{i}" for i in range(150))  # more than 64 distinct terms
    items = [(i, t) for i, t in enumerate(corpus(3, 12))] + [(50, None), (51, ""), (52, "nowhere"), (53, long_item), (54, "w1 w1 w1 w2"), (None, "w3 w4")]
    check(spark, rows, items)
    check(spark, rows, items, top=3, most_terms=40)  # several blocks of items


def test_ties_and_a_hot_text(spark):
    rows = [(i, "alpha beta gamma") for i in range(300)] + [(1000 + i, "alpha delta") for i in range(30)] + [(5000, "rare")]
    check(spark, rows, [(1, "alpha beta"), (2, "delta rare"), (3, "alpha")])


def test_empty_tables(spark):
    assert search_report(docs(spark, []), spark.createDataFrame([(1, "a")], "item_id long, text string")).count() == 0
    assert search_report(docs(spark, ["a b"]), spark.createDataFrame([], "item_id long, text string")).count() == 0


def test_groups_below_the_floor_are_not_scored():
    rng = np.random.default_rng(4)
    n = 20_000
    term = np.concatenate([np.full(n, 0), np.full(200, 1), np.full(60, 2)])
    doc = np.concatenate([np.arange(n), rng.choice(n, 200, False), rng.choice(n, 60, False)])
    block = P.Block(np.arange(n), np.ones(n, bool), np.full(n, 100), doc[np.lexsort((doc, term))], np.sort(term), np.ones(len(doc), np.int64), 3)
    best = P.Best(20)
    assert P.search(block, np.arange(3), np.array([1, 5000, 9000]), best) < 1000
    every = np.zeros(n, np.int64)
    for t, w in enumerate([1, 5000, 9000]):
        d, part = block.of(t)
        every[d] += w * part
    order = np.lexsort((np.arange(n), -every))[:20]
    assert best.id.tolist() == order.tolist() and best.score.tolist() == every[order].tolist()
