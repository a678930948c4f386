import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from citylake.llm.decontamination import contamination_report, decontaminate, filter_bits, words_of
from tests.llm.helpers import docs, with_extra

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def slow_words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def slow(texts, items, window=10):
    out = {}
    for d, t in texts:
        w = slow_words(t)
        hit, found = set(), set()
        for item, it in items:
            iw = slow_words(it)
            for i in range(max(len(iw) - window + 1, 1) if iw else 0):
                x = iw[i:i + window]
                for s in range(len(w) - len(x) + 1):
                    if w[s:s + len(x)] == x:
                        hit.update(range(s, s + len(x)))
                        found.add("" if item is None else str(item))
        out[d] = (len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit))
    return out


def run(spark, texts, items, extra=False):
    df = docs(spark, [t for _, t in texts], ids=[d for d, _ in texts])
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = contamination_report(with_extra(df) if extra else df, with_extra(bench) if extra else bench).collect()
    return {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in rows}, len(rows)


def test_words(spark):
    texts = ["ÉTÉ Été x-Y_z", "", None, "a\tB\x00c\x7fd", "ΣΑΣ İ ǅ Ⓐ", "...", "ABC123 9-8"]
    got = [r.w for r in docs(spark, texts).orderBy("doc_id").select(words_of(F.col("text")).alias("w")).collect()]
    assert got == [slow_words(t) for t in texts]


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    rng = random.Random(seed)
    vocabulary = ["the", "of", "Été", "x1", "a", "to", "zz", "q"] if seed == 1 else ["the", "a"]
    def some(n):
        return "".join(rng.choice(vocabulary) + rng.choice([" ", ", ", "\n"]) for _ in range(n))
    items = [(i, some(rng.choice([1, 2, 3, 5, 9, 10, 11, 25]) if seed == 1 else rng.choice([10, 12]))) for i in range(12)] + [(90, None), (91, "..."), (None, some(14))]
    texts = []
    for d in range(40):
        t = some(rng.choice([0, 3, 12, 60]))
        if d % 3 == 0 and items[d % 12][1]:
            t += items[d % 12][1].upper().replace("É", "É") + some(4)
        texts.append((d, t))
    texts += [(100, None), (101, ""), (102, some(3) + (items[7][1] or "")), (103, some(3) + (items[7][1] or ""))]
    got, n = run(spark, texts, items, extra=True)
    assert n == len(texts) and got == slow(texts, items)


def test_empty_tables_and_copies(spark):
    passage = " ".join(f"word{i}" for i in range(30))
    texts = [(i, "lead in " + passage) for i in range(50)] + [(50, "clean " * 30), (51, " ".join(f"word{i}" for i in range(9)))]
    got, _ = run(spark, texts, [(5, passage), (11, passage)])
    assert all(got[i][1:3] == (30, 2) for i in range(50)) and got[50][1] == got[51][1] == 0
    assert run(spark, [], [(1, passage)]) == ({}, 0)
    none, n = run(spark, texts[:2], [])
    assert n == 2 and all(not v[4] for v in none.values())
    df = docs(spark, [t for _, t in texts])
    bench = spark.createDataFrame([(5, passage)], "item_id long, text string")
    kept = decontaminate(df, bench)
    assert sorted(r.doc_id for r in kept.collect()) == [50, 51] and kept.columns == df.columns
    plan = contamination_report(df, bench)._jdf.queryExecution().toString()
    assert "Cartesian" not in plan and "Python" not in plan


def test_oracle_at_small_scale(spark):
    import duckdb
    from citylake.llm.queries import ORACLE, QUERIES
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    cur = con.execute(ORACLE["op9_decontamination"])
    names = [c[0] for c in cur.description]
    want = sorted(tuple(r) for r in cur.fetchall())
    got = sorted(tuple(r[n] for n in names) for r in QUERIES["op9_decontamination"](spark, sf).collect())
    assert got == want and sum(r[-1] for r in got) > 0


def test_filter_grows_with_its_hashes():
    assert [filter_bits(n) for n in (0, 1, 128, 129, 100_000, 2_000_000, 10 ** 9)] == [12, 12, 12, 13, 22, 26, 26]


def test_many_items(spark):
    rng = random.Random(5)
    items = [(i, " ".join(f"w{rng.randrange(3000)}" for _ in range(rng.choice([1, 2, 4, 12])))) for i in range(100_000)]
    texts = [(d, " ".join(f"w{rng.randrange(3000)}" for _ in range(30))) for d in range(200)]
    texts += [(1000 + d, "so " + items[i][1] + " on") for d, i in enumerate(rng.sample(range(100_000), 200))]
    windows = {}
    for i, t in items:
        w = t.split()
        for k in range(max(len(w) - 9, 1)):
            windows.setdefault(tuple(w[k:k + 10]), set()).add(str(i))
    want = {}
    for d, t in texts:
        w, hit, found = t.split(), set(), set()
        for s in range(len(w)):
            for n in (1, 2, 4, 10):
                if s + n <= len(w) and (x := tuple(w[s:s + n])) in windows:
                    hit.update(range(s, s + n))
                    found |= windows[x]
        want[d] = (len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit))
    got, n = run(spark, texts, items)
    assert n == len(texts) and got == want
