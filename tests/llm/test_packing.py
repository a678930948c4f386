import itertools
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from citylake.llm.cutting_stock import best_pattern, first_fit, patterns, plan
from citylake.llm.packing import pack_documents, pack_lengths
from tests.llm.helpers import docs, with_extra

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_knapsack_against_all_multisets():
    rng = np.random.default_rng(1)
    for _ in range(30):
        window = int(rng.integers(5, 14))
        lengths = np.unique(rng.integers(2, window + 1, 4))
        value = rng.random(len(lengths))
        got, copies = best_pattern(lengths, value, window)
        best = max(np.dot(c, value) for c in itertools.product(*(range(window // x + 1) for x in lengths)) if np.dot(c, lengths) <= window)
        assert np.isclose(got, best) and copies @ lengths <= window and np.isclose(copies @ value, best)


def test_linear_program_meets_demand_and_bound():
    rng = np.random.default_rng(2)
    lengths = np.arange(1, 64)
    demand = np.ceil(rng.integers(50, 200, len(lengths)) * np.exp(-lengths / 30))
    got = patterns(lengths, demand, 64, 2000)
    assert np.allclose(sum(c * u for c, u in got), demand) or (sum(c * u for c, u in got) >= demand - 1e-6).all()
    assert sum(u for _, u in got) <= max((lengths @ demand) / 64, demand[lengths > 32].sum()) * 1.01
    allocations, left, n = plan({int(x): int(d) for x, d in zip(lengths, demand)}, 64, 0)
    assert sum((hi - lo) * x for x, lo, hi, *_ in allocations) == 64 * n
    assert n >= 0.9 * (lengths @ demand) / 64


def check(rows, window, sizes):
    """Every token in one piece, every sequence gapless."""
    seqs, doc = {}, {}
    for rid, start, length, seq, offset in rows:
        seqs.setdefault(seq, []).append((offset, length))
        doc.setdefault(rid, []).append((start, length))
    for rid, n in sizes.items():
        at = 0
        for s, k in sorted(doc.get(rid, [])):
            assert s == at and k > 0
            at += k
        assert at == n
    fills = []
    for spans in seqs.values():
        at = 0
        for o, k in sorted(spans):
            assert o == at
            at += k
        assert at <= window
        fills.append(at)
    assert sorted(seqs) == list(range(len(seqs)))
    return fills


@pytest.mark.parametrize("kind", ["uniform", "one length", "few", "none", "long"])
def test_every_token_in_one_piece(spark, kind):
    rng = np.random.default_rng(3)
    sizes = {"uniform": rng.integers(1, 300, 800), "one length": np.full(500, 41), "few": np.array([64, 128, 1]),
             "none": np.zeros(0, int), "long": rng.integers(1, 20_000, 20)}[kind].tolist()
    df = spark.createDataFrame(list(enumerate(sizes)), "rid long, n long")
    rows = [(r.rid, p.start, p.length, p.sequence_id, p.offset) for r in pack_lengths(df, 64).collect() for p in r.pieces]
    fills = check(rows, 64, dict(enumerate(sizes)))
    assert sum(64 - f for f in fills) <= 2 * len(fills) + 64
    if kind == "uniform":
        cut = sum(1 for r in rows) - sum(-(-n // 64) for n in sizes)
        assert cut < 0.15 * len(sizes)  # most remainders stay whole


def test_documents(spark):
    texts = ["Hello world", "", None, "same", "same", "très long " * 3000] + [f"number {i} " * (i % 90) for i in range(200)]
    df = with_extra(docs(spark, texts))
    tok = Tokenizer.from_file(PATH)
    ids = {i: np.array(tok.encode(t or "", add_special_tokens=False).ids + [0], "<u4") for i, t in enumerate(texts)}
    rows = pack_documents(df, PATH, window=128, digest=True).collect()
    fills = check([(r.doc_id, r.start, r.length, r.sequence_id, r.offset) for r in rows], 128, {i: len(v) for i, v in ids.items()})
    assert sum(fills) == sum(map(len, ids.values()))
    for r in rows:
        assert r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start:r.start + r.length].tobytes()) and r.doc_tokens == len(ids[r.doc_id])
    full = pack_documents(df, PATH, window=128).where(F.col("doc_id") == 5).collect()
    assert b"".join(bytes(r.ids) for r in sorted(full, key=lambda r: r.start)) == ids[5].tobytes()
    assert pack_documents(docs(spark, []), PATH).count() == 0
    twice = pack_documents(docs(spark, ["a b c"] * 3, ids=[1, 1, None]), PATH, window=8).collect()
    assert sum(r.length for r in twice) == 3 * len(tok.encode("a b c").ids) + 3


def test_little_is_left_to_cut():
    rng = np.random.default_rng(4)
    h = {int(x): int(k) for x, k in zip(*np.unique(rng.integers(1, 128, 50_000), return_counts=True))}
    allocations, given, n = plan(h, 128, 2)
    assert sum((h[x] - given[x]) * x for x in h) < 0.05 * sum(k * x for x, k in h.items())
    fill = np.zeros(n, int)
    for length, lo, hi, copies, first, _ in allocations:
        fill[first:first + (hi - lo) // copies] += copies * length
    assert fill.min() >= 126 and fill.max() <= 128
    assert plan({}, 128, 2) == ([], {}, 0)


def test_columns_are_priced_beyond_the_first_fit():
    lengths, demand, window = np.array([3, 4, 5]), np.array([60.0, 40.0, 50.0]), 12
    got = patterns(lengths, demand, window, gap=0.0)
    assert (sum(c * u for c, u in got) >= demand - 1e-6).all()
    every = [c for c in itertools.product(range(5), range(4), range(3)) if np.dot(c, lengths) <= window]
    first = sum(n for _, n in first_fit(lengths, demand, window))
    best = sum(u for _, u in got)
    assert best <= first + 1e-3
    # optimal: the dual values of the result price no pattern over 1
    basis = np.array([c for c, _ in got], float)
    assert len(basis) == 3 and (np.array(every) @ np.linalg.solve(basis, np.ones(3)) <= 1 + 1e-6).all()


def test_whole_texts_go_to_python_in_short_batches(spark, monkeypatch):
    from citylake.llm import packing, token_files
    seen = spark.sparkContext.accumulator(0)

    def encode(df, *args):
        def sizes(batches):
            for b in batches:
                if b.num_rows > 1000:
                    seen.add(1)
                yield b
        return token_files.encode_documents(df.mapInArrow(sizes, df.schema), *args)

    monkeypatch.setattr(packing, "encode_documents", encode)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    df = spark.range(0, 6000, 1, 2).selectExpr("id AS doc_id", "concat('text of ', id) AS text")
    got = pack_documents(df, PATH, window=64).collect()
    assert seen.value == 0 and spark.conf.get(key) == before
    tok = Tokenizer.from_file(PATH)
    ids = {}
    for r in sorted(got, key=lambda r: (r.doc_id, r.start)):
        ids[r.doc_id] = ids.get(r.doc_id, []) + np.frombuffer(r.ids, "<u4").tolist()
    assert ids == {i: [*tok.encode(f"text of {i}", add_special_tokens=False).ids, 0] for i in range(6000)}
