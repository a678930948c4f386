import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from citylake.llm.huffman import Code, code_lengths
from citylake.llm.token_files import read_tokens, write_tokens
from tests.llm.helpers import docs, with_extra

PATH = public_tokenizers.path("word_bpe_49k.json")


def huffman_cost(counts):
    import heapq
    heap = [int(c) for c in counts if c]
    heapq.heapify(heap)
    total = 0
    while len(heap) > 1:
        a, b = heapq.heappop(heap), heapq.heappop(heap)
        total += a + b
        heapq.heappush(heap, a + b)
    return total


@pytest.mark.parametrize("n", [0, 1, 2, 3, 100, 3000])
def test_round_trip(n):
    rng = np.random.default_rng(n)
    ids = (rng.pareto(0.7, 20_000) * 3).astype(np.int64) % max(n, 1) if n else np.zeros(0, np.int64)
    counts = np.bincount(ids, minlength=max(n, 1) + 5)
    lengths = code_lengths(counts, 16)
    assert sum(2.0 ** -int(x) for x in lengths if x) <= 1 and lengths.max() <= 16
    code = Code(lengths)
    for block in (1, 7, 512):
        bits, offsets = code.encode(ids, block)
        assert (code.decode(bits, offsets, len(ids), block) == ids).all()


def test_lengths_are_optimal_and_limited():
    counts = np.array([5, 9, 12, 13, 16, 45, 0, 1])
    assert (code_lengths(counts, 16) * counts).sum() == huffman_cost(counts)
    fib = [1, 1]
    while len(fib) < 30:
        fib.append(fib[-1] + fib[-2])
    tight = code_lengths(np.array(fib), 6)
    assert tight.max() <= 6 and sum(2.0 ** -int(x) for x in tight) <= 1
    with pytest.raises(ValueError):
        code_lengths(np.ones(9), 3)
    # brute force over all length tuples of a small case
    import itertools
    small = np.array([1, 2, 4, 8, 16])
    best = min((np.array(t) * small).sum() for t in itertools.product(range(1, 4), repeat=5) if sum(2.0 ** -x for x in t) <= 1)
    assert (code_lengths(small, 3) * small).sum() == best


def test_files_hold_every_document_in_order(spark, tmp_path):
    texts = ["Hello, world!", "", None, "naïve café", "same", "same", "<|endoftext|> x", "word " * 5000] * 5
    ids = [(i * 37) % 101 - 20 for i in range(len(texts))]
    df = with_extra(docs(spark, texts, ids=ids)).repartition(3)
    path = str(tmp_path / "t")
    write_tokens(df, path, PATH, segment=3000, block=64)
    tok, at = Tokenizer.from_file(PATH), 0
    got = {r.doc_id: r for r in read_tokens(spark, path, digest=True).collect()}
    full = {r.doc_id: r for r in read_tokens(spark, path).collect()}
    assert len(got) == len(texts)
    for d, t in sorted(zip(ids, texts)):
        want = np.array(tok.encode(t or "", add_special_tokens=False).ids + [1], "<u4")
        r = got[d]
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(want), zlib.crc32(want.tobytes()))
        assert bytes(full[d].ids) == want.tobytes()
        at += len(want)


def test_empty_table_ties_and_null_ids(spark, tmp_path):
    write_tokens(docs(spark, []), str(tmp_path / "e"), PATH)
    assert read_tokens(spark, str(tmp_path / "e"), digest=True).count() == 0
    write_tokens(docs(spark, ["a", "a", "b", None], ids=[1, 1, None, None]), str(tmp_path / "t"), PATH)
    rows = sorted(read_tokens(spark, str(tmp_path / "t"), digest=True).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == [None, None, 1, 1] and rows[0].start == 0 and rows[-1].start == sum(r.n_tokens for r in rows[:-1])


def test_ids_are_counted_where_they_are_encoded(spark):
    from citylake.llm.token_files import encode_documents, id_counts
    path = public_tokenizers.path("word_bpe_49k.json")
    texts = ["a b a", None, "", "été, the the", "x " * 2000] * 40
    frame = docs(spark, texts).repartition(7, "text")  # some tasks get no row
    tokens = encode_documents(frame, path, "words", "doc_id", "text", 1, vocabulary=1 << 16).cache()
    want = np.bincount([i for t in texts for i in [*Tokenizer.from_file(path).encode(t or "", add_special_tokens=False).ids, 1]], minlength=1 << 16)
    assert id_counts(tokens.drop("ids"), 1 << 16).tolist() == want.tolist()
    assert encode_documents(frame, path, "words", "doc_id", "text", 1).columns == ["id", "ids"]
    tokens.unpersist()


def test_codes_of_neighbours_are_joined_without_a_change_of_bits():
    rng = np.random.default_rng(3)
    for n, block in [(1, 4), (2, 1), (5, 3), (4099, 512), (1000, 7)]:
        ids = rng.integers(0, 65536, n).astype("<u2")
        for code in (Code(np.full(65536, 16, np.uint8)), Code(code_lengths(np.bincount(ids, minlength=65536)))):
            bits, offsets = code.encode(ids, block)
            plain = "".join(format(int(code.codes[i]), f"0{code.lengths[i]}b") for i in ids)
            assert "".join(f"{b:08b}" for b in bits).startswith(plain) and len(bits) == -(-len(plain) // 8)
            ends = np.cumsum(code.lengths[ids])
            assert offsets.tolist() == (ends - code.lengths[ids])[::block].tolist()
