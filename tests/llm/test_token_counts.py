import numpy as np
import public_tokenizers
import pytest

from citylake.llm.token_counts import RULES, crossing, interval_counts, token_counts, token_spans
from citylake.llm.tokens import tiktoken_encoder
from tests.llm.helpers import docs, with_extra

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


def slow(text, sections, rule):
    """Each token against each section, character by character."""
    encoder, lengths = tiktoken_encoder(PATH)
    ids, _ = encoder.encode([text])
    got, cut = [0.0] * len(sections), [0] * len(sections)
    raw, at = text.encode(), 0
    char_of = [i for i, c in enumerate(text) for _ in c.encode()]
    for t in ids:
        n = int(lengths[t])
        chars = sorted(set(char_of[at:at + n]))
        at += n
        anchor = {"first": chars[0], "last": chars[-1], "middle": (chars[0] + chars[-1]) // 2, "share": None}[rule]
        for k, (lo, hi) in enumerate(sections):
            inside = sum(lo <= c < hi for c in chars)
            got[k] += inside / len(chars) if rule == "share" else lo <= anchor < hi
            cut[k] += 0 < inside < len(chars)
    assert at == len(raw)
    return got, cut


@pytest.mark.parametrize("rule", RULES)
def test_rules_against_a_slow_form(rule):
    text = "Élan vital\nthe unbelievable 日本語 emoji 😀 costs £5.\n\nlast line"
    sections = [(0, 3), (3, 14), (14, 20), (0, len(text)), (5, 5), (25, 33), (30, len(text))]
    encoder, lengths = tiktoken_encoder(PATH)
    ids, _ = encoder.encode([text])
    starts, ends = token_spans(ids, lengths, text)
    lo, hi = (np.array(x) for x in zip(*sections, strict=True))
    want, cut = slow(text, sections, rule)
    assert np.allclose(interval_counts(starts, ends, lo, hi, rule), want)
    assert crossing(starts, ends, lo, hi).tolist() == cut


def test_sections_tile_the_document(spark):
    texts = ["one line", "two\nlines here\n", "", None, "naïve café\n日本語", "same", "same", "long " * 30_000]
    df = with_extra(docs(spark, texts))
    rows = token_counts(df, PATH, fields=("source", "lang", "text")).collect()
    encoder, _ = tiktoken_encoder(PATH)
    for i, t in enumerate(texts):
        mine = sorted((r for r in rows if r.doc_id == i), key=lambda r: (r.start, r.end))
        whole = "\n".join(["src0", "en"] + ([t] if t is not None else []))
        n = int(encoder.encode([whole])[1][0])
        assert {r.doc_tokens for r in mine} == {n} and sum(r.n_tokens for r in mine) == n
        assert mine[0].start == 0 and mine[-1].end == len(whole)
        assert all(a.end == b.start for a, b in zip(mine, mine[1:]))
    assert token_counts(docs(spark, []), PATH).count() == 0
    only = token_counts(docs(spark, [None]), PATH).collect()
    assert [(r.section, r.n_tokens) for r in only] == [(None, 0.0)]
