import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from citylake.llm.tokens import tiktoken_encoder, tokenizers_encoder

ODD = ["", " ", "  ", "a", " a", "a ", "a  b", "a \n b", "\n\n\nx", "x \t y z", "don't, we'LL 's'", "été Étoile. ÉCOLE!", "ends.\n",
       "a\x1cb \x1d c", "x <|endoftext|> y", "a  <|endoftext|>", "ΟΔΥΣΣΕΥΣ ΣΑΣ.", "İstanbul ǅ", "é à,", "12,345.67 ½ ²", "日本語 テスト。",
       "emoji 😀😀 ‍", "word," * 50, "a" * 300, "..,, !!?? a.. b!,", " x  y", "tab\tsep\r\nline"]


def texts():
    rng = random.Random(5)
    alphabet = ["a", "the", "Élan", " ", "  ", "\n", ",", ".", "'s", "9", "x,", "ß", "Ω", "\t", "!?", "日"]
    return ODD + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(40))) for _ in range(1500)]


@pytest.mark.parametrize("name, kind", [("byte_bpe_50k.json", "bytes"), ("word_bpe_49k.json", "words")])
def test_chunked_ids_are_the_ids_of_the_whole_text(name, kind):
    path = public_tokenizers.path(name)
    whole = Tokenizer.from_file(path)
    encoder = tokenizers_encoder(path, kind)
    encoder.max_chunks = 500  # cleared on the way
    many = texts()
    for first in range(0, len(many), 100):
        part = many[first:first + 100]
        ids, counts = encoder.encode(part)
        at = 0
        for t, n in zip(part, counts, strict=True):
            assert ids[at:at + n].tolist() == whole.encode(t, add_special_tokens=False).ids, repr(t)
            at += n
    encoder.max_chunks = 600_000


def test_tiktoken_chunks():
    import base64

    import tiktoken
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    whole = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    encoder, lengths = tiktoken_encoder(path)
    many = texts()
    ids, counts = encoder.encode(many)
    at = 0
    for t, n in zip(many, counts, strict=True):
        assert ids[at:at + n].tolist() == whole.encode_ordinary(t), repr(t)
        assert lengths[ids[at:at + n]].sum() == len(t.encode())
        at += n


@pytest.mark.parametrize("name, kind", [("byte_bpe_50k.json", "bytes"), ("word_bpe_49k.json", "words")])
def test_special_strings_in_other_case_are_ordinary_text(name, kind):
    path = public_tokenizers.path(name)
    whole = Tokenizer.from_file(path)
    many = [t for s in ("<|EndOfText|>", "<|ENDOFTEXT|>", "<|StartOfText|>", "<|endoftext|>", "<|STARTOFTEXT|>")
            for t in (s, f"a {s} b", f"a{s}b", f"é {s}", f"日 {s}", f"{s} <|endoftext|>", f"{s}\n{s.lower()} {s}")]
    ids, counts = tokenizers_encoder(path, kind).encode(many)
    at = 0
    for t, n in zip(many, counts, strict=True):
        assert ids[at:at + n].tolist() == whole.encode(t, add_special_tokens=False).ids, repr(t)
        at += n


def test_the_library_gets_few_chunks_at_a_time_and_kept_chunks_keep_their_ids():
    from citylake.llm import tokens
    path, seen = public_tokenizers.path("byte_bpe_50k.json"), []
    whole = Tokenizer.from_file(path)
    encoder = tokenizers_encoder(path, "bytes")
    joined = encoder.encode_joined
    encoder.clear()
    encoder.encode_joined = lambda chunks, sizes: seen.append(len(chunks)) or joined(chunks, sizes)
    try:
        many = [" ".join(f"w{i * j}x" for j in range(40)) for i in range(1, 800)]
        for _ in range(2):
            ids, counts = encoder.encode(many)
            assert ids.tolist() == [i for t in many for i in whole.encode(t, add_special_tokens=False).ids] and counts.sum() == len(ids)
            encoder.forget()
    finally:
        encoder.encode_joined = joined
    assert max(seen) <= tokens.SLICE < sum(seen)


def test_words_that_go_to_the_model_without_patterns_have_the_ids_of_the_whole_text():
    path = public_tokenizers.path("word_bpe_49k.json")
    whole, encoder, rng = Tokenizer.from_file(path), tokenizers_encoder(path, "words"), random.Random(9)
    letters = [chr(c) for c in range(0x41, 0x250) if chr(c).isalpha()]
    words = ["".join(rng.choice(letters) for _ in range(rng.randrange(1, 9))) + rng.choice(["", "", *".,;:!?"]) for _ in range(4000)]
    encoder.clear()
    seen, joined = [], encoder.encode_joined
    encoder.encode_joined = lambda chunks, sizes: seen.extend(chunks) or joined(chunks, sizes)
    try:
        # the last texts keep their capitals until the library lowers them
        many = [" ".join(words[i:i + 50]) + (" Ω" if i >= 3000 else "") for i in range(0, len(words), 50)]
        ids, counts = encoder.encode(many)
    finally:
        encoder.encode_joined = joined
    want = [whole.encode(t, add_special_tokens=False).ids for t in many]
    assert ids.tolist() == [i for one in want for i in one] and counts.tolist() == [len(one) for one in want]
    assert len(seen) > 3000
    ids, counts = joined(("été,", "École", "mot"), np.array([2, 1, 1]))  # ids as one array, not as bytes of each chunk
    assert ids.dtype == np.uint16 and [ids[:counts[0]].tolist(), ids[-counts[2]:].tolist()] == [whole.encode(t, add_special_tokens=False).ids for t in ("été,", "mot")]
