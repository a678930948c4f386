"""Token counts by offset-mapped attribution.

A document is rendered from its fields and encoded once, whole. Every token carries its character
span; fields and the lines of the body are intervals over the same characters. Each section counts
the tokens that an explicit rule gives it, so a token that crosses a boundary is never encoded twice
or lost.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citylake.llm.common import byte_slices
from citylake.llm.tokens import tiktoken_encoder

RULES = ("first", "last", "middle", "share")


def token_spans(ids: np.ndarray, lengths: np.ndarray, text: str) -> tuple[np.ndarray, np.ndarray]:
    """Character spans [start, end) of byte-level tokens; a token that holds part of a character
    spans the whole character."""
    ends = np.cumsum(lengths[ids])
    starts = ends - lengths[ids]
    raw = text.encode("utf-8", "surrogatepass")
    if len(raw) == len(text):
        return starts, ends
    char = np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80) - 1
    return char[starts], char[ends - 1] + 1


def interval_counts(starts, ends, lo, hi, rule: str) -> np.ndarray:
    """Tokens that the sections [lo, hi) get. ``first``, ``last`` and ``middle`` give a token to the
    section with its first, last or middle character ((start + end - 1) // 2); ``share`` divides it
    by characters. Both token arrays ascend, so each section is two binary searches."""
    if rule == "share":
        def before(x):
            at = np.searchsorted(ends, x, "right")
            in_range = np.minimum(at, max(len(starts) - 1, 0))
            if not len(starts):
                return np.zeros(len(x))
            s, e = starts[in_range], ends[in_range]
            return at + np.where((at < len(starts)) & (s < x), (x - s) / np.maximum(e - s, 1), 0.0)
        return before(hi) - before(lo)
    anchor = {"first": starts, "last": ends - 1, "middle": (starts + ends - 1) // 2}[rule]
    return (np.searchsorted(anchor, hi, "left") - np.searchsorted(anchor, lo, "left")).astype(float)


def crossing(starts, ends, lo, hi) -> np.ndarray:
    """Tokens that lie partly in and partly outside each section."""
    def cut(x):
        at = np.searchsorted(ends, x, "right")
        ok = at < len(starts)
        return np.where(ok & (starts[np.minimum(at, max(len(starts) - 1, 0))] < x), at, -1) if len(starts) else np.full(len(x), -1)
    a, b = cut(lo), cut(hi)
    some = hi > lo
    return ((a >= 0) & some).astype(np.int64) + ((b >= 0) & (b != a) & some)


def token_counts(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", fields: tuple[str, ...] = ("text",),
                 body: str = "text", rule: str = "middle") -> DataFrame:
    """One row per document and section.

    The document is the non-null ``fields`` in order, joined by newlines. Sections are each field, and
    for the field ``body`` each of its newline-separated lines; a section holds its closing newline, so
    the sections tile the document and (but for ``share``'s rounding) their counts add up to
    ``doc_tokens``. Columns: id, ``section`` (field), ``part`` (line, from 0), ``start`` and ``end``
    (characters), ``n_tokens`` (double), ``n_cut`` (tokens that cross one of its bounds),
    ``doc_tokens``. A null field and an empty text give no tokens: a null field has no row, an empty
    one a row of zero tokens or just its newline. A document whose fields are all null has no row but
    one with null ``section``. Repeated rows are counted each by itself; other columns are ignored.
    """
    if rule not in RULES:
        raise ValueError(f"rule is one of {RULES}")
    id_type = docs.schema[id_col].dataType.simpleString()
    names = list(fields)

    def count(batches):
        encoder, lengths = tiktoken_encoder(tokenizer_path)
        for batch in batches:
            columns = [batch.column(i + 1).to_pylist() for i in range(len(names))]
            parts = [[(n, v) for n, v in zip(names, row, strict=True) if v is not None] for row in zip(*columns, strict=True)]
            texts = ["\n".join(v for _, v in row) for row in parts]
            for first, last in byte_slices(texts):
                ids, counts = encoder.encode(texts[first:last])
                stops = np.cumsum(counts)
                out = {k: [] for k in ("row", "section", "part", "start", "end", "n_tokens", "n_cut", "doc_tokens")}
                for i, stop, n in zip(range(first, last), stops, counts, strict=True):
                    sections, line, sizes = [], [], []
                    for name, value in parts[i]:
                        pieces = value.split("\n") if name == body else [value]
                        sections += [name] * len(pieces)
                        line += range(len(pieces))
                        sizes += [len(p) + 1 for p in pieces]
                    if not sections:
                        sections, line, sizes = [None], [0], [1]
                    hi = np.minimum(np.cumsum(sizes), len(texts[i]))
                    lo = np.concatenate([[0], hi[:-1]])
                    starts, ends = token_spans(ids[stop - n:stop], lengths, texts[i])
                    out["row"] += [i] * len(sections)
                    out["section"] += sections
                    out["part"] += line
                    out["start"].append(lo)
                    out["end"].append(hi)
                    out["n_tokens"].append(interval_counts(starts, ends, lo, hi, rule))
                    out["n_cut"].append(crossing(starts, ends, lo, hi))
                    out["doc_tokens"] += [int(n)] * len(sections)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(out["row"], pa.int64())), pa.array(out["section"], pa.string()),
                     pa.array(out["part"], pa.int32()), *(pa.array(np.concatenate(out[k]).astype(np.int64)) for k in ("start", "end")),
                     pa.array(np.concatenate(out["n_tokens"])), pa.array(np.concatenate(out["n_cut"]).astype(np.int64)),
                     pa.array(out["doc_tokens"], pa.int64())],
                    ["id", "section", "part", "start", "end", "n_tokens", "n_cut", "doc_tokens"])

    narrow = docs.select(F.col(f"`{id_col}`").alias("id"), *(F.col(f"`{n}`").cast("string").alias(f"f{i}") for i, n in enumerate(names)))
    schema = f"id {id_type}, section string, part int, start long, end long, n_tokens double, n_cut long, doc_tokens long"
    return narrow.mapInArrow(count, schema).withColumnRenamed("id", id_col)
