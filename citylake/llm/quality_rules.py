"""Quality rules: fixed base rules and gradient-boosted trees over statistics of whole texts."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citylake.llm import boosting

FEATURES = ("log_words", "word_length", "symbols", "duplicate_lines", "repeated_words", "upper", "digits", "marks", "distinct_words",
            "line_words", "long_words", "short_words", "other_scripts")
#: Quality never rises with these shares.
MONOTONE = {"symbols": -1, "duplicate_lines": -1, "repeated_words": -1, "upper": -1}
#: Labelled rows used for fitting, at most: those of the least xxhash64(id).
FIT_ROWS = 6000
_SPACE = " \t\n\x0b\x0c\r"


def repeated_words(words: list[bytes], width: int = 5) -> int:
    """Words inside windows of ``width`` words that occur twice or more, the first occurrence included."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    seen: dict[bytes, int] = {}
    ids = np.array([seen.setdefault(w, len(seen)) for w in words], np.int64)
    key, size = ids[:n], len(seen)
    for k in range(1, width):
        if size > (1 << 62) // max(len(seen), 1):  # ranks instead, so that keys stay exact
            key = np.unique(key, return_inverse=True)[1]
            size = int(key.max()) + 1
        key = key * len(seen) + ids[k:n + k]
        size *= len(seen)
    _, inverse, counts = np.unique(key, return_inverse=True, return_counts=True)
    twice = (counts > 1)[inverse].astype(np.int64)
    edge = np.zeros(len(words) + 1, np.int64)
    edge[:n] += twice
    edge[width:n + width] -= twice
    return int((np.cumsum(edge)[:-1] > 0).sum())


def statistics(text: str) -> tuple[list[int], list[float]]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) and the features of one whole text."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()  # bytes split at ASCII white space alone
    n = len(words)
    chars = len(text) - sum(text.count(c) for c in _SPACE)
    symbols = sum(raw.count(c) for c in (b"#", b"*", b"$", b"%", b"&", b"|", b"<", b">"))
    lines = [x for x in text.split("\n") if x.strip(_SPACE)]
    dup = len(lines) - len(set(lines))
    repeat = repeated_words(words)
    some, some_chars, some_lines = max(n, 1), max(chars, 1), max(len(lines), 1)
    kind = np.bincount(_KIND[np.frombuffer(raw, np.uint8)], minlength=6)
    sizes = np.fromiter(map(len, words), np.int64, n)
    return [n, chars, symbols, dup, repeat], [
        float(np.log1p(n)), chars / some, symbols / some_chars, dup / some_lines, repeat / some, kind[1] / some_chars, kind[2] / some_chars,
        kind[3] / some_chars, len(set(words)) / some, n / some_lines, float((sizes > 15).sum()) / some, float((sizes < 3).sum()) / some, kind[4] / some_chars]


#: Byte classes: 1 upper case, 2 digit, 3 other ASCII mark, 4 first byte of a character beyond ASCII, 0 lower case.
_KIND = np.zeros(256, np.int64)
for _b in range(256):
    _c = chr(_b)
    _KIND[_b] = (1 if "A" <= _c <= "Z" else 2 if "0" <= _c <= "9" else 0 if "a" <= _c <= "z" else 5 if _c in _SPACE or 128 <= _b < 192 else 4 if _b >= 192 else 3)


def fit_quality(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, id_col: str = "doc_id", text_col: str = "text",
                label_col: str = "quality") -> boosting.Trees:
    """Fit on at most ``fit_rows`` labelled rows, chosen by hash of the id; their texts are measured where they lie, and only
    their statistics are sorted and reach the driver. Null labels and ids are left out."""
    key = F.col(f"`{id_col}`")
    picked = (labels.where(F.col(f"`{label_col}`").isNotNull() & key.isNotNull()).select(key.alias("_label_id"), F.col(f"`{label_col}`").cast("double").alias("_label"))
              .orderBy(F.xxhash64("_label_id"), "_label_id", "_label").limit(fit_rows))

    def measure(batches):
        for batch in batches:
            rows = [statistics(t or "")[1] for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.float64())), batch.column(1), batch.column(2)], ["x", "y", "h"])

    rows = (docs.select(key.alias("_id"), F.col(f"`{text_col}`").alias("_text")).join(F.broadcast(picked), F.col("_id") == F.col("_label_id"))
            .select("_text", "_label", F.xxhash64("_id", "_text").alias("_order"))
            .mapInArrow(measure, "x array<double>, y double, h long").orderBy("h", "y", "x").limit(2 * fit_rows).select("x", "y").collect())
    rows.sort(key=lambda r: (r["x"], r["y"]))
    x = np.array([r["x"] for r in rows]).reshape(len(rows), len(FEATURES))
    return boosting.fit(x, np.array([r["y"] for r in rows]), {FEATURES.index(k): v for k, v in MONOTONE.items()})


def quality_report(docs: DataFrame, model: boosting.Trees, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """One row per input row: id, ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``,
    ``base_failed`` (below 10 words, or more than a fifth of them repeated), ``score`` of the trees and ``kept``
    (not base_failed, and the score is at least ``threshold``). A null text has no words, so it fails. No shuffle;
    repeated rows are scored each; other columns are ignored."""
    def score(batches):
        for batch in batches:
            both = [statistics(t or "") for t in batch.column(1).to_pylist()]
            base = np.array([b for b, _ in both], np.int64).reshape(len(both), 5)
            p = model.probability(np.array([f for _, f in both]).reshape(len(both), len(FEATURES)))
            failed = (base[:, 0] < 10) | (100 * base[:, 4] > 20 * base[:, 0])
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(base[:, k]) for k in range(5)), pa.array(failed), pa.array(p),
                                              pa.array(~failed & (p >= threshold))],
                                             ["id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "score", "kept"])

    id_type = docs.schema[id_col].dataType.simpleString()
    schema = (f"id {id_type}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
              "base_failed boolean, score double, kept boolean")
    return docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")).mapInArrow(score, schema).withColumnRenamed("id", id_col)
