"""Benchmark decontamination by a prefix-filtered set join, in DataFrame functions only.

A benchmark item is cut into windows of ten words, and a window into short shingles. Shingles are
ordered by their number of occurrences in the whole corpus. A text can hold a window only if it holds the window's rarest shingle,
so that shingle is the necessary prefix for exact containment and alone is joined. The shingle's place in the window then
fixes where an occurrence must begin: it must lie inside the text (length and position bounds), and
the words there must equal the window's.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citylake.llm.common import filter_bits, hash_filter, staged, unused  # noqa: F401

#: What separates words: ASCII but digits and lower-case letters.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Characters that lower() may change although A-Z doesn't hold them.
OTHER_UPPER = r"[\p{IsUppercase}\p{Lt}&&[^A-Z]]"


def words_of(text: Column) -> Column:
    """Words of the text with A-Z, and nothing else, in lower case; null has none."""
    text = F.coalesce(text, F.lit(""))
    lowered = F.when((F.octet_length(text) > F.char_length(text)) & text.rlike(OTHER_UPPER), F.translate(text, string.ascii_uppercase, string.ascii_lowercase)).otherwise(F.lower(text))
    return F.array_remove(F.split(lowered, SEPARATORS, -1), "")


def digest_of(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def _hash(words: Column, at: Column, size: int) -> Column:
    return F.xxhash64(*(F.get(words, at + k) for k in range(size)), F.lit(size))


def benchmark_windows(benchmark: DataFrame, window: int, item_col: str, text_col: str) -> DataFrame:
    """(item, words): the distinct windows of each item; an item of fewer words, but not none, is one."""
    items = benchmark.select(F.col(f"`{item_col}`").alias("item"), words_of(F.col(f"`{text_col}`")).alias("w"))
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - window + 1, F.lit(1)))
    return (items.where(F.size("w") > 0).select("item", "w", F.explode(starts).alias("i"))
            .select("item", F.slice("w", F.col("i"), window).alias("words")).distinct())


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10, shingle: int = 3, text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """For each distinct text that holds a window: ``digest`` (md5 of the text), ``n_hit`` (words inside
    occurrences), ``n_items``, ``items`` (the item ids with occurring windows, as sorted strings).

    The texts themselves are never shuffled: scans explode them to shingles, which the filter
    thins out to those of the benchmark. Equal texts share a digest, and their equal rows are reduced
    before and at each exchange. Items with a null id count as an item named by the empty string.
    """
    staged_windows = staged(benchmark_windows(benchmark, window, item_col, item_text_col), "windows")
    windows = staged(staged_windows.groupBy("words").agg(F.count("*").alias("items"))
                     .select(F.monotonically_increasing_id().alias("wid"), "words", F.size("words").alias("n"),
                             F.least(F.size("words"), F.lit(shingle)).alias("s")), "distinct-windows")
    sizes = sorted(r["s"] for r in windows.select("s").distinct().collect())  # at most ``shingle`` values
    places = windows.select("wid", "words", "n", "s", F.explode(F.sequence(F.lit(0), F.col("n") - F.col("s"))).alias("o"))
    hashed = F.lit(None).cast("long")
    for s in sizes:
        hashed = F.when(F.col("s") == s, _hash(F.col("words"), F.col("o"), s)).otherwise(hashed)
    shingles = staged(places.withColumn("h", hashed), "shingles")

    texts = docs.select(digest_of(F.col(f"`{text_col}`")).alias("digest"), words_of(F.col(f"`{text_col}`")).alias("words"))

    def occurrences(wanted: DataFrame, *columns: Column) -> DataFrame:
        """Occurrences of shingles of all sizes, from one pass over the texts."""
        test = hash_filter(wanted)
        each = [F.struct(F.lit(s).alias("s"), F.xxhash64(F.col("word"), *(F.get("words", F.col("pos") + k) for k in range(1, s)), F.lit(s)).alias("h"))
                for s in sizes]
        exploded = texts.select("digest", "words", F.posexplode("words").alias("pos", "word"))
        exploded = exploded.select("digest", "words", "pos", each[0].alias("c") if len(each) == 1 else F.explode(F.array(*each)).alias("c"))
        return exploded.where(test(F.col("c.h"))).select(F.col("c.h").alias("h"), F.col("c.s").alias("s"), *columns)

    if not sizes:
        return staged(texts.where(F.lit(False)).select("digest", F.lit(0).cast("long").alias("n_hit"), F.lit(0).cast("long").alias("n_items"),
                                                       F.array().cast("array<string>").alias("items")), "none")
    frequency = occurrences(shingles).groupBy("s", "h").agg(F.count("*").alias("seen"))
    rarest = staged(
        shingles.join(frequency, ["s", "h"]).groupBy("wid")  # a shingle that never occurs ends its window here
        .agg(F.min(F.struct("seen", "h", "o")).alias("m"), F.count("*").alias("have"))
        .join(windows, "wid").where(F.col("have") == F.col("n") - F.col("s") + 1)
        .select("wid", F.col("words").alias("window"), "n", "s", F.col("m.o").alias("o"), F.col("m.h").alias("h")), "prefixes")

    left = F.greatest(F.col("pos") - (window - 1), F.lit(0))
    near = occurrences(rarest, F.col("digest"), F.col("pos"), F.size("words").alias("size"), left.alias("left"),
                       F.slice("words", left + 1, 2 * window - 1).alias("near"))
    start = F.col("pos") - F.col("o")
    same = F.slice("near", F.greatest(start - F.col("left") + 1, F.lit(1)), F.col("n")) == F.col("window")
    hits = staged(near.join(rarest, ["s", "h"]).where((start >= 0) & (start + F.col("n") <= F.col("size")) & same)
                  .select("digest", start.alias("start"), "n", "wid").distinct(), "hits")
    covered = (hits.select("digest", "start", "n").distinct()
               .select("digest", F.explode(F.sequence(F.col("start"), F.col("start") + F.col("n") - 1)).alias("word")).distinct()
               .groupBy("digest").agg(F.count("*").alias("n_hit")))
    owners = staged_windows.join(windows.select("wid", "words"), "words").select("wid", "item")
    items = (hits.select("digest", "wid").distinct().join(owners, "wid").select("digest", F.coalesce(F.col("item").cast("string"), F.lit("")).alias("item"))
             .distinct().groupBy("digest").agg(F.count("*").alias("n_items"), F.sort_array(F.collect_list("item")).alias("items")))
    return covered.join(items, "digest")


def contamination_report(docs: DataFrame, benchmark: DataFrame, window: int = 10, shingle: int = 3, id_col: str = "doc_id",
                         text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row per input row: id, ``n_words``, ``n_hit``, ``n_items``, ``items_sha256`` (lowercase hex of
    the sorted item ids, comma-joined; of the empty string where there are none), ``contaminated``. A null or empty text has
    no words; empty tables give no rows or no hits; other columns are ignored."""
    found = contamination(docs, benchmark, window, shingle, text_col, item_col, item_text_col)
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), digest_of(F.col(f"`{text_col}`")).alias("digest"),
                       F.size(words_of(F.col(f"`{text_col}`"))).cast("long").alias("n_words"))
    none = F.lit(0).cast("long")
    return rows.join(found, "digest", "left").select(
        F.col("id").alias(id_col), "n_words", F.coalesce("n_hit", none).alias("n_hit"), F.coalesce("n_items", none).alias("n_items"),
        F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")), 256).alias("items_sha256"),
        (F.coalesce("n_hit", none) > 0).alias("contaminated"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, all columns (any names), whose text holds no benchmark window. A row with a null text stays; repeated rows stay or go
    together."""
    name = unused(docs, "_contaminated_digest")
    found = contamination(docs, benchmark, **options).select(F.col("digest").alias(name))
    text = F.col(f"`{options.get('text_col', 'text')}`")
    return docs.join(found, digest_of(text) == F.col(name), "left_anti")


ORACLE = """
WITH dw AS (
  SELECT doc_id, [x FOR x IN string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') IF x <> ''] AS w FROM documents),
bi AS (
  SELECT item_id, [x FOR x IN string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') IF x <> ''] AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, array_to_string(w[i:i + 9], ' ') AS win, least(len(w), 10) AS n
  FROM (SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS i FROM bi WHERE len(w) > 0)),
places AS (
  SELECT doc_id, n, s, array_to_string(w[s:s + n - 1], ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS s
        FROM dw JOIN (SELECT DISTINCT n FROM bw) AS sizes ON len(w) >= n)),
hits AS (SELECT DISTINCT p.doc_id, p.s, p.n, b.item_id FROM places p JOIN bw b ON p.win = b.win AND p.n = b.n),
covered AS (
  SELECT doc_id, count(DISTINCT k) AS n_hit
  FROM (SELECT doc_id, unnest(generate_series(s, s + n - 1)) AS k FROM hits) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(c.n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(i.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(i.items, '')) AS items_sha256,
       coalesce(c.n_hit, 0) > 0 AS contaminated
FROM dw d LEFT JOIN covered c USING (doc_id) LEFT JOIN items i USING (doc_id)
"""
