"""Secret scans with corpus-wide ownership frequency.

Candidate credentials are found in every whole text and hashed. Over the whole corpus each hash is
aggregated by the distinct owners and repositories that hold it: a value that several owners hold, or many repositories of more than
one owner, is a widely copied example; a value of few, or of one owner however many repositories it has, that looks random is a
live-looking credential.
"""

from __future__ import annotations

import bisect
import hashlib
import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citylake.llm.common import staged, unused

#: Kinds in the order of a tie at one place; the first three are always reported.
KINDS = ("assign", "access", "hex", "private_key", "jwt", "url", "random")
BASE = 3
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
PRIVATE_KEY = re.compile(r"-----BEGIN [A-Z ]*PRIVATE KEY-----[^-]++-----END")
#: Where a JWT may lie: runs of its characters and dots.
JWT_RUN = re.compile(r"[A-Za-z0-9_.-]+")
URL = re.compile(r"://[^\s:/@]++:([^\s/@]{3,}+)@")
RANDOM = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
PLACEHOLDER = re.compile(r"example|sample|dummy|changeme|placeholder|your|test|xxxx|0000|1234567|abcdef", re.I)
#: Placeholder words make a value one if they are at least this share of it; a long value may hold some by chance.
PLACEHOLDER_SHARE = 8
WORDS = ("password", "passwd", "secret", "token", "api_key", "apikey")
#: A text without a match of this has no candidate.
GATE = r"(?i:password|passwd|secret|token|api_?key)|AKIA|://|-----BEGIN|[A-Za-z0-9+/_=-]{20}"
_RUN = bytes(0x61 if chr(b) in "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-" else 0x20 for b in range(256))
_HEX_RUN = bytes(0x61 if chr(b) in "0123456789abcdef" else 0x20 for b in range(256))


def entropy(value: str) -> float:
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values()) if n else 0.0


def placeholder(value: str) -> bool:
    held = sum(map(len, PLACEHOLDER.findall(value)))
    return held > 0 and PLACEHOLDER_SHARE * held >= len(value)


def jwts(text: str):
    """(start, end) of JWTs: three segments joined by dots, the first from "eyJ" on of 20 characters or more, the others of 4 or more. Each run of
    such characters is cut at its dots once."""
    for m in JWT_RUN.finditer(text):
        if "eyJ" not in m[0]:
            continue
        segments, starts, at = m[0].split("."), [], m.start()
        for x in segments:
            starts.append(at)
            at += len(x) + 1
        i = 0
        while i + 2 < len(segments):
            k = segments[i].find("eyJ")
            if k >= 0 and len(segments[i]) - k >= 20 and len(segments[i + 1]) >= 4 and len(segments[i + 2]) >= 4:
                yield starts[i] + k, starts[i + 2] + len(segments[i + 2])
                i += 3
            else:
                i += 1


def live_looking(value: str, kind: int = 0) -> bool:
    """A private key or JWT; of the other kinds, many different characters with a digit among them, and no placeholder."""
    if KINDS[kind] in ("private_key", "jwt"):
        return True
    return len(value) >= 12 and entropy(value) >= 3.0 and any(c.isdigit() for c in value) and not placeholder(value)


def scan(text: str) -> list[tuple[int, int, int, str]]:
    """(start, kind, end, value) of all candidates by start and kind: the base kinds, and others
    where they overlap nothing before them."""
    found: list[tuple[int, int, int, str]] = []
    low = text.lower()
    if any(w in low for w in WORDS):
        found += [(m.start(), 0, m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end(), m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    raw = text.encode("utf-8", "surrogatepass")
    long_run = b"a" * 20 in raw.translate(_RUN)
    if long_run and b"a" * 24 in raw.translate(_HEX_RUN):
        found += [(m.start(), 2, m.end(), m[0]) for m in HEX.finditer(text) if m.end() - m.start() >= 24]
    more: list[list[tuple[int, int, int, str]]] = [[] for _ in KINDS]
    if "-----BEGIN" in text:
        more[3] = [(m.start(), 3, m.end(), m[0]) for m in PRIVATE_KEY.finditer(text)]
    if "eyJ" in text:
        more[4] = [(s, 4, e, text[s:e]) for s, e in jwts(text)]
    if "://" in text:
        more[5] = [(m.start(1), 5, m.end(1), m[1]) for m in URL.finditer(text)]
    if long_run:
        for m in RANDOM.finditer(text):
            v = m[0]
            if any(c.isdigit() for c in v) and any(c.isupper() for c in v) and any(c.islower() for c in v) and entropy(v) >= 3.5:
                more[6].append((m.start(), 6, m.end(), v))
    for kind in more[BASE:]:  # the candidates of one kind don't overlap each other
        if kind:
            starts, ends = _joined(found)
            free = []
            for c in kind:
                i = bisect.bisect_right(starts, c[0])
                if (i == 0 or ends[i - 1] <= c[0]) and (i == len(starts) or starts[i] >= c[2]):
                    free.append(c)
            found += free
    return sorted(found)


def _joined(found) -> tuple[list[int], list[int]]:
    """Starts and ends of the stretches that the candidates cover."""
    starts: list[int] = []
    ends: list[int] = []
    for s, _, e, _ in sorted(found):
        if ends and s <= ends[-1]:
            ends[-1] = max(ends[-1], e)
        else:
            starts.append(s)
            ends.append(e)
    return starts, ends


def named(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e, *_ in spans)


CANDIDATES = "array<struct<start:int,kind:int,end:int,hash:binary,looks:boolean>>"


def _scan(batches):
    arrow = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32()), ("hash", pa.binary()), ("looks", pa.bool_())]))
    for batch in batches:
        found = [scan(t) if t else [] for t in batch.column("text").to_pylist()]
        base = [[c for c in f if c[1] < BASE] for f in found]
        counts = [[sum(c[1] == k for c in b) for b in base] for k in range(BASE)]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(n) for n in ("key", "owner", "repository")), *(pa.array(c, pa.int64()) for c in counts),
             pa.array([hashlib.sha256(named(b).encode()).hexdigest() for b in base]),
             pa.array([[{"start": s, "kind": k, "end": e, "looks": live_looking(v, k),
                         "hash": hashlib.blake2b(v.encode("utf-8", "surrogatepass"), digest_size=16).digest()} for s, k, e, v in f] for f in found], arrow)],
            ["key", "owner", "repository", "n_assign", "n_access", "n_hex", "base_sha256", "found"])


def candidates(docs: DataFrame, key, owner_col: str, repository_cols: tuple[str, ...], text_col: str) -> DataFrame:
    """One row per input row with the candidates of its text, and its owner and repository."""
    text = lambda n: F.coalesce(F.col(f"`{n}`").cast("string"), F.lit(""))
    key_type = docs.select(key.alias("key")).schema["key"].dataType.simpleString()
    return docs.select(key.alias("key"), text(owner_col).alias("owner"), F.concat_ws("/", *(text(n) for n in repository_cols)).alias("repository"),
                       F.col(f"`{text_col}`").alias("text")).mapInArrow(
        _scan, f"key {key_type}, owner string, repository string, n_assign long, n_access long, n_hex long, base_sha256 string, found {CANDIDATES}")


def verdicts(found: DataFrame, min_owners: int, min_repositories: int) -> DataFrame:
    """The candidates one per row (key, start, kind, end, n_owners, n_repositories, verdict). A hash that ``min_owners`` owners or
    more hold, or ``min_repositories`` repositories or more of at least two owners, is an "example"; of others, one that looks
    random is "live" and the rest "weak". Holders are made distinct, map-side first, before they are counted."""
    each = found.where(F.size("found") > 0).select("key", "owner", "repository", F.inline("found"))
    holders = each.select("hash", "owner", "repository").distinct()
    owners = (holders.groupBy("hash", "owner").agg(F.count("*").alias("r")).groupBy("hash")
              .agg(F.count("*").alias("n_owners"), F.sum("r").alias("n_repositories")))
    wide = (F.col("n_owners") >= min_owners) | ((F.col("n_owners") >= 2) & (F.col("n_repositories") >= min_repositories))
    verdict = F.when(wide, "example").when(F.col("looks"), "live").otherwise("weak")
    return each.join(owners, "hash").select("key", "start", "kind", "end", "n_owners", "n_repositories", verdict.alias("verdict"))


def secret_report(docs: DataFrame, id_col: str = "doc_id", owner_col: str = "source", repository_cols: tuple[str, ...] = ("source", "lang"),
                  text_col: str = "text", min_owners: int = 3, min_repositories: int = 5) -> DataFrame:
    """One row per input row: id, ``n_assign``, ``n_access``, ``n_hex``, ``base_sha256`` (of the base spans
    as kind:start:end), ``spans`` (the base spans and the live-looking others, in the same form),
    ``n_live``, ``n_examples``, ``most_owners`` and ``most_repositories`` over its candidates. Spans are in code points, end exclusive. A null
    or empty text has none; a null owner counts as one owner; repeated rows are one holder but each has its row;
    other columns are ignored."""
    rows = staged(candidates(docs, F.col(f"`{id_col}`"), owner_col, repository_cols, text_col).withColumnRenamed("key", "id")
                  .withColumn("key", F.monotonically_increasing_id()), "candidates")
    judged = verdicts(rows, min_owners, min_repositories)
    kinds = F.array(*(F.lit(k) for k in KINDS))
    shown = (F.col("kind") < BASE) | (F.col("verdict") == "live")
    spans = judged.groupBy("key").agg(
        F.sort_array(F.collect_list(F.when(shown, F.struct("start", "kind", "end")))).alias("s"),
        F.count_if(F.col("verdict") == "live").alias("n_live"), F.count_if(F.col("verdict") == "example").alias("n_examples"), F.max("n_owners").alias("most_owners"),
        F.max("n_repositories").alias("most_repositories"))
    spans = spans.withColumn("s", F.array_join(F.transform("s", lambda x: F.concat_ws(":", F.get(kinds, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ","))
    zero = F.lit(0).cast("long")
    return rows.join(spans, "key", "left").select(
        F.col("id").alias(id_col), "n_assign", "n_access", "n_hex", "base_sha256", F.coalesce("s", F.lit("")).alias("spans"),
        F.coalesce("n_live", zero).alias("n_live"), F.coalesce("n_examples", zero).alias("n_examples"), F.coalesce("most_owners", zero).alias("most_owners"),
        F.coalesce("most_repositories", zero).alias("most_repositories"))


def redact(docs: DataFrame, mask: str = "[SECRET]", owner_col: str = "source", repository_cols: tuple[str, ...] = ("source", "lang"),
           text_col: str = "text", min_owners: int = 3, min_repositories: int = 5, length_col: str | None = None) -> DataFrame:
    """``docs`` with base spans that aren't widely copied examples, and live-looking others, replaced by
    ``mask``; overlapping spans become one mask. ``length_col``, if given, becomes the length of the new text. Rows and all other columns stay as they are. Texts that cannot hold a
    candidate are not shuffled; the others meet their spans by the md5 of the text."""
    text = F.col(f"`{text_col}`")
    digest = F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))
    may = F.coalesce(text.rlike(GATE), F.lit(False))
    name, at = unused(docs, "_secret_digest"), unused(docs, "_secret_spans")
    found = staged(candidates(docs.where(may), digest, owner_col, repository_cols, text_col), "candidates")
    cut = ((F.col("kind") < BASE) & (F.col("verdict") != "example")) | (F.col("verdict") == "live")
    spans = (verdicts(found, min_owners, min_repositories).where(cut).groupBy("key").agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias(at))
             .withColumnRenamed("key", name))
    held = docs.where(may).join(spans, digest == F.col(name), "left")
    # outside parts: from the end of the spans before to the start of the next
    state = F.aggregate(at, F.struct(F.lit("").alias("out"), F.lit(0).alias("at")), lambda a, s: F.when(
        s["start"] >= a["at"], F.struct(F.concat(a["out"], F.substring(text, a["at"] + 1, s["start"] - a["at"]), F.lit(mask)).alias("out"), s["end"].alias("at")))
        .otherwise(F.struct(a["out"].alias("out"), F.greatest(a["at"], s["end"]).alias("at"))))
    whole = F.when(F.col(at).isNull(), text).otherwise(F.concat(state["out"], F.substring(text, state["at"] + 1, F.length(text))))
    masked = held.select(*((whole.alias(c) if c == text_col else F.when(F.col(at).isNull(), F.col(f"`{c}`"))
                            .otherwise(F.length(whole)).cast(docs.schema[c].dataType).alias(c) if c == length_col else F.col(f"`{c}`")) for c in docs.columns))
    return docs.where(~may).unionAll(masked)
