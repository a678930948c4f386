"""Near-duplicate classes by DartMinHash signatures, banded joining and exact verification."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from citylake.llm import dartminhash as D
from citylake.llm.common import column_slices, dropped, hash_filter, staged, unused
from citylake.llm.components import components

BANDS = 32
ROWS = 5
#: Members of one leader that a task verifies, about.
PER_TASK = 512
#: Tasks to which the copies of a text are dealt.
COPY_PARTS = 8
#: What rounding may lose in comparisons of sizes with the threshold.
SLACK = 1e-6


def _new_texts(batches, remember: int = 100_000):
    """(digests, texts as bytes) in slices, without texts that the task has just had: copies are
    reduced before anything is computed or shuffled, and dropDuplicates removes the rest."""
    seen = set()
    for batch in batches:
        if len(seen) > remember:
            seen.clear()
        names, fresh = batch.column("digest").to_pylist(), []
        for i, name in enumerate(names):
            if name not in seen:
                seen.add(name)
                fresh.append(i)
        fresh = pa.array(fresh, pa.int64())
        names = batch.column("digest").take(fresh)
        for first, last, texts in column_slices(batch.column("text").take(fresh), 500_000, 128):
            yield names.slice(first, last - first), [t.encode("utf-8", "surrogatepass") for t in texts]


def _sketch(width: int, bands: int, rows: int, weighting: str):
    def run(batches):
        for digests, part in _new_texts(batches):
            text, shingle, count = D.shingles(*D.word_hashes(D.apart(part)), width)
            weight = np.ones(len(shingle)) if weighting == "set" else count.astype(float)
            signature, some = D.signatures(text, shingle, weight, len(part), bands * rows)
            keys = D.band_keys(signature, bands)
            offsets = np.concatenate([[0], np.cumsum(np.where(some, bands, 0))]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([digests, pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys[some].reshape(-1)))], ["digest", "keys"])
    return run


def _sets(width: int, weighting: str):
    def run(batches):
        for digests, part in _new_texts(batches):
            text, shingle, count = D.shingles(*D.word_hashes(D.apart(part)), width)
            if weighting == "count":  # the k-th occurrence of a shingle is an element
                number = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                text, shingle = np.repeat(text, count), np.repeat(shingle, count)
                shingle = np.where(number > 0, D.mix(shingle ^ D.mix(number.astype(np.uint64))), shingle)
            offsets = pa.array(np.searchsorted(text, np.arange(len(part) + 1)).astype(np.int32))
            yield pa.RecordBatch.from_arrays([digests, pa.ListArray.from_arrays(offsets, pa.array(shingle.view(np.int64)))], ["digest", "shingles"])
    return run


def _similarity(threshold: float):
    """For each pair whether it is linked, the size of the sets' symmetric difference (``apart``) and the sets' sizes."""
    share = _gap_share(threshold)

    def run(batches):
        for batch in batches:
            sa, sb = batch.column("sa"), batch.column("sb")
            apart, size_a, size_b = (np.zeros(batch.num_rows, np.int64) for _ in range(3))
            for i in range(batch.num_rows):
                x, y = sa[i].values.to_numpy(), sb[i].values.to_numpy()
                size_a[i], size_b[i] = len(x), len(y)
                apart[i] = len(x) + len(y) - 2 * len(np.intersect1d(x, y, assume_unique=True))
            linked = apart <= share * (size_a + size_b) + SLACK
            yield pa.RecordBatch.from_arrays([batch.column("leader"), batch.column("member"), pa.array(linked), pa.array(apart), pa.array(size_a), pa.array(size_b)],
                                             ["leader", "member", "linked", "apart", "leader_size", "size"])
    return run


def _gap_share(threshold: float) -> float:
    """Sets are at least ``threshold`` alike just if their symmetric difference is at most this share of their sizes' sum."""
    return (1 - threshold) / (1 + threshold)


def _prefixes(threshold: float):
    """The elements of each member's difference from its leader by which a link to a member of another class must be found."""
    share = _gap_share(threshold)

    def run(batches):
        for batch in batches:
            sa, sb = batch.column("sa"), batch.column("sb")
            least = batch.column("least_gap").to_numpy()
            rows, elements, places, sizes, gaps, opens = [], [], [], [], [], []
            for i in range(batch.num_rows):
                x, y = sa[i].values.to_numpy(), sb[i].values.to_numpy()
                gained, lost = np.sort(np.setdiff1d(y, x, assume_unique=True)), np.sort(np.setdiff1d(x, y, assume_unique=True))
                n, own = len(gained) + len(lost), share * len(x)
                gap = n - share * len(y)
                open_ = gap > own + SLACK
                # a partner's gap is at least this: that of any text near enough to an open one, or that of the least open one
                other = (gap - own) / (1 + share) * (1 - share) - own if open_ else least[i]
                first = np.concatenate([gained, lost])[:max(0, n - max(1, int(np.ceil((gap + other) / 2 - 1e-6))) + 1)]
                rows.append(np.full(len(first), i))
                elements.append(first)
                places.append(np.arange(len(first)))
                sizes.append(n)
                gaps.append(gap)
                opens.append(open_)
            which = pa.array(np.concatenate(rows) if rows else np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n).take(which) for n in ("leader", "member", "root")), pa.array(np.concatenate(elements) if elements else np.zeros(0, np.int64)),
                 pa.array(np.concatenate(places).astype(np.int32) if places else np.zeros(0, np.int32)),
                 *(pa.array(v).take(which) for v in (np.array(sizes, np.int32), np.array(gaps, np.float64), np.array(opens, bool)))],
                ["leader", "member", "root", "element", "place", "apart", "gap", "open"])
    return run


def _with_sets(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``pairs`` (leader, member, ...) with the elements of both (sa, sb). A leader of many members is dealt to several tasks."""
    counts = pairs.groupBy("leader").agg(F.ceil(F.count("*") / PER_TASK).cast("int").alias("_parts"))
    leaders = (counts.join(sets.select(F.col("digest").alias("leader"), F.col("shingles").alias("sa")), "leader")
               .select("leader", "_parts", "sa", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)).alias("_part")))
    members = pairs.join(counts, "leader").withColumn("_part", F.pmod(F.xxhash64("member"), F.col("_parts")).cast("int")).drop("_parts")
    return (members.join(sets.select(F.col("digest").alias("member"), F.col("shingles").alias("sb")), "member")
            .join(leaders.drop("_parts"), ["leader", "_part"]).drop("_part"))


def near_links(docs: DataFrame, width: int = 5, threshold: float = 0.8, bands: int = BANDS, rows: int = ROWS, weighting: str = "set",
               text_col: str = "text") -> DataFrame:
    """(node, root): the classes of distinct texts, by md5, that have a verified link to another text.

    ``weighting`` "set" compares the distinct shingles, "count" weights each by its occurrences: then its k-th occurrence is an element of its
    own. Texts of one band key form a bucket; buckets of the same texts count once. Each bucket is led by its text that meets the most
    others, and every text is verified against its leaders, instead of all pairs of a bucket. The texts under one leader may hold
    further links, which an exact prefix join finds: let D be the symmetric difference of a text's set and its leader's. Two
    texts are alike enough just if their D sets share at least half of by how far they miss the threshold together, which is above 0 unless
    both are linked to the leader. So they share one of the first elements of their D sets, in an order that puts what a text
    has beyond its leader first, as that is rarest. Only elements under one leader that occur in several classes are joined, texts of one class
    never meet, and place and size bounds thin out what is verified. No pair that shared a bucket is left out.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    digest = F.unhex(F.md5(text.cast("binary")))
    given = docs.where(F.col(f"`{text_col}`").isNotNull()).select(digest.alias("digest"), text.alias("text"))
    sketched = given.mapInArrow(_sketch(width, bands, rows, weighting), "digest binary, keys array<long>")
    signed = staged(sketched.dropDuplicates(["digest"]), "bands")
    keys = signed.select("digest", F.explode("keys").alias("key"))
    # few keys are those of two texts: the others' texts aren't shuffled
    often = staged(keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key"), "often")
    may_meet = hash_filter(often.select(F.col("key").alias("h")))
    met = staged(keys.where(may_meet(F.col("key"))).join(often, "key", "left_semi"), "met")
    dropped(signed, often)
    # bands in which the same texts meet, told by two hashes over them, need one bucket
    shared = (met.groupBy("key").agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("digest")).alias("x"), F.bit_xor(F.xxhash64(F.lit(1), "digest")).alias("y"))
              .groupBy("n", "x", "y").agg(F.min("key").alias("key")).select("key", "n"))
    buckets = staged(met.join(shared, "key"), "buckets")
    dropped(met)
    # copies of one text come from many tasks; they meet its digest in COPY_PARTS tasks, which reduce them
    wanted = buckets.select("digest").distinct().withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(COPY_PARTS - 1))))
    wanted_here = hash_filter(buckets.select(F.xxhash64("digest").alias("h")))(F.xxhash64("digest"))  # other texts stay where they are
    sets = staged(given.where(wanted_here).withColumn("_part", F.spark_partition_id() % COPY_PARTS).join(wanted, ["digest", "_part"], "left_semi").select("digest", "text")
                  .mapInArrow(_sets(width, weighting), "digest binary, shingles array<long>").dropDuplicates(["digest"]), "sets")
    meets = buckets.groupBy("digest").agg(F.sum("n").alias("meets"))
    leaders = buckets.join(meets, "digest").groupBy("key").agg(F.max(F.struct("meets", "digest")).alias("m")).select("key", F.col("m.digest").alias("leader"))
    pairs = staged(buckets.select("key", F.col("digest").alias("member")).join(leaders, "key").where("leader != member").select("leader", "member").distinct(), "pairs")
    verified = staged(_with_sets(pairs, sets).select("leader", "member", "sa", "sb").mapInArrow(
        _similarity(threshold), "leader binary, member binary, linked boolean, apart long, leader_size long, size long"), "verified")
    dropped(buckets, pairs)
    links = verified.where("linked").select(F.col("leader").alias("a"), F.col("member").alias("b"))
    roots = components(links)

    # texts under a leader that may have links across classes: open ones, which the leader isn't linked with, beside others
    share = _gap_share(threshold)
    gap = F.col("apart") - share * F.col("size")
    placed = (verified.join(roots.withColumnRenamed("node", "member"), "member", "left")
              .select("leader", "member", F.coalesce("root", "member").alias("root"), "apart", "size", gap.alias("gap"), (~F.col("linked")).alias("open")))
    # an open text needs a partner of another class whose difference can hold what they must share
    reach = F.col("apart") + share * F.col("size")
    some = (placed.groupBy("leader", "root").agg(F.max(reach).alias("reach"), F.min(F.when(F.col("open"), F.col("gap"))).alias("gap"))
            .groupBy("leader").agg(F.min("gap").alias("least_gap"), F.max(F.struct("reach", "root")).alias("far"), F.count("*").alias("n"))
            .where("n > 1 AND least_gap IS NOT NULL"))
    able = (placed.join(some.select("leader", "least_gap", "far"), "leader")
            .where(F.when(F.col("open"), (F.col("root") == F.col("far.root")) | (F.col("gap") <= F.col("far.reach") + SLACK))
                   .otherwise(F.col("apart") + share * F.col("size") + SLACK >= F.col("least_gap")))
            .select("leader", "member", "root", "least_gap"))
    able = staged(able, "able")
    first = staged(_with_sets(able, sets).select("leader", "member", "root", "least_gap", "sa", "sb").mapInArrow(
        _prefixes(threshold), "leader binary, member binary, root binary, element long, place int, apart int, gap double, open boolean"), "prefixes")
    crossing = (first.groupBy("leader", "element").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.max("open").alias("any"))
                .where("lo != hi AND any").select("leader", "element"))
    each = staged(first.join(crossing, ["leader", "element"], "left_semi"), "crossing")
    left = each.where("open").select("leader", "element", *(F.col(c).alias(f"{c}_") for c in ("member", "root", "place", "apart", "gap")))
    must = F.ceil((F.col("gap") + F.col("gap_")) / 2 - 1e-6)
    candidates = (left.join(each, ["leader", "element"])
                  .where((F.col("root") != F.col("root_")) & (~F.col("open") | (F.col("member_") < F.col("member")))
                         & (F.least(F.col("apart") - F.col("place"), F.col("apart_") - F.col("place_")) >= must))
                  .select(F.col("member_").alias("leader"), "member").distinct())
    candidates = staged(candidates, "candidates")
    more = staged(_with_sets(candidates, sets).select("leader", "member", "sa", "sb").mapInArrow(
        _similarity(threshold), "leader binary, member binary, linked boolean, apart long, leader_size long, size long")
        .where("linked").select(F.col("leader").alias("a"), F.col("member").alias("b")), "links")
    if not more.isEmpty():
        old = roots
        roots = components(more.union(old.select(F.col("root").alias("a"), F.col("node").alias("b"))))
        dropped(old)
    dropped(sets, verified, able, first, each, candidates, more)
    return roots


def near_duplicates(docs: DataFrame, width: int = 5, threshold: float = 0.8, bands: int = BANDS, rows: int = ROWS, weighting: str = "set",
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, ``class_id`` (the least id of the class), ``class_size`` (rows),
    ``kept`` (true for one row of each class: one with the class id) and ``digest`` (md5 of the text).

    Two texts are linked if the Jaccard similarity of their ``width``-word shingles is at least
    ``threshold``; words are runs of ASCII letters and digits, in lower case, and of all other
    characters but Unicode white space and punctuation; in scripts without spaces each character is one; a text of fewer words is one shingle. Classes are the connected components, and equal texts are one
    class (so are empty ones; different texts without words are not linked). A row with a null text is a class of its
    own, with a null id too. Repeated rows are one class, of which one stays. Other columns are ignored.
    """
    text = F.col(f"`{text_col}`")
    rows_ = staged(docs.select(F.col(f"`{id_col}`").alias("id"), F.when(text.isNotNull(), F.unhex(F.md5(text.cast("binary")))).alias("digest"),
                               F.monotonically_increasing_id().alias("place")), "rows")
    links = near_links(docs, width, threshold, bands, rows, weighting, text_col)
    have, without = rows_.where(F.col("digest").isNotNull()), rows_.where(F.col("digest").isNull())
    # per distinct text first, then per class: a hot text or class is reduced before it is shuffled
    texts = (have.groupBy("digest").agg(F.min(F.struct("id", "place")).alias("least"), F.count("*").alias("n"))
             .join(links.withColumnRenamed("node", "digest"), "digest", "left").withColumn("root", F.coalesce("root", "digest")))
    texts = staged(texts, "texts")
    classes = texts.groupBy("root").agg(F.min("least").alias("least"), F.sum("n").alias("class_size"))
    found = (have.join(texts.select("digest", "root").join(classes, "root"), "digest")
             .select("id", F.col("least.id").alias("class_id"), "class_size", (F.col("place") == F.col("least.place")).alias("kept"), "digest"))
    alone = without.select("id", F.col("id").alias("class_id"), F.lit(1).cast("long").alias("class_size"), F.lit(True).alias("kept"), "digest")
    return found.unionAll(alone).withColumnRenamed("id", id_col)


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs``, all columns, without near duplicates: one row of each class, with the least id,
    and every row with a null text. Rows repeated under one id and text are reduced to one."""
    classes = near_duplicates(docs, id_col=id_col, text_col=text_col, **options)
    name = unused(docs, "near_key")

    def key(id_, digest):  # one binary column, so that one exchange serves the join and what follows
        return F.unhex(F.md5(F.concat(F.coalesce(id_.cast("string"), F.lit("-")).cast("binary"), F.lit(b":"), digest)))

    found = staged(classes.where("digest IS NOT NULL").select(key(F.col(f"`{id_col}`"), F.col("digest")).alias(name), "kept"), "kept")
    # a key of which no row goes has one row; only rows of other keys, and the few that pass the filter beside them, are shuffled
    goes = hash_filter(found.where("NOT kept").select(F.xxhash64(name).alias("h")))(F.xxhash64(F.col(name)))
    text = F.col(f"`{text_col}`")
    have = docs.where(text.isNotNull()).withColumn(name, key(F.col(f"`{id_col}`"), F.unhex(F.md5(text.cast("binary")))))
    stay = have.where(goes).join(found.where("kept").where(goes).select(name), name, "left_semi").dropDuplicates([name])
    return have.where(~goes).unionAll(stay.select(*have.columns)).drop(name).unionAll(docs.where(text.isNull()))
