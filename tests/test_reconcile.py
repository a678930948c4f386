import contextlib
import random

import pytest
from pyspark.sql import functions as F

from citylake.operators.reconcile import (LOOKUP_COLUMNS, extend_lookup, reconcile, reconcile_with_fallback)

LK_SCHEMA = "pos long, " + ", ".join(f"{c} string" for c in LOOKUP_COLUMNS)


def lk_row(pos, district, hood, did, nid):
    return (pos, district, hood, district, district.lower(), did, hood, hood.lower(), nid)


LOOKUP = [
    lk_row(0, "Ciutat Vella", "el Raval", "Q1", "Q11"),
    lk_row(1, "Ciutat Vella", "el Gòtic", "Q1", "Q12"),
    lk_row(2, "Eixample", "Sant Antoni", "Q2", "Q21"),
    lk_row(3, "Gràcia", "Sant Antoni", "Q3", "Q31"),   # second candidate for "Sant Antoni"
    lk_row(4, "Eixample", "Eixample", "Q2", "Q22"),     # neighborhood named like a district
]


def test_reconcile_hand_cases(spark):
    lk = spark.createDataFrame(LOOKUP, LK_SCHEMA)
    probe = spark.createDataFrame([
        (1, "el Raval"),       # exact
        (2, "EL RAVAL"),       # uppercase probe: lower() matches neighborhood_n
        (3, "el gòtic"),       # lowercase only
        (4, "Eixample"),       # equals a district name: first row of that district (pos 2)
        (5, "Sant Antoni"),    # two candidates: first wins
        (6, "el Raval "),      # trailing space: no match
        (7, None),             # NULL never matches
        (8, "Nowhere"),        # absent
    ], "id int, neighborhood string")
    inner = {r.id: (r.neighborhood, r.district_id, r.neighborhood_id) for r in reconcile(probe, lk, "neighborhood").collect()}
    assert inner == {1: ("el Raval", "Q1", "Q11"), 2: ("el Raval", "Q1", "Q11"), 3: ("el Gòtic", "Q1", "Q12"),
                     4: ("Sant Antoni", "Q2", "Q21"), 5: ("Sant Antoni", "Q2", "Q21")}
    left = {r.id: (r.neighborhood, r.district_id) for r in reconcile(probe, lk, "neighborhood", how="left").collect()}
    assert left[6] == ("el Raval ", None) and left[7] == (None, None) and left[8] == ("Nowhere", None)
    narrowed = {r.id: r.neighborhood_id for r in reconcile(probe, lk, "neighborhood", columns=["neighborhood"]).collect()}
    # matching on neighborhood names only: "Eixample" now finds the neighborhood of that name, and
    # "EL RAVAL" / "el gòtic" need the lowercase column, which is no longer searched
    assert narrowed == {1: "Q11", 4: "Q22", 5: "Q21"}


def seq_reconcile(records, lookup, cols):
    out = {}
    for rid, v in records:
        if v is None:
            continue
        for k in lookup:
            vals = [k[c] for c in cols]
            if v in vals or v.lower() in vals:
                out[rid] = k[0]
                break
    return out


@pytest.mark.parametrize("seed", [11, 12, 13])
def test_reconcile_matches_sequential_spec(spark, seed):
    rnd = random.Random(seed)
    words = ["Alfa", "beta", "GAMMA", "Delta", "eps", "Zeta"]
    lookup = []
    for pos in range(30):
        d, h = rnd.choice(words), rnd.choice(words) + rnd.choice(["", "x", "Y"])
        lookup.append(lk_row(pos, d, h, f"D{rnd.randint(0, 5)}", f"N{pos}"))
    rnd.shuffle(lookup)  # order is carried by pos, not by row order
    recs = []
    for i in range(400):
        w = rnd.choice(words) + rnd.choice(["", "x", "Y", "z"])
        recs.append((i, rnd.choice([w, w.lower(), w.upper(), None, "N3", "d1"])))
    lk = spark.createDataFrame(lookup, LK_SCHEMA)
    probe = spark.createDataFrame(recs, "id int, name string").repartition(5)
    got = {r.id: r.p for r in reconcile(probe, lk, "name", match_pos="p").collect()}
    spec = seq_reconcile(recs, sorted(lookup), list(range(1, 9)))
    assert got == spec
    # shuffle joins give the same answer
    with no_broadcast(spark):
        assert {r.id: r.p for r in reconcile(probe, lk, "name", match_pos="p").collect()} == spec


LK_SCHEMA_NAMES = ["pos", "district", "neighborhood", "district_n_reconciled", "district_n", "district_id",
                   "neighborhood_n_reconciled", "neighborhood_n", "neighborhood_id"]


@contextlib.contextmanager
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def test_names_equal_to_a_minted_district(spark):
    lk = spark.createDataFrame([lk_row(0, "D", "Known", "Q9", "Q99")], LK_SCHEMA)
    df = spark.createDataFrame([(1, "A", "X", "5", "1"), (2, "X", "Z", "6", "2"), (3, "Z", "W", "7", "3")],
                               "ord int, name string, dname string, did string, nid string")
    ext = extend_lookup(lk, df, name="name", district="dname", district_id="did", neighborhood_id="nid", order=["ord"])
    assert [(r.neighborhood, r.district_id, r.neighborhood_id) for r in ext.orderBy("pos").collect()][1:] == [("A", "Q5", "Q51"), ("Z", "Q7", "Q73")]


@pytest.mark.parametrize("seed", range(4))
def test_extend_lookup_with_district_names_matches_sequential_spec(spark, seed):
    rnd = random.Random(seed)
    names = ["aa", "Bb", "CC", "dd", "Ee", "ff", "gg", "Hh"]
    recs = [(i, rnd.choice(names + [None]), rnd.choice(names), str(rnd.randint(1, 3)), str(rnd.randint(10, 19))) for i in range(40)]
    lk = spark.createDataFrame([lk_row(0, "D", "Known", "Q9", "Q99")], LK_SCHEMA)
    df = spark.createDataFrame(recs, "ord int, name string, dname string, did string, nid string").repartition(3)
    ext = extend_lookup(lk, df, name="name", district="dname", district_id="did", neighborhood_id="nid", order=["ord"])
    spec, spec_lk = seq_extend(recs, [lk_row(0, "D", "Known", "Q9", "Q99")])
    assert [tuple(r) for r in ext.select(*LK_SCHEMA_NAMES).orderBy("pos").collect()] == [tuple(r) for r in spec_lk]


def seq_extend(records, lookup):
    """Reference loop with 'mint for all' (every row of a minted name gets the minted ids)."""
    lk = [list(k) for k in lookup]
    for rid, name, dname, did, nid in records:
        if name is None:
            continue
        if not any(name in k[1:] or name.lower() in k[1:] for k in lk):
            lk.append([len(lk), dname, name, dname, dname.lower(), "Q" + did, name, name.lower(), "Q" + did + nid])
    res = {}
    for rid, name, dname, did, nid in records:
        hit = next((k for k in lk if name is not None and (name in k[1:] or name.lower() in k[1:])), None)
        res[rid] = (hit[5], hit[8]) if hit else (None, None)  # probe ids are named did/nid
    return res, lk


@pytest.mark.parametrize("seed", [5, 6])
def test_extend_lookup_matches_sequential_spec(spark, seed):
    rnd = random.Random(seed)
    lookup = [lk_row(i, "Dist", f"Known{i}", "Q1", f"Q1{i}") for i in range(4)]
    names = ["Known1", "known2", "NewA", "newa", "NEWB", "Newc"]
    recs = [(i, rnd.choice(names + [None]), rnd.choice(["North", "South"]), str(rnd.randint(1, 3)), str(rnd.randint(10, 19)))
            for i in range(120)]
    lk = spark.createDataFrame(lookup, LK_SCHEMA)
    df = spark.createDataFrame(recs, "ord int, name string, dname string, did string, nid string").repartition(3)
    ext = extend_lookup(lk, df, name="name", district="dname", district_id="did", neighborhood_id="nid", order=["ord"])
    spec, spec_lk = seq_extend(recs, lookup)
    assert ext.count() == len(spec_lk)
    out = reconcile(df, ext, "name", how="left", take=["district_id", "neighborhood_id"])
    got = {r.ord: (r.district_id, r.neighborhood_id) for r in out.collect()}
    assert got == spec
    assert sorted(r.pos for r in ext.collect()) == list(range(len(spec_lk)))


def test_extend_lookup_case_variants_and_known(spark):
    lk = spark.createDataFrame([lk_row(0, "D", "Known", "Q1", "Q11")], LK_SCHEMA)
    df = spark.createDataFrame([(1, "Fresh", "D2", "2", "21"), (2, "FRESH", "D3", "3", "31"),
                                (3, "known", "D", "1", "11"), (4, "Other", "D2", "2", "22")],
                               "ord int, name string, dname string, did string, nid string")
    ext = extend_lookup(lk, df, name="name", district="dname", district_id="did", neighborhood_id="nid", order=["ord"])
    rows = sorted(ext.collect(), key=lambda r: r.pos)
    assert [(r.pos, r.neighborhood, r.neighborhood_id) for r in rows] == [
        (0, "Known", "Q11"), (1, "Fresh", "Q221"), (2, "Other", "Q222")]


def test_reconcile_with_fallback(spark):
    lk = spark.createDataFrame(LOOKUP, LK_SCHEMA)
    probe = spark.createDataFrame([(1, "el Raval", "Eixample"), (2, None, "Eixample"), (3, None, "Nowhere"),
                                   (4, "el raval", "Eixample")], "id int, hood string, dist string")
    got = {r.id: (r.neighborhood_id, r.district_id) for r in
           reconcile_with_fallback(probe, lk, fine_on="hood", coarse_on="dist").collect()}
    assert got == {1: ("Q11", "Q1"), 2: (None, "Q2"), 3: (None, None), 4: (None, None)}


def test_reconcile_plan_is_equi(spark):
    lk = spark.createDataFrame(LOOKUP, LK_SCHEMA)
    probe = spark.range(100).select(F.col("id"), F.when(F.col("id") % 2 == 0, "el Raval").otherwise("EL RAVAL").alias("name"))
    plan = reconcile(probe, lk, "name")._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_reconcile_with_fallback_large_dictionary_path(spark):
    lk = spark.createDataFrame(LOOKUP, LK_SCHEMA)
    probe = spark.createDataFrame([(1, "el Raval", "Eixample"), (2, None, "Eixample"), (3, None, "Nowhere"),
                                   (4, "el raval", "Eixample"), (5, None, None)], "id int, hood string, dist string")
    small = {r.id: tuple(r) for r in reconcile_with_fallback(probe, lk, fine_on="hood", coarse_on="dist").collect()}
    with no_broadcast(spark):
        large = {r.id: tuple(r) for r in reconcile_with_fallback(probe, lk, fine_on="hood", coarse_on="dist").collect()}
    assert small == large and small[5][-2:] == (None, None)


def _plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_records_are_evaluated_once_and_not_shuffled_by_name(spark):
    lookup = spark.range(1).selectExpr("id AS pos", *(f"'{v}' AS {c}" for v, c in zip("dAdd1aa2", LOOKUP_COLUMNS)))  # of known size
    records = spark.range(1000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN NULL ELSE 'A' END AS name")
    for how, n in (("inner", 666), ("left", 1000)):
        out = reconcile(records, lookup, "name", how=how)
        assert out.count() == n
        plan = _plan(out)
        assert "SortMergeJoin" not in plan and "hashpartitioning(_key" not in plan and plan.count("Range (0, 1000") == 1


def test_records_without_a_name_are_spread(spark):
    from pyspark.sql import functions as F
    lookup = spark.createDataFrame([(0, "d", "A", "d", "d", "1", "a", "no name 5", "2")], "pos long, " + ", ".join(f"{c} string" for c in LOOKUP_COLUMNS))
    records = spark.range(20_000).selectExpr("id", "CASE WHEN id % 10 = 0 THEN 'a' ELSE NULL END AS name")
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = reconcile(records, lookup, "name", how="left")
        parts = [r["n"] for r in out.where("name IS NULL").groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
        assert out.where("name IS NULL AND district IS NOT NULL").count() == 0 and out.where("district = 'd'").count() == 2000
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert len(parts) == 4 and max(parts) < 2 * min(parts)


def test_records_are_not_shuffled_by_name_when_the_dictionary_size_is_overestimated(spark):
    ids = spark.range(3).selectExpr("id AS k", "id * 10 AS v")
    far = ids.alias("a").crossJoin(spark.range(3000).selectExpr("id AS w")).groupBy("k").agg(F.max("w").alias("w"), F.max("v").alias("v"))
    lookup = far.join(spark.range(1 << 20).selectExpr("id AS n"), F.col("k") == F.col("n")).selectExpr(
        "k AS pos", *(f"concat('{v}', k) AS {c}" for v, c in zip("dAdd1aa2", LOOKUP_COLUMNS)))
    records = spark.range(1000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN NULL ELSE 'A1' END AS name")
    out = reconcile(records, lookup, "name", how="inner")
    plan = _plan(out)
    assert out.count() == 666 and "hashpartitioning(_key" not in plan and "SortMergeJoin" not in plan
