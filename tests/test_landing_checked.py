from pathlib import Path

from citylake import schemas
from citylake.operators.quality import reject_counts
from citylake.sources.landing import read_landing_checked, split_landing


def test_every_line_is_accepted_or_has_a_reason(spark, tmp_path):
    lines = ['{"_id": "a", "filename": "f", "timestamp": "t", "data": [{"Any": "2020", "extra": 1}]}', '{"_id": "b", "data": []}', "",
             '{"_id": "c", "data": [{"Any": "20', "not json", '{"_id": "d", "data": "text"}', '{"data": []}', '{"_id": null, "data": []}',
             '{"_id": "e"}', '{"_id": "f", "data": null}', "[1, 2]", '{"_id": "a", "data": [null]}']
    (tmp_path / "x.json").write_text("\n".join(lines) + "\n")
    accepted, rejected = split_landing(read_landing_checked(spark, str(tmp_path), schemas.INCOME_ENVELOPE))
    got = sorted(((r._id, None if r.data is None else len(r.data), r.filename) for r in accepted.collect()), key=repr)
    assert ("a", 1, "f") in got and ("b", 0, None) in got and [g[0] for g in got] == ["a", "a", "b"]
    counts = {r.reason: r.rejected for r in reject_counts(rejected).collect()}
    assert counts == {"malformed": 4, "missing _id": 2, "missing data": 2}
    assert {r.raw for r in rejected.where("reject_reason = 'malformed'").collect()} == {lines[3], "not json", lines[5], "[1, 2]"}


def test_an_empty_folder_of_lines(spark, tmp_path):
    (tmp_path / "x.json").write_text("")
    accepted, rejected = split_landing(read_landing_checked(spark, str(tmp_path), schemas.INCOME_ENVELOPE))
    assert accepted.count() == 0 and rejected.count() == 0 and reject_counts(rejected).count() == 0


def test_landing_json_is_compressed_and_cut_into_short_files(spark, monkeypatch):
    from citylake.plans import lake_queries
    monkeypatch.setattr(lake_queries, "LINES_PER_FILE", 100)
    given = spark.range(0, 1000, 1, 2).selectExpr("concat('M', id) AS _id", "'f' AS filename", "'t' AS timestamp",
                                                  "transform(sequence(1, 20), i -> named_struct('a_long_field_name', id, 'another_long_field_name', cast(i AS string))) AS data")
    path = lake_queries._landing_json(spark, given)
    files = [f for f in Path(path.removeprefix("file:")).iterdir() if f.name.startswith("part-")]
    assert len(files) == 16 and all(f.name.endswith(".gz") for f in files)
    plain = sum(len(r.value) for r in spark.read.text(path).collect())
    assert sum(f.stat().st_size for f in files) < plain / 5
    accepted, rejected = split_landing(read_landing_checked(spark, path, given.schema))
    assert sorted(accepted.collect()) == sorted(given.collect())
    assert {r.reason: r.rejected for r in reject_counts(rejected).collect()} == {"malformed": 300, "missing _id": 100, "missing data": 100}


def test_listing_envelopes_shuffle_lineitems_once(spark, tmp_path):
    from citylake.plans import standins
    tables = {"nation": "SELECT 1 AS n_nationkey, 'FRANCE' AS n_name, 3 AS n_regionkey",
              "region": "SELECT 3 AS r_regionkey, 'EUROPE' AS r_name",
              "customer": "SELECT 7L AS c_custkey, 1 AS c_nationkey, 1.0D AS c_acctbal",
              "orders": "SELECT nullif(id, 5) AS o_orderkey, 7L AS o_custkey, timestamp_ntz'2023-01-09' - make_dt_interval(cast(id AS int)) AS o_orderdate FROM range(1, 9) UNION ALL "
                        "SELECT 6L, 7L, timestamp_ntz'2020-02-02'",
              "lineitem": "SELECT nullif(o.id, 8) AS l_orderkey, 10 * o.id + n.id AS l_partkey, cast(n.id AS int) AS l_linenumber, 2.0D AS l_quantity, 1.5D AS l_extendedprice, "
                          "0.0D AS l_discount, 0.02D AS l_tax, 'N' AS l_returnflag, 'F' AS l_linestatus FROM range(0, 11) o, range(1, 4) n"}
    for name, sql in tables.items():
        spark.sql(sql).write.parquet(f"{tmp_path}/{name}.parquet")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = standins.listing_envelopes(spark, str(tmp_path))
        got = {r._id: (r.filename, [x.propertyCode for x in r.data]) for r in out.collect()}
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    lines = {k: [f"{k}-{n}" for n in (1, 2, 3)] for k in range(9)}
    # order 5 has no key, lines of order 8 neither; order 6 stands there twice
    assert got == {"L0": ("idealista_2023-01-06.json", lines[1] + lines[2] + lines[3]),
                   "L1": ("idealista_2020-02-02.json", lines[4] + sorted(2 * lines[6]) + lines[7])}
    assert "hashpartitioning(l_orderkey" not in plan and plan.count("hashpartitioning(block") > 0


def _facility_tables(spark, root):
    """40 orders of up to three lines; keys repeat or are missing, and a supplier's lines fall into many documents."""
    tables = {"nation": "SELECT * FROM VALUES (1, 'FRANCE', 3), (2, 'IRAQ', 4) AS t(n_nationkey, n_name, n_regionkey)",
              "region": "SELECT * FROM VALUES (3, 'EUROPE'), (4, 'MIDDLE EAST') AS t(r_regionkey, r_name)",
              "supplier": "SELECT id AS s_suppkey, concat('S', id) AS s_name, cast(1 + id % 2 AS int) AS s_nationkey FROM range(0, 5)",
              "lineitem": "SELECT nullif(o.id, 9) AS l_orderkey, 10 * o.id + n.id AS l_partkey, nullif((o.id * 7 + n.id) % 6, 3) AS l_suppkey, cast(n.id % 3 AS int) AS l_linenumber, "
                          "18.0D + 4 * n.id AS l_quantity, 1.5D AS l_extendedprice, 0.03D * n.id AS l_discount, 0.02D AS l_tax, substr('NRA', cast(o.id % 3 + 1 AS int), 1) AS l_returnflag, "
                          "substr('OF', cast(n.id % 2 + 1 AS int), 1) AS l_linestatus, "
                          "timestamp_ntz'2023-12-30' - make_dt_interval(cast((o.id * 37 + n.id) % 800 AS int)) AS l_shipdate FROM range(0, 40) o, range(1, 5) n"}
    for name, sql in tables.items():
        spark.sql(sql).write.parquet(f"{root}/{name}.parquet")


def test_facilities_that_land_in_batches(spark, tmp_path, monkeypatch):
    from citylake.plans import city, lake_queries, standins
    from citylake.session import checkpoint_dir
    root = Path(checkpoint_dir(spark).removeprefix("file:"))
    left = lambda: {f.name for f in root.iterdir() if f.name.startswith(("landing-", "facilities-"))}
    _facility_tables(spark, str(tmp_path))
    d, before, landed, found = str(tmp_path), left(), [], []
    land = lake_queries._landing_json

    def spied(spark, envelopes):
        found.append(left() - before)
        path = land(spark, envelopes)
        landed.append([r._id for r in split_landing(read_landing_checked(spark, path, envelopes.schema))[0].select("_id").collect()])
        plan = envelopes._jdf.queryExecution().executedPlan().toString()
        assert plan.index("hashpartitioning(block") < plan.index("xxhash64")  # other batches' rows go before the shuffle
        return path

    given = standins.facility_envelopes(spark, d)
    expected, _ = city.format_facilities(given.where("_id IS NOT NULL"), standins.places(spark, d))
    monkeypatch.setattr(lake_queries, "_landing_json", spied)
    monkeypatch.setattr(lake_queries, "RECORDS_PER_BATCH", 50)
    got = lake_queries.q_format_facilities_json(spark, d)
    assert sorted(got.collect(), key=repr) == sorted(expected.select(*got.columns).collect(), key=repr) and got.count() > 10
    ids = [r._id for r in given.where("_id IS NOT NULL").collect()]
    assert len(landed) == 4 and sorted(sum(landed, [])) == sorted(ids) and all(landed)  # 160 lineitems
    # a batch meets no landing files of earlier ones, only the first records so far; in the end nothing is left
    assert not found[0] and all(len(x) == 1 and x.pop().startswith("facilities-") for x in found[1:]) and left() == before
    monkeypatch.setattr(lake_queries, "MOST_BATCHES", 2)
    landed.clear()
    assert sorted(lake_queries.q_format_facilities_json(spark, d).collect(), key=repr) == sorted(got.collect(), key=repr) and len(landed) == 2


def test_facility_batches_in_any_order_and_with_repeated_documents(spark, tmp_path):
    import pytest

    from citylake.plans import city, standins
    _facility_tables(spark, str(tmp_path))
    lookup = standins.places(spark, str(tmp_path))
    given = standins.facility_envelopes(spark, str(tmp_path))
    twice = given.selectExpr("_id", "filename", "timestamp", "transform(data, r -> struct(r.line, r.id, r.register_id, concat('again ', r.name) AS name, r.created, r.status_name, r.addresses, "
                             "r.classifications_data, r.warnings, r.geo_epgs_25831, r.body, r.place, r.timetable)) AS data")
    both = given.unionByName(twice).unionByName(given)
    want, extended = city.format_facilities(both, lookup)
    for batches in ([both], [twice, given, given], [both.where("_id > 'M3'"), both.where("false"), both.where("_id <= 'M3'"), both.where("_id IS NULL")]):
        got, more = city.format_facility_batches(iter(batches), lookup)
        assert got.columns == want.columns and sorted(got.collect(), key=repr) == sorted(want.collect(), key=repr)
        assert sorted(more.collect(), key=repr) == sorted(extended.collect(), key=repr)
    with pytest.raises(ValueError):
        city.format_facility_batches([], lookup)


def test_shuffle_files_go_with_the_job(spark, tmp_path):
    import time

    from citylake.session import shuffles_freed
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    tracker = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = lambda: {f.getName() for f in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(tracker.getAllFiles()) if f.getName().startswith("shuffle_")}
    rows, before, set_to = spark.range(0, 1000, 1, 3).repartition("id"), files(), spark.conf.get(key, "false")
    with shuffles_freed(spark):
        rows.write.parquet(f"{tmp_path}/a")
    for _ in range(50):
        if not files() - before:
            break
        time.sleep(0.1)
    assert not files() - before and spark.conf.get(key) == set_to
    assert spark.read.parquet(f"{tmp_path}/a").count() == 1000
