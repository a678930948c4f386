import zlib

from citylake.llm.sharding import assign_shards, shard_slots, write_shards
from tests.llm.helpers import docs, with_extra

EVEN = {s: 1.0 for s in range(8)}


def test_slots_sizes_and_checksums(spark):
    texts = ["a", "", None, "é" * 10, "a", "x" * 1000] * 40
    rows = shard_slots(with_extra(docs(spark, texts)), EVEN, EVEN | {8: 1.0}).collect()
    assert len(rows) == len(texts)
    for s in EVEN:
        mine = sorted((r for r in rows if r.shard == s), key=lambda r: r.slot)
        assert [r.slot for r in mine] == list(range(len(mine)))
        assert [r.doc_id for r in mine] == sorted(r.doc_id for r in mine)
    for r in rows:
        raw = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32) == (len(raw) + 1, zlib.crc32(raw))
        assert r.grown_shard in (r.shard, 8)


def test_key_alone_decides_and_weights_share(spark):
    df = docs(spark, ["x"] * 6000)
    weights = {0: 1.0, 1: 2.0, 2: 3.0}
    a = {r.doc_id: r.shard for r in assign_shards(df, "doc_id", weights).collect()}
    b = {r.doc_id: r.shard for r in assign_shards(df.repartition(7), "doc_id", weights).collect()}
    assert a == b
    share = [sum(s == k for s in a.values()) / len(a) for k in weights]
    assert all(abs(x - w / 6) < 0.03 for x, w in zip(share, weights.values()))
    more = {r.doc_id: r.shard for r in assign_shards(df, "doc_id", weights | {1: 4.0}).collect()}
    assert all(more[k] in (a[k], 1) for k in a)  # a heavier shard only wins records


def test_edges(spark, tmp_path):
    hot = docs(spark, ["same"] * 500, ids=[7] * 300 + [None] * 200)
    rows = shard_slots(hot, EVEN).collect()
    assert len(rows) == 500 and len({r.shard for r in rows if r.doc_id == 7}) == 1 == len({r.shard for r in rows if r.doc_id is None})
    for s in {r.shard for r in rows}:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows)))
    assert shard_slots(docs(spark, []), EVEN).count() == 0
    write_shards(docs(spark, ["a", None, "b"]), str(tmp_path / "out"), "doc_id", EVEN)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3
