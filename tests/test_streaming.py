import json
import os

from citylake import schemas
from citylake.plans.city import format_listings
from citylake.sources.landing import explode_lookup
from citylake.sources.zone import Zone
from citylake.streaming.landing import stream_landing

from fixtures_city import PLACES, listing, lookup_row


def test_stream_landing_first_wins_across_batches(spark, scratch):
    lk_docs = spark.createDataFrame([("l1", "f", "t", [tuple(lookup_row(*p).values()) for p in PLACES])],
                                    schemas.LOOKUP_ENVELOPE)
    lookup = explode_lookup(lk_docs)
    land = os.path.join(scratch, "landing")
    os.makedirs(land)

    def put(name, docs):
        with open(os.path.join(land, name), "w", encoding="utf-8") as f:
            for d in docs:
                f.write(json.dumps(d) + "\n")

    put("a.json", [{"_id": "d1", "filename": "idealista_2023-01-01.json", "timestamp": "t",
                    "data": [listing("p1", "el Raval", 100.0, 2, 1, 50.0), listing("p2", "la Dreta", 200.0, 3, 1, 60.0)]}])
    zone = Zone(spark, os.path.join(scratch, "zone"))
    ck = os.path.join(scratch, "ck")
    q = stream_landing(spark, land, schemas.LISTING_ENVELOPE, lambda b: format_listings(b, lookup), zone,
                       "table_idealista", ["id", "timestamp"], checkpoint_location=ck)
    q.awaitTermination(120)
    assert zone.read("table_idealista").count() == 2
    # a later file repeats p1 for the same date (must not replace the first) and adds p3
    put("b.json", [{"_id": "d2", "filename": "idealista_2023-01-01.json", "timestamp": "t",
                    "data": [listing("p1", "el Raval", 999.0, 2, 1, 50.0), listing("p3", "el Coll", 300.0, 1, 1, 70.0)]}])
    q = stream_landing(spark, land, schemas.LISTING_ENVELOPE, lambda b: format_listings(b, lookup), zone,
                       "table_idealista", ["id", "timestamp"], checkpoint_location=ck)
    q.awaitTermination(120)
    got = {r.id: r.price for r in zone.read("table_idealista").collect()}
    assert got == {"p1": 100.0, "p2": 200.0, "p3": 300.0}


def test_stream_landing_upsert_mode_replaces(spark, scratch):
    lk_docs = spark.createDataFrame([("l1", "f", "t", [tuple(lookup_row(*p).values()) for p in PLACES])],
                                    schemas.LOOKUP_ENVELOPE)
    lookup = explode_lookup(lk_docs)
    land = os.path.join(scratch, "landing_u")
    os.makedirs(land)
    zone = Zone(spark, os.path.join(scratch, "zone_u"))
    ck = os.path.join(scratch, "ck_u")
    for i, price in enumerate([100.0, 250.0]):
        with open(os.path.join(land, f"{i}.json"), "w", encoding="utf-8") as f:
            f.write(json.dumps({"_id": f"d{i}", "filename": "idealista_2023-01-01.json", "timestamp": "t",
                                "data": [listing("p1", "el Raval", price, 2, 1, 50.0)]}) + "\n")
        q = stream_landing(spark, land, schemas.LISTING_ENVELOPE, lambda b: format_listings(b, lookup), zone,
                           "table_idealista", ["id", "timestamp"], mode="upsert", checkpoint_location=ck)
        q.awaitTermination(120)
    assert [(r.id, r.price) for r in zone.read("table_idealista").collect()] == [("p1", 250.0)]


def test_default_stream_checkpoint_is_stable(spark, scratch):
    from citylake.streaming.landing import default_stream_checkpoint
    zone = Zone(spark, os.path.join(scratch, "zone_s"))
    loc = default_stream_checkpoint(spark, zone, "table_idealista")
    assert loc == default_stream_checkpoint(spark, zone, "table_idealista")
    ctx_dir = spark.sparkContext.getCheckpointDir() or ""
    assert not loc.startswith(ctx_dir.replace("file:", "")) or not ctx_dir  # not inside the per-app folder
