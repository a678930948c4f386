import os

from citylake import schemas
from citylake.sources.landing import LISTING_LOOKUP_FILE, read_landing, read_lookup

from fixtures_city import lookup_row


def test_read_lookup_last_document_wins(spark):
    rows = [("d1", LISTING_LOOKUP_FILE, "t", [tuple(lookup_row("A", "old", "Q1", "Q11").values())]),
            ("d3", LISTING_LOOKUP_FILE, "t", [tuple(lookup_row("A", "new", "Q1", "Q11").values()),
                                              tuple(lookup_row("A", "new2", "Q1", "Q12").values())]),
            ("d2", "lookup_opendata.csv", "t", [tuple(lookup_row("B", "open", "Q2", "Q21").values())]),
            ("d0", "other.csv", "t", [tuple(lookup_row("C", "older", "Q3", "Q31").values())])]
    docs = spark.createDataFrame(rows, schemas.LOOKUP_ENVELOPE)
    marked, other = read_lookup(docs)
    assert [(r.pos, r.neighborhood) for r in marked.orderBy("pos").collect()] == [(0, "new"), (1, "new2")]
    assert [r.neighborhood for r in other.collect()] == ["open"]  # d2 comes after d0


def test_read_landing_formats(spark, scratch):
    docs = spark.createDataFrame([("d1", "f_2023-01-01.json", "t", [tuple(lookup_row("A", "x", "Q1", "Q11").values())])],
                                 schemas.LOOKUP_ENVELOPE)
    path = os.path.join(scratch, "lk")
    docs.write.parquet(path)
    back = read_landing(spark, path, schemas.LOOKUP_ENVELOPE, fmt="parquet")
    assert back.count() == 1 and back.schema["data"].dataType.elementType.fieldNames()[0] == "district"
    jpath = os.path.join(scratch, "lkj")
    docs.coalesce(1).write.json(jpath)
    assert read_landing(spark, jpath, schemas.LOOKUP_ENVELOPE).first()._id == "d1"
