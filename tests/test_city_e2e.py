import os

from citylake.plans import city, ml
from citylake.plans.city import LandingPaths
from citylake.sources.zone import Zone

from fixtures_city import make_landing


def test_city_end_to_end(spark, scratch):
    root = make_landing(os.path.join(scratch, "landing"))
    paths = LandingPaths(lookup=f"{root}/lookup", listings=f"{root}/idealista", facilities=f"{root}/markets",
                         income=f"{root}/income")
    formatted = Zone(spark, os.path.join(scratch, "formatted"))
    exploitation = Zone(spark, os.path.join(scratch, "exploitation"))
    out = city.format_zone(spark, paths, formatted)
    c = out["counters"]
    # 18 + 2 + 1 listing records read in three documents; 20 named ones match (NULL and "Nowhere" do not)
    assert (c["listings_read"], c["listings_kept"], c["listings_duplicates_removed"]) == (23, 19, 2)
    assert c["income_duplicates_removed"] == 1 and c["facilities_kept_unmatched"] == 0

    listings = formatted.read("table_idealista")
    assert listings.count() == 18 + 1  # 6 places x 3, one more snapshot date of p00; dups and unmatched dropped
    row = listings.where("id = 'p00' and timestamp = '2023-01-15'").first()
    assert (row.neighborhood, row.neighborhood_id, row.hasParkingSpace, row.parkingSpacePrice) == ("el Raval", "Q11", True, 10.0)
    assert "parkingSpace" not in listings.columns

    markets = {r.register_id: r for r in formatted.read("table_markets").collect()}
    assert len(markets) == 8 + 1 - 1  # r0..r5, r9, r10 (+ r0 of 2021 again is a duplicate)
    assert markets["r0"].neighborhood_id == "Q11" and markets["r0"].level == 9 and markets["r0"].n_warnings == 1
    assert markets["r9"].neighborhood_id == "Q318" and markets["r10"].neighborhood_id == "Q318"  # minted, both rows
    assert markets["r0"].asia_id == 42 and "addresses" not in formatted.read("table_markets").columns

    inc = formatted.read("table_income")
    ids = {r.id: r for r in inc.collect()}
    assert ids["2020318"].neighborhood_id == "Q318"  # matched through the extended dictionary
    assert inc.where("neighborhood = 'el Raval' and year = '2019'").count() == 1  # first wins
    assert set(inc.columns) == {"id", "year", "population", "index_rfd", "source_id", "timestamp", "district",
                                "neighborhood", "district_id", "neighborhood_id"}

    city.exploitation_zone(formatted, exploitation)
    model_data = exploitation.read("model_data")
    assert model_data.count() == 6
    # terciles are taken over the 7 places with income (the minted Sants has no listings and then
    # drops out of the join): ranks 0-2 Low, 3-4 Medium (Sants is 3), 5-6 High
    assert sorted(r.index_rfd for r in model_data.collect()) == ["High", "High", "Low", "Low", "Low", "Medium"]
    city.exploitation_zone(formatted, exploitation)  # rerun: keyed upsert, still one row per place
    assert exploitation.read("model_data").count() == 6

    dash = city.dashboard_data(exploitation)
    assert dash["markets_vs_income"].count() == 7
    assert dash["price_per_room"].count() == 3 and dash["size_by_district"].count() == 3

    model, train_df, test_df = ml.train(exploitation.read("model_data"), seed=7)
    ev = ml.evaluate(ml.predict(model, exploitation.read("model_data"))).first()
    assert 0.0 <= ev.accuracy <= 1.0 and ev.n_test == 6
    assert len(ml.forest(model).featureImportances) == 7


def test_cli_steps(spark, scratch, capsys):
    from citylake.__main__ import main
    root = make_landing(os.path.join(scratch, "landing"))
    fz, ez, dz = (os.path.join(scratch, n) for n in ("f", "e", "d"))
    assert main(["format", "--lookup", f"{root}/lookup", "--listings", f"{root}/idealista", "--facilities",
                 f"{root}/markets", "--income", f"{root}/income", "--formatted", fz]) == 0
    assert main(["exploit", "--formatted", fz, "--exploitation", ez]) == 0
    assert main(["train", "--exploitation", ez, "--seed", "3", "--model-out", os.path.join(scratch, "model")]) == 0
    assert main(["dashboard", "--exploitation", ez, "--out", dz]) == 0
    out = capsys.readouterr().out
    assert '"test_error"' in out and "table_idealista" in out
    assert Zone(spark, dz).read("markets_vs_income").count() == 7
