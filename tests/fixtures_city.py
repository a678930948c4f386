"""Hand-made landing documents for the end-to-end city run (FIXTURES.md schemas)."""

import json
import os

from citylake.sources.landing import LISTING_LOOKUP_FILE

PLACES = [  # district, neighborhood, district_id, neighborhood_id
    ("Ciutat Vella", "el Raval", "Q1", "Q11"), ("Ciutat Vella", "el Gòtic", "Q1", "Q12"),
    ("Eixample", "Sant Antoni", "Q2", "Q21"), ("Eixample", "la Dreta", "Q2", "Q22"),
    ("Gràcia", "Vila de Gràcia", "Q3", "Q31"), ("Gràcia", "el Coll", "Q3", "Q32"),
]


def lookup_row(d, n, did, nid):
    return {"district": d, "neighborhood": n, "district_n_reconciled": d, "district_n": d.lower(),
            "district_id": did, "neighborhood_n_reconciled": n, "neighborhood_n": n.lower(), "neighborhood_id": nid}


def write(folder, name, docs):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", encoding="utf-8") as f:
        for d in docs:
            f.write(json.dumps(d, ensure_ascii=False) + "\n")


def listing(code, hood, price, rooms, baths, size, **extra):
    rec = {"propertyCode": code, "price": price, "rooms": rooms, "bathrooms": baths, "size": size,
           "priceByArea": price / size, "neighborhood": hood, "district": "raw"}
    rec.update(extra)
    return rec


def facility(reg, created, hood, dname, did, nid, level=1):
    return {"id": "x" + reg, "register_id": reg, "name": "Market " + reg, "created": created,
            "addresses": [{"address_name": "Street", "level": level, "district_id": did, "district_name": dname,
                           "neighborhood_id": nid, "neighborhood_name": hood}],
            "classifications_data": [{"full_path": "/markets", "asia_id": "42", "level": 9}],
            "warnings": [{"message": "w"}], "geo_epgs_25831": {"x": 1.0, "y": 2.0}, "timetable": "9-21"}


def income(year, dcode, dname, ncode, nname, pop, idx):
    return {"Any": year, "Codi_Districte": dcode, "Nom_Districte": dname, "Codi_Barri": ncode, "Nom_Barri": nname,
            "Població": pop, "Índex RFD Barcelona = 100": idx}


def make_landing(root):
    lk = [lookup_row(*p) for p in PLACES]
    write(f"{root}/lookup", "part-0.json", [
        {"_id": "l1", "filename": LISTING_LOOKUP_FILE, "timestamp": "2023-05-11", "data": lk},
        {"_id": "l2", "filename": "lookup_opendata.csv", "timestamp": "2023-05-11", "data": lk},
    ])
    hoods = [p[1] for p in PLACES]
    listings = []
    for i, h in enumerate(hoods):
        for j in range(3):
            listings.append(listing(f"p{i}{j}", h if j else h.upper(), 1000.0 * (i + 1) + j, 2 + j, 1, 50.0 + i,
                                    parkingSpace={"hasParkingSpace": True, "parkingSpacePrice": 10.0} if j == 0 else None))
    listings.append(listing("pX", None, 1.0, 1, 1, 1.0))            # no neighborhood: dropped
    listings.append(listing("pY", "Nowhere", 1.0, 1, 1, 1.0))       # unmatched: dropped
    write(f"{root}/idealista", "part-0.json", [
        {"_id": "i1", "filename": "idealista_2023-01-15_a.json", "timestamp": "t", "data": listings},
        {"_id": "i2", "filename": "idealista_2023-01-15_b.json", "timestamp": "t", "data": listings[:2]},  # dups
        {"_id": "i3", "filename": "idealista_2023-02-15.json", "timestamp": "t", "data": listings[:1]},   # new date
    ])
    fac = [facility(f"r{i}", "2021-01-01", h, p[0], p[2][1:], p[3][2:]) for i, (h, p) in enumerate(zip(hoods, PLACES))]
    fac += [facility("r9", "2021-05-01", "Sants", "Sants-Montjuïc", "3", "18"),
            facility("r10", "2022-01-01", "SANTS", "Sants-Montjuïc", "3", "18"),
            facility("r0", "2021-12-01", hoods[0], "x", "1", "1")]            # dup of r0 in 2021
    write(f"{root}/markets", "part-0.json", [{"_id": "m1", "filename": "markets.json", "timestamp": "2023-03-01",
                                              "data": fac}])
    inc = []
    for i, p in enumerate(PLACES):
        for y in ("2019", "2020"):
            inc.append(income(y, p[2][1:], p[0], str(i), p[1], str(1000 + i), str(50.0 + 10 * i)))
    inc.append(income("2020", "3", "Sants-Montjuïc", "18", "Sants", "900", "75"))   # matches minted place
    inc.append(income("2020", "0", "x", "0", "el Raval", "1", "1"))                 # dup key of first? no: other codes
    inc.append(income("2019", "1", "Ciutat Vella", "0", "el Raval", "5", "5"))      # dup of the first record
    write(f"{root}/income", "part-0.json", [{"_id": "c1", "filename": "income.json", "timestamp": "2023-04-01",
                                             "data": inc}])
    return root
