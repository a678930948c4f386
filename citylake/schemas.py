"""Explicit schemas of the landing documents (no inference at scale) and of the exploitation tables."""

from __future__ import annotations

from pyspark.sql import types as T


def envelope(record: T.StructType) -> T.StructType:
    """``{_id, filename, timestamp, data: [record]}``."""
    return T.StructType([
        T.StructField("_id", T.StringType(), False),
        T.StructField("filename", T.StringType(), False),
        T.StructField("timestamp", T.StringType(), True),
        T.StructField("data", T.ArrayType(record), True),
    ])


# The fields of the landing documents, in the documents' own order.
LOOKUP_RECORD = ("district string, neighborhood string, district_n_reconciled string, district_n string, "
                   "district_id string, neighborhood_n_reconciled string, neighborhood_n string, neighborhood_id string")

LISTING_RECORD = (
    "propertyCode string, thumbnail string, externalReference string, numPhotos int, floor string, price double, "
    "propertyType string, operation string, size double, exterior boolean, rooms int, bathrooms int, address string, "
    "province string, municipality string, district string, country string, neighborhood string, latitude double, "
    "longitude double, showAddress boolean, url string, distance string, hasVideo boolean, status string, "
    "newDevelopment boolean, newDevelopmentFinished boolean, hasLift boolean, priceByArea double, hasPlan boolean, "
    "has3DTour boolean, has360 boolean, hasStaging boolean, topNewDevelopment boolean, "
    "parkingSpace struct<hasParkingSpace:boolean,isParkingSpaceIncludedInPrice:boolean,parkingSpacePrice:double>, "
    "detailedType struct<typology:string,subTypology:string>, "
    "suggestedTexts struct<subtitle:string,title:string>")

FACILITY_RECORD = (
    "id string, register_id string, name string, created string, modified string, status string, status_name string, "
    "core_type string, core_type_name string, body string, ical string, place string, "
    "addresses array<struct<address_name:string,address_id:bigint,start_street_number:int,end_street_number:int,"
    "street_number_1:string,street_number_2:string,level:int,zip_code:string,province:string,town:string,"
    "country:string,position:int,position_relative:string,main_address:boolean,roadtype_name:string,"
    "roadtype_id:string,hide_address:boolean,district_id:string,district_name:string,neighborhood_id:string,"
    "neighborhood_name:string>>, "
    "classifications_data array<struct<full_path:string,dependency_group:int,parent_id:bigint,tree_id:int,"
    "asia_id:string,level:int>>, "
    "warnings array<struct<message:string>>, geo_epgs_25831 struct<x:double,y:double>, "
    "geo_epgs_23031 struct<x:double,y:double>, geo_epgs_4326 struct<lat:double,lon:double>, "
    "secondary_filters_data array<string>, attribute_categories array<string>, entity_types_data array<string>, "
    "`values` array<string>, image_data string, location string, gallery_data array<string>, "
    "sections_data array<string>, tickets_data array<string>, from_relationships array<string>, "
    "to_relationships array<string>, timetable string")

INCOME_RECORD = ("Any string, Codi_Districte string, Nom_Districte string, Codi_Barri string, Nom_Barri string, "
                   "`Població` string, `Índex RFD Barcelona = 100` string")

MODEL_DATA = ("neighborhood_id string not null, n_markets bigint, price double, size double, rooms double, "
                "bathrooms double, priceByArea double, index_rfd string, population double")

_RECORDS = {"LOOKUP": LOOKUP_RECORD, "LISTING": LISTING_RECORD, "FACILITY": FACILITY_RECORD, "INCOME": INCOME_RECORD}
_CACHE: dict[str, T.StructType] = {}


def parse(ddl: str) -> T.StructType:
    """DDL text to a StructType (needs an active session: the parser runs in the JVM)."""
    return T.StructType.fromDDL(ddl)


def __getattr__(name: str) -> T.StructType:
    """``LISTING_RECORD`` etc. are DDL strings; ``*_ENVELOPE`` and ``*_SCHEMA`` are parsed on first use."""
    if name not in _CACHE:
        if name.endswith("_ENVELOPE") and name[:-9] in _RECORDS:
            _CACHE[name] = envelope(parse(_RECORDS[name[:-9]]))
        elif name == "MODEL_DATA_SCHEMA":
            _CACHE[name] = parse(MODEL_DATA)
        else:
            raise AttributeError(name)
    return _CACHE[name]
