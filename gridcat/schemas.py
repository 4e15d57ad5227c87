"""

JSON is never inferred: an inferred ``assets`` map would turn into a struct
with one field per asset key."""

from __future__ import annotations

from pyspark.sql import types as T

S, D = T.StringType(), T.DoubleType()


def _f(name, typ, nullable=True):
    return T.StructField(name, typ, nullable)


LINK = T.StructType([_f("rel", S), _f("href", S), _f("type", S)])
LINKS = T.ArrayType(LINK)
ASSET = T.StructType([_f("href", S), _f("type", S), _f("title", S)])

CATALOG = T.StructType([_f("type", S), _f("id", S), _f("description", S), _f("links", LINKS)])

COLLECTION = T.StructType([
    _f("type", S), _f("id", S), _f("title", S), _f("description", S), _f("links", LINKS),
    _f("extent", T.StructType([
        _f("spatial", T.StructType([_f("bbox", T.ArrayType(T.ArrayType(D)))])),
        _f("temporal", T.StructType([_f("interval", T.ArrayType(T.ArrayType(S)))])),
    ])),
])

ITEM = T.StructType([
    _f("type", S), _f("id", S), _f("collection", S), _f("bbox", T.ArrayType(D)),
    _f("properties", T.StructType([_f("datetime", S)])),
    _f("links", LINKS), _f("assets", T.MapType(S, ASSET)),
])

ITEM_PAGE = T.StructType([_f("type", S), _f("features", T.ArrayType(ITEM))])

GRANULE = T.StructType([_f("Granule", T.StructType([
    _f("GranuleUR", S),
    _f("OnlineAccessURLs", T.StructType([_f("OnlineAccessURL", T.ArrayType(T.StructType([_f("URL", S)])))])),
]))])
