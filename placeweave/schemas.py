"""Declared schemas. Readers never infer."""

from __future__ import annotations

from pyspark.sql import types as T

STRING, DOUBLE, LONG = T.StringType(), T.DoubleType(), T.LongType()


def _struct(fields: str | dict) -> T.StructType:
    if isinstance(fields, str):
        return T.StructType([T.StructField(n, STRING) for n in fields.split()])
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


TEXT_COLUMNS = (
    "address_chi address_eng phase_chi block_chi building_chi estate_chi village_chi street_chi "
    "phase_eng block_eng building_eng estate_eng village_eng street_eng"
).split()

# One canonical address row, in output order.
CANONICAL = T.StructType(
    [T.StructField("id", STRING)]
    + [T.StructField(n, STRING) for n in TEXT_COLUMNS]
    + [T.StructField(n, DOUBLE) for n in ("lat", "lon", "easting", "northing")]
    + [T.StructField(n, STRING) for n in ("district_chi", "district_eng")]
)

SUB_DISTRICT_COLUMNS = ["sub_district_chi", "sub_district_eng", "sub_district_dist_m"]

CANONICAL_WITH_SUB_DISTRICT = T.StructType(
    CANONICAL.fields
    + [
        T.StructField("sub_district_chi", STRING),
        T.StructField("sub_district_eng", STRING),
        T.StructField("sub_district_dist_m", DOUBLE),
    ]
)

# Polymorphic members stay JSON text here and become VARIANT after the explode.
FEATURE = _struct({"geometry": _struct("type coordinates"), "properties": STRING})

FEATURE_COLLECTION = _struct({"features": T.ArrayType(FEATURE)})

LAT_LON = _struct({"lat": DOUBLE, "lon": DOUBLE})
VERTEX = _struct({"x": DOUBLE, "y": DOUBLE})

# A relation's members; ways carry their own geometry in dumps that ask for it.
MEMBER = _struct({"type": STRING, "ref": LONG, "role": STRING, "geometry": T.ArrayType(LAT_LON)})

OSM_ELEMENT = _struct(
    {
        "type": STRING,
        "id": LONG,
        "lat": DOUBLE,
        "lon": DOUBLE,
        "center": LAT_LON,
        "geometry": T.ArrayType(LAT_LON),
        "tags": T.MapType(STRING, STRING),
        "members": T.ArrayType(MEMBER),
    }
)

OSM_DUMP = _struct({"elements": T.ArrayType(OSM_ELEMENT)})

ENTITY = _struct(
    {
        "id": STRING,
        "names": _struct("en zh"),
        "category": STRING,
        "lat": DOUBLE,
        "lon": DOUBLE,
        "source": STRING,
        "last_updated": STRING,
        "tags": T.ArrayType(STRING),
        "geometry_ref": STRING,
        "assigned_district": STRING,
        "source_version": STRING,
    }
)

SNAPSHOT = _struct(
    {
        "url": STRING,
        "etag": STRING,
        "last_modified": STRING,
        "content_length": STRING,
        "file_md5": STRING,
        "downloaded_at": STRING,
        "file_name": STRING,
    }
)
