"""OSM scalars."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, functions as F

# One-letter codes of the element types, and the offset of area ids.
TYPE_CODES = {"node": "N", "way": "W", "relation": "R"}
AREA_ID_OFFSET = 3600000000


def osm_type_code(type_name: Column) -> Column:
    codes = F.create_map(*[F.lit(x) for pair in TYPE_CODES.items() for x in pair])
    return F.coalesce(F.try_element_at(codes, F.lower(type_name)), F.lit("N"))


def osm_area_id(relation_id: Column) -> Column:
    return F.lit(AREA_ID_OFFSET) + relation_id.cast("bigint")


def geometry_ref(code: Column, osm_id: Column) -> Column:
    return F.concat(F.lit("nominatim://"), code, F.lit("/"), osm_id.cast("string"))


def tag(tags: Column, key: str) -> Column:
    return F.try_element_at(tags, F.lit(key))


def matches_any_selector(tags: Column, selectors: Iterable[str]) -> Column:
    """OR of ``key`` and ``key=value`` selectors."""

    def one(selector: str) -> Column:
        key, eq, value = selector.partition("=")
        return tag(tags, key) == value if eq else F.map_contains_key(tags, F.lit(key))

    return F.coalesce(reduce(lambda a, b: a | b, map(one, selectors)), F.lit(False))
