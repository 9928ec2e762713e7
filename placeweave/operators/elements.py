"""Filters and projections over OSM elements."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.osm import matches_any_selector, tag
from ..functions.text import split_combined_name
from ..functions.variant import non_empty
from .dedup import file_order
from .polygons import is_ring, points_in_polygons, ring_of
from .sizing import BroadcastLimit

# Place kinds that name a colloquial locality.
LOCALITY_KINDS = ("suburb", "quarter", "neighbourhood", "village", "town", "region")

# Any of these tags makes an area useful for filling in district, city or postcode.
AREA_TAGS = ("addr:district", "addr:city", "addr:postcode", "admin_level")


def filter_place_types(elements: DataFrame, kinds: Iterable[str] = LOCALITY_KINDS) -> DataFrame:
    """Elements whose ``place`` tag is one of the kinds, in any case; adds the lower-cased ``place``."""
    place = F.lower(tag(F.col("tags"), "place"))
    return elements.withColumn("place", place).filter(F.col("place").isin([k.lower() for k in kinds]))


def load_places(elements: DataFrame, kinds: Iterable[str] = LOCALITY_KINDS, order: Sequence[str] | None = None) -> DataFrame:
    """(order..., lat, lon, zh_name, en_name, place, tags) of usable locality labels.

    Coordinates are the element's own pair or its centre's; ``order`` defaults to the scan's own. A missing name is taken from the combined ``name`` tag; labels
    without both names are dropped.
    """
    tags, order = F.col("tags"), order or file_order(elements)
    zh, en = split_combined_name(tag(tags, "name"))
    own = F.col("lat").isNotNull() & F.col("lon").isNotNull()
    labels = filter_place_types(elements, kinds).select(
        *order,
        F.when(own, F.col("lat")).otherwise(F.col("center.lat")).alias("lat"),
        F.when(own, F.col("lon")).otherwise(F.col("center.lon")).alias("lon"),
        F.coalesce(non_empty(tag(tags, "name:zh")), zh).alias("zh_name"),
        F.coalesce(non_empty(tag(tags, "name:en")), en).alias("en_name"),
        "place",
        "tags",
    )
    return labels.dropna(subset=["lat", "lon", "zh_name", "en_name"])


def _is_area() -> Column:
    return F.col("type").isin("way", "relation") & is_ring(F.col("geometry"))


def building_filter() -> Column:
    return _is_area() & (F.coalesce(tag(F.col("tags"), "building"), F.lit("")) != "")


def address_filter() -> Column:
    return (
        (F.col("type") == "node")
        & (F.coalesce(tag(F.col("tags"), "addr:housenumber"), F.lit("")) != "")
        & F.col("lat").isNotNull()
        & F.col("lon").isNotNull()
    )


def admin_filter() -> Column:
    wanted = F.array(*[F.lit(t) for t in AREA_TAGS])
    return _is_area() & F.coalesce(F.arrays_overlap(F.map_keys("tags"), wanted), F.lit(False))


def buildings(elements: DataFrame) -> DataFrame:
    return elements.filter(building_filter()).select(F.col("id").alias("osm_id"), ring_of(F.col("geometry")).alias("ring"))


def address_points(elements: DataFrame) -> DataFrame:
    tags = F.col("tags")
    return elements.filter(address_filter()).select(
        F.col("id").alias("addr_osm_id"),
        "lon",
        "lat",
        *[tag(tags, f"addr:{k}").alias(f"addr_{k}") for k in ("housenumber", "street", "postcode", "city", "district")],
    )


def admin_areas(elements: DataFrame) -> DataFrame:
    tags = F.col("tags")
    return elements.filter(admin_filter()).select(
        tag(tags, "addr:city").alias("admin_city"),
        tag(tags, "addr:postcode").alias("admin_postcode"),
        F.coalesce(non_empty(tag(tags, "addr:district")), tag(tags, "name")).alias("admin_district"),
        ring_of(F.col("geometry")).alias("ring"),
    )


def class_counts(elements: DataFrame) -> DataFrame:
    """Buildings, address points and admin areas in one pass; an element may count in several classes."""
    return elements.agg(
        F.count_if(building_filter()).alias("buildings"),
        F.count_if(address_filter()).alias("addresses"),
        F.count_if(admin_filter()).alias("admin_areas"),
    )


def filter_tags(elements: DataFrame, selectors: Iterable[str]) -> DataFrame:
    return elements.filter(matches_any_selector(F.col("tags"), selectors))


def filter_named(elements: DataFrame) -> DataFrame:
    return elements.filter(F.map_contains_key("tags", F.lit("name")))


def elements_in_area(elements: DataFrame, areas: DataFrame, ring: str = "ring", limit: BroadcastLimit = BroadcastLimit()) -> DataFrame:
    """Elements with their own point, centre or any vertex strictly inside one of the areas."""
    vertex = "struct<lat:double,lon:double>"

    def spot(lat: str, lon: str) -> Column:
        given = F.col(lat).isNotNull() & F.col(lon).isNotNull()
        return F.when(given, F.array(F.struct(F.col(lat).alias("lat"), F.col(lon).alias("lon")).cast(vertex)))

    spots = F.coalesce(spot("lat", "lon"), spot("center.lat", "center.lon"), F.col("geometry").cast(f"array<{vertex}>"))
    located = elements.select("type", "id", F.explode(spots).alias("_spot")).select("type", "id", "_spot.lat", "_spot.lon")
    inside = points_in_polygons(located, areas, x="lon", y="lat", ring=ring, carry={}, how="left_semi", limit=limit)
    return elements.join(inside.select("type", "id").distinct(), ["type", "id"], "left_semi")
