"""Features -> canonical addresses."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import address as A
from ..functions.text import map_district, normalize_text_columns
from ..operators.dedup import dedup_key, file_order, first_wins
from ..schemas import CANONICAL, TEXT_COLUMNS
from ..sources.geojson import scan_feature_lines, scan_features

# Fixed value: provenance text of rows built from the government address feed.
DEFAULT_SOURCE = "gov_hk/ALS-GeoJSON"


def parse_features(features: DataFrame) -> DataFrame:
    """JSON text -> VARIANT ``props`` and ``coords``. Unreadable properties become null instead of stopping the run."""
    keys = [c for c in features.columns if c not in ("geometry", "properties")]
    # A repeated member keeps its last value, whatever the session says.
    features.sparkSession.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    return features.select(
        *keys,
        F.try_parse_json("properties").alias("props"),
        F.try_parse_json("geometry.coordinates").alias("coords"),
    )


def rejected_features(features: DataFrame) -> DataFrame:
    """Features whose properties are present but not readable JSON."""
    return features.filter(F.col("properties").isNotNull() & F.try_parse_json("properties").isNull())


def resolve_features(parsed: DataFrame) -> DataFrame:
    """Add the resolved ``chi`` and ``eng`` component structs.

    Done in two projections so each block is read once and the later expressions only touch plain structs.
    """
    props = F.col("props")
    blocks, resolved = {}, {}
    for lang in ("Chi", "Eng"):
        objects, texts = f"_{lang.lower()}", f"_{lang.lower()}_texts"
        blocks[objects], blocks[texts] = A.address_parts(props, lang)
        resolved[lang.lower()] = A.resolve_parts(props, lang, F.col(objects), F.col(texts))
    return parsed.withColumns(blocks).withColumns(resolved)


def canonicalize_feature(features: DataFrame, phase_from_estate: bool = False) -> DataFrame:
    """One canonical row per feature, with ``geoaddress``; other columns of ``features`` are kept."""
    keys = [c for c in features.columns if c not in ("geometry", "properties")]
    resolved = resolve_features(parse_features(features))
    props = F.col("props")
    csu = F.try_variant_get(props, f"{A.PREMISES}.BuildingCsuInformation.CsuId", "string")
    geo = F.try_variant_get(props, f"{A.PREMISES}.GeoAddress", "string")
    lon, lat = A.point_of(F.col("coords"))
    text = {}
    for suffix, lang, parts in (("chi", "zh", F.col("chi")), ("eng", "en", F.col("eng"))):
        text[f"address_{suffix}"] = A.compose_address(parts, lang)
        text[f"phase_{suffix}"] = A.pick_phase(parts, phase_from_estate)
        text[f"block_{suffix}"] = A.pick_block(parts)
        text[f"building_{suffix}"] = A.pick_building(parts)
        text[f"estate_{suffix}"] = A.pick_estate(parts)
        text[f"village_{suffix}"] = A.pick_village(parts)
        text[f"street_{suffix}"] = A.pick_street(parts)
    rows = resolved.select(
        *keys,
        A.feature_id(csu, geo).alias("id"),
        A.geo_address(csu, geo).alias("geoaddress"),
        *[F.coalesce(c, F.lit("")).alias(n) if n.startswith("address_") else c.alias(n) for n, c in text.items()],
        lat.alias("lat"),
        lon.alias("lon"),
        F.try_variant_get(props, "$.Easting", "double").alias("easting"),
        F.try_variant_get(props, "$.Northing", "double").alias("northing"),
        F.col("_chi.ChiDistrict").alias("district_chi"),
        F.col("_eng.EngDistrict").alias("district_eng"),
    )
    return normalize_text_columns(rows, TEXT_COLUMNS)


def canonicalize(
    features: DataFrame,
    order: Sequence[str] | None = None,
    *,
    phase_from_estate: bool = False,
    normalize_district: bool = False,
    keep_provenance: bool = False,
    source: str = DEFAULT_SOURCE,
    source_version: str | None = None,
    as_of: str | None = None,
) -> DataFrame:
    """Features (with their order columns) -> deduplicated canonical table: one shuffle, on the dedup key.

    ``order`` defaults to those of path, block and pos that the scan gives. Unreadable features stay rows of their own.
    """
    order = list(order or file_order(features))
    unread = F.col("properties").isNotNull() & F.try_parse_json("properties").isNull()
    marked = features.select(*order, "geometry", "properties", unread.alias("_unread"))
    rows = canonicalize_feature(marked, phase_from_estate)
    key = dedup_key(*[F.col(c) for c in ("id", "geoaddress", "lat", "lon", "address_chi", "address_eng")])
    key = F.when(F.col("_unread"), F.concat_ws("::", F.lit("unread"), *order)).otherwise(key)
    kept = first_wins(rows.withColumn("_key", key).drop("_unread"), "_key", order)
    out = kept
    if normalize_district:
        out = out.withColumns({c: map_district(F.col(c)) for c in ("district_chi", "district_eng")})
    if not keep_provenance:
        return out.select(*CANONICAL.fieldNames())
    return out.select(
        *CANONICAL.fieldNames(),
        "geoaddress",
        F.lit(source).alias("source"),
        F.lit(source_version).cast("string").alias("source_version"),
        F.array().cast("array<string>").alias("tags"),
        (F.lit(as_of) if as_of else F.current_date().cast("string")).alias("last_modified"),
    )


def canonicalize_files(
    spark: SparkSession,
    paths: str | Sequence[str],
    recursive: bool = False,
    one_feature_per_line: bool = False,
    layout: str | None = None,
    **options,
) -> DataFrame:
    """``layout`` names a splittable one; without it each file is read whole."""
    layout = layout or ("line" if one_feature_per_line else None)
    if layout:
        return canonicalize(scan_feature_lines(spark, paths, recursive, layout), **options)
    return canonicalize(scan_features(spark, paths, recursive), **options)
