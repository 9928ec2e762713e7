"""Canonical addresses -> addresses with their colloquial locality."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions.geodesy import hk80_grid
from ..functions.text import inject_sub_district, village_fallback
from ..operators.dedup import file_order
from ..operators.nearest import nearest_within
from ..operators.sizing import BroadcastLimit

DEFAULT_RADIUS_M = 1500.0

_CARRY = {"zh_name": "sub_district_chi", "en_name": "sub_district_eng"}


def _flat(df: DataFrame) -> DataFrame:
    return df.withColumns({"_e": F.col("_grid.easting"), "_n": F.col("_grid.northing")}).drop("_grid")


def nearest_locality(
    addresses: DataFrame,
    places: DataFrame,
    max_m: float = DEFAULT_RADIUS_M,
    order: Sequence[str] | None = None,
    limit: BroadcastLimit = BroadcastLimit(),
) -> DataFrame:
    """Add ``sub_district_chi``, ``sub_district_eng`` and ``sub_district_dist_m`` from latitudes and longitudes."""
    usable = F.col("lat").isNotNull() & F.col("lon").isNotNull()
    order = list(order or file_order(places))
    projected = places.filter(usable).select(*order, *_CARRY, hk80_grid(F.col("lat"), F.col("lon")).alias("_grid"))
    found = nearest_within(
        _flat(addresses.withColumn("_grid", hk80_grid(F.col("lat"), F.col("lon")))),
        _flat(projected),
        max_m,
        point_xy=("_e", "_n"),
        label_xy=("_e", "_n"),
        order=order,
        carry=_CARRY,
        distance_column="sub_district_dist_m",
        limit=limit,
    )
    return found.drop("_e", "_n")


def derive_sub_district(
    addresses: DataFrame,
    places: DataFrame | None,
    max_m: float = DEFAULT_RADIUS_M,
    *,
    prefer_village: bool = True,
    inject_into_address: bool = False,
    order: Sequence[str] | None = None,
    limit: BroadcastLimit = BroadcastLimit(),
) -> DataFrame:
    """Nearest locality, then the village name where there is none, then optionally the splice into the addresses."""
    columns = set(addresses.columns)
    if places is not None and {"lat", "lon"} <= columns:
        out = nearest_locality(addresses, places, max_m, order, limit)
    else:
        none = F.lit(None)
        out = addresses.withColumns(
            {
                "sub_district_chi": none.cast("string"),
                "sub_district_eng": none.cast("string"),
                "sub_district_dist_m": none.cast("double"),
            }
        )
    return finish_sub_district(out, prefer_village, inject_into_address)


def finish_sub_district(found: DataFrame, prefer_village: bool = True, inject_into_address: bool = False) -> DataFrame:
    columns = set(found.columns)
    out = found
    if prefer_village:
        fallback = {
            f"sub_district_{s}": village_fallback(F.col(f"sub_district_{s}"), F.col(f"village_{s}"))
            for s in ("chi", "eng")
            if f"village_{s}" in columns
        }
        out = out.withColumns(fallback) if fallback else out
    if inject_into_address:
        spliced = {
            f"address_{s}": inject_sub_district(
                F.col(f"address_{s}"), F.col(f"district_{s}"), F.col(f"sub_district_{s}"), before_district=s == "eng"
            )
            for s in ("chi", "eng")
            if {f"address_{s}", f"district_{s}"} <= columns
        }
        out = out.withColumns(spliced) if spliced else out
    return out
