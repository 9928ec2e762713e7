"""OSM element dumps -> one row per element."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..schemas import OSM_DUMP, OSM_ELEMENT
from .records import documents, records, rejects


def scan_elements(spark: SparkSession, paths: str | Sequence[str], strict: bool = True) -> DataFrame:
    """(path, pos, type, id, lat, lon, center, geometry, tags, members); ``(path, pos)`` is the element's file order.

    Missing paths are skipped and each path is read once. A dump that is not JSON stops the scan unless ``strict`` is off.
    """
    dump = documents(spark, StructType(list(OSM_DUMP.fields)), paths, "elements", strict=strict)
    return dump.select("path", F.posexplode("elements").alias("pos", "el")).select("path", "pos", "el.*")


def scan_element_lines(spark: SparkSession, paths: str | Sequence[str], layout: str = "line", strict: bool = True) -> DataFrame:
    """As :func:`scan_elements` for dumps of any size; files are split between tasks. ``layout``: see ``records``."""
    element = F.from_json("json", OSM_ELEMENT).alias("el")
    return records(spark, paths, "element", layout, None, strict).select("path", "block", "pos", element).select("path", "block", "pos", "el.*")


def rejected_elements(spark: SparkSession, paths: str | Sequence[str], layout: str = "line") -> DataFrame:
    return rejects(spark, paths, "element", layout)


def land_elements(elements: DataFrame, target: str) -> DataFrame:
    """Write scanned elements to Parquet, spread over all tasks, and read them from there: dumps are parsed once."""
    order = [c for c in ("path", "block", "pos") if c in elements.columns]
    elements.repartition(*order).write.mode("overwrite").parquet(target)
    return elements.sparkSession.read.schema(elements.schema).parquet(target)
