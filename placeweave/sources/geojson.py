"""Feature collections -> one row per feature."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..schemas import FEATURE, FEATURE_COLLECTION
from .records import documents, existing_paths, reader, records, rejects


def scan_features(spark: SparkSession, paths: str | Sequence[str], recursive: bool = False, strict: bool = True) -> DataFrame:
    """(path, pos, geometry, properties) of every feature; ``properties`` and the coordinates stay JSON text.

    A directory is searched for ``*.geojson`` at any depth when ``recursive``; otherwise paths and globs are taken as
    given. Missing paths are skipped and each path is read once. A file that is not JSON stops the scan unless ``strict``
    is off. Each file is one JSON document and so one task and one row: use :func:`scan_feature_lines` for files too
    large for that, and land feeds that are read often with :func:`land_features`.
    """
    glob = "*.geojson" if recursive else None
    collections = documents(spark, StructType(list(FEATURE_COLLECTION.fields)), paths, "features", glob, strict)
    return explode_features(collections, F.col("path"))


def scan_feature_lines(
    spark: SparkSession, paths: str | Sequence[str], recursive: bool = False, layout: str = "line", strict: bool = True
) -> DataFrame:
    """(path, block, pos, geometry, properties) of collections in a splittable layout; see ``records``.

    Files are split between tasks, so one file may hold any share of the rows. Order columns: ``path, block, pos``.
    """
    lines = records(spark, paths, "feature", layout, "*.geojson" if recursive else None, strict)
    feature = F.from_json("json", FEATURE).alias("feature")
    return lines.select("path", "block", "pos", feature).select(
        "path", "block", "pos", "feature.geometry", "feature.properties"
    )


def rejected_records(spark: SparkSession, paths: str | Sequence[str], recursive: bool = False, layout: str = "line") -> DataFrame:
    return rejects(spark, paths, "feature", layout, "*.geojson" if recursive else None)


def collection_files(spark: SparkSession, paths: str | Sequence[str], recursive: bool = False) -> DataFrame:
    """(path) of every collection, those without features too; contents are not read."""
    found = existing_paths(spark, paths)
    if not found:
        return spark.createDataFrame([], "path string")
    files = reader(spark, "*.geojson" if recursive else None).format("binaryFile").load(found)
    return files.select(F.col("_metadata.file_path").alias("path"))


def explode_features(collections: DataFrame, path: Column) -> DataFrame:
    return collections.select(path.alias("path"), F.posexplode("features").alias("pos", "feature")).select(
        "path", "pos", "feature.geometry", "feature.properties"
    )


def land_features(features: DataFrame, target: str, partitions: int | None = None) -> DataFrame:
    """Write the exploded features to Parquet, spread over all tasks, and read them back from there."""
    spread = features.repartition(partitions) if partitions else features.repartition(*[c for c in ("path", "block", "pos") if c in features.columns])
    spread.write.mode("overwrite").parquet(target)
    return features.sparkSession.read.schema(features.schema).parquet(target)
