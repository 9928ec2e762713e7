"""Manifests of landed files."""

from __future__ import annotations

import re
import sys
from functools import reduce

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F

# The digest travels with the job, so executors need no copy of this module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def file_manifest(spark: SparkSession, path: str) -> DataFrame:
    """(path, length) of every file at any depth that has bytes; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select("path", "length")


#: Files of fewer bytes are digested as one value; that is far below the 2 GB that a value can hold.
WHOLE_BELOW = 256 << 20
# Suffixes of files that Spark unpacks while it reads them as text.
UNPACKED = (".gz", ".bz2", ".zst", ".lz4", ".snappy", ".deflate")


def file_fingerprints(spark: SparkSession, path: str, whole_below: int = WHOLE_BELOW) -> DataFrame:
    """(path, length, file_md5) of files of any size; only packed files must stay under 2 GB."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    packed = reduce(lambda a, b: a | b, (F.lower("path").endswith(suffix) for suffix in UNPACKED))
    streamed = (F.col("length") >= whole_below) & ~packed
    whole = files.filter(~streamed).select("path", "length", F.md5("content").alias("file_md5"))
    large = [r["path"] for r in files.filter(streamed).select("path").collect()]
    return whole.unionByName(streamed_md5(spark, large)) if large else whole


def streamed_md5(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, length, file_md5): pieces of the files run in order through one digest for each file.

    A digest goes on from piece to piece, so a file's pieces meet in one task, which holds a batch of them at a time.
    """
    text = spark.read.option("lineSep", "\n").text([glob_escaped(p) for p in paths])
    pieces = text.select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_size").alias("length"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("pos"),
        F.col("value").cast("binary").alias("value"),
    )
    ordered = pieces.repartition("path").sortWithinPartitions("path", "block", "pos").select("path", "length", "value")

    def digest(batches):
        import hashlib

        import pyarrow as pa

        held = None  # path, length, digest, bytes so far

        def told():
            return pa.RecordBatch.from_arrays(
                [pa.array([held[0]]), pa.array([held[1]], pa.int64()), pa.array([held[2].hexdigest()])], names=["path", "length", "file_md5"]
            )

        for batch in batches:
            for path, length, value in zip(*(batch.column(c).to_pylist() for c in ("path", "length", "value"))):
                if held is None or held[0] != path:
                    if held is not None:
                        yield told()
                    held = [path, length, hashlib.md5(), 0]
                # The separator of the last piece is there only if the length says so.
                piece = value + b"\n" if held[3] + len(value) < length else value
                held[2].update(piece)
                held[3] += len(piece)
        if held is not None:
            yield told()

    return ordered.mapInArrow(digest, "path string, length long, file_md5 string")


def glob_escaped(path: str) -> str:
    """A path as a pattern that only it matches."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def landing_summary(manifest: DataFrame) -> DataFrame:
    """Total and GeoJSON file counts, and total bytes."""
    is_geojson = F.lower("path").endswith(".geojson")
    return manifest.agg(
        F.count("*").alias("files"),
        F.count_if(is_geojson).alias("geojson_files"),
        F.coalesce(F.sum("length"), F.lit(0)).alias("total_bytes"),
    )


def example_files(manifest: DataFrame, n: int = 10) -> DataFrame:
    return manifest.filter(F.lower("path").endswith(".geojson")).orderBy("path").limit(n)
