"""Canonical tables as CSV, Parquet or JSON lines, chosen by suffix."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, types as T

from ..schemas import CANONICAL
from .quoted import read_quoted_csv


def _format(path: str) -> str:
    suffix = os.path.splitext(path.rstrip("/"))[1].lower()
    return {".csv": "csv", ".parquet": "parquet", ".pq": "parquet"}.get(suffix, "json")


def read_canonical(spark: SparkSession, path: str, schema: T.StructType = CANONICAL, fmt: str | None = None) -> DataFrame:
    """Empty CSV fields come back as null; texts such as ``NA`` stay text. CSV files are split between tasks."""
    reader = spark.read.schema(schema)
    fmt = fmt or _format(path)
    if fmt == "csv":
        return read_quoted_csv(spark, path, schema)
    return reader.format(fmt).load(path)


def write_canonical(df: DataFrame, path: str, fmt: str | None = None, keep_nulls: bool = True, mode: str = "overwrite") -> None:
    """JSON lines keep null members for stage-1 output and drop them for stage 2 (``keep_nulls=False``)."""
    writer = df.write.mode(mode)
    fmt = fmt or _format(path)
    if fmt == "csv":
        # Null and empty text both become an empty field.
        writer.options(header=True, escape='"', emptyValue="").csv(path)
    elif fmt == "parquet":
        writer.parquet(path)
    else:
        writer.option("ignoreNullFields", not keep_nulls).json(path)
