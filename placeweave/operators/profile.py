"""Profiles: property-key frequencies, feature counts, top keys and fill rates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def property_key_freq(features: DataFrame, properties: str = "properties", by: str = "path") -> DataFrame:
    """(by, key, cnt) of the top-level property keys per file."""
    keys = F.explode(F.json_object_keys(properties)).alias("key")
    return features.select(by, keys).groupBy(by, "key").agg(F.count("*").alias("cnt"))


def global_key_freq(per_file: DataFrame) -> DataFrame:
    return per_file.groupBy("key").agg(F.sum("cnt").alias("cnt"))


def top_keys_per_file(per_file: DataFrame, n: int = 10, by: str = "path") -> DataFrame:
    place = F.row_number().over(Window.partitionBy(by).orderBy(F.desc("cnt"), "key"))
    return per_file.withColumn("position", place).filter(F.col("position") <= n)


def top_keys_global(per_file: DataFrame, n: int = 40) -> DataFrame:
    return global_key_freq(per_file).orderBy(F.desc("cnt"), "key").limit(n)


def feature_counts(features: DataFrame, files: DataFrame | None = None, properties: str = "properties", by: str = "path") -> DataFrame:
    """(by, files, features, keys) per file plus a total row with a null ``by``.

    ``files`` lists all files by the same column, so that those without features are rows of zeros and count as files.

    Rows are first reduced to one per (file, key set), so the distinct count never sees single features.
    """
    key_sets = features.groupBy(by, F.json_object_keys(properties).alias("_keys")).agg(F.count("*").alias("n"))
    keyed = key_sets.select(by, "n", F.posexplode_outer("_keys").alias("_i", "key"))
    counted = F.sum(F.when(F.coalesce("_i", F.lit(0)) == 0, F.col("n")))
    if files is not None:
        listed = files.select(by).distinct()
        keyed = listed.join(keyed, by, "left")
    per_file = keyed.rollup(by).agg(F.coalesce(counted, F.lit(0)).alias("features"), F.count_distinct("key").alias("keys"), F.count_distinct(by).alias("n"))
    return per_file.select(by, F.col("n").alias("files"), "features", "keys")


def fill_rates(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column_name, filled, total, fill_rate) in one pass; empty text counts as missing."""
    columns = list(columns or df.columns)
    text = {f.name for f in df.schema if f.dataType.simpleString() == "string"}

    def present(c: str) -> Column:
        return F.col(c).isNotNull() & (F.col(c) != "") if c in text else F.col(c).isNotNull()

    counts = df.agg(F.count("*").alias("total"), *[F.count_if(present(c)).alias(f"_{i}") for i, c in enumerate(columns)])
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"_{i}").alias("filled")) for i, c in enumerate(columns)]))
    return counts.select("total", rows.alias("r")).select(
        "r.column_name",
        "r.filled",
        "total",
        F.when(F.col("total") > 0, F.col("r.filled") / F.col("total")).alias("fill_rate"),
    )


def sub_district_provenance(df: DataFrame) -> DataFrame:
    """Rows whose locality came from geography, from the village name, or not at all."""
    origin = (
        F.when(F.col("sub_district_dist_m").isNotNull(), "geographic")
        .when(F.coalesce("sub_district_chi", "sub_district_eng").isNotNull(), "village")
        .otherwise("none")
    )
    return df.groupBy(origin.alias("provenance")).agg(F.count("*").alias("cnt"))
