"""Joins behind a bitmap equal plain joins at every size of the bitmap, and shuffle only what may match."""

import pytest

from placeweave.operators import prefilter as P
from pyspark.sql import functions as F


def tables(spark):
    df = spark.range(5000).select((F.col("id") % 3000).alias("k"), F.concat(F.lit("t"), F.col("id") % 7).alias("t"), "id")
    df = df.unionByName(spark.createDataFrame([(None, "t1", -1), (5, None, -2)], "k long, t string, id long"))
    other = spark.range(0, 6000, 13).select(F.col("id").alias("k"), F.concat(F.lit("t"), F.col("id") % 7).alias("t"), (F.col("id") * 2).alias("v"))
    return df, other.unionByName(spark.createDataFrame([(None, "t1", 1)], "k long, t string, v long"))


@pytest.mark.parametrize("most_bits", [P.MOST_BITS, 1])
@pytest.mark.parametrize("bits_per_key", [16, 1])
def test_reduced_joins_equal_plain_joins(spark, monkeypatch, most_bits, bits_per_key):
    monkeypatch.setattr(P, "BITS_PER_KEY", bits_per_key)
    df, other = tables(spark)
    n = other.count()
    for how in ("left", "left_anti"):
        got = P.reduced_left_join(df, other, ["k", "t"], n, how, most_bits)
        want = df.join(other, ["k", "t"], how)
        assert got.columns == want.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    semi = P.only_possible(df, other, ["k", "t"], n, most_bits).join(other, ["k", "t"], "left_semi")
    assert sorted(map(str, semi.collect())) == sorted(map(str, df.join(other, ["k", "t"], "left_semi").collect()))


def test_few_rows_pass_that_cannot_match(spark):
    df, other = tables(spark)
    n = other.count()
    real = df.join(other, ["k", "t"], "left_semi").count()
    assert real <= P.only_possible(df, other, ["k", "t"], n).count() <= real + 0.15 * 5000
    assert P.only_possible(df, other.limit(0), ["k", "t"], 0).count() == 0
    assert P.reduced_left_join(df.limit(0), other, ["k", "t"], n).count() == 0
