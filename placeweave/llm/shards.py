"""Shards by extendible hashing: a directory of hash prefixes, where only buckets above the byte limit split.

A row's address is 120 bits: 60 of the MD5 of its key and 60 of the MD5 of its row number, so rows that share a key
still part when one key alone is above the limit. A bucket is a prefix of the address. It stays whole when its rows fit
the limit or when it holds a single row, which no further bit can make smaller; such a shard is marked ``oversized``.

Texts are measured in UTF-8 bytes; a null text has none, a null key hashes like an empty one. Rows that repeat are
placed one by one, and a text of any length is one row. An empty table has no shards. Columns beside key and text are not
read by ``shard``; ``write_shards`` replaces a column named ``shard`` and carries the others along.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from placeweave.llm.store import store
from placeweave.operators.sizing import BroadcastLimit

HALF = 60
# Bits that one round over the rows looks ahead, beyond those that an even spread would need.
AHEAD = 6
LEAF_BYTES = 64


def hash_bits(value: Column) -> Column:
    """The first 60 bits of an MD5, as a long."""
    return F.conv(F.substring(F.md5(F.coalesce(value.cast("string"), F.lit(""))), 1, 15), 16, 10).cast("long")


def prefix(h1: Column, h2: Column, depth: Column) -> list[Column]:
    """The first ``depth`` bits of an address, as two longs."""

    def cut(h: Column, bits: Column) -> Column:
        return F.call_function("shiftright", h, (HALF - F.least(F.greatest(bits, F.lit(0)), F.lit(HALF))).cast("int"))

    return [cut(h1, depth).alias("p1"), cut(h2, depth - HALF).alias("p2")]


def addressed(df: DataFrame, key: str, nbytes: Column) -> DataFrame:
    """(key, h1, h2, n_bytes), written down, so a row keeps its number when a task runs again."""
    number = F.monotonically_increasing_id()
    rows = df.select(F.col(key).alias("key"), nbytes.cast("long").alias("n_bytes"), number.alias("number"))
    return store(rows.select("key", hash_bits(F.col("key")).alias("h1"), hash_bits(F.col("number")).alias("h2"), "n_bytes"), "addresses")


def directory(rows: DataFrame, limit: int) -> DataFrame:
    """Leaves (depth, p1, p2, shard_bytes, shard_rows, oversized). Each round reads sums of a bounded number of cells."""
    total = rows.agg(F.sum("n_bytes")).first()[0] or 0
    low, high = 0, min(2 * HALF, AHEAD + max(0, math.ceil(math.log2(max(1, total / limit)))))
    open_rows, leaves = rows, []
    while True:
        cells = store(
            open_rows.groupBy(*prefix(F.col("h1"), F.col("h2"), F.lit(high))).agg(F.sum("n_bytes").alias("b"), F.count("*").alias("n")),
            "cells",
        )
        sums = cells.select(F.explode(F.sequence(F.lit(low), F.lit(high))).alias("depth"), "p1", "p2", "b", "n")
        up = F.col("depth").cast("int")
        sums = sums.select("depth", *_shorten(F.col("p1"), F.col("p2"), high, up), "b", "n")
        sums = store(sums.groupBy("depth", "p1", "p2").agg(F.sum("b").alias("b"), F.sum("n").alias("n")), "sums")
        fits = (F.col("b") <= limit) | (F.col("n") == 1)
        parents = sums.filter(~fits).select((F.col("depth") + 1).alias("depth"), F.col("p1").alias("q1"), F.col("p2").alias("q2"))
        below = sums.filter(fits).select("*", *[c.alias(n) for c, n in zip(_parent(), ("q1", "q2"), strict=True)])
        grown = below.join(parents, ["depth", "q1", "q2"], "left_semi")
        first = below.filter((F.col("depth") == low) & F.lit(low == 0))
        leaves.append(
            first.unionByName(grown.select(first.columns)).select(
                "depth", "p1", "p2", F.col("b").alias("shard_bytes"), F.col("n").alias("shard_rows"), (F.col("b") > limit).alias("oversized")
            )
        )
        left = sums.filter((F.col("depth") == high) & ~fits).select("p1", "p2")
        if high == 2 * HALF or left.isEmpty():
            break
        keyed = open_rows.select("*", *prefix(F.col("h1"), F.col("h2"), F.lit(high)))
        open_rows = store(keyed.join(left, ["p1", "p2"], "left_semi").select(rows.columns), "open")
        low, high = high, min(2 * HALF, high + 2 * AHEAD)
    out = leaves[0]
    for more in leaves[1:]:
        out = out.unionByName(more)
    return store(out, "directory")


def _shorten(p1: Column, p2: Column, at: int, depth: Column) -> list[Column]:
    """A prefix of ``at`` bits cut down to ``depth`` bits."""
    first, second = min(at, HALF), max(0, at - HALF)
    drop1 = first - F.least(depth, F.lit(first))
    drop2 = second - F.greatest(F.least(depth - HALF, F.lit(second)), F.lit(0))
    return [
        F.call_function("shiftright", p1, drop1.cast("int")).alias("p1"),
        F.call_function("shiftright", p2, drop2.cast("int")).alias("p2"),
    ]


def _parent() -> list[Column]:
    deep = F.col("depth") > HALF
    return [
        F.when(deep, F.col("p1")).otherwise(F.shiftright("p1", 1)),
        F.when(deep, F.shiftright("p2", 1)).otherwise(F.col("p2")),
    ]


def assign(rows: DataFrame, leaves: DataFrame, broadcast: BroadcastLimit = BroadcastLimit()) -> DataFrame:
    """Every row with its leaf. The depths in use are few; the directory is broadcast when it was measured to be small."""
    depths = sorted(r[0] for r in leaves.select("depth").distinct().collect())
    tried = rows.select("*", F.explode(F.array(*[F.lit(d) for d in depths]).cast("array<int>")).alias("depth"))
    tried = tried.select("*", *prefix(F.col("h1"), F.col("h2"), F.col("depth")))
    n = leaves.count()
    return tried.join(broadcast.hint(leaves, n, n * LEAF_BYTES), ["depth", "p1", "p2"])


def shard_name(depth: Column, p1: Column, p2: Column) -> Column:
    """The prefix as bits, ``*`` for the whole table."""
    bits = F.concat(
        F.lpad(F.bin(p1), F.least(depth, F.lit(HALF)), F.lit("0")),
        F.lpad(F.bin(p2), F.greatest(depth - HALF, F.lit(0)), F.lit("0")),
    )
    return F.when(depth == 0, "*").otherwise(bits)


def shard(df: DataFrame, key: str, limit: int, nbytes: Column | None = None, text: str = "text") -> DataFrame:
    """(key, n_bytes, shard, depth, shard_bytes, shard_rows, oversized), one row for each row of ``df``."""
    size = F.coalesce(F.octet_length(text) if nbytes is None else nbytes, F.lit(0))
    rows = addressed(df, key, size)
    placed = assign(rows, directory(rows, limit))
    name = shard_name(F.col("depth"), F.col("p1"), F.col("p2"))
    return placed.select(F.col("key").alias(key), "n_bytes", name.alias("shard"), "depth", "shard_bytes", "shard_rows", "oversized")


def write_shards(df: DataFrame, placed: DataFrame, key: str, path: str) -> None:
    """One folder a shard with the rows of ``df``, whose own ``shard`` column goes; ``key`` must name its rows uniquely."""
    shards = store(placed.select(key, "shard"), "placed")
    df.drop("shard").join(shards, key).repartition("shard").write.partitionBy("shard").parquet(path)
