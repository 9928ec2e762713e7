"""Building-level dedup: the first record per key in (file, position) order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import landed
from .prefilter import ROW_BITS, is_set
from .sizing import BroadcastLimit


def micro_degrees(value: Column) -> Column:
    """Six decimals as an exact integer, so the key does not depend on how an engine prints doubles."""
    return F.floor(value * 1e6 + 0.5).cast("string")


def dedup_key(row_id: Column, geo: Column, lat: Column, lon: Column, chi: Column, eng: Column) -> Column:
    """Record id, else geo key, else position, else text. The geo branch only matters for tables whose id lacks it."""

    def present(text: Column) -> Column:
        return F.coalesce(text, F.lit("")) != ""

    return (
        F.when(present(row_id), F.concat(F.lit("id::"), row_id))
        .when(present(geo), F.concat(F.lit("geo::"), geo))
        .when(
            lat.isNotNull() & lon.isNotNull(),
            F.concat(F.lit("coord::"), micro_degrees(lat), F.lit(","), micro_degrees(lon)),
        )
        .otherwise(F.concat(F.lit("addr::"), F.coalesce(chi, F.lit("")), F.lit("||"), F.coalesce(eng, F.lit(""))))
    )


def first_wins(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """One row per key, the least by ``order``.

    ``min_by`` is combined before the shuffle, so a key with very many copies sends one row per task.
    """
    kept = [c for c in df.columns if c != key]
    winner = F.min_by(F.struct(*kept), F.struct(*order)).alias("row")
    return df.groupBy(key).agg(winner).select(key, "row.*")


#: Rows of one block of a scan are numbered below this, so a block's number and a row's fit one long.
IN_BLOCK = 1 << 33


def first_wins_late(df: DataFrame, key: str, order: list[str], limit: BroadcastLimit = BroadcastLimit()) -> DataFrame:
    """As :func:`first_wins` for tables that are much wider than their keys and read the same twice, as landed ones do.

    Only 128 bits of the key's hash and one number for a row's place go through the shuffle, all of them fixed-width, so the
    aggregate is a hash aggregate and what is shuffled does not depend on how wide rows are. The winners' places become a
    bitmap, a bit for each row of the table, and the table is read again through it; the bitmap is broadcast when it was
    measured to be small. The last column of ``order`` must be a number that is not negative; the others say which block
    of the input a row is in. A third hash tells whether two keys share 128 bits; if any do, rows go the other way.
    """
    *lead, last = order
    ranked, n = None, 1
    if lead:
        blocks = landed(df.select(*lead).distinct(), "blocks")
        ranked, n = blocks.withColumn("_block", F.row_number().over(Window.orderBy(*lead)) - 1), blocks.count()

    def placed(rows: DataFrame) -> DataFrame:
        if not lead:
            return rows.withColumn("_place", F.col(last).cast("long") + 1)
        same = [rows[c].eqNullSafe(ranked[c]) for c in lead]
        joined = rows.join(limit.hint(ranked, n, 256 * n), same)
        place = F.col("_block").cast("long") * IN_BLOCK + rows[last].cast("long") % IN_BLOCK + 1
        return joined.select(*[rows[c] for c in rows.columns], place.alias("_place"))

    digests = [F.xxhash64(F.lit(salt), F.isnull(key), key).alias(f"_d{salt}") for salt in range(3)]
    narrow = placed(df.select(*order, key)).select(*digests, "_place")
    found = narrow.groupBy("_d0", "_d1").agg(F.min("_place").alias("_place"), F.min("_d2").alias("lo"), F.max("_d2").alias("hi"))
    winners = landed(found, "winners")
    if not winners.filter("lo <> hi").isEmpty():
        return first_wins(df, key, order)
    bucket = F.bitmap_bucket_number("_place").alias("_bucket")
    bits = landed(winners.groupBy(bucket).agg(F.bitmap_construct_agg(F.bitmap_bit_position("_place")).alias("_bits")), "winner-bits")
    n_bits = bits.count()
    rows = placed(df).withColumn("_bucket", F.bitmap_bucket_number("_place"))
    kept = rows.join(limit.hint(bits, n_bits, n_bits * ROW_BITS // 8), "_bucket").filter(is_set("_bits", "_place"))
    return kept.select(key, *[c for c in df.columns if c != key])


def file_order(rows: DataFrame) -> list[str]:
    """The columns that sort scanned rows like their files."""
    return [c for c in ("path", "block", "pos") if c in rows.columns]
