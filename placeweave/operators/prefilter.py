"""Bitmaps over hash buckets in front of joins: rows that surely have no partner skip the shuffle.

A bitmap has a bit for each hash bucket that some key falls into. Its size follows the measured number of keys and is
bounded; past the bound every row may have a partner and the join is the plain one. A bit that several keys share only
lets a row through that the join then drops, so results never depend on the bitmap.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

BITS_PER_KEY = 16
#: 32 MB in all, in rows of 4 KB.
MOST_BITS = 1 << 28
ROW_BITS = 32_768

MAYBE = "_maybe"


def bitmap(keys: DataFrame, on: Sequence[str], bits: int) -> DataFrame:
    """(_bucket, _bits): 32,768 hash buckets a row."""
    slot = _slot(on, bits)
    return keys.groupBy(F.bitmap_bucket_number(slot).alias("_bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("_bits"))


def _slot(on: Sequence[str], bits: int):
    return F.pmod(F.xxhash64(*on), F.lit(bits)) + 1


def bits_for(n: int) -> int:
    """A power of two with ``BITS_PER_KEY`` bits for each of ``n`` keys."""
    return max(ROW_BITS, 1 << (max(1, n * BITS_PER_KEY) - 1).bit_length())


def with_maybe(df: DataFrame, keys: DataFrame, on: Sequence[str], n: int, most_bits: int = MOST_BITS) -> DataFrame:
    """``df`` with ``_maybe``: false where no row of ``keys``, which has ``n`` rows, can agree on the columns ``on``.

    A null in ``on`` agrees with nothing in a join, but may pass here.
    """
    bits = bits_for(n)
    if bits > most_bits:
        return df.withColumn(MAYBE, F.lit(True))
    held = bitmap(keys, on, bits)
    placed = df.withColumns({"_at": _slot(on, bits), "_bucket": F.bitmap_bucket_number(_slot(on, bits))})
    joined = placed.join(F.broadcast(held), "_bucket", "left")
    return joined.withColumn(MAYBE, F.coalesce(is_set("_bits", "_at"), F.lit(False))).select(*df.columns, MAYBE)


def is_set(bits: str, number: str) -> Column:
    """Whether a row of a bitmap has the bit of a number that falls into it."""
    position = F.bitmap_bit_position(number)
    byte = F.conv(F.hex(F.substring(bits, (F.floor(position / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.call_function("shiftright", byte, (position % 8).cast("int")).bitwiseAND(F.lit(1)) == 1


def only_possible(df: DataFrame, keys: DataFrame, on: Sequence[str], n: int, most_bits: int = MOST_BITS) -> DataFrame:
    """The rows of ``df`` that may have a partner in ``keys``: what an inner or semi join needs."""
    return with_maybe(df, keys, on, n, most_bits).filter(MAYBE).drop(MAYBE)


def reduced_left_join(df: DataFrame, other: DataFrame, on: Sequence[str], n: int, how: str = "left", most_bits: int = MOST_BITS) -> DataFrame:
    """A ``left`` or ``left_anti`` join on columns of one name, where only rows that may have a partner are shuffled."""
    if bits_for(n) > most_bits:
        return df.join(other, list(on), how)
    marked = with_maybe(df, other.select(*on), on, n, most_bits)
    met = marked.filter(MAYBE).drop(MAYBE).join(other, list(on), how)
    rest = marked.filter(f"not {MAYBE}").drop(MAYBE)
    if how == "left":
        added = [f for f in other.schema.fields if f.name not in on]
        rest = rest.withColumns({f.name: F.lit(None).cast(f.dataType) for f in added})
    return met.unionByName(rest)
