"""Size checks in front of every broadcast hint, and keys that keep unmatched rows from piling up in one task."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..session import landed

# A broadcast side never exceeds this many rows nor bytes; beyond it the same join is shuffled.
MAX_BROADCAST_ROWS = 2_000_000
MAX_BROADCAST_BYTES = 64 << 20


@dataclass(frozen=True)
class BroadcastLimit:
    rows: int = MAX_BROADCAST_ROWS
    bytes: int = MAX_BROADCAST_BYTES

    def allows(self, rows: int, nbytes: int) -> bool:
        return rows <= self.rows and nbytes <= self.bytes

    def hint(self, df: DataFrame, rows: int, nbytes: int) -> DataFrame:
        """Mark ``df`` for broadcast when its measured size is within the limit, else leave it to the shuffle."""
        return F.broadcast(df) if self.allows(rows, nbytes) else df

    def joinable(self, df: DataFrame, rows: int, nbytes: int, name: str) -> DataFrame:
        """As :meth:`hint` for a side made by grouping: beyond the limit it is landed first, so hot keys can be split."""
        return F.broadcast(df) if self.allows(rows, nbytes) else landed(df, name)


NEVER = BroadcastLimit(rows=-1, bytes=-1)


_SPREAD = 65536


def row_salt(df: DataFrame) -> Column:
    """A repeatable number per row, from its plain columns, so a retried task gives the same one."""
    plain = [df[f.name] for f in df.schema if isinstance(f.dataType, T.AtomicType) and f.dataType.typeName() != "variant"]
    return F.pmod(F.xxhash64(*plain), F.lit(_SPREAD))


def spread_key(key: Column, usable: Column, salt: Column) -> Column:
    """``key`` where usable, else one of many values no cell or coordinate can take.

    A left join sends every null key to the same task; these keys match nothing either but fall everywhere.
    """
    return F.when(usable, key).otherwise(F.lit(-(2**62)) + salt)


def spread_coordinate(value: Column, usable: Column, salt: Column) -> Column:
    return F.when(usable, value.cast("double")).otherwise(F.lit(-1e200) * (salt + 1))
