"""Delimited text whose quoted fields may hold line breaks, read by as many tasks as the files have blocks.

Quotes inside quoted fields are doubled, so a line break ends a record where the number of quotes before it is even. A
first pass counts, for every block, the lines with an odd number of quotes; summed in block order these say whether a block
begins inside a field and in which block the record open there began. The second pass joins lines to records; records that
cross blocks are put together from their parts. Each record is then parsed by itself.

The first record of every file is its header and is left out; empty lines are no records; a carriage return before a line
break belongs to the break. A quote that never closes makes the rest of its file one record, as it does in a whole read.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from ..operators.sizing import BroadcastLimit
from ..session import landed
from .blocks import STATE_BYTES

# The functions below travel with the job, so executors need no copy of this module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: The place of a header, and of a record that crosses its block's end.
HEADER, CROSSING = -1, 1 << 61
PIECES = "path string, block long, pos long, opener long, part boolean, record string"


def _lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(path, block, pos, value); ``(path, block, pos)`` sorts like the file."""
    text = spark.read.option("lineSep", "\n").text(paths)
    block = F.col("_metadata.file_block_start").alias("block")
    return text.select(F.col("_metadata.file_path").alias("path"), block, F.monotonically_increasing_id().alias("pos"), "value")


def block_states(lines: DataFrame) -> DataFrame:
    """(path, block, inside, opener): whether a block begins inside a record, and in which block that one begins."""
    odd = (F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))) % 2
    counts = landed(lines.groupBy("path", "block").agg(F.sum(odd).alias("odd")), "quote-counts")
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2 == 1
    # A block with such a line, left inside a record, holds that record's beginning.
    opener = F.last(F.when(F.col("odd") > 0, F.col("block")), ignorenulls=True).over(before)
    return counts.select("path", "block", inside.alias("inside"), F.when(inside, opener).alias("opener"))


def _records(batches):
    """Lines with the state of their block to records, and to the parts of those that cross a block's ends."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    names = [field.split()[0] for field in PIECES.split(", ")]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.string()]
    key, opener, held, pos, out = None, None, None, 0, []

    def say(lines, ended: bool):
        """A record or part of one; ``opener`` is set while the record began in an earlier block."""
        nonlocal pos, opener
        crosses = opener is not None or not ended
        place = HEADER if pos == 0 and key[1] == 0 else CROSSING if crosses else pos
        out.append((*key, place, (key[1] if opener is None else opener) if crosses else None, crosses, "\n".join(lines)))
        pos, opener = pos + 1, None

    def batch_of():
        made = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)
        out.clear()
        return made

    for batch in batches:
        paths, blocks = batch.column("path").to_pylist(), batch.column("block").to_pylist()
        odd = pc.count_substring(batch.column("value"), '"').to_numpy(zero_copy_only=False) % 2
        values = batch.column("value").to_pylist()
        turns = [0, *(i for i in range(1, len(paths)) if blocks[i] != blocks[i - 1] or paths[i] != paths[i - 1]), len(paths)]
        for a, b in zip(turns, turns[1:]):
            if b == a:
                continue
            if (paths[a], blocks[a]) != key:
                if held is not None:
                    say(held, False)
                inside, opened = batch.column("inside")[a].as_py(), batch.column("opener")[a].as_py()
                key, opener, held, pos = (paths[a], blocks[a]), opened if inside else None, [] if inside else None, 0
            open_after = (np.cumsum(odd[a:b]) + (held is not None)) % 2 == 1
            for value, goes_on in zip(values[a:b], open_after.tolist()):
                if held is None and not goes_on:
                    if value.strip("\r"):
                        say([value], True)
                    continue
                held = held or []
                held.append(value)
                if not goes_on:
                    say(held, True)
                    held = None
        if out:
            yield batch_of()
    if held is not None:
        say(held, False)
    if out:
        yield batch_of()


def read_records(spark: SparkSession, paths: str | Sequence[str], limit: BroadcastLimit = BroadcastLimit()) -> DataFrame:
    """(path, block, pos, record) of every record after the header; the columns but the last sort like the files."""
    lines = _lines(spark, paths)
    states = landed(block_states(lines), "block-states")
    n = states.count()
    near = lines.join(limit.hint(states, n, n * STATE_BYTES), ["path", "block"])
    if not limit.allows(n, n * STATE_BYTES):
        near = near.repartition("path", "block").sortWithinPartitions("path", "block", "pos")
    pieces = near.select("path", "block", "value", "inside", "opener").mapInArrow(_records, PIECES)
    whole = pieces.filter("not part").select("path", "block", "pos", "record")
    texts = F.array_sort(F.collect_list(F.struct("block", "record")))
    parts = pieces.filter("part").groupBy("path", "opener").agg(F.min("pos").alias("pos"), texts.alias("texts"))
    across = parts.select("path", F.col("opener").alias("block"), "pos", F.array_join("texts.record", "\n").alias("record"))
    records = whole.unionByName(across).filter(F.col("pos") != HEADER)
    return records.withColumn("record", F.regexp_replace("record", r"\r\z", ""))


def read_quoted_csv(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType, limit: BroadcastLimit = BroadcastLimit()) -> DataFrame:
    """The rows of delimited files with a header, columns by position."""
    records = read_records(spark, paths, limit)
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    parsed = F.from_csv("record", ddl, {"escape": '"', "multiLine": "true"})
    return records.select(parsed.alias("row")).select("row.*")
