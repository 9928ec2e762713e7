"""Given tables, intermediate tables in the shared folder, and keys that may be null."""

from __future__ import annotations

import gc
import pickle

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from placeweave.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Spark's own setting: an execution's shuffle files go when it ends, not when the driver happens to collect its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below ``spark.checkpoint.dir`` and read it back: computed once, kept when executors are lost.

    The copy that is read carries no partitioning, so a join on it shuffles both sides and Spark can split a hot key.
    What was shuffled for the copy is removed once it is written.
    """
    spark = df.sparkSession
    path, before = scratch_path(spark, name), spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Remove stored tables once what was made of them is written."""
    for df in tables:
        spark = df.sparkSession
        for folder in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
            place = spark._jvm.org.apache.hadoop.fs.Path(folder)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def text_of(col: str | Column) -> Column:
    """A text column with null read as empty."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Let at most so many rows and bytes go to Python at once: texts are long, and a task's share of memory is not."""
    if int(spark.conf.get(BATCH)) > rows or int(spark.conf.get(BATCH)) <= 0:
        spark.conf.set(BATCH, str(rows))
    spark.conf.set(BATCH_BYTES, str(4 << 20))


def release() -> None:
    """Free what earlier tasks of a reused Python worker left: their functions hold each other, so only a collection does.

    What is free then goes back to the system, so that a worker holds what its task needs and not the most that any needed.
    """
    import ctypes

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def freed(rows):
    """``rows`` for ``mapInArrow``, with what a task needed given back when it ends: a worker without a task is kept, and stays
    as large as it is then while tasks without Python fill the executor."""

    def run(batches):
        release()
        yield from rows(batches)
        release()

    return run


class Shared:
    """A broadcast of any object of bounded size; classes travel with it, and a task opens it once."""

    def __init__(self, spark: SparkSession, value):
        small_batches(spark)
        self.held, self.opened = spark.sparkContext.broadcast(cloudpickle.dumps(value)), []

    def __getstate__(self):
        return {"held": self.held, "opened": []}

    @property
    def value(self):
        if not self.opened:
            release()
            self.opened.append(pickle.loads(self.held.value))
        return self.opened[0]


class Kept(Shared):
    """As :class:`Shared`, opened once a worker: it stays with the broadcast until the worker is given work without it, so all
    functions of a stage and all its tasks use one copy, and whatever that has learnt."""

    @property
    def value(self):
        here = vars(self.held)
        if "opened" not in here:
            release()
            here["opened"] = pickle.loads(self.held.value)
        return here["opened"]
