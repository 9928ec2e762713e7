"""Connected components of an edge table by alternating stars, without any vertex's edges meeting in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from placeweave.llm.store import store


def _forest(batches):
    """Edges of a partition, thinned to a forest that joins the same vertices."""
    import pyarrow as pa

    root: dict[int, int] = {}

    def find(x: int) -> int:
        top = x
        while root.setdefault(top, top) != top:
            top = root[top]
        while root[x] != top:
            root[x], x = top, root[x]
        return top

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            x, y = find(a), find(b)
            if x != y:
                root[max(x, y)] = min(x, y)
    pairs = [(v, find(v)) for v in list(root)]
    pairs = [p for p in pairs if p[0] != p[1]]
    yield pa.RecordBatch.from_arrays([pa.array([p[i] for p in pairs], pa.int64()) for i in (0, 1)], names=["a", "b"])


def _min_of(edges: DataFrame, key: str, other: str) -> DataFrame:
    """``edges`` with ``m``, the least of a vertex and its neighbours. The minima are written down: a hot key can be split."""
    least = edges.groupBy(key).agg(F.least(F.col(key), F.min(other)).alias("m"))
    return edges.join(store(least, "minima"), key)


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(id, component) for every id of ``edges`` (a, b longs): ``component`` is the least id that its links reach."""
    links = edges.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).filter("a <> b")
    links = store(links.mapInArrow(_forest, "a long, b long"), "forest")
    state = _state(links)
    while state[0]:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _min_of(both, "a", "b").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = store(large, "large")
        small = _min_of(large, "a", "b")
        pairs = F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))
        links = small.select(F.explode(pairs).alias("e")).select("e.a", "e.b").filter("a <> b").distinct()
        links = store(links, "links")
        before, state = state, _state(links)
        if before == state:
            break
    roots = links.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    return links.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(roots)
