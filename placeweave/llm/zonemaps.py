"""Centroid clustering over zone maps: vectors in Hilbert order, cut into blocks with a box of least and largest components.

Components become integers, so distances, sums and floors are exact and no order of adding changes a result. Vectors are
sorted along a Hilbert curve through their coordinates on a few principal axes and cut into blocks; a block keeps its box,
its sum and its vectors. In each round a block's box gives every centroid a least and a largest distance. Centroids whose
least distance is above another's largest, or that lose to the centroid nearest the box's middle at every corner, cannot be
nearest to any vector of the block. A block with one candidate left is assigned whole, from its stored sum; for the others
the vectors are compared with the candidates, all at once. Axes and curve come from a bounded sample of the vectors and
decide only which vectors share a block; every vector is compared exactly.

The vectors are written once; a round sends the centroids out and gets counts and sums of each cluster back, so what the
driver holds is bounded by the number of clusters times the width.

Results for edge cases: vectors that are null, of another width, or hold a null or non-finite component are left out.
Components beyond ``LARGEST`` in size count as ``LARGEST``, which keeps every distance within a long; sums of distances
that do not fit a long are null. Distances that tie go to the smaller number. Ids may be null (they hash like an empty id)
and may repeat: each row is a vector of its own, and rows of one id are ordered by their components where the first
centroids are drawn. Fewer vectors than clusters give fewer clusters; an empty table gives an empty result. Other columns
are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from placeweave.llm.store import Shared, release, store

#: 2 ** 27: the square of a difference of two such components, 64 times, is below 2 ** 63.
LARGEST = 1 << 27
#: Below this, products of components add up exactly in doubles.
EXACT_IN_DOUBLES = 1 << 22


@dataclass(frozen=True)
class Settings:
    clusters: int = 8
    rounds: int = 10
    width: int = 64
    scale: int = 1024
    #: Vectors that fit the axes and the cells of the curve; it decides who shares a block, never a result.
    sample: int = 4096
    axes: int = 8
    bits: int = 6
    block: int = 256


def integers(vectors: DataFrame, settings: Settings = Settings(), vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(id, cells): the usable vectors, each component x as floor(scale * x)."""

    def usable(x: Column) -> Column:
        x = x.cast("double")
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))

    def whole(x: Column) -> Column:
        inside = F.least(F.greatest(x.cast("double") * settings.scale, F.lit(-float(LARGEST))), F.lit(float(LARGEST)))
        return F.floor(inside).cast("int")

    kept = F.col(vector).isNotNull() & (F.size(vector) == settings.width) & F.forall(vector, usable)
    return vectors.filter(kept).select(F.col(vec_id).alias("id"), F.transform(vector, whole).alias("cells"))


def first_centroids(cells: DataFrame, settings: Settings, salt: str) -> list[list[int]]:
    """The vectors with the smallest SHA-256 of ``<salt>:<id>``, in that order; a top-k, never a sort of all rows."""
    name = F.sha2(F.concat(F.lit(f"{salt}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    rows = cells.select(name.alias("name"), "cells").orderBy("name", "cells").limit(settings.clusters).collect()
    return [list(r["cells"]) for r in rows]


# The curve


def hilbert(cells, bits: int):
    """Keys along a Hilbert curve of points with ``bits`` bits a coordinate (rows of ``cells``), as sortable bytes.

    The transposed form of the curve's index: coordinates are reflected and exchanged bit by bit, then Gray-coded.
    """
    import numpy as np

    x = np.ascontiguousarray(cells.T).astype(np.uint32)
    axes, zero = len(x), np.uint32(0)
    for bit in range(bits - 1, 0, -1):
        q, p = np.uint32(1 << bit), np.uint32((1 << bit) - 1)
        for i in range(axes):
            hit = (x[i] & q) != 0
            swap = np.where(hit, zero, (x[0] ^ x[i]) & p)
            x[0] ^= np.where(hit, p, swap)
            x[i] ^= swap
    for i in range(1, axes):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    for bit in range(bits - 1, 0, -1):
        flip ^= np.where((x[-1] & np.uint32(1 << bit)) != 0, np.uint32((1 << bit) - 1), zero)
    x ^= flip
    digits = [(x[i] >> np.uint32(bit)) & np.uint32(1) for bit in range(bits - 1, -1, -1) for i in range(axes)]
    return [row.tobytes() for row in np.packbits(np.stack(digits, axis=1).astype(np.uint8), axis=1)]


def _curve(cells: DataFrame, settings: Settings):
    """(axes, cuts) of a bounded sample: principal axes, and where each axis is cut into even shares."""
    import numpy as np

    draw = F.xxhash64("id", "cells")
    rows = cells.select("cells", draw.alias("draw")).orderBy("draw", "cells").limit(settings.sample).select("cells").collect()
    sample = np.array([r[0] for r in rows], np.float64).reshape(len(rows), settings.width)
    sample -= sample.mean(axis=0) if len(rows) else 0
    _, axes = np.linalg.eigh(sample.T @ sample)
    axes = axes[:, ::-1][:, : settings.axes]
    shares = np.arange(1, 1 << settings.bits) / (1 << settings.bits)
    spots = sample @ axes if len(rows) else np.zeros((1, settings.axes))
    return axes, np.quantile(spots, shares, axis=0)


def _matrix(column, width: int):
    """A list column of integers as a matrix."""
    import numpy as np

    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), width)


def blocks(cells: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(ids, n, low, high, total, cells): the vectors in blocks along the curve, written once.

    Equal keys are parted by a hash of the row, so copies of one vector spread over tasks like any others.
    """
    curve, bits, width, most = Shared(cells.sparkSession, _curve(cells, settings)), settings.bits, settings.width, settings.block

    @F.pandas_udf("binary")
    def key(values):
        import numpy as np
        import pandas as pd

        axes, cuts = curve.value
        spots = np.stack([np.asarray(v, np.float64) for v in values]) @ axes if len(values) else np.zeros((0, axes.shape[1]))
        at = np.stack([np.searchsorted(cuts[:, i], spots[:, i]) for i in range(spots.shape[1])], axis=1)
        return pd.Series(hilbert(at, bits), index=values.index, dtype=object)

    def cut(batches):
        import numpy as np
        import pyarrow as pa

        release()
        held: list = []

        def made(ids, rows):
            arrays = [
                pa.array([ids], pa.list_(pa.int64())),
                pa.array([len(ids)], pa.int64()),
                *(pa.array([v.tolist()], pa.list_(pa.int64())) for v in (rows.min(axis=0), rows.max(axis=0), rows.sum(axis=0))),
                pa.array([rows.astype("<i4").tobytes()], pa.binary()),
            ]
            return pa.RecordBatch.from_arrays(arrays, names=["ids", "n", "low", "high", "total", "cells"])

        ids, parts, size = [], [], 0
        for batch in batches:
            rows, names, at = _matrix(batch.column("cells"), width), batch.column("id").to_pylist(), 0
            while at < len(names):
                took = min(most - size, len(names) - at)
                ids += names[at : at + took]
                parts.append(rows[at : at + took])
                size, at = size + took, at + took
                if size == most:
                    yield made(ids, np.concatenate(parts))
                    ids, parts, size = [], [], 0
        if size:
            yield made(ids, np.concatenate(parts))

    spread = F.xxhash64("id", F.monotonically_increasing_id())
    keyed = cells.select(F.col("id").cast("long").alias("id"), "cells", key("cells").alias("key"), spread.alias("spread"))
    ordered = keyed.repartitionByRange("key", "spread").sortWithinPartitions("key", "spread").select("id", "cells")
    schema = "ids array<long>, n long, low array<long>, high array<long>, total array<long>, cells binary"
    return store(ordered.mapInArrow(cut, schema), "blocks")


# A round


def candidates(low, high, centroids):
    """Which centroids can be nearest to some vector of each box (boxes by rows); ties keep both."""
    import numpy as np

    gap = np.maximum(np.maximum(low[:, None] - centroids, centroids - high[:, None]), 0)
    reach = np.maximum(abs(low[:, None] - centroids), abs(high[:, None] - centroids))
    near, far = (gap * gap).sum(axis=2), (reach * reach).sum(axis=2)
    maybe = near <= far.min(axis=1, keepdims=True)
    # The centroid nearest the box's middle against each other one: who is farther at every corner is out.
    middle = (low + high) // 2
    pivot = np.argmin(((middle[:, None] - centroids) ** 2).sum(axis=2), axis=1)
    apart = centroids - centroids[pivot][:, None]
    most = np.maximum(low[:, None] * apart, high[:, None] * apart).sum(axis=2)
    norms = (centroids * centroids).sum(axis=1)
    return maybe & (2 * most + norms[pivot][:, None] - norms >= 0)


def nearest(rows, centroids):
    """(place in ``centroids``, squared distance) of the nearest centroid of each row; ties go to the first."""
    import numpy as np

    if max(abs(rows).max(initial=0), abs(centroids).max(initial=0)) < EXACT_IN_DOUBLES:
        x, c = rows.astype(np.float64), centroids.astype(np.float64)
        apart = ((x * x).sum(axis=1)[:, None] - 2 * (x @ c.T) + (c * c).sum(axis=1)).astype(np.int64)
    else:
        apart = np.stack([((rows - c) ** 2).sum(axis=1) for c in centroids], axis=1)
    best = apart.argmin(axis=1)
    return best, apart[np.arange(len(rows)), best]


def _boxes(batch, width: int):
    return _matrix(batch.column("low"), width), _matrix(batch.column("high"), width)


def _vectors(batch, i: int, width: int):
    import numpy as np

    return np.frombuffer(batch.column("cells")[i].as_buffer(), "<i4").reshape(-1, width).astype(np.int64)


#: Rows of a round's totals: component sums by place, then these.
COUNT, INERTIA, PAIRS, OPENED = -1, -2, -3, -4


def totals(made: DataFrame, centroids: list[list[int]], measure: bool = False) -> dict[tuple[int, int], int]:
    """{(cluster, place): sum} over all vectors assigned to ``centroids``; with ``measure`` the distances as well.

    A task adds up what it has and sends one row for each cluster and component.
    """
    width, wanted = len(centroids[0]), centroids

    def add(batches):
        from decimal import Decimal

        import numpy as np
        import pyarrow as pa

        release()
        c = np.array(wanted, np.int64)
        sums, counts, inertia = np.zeros(c.shape, np.int64), np.zeros(len(c), np.int64), [0] * len(c)
        pairs = np.zeros((2, len(c)), np.int64)
        for batch in batches:
            maybe = candidates(*_boxes(batch, width), c)
            whole = _matrix(batch.column("total"), width)
            sizes = batch.column("n").to_numpy()
            pairs[0] += maybe.T @ sizes
            for i, row in enumerate(maybe):
                chosen = np.flatnonzero(row)
                if len(chosen) == 1 and not measure:
                    sums[chosen[0]] += whole[i]
                    counts[chosen[0]] += sizes[i]
                    continue
                rows = _vectors(batch, i, width)
                pairs[1, 0] += len(rows)
                best, apart = nearest(rows, c[chosen])
                for at, cluster in enumerate(chosen):
                    mine = best == at
                    sums[cluster] += rows[mine].sum(axis=0)
                    counts[cluster] += int(mine.sum())
                    if measure:
                        inertia[cluster] += sum(apart[mine].tolist())
        every = [(k, place, int(sums[k, place])) for k in range(len(c)) for place in range(width)]
        every += [(k, what, int(v[k])) for what, v in ((COUNT, counts), (INERTIA, inertia), (PAIRS, pairs[0]), (OPENED, pairs[1])) for k in range(len(c))]
        clusters, places, values = zip(*every)
        kind = pa.decimal128(38, 0)
        arrays = [pa.array(clusters, pa.int32()), pa.array(places, pa.int32()), pa.array(map(Decimal, values), kind)]
        yield pa.RecordBatch.from_arrays(arrays, names=["cluster", "place", "value"])

    parts = made.mapInArrow(add, "cluster int, place int, value decimal(38,0)")
    rows = parts.groupBy("cluster", "place").agg(F.sum("value").alias("value")).collect()
    return {(r["cluster"], r["place"]): int(r["value"]) for r in rows}


def moved(centroids: list[list[int]], sums: dict[tuple[int, int], int]) -> list[list[int]]:
    """Each centroid as the floor of its vectors' mean; one without vectors stays."""
    out = []
    for k, old in enumerate(centroids):
        n = sums.get((k, COUNT), 0)
        out.append([sums[k, place] // n for place in range(len(old))] if n else old)
    return out


def assign(made: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """(id, cluster, distance) of every vector of the blocks."""
    width, wanted = len(centroids[0]), centroids

    def place(batches):
        import numpy as np
        import pyarrow as pa

        release()
        c = np.array(wanted, np.int64)
        for batch in batches:
            maybe = candidates(*_boxes(batch, width), c)
            for i, row in enumerate(maybe):
                chosen = np.flatnonzero(row)
                best, apart = nearest(_vectors(batch, i, width), c[chosen])
                arrays = [batch.column("ids")[i].values, pa.array(chosen[best].astype(np.int32)), pa.array(apart)]
                yield pa.RecordBatch.from_arrays(arrays, names=["id", "cluster", "distance"])

    return made.mapInArrow(place, "id long, cluster int, distance long")


@dataclass
class Clustering:
    blocks: DataFrame
    centroids: list[list[int]]
    #: Distances summed over each cluster, as whole numbers of any size.
    inertia: list[int]
    #: Share of (vector, centroid) pairs that the boxes leave in the last assignment, and of vectors read while moving.
    pairs_kept: float
    vectors_read: float

    def assigned(self) -> DataFrame:
        return assign(self.blocks, self.centroids)

    def digests(self) -> list[str]:
        return [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in self.centroids]


def cluster(cells: DataFrame, settings: Settings = Settings(), salt: str = "3") -> Clustering | None:
    """Rounds of assigning and moving over the vectors of ``integers``; None when there are none."""
    centroids = first_centroids(cells, settings, salt)
    if not centroids:
        return None
    made = blocks(cells, settings)
    read = seen = 0
    for _ in range(settings.rounds):
        sums = totals(made, centroids)
        read += sum(v for (_, what), v in sums.items() if what == OPENED)
        seen += sum(v for (_, what), v in sums.items() if what == COUNT)
        centroids = moved(centroids, sums)
    sums = totals(made, centroids, measure=True)
    n = sum(v for (_, what), v in sums.items() if what == COUNT)
    pairs = sum(v for (_, what), v in sums.items() if what == PAIRS)
    inertia = [sums.get((k, INERTIA), 0) for k in range(len(centroids))]
    return Clustering(made, centroids, inertia, pairs / (n * len(centroids)), read / max(1, seen))


def _long(value: int) -> int | None:
    return value if value < 1 << 63 else None


def clustered(vectors: DataFrame, settings: Settings = Settings(), vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every usable vector."""
    cells = integers(vectors, settings, vec_id, vector)
    done = cluster(cells, settings)
    if done is None:
        schema = f"{vec_id} long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
        return vectors.sparkSession.createDataFrame([], schema)

    def of_cluster(values: list, kind: str) -> Column:
        return F.get(F.array(*(F.lit(v).cast(kind) for v in values)), F.col("cluster"))

    return done.assigned().select(
        F.col("id").alias(vec_id),
        "cluster",
        "distance",
        of_cluster([_long(v) for v in done.inertia], "long").alias("cluster_inertia"),
        F.lit(_long(sum(done.inertia))).cast("long").alias("inertia"),
        of_cluster(done.digests(), "string").alias("centroid_sha256"),
    )
