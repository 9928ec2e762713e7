"""Embedding near-dedup by a dual traversal of cover trees: exact threshold pairs within a label, as links and components.

Unit vectors are at cosine ``c`` when they are sqrt(2 - 2c) apart, so near copies are pairs within a small distance.
Every label's distinct vectors are dealt into chunks of bounded size: along the leaves of an upper tree that was fitted on
a bounded sample of all vectors, leaves being packed or, when one alone is too large, split by hash. Each chunk gets a
cover tree of its own: nested levels with halving radii, each vector naming its centre at every level. Two chunks, and
then two nodes, are looked at together only if their centres are at most both covering radii and the threshold apart.

Equal vectors of a label are one point with a weight. Vectors that are null, zero, or hold null or non-finite components,
and those without a label, link with nothing. Repeated ids are points of their own that share a component.

Points have numbers of their own; ids only name components, by the least that is not null. A component without any id has
a null name, and all its rows are kept, as rows that repeat the id kept are. Vectors of different lengths never link. An
empty table gives an empty result, and columns beside the three named are not read, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from placeweave.llm.graph import components
from placeweave.llm.store import Shared, store

#: What products of unit vectors lose in double precision: pairs at the threshold itself must not fall below it.
ROUNDING = 1e-15


@dataclass(frozen=True)
class Settings:
    cosine: float = 0.98
    chunk: int = 4096
    #: Vectors the upper tree is fitted on, and its leaves' radius.
    sample: int = 2048
    leaf_radius: float = 0.5
    #: Levels halve their radius from the root's down to this one.
    least_radius: float = 0.05
    #: Nodes of at most so many points are compared whole.
    small: int = 64

    @property
    def reach(self) -> float:
        return (2 - 2 * self.cosine) ** 0.5 + 1e-7


def unit(vector: Column) -> Column:
    """A vector of length one in double precision, or null where there is none."""

    @F.arrow_udf("array<double>")
    def scaled(column):
        import numpy as np
        import pyarrow as pa

        ends, lists = np.asarray(column.offsets), column.values
        ends = ends - ends[0] if len(ends) else ends
        lists = column.flatten() if column.null_count == 0 else lists.slice(column.offsets[0].as_py(), int(ends[-1]))
        values = lists.cast(pa.float64()).fill_null(float("nan")).to_numpy(zero_copy_only=False).copy()
        sound = column.is_valid().to_numpy(zero_copy_only=False).copy()
        for i, (low, high) in enumerate(zip(ends, ends[1:])):
            row = values[low:high]
            top = np.abs(row).max() if high > low else 0.0
            if not sound[i] or not np.isfinite(top) or top == 0:
                sound[i] = False
                continue
            # Scaled by the largest component first, so that no square is lost or overflows.
            row /= top
            row /= np.sqrt(row @ row)
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values), mask=pa.array(~sound))

    return scaled(vector)


def net(points, radius: float):
    """Greedy centres more than ``radius`` apart that cover all unit vectors: each one's centre, by index, the first first."""
    import numpy as np

    owner, least = np.full(len(points), -1), 1 - radius * radius / 2
    for centre in range(len(points)):
        if owner[centre] < 0:
            near = (points @ points[centre] >= least) & (owner < 0)
            owner[near] = centre
            owner[centre] = centre
    return owner


def apart(points, centre):
    """Distances of unit vectors from one of them."""
    import numpy as np

    return np.sqrt(np.maximum(0, 2 - 2 * (points @ centre)))


def halved(points, owner, radius: float):
    """The next level: within each node a net of ``radius`` whose first centre is the node's own, so levels are nested."""
    import numpy as np

    out = np.empty(len(points), np.int64)
    order = np.argsort(owner, kind="stable")
    for inside in np.split(order, np.flatnonzero(np.diff(owner[order])) + 1) if len(order) else ():
        centre = owner[inside[0]]
        inside = np.concatenate([[centre], inside[inside != centre]])
        out[inside] = inside[net(points[inside], radius)] if len(inside) > 1 else centre
    return out


def levels(points, settings: Settings):
    """Each point's centre at every level, from the root (its first point) down: columns of indices."""
    import numpy as np

    out = [np.zeros(len(points), np.int64)]
    radius = float(apart(points, points[0]).max()) if len(points) else 0.0
    while radius > settings.least_radius and (out[-1] != np.arange(len(points))).any():
        radius /= 2
        out.append(halved(points, out[-1], radius))
    return np.stack(out, axis=1)


@dataclass
class Node:
    centre: int
    radius: float
    members: object
    kids: list


def build(points, paths) -> Node:
    """The tree that ``paths`` spell out, with exact covering radii."""
    import numpy as np

    def grow(centre: int, members, level: int) -> Node:
        radius = float(apart(points[members], points[centre]).max()) if len(members) > 1 else 0.0
        kids = []
        if len(members) > 1 and level + 1 < paths.shape[1]:
            below = paths[members, level + 1]
            order = np.argsort(below, kind="stable")
            cuts = np.flatnonzero(np.diff(below[order])) + 1
            kids = [grow(int(below[part[0]]), members[part], level + 1) for part in np.split(order, cuts)]
        return Node(centre, radius, members, kids)

    return grow(int(paths[0, 0]), np.arange(len(points)), 0)


def traverse(x, tree_x: Node, y, tree_y: Node, same: bool, settings: Settings, found) -> None:
    """Hand every block of points that may be near to ``found(members_x, members_y)``; with ``same``, each pair of nodes once."""
    import numpy as np

    stack = [(tree_x, tree_y)]
    while stack:
        a, b = stack.pop()
        wide_a, wide_b = len(a.members) > settings.small and a.kids, len(b.members) > settings.small and b.kids
        if not wide_a and not wide_b:
            found(a.members, b.members)
            continue
        left = a.kids if wide_a else [a]
        right = b.kids if wide_b else [b]
        if len(left) * len(right) > len(a.members) * len(b.members) // 4:
            # Nodes of about one point each: their bounds are the points' own distances.
            found(a.members, b.members)
            continue
        gaps = distances(x[[n.centre for n in left]], y[[n.centre for n in right]])
        bound = np.array([n.radius for n in left])[:, None] + np.array([n.radius for n in right]) + settings.reach
        near = gaps <= bound
        if same and a is b:
            near = np.triu(near)
        stack += [(left[i], right[j]) for i, j in zip(*np.nonzero(near), strict=True)]


def distances(x, y):
    import numpy as np

    return np.sqrt(np.maximum(0, 2 - 2 * (x @ y.T)))


def joined(hit):
    """For each row and column of a block of links, the least row linked with it directly or through others of the block."""
    import numpy as np

    n = len(hit)
    row = np.arange(n)
    while True:
        column = np.where(hit, row[:, None], n).min(axis=0)
        least = np.minimum(row, np.where(hit, column[None, :], n).min(axis=1))
        # What a row has learnt passes to the row that named it before, so chains shorten by leaps.
        np.minimum.at(least, row, least.copy())
        least = least[least]
        if (least == row).all():
            return row, column
        row = least


def near_pairs(x, paths_x, y, paths_y, weights_x, weights_y, ids_x, ids_y, same: bool, settings: Settings):
    """Links of two chunks: for each point the weight of those it links with, and a forest of its links (a, b)."""
    import numpy as np

    links_x, links_y, edges = np.zeros(len(x), np.int64), np.zeros(len(y), np.int64), []
    if same:
        links_y = links_x
    step = 1024

    def found(a, b):
        for low in range(0, len(a), step):
            rows = a[low : low + step]
            hit = x[rows] @ y[b].T >= settings.cosine - ROUNDING
            if same:
                # A pair of nodes is seen once; within one node, each pair of points once.
                hit &= rows[:, None] < b[None, :] if len(a) == len(b) and (a == b).all() else rows[:, None] != b[None, :]
            if not hit.any():
                continue
            np.add.at(links_x, rows, hit @ weights_y[b])
            np.add.at(links_y, b, weights_x[rows] @ hit)
            # Enough edges to keep what is connected connected: each row and column with one row of its component.
            row, column = joined(hit)
            i, j = np.flatnonzero(hit.any(axis=1)), np.flatnonzero(hit.any(axis=0))
            edges.append(np.stack([ids_x[rows[i]], ids_x[rows[row[i]]]], axis=1))
            edges.append(np.stack([ids_y[b[j]], ids_x[rows[column[j]]]], axis=1))

    tree = build(x, paths_x)
    traverse(x, tree, y, tree if same else build(y, paths_y), same, settings, found)
    return links_x, links_y, np.concatenate([*edges, np.zeros((0, 2), np.int64)])


def _matrix(column):
    import numpy as np

    return np.stack(column.to_list()) if len(column) else np.zeros((0, 1))


def points_of(vectors: DataFrame, vec_id: str, embedding: str, label: str) -> DataFrame:
    """(label, v, id, weight, width, point): distinct usable vectors, their least id if any has one, and a number of their own.

    Numbers hold for one evaluation only: store the result before it is used.
    """
    rows = vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(label).alias("label"), unit(F.col(embedding)).alias("v"))
    usable = rows.filter(F.col("label").isNotNull() & F.col("v").isNotNull())
    width = F.size("v")
    distinct = usable.groupBy("label", "v").agg(F.min("id").alias("id"), F.count("*").alias("weight"))
    return distinct.withColumn("width", width).withColumn("point", F.monotonically_increasing_id())


def upper_tree(points: DataFrame, settings: Settings):
    """Centres of the upper tree's leaves in the order of its branches, for vectors of the commonest width."""
    import numpy as np

    rows = points.orderBy(F.xxhash64("v"), "v").limit(settings.sample).select("v").toArrow()
    sample = rows.column("v").to_pylist()
    if not sample:
        return np.zeros((0, 1))
    width = max({len(v) for v in sample}, key=[len(v) for v in sample].count)
    matrix = np.array([v for v in sample if len(v) == width])
    path, radius = [np.zeros(len(matrix), np.int64)], 2.0
    while radius > settings.leaf_radius:
        radius /= 2
        path.append(halved(matrix, path[-1], radius))
    order = np.lexsort(path[::-1])
    _, first = np.unique(path[-1][order], return_index=True)
    return matrix[path[-1][order][np.sort(first)]]


def chunked(points: DataFrame, settings: Settings) -> DataFrame:
    """``points`` with a chunk number; a label's chunks hold neighbours of the upper tree, at most ``chunk`` points or so."""
    shared = Shared(points.sparkSession, upper_tree(points, settings))

    @F.arrow_udf("int")
    def leaf(column):
        import numpy as np
        import pyarrow as pa

        centres, out = shared.value, []
        rows = column.to_pylist()
        for low in range(0, len(rows), 512):
            part = rows[low : low + 512]
            fits = [i for i, v in enumerate(part) if len(v) == centres.shape[1]] if len(centres) else []
            nearest = np.zeros(len(part), np.int32)
            if fits:
                nearest[fits] = (np.array([part[i] for i in fits]) @ centres.T).argmax(axis=1)
            out.append(nearest)
        return pa.array(np.concatenate(out) if out else np.zeros(0, np.int32), pa.int32())

    placed = store(points.withColumn("leaf", leaf("v")), "placed")
    key = ["label", "width"]
    cells = placed.groupBy(*key, "leaf").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy(*key).orderBy("leaf").rowsBetween(Window.unboundedPreceding, -1))
    first = F.floor(F.coalesce(before, F.lit(0)) / settings.chunk).cast("int")
    cells = cells.select(*key, "leaf", first.alias("first"), F.ceil(F.col("n") / settings.chunk).cast("int").alias("parts"))
    rows = placed.join(store(cells, "cells"), [*key, "leaf"])
    # A leaf too large for a chunk is split by hash; such parts are chunks of their own.
    part = F.when(F.col("parts") > 1, F.struct("leaf", F.pmod(F.xxhash64("v"), F.col("parts")).cast("int").alias("part")))
    chunk = F.xxhash64("first", F.coalesce(part["leaf"], F.lit(-1)), F.coalesce(part["part"], F.lit(-1)))
    return rows.select(*key, chunk.alias("chunk"), "point", "weight", "v")


def with_paths(chunks: DataFrame, settings: Settings) -> DataFrame:
    """Points with their place in their chunk's cover tree: ``at`` (0 is the root's centre), ``path`` and the chunk's radius."""

    def grow(frame):
        import numpy as np

        frame = frame.sort_values("point", kind="stable", ignore_index=True)
        points = _matrix(frame["v"])
        paths = levels(points, settings)
        frame["at"] = np.arange(len(points), dtype=np.int32)
        frame["path"] = list(paths.astype(np.int32))
        frame["radius"] = float(apart(points, points[0]).max())
        return frame

    label = chunks.schema["label"].dataType.simpleString()
    schema = f"label {label}, width int, chunk long, point long, weight long, v array<double>, at int, path array<int>, radius double"
    return chunks.groupBy("label", "width", "chunk").applyInPandas(grow, schema)


def links_of(trees: DataFrame, settings: Settings) -> DataFrame:
    """(point, links, a, b): weights of links found, and edges that join what is linked, from every pair of chunks in reach."""
    roots = trees.filter("at = 0").select("label", "width", "chunk", "v", "radius")
    roots = store(roots, "roots")
    other = roots.select("label", "width", F.col("chunk").alias("chunk_b"), F.col("v").alias("v_b"), F.col("radius").alias("radius_b"))
    dot = F.aggregate(F.zip_with("v", "v_b", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    gap = F.sqrt(F.greatest(F.lit(0.0), 2 - 2 * dot))
    near = (F.col("chunk") <= F.col("chunk_b")) & (gap <= F.col("radius") + F.col("radius_b") + settings.reach)
    pairs = roots.join(other, ["label", "width"]).filter(near).select("label", "width", "chunk", "chunk_b")
    pairs = store(pairs.withColumn("pair", F.xxhash64("label", "width", "chunk", "chunk_b")), "pairs")
    sides = F.array(F.struct(F.col("chunk").alias("c"), F.lit(0).alias("side")), F.struct(F.col("chunk_b").alias("c"), F.lit(1).alias("side")))
    wanted = pairs.select("label", "width", "pair", (F.col("chunk") == F.col("chunk_b")).alias("same"), F.explode(sides).alias("s"))
    wanted = wanted.select("label", "width", "pair", "same", F.col("s.c").alias("chunk"), F.col("s.side").alias("side")).filter("not (same and side = 1)")
    work = trees.join(store(wanted, "wanted"), ["label", "width", "chunk"]).select("pair", "same", "side", "at", "point", "weight", "v", "path")

    def compare(frame):
        import numpy as np
        import pandas as pd

        same = bool(frame["same"].iloc[0])
        sides = [frame[frame["side"] == k].sort_values("at") for k in (0, 0 if same else 1)]
        (x, y), (px, py) = ([_matrix(s[c]) for s in sides] for c in ("v", "path"))
        (wx, wy), (ix, iy) = ([s[c].to_numpy(np.int64) for s in sides] for c in ("weight", "point"))
        lx, ly, edges = near_pairs(x, px, y, py, wx, wy, ix, iy, same, settings)
        # Nullable from the start: beside missing values plain numbers would become doubles.
        out = [pd.DataFrame({"point": ix, "links": lx}, dtype="Int64")]
        if not same:
            out.append(pd.DataFrame({"point": iy, "links": ly}, dtype="Int64"))
        out.append(pd.DataFrame({"a": edges[:, 0], "b": edges[:, 1]}, dtype="Int64"))
        got = pd.concat(out, ignore_index=True).reindex(columns=["point", "links", "a", "b"]).astype("Int64")
        return got[(got["links"].fillna(1) > 0)]

    return store(work.groupBy("pair").applyInPandas(compare, "point long, links long, a long, b long"), "found")


def near_copies(vectors: DataFrame, settings: Settings = Settings(), vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label") -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vectors``."""
    points = store(points_of(vectors, vec_id, embedding, label), "points")
    found = links_of(store(with_paths(chunked(points, settings), settings), "trees"), settings)
    counts = found.filter("point is not null").groupBy("point").agg(F.sum("links").alias("others"))
    names = store(components(found.filter("a is not null").select("a", "b").distinct()), "components")
    named = points.join(counts, "point", "left").join(names.withColumnRenamed("id", "point"), "point", "left")
    links = (F.coalesce("others", F.lit(0)) + F.col("weight") - 1).alias("links")
    named = store(named.select("label", "v", "id", links, F.coalesce("component", "point").alias("root")), "named")
    least = store(named.groupBy("root").agg(F.min("id").alias("component")), "least")
    facts = named.join(least, "root").select("label", "v", "links", "component")
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).alias("label"), unit(F.col(embedding)).alias("v"))
    joined = rows.join(store(facts, "facts"), ["label", "v"], "left")
    component = F.coalesce("component", "vec_id")
    kept = F.col("vec_id").eqNullSafe(component)
    return joined.select("vec_id", F.coalesce("links", F.lit(0)).alias("n_links"), component.alias("component_id"), kept.alias("kept"))
