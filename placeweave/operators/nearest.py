"""Nearest labelled point within a radius, as equi-joins on grid cells.

The plan follows what one small aggregate over the labels says:

* No cell is crowded (the usual case): every label is copied to the lookup cells within the radius, each cell keeps the
  labels that are nearest to at least some spot in it as one bounded array, and each row looks up its own cell once.
  Broadcast when measured small, else one shuffle on the cell.
* Some cell is crowded: a directory of cells is built in which only crowded cells are divided, by four per side, and
  those of their parts that are still crowded again. Rows then descend from the cells around them, opening divided cells
  only and keeping only the cells that can still hold the nearest label (closest corner no farther than another cell's
  farthest corner). A crowd in one place therefore costs cells there and nowhere else, no task ever holds more than
  ``crowd`` labels of a cell, and the result is still exact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import ensure_checkpoint_dir, landed
from .sizing import BroadcastLimit, row_salt, spread_coordinate, spread_key

CROWD = 256
SPLIT = 4
# By then cells are narrower than doubles of a coordinate's size are apart, so no cell is crowded any more.
MAX_DEPTH = 26

# Lookup cells per radius: smaller cells hold fewer candidates but copy each label (2 * 2 + 1) ** 2 times.
LOOKUP_SPLIT = 2
LOOKUP_COPIES = (2 * LOOKUP_SPLIT + 1) ** 2


def _cell(value: Column, side: float) -> Column:
    return F.floor(value / F.lit(side)).cast("bigint")


def _around(cell: Column, reach: int = 1) -> Column:
    return F.explode(F.sequence(cell - reach, cell + reach))


def _usable(x: str, y: str) -> Column:
    """Both coordinates are finite; each is read once, which matters when it stands for a projection."""
    return F.coalesce(F.abs(F.col(x)) + F.abs(F.col(y)) < F.lit(float("inf")), F.lit(False))


def _placed(labels: DataFrame, x: str, y: str, order: Sequence[str], carry: Sequence[str]) -> DataFrame:
    """(px, py, label) of the labels with usable coordinates."""
    label = F.struct(*[F.col(c) for c in dict.fromkeys([*order, *carry])])
    return labels.filter(_usable(x, y)).select(
        F.col(x).cast("double").alias("px"), F.col(y).cast("double").alias("py"), label.alias("label")
    )


def _unique(placed: DataFrame, order: Sequence[str]) -> DataFrame:
    """One label per exact position, the first by ``order``, then by the label: the other copies can never win a tie."""
    first = F.min_by("label", F.struct(*[F.col(f"label.{c}") for c in order], F.col("label")))
    return placed.groupBy("px", "py").agg(first.alias("label"))


def _crowding(labels: DataFrame, radius: float) -> tuple[int, int, int]:
    """(labels, the fullest cell, bytes of the carried columns). One pass, partial counts before the shuffle."""
    cells = (_cell(F.col(c), radius).alias(a) for c, a in (("px", "cx"), ("py", "cy")))
    counts = labels.groupBy(*cells).agg(F.count("*").alias("n"), F.sum(F.length(F.to_json("label"))).alias("bytes"))
    row = counts.agg(F.sum("n"), F.max("n"), F.sum("bytes")).first()
    return row[0] or 0, row[1] or 0, row[2] or 0


def _best(x: Column, y: Column, candidates: Column, radius: float, order: Sequence[str]) -> Column:
    """Least (distance, order) candidate within the radius."""

    def measured(p: Column) -> Column:
        dx, dy = p["px"] - x, p["py"] - y
        return F.struct(
            F.sqrt(dx * dx + dy * dy).alias("dist"),
            F.struct(*[p["label"][c].alias(c) for c in order]).alias("ord"),
            p["label"].alias("label"),
        )

    return F.array_min(F.filter(F.transform(candidates, measured), lambda c: c["dist"] <= radius))


def nearest_within(
    points: DataFrame,
    labels: DataFrame,
    radius: float,
    *,
    point_xy: tuple[str, str],
    label_xy: tuple[str, str],
    order: Sequence[str],
    carry: dict[str, str],
    distance_column: str,
    limit: BroadcastLimit = BroadcastLimit(),
    crowd: int = CROWD,
) -> DataFrame:
    """Left join every row of ``points`` to its nearest label within ``radius`` (inclusive).

    Ties go to the first label by ``order``, then by the carried columns. ``carry`` maps label columns to output names. Rows without usable
    coordinates or without a label in range get nulls.
    """
    if radius <= 0:
        raise ValueError("radius must be positive")
    x, y = point_xy
    placed = _unique(_placed(labels, *label_xy, order, list(carry)), order)
    n, fullest, nbytes = _crowding(placed, radius)
    label_type = placed.schema["label"].dataType

    def outputs(best: Column) -> dict[str, Column]:
        out = {new: best["label"][old] for old, new in carry.items()}
        return {**out, distance_column: best["dist"]}

    if not n:
        nulls = {new: F.lit(None).cast(label_type[old].dataType) for old, new in carry.items()}
        return points.withColumns({**nulls, distance_column: F.lit(None).cast("double")})

    if fullest <= crowd:
        # Before pruning a cell holds at most the labels of the crowd-checked cells around it.
        blocks = _blocks(placed, radius)
        blocks = limit.joinable(blocks, LOOKUP_COPIES * n, LOOKUP_COPIES * (nbytes + 48 * n), "blocks")
        side, usable, salt = radius / LOOKUP_SPLIT, _usable(x, y), row_salt(points)
        cells = {a: spread_key(_cell(F.col(c), side), usable, salt) for a, c in (("_cx", x), ("_cy", y))}
        joined = points.withColumns(cells).join(blocks, ["_cx", "_cy"], "left")
        best = _best(F.col(x), F.col(y), F.col("_block"), radius, order)
        return joined.withColumn("_best", best).withColumns(outputs(F.col("_best"))).select(
            *points.columns, *carry.values(), distance_column
        )

    if "void" not in points.schema.simpleString():
        # Read twice from here on: whatever the rows are made of is worked out once.
        points = landed(points, "points")
    found = _descend(points.filter(_usable(x, y)), placed, radius, x, y, order, limit, crowd, nbytes)
    usable, salt = _usable(x, y), row_salt(points)
    keys = {a: spread_coordinate(F.col(c), usable, salt) for a, c in (("_x", x), ("_y", y))}
    joined = points.withColumns(keys).join(landed(found, "nearest"), ["_x", "_y"], "left")
    return joined.withColumns(outputs(F.col("_best"))).select(*points.columns, *carry.values(), distance_column)


def _blocks(placed: DataFrame, radius: float) -> DataFrame:
    """Lookup cell -> the labels that can be the nearest one within the radius for some spot of the cell."""
    side = radius / LOOKUP_SPLIT
    cells = placed.withColumn("_cx", _around(_cell(F.col("px"), side), LOOKUP_SPLIT)).withColumn(
        "_cy", _around(_cell(F.col("py"), side), LOOKUP_SPLIT)
    )
    blocks = cells.groupBy("_cx", "_cy").agg(F.collect_list(F.struct("px", "py", "label")).alias("_block"))

    def distance(p: Column, far: bool) -> Column:
        return _cell_distance(p["px"], p["py"], F.col("_cx"), F.col("_cy"), side, far)

    def prune(v: Column) -> Column:
        return F.filter(v["block"], lambda p: distance(p, False) <= v["reach"])

    reach = F.least(F.array_min(F.transform("_block", lambda p: distance(p, True))), F.lit(float(radius) * (1 + 1e-9)))
    # The one-element array names the reach, so it is worked out once per cell and not once per label.
    pruned = F.get(F.transform(F.array(F.struct(F.col("_block").alias("block"), reach.alias("reach"))), prune), F.lit(0))
    return blocks.select("_cx", "_cy", pruned.alias("_block"))


def _box_distance(v: Column, c: Column, side: float | Column, far: bool) -> Column:
    """Least or greatest distance along one axis from ``v`` to the cell's interval, widened for rounding."""
    side = F.lit(side) if isinstance(side, float) else side
    lo, hi = c * side - 1e-6 * side, (c + 1) * side + 1e-6 * side
    if far:
        return F.greatest(F.abs(v - lo), F.abs(v - hi))
    return F.greatest(lo - v, v - hi, F.lit(0.0))


def _cell_distance(x: Column, y: Column, cx: Column, cy: Column, side: float | Column, far: bool) -> Column:
    dx, dy = _box_distance(x, cx, side, far), _box_distance(y, cy, side, far)
    return F.sqrt(dx * dx + dy * dy)


NODE = ["k", "cx", "cy"]


def _directory(unique: DataFrame, radius: float, crowd: int) -> tuple[list[tuple[DataFrame, int]], DataFrame]:
    """([(cells of a depth with ``split``, how many)], labels with the cell that holds them).

    A cell is named by its depth and place. Each round goes over the labels of crowded cells only.
    """
    levels, held, rest = [], [], unique
    for k in range(MAX_DEPTH + 1):
        side = radius / SPLIT**k
        placed = rest.select("*", F.lit(k).alias("k"), _cell(F.col("px"), side).alias("cx"), _cell(F.col("py"), side).alias("cy"))
        split = (F.count("*") > crowd) & F.lit(k < MAX_DEPTH)
        cells = landed(placed.groupBy(*NODE).agg(split.alias("split")), "cells")
        levels.append((cells, cells.count()))
        crowded = cells.filter("split").select(NODE)
        if crowded.isEmpty():
            held.append(placed)
            break
        held.append(placed.join(crowded, NODE, "left_anti"))
        rest = landed(placed.join(crowded, NODE, "left_semi").select(unique.columns), "crowded")
    labels = held[0]
    for more in held[1:]:
        labels = labels.unionByName(more)
    return levels, labels


def _descend(
    points: DataFrame, unique: DataFrame, radius: float, x: str, y: str, order: Sequence[str], limit: BroadcastLimit, crowd: int, nbytes: int
) -> DataFrame:
    ensure_checkpoint_dir(points.sparkSession)
    unique = landed(unique, "labels")
    levels, labels = _directory(unique, radius, crowd)

    # Distinct positions only: copies of a row cost one search.
    sought = points.select(F.col(x).alias("_x"), F.col(y).alias("_y")).distinct()
    top, n = levels[0]
    start = top
    for c in ("cx", "cy"):
        start = start.withColumn(f"h{c}", _around(F.col(c)))
    homes = sought.withColumns({"hcx": _cell(F.col("_x"), radius), "hcy": _cell(F.col("_y"), radius)})
    frontier = homes.join(limit.hint(start, 9 * n, 9 * 56 * n), ["hcx", "hcy"]).select("_x", "_y", *NODE, "split")

    side = F.lit(float(radius)) / F.pow(F.lit(float(SPLIT)), F.col("k"))
    at = [F.col(c) for c in ("_x", "_y", "cx", "cy")]
    near, far = (_cell_distance(*at, side, f) for f in (False, True))
    reach = F.min(far).over(Window.partitionBy("_x", "_y"))
    for cells, n in levels[1:]:
        parents = {c: F.floor(F.col(f"n{c}") / SPLIT).cast("bigint") for c in ("cx", "cy")}
        children = cells.select(F.col("k").alias("nk"), F.col("cx").alias("ncx"), F.col("cy").alias("ncy"), F.col("split").alias("nsplit"))
        children = children.withColumns({**parents, "k": F.col("nk") - 1})
        opened = frontier.filter("split").join(limit.hint(children, n, 72 * n), NODE)
        opened = opened.select("_x", "_y", F.col("nk").alias("k"), F.col("ncx").alias("cx"), F.col("ncy").alias("cy"), F.col("nsplit").alias("split"))
        step = frontier.filter("not split").unionByName(opened).select("*", near.alias("_near"), reach.alias("_reach"))
        kept = step.filter(F.col("_near") <= F.least("_reach", F.lit(float(radius) * (1 + 1e-9))))
        frontier = kept.select("_x", "_y", *NODE, "split").checkpoint()

    leaves = labels.groupBy(*NODE).agg(F.collect_list(F.struct("px", "py", "label")).alias("_block"))
    total = unique.count()
    leaves = limit.joinable(leaves, total, nbytes + 48 * total, "leaves")
    best = _best(F.col("_x"), F.col("_y"), F.col("_block"), radius, order)
    return (
        frontier.join(leaves, NODE)
        .select("_x", "_y", best.alias("_best"))
        .filter(F.col("_best").isNotNull())
        .groupBy("_x", "_y")
        .agg(F.min("_best").alias("_best"))
    )
