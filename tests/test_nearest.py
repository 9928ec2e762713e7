import math
import random

import pytest
from pyspark.sql import functions as F

from placeweave.functions.geodesy import haversine_m, hk80_grid
from placeweave.operators.nearest import nearest_within
from placeweave.operators.sizing import NEVER
from placeweave.plans.sub_district import derive_sub_district

R = 1500.0


def brute(points, labels):
    out = {}
    for pid, x, y in points:
        best = None
        if x is not None and y is not None and not math.isnan(x):
            for o, lx, ly in labels:
                d = math.sqrt((lx - x) ** 2 + (ly - y) ** 2)
                if d <= R and (best is None or (d, o) < best):
                    best = (d, o)
        out[pid] = best
    return out


def run(spark, points, labels, **options):
    p = spark.createDataFrame(points, "id int, x double, y double")
    lab = spark.createDataFrame(labels, "ord int, px0 double, py0 double").withColumn("name", F.concat(F.lit("L"), "ord"))
    df = nearest_within(
        p, lab, R, point_xy=("x", "y"), label_xy=("px0", "py0"), order=["ord"], carry={"name": "name", "ord": "found"},
        distance_column="dist", **options,
    )
    return df


def check(spark, points, labels, **options):
    df = run(spark, points, labels, **options)
    got = df.collect()
    want = brute(points, labels)
    assert len(got) == len(points)
    for r in got:
        assert (None if r.found is None else (r.dist, r.found)) == want[r.id], r
        assert r.name == (None if r.found is None else f"L{r.found}")
    return df


def scattered(n, seed, size=20000, cell=1.0):
    rnd = random.Random(seed)
    return [(i, round(rnd.uniform(0, size) / cell) * cell, round(rnd.uniform(0, size) / cell) * cell) for i in range(n)]


def test_matches_brute_force(spark, limit):
    points = scattered(400, 1) + [(1000, None, 5.0), (1001, float("nan"), 5.0), (1002, -9e6, 0.0)]
    df = check(spark, points, scattered(60, 2), limit=limit)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan
    assert ("BroadcastHashJoin" in plan) == (limit is not NEVER)


def test_ties_copies_and_radius_edge(spark):
    labels = [(3, 100.0, 0.0), (1, 0.0, 100.0), (2, 0.0, 100.0), (0, 5000.0, 0.0)]
    points = [(0, 0.0, 0.0), (1, 3500.0, 0.0), (2, 3499.0, 0.0), (3, 0.0, 100.0)]
    check(spark, points, labels)


def test_crowded_cells_descend(spark, limit):
    """A third of the labels and points share one cell, one spot holds many copies, and a ring surrounds a lone point."""
    rnd = random.Random(5)
    hot = [(1000 + i, 300 + rnd.uniform(0, 60), 300 + rnd.uniform(0, 60)) for i in range(150)]
    ring = [(2000 + i, 9000 + 400 * math.cos(i / 10), 9000 + 400 * math.sin(i / 10)) for i in range(62)]
    copies = [(3000 + i, 5000.0, 5000.0) for i in range(100)]
    labels = scattered(150, 3) + hot + ring + copies
    points = scattered(150, 4) + [(5000 + i, 300 + rnd.uniform(-900, 1300), 300 + rnd.uniform(-900, 900)) for i in range(100)]
    points += [(6000 + i, 9000.0, 9000.0) for i in range(50)] + [(7000, 5001.0, 5000.0), (7001, None, None)]
    check(spark, points, labels, crowd=8, limit=limit)


def test_a_crowd_costs_cells_only_where_it_is(spark):
    """100,000 labels in one spot among a million sparse ones raise the number of leaves by less than one in a hundred."""
    from placeweave.operators.nearest import _directory

    sparse = spark.range(1_000_000).selectExpr("(id % 1000) * 1600D + 800D px", "floor(id / 1000) * 1600D + 800D py")
    dense = spark.range(100_000).selectExpr("400000D + pmod(xxhash64(id), 100000) / 1000 px", "400000D + pmod(hash(id), 100000) / 1000 py")

    def leaves(labels):
        levels, held = _directory(labels, R, 256)
        assert held.groupBy("k", "cx", "cy").count().selectExpr("max(count)").first()[0] <= 256
        assert held.count() == labels.count()
        return sum(cells.filter("not split").count() for cells, _ in levels)

    alone = leaves(sparse)
    assert alone <= leaves(sparse.unionByName(dense.distinct())) < 1.01 * alone


def test_labels_closer_than_any_even_grid(spark):
    """Crowds of very different densities: each is divided to its own depth."""
    rnd = random.Random(8)
    labels = [(i, 700 + rnd.random() * 1e-6, 700 + rnd.random() * 1e-6) for i in range(60)]
    labels += [(100 + i, 5000 + rnd.random(), 5000 + rnd.random()) for i in range(60)] + [(300, 9000.0, 9000.0)]
    points = [(i, 700 + rnd.random() * 2e-6, 700 + rnd.random() * 2e-6) for i in range(30)]
    points += [(50 + i, 5000 + 2 * rnd.random(), 5000 + 2 * rnd.random()) for i in range(30)] + [(99, 9500.0, 9500.0), (98, 1500.0, 1500.0)]
    check(spark, points, labels, crowd=4)


def test_no_labels(spark):
    got = run(spark, [(0, 1.0, 1.0)], []).collect()
    assert len(got) == 1 and got[0].name is None and got[0].dist is None


def test_radius_must_be_positive(spark):
    df = spark.range(1).selectExpr("double(id) x", "double(id) y", "id o")
    with pytest.raises(ValueError):
        nearest_within(df, df, 0, point_xy=("x", "y"), label_xy=("x", "y"), order=["o"], carry={}, distance_column="d")


PLACES = [(0, 22.5, 114.1, "上水", "Sheung Shui"), (1, 22.45, 114.17, "大埔", "Tai Po")]


def places(spark):
    return spark.createDataFrame(PLACES, "ord int, lat double, lon double, zh_name string, en_name string")


def test_nearest_locality_on_the_grid(spark):
    a = spark.createDataFrame([("p1", 22.499, 114.1), ("p2", 22.451, 114.171)], "id string, lat double, lon double")
    out = {r.id: r for r in derive_sub_district(a, places(spark), 5000, order=["ord"]).collect()}
    assert (out["p1"].sub_district_chi, out["p1"].sub_district_eng) == ("上水", "Sheung Shui")
    assert out["p2"].sub_district_eng == "Tai Po" and 100 < out["p2"].sub_district_dist_m < 200


def test_cap_and_village_fallback(spark):
    a = spark.createDataFrame(
        [("far", 22.2, 113.9, "錦田", "Kam Tin")], "id string, lat double, lon double, village_chi string, village_eng string"
    )
    r = derive_sub_district(a, places(spark), 1500, order=["ord"]).first()
    assert (r.sub_district_chi, r.sub_district_eng, r.sub_district_dist_m) == ("錦田", "Kam Tin", None)
    r = derive_sub_district(a, places(spark), 1500, prefer_village=False, order=["ord"]).first()
    assert r.sub_district_chi is None and r.sub_district_eng is None


def test_without_places_columns_exist(spark):
    r = derive_sub_district(spark.createDataFrame([("a", 22.5, 114.1)], "id string, lat double, lon double"), None).first()
    assert r.sub_district_chi is None and r.sub_district_dist_m is None


def test_projection_and_distance(spark):
    r = spark.range(1).select(
        hk80_grid(F.lit(22.5), F.lit(114.1)).alias("g"),
        hk80_grid(F.lit(22.501), F.lit(114.1)).alias("h"),
        haversine_m(F.lit(22.5), F.lit(114.1), F.lit(22.501), F.lit(114.1)).alias("d"),
    ).first()
    assert abs(r.g.easting - 828357.91) < 0.02 and abs(r.g.northing - 840044.93) < 0.02
    step = math.hypot(r.h.easting - r.g.easting, r.h.northing - r.g.northing)
    assert abs(step - r.d) < 1 and abs(r.d - 111.19) < 0.1


def test_rows_are_worked_out_once_when_labels_are_crowded(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def place(i):
        seen.add(1)
        return float(i)

    points = spark.range(0, 40, 1, 2).select("id", place("id").alias("x"), F.lit(0.0).alias("y"))
    labels = spark.range(0, 40, 1, 2).selectExpr("id AS ord", "id + 0.25D AS px", "0D AS py")
    names = {"point_xy": ("x", "y"), "label_xy": ("px", "py"), "order": ["ord"], "carry": {"ord": "near"}, "distance_column": "d"}
    found = nearest_within(points, labels, 10.0, **names, crowd=2).collect()
    assert sorted((r.id, r.near, r.d) for r in found) == [(i, i, 0.25) for i in range(40)]
    assert seen.value == 40
