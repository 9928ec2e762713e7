"""The first row of every key, with whole rows shuffled and with narrow ones."""

import random

import pytest

from placeweave.operators import dedup
from placeweave.operators.sizing import NEVER, BroadcastLimit
from placeweave.session import landed

SCHEMA = "k string, path string, block long, pos long, wide string, v int"


def rows(n, wide=3):
    rnd = random.Random(n)
    keys = [None, "", "hot", *(f"k{i}" for i in range(n // 3))]
    places = [(f"f{f}", b * 1000, b * 2**33 + i) for f in range(3) for b in range(4) for i in range(n // 12)]
    rnd.shuffle(places)
    return [("hot" if rnd.random() < 0.4 else rnd.choice(keys), *p, "x" * wide, rnd.randint(0, 9)) for p in places]


@pytest.mark.parametrize("limit", [BroadcastLimit(), NEVER], ids=["broadcast", "shuffle"])
def test_narrow_dedup_equals_the_plain_one(spark, limit):
    df = landed(spark.createDataFrame(rows(600), SCHEMA).repartition(5), "rows")
    order = ["path", "block", "pos"]
    want = sorted(map(str, dedup.first_wins(df, "k", order).collect()))
    got = dedup.first_wins_late(df, "k", order, limit)
    assert got.columns == dedup.first_wins(df, "k", order).columns and sorted(map(str, got.collect())) == want
    alone = df.dropDuplicates(["pos"])
    assert sorted(map(str, dedup.first_wins_late(alone, "k", ["pos"], limit).collect())) == sorted(map(str, dedup.first_wins(alone, "k", ["pos"]).collect()))
    assert dedup.first_wins_late(df.limit(0), "k", order, limit).count() == 0


def test_keys_that_share_a_digest_go_the_other_way(spark, monkeypatch):
    df = landed(spark.createDataFrame(rows(120), SCHEMA), "rows")
    want = sorted(map(str, dedup.first_wins(df, "k", ["path", "block", "pos"]).collect()))
    real = dedup.F.xxhash64
    monkeypatch.setattr(dedup.F, "xxhash64", lambda salt, *c: dedup.F.lit(1).cast("long") if "2" not in str(salt) else real(salt, *c))
    assert sorted(map(str, dedup.first_wins_late(df, "k", ["path", "block", "pos"]).collect())) == want


def test_what_is_shuffled_does_not_depend_on_the_rows_width(spark, monkeypatch):
    plans = []
    real = dedup.landed
    monkeypatch.setattr(dedup, "landed", lambda df, name: plans.append((name, df._jdf.queryExecution().executedPlan().toString())) or real(df, name))
    df = real(spark.createDataFrame(rows(300, wide=500), SCHEMA), "rows")
    out = dedup.first_wins_late(df, "k", ["path", "block", "pos"])
    winners = dict(plans)["winners"]
    assert "HashAggregate" in winners and "SortAggregate" not in winners and "ObjectHashAggregate" not in winners and "wide" not in winners
    assert "Exchange hashpartitioning" not in out._jdf.queryExecution().executedPlan().toString()
