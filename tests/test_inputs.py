"""Inputs made from the given tables: the same rows, over as many tasks as their number asks for."""

from checks.inputs import ROWS_PER_TASK, derive, spread


def test_rows_of_one_row_group_are_spread_over_tasks(spark, tmp_path):
    n = 3 * ROWS_PER_TASK + 5
    rows = spark.range(n).selectExpr("id AS p_partkey", "if(id % 7 = 0, null, 'x') AS p_name")
    rows.unionByName(rows.limit(10)).coalesce(1).write.parquet(str(tmp_path / "part.parquet"))
    found = derive(spark, str(tmp_path), "SELECT p_partkey AS k, p_name FROM {part}")
    sizes = [len(part) for part in found.rdd.glom().collect()]
    assert len(sizes) == 4 and max(sizes) <= ROWS_PER_TASK + 5 and sum(sizes) == n + 10
    assert found.distinct().count() == n and found.filter("p_name IS NULL").count() == -(-n // 7) + 2


def test_small_and_empty_tables_stay_as_they_are(spark):
    assert spread(spark.range(0, 10, 1, 2)).rdd.getNumPartitions() == 2
    assert spread(spark.range(0)).count() == 0
