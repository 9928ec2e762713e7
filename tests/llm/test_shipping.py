"""Executors need no copy of the package: operators run in a session whose workers cannot import it."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SCRIPT = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
settings = {{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"}}
spark = SparkSession.builder.master("local[4]").config(map=settings).getOrCreate()

def imports(rows):
    try:
        import placeweave
        yield True
    except ModuleNotFoundError:
        yield False

assert spark.sparkContext.parallelize([0], 1).mapPartitions(imports).collect() == [False]
from placeweave.llm.queries import QUERIES
for name in {names!r}:
    assert QUERIES[name](spark, "/root/testdata/sf0.001").count() > 0, name
print("all ran")
"""


def test_operators_run_where_workers_lack_the_package(tmp_path):
    names = ["op2_line_dedup", "op7_latent_neighbours", "op9_grouped_prefix_join", "op11_prefix_fingerprints", "op12_zone_map_clusters", "op13_spelling_variants"]
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    script = SCRIPT.format(root=ROOT, names=names)
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert "all ran" in done.stdout, done.stderr[-2000:]
