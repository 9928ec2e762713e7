"""Run registered queries against their checking SQL: ``python tests/check_oracle.py [sf_dir] [name ...]``."""

from __future__ import annotations

import datetime
import math
import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def canon(value):
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.9g}"
    if isinstance(value, (datetime.date, datetime.datetime)):
        return value.isoformat()
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(canon(r[i]) for i in order) for r in rows)


def main():
    import duckdb
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for name in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    oracles, bad = entry.oracle_sql(), []
    for name, fn in entry.queries().items():
        if only and name not in only:
            continue
        t = time.time()
        try:
            df = fn(spark, sf_dir)
            got = rows_of(df.columns, df.collect())
            took = time.time() - t
            if name not in oracles:
                print(f"rows  {name} {len(got)} {took:.2f}s", flush=True)
                continue
            cur = con.execute(oracles[name])
            cols = [d[0] for d in cur.description]
            want = rows_of(cols, cur.fetchall())
            ok = sorted(cols) == sorted(df.columns) and got == want
            print(f"{'ok   ' if ok else 'DIFF '} {name} {len(got)}/{len(want)} {took:.2f}s", flush=True)
            if not ok:
                bad.append(name)
                print("   ", sorted(df.columns), sorted(cols))
                print("    spark only", sorted(set(got) - set(want))[:3])
                print("    sql only  ", sorted(set(want) - set(got))[:3])
        except Exception:
            bad.append(name)
            print(f"FAIL  {name}", traceback.format_exc()[-1800:], flush=True)
    print("bad:", bad)


if __name__ == "__main__":
    main()
