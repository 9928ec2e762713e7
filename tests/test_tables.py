import hashlib
import json

from placeweave.operators import profile as P
from placeweave.schemas import CANONICAL
from placeweave.sources import landing as L
from placeweave.sources.canonical import read_canonical, write_canonical


def canonical(spark):
    row = {f.name: None for f in CANONICAL.fields}
    a = {**row, "id": "1", "address_chi": '引號"，,\n行', "address_eng": "NA", "lat": 22.25, "village_eng": ""}
    return spark.createDataFrame([a, {**row, "id": "2"}], CANONICAL)


def test_round_trips(spark, tmp_path):
    df = canonical(spark)
    for suffix in (".csv", ".parquet", ".pq", ".jsonl"):
        path = str(tmp_path / f"t{suffix}")
        write_canonical(df, path)
        out = {r.id: r for r in read_canonical(spark, path).collect()}
        assert out["1"].address_chi == '引號"，,\n行' and out["1"].address_eng == "NA" and out["1"].lat == 22.25
        assert out["2"].address_chi is None
    assert {r.id: r for r in read_canonical(spark, str(tmp_path / "t.csv")).collect()}["1"].village_eng is None


def test_json_null_members(spark, tmp_path):
    for keep in (True, False):
        write_canonical(canonical(spark), str(tmp_path / f"{keep}.jsonl"), keep_nulls=keep)
        lines = [json.loads(r.value) for r in spark.read.text(str(tmp_path / f"{keep}.jsonl")).collect()]
        assert ("lon" in lines[0]) is keep


def test_landing(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.geojson").write_text("{}")
    (tmp_path / "sub" / "b.GEOJSON").write_text("[]")
    (tmp_path / "c.zip").write_bytes(b"abc")
    manifest = L.file_manifest(spark, str(tmp_path))
    assert tuple(L.landing_summary(manifest).first()) == (3, 2, 7)
    assert L.example_files(manifest, 1).count() == 1
    prints = {r.path.rsplit("/", 1)[1]: r.file_md5 for r in L.file_fingerprints(spark, str(tmp_path)).collect()}
    assert prints["c.zip"] == hashlib.md5(b"abc").hexdigest()


def test_digests_of_large_files_are_streamed(spark, tmp_path):
    import random

    rnd = random.Random(2)
    contents = {
        "a.bin": rnd.randbytes(50_000), "b.txt": b"line\n" * 9000, "c.txt": b"\n" * 5000, "d.txt": b"x" * 5000, "e [1].txt": b"a\nb" * 2000 + b"\n\n",
        "small.txt": b"a\n", "packed.gz": rnd.randbytes(9000), "wrong.json": b"\xff\xfe\n" * 3000 + b"\r",
    }
    for name, content in contents.items():
        (tmp_path / name).write_bytes(content)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        got = {r["path"].rsplit("/", 1)[1]: (r["length"], r["file_md5"]) for r in L.file_fingerprints(spark, str(tmp_path), 4096).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    from urllib.parse import unquote

    assert {unquote(k): v for k, v in got.items()} == {k: (len(v), hashlib.md5(v).hexdigest()) for k, v in contents.items()}


def test_profiles(spark):
    rows = [("f1", '{"a":1,"b":2}'), ("f1", '{"a":1}'), ("f1", "{}"), ("f2", '{"c":null,"a":{"x":1}}'), ("f2", None)]
    df = spark.createDataFrame(rows, "path string, properties string")
    freq = P.property_key_freq(df)
    assert {(r.path, r.key): r.cnt for r in freq.collect()} == {("f1", "a"): 2, ("f1", "b"): 1, ("f2", "c"): 1, ("f2", "a"): 1}
    assert [(r.path, r.key) for r in P.top_keys_per_file(freq, 1).orderBy("path").collect()] == [("f1", "a"), ("f2", "a")]
    assert [tuple(r) for r in P.top_keys_global(freq, 2).collect()] == [("a", 3), ("b", 1)]
    counts = {r.path: (r.features, r["keys"]) for r in P.feature_counts(df).collect()}
    assert counts == {"f1": (3, 2), "f2": (2, 2), None: (5, 3)}


def test_fill_rates_and_provenance(spark):
    rates = {r.column_name: r.fill_rate for r in P.fill_rates(canonical(spark), ["id", "lat", "village_eng"]).collect()}
    assert rates == {"id": 1.0, "lat": 0.5, "village_eng": 0.0}
    df = spark.createDataFrame(
        [("a", "a", 1.0), ("b", None, None), (None, None, None)],
        "sub_district_chi string, sub_district_eng string, sub_district_dist_m double",
    )
    assert {r.provenance: r.cnt for r in P.sub_district_provenance(df).collect()} == {"geographic": 1, "village": 1, "none": 1}


def quoted_rows(n):
    import random

    rnd = random.Random(4)
    bits = ['"', ",", "\n", "\r\n", "a", "b c", "é", "\n\n", '""', "{x}", ""]
    return [(i, "".join(rnd.choice(bits) for _ in range(rnd.randint(0, 8))), i / 4 if i % 3 else None, rnd.choice(["NA", "", None, "x"])) for i in range(n)]


def test_quoted_text_is_split_between_tasks(spark, tmp_path):
    """Line breaks inside fields, blocks that begin inside them, records over several blocks, several files."""
    import csv

    from pyspark.sql import types as T

    from placeweave.operators.sizing import NEVER, BroadcastLimit
    from placeweave.sources.quoted import read_quoted_csv, read_records

    schema = T.StructType([T.StructField(n, t) for n, t in (("k", T.LongType()), ("t", T.StringType()), ("d", T.DoubleType()), ("e", T.StringType()))])
    rows = quoted_rows(900)
    rows[300] = (300, "long\n" * 3000, 1.0, "x")
    rows[301] = (301, '"' * 2001 + "\n", 1.0, "x")
    for name, part in (("a", rows[:500]), ("b", rows[500:]), ("c", [])):
        with open(tmp_path / f"{name}.csv", "w", encoding="utf8", newline="") as out:
            writer = csv.writer(out, lineterminator="\n")
            writer.writerow(["k", "a name\nof two lines", "d", "e"])
            writer.writerows(part)
            out.write("\n")
    whole = spark.read.schema(schema).options(header=True, multiLine=True, escape='"').csv(str(tmp_path))
    want = sorted(map(tuple, whole.collect()), key=repr)
    assert len(want) == 900
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
    spark.conf.set("spark.sql.files.openCostInBytes", "100")
    try:
        for limit in (BroadcastLimit(), NEVER):
            got = read_quoted_csv(spark, str(tmp_path), schema, limit)
            assert sorted(map(tuple, got.collect()), key=repr) == want
        records = read_records(spark, str(tmp_path))
        assert records.select("path", "block").distinct().count() > 10 and records.filter(f"pos = {2**61}").count() > 3
        keys = [int(r["record"].split(",")[0]) for r in records.orderBy("path", "block", "pos").collect()]
        assert keys == list(range(900))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_carriage_returns_before_line_breaks_belong_to_them(spark, tmp_path):
    from placeweave.sources.quoted import read_quoted_csv
    from pyspark.sql import types as T

    (tmp_path / "x.csv").write_bytes(b'k,t\r\n1,"a\r\nb"\r\n\r\n2,c\r\n3,')
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("t", T.StringType())])
    got = read_quoted_csv(spark, str(tmp_path), schema).collect()
    assert sorted((r["k"], (r["t"] or "").replace("\r", "")) for r in got) == [(1, "a\nb"), (2, "c"), (3, "")]
