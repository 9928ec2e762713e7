"""Splittable layouts against whole-file scans, unreadable pieces, missing and repeated paths."""

import json

import pytest

from placeweave.plans.canonicalize import canonicalize, canonicalize_files
from placeweave.sources.geojson import collection_files, rejected_records, scan_feature_lines, scan_features
from placeweave.sources.osm import land_elements, rejected_elements, scan_element_lines, scan_elements


def elements(n):
    out = []
    for i in range(n):
        tags = {"name": f'x [{i}] "\\n  ]" {{', "place": "village"}
        if i % 3 == 0:
            out.append({"type": "node", "id": i, "lat": 22.0 + i, "lon": 114.0, "tags": tags})
        elif i % 3 == 1:
            out.append({"type": "way", "id": i, "nodes": [1, 2, 3], "geometry": [{"lat": 1.0, "lon": 2.0}] * 3, "tags": tags})
        else:
            out.append({"type": "relation", "id": i, "center": {"lat": 1.5, "lon": 2.5}, "members": [{"type": "way", "ref": 1}]})
    return out


def native(items):
    """As a map server prints dumps: elements at the left margin, one-line vertices."""
    text = ",\n".join(json.dumps(x, indent=2) for x in items)
    return '{\n  "version": 0.6,\n  "osm3s": {\n    "copyright": "c"\n  },\n  "elements": [\n\n' + text + "\n\n  ]\n}\n"


def lines(items, name="elements", head='"version": 0.6,'):
    return "{" + head + f'"{name}":[\n' + ",\n".join(json.dumps(x) for x in items) + "\n]}\n"


def write(path, text):
    path.write_text(text, encoding="utf8")
    return str(path)


def content(df):
    order = [c for c in ("path", "block", "pos") if c in df.columns]
    return [tuple(r) for r in df.orderBy(*order).drop("path", "block", "pos").collect()]


def test_element_layouts_equal_the_whole_scan(spark, tmp_path):
    items = elements(200)
    whole = content(scan_elements(spark, write(tmp_path / "whole.json", json.dumps({"elements": items}))))
    assert len(whole) == 200
    texts = {"line": lines(items), "indent": json.dumps({"version": 1, "elements": items, "note": [1]}, indent=2), "native": native(items)}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        for layout, text in texts.items():
            path = write(tmp_path / f"{layout}.json", text)
            got = scan_element_lines(spark, path, layout)
            assert content(got) == whole, layout
            assert rejected_elements(spark, path, layout).count() == 0
            assert got.rdd.getNumPartitions() > 3
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    landed = land_elements(scan_element_lines(spark, str(tmp_path / "native.json"), "native"), str(tmp_path / "landed"))
    assert content(landed) == whole


def features(n):
    return [{"type": "Feature", "geometry": {"type": "Point", "coordinates": [1.0, i]}, "properties": {"k": i, "list": [{"a": 1}]}} for i in range(n)]


def plain(rows):
    return [(g.type, json.loads(g.coordinates), json.loads(p)) for g, p in rows]


def test_feature_layouts_equal_the_whole_scan(spark, tmp_path):
    items, head = features(50), '"type":"FeatureCollection","crs":{"type":"name"},'
    whole = content(scan_features(spark, write(tmp_path / "w.geojson", json.dumps({"type": "FeatureCollection", "features": items}))))
    printed = '{\n"type": "FeatureCollection",\n"name": "x",\n"features": [\n' + ",\n".join(json.dumps(x) for x in items) + "\n]\n}\n"
    texts = {"line": [lines(items, "features", head), printed], "indent": [json.dumps({"type": "FeatureCollection", "features": items}, indent=2)]}
    for layout, given in texts.items():
        for k, text in enumerate(given):
            got = scan_feature_lines(spark, write(tmp_path / f"{layout}{k}.geojson", text), layout=layout)
            assert plain(content(got)) == plain(whole)


@pytest.fixture(params=["1k", "6k", "128m"])
def split(request, spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", request.param)
    spark.conf.set("spark.sql.files.openCostInBytes", "100")
    yield request.param
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def test_any_layout_equals_the_whole_scan(spark, tmp_path, split):
    items = elements(40)
    items[6]["tags"]["long"] = 'x}{["\\' * 900  # a string of marks over several blocks
    items[8]["members"] = [{"type": "way", "ref": i} for i in range(400)]  # a record over several blocks
    whole = content(scan_elements(spark, write(tmp_path / "whole.json", json.dumps({"elements": items}))))
    beside = {"links": [{"type": "node", "elements": [{"type": "node"}]}], "elements": items, "note": ["}", {"type": "way"}]}
    texts = {
        "one": json.dumps(beside),
        "tight": json.dumps({"elements": items}, separators=(",", ":"), ensure_ascii=False),
        "two": json.dumps(beside, indent=2) + "\n",
        "four": json.dumps(beside, indent=4) + "\n\n",
        "native": native(items),
    }
    paths = {name: write(tmp_path / f"{name}.json", text) for name, text in texts.items()}
    got = scan_element_lines(spark, list(paths.values()), "any")
    if split == "1k":
        assert got.filter(f"pos = {2**33 - 2}").count() > 10 and got.select("block").distinct().count() > 20
    rows = {}
    for r in got.orderBy("path", "block", "pos").collect():
        rows.setdefault(r["path"].rsplit("/", 1)[1], []).append(tuple(r)[3:])
    assert rows == {f"{name}.json": whole for name in texts}
    assert rejected_elements(spark, list(paths.values()), "any").count() == 0


def test_any_layout_without_broadcast(spark, tmp_path, split):
    from placeweave.operators.sizing import NEVER
    from placeweave.sources.blocks import list_items
    from placeweave.sources.records import reader

    items = [{"a": i, "b": ["}" * (i % 7), {"c": [{}]}]} for i in range(150)]
    path = write(tmp_path / "x.json", json.dumps({"elements": items}))
    rows = list_items(spark, reader(spark), [path], "elements", NEVER).orderBy("block", "pos").collect()
    assert all(r["whole"] for r in rows) and [json.loads(r["json"]) for r in rows] == items


def test_any_layout_says_what_is_no_record(spark, tmp_path, split):
    items = elements(30)
    one = json.dumps({"elements": items})
    texts = {
        "cut": one[:-40],
        "cut-after-a-record": one[:-2],
        "cut-before-the-end": one[:-1],
        "cut-in-a-string": one[: one.index("village", 2000)],
        "stray": json.dumps({"elements": [*items, 7, "x}", None, [1]]}),
        "wrong-kind": json.dumps({"elements": [*items, {"type": "other"}]}),
        "no-comma": one.replace("}, {", "} ; {", 1),
        "not-a-list": json.dumps({"elements": {"a": 1}}),
    }
    for name, text in texts.items():
        path = write(tmp_path / f"{name}.json", text)
        assert rejected_elements(spark, path, "any").count() > 0, name
        with pytest.raises(Exception, match="unreadable record"):
            scan_element_lines(spark, path, "any").count()
    loose = scan_element_lines(spark, str(tmp_path / "stray.json"), "any", strict=False)
    assert loose.count() == 30
    for name, text in (("none", '{"elements":[]}'), ("absent", '{"other":[{"type":"node"}]}'), ("empty", ""), ("blank", '\n {"elements" : [ \n ] } \n')):
        path = write(tmp_path / f"{name}.json", text)
        assert scan_element_lines(spark, path, "any").count() == 0, name


def test_strict_scans_stop_whatever_columns_are_asked_for(spark, tmp_path):
    items = elements(5)
    broken = [
        ("indent", json.dumps({"elements": items}, indent=2)[:-60]),
        ("line", lines(items)[:-60]),
        ("line", json.dumps({"elements": items})),
        ("native", json.dumps({"elements": items})),
        ("any", json.dumps({"elements": items})[:-9]),
    ]
    for k, (layout, text) in enumerate(broken):
        path = write(tmp_path / f"{k}.json", text)
        for asked in (lambda df: df.count(), lambda df: df.select("path", "pos").collect(), lambda df: df.select("id").collect()):
            with pytest.raises(Exception, match="unreadable record"):
                asked(scan_element_lines(spark, path, layout))


def test_wrong_layouts_and_broken_files_stop_the_scan(spark, tmp_path):
    items = elements(5)
    printed = write(tmp_path / "p.json", json.dumps({"elements": items}, indent=2))
    one = write(tmp_path / "o.json", json.dumps({"elements": items}))
    for path, layout in ((printed, "line"), (one, "line"), (one, "native"), (printed, "native")):
        with pytest.raises(Exception, match="unreadable record"):
            scan_element_lines(spark, path, layout).collect()
        assert rejected_elements(spark, path, layout).count() > 0
    broken = write(tmp_path / "b.json", lines(items)[:-60])
    with pytest.raises(Exception, match="unreadable record"):
        scan_element_lines(spark, broken).collect()
    assert scan_element_lines(spark, broken, strict=False).count() == 4
    cut = write(tmp_path / "c.json", json.dumps({"elements": items})[:-30])
    with pytest.raises(Exception, match="unreadable document"):
        scan_elements(spark, cut).collect()
    assert scan_elements(spark, cut, strict=False).count() < 5


def test_paths(spark, tmp_path):
    a = write(tmp_path / "a.geojson", json.dumps({"features": features(2)}))
    none = write(tmp_path / "none.geojson", json.dumps({"features": []}))
    missing = str(tmp_path / "missing.geojson")
    assert scan_features(spark, [a, missing, a]).count() == 2
    assert scan_feature_lines(spark, [missing]).count() == 0 and scan_features(spark, missing).count() == 0
    assert collection_files(spark, [a, none, missing]).count() == 2
    assert rejected_records(spark, none).count() == 0


def test_unreadable_features_keep_their_own_rows(spark, tmp_path):
    rows = [("f", i, None, p) for i, p in enumerate(["{bad", "{worse", '{"a":1,"a":2}', '{"a":1}'])]
    df = spark.createDataFrame(rows, "path string, pos int, geometry struct<type:string,coordinates:string>, properties string")
    assert canonicalize(df).count() == 3


def test_order_comes_from_the_scan(spark, tmp_path):
    items = [{"type": "Feature", "geometry": None, "properties": {"Address": {"PremisesAddress": {"GeoAddress": "same", "EngPremisesAddress": {"BuildingName": f"B{i}"}}}}} for i in range(30)]
    path = write(tmp_path / "f.geojson", lines(items, "features"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    try:
        assert [r.building_eng for r in canonicalize_files(spark, path, layout="line").collect()] == ["B0"]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def _feature(i: int) -> str:
    return '{"type":"Feature","geometry":{"type":"Point","coordinates":[1e2, %d]},"properties":{"a" : 1.0e5,"名":"%s"}}' % (i, "é" * 50)


def test_whole_documents_are_read_once_and_keep_their_text(spark, tmp_path):
    text = '{"type":"FeatureCollection","features":[\n' + ",\n".join(_feature(i) for i in range(400)) + "]}"
    path = tmp_path / "one.geojson"
    path.write_text(text, encoding="utf8")
    told = spark._jvm.org.apache.hadoop.fs.FileSystem.getGlobalStorageStatistics().get("file")
    scan = scan_features(spark, str(path))
    before = told.getLong("bytesRead")
    rows = scan.orderBy("pos").collect()
    assert told.getLong("bytesRead") - before < 3 * path.stat().st_size
    assert [(r.pos, r.geometry.coordinates) for r in rows] == [(i, f"[1e2, {i}]") for i in range(400)]
    assert {r.properties for r in rows} == {'{"a" : 1.0e5,"名":"%s"}' % ("é" * 50)}


def test_documents_in_other_encodings_are_not_misread(spark, tmp_path):
    """They stop a strict scan beside readable ones; lists of documents and byte order marks read as ever."""
    text = '{"features":[' + _feature(1) + "]}"
    (tmp_path / "mark.geojson").write_bytes(b"\xef\xbb\xbf" + text.encode())
    (tmp_path / "list.geojson").write_text(f"[{text}, {text}]", encoding="utf8")
    (tmp_path / "empty.geojson").write_text("")
    assert sorted(r.geometry.coordinates for r in scan_features(spark, str(tmp_path / "*.geojson")).collect()) == ["[1e2, 1]"] * 3
    (tmp_path / "wide.geojson").write_bytes(text.encode("utf-16-le"))
    with pytest.raises(Exception, match="unreadable document"):
        scan_features(spark, str(tmp_path / "*.geojson")).collect()
    loose = scan_features(spark, str(tmp_path / "*.geojson"), strict=False).collect()
    assert sorted(str(r.geometry.coordinates) for r in loose) == ["None", "[1e2, 1]", "[1e2, 1]", "[1e2, 1]"]
