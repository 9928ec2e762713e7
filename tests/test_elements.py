import json

from pyspark.sql import functions as F

from placeweave.functions.osm import matches_any_selector, osm_area_id, osm_type_code
from placeweave.operators import elements as E
from placeweave.plans.spatial_enrich import spatial_enrich_elements, write_enriched
from placeweave.sources.osm import scan_element_lines, scan_elements


def geom(*pts):
    return [{"lon": x, "lat": y} for x, y in pts]


SQUARE = geom((0, 0), (2, 0), (2, 2), (0, 2), (0, 0))
ELEMENTS = [
    {"type": "node", "id": 1, "lat": 1.0, "lon": 1.0, "tags": {"addr:housenumber": "8", "addr:city": "", "addr:street": "S"}},
    {"type": "node", "id": 2, "lat": 9.0, "lon": 9.0, "tags": {"addr:housenumber": "9"}},
    {"type": "node", "id": 3, "lat": 1.0, "lon": 1.0, "tags": {"addr:housenumber": ""}},
    {"type": "node", "id": 4, "lat": 1.0, "lon": 1.0},
    {"type": "way", "id": 10, "tags": {"building": "yes"}, "geometry": SQUARE},
    {"type": "way", "id": 11, "tags": {"building": "yes", "name": "Tower", "addr:postcode": "P1"}, "geometry": SQUARE},
    {"type": "way", "id": 12, "tags": {"building": "yes"}, "geometry": geom((0, 0), (1, 1))},
    {"type": "relation", "id": 13, "tags": {"admin_level": "6", "addr:city": "HK", "addr:district": "D"}, "geometry": geom((0, 0), (3, 0), (3, 3), (0, 3))},
    {"type": "relation", "id": 14, "tags": {"admin_level": "6"}, "members": []},
    {"type": "node", "id": 20, "lat": 22.5, "lon": 114.1, "tags": {"place": "Town", "name:zh": "上水", "name:en": "Sheung Shui"}},
    {"type": "way", "id": 21, "center": {"lat": 1.5, "lon": 1.5}, "tags": {"place": "suburb", "name": "旺角 Mong Kok"}},
    {"type": "node", "id": 22, "lat": 1, "lon": 1, "tags": {"place": "city", "name": "旺角 Mong Kok"}},
    {"type": "node", "id": 23, "lat": 1, "lon": 1, "tags": {"place": "village", "name": "Mong Kok"}},
    {"type": "node", "id": 24, "tags": {"place": "village", "name": "旺角 Mong Kok"}},
]


def dump(spark, tmp_path):
    (tmp_path / "dump.json").write_text(json.dumps({"version": 0.6, "elements": ELEMENTS}, ensure_ascii=False), encoding="utf8")
    return scan_elements(spark, str(tmp_path / "dump.json"))


def ids(df, column="id"):
    return sorted(r[0] for r in df.select(column).collect())


def test_classes_are_not_exclusive(spark, tmp_path):
    e = dump(spark, tmp_path)
    assert ids(E.buildings(e), "osm_id") == [10, 11]
    assert ids(E.address_points(e), "addr_osm_id") == [1, 2]
    assert sorted((r.admin_district, r.admin_city) for r in E.admin_areas(e).collect()) == [("D", "HK"), ("Tower", None)]
    assert tuple(E.class_counts(e).first()) == (2, 2, 2)


def test_enriched_rows_multiply_and_fill_only_nulls(spark, tmp_path):
    out = spatial_enrich_elements(dump(spark, tmp_path))
    rows = sorted((r.addr_osm_id, r.building_osm_id or 0, r.addr_district or "", r.addr_city, r.addr_postcode) for r in out.collect())
    assert rows == [
        (1, 10, "D", "", None), (1, 10, "Tower", "", "P1"), (1, 11, "D", "", None), (1, 11, "Tower", "", "P1"), (2, 0, "", None, None),
    ]
    write_enriched(out, str(tmp_path / "out"))
    back = spark.read.csv(str(tmp_path / "out"), header=True)
    assert back.columns == out.columns and back.count() == 5


def test_places(spark, tmp_path):
    out = {r.en_name: r for r in E.load_places(dump(spark, tmp_path)).collect()}
    assert set(out) == {"Sheung Shui", "Mong Kok"}
    assert (out["Mong Kok"].lat, out["Mong Kok"].zh_name, out["Sheung Shui"].place) == (1.5, "旺角", "town")


def test_ids_codes_and_selectors(spark):
    df = spark.createDataFrame([(1, "node"), (913110, "WAY"), (3, "x"), (4, None)], "i int, t string")
    got = df.select(osm_area_id(F.col("i")).alias("a"), osm_type_code(F.col("t")).alias("c")).collect()
    assert [(r.a, r.c) for r in got] == [(3600000001, "N"), (3600913110, "W"), (3600000003, "N"), (3600000004, "N")]
    tags = spark.createDataFrame(
        [(1, {"place": "x"}), (2, {"railway": "station"}), (3, {"railway": "halt"}), (4, {}), (5, None)], "i int, tags map<string,string>"
    )
    hit = tags.filter(matches_any_selector(F.col("tags"), ["place", "building", "railway=station"]))
    assert ids(hit, "i") == [1, 2]


def test_elements_in_area(spark, tmp_path):
    area = spark.createDataFrame([([(0.5, 0.5), (2.5, 0.5), (2.5, 2.5), (0.5, 2.5)],)], "ring array<struct<x:double,y:double>>")
    assert ids(E.elements_in_area(dump(spark, tmp_path), area)) == [1, 3, 4, 10, 11, 12, 21, 22, 23]


def test_element_lines(spark, tmp_path):
    whole = dump(spark, tmp_path).drop("path", "pos")
    lines = ",\n".join(json.dumps(e, ensure_ascii=False) for e in ELEMENTS)
    (tmp_path / "lines.json").write_text('{"elements": [\n' + lines + "\n]}", encoding="utf8")
    split = scan_element_lines(spark, str(tmp_path / "lines.json")).drop("path", "block", "pos")
    assert sorted(map(str, split.collect())) == sorted(map(str, whole.collect()))
