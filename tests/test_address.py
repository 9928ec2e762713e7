import json

import pytest

from placeweave.plans.canonicalize import canonicalize, canonicalize_feature, canonicalize_files, rejected_features
from placeweave.sources.geojson import land_features, scan_feature_lines, scan_features

SCHEMA = "path string, pos int, geometry struct<type:string,coordinates:string>, properties string"


def feature(csu="zz77", coordinates=(114.1, 22.2), chi=None, eng=None, **extra):
    chi = {"ChiDistrict": "南區", "BuildingName": "松風樓", "ChiEstate": {"EstateName": "晴川邨"}} if chi is None else chi
    eng = {"EngDistrict": "SOUTH", "BuildingName": "Pine Wind House", "EngEstate": {"EstateName": "Clear River Estate"}} if eng is None else eng
    premises = {"BuildingCsuInformation": {"CsuId": csu}, "ChiPremisesAddress": chi, "EngPremisesAddress": eng, **extra}
    return {
        "type": "Feature",
        "geometry": {"type": "Point", "coordinates": list(coordinates)},
        "properties": {"Easting": 1.5, "Northing": 2.5, "Address": {"PremisesAddress": premises}},
    }


def rows(spark, *features):
    data = [
        ("f", i, (f["geometry"]["type"], json.dumps(f["geometry"]["coordinates"])), json.dumps(f["properties"], ensure_ascii=False))
        for i, f in enumerate(features)
    ]
    return spark.createDataFrame(data, SCHEMA)


def one(spark, f, **options):
    return canonicalize_feature(rows(spark, f), **options).first()


def test_fields(spark):
    r = one(spark, feature())
    assert r.id == r.geoaddress == "zz77"
    assert (r.building_chi, r.building_eng, r.estate_chi) == ("松風樓", "Pine Wind House", "晴川邨")
    assert "松風樓" in r.address_chi and "Pine Wind House" in r.address_eng
    assert (r.lat, r.lon, r.easting, r.northing) == (22.2, 114.1, 1.5, 2.5)
    assert r.address_chi == "南區 晴川邨 松風樓" and r.address_eng == "Pine Wind House, Clear River Estate, SOUTH"


def test_multipoint_takes_first_point(spark):
    r = one(spark, feature(coordinates=([114.1, 22.2], [114.11, 22.21])))
    assert (r.lat, r.lon) == (22.2, 114.1)


@pytest.mark.parametrize("coordinates", [[114.1], [[[114.1, 22.2]]], [], ["a", "b"]])
def test_unreadable_points_are_null(spark, coordinates):
    r = one(spark, feature(coordinates=coordinates))
    assert r.lat is None and r.lon is None


def test_block_forms(spark):
    def block(**b):
        r = one(spark, feature(eng={"EngBlock": b}))
        return r.block_eng, r.address_eng

    assert block(BlockNo="A", BlockDescriptor="BLK") == ("Block A", "A Block")
    assert block(BlockNo="5", BlockDescriptor="HSE") == ("House 5", "House 5")
    assert block(BlockNo="5", BlockDescriptor="座") == ("5座", "5座")
    assert block(BlockNo=7) == ("7", "7")
    assert block(BlockDescriptor="") == ("", "")


def test_number_street_region_order(spark):
    parts = {
        "ChiStreet": {"StreetName": "道", "BuildingNoFrom": "1", "BuildingNoTo": "3"},
        "ChiVillage": "村",
        "ChiDistrict": "沙田區",
        "Region": "NT",
        "ChiEstate": {"EstateName": "邨", "ChiPhase": {"PhaseName": "一期"}},
    }
    r = one(spark, feature(chi=parts))
    assert r.address_chi == "New Territories 沙田區 道 1-3號 村 一期 邨"
    assert r.phase_chi is None and r.village_chi == "村"
    assert one(spark, feature(chi=parts), phase_from_estate=True).phase_chi == "一期"


def test_street_forms(spark):
    def street(value):
        r = one(spark, feature(eng={"EngStreet": value}))
        return r.street_eng, r.address_eng

    assert street("Scalar Road") == ("Scalar Road", "")
    assert street({"Street": "Other Road"}) == ("Other Road", "")
    assert street({"StreetName": "", "Street": "Other Road"}) == ("Other Road", "")


def test_empty_or_missing_blocks(spark):
    r = one(spark, feature(chi={}, eng={}, csu="", GeoAddress="G1"))
    assert (r.id, r.geoaddress, r.address_chi, r.address_eng) == ("G1", "G1", "", "")
    bare = {"geometry": {"type": "Point", "coordinates": []}, "properties": {}}
    r = one(spark, bare)
    assert r.id is None and r.address_chi == ""


def test_text_is_normalised(spark):
    r = one(spark, feature(eng={"BuildingName": "　Ｐｉｎｅ Ｗｉｎｄ　House　"}))
    assert r.building_eng == "Pine Wind House" and r.address_eng == "Pine Wind House"


def test_duplicate_json_keys_keep_the_last(spark):
    df = spark.createDataFrame(
        [("f", 0, None, '{"Address":{"PremisesAddress":{"GeoAddress":"a","GeoAddress":"b"}}}'), ("f", 1, None, "{broken")], SCHEMA
    )
    assert canonicalize_feature(df).orderBy("pos").first().id == "b"
    assert [r.pos for r in rejected_features(df).collect()] == [1]


def write_collection(path, *features):
    path.write_text(json.dumps({"type": "FeatureCollection", "features": list(features)}, ensure_ascii=False), encoding="utf8")


def test_files_are_deduplicated_first_wins(spark, tmp_path):
    first, second = feature("B1"), feature("B1", coordinates=(1, 2))
    deeper = tmp_path / "sub"
    deeper.mkdir()
    write_collection(tmp_path / "a.geojson", first, feature("X1"))
    write_collection(deeper / "b.geojson", second, feature("X2"))
    (tmp_path / "c.geojson").write_text("{}")
    (tmp_path / "ignored.txt").write_text("not json")
    out = {r.id: r for r in canonicalize_files(spark, str(tmp_path), recursive=True).collect()}
    assert set(out) == {"B1", "X1", "X2"}
    assert (out["B1"].lon, out["B1"].lat) == (114.1, 22.2)
    assert not {"tags", "source", "source_version", "last_modified", "geoaddress"} & set(out["B1"].asDict())


def test_dedup_falls_back_to_position_then_text(spark):
    def anonymous(coordinates, name):
        return feature("", coordinates=coordinates, eng={"BuildingName": name}, chi={})

    near = anonymous((114.10000001, 22.2), "one"), anonymous((114.10000002, 22.2), "two")
    loose = anonymous((), "three"), anonymous((), "three"), anonymous((), "four")
    out = canonicalize(rows(spark, *near, *loose))
    assert sorted(r.building_eng for r in out.collect()) == ["four", "one", "three"]


def test_provenance_on_request(spark):
    r = canonicalize(rows(spark, feature()), keep_provenance=True, source_version="v1", as_of="2026-01-01").first()
    assert (r.source_version, r.last_modified, r.geoaddress, r.tags) == ("v1", "2026-01-01", "zz77", [])


def test_normalised_districts_on_request(spark):
    f = feature(eng={"EngDistrict": "SHA TIN DISTRICT"}, chi={"ChiDistrict": "沙田區"})
    r = canonicalize(rows(spark, f), normalize_district=True).first()
    assert (r.district_eng, r.district_chi) == ("Sha Tin", "Sha Tin")


def test_landed_features_give_the_same_table(spark, tmp_path):
    write_collection(tmp_path / "a.geojson", feature("B1"), feature("B2"))
    scanned = scan_features(spark, str(tmp_path / "*.geojson"))
    landed = land_features(scanned, str(tmp_path / "landed"))
    assert sorted(map(tuple, canonicalize(landed).collect())) == sorted(map(tuple, canonicalize(scanned).collect()))


def test_large_files_are_split_by_line(spark, tmp_path):
    """One feature per line, cut into many blocks: same table as the whole-document scan, first copy still wins."""
    features = [feature(f"id{i % 700}", coordinates=(100 + i / 1000, 20)) for i in range(1000)]
    body = ",\n".join(json.dumps(f, ensure_ascii=False) for f in features)
    (tmp_path / "a.geojson").write_text('{"type": "FeatureCollection", "features": [\n' + body + "\n]}\n", encoding="utf8")
    whole = canonicalize_files(spark, str(tmp_path), recursive=True)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        lines = canonicalize_files(spark, str(tmp_path), recursive=True, one_feature_per_line=True)
        scanned = scan_feature_lines(spark, str(tmp_path), recursive=True)
        assert scanned.count() == 1000 and scanned.select("block").distinct().count() > 5
        assert sorted(map(str, lines.collect())) == sorted(map(str, whole.collect()))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_hot_key_keeps_the_first_copy(spark):
    """A third of all rows share one key; partial aggregation runs before the shuffle and the first row wins."""
    features = [feature("HOT" if i % 3 == 0 else f"id{i}", coordinates=(100 + i / 100, 20)) for i in range(300)]
    df = canonicalize(rows(spark, *features).repartition(8))
    out = {r.id: r.lon for r in df.collect()}
    assert len(out) == 201 and out["HOT"] == 100.0
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by" in plan
