import pytest
from pyspark.sql import functions as F

from placeweave.operators import entities as N
from placeweave.schemas import ENTITY
from placeweave.sources.entities import known_slugs, parse_entity_docs, read_documents, render_document, scan_entity_docs

DOC = """---
category: estate
geometry_ref: map://W/77
id: lone_pine
last_updated: '2024-02-29'
lat: '22.5'
lon: null
names:
  en: Lone Pine
  zh: 孤松
source: survey
tags:
- seen
wikidata: Q1
aliases: [a, {b: 1}]
---

# Lone Pine

A tree and what stands around it.
"""


def corpus(tmp_path):
    (tmp_path / "lone_pine.md").write_text(DOC, encoding="utf8")
    (tmp_path / "plain.md").write_text("no frontmatter\n", encoding="utf8")
    (tmp_path / "bad.md").write_text("---\n: [\n---\nbody", encoding="utf8")
    (tmp_path / "scaffold.md").write_text("---\nid: s\nnames: {'en': 'A', 'zh': '大'}\nlast_updated: 2025-01-02\n---\n\n", encoding="utf8")
    (tmp_path / "notes.txt").write_text("x")
    return str(tmp_path)


def test_scan_documents(spark, tmp_path):
    out = {r.slug: r for r in scan_entity_docs(spark, corpus(tmp_path)).collect()}
    r = out["lone_pine"]
    assert (r.id, r.names.en, r.names.zh, r.lat, r.lon, r.tags) == ("lone_pine", "Lone Pine", "孤松", 22.5, None, ["seen"])
    assert r.last_updated == "2024-02-29" and r.geometry_ref == "map://W/77" and r.body.startswith("# Lone Pine")
    assert r.extra == {"wikidata": '"Q1"', "aliases": '["a", {"b": 1}]'}
    assert out["plain"].id is None and out["bad"].id is None
    assert (out["scaffold"].names.zh, out["scaffold"].last_updated) == ("大", "2025-01-02")
    assert sorted(x.slug for x in known_slugs(spark, str(tmp_path)).collect()) == ["bad", "lone_pine", "plain", "scaffold"]
    assert read_documents(spark, str(tmp_path)).count() == 4


def test_render_then_parse(spark):
    yaml = pytest.importorskip("yaml")
    rows = [("a", 'He said "x": \\ # y\n- z', "大", None, ["t1", "- [t2"]), ("b", "null", "", 1.5, None)]
    df = spark.createDataFrame(rows, "id string, en string, zh string, lat double, tags array<string>")
    c = {n: F.col(n) for n in ("id", "lat", "tags")}
    c.update(names_en=F.col("en"), names_zh=F.col("zh"), lon=F.col("lat"), category=F.lit("poi"), source=F.lit(None).cast("string"), last_updated=F.lit("2026-01-01"))
    docs = df.select(F.col("id").alias("slug"), render_document(c).alias("document"))
    for r in docs.collect():
        assert isinstance(yaml.safe_load(r.document.split("\n---\n")[0][4:]), dict)
    out = {r.slug: r for r in parse_entity_docs(docs).collect()}
    assert out["a"].names.en == rows[0][1] and out["a"].tags == ["t1", "- [t2"] and out["b"].names.en == "null"
    assert out["b"].source is None and out["b"].lat == 1.5 and out["a"].last_updated == "2026-01-01"


def fields(df):
    c = {n: F.col(n) for n in "category id lat lon source last_updated tags geometry_ref assigned_district source_version extra".split()}
    return df.select("slug", render_document(c | {"names_en": F.col("names.en"), "names_zh": F.col("names.zh")}, F.col("body")).alias("document"))


def test_documents_survive_a_rewrite(spark, tmp_path):
    once = fields(scan_entity_docs(spark, corpus(tmp_path)).filter("slug = 'lone_pine'"))
    twice = fields(parse_entity_docs(once))
    assert once.collect() == twice.collect()
    head = once.first().document.split("\n---\n")[0]
    keys = [line.split(":")[0] for line in head.split("\n")[1:] if line[0] not in " -"]
    assert keys == sorted(keys) and {"wikidata", "aliases"} <= set(keys)


def test_a_document_without_frontmatter_gets_defaults(spark, tmp_path):
    (tmp_path / "untyped.md").write_text("no frontmatter\n", encoding="utf8")
    entities = scan_entity_docs(spark, str(tmp_path)).drop("extra")
    _, hits, details = tables(spark)
    requests = spark.createDataFrame([("untyped", "Untyped")], "slug string, name string")
    r = N.enrich_entities(requests, entities, hits, details, as_of="2026-01-01", rank=["rank"]).first()
    assert (r.status, r.id, r.names.en, r.category) == ("ok", "untyped", "Untyped", "poi")


def test_a_hot_name_is_split(spark, monkeypatch):
    entities, hits, details = tables(spark)
    asked = spark.range(60_000).select(F.concat(F.lit("s"), F.col("id").cast("string")).alias("slug"), F.when(F.col("id") % 10 > 0, "Lone Pine").otherwise(F.col("id").cast("string")).alias("name"))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        out = N.enrich_entities(asked, entities, hits, details, as_of="2026-01-01", rank=["rank"])
        out.collect()
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def tables(spark, known=True):
    entity = ("lone_pine", "lone_pine", ("Lone Pine", ""), "poi", None, None, "feed", None, None, None, None, None, "# body")
    schema = "slug string, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ENTITY.fields) + ", body string"
    entities = spark.createDataFrame([entity] if known else [], schema)
    hits = spark.createDataFrame(
        [("Lone Pine", 1, "Second", "way", 9), ("Lone Pine", 0, "Lone Pine, Somewhere", "node", 501), ("Untyped", 0, "U", None, None)],
        "query string, rank int, display_name string, osm_type string, osm_id bigint",
    )
    details = spark.createDataFrame(
        [("N", 501, '{"address":{"suburb":"","city":"Lone Pine"},"geojson":{"type":"Point"}}'), ("W", 9, '{"address":[{"suburb":"S"}]}')],
        "osm_code string, osm_id bigint, d string",
    ).select("osm_code", "osm_id", F.parse_json("d").alias("details"))
    return entities, hits, details


def enrich(spark, slug, name=None, known=True, **options):
    entities, hits, details = tables(spark, known)
    requests = spark.createDataFrame([(slug, name)], "slug string, name string")
    return N.enrich_entities(requests, entities, hits, details, as_of="2026-01-01", rank=["rank"], **options)


def test_enrichment(spark):
    r = enrich(spark, "lone_pine").first()
    assert r.status == "ok" and r.tags == ["nominatim-polygon", "nominatim"] and r.assigned_district == "Lone Pine"
    assert (r.geometry_ref, r.last_updated, r.display_name) == ("nominatim://N/501", "2026-01-01", "Lone Pine, Somewhere")


def test_enrichment_is_idempotent(spark):
    entities, hits, details = tables(spark)
    once = enrich(spark, "lone_pine").select(entities.columns)
    requests = spark.createDataFrame([("lone_pine", None)], "slug string, name string")
    twice = N.enrich_entities(requests, once, hits, details, as_of="2026-01-01", rank=["rank"]).select(entities.columns)
    assert once.first() == twice.first()


def test_no_candidates_leaves_the_entity_alone(spark):
    r = enrich(spark, "lone_pine", name="Nowhere").first()
    assert (r.status, r.last_updated, r.tags, r.category) == ("no_candidates", None, None, "poi")


def test_new_entity_gets_defaults(spark):
    r = enrich(spark, "untyped", name="Untyped", known=False, source_version="v").first()
    assert (r.status, r.id, r.names.en, r.names.zh, r.category, r.geometry_ref) == ("ok", "untyped", "Untyped", "", "poi", None)
    assert r.tags == ["nominatim"] and r.source_version == "v"


def test_geometry_can_be_left_out(spark):
    r = enrich(spark, "lone_pine", fetch_geometry=False).first()
    assert (r.status, r.tags, r.geometry_ref, r.assigned_district) == ("ok", ["nominatim"], None, None)


def test_folded_slugs(spark):
    names = spark.createDataFrame([("Lone Pine",), ("Sha Tin",)], "name string")
    known = spark.createDataFrame([("lone_pine",)], "slug string")
    assert {r.slug for r in N.suggest_entities(names, known).collect()} == {"lone-pine", "sha-tin"}
    assert {r.slug for r in N.suggest_entities(names, known, fold=True).collect()} == {"sha-tin"}


def test_request_split(spark):
    wanted = spark.createDataFrame([("a",), ("a",), ("b",)], "request_key string")
    stored = spark.createDataFrame([("a",)], "request_key string")
    assert [r[0] for r in N.pending_requests(wanted, stored).collect()] == ["b"]
    assert sorted(r[0] for r in N.pending_requests(wanted, stored, force=True).collect()) == ["a", "b"]
    assert {r[0] for r in N.cached_requests(wanted, stored).collect()} == {"a"}


def test_requests_are_distinct_whatever_their_columns(spark):
    wanted = spark.createDataFrame([("a", 1), ("b", 2), ("b", 1), ("b", 1)], "request_key string, n int")
    stored = spark.createDataFrame([("a",)], "request_key string")
    assert [tuple(r) for r in N.pending_requests(wanted, stored).collect()] == [("b", 1)]
    assert sorted(tuple(r) for r in N.pending_requests(wanted, stored, force=True).collect()) == [("a", 1), ("b", 1)]
