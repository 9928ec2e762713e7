"""Documents as files: whole writes or none, creation only where nothing is, and round trips."""

import os

import pytest

from placeweave.operators import entities as N
from placeweave.sources.documents import write_text_documents
from placeweave.sources.entities import known_slugs, read_documents, scan_entity_docs, write_entity_docs
from pyspark.sql import functions as F

ENTITY = "slug string, id string, names struct<en:string,zh:string>, category string, lat double, lon double, source string, last_updated string, tags array<string>"


def entities(spark, rows):
    return spark.createDataFrame([(s, s, (en, zh), "poi", 1.5, None, 'a "b"', "2026-01-01", tags) for s, en, zh, tags in rows], ENTITY)


def files(path):
    return {name: (path / name).read_text(encoding="utf8") for name in sorted(os.listdir(path))}


ROWS = [("lone_pine", "Lone Pine", "孤松", ["x"]), ("tai-po", "Tai Po", "", None), ("大埔", "", "大埔", [])]


def test_written_documents_read_back_and_stay_the_same(spark, tmp_path):
    path = tmp_path / "docs"
    write_entity_docs(entities(spark, ROWS).repartition(3), str(path))
    first = files(path)
    assert sorted(first) == ["lone_pine.md", "tai-po.md", "大埔.md"]
    assert first["lone_pine.md"].endswith("---\n\n# Lone Pine (孤松)\n\nShort description.\n")
    assert {r["slug"] for r in known_slugs(spark, str(path)).collect()} == {s for s, *_ in ROWS}
    scanned = scan_entity_docs(spark, str(path))
    assert {r["slug"]: r["names"]["zh"] for r in scanned.collect()}["lone_pine"] == "孤松"
    write_entity_docs(scanned, str(path))
    assert files(path) == first


def test_enriched_documents_are_rewritten_once(spark, tmp_path):
    path = str(tmp_path / "docs")
    write_entity_docs(entities(spark, ROWS), path)
    hits = spark.createDataFrame([("Tai Po", 1, "Tai Po, HK", "node", 7)], "query string, r int, display_name string, osm_type string, osm_id long")
    details = spark.createDataFrame([("N", 7, '{"address":{"suburb":"Tai Po"},"geojson":{"type":"Point"}}')], "osm_code string, osm_id long, d string")
    details = details.select("osm_code", "osm_id", F.try_parse_json("d").alias("details"))
    wanted = spark.createDataFrame([("tai-po", "Tai Po")], "slug string, name string")

    def enrich():
        found = N.enrich_entities(wanted, scan_entity_docs(spark, path), hits, details, as_of="2026-02-02", rank=["r"], source_version="v1")
        write_entity_docs(found.filter("status = 'ok'").drop("status"), path)
        return files(tmp_path / "docs")

    once = enrich()
    assert "geometry_ref: \"nominatim://N/7\"" in once["tai-po.md"] and "2026-02-02" in once["tai-po.md"]
    assert "# Tai Po" in once["tai-po.md"] and "2026-01-01" in once["lone_pine.md"]
    assert enrich() == once


def test_existing_documents_are_left_alone_on_creation(spark, tmp_path):
    rows = spark.createDataFrame([("a", "new a"), ("b", "new b"), ("c", None)], "name string, text string")
    (tmp_path / "a.md").write_text("old a")
    write_text_documents(rows, str(tmp_path), suffix=".md", create_only=True)
    assert files(tmp_path) == {"a.md": "old a", "b.md": "new b", "c.md": ""}
    write_text_documents(rows, f"file://{tmp_path}", suffix=".md")
    assert files(tmp_path)["a.md"] == "new a"


def test_a_failed_job_leaves_nothing(spark, tmp_path):
    good = spark.range(40).select(F.concat(F.lit("d"), F.col("id").cast("string")).alias("name"), F.lit("x").alias("text"))
    for bad in ("a/b", "", "..", "d7", None):
        rows = good.unionByName(spark.createDataFrame([(bad, "y")], "name string, text string")).repartition(4)
        with pytest.raises(Exception, match="not a name|two documents"):
            write_text_documents(rows, str(tmp_path / "out"))
        assert not (tmp_path / "out").exists() or os.listdir(tmp_path / "out") == []
    failing = good.withColumn("text", F.when(F.col("name") == "d33", F.raise_error(F.lit("broken"))).otherwise("x"))
    with pytest.raises(Exception, match="broken"):
        write_text_documents(failing, str(tmp_path / "out"))
    assert not (tmp_path / "out").exists() or os.listdir(tmp_path / "out") == []


def test_no_documents_and_missing_folders(spark, tmp_path):
    write_entity_docs(entities(spark, ROWS).limit(0), str(tmp_path / "none"))
    assert os.listdir(tmp_path / "none") == []
    missing = str(tmp_path / "missing")
    assert read_documents(spark, missing).count() == 0 and known_slugs(spark, [missing]).count() == 0
    assert scan_entity_docs(spark, missing).count() == 0
