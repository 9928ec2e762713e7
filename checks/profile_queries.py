"""Property-key, count and landing profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from placeweave.operators import profile as P
from placeweave.session import scratch_path
from placeweave.sources import landing as L
from placeweave.sources.documents import write_text_documents

from . import expected as X
from .inputs import address_features, table, write_documents
from .registry import query

PAGES_PER_FILE = 100


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as features: one file per return flag, property keys from quantity, status and ship mode."""
    c = F.col
    keys = F.array(
        F.concat(F.lit("q"), c("l_quantity").cast("int").cast("string")),
        F.concat(F.lit("status_"), "l_linestatus"),
        F.concat(F.lit("line_"), c("l_linenumber").cast("string")),
    )
    props = F.map_from_arrays(keys, F.array_repeat(F.lit(1), 3))
    return table(spark, sf_dir, "lineitem").select(c("l_returnflag").alias("path"), F.to_json(props).alias("properties"))


_KEYS = """SELECT l_returnflag AS path, unnest(['q' || CAST(CAST(l_quantity AS INT) AS STRING), 'status_' || l_linestatus,
   'line_' || CAST(l_linenumber AS STRING)]) AS key FROM lineitem"""
_PER_FILE = f"SELECT path, key, count(*) AS cnt FROM ({_KEYS}) GROUP BY path, key"


@query(
    """SELECT path, key, count(*) AS cnt FROM (SELECT event_type AS path, unnest(json_keys(props)) AS key FROM events)
  GROUP BY path, key"""
)
def property_key_freq(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(F.col("event_type").alias("path"), F.col("props").alias("properties"))
    return P.property_key_freq(events)


@query(
    f"""SELECT path, key, cnt, CAST(position AS INT) AS position FROM
  (SELECT *, row_number() OVER (PARTITION BY path ORDER BY cnt DESC, key) AS position FROM ({_PER_FILE})) WHERE position <= 10"""
)
def top_keys_per_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.top_keys_per_file(P.property_key_freq(_events(spark, sf_dir)))


@query(f"SELECT key, CAST(sum(cnt) AS BIGINT) AS cnt FROM ({_PER_FILE}) GROUP BY key ORDER BY cnt DESC, key LIMIT 40")
def top_keys_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.top_keys_global(P.property_key_freq(_events(spark, sf_dir)))


@query(
    f"""SELECT 'file' || CAST(k % 4 AS STRING) AS path, CAST(1 AS BIGINT) AS files, count(*) AS features,
   3 + max(CASE WHEN k % 5 = 0 THEN 1 ELSE 0 END) AS keys FROM ({X.PREMISES}) GROUP BY 1
  UNION ALL SELECT 'empty' || CAST(n_nationkey AS STRING), 1, 0, 0 FROM nation
  UNION ALL SELECT NULL, count(DISTINCT k % 4) + (SELECT count(*) FROM nation), count(*),
   3 + max(CASE WHEN k % 5 = 0 THEN 1 ELSE 0 END) FROM ({X.PREMISES})"""
)
def feature_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files with features, and one without for every nation."""
    features = address_features(spark, sf_dir)
    empty = table(spark, sf_dir, "nation").select(F.concat(F.lit("empty"), F.col("n_nationkey").cast("string")).alias("path"))
    return P.feature_counts(features, features.select("path").distinct().unionByName(empty))


def _written_pages(spark: SparkSession, sf_dir: str) -> str:
    return write_documents(
        table(spark, sf_dir, "pages").select(
            F.floor(F.col("page_id") / PAGES_PER_FILE).alias("bucket"), F.col("page_id").alias("pos"), F.col("html").alias("line")
        ),
        "pages",
    )


_FILES = f"""SELECT CAST(floor(page_id / {PAGES_PER_FILE}) AS BIGINT) AS bucket,
   string_agg(html || chr(10), '' ORDER BY page_id) AS content FROM pages GROUP BY 1"""


@query(f"SELECT bucket, CAST(strlen(content) AS BIGINT) AS length, md5(content) AS file_md5 FROM ({_FILES})")
def file_manifest_md5(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = L.file_fingerprints(spark, _written_pages(spark, sf_dir)).filter(~F.col("path").endswith("_SUCCESS"))
    return files.select(F.regexp_extract("path", r"bucket=(\d+)/", 1).cast("bigint").alias("bucket"), "length", "file_md5")


PER_COLLECTION = 100

_COLLECTIONS = f"""SELECT CAST(floor(c_custkey / {PER_COLLECTION}) AS BIGINT) AS nr, '{{"type":"FeatureCollection","features":['
   || string_agg('{{"type":"Feature","geometry":null,"properties":{{"k":' || CAST(c_custkey AS STRING) || '}}}}', ',' ORDER BY c_custkey) || ']}}' AS content
  FROM customer GROUP BY 1"""


def _written_collections(spark: SparkSession, sf_dir: str) -> str:
    """Small feature collections; every third one has its suffix in capitals, and every fifth is plain JSON by name."""
    path = scratch_path(spark, "collections")
    k = F.col("c_custkey")
    feature = F.concat(F.lit('{"type":"Feature","geometry":null,"properties":{"k":'), k.cast("string"), F.lit("}}"))
    listed = F.array_sort(F.collect_list(F.struct(k.alias("k"), feature.alias("text"))))
    grouped = table(spark, sf_dir, "customer").groupBy(F.floor(k / PER_COLLECTION).alias("nr")).agg(listed.alias("items"))
    text = F.concat(F.lit('{"type":"FeatureCollection","features":['), F.array_join("items.text", ","), F.lit("]}"))
    suffix = F.when(F.col("nr") % 5 == 4, ".json").when(F.col("nr") % 3 == 0, ".GeoJSON").otherwise(".geojson")
    write_text_documents(grouped, path, F.concat(F.lit("c"), F.lpad(F.col("nr").cast("string"), 9, "0"), suffix), text)
    return path


@query(
    f"""SELECT (SELECT count(*) FROM ({_FILES})) + count(*) AS files, count(*) FILTER (nr % 5 <> 4) AS geojson_files,
   CAST(sum(strlen(content)) + (SELECT sum(strlen(content)) FROM ({_FILES})) AS BIGINT) AS total_bytes FROM ({_COLLECTIONS})"""
)
def landing_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifests = [L.file_manifest(spark, written(spark, sf_dir)) for written in (_written_pages, _written_collections)]
    return L.landing_summary(manifests[0].filter(~F.col("path").endswith("_SUCCESS")).unionByName(manifests[1]))


@query(
    f"""SELECT 'c' || lpad(CAST(nr AS STRING), 9, '0') || CASE WHEN nr % 3 = 0 THEN '.GeoJSON' ELSE '.geojson' END AS name,
   CAST(strlen(content) AS BIGINT) AS length FROM ({_COLLECTIONS}) WHERE nr % 5 <> 4 ORDER BY nr LIMIT 10"""
)
def example_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = L.example_files(L.file_manifest(spark, _written_collections(spark, sf_dir)))
    return found.select(F.regexp_extract("path", r"([^/]*)$", 1).alias("name"), "length")
