"""Entity documents, suggestions, requests, hits and enrichment."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from placeweave.functions.text import slugify
from placeweave.operators import entities as N
from placeweave.session import scratch_path
from placeweave.sources.entities import known_slugs as slugs_of_files
from placeweave.sources.entities import rendered, scan_entity_docs as scan_docs, write_entity_docs

from . import expected as X
from .inputs import ADMIN, ENTITIES, HITS, PLACES, REQUESTS, address_features, derive, details, entities, table  # noqa: F401
from .registry import query

AS_OF = "2026-01-31"
RANK = ["r1", "r2", "r3", "r4"]


def _rendered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rendered(entities(spark, sf_dir))


def _quoted(expr: str) -> str:
    return f"""'"' || replace({expr}, '"', '\\"') || '"'"""


_DOCUMENT = f"""'---' || chr(10) || coalesce('assigned_district: ' || {_quoted('assigned_district')} || chr(10), '')
  || 'category: ' || {_quoted('category')} || chr(10) || coalesce('geometry_ref: ' || {_quoted('geometry_ref')} || chr(10), '')
  || 'id: ' || {_quoted('slug')} || chr(10)
  || 'last_updated: ' || {_quoted('last_updated')} || chr(10) || 'lat: ' || coalesce(CAST(lat AS STRING), 'null') || chr(10)
  || 'lon: ' || coalesce(CAST(lon AS STRING), 'null') || chr(10) || 'names:' || chr(10) || '  en: ' || {_quoted('en')} || chr(10)
  || '  zh: ' || {_quoted('zh')} || chr(10) || 'source: ' || {_quoted('source')} || chr(10)
  || CASE WHEN tagged THEN 'tags:' || chr(10) || '- "nominatim"' || chr(10) ELSE '' END
  || '---' || chr(10) || chr(10) || '# body' || chr(10)"""


@query(f"SELECT slug, {_DOCUMENT} AS document FROM ({X.ENTITIES})")
def render_entity_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rendered(spark, sf_dir)


@query(
    f"""SELECT slug, slug AS id, en, zh, category, lat, lon, source, last_updated,
   CASE WHEN tagged THEN 'nominatim' END AS tags, geometry_ref, assigned_district, '# body' || chr(10) AS body
  FROM ({X.ENTITIES})"""
)
def scan_entity_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents written as files and read back."""
    path = scratch_path(spark, "entities")
    write_entity_docs(entities(spark, sf_dir), path)
    return _flat(scan_docs(spark, path))


def _flat(docs: DataFrame) -> DataFrame:
    return docs.select(
        "slug", "id", F.col("names.en").alias("en"), F.col("names.zh").alias("zh"), "category", "lat", "lon", "source",
        "last_updated", F.array_join("tags", ",").alias("tags"), "geometry_ref", "assigned_district", "body",
    )


@query(f"SELECT slug FROM ({X.ENTITIES})")
def known_slugs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From the names of written files; the texts are not read."""
    path = scratch_path(spark, "entities")
    write_entity_docs(entities(spark, sf_dir), path)
    return slugs_of_files(spark, path)


@query(
    f"""WITH wanted AS (SELECT s_suppkey AS k, 'place-' || CAST(s_suppkey AS STRING) AS slug FROM supplier)
  SELECT w.slug, CASE WHEN k % 3 = 0 THEN e.document ELSE replace(e.document, 'category: "poi"', 'category: "estate"') END AS document
  FROM wanted w JOIN (SELECT slug, {_DOCUMENT} AS document FROM ({X.ENTITIES})) e ON w.slug = e.slug"""
)
def write_entity_docs_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third document is written first; then all are created in another category, which leaves those alone."""
    from placeweave.sources.entities import read_documents

    path, rows = scratch_path(spark, "entities"), entities(spark, sf_dir)
    third = F.regexp_extract("slug", r"(\d+)$", 1).cast("bigint") % 3 == 0
    write_entity_docs(rows.filter(third), path)
    write_entity_docs(rows.withColumn("category", F.lit("estate")), path, create_only=True)
    return read_documents(spark, path)


def _features_and_free_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Structured addresses, addresses one level up, and free-text ones."""
    c = F.col
    structured = address_features(spark, sf_dir).select("properties")
    sentence = F.concat(F.lit("Flat 3, Happy "), "c_mktsegment", F.lit(" "), c("c_nationkey").cast("string"), F.lit(" Court, Kowloon"))
    free = table(spark, sf_dir, "customer").select(F.to_json(F.struct(sentence.alias("Address"))).alias("properties"))
    village = F.struct(F.struct(F.concat(F.lit("Bare "), "s_name").alias("VillageName")).alias("EngVillage"))
    bare = table(spark, sf_dir, "supplier").select(
        F.to_json(F.struct(F.struct(village.alias("EngPremisesAddress")).alias("PremisesAddress"))).alias("properties")
    )
    return structured.unionByName(free).unionByName(bare).select(F.try_parse_json("properties").alias("properties"))


_CANDIDATES = f"""SELECT village_chi AS name FROM ({X.PREMISES}) WHERE village_kind = 'object'
  UNION SELECT village_eng FROM ({X.PREMISES}) WHERE village_kind = 'object'
  UNION SELECT 'Happy ' || c_mktsegment || ' ' || CAST(c_nationkey AS STRING) || ' Court' FROM customer
  UNION SELECT 'Bare ' || s_name FROM supplier"""


@query(_CANDIDATES)
def entity_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.entity_candidates(_features_and_free_text(spark, sf_dir))


_ALL_CANDIDATES = f"{_CANDIDATES} UNION SELECT en_name FROM ({X.LABELS})"
_SLUG = r"""regexp_replace(regexp_replace(lower(trim(name)), '[^\p{L}\p{N}_\-\s]', '', 'g'), '\s+', '-', 'g')"""
_SUGGESTED = f"""SELECT name, slug FROM (SELECT name, {_SLUG} AS slug FROM ({_ALL_CANDIDATES}))
  WHERE slug NOT IN (SELECT slug FROM ({X.ENTITIES})) ORDER BY slug, name LIMIT 200"""


def _suggested(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = derive(spark, sf_dir, X.LABELS.replace(X.PLACES, PLACES)).select(F.col("en_name").alias("name"))
    candidates = N.entity_candidates(_features_and_free_text(spark, sf_dir)).unionByName(named).distinct()
    return N.suggest_entities(candidates, derive(spark, sf_dir, ENTITIES))


@query(_SUGGESTED)
def suggest_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _suggested(spark, sf_dir)


@query(
    f"""SELECT name, slug, 'Entity Create: ' || name AS title,
   'Entity name (EN / ZH): ' || name || chr(10) || 'Entity category: estate or poi' || chr(10) || 'Short description:' || chr(10)
   || 'Lat, Lon:' || chr(10) || 'Source: gov.hk ALS-GeoJSON' || chr(10) || 'Suggested slug / id: ' || slug AS body
  FROM ({_SUGGESTED})"""
)
def suggestion_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.suggestion_text(_suggested(spark, sf_dir))


_WANTED = "SELECT p_name || ' ' || p_brand AS slug, p_name AS en, p_type AS category, p_retailprice AS lat FROM {part}"
_PART_SLUG = r"""regexp_replace(regexp_replace(lower(trim(slug)), '[^\p{L}\p{N}_\-\s]', '', 'g'), '\s+', '-', 'g')"""


@query(
    f"""WITH wanted AS (SELECT {_PART_SLUG} AS slug, en, category, lat FROM ({_WANTED.format(part='part')})),
   existing AS (SELECT {_PART_SLUG} AS slug FROM (SELECT p_name || ' ' || p_brand AS slug FROM part JOIN supplier ON p_partkey = s_suppkey))
  SELECT slug AS id, en, '' AS zh, category, lat, '{AS_OF}' AS last_updated FROM
   (SELECT *, row_number() OVER (PARTITION BY slug ORDER BY en, category, lat) AS rn FROM wanted
    WHERE slug NOT IN (SELECT slug FROM existing)) WHERE rn = 1"""
)
def new_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    wanted = derive(spark, sf_dir, _WANTED).withColumns(
        {"zh": F.lit(None).cast("string"), "lon": F.lit(None).cast("double"), "source": F.lit(None).cast("string")}
    )
    part, supplier = (table(spark, sf_dir, t) for t in ("part", "supplier"))
    held = part.join(supplier, c("p_partkey") == c("s_suppkey"), "left_semi")
    existing = held.select(slugify(F.concat("p_name", F.lit(" "), "p_brand")).alias("slug"))
    return N.new_entities(wanted, existing, AS_OF).select(
        "id", c("names.en").alias("en"), c("names.zh").alias("zh"), "category", "lat", "last_updated"
    )


_REQUEST_KEY = "'search::Place ' || CAST({0} AS STRING) || '::limit=3::polygon=1::cc=' || CASE WHEN {0} % 4 = 0 THEN 'hk' ELSE '' END"


def _request_keys(df: DataFrame, key: str) -> DataFrame:
    k = F.col(key)
    name = F.concat(F.lit("Place "), k.cast("string"))
    return df.select(N.search_key(name, F.lit(3), F.lit(True), F.when(k % 4 == 0, "hk")).alias("request_key"))


@query(
    f"""SELECT {_REQUEST_KEY.format('p_partkey')} AS request_key FROM part
  EXCEPT SELECT {_REQUEST_KEY.format('s_suppkey')} FROM supplier"""
)
def pending_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = _request_keys(table(spark, sf_dir, "part"), "p_partkey")
    return N.pending_requests(wanted, _request_keys(table(spark, sf_dir, "supplier"), "s_suppkey"))


@query(
    f"""SELECT DISTINCT {_REQUEST_KEY.format('p_partkey')} AS request_key, 'forced' AS part FROM part
  UNION ALL SELECT {_REQUEST_KEY.format('p_partkey')}, 'cached' FROM part JOIN supplier ON p_partkey = s_suppkey"""
)
def cached_and_forced_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All requests when forced, and those whose results are stored."""
    wanted = _request_keys(table(spark, sf_dir, "part"), "p_partkey")
    stored = _request_keys(table(spark, sf_dir, "supplier"), "s_suppkey")
    forced = N.pending_requests(wanted, stored, force=True).select("request_key", F.lit("forced").alias("part"))
    return forced.unionByName(N.cached_requests(wanted, stored).select("request_key", F.lit("cached").alias("part")))


@query(
    """SELECT DISTINCT 'details::' || CASE l_linenumber % 3 WHEN 0 THEN 'N' WHEN 1 THEN 'W' ELSE 'R' END || '::' || CAST(l_suppkey AS STRING)
   || '::cls=' || CASE WHEN l_linenumber % 2 = 0 THEN 'place' ELSE '' END || '::entr=' AS request_key FROM lineitem
  EXCEPT SELECT 'details::N::' || CAST(s_suppkey AS STRING) || '::cls=place::entr=' FROM supplier"""
)
def pending_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, none = F.col, F.lit(None).cast("string")
    code = F.element_at(F.array(*[F.lit(x) for x in "NWR"]), (c("l_linenumber") % 3 + 1).cast("int"))
    cls = F.when(c("l_linenumber") % 2 == 0, "place")
    wanted = table(spark, sf_dir, "lineitem").select(N.details_key(code, c("l_suppkey"), cls, none).alias("request_key"))
    stored = table(spark, sf_dir, "supplier").select(
        N.details_key(F.lit("N"), c("s_suppkey"), F.lit("place"), none).alias("request_key")
    )
    return N.pending_requests(wanted, stored)


@query("SELECT 'https://files/' || CAST(o_orderkey AS STRING) AS url FROM orders WHERE o_orderkey % 5 = 0 OR o_orderstatus = 'P'")
def changed_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fifth file has a new tag, files with status P a new date; a missing length on both sides is no change."""
    c = F.col
    remote = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.concat(F.lit("https://files/"), c("o_orderkey").cast("string")).alias("url"),
        c("o_orderpriority").alias("etag"),
        c("o_orderstatus").alias("last_modified"),
        F.when(c("o_custkey") % 10 != 0, c("o_totalprice").cast("string")).alias("content_length"),
    )
    local = remote.withColumn("etag", F.when(c("o_orderkey") % 5 == 0, "old").otherwise(c("etag")))
    local = local.withColumn("last_modified", F.when(c("last_modified") == "P", None).otherwise(c("last_modified")))
    return N.changed_snapshots(remote, local).select("url")


_RANKED = f"SELECT *, row_number() OVER (PARTITION BY query ORDER BY r1, r2, r3, r4) AS position FROM ({X.HITS})"


@query(f"SELECT query, display_name, osm_type, osm_id FROM ({_RANKED}) WHERE position = 1")
def best_candidate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.best_candidate(derive(spark, sf_dir, HITS), "query", RANK).select("query", "display_name", "osm_type", "osm_id")


@query(f"SELECT query, CAST(position AS INT) AS position, display_name, osm_id FROM ({_RANKED}) WHERE position <= 5")
def search_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.search_topk(derive(spark, sf_dir, HITS), "query", RANK, 5).select("query", "position", "display_name", "osm_id")


_DISTRICT = "CASE WHEN shape = 'none' THEN NULL WHEN suburb <> '' THEN suburb ELSE city END"


@query(f"SELECT osm_id, c AS osm_code, {_DISTRICT} AS district FROM ({X.DETAILS}), (SELECT unnest(['N', 'W', 'R']) AS c)")
def assigned_district(spark: SparkSession, sf_dir: str) -> DataFrame:
    return details(spark, sf_dir).select("osm_id", "osm_code", N.assigned_district(F.col("details")).alias("district"))


@query(
    f"""WITH asked AS (SELECT r.slug, r.name, e.slug IS NOT NULL AS known, e.* EXCLUDE (slug),
    coalesce(r.name, nullif(e.en, ''), r.slug) AS q FROM ({X.REQUESTS}) r LEFT JOIN ({X.ENTITIES}) e ON r.slug = e.slug),
   hit AS (SELECT query, display_name, osm_type, osm_id,
     CASE WHEN osm_id <> 0 THEN CASE lower(osm_type) WHEN 'way' THEN 'W' WHEN 'relation' THEN 'R' ELSE 'N' END END AS code
    FROM ({_RANKED}) WHERE position = 1),
   found AS (SELECT a.*, h.query IS NOT NULL AS ok, h.display_name, h.osm_type, h.osm_id, h.code,
     {_DISTRICT} AS found_district, d.has_shape
    FROM asked a LEFT JOIN hit h ON a.q = h.query
    LEFT JOIN ({X.DETAILS}) d ON h.code IS NOT NULL AND d.osm_id = h.osm_id)
  SELECT CASE WHEN ok THEN 'ok' ELSE 'no_candidates' END AS status, slug,
   CASE WHEN known OR ok THEN slug END AS id,
   CASE WHEN known THEN en WHEN ok THEN coalesce(name, slug) END AS en, CASE WHEN known THEN zh WHEN ok THEN '' END AS zh,
   CASE WHEN known THEN category WHEN ok THEN 'poi' END AS category, lat, lon,
   CASE WHEN known THEN source WHEN ok THEN 'gov_hk/ALS-GeoJSON' END AS source,
   CASE WHEN ok THEN '{AS_OF}' ELSE last_updated END AS last_updated,
   CASE WHEN NOT ok THEN CASE WHEN tagged THEN 'nominatim' END
        WHEN tagged THEN CASE WHEN code IS NOT NULL AND has_shape THEN 'nominatim,nominatim-polygon' ELSE 'nominatim' END
        WHEN code IS NOT NULL AND has_shape THEN 'nominatim-polygon,nominatim' ELSE 'nominatim' END AS tags,
   coalesce(geometry_ref, CASE WHEN code IS NOT NULL THEN 'nominatim://' || code || '/' || CAST(osm_id AS STRING) END) AS geometry_ref,
   coalesce(found_district, assigned_district) AS assigned_district,
   CASE WHEN ok THEN 'snap-1' END AS source_version, display_name
  FROM found"""
)
def enrich_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = N.enrich_entities(
        derive(spark, sf_dir, REQUESTS),
        entities(spark, sf_dir),
        derive(spark, sf_dir, HITS),
        details(spark, sf_dir),
        as_of=AS_OF,
        rank=RANK,
        source_version="snap-1",
    )
    return out.select(
        "status", "slug", "id", F.col("names.en").alias("en"), F.col("names.zh").alias("zh"), "category", "lat", "lon", "source",
        "last_updated", F.array_join("tags", ",").alias("tags"), "geometry_ref", "assigned_district", "source_version", "display_name",
    )
