"""Locality and polygon joins, and OSM element filters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from placeweave.functions.osm import osm_area_id as area_id_of, osm_type_code as type_code_of
from placeweave.operators import elements as E
from placeweave.operators.nearest import nearest_within
from placeweave.operators.relations import with_relation_rings
from placeweave.operators.profile import sub_district_provenance as provenance_of
from placeweave.plans import spatial_enrich as S
from placeweave.plans.canonicalize import canonicalize as canonicalize_features
from placeweave.plans.sub_district import derive_sub_district as derive_localities
from placeweave.session import scratch_path
from placeweave.sources.osm import scan_element_lines, scan_elements

from . import expected as X
from .inputs import (
    ADMIN, PLACES, PREMISES, address_elements, address_features, admin_elements, admin_relations, building_elements, compact_elements, derive, osm_elements,
    place_elements, table, written_elements,
)
from .registry import query

RADIUS = 1500.0


@query(
    f"""SELECT 10000000000 + ord AS id, CASE WHEN ord % 4 = 0 THEN 'way' ELSE 'node' END AS type, lat, lon,
   2 + 2 * CAST(name_zh IS NOT NULL AS INT) AS n_tags, CAST(floor(ord / 2000) AS BIGINT) AS bucket, CAST(ord % 2000 AS INT) AS pos
  FROM ({X.PLACES})"""
)
def scan_osm_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_elements(spark, written_elements(spark, sf_dir) + "/*/*.txt")
    return found.select(
        "id",
        "type",
        F.coalesce("lat", "center.lat").alias("lat"),
        F.coalesce("lon", "center.lon").alias("lon"),
        F.size("tags").alias("n_tags"),
        F.regexp_extract("path", r"bucket=(\d+)/", 1).cast("bigint").alias("bucket"),
        "pos",
    )


@query(
    f"""SELECT 10000000000 + ord AS id, CASE WHEN ord % 4 = 0 THEN 'way' ELSE 'node' END AS type, lat, lon,
   2 + 2 * CAST(name_zh IS NOT NULL AS INT) AS n_tags, CAST(floor(ord / 500) AS BIGINT) AS bucket,
   CAST(row_number() OVER (PARTITION BY floor(ord / 500) ORDER BY ord) - 1 AS INT) AS pos
  FROM ({X.PLACES})"""
)
def scan_elements_any_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dumps on one line and dumps with indented elements, cut into records by the structural index."""
    found = scan_element_lines(spark, compact_elements(spark, sf_dir) + "/*/*.txt", layout="any")
    in_file = Window.partitionBy("path").orderBy("block", "pos")
    return found.select(
        "id",
        "type",
        F.coalesce("lat", "center.lat").alias("lat"),
        F.coalesce("lon", "center.lon").alias("lon"),
        F.size("tags").alias("n_tags"),
        F.regexp_extract("path", r"bucket=(\d+)/", 1).cast("bigint").alias("bucket"),
        (F.row_number().over(in_file) - 1).alias("pos"),
    )


@query(f"SELECT 10000000000 + ord AS id, lower(place) AS place FROM ({X.PLACES}) WHERE lower(place) IN {X.KINDS}")
def filter_place_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.filter_place_types(osm_elements(spark, sf_dir)).select("id", "place")


@query(f"SELECT 10000000000 + ord AS id, lat, lon, zh_name, en_name, place FROM ({X.LABELS})")
def load_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.load_places(osm_elements(spark, sf_dir), order=["id"]).drop("tags")


@query(f"SELECT osm_id, 5 AS n_vertices, cx - h AS first_x, cy - h AS first_y FROM ({X.BUILDING_RINGS})")
def osm_buildings(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = F.get("ring", F.lit(0))
    return E.buildings(osm_elements(spark, sf_dir)).select(
        "osm_id", F.size("ring").alias("n_vertices"), first["x"].alias("first_x"), first["y"].alias("first_y")
    )


@query(X.ADDRESSES)
def osm_address_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.address_points(osm_elements(spark, sf_dir))


@query(f"SELECT admin_city, admin_postcode, admin_district, n_vertices FROM ({X.AREAS})")
def osm_admin_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.admin_areas(osm_elements(spark, sf_dir)).select(
        "admin_city", "admin_postcode", "admin_district", F.size("ring").alias("n_vertices")
    )


@query(
    f"""SELECT (SELECT count(*) FROM ({X.BUILDING_RINGS})) AS buildings, (SELECT count(*) FROM ({X.ADDRESSES})) AS addresses,
   (SELECT count(*) FROM ({X.AREAS})) AS admin_areas"""
)
def osm_class_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.class_counts(osm_elements(spark, sf_dir))


@query(
    f"""SELECT 'way' AS type, osm_id AS id FROM ({X.BUILDINGS}) WHERE building IS NOT NULL
  UNION ALL SELECT CASE WHEN ord % 4 = 0 THEN 'way' ELSE 'node' END, 10000000000 + ord FROM ({X.PLACES}) WHERE place = 'village'
  UNION ALL SELECT 'relation', admin_id FROM ({X.ADMIN}) WHERE city IS NOT NULL
  UNION ALL SELECT 'node', osm_id FROM ({X.ADDRESS_NODES}) WHERE city IS NOT NULL"""
)
def filter_osm_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.filter_tags(osm_elements(spark, sf_dir), ["building", "place=village", "addr:city"]).select("type", "id")


@query(
    f"""SELECT 'way' AS type, osm_id AS id FROM ({X.BUILDINGS}) WHERE name IS NOT NULL
  UNION ALL SELECT CASE WHEN ord % 4 = 0 THEN 'way' ELSE 'node' END, 10000000000 + ord FROM ({X.PLACES})
  UNION ALL SELECT 'relation', admin_id FROM ({X.ADMIN})"""
)
def filter_osm_named(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.filter_named(osm_elements(spark, sf_dir)).select("type", "id")


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey, CASE l_returnflag WHEN 'A' THEN 'W' WHEN 'R' THEN 'R' ELSE 'N' END AS code
  FROM lineitem"""
)
def osm_type_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = F.when(F.col("l_returnflag") == "A", "Way").when(F.col("l_returnflag") == "R", "relation").otherwise("unknown")
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", type_code_of(names).alias("code"))


@query("SELECT o_orderkey, 3600000000 + o_orderkey AS area_id FROM orders")
def osm_area_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", area_id_of(F.col("o_orderkey")).alias("area_id"))


_GRID_POINTS = f"SELECT k, easting AS x, northing AS y FROM ({X.PREMISES})"
_GRID_LABELS = f"SELECT ord, pe AS x, pn AS y, zh_name, en_name FROM ({X.LABELS})"


@query(
    f"""SELECT p.k, zh_name, en_name, round(dist, 3) AS dist_m FROM ({X.PREMISES}) p
  LEFT JOIN ({X.nearest(_GRID_POINTS, _GRID_LABELS, 'k', RADIUS)}) f ON p.k = f.k"""
)
def nearest_locality(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = derive(spark, sf_dir, X.LABELS.replace(X.PLACES, PLACES))
    found = nearest_within(
        derive(spark, sf_dir, PREMISES).select("k", "easting", "northing"),
        labels,
        RADIUS,
        point_xy=("easting", "northing"),
        label_xy=("pe", "pn"),
        order=["ord"],
        carry={"zh_name": "zh_name", "en_name": "en_name"},
        distance_column="dist_m",
    )
    return found.select("k", "zh_name", "en_name", F.round("dist_m", 3).alias("dist_m"))


def _sub_district_sql() -> str:
    points = X.projected("SELECT k, lat, lon FROM canonical", "k")
    labels = X.projected(X.LABELS, "ord, zh_name, en_name")
    found = X.nearest(
        f"SELECT k, e AS x, n AS y FROM ({points})", f"SELECT ord, e AS x, n AS y, zh_name, en_name FROM ({labels})", "k", RADIUS
    )

    def spliced(address: str, district: str, sub: str, pair: str) -> str:
        return f"""CASE WHEN {district} <> '' AND {sub} <> '' AND strpos({address}, {sub}) = 0 AND strpos({address}, {district}) > 0
          THEN substr({address}, 1, strpos({address}, {district}) - 1) || {pair}
            || substr({address}, strpos({address}, {district}) + length({district})) ELSE {address} END"""

    return f"""WITH canonical AS ({X.canonical('path, pos')}),
      joined AS (SELECT c.*, coalesce(zh_name, village_chi) AS sub_district_chi, coalesce(en_name, village_eng) AS sub_district_eng,
        round(dist, 3) AS sub_district_dist_m FROM canonical c LEFT JOIN ({found}) f ON c.k = f.k)
      SELECT id, lat, lon, village_eng, sub_district_chi, sub_district_eng, sub_district_dist_m,
        {spliced('address_chi', 'district_chi', 'sub_district_chi', "district_chi || ' ' || sub_district_chi")} AS address_chi,
        {spliced('address_eng', 'district_eng', 'sub_district_eng', "sub_district_eng || ' ' || district_eng")} AS address_eng
      FROM joined"""


@query(_sub_district_sql())
def derive_sub_district(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole way: features -> canonical rows -> nearest label -> village name -> splice."""
    places = E.load_places(place_elements(spark, sf_dir), order=["id"])
    rows = canonicalize_features(address_features(spark, sf_dir))
    out = derive_localities(rows, places, RADIUS, inject_into_address=True, order=["id"])
    return out.select(
        "id", "lat", "lon", "village_eng", "sub_district_chi", "sub_district_eng",
        F.round("sub_district_dist_m", 3).alias("sub_district_dist_m"), "address_chi", "address_eng",
    )


@query(
    f"""SELECT CASE WHEN sub_district_dist_m IS NOT NULL THEN 'geographic'
   WHEN sub_district_chi IS NOT NULL OR sub_district_eng IS NOT NULL THEN 'village' ELSE 'none' END AS provenance,
   count(*) AS cnt FROM ({_sub_district_sql()}) GROUP BY 1"""
)
def sub_district_provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return provenance_of(derive_sub_district(spark, sf_dir))


@query(
    f"""SELECT a.addr_osm_id, b.osm_id AS building_osm_id FROM ({X.ADDRESSES}) a
  LEFT JOIN ({X.BUILDING_RINGS}) b ON {X.in_square('a.lon', 'a.lat')}"""
)
def points_in_buildings(spark: SparkSession, sf_dir: str) -> DataFrame:
    addresses = E.address_points(address_elements(spark, sf_dir))
    rings = E.buildings(building_elements(spark, sf_dir))
    return S.points_in_buildings(addresses, rings).select("addr_osm_id", "building_osm_id")


@query(
    f"""SELECT d.addr_osm_id, a.admin_city, a.admin_postcode, a.admin_district FROM ({X.ADDRESSES}) d
  LEFT JOIN ({X.AREAS}) a ON {X.in_area('d.lon', 'd.lat')}"""
)
def points_in_admin(spark: SparkSession, sf_dir: str) -> DataFrame:
    addresses = E.address_points(address_elements(spark, sf_dir))
    areas = E.admin_areas(building_elements(spark, sf_dir).unionByName(admin_elements(spark, sf_dir)))
    return S.points_in_admin(addresses, areas).select("addr_osm_id", "admin_city", "admin_postcode", "admin_district")


@query(
    f"""SELECT d.addr_osm_id, a.admin_city, a.admin_postcode, a.admin_district FROM ({X.ADDRESSES}) d
  LEFT JOIN (SELECT * FROM ({X.AREAS}) WHERE n_vertices = 6) a ON {X.in_area('d.lon', 'd.lat')}"""
)
def points_in_relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Areas put together from the ways of relations: the same matches as for areas drawn as one ring."""
    addresses = E.address_points(address_elements(spark, sf_dir))
    areas = E.admin_areas(with_relation_rings(admin_relations(spark, sf_dir)))
    return S.points_in_admin(addresses, areas).select("addr_osm_id", "admin_city", "admin_postcode", "admin_district")


@query(
    f"""SELECT d.addr_osm_id, b.osm_id AS building_osm_id, d.addr_housenumber, d.addr_street,
   coalesce(d.addr_district, a.admin_district) AS addr_district, coalesce(d.addr_city, a.admin_city) AS addr_city,
   coalesce(d.addr_postcode, a.admin_postcode) AS addr_postcode, d.lon, d.lat
  FROM ({X.ADDRESSES}) d LEFT JOIN ({X.BUILDING_RINGS}) b ON {X.in_square('d.lon', 'd.lat')}
  LEFT JOIN ({X.AREAS}) a ON {X.in_area('d.lon', 'd.lat')}"""
)
def spatial_enrich_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.spatial_enrich_elements(osm_elements(spark, sf_dir))


@query(
    f"""SELECT d.addr_osm_id, b.osm_id AS building_osm_id, nullif(d.addr_housenumber, '') AS addr_housenumber, nullif(d.addr_street, '') AS addr_street,
   nullif(coalesce(d.addr_district, a.admin_district), '') AS addr_district, nullif(coalesce(d.addr_city, a.admin_city), '') AS addr_city,
   nullif(coalesce(d.addr_postcode, a.admin_postcode), '') AS addr_postcode, d.lon, d.lat
  FROM ({X.ADDRESSES}) d LEFT JOIN ({X.BUILDING_RINGS}) b ON {X.in_square('d.lon', 'd.lat')}
  LEFT JOIN ({X.AREAS}) a ON {X.in_area('d.lon', 'd.lat')}"""
)
def write_enriched_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The enriched table as CSV, read back: empty texts are empty fields."""
    enriched, path = S.spatial_enrich_elements(osm_elements(spark, sf_dir)), scratch_path(spark, "enriched")
    S.write_enriched(enriched, path)
    return spark.read.schema(enriched.schema).option("header", True).csv(path)


_L_SHAPES = f"SELECT x0, y0, x0 + w AS x1, y0 + h AS y1, x0 + w / 2 AS xc, y0 + h / 2 AS yc, admin_id FROM ({X.ADMIN})"
_CORNERS = [("cx - h", "cy - h"), ("cx + h", "cy - h"), ("cx + h", "cy + h"), ("cx - h", "cy + h")]
_AREA_CORNERS = [
    ("x0", "y0"), ("x0 + w", "y0"), ("x0 + w", "y0 + h / 2"), ("x0 + w / 2", "y0 + h / 2"), ("x0 + w / 2", "y0 + h"), ("x0", "y0 + h"),
]


def _located() -> str:
    parts = [f"SELECT 'node' AS type, osm_id AS id, lon AS x, lat AS y FROM ({X.ADDRESS_NODES}) WHERE lon IS NOT NULL"]
    parts.append(f"SELECT CASE WHEN ord % 4 = 0 THEN 'way' ELSE 'node' END, 10000000000 + ord, lon, lat FROM ({X.PLACES})")
    for i, (x, y) in enumerate(_CORNERS):
        only = "" if i < 2 else " WHERE closed"
        parts.append(f"SELECT 'way', osm_id, {x}, {y} FROM ({X.BUILDINGS}){only}")
    parts += [f"SELECT 'relation', admin_id, {x}, {y} FROM ({X.ADMIN})" for x, y in _AREA_CORNERS]
    return " UNION ALL ".join(parts)


@query(
    f"SELECT DISTINCT e.type, e.id FROM ({_located()}) e JOIN ({_L_SHAPES}) a ON {X.in_area('e.x', 'e.y')}"
)
def elements_in_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    from placeweave.operators.polygons import ring_of

    areas = admin_elements(spark, sf_dir).select(ring_of(F.col("geometry")).alias("ring"))
    return E.elements_in_area(osm_elements(spark, sf_dir), areas).select("type", "id")
