"""Feature, component, dedup and table queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from placeweave.functions import address as A
from placeweave.operators.dedup import dedup_key as dedup_key_of, first_wins, first_wins_late
from placeweave.operators.profile import fill_rates as fill_rates_of
from placeweave.plans.canonicalize import canonicalize as canonicalize_features
from placeweave.plans.canonicalize import canonicalize_feature as canonicalize_rows
from placeweave.plans.canonicalize import canonicalize_files, parse_features, resolve_features
from placeweave.schemas import CANONICAL
from placeweave.session import landed, scratch_path
from placeweave.sources.canonical import read_canonical, write_canonical
from placeweave.sources.geojson import scan_feature_lines as read_feature_lines, scan_features

from . import expected as X
from .inputs import address_features, compact_features, written_features
from .registry import query

BUCKET = r"bucket=(\d+)/"


def _resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve_features(parse_features(address_features(spark, sf_dir)))


def _both(spark: SparkSession, sf_dir: str, chi, eng=None) -> DataFrame:
    """Apply a component rule to both languages' resolved parts."""
    eng = eng or chi
    return _resolved(spark, sf_dir).select("k", chi(F.col("chi")).alias("chi"), eng(F.col("eng")).alias("eng"))


def _both_sql(chi: str, eng: str) -> str:
    return f"SELECT k, {chi} AS chi, {eng} AS eng FROM ({X.PREMISES})"


def _pieces_sql(name: str) -> str:
    return _both_sql(X.pieces("chi")[name], X.pieces("eng")[name])


@query(
    f"""SELECT CAST(floor(k / 2000) AS BIGINT) AS bucket, CAST(k % 2000 AS INT) AS pos, easting,
  CASE WHEN lon IS NOT NULL THEN CASE WHEN k % 3 = 1 THEN 'MultiPoint' ELSE 'Point' END END AS geometry_type
  FROM ({X.PREMISES})"""
)
def scan_geojson_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = scan_features(spark, written_features(spark, sf_dir) + "/*/*.txt")
    return features.select(
        F.regexp_extract("path", BUCKET, 1).cast("bigint").alias("bucket"),
        "pos",
        F.get_json_object("properties", "$.Easting").cast("double").alias("easting"),
        F.col("geometry.type").alias("geometry_type"),
    )


@query(
    f"""SELECT CAST(floor(k / 500) AS BIGINT) AS bucket, CAST(row_number() OVER (PARTITION BY floor(k / 500) ORDER BY k) - 1 AS INT) AS pos,
  easting, CASE WHEN lon IS NOT NULL THEN CASE WHEN k % 3 = 1 THEN 'MultiPoint' ELSE 'Point' END END AS geometry_type
  FROM ({X.PREMISES})"""
)
def scan_features_any_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents on one line and documents with indented items, cut into records by the structural index."""
    features = read_feature_lines(spark, compact_features(spark, sf_dir) + "/*/*.txt", layout="any")
    in_file = Window.partitionBy("path").orderBy("block", "pos")
    return features.select(
        F.regexp_extract("path", BUCKET, 1).cast("bigint").alias("bucket"),
        (F.row_number().over(in_file) - 1).alias("pos"),
        F.get_json_object("properties", "$.Easting").cast("double").alias("easting"),
        F.col("geometry.type").alias("geometry_type"),
    )


@query(f"SELECT k, lon, lat FROM ({X.PREMISES})")
def feature_point(spark: SparkSession, sf_dir: str) -> DataFrame:
    lon, lat = A.point_of(F.col("coords"))
    return parse_features(address_features(spark, sf_dir)).select("k", lon.alias("lon"), lat.alias("lat"))


@query(f"SELECT k, id, geoaddress FROM ({X.FEATURES})")
def feature_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    props = F.col("props")
    csu = F.try_variant_get(props, f"{A.PREMISES}.BuildingCsuInformation.CsuId", "string")
    geo = F.try_variant_get(props, f"{A.PREMISES}.GeoAddress", "string")
    return parse_features(address_features(spark, sf_dir)).select(
        "k", A.feature_id(csu, geo).alias("id"), A.geo_address(csu, geo).alias("geoaddress")
    )


@query(_both_sql(X.address("chi"), X.address("eng")))
def compose_address(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _both(spark, sf_dir, lambda r: A.compose_address(r, "zh"), lambda r: A.compose_address(r, "en"))


@query(f"SELECT k, {X.REGION} AS region FROM ({X.PREMISES})")
def decode_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _resolved(spark, sf_dir).select("k", A.decode_region(F.col("eng.region")).alias("region"))


@query(_both_sql(X.BLOCK_IN_ADDRESS, X.BLOCK_IN_ADDRESS))
def block_in_address(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _both(spark, sf_dir, A.block_in_address)


@query(_both_sql(X.PICK_BLOCK, X.PICK_BLOCK))
def pick_block(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _both(spark, sf_dir, A.pick_block)


@query(_both_sql("nullif(building_chi, '')", "nullif(building_eng_raw, '')"))
def pick_building(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _both(spark, sf_dir, A.pick_building)


@query(_pieces_sql("estate"))
def pick_estate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _both(spark, sf_dir, A.pick_estate)


@query(_pieces_sql("phase"))
def pick_phase(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _both(spark, sf_dir, A.pick_phase)


@query(_pieces_sql("village"))
def pick_village(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _both(spark, sf_dir, A.pick_village)


@query(_pieces_sql("street"))
def pick_street(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _both(spark, sf_dir, A.pick_street)


@query(_pieces_sql("number"))
def building_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _both(spark, sf_dir, lambda r: A.building_number(r, "zh"), lambda r: A.building_number(r, "en"))


@query(f"SELECT k, geoaddress, {X.CANONICAL_COLUMNS} FROM ({X.FEATURES})")
def canonicalize_feature(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canonicalize_rows(address_features(spark, sf_dir)).select("k", "geoaddress", *CANONICAL.fieldNames())


def _key() -> Column:
    return dedup_key_of(*[F.col(c) for c in ("id", "geoaddress", "lat", "lon", "address_chi", "address_eng")])


@query(f"SELECT k, {X.DEDUP_KEY} AS dedup_key FROM ({X.FEATURES})")
def dedup_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canonicalize_rows(address_features(spark, sf_dir)).select("k", _key().alias("dedup_key"))


@query(f"SELECT k, {X.DEDUP_KEY} AS dedup_key FROM ({X.canonical('path, pos')})")
def dedup_first_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = canonicalize_rows(address_features(spark, sf_dir)).select("k", "path", "pos", _key().alias("dedup_key"))
    return first_wins(rows, "dedup_key", ["path", "pos"]).select("k", "dedup_key")


@query(f"SELECT k, {X.DEDUP_KEY} AS dedup_key FROM ({X.canonical('path, pos')})")
def dedup_first_wins_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows, found by digests and places alone and read again from the stored table."""
    rows = canonicalize_rows(address_features(spark, sf_dir)).select("k", "path", "pos", _key().alias("dedup_key"))
    return first_wins_late(landed(rows, "rows"), "dedup_key", ["path", "pos"]).select("k", "dedup_key")


@query(f"SELECT {X.CANONICAL_COLUMNS} FROM ({X.canonical('k')})")
def canonicalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Collections on disk, read by line -> canonical table; file order is ``k`` order."""
    return canonicalize_files(spark, written_features(spark, sf_dir) + "/*/*.txt", one_feature_per_line=True)


@query(
    f"""SELECT CAST(floor(k / 2000) AS BIGINT) AS bucket, row_number() OVER (PARTITION BY floor(k / 2000) ORDER BY k) - 1 AS pos,
   easting, csu FROM ({X.PREMISES})"""
)
def scan_feature_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same collections read as splittable lines; the order columns rank lines as they stand in the file."""
    lines = read_feature_lines(spark, written_features(spark, sf_dir) + "/*/*.txt")
    place = F.row_number().over(Window.partitionBy("path").orderBy("block", "pos")) - 1
    return lines.withColumn("place", place).select(
        F.regexp_extract("path", BUCKET, 1).cast("bigint").alias("bucket"),
        F.col("place").cast("bigint").alias("pos"),
        F.get_json_object("properties", "$.Easting").cast("double").alias("easting"),
        F.get_json_object("properties", "$.Address.PremisesAddress.BuildingCsuInformation.CsuId").alias("csu"),
    )


_NULL_IF_EMPTY = ", ".join(
    f"nullif({c}, '') AS {c}" if c not in ("lat", "lon", "easting", "northing") else c
    for c in X.CANONICAL_COLUMNS.split(", ")
)


@query(f"SELECT {_NULL_IF_EMPTY} FROM ({X.canonical('path, pos')})")
def read_canonical_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = scratch_path(spark, "canonical") + ".csv"
    write_canonical(canonicalize_features(address_features(spark, sf_dir)), target)
    return read_canonical(spark, target)


def _format_rows(fmt: str) -> str:
    keys = "count(*)" if fmt == "jsonl_keep" else "count(village_chi)"
    return f"SELECT '{fmt}' AS format, count(*) AS n_rows, count(building_eng) AS buildings, {keys} AS village_keys FROM canonical"


@query(
    f"""WITH canonical AS ({X.canonical('path, pos')})
  {' UNION ALL '.join(_format_rows(f) for f in ('parquet', 'jsonl_keep', 'jsonl_drop'))}"""
)
def write_canonical_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parquet and both JSON-lines forms written and read back; JSON shows whether null members were kept."""
    base = scratch_path(spark, "canonical")
    rows = canonicalize_features(address_features(spark, sf_dir))
    write_canonical(rows, base + ".parquet")
    stored = read_canonical(spark, base + ".parquet")
    write_canonical(stored, base + "-keep.jsonl")
    write_canonical(stored, base + "-drop.jsonl", keep_nulls=False)

    def summary(fmt: str, df: DataFrame, village_keys: Column) -> DataFrame:
        return df.agg(
            F.lit(fmt).alias("format"),
            F.count("*").alias("n_rows"),
            F.count("building_eng").alias("buildings"),
            village_keys.alias("village_keys"),
        )

    out = summary("parquet", stored, F.count("village_chi"))
    for fmt in ("keep", "drop"):
        lines = spark.read.text(f"{base}-{fmt}.jsonl")
        row = F.from_json("value", CANONICAL)
        parsed = lines.select(row.alias("r"), "value").select("r.*", "value")
        out = out.unionByName(summary(f"jsonl_{fmt}", parsed, F.count_if(F.col("value").contains('"village_chi":'))))
    return out


@query(
    f"WITH canonical AS ({X.canonical('path, pos')}), total AS (SELECT count(*) AS total FROM canonical) "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(nullif(CAST({c} AS STRING), '')) AS filled, count(*) AS total, "
        f"count(nullif(CAST({c} AS STRING), '')) / CAST(count(*) AS DOUBLE) AS fill_rate FROM canonical"
        for c in X.CANONICAL_COLUMNS.split(", ")
    )
)
def fill_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_rates_of(canonicalize_features(address_features(spark, sf_dir)))
