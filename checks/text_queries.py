"""Text, lookup and distance scalars."""

from __future__ import annotations

import unicodedata

from pyspark.sql import DataFrame, SparkSession, functions as F

from placeweave.functions import text as T
from placeweave.functions.geodesy import haversine_m as haversine
from placeweave.functions.geodesy import hk80_grid

from . import expected as X
from .inputs import DOCUMENTS_PER_TASK, PLACES, PREMISES, derive, spread, table
from .registry import query


@query("SELECT p_partkey, p_name || ' ' || CAST(p_partkey AS STRING) AS name FROM part")
def text_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names turned full-width with ideographic spaces around them come back plain."""
    letters = "abcdefghijklmnopqrstuvwxyz0123456789 "
    wide = "".join(chr(ord(c) + 0xFEE0) for c in letters[:-1]) + "　"
    name = F.concat("p_name", F.lit(" "), F.col("p_partkey").cast("string"))
    padded = F.concat(F.lit("　 "), F.translate(name, letters, wide), F.lit(" "))
    rows = table(spark, sf_dir, "part").select("p_partkey", padded.alias("name"))
    return T.normalize_text_columns(rows, ["name"])


def _compatibility_rows() -> str:
    """(c, plain) for every character that compatibility composition changes beyond the canonical one, from Python's tables."""
    found = []
    for code in range(0x80, 0x110000):
        c = chr(code)
        if not 0xD800 <= code < 0xE000 and unicodedata.normalize("NFKC", c) != unicodedata.normalize("NFC", c):
            plain = " || ".join(f"chr({ord(x)})" for x in unicodedata.normalize("NFKD", c))
            found.append(f"(chr({code}), {plain})")
    return ", ".join(found)


# Characters are replaced one by one, and the engine's own canonical normalisation does the rest.
_NORMALIZED = f"""WITH stripped AS (
   SELECT row_number() OVER () AS r, doc_id, text IS NULL AS missing,
     regexp_replace(text, '^{X.WHITE_SPACE}+|{X.WHITE_SPACE}+$', '', 'g') AS t FROM documents),
  parted AS (SELECT r, string_split(t, '') AS chars FROM stripped),
  one AS (SELECT r, unnest(chars) AS c, unnest(range(len(chars))) AS i FROM parted),
  plain AS (SELECT * FROM (VALUES {_compatibility_rows()}) AS v(c, plain)),
  whole AS (SELECT r, nfc_normalize(string_agg(coalesce(plain, c), '' ORDER BY i)) AS t FROM one LEFT JOIN plain USING (c) GROUP BY r)
  SELECT s.doc_id, CASE WHEN NOT missing THEN md5(coalesce(w.t, '')) END AS text_md5 FROM stripped s LEFT JOIN whole w USING (r)"""


@query(_NORMALIZED)
def text_normalize_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole document texts; the tests compare the function with the Unicode tables too."""
    rows = table(spark, sf_dir, "documents").select("doc_id", "text")
    return T.normalize_text_columns(rows, ["text"]).select("doc_id", F.md5("text").alias("text_md5"))


_SLUG = r"""regexp_replace(regexp_replace(lower(trim({0})), '[^\p{{L}}\p{{N}}_\-\s]', '', 'g'), '\s+', '-', 'g')"""


@query(
    "SELECT p_partkey, "
    + _SLUG.format("'地標 ' || p_name || ' (No. ' || CAST(p_partkey AS STRING) || ')_' || p_brand || ' – ' || p_type")
    + " AS slug FROM part"
)
def slugify(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.concat(
        F.lit("地標 "), "p_name", F.lit(" (No. "), F.col("p_partkey").cast("string"), F.lit(")_"), "p_brand", F.lit(" – "), "p_type"
    )
    return table(spark, sf_dir, "part").select("p_partkey", T.slugify(name).alias("slug"))


@query(
    f"""SELECT ord, CASE WHEN ord % 3 = 0 THEN '地' || CASE WHEN name = 'Mong Kok' THEN '標' ELSE '旺角' END
      WHEN name = '旺角 Mong Kok' THEN '旺角' END AS zh,
   CASE WHEN ord % 3 = 0 THEN 'Place ' || CAST(ord AS STRING) || CASE WHEN name = 'Mong Kok' THEN '' ELSE ' Mong Kok' END
      WHEN name = '旺角 Mong Kok' THEN 'Mong Kok' END AS en
  FROM ({X.PLACES})"""
)
def split_combined_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    longer = F.when(
        F.col("name") == "Mong Kok", F.concat(F.lit(" 地標  Place "), F.col("ord").cast("string"))
    ).otherwise(F.concat(F.lit("地旺角　Place "), F.col("ord").cast("string"), F.lit(" Mong Kok")))
    name = F.when(F.col("ord") % 3 == 0, longer).otherwise(F.col("name"))
    zh, en = T.split_combined_name(name)
    return derive(spark, sf_dir, PLACES).select("ord", zh.alias("zh"), en.alias("en"))


@query(f"SELECT k, {X.district_lookup('district')} AS district, {X.district_lookup('district_chi')} AS district_chi FROM ({X.PREMISES})")
def map_district(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(spark, sf_dir, PREMISES).select(
        "k", *[T.map_district(F.col(c)).alias(c) for c in ("district", "district_chi")]
    )


@query(
    f"""SELECT k, round(2 * 6371000 * atan2(sqrt(a), sqrt(1 - a)), 3) AS dist_m FROM (
   SELECT k, pow(sin(radians(CAST(22.3 AS DOUBLE) - lat) / 2), 2)
     + cos(radians(lat)) * cos(radians(CAST(22.3 AS DOUBLE))) * pow(sin(radians(CAST(114.17 AS DOUBLE) - lon) / 2), 2) AS a
   FROM ({X.PREMISES}))"""
)
def haversine_m(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = haversine(F.col("lat"), F.col("lon"), F.lit(22.3), F.lit(114.17))
    return derive(spark, sf_dir, PREMISES).select("k", F.round(d, 3).alias("dist_m"))


@query(f"SELECT k, round(e, 3) AS easting, round(n, 3) AS northing FROM ({X.projected(X.PREMISES, 'k')})")
def project_hk80(spark: SparkSession, sf_dir: str) -> DataFrame:
    grid = derive(spark, sf_dir, PREMISES).select("k", hk80_grid(F.col("lat"), F.col("lon")).alias("g"))
    return grid.select("k", F.round("g.easting", 3).alias("easting"), F.round("g.northing", 3).alias("northing"))


_SPLICE = f"""SELECT k,
  CAST(k AS STRING) || ' Road, ' || district || CASE WHEN k % 2 = 0 THEN ', ' || district ELSE '' END AS addr,
  CASE WHEN k % 13 = 0 THEN '' WHEN k % 7 = 0 THEN 'Nowhere' ELSE district END AS anchor,
  CASE WHEN k % 11 = 0 THEN NULL WHEN k % 17 = 0 THEN '' WHEN k % 5 = 0 THEN 'Road' ELSE village_eng END AS sub
 FROM ({PREMISES})"""


def _spliced(pair: str) -> str:
    return f"""CASE WHEN anchor <> '' AND sub IS NOT NULL AND sub <> '' AND strpos(addr, sub) = 0 AND strpos(addr, anchor) > 0
      THEN substr(addr, 1, strpos(addr, anchor) - 1) || {pair} || substr(addr, strpos(addr, anchor) + length(anchor))
      ELSE addr END"""


@query(
    "SELECT k, " + _spliced("sub || ' ' || anchor") + " AS eng, " + _spliced("anchor || ' ' || sub") + " AS chi FROM ("
    + _SPLICE.format(customer="customer") + ")"
)
def inject_sub_district(spark: SparkSession, sf_dir: str) -> DataFrame:
    args = [F.col(c) for c in ("addr", "anchor", "sub")]
    return derive(spark, sf_dir, _SPLICE).select(
        "k",
        T.inject_sub_district(*args, before_district=True).alias("eng"),
        T.inject_sub_district(*args, before_district=False).alias("chi"),
    )


@query(f"SELECT k, CASE WHEN k % 2 = 0 THEN 'found' WHEN village_kind <> 'none' THEN village_eng END AS sub FROM ({X.PREMISES})")
def village_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = F.when(F.col("k") % 2 == 0, "found")
    village = F.when(F.col("village_kind") != "none", F.col("village_eng"))
    return derive(spark, sf_dir, PREMISES).select("k", T.village_fallback(found, village).alias("sub"))


_WORDS = "Estate|Court|Garden|Centre|Mansion|Plaza|Tower"


@query(
    f"""SELECT doc_id, nullif(trim(regexp_extract(text || '; Flat 3, Happy ' || source ||
    CASE WHEN doc_id % 3 = 0 THEN ' Garden' WHEN doc_id % 3 = 1 THEN ' Tower 2, Lee Plaza' ELSE '' END,
    '([A-Za-z0-9\\s]+(?:{_WORDS}))', 1), E' \\t\\n\\f\\r'), '') AS phrase FROM documents"""
)
def extract_place_phrase(spark: SparkSession, sf_dir: str) -> DataFrame:
    ending = F.when(F.col("doc_id") % 3 == 0, " Garden").when(F.col("doc_id") % 3 == 1, " Tower 2, Lee Plaza").otherwise("")
    text = F.concat("text", F.lit("; Flat 3, Happy "), "source", ending)
    return spread(table(spark, sf_dir, "documents"), DOCUMENTS_PER_TASK).select("doc_id", T.extract_place_phrase(text).alias("phrase"))
