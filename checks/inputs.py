"""Address, place, polygon, feature and entity inputs derived from the given tables.

The SQL texts run unchanged in Spark and in the checking engine, so each side starts from the same rows; anything
nested (JSON, maps, rings) is then built here in Spark only, and the checking SQL works from the flat rows.
"""

from __future__ import annotations

from string import Formatter

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from placeweave.session import scratch_path

FEATURES_PER_FILE = 2000

# Rows of a table that one task makes inputs from, and the most tasks for one table.
ROWS_PER_TASK = 1 << 14
DOCUMENTS_PER_TASK = 1 << 12
MOST_TASKS = 1024

# One row per address with everything that goes into its feature, and which shape each polymorphic member takes.
PREMISES = """
SELECT c_custkey AS k,
 CASE WHEN c_custkey % 17 = 3 THEN NULL ELSE 'CSU' || CAST(CAST(floor(c_custkey / 2) AS BIGINT) AS STRING) END AS csu,
 CASE WHEN c_custkey % 34 = 3 THEN NULL WHEN c_custkey % 51 = 20 THEN ''
      ELSE 'GEO' || CAST(c_custkey AS STRING) END AS geo,
 CAST(800000 + (c_custkey*7919) % 60000 AS DOUBLE) AS easting,
 CAST(800000 + (c_custkey*104729) % 45000 AS DOUBLE) AS northing,
 CASE WHEN c_custkey % 102 = 20 THEN NULL
      ELSE CAST(113.85 AS DOUBLE) + ((c_custkey*7919) % 52000)/CAST(100000 AS DOUBLE) END AS lon,
 CASE WHEN c_custkey % 102 = 20 THEN NULL
      ELSE CAST(22.20 AS DOUBLE) + ((c_custkey*104729) % 36000)/CAST(100000 AS DOUBLE) END AS lat,
 split_part('SHA TIN DISTRICT|Tai Po Dist.|CENTRAL & WESTERN|yuen long|油尖旺區|Tai-Po District|ATLANTIS', '|',
            CAST(c_nationkey % 7 + 1 AS INT)) AS district,
 split_part('SHA TIN DISTRICT|TAI PO DISTRICT|CENTRAL & WESTERN|YUEN LONG|YAU TSIM MONG DISTRICT|NORTH|ATLANTIS', '|',
            CAST(c_nationkey % 7 + 1 AS INT)) AS district_eng,
 split_part('沙田區|大埔區|中西區|元朗區|油尖旺區|北區|', '|', CAST(c_nationkey % 7 + 1 AS INT)) AS district_chi,
 CASE WHEN c_custkey % 11 <> 0 THEN split_part('HK|KLN|NT|XX', '|', CAST(c_custkey % 4 + 1 AS INT)) END AS region,
 CASE WHEN c_custkey % 3 <> 2 THEN 'object' WHEN c_custkey % 2 = 0 THEN 'text' ELSE 'none' END AS block_kind,
 CASE WHEN c_custkey % 4 <> 0 THEN substr('ABCDEFGHIJ', CAST(c_custkey % 10 + 1 AS INT), 1) END AS block_no,
 split_part('BLK|HSE|TOWER|座|', '|', CAST(c_custkey % 5 + 1 AS INT)) AS block_desc,
 CASE WHEN c_custkey % 4 = 1 THEN '' WHEN c_custkey % 4 <> 2 THEN c_name END AS building_eng,
 CASE WHEN c_custkey % 8 = 3 THEN translate(c_name, '0123456789', '０１２３４５６７８９')
      WHEN c_custkey % 4 = 1 THEN '' WHEN c_custkey % 4 <> 2 THEN c_name END AS building_eng_raw,
 CASE WHEN c_custkey % 4 = 1 THEN '' WHEN c_custkey % 4 <> 2 THEN '大廈' || CAST(c_custkey AS STRING) END AS building_chi,
 split_part('none|object|phased|text', '|', CAST(c_custkey % 4 + 1 AS INT)) AS estate_kind,
 'Estate ' || c_mktsegment AS estate_eng,
 '邨' || c_mktsegment AS estate_chi,
 'Phase ' || CAST(c_custkey % 3 + 1 AS STRING) AS phase_eng,
 '第' || CAST(c_custkey % 3 + 1 AS STRING) || '期' AS phase_chi,
 CASE WHEN c_custkey % 7 = 0 THEN 'object' ELSE 'none' END AS phase_kind,
 CASE WHEN c_custkey % 6 = 0 THEN 'object' WHEN c_custkey % 6 = 1 THEN 'text' ELSE 'none' END AS village_kind,
 'Village ' || CAST(c_nationkey AS STRING) AS village_eng,
 '村' || CAST(c_nationkey AS STRING) AS village_chi,
 split_part('none|name|other|text|numbered', '|', CAST(c_custkey % 5 + 1 AS INT)) AS street_kind,
 'Street ' || CAST(c_nationkey AS STRING) AS street_eng,
 '街' || CAST(c_nationkey AS STRING) AS street_chi,
 CAST(c_custkey % 200 + 1 AS STRING) AS no_from,
 CASE WHEN c_custkey % 2 = 0 THEN CAST(c_custkey % 200 + 3 AS STRING) END AS no_to
FROM {customer}
"""

# Locality labels.
PLACES = """
SELECT p_partkey AS ord,
 CAST(800000 + (p_partkey*15485863) % 60000 AS DOUBLE) AS pe,
 CAST(800000 + (p_partkey*32452843) % 45000 AS DOUBLE) AS pn,
 CAST(113.85 AS DOUBLE) + ((p_partkey*15485863) % 52000)/CAST(100000 AS DOUBLE) AS lon,
 CAST(22.20 AS DOUBLE) + ((p_partkey*32452843) % 36000)/CAST(100000 AS DOUBLE) AS lat,
 split_part('suburb|Quarter|neighbourhood|village|town|region|city', '|', CAST(p_size % 7 + 1 AS INT)) AS place,
 CASE WHEN p_partkey % 5 <> 0 THEN '地' || CAST(p_partkey AS STRING) END AS name_zh,
 CASE WHEN p_partkey % 5 <> 0 THEN 'Place ' || CAST(p_partkey AS STRING) END AS name_en,
 CASE WHEN p_partkey % 10 = 0 THEN '旺角 Mong Kok' ELSE 'Mong Kok' END AS name
FROM {part}
"""

# Square buildings of half-width h; a few have too few vertices, an empty tag, or a postcode that makes them areas too.
BUILDINGS = """
SELECT s_suppkey AS osm_id,
 CAST(113.85 AS DOUBLE) + ((s_suppkey*7927) % 52000)/CAST(100000 AS DOUBLE) AS cx,
 CAST(22.20 AS DOUBLE) + ((s_suppkey*104723) % 36000)/CAST(100000 AS DOUBLE) AS cy,
 CAST(0.02 AS DOUBLE) AS h,
 CASE WHEN s_suppkey % 10 = 9 THEN '' ELSE 'yes' END AS building,
 CASE WHEN s_suppkey % 2 = 0 THEN s_name END AS name,
 CASE WHEN s_suppkey % 7 = 0 THEN 'BP' || CAST(s_suppkey AS STRING) END AS postcode,
 s_suppkey % 25 <> 7 AS closed
FROM {supplier}
"""

# L-shaped administrative areas on a 5 x 5 grid.
ADMIN = """
SELECT CAST(n_nationkey AS BIGINT) AS admin_id, n_name AS name,
 CAST(113.85 AS DOUBLE) + (n_nationkey % 5)*CAST(0.104 AS DOUBLE) AS x0,
 CAST(22.20 AS DOUBLE) + CAST(floor(n_nationkey/5) AS INT)*CAST(0.072 AS DOUBLE) AS y0,
 CAST(0.104 AS DOUBLE) AS w, CAST(0.072 AS DOUBLE) AS h,
 CASE WHEN n_nationkey % 2 = 0 THEN 'District ' || CAST(n_nationkey AS STRING) END AS district,
 CASE WHEN n_nationkey % 3 = 0 THEN 'City ' || CAST(n_nationkey AS STRING) END AS city,
 CASE WHEN n_nationkey % 4 = 0 THEN 'AP' || CAST(n_nationkey AS STRING) END AS postcode
FROM {nation}
"""

# Address tags of the address nodes; positions and district come from PREMISES.
ADDRESS_NODES = """
SELECT c_custkey AS osm_id,
 CASE WHEN c_custkey % 102 = 20 THEN NULL
      ELSE CAST(113.85 AS DOUBLE) + ((c_custkey*7919) % 52000)/CAST(100000 AS DOUBLE) END AS lon,
 CASE WHEN c_custkey % 102 = 20 THEN NULL
      ELSE CAST(22.20 AS DOUBLE) + ((c_custkey*104729) % 36000)/CAST(100000 AS DOUBLE) END AS lat,
 CASE WHEN c_custkey % 13 <> 0 THEN CAST(c_custkey % 300 AS STRING) END AS housenumber,
 'Street ' || CAST(c_nationkey AS STRING) AS street,
 CASE WHEN c_custkey % 4 <> 0 THEN 'P' || CAST(c_custkey % 100 AS STRING) END AS postcode,
 CASE WHEN c_custkey % 5 = 0 THEN '' WHEN c_custkey % 5 <> 1 THEN 'Hong Kong' END AS city,
 CASE WHEN c_custkey % 3 <> 0 THEN 'D' || CAST(c_nationkey AS STRING) END AS district
FROM {customer}
"""

# Entities that already exist.
ENTITIES = """
SELECT 'place-' || CAST(s_suppkey AS STRING) AS slug,
 CASE WHEN s_suppkey % 3 = 0 THEN '' ELSE 'Place ' || CAST(s_suppkey AS STRING) END AS en,
 CASE WHEN s_suppkey % 4 = 1 THEN '地' || CAST(s_suppkey AS STRING) ELSE '' END AS zh,
 CASE WHEN s_suppkey % 2 = 0 THEN 'poi' ELSE 'estate' END AS category,
 CASE WHEN s_suppkey % 5 = 0 THEN NULL ELSE CAST(s_suppkey AS DOUBLE) / CAST(8 AS DOUBLE) END AS lat,
 CASE WHEN s_suppkey % 5 = 0 THEN NULL ELSE CAST(s_nationkey AS DOUBLE) + CAST(0.5 AS DOUBLE) END AS lon,
 CASE WHEN s_suppkey % 7 = 0 THEN 'survey "' || s_name || '"' ELSE 'gov_hk/ALS-GeoJSON' END AS source,
 '2025-11-21' AS last_updated,
 s_suppkey % 2 = 0 AS tagged,
 CASE WHEN s_suppkey % 4 = 0 THEN 'nominatim://N/1' END AS geometry_ref,
 CASE WHEN s_suppkey % 6 = 0 THEN 'Old ' || CAST(s_nationkey AS STRING) END AS assigned_district
FROM {supplier}
"""

REQUESTS = """
SELECT 'place-' || CAST(p_partkey AS STRING) AS slug,
 CASE WHEN p_partkey % 2 = 1 THEN 'Place ' || CAST(p_partkey AS STRING) END AS name
FROM {part}
"""

HITS = """
SELECT 'Place ' || CAST(l_partkey AS STRING) AS query,
 l_orderkey AS r1, l_linenumber AS r2, l_suppkey AS r3, l_extendedprice AS r4,
 'Place ' || CAST(l_partkey AS STRING) || ', ' || l_returnflag || l_linestatus AS display_name,
 split_part('node|Way|relation|other', '|', CAST(l_linenumber % 4 + 1 AS INT)) AS osm_type,
 CASE WHEN l_linenumber = 7 THEN CAST(0 AS BIGINT) ELSE l_suppkey + 1 END AS osm_id
FROM {lineitem}
"""

DETAILS = """
SELECT s_suppkey + 1 AS osm_id,
 CASE WHEN s_suppkey % 4 = 3 THEN 'none' WHEN s_suppkey % 4 = 2 THEN 'list' ELSE 'object' END AS shape,
 CASE WHEN s_suppkey % 3 = 0 THEN 'Suburb ' || CAST(s_nationkey AS STRING) ELSE '' END AS suburb,
 'City ' || CAST(s_nationkey AS STRING) AS city,
 s_suppkey % 2 = 0 AS has_shape
FROM {supplier}
"""


def fields(sql: str) -> set[str]:
    return {name for _, name, _, _ in Formatter().parse(sql) if name}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(rows: DataFrame, per_task: int = ROWS_PER_TASK) -> DataFrame:
    """The same rows over as many tasks as their number asks for: a row group of a file is read by one task, however many
    rows it holds, and everything made from its rows would stay in that task. Counting reads no columns."""
    n = min(-(-rows.count() // per_task), MOST_TASKS)
    return rows.repartition(n) if n > 1 else rows


def derive(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    return spark.sql(sql, **{name: spread(table(spark, sf_dir, name)) for name in fields(sql)})


def plain(sql: str) -> str:
    """The same text for an engine where the tables are registered under their own names."""
    return sql.format(**{name: name for name in fields(sql)})


# ---- features -------------------------------------------------------------------------------------------------


def _object(kind: str, *members: Column) -> Column:
    return F.when(F.col(kind) != "none", F.to_variant_object(F.struct(*members)))


def _text(kind: str, value: Column) -> Column:
    return F.when(F.col(kind) == "text", value.cast("variant"))


def _language_block(lang: str) -> Column:
    s = "chi" if lang == "Chi" else "eng"
    c = F.col
    phase = F.when(c("estate_kind") == "phased", F.struct(c(f"phase_{s}").alias("PhaseName")))
    estate = F.coalesce(
        _text("estate_kind", c(f"estate_{s}")),
        _object("estate_kind", c(f"estate_{s}").alias("EstateName"), phase.alias(f"{lang}Phase")),
    )
    named = F.col("street_kind").isin("name", "numbered")
    numbered = F.col("street_kind") == "numbered"
    street = F.coalesce(
        _text("street_kind", c(f"street_{s}")),
        _object(
            "street_kind",
            F.when(named, c(f"street_{s}")).alias("StreetName"),
            F.when(c("street_kind") == "other", c(f"street_{s}")).alias("Street"),
            F.when(numbered, c("no_from")).alias("BuildingNoFrom"),
            F.when(numbered, c("no_to")).alias("BuildingNoTo"),
        ),
    )
    block = F.coalesce(
        _text("block_kind", F.lit("loose")),
        _object("block_kind", c("block_no").alias("BlockNo"), c("block_desc").alias("BlockDescriptor")),
    )
    village = F.coalesce(
        _text("village_kind", c(f"village_{s}")),
        _object("village_kind", c(f"village_{s}").alias("VillageName")),
    )
    top_phase = F.when(c("phase_kind") == "object", F.struct(F.concat(c(f"phase_{s}"), F.lit("T")).alias("PhaseName")))
    # Now and then the Chinese block leaves its own estate member empty and carries the English one.
    swapped = (c("k") % 9 == 4) & F.lit(lang == "Chi")
    return F.struct(
        c(f"district_{s}").alias(f"{lang}District"),
        c("region").alias("Region"),
        c("building_eng_raw" if s == "eng" else "building_chi").alias("BuildingName"),
        block.alias(f"{lang}Block"),
        top_phase.alias(f"{lang}Phase"),
        F.when(swapped, F.lit("").cast("variant")).otherwise(estate).alias(f"{lang}Estate"),
        *([F.when(swapped, estate).alias("EngEstate")] if lang == "Chi" else []),
        village.alias(f"{lang}Village"),
        street.alias(f"{lang}Street"),
    )


def address_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(k, path, pos, geometry, properties) with JSON text as a feature scan gives it."""
    c = F.col
    rows = derive(spark, sf_dir, PREMISES)
    premises = F.struct(
        F.struct(c("csu").alias("CsuId")).alias("BuildingCsuInformation"),
        c("geo").alias("GeoAddress"),
        _language_block("Chi").alias("ChiPremisesAddress"),
        _language_block("Eng").alias("EngPremisesAddress"),
    )
    properties = F.to_json(
        F.struct(
            c("easting").alias("Easting"),
            c("northing").alias("Northing"),
            F.when(c("k") % 5 == 0, c("k")).alias("Note"),
            F.struct(premises.alias("PremisesAddress")).alias("Address"),
        )
    )
    point = F.array("lon", "lat")
    nested = F.when(c("k") % 3 == 1, F.to_json(F.array(point, F.array(F.lit(1.0), F.lit(2.0)))))
    geometry = F.when(
        c("lon").isNotNull(),
        F.struct(
            F.when(c("k") % 3 == 1, "MultiPoint").otherwise("Point").alias("type"),
            F.coalesce(nested, F.to_json(point)).alias("coordinates"),
        ),
    )
    return rows.select(
        "k",
        F.concat(F.lit("file"), (c("k") % 4).cast("string")).alias("path"),
        F.floor(c("k") / 4).cast("int").alias("pos"),
        geometry.alias("geometry"),
        properties.alias("properties"),
    )


# ---- OSM elements ---------------------------------------------------------------------------------------------


def _vertex(x: Column, y: Column) -> Column:
    return F.struct(y.alias("lat"), x.alias("lon"))


def _tags(**pairs: Column) -> Column:
    entries = [F.struct(F.lit(k.replace("__", ":")).alias("k"), v.cast("string").alias("v")) for k, v in pairs.items()]
    return F.map_from_entries(F.filter(F.array(*entries), lambda e: e["v"].isNotNull()))


_POINT = "struct<lat:double,lon:double>"


def _element(kind, osm_id, tags, lat=None, lon=None, center=None, geometry=None) -> list[Column]:
    none = F.lit(None).cast("double")
    return [
        (F.lit(kind) if isinstance(kind, str) else kind).alias("type"),
        osm_id.cast("bigint").alias("id"),
        (none if lat is None else lat).alias("lat"),
        (none if lon is None else lon).alias("lon"),
        (F.lit(None) if center is None else center).cast(_POINT).alias("center"),
        (F.lit(None) if geometry is None else geometry).cast(f"array<{_POINT}>").alias("geometry"),
        tags.alias("tags"),
    ]


def building_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    corners = [(-1, -1), (1, -1), (1, 1), (-1, 1), (-1, -1)]
    ring = F.array(*[_vertex(c("cx") + i * c("h"), c("cy") + j * c("h")) for i, j in corners])
    geometry = F.when(c("closed"), ring).otherwise(F.slice(ring, 1, 2))
    tags = _tags(building=c("building"), name=c("name"), addr__postcode=c("postcode"))
    return derive(spark, sf_dir, BUILDINGS).select(*_element("way", c("osm_id"), tags, geometry=geometry))


def admin_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    x, y, w, h = c("x0"), c("y0"), c("w"), c("h")
    ring = [(x, y), (x + w, y), (x + w, y + h / 2), (x + w / 2, y + h / 2), (x + w / 2, y + h), (x, y + h)]
    tags = _tags(
        admin_level=F.lit("6"), name=c("name"), addr__district=c("district"), addr__city=c("city"), addr__postcode=c("postcode")
    )
    geometry = F.array(*[_vertex(*v) for v in ring])
    return derive(spark, sf_dir, ADMIN).select(*_element("relation", c("admin_id"), tags, geometry=geometry))


_MEMBERS = "array<struct<type:string,ref:bigint,role:string,geometry:array<struct<lat:double,lon:double>>>>"


def admin_relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The administrative areas as dumps give them: relations of several ways, out of order, some of them backwards, with a
    hole, a way that leads nowhere and a label point, and every third one with a second ring far away."""
    c = F.col
    x, y, w, h = c("x0"), c("y0"), c("w"), c("h")
    corners = [(x, y), (x + w, y), (x + w, y + h / 2), (x + w / 2, y + h / 2), (x + w / 2, y + h), (x, y + h)]

    def way(ref: int, spots, role: str = "outer", kind: str = "way") -> Column:
        line = F.array(*[_vertex(*v) for v in spots])
        return F.struct(F.lit(kind).alias("type"), F.lit(ref).alias("ref"), F.lit(role).alias("role"), line.alias("geometry"))

    far = [(F.lit(10.0) + i, F.lit(10.0) + j) for i, j in ((0, 0), (1, 0), (1, 1), (0, 1), (0, 0))]
    main = F.array(
        way(3, [corners[4], corners[5], corners[0]]),
        way(9, [(x + w / 8, y + h / 8), (x + w / 4, y + h / 8), (x + w / 4, y + h / 4), (x + w / 8, y + h / 8)], "inner"),
        way(1, corners[:3], ""),
        way(8, [(x - 1, y - 1), (x - 2, y - 2)]),
        way(7, corners[:1], "label", "node"),
        way(2, [corners[4], corners[3], corners[2]]),
    )
    rings = F.when(c("admin_id") % 3 == 0, F.concat(main, F.array(way(5, far)))).otherwise(main)
    tags = _tags(
        admin_level=F.lit("6"), name=c("name"), addr__district=c("district"), addr__city=c("city"), addr__postcode=c("postcode")
    )
    rows = derive(spark, sf_dir, ADMIN)
    return rows.select(*_element("relation", c("admin_id"), tags), rings.cast(_MEMBERS).alias("members"))


def address_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    tags = _tags(**{f"addr__{k}": c(k) for k in ("housenumber", "street", "postcode", "city", "district")})
    return derive(spark, sf_dir, ADDRESS_NODES).select(*_element("node", c("osm_id"), tags, c("lat"), c("lon")))


def place_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fourth label is a way that only has a centre."""
    c = F.col
    centred = c("ord") % 4 == 0
    tags = _tags(place=c("place"), name=c("name"), name__zh=c("name_zh"), name__en=c("name_en"))
    return derive(spark, sf_dir, PLACES).select(
        *_element(
            F.when(centred, "way").otherwise("node"),
            c("ord") + 10_000_000_000,
            tags,
            F.when(~centred, c("lat")),
            F.when(~centred, c("lon")),
            F.when(centred, _vertex(c("lon"), c("lat"))),
        )
    )


def osm_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [f(spark, sf_dir) for f in (address_elements, building_elements, admin_elements, place_elements)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ---- entities -------------------------------------------------------------------------------------------------


def entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(slug, entity fields..., body)."""
    c = F.col
    return derive(spark, sf_dir, ENTITIES).select(
        "slug",
        c("slug").alias("id"),
        F.struct("en", "zh").alias("names"),
        "category",
        "lat",
        "lon",
        "source",
        "last_updated",
        F.when(c("tagged"), F.array(F.lit("nominatim"))).alias("tags"),
        "geometry_ref",
        "assigned_district",
        F.lit(None).cast("string").alias("source_version"),
        F.lit("# body\n").alias("body"),
    )


def details(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    address = F.struct("suburb", "city")
    body = (
        F.when(c("shape") == "list", F.to_json(F.struct(F.array(address).alias("address"), c("geojson"))))
        .when(c("shape") == "object", F.to_json(F.struct(address.alias("address"), c("geojson"))))
        .otherwise(F.to_json(F.struct(c("geojson"))))
    )
    geojson = F.when(c("has_shape"), F.struct(F.lit("Point").alias("type")))
    return (
        derive(spark, sf_dir, DETAILS)
        .withColumn("geojson", geojson)
        .select(F.explode(F.array(*[F.lit(x) for x in "NWR"])).alias("osm_code"), "osm_id", F.try_parse_json(body).alias("details"))
    )


# ---- documents on disk ----------------------------------------------------------------------------------------


def write_documents(lines: DataFrame, name: str) -> str:
    """Write ``lines(bucket, pos, line)`` as one text file per bucket, in ``pos`` order, below the shared folder."""
    target = scratch_path(lines.sparkSession, name)
    (
        lines.repartition("bucket")
        .sortWithinPartitions("bucket", "pos")
        .select("bucket", "line")
        .write.partitionBy("bucket")
        .text(target)
    )
    return target


def as_collection(items: DataFrame, head: str, tail: str) -> DataFrame:
    """``items(bucket, pos, item)`` -> the lines of one JSON document per bucket; ``pos`` starts at zero."""
    comma = F.when(F.col("pos") == 0, "").otherwise(",")
    body = items.select("bucket", F.col("pos").cast("bigint").alias("pos"), F.concat(comma, "item").alias("line"))
    ends = items.select("bucket").distinct()
    opening = ends.select("bucket", F.lit(-1).cast("bigint").alias("pos"), F.lit(head).alias("line"))
    closing = ends.select("bucket", F.lit(2**62).alias("pos"), F.lit(tail).alias("line"))
    return body.unionByName(opening).unionByName(closing)


def _feature_text() -> Column:
    return F.concat(
        F.lit('{"type":"Feature","geometry":'),
        F.coalesce(
            F.concat(F.lit('{"type":"'), F.col("geometry.type"), F.lit('","coordinates":'), F.col("geometry.coordinates"), F.lit("}")),
            F.lit("null"),
        ),
        F.lit(',"properties":'),
        F.col("properties"),
        F.lit("}"),
    )


def written_features(spark: SparkSession, sf_dir: str) -> str:
    """Feature collections on disk, ``FEATURES_PER_FILE`` features each, in ``k`` order."""
    feature = _feature_text()
    items = address_features(spark, sf_dir).select(
        F.format_string("%09d", F.floor(F.col("k") / FEATURES_PER_FILE)).alias("bucket"),
        (F.col("k") % FEATURES_PER_FILE).alias("pos"),
        feature.alias("item"),
    )
    return write_documents(as_collection(items, '{"type":"FeatureCollection","features":[', "]}"), "features")


def written_elements(spark: SparkSession, sf_dir: str) -> str:
    """OSM dumps of the place elements on disk."""
    items = place_elements(spark, sf_dir).withColumn("ord", F.col("id") - 10_000_000_000).select(
        F.format_string("%09d", F.floor(F.col("ord") / FEATURES_PER_FILE)).alias("bucket"),
        (F.col("ord") % FEATURES_PER_FILE).alias("pos"),
        F.to_json(F.struct("type", "id", "lat", "lon", "center", "tags")).alias("item"),
    )
    return write_documents(as_collection(items, '{"elements":[', "]}"), "elements")


PER_COMPACT_FILE = 500


def compact_documents(items: DataFrame, member: str) -> DataFrame:
    """``items(bucket, pos, item)`` -> one document per bucket: even buckets on one line, odd ones with items indented by
    eight spaces, and each with another list of objects beside the wanted one."""
    texts = F.array_sort(F.collect_list(F.struct("pos", "item")))
    whole = items.groupBy("bucket").agg(F.transform(texts, lambda t: t["item"]).alias("texts"))
    one_line = F.concat(
        F.lit(f'{{"links":[{{"type":"node","{member}":[{{}}]}}],"{member}":['), F.array_join("texts", ","), F.lit('],"note":{"a":["}"]}}')
    )
    printed = F.concat(
        F.lit(f'{{\n    "name": "a \\"}}{{[",\n    "{member}": [\n        '),
        F.array_join("texts", ",\n        "),
        F.lit("\n    ]\n}\n"),
    )
    line = F.when(F.col("bucket").cast("int") % 2 == 0, one_line).otherwise(printed)
    return whole.select("bucket", F.lit(0).cast("long").alias("pos"), line.alias("line"))


def compact_features(spark: SparkSession, sf_dir: str) -> str:
    items = address_features(spark, sf_dir).select(
        F.format_string("%09d", F.floor(F.col("k") / PER_COMPACT_FILE)).alias("bucket"),
        (F.col("k") % PER_COMPACT_FILE).alias("pos"),
        _feature_text().alias("item"),
    )
    return write_documents(compact_documents(items, "features"), "compact-features")


def compact_elements(spark: SparkSession, sf_dir: str) -> str:
    items = place_elements(spark, sf_dir).withColumn("ord", F.col("id") - 10_000_000_000).select(
        F.format_string("%09d", F.floor(F.col("ord") / PER_COMPACT_FILE)).alias("bucket"),
        (F.col("ord") % PER_COMPACT_FILE).alias("pos"),
        F.to_json(F.struct("type", "id", "lat", "lon", "center", "tags")).alias("item"),
    )
    return write_documents(compact_documents(items, "elements"), "compact-elements")
