"""Entity corpus: candidates, suggestions, new entities, search hits and enrichment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.osm import geometry_ref, osm_type_code
from ..functions.text import extract_place_phrase, slugify
from ..functions.variant import non_empty, truthy
from ..session import landed
from .sizing import spread_key

# Where a new entity's record says it comes from, and its kind.
DEFAULT_SOURCE = "gov_hk/ALS-GeoJSON"
DEFAULT_CATEGORY = "poi"

# Address members that can name the district, best first.
DISTRICT_MEMBERS = ("suburb", "city", "county", "village", "municipality")

SUGGESTION_LIMIT = 200

# A document that holds none of these has no frontmatter.
_IDENTITY = ("id", "names.en", "names.zh", "category", "lat", "lon", "source", "last_updated", "tags", "geometry_ref", "assigned_district", "source_version")


def entity_candidates(features: DataFrame, properties: str = "properties") -> DataFrame:
    """Distinct place names: village names of structured addresses, place phrases of free-text ones."""
    props = F.col(properties)
    # Only an object casts to a struct; its text is looked at only when it has no premises to read.
    address = F.try_variant_get(props, "$.Address", "struct<PremisesAddress: variant>")
    premises = address["PremisesAddress"]
    text = F.when(premises.isNull(), F.try_variant_get(props, "$.Address", "string"))
    absent = premises.isNull() & F.coalesce(text.isin("", "{}", "[]", "0", "0.0", "false"), F.lit(True))

    def village(lang: str) -> Column:
        member = f"{lang}PremisesAddress.{lang}Village.VillageName"
        return F.when(premises.isNotNull(), F.try_variant_get(premises, f"$.{member}", "string")).when(
            absent, F.try_variant_get(props, f"$.PremisesAddress.{member}", "string")
        )

    free_text = F.when(address.isNull() & ~absent, extract_place_phrase(text))
    names = F.array_compact(F.array(non_empty(village("Chi")), non_empty(village("Eng")), free_text))
    return features.select(F.explode(names).alias("name")).distinct()


def fold_separators(slug: Column) -> Column:
    return F.replace(slug, F.lit("_"), F.lit("-"))


def missing_entities(candidates: DataFrame, known: DataFrame, fold: bool = False) -> DataFrame:
    """(name, slug) of the candidates whose slug is not known; ``fold`` treats ``_`` and ``-`` alike."""
    slugged = candidates.select("name", slugify(F.col("name")).alias("slug"))
    if not fold:
        return slugged.join(known.select("slug").distinct(), "slug", "left_anti").select("name", "slug")
    keys = known.select(fold_separators(F.col("slug")).alias("_folded")).distinct()
    return slugged.join(keys, fold_separators(F.col("slug")) == F.col("_folded"), "left_anti").select("name", "slug")


def suggest_entities(candidates: DataFrame, known: DataFrame, limit: int = SUGGESTION_LIMIT, fold: bool = False) -> DataFrame:
    return missing_entities(candidates, known, fold).orderBy("slug", "name").limit(limit)


def suggestion_text(suggestions: DataFrame) -> DataFrame:
    """Add the issue title and body."""
    name, slug = F.col("name"), F.col("slug")
    body = F.concat_ws(
        "\n",
        F.concat(F.lit("Entity name (EN / ZH): "), name),
        F.lit("Entity category: estate or poi"),
        F.lit("Short description:"),
        F.lit("Lat, Lon:"),
        F.lit("Source: gov.hk ALS-GeoJSON"),
        F.concat(F.lit("Suggested slug / id: "), slug),
    )
    return suggestions.withColumns({"title": F.concat(F.lit("Entity Create: "), name), "body": body})


def new_entities(requests: DataFrame, existing: DataFrame, as_of: str) -> DataFrame:
    """Rows for requested entities (slug, en, zh, category, lat, lon, source) that do not exist yet.

    Requests that fold to one slug give one entity, the first by their own columns.
    """
    wanted = requests.withColumn("slug", slugify(F.col("slug")))
    kinds = {"en": "string", "zh": "string", "category": "string", "lat": "double", "lon": "double", "source": "string"}
    wanted = wanted.withColumns({c: F.lit(None).cast(k) for c, k in kinds.items() if c not in requests.columns})
    order = list(kinds)
    fresh = wanted.join(existing.select("slug").distinct(), "slug", "left_anti")
    first = fresh.groupBy("slug").agg(F.min(F.struct(*order)).alias("r"))
    return first.select(
        F.col("slug").alias("id"),
        F.struct(F.col("r.en").alias("en"), F.coalesce("r.zh", F.lit("")).alias("zh")).alias("names"),
        F.coalesce("r.category", F.lit(DEFAULT_CATEGORY)).alias("category"),
        *[F.col(f"r.{c}").alias(c) for c in ("lat", "lon", "source")],
        F.lit(as_of).alias("last_updated"),
    )


def best_candidate(hits: DataFrame, by: str, rank: list[str]) -> DataFrame:
    """The first hit per query; combined before the shuffle."""
    rest = [c for c in hits.columns if c != by]
    return hits.groupBy(by).agg(F.min_by(F.struct(*rest), F.struct(*rank)).alias("hit")).select(by, "hit.*")


def search_topk(hits: DataFrame, by: str, rank: list[str], limit: int) -> DataFrame:
    """The first ``limit`` hits per query; Spark trims each task to the limit before the shuffle."""
    place = F.row_number().over(Window.partitionBy(by).orderBy(*rank))
    return hits.withColumn("position", place).filter(F.col("position") <= limit)


def search_key(query: Column, limit: Column, polygon: Column, countries: Column) -> Column:
    return F.concat(
        F.lit("search::"),
        query,
        F.lit("::limit="),
        limit.cast("string"),
        F.lit("::polygon="),
        polygon.cast("int").cast("string"),
        F.lit("::cc="),
        F.coalesce(countries, F.lit("")),
    )


def details_key(code: Column, osm_id: Column, cls: Column, entrances: Column) -> Column:
    return F.concat(
        F.lit("details::"),
        code,
        F.lit("::"),
        osm_id.cast("string"),
        F.lit("::cls="),
        F.coalesce(cls, F.lit("")),
        F.lit("::entr="),
        F.coalesce(non_empty(entrances.cast("string")), F.lit("")),
    )


def pending_requests(requests: DataFrame, results: DataFrame, key: str = "request_key", force: bool = False) -> DataFrame:
    """One request per key without a stored result, all keys when forced; other columns are those of the least row."""
    rest = [c for c in requests.columns if c != key]
    wanted = best_candidate(requests, key, rest).select(requests.columns) if rest else requests.distinct()
    return wanted if force else wanted.join(results.select(key).distinct(), key, "left_anti")


def cached_requests(requests: DataFrame, results: DataFrame, key: str = "request_key") -> DataFrame:
    return requests.join(results.select(key).distinct(), key, "left_semi")


def changed_snapshots(remote: DataFrame, local: DataFrame, key: str = "url") -> DataFrame:
    """Remote snapshots whose signature has no stored equal; missing parts equal missing parts."""
    parts = ["etag", "last_modified", "content_length"]
    stored = local.select(F.col(key).alias("_key"), *[F.col(p).alias(f"_{p}") for p in parts]).distinct()
    on = F.col(key) == F.col("_key")
    for p in parts:
        on = on & F.col(p).eqNullSafe(F.col(f"_{p}"))
    return remote.join(stored, on, "left_anti")


def assigned_district(details: Column) -> Column:
    """First member that holds something, of the address or of the first address in a list."""
    fields = ", ".join(f"{m}: string" for m in DISTRICT_MEMBERS)
    address = F.coalesce(
        F.try_variant_get(details, "$.address", f"struct<{fields}>"),
        F.try_variant_get(details, "$.address[0]", f"struct<{fields}>"),
    )
    return F.coalesce(*[non_empty(address[m]) for m in DISTRICT_MEMBERS])


def enrich_entities(
    requests: DataFrame,
    entities: DataFrame,
    hits: DataFrame,
    details: DataFrame,
    *,
    as_of: str,
    rank: list[str],
    fetch_geometry: bool = True,
    source_version: str | None = None,
    distinct_tags: bool = True,
) -> DataFrame:
    """Batch enrichment from landed search hits and details.

    ``requests(slug, name)``; ``entities(slug, <entity fields>, body)``; ``hits(query, <rank>, display_name, osm_type,
    osm_id)``; ``details(osm_code, osm_id, details)``. Each join has at most one right-hand row per key, so an
    often-asked name cannot multiply rows; those sides are landed, so a hot name or element can be split. An entity whose
    document has no frontmatter counts as new. Entities without a hit keep their fields and get ``no_candidates``.
    """
    known = entities.withColumn("_known", F.lit(True))
    asked = requests.select("slug", F.col("name").alias("_name")).join(known, "slug", "left")
    asked = asked.withColumn(
        "_query", F.coalesce(non_empty(F.col("_name")), non_empty(F.col("names.en")), F.col("slug"))
    )

    best = best_candidate(hits.filter(F.col("query").isNotNull()), "query", rank)
    best = best.select(
        F.col("query").alias("_query"), F.lit(True).alias("_hit"), "display_name", "osm_type", "osm_id"
    )
    found = asked.join(landed(best, "best-hits"), "_query", "left")

    # Details are fetched only for hits that say what they are; the other rows get keys that match nothing.
    typed = (F.coalesce("osm_type", F.lit("")) != "") & (F.coalesce("osm_id", F.lit(0)) != 0)
    found = found.withColumn("_code", F.when(F.lit(fetch_geometry) & typed, osm_type_code(F.col("osm_type"))))
    element = spread_key(F.col("osm_id"), F.col("_code").isNotNull(), F.pmod(F.xxhash64("slug"), F.lit(65536)))
    found = found.withColumns({"_element": element, "_letter": F.coalesce("_code", F.lit(""))})
    by_element = details.groupBy(F.col("osm_code").alias("_letter"), F.col("osm_id").alias("_element")).agg(
        F.min_by("details", F.to_json("details")).alias("_details")
    )
    detailed = found.join(landed(by_element, "details"), ["_letter", "_element"], "left")

    ok = F.coalesce("_hit", F.lit(False))
    is_new = F.col("_known").isNull() | F.coalesce(*[F.col(c).cast("string") for c in _IDENTITY]).isNull()
    has_details = ok & F.col("_code").isNotNull()

    def default(column: str, value: Column) -> Column:
        return F.when(ok & is_new, value).otherwise(F.col(column))

    shape = truthy(F.try_variant_get("_details", "$.geojson", "variant"))
    added = F.concat(F.when(has_details & shape, F.array(F.lit("nominatim-polygon"))).otherwise(F.array()), F.array(F.lit("nominatim")))
    tags = F.concat(F.coalesce("tags", F.array().cast("array<string>")), added)
    updates = {
        "id": default("id", F.col("slug")),
        "names": default(
            "names", F.struct(F.coalesce(non_empty(F.col("_name")), F.col("slug")).alias("en"), F.lit("").alias("zh"))
        ),
        "category": default("category", F.lit(DEFAULT_CATEGORY)),
        "source": default("source", F.lit(DEFAULT_SOURCE)),
        "geometry_ref": F.coalesce("geometry_ref", F.when(has_details, geometry_ref(F.col("_code"), F.col("osm_id")))),
        "assigned_district": F.coalesce(
            F.when(has_details, assigned_district(F.col("_details"))), F.col("assigned_district")
        ),
        "tags": F.when(ok, F.array_distinct(tags) if distinct_tags else tags).otherwise(F.col("tags")),
        "last_updated": F.when(ok, F.lit(as_of)).otherwise(F.col("last_updated")),
        "source_version": F.when(ok & F.lit(bool(source_version)), F.lit(source_version)).otherwise(F.col("source_version")),
    }
    status = F.when(ok, "ok").otherwise("no_candidates").alias("status")
    out = detailed.withColumns(updates)
    return out.select(status, *entities.columns, "display_name", "osm_type", "osm_id")
