"""Entity documents: Markdown with YAML frontmatter."""

from __future__ import annotations

import json
import sys
from collections.abc import Sequence

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..schemas import ENTITY
from .documents import write_text_documents
from .records import existing_paths

# The parser travels with the job, so executors need no copy of this module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Fixed value: frontmatter between dashes, an empty line that rendering puts before the body, and the body.
_DOCUMENT = r"(?s)^---\n(.*?)\n---\n\n?(.*)$"

# The known fields, and every other member as its JSON text, so that a rewrite loses nothing.
DOCUMENT = T.StructType([*ENTITY.fields, T.StructField("extra", T.MapType(T.StringType(), T.StringType()))])


def _scalar_text(value):
    return None if value is None or isinstance(value, (dict, list)) else str(value)


def _number(value):
    """A number, or a text that reads like one."""
    try:
        return None if isinstance(value, (bool, list, dict)) or value is None else float(value)
    except ValueError:
        return None


def _entity_row(front) -> dict:
    front = front if isinstance(front, dict) else {}
    names = front.get("names") if isinstance(front.get("names"), dict) else {}
    tags = front.get("tags")
    row = {f.name: _scalar_text(front.get(f.name)) for f in ENTITY.fields}
    row["names"] = {"en": _scalar_text(names.get("en")), "zh": _scalar_text(names.get("zh"))}
    row["tags"] = [str(t) for t in tags] if isinstance(tags, list) else None
    row["lat"], row["lon"] = _number(front.get("lat")), _number(front.get("lon"))
    known = set(ENTITY.fieldNames())
    row["extra"] = {str(k): json.dumps(v, ensure_ascii=False, sort_keys=True, default=str) for k, v in front.items() if k not in known} or None
    return row


def frontmatter_parser():
    """YAML mapping -> entity fields, for a text column; text that is not a YAML mapping gives all nulls."""

    @F.arrow_udf(DOCUMENT)
    def parse_frontmatter(texts):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_type

        try:
            import yaml
        except ImportError as exc:
            raise ImportError("reading entity documents needs PyYAML") from exc
        loader = getattr(yaml, "CSafeLoader", yaml.SafeLoader)

        def parse(text):
            try:
                return yaml.load(text, Loader=loader) if text else None
            except yaml.YAMLError:
                return None

        rows = [_entity_row(parse(t.as_py())) for t in texts]
        for row in rows:
            row["extra"] = list(row["extra"].items()) if row["extra"] else None
        return pa.array(rows, to_arrow_type(DOCUMENT))

    return parse_frontmatter


def entity_fields(document: Column) -> dict[str, Column]:
    return {
        "frontmatter": F.regexp_extract(document, _DOCUMENT, 1),
        "body": F.regexp_extract(document, _DOCUMENT, 2),
    }


def parse_entity_docs(documents: DataFrame, document: str = "document") -> DataFrame:
    """Replace the ``document`` column by the entity fields and the body."""
    keys = [c for c in documents.columns if c != document]
    split = documents.select(*keys, *[c.alias(n) for n, c in entity_fields(F.col(document)).items()])
    parsed = split.withColumn("e", frontmatter_parser()("frontmatter"))
    return parsed.select(*keys, "e.*", "body")


def read_documents(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(slug, document): one row per ``.md`` file, the slug being the file stem. Paths that do not exist hold none."""
    found = existing_paths(spark, paths)
    if not found:
        return spark.createDataFrame([], "slug string, document string")
    files = spark.read.option("pathGlobFilter", "*.md").text(found, wholetext=True)
    stem = F.regexp_extract("_metadata.file_name", r"^(.*)\.md$", 1)
    return files.select(stem.alias("slug"), F.col("value").alias("document"))


def scan_entity_docs(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    return parse_entity_docs(read_documents(spark, paths))


def known_slugs_of(files: DataFrame, path: str = "path") -> DataFrame:
    """Distinct stems of the ``.md`` paths."""
    slug = F.regexp_extract(path, r"([^/]*)\.md$", 1)
    return files.filter(F.col(path).endswith(".md")).select(slug.alias("slug")).distinct()


def known_slugs(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Distinct file stems of a corpus, from file names alone. Paths that do not exist hold none."""
    found = existing_paths(spark, paths)
    if not found:
        return spark.createDataFrame([], "slug string")
    return known_slugs_of(spark.read.format("binaryFile").option("pathGlobFilter", "*.md").load(found).select("path"))


def _quoted(value: Column) -> Column:
    """A YAML double-quoted scalar (JSON escapes are valid there); ``null`` when missing."""
    return F.coalesce(F.to_json(value.cast("variant")), F.lit("null"))


def render_document(entity: dict[str, Column], body: Column | None = None) -> Column:
    """Frontmatter with sorted keys plus body; optional keys appear only when they hold something.

    ``entity["extra"]``, a map of JSON texts, is written among the rest: parsing and rendering again changes nothing.
    """

    def plain(key: str) -> Column:
        return F.coalesce(entity[key].cast("string"), F.lit("null"))

    lines = {key: _quoted(entity[key]) for key in ("category", "id", "last_updated", "source")}
    lines |= {key: plain(key) for key in ("lat", "lon")}
    lines["names"] = F.concat(F.lit("\n  en: "), _quoted(entity["names_en"]), F.lit("\n  zh: "), _quoted(entity["names_zh"]))
    for key in ("assigned_district", "geometry_ref", "source_version"):
        if key in entity:
            lines[key] = F.when(entity[key].isNotNull(), _quoted(entity[key]))
    if "tags" in entity:
        tags = F.array_join(F.transform(entity["tags"], lambda t: F.concat(F.lit("\n- "), _quoted(t))), "")
        lines["tags"] = F.when(F.size(entity["tags"]) > 0, tags)

    def entry(key: str, value: Column) -> Column:
        gap = "" if key in ("names", "tags") else " "
        return F.when(value.isNotNull(), F.struct(F.lit(key).alias("key"), F.concat(F.lit(f"{key}:{gap}"), value).alias("line")))

    entries = F.array_compact(F.array(*[entry(k, v) for k, v in lines.items()]))
    if "extra" in entity:
        others = F.transform(
            F.map_entries(entity["extra"]),
            lambda e: F.struct(e["key"].alias("key"), F.concat(e["key"], F.lit(": "), e["value"]).alias("line")),
        )
        entries = F.concat(entries, F.coalesce(others, F.array().cast("array<struct<key:string,line:string>>")))
    head = F.array_join(F.transform(F.array_sort(entries), lambda e: e["line"]), "\n")
    if body is None:
        title = F.when(
            F.coalesce(entity["names_zh"], F.lit("")) != "",
            F.concat(entity["names_en"], F.lit(" ("), entity["names_zh"], F.lit(")")),
        ).otherwise(F.coalesce(entity["names_en"], F.lit("")))
        body = F.concat(F.lit("# "), title, F.lit("\n\nShort description.\n"))
    return F.concat(F.lit("---\n"), head, F.lit("\n---\n\n"), F.coalesce(body, F.lit("")))


def rendered(entities: DataFrame) -> DataFrame:
    """(slug, document) of entity rows: ``slug``, the entity fields, and ``body`` and ``extra`` where there are such columns.

    A row without a body gets the one that new documents have.
    """
    c = F.col
    fields = {n: c(n) for n in (*ENTITY.fieldNames(), "extra") if n in entities.columns and n != "names"}
    fields |= {"names_en": c("names.en"), "names_zh": c("names.zh")}
    document = render_document(fields)
    if "body" in entities.columns:
        document = F.when(c("body").isNull(), document).otherwise(render_document(fields, c("body")))
    return entities.select("slug", document.alias("document"))


def write_entity_docs(entities: DataFrame, path: str, create_only: bool = False) -> None:
    """``<slug>.md`` for every entity: new ones only with ``create_only``, else those that exist are rewritten."""
    write_text_documents(rendered(entities), path, "slug", "document", ".md", create_only)
