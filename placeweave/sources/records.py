"""JSON documents that hold a list of records, read as splittable text.

A document of any size is cut where its layout says a record starts, so no task holds a whole file:

* ``line``: one record per line, other members of the document on lines of their own;
* ``indent``: the document printed with two spaces a level, records starting at ``\\n    {``;
* ``native``: records printed at the left margin, starting at ``\\n{``;
* ``any``: any layout, one line included, through the structural index of ``blocks``, which reads the text three times.

Every piece is either part of the document's frame or a record that reads as the wanted kind of object. Anything else is
a reject: strict scans stop at it, others leave it to :func:`rejects`. Nothing is dropped without a word.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .blocks import list_items

SEPARATORS = {"line": "\n", "indent": "\n    {", "native": "\n{"}

# Members that stand beside the list in a collection or dump, and the kinds of records.
FRAME = (
    "version generator osm3s timestamp_osm_base timestamp_areas_base copyright name crs bbox features elements "
    "xy_coordinate_resolution totalFeatures numberMatched numberReturned timeStamp description license links"
).split()
KINDS = {"feature": ("Feature",), "element": ("node", "way", "relation")}
MEMBERS = {"feature": "features", "element": "elements"}

# Never part of a JSON document, which holds no bare control characters.
NO_SEPARATOR = "\x00\x1e\x1f\x00"

_LIST_OPENS = r'(?s)"(features|elements)"\s*:\s*\[\s*(\].*)?$'
# What follows the last record of a printed document.
_TAILS = {"indent": r"(?s)(\n    \})\s*\n  \].*$", "native": r"(?s)(\n\})\s*\n\s*\].*$"}


def existing_paths(spark: SparkSession, paths: str | Sequence[str]) -> list[str]:
    """The given paths and globs that match something, sorted, each once."""
    given = [paths] if isinstance(paths, str) else paths
    hadoop, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()

    def found(path: str) -> bool:
        place = hadoop.Path(path)
        matches = place.getFileSystem(conf).globStatus(place)
        return matches is not None and len(matches) > 0

    return sorted({p for p in given if found(p)})


def reader(spark: SparkSession, recursive_glob: str | None = None):
    """A reader that ignores files gone since they were listed."""
    out = spark.read.option("ignoreMissingFiles", True)
    return out.option("recursiveFileLookup", True).option("pathGlobFilter", recursive_glob) if recursive_glob else out


def pieces(spark: SparkSession, paths: str | Sequence[str], kind: str, layout: str = "line", recursive_glob: str | None = None) -> DataFrame:
    """(path, block, pos, json, part): ``part`` is ``record``, ``frame`` or ``reject``.

    ``(path, block, pos)`` sorts like the file: ``pos`` grows within a block, and a block is read by one task.
    """
    found = existing_paths(spark, paths)
    schema = "path string, block long, pos long, json string, part string"
    if not found:
        return spark.createDataFrame([], schema)
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    is_record = F.coalesce(F.try_variant_get(F.try_parse_json("json"), "$.type", "string").isin(*KINDS[kind]), F.lit(False))
    if layout == "any":
        rows = list_items(spark, reader(spark, recursive_glob), found, MEMBERS[kind])
        part = F.when(F.col("whole") & is_record, "record").otherwise("reject")
        return rows.select("path", "block", "pos", "json", part.alias("part"))
    text = reader(spark, recursive_glob).option("lineSep", SEPARATORS[layout]).text(found)
    raw = F.regexp_replace("value", r"(?s)^[\s,]+|[\s,]+$", "")
    if layout != "line":
        opened = F.concat(F.lit("{"), F.regexp_replace(F.regexp_replace("value", _TAILS[layout], "$1"), r"(?s)[\s,]+$", ""))
        raw = F.when(F.col("value").rlike(_LIST_OPENS), F.col("value")).otherwise(opened)
    rows = text.select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("pos"),
        raw.alias("json"),
    )
    return rows.withColumn("part", F.when(is_record, "record").when(_is_frame(F.col("json"), layout), "frame").otherwise("reject"))


def _is_frame(json: Column, layout: str) -> Column:
    opens = json.rlike(_LIST_OPENS)
    if layout != "line":
        return opens
    members = rf'^"({"|".join(FRAME)})"\s*:|^"type"\s*:\s*"FeatureCollection"'
    return opens | json.rlike(r"^$|^\{$|^[\]}][\]}\s,]*$") | json.rlike(members)


def records(spark: SparkSession, paths, kind: str, layout: str = "line", recursive_glob: str | None = None, strict: bool = True) -> DataFrame:
    """(path, block, pos, json) of every record; a reject stops a strict scan."""
    rows = pieces(spark, paths, kind, layout, recursive_glob)
    if not strict:
        return rows.filter("part = 'record'").drop("part")
    # The check is a filter, so no choice of columns prunes it away.
    said = F.concat(F.lit("unreadable record in "), "path", F.lit(": "), F.substring("json", 1, 80))
    stop = F.when(F.col("part") == "reject", F.raise_error(said).cast("boolean")).otherwise(F.col("part") == "record")
    return rows.filter(stop).drop("part")


def rejects(spark: SparkSession, paths, kind: str, layout: str = "line", recursive_glob: str | None = None) -> DataFrame:
    """(path, block, pos, json) of the pieces that are neither records nor frame."""
    return pieces(spark, paths, kind, layout, recursive_glob).filter("part = 'reject'").drop("part")


def _other_files(spark: SparkSession, found: list[str], recursive_glob: str | None) -> list[str]:
    """Files that are packed, or not UTF-8 by what they begin with: a byte order mark or the zero bytes of wider units."""
    path = F.col("_metadata.file_path")
    whole = reader(spark, recursive_glob).option("lineSep", NO_SEPARATOR).text(found)
    head = F.hex(F.substring(F.col("value").cast("binary"), 1, 2))
    packed = path.rlike(r"(?i)\.(gz|bz2|zst|lz4|snappy|deflate)$")
    return [r[0] for r in whole.filter(packed | head.rlike("^(FEFF|FFFE|00|..00)")).select(path).distinct().collect()]


def documents(spark: SparkSession, schema, paths, member: str, recursive_glob: str | None = None, strict: bool = True) -> DataFrame:
    """(path, <member>) of whole documents, one task each.

    A document that is not JSON, or has a member of another type than the schema's, stops a strict scan; otherwise it gives
    what could be read of it. Documents are read as lines that nothing ends, so members kept as JSON text are cut out of
    memory: Spark's reader of several lines goes back to the file for each of them. Only packed files, which it reads once,
    and those in other encodings than UTF-8 are left to it.
    """
    found = existing_paths(spark, paths)
    kept = schema.add("_unread", "string") if "_unread" not in schema.names else schema
    if not found:
        return spark.createDataFrame([], kept).select(F.lit("").alias("path"), member)

    def read(option: str, value, only: Column | None = None) -> DataFrame:
        source = reader(spark, recursive_glob).schema(kept).option(option, value).option("columnNameOfCorruptRecord", "_unread")
        files = source.json(found)
        files = files if only is None else files.filter(only)
        return files.select(F.col("_metadata.file_path").alias("path"), member, "_unread")

    other = _other_files(spark, found, recursive_glob)
    if other:
        is_other = F.col("_metadata.file_path").isin(other)
        rows = read("lineSep", NO_SEPARATOR, ~is_other).unionByName(read("multiLine", True, is_other))
    else:
        rows = read("lineSep", NO_SEPARATOR)
    if not strict:
        return rows.drop("_unread")
    broken = F.col("_unread").isNotNull()
    return rows.filter(~F.when(broken, F.raise_error(F.concat(F.lit("unreadable document "), "path")).cast("boolean")).otherwise(F.lit(False))).drop("_unread")
