"""Text scalars. Everything is a built-in expression except NFKC, which Spark does not offer."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

# Java's \s under (?U) misses four separators that count as white space here.
_WS = r"[\s\x1c-\x1f]"

# The same characters spelled out, which Java matches faster than its Unicode classes.
_WS_CHARS = r"\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"

# ASCII and the two main CJK ideograph blocks are unchanged by NFKC, alone or side by side.
_MAY_CHANGE = r"[^\x00-\x7F㐀-䶿一-鿿]"

# The 18 districts, short English name and Chinese name.
DISTRICTS = {
    "Central & Western": "中西區",
    "Eastern": "東區",
    "Islands": "離島區",
    "Kowloon City": "九龍城區",
    "Kwai Tsing": "葵青區",
    "Kwun Tong": "觀塘區",
    "North": "北區",
    "Sai Kung": "西貢區",
    "Sha Tin": "沙田區",
    "Sham Shui Po": "深水埗區",
    "Southern": "南區",
    "Tai Po": "大埔區",
    "Tsuen Wan": "荃灣區",
    "Tuen Mun": "屯門區",
    "Wan Chai": "灣仔區",
    "Wong Tai Sin": "黃大仙區",
    "Yau Tsim Mong": "油尖旺區",
    "Yuen Long": "元朗區",
}

# Fixed value: words that end a free-text place name.
PLACE_WORDS = "Estate|Court|Garden|Centre|Mansion|Plaza|Tower"


def strip(text: Column) -> Column:
    """Trim every Unicode white-space character, not only U+0020."""
    return F.regexp_replace(text, rf"(?U)^{_WS}+|{_WS}+\z", "")


def _may_change(text: Column) -> Column:
    """Holds for every text that stripping or NFKC could alter (and a few more): a character outside the unchanging
    blocks, or an end at or below U+0020, where all ASCII white space lies."""
    ends = (F.left(text, F.lit(1)) <= " ") | (F.right(text, F.lit(1)) <= " ")
    return text.rlike(_MAY_CHANGE) | ((text != "") & ends)


def normalize_text_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Strip and NFKC-normalise the columns in place, in one Python call per batch.

    A JVM-side screen replaces text that would not change by null before it crosses to Python, so a batch of plain
    ASCII and CJK text moves no string data at all.
    """
    fields = T.StructType([T.StructField(f"t{i}", T.StringType()) for i in range(len(columns))])

    @F.pandas_udf(fields)
    def nfkc(batch: pd.DataFrame) -> pd.DataFrame:
        for name in batch.columns:
            if batch[name].notna().any():
                batch[name] = batch[name].str.strip().str.normalize("NFKC")
        return batch

    screened = F.struct(
        *[F.when(_may_change(F.col(c)), F.col(c)).alias(f"t{i}") for i, c in enumerate(columns)]
    )
    replaced = {c: F.coalesce(F.col("_nfkc")[f"t{i}"], F.col(c)) for i, c in enumerate(columns)}
    return df.withColumn("_nfkc", nfkc(screened)).withColumns(replaced).drop("_nfkc")


def slugify(text: Column) -> Column:
    kept = F.regexp_replace(F.lower(strip(text)), rf"(?U)[^\p{{L}}\p{{N}}_\-\s\x1c-\x1f]", "")
    return F.regexp_replace(kept, rf"(?U){_WS}+", "-")


def split_combined_name(name: Column) -> tuple[Column, Column]:
    """(zh, en) of a combined label such as ``旺角 Mong Kok``; both null when it does not split cleanly."""
    pattern = r"(?U)^([一-鿿·]+)\s+([A-Za-z][A-Za-z0-9'’.\- ]+)\z"
    trimmed = strip(name)
    zh = F.regexp_extract(trimmed, pattern, 1)
    en = F.trim(F.regexp_extract(trimmed, pattern, 2))
    return F.when(zh != "", zh), F.when(en != "", en)


def _district_keys() -> dict[str, str]:
    keys = {}
    for short, chinese in DISTRICTS.items():
        for english in {short.upper(), short.upper().replace("&", "AND")}:
            keys[english] = short
            keys[f"{english} DISTRICT"] = short
        keys[chinese] = short
    return keys


def map_district(text: Column) -> Column:
    """Short district name of an English or Chinese spelling; null when unknown."""
    table = F.create_map(*[F.lit(x) for pair in _district_keys().items() for x in pair])
    key = F.replace(F.upper(strip(text)), F.lit("DIST."), F.lit("DISTRICT"))
    collapsed = F.trim(F.regexp_replace(key, r"[^A-Z0-9一-鿿]+", " "))
    attempts = [key, F.regexp_replace(key, r" DISTRICT\z", ""), collapsed]
    return F.coalesce(*[F.try_element_at(table, a) for a in attempts])


def inject_sub_district(address: Column, district: Column, sub: Column, before_district: bool) -> Column:
    """Put the locality beside the first occurrence of the district; unchanged when there is nothing to do."""
    pair = [sub, district] if before_district else [district, sub]
    at = F.instr(address, district)
    applies = (district != "") & (sub != "") & (F.instr(address, sub) == 0) & (at > 0)
    spliced = F.overlay(address, F.concat_ws(" ", *pair), at, F.length(district))
    return F.when(applies, spliced).otherwise(address)


def village_fallback(sub: Column, village: Column) -> Column:
    return F.coalesce(sub, village)


def extract_place_phrase(text: Column) -> Column:
    """First run of Latin words that ends in a place word, trimmed; null when there is none.

    A match always reaches back to the start of its run, so only run starts are tried: the cost stays linear in the
    text instead of quadratic in the run.
    """
    word = rf"A-Za-z0-9{_WS_CHARS}"
    found = F.regexp_extract(text, rf"(?:^|[^{word}])([{word}]+(?:{PLACE_WORDS}))", 1)
    mentions = reduce(lambda a, b: a | b, [F.contains(text, F.lit(w)) for w in PLACE_WORDS.split("|")])
    return F.when(mentions, strip(F.nullif(found, F.lit(""))))
