"""Small helpers over VARIANT values whose members may be an object, a scalar or missing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

# Texts of empty, zero and false values; a string scalar that merely reads like one still holds something.
_EMPTY_TEXTS = ["{}", "[]", "0", "0.0", "false"]


def holds(text: Column, value: Callable[[], Column]) -> Column:
    """True unless the value with this text is missing, null, empty, zero or false."""
    is_string = F.schema_of_variant(value()) == "STRING"
    return F.when(text.isin(_EMPTY_TEXTS), is_string).otherwise(F.coalesce(text != "", F.lit(False)))


def truthy(value: Column) -> Column:
    return holds(as_text(value), lambda: value)


def either(first: Column, second: Column) -> Column:
    """``first`` when it holds something, else ``second`` as it is."""
    return F.when(truthy(first), first).otherwise(second)


def as_object(value: Column, fields: str) -> Column:
    """Cast to a struct; null when the value is not an object, which doubles as the type test."""
    return F.try_variant_get(value, "$", f"struct<{fields}>")


def as_text(value: Column) -> Column:
    return F.try_variant_get(value, "$", "string")


def non_empty(text: Column) -> Column:
    return F.when(text != "", text)
