"""Feature -> canonical column expressions.

One language's address block is read from VARIANT twice: with its members as objects, and with them as text. A member
that is an object there is null in neither, a scalar is null in the first, and a missing one is null in both.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .variant import as_object, as_text, either, holds, non_empty, truthy

# Region codes and their names.
REGION_NAMES = {
    "HK": "Hong Kong Island",
    "KLN": "Kowloon",
    "NT": "New Territories",
}

_PHASE = "PhaseName: string"
_MEMBERS = {
    "Block": "BlockNo: variant, BlockDescriptor: string",
    "Phase": _PHASE,
    "Estate": "EstateName: string, ChiPhase: variant, EngPhase: variant",
    "Village": "VillageName: string",
    "Street": "StreetName: string, Street: string, BuildingNoFrom: variant, BuildingNoTo: variant",
}

_PLAIN = "BuildingName: string, ChiDistrict: string, EngDistrict: string, Region: string"
_OBJECTS = ", ".join([_PLAIN] + [f"{lang}{m}: struct<{f}>" for m, f in _MEMBERS.items() for lang in ("Chi", "Eng")])
_TEXTS = ", ".join(f"{lang}{m}: string" for m in _MEMBERS for lang in ("Chi", "Eng"))

PREMISES = "$.Address.PremisesAddress"


def address_parts(properties: Column, lang: str) -> tuple[Column, Column]:
    """The ``Chi`` or ``Eng`` block with its members as objects, and as texts; null when absent."""
    path = f"{PREMISES}.{lang}PremisesAddress"
    return tuple(F.try_variant_get(properties, path, f"struct<{fields}>") for fields in (_OBJECTS, _TEXTS))


def resolve_parts(properties: Column, lang: str, objects: Column, texts: Column) -> Column:
    """Pick each member's Chi-or-Eng node once, keeping both its object and its text form."""
    path = f"{PREMISES}.{lang}PremisesAddress"

    def node(member: str) -> list[Column]:
        chi, eng = f"Chi{member}", f"Eng{member}"
        # Only a text such as "0" or "{}" needs a look at the value's own type.
        first = holds(texts[chi], lambda: F.try_variant_get(properties, f"{path}.{chi}", "variant"))
        name = member.lower()
        return [
            F.when(first, objects[chi]).otherwise(objects[eng]).alias(name),
            F.when(first, texts[chi]).otherwise(texts[eng]).alias(f"{name}_text"),
        ]

    return F.struct(
        *[c for member in _MEMBERS for c in node(member)],
        objects["BuildingName"].alias("building"),
        F.coalesce(non_empty(objects["ChiDistrict"]), non_empty(objects["EngDistrict"])).alias("district"),
        objects["Region"].alias("region"),
    )


def point_of(coordinates: Column) -> tuple[Column, Column]:
    """(lon, lat) of a point, or of the first point when the coordinates are nested one level."""

    def number(path: str) -> Column:
        """Only a JSON number counts, not a text that reads like one."""
        kind = F.schema_of_variant(F.try_variant_get(coordinates, path, "variant"))
        return F.when(kind != "STRING", F.try_variant_get(coordinates, path, "double"))

    flat, nested = [number(f"$[{i}]") for i in (0, 1)], [number(f"$[0][{i}]") for i in (0, 1)]
    is_flat, is_nested = (p[0].isNotNull() & p[1].isNotNull() for p in (flat, nested))
    lon, lat = (F.when(is_flat, flat[i]).when(is_nested, nested[i]) for i in (0, 1))
    return lon, lat


def geo_address(csu: Column, geo: Column) -> Column:
    return F.coalesce(non_empty(geo), non_empty(csu))


def feature_id(csu: Column, geo: Column) -> Column:
    return F.coalesce(non_empty(csu), non_empty(geo))


def decode_region(region: Column) -> Column:
    names = F.create_map(*[F.lit(x) for pair in REGION_NAMES.items() for x in pair])
    return F.coalesce(F.try_element_at(names, region), region)


def block_label(block: Column, block_word: str) -> Column:
    """Number plus descriptor: Latin descriptors lead, others follow the number."""
    number = F.coalesce(as_text(block["BlockNo"]), F.lit(""))
    descriptor = (
        F.when(block["BlockDescriptor"] == "BLK", block_word)
        .when(block["BlockDescriptor"] == "HSE", "House")
        .otherwise(non_empty(block["BlockDescriptor"]))
    )
    return (
        F.when(descriptor.isNull(), number)
        .when(descriptor.rlike("^[a-zA-Z]+$"), F.concat(descriptor, F.lit(" "), number))
        .otherwise(F.concat(number, descriptor))
    )


def block_in_address(r: Column) -> Column:
    """The word carries a leading space here, so it fails the Latin test and follows the number: ``A Block``."""
    return F.when(r["block"].isNotNull(), block_label(r["block"], " Block"))


def pick_block(r: Column) -> Column:
    bare_null = F.is_variant_null(r["block"]["BlockNo"]) & non_empty(r["block"]["BlockDescriptor"]).isNull()
    return F.when(r["block"].isNotNull() & ~bare_null, block_label(r["block"], "Block"))


def pick_building(r: Column) -> Column:
    return non_empty(r["building"])


def pick_estate(r: Column) -> Column:
    return r["estate"]["EstateName"]


def pick_phase(r: Column, from_estate: bool = False) -> Column:
    top = r["phase"]["PhaseName"]
    return F.coalesce(non_empty(top), phase_in_address(r)) if from_estate else top


def phase_in_address(r: Column) -> Column:
    phase = either(r["estate"]["ChiPhase"], r["estate"]["EngPhase"])
    return as_object(phase, _PHASE)["PhaseName"]


def pick_village(r: Column) -> Column:
    return F.when(r["village"].isNotNull(), r["village"]["VillageName"]).otherwise(r["village_text"])


def pick_street(r: Column) -> Column:
    named = F.coalesce(non_empty(r["street"]["StreetName"]), non_empty(r["street"]["Street"]))
    return F.when(r["street"].isNotNull(), named).otherwise(r["street_text"])


def building_number(r: Column, lang: str) -> Column:
    # A number zero holds nothing; the text "0" does.
    start, end = (F.when(truthy(r["street"][m]), as_text(r["street"][m])) for m in ("BuildingNoFrom", "BuildingNoTo"))
    number = F.when(end.isNotNull(), F.concat(start, F.lit("-"), end)).otherwise(start)
    return F.concat(number, F.lit("號")) if lang == "zh" else number


def compose_address(r: Column, lang: str) -> Column:
    """All present pieces, small to large for ``en`` and large to small for ``zh``; empty text when none."""
    estate = F.when(r["estate"].isNotNull(), r["estate"]["EstateName"]).otherwise(r["estate_text"])
    pieces = F.array(
        block_in_address(r),
        r["building"],
        estate,
        phase_in_address(r),
        pick_village(r),
        building_number(r, lang),
        r["street"]["StreetName"],
        r["district"],
        decode_region(r["region"]),
    )
    kept = F.filter(pieces, lambda p: p.isNotNull() & (p != ""))
    return F.array_join(F.reverse(kept), " ") if lang == "zh" else F.array_join(kept, ", ")
