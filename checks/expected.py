"""Checking SQL: the address rules, the projection and the spatial predicates written out plainly over flat rows."""

from __future__ import annotations

from placeweave.functions import geodesy as G
from placeweave.functions.text import DISTRICTS

from . import inputs

PREMISES = inputs.plain(inputs.PREMISES)
PLACES = inputs.plain(inputs.PLACES)
BUILDINGS = inputs.plain(inputs.BUILDINGS)
ADMIN = inputs.plain(inputs.ADMIN)
ADDRESS_NODES = inputs.plain(inputs.ADDRESS_NODES)
ENTITIES = inputs.plain(inputs.ENTITIES)
REQUESTS = inputs.plain(inputs.REQUESTS)
HITS = inputs.plain(inputs.HITS)
DETAILS = inputs.plain(inputs.DETAILS)

REGION = "CASE region WHEN 'HK' THEN 'Hong Kong Island' WHEN 'KLN' THEN 'Kowloon' WHEN 'NT' THEN 'New Territories' ELSE region END"


def block(word: str) -> str:
    return f"""CASE WHEN block_kind = 'object' THEN
        CASE WHEN block_desc = 'BLK' THEN {word}
             WHEN block_desc = 'HSE' THEN 'House ' || coalesce(block_no, '')
             WHEN block_desc = 'TOWER' THEN 'TOWER ' || coalesce(block_no, '')
             WHEN block_desc = '座' THEN coalesce(block_no, '') || '座'
             ELSE coalesce(block_no, '') END END"""


BLOCK_IN_ADDRESS = block("coalesce(block_no, '') || ' Block'")
# A missing number with no descriptor is a null, not an empty label.
PICK_BLOCK = f"CASE WHEN block_no IS NULL AND block_desc = '' THEN NULL ELSE {block(chr(39) + 'Block ' + chr(39) + ' || coalesce(block_no, ' + chr(39) * 2 + ')')} END"


def pieces(s: str) -> dict[str, str]:
    """SQL of every component of one language (``eng`` or ``chi``)."""
    unit = "號" if s == "chi" else ""
    return {
        "building_raw": "building_eng_raw" if s == "eng" else "building_chi",
        "estate_piece": f"CASE WHEN estate_kind <> 'none' THEN estate_{s} END",
        "estate": f"CASE WHEN estate_kind IN ('object', 'phased') THEN estate_{s} END",
        "phase_piece": f"CASE WHEN estate_kind = 'phased' THEN phase_{s} END",
        "phase": f"CASE WHEN phase_kind = 'object' THEN phase_{s} || 'T' END",
        "village": f"CASE WHEN village_kind <> 'none' THEN village_{s} END",
        "street": f"CASE WHEN street_kind <> 'none' THEN street_{s} END",
        "street_piece": f"CASE WHEN street_kind IN ('name', 'numbered') THEN street_{s} END",
        "number": f"CASE WHEN street_kind = 'numbered' THEN no_from || coalesce('-' || no_to, '') || '{unit}' END",
        "district": f"district_{s}",
    }


def address(s: str) -> str:
    p = pieces(s)
    names = ["building_raw", "estate_piece", "phase_piece", "village", "number", "street_piece", "district"]
    parts = [BLOCK_IN_ADDRESS, *[p[n] for n in names], REGION]
    kept = f"list_filter([{', '.join(parts)}], lambda x: x IS NOT NULL AND x <> '')"
    return f"array_to_string(list_reverse({kept}), ' ')" if s == "chi" else f"array_to_string({kept}, ', ')"


def half_width(sql: str) -> str:
    return f"translate({sql}, '０１２３４５６７８９', '0123456789')"


def _canonical_columns() -> str:
    out = [
        "k",
        "coalesce(nullif(csu, ''), nullif(geo, '')) AS id",
        "coalesce(nullif(geo, ''), nullif(csu, '')) AS geoaddress",
        "'file' || CAST(k % 4 AS STRING) AS path",
        "CAST(floor(k / 4) AS BIGINT) AS pos",
    ]
    for s in ("chi", "eng"):
        p = pieces(s)
        out += [
            f"trim({half_width(address(s))}) AS address_{s}",
            f"{p['phase']} AS phase_{s}",
            f"trim({PICK_BLOCK}) AS block_{s}",
            f"nullif(building_{s}, '') AS building_{s}",
            f"{p['estate']} AS estate_{s}",
            f"{p['village']} AS village_{s}",
            f"{p['street']} AS street_{s}",
        ]
    out += ["lat", "lon", "easting", "northing", "district_chi", "district_eng"]
    return ",\n ".join(out)


FEATURES = f"SELECT {_canonical_columns()} FROM ({PREMISES})"

CANONICAL_COLUMNS = (
    "id, address_chi, address_eng, phase_chi, block_chi, building_chi, estate_chi, village_chi, street_chi, "
    "phase_eng, block_eng, building_eng, estate_eng, village_eng, street_eng, lat, lon, easting, northing, "
    "district_chi, district_eng"
)

DEDUP_KEY = """CASE WHEN id IS NOT NULL THEN 'id::' || id
  WHEN lat IS NOT NULL AND lon IS NOT NULL THEN 'coord::' || CAST(CAST(floor(lat * 1e6 + 0.5) AS BIGINT) AS STRING)
    || ',' || CAST(CAST(floor(lon * 1e6 + 0.5) AS BIGINT) AS STRING)
  ELSE 'addr::' || address_chi || '||' || address_eng END"""


def canonical(order: str) -> str:
    """Deduplicated rows, the first per key in the given order."""
    return f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {DEDUP_KEY} ORDER BY {order}) AS rn
      FROM ({FEATURES})) WHERE rn = 1"""


def projected(source: str, keep: str) -> str:
    """The grid projection step by step over ``source(lat, lon, ...)``; adds e and n."""
    e2w = G.WGS84_F * (2 - G.WGS84_F)
    a, f = G.INTL1924_A, G.INTL1924_F
    e2, b = f * (2 - f), a * (1 - f)
    ep2 = e2 / (1 - e2)
    m0, m2, m4, m6 = G._meridian_terms(e2)
    rx, ry, rz = G.ROTATION_RAD

    def d(v: float) -> str:
        return f"CAST({v!r} AS DOUBLE)"

    def arc(p: str) -> str:
        return f"{d(a)} * ({d(m0)} * {p} + {d(m2)} * sin(2 * {p}) + {d(m4)} * sin(4 * {p}) + {d(m6)} * sin(6 * {p}))"

    steps = [
        f"SELECT *, radians(lat) AS p0, radians(lon) AS l0 FROM ({source})",
        f"SELECT *, {d(G.WGS84_A)} / sqrt(1 - {d(e2w)} * sin(p0) * sin(p0)) AS nn FROM (%s)",
        f"""SELECT *, (nn * cos(p0) * cos(l0) - {d(G.SHIFT_M[0])}) / {d(G.SCALE)} AS x1,
              (nn * cos(p0) * sin(l0) - {d(G.SHIFT_M[1])}) / {d(G.SCALE)} AS y1,
              (nn * {d(1 - e2w)} * sin(p0) - {d(G.SHIFT_M[2])}) / {d(G.SCALE)} AS z1 FROM (%s)""",
        f"""SELECT *, x1 + {d(rz)} * y1 - {d(ry)} * z1 AS x2, y1 - {d(rz)} * x1 + {d(rx)} * z1 AS y2,
              z1 + {d(ry)} * x1 - {d(rx)} * y1 AS z2 FROM (%s)""",
        "SELECT *, sqrt(x2 * x2 + y2 * y2) AS pp FROM (%s)",
        f"SELECT *, atan2(z2 * {d(a)}, pp * {d(b)}) AS th FROM (%s)",
        f"""SELECT *, atan2(z2 + {d(ep2 * b)} * pow(sin(th), 3), pp - {d(e2 * a)} * pow(cos(th), 3)) AS ph,
              atan2(y2, x2) AS lh FROM (%s)""",
        f"""SELECT *, {d(a)} / sqrt(1 - {d(e2)} * sin(ph) * sin(ph)) AS nu, tan(ph) * tan(ph) AS t,
              {d(ep2)} * cos(ph) * cos(ph) AS c, (lh - {d(G.GRID_LON0)}) * cos(ph) AS u FROM (%s)""",
        f"""SELECT {keep},
              {d(G.GRID_E0)} + nu * u * (1 + u*u/6 * (1 - t + c)
                + u*u*u*u/120 * (5 - 18*t + t*t + 72*c - {d(58 * ep2)})) AS e,
              {d(G.GRID_N0)} + ({arc('ph')}) - ({arc(d(G.GRID_LAT0))}) + nu * tan(ph) * u*u * (CAST(0.5 AS DOUBLE)
                + u*u/24 * (5 - t + 9*c + 4*c*c)
                + u*u*u*u/720 * (61 - 58*t + t*t + 600*c - {d(330 * ep2)})) AS n FROM (%s)""",
    ]
    sql = steps[0]
    for s in steps[1:]:
        sql = s % sql
    return sql


KINDS = "('suburb', 'quarter', 'neighbourhood', 'village', 'town', 'region')"

# Usable labels: the combined name stands in for missing ones and only splits when it has both scripts.
LABELS = f"""SELECT ord, pe, pn, lat, lon, lower(place) AS place,
  coalesce(name_zh, CASE WHEN name = '旺角 Mong Kok' THEN '旺角' END) AS zh_name,
  coalesce(name_en, CASE WHEN name = '旺角 Mong Kok' THEN 'Mong Kok' END) AS en_name
 FROM ({PLACES})
 WHERE lower(place) IN {KINDS} AND (name_zh IS NOT NULL OR name = '旺角 Mong Kok')"""


def nearest(points: str, labels: str, key: str, radius: float) -> str:
    """Brute force: (key, zh, en, dist) for every point row (key, x, y) over labels (ord, x, y, zh_name, en_name)."""
    return f"""SELECT {key}, zh_name, en_name, dist FROM (
      SELECT p.{key}, l.zh_name, l.en_name, sqrt((l.x - p.x) * (l.x - p.x) + (l.y - p.y) * (l.y - p.y)) AS dist,
        row_number() OVER (PARTITION BY p.{key}
          ORDER BY sqrt((l.x - p.x) * (l.x - p.x) + (l.y - p.y) * (l.y - p.y)), l.ord) AS rn
      FROM ({points}) p JOIN ({labels}) l
        ON sqrt((l.x - p.x) * (l.x - p.x) + (l.y - p.y) * (l.y - p.y)) <= {radius}) WHERE rn = 1"""


ADDRESSES = f"""SELECT osm_id AS addr_osm_id, lon, lat, housenumber AS addr_housenumber, street AS addr_street,
  postcode AS addr_postcode, city AS addr_city, district AS addr_district
 FROM ({ADDRESS_NODES}) WHERE housenumber IS NOT NULL AND lon IS NOT NULL"""

BUILDING_RINGS = f"SELECT * FROM ({BUILDINGS}) WHERE closed AND building <> ''"

# Administrative areas: the L shapes, and buildings that carry a postcode. cut = the notch corner, null for squares.
AREAS = f"""SELECT x0, y0, x0 + w AS x1, y0 + h AS y1, x0 + w / 2 AS xc, y0 + h / 2 AS yc,
   city AS admin_city, postcode AS admin_postcode, coalesce(district, name) AS admin_district, 6 AS n_vertices
  FROM ({ADMIN})
 UNION ALL
 SELECT cx - h, cy - h, cx + h, cy + h, NULL, NULL, NULL, postcode, name, 5
  FROM ({BUILDINGS}) WHERE closed AND postcode IS NOT NULL"""


def in_square(x: str, y: str) -> str:
    return f"({x} > b.cx - b.h AND {x} < b.cx + b.h AND {y} > b.cy - b.h AND {y} < b.cy + b.h)"


def in_area(x: str, y: str) -> str:
    return f"""({x} > a.x0 AND {x} < a.x1 AND {y} > a.y0 AND {y} < a.y1
      AND (a.xc IS NULL OR NOT ({x} >= a.xc AND {y} >= a.yc)))"""


def district_lookup(text: str) -> str:
    """Short district name of a spelling, as nested CASEs."""
    known = {}
    for short, chinese in DISTRICTS.items():
        for english in {short.upper(), short.upper().replace("&", "AND")}:
            known[english] = known[english + " DISTRICT"] = short
        known[chinese] = short

    def find(expr: str) -> str:
        whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in known.items())
        return f"CASE {expr} {whens} END"

    key = f"replace(upper(trim({text})), 'DIST.', 'DISTRICT')"
    collapsed = f"trim(regexp_replace({key}, '[^A-Z0-9一-鿿]+', ' ', 'g'))"
    return f"coalesce({find(key)}, {find(collapsed)})"


# Fixed value: Unicode white space, as a class of the checking engine's patterns.
WHITE_SPACE = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
