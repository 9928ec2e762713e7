"""Distances and the WGS 84 -> Hong Kong 1980 Grid projection, in column arithmetic."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

EARTH_RADIUS_M = 6371000.0

# Ellipsoid axes and flattenings, grid origin, and the published seven datum parameters.
WGS84_A, WGS84_F = 6378137.0, 1 / 298.257223563
INTL1924_A, INTL1924_F = 6378388.0, 1 / 297.0
GRID_LAT0 = math.radians(22 + 18 / 60 + 43.68 / 3600)
GRID_LON0 = math.radians(114 + 10 / 60 + 42.80 / 3600)
GRID_E0, GRID_N0 = 836694.05, 819069.80
SHIFT_M = (-162.619, -276.959, -161.764)
ROTATION_RAD = tuple(math.radians(v / 3600) for v in (0.067753, -2.243649, -1.158827))
SCALE = 1 - 1.094246e-6


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    half_lat = F.sin(F.radians(lat2 - lat1) / 2)
    half_lon = F.sin(F.radians(lon2 - lon1) / 2)
    a = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon
    return 2 * EARTH_RADIUS_M * F.atan2(F.sqrt(a), F.sqrt(1 - a))


def _meridian_terms(e2: float) -> list[float]:
    return [
        1 - e2 / 4 - 3 * e2**2 / 64 - 5 * e2**3 / 256,
        -(3 * e2 / 8 + 3 * e2**2 / 32 + 45 * e2**3 / 1024),
        15 * e2**2 / 256 + 45 * e2**3 / 1024,
        -(35 * e2**3 / 3072),
    ]


def _let(values: dict[str, Column], body) -> Column:
    """Name intermediate values once. Without it every reuse would copy the whole expression below it."""
    named = F.struct(*[v.alias(n) for n, v in values.items()])
    return F.get(F.transform(F.array(named), body), F.lit(0))


def hk80_grid(lat: Column, lon: Column) -> Column:
    """Struct (easting, northing) in metres of WGS 84 degrees: datum shift, then transverse Mercator of unit scale."""
    e2w = WGS84_F * (2 - WGS84_F)
    a, f = INTL1924_A, INTL1924_F
    e2, b = f * (2 - f), a * (1 - f)
    ep2 = e2 / (1 - e2)
    rx, ry, rz = ROTATION_RAD
    m0, m2, m4, m6 = _meridian_terms(e2)
    lat0, lon0 = GRID_LAT0, GRID_LON0
    origin = a * (m0 * lat0 + m2 * math.sin(2 * lat0) + m4 * math.sin(4 * lat0) + m6 * math.sin(6 * lat0))

    def geocentric(v: Column) -> Column:
        n = WGS84_A / F.sqrt(1 - e2w * v["sin"] * v["sin"])
        values = {
            "x": (n * v["cos"] * F.cos(v["lam"]) - SHIFT_M[0]) / SCALE,
            "y": (n * v["cos"] * F.sin(v["lam"]) - SHIFT_M[1]) / SCALE,
            "z": (n * (1 - e2w) * v["sin"] - SHIFT_M[2]) / SCALE,
        }
        return _let(values, rotated)

    def rotated(v: Column) -> Column:
        values = {
            "x": v["x"] + rz * v["y"] - ry * v["z"],
            "y": v["y"] - rz * v["x"] + rx * v["z"],
            "z": v["z"] + ry * v["x"] - rx * v["y"],
        }
        return _let(values, reduced)

    def reduced(v: Column) -> Column:
        p = F.sqrt(v["x"] * v["x"] + v["y"] * v["y"])
        values = {"p": p, "z": v["z"], "lam": F.atan2(v["y"], v["x"]), "theta": F.atan2(v["z"] * a, p * b)}
        return _let(values, geodetic)

    def geodetic(v: Column) -> Column:
        # Bowring's closed form: exact to far below a millimetre at ground level.
        phi = F.atan2(
            v["z"] + ep2 * b * F.pow(F.sin(v["theta"]), F.lit(3.0)),
            v["p"] - e2 * a * F.pow(F.cos(v["theta"]), F.lit(3.0)),
        )
        return _let({"phi": phi, "lam": v["lam"]}, terms)

    def terms(v: Column) -> Column:
        cos, tan = F.cos(v["phi"]), F.tan(v["phi"])
        values = {
            "phi": v["phi"],
            "nu": a / F.sqrt(1 - e2 * F.sin(v["phi"]) * F.sin(v["phi"])),
            "tan": tan,
            "t": tan * tan,
            "c": ep2 * cos * cos,
            "u": (v["lam"] - lon0) * cos,
        }
        return _let(values, grid)

    def grid(v: Column) -> Column:
        t, c, u, u2 = v["t"], v["c"], v["u"], v["u"] * v["u"]
        arc = a * (m0 * v["phi"] + m2 * F.sin(2 * v["phi"]) + m4 * F.sin(4 * v["phi"]) + m6 * F.sin(6 * v["phi"]))
        east = 1 + u2 / 6 * (1 - t + c) + u2 * u2 / 120 * (5 - 18 * t + t * t + 72 * c - 58 * ep2)
        north = 0.5 + u2 / 24 * (5 - t + 9 * c + 4 * c * c) + u2 * u2 / 720 * (61 - 58 * t + t * t + 600 * c - 330 * ep2)
        return F.struct(
            (GRID_E0 + v["nu"] * u * east).alias("easting"),
            (GRID_N0 + (arc - origin) + v["nu"] * v["tan"] * u2 * north).alias("northing"),
        )

    phi = F.radians(lat)
    return _let({"sin": F.sin(phi), "cos": F.cos(phi), "lam": F.radians(lon)}, geocentric)
