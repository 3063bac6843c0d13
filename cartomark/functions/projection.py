"""Reference systems: UTM zones, WGS-84 to UTM and back, units and CRS facts."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from cartomark.functions.geometry import WGS84_A, WGS84_F

#: Units of projected systems: code, name, metres (fixed values).
UNITS: list[tuple[str, str, float]] = [
    ("km", "kilometer", 1000.0),
    ("m", "metre", 1.0),
    ("dm", "decimeter", 1 / 10),
    ("cm", "centimeter", 1 / 100),
    ("mm", "millimeter", 1 / 1000),
    ("kmi", "International Nautical Mile", 1852.0),
    ("in", "International Inch", 0.0254),
    ("ft", "International Foot", 0.3048),
    ("yd", "International Yard", 0.9144),
    ("mi", "International Statute Mile", 1609.344),
    ("fath", "International Fathom", 1.8288),
    ("ch", "International Chain", 20.1168),
    ("link", "International Link", 0.201168),
    ("us-in", "U.S. Surveyor's Inch", 1 / 39.37),
    ("us-ft", "U.S. Surveyor's Foot", 0.304800609601219),
    ("us-yd", "U.S. Surveyor's Yard", 0.914401828803658),
    ("us-ch", "U.S. Surveyor's Chain", 20.11684023368047),
    ("us-mi", "U.S. Surveyor's Statute Mile", 1609.347218694437),
    ("ind-yd", "Indian Yard", 0.91439523),
    ("ind-ft", "Indian Foot", 0.30479841),
    ("ind-ch", "Indian Chain", 20.11669506),
]

_N = WGS84_F / (2 - WGS84_F)
_RECTIFYING = WGS84_A / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)
_SCALE = 0.9996
_FALSE_EASTING = 500000.0
_FALSE_NORTHING_SOUTH = 10000000.0
_ECC = 2 * math.sqrt(_N) / (1 + _N)
#: Krueger series to the fourth order of the third flattening (published formulas).
_ALPHA = (
    _N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16 + 41 * _N**4 / 180,
    13 * _N**2 / 48 - 3 * _N**3 / 5 + 557 * _N**4 / 1440,
    61 * _N**3 / 240 - 103 * _N**4 / 140,
    49561 * _N**4 / 161280,
)
_BETA = (
    _N / 2 - 2 * _N**2 / 3 + 37 * _N**3 / 96 - _N**4 / 360,
    _N**2 / 48 + _N**3 / 15 - 437 * _N**4 / 1440,
    17 * _N**3 / 480 - 37 * _N**4 / 840,
    4397 * _N**4 / 161280,
)
_DELTA = (
    2 * _N - 2 * _N**2 / 3 - 2 * _N**3 + 116 * _N**4 / 45,
    7 * _N**2 / 3 - 8 * _N**3 / 5 - 227 * _N**4 / 45,
    56 * _N**3 / 15 - 136 * _N**4 / 35,
    4279 * _N**4 / 630,
)


def utm_zone(lat: Column, lon: Column) -> Column:
    """Zone number with the Norway and Svalbard exceptions; null outside 80S..84N."""
    turned = F.pmod(lon + F.lit(180.0), F.lit(360.0)) - F.lit(180.0)
    plain = (F.floor((turned + 180.0) / 6.0) + 1).cast("int")
    svalbard = (lat >= 72) & (lat <= 84) & (turned >= 0)
    return (
        F.when((lat < -80) | (lat > 84), F.lit(None).cast("int"))
        .when((lat >= 56) & (lat < 64) & (turned >= 3) & (turned < 12), F.lit(32))
        .when(svalbard & (turned < 9), F.lit(31))
        .when(svalbard & (turned < 21), F.lit(33))
        .when(svalbard & (turned < 33), F.lit(35))
        .when(svalbard & (turned < 42), F.lit(37))
        .otherwise(plain)
    )


def utm_epsg(lat: Column, lon: Column) -> Column:
    """``epsg:326zz`` north of the equator, ``epsg:327zz`` south of it."""
    code = F.when(lat >= 0, F.lit(32600)).otherwise(F.lit(32700)) + utm_zone(lat, lon)
    return F.concat(F.lit("epsg:"), code.cast("string"))


def epsg_code(epsg: Column) -> Column:
    return F.regexp_extract(epsg, r"(\d+)$", 1).try_cast("int")


def _central_meridian(code: Column) -> Column:
    return (F.pmod(code, F.lit(100)) * 6 - 183).cast("double")


def _is_south(code: Column) -> Column:
    return F.floor(code / 100) == 327


def _series(coefs: tuple[float, ...], term) -> Column:
    total = F.lit(0.0)
    for j, coef in enumerate(coefs, start=1):
        total = total + F.lit(coef) * term(2.0 * j)
    return total


def _inline(value: Column, use: Callable[[Column], Column]) -> Column:
    return use(value)


def _named(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once; for lambdas, where repeats are not found by themselves."""
    return F.element_at(F.transform(F.array(value), use), 1)


def wgs84_to_utm(lat: Column, lon: Column, code: Column, let: Callable = _inline) -> Column:
    """Easting and northing in the UTM zone of an integer EPSG code."""
    sin_lat = F.sin(F.radians(lat))
    lam = F.radians(lon - _central_meridian(code))
    t = F.sinh(F.atanh(sin_lat) - F.lit(_ECC) * F.atanh(F.lit(_ECC) * sin_lat))
    false_north = F.when(_is_south(code), F.lit(_FALSE_NORTHING_SOUTH)).otherwise(F.lit(0.0))

    def on_sphere(s: Column) -> Column:
        xi = F.atan2(s["t"], F.cos(s["lam"]))
        eta = F.atanh(F.sin(s["lam"]) / F.sqrt(s["t"] * s["t"] + 1.0))
        return let(F.struct(xi.alias("xi"), eta.alias("eta")), on_grid)

    def on_grid(s: Column) -> Column:
        xi, eta = s["xi"], s["eta"]
        east = eta + _series(_ALPHA, lambda k: F.cos(xi * k) * F.sinh(eta * k))
        north = xi + _series(_ALPHA, lambda k: F.sin(xi * k) * F.cosh(eta * k))
        return F.struct(
            (F.lit(_FALSE_EASTING) + F.lit(_SCALE * _RECTIFYING) * east).alias("x"),
            (false_north + F.lit(_SCALE * _RECTIFYING) * north).alias("y"),
        )

    return let(F.struct(t.alias("t"), lam.alias("lam")), on_sphere)


def utm_to_wgs84(x: Column, y: Column, code: Column, let: Callable = _inline) -> Column:
    """Longitude (x) and latitude (y) in degrees from UTM easting and northing."""
    false_north = F.when(_is_south(code), F.lit(_FALSE_NORTHING_SOUTH)).otherwise(F.lit(0.0))
    xi = (y - false_north) / F.lit(_SCALE * _RECTIFYING)
    eta = (x - F.lit(_FALSE_EASTING)) / F.lit(_SCALE * _RECTIFYING)

    def on_sphere(s: Column) -> Column:
        xi, eta = s["xi"], s["eta"]
        xi1 = xi - _series(_BETA, lambda k: F.sin(xi * k) * F.cosh(eta * k))
        eta1 = eta - _series(_BETA, lambda k: F.cos(xi * k) * F.sinh(eta * k))
        return let(F.struct(xi1.alias("xi1"), eta1.alias("eta1")), conformal)

    def conformal(s: Column) -> Column:
        chi = F.asin(F.sin(s["xi1"]) / F.cosh(s["eta1"]))
        lon = _central_meridian(code) + F.degrees(F.atan2(F.sinh(s["eta1"]), F.cos(s["xi1"])))
        return let(F.struct(chi.alias("chi"), lon.alias("lon")), degrees)

    def degrees(s: Column) -> Column:
        lat = s["chi"] + _series(_DELTA, lambda k: F.sin(s["chi"] * k))
        return F.struct(s["lon"].alias("x"), F.degrees(lat).alias("y"))

    return let(F.struct(xi.alias("xi"), eta.alias("eta")), on_sphere)


def is_known_system(code: Column) -> Column:
    """Whether :func:`between_systems` knows an integer EPSG code: WGS-84 degrees or a UTM zone on it."""
    return F.coalesce((code == 4326) | code.between(32601, 32660) | code.between(32701, 32760), F.lit(False))


def between_systems(p: Column, source: Column, target: Column) -> Column:
    """A point ``x, y`` moved between known systems, by way of WGS-84; unmoved where they are equal."""

    plain = F.struct(p["x"].alias("x"), p["y"].alias("y"))
    lonlat = F.when(source == 4326, plain).otherwise(utm_to_wgs84(p["x"], p["y"], source, _named))
    # A transform of one element names the position, so that its long expression stands once.
    there = F.transform(F.array(lonlat), lambda q: F.when(target == 4326, q).otherwise(wgs84_to_utm(q["y"], q["x"], target, _named)))
    return F.when(source == target, plain).otherwise(F.element_at(there, 1))


def unit_lookup(key: Column, by: str = "code", give: str = "metres") -> Column:
    """Look a unit up in the constant table by ``code`` or ``name``; null when absent."""
    at = {"code": 0, "name": 1, "metres": 2}
    pairs = []
    for row in UNITS:
        pairs += [F.lit(row[at[by]]), F.lit(row[at[give]])]
    return F.try_element_at(F.create_map(*pairs), key)


def crs_facts(crs: Column) -> Column:
    """``(epsg, unit, needs_reprojection)`` of an EPSG string or a proj4 string.

    Degrees are always re-projected; so is any system given only as proj4, whose
    unit comes from its ``+units=`` term.
    """
    code = epsg_code(F.when(F.lower(crs).rlike(r"^epsg:\d+$"), crs))
    proj_unit = unit_lookup(F.nullif(F.regexp_extract(crs, r"\+units=(\S+)", 1), F.lit("")), give="name")
    return F.struct(
        F.when(code.isNotNull(), F.lower(crs)).otherwise(crs).alias("epsg"),
        F.when(code == 4326, F.lit("degrees"))
        .when(code.between(32601, 32660) | code.between(32701, 32760) | (code == 3857), F.lit("metre"))
        .when(code.isNull(), proj_unit)
        .alias("unit"),
        F.when(code.isNull(), F.lit(True)).otherwise(code == 4326).alias("needs_reprojection"),
    )
