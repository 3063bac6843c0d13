"""Geometry as columns: boxes, rings, affine transforms, buffers and distances.

A box is four columns or a struct ``(xmin, ymin, xmax, ymax)``; a geometry is a
struct ``(kind, rings)`` whose rings are arrays of ``(x, y)`` structs.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Value that marks a feature whose label must be found spatially (fixed value).
USE_SPATIAL_INDEX = "Use Spatial Index"
#: Inches per metre, converting a scaled map distance to metres (fixed value).
INCHES_PER_METRE = 39.37


def box(xmin: Column, ymin: Column, xmax: Column, ymax: Column) -> Column:
    return F.struct(
        xmin.cast("double").alias("xmin"),
        ymin.cast("double").alias("ymin"),
        xmax.cast("double").alias("xmax"),
        ymax.cast("double").alias("ymax"),
    )


def box_area(b: Column) -> Column:
    return (b["xmax"] - b["xmin"]) * (b["ymax"] - b["ymin"])


def box_intersection_area(a: Column, b: Column) -> Column:
    width = F.least(a["xmax"], b["xmax"]) - F.greatest(a["xmin"], b["xmin"])
    height = F.least(a["ymax"], b["ymax"]) - F.greatest(a["ymin"], b["ymin"])
    return F.greatest(width, F.lit(0.0)) * F.greatest(height, F.lit(0.0))


def boxes_intersect(a: Column, b: Column) -> Column:
    """Closed test: boxes that only touch do intersect."""
    return (
        (a["xmin"] <= b["xmax"])
        & (b["xmin"] <= a["xmax"])
        & (a["ymin"] <= b["ymax"])
        & (b["ymin"] <= a["ymax"])
    )


def box_contains(a: Column, b: Column) -> Column:
    return (
        (a["xmin"] <= b["xmin"])
        & (a["ymin"] <= b["ymin"])
        & (a["xmax"] >= b["xmax"])
        & (a["ymax"] >= b["ymax"])
    )


def boxes_overlap(a: Column, b: Column) -> Column:
    """Strict test: interiors meet and neither box covers the other."""
    return (box_intersection_area(a, b) > 0) & ~box_contains(a, b) & ~box_contains(b, a)


def iou_units(inter: Column, union: Column) -> Column:
    """Intersection over union in whole hundred-thousandths; 0 for an empty union."""
    return F.when(
        union > 0, F.floor(inter / union * F.lit(100000.0) + F.lit(0.5)).cast("bigint")
    ).otherwise(F.lit(0).cast("bigint"))


def iou_percent(units: Column) -> Column:
    """Percentage with three decimals from :func:`iou_units`."""
    return units / F.lit(1000.0)


def box_iou_units(a: Column, b: Column) -> Column:
    inter = box_intersection_area(a, b)
    return iou_units(inter, box_area(a) + box_area(b) - inter)


# --- geometry from coordinates -------------------------------------------------


def ring_from_pairs(pairs: Column) -> Column:
    """Array of ``(x, y)`` from an array of coordinate arrays; extra ordinates drop."""
    return F.transform(
        pairs,
        lambda p: F.struct(p[0].cast("double").alias("x"), p[1].cast("double").alias("y")),
    )


def geometry(kind: Column, rings: Column) -> Column:
    return F.struct(kind.alias("kind"), rings.alias("rings"))


def geometry_from_pairs(kind: str, pairs: Column) -> Column:
    """A point (one pair), line (pairs) or polygon (array of pairs per ring)."""
    if kind == "point":
        return geometry(F.lit(kind), F.array(ring_from_pairs(F.array(pairs))))
    if kind == "line":
        return geometry(F.lit(kind), F.array(ring_from_pairs(pairs)))
    return geometry(F.lit("polygon"), F.transform(pairs, ring_from_pairs))


def geometry_box(geom: Column) -> Column:
    """Bounding box of all vertices."""
    points = F.flatten(geom["rings"])
    xs = F.transform(points, lambda p: p["x"])
    ys = F.transform(points, lambda p: p["y"])
    return box(F.array_min(xs), F.array_min(ys), F.array_max(xs), F.array_max(ys))


def box_ring(b: Column) -> Column:
    """Closed ring around a box."""

    def corner(x: Column, y: Column) -> Column:
        return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))

    return F.array(
        corner(b["xmin"], b["ymin"]),
        corner(b["xmax"], b["ymin"]),
        corner(b["xmax"], b["ymax"]),
        corner(b["xmin"], b["ymax"]),
        corner(b["xmin"], b["ymin"]),
    )


def ring_segments(ring: Column) -> Column:
    """Array of ``(x1, y1, x2, y2)`` between neighbouring vertices."""
    return F.zip_with(
        F.slice(ring, F.lit(1), F.greatest(F.size(ring) - 1, F.lit(0))),
        F.slice(ring, F.lit(2), F.greatest(F.size(ring) - 1, F.lit(0))),
        lambda a, b: F.struct(
            a["x"].alias("x1"), a["y"].alias("y1"), b["x"].alias("x2"), b["y"].alias("y2")
        ),
    )


def geometry_segments(geom: Column) -> Column:
    """All segments of all rings; a polygon ring left open is closed first."""

    def closed(ring: Column) -> Column:
        is_open = (geom["kind"] == "polygon") & (
            F.element_at(ring, 1) != F.element_at(ring, -1)
        )
        return F.when(is_open, F.concat(ring, F.slice(ring, 1, 1))).otherwise(ring)

    return F.flatten(F.transform(geom["rings"], lambda ring: ring_segments(closed(ring))))


# --- affine transforms ----------------------------------------------------------


def pixel_to_coord(t: Column, row: Column, col: Column, offset: float = 0.5) -> Column:
    """Map position of a pixel's centre under ``x = a*col + b*row + c``, ``y = d*col + e*row + f``."""
    c = col + F.lit(offset)
    r = row + F.lit(offset)
    return F.struct(
        (t["a"] * c + t["b"] * r + t["c"]).alias("x"),
        (t["d"] * c + t["e"] * r + t["f"]).alias("y"),
    )


def coord_to_pixel(t: Column, x: Column, y: Column) -> Column:
    """Pixel holding a map position; null when the transform cannot be inverted."""
    det = t["a"] * t["e"] - t["b"] * t["d"]
    dx = x - t["c"]
    dy = y - t["f"]
    col = F.try_divide(t["e"] * dx - t["b"] * dy, det)
    row = F.try_divide(t["a"] * dy - t["d"] * dx, det)
    return F.struct(
        F.floor(row).cast("bigint").alias("row"), F.floor(col).cast("bigint").alias("col")
    )


def pixel_box_to_coord(t: Column, px_bbox: Column) -> Column:
    """Map-space box of a pixel box ``[x0, y0, x1, y1]``; null when there is none."""
    low = pixel_to_coord(t, px_bbox[1], px_bbox[0])
    high = pixel_to_coord(t, px_bbox[3], px_bbox[2])
    return F.when(
        px_bbox.isNotNull() & (F.size(px_bbox) == 4),
        box(
            F.least(low["x"], high["x"]),
            F.least(low["y"], high["y"]),
            F.greatest(low["x"], high["x"]),
            F.greatest(low["y"], high["y"]),
        ),
    )


# --- buffers ----------------------------------------------------------------------


def buffer_radius(scale: Column, dynamic_buffer: float) -> Column:
    """Scale-dependent radius in metres around points and lines."""
    return scale * F.lit(dynamic_buffer) / F.lit(INCHES_PER_METRE)


def grown_box(b: Column, radius: Column) -> Column:
    return box(b["xmin"] - radius, b["ymin"] - radius, b["xmax"] + radius, b["ymax"] + radius)


def disc_intersection_area(distance: Column, radius: Column) -> Column:
    """Area of the lens shared by two discs of equal radius."""
    half = distance / (radius * 2.0)
    return F.when(
        distance < radius * 2.0,
        radius * radius * 2.0 * F.acos(F.least(half, F.lit(1.0)))
        - distance / 2.0 * F.sqrt(F.greatest(radius * radius * 4.0 - distance * distance, F.lit(0.0))),
    ).otherwise(F.lit(0.0))


def disc_iou_units(distance: Column, radius: Column) -> Column:
    inter = disc_intersection_area(distance, radius)
    return iou_units(inter, radius * radius * F.lit(2.0 * math.pi) - inter)


def segment_distance(px: Column, py: Column, s: Column) -> Column:
    """Distance of a point from a segment ``(x1, y1, x2, y2)``."""
    dx = s["x2"] - s["x1"]
    dy = s["y2"] - s["y1"]
    length2 = dx * dx + dy * dy
    along = F.coalesce(
        F.try_divide((px - s["x1"]) * dx + (py - s["y1"]) * dy, length2), F.lit(0.0)
    )
    along = F.greatest(F.lit(0.0), F.least(F.lit(1.0), along))
    ex = px - (s["x1"] + along * dx)
    ey = py - (s["y1"] + along * dy)
    return F.sqrt(ex * ex + ey * ey)


# --- distances on the earth ---------------------------------------------------------

#: WGS-84 ellipsoid and mean earth radius (fixed values).
WGS84_A = 6378137.0
WGS84_F = 1 / 298.257223563
EARTH_RADIUS_KM = 6371.0088


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    p1, p2 = F.radians(lat1), F.radians(lat2)
    h = (
        F.pow(F.sin((p2 - p1) / 2.0), 2)
        + F.cos(p1) * F.cos(p2) * F.pow(F.sin(F.radians(lon2 - lon1) / 2.0), 2)
    )
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(F.least(h, F.lit(1.0))))


def _arc_km(p: Column) -> Column:
    """Length of a geodesic from its arc on the auxiliary sphere, by Vincenty's series."""
    a, b = WGS84_A, WGS84_A * (1 - WGS84_F)
    u = p["cos2_alpha"] * F.lit((a * a - b * b) / (b * b))
    big_a = F.lit(1.0) + u / 16384.0 * (
        F.lit(4096.0) + u * (F.lit(-768.0) + u * (F.lit(320.0) - u * 175.0))
    )
    big_b = u / 1024.0 * (
        F.lit(256.0) + u * (F.lit(-128.0) + u * (F.lit(74.0) - u * 47.0))
    )
    delta = (
        big_b
        * p["sin_sigma"]
        * (
            p["mid"]
            + big_b
            / 4.0
            * (
                p["cos_sigma"] * (p["mid"] * p["mid"] * 2.0 - 1.0)
                - big_b
                / 6.0
                * p["mid"]
                * (p["sin_sigma"] * p["sin_sigma"] * 4.0 - 3.0)
                * (p["mid"] * p["mid"] * 4.0 - 3.0)
            )
        )
    )
    return F.lit(b / 1000.0) * big_a * (p["sigma"] - delta)


def _azimuth_km(s1: Column, c1: Column, s2: Column, c2: Column, length: Column, halvings: int = 60) -> Column:
    """Distance of two points by halving the azimuth at one of them until the other's longitude is met.

    Takes sines and cosines of the reduced latitudes and the difference of the longitudes
    in radians. The points are mirrored and swapped first, so that the one further
    from the equator is the start and lies south; the longitude then grows with the azimuth.
    """
    f = WGS84_F
    swap = F.abs(s1) < F.abs(s2)
    start_s, start_c = F.when(swap, s2).otherwise(s1), F.when(swap, c2).otherwise(c1)
    end_s, end_c = F.when(swap, s1).otherwise(s2), F.when(swap, c1).otherwise(c2)
    end_s = F.when(start_s > 0, -end_s).otherwise(end_s)
    around = F.pmod(F.abs(length), F.lit(2 * math.pi))
    fixed = {
        # A start on the equator counts as just south of it.
        "s1": F.least(-F.abs(start_s), F.lit(-1e-200)), "c1": start_c, "s2": end_s, "c2": end_c,
        "len": F.least(around, F.lit(2 * math.pi) - around),
    }
    begin = F.struct(F.lit(0.0).alias("low"), F.lit(math.pi).alias("high"), *[v.alias(k) for k, v in fixed.items()])

    def arc(z: Column) -> Column:
        """The geodesic that leaves at the middle azimuth, up to the end's latitude."""
        azimuth = (z["low"] + z["high"]) / 2.0
        sin_alpha = F.sin(azimuth) * z["c1"]
        north = F.cos(azimuth) * z["c1"]
        end_north = F.sqrt(F.greatest(north * north + z["c2"] * z["c2"] - z["c1"] * z["c1"], F.lit(0.0)))
        sigma = F.atan2(z["s2"], end_north) - F.atan2(z["s1"], north)
        omega = F.atan2(sin_alpha * z["s2"], end_north) - F.atan2(sin_alpha * z["s1"], north)
        cos2_alpha = F.lit(1.0) - sin_alpha * sin_alpha
        mid = F.coalesce(F.cos(sigma) - F.try_divide(z["s1"] * z["s2"] * 2.0, cos2_alpha), F.lit(0.0))
        named = {
            "azimuth": azimuth, "sin_alpha": sin_alpha, "sigma": sigma, "omega": omega, "cos2_alpha": cos2_alpha,
            "mid": mid, "sin_sigma": F.sin(sigma), "cos_sigma": F.cos(sigma),
        }
        return F.struct(*[v.alias(k) for k, v in named.items()])

    def reached(p: Column) -> Column:
        c = F.lit(f / 16.0) * p["cos2_alpha"] * (F.lit(4.0) + F.lit(f) * (F.lit(4.0) - p["cos2_alpha"] * 3.0))
        bend = p["mid"] + c * p["cos_sigma"] * (p["mid"] * p["mid"] * 2.0 - 1.0)
        return p["omega"] - (F.lit(1.0) - c) * F.lit(f) * p["sin_alpha"] * (p["sigma"] + c * p["sin_sigma"] * bend)

    def halve(z: Column, _: Column) -> Column:
        def side(p: Column) -> Column:
            short = reached(p) < z["len"]
            return F.struct(
                F.when(short, p["azimuth"]).otherwise(z["low"]).alias("low"),
                F.when(short, z["high"]).otherwise(p["azimuth"]).alias("high"),
                *[z[k].alias(k) for k in fixed],
            )

        return F.element_at(F.transform(F.array(arc(z)), side), 1)

    def measured(z: Column) -> Column:
        return F.element_at(F.transform(F.array(arc(z)), _arc_km), 1)

    return F.aggregate(F.sequence(F.lit(1), F.lit(halvings)), begin, halve, measured)


def geodesic_km(
    lat1: Column, lon1: Column, lat2: Column, lon2: Column, rounds: int = 30, *, near_antipode: bool = False
) -> Column:
    """WGS-84 distance by Vincenty's inverse formula.

    The iteration is a fixed-length fold, so it stays one column expression. Near the
    antipode it does not settle; the distance is null there, or with ``near_antipode``
    that of the azimuth that leads to the other point.
    """
    f = WGS84_F
    length = F.radians(lon2 - lon1)
    u1 = F.atan(F.lit(1 - f) * F.tan(F.radians(lat1)))
    u2 = F.atan(F.lit(1 - f) * F.tan(F.radians(lat2)))
    start = F.struct(
        length.alias("lam"),
        F.lit(1.0).alias("step"),
        F.sin(u1).alias("s1"),
        F.cos(u1).alias("c1"),
        F.sin(u2).alias("s2"),
        F.cos(u2).alias("c2"),
        length.alias("len"),
    )

    def parts(s: Column) -> dict[str, Column]:
        lam = s["lam"]
        sin_sigma = F.sqrt(
            F.pow(s["c2"] * F.sin(lam), 2)
            + F.pow(s["c1"] * s["s2"] - s["s1"] * s["c2"] * F.cos(lam), 2)
        )
        cos_sigma = s["s1"] * s["s2"] + s["c1"] * s["c2"] * F.cos(lam)
        sin_alpha = F.coalesce(
            F.try_divide(s["c1"] * s["c2"] * F.sin(lam), sin_sigma), F.lit(0.0)
        )
        cos2_alpha = F.lit(1.0) - sin_alpha * sin_alpha
        mid = F.coalesce(
            cos_sigma - F.try_divide(s["s1"] * s["s2"] * 2.0, cos2_alpha), F.lit(0.0)
        )
        return {
            "sin_sigma": sin_sigma,
            "cos_sigma": cos_sigma,
            "sigma": F.atan2(sin_sigma, cos_sigma),
            "sin_alpha": sin_alpha,
            "cos2_alpha": cos2_alpha,
            "mid": mid,
        }

    def as_struct(s: Column) -> Column:
        return F.struct(*[value.alias(name) for name, value in parts(s).items()])

    def refine(s: Column, p: Column) -> Column:
        c = (
            F.lit(f / 16.0)
            * p["cos2_alpha"]
            * (F.lit(4.0) + F.lit(f) * (F.lit(4.0) - p["cos2_alpha"] * 3.0))
        )
        lam = s["len"] + (F.lit(1.0) - c) * F.lit(f) * p["sin_alpha"] * (
            p["sigma"]
            + c
            * p["sin_sigma"]
            * (p["mid"] + c * p["cos_sigma"] * (p["mid"] * p["mid"] * 2.0 - 1.0))
        )
        return F.struct(
            lam.alias("lam"),
            F.abs(lam - s["lam"]).alias("step"),
            *[s[n].alias(n) for n in ("s1", "c1", "s2", "c2", "len")],
        )

    def once(s: Column, _: Column) -> Column:
        settled = s["step"] < 1e-12
        following = F.element_at(
            F.transform(F.array(as_struct(s)), lambda p: refine(s, p)), 1
        )
        return F.when(settled, s).otherwise(following)

    def distance(s: Column) -> Column:
        km = F.element_at(F.transform(F.array(as_struct(s)), _arc_km), 1)
        settled = F.when(s["step"] < 1e-9, km)
        if near_antipode:
            return settled.otherwise(_azimuth_km(s["s1"], s["c1"], s["s2"], s["c2"], s["len"]))
        return settled

    same = (lat1 == lat2) & (lon1 == lon2)
    folded = F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), start, once, distance)
    return F.when(same, F.lit(0.0)).otherwise(folded)
