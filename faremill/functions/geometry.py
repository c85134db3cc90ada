"""Great-circle distance, bearing and planar polygon expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

KM_EARTH_RADIUS = 6371.0
MILES_PER_KM = 0.621371
MILES_EARTH_RADIUS = 3959.0


def _half_chord(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    a, b = F.radians(lat1), F.radians(lat2)
    north = F.sin((b - a) / 2.0)
    east = F.sin((F.radians(lon2) - F.radians(lon1)) / 2.0)
    return north * north + F.cos(a) * F.cos(b) * east * east


def haversine_km_miles(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Miles on a sphere of 6371 km."""
    h = _half_chord(lat1, lon1, lat2, lon2)
    angle = F.lit(2.0) * F.atan2(F.sqrt(h), F.sqrt(F.lit(1.0) - h))
    return F.lit(KM_EARTH_RADIUS) * angle * F.lit(MILES_PER_KM)


def haversine_miles(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Miles on a sphere of 3959 miles."""
    h = _half_chord(lat1, lon1, lat2, lon2)
    return F.lit(MILES_EARTH_RADIUS) * F.lit(2.0) * F.asin(F.sqrt(F.least(h, F.lit(1.0))))


def bearing_degrees(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Initial bearing from the first point to the second, 0 to 360."""
    a, b, turn = F.radians(lat1), F.radians(lat2), F.radians(lon2) - F.radians(lon1)
    y = F.sin(turn) * F.cos(b)
    x = F.cos(a) * F.sin(b) - F.sin(a) * F.cos(b) * F.cos(turn)
    return F.pmod(F.degrees(F.atan2(y, x)) + 360.0, F.lit(360.0))


def ring_centroid(ring: Column) -> Column:
    """Planar centroid (lat, lon) of a ring of {lat, lon} corners.

    Coordinates are taken relative to the first corner, which keeps the cross products well
    conditioned; a ring without area yields its first corner.
    """
    origin = F.element_at(ring, 1)
    after = F.concat(F.slice(ring, 2, F.size(ring)), F.slice(ring, 1, 1))
    zero = F.struct(F.lit(0.0).alias("area2"), F.lit(0.0).alias("x"), F.lit(0.0).alias("y"))

    def add(acc: Column, pair: Column) -> Column:
        x1, y1 = pair["a"]["lon"] - origin["lon"], pair["a"]["lat"] - origin["lat"]
        x2, y2 = pair["b"]["lon"] - origin["lon"], pair["b"]["lat"] - origin["lat"]
        cross = x1 * y2 - x2 * y1
        return F.struct(
            (acc["area2"] + cross).alias("area2"),
            (acc["x"] + (x1 + x2) * cross).alias("x"),
            (acc["y"] + (y1 + y2) * cross).alias("y"),
        )

    def finish(acc: Column) -> Column:
        return F.struct(
            (origin["lat"] + F.coalesce(F.try_divide(acc["y"], acc["area2"] * 3.0), F.lit(0.0))).alias("lat"),
            (origin["lon"] + F.coalesce(F.try_divide(acc["x"], acc["area2"] * 3.0), F.lit(0.0))).alias("lon"),
        )

    edges = F.zip_with(ring, after, lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    return F.aggregate(edges, zero, add, finish)


def ring_contains(ring: Column, lat: Column, lon: Column) -> Column:
    """Even-odd ray cast: does the ring hold the point?"""
    after = F.concat(F.slice(ring, 2, F.size(ring)), F.slice(ring, 1, 1))

    def crosses(a: Column, b: Column) -> Column:
        spans = (a["lat"] > lat) != (b["lat"] > lat)
        meets = lon < a["lon"] + F.try_divide((lat - a["lat"]) * (b["lon"] - a["lon"]), b["lat"] - a["lat"])
        return (spans & F.coalesce(meets, F.lit(False))).cast("int")

    hits = F.zip_with(ring, after, crosses)
    return F.aggregate(hits, F.lit(0), lambda n, hit: n + hit) % 2 == 1
