"""Zone flags, zone lookup, spatial joins and route tables."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from faremill.functions.basics import clip, dbl, flag
from faremill.functions.calendar import hour_start
from faremill.functions.geometry import haversine_km_miles, ring_contains
from faremill.profile import Conventions, TRAINING
from faremill.session import written_table


def location_flags(conventions: Conventions = TRAINING) -> dict[str, Column]:
    pickup, dropoff = F.col("PULocationID"), F.col("DOLocationID")
    first, last = conventions.manhattan
    return {
        "pickup_is_airport": flag(pickup.isin(*conventions.airports)),
        "dropoff_is_airport": flag(dropoff.isin(*conventions.airports)),
        "is_airport_trip": flag(pickup.isin(*conventions.airports) | dropoff.isin(*conventions.airports)),
        "pickup_is_manhattan": flag(pickup.between(first, last)),
        "dropoff_is_manhattan": flag(dropoff.between(first, last)),
        "same_location": flag(pickup == dropoff),
    }


def enrich_zones(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Borough, zone name and service zone of both ends; a zone without a row is named by its number."""
    lookup = zones.select("LocationID", "Borough", "Zone", "service_zone")
    for end, column in (("pickup", "PULocationID"), ("dropoff", "DOLocationID")):
        side = lookup.select(
            F.col("LocationID").alias(column), F.col("Borough").alias(f"{end}_borough"),
            F.col("Zone").alias(f"{end}_zone"), F.col("service_zone").alias(f"{end}_service_zone"),
        )
        trips = trips.join(side, column, "left").withColumn(
            f"{end}_zone", F.coalesce(f"{end}_zone", F.concat(F.lit("Zone "), F.col(column).cast("string")))
        )
    return trips


def borough_flow_flags(conventions: Conventions = TRAINING) -> dict[str, Column]:
    start, end = F.col("pickup_borough"), F.col("dropoff_borough")
    from_airport = F.col("PULocationID").isin(*conventions.airports)
    to_airport = F.col("DOLocationID").isin(*conventions.airports)
    return {
        "is_cross_borough": flag(start != end),
        "both_manhattan": flag((start == "Manhattan") & (end == "Manhattan")),
        "manhattan_to_airport": flag((start == "Manhattan") & to_airport),
        "airport_to_manhattan": flag(from_airport & (end == "Manhattan")),
    }


def centroid_distance(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Centroid to centroid miles; zero when either zone is unknown."""
    centres = zones.select("LocationID", "lat", "lon")
    for end, column in (("pu", "PULocationID"), ("do", "DOLocationID")):
        trips = trips.join(
            centres.select(F.col("LocationID").alias(column), F.col("lat").alias(f"{end}_lat"), F.col("lon").alias(f"{end}_lon")), column, "left"
        )
    miles = haversine_km_miles(F.col("pu_lat"), F.col("pu_lon"), F.col("do_lat"), F.col("do_lon"))
    return trips.withColumn("centroid_distance", F.coalesce(miles, F.lit(0.0))).drop("pu_lat", "pu_lon", "do_lat", "do_lon")


def distance_features() -> dict[str, Column]:
    """Distance held to [0.1, 50] and its right-closed band."""
    d = clip(dbl("trip_distance"), 0.1, 50.0)
    return {
        "estimated_distance": d,
        "distance_category": F.when((d > 0) & (d <= 1), "very_short").when(d <= 3, "short").when(d <= 5, "medium").when(d <= 10, "long").when(d <= 50, "very_long"),
    }


def route_encodings() -> dict[str, Column]:
    pu, do = F.col("PULocationID"), F.col("DOLocationID")
    return {
        "route_complexity": (pu + do).cast("double") / 2.0,
        "pickup_density": pu.cast("double") / 265.0,
        "dropoff_density": do.cast("double") / 265.0,
        "route_hash": F.pmod(pu * 1000 + do, F.lit(10000)).cast("int"),
    }


# Spatial lookup ---------------------------------------------------------------------------------

def grid_cell(lat: Column, lon: Column, size: float) -> tuple[Column, Column]:
    return F.floor(lat / size).cast("int"), F.floor(lon / size).cast("int")


def cell_candidates(rings: DataFrame, size: float = 0.02) -> DataFrame:
    """One row per grid cell with the rings whose bounding box touches it, lowest zone first.

    A cell holds only the zones meeting there, so the gathered array stays short.
    """
    lats, lons = F.transform("ring", lambda c: c["lat"]), F.transform("ring", lambda c: c["lon"])
    south, west = grid_cell(F.array_min(lats), F.array_min(lons), size)
    north, east = grid_cell(F.array_max(lats), F.array_max(lons), size)
    return (
        rings.select("LocationID", "ring", F.explode(F.sequence(south, north)).alias("cell_y"), west.alias("west"), east.alias("east"))
        .select("LocationID", "ring", "cell_y", F.explode(F.sequence(F.col("west"), F.col("east"))).alias("cell_x"))
        .groupBy("cell_y", "cell_x")
        .agg(F.array_sort(F.collect_list(F.struct("LocationID", "ring"))).alias("candidates"))
    )


def point_in_zone(points: DataFrame, rings: DataFrame, lat: str = "lat", lon: str = "lon", size: float = 0.02) -> DataFrame:
    """Containing zone of each point, or missing: an equi join on the grid cell, then the exact test."""
    y, x = grid_cell(F.col(lat), F.col(lon), size)
    cells = cell_candidates(rings, size)
    hits = F.filter("candidates", lambda z: ring_contains(z["ring"], F.col(lat), F.col(lon)))
    return (
        points.withColumns({"cell_y": y, "cell_x": x})
        .join(cells, ["cell_y", "cell_x"], "left")
        .withColumn("zone_id", F.try_element_at(hits, F.lit(1))["LocationID"])
        .drop("cell_y", "cell_x", "candidates")
    )


# Miles in a degree of latitude, a little less than any sphere model gives, so that a radius in degrees is never short.
MILES_PER_DEGREE = 68.9


def _levels(size: float) -> int:
    """How many times a cell doubles until one spans the globe."""
    return math.ceil(math.log2(360.0 / size)) + 1


def _around(y: Column, x: Column) -> Column:
    """The cell and its eight neighbours."""
    steps = [(j, i) for j in (-1, 0, 1) for i in (-1, 0, 1)]
    return F.array(*[F.struct((y + j).alias("y"), (x + i).alias("x")) for j, i in steps])


def _zone_levels(zones: DataFrame, size: float) -> DataFrame:
    """(level, y, x, LocationID, lat, lon): every zone's cell on each level of the grid, whose cells double from level to level."""
    level = F.explode(F.sequence(F.lit(0), F.lit(_levels(size) - 1))).alias("level")
    width = F.pow(F.lit(2.0), F.col("level")) * size
    return zones.where("lat is not null and lon is not null").select("LocationID", "lat", "lon", level).select("level", F.floor(F.col("lat") / width).alias("y"), F.floor(F.col("lon") / width).alias("x"), "LocationID", "lat", "lon")


def cell_zones(cells: DataFrame, zones: DataFrame, size: float) -> DataFrame:
    """(cell_y, cell_x, candidates): the zones that can be the nearest of some point in a cell, found by equi joins on a grid of doubling cells.

    Around the cell, one zone per neighbouring grid cell of every level is measured; the nearest of them is an upper bound, which on the
    finest level with any zone is a small multiple of the true distance. A zone that wins for a point of the cell lies within that bound and
    the cell's diameter of its middle: the level whose cells are at least that wide has all of them next to the cell. Where the radius
    reaches a pole or the date line, that is the last level, whose cell is the globe.
    """
    mid_lat, mid_lon = (F.col("cell_y") + 0.5) * size, (F.col("cell_x") + 0.5) * size
    reach = F.greatest(*[haversine_km_miles(mid_lat, mid_lon, mid_lat + F.lit(side * size / 2), mid_lon + F.lit(size / 2)) for side in (-1, 1)]) * 1.01 + 1e-6
    top = _levels(size) - 1
    placed = written_table(_zone_levels(zones, size), "zone-levels")
    one = placed.groupBy("level", "y", "x").agg(F.min(F.struct("LocationID", "lat", "lon")).alias("z"))
    width = F.pow(F.lit(2.0), F.col("level")) * size
    looks = cells.withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(top)))).withColumn("n", F.explode(_around(F.floor(mid_lat / width), F.floor(mid_lon / width))))
    seen = looks.select("cell_y", "cell_x", "level", "n.y", "n.x").join(one, ["level", "y", "x"])
    bound = seen.groupBy("cell_y", "cell_x").agg(F.min(haversine_km_miles(mid_lat, mid_lon, F.col("z.lat"), F.col("z.lon"))).alias("upper"))
    radius = (F.col("upper") + reach * 2.0) * 1.001 + 1e-6
    up = radius / MILES_PER_DEGREE
    across = up / F.cos(F.radians(F.least(F.abs(mid_lat) + up, F.lit(89.0))))
    wraps = (F.abs(mid_lat) + up >= 89.0) | (F.abs(mid_lon) + across >= 180.0)
    fit = F.greatest(F.ceil(F.log2(F.greatest(up, across) / size)), F.lit(0)).cast("int")
    wide = bound.withColumns({"radius": radius, "level": F.when(wraps, F.lit(top)).otherwise(F.least(fit, F.lit(top)))})
    nearby = wide.withColumn("n", F.explode(_around(F.floor(mid_lat / width), F.floor(mid_lon / width)))).select("cell_y", "cell_x", "radius", "level", "n.y", "n.x")
    met = nearby.join(placed, ["level", "y", "x"]).where(haversine_km_miles(mid_lat, mid_lon, F.col("lat"), F.col("lon")) <= F.col("radius"))
    return met.groupBy("cell_y", "cell_x").agg(F.collect_list(F.struct("LocationID", "lat", "lon")).alias("candidates"))


def nearest_zone(points: DataFrame, zones: DataFrame, lat: str = "lat", lon: str = "lon", size: float = 0.02) -> DataFrame:
    """Zone with the nearest centroid and its distance; the lowest zone wins a tie.

    Points meet, in an equi join on their grid cell, only the zones that can win there (see cell_zones). Points without coordinates get none.
    """
    y, x = grid_cell(F.col(lat), F.col(lon), size)
    placed = points.withColumns({"cell_y": y, "cell_x": x})
    kept = cell_zones(placed.select("cell_y", "cell_x").where("cell_y is not null and cell_x is not null").distinct(), zones, size)
    best = F.array_min(
        F.transform(
            "candidates",
            lambda z: F.struct(F.round(haversine_km_miles(F.col(lat), F.col(lon), z["lat"], z["lon"]), 9).alias("miles"), z["LocationID"].alias("LocationID")),
        )
    )
    return (
        placed.join(written_table(kept, "cells"), ["cell_y", "cell_x"], "left")
        .withColumn("best", best)
        .withColumns({"nearest_zone_id": F.col("best.LocationID"), "nearest_miles": F.col("best.miles")})
        .drop("cell_y", "cell_x", "candidates", "best")
    )


def resolve_zone(points: DataFrame, rings: DataFrame, zones: DataFrame, allow_nearest: bool = True) -> DataFrame:
    """Containing zone, else the nearest one where allowed, with a flag for the fallback."""
    found = point_in_zone(points, rings)
    if not allow_nearest:
        return found.withColumn("used_fallback", F.lit(0))
    return (
        nearest_zone(found, zones)
        .withColumn("used_fallback", flag(F.col("zone_id").isNull()))
        .withColumn("zone_id", F.coalesce("zone_id", "nearest_zone_id"))
        .drop("nearest_zone_id", "nearest_miles")
    )


# Routes -----------------------------------------------------------------------------------------

ROUTE = ["PULocationID", "DOLocationID"]


def route_profile(trips: DataFrame) -> DataFrame:
    """Typical distance, duration and fare of each zone pair, its trips and its typical speed."""
    return (
        trips.groupBy(*ROUTE)
        .agg(
            F.avg("trip_distance").alias("typical_distance"), F.avg("trip_duration").alias("typical_duration"),
            F.avg("fare_amount").alias("typical_fare"), F.count("*").alias("route_popularity"),
        )
        .withColumn("route_efficiency", F.try_divide(F.col("typical_distance"), F.col("typical_duration") / 60.0))
    )


def route_profile_prior(trips: DataFrame, ts: str = "tpep_pickup_datetime") -> DataFrame:
    """Means over strictly earlier trips of the same zone pair.

    Trips are first added up per route and second, then per route and hour. Running totals over the
    hours give what lies before an hour, running totals within the hour the rest. No window group
    grows with the number of trips on a route: one holds at most 3,600 seconds, the other one row per hour.
    """
    measures = {"distance": "trip_distance", "duration": "trip_duration", "fare": "fare_amount"}
    seconds = trips.groupBy(*ROUTE, ts).agg(
        F.count("*").alias("n"), *[F.sum(c).alias(m) for m, c in measures.items()]
    ).withColumn("hour_start", hour_start(ts))
    sums = ["n", *measures]
    by_hour = Window.partitionBy(*ROUTE).orderBy("hour_start").rowsBetween(Window.unboundedPreceding, -1)
    within = Window.partitionBy(*ROUTE, "hour_start").orderBy(ts).rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        seconds.groupBy(*ROUTE, "hour_start").agg(*[F.sum(c).alias(c) for c in sums])
        .select(*ROUTE, "hour_start", *[F.coalesce(F.sum(c).over(by_hour), F.lit(0)).alias(f"{c}_carried") for c in sums])
    )
    totals = seconds.select(*ROUTE, "hour_start", ts, *[F.coalesce(F.sum(c).over(within), F.lit(0)).alias(f"{c}_within") for c in sums]).join(
        carried, [*ROUTE, "hour_start"]
    )
    prior_n = F.col("n_carried") + F.col("n_within")
    prior = totals.select(
        *ROUTE, ts, prior_n.alias("prior_trips"),
        *[F.try_divide(F.col(f"{m}_carried") + F.col(f"{m}_within"), prior_n).alias(f"prior_{m}") for m in measures],
    )
    return trips.join(prior, [*ROUTE, ts], "left")


def route_ratios(trips: DataFrame, profile: DataFrame) -> DataFrame:
    """Actual over typical distance and duration."""
    side = profile.select(*ROUTE, "typical_distance", "typical_duration")
    return trips.join(side, ROUTE, "left").withColumns(
        {
            "distance_ratio": F.try_divide(F.col("trip_distance"), F.col("typical_distance")),
            "duration_ratio": F.try_divide(F.col("trip_duration"), F.col("typical_duration")),
        }
    )


def zone_popularity(trips: DataFrame) -> DataFrame:
    """Trips per zone at either end; a zone is popular from the third quartile of its end upwards.

    At most one row per zone and end reaches the window, so the exact percentile is cheap there.
    """
    ends = F.array(
        F.struct(F.lit("pickup").alias("trip_end"), F.col("PULocationID").alias("zone_id")),
        F.struct(F.lit("dropoff").alias("trip_end"), F.col("DOLocationID").alias("zone_id")),
    )
    counts = trips.select(F.inline(ends)).groupBy("trip_end", "zone_id").agg(F.count("*").alias("trips"))
    cut = F.percentile("trips", F.lit(0.75)).over(Window.partitionBy("trip_end"))
    return counts.withColumn("is_popular", flag(F.col("trips") >= cut))
