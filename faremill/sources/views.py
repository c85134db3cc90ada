"""Trip, weather, zone, point and request views over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

# One trip is named by these columns of its source row.
KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice"]
HASH_KEY = ["l_orderkey", "l_partkey", "l_linenumber", "l_suppkey"]

# The six boroughs of the zone lookup.
BOROUGHS = ("Manhattan", "Queens", "Brooklyn", "Bronx", "Staten Island", "EWR")
SERVICE_ZONES = ("Yellow Zone", "Boro Zone", "Airports", "EWR")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def trips_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw trips: line items read as rides of the year 2022."""
    return lines_to_trips(table(spark, sf_dir, "lineitem"))


def lines_to_trips(lines: DataFrame) -> DataFrame:
    """The trip columns of line items, in a batch or a stream.

    The two times come out of inline, so that they are worked out once per row; as plain expressions
    they would be copied into every filter that mentions them.
    """
    start = "timestampadd(SECOND, (l_orderkey*7919 + l_partkey*104729 + l_linenumber*1709 + l_suppkey*31) % 31536000, timestamp_ntz'2022-01-01 00:00:00')"
    end = start.replace(") % 31536000", ") % 31536000 + (l_orderkey*37 + l_partkey*101 + l_suppkey*13) % 12000")
    return (
        lines.selectExpr("*", f"inline(array(struct({start} as tpep_pickup_datetime, {end} as tpep_dropoff_datetime)))")
        .selectExpr(
            *KEY,
            "tpep_pickup_datetime",
            "tpep_dropoff_datetime",
            "cast(l_partkey % 265 + 1 as int) as PULocationID",
            "cast((l_orderkey*3 + l_suppkey) % 265 + 1 as int) as DOLocationID",
            "case when l_linenumber = 7 and l_partkey % 5 = 0 then null else cast((l_linenumber + l_suppkey) % 8 as double) end as passenger_count",
            "(l_quantity - 1D) * 1.05D as trip_distance",
            "l_extendedprice / 400D as fare_amount",
            "cast(l_linenumber % 6 + 1 as int) as payment_type",
        )
    )


def fold_routes(trips: DataFrame, zones: int = 20) -> DataFrame:
    """Fold the zones so that every route repeats."""
    return trips.withColumns(
        {name: ((F.col(name) - 1) % zones + 1).cast("int") for name in ("PULocationID", "DOLocationID")}
    )


def weather_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One weather row per covered hour of 2022 (at most 8,760); a tenth of the hours is left out."""
    return (
        table(spark, sf_dir, "orders")
        .selectExpr("(o_orderkey*53) % 8760 as hour_no", "o_custkey as c")
        .where("hour_no % 10 <> 3")
        .groupBy("hour_no")
        .agg(
            F.expr("cast(min(c % 100) as double)").alias("temperature"),
            F.expr("cast(max(c % 61 + 35) as double)").alias("humidity"),
            F.expr("cast(min(c % 31) as double)").alias("wind_speed"),
            F.expr("(case when min(c % 4) = 0 then min(c % 9) else 0 end) * 0.05D").alias("precipitation"),
            F.expr("(case when min(c % 7) = 0 then min(c % 5) else 0 end) * 0.5D").alias("snow"),
            F.expr("cast(min(c % 12) as double)").alias("visibility"),
            F.expr("cast(max(c % 41) + 990 as double)").alias("pressure_hpa"),
            F.expr("cast(max(c % 101) as double)").alias("clouds"),
            F.expr("cast(min(c % 97) as int)").alias("weathercode"),
        )
        .select(F.expr("timestampadd(HOUR, hour_no, timestamp_ntz'2022-01-01 00:00:00')").alias("datetime"), "*")
        .drop("hour_no")
    )


def weather_payload(weather: DataFrame) -> DataFrame:
    """One JSON text per day holding parallel hourly arrays (24 entries at most)."""
    names = {
        "temperature_2m": "temperature",
        "relativehumidity_2m": "humidity",
        "windspeed_10m": "wind_speed",
        "precipitation": "precipitation",
        "snowfall": "snow",
        "visibility": "visibility",
        "pressure_msl": "pressure_hpa",
        "cloudcover": "clouds",
        "weathercode": "weathercode",
    }
    entry = F.struct(F.date_format("datetime", "yyyy-MM-dd'T'HH:mm").alias("time"), *[F.col(v).alias(k) for k, v in names.items()])
    days = weather.groupBy(F.to_date("datetime").alias("day")).agg(F.array_sort(F.collect_list(entry)).alias("e"))
    arrays = [F.col("e")[k].alias(k) for k in ("time", *names)]
    return days.select("day", F.to_json(F.struct(F.struct(*arrays).alias("hourly"))).alias("payload"))


def zones(spark: SparkSession) -> DataFrame:
    """Zone dimension of 265 rows with a centroid each."""
    return spark.range(1, 266).select(
        F.col("id").cast("int").alias("LocationID"),
        F.element_at(F.array(*[F.lit(b) for b in BOROUGHS]), (F.col("id") % 6 + 1).cast("int")).alias("Borough"),
        F.concat(F.lit("Area "), F.col("id").cast("string")).alias("Zone"),
        F.element_at(F.array(*[F.lit(s) for s in SERVICE_ZONES]), (F.col("id") % 4 + 1).cast("int")).alias("service_zone"),
        F.expr("40.5D + (id % 17) * 0.03D").alias("lat"),
        F.expr("-74.2D + (id % 23) * 0.03D").alias("lon"),
    )


def zone_lookup(spark: SparkSession) -> DataFrame:
    """The zone table with every fiftieth zone left out, so that a lookup can miss."""
    return zones(spark).where("LocationID % 50 <> 0")


def zone_rings(spark: SparkSession, half: float = 0.01) -> DataFrame:
    """A rectangular ring around each centroid."""

    def corner(north: int, east: int):
        return F.struct((F.col("lat") + north * half).alias("lat"), (F.col("lon") + east * half).alias("lon"))

    return zones(spark).select("LocationID", F.array(corner(-1, -1), corner(-1, 1), corner(1, 1), corner(1, -1)).alias("ring"))


def parcel_rings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A five-cornered ring per customer."""
    base = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey",
        "40D + (c_custkey % 100) * 0.01D as lat0",
        "-75D + (c_custkey % 77) * 0.01D as lon0",
        "(c_custkey % 9 + 1) * 0.001D as w",
        "(c_custkey % 7 + 1) * 0.001D as h",
        "(c_nationkey % 5 + 1) * 0.0005D as d",
    )
    corners = ((("lat0"), ("lon0")), ("lat0", "lon0 + w"), ("lat0 + h", "lon0 + w"), ("lat0 + h + d", "lon0 + w / 2D"), ("lat0 + h", "lon0"))
    return base.select("c_custkey", F.array(*[F.struct(F.expr(a).alias("lat"), F.expr(o).alias("lon")) for a, o in corners]).alias("ring"))


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A point and a second point per event."""
    return table(spark, sf_dir, "events").selectExpr(
        "event_id",
        "40.48D + (event_id*37 % 560)*0.001D + 0.0005D as lat",
        "-74.25D + (event_id*101 % 750)*0.001D + 0.0005D as lon",
        "40.48D + (event_id*53 % 560)*0.001D + 0.0005D as lat2",
        "-74.25D + (event_id*211 % 750)*0.001D + 0.0005D as lon2",
    )


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prediction requests read from events; some carry values outside the allowed ranges."""
    return events_to_requests(table(spark, sf_dir, "events"))


def events_to_requests(events: DataFrame) -> DataFrame:
    return events.selectExpr(
        "event_id as request_id",
        "ts as request_time",
        "timestampadd(SECOND, (event_id*7919 + user_id*104729) % 31536000, timestamp_ntz'2022-01-01 00:00:00') as pickup_datetime",
        "cast(event_id % 270 as int) as PULocationID",
        "cast((event_id*7 + user_id) % 265 + 1 as int) as DOLocationID",
        "cast(user_id % 8 as int) as passenger_count",
        "((event_id*37 + user_id*11) % 5200) * 0.01D as estimated_distance",
        "cast(event_id % 25 as int) as pickup_hour",
        "40.48D + (event_id*37 % 560)*0.001D + 0.0005D as pickup_latitude",
        "-74.25D + (event_id*101 % 750)*0.001D + 0.0005D as pickup_longitude",
    )


def dirty_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers as text, with words and non-finite spellings mixed in."""
    return table(spark, sf_dir, "events").selectExpr(
        "event_id",
        """case when event_id % 11 = 0 then 'x' when event_id % 13 = 0 then 'NaN' when event_id % 17 = 0 then 'Infinity'
                when event_id % 19 = 0 then '-Infinity' else get_json_object(props, '$.k') end as raw_text""",
    )
