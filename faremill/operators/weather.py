"""Weather parsing, joins, imputation and summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from faremill.functions.basics import share
from faremill.functions.weather import hpa_to_inhg, metres_to_miles, weather_flags, wmo_labels, temp_category
from faremill.functions.calendar import hour_start, seconds_between


PAYLOAD = (
    "hourly struct<time:array<string>,temperature_2m:array<double>,relativehumidity_2m:array<double>,windspeed_10m:array<double>,"
    "precipitation:array<double>,snowfall:array<double>,visibility:array<double>,pressure_msl:array<double>,"
    "cloudcover:array<double>,weathercode:array<int>>"
)

FLAGS = ("is_raining", "is_snowing", "is_extreme_weather", "is_poor_visibility")
MEASURES = ("temperature", "humidity", "wind_speed", "precipitation", "snow", "weather_severity")


def parse_payload(payloads: DataFrame, column: str = "payload") -> DataFrame:
    """JSON texts of parallel hourly arrays, as one row per hour with units fixed."""
    hours = payloads.select(F.from_json(column, PAYLOAD).alias("j")).select(
        F.inline(
            F.arrays_zip(
                "j.hourly.time", "j.hourly.temperature_2m", "j.hourly.relativehumidity_2m", "j.hourly.windspeed_10m",
                "j.hourly.precipitation", "j.hourly.snowfall", "j.hourly.visibility", "j.hourly.pressure_msl",
                "j.hourly.cloudcover", "j.hourly.weathercode",
            )
        )
    )
    return hours.select(
        F.to_timestamp_ntz("time", F.lit("yyyy-MM-dd'T'HH:mm")).alias("datetime"),
        F.col("temperature_2m").alias("temperature"),
        F.col("temperature_2m").alias("feels_like"),
        F.col("relativehumidity_2m").alias("humidity"),
        hpa_to_inhg(F.col("pressure_msl")).alias("pressure"),
        F.col("windspeed_10m").alias("wind_speed"),
        F.col("cloudcover").alias("clouds"),
        metres_to_miles(F.col("visibility")).alias("visibility"),
        F.col("precipitation"),
        F.col("snowfall").alias("snow"),
        *[value.alias(name) for name, value in wmo_labels().items()],
    )


def derive(weather: DataFrame) -> DataFrame:
    """Add temperature band, severity and flags to hourly readings."""
    return weather.withColumns({"temp_category": temp_category(), **weather_flags()})


def feature_weather(weather: DataFrame) -> DataFrame:
    """The fifteen weather columns of the feature table, keyed by hour."""
    full = derive(weather).withColumns({"feels_like": F.col("temperature"), "pressure": hpa_to_inhg(F.col("pressure_hpa"))})
    return full.select("datetime", *WEATHER_COLUMNS)


WEATHER_COLUMNS = (
    "temperature", "feels_like", "humidity", "pressure", "wind_speed", "clouds", "precipitation", "snow", "weather_severity",
    "is_raining", "is_snowing", "is_heavy_rain", "is_heavy_snow", "is_extreme_weather", "is_poor_visibility",
)


def join_hourly(trips: DataFrame, weather: DataFrame, ts: str = "tpep_pickup_datetime") -> DataFrame:
    """Weather of the pickup hour; a trip in an uncovered hour keeps missing readings."""
    side = weather.withColumnRenamed("datetime", "weather_hour")
    return trips.withColumn("weather_hour", hour_start(ts)).join(side, "weather_hour", "left").drop("weather_hour")


def weighted_medians(hours: DataFrame, columns: tuple[str, ...] = MEASURES) -> DataFrame:
    """Median reading per month over hours weighted by their trips; an hour without a reading does not count."""
    return hours.groupBy("pickup_month").agg(
        *[F.percentile(F.col(c).cast("double"), F.lit(0.5), F.col("trips")).alias(f"{c}_median") for c in columns]
    )


def monthly_medians(trips: DataFrame, weather: DataFrame, columns: tuple[str, ...] = MEASURES, ts: str = "tpep_pickup_datetime") -> DataFrame:
    """Median reading per month over trips that found one.

    Trips are counted per hour first, so neither the shuffle nor the percentile buffer grows with the trips.
    """
    hours = trips.groupBy(hour_start(ts).alias("datetime")).agg(F.count("*").alias("trips"))
    joined = hours.join(weather.select("datetime", *columns), "datetime")
    return weighted_medians(joined.withColumn("pickup_month", F.month("datetime")), columns)


def impute(joined: DataFrame, medians: DataFrame, measures: tuple[str, ...] = MEASURES, flags: tuple[str, ...] = FLAGS) -> DataFrame:
    """Missing flags become 0, missing readings the median of the trip's month.

    medians holds one row per month number, twelve at most, so it is broadcast as it is.
    """
    filled = joined.join(F.broadcast(medians), "pickup_month", "left").withColumns(
        {
            **{c: F.coalesce(F.col(c), F.lit(0)).cast("int") for c in flags},
            **{c: F.coalesce(F.col(c).cast("double"), F.col(f"{c}_median")) for c in measures},
        }
    )
    return filled.drop(*[f"{c}_median" for c in measures])


def attach_weather(trips: DataFrame, weather: DataFrame) -> DataFrame:
    """Join the pickup hour and fill what is missing."""
    return impute(join_hourly(trips, weather), monthly_medians(trips, weather))


def nearest_hour(requests: DataFrame, weather: DataFrame, ts: str = "pickup_datetime") -> DataFrame:
    """The observation with the least time gap to the request's hour, the earlier one on a tie.

    Observations may be at any minute. Of several at one time the least (column by column) counts; a request without a time gets none.
    Each wanted hour looks at the last observation up to it and the first one after it: within a day by running windows, beyond
    it by what the nearest days with observations carry over. Days are window groups of their own; only one row per day is
    ordered in a single task.
    """
    fields = [c for c in weather.columns if c != "datetime"]
    observed = weather.groupBy("datetime").agg(F.min(F.struct("datetime", *fields)).alias("obs")).where("datetime is not null")
    wanted = requests.select(hour_start(ts).alias("at")).where("at is not null").distinct()
    events = observed.select(F.col("datetime").alias("at"), "obs", F.lit(0).alias("asks")).unionByName(
        wanted.select("at", F.lit(None).cast(observed.schema["obs"].dataType).alias("obs"), F.lit(1).alias("asks"))
    ).withColumn("day", F.to_date("at"))
    days = events.groupBy("day").agg(F.max("obs").alias("last_obs"), F.min("obs").alias("first_obs"))
    in_order, back = Window.orderBy("day"), Window.orderBy(F.desc("day"))
    carried = days.select(
        "day",
        F.last("last_obs", ignorenulls=True).over(in_order.rowsBetween(Window.unboundedPreceding, -1)).alias("carried"),
        F.last("first_obs", ignorenulls=True).over(back.rowsBetween(Window.unboundedPreceding, -1)).alias("coming"),
    )
    before = Window.partitionBy("day").orderBy("at", "asks").rowsBetween(Window.unboundedPreceding, 0)
    after = Window.partitionBy("day").orderBy(F.desc("at"), "asks").rowsBetween(Window.unboundedPreceding, 0)
    sided = events.select("at", "asks", "day", F.last("obs", ignorenulls=True).over(before).alias("near_before"), F.last("obs", ignorenulls=True).over(after).alias("near_after"))
    sides = (
        sided.where("asks = 1").join(carried, "day")
        .select("at", F.coalesce("near_before", "carried").alias("earlier"), F.coalesce("near_after", "coming").alias("later"))
        .withColumns({"earlier_at": F.col("earlier.datetime"), "later_at": F.col("later.datetime")})
    )
    gap_before, gap_after = seconds_between("earlier_at", "at"), seconds_between("at", "later_at")
    nearest = sides.select("at", F.when(F.col("later").isNull() | (gap_before <= gap_after), F.col("earlier")).otherwise(F.col("later")).alias("obs"))
    return requests.withColumn("at", hour_start(ts)).join(nearest, "at", "left").drop("at")


def weather_summary(weather: DataFrame) -> DataFrame:
    """One row over all hours."""
    return derive(weather).agg(
        F.min("datetime").alias("first_hour"), F.max("datetime").alias("last_hour"), F.count("*").alias("hours"),
        F.avg("temperature").alias("mean_temperature"), F.min("temperature").alias("min_temperature"), F.max("temperature").alias("max_temperature"),
        F.sum("is_raining").alias("rainy_hours"), share(F.sum("is_raining"), F.count("*")).alias("rainy_pct"),
        F.sum("is_snowing").alias("snowy_hours"), share(F.sum("is_snowing"), F.count("*")).alias("snowy_pct"),
        F.sum("precipitation").alias("total_precipitation"), F.sum("snow").alias("total_snow"),
        F.avg("wind_speed").alias("mean_wind"), F.max("wind_speed").alias("max_wind"), F.avg("visibility").alias("mean_visibility"),
        F.sum("is_extreme_weather").alias("extreme_hours"), share(F.sum("is_extreme_weather"), F.count("*")).alias("extreme_pct"),
    )


def weather_monthly(weather: DataFrame) -> DataFrame:
    return derive(weather).groupBy(F.month("datetime").alias("month")).agg(
        F.avg("temperature").alias("mean_temperature"), F.sum("precipitation").alias("total_precipitation"),
        F.sum("snow").alias("total_snow"), F.sum("is_extreme_weather").alias("extreme_hours"),
    )
