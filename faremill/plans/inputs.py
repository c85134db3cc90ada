"""Inputs the registered queries start from."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from faremill.functions.basics import dbl, decimals
from faremill.functions.calendar import cyclical_encoding, night_and_rush_parts, time_flags
from faremill.functions.rules import tariff
from faremill.operators import features, holidays, location, quality, sampling, weather
from faremill.session import written_table
from faremill.sources import views
from faremill.sources.views import KEY


# Added before rounding: decimal ties (a mean of two prices, say) would otherwise fall either way
# with the last bit of a sum.
NUDGE = 1e-9


def tidy(df: DataFrame, digits: int = 6, **special: int) -> DataFrame:
    """Round every double, so that two engines' last bits do not show; `special` has other digits for named columns."""
    return df.select(
        *[decimals(F.col(f.name) + NUDGE, special.get(f.name, digits)).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name) for f in df.schema]
    )


def raw(spark: SparkSession, sf: str) -> DataFrame:
    return views.trips_raw(spark, sf)


def timed(spark: SparkSession, sf: str) -> DataFrame:
    """Raw trips with their duration."""
    return quality.with_duration(raw(spark, sf))


def clean(spark: SparkSession, sf: str) -> DataFrame:
    return quality.clean_trips(raw(spark, sf), KEY)


def readings(spark: SparkSession, sf: str) -> DataFrame:
    return views.weather_hourly(spark, sf)


def hours(spark: SparkSession, sf: str) -> DataFrame:
    """The fifteen weather feature columns per hour."""
    return weather.feature_weather(readings(spark, sf))


def calendar(spark: SparkSession) -> DataFrame:
    return holidays.holiday_calendar(holidays.base_calendar(spark))


def flagged(spark: SparkSession, sf: str) -> DataFrame:
    """Clean trips with time, location and distance columns."""
    return clean(spark, sf).withColumns(
        {**time_flags(), **location.location_flags(), **location.distance_features(), **night_and_rush_parts()}
    )


def enriched(spark: SparkSession, sf: str) -> DataFrame:
    """Clean trips with all base features, a split and night parts."""
    full = features.enrich(clean(spark, sf), hours(spark, sf), calendar(spark))
    return full.withColumn("split", sampling.month_split())


def folded(spark: SparkSession, sf: str) -> DataFrame:
    return views.fold_routes(clean(spark, sf))


def scored_fare(spark: SparkSession, sf: str) -> DataFrame:
    full = enriched(spark, sf)
    guess = tariff(F.col("estimated_distance"), F.col("trip_duration"), F.col("is_raining"), F.col("is_snowing"))
    return full.withColumns({"y_true": F.col("fare_amount"), "y_pred": guess})


def zone_means(trips: DataFrame) -> DataFrame:
    """Mean duration per pickup zone from whole seconds."""
    return trips.groupBy("PULocationID").agg((F.sum(F.round(F.col("trip_duration") * 60).cast("bigint")) / F.count("*") / 60.0).alias("y_pred"))


def scored_duration(spark: SparkSession, sf: str) -> DataFrame:
    """Clean flagged trips with the mean duration of the pickup zone as the guess."""
    trips = flagged(spark, sf).withColumn("split", sampling.month_split())
    return trips.join(zone_means(trips), "PULocationID").withColumn("y_true", F.col("trip_duration"))


TARGET = ("target",)


def scored_both(spark: SparkSession, sf: str) -> DataFrame:
    """A row per trip and target (fare, duration) with its truth and guess, from one plan of the trips."""
    full = scored_fare(spark, sf).withColumnRenamed("y_pred", "fare_guess").drop("y_true")
    means = zone_means(clean(spark, sf)).withColumnRenamed("y_pred", "minutes_guess")
    sides = F.array(
        F.struct(F.lit("fare").alias("target"), F.col("fare_amount").cast("double").alias("y_true"), F.col("fare_guess").alias("y_pred")),
        F.struct(F.lit("duration").alias("target"), F.col("trip_duration").alias("y_true"), F.col("minutes_guess").alias("y_pred")),
    )
    # a mean per zone: a side bounded by its key, so that no trip is shuffled
    return full.join(F.broadcast(means), "PULocationID").select("*", F.inline(sides))


SCORED_COLUMNS = (
    "target", *KEY, "split", "tpep_pickup_datetime", "pickup_hour", "is_airport_trip", "is_rush_hour", "estimated_distance", "trip_duration", "fare_amount",
    "passenger_count", "temperature", "y_true", "y_pred",
)


def saved(scored: DataFrame) -> DataFrame:
    """Scored rows written once, for a report that passes over them several times."""
    return written_table(scored.select(*[c for c in SCORED_COLUMNS if c in scored.columns]), "scored")
