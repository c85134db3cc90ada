"""Rule-based scoring of trips and requests."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from faremill.functions.basics import clip, rounded
from faremill.functions.calendar import calendar_parts, time_flags
from faremill.functions.rules import calibration, fare_confidence, served_duration, served_fare, tariff
from faremill.operators.holidays import attach_holidays
from faremill.operators.location import location_flags
from faremill.operators.weather import join_hourly
from faremill.functions.weather import NEUTRAL, inches_to_mm, serving_weather
from faremill.profile import Conventions, SERVING


def with_stages(df: DataFrame, stages: dict[str, dict]) -> DataFrame:
    """Apply groups of columns one after the other."""
    for columns in stages.values():
        df = df.withColumns(columns)
    return df


def calibrate(
    trips: DataFrame, predicted: str = "predicted_duration", distance: str = "estimated_distance", rain: str = "precipitation", snow: str = "snow"
) -> DataFrame:
    """Hold a predicted duration to what weather and traffic allow; rain and snow name columns in mm an hour."""
    return with_stages(trips, calibration(predicted, distance, rain, snow)).drop("adjustment_kind")


def tariff_scores(trips: DataFrame, minutes: str = "trip_duration", distance: str = "estimated_distance") -> DataFrame:
    """Tariff fare with served floors and confidence."""
    fare = tariff(F.col(distance), F.col(minutes), F.col("is_raining"), F.col("is_snowing"))
    return trips.withColumns(
        {
            "tariff_fare": fare, "served_fare": served_fare(fare), "served_duration": served_duration(F.col(minutes)),
            "fare_confidence": fare_confidence(served_fare(fare)),
        }
    )


def request_features(requests: DataFrame, weather: DataFrame, calendar: DataFrame, conventions: Conventions = SERVING) -> DataFrame:
    """Requests with calendar, location, weather and holiday columns; an hour without weather takes neutral readings.

    Readings are in inches; the served weather columns come from them, and rain_mm and snow_mm are the amounts the calibration limits. Works on a batch and on a stream alike: both dimension joins have a static side.
    """
    timed = requests.withColumns({**calendar_parts("pickup_datetime"), "pickup_date": F.to_date("pickup_datetime")})
    flagged = timed.withColumns({**time_flags(conventions), **location_flags(conventions), "estimated_distance": clip(F.col("estimated_distance"), 0.1, 50.0)})
    joined = attach_holidays(join_hourly(flagged, weather, "pickup_datetime"), calendar)
    filled = joined.withColumns({name: F.coalesce(name, F.lit(value)) for name, value in NEUTRAL.items()})
    return filled.withColumns(serving_weather()).withColumns({"rain_mm": inches_to_mm(F.col("precipitation")), "snow_mm": inches_to_mm(F.col("snow"))})


def rule_scores(features: DataFrame, mph: float = 25.0) -> DataFrame:
    """Duration at a flat speed, calibrated, and the tariff on it; every output rounded as served."""
    first = features.withColumn("predicted_duration", F.col("estimated_distance") / mph * 60.0)
    scored = tariff_scores(calibrate(first, rain="rain_mm", snow="snow_mm"), "calibrated_duration")
    return scored.withColumns(
        {
            "duration_minutes": rounded(F.col("served_duration"), 2), "fare_usd": rounded(F.col("served_fare"), 2),
            "speed_limit_mph": rounded(F.col("speed_limit"), 1), "calibration_reasons": F.col("reasons"),
        }
    )


def what_if_summary(pairs: DataFrame) -> DataFrame:
    """Mean, least and largest change, and how many are identical, minor or significant."""
    dd, df = F.abs(F.col("duration_a") - F.col("duration_b")), F.abs(F.col("fare_a") - F.col("fare_b"))
    deltas = pairs.select(F.round(dd, 9).alias("dd"), F.round(df, 9).alias("df"))
    n = F.count("*")
    return deltas.agg(
        n.alias("trips"), F.avg("dd").alias("mean_duration_change"), F.min("dd").alias("min_duration_change"), F.max("dd").alias("max_duration_change"),
        F.avg("df").alias("mean_fare_change"), F.min("df").alias("min_fare_change"), F.max("df").alias("max_fare_change"),
        (F.count_if(F.col("dd") <= 0.01) * 100.0 / n).alias("identical_pct"),
        (F.count_if((F.col("dd") > 0.01) & (F.col("dd") <= 0.5)) * 100.0 / n).alias("minor_pct"),
        (F.count_if(F.col("dd") > 0.5) * 100.0 / n).alias("significant_pct"),
    )
