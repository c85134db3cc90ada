"""Feature table, interaction sets and leakage audit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from faremill.functions.basics import flag
from faremill.functions.calendar import calendar_parts, cyclical_encoding, hour_start, night_and_rush_parts, time_flags
from faremill.operators.correlations import correlations_long
from faremill.operators.holidays import attach_holidays
from faremill.operators.location import distance_features, location_flags, route_encodings
from faremill.operators.weather import WEATHER_COLUMNS, impute, weighted_medians
from faremill.profile import Conventions, TRAINING
from faremill.session import written_table

LOCATION_COLUMNS = (
    "PULocationID", "DOLocationID", "pickup_is_airport", "dropoff_is_airport", "is_airport_trip", "pickup_is_manhattan",
    "dropoff_is_manhattan", "same_location",
)
TEMPORAL_COLUMNS = (
    "pickup_hour", "pickup_day", "pickup_month", "pickup_weekday", "pickup_dayofyear", "pickup_weekofyear", "is_weekend",
    "is_rush_hour", "is_late_night", "is_business_hours",
)
HOLIDAY_COLUMNS = ("is_holiday", "is_major_holiday", "is_holiday_week")
CYCLICAL_COLUMNS = (
    "hour_sin", "hour_cos", "weekday_sin", "weekday_cos", "month_sin", "month_cos", "dayofyear_sin", "dayofyear_cos",
)

# Products of two or three columns.
BASE_PRODUCTS = {
    "weather_airport_interaction": ("weather_severity", "is_airport_trip"),
    "weather_rushhour_interaction": ("weather_severity", "is_rush_hour"),
    "rushhour_airport_interaction": ("is_rush_hour", "is_airport_trip"),
    "latenight_manhattan_interaction": ("is_late_night", "pickup_is_manhattan"),
    "distance_hour_interaction": ("estimated_distance", "pickup_hour"),
    "distance_rushhour_interaction": ("estimated_distance", "is_rush_hour"),
    "holiday_airport_interaction": ("is_holiday", "is_airport_trip"),
    "holiday_manhattan_interaction": ("is_holiday", "pickup_is_manhattan"),
    "rain_distance_interaction": ("is_raining", "estimated_distance"),
    "snow_distance_interaction": ("is_snowing", "estimated_distance"),
}
ENHANCED_PRODUCTS = {
    "weather_distance_interaction": ("weather_severity", "trip_distance"),
    "weather_rushhour_interaction": ("weather_severity", "is_rush_hour"),
    "rain_airport_interaction": ("is_raining", "is_airport_trip"),
    "holiday_hour_interaction": ("is_holiday", "pickup_hour"),
    "holiday_distance_interaction": ("is_holiday", "trip_distance"),
    "extreme_weather_distance": ("is_extreme_weather", "trip_distance"),
}
LEAKY_PRODUCTS = {"snow_duration_interaction": ("is_snowing", "trip_duration")}
FIRST_PRODUCTS = {
    "distance_rain": ("estimated_distance", "is_raining"),
    "distance_snow": ("estimated_distance", "is_snowing"),
    "distance_weather_severity": ("estimated_distance", "weather_severity"),
    "holiday_hour": ("is_holiday", "pickup_hour"),
    "major_holiday_rush": ("is_major_holiday", "is_rush_hour"),
    "rush_rain": ("is_rush_hour", "is_raining"),
    "rush_snow": ("is_rush_hour", "is_snowing"),
    "manhattan_rush": ("pickup_is_manhattan", "is_rush_hour"),
    "manhattan_weekend": ("pickup_is_manhattan", "is_weekend"),
    "manhattan_distance": ("pickup_is_manhattan", "estimated_distance"),
    "airport_hour": ("is_airport_trip", "pickup_hour"),
    "airport_weekend": ("is_airport_trip", "is_weekend"),
    "airport_distance": ("is_airport_trip", "estimated_distance"),
    "passengers_distance": ("passenger_count", "estimated_distance"),
    "passengers_rush": ("passenger_count", "is_rush_hour"),
    "passengers_airport": ("passenger_count", "is_airport_trip"),
    "weekend_rain": ("is_weekend", "is_raining"),
    "weekend_temp": ("is_weekend", "temperature"),
}
FURTHER_PRODUCTS = {
    "distance_hour_rain": ("estimated_distance", "pickup_hour", "is_raining"),
    "distance_rush_manhattan": ("estimated_distance", "is_rush_hour", "pickup_is_manhattan"),
    "distance_squared": ("estimated_distance", "estimated_distance"),
    "hour_squared": ("pickup_hour", "pickup_hour"),
    "temp_squared": ("temperature", "temperature"),
    "temp_distance": ("temperature", "estimated_distance"),
    "temp_rush": ("temperature", "is_rush_hour"),
    "wind_distance": ("wind_speed", "estimated_distance"),
    "wind_rush": ("wind_speed", "is_rush_hour"),
    "precip_distance": ("precipitation", "estimated_distance"),
    "precip_hour": ("precipitation", "pickup_hour"),
    "weekday_hour": ("pickup_weekday", "pickup_hour"),
    "day_distance": ("pickup_day", "estimated_distance"),
    "latenight_distance": ("is_late_night", "estimated_distance"),
    "latenight_manhattan": ("is_late_night", "pickup_is_manhattan"),
    "latenight_weekend": ("is_late_night", "is_weekend"),
    "business_distance": ("is_business_hours", "estimated_distance"),
    "business_manhattan": ("is_business_hours", "pickup_is_manhattan"),
    "hoursin_distance": ("hour_sin", "estimated_distance"),
    "hourcos_distance": ("hour_cos", "estimated_distance"),
    "extreme_distance": ("is_extreme_weather", "estimated_distance"),
    "poorvis_rush": ("is_poor_visibility", "is_rush_hour"),
    "passengers_manhattan": ("passenger_count", "pickup_is_manhattan"),
    "passengers_weekend": ("passenger_count", "is_weekend"),
    "holidayweek_distance": ("is_holiday_week", "estimated_distance"),
    "holidayweek_hour": ("is_holiday_week", "pickup_hour"),
}

FEATURES = (
    *LOCATION_COLUMNS, "passenger_count", "estimated_distance", *TEMPORAL_COLUMNS, *WEATHER_COLUMNS, *HOLIDAY_COLUMNS,
    *BASE_PRODUCTS, *CYCLICAL_COLUMNS,
)
TARGETS = ("fare_amount", "trip_duration")
FORBIDDEN = (
    "fare_amount", "trip_duration", "tpep_dropoff_datetime", "trip_distance", "weather_main", "weather_description", "temp_category",
    "distance_category", "visibility", "total_amount", "tip_amount", "tolls_amount", "extra", "mta_tax",
)


def products(table: dict[str, tuple[str, ...]]) -> dict[str, Column]:
    out = {}
    for name, parts in table.items():
        value = F.col(parts[0])
        for part in parts[1:]:
            value = value * F.col(part)
        out[name] = value
    return out


def base_interactions() -> dict[str, Column]:
    return products(BASE_PRODUCTS)


def enhanced_interactions(leaky: bool = False) -> dict[str, Column]:
    """Weather, holiday and temperature interactions; the one built on a target only on request."""
    extreme_heat = flag((F.col("temperature") < 32) | (F.col("temperature") > 85))
    return {**products(ENHANCED_PRODUCTS), "temp_demand_score": extreme_heat, **(products(LEAKY_PRODUCTS) if leaky else {})}


def interactions_20() -> dict[str, Column]:
    return {
        **products(FIRST_PRODUCTS),
        "speed_proxy_hour": F.col("estimated_distance") / (F.lit(1.0) + F.col("pickup_hour") / F.lit(24.0)),
        "route_complexity": route_encodings()["route_complexity"],
    }


def interactions_51() -> dict[str, Column]:
    encodings = route_encodings()
    return {
        **interactions_20(),
        **products(FURTHER_PRODUCTS),
        "distance_sqrt": F.sqrt(F.greatest(F.col("estimated_distance"), F.lit(0.0))),
        "pickup_density": encodings["pickup_density"],
        "dropoff_density": encodings["dropoff_density"],
        "route_hash": encodings["route_hash"],
        "distance_per_passenger": F.col("estimated_distance") / (F.col("passenger_count") + 1.0),
    }


def context_interactions() -> dict[str, Column]:
    """Context products; a long trip is one beyond ten miles."""
    return {
        "rush_airport": F.col("is_rush_hour") * F.col("is_airport_trip"),
        "weekend_night": F.col("is_weekend") * F.col("is_night"),
        "cross_borough_rush": F.col("is_cross_borough") * F.col("is_rush_hour"),
        "long_trip_night": flag(F.col("trip_distance") > 10) * F.col("is_night"),
        "rain_rush_hour": F.col("is_raining") * F.col("is_rush_hour"),
        "weekend_evening": F.col("is_weekend") * flag(F.col("pickup_hour") >= 20),
    }


def hour_table(trips: DataFrame, weather: DataFrame, calendar: DataFrame, conventions: Conventions = TRAINING, ts: str = "tpep_pickup_datetime") -> DataFrame:
    """Everything about a trip that depends on its pickup hour alone, one row per hour that has trips.

    Calendar parts, flags, cyclical encodings, filled weather and holiday flags are worked out once
    per hour (8,760 rows a year) instead of once per trip. Hours carry their number of trips, which
    weights the monthly medians. The table is written, so that counting and joining it reads a few
    thousand rows and not the trips again.
    """
    hours = trips.groupBy(hour_start(ts).alias("hour_start")).agg(F.count("*").alias("trips"))
    timed = hours.withColumns({**calendar_parts("hour_start"), "pickup_date": F.to_date("hour_start")})
    joined = timed.join(weather.withColumnRenamed("datetime", "hour_start"), "hour_start", "left")
    filled = impute(joined, weighted_medians(joined))
    full = attach_holidays(filled, calendar).withColumns({**time_flags(conventions), **night_and_rush_parts(), **cyclical_encoding()})
    return written_table(full.drop("trips"), "hours")


def enrich(trips: DataFrame, weather: DataFrame, calendar: DataFrame, conventions: Conventions = TRAINING) -> DataFrame:
    """Clean trips with every base feature next to the original columns.

    One broadcast join on the pickup hour brings the time-bound columns; the trips themselves are never shuffled.
    """
    hours = hour_table(trips, weather, calendar, conventions)
    bare = trips.drop(*[c for c in hours.columns if c in trips.columns])
    keyed = bare.withColumn("hour_start", hour_start("tpep_pickup_datetime"))
    joined = keyed.join(hours, "hour_start", "left").drop("hour_start")
    return joined.withColumns({**location_flags(conventions), **distance_features()}).withColumns(base_interactions())


def safe_features(trips: DataFrame, weather: DataFrame, calendar: DataFrame, key: list[str], conventions: Conventions = TRAINING) -> DataFrame:
    """Key, the 56 features in serving order, and the two targets."""
    return enrich(trips, weather, calendar, conventions).select(*key, *FEATURES, *TARGETS)


def project_safe(df: DataFrame, key: list[str] = ()) -> DataFrame:
    """Drop forbidden, temporal and non-numeric columns by looking at the schema."""
    kept = [f.name for f in df.schema if f.name in key or (f.name not in FORBIDDEN and isinstance(f.dataType, T.NumericType))]
    return df.select(*kept)


def split_xy(features: DataFrame, key: list[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Feature frame and two target frames, each carrying the trip key."""
    return features.select(*key, *FEATURES), features.select(*key, "fare_amount"), features.select(*key, "trip_duration")


def leakage_audit(df: DataFrame, columns: list[str], max_corr: float = 0.999, max_equal: float = 0.99) -> DataFrame:
    """Per column: forbidden name, correlation with both targets, share of rows equal to a target, contract membership."""
    tied = df.withColumn("tied", F.when(F.col("fare_amount") == F.col("trip_duration"), F.col("fare_amount")))
    wide = correlations_long(tied, columns, (*TARGETS, "tied"))
    rows = wide.select(
        "column_name", F.col("corr_fare_amount").alias("corr_fare"), F.col("corr_trip_duration").alias("corr_duration"),
        ((F.col("same_fare_amount") + F.col("same_trip_duration") - F.col("same_tied")) / F.col("rows")).alias("equal_share"),
    )
    contract = df.sparkSession.createDataFrame([(name, 1) for name in FEATURES], "column_name string, listed int")
    strongest = F.greatest(F.abs(F.coalesce("corr_fare", F.lit(0.0))), F.abs(F.coalesce("corr_duration", F.lit(0.0))))
    forbidden = F.col("column_name").isin(*FORBIDDEN)
    return (
        rows.join(contract, "column_name", "full")
        .select(
            "column_name", flag(forbidden).alias("is_forbidden"), "corr_fare", "corr_duration", "equal_share",
            flag(F.col("listed") == 1).alias("in_contract"),
            F.when(forbidden, "forbidden").when(F.col("equal_share").isNull(), "absent")
            .when((strongest > max_corr) | (F.col("equal_share") > max_equal), "suspicious").otherwise("safe").alias("verdict"),
        )
    )
