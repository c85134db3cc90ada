"""Fare, duration and confidence rules of the serving side."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from faremill.functions.basics import flag

BASE_FARE, PER_MILE, PER_MINUTE, WEATHER_SURCHARGE = 2.50, 2.50, 0.50, 1.1
MINIMUM_FARE, MINIMUM_DURATION = 2.5, 1.0
OPEN_ROAD_MPH, GRIDLOCK_MPH = 60.0, 8.0


def tariff(distance: Column, minutes: Column, raining: Column, snowing: Column) -> Column:
    fare = F.lit(BASE_FARE) + distance * PER_MILE + minutes * PER_MINUTE
    return fare * F.when((raining == 1) | (snowing == 1), WEATHER_SURCHARGE).otherwise(1.0)


def served_fare(fare: Column) -> Column:
    return F.when(fare.isNotNull(), F.greatest(fare, F.lit(MINIMUM_FARE)))


def served_duration(minutes: Column) -> Column:
    return F.when(minutes.isNotNull(), F.greatest(minutes, F.lit(MINIMUM_DURATION)))


def fare_confidence(fare: Column) -> Column:
    return F.when(fare < 100, "High").otherwise("Medium")


def one_decimal(value: Column) -> Column:
    """One-decimal text, halves to even, as used inside a reason."""
    return F.format_string("%.1f", F.bround(value, 1))


def _speed_limit_rules(rain: Column, snow: Column) -> list[tuple[Column, Column, Column]]:
    """(condition, limit mph, reason) of every rule that lowers the ceiling; exclusive within a topic. Rain and snow in mm an hour."""
    snowing, raining, rush = F.col("is_snowing") == 1, F.col("is_raining") == 1, F.col("is_rush_hour") == 1
    manhattan, airport = F.col("pickup_is_manhattan") == 1, F.col("is_airport_trip") == 1

    def measured(text: str, reading: Column, mph: int) -> Column:
        return F.concat(F.lit(f"{text} ("), one_decimal(reading), F.lit(f"mm/hr) - max {mph} mph"))

    return [
        (snowing & (snow > 8), F.lit(25.0), measured("Extreme blizzard", snow, 25)),
        (snowing & (snow > 5) & (snow <= 8), F.lit(30.0), measured("Heavy snow", snow, 30)),
        (snowing & (snow > 2) & (snow <= 5), F.lit(40.0), measured("Moderate snow", snow, 40)),
        (raining & (rain > 7), F.lit(35.0), measured("Heavy rain", rain, 35)),
        (raining & (rain > 4) & (rain <= 7), F.lit(45.0), measured("Moderate rain", rain, 45)),
        (rush & manhattan, F.lit(20.0), F.lit("Manhattan rush hour - max 20 mph")),
        (rush & ~manhattan, F.lit(30.0), F.lit("Rush hour traffic - max 30 mph")),
        (rush & airport, F.lit(25.0), F.lit("Airport + rush hour - bridge/tunnel delays")),
        (rush & (F.col("weather_severity") >= 2), F.lit(18.0), F.lit("Combined: Weather + Traffic - max 18 mph")),
    ]


def calibration(
    predicted: str = "predicted_duration", distance: str = "estimated_distance", rain: str = "precipitation", snow: str = "snow"
) -> dict[str, dict[str, Column]]:
    """Stages of duration calibration, to be applied one after the other with with_stages; rain and snow name columns in mm an hour.

    Each limiting rule is a minimum, so their order does not matter; the late-night rule runs last
    because it raises the ceiling again.
    """
    pred, dist = F.col(predicted), F.col(distance)
    rules = _speed_limit_rules(F.col(rain), F.col(snow))
    quiet = (F.col("is_late_night") == 1) & (F.col("is_rush_hour") == 0) & (F.col("weather_severity") < 2)
    ceiling = F.least(F.lit(OPEN_ROAD_MPH), *[F.when(c, limit) for c, limit, _ in rules])
    limits = {
        "speed_limit": F.when(quiet, F.greatest(ceiling, F.lit(50.0))).otherwise(ceiling),
        "reasons": F.array_compact(
            F.array(*[F.when(c, why) for c, _, why in rules], F.when(quiet, F.lit("Late night empty roads - allow faster")))
        ),
    }
    bounds = {
        "min_duration": dist / F.col("speed_limit") * 60.0,
        "max_duration": dist / F.lit(GRIDLOCK_MPH) * 60.0,
    }
    low, high = pred < F.col("min_duration"), pred > F.col("max_duration")
    long_trip = (dist > 15) & (F.col("is_late_night") == 0)
    result = {
        "calibrated_duration": F.when(low, F.col("min_duration"))
        .when(high, F.col("max_duration"))
        .when(long_trip, F.least(pred * 1.3, F.col("max_duration")))
        .otherwise(pred * 1.1),
        "confidence": F.when(low, "Low (calibrated up)")
        .when(high, "Low (calibrated down)")
        .when(long_trip, "Medium (long trip buffer)")
        .otherwise("High (model reliable)"),
        "adjustment_kind": F.when(low, "physical constraint")
        .when(high, "capped")
        .when(long_trip, "long trip adjustment")
        .otherwise("minor adjustment"),
    }
    cal = F.col("calibrated_duration")
    report = {
        "adjustment": F.concat(
            F.when(high, "").otherwise("+"), one_decimal(cal - pred), F.lit(" min ("), F.col("adjustment_kind"), F.lit(")")
        ),
        "original_speed": F.coalesce(F.when(pred > 0, F.try_divide(dist, pred / 60.0)), F.lit(0.0)),
        "calibrated_speed": F.coalesce(F.when(cal > 0, F.try_divide(dist, cal / 60.0)), F.lit(0.0)),
        "improvement": F.try_divide(cal - pred, pred) * 100.0,
    }
    return {"limits": limits, "bounds": bounds, "result": result, "report": report}


def request_confidence(distance: Column, lon: Column, lat: Column, passengers: Column) -> Column:
    return (
        F.when((distance < 0.1) | (distance > 50), "low")
        .when(~lon.between(-74.05, -73.75), "low")
        .when(~lat.between(40.60, 40.90), "low")
        .when((passengers < 1) | (passengers > 6), "medium")
        .when((distance > 0.5) & (distance < 20), "high")
        .otherwise("medium")
    )


def request_violations() -> dict[str, Column]:
    """Range rules of a request; a missing required field counts as a violation of its rule."""
    ok = {
        "PULocationID": F.col("PULocationID").between(1, 265),
        "DOLocationID": F.col("DOLocationID").between(1, 265),
        "passenger_count": F.col("passenger_count").between(1, 6),
        "estimated_distance": (F.col("estimated_distance") > 0) & (F.col("estimated_distance") <= 50),
        "pickup_hour": F.col("pickup_hour").between(0, 23),
        "pickup_latitude": F.col("pickup_latitude").between(-90, 90),
        "pickup_longitude": F.col("pickup_longitude").between(-180, 180),
    }
    broken = F.array_compact(F.array(*[F.when(~F.coalesce(rule, F.lit(False)), F.lit(name)) for name, rule in ok.items()]))
    return {"violations": broken, "is_valid": flag(F.size(broken) == 0)}
