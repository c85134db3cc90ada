"""Hand-worked rows for each boundary."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from faremill.functions import calendar as cal, rules, weather as wx
from faremill.operators import errors, features, holidays, location, quality, sampling, scoring

# The dates of the finished calendar.
CALENDAR = """2021-12-31 2022-01-01 2022-01-02 2022-01-17 2022-01-31 2022-02-21 2022-03-16 2022-03-17 2022-03-18 2022-04-15 2022-04-17
2022-05-29 2022-05-30 2022-05-31 2022-06-11 2022-06-12 2022-06-13 2022-06-20 2022-07-03 2022-07-04 2022-07-05 2022-09-04 2022-09-05 2022-09-06
2022-10-10 2022-11-05 2022-11-06 2022-11-07 2022-11-11 2022-11-23 2022-11-24 2022-11-25 2022-11-26 2022-11-28 2022-12-23 2022-12-24 2022-12-25
2022-12-26 2022-12-27 2022-12-28 2022-12-29 2022-12-30 2022-12-31 2023-01-01""".split()


def trips(spark, rows):
    schema = "id int, fare_amount double, trip_distance double, trip_duration double, passenger_count double, PULocationID int, DOLocationID int"
    return spark.createDataFrame(rows, schema)


@pytest.mark.parametrize(
    "fare,distance,minutes,passengers,reason",
    [
        (10.0, 2.0, 10.0, 1.0, "kept"), (2.5, 0.1, 1.0, 1.0, "kept"), (250.0, 50.0, 180.0, 6.0, "kept"), (2.49, 2.0, 10.0, 1.0, "fare"), (250.01, 2.0, 10.0, 1.0, "fare"),
        (10.0, 0.09, 10.0, 1.0, "distance"), (10.0, 50.01, 60.0, 1.0, "distance"), (10.0, 2.0, 0.99, 1.0, "duration"), (10.0, 2.0, 180.1, 1.0, "duration"),
        (10.0, 2.0, 10.0, 0.0, "no_passengers"), (10.0, 2.0, 10.0, 7.0, "passengers"), (10.0, 16.9, 10.0, 1.0, "speed"), (None, 2.0, 10.0, 1.0, "missing_core"), (10.0, 2.0, 10.0, None, "missing_core"),
    ],
)
def test_cleaning_limits(spark, fare, distance, minutes, passengers, reason):
    df = trips(spark, [(1, fare, distance, minutes, passengers, 5, 9)])
    first = F
    for name, rule in quality.cleaning_rules().items():
        first = first.when(~F.coalesce(rule, F.lit(False)), name)
    row = df.select(first.otherwise("kept").alias("r"), quality.is_kept().alias("k")).first()
    assert row.r == reason
    assert row.k == (reason == "kept")
    assert quality.keep(df, *quality.deciding_rules()).count() == int(reason == "kept")


def test_short_trip_rules_alone(spark):
    df = trips(spark, [(1, 9.0, 0.05, 6.0, 1.0, 5, 9), (2, 9.0, 0.05, 4.0, 1.0, 5, 9), (3, 9.0, 0.05, 4.0, 1.0, 5, 5), (4, 9.0, 2.0, 6.0, 1.0, 5, 5)])
    assert [r.id for r in quality.keep(df, "zero_distance_long").orderBy("id").collect()] == [2, 3, 4]
    assert [r.id for r in quality.keep(df, "same_zone_short").orderBy("id").collect()] == [1, 2, 4]


def test_calendar_parts(spark):
    times = [dt.datetime(2022, 1, 1, 4), dt.datetime(2022, 1, 2, 5), dt.datetime(2022, 1, 3, 10), dt.datetime(2022, 12, 31, 22)]
    df = spark.createDataFrame([(t,) for t in times], "t timestamp_ntz").select(*[c.alias(n) for n, c in cal.calendar_parts("t").items()]).withColumns(cal.time_flags())
    rows = df.orderBy("pickup_dayofyear").collect()
    assert [r.pickup_weekday for r in rows] == [5, 6, 0, 5]
    assert [r.pickup_weekofyear for r in rows] == [52, 52, 1, 52]
    assert [r.is_weekend for r in rows] == [1, 1, 0, 1]
    assert [r.is_late_night for r in rows] == [1, 0, 0, 1]
    assert [r.is_rush_hour for r in rows] == [0, 0, 0, 0]
    assert [r.is_business_hours for r in rows] == [0, 0, 1, 0]


def test_right_closed_bands(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (1.01,), (3.0,), (5.0,), (10.0,), (50.0,), (60.0,)], "trip_distance double")
    bands = [r.distance_category for r in df.select(*[c.alias(n) for n, c in location.distance_features().items()]).collect()]
    assert bands == ["very_short", "very_short", "short", "short", "medium", "long", "very_long", "very_long"]
    temps = spark.createDataFrame([(32.0,), (32.1,), (50.0,), (65.0,), (80.0,), (80.1,), (None,)], "temperature double")
    assert [r.b for r in temps.select(wx.temp_category().alias("b")).collect()] == ["freezing", "cold", "cold", "cool", "warm", "hot", None]


@pytest.mark.parametrize(
    "rain,snow,wind,sight,score", [(0.0, 0.0, 20.0, 5.0, 0), (0.05, 0.0, 21.0, 5.0, 3), (0.1, 0.0, 0.0, 5.0, 2), (0.11, 0.0, 0.0, 4.9, 6), (0.0, 1.0, 0.0, None, 3), (0.2, 1.1, 30.0, 1.0, 12)]
)
def test_severity(spark, rain, snow, wind, sight, score):
    df = spark.createDataFrame([(rain, snow, wind, sight)], "precipitation double, snow double, wind_speed double, visibility double")
    row = df.select(*[c.alias(n) for n, c in wx.weather_flags().items()]).first()
    assert row.weather_severity == score
    assert row.is_extreme_weather == int(score >= 5)
    assert row.is_poor_visibility == int(sight is not None and sight < 5)


def test_calendar_has_the_listed_dates(spark):
    table = holidays.holiday_calendar(holidays.base_calendar(spark)).orderBy("date").collect()
    assert [r.date.isoformat() for r in table] == CALENDAR
    named = {r.date.isoformat(): r.name for r in table}
    assert named["2022-11-24"] == "Thanksgiving"
    assert named["2022-03-18"] == "Day After St. Patrick's Day"
    assert named["2022-11-26"] == "Day After Black Friday"


def _calibrated(spark, minutes, miles, **given):
    base = {"is_snowing": 0, "is_raining": 0, "snow": 0.0, "precipitation": 0.0, "is_rush_hour": 0, "is_late_night": 0, "is_airport_trip": 0, "pickup_is_manhattan": 1, "weather_severity": 0.0}
    values = {**base, **given, "predicted_duration": minutes, "estimated_distance": miles}
    return scoring.calibrate(spark.range(1).select(*[F.lit(v).alias(n) for n, v in values.items()])).first()


def test_calibration_worked_cases(spark):
    # Snow holds the road to 25 mph; severity 3 keeps the late-night rule out: 28.5 / 25 * 60 = 68.4.
    night = _calibrated(spark, 12.4, 28.5, is_snowing=1, snow=12.0, is_late_night=1, weather_severity=3.0)
    assert (night.speed_limit, round(night.calibrated_duration, 1), night.confidence) == (25.0, 68.4, "Low (calibrated up)")
    assert night.reasons == ["Extreme blizzard (12.0mm/hr) - max 25 mph"]
    assert night.adjustment == "+56.0 min (physical constraint)"
    # Rush hour with weather: 18 mph, 16.8 / 18 * 60 = 56.0.
    rain = _calibrated(spark, 14.0, 16.8, is_raining=1, precipitation=8.5, is_rush_hour=1, is_airport_trip=1, weather_severity=2.0)
    assert (rain.speed_limit, round(rain.calibrated_duration, 1)) == (18.0, 56.0)
    assert len(rain.reasons) == 4
    # 28.5 / 18 * 60 = 95.0.
    both = _calibrated(spark, 15.1, 28.5, is_snowing=1, snow=12.0, is_rush_hour=1, weather_severity=3.0)
    assert (both.speed_limit, round(both.calibrated_duration, 1)) == (18.0, 95.0)
    # Late night raises the ceiling again, and a short trip takes the small buffer.
    quiet = _calibrated(spark, 20.0, 10.0, is_late_night=1)
    assert (quiet.speed_limit, round(quiet.calibrated_duration, 6), quiet.confidence) == (60.0, 22.0, "High (model reliable)")
    slow = _calibrated(spark, 90.0, 10.0)
    assert (slow.calibrated_duration, slow.confidence) == (75.0, "Low (calibrated down)")


def test_error_edges(spark):
    scored = spark.createDataFrame([(0.0, 1.0), (2.0, 3.0), (4.0, 5.0)], "y_true double, y_pred double")
    row = errors.regression_metrics(scored).first()
    assert row.mae == 1.0 and row.rmse == 1.0 and row.mape == pytest.approx((50 + 25) / 2)
    tests = errors.error_tests(scored).first()
    assert tests.k2 is None and tests.t_statistic is None
    flat = errors.regression_metrics(spark.createDataFrame([(2.0, 3.0), (2.0, 3.0)], "y_true double, y_pred double")).first()
    assert flat.r2 is None


def test_splits_cover_everything(spark, sf):
    from faremill.plans import inputs
    from faremill.sources.views import HASH_KEY

    trips_ = inputs.clean(spark, sf).withColumn("split", sampling.month_split())
    counts = {r.split: r.trips for r in sampling.split_counts(trips_).collect()}
    assert sum(counts.values()) == trips_.count()
    hashed = trips_.groupBy(sampling.hash_split(HASH_KEY).alias("s")).count().collect()
    assert sum(r["count"] for r in hashed) == trips_.count()


def test_clean_and_rejected_make_all(spark, sf):
    from faremill.plans import inputs

    rows = {r.reason: r.trips for r in quality.rejection_waterfall(inputs.raw(spark, sf)).collect()}
    assert sum(rows.values()) == inputs.raw(spark, sf).count()
    assert rows["kept"] == inputs.clean(spark, sf).count()


def test_feature_contract():
    assert len(features.FEATURES) == len(set(features.FEATURES)) == 56
    assert not set(features.FEATURES) & set(features.FORBIDDEN)


def test_interaction_counts(spark):
    assert len(features.interactions_20()) == 20
    assert len(features.interactions_51()) == 51
    assert len(cal.cyclical_encoding()) == 8


def test_request_rules(spark):
    df = spark.createDataFrame([(0.05, -73.9, 40.7, 1), (5.0, -75.0, 40.7, 1), (5.0, -73.9, 40.7, 0), (5.0, -73.9, 40.7, 2), (0.5, -73.9, 40.7, 2)], "d double, lon double, lat double, p int")
    got = [r.c for r in df.select(rules.request_confidence(F.col("d"), F.col("lon"), F.col("lat"), F.col("p")).alias("c")).collect()]
    assert got == ["low", "low", "medium", "high", "medium"]
