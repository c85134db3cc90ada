"""Month files, stored statistics and the feed with a refreshing weather side."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from faremill.operators import holidays, models, scoring
from faremill.sources import trips as files
from faremill.streaming import jobs

HOUR = dt.datetime(2022, 5, 3, 14)


def weather_row(spark, rain):
    readings = {"temperature": 60.0, "feels_like": 60.0, "humidity": 50.0, "pressure": 30.0, "wind_speed": 5.0, "clouds": 10.0, "precipitation": rain, "snow": 0.0, "weather_severity": 1}
    flags = {"is_raining": int(rain > 0), "is_snowing": 0, "is_heavy_rain": 0, "is_heavy_snow": 0, "is_extreme_weather": 0, "is_poor_visibility": 0}
    return spark.createDataFrame([(HOUR,)], "datetime timestamp_ntz").select("*", *[F.lit(v).alias(n) for n, v in {**readings, **flags}.items()])


def feed_file(spark, path, rows):
    schema = "request_id long, request_time timestamp_ntz, pickup_datetime timestamp_ntz, PULocationID int, DOLocationID int, estimated_distance double"
    frame = spark.createDataFrame([(k, HOUR + dt.timedelta(minutes=m), HOUR, 50, 60, 10.0) for k, m in rows], schema).coalesce(1)
    frame.write.mode("append").parquet(path)
    return frame.schema


def test_weather_delivered_between_two_batches(spark, tmp_path):
    feed, weather, out, state = (str(tmp_path / n) for n in ("feed", "weather", "out", "state"))
    calendar = holidays.holiday_calendar(holidays.base_calendar(spark))

    def run(schema):
        stream = jobs.file_feed(spark, feed, schema)
        jobs.score_refreshing(stream, weather, calendar, out, state).awaitTermination()

    jobs.deliver_weather(weather_row(spark, 0.0), weather, 1)
    # 2 comes before 1, and 1 twice
    run(feed_file(spark, feed, [(2, 30), (1, 20), (1, 21)]))
    jobs.deliver_weather(weather_row(spark, 0.35), weather, 2)
    # 2 repeats within the delay; 3 is new; 4 is more than an hour behind what was seen
    run(feed_file(spark, feed, [(2, 31), (3, 40), (4, -120)]))
    got = {r["request_id"]: r["speed_limit"] for r in jobs.scored_batches(spark, out).collect()}
    assert len(got) == jobs.scored_batches(spark, out).count()
    # 0.35 inches an hour are 8.9 mm: heavy rain, at most 35 mph
    assert got == {1: 60.0, 2: 60.0, 3: 35.0}


def test_inches_reach_every_limit(spark):
    calendar = holidays.holiday_calendar(holidays.base_calendar(spark))
    request = spark.createDataFrame([(1, HOUR, 50, 60, 10.0)], "request_id long, pickup_datetime timestamp_ntz, PULocationID int, DOLocationID int, estimated_distance double")
    limits = {}
    for snowing in (0, 1):
        for inches in (0.05, 0.1, 0.2, 0.35):
            hour = weather_row(spark, inches).withColumn("is_snowing", F.lit(snowing)).withColumn("is_raining", F.lit(1 - snowing))
            limits[snowing, inches] = scoring.rule_scores(scoring.request_features(request, hour, calendar)).first()["speed_limit"]
    assert limits == {(0, 0.05): 60, (0, 0.1): 60, (0, 0.2): 45, (0, 0.35): 35, (1, 0.05): 60, (1, 0.1): 40, (1, 0.2): 30, (1, 0.35): 25}


def test_one_month_written_again(spark, tmp_path):
    path = str(tmp_path / "months")
    rows = spark.range(90).select("id", F.format_string("2022-%02d", F.col("id") % 3 + 1).alias("month"))
    files.write_months(rows, path)
    files.redo_months(rows.where("month = '2022-02' and id < 30"), path)
    back = files.scan_months(spark, path)
    assert {r["month"]: r["count"] for r in back.groupBy("month").count().collect()} == {"2022-01": 30, "2022-02": 10, "2022-03": 30}
    pruned = files.read_months(spark, path, rows.schema).where("month = '2022-02'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in pruned
    one = back.where("month = '2022-02'")
    assert all(".parquet" in f and "2022-02" in f for f in {r[0] for r in one.select(F.col("_metadata.file_path")).collect()}) and one.count() == 10


@pytest.mark.parametrize("population", [True, False])
def test_merged_moments_equal_one_pass(spark, population):
    rows = spark.range(400).select(
        (F.col("id") % 5).alias("month"), F.lit("train").alias("split"), (F.col("id") * 1.5 + 1e6).alias("x"), F.lit(0.1).alias("same"),
        F.when(F.col("id") % 7 == 0, float("nan")).when(F.col("id") % 11 == 0, None).otherwise(F.col("id") % 13).alias("holes"),
    )
    names = ["x", "same", "holes"]
    want = models.standardize(rows, names, population=population).select(*[F.round(c, 9) for c in names]).collect()
    merged = models.merge_moments(models.moments_by(rows, names, "month"))
    got = models.standardize_by(rows, names, merged, population=population).select(*[F.round(c, 9) for c in names]).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))
