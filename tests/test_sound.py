"""Results that must not depend on the session's time zone, on the size of the numbers or on where readings lie."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from faremill.operators import quantiles
from faremill.operators.correlations import correlation_pairs
from faremill.operators.quantiles import exact_quantiles
from faremill.operators.weather import nearest_hour
from faremill.session import shared_dir

QUERIES = entry.queries()


@pytest.mark.parametrize("name", ["trip_duration_minutes", "clean_trips", "safe_features", "impute_weather", "weekly_monitor", "stream_monitor", "route_profile_prior"])
def test_rows_do_not_depend_on_the_time_zone(spark, sf, name):
    found = []
    for zone in ("UTC", "America/New_York"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            found.append(sorted(map(str, QUERIES[name](spark, sf).collect())))
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert found[0] == found[1] and found[0]


def test_correlation_of_large_numbers(spark):
    rows = spark.range(0, 5000, 1, 7).select((F.col("id") + 1e9).alias("x"), F.col("id").cast("double").alias("y"), F.lit(0.1).alias("c"), (-F.col("id") * 1e-9).alias("z"))
    r = {(p["a"], p["b"]): p["r"] for p in correlation_pairs(rows, ["x", "c"], ["y", "z"]).collect()}
    assert r["x", "y"] == pytest.approx(1, abs=1e-12) and r["x", "z"] == pytest.approx(-1, abs=1e-12)
    assert r["c", "y"] is None and r["c", "z"] is None


def test_quantiles_with_infinities(spark):
    inf = float("inf")
    rows = spark.createDataFrame([(v,) for v in [-inf, 1.0, 2.0, 3.0, inf, inf, float("nan"), None]], "v double")
    got = {q["p"]: q["value"] for q in exact_quantiles(rows, ["v"], [0.0, 0.2, 0.4, 0.5, 0.8, 1.0]).collect()}
    assert got == {0.0: -inf, 0.2: 1.0, 0.4: 2.0, 0.5: 2.5, 0.8: inf, 1.0: inf}


def test_nearest_hour_against_brute_force(spark):
    rng = random.Random(3)
    start = dt.datetime(2022, 3, 1)
    at = [start + dt.timedelta(minutes=rng.randrange(60 * 24 * 40)) for _ in range(60)]
    readings = [(t, float(k)) for k, t in enumerate(at)] + [(at[0], 99.0), (at[1], -1.0)]
    asked = [(k, start + dt.timedelta(minutes=rng.randrange(-3000, 60 * 24 * 43))) for k in range(300)] + [(999, None)]
    weather = spark.createDataFrame(readings, "datetime timestamp_ntz, temperature double")
    requests = spark.createDataFrame(asked, "request_id int, pickup_datetime timestamp_ntz")
    got = {r["request_id"]: r["obs"] for r in nearest_hour(requests, weather).collect()}
    least = {}
    for t, v in readings:
        least[t] = min(v, least.get(t, v))
    for k, t in asked:
        if t is None:
            assert got[k] is None
            continue
        hour = t.replace(minute=0)
        best = min(least, key=lambda x: (abs(x - hour), x))
        assert (got[k]["datetime"], got[k]["temperature"]) == (best, least[best])
    assert len(got) == len(asked)


def test_scratch_folder_must_be_shared():
    class Conf:
        def get(self, key, default):
            return default

    class Session:
        conf = Conf()

        class sparkContext:
            master = "spark://host:7077"

    with pytest.raises(ValueError):
        shared_dir(Session())


def test_quantiles_of_tight_columns_spread_over_tasks(spark):
    """A million readings from a billion up fall into two value buckets; the sorting is dealt by their even parts."""
    df = spark.range(1_000_000).select((F.lit(1e9) + (F.col("id") * 7919) % 1_000_003).alias("x"))
    values = np.sort(np.array([r[0] for r in df.collect()]))
    probs = [0.0, 0.01, 0.25, 0.5, 0.777, 0.99, 1.0]
    got = {r["p"]: r["value"] for r in quantiles.exact_quantiles(df, ["x"], probs).collect()}
    assert all(got[p] == np.quantile(values, p) for p in probs)
    buckets = df.select(quantiles.value_bucket(F.col("x")).alias("b"), "x")
    assert buckets.select("b").distinct().count() <= 3
    ends = buckets.groupBy("b").agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    parts = buckets.join(F.broadcast(ends), "b").groupBy("b", F.floor((F.col("x") - F.col("lo")) / (F.col("hi") - F.col("lo")) * quantiles.PARTS)).count()
    assert parts.agg(F.max("count")).first()[0] < 1000


def test_quantiles_of_clustered_values(spark):
    rng = np.random.default_rng(6)
    x = np.concatenate([rng.normal(size=3000), 1e9 + rng.random(3000) * 1e-3, np.full(500, 7.25), -1e12 - rng.integers(0, 50, 800), [np.inf, -np.inf, 0.0, -0.0, 5e-324]])
    df = spark.createDataFrame([(float(v), int(k % 2)) for k, v in enumerate(x)], "x double, g int")
    probs = [0.05, 0.3, 0.31, 0.6, 0.95]
    got = {(r["g"], r["p"]): r["value"] for r in quantiles.exact_quantiles(df, ["x"], probs, ("g",)).collect()}
    for g in (0, 1):
        assert np.allclose([got[g, p] for p in probs], np.quantile(x[g::2], probs), rtol=1e-15, atol=0)
