"""Operators against brute force on skewed fixtures, and their way beyond the broadcast bound."""

import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from faremill.operators import correlations, errors, location, quantiles, sampling, weather
from faremill.operators.quantiles import exact_quantiles, quantile_row, value_bucket
from faremill.streaming import jobs


def test_exact_quantiles_match_numpy_on_skew(spark):
    random.seed(3)
    values = [7.25] * 4000 + [random.uniform(-50, 50) for _ in range(3000)] + [random.expovariate(1e-3) for _ in range(3000)] + [0.0] * 500
    df = spark.createDataFrame([(i % 3, v, None if i % 7 == 0 else v * 2) for i, v in enumerate(values)], "g int, x double, y double")
    probs = [0.0, 0.05, 0.5, 0.95, 0.999, 1.0]
    got = {(r.metric, round(r.p, 3)): r.value for r in exact_quantiles(df, ["x", "y"], probs).collect()}
    for name, sample in (("x", values), ("y", [v * 2 for i, v in enumerate(values) if i % 7])):
        for p in probs:
            assert got[(name, p)] == pytest.approx(np.percentile(sample, p * 100), abs=1e-9)
    grouped = {r.g: r.x_p50 for r in quantile_row(df, ["x"], [0.5], by=("g",)).collect()}
    for g in range(3):
        assert grouped[g] == pytest.approx(np.median([v for i, v in enumerate(values) if i % 3 == g]), abs=1e-9)


def test_value_bucket_keeps_order(spark):
    values = sorted([-1e300, -3.5, -1e-300, 0.0, 1e-300, 1e-5, 1.0, 1.0000001, 2.0, 1e9, 1e300])
    buckets = [r.b for r in spark.createDataFrame([(v,) for v in values], "v double").select("v", value_bucket(F.col("v")).alias("b")).orderBy("v").collect()]
    assert buckets == sorted(buckets)


def test_quantiles_leave_out_missing_and_nan(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,), (3.0,)], "x double")
    assert exact_quantiles(df, ["x"], [0.5]).first().value == 2.0


def test_prior_route_means_by_brute_force(spark):
    random.seed(5)
    start = dt.datetime(2022, 3, 1)
    rows = [(i, 1 if i % 3 else random.randint(1, 3), 2, start + dt.timedelta(seconds=random.randint(0, 9000)), float(i % 11), float(i % 7), float(i % 5)) for i in range(400)]
    df = spark.createDataFrame(rows, "id int, PULocationID int, DOLocationID int, tpep_pickup_datetime timestamp_ntz, trip_distance double, trip_duration double, fare_amount double")
    got = {r.id: r for r in location.route_profile_prior(df).collect()}
    assert len(got) == len(rows)
    for row in rows:
        earlier = [x for x in rows if x[1] == row[1] and x[2] == row[2] and x[3] < row[3]]
        assert got[row[0]].prior_trips == len(earlier)
        if earlier:
            assert got[row[0]].prior_fare == pytest.approx(sum(x[6] for x in earlier) / len(earlier))
        else:
            assert got[row[0]].prior_fare is None


def _miles(a, b):
    lat1, lon1, lat2, lon2 = map(math.radians, (*a, *b))
    h = math.sin((lat2 - lat1) / 2) ** 2 + math.cos(lat1) * math.cos(lat2) * math.sin((lon2 - lon1) / 2) ** 2
    return 6371.0 * 2 * math.asin(math.sqrt(h)) * 0.621371


def test_nearest_zone_by_brute_force(spark):
    random.seed(9)
    zones = [(i, 40.5 + random.random() * 0.5, -74.3 + random.random() * 0.6) for i in range(1, 60)]
    points = [(i, 40.3 + random.random(), -74.6 + random.random() * 1.2) for i in range(300)] + [(300, -10.0, 100.0)]
    zdf = spark.createDataFrame(zones, "LocationID int, lat double, lon double")
    pdf = spark.createDataFrame(points, "id int, lat double, lon double")
    got = {r.id: r.nearest_zone_id for r in location.nearest_zone(pdf, zdf).collect()}
    for pid, lat, lon in points:
        assert got[pid] == min(zones, key=lambda z: (round(_miles((lat, lon), z[1:]), 9), z[0]))[0]


def test_point_in_concave_zone(spark):
    ring = [(0.0, 0.0), (0.0, 0.05), (0.05, 0.05), (0.05, 0.03), (0.02, 0.025), (0.05, 0.02), (0.05, 0.0)]
    zdf = spark.createDataFrame([(7, [dict(lat=a, lon=b) for a, b in ring])], "LocationID int, ring array<struct<lat:double,lon:double>>")
    pdf = spark.createDataFrame([(1, 0.01, 0.025), (2, 0.04, 0.025), (3, 0.04, 0.01), (4, 0.06, 0.01)], "id int, lat double, lon double")
    got = {r.id: r.zone_id for r in location.point_in_zone(pdf, zdf).collect()}
    assert got == {1: 7, 2: None, 3: 7, 4: None}


def test_nearest_hour_at_the_ends_and_ties(spark):
    base = dt.datetime(2022, 1, 1)
    obs = spark.createDataFrame([(base + dt.timedelta(hours=h), float(h)) for h in (2, 3, 7)], "datetime timestamp_ntz, temperature double")
    asked = spark.createDataFrame([(h, base + dt.timedelta(hours=h, minutes=30)) for h in (0, 2, 4, 5, 6, 9)], "id int, pickup_datetime timestamp_ntz")
    got = {r.id: r.obs.temperature for r in weather.nearest_hour(asked, obs).collect()}
    assert got == {0: 2.0, 2: 2.0, 4: 3.0, 5: 3.0, 6: 7.0, 9: 7.0}


def test_sample_per_group_takes_the_lowest_hashes(spark):
    rows = [(i % 2 if i % 3 else 0, i, i * 7, 1, 2) for i in range(2000)]
    df = spark.createDataFrame(rows, "g int, l_orderkey long, l_partkey long, l_linenumber int, l_suppkey long")
    key = ["l_orderkey", "l_partkey", "l_linenumber", "l_suppkey"]
    got = sampling.sample_per_group(df, "g", 150, key, key).collect()
    for g in (0, 1):
        mine = [(o * 7919 + p * 104729 + n * 1709 + s * 31) % 1_000_003 for gg, o, p, n, s in rows if gg == g]
        kept = [(r.l_orderkey * 7919 + r.l_partkey * 104729 + 1709 + 62) % 1_000_003 for r in got if r.g == g]
        assert sorted(kept) == sorted(mine)[:150]


def test_correlation_of_gaps_and_constants(spark):
    rng = np.random.default_rng(1)
    x, y = rng.normal(40, 5, 500), rng.normal(0, 1, 500)
    rows = [(float(a), float(a * 2 + b) if i % 5 else None, 0.05) for i, (a, b) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "x double, y double, flat double").repartition(5)
    got = {(r.a, r.b): r.r for r in correlations.correlation_pairs(df, ["x", "flat"], ["y", "x"]).collect()}
    pairs = [(a, b) for a, b, _ in rows if b is not None]
    assert got[("x", "y")] == pytest.approx(np.corrcoef(*zip(*pairs))[0, 1], abs=1e-9)
    assert got[("x", "x")] == pytest.approx(1.0)
    assert got[("flat", "y")] is None


def test_quantile_bins_merge_equal_edges(spark):
    df = spark.createDataFrame([(float(v),) for v in [1] * 60 + [2] * 20 + list(range(3, 23))], "f double")
    bins = errors.quantile_bins(df, "f", 5).groupBy("bin_no", "bin_low", "bin_high").count().orderBy("bin_no").collect()
    # Quantiles at 0, 20, 40, 60, 80, 100 %: 1, 1, 1, 1.4, 2.2, 22.
    assert [(round(b.bin_low, 9), round(b.bin_high, 9), b["count"]) for b in bins] == [(1.0, 1.4, 60), (1.4, 2.2, 20), (2.2, 22.0, 20)]


def test_stream_drops_late_rows_and_repeats(spark, tmp_path):
    base = dt.datetime(2022, 1, 3)
    schema = "ts timestamp_ntz, y_true double, y_pred double"
    source = str(tmp_path / "in")
    for day in (0, 8, 20):
        spark.createDataFrame([(base + dt.timedelta(days=day, hours=h), 10.0 + h, 11.0 + h) for h in range(3)], schema).coalesce(1).write.mode("append").parquet(source)
    spark.createDataFrame([(base, 10.0, 99.0)], schema).coalesce(1).write.mode("append").parquet(source)
    feed = jobs.file_feed(spark, source, spark.read.parquet(source).schema)
    weeks = jobs.monitor_stream(feed, "ts")
    jobs.run_to_table(weeks, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    rows = spark.read.parquet(str(tmp_path / "out")).orderBy("week_start").collect()
    assert [r.n for r in rows] == [3, 3]
    assert all(r.mae == 1.0 for r in rows)


def test_nearest_zone_among_many_zones_and_around_the_globe(spark):
    """A hundred thousand zones, some clumped, points in the clump, far away, at the poles and beyond the date line."""
    rng = np.random.default_rng(3)
    lat = np.concatenate([40 + rng.random(90_000) * 2, rng.random(9_990) * 170 - 85, [89.99, -89.99, 10.0, 10.0, 0.0, 0, 0, 0, 0, 0]])
    lon = np.concatenate([-75 + rng.random(90_000) * 2, rng.random(9_990) * 359 - 179.5, [20.0, 20.0, 179.99, -179.99, 0.0, 0, 0, 0, 0, 0]])
    zones = spark.createDataFrame([(k + 1, float(a), float(b)) for k, (a, b) in enumerate(zip(lat, lon))], "LocationID int, lat double, lon double")
    points = np.concatenate([np.column_stack([40 + rng.random(150) * 2, -75 + rng.random(150) * 2]), np.column_stack([rng.random(60) * 178 - 89, rng.random(60) * 358 - 179]), [[89.9, -170], [-89.95, 3], [10, 179.999], [10.001, -179.9999], [0, 0]]])
    rows = [(k, float(a), float(b)) for k, (a, b) in enumerate(points)] + [(999, None, 1.0)]
    got = {r["id"]: (r["nearest_zone_id"], r["nearest_miles"]) for r in location.nearest_zone(spark.createDataFrame(rows, "id int, lat double, lon double"), zones).collect()}
    assert got.pop(999) == (None, None) and len(got) == len(points)
    y, x = np.radians(lat), np.radians(lon)
    for k, (a, b) in enumerate(np.radians(points)):
        h = np.sin((y - a) / 2) ** 2 + np.cos(a) * np.cos(y) * np.sin((x - b) / 2) ** 2
        miles = np.round(6371.0 * 2 * np.arcsin(np.sqrt(np.minimum(h, 1))) * 0.621371, 9)
        best = miles.min()
        assert abs(got[k][1] - best) < 2e-9 and abs(miles[got[k][0] - 1] - best) < 2e-9


def test_error_bins_shuffle_rows_next_to_a_median_or_an_edge_only(spark, monkeypatch):
    rng = np.random.default_rng(5)
    n = 20_000
    x, y = rng.exponential(3, n), rng.normal(0, 40, n)
    guess = np.where(rng.random(n) < 0.2, y, y + rng.normal(0, 9, n))
    rows = [(g, float(a) if i % 13 else None, float(i % 3), 5.0, float(t), float(p)) for i, (g, a, t, p) in enumerate(zip(np.where(rng.random(n) < 0.3, "one", "two").tolist(), x, y, guess))]
    df = spark.createDataFrame(rows, "target string, x double, few double, same double, y_true double, y_pred double").repartition(6)
    kept, write = [], quantiles.written_table
    monkeypatch.setattr(quantiles, "written_table", lambda df, name, *a: kept.append((name, write(df, name, *a))) or kept[-1][1])
    # nothing counts all values
    monkeypatch.setattr(quantiles, "value_counts", None)
    got = {(r["target"], r["feature"], r["bin_no"], r["bin_low"]): r for r in errors.error_by_quantile_bin(df, {"x": 8, "few": None, "same": 4}, ("target",)).collect()}
    medians = [t for name, t in kept if name == "value-counts"][-1]
    assert 0 < medians.count() < n / 10
    want = 0
    for g in ("one", "two"):
        mine = [r for r in rows if r[0] == g]
        with_x = [r for r in mine if r[1] is not None]
        edges = np.quantile([r[1] for r in with_x], [k / 8 for k in range(9)])
        parts = [(("x", k + 1, edges[k], edges[k + 1]), [r for r in with_x if (r[1] > edges[k] or k == 0) and r[1] <= edges[k + 1]]) for k in range(8)]
        parts += [(("few", 0, v, v), [r for r in mine if r[2] == v]) for v in (0.0, 1.0, 2.0)]
        for (name, number, low, high), some in parts:
            found = [r for (t, f, b, start), r in got.items() if (t, f, b) == (g, name, number) and start == pytest.approx(low, abs=1e-9)]
            raw = np.array([r[5] - r[4] for r in some])
            assert len(found) == 1 and found[0]["rows"] == len(some) and found[0]["bin_high"] == pytest.approx(high, abs=1e-9)
            told = [found[0][c] for c in ("mean_abs", "median_abs", "mean_raw")]
            assert told == pytest.approx([np.abs(raw).mean(), np.median(np.abs(raw)), raw.mean()], abs=1e-9)
            want += 1
    # a feature of one value has no upper edge, and no row
    assert len(got) == want


def test_quantiles_read_twice_are_those_of_all_values(spark):
    rng = np.random.default_rng(6)
    cells = [(int(k % 3) or None, float(v), None if k % 5 == 0 else float(round(v)), [float("inf"), float("-inf"), float("nan"), 0.0, -1e-300, 1e300][k % 6]) for k, v in enumerate(rng.normal(1e9, 300, 4000))]
    df = spark.createDataFrame(cells, "g int, a double, b double, c double").repartition(5)
    probs = [0.0, 0.1, 0.5, 0.999, 1.0]
    for by in ((), ("g",)):
        want, got = (sorted(map(str, f(df, ["a", "b", "c"], probs, by).collect())) for f in (exact_quantiles, quantiles.exact_quantiles_reread))
        assert got == want and want
