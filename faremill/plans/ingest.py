"""Queries: scans, sinks, cleaning, caps and audits."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from faremill.functions.basics import flag
from faremill.functions.rules import request_violations
from faremill.operators import features, profiles, quality, sampling, weather
from faremill.plans import inputs
from faremill.plans.inputs import tidy
from faremill.plans.registry import query
from faremill.plans.sql import KEPT, KEYS, i, r, sql
from faremill.session import fresh_path
from faremill.sources import trips as files, views
from faremill.sources.views import KEY

PROBS = [0.5, 0.75, 0.9, 0.95, 0.99, 0.995, 0.999]


@query(
    "scan_months",
    sql(f"select {KEYS}, strftime(tpep_pickup_datetime, '%Y-%m') as month, PULocationID, DOLocationID, {r('fare_amount', 'fare_amount')} from trips", "trips"),
)
def scan_months(spark, sf):
    """Trips written by month, and read back with the month their files name."""
    path = fresh_path(spark, "raw-months")
    files.write_months(inputs.raw(spark, sf).withColumn("month", files.month_tag()), path)
    return tidy(files.scan_months(spark, path).select(*KEY, "month", "PULocationID", "DOLocationID", "fare_amount"))


@query(
    "write_month_partitions",
    sql(f"select strftime(tpep_pickup_datetime, '%Y-%m') as month, count(*) as trips, {r('avg(fare_amount)', 'avg_fare')} from clean group by 1", "clean"),
)
def write_month_partitions(spark, sf):
    months = inputs.clean(spark, sf).withColumn("month", files.month_tag())
    path = fresh_path(spark, "months")
    files.write_months(months, path)
    back = files.read_months(spark, path, months.schema)
    return tidy(back.groupBy("month").agg(F.count("*").alias("trips"), F.avg("fare_amount").alias("avg_fare")))


@query(
    "redo_month",
    sql(
        f"""select strftime(tpep_pickup_datetime, '%Y-%m') as month, count(*) as trips, {r('avg(fare_amount)', 'avg_fare')}, min(tpep_pickup_datetime) as first_pickup, max(tpep_pickup_datetime) as last_pickup
from clean where month(tpep_pickup_datetime) = 3 or payment_type <> 3 group by 1""",
        "clean",
    ),
)
def redo_month(spark, sf):
    """Months delivered without one payment type; March alone is then written again in full, and the files name the month."""
    months = inputs.clean(spark, sf).withColumn("month", files.month_tag())
    path = fresh_path(spark, "redone-months")
    files.write_months(months.where("payment_type <> 3"), path)
    files.redo_months(months.where(F.month("tpep_pickup_datetime") == 3), path)
    back = files.scan_months(spark, path).groupBy("month").agg(
        F.count("*").alias("trips"), F.avg("fare_amount").alias("avg_fare"), F.min("tpep_pickup_datetime").alias("first_pickup"), F.max("tpep_pickup_datetime").alias("last_pickup")
    )
    return tidy(back)


def _split_sql() -> str:
    parts = {"x": features.FEATURES, "y_duration": ("trip_duration",), "y_fare": ("fare_amount",)}
    sums = ", ".join(f"sum({c}) as {c}" for names in parts.values() for c in names)
    rows = [f"select '{p}' as part, '{c}' as column_name, {len(names)}::int as value_columns, n as trips, {r(c, 'checksum', 2)} from s" for p, names in parts.items() for c in names]
    return sql(f"with s as (select count(*) as n, {sums} from feat) {' union all '.join(rows)}", "feat")


@query("split_xy", _split_sql())
def split_xy(spark, sf):
    table = features.safe_features(inputs.clean(spark, sf), inputs.hours(spark, sf), inputs.calendar(spark), KEY)
    x, fare, minutes = features.split_xy(table, KEY)
    rows = []
    for part, frame in (("x", x), ("y_fare", fare), ("y_duration", minutes)):
        names = [c for c in frame.columns if c not in KEY]
        sums = frame.agg(F.count("*").alias("trips"), *[F.round(F.sum(F.col(c).cast("double")) + inputs.NUDGE, 2).alias(c) for c in names])
        pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("checksum")) for c in names])
        rows.append(sums.select(F.lit(part).alias("part"), F.lit(len(names)).alias("value_columns"), "trips", F.inline(pairs)))
    return files.concat_months(rows)


@query(
    "read_calendar_csv",
    sql(
        """select c.date, c.name, c.type, c.major, c.day_of_week, (select count(*) from trips t where t.tpep_pickup_datetime::date = c.date) as trips from calendar c""",
        "calendar", "trips",
    ),
)
def read_calendar_csv(spark, sf):
    per_day = inputs.raw(spark, sf).groupBy(F.to_date("tpep_pickup_datetime").alias("date")).agg(F.count("*").alias("trips"))
    dated = inputs.calendar(spark).join(per_day, "date", "left").na.fill(0, ["trips"])
    path = fresh_path(spark, "calendar")
    files.write_report(dated, path)
    return files.read_calendar(spark, path, (T.StructField("trips", T.LongType()),))


@query(
    "read_zone_csv",
    sql(
        """select LocationID, Borough, Zone, service_zone, (select count(*) from trips t where t.PULocationID = z.LocationID) as pickups from zones z""", "zones", "trips"
    ),
)
def read_zone_csv(spark, sf):
    pickups = inputs.raw(spark, sf).groupBy(F.col("PULocationID").alias("LocationID")).agg(F.count("*").alias("pickups"))
    counted = views.zones(spark).drop("lat", "lon").join(pickups, "LocationID", "left").na.fill(0, ["pickups"])
    path = fresh_path(spark, "zones")
    files.write_report(counted, path)
    return files.read_zones(spark, path, (T.StructField("pickups", T.LongType()),))


@query("distinct_trip_dates", sql("select distinct tpep_pickup_datetime::date as pickup_date from trips", "trips"))
def distinct_trip_dates(spark, sf):
    return files.distinct_dates(inputs.raw(spark, sf)).orderBy("pickup_date")


@query(
    "weather_from_json",
    sql(
        f"""select datetime, temperature, feels_like, humidity, {r('nullif(pressure_hpa, 0) * 0.02953', 'pressure')}, wind_speed, clouds,
{r('nullif(visibility, 0) / 1609.34', 'visibility', 9)}, {r('precipitation', 'precipitation')}, snow,
coalesce(m.main, 'Unknown') as weather_main, coalesce(m.description, 'unknown') as weather_description
from wflags w left join wmo m on m.code = w.weathercode""",
        "wflags", "wmo",
    ),
)
def weather_from_json(spark, sf):
    return tidy(weather.parse_payload(views.weather_payload(inputs.readings(spark, sf))), visibility=9)


@query(
    "concat_months",
    sql(f"select {KEYS}, pickup_month, {r('trip_distance', 'trip_distance')}, {r('fare_amount', 'fare_amount')}, {r('trip_duration', 'trip_duration')} from clean", "clean"),
)
def concat_months(spark, sf):
    trips = inputs.clean(spark, sf)
    halves = [trips.where("pickup_month <= 6"), trips.where("pickup_month > 6")]
    x = files.concat_months([h.select(*KEY, "pickup_month", "trip_distance") for h in halves])
    y = files.concat_months([h.select(*KEY, "fare_amount", "trip_duration") for h in halves])
    return tidy(x.join(y, KEY))


MONTH_REPORT = f"""with m as (select strftime(tpep_pickup_datetime, '%Y-%m') as month, count(*) as raw_count, count(*) filter ({KEPT}) as clean_count,
  avg(fare_amount) filter ({KEPT}) as f, avg(trip_duration) filter ({KEPT}) as d, avg(trip_distance) filter ({KEPT}) as s from trips group by 1),
p as (select *, raw_count - clean_count as removed_count, (raw_count - clean_count) * 100.0::double / raw_count as pct from m),
report as (select month, raw_count, clean_count, removed_count, {r('pct', 'removed_pct')}, {r('f', 'avg_fare')}, {r('d', 'avg_duration')}, {r('s', 'avg_distance')} from p
union all select 'TOTAL', sum(raw_count)::bigint, sum(clean_count)::bigint, sum(removed_count)::bigint, {r('avg(pct)', 'removed_pct')}, {r('avg(f)', 'avg_fare')}, {r('avg(d)', 'avg_duration')}, {r('avg(s)', 'avg_distance')} from p)
select * from report"""


@query("write_report_csv", sql(MONTH_REPORT, "trips"))
def write_report_csv(spark, sf):
    report = tidy(profiles.monthly_quality_report(inputs.raw(spark, sf)))
    path = fresh_path(spark, "report")
    files.write_report(report, path)
    return spark.read.csv(path, header=True, schema=report.schema)


@query(
    "write_params_json",
    sql(f"select {r('quantile_cont(trip_duration, 0.95)', 'duration_cap')}, {r('quantile_cont(trip_distance, 0.99)', 'distance_cap')} from clean", "clean"),
)
def write_params_json(spark, sf):
    caps = tidy(quality.caps(inputs.clean(spark, sf), distance="trip_distance"))
    path = fresh_path(spark, "caps")
    files.write_params(caps, path)
    return spark.read.json(path, schema=caps.schema)


_PROFILE_TYPES = {
    "tpep_pickup_datetime": "timestamp_ntz", "tpep_dropoff_datetime": "timestamp_ntz", "PULocationID": "int", "DOLocationID": "int", "trip_distance": "double",
    "passenger_count": "double", "fare_amount": "double", "trip_duration": "double", "pickup_hour": "int", "pickup_day": "int", "pickup_month": "int",
    "pickup_weekday": "int", "pickup_date": "date", "pickup_dayofyear": "int", "pickup_weekofyear": "int", "is_weekend": "int",
}


def _profile_sql() -> str:
    rows = []
    for name, kind in _PROFILE_TYPES.items():
        stats = {"min": f"min({name})", "max": f"max({name})", "mean": f"avg({name})", "median": f"quantile_cont({name}, 0.5)", "std": f"stddev_samp({name})"}
        target = name in ("fare_amount", "trip_duration")
        cells = ", ".join(r(e, f'"{s}"') if target else f'null::double as "{s}"' for s, e in stats.items())
        rows.append(f"select '{name}' as column_name, '{kind}' as data_type, count(*) as rows, {cells} from clean")
    return sql(" union all ".join(rows), "clean")


@query("dataset_profile", _profile_sql())
def dataset_profile(spark, sf):
    return tidy(profiles.dataset_profile(inputs.clean(spark, sf).drop(*KEY), features.TARGETS))


# Cleaning ---------------------------------------------------------------------------------------

SHOWN = f"{KEYS}, {r('fare_amount', 'fare_amount')}, {r('trip_distance', 'trip_distance')}, {r('trip_duration', 'trip_duration')}, passenger_count"


def shown(df):
    return tidy(df.select(*KEY, "fare_amount", "trip_distance", "trip_duration", "passenger_count"))


@query("trip_duration_minutes", sql(f"select {KEYS}, {r('epoch(tpep_dropoff_datetime - tpep_pickup_datetime) / 60', 'trip_duration')} from trips", "trips"))
def trip_duration_minutes(spark, sf):
    return tidy(inputs.timed(spark, sf).select(*KEY, "trip_duration"))


def _filter_query(name: str, rules: tuple[str, ...], condition: str) -> None:
    @query(name, sql(f"select {SHOWN} from trips where {condition}", "trips"))
    def run(spark, sf):
        return shown(quality.keep(inputs.timed(spark, sf), *rules))


_filter_query(
    "drop_missing_core", ("missing_core",), "fare_amount is not null and trip_distance is not null and trip_duration is not null and passenger_count is not null"
)
_filter_query("filter_fare", ("fare",), "fare_amount >= 2.5 and fare_amount <= 250")
_filter_query("filter_distance", ("distance",), "trip_distance >= 0.1 and trip_distance <= 50")
_filter_query("filter_duration", ("duration",), "trip_duration >= 1 and trip_duration <= 180")
_filter_query("filter_passengers", ("no_passengers", "passengers"), "passenger_count > 0 and passenger_count <= 6 and passenger_count >= 1")
_filter_query("filter_zero_distance_long", ("zero_distance_long",), "not (trip_distance < 0.1 and trip_duration > 5)")
_filter_query("filter_speed", ("speed",), "trip_duration > 0 and trip_distance / (trip_duration / 60) <= 100")
_filter_query("filter_same_zone_short", ("same_zone_short",), "not (PULocationID = DOLocationID and trip_distance < 0.1)")


@query(
    "clean_trips",
    sql(
        f"""select {KEYS}, tpep_pickup_datetime, tpep_dropoff_datetime, PULocationID, DOLocationID, {r('trip_distance', 'trip_distance')}, passenger_count,
{r('fare_amount', 'fare_amount')}, {r('trip_duration', 'trip_duration')}, pickup_hour, pickup_day, pickup_month, pickup_weekday, pickup_date, pickup_dayofyear, pickup_weekofyear, is_weekend from clean""",
        "clean",
    ),
)
def clean_trips(spark, sf):
    return tidy(inputs.clean(spark, sf))


@query(
    "rejection_waterfall",
    sql(
        f"""with w as (select case when fare_amount is null or trip_distance is null or trip_duration is null or passenger_count is null then 'missing_core'
  when passenger_count <= 0 then 'no_passengers' when fare_amount < 2.5 or fare_amount > 250 then 'fare' when trip_distance < 0.1 or trip_distance > 50 then 'distance'
  when trip_duration < 1 or trip_duration > 180 then 'duration' when passenger_count > 6 then 'passengers'
  when trip_distance / (trip_duration / 60) > 100 then 'speed' else 'kept' end as reason from trips)
select reason, count(*) as trips, {r('count(*) * 100.0::double / (select count(*) from w)', 'pct')} from w group by 1""",
        "trips",
    ),
)
def rejection_waterfall(spark, sf):
    return tidy(quality.rejection_waterfall(inputs.raw(spark, sf)))


CAPS = "caps as (select quantile_cont(trip_duration, 0.95) as dc, quantile_cont(estimated_distance, 0.99) as sc from flagged)"


@query(
    "outlier_caps",
    sql(
        f"""with {CAPS} select {r('max(dc)', 'duration_cap')}, {r('max(sc)', 'distance_cap')}, count(*) filter (trip_duration > dc) as duration_above,
count(*) filter (estimated_distance > sc) as distance_above, count(*) as trips from flagged, caps""",
        "flagged",
    ),
)
def outlier_caps(spark, sf):
    return tidy(quality.outlier_caps(inputs.flagged(spark, sf)))


def _exceed_sql() -> str:
    rows = [
        f"""select '{c}' as metric, {r(str(p * 100) + '::double', 'percentile')}, {r('max(v)', 'value')}, count(*) filter ({c} > v) as trips_above,
{r(f'count(*) filter ({c} > v) * 100.0::double / count(*)', 'pct_above')} from flagged, (select quantile_cont({c}, {p}) as v from flagged)"""
        for c in ("trip_duration", "estimated_distance")
        for p in PROBS
    ]
    return sql(" union all ".join(rows), "flagged")


@query("percentile_exceedance", _exceed_sql())
def percentile_exceedance(spark, sf):
    return tidy(quality.percentile_exceedance(inputs.flagged(spark, sf), ["trip_duration", "estimated_distance"], PROBS))


@query(
    "apply_caps",
    sql(
        f"""with {CAPS} select {KEYS}, {r('least(trip_duration, dc)', 'trip_duration')}, {r('least(estimated_distance, sc)', 'estimated_distance')},
{r('least(estimated_distance, sc) * pickup_hour', 'distance_hour_interaction')}, {r('least(estimated_distance, sc) * is_rush_hour', 'distance_rushhour_interaction')},
{r('least(estimated_distance, sc) * is_snowing', 'snow_distance_interaction')}, {r('least(estimated_distance, sc) * is_raining', 'rain_distance_interaction')} from feat, caps""",
        "feat", "flagged",
    ),
)
def apply_caps(spark, sf):
    capped = quality.apply_caps(inputs.enriched(spark, sf), quality.caps(inputs.flagged(spark, sf)))
    names = ["distance_hour_interaction", "distance_rushhour_interaction", "snow_distance_interaction", "rain_distance_interaction"]
    return tidy(capped.select(*KEY, "trip_duration", "estimated_distance", *names))


@query(
    "cap_report_by_split",
    sql(
        f"""with {CAPS.replace('from flagged', "from flagged where split = 'train'")},
c as (select split, pickup_month, count(*) as n, count(*) filter (trip_duration > dc) as d, count(*) filter (estimated_distance > sc) as s from flagged, caps group by 1, 2)
select split, pickup_month, n::bigint as trips, d::bigint as duration_capped, s::bigint as distance_capped from c
union all select split, 0, sum(n)::bigint, sum(d)::bigint, sum(s)::bigint from c group by 1
union all select 'ALL', 0, sum(n)::bigint, sum(d)::bigint, sum(s)::bigint from c""",
        "flagged",
    ),
)
def cap_report_by_split(spark, sf):
    trips = inputs.flagged(spark, sf).withColumn("split", sampling.month_split())
    return quality.cap_report(trips, quality.caps(trips.where("split = 'train'")))


@query(
    "target_cap_p995",
    sql(
        f"""select {KEYS}, {r('least(greatest(fare_amount, 0), fc)', 'fare_amount_capped')}, {r('least(greatest(trip_duration, 0), dc)', 'trip_duration_capped')}
from trips, (select quantile_cont(fare_amount, 0.995) as fc, quantile_cont(trip_duration, 0.995) as dc from trips)""",
        "trips",
    ),
)
def target_cap_p995(spark, sf):
    capped = quality.cap_target(inputs.timed(spark, sf), ["fare_amount", "trip_duration"])
    return tidy(capped.select(*KEY, "fare_amount_capped", "trip_duration_capped"))


def _iqr_sql() -> str:
    rows = [
        f"""select '{c}' as metric, {r('max(lo)', 'lower_bound')}, {r('max(hi)', 'upper_bound')}, count(*) filter ({c} < lo or {c} > hi) as outliers,
{r(f'count(*) filter ({c} < lo or {c} > hi) * 100.0::double / count(*)', 'pct')}, {r(f'min({c}) filter ({c} < lo or {c} > hi)', 'min_outlier')},
{r(f'max({c}) filter ({c} < lo or {c} > hi)', 'max_outlier')} from trips, (select q1 - 1.5 * (q3 - q1) as lo, q3 + 1.5 * (q3 - q1) as hi
from (select quantile_cont({c}, 0.25) as q1, quantile_cont({c}, 0.75) as q3 from trips))"""
        for c in ("fare_amount", "trip_distance", "trip_duration")
    ]
    return sql(" union all ".join(rows), "trips")


@query("iqr_outliers", _iqr_sql())
def iqr_outliers(spark, sf):
    return tidy(quality.iqr_outliers(inputs.timed(spark, sf), ["fare_amount", "trip_distance", "trip_duration"]))


WEATHER_CHECKED = ["temperature", "humidity", "wind_speed", "precipitation", "snow", "visibility", "pressure_hpa", "clouds", "weathercode"]
TRIPS_CHECKED = [*KEY, "tpep_pickup_datetime", "tpep_dropoff_datetime", "PULocationID", "DOLocationID", "passenger_count", "trip_distance", "fare_amount", "payment_type"]


def _missing_sql() -> str:
    names = [*TRIPS_CHECKED, *WEATHER_CHECKED]
    rows = [f"select '{c}' as column_name, count(*) filter ({c} is null) as missing, {r(f'count(*) filter ({c} is null) * 100.0::double / count(*)', 'pct')} from j" for c in names]
    body = "with j as (select t.*, w.* from trips t left join weather w on date_trunc('hour', t.tpep_pickup_datetime) = w.datetime) select * from ("
    return sql(body + " union all ".join(rows) + ") where missing > 0", "trips", "weather")


@query("missing_profile", _missing_sql())
def missing_profile(spark, sf):
    return tidy(quality.missing_profile(weather.join_hourly(inputs.raw(spark, sf), inputs.readings(spark, sf))))


_DUPLICATES = f"sum(c)::bigint as rows, sum(c - 1)::bigint as duplicates, {r('sum(c - 1) * 100.0::double / sum(c)', 'pct')}"


@query(
    "duplicate_rows",
    sql(
        f"""select 'all columns' as scope, {_DUPLICATES} from (select count(*) as c from (select t as whole from trips t) group by whole)
union all select 'order line', {_DUPLICATES} from (select count(*) as c from trips group by l_orderkey, l_linenumber)""",
        "trips",
    ),
)
def duplicate_rows(spark, sf):
    trips = inputs.raw(spark, sf)
    both = [("all columns", None), ("order line", ["l_orderkey", "l_linenumber"])]
    parts = [quality.duplicate_rows(trips, columns).select(F.lit(scope).alias("scope"), "*") for scope, columns in both]
    return tidy(files.concat_months(parts))


@query(
    "sign_audit",
    sql(
        " union all ".join(
            f"select '{c}' as metric, count(*) filter ({c} < 0) as negative, count(*) filter ({c} = 0) as zero from trips" for c in ("fare_amount", "trip_duration", "trip_distance")
        ),
        "trips",
    ),
)
def sign_audit(spark, sf):
    return quality.sign_audit(inputs.timed(spark, sf), ["fare_amount", "trip_duration", "trip_distance"])


DIRTY = """with d as (select event_id, case when event_id % 11 = 0 then 'x' when event_id % 13 = 0 then 'NaN' when event_id % 17 = 0 then 'Infinity'
  when event_id % 19 = 0 then '-Infinity' else json_extract_string(props, '$.k') end as raw_text from events),
n as (select *, case when isnan(try_cast(raw_text as double)) then null else try_cast(raw_text as double) end as v from d) """


@query("coerce_numeric", DIRTY + f"select event_id, raw_text, case when isinf(v) then null else v end as value, {i('isinf(v)', 'is_infinite')}, {i('v is null', 'is_missing')} from n")
def coerce_numeric(spark, sf):
    number = quality.to_number("raw_text")
    infinite = F.abs("n") == F.lit(float("inf"))
    return views.dirty_numbers(spark, sf).withColumn("n", number).select(
        "event_id", "raw_text", F.when(~infinite, F.col("n")).alias("value"), flag(infinite).alias("is_infinite"), flag(F.col("n").isNull()).alias("is_missing")
    )


@query("nonfinite_to_zero", DIRTY + f"select event_id, case when v is null or isinf(v) then 0 else v end::double as value, {i('v is null or isinf(v)', 'was_replaced')}, (count(*) filter (v is null or isinf(v)) over ())::bigint as replaced from n")
def nonfinite_to_zero(spark, sf):
    numbers = views.dirty_numbers(spark, sf).select("event_id", F.col("raw_text").try_cast("double").alias("n"))
    bad = F.col("n").isNull() | F.isnan("n") | (F.abs("n") == F.lit(float("inf")))
    total = numbers.agg(F.count_if(bad).alias("replaced"))
    return numbers.select("event_id", quality.finite_or_zero(F.col("n")).alias("value"), flag(bad).alias("was_replaced"), total.scalar().alias("replaced"))


@query(
    "impute_median",
    sql(
        f"""select {KEYS}, {r('coalesce(passenger_count, (select quantile_cont(passenger_count, 0.5) from trips))', 'median_filled')},
{r('coalesce(passenger_count, (select avg(passenger_count) from trips))', 'mean_filled')} from trips""",
        "trips",
    ),
)
def impute_median(spark, sf):
    trips = inputs.raw(spark, sf).select(*KEY, F.col("passenger_count").alias("median_filled"), F.col("passenger_count").alias("mean_filled"))
    return tidy(quality.impute_mean(quality.impute_median(trips, ["median_filled"]), ["mean_filled"]))


@query(
    "validate_requests",
    sql(
        f"""with v as (select request_id, list_filter([case when PULocationID < 1 or PULocationID > 265 then 'PULocationID' end, case when DOLocationID < 1 or DOLocationID > 265 then 'DOLocationID' end,
  case when passenger_count < 1 or passenger_count > 6 then 'passenger_count' end, case when estimated_distance <= 0 or estimated_distance > 50 then 'estimated_distance' end,
  case when pickup_hour < 0 or pickup_hour > 23 then 'pickup_hour' end, case when abs(pickup_latitude) > 90 then 'pickup_latitude' end,
  case when abs(pickup_longitude) > 180 then 'pickup_longitude' end], lambda x: x is not null) as bad from requests)
select request_id, coalesce(array_to_string(bad, '|'), '') as violations, {i('len(bad) = 0', 'is_valid')} from v""",
        "requests",
    ),
)
def validate_requests(spark, sf):
    return views.requests(spark, sf).withColumns(request_violations()).select("request_id", F.concat_ws("|", "violations").alias("violations"), "is_valid")
