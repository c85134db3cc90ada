"""Queries: distribution profiles, periodic reports and rankings."""

from __future__ import annotations

from pyspark.sql import functions as F

from faremill.functions.calendar import calendar_parts
from faremill.operators import profiles
from faremill.plans import inputs
from faremill.plans.ingest import MONTH_REPORT
from faremill.plans.inputs import tidy
from faremill.plans.registry import query
from faremill.plans.sql import i, r, sql

DAY = "['Monday','Tuesday','Wednesday','Thursday','Friday','Saturday','Sunday'][pickup_weekday + 1]"


@query("monthly_quality_report", sql(MONTH_REPORT, "trips"))
def monthly_quality_report(spark, sf):
    return tidy(profiles.monthly_quality_report(inputs.raw(spark, sf)))


@query(
    "seasonal_rollup",
    sql(
        f"""with m as (select pickup_month, count(*) as n, avg(fare_amount) as f, avg(trip_duration) as d, avg(trip_distance) as s from clean group by 1)
select case when pickup_month in (12,1,2) then 'Winter' when pickup_month <= 5 then 'Spring' when pickup_month <= 8 then 'Summer' else 'Fall' end as season, sum(n)::bigint as trips,
{r('avg(f)', 'avg_fare')}, {r('avg(d)', 'avg_duration')}, {r('avg(s)', 'avg_distance')} from m group by 1""",
        "clean",
    ),
)
def seasonal_rollup(spark, sf):
    return tidy(profiles.seasonal_rollup(profiles.monthly_quality_report(inputs.raw(spark, sf))))


_STATS = {"mean": "avg({})", "median": "quantile_cont({}::double, 0.5)", "std": "stddev_samp({})", "min": "min({})", "max": "max({})"}
_MONTHLY = ", ".join(r(_STATS[s].format(c), f"{c}_{s}") for c, names in profiles.MONTHLY_STATS.items() for s in names)


@query("monthly_summary", sql(f"select pickup_month, {_MONTHLY} from feat group by 1", "feat"))
def monthly_summary(spark, sf):
    return tidy(profiles.monthly_summary(inputs.enriched(spark, sf)))


@query(
    "hourly_volume",
    sql(
        f"""with h as (select pickup_hour, count(*) as trips from clean group by 1)
select pickup_hour, trips, {r('trips * 100.0::double / (select sum(trips) from h)', 'pct')}, {i('trips >= (select quantile_cont(trips, 0.75) from h)', 'is_peak')},
{i('pickup_hour = (select pickup_hour from h order by trips desc, pickup_hour limit 1)', 'is_busiest')}, {i('pickup_hour = (select pickup_hour from h order by trips, pickup_hour limit 1)', 'is_quietest')} from h""",
        "clean",
    ),
)
def hourly_volume(spark, sf):
    return tidy(profiles.hourly_volume(inputs.clean(spark, sf)))


@query(
    "weekday_profile",
    sql(
        f"""select pickup_weekday, {DAY} as day_name, count(*) as trips, {r('count(*) * 100.0::double / (select count(*) from clean)', 'pct')}, {r('avg(fare_amount)', 'avg_fare')} from clean group by pickup_weekday""",
        "clean",
    ),
)
def weekday_profile(spark, sf):
    return tidy(profiles.weekday_profile(inputs.clean(spark, sf)))


@query(
    "weekend_vs_weekday",
    sql(
        f"""with k as (select case when is_weekend = 1 then 'Weekend' else 'Weekday' end as day_kind, count(*) as trips, avg(fare_amount) as f, avg(trip_distance) as s, avg(trip_duration) as d from clean group by 1)
select day_kind, trips, {r('trips * 100.0::double / (select sum(trips) from k)', 'pct')}, {r('f', 'avg_fare')}, {r('s', 'avg_distance')}, {r('d', 'avg_duration')},
{r('f * 100 / (select max(f) from k)', 'avg_fare_pct_of_max')}, {r('s * 100 / (select max(s) from k)', 'avg_distance_pct_of_max')}, {r('d * 100 / (select max(d) from k)', 'avg_duration_pct_of_max')} from k""",
        "clean",
    ),
)
def weekend_vs_weekday(spark, sf):
    return tidy(profiles.weekend_vs_weekday(inputs.clean(spark, sf)))


@query("hourly_fare_duration", sql(f"select pickup_hour, {r('avg(fare_amount)', 'avg_fare')}, {r('avg(trip_duration)', 'avg_duration')} from clean group by 1", "clean"))
def hourly_fare_duration(spark, sf):
    return tidy(profiles.hourly_fare_duration(inputs.clean(spark, sf)))


_DESCRIBED = ["fare_amount", "trip_distance", "trip_duration", "passenger_count"]


@query(
    "describe_columns",
    sql(
        " union all ".join(
            f"""select '{c}' as metric, count({c}) as count, {r(f'avg({c})', 'mean')}, {r(f'stddev_samp({c})', 'std')}, {r(f'min({c})', '"min"')}, {r(f'max({c})', '"max"')}, """
            + ", ".join(r(f"quantile_cont({c}, {p})", f"p{round(p * 100)}") for p in (0.25, 0.5, 0.75, 0.9, 0.95, 0.99))
            + " from trips"
            for c in _DESCRIBED
        ),
        "trips",
    ),
)
def describe_columns(spark, sf):
    return tidy(profiles.describe_columns(inputs.timed(spark, sf), _DESCRIBED))


def _histogram_sql(value: str, table: str, where: str = "true") -> str:
    return sql(
        f"""with v as (select {value} as x from {table} where {where}), s as (select min(x) as lo, max(x) as hi from v),
b as (select least(floor((x - lo) / (hi - lo) * 100), 99)::int as bin, count(*) as n from v, s group by 1)
select g.k::int as bin, {r('lo + (hi - lo) / 100 * g.k', 'lower')}, {r('lo + (hi - lo) / 100 * (g.k + 1)', 'upper')}, coalesce(n, 0) as trips from s, range(0, 100) g(k) left join b on b.bin = g.k""",
        table,
    )


@query("histogram_100", _histogram_sql("fare_amount", "trips", "fare_amount is not null"))
def histogram_100(spark, sf):
    return tidy(profiles.histogram(inputs.raw(spark, sf), F.col("fare_amount")))


@query("histogram_log1p", _histogram_sql("ln(1 + trip_duration)", "trips", "trip_duration > 0"))
def histogram_log1p(spark, sf):
    return tidy(profiles.histogram(inputs.timed(spark, sf).where("trip_duration > 0"), F.log1p("trip_duration")))


@query(
    "value_counts",
    sql(
        """select 'passenger_count' as metric, passenger_count::int::varchar as value, count(*) as trips from trips where passenger_count is not null group by 2
union all select 'payment_type', ['Credit Card','Cash','No Charge','Dispute','Unknown','Voided'][payment_type], count(*) from trips group by payment_type""",
        "trips",
    ),
)
def value_counts(spark, sf):
    return profiles.value_counts(inputs.raw(spark, sf))


@query(
    "top_zones",
    sql(
        """with c as (select 'pickup' as trip_end, PULocationID as zone_id, count(*) as trips from clean group by 2 union all select 'dropoff', DOLocationID, count(*) from clean group by 2)
select trip_end, zone_id, trips, (row_number() over (partition by trip_end order by trips desc, zone_id))::int as place from c
qualify row_number() over (partition by trip_end order by trips desc, zone_id) <= 10""",
        "clean",
    ),
)
def top_zones(spark, sf):
    return profiles.top_zones(inputs.clean(spark, sf))


KEY_FEATURES = [
    "trip_duration", "fare_amount", "estimated_distance", "passenger_count", "temperature", "is_raining", "is_snowing", "is_rush_hour", "is_weekend", "is_airport_trip", "pickup_is_manhattan",
]


@query(
    "correlation_matrix",
    sql(" union all ".join(f"select '{a}' as feature_a, '{b}' as feature_b, {r(f'corr({a}, {b})', 'r')} from feat" for a in KEY_FEATURES for b in KEY_FEATURES), "feat"),
)
def correlation_matrix(spark, sf):
    return tidy(profiles.correlation_matrix(inputs.enriched(spark, sf), KEY_FEATURES))


_TARGET_ROWS = " union all ".join(f"select '{t}' as target, '{c}' as feature, corr({c}, {t}) as v from feat" for c in KEY_FEATURES[2:] for t in ("fare_amount", "trip_duration"))


@query(
    "target_correlations",
    sql(
        f"""with c as ({_TARGET_ROWS}) select target, feature, {r('v', 'r')}, case when abs(v) > 0.5 then 'Strong' when abs(v) > 0.3 then 'Moderate' else 'Weak' end as strength,
(row_number() over (partition by target order by round(v, 9) desc, feature))::int as place from c""",
        "feat",
    ),
)
def target_correlations(spark, sf):
    return tidy(profiles.target_correlations(inputs.enriched(spark, sf), KEY_FEATURES[2:], ("fare_amount", "trip_duration")))


@query(
    "weather_impact",
    sql(
        f"""with g as (select 'Clear' as condition, trip_duration, fare_amount from feat where is_raining = 0 and is_snowing = 0 union all select 'Rain', trip_duration, fare_amount from feat where is_raining = 1
union all select 'Snow', trip_duration, fare_amount from feat where is_snowing = 1)
select condition, count(*) as trips, {r('count(*) * 100.0::double / (select count(*) from feat)', 'pct')}, {r('avg(trip_duration)', 'avg_duration')}, {r('avg(fare_amount)', 'avg_fare')} from g group by 1""",
        "feat",
    ),
)
def weather_impact(spark, sf):
    return tidy(profiles.weather_impact(inputs.enriched(spark, sf)))


_IMPACT = f"count(*) as trips, {r('avg(trip_duration)', 'avg_duration')}, {r('avg(fare_amount)', 'avg_fare')}, {r('avg(estimated_distance)', 'avg_distance')}"


@query(
    "flag_impact",
    sql(
        f"""select 'is_holiday' as flag, is_holiday as flag_value, {_IMPACT} from feat group by 2 union all select 'is_rush_hour', is_rush_hour, {_IMPACT} from feat group by 2""", "feat"
    ),
)
def flag_impact(spark, sf):
    return tidy(profiles.flag_impact(inputs.enriched(spark, sf)))


@query(
    "key_findings",
    sql(
        f"""select count(*) as trips, min(tpep_pickup_datetime) as first_pickup, max(tpep_pickup_datetime) as last_pickup,
{r('(count(*) * 4 - count(fare_amount) - count(trip_distance) - count(passenger_count) - count(payment_type)) * 100.0::double / (count(*) * 4)', 'missing_pct')},
{r('avg(fare_amount)', 'mean_fare')}, {r('avg(trip_duration)', 'mean_duration')}, {r('avg(trip_distance)', 'mean_distance')}, count(*) filter (fare_amount < 0) as negative_fares,
count(*) filter (trip_distance = 0) as zero_distances, count(*) filter (trip_duration < 0) as negative_durations, {r('quantile_cont(fare_amount, 0.5)', 'median_fare')},
{r('quantile_cont(trip_duration, 0.5)', 'median_duration')}, {r('quantile_cont(fare_amount, 0.05)', 'fare_p5')}, {r('quantile_cont(fare_amount, 0.95)', 'fare_p95')},
(select pickup_hour from parts group by 1 order by count(*) desc, 1 limit 1) as peak_hour, (select {DAY} from parts group by 1 order by count(*) desc, 1 limit 1) as busiest_day,
(select passenger_count::int from parts where passenger_count is not null group by 1 order by count(*) desc, 1 limit 1) as modal_passengers,
(select ['Credit Card','Cash','No Charge','Dispute','Unknown','Voided'][payment_type] from parts group by 1 order by count(*) desc, 1 limit 1) as modal_payment from trips""",
        "parts",
    ),
)
def key_findings(spark, sf):
    trips = inputs.timed(spark, sf).withColumns(calendar_parts())
    return tidy(profiles.key_findings(trips, ["fare_amount", "trip_distance", "passenger_count", "payment_type"]))
