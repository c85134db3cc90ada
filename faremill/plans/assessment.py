"""Queries: error analytics, scoring rules, models and importance."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from faremill.functions.rules import request_confidence
from faremill.operators import errors, features, importance, location, models, scoring
from faremill.operators.quantiles import attach_row
from faremill.plans import inputs
from faremill.plans.inputs import TARGET, tidy
from faremill.plans.registry import query
from faremill.plans.sql import KEYS, errors_of, i, r, sql
from faremill.session import written_table
from faremill.sources import views
from faremill.sources.trips import concat_months
from faremill.sources.views import KEY

FARE, MINUTES = errors_of("scored_fare"), errors_of("scored_duration")
METRICS = f"""count(*) as n, {r('sqrt(avg(squared_error))', 'rmse')}, {r('avg(abs_error)', 'mae')}, {r('1 - sum(squared_error) / (var_pop(y_true) * count(*))', 'r2')}, {r('avg(abs_pct_error)', 'mape')}"""
BOTH = f"{FARE}, {errors_of('scored_minutes').replace('err as', 'err2 as')}"


def _both(spark, sf) -> DataFrame:
    """Fare and duration scores as one frame, written once."""
    return inputs.saved(inputs.scored_both(spark, sf))


def _both_sql(template: str) -> str:
    """The same SQL over both error tables; {t} is the table, {n} the target's name."""
    one = template.replace("{t}", "err").replace("{n}", "fare")
    two = template.replace("{t}", "err2").replace("{n}", "duration")
    return sql(f"with {BOTH} select * from ({one}) union all select * from ({two})", "scored_fare", "scored_minutes")


@query("regression_metrics", _both_sql(f"select '{{n}}' as target, {METRICS}, {r('quantile_cont(abs_error, 0.5)', 'median_ae')} from {{t}}"))
def regression_metrics(spark, sf):
    return tidy(errors.regression_metrics(_both(spark, sf), TARGET))


_SKEW = "(avg(pow(raw_error - m, 3)) / pow(avg(pow(raw_error - m, 2)), 1.5))"
_KURT = "(avg(pow(raw_error - m, 4)) / pow(avg(pow(raw_error - m, 2)), 2) - 3)"


@query(
    "error_distribution",
    _both_sql(
        f"""select '{{n}}' as target, count(*) as n, {r('avg(raw_error)', 'mean_error')}, {r('stddev_samp(raw_error)', 'std_error')}, {r('min(raw_error)', 'min_error')}, {r('max(raw_error)', 'max_error')},
{r(f'{_SKEW} * sqrt(count(*) * (count(*) - 1.0::double)) / (count(*) - 2)', 'skew')}, {r(f'(count(*) - 1.0::double) / ((count(*) - 2.0::double) * (count(*) - 3.0::double)) * ((count(*) + 1) * {_KURT} + 6)', 'kurtosis')},
{r('avg(abs(pct_error))', 'mape')}, {', '.join(r(f'count(*) filter (abs(pct_error) <= {t}) * 100.0::double / count(*)', f'within_{t}_pct') for t in (5, 10, 20))},
count(*) filter (raw_error > 0) as over, count(*) filter (raw_error < 0) as under, {r('quantile_cont(raw_error, 0.5)', 'median_error')}, {r('quantile_cont(abs_pct_error, 0.5)', 'median_ape')},
{', '.join(r(f'quantile_cont(abs_error, {p})', f"abs_p{format(p * 100, 'g')}") for p in errors.ABS_LEVELS)},
{r('count(*) filter (raw_error > 0) * 100.0::double / count(*)', 'over_pct')}, {r('count(*) filter (raw_error < 0) * 100.0::double / count(*)', 'under_pct')},
case when abs(avg(raw_error)) <= 0.01 then 'none' when avg(raw_error) > 0 then 'over-predicting' else 'under-predicting' end as bias from {{t}}, (select avg(raw_error) as m from {{t}})"""
    ),
)
def error_distribution(spark, sf):
    return tidy(errors.error_distribution(_both(spark, sf), TARGET))


# Published formulas: D'Agostino (1970), Anscombe and Glynn (1983).
_Z_SQL = f"""select '{{n}}' as target, n::bigint as n, {r('z1', 'skew_z', 5)}, {r('z2', 'kurtosis_z', 5)}, {r('z1*z1 + z2*z2', 'k2', 3)}, {r('exp(-(z1*z1 + z2*z2) / 2)', 'normality_p', 5)}, {r('t', 't_statistic', 5)},
{r('2 * exp(-t*t/2) / sqrt(2*pi()) * k*(0.319381530::double + k*(-0.356563782::double + k*(1.781477937::double + k*(-1.821255978::double + k*1.330274429::double))))', 'zero_mean_p', 5)}
from (select *, 1 / (1 + 0.2316419::double * abs(t)) as k from (select n, m / (sd / sqrt(n)) as t,
  1 / sqrt(ln(w)) * ln(y / al + sqrt(pow(y / al, 2) + 1)) as z1, (1 - 2 / (9 * a) - cbrt((1 - 2 / a) / (1 + x * sqrt(2 / (a - 4))))) / sqrt(2 / (9 * a)) as z2
  from (select *, sqrt(w2) as w, sqrt(2 / (w2 - 1)) as al, 6 + 8 / sb * (2 / sb + sqrt(1 + 4 / pow(sb, 2))) as a
    from (select *, sqrt(2 * (b2 - 1)) - 1 as w2 from (select n, m, sd, g1 * sqrt((n + 1) * (n + 3) / (6 * (n - 2))) as y,
      3 * (n*n + 27*n - 70) * (n + 1) * (n + 3) / ((n - 2) * (n + 5) * (n + 7) * (n + 9)) as b2, (g2 + 3 - 3 * (n - 1) / (n + 1)) / sqrt(24 * n * (n - 2) * (n - 3) / ((n + 1) * (n + 1) * (n + 3) * (n + 5))) as x,
      6 * (n*n - 5*n + 2) / ((n + 7) * (n + 9)) * sqrt(6 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3))) as sb
      from (select count(*)::double as n, max(m) as m, stddev_samp(raw_error) as sd, {_SKEW} as g1, {_KURT} as g2 from {{t}}, (select avg(raw_error) as m from {{t}})))))))"""


@query("error_tests", _both_sql(_Z_SQL))
def error_tests(spark, sf):
    out = errors.error_tests(inputs.scored_both(spark, sf), TARGET)
    return out.select(
        "target", "n", *[F.round(F.col(c) + inputs.NUDGE, d).alias(c) for c, d in (("skew_z", 5), ("kurtosis_z", 5), ("k2", 3), ("normality_p", 5), ("t_statistic", 5), ("zero_mean_p", 5))]
    )


def _within_sql(table: str, target: str, thresholds) -> str:
    return " union all ".join(
        f"select '{target}' as target, {t}::double as threshold, count(*) filter (abs_error <= {t}) as rows, {r(f'count(*) filter (abs_error <= {t}) * 100.0::double / count(*)', 'pct')} from {table}" for t in thresholds
    )


@query("error_within", sql(f"with {BOTH} {_within_sql('err', 'fare', (1, 3, 5, 10))} union all {_within_sql('err2', 'duration', (2, 5, 10, 15))}", "scored_fare", "scored_minutes"))
def error_within(spark, sf):
    fare = errors.error_within(inputs.scored_fare(spark, sf), (1, 3, 5, 10)).withColumn("target", F.lit("fare"))
    minutes = errors.error_within(inputs.scored_duration(spark, sf), (2, 5, 10, 15)).withColumn("target", F.lit("duration"))
    return tidy(concat_months([fare, minutes]))


def _bins_sql(feature: str, bins: int) -> str:
    values = ", ".join(str(k / bins) for k in range(bins + 1))
    return f"""select '{{n}}' as target, '{feature}' as feature, b as bin_no, {r('any_value(list_extract(e, b))', 'bin_low')}, {r('any_value(list_extract(e, b + 1))', 'bin_high')}, {r('avg(abs_error)', 'mean_abs')},
{r('quantile_cont(abs_error, 0.5)', 'median_abs')}, count(*) as rows, {r('avg(raw_error)', 'mean_raw')} from (select *, greatest(1, len(list_filter(e, lambda v: v < {feature})))::int as b
from {{t}}, (select list_sort(list_distinct(quantile_cont({feature}::double, [{values}]))) as e from {{t}})) group by b"""


_FEW = f"""select '{{n}}' as target, 'passenger_count' as feature, 0::int as bin_no, {r('passenger_count', 'bin_low')}, {r('passenger_count', 'bin_high')}, {r('avg(abs_error)', 'mean_abs')},
{r('quantile_cont(abs_error, 0.5)', 'median_abs')}, count(*) as rows, {r('avg(raw_error)', 'mean_raw')} from {{t}} group by passenger_count"""

# The number of quantile bins per feature; None: grouped by value.
BINS = {"estimated_distance": 10, "pickup_hour": 5, "fare_amount": 4, "trip_duration": 4, "temperature": 5, "passenger_count": None}


@query("error_by_quantile_bin", _both_sql(" union all ".join([*(_bins_sql(f, n) for f, n in BINS.items() if n), _FEW])))
def error_by_quantile_bin(spark, sf):
    return tidy(errors.error_by_quantile_bin(_both(spark, sf), BINS, TARGET))


def _ranges_sql(feature: str, edges) -> str:
    return " union all ".join(
        f"select '{{n}}' as target, '{feature}' as feature, {lo}::double as low, {hi}::double as high, {r('avg(abs_error)', 'mae')}, count(*) as rows from {{t}} where {feature} >= {lo} and {feature} < {hi} having count(*) > 0"
        for lo, hi in zip(edges, edges[1:])
    )


RANGES = {"estimated_distance": [0, 2, 5, 10, 20, 100], "temperature": [-10, 32, 50, 70, 85, 110]}


@query("error_by_range", _both_sql(" union all ".join(_ranges_sql(f, e) for f, e in RANGES.items())))
def error_by_range(spark, sf):
    return tidy(errors.error_by_range(inputs.scored_both(spark, sf), RANGES, TARGET))


@query(
    "error_by_hour_ranked",
    _both_sql(
        f"""select '{{n}}' as target, pickup_hour, {r('v', 'mae')}, rows, (row_number() over (order by round(v, 9) desc, pickup_hour))::int as worst_place, (row_number() over (order by round(v, 9), pickup_hour))::int as best_place
from (select pickup_hour, avg(abs_error) as v, count(*) as rows from {{t}} group by 1)"""
    ),
)
def error_by_hour_ranked(spark, sf):
    return tidy(errors.error_by_hour(inputs.scored_both(spark, sf), TARGET))


PROFILED = ["estimated_distance", "trip_duration", "pickup_hour", "is_airport_trip", "is_rush_hour"]


@query(
    "large_error_profile",
    _both_sql(
        " union all ".join(
            f"""select '{{n}}' as target, '{f}' as feature, {r('max(cut)', 'threshold')}, count(*) filter (abs_error >= cut) as large_rows, {r(f'avg({f}) filter (abs_error >= cut)', 'large_mean')}, {r(f'avg({f})', 'overall_mean')},
{r(f'(avg({f}) filter (abs_error >= cut) - avg({f})) / avg({f}) * 100', 'difference_pct')} from {{t}}, (select quantile_cont(abs_error, 0.95) as cut from {{t}})"""
            for f in PROFILED
        )
    ),
)
def large_error_profile(spark, sf):
    return tidy(errors.large_error_profile(_both(spark, sf), PROFILED, by=TARGET))


@query(
    "worst_predictions",
    _both_sql(
        f"""select '{{n}}' as target, {KEYS}, {r('estimated_distance', 'estimated_distance')}, {r('trip_duration', 'trip_duration')}, pickup_hour, {r('y_true', 'y_true')}, {r('y_pred', 'y_pred')},
{r('abs_error', 'abs_error')}, {r('abs_pct_error', 'abs_pct_error')} from {{t}} order by round({{t}}.abs_error, 6) desc, {KEYS} limit 10"""
    ),
)
def worst_predictions(spark, sf):
    return tidy(errors.worst_predictions(inputs.scored_both(spark, sf), KEY, ["estimated_distance", "trip_duration", "pickup_hour"], by=TARGET))


@query(
    "error_boxes",
    _both_sql(
        f"""select '{{n}}' as target, is_airport_trip, count(*) as rows, {r('min(abs_error)', '"min"')}, {r('max(q1)', 'q1')}, {r('max(q2)', 'median')}, {r('max(q3)', 'q3')}, {r('max(abs_error)', '"max"')},
{r('min(abs_error) filter (inside)', 'whisker_low')}, {r('max(abs_error) filter (inside)', 'whisker_high')}, count(*) filter (not inside) as outliers from (
select {{t}}.*, q1, q2, q3, abs_error >= q1 - 1.5 * (q3 - q1) and abs_error <= q3 + 1.5 * (q3 - q1) as inside from {{t}} join (select is_airport_trip as g, quantile_cont(abs_error, 0.25) as q1, quantile_cont(abs_error, 0.5) as q2,
  quantile_cont(abs_error, 0.75) as q3 from {{t}} group by 1) on g = is_airport_trip) group by is_airport_trip"""
    ),
)
def error_boxes(spark, sf):
    return tidy(errors.error_boxes(_both(spark, sf), (*TARGET, "is_airport_trip")))


# Standard normal quantiles.
NORMAL_LEVELS = {
    0.01: -2.3263478740, 0.05: -1.6448536270, 0.1: -1.2815515655, 0.25: -0.6744897502, 0.5: 0.0, 0.75: 0.6744897502, 0.9: 1.2815515655, 0.95: 1.6448536270, 0.99: 2.3263478740,
}


@query(
    "residual_quantiles",
    _both_sql(
        " union all ".join(
            f"select '{{n}}' as target, {p}::double as p, {r(f'quantile_cont(raw_error, {p})', 'sample_quantile')}, {r(f'avg(raw_error) + stddev_samp(raw_error) * ({z}::double)', 'normal_quantile', 3)} from {{t}}" for p, z in NORMAL_LEVELS.items()
        )
    ),
)
def residual_quantiles(spark, sf):
    out = errors.residual_quantiles(_both(spark, sf), tuple(NORMAL_LEVELS), TARGET)
    return out.select("target", "p", F.round(F.col("sample_quantile") + inputs.NUDGE, 6).alias("sample_quantile"), F.round(F.col("normal_quantile") + inputs.NUDGE, 3).alias("normal_quantile"))


_GAP = f"""with m as (select split, sqrt(avg(squared_error)) as rmse, avg(abs_error) as mae, 1 - sum(squared_error) / (var_pop(y_true) * count(*)) as r2 from {{t}} group by 1),
w as (select {', '.join(f"max({c}) filter (split = '{s}') as {s}_{c}" for s in ('train', 'val', 'test') for c in ('rmse', 'mae', 'r2'))} from m),
g as (select *, (test_rmse / train_rmse - 1) * 100 as rg, (test_mae / train_mae - 1) * 100 as mg, (train_r2 - test_r2) / train_r2 * 100 as xg, (test_r2 - val_r2) * 100 as pp from w),
p as (select *, ((case when rg > 10 then 1 when rg > 5 then 0.5 else 0 end) + (case when mg > 10 then 1 when mg > 5 then 0.5 else 0 end) + (case when xg > 2 then 1 when xg > 1 then 0.5 else 0 end))::double as points from g)
select '{{n}}' as target, {', '.join(r(f'{s}_{c}', f'{s}_{c}') for s in ('train', 'val', 'test') for c in ('rmse', 'mae', 'r2'))}, {r('rg', 'rmse_gap_pct')}, {r('mg', 'mae_gap_pct')}, {r('xg', 'r2_gap_pct')}, {r('pp', 'val_test_pp')}, points,
case when points = 0 then 'none' when points < 1.5 then 'slight' when points < 2.5 then 'moderate' else 'severe' end as verdict,
case when abs(pp) < 0.5 then 'excellent' when abs(pp) < 1 then 'very good' when abs(pp) < 2 then 'good' else 'moderate' end as val_test_verdict from p"""


@query("generalisation_gap", _both_sql(_GAP))
def generalisation_gap(spark, sf):
    return tidy(errors.generalisation_gap(inputs.scored_both(spark, sf), TARGET))


_ODD = "mph < 3 or mph > 60 or fpm < 1.5 or fpm > 20 or trip_duration < 1 or trip_duration > 180"


@query(
    "plausibility_flags",
    sql(f"select {KEYS}, {r('mph', 'mph')}, {r('fpm', 'fare_per_mile')}, {i(_ODD, 'is_anomaly')} from (select *, trip_distance * 60 / trip_duration as mph, fare_amount / trip_distance as fpm from clean)", "clean"),
)
def plausibility_flags(spark, sf):
    return tidy(inputs.clean(spark, sf).withColumns(errors.plausibility_columns("trip_distance", "trip_duration", "fare_amount")).select(*KEY, "mph", "fare_per_mile", "is_anomaly"))


@query(
    "plausibility_summary",
    sql(
        f"""select count(*) as trips, {r('avg(mph)', 'mean_mph')}, {r('avg(fpm)', 'mean_fare_per_mile')}, count(*) filter ({_ODD}) as anomalies, {r('count(*) filter (mph > 40) * 100.0::double / count(*)', 'fast_pct')},
{r('count(*) filter (mph < 5) * 100.0::double / count(*)', 'slow_pct')} from (select *, trip_distance / (trip_duration / 60) as mph, fare_amount / trip_distance as fpm from clean)""",
        "clean",
    ),
)
def plausibility_summary(spark, sf):
    rows = inputs.clean(spark, sf).withColumns(errors.plausibility_columns("trip_distance", "trip_duration", "fare_amount"))
    return tidy(errors.plausibility_summary(rows))


_SCENE_ROWS = """s as (select f.*, f.fare_amount as fare_true, f.y_pred as fare_pred, f.trip_duration as duration_true, z.g as duration_pred, p.d as typical_distance, a.Borough <> b.Borough as crosses
  from scored_fare f join (select PULocationID as pu, sum(duration_s)::double / count(*) / 60 as g from flagged group by 1) z on z.pu = f.PULocationID
  join (select (PULocationID - 1) % 20 as u, (DOLocationID - 1) % 20 as v, avg(trip_distance) as d from clean group by 1, 2) p on p.u = (f.PULocationID - 1) % 20 and p.v = (f.DOLocationID - 1) % 20
  left join lookup a on a.LocationID = f.PULocationID left join lookup b on b.LocationID = f.DOLocationID)"""


def _scene_sql() -> str:
    def near(x: float) -> str:
        return " and ".join(f"{t}_pred >= {t}_true * (1 - {x}::double) and {t}_pred <= {t}_true * (1 + {x}::double)" for t in ("fare", "duration"))

    fixed = "fare_pred >= 3 and fare_pred <= 25 and duration_pred >= 1 and duration_pred <= 30"
    cases = [
        ("short_manhattan_rush_hour", "scenario", "pickup_hour in (17,18,19) and is_airport_trip = 0 and typical_distance < 3", near(0.2)), ("airport_trip", "scenario", "is_airport_trip = 1", near(0.2)),
        ("cross_borough_weekend", "scenario", "is_weekend = 1 and crosses", near(0.2)), ("very_short_trip", "scenario", "typical_distance < 1.5", near(0.2)), ("late_night", "scenario", "is_night = 1", near(0.2)),
        ("minimum_distance", "edge", "typical_distance = (select min(typical_distance) from s)", fixed), ("maximum_distance", "edge", "typical_distance = (select max(typical_distance) from s)", near(0.5)),
        ("airport_trips", "edge", "is_airport_trip = 1", near(0.3)),
    ]
    rows = " union all ".join(f"select '{n}' as scenario, '{k}' as kind, count(*) as rows, count(*) filter ({ok}) * 100.0::double / count(*) as p from s where {mask} having count(*) > 0" for n, k, mask, ok in cases)
    body = f"""with {_SCENE_ROWS}, c as ({rows}), k as (select kind as k, avg(case when p >= 50 then 1 else 0 end) * 100 as rate from c group by 1)
select scenario, kind, rows, {r('p', 'ok_pct')}, {i('p >= 50', 'passed')}, {r('rate', 'pass_rate')},
case when (select count(*) from k where (k = 'scenario' and rate < 80) or (k = 'edge' and rate < 66)) = 0 then 'pass' else 'review' end as overall from c join k on k.k = c.kind"""
    return sql(body, "scored_fare", "flagged", "clean", "lookup")


def _scenario_rows(spark, sf) -> DataFrame:
    scored = inputs.scored_fare(spark, sf)
    trips = location.enrich_zones(scored, views.zone_lookup(spark)).withColumns(location.borough_flow_flags())
    means = inputs.zone_means(inputs.clean(spark, sf)).withColumnRenamed("y_pred", "duration_pred")
    folds = {"pu20": (F.col("PULocationID") - 1) % 20 + 1, "do20": (F.col("DOLocationID") - 1) % 20 + 1}
    profile = location.route_profile(inputs.folded(spark, sf)).select(F.col("PULocationID").alias("pu20"), F.col("DOLocationID").alias("do20"), "typical_distance")
    joined = trips.withColumns(folds).join(profile, ["pu20", "do20"]).join(means, "PULocationID")
    return joined.withColumns({"fare_true": F.col("fare_amount"), "fare_pred": F.col("y_pred"), "duration_true": F.col("trip_duration")}).withColumn(
        "typical_distance", F.round("typical_distance", 9)
    )


@query("scenario_checks", _scene_sql().replace("p.d as typical_distance", "round(p.d, 9) as typical_distance"))
def scenario_checks(spark, sf):
    return tidy(errors.scenario_checks(_scenario_rows(spark, sf)))


_WEEKS = f"""w as (select time_bucket(interval '7 days', tpep_pickup_datetime, timestamp '1970-01-01') as week_start, count(*) as n, avg(abs_error) as mae, 1 - sum(squared_error) / (var_pop(y_true) * count(*)) as r2 from err group by 1)
select week_start, n, {r('mae', 'mae')}, {r('r2', 'r2')}, {i('r2 < 0.8 or mae > 3', 'alert')} from w"""


@query("weekly_monitor", sql(f"with {MINUTES}, {_WEEKS}", "scored_duration"))
def weekly_monitor(spark, sf):
    return tidy(errors.weekly_monitor(inputs.scored_duration(spark, sf)))


# Scoring ----------------------------------------------------------------------------------------


@query(
    "tariff_fare",
    sql(
        f"""with c as (select *, y_pred as f from scored_fare) select {KEYS}, {r('f', 'tariff_fare')}, {r('greatest(f, 2.5)', 'served_fare')}, {r('greatest(trip_duration, 1)', 'served_duration')},
case when greatest(f, 2.5) < 100 then 'High' else 'Medium' end as fare_confidence from c""",
        "scored_fare",
    ),
)
def tariff_fare(spark, sf):
    return tidy(scoring.tariff_scores(inputs.enriched(spark, sf)).select(*KEY, "tariff_fare", "served_fare", "served_duration", "fare_confidence"))


_CALIBRATED = """k as (select f.*, z.g as pred, snow * 4 as snow_mm, precipitation * 25 as rain_mm from feat f join (select PULocationID as pu, sum(duration_s)::double / count(*) / 60 * 0.3 as g from flagged group by 1) z on z.pu = f.PULocationID),
c1 as (select *, least(60, case when is_snowing = 1 then case when snow_mm > 8 then 25 when snow_mm > 5 then 30 when snow_mm > 2 then 40 else 60 end else 60 end,
    case when is_raining = 1 then case when rain_mm > 7 then 35 when rain_mm > 4 then 45 else 60 end else 60 end,
    case when is_rush_hour = 1 then least(case when pickup_is_manhattan = 1 then 20 else 30 end, case when is_airport_trip = 1 then 25 else 60 end, case when weather_severity >= 2 then 18 else 60 end) else 60 end) as v0 from k),
c2 as (select *, (case when is_late_night = 1 and is_rush_hour = 0 and weather_severity < 2 then greatest(v0, 50) else v0 end)::double as v from c1),
c3 as (select *, estimated_distance / v * 60 as lo, estimated_distance / 8 * 60 as hi from c2),
cal as (select *, case when pred < lo then lo when pred > hi then hi when estimated_distance > 15 and is_late_night = 0 then least(pred * 1.3, hi) else pred * 1.1 end as calibrated,
  case when pred < lo then 'Low (calibrated up)' when pred > hi then 'Low (calibrated down)' when estimated_distance > 15 and is_late_night = 0 then 'Medium (long trip buffer)' else 'High (model reliable)' end as confidence,
  concat_ws('|', case when is_snowing = 1 and snow_mm > 8 then 'Extreme blizzard (' || printf('%.1f', snow_mm) || 'mm/hr) - max 25 mph' when is_snowing = 1 and snow_mm > 5 then 'Heavy snow (' || printf('%.1f', snow_mm) || 'mm/hr) - max 30 mph'
      when is_snowing = 1 and snow_mm > 2 then 'Moderate snow (' || printf('%.1f', snow_mm) || 'mm/hr) - max 40 mph' end,
    case when is_raining = 1 and rain_mm > 7 then 'Heavy rain (' || printf('%.1f', rain_mm) || 'mm/hr) - max 35 mph' when is_raining = 1 and rain_mm > 4 then 'Moderate rain (' || printf('%.1f', rain_mm) || 'mm/hr) - max 45 mph' end,
    case when is_rush_hour = 1 and pickup_is_manhattan = 1 then 'Manhattan rush hour - max 20 mph' when is_rush_hour = 1 then 'Rush hour traffic - max 30 mph' end,
    case when is_rush_hour = 1 and is_airport_trip = 1 then 'Airport + rush hour - bridge/tunnel delays' end,
    case when is_rush_hour = 1 and weather_severity >= 2 then 'Combined: Weather + Traffic - max 18 mph' end,
    case when is_late_night = 1 and is_rush_hour = 0 and weather_severity < 2 then 'Late night empty roads - allow faster' end) as reasons from c3)"""


def _calibration_input(spark, sf) -> DataFrame:
    """Feature rows with a low zone mean as the model's guess, and metric weather amounts."""
    trips = inputs.enriched(spark, sf)
    means = inputs.zone_means(inputs.clean(spark, sf)).select("PULocationID", (F.col("y_pred") * 0.3).alias("predicted_duration"))
    return trips.join(means, "PULocationID").withColumns({"snow": F.col("snow") * 4, "precipitation": F.col("precipitation") * 25})


@query(
    "calibrate_duration",
    sql(
        f"""with {_CALIBRATED} select {KEYS}, v as speed_limit, {r('lo', 'min_duration')}, {r('hi', 'max_duration')}, {r('calibrated', 'calibrated_duration')}, confidence, reasons,
{r('estimated_distance / (pred / 60)', 'original_speed')}, {r('estimated_distance / (calibrated / 60)', 'calibrated_speed')}, {r('(calibrated - pred) / pred * 100', 'improvement')} from cal""",
        "feat", "flagged",
    ),
)
def calibrate_duration(spark, sf):
    out = scoring.calibrate(_calibration_input(spark, sf)).withColumn("reasons", F.concat_ws("|", "reasons"))
    names = ["speed_limit", "min_duration", "max_duration", "calibrated_duration", "confidence", "reasons", "original_speed", "calibrated_speed", "improvement"]
    return tidy(out.select(*KEY, *names))


@query(
    "request_confidence",
    sql(
        """select request_id, case when estimated_distance < 0.1 or estimated_distance > 50 or pickup_longitude < -74.05 or pickup_longitude > -73.75 or pickup_latitude < 40.60 or pickup_latitude > 40.90 then 'low'
when passenger_count < 1 or passenger_count > 6 then 'medium' when estimated_distance > 0.5 and estimated_distance < 20 then 'high' else 'medium' end as confidence from requests""",
        "requests",
    ),
)
def confidence(spark, sf):
    value = request_confidence(F.col("estimated_distance"), F.col("pickup_longitude"), F.col("pickup_latitude"), F.col("passenger_count"))
    return views.requests(spark, sf).select("request_id", value.alias("confidence"))


@query(
    "what_if_weather",
    sql(
        f"""with {_CALIBRATED}, dry as (select {KEYS}, {{dry}} as calibrated from c1), x as (select round(abs(c.calibrated - d.calibrated), 9) as dd,
  round(abs((2.5 + c.estimated_distance*2.5 + c.calibrated*0.5) * (case when c.is_raining = 1 or c.is_snowing = 1 then 1.1 else 1 end) - (2.5 + c.estimated_distance*2.5 + d.calibrated*0.5)), 9) as df
  from cal c join dry d using ({KEYS}))
select count(*) as trips, {r('avg(dd)', 'mean_duration_change')}, {r('min(dd)', 'min_duration_change')}, {r('max(dd)', 'max_duration_change')}, {r('avg(df)', 'mean_fare_change')}, {r('min(df)', 'min_fare_change')},
{r('max(df)', 'max_fare_change')}, {r('count(*) filter (dd <= 0.01) * 100.0::double / count(*)', 'identical_pct')}, {r('count(*) filter (dd > 0.01 and dd <= 0.5) * 100.0::double / count(*)', 'minor_pct')},
{r('count(*) filter (dd > 0.5) * 100.0::double / count(*)', 'significant_pct')} from x""".replace(
            "{dry}",
            """(case when pred < estimated_distance / dv * 60 then estimated_distance / dv * 60 when pred > estimated_distance / 8 * 60 then estimated_distance / 8 * 60
    when estimated_distance > 15 and is_late_night = 0 then least(pred * 1.3, estimated_distance / 8 * 60) else pred * 1.1 end)""",
        ).replace(
            "as calibrated from c1)",
            """as calibrated from (select *, (case when is_rush_hour = 1 then least(case when pickup_is_manhattan = 1 then 20 else 30 end, case when is_airport_trip = 1 then 25 else 60 end) else 60 end)::double as dv from k))""",
        ),
        "feat", "flagged",
    ),
)
def what_if_weather(spark, sf):
    wet = _calibration_input(spark, sf)
    calm = {"snow": F.lit(0.0), "precipitation": F.lit(0.0), "is_raining": F.lit(0), "is_snowing": F.lit(0), "weather_severity": F.lit(0.0)}

    def scored(trips: DataFrame, label: str) -> DataFrame:
        out = scoring.tariff_scores(scoring.calibrate(trips), "calibrated_duration")
        return out.withColumns({f"duration_{label}": F.col("calibrated_duration"), f"fare_{label}": F.col("tariff_fare")})

    # both scores on one row: the second scoring replaces the first one's working columns, the labelled results stay
    with_weather = scored(wet, "a").select(*wet.columns, "duration_a", "fare_a")
    return tidy(scoring.what_if_summary(scored(with_weather.withColumns(calm), "b")))


# Models -----------------------------------------------------------------------------------------

SCALED = list(features.FEATURES)


def _scaled_sql() -> str:
    stats = ", ".join(f"avg(coalesce({c}, 0)) as m_{c}, coalesce(nullif(stddev_pop(coalesce({c}, 0)), 0), 1) as s_{c}" for c in SCALED)
    cells = ", ".join(r(f"least(greatest((coalesce({c}, 0) - m_{c}) / s_{c}, -10), 10)", c) for c in SCALED)
    return sql(f"select {KEYS}, split, {cells} from feat, (select {stats} from feat where split = 'train')", "feat")


@query("standardize_features", _scaled_sql())
def standardize_features(spark, sf):
    return tidy(models.standardize(inputs.enriched(spark, sf), SCALED).select(*KEY, "split", *SCALED))


@query("standardize_merged", _scaled_sql())
def standardize_merged(spark, sf):
    """Statistics kept per month as a small table; the training months' are merged and applied without reading those months again."""
    trips = inputs.enriched(spark, sf)
    kept = written_table(models.moments_by(trips, SCALED, "pickup_month"), "moments")
    train = kept.where(F.col("part") <= 10)
    return tidy(models.standardize_by(trips, SCALED, models.merge_moments(train)).select(*KEY, "split", *SCALED))


@query(
    "model_leaderboard",
    sql(
        f"""with p as (select target, model, y, case model when 'global mean' then avg(y) over (partition by target, model) when 'zone mean' then avg(y) over (partition by target, model, PULocationID) else guess end as g
  from (select 'fare' as target, model, PULocationID, fare_amount as y, y_pred as guess from scored_fare, (values ('global mean'), ('zone mean'), ('tariff')) m(model)
  union all select 'duration', model, PULocationID, trip_duration, estimated_distance / 25 * 60 from scored_fare, (values ('global mean'), ('zone mean'), ('flat speed')) m(model))),
m as (select target, model, count(*) as n, round(sqrt(avg((g - y) * (g - y))), 4) as rmse, round(avg(abs(g - y)), 4) as mae, round(1 - sum((g - y) * (g - y)) / (var_pop(y) * count(*)), 4) as r2 from p group by 1, 2)
select target, model, n, {r('rmse', 'rmse')}, {r('mae', 'mae')}, {r('r2', 'r2')}, (row_number() over (partition by target order by rmse, model))::int as place,
((case when row_number() over (partition by target order by r2 desc, model) = 1 then 1 else 0 end) + (case when row_number() over (partition by target order by mae, model) = 1 then 1 else 0 end))::int as wins from m""",
        "scored_fare",
    ),
)
def model_leaderboard(spark, sf):
    """Guesses that need no fit, for both targets: the mean, the pickup zone's mean, and the tariff or a flat 25 mph."""
    trips = inputs.scored_fare(spark, sf)
    y = {"fare": F.col("fare_amount").cast("double"), "duration": F.col("trip_duration")}
    means = trips.groupBy("PULocationID").agg(*[F.avg(c).alias(f"{t}_zone") for t, c in y.items()])
    overall = trips.agg(*[F.avg(c).alias(f"{t}_mean") for t, c in y.items()])
    rule = {"fare": ("tariff", F.col("y_pred")), "duration": ("flat speed", F.col("estimated_distance") / 25.0 * 60.0)}
    guesses = [
        F.struct(F.lit(t).alias("target"), F.lit(name).alias("model"), y[t].alias("y_true"), guess.alias("y_pred"))
        for t in y
        for name, guess in (("global mean", F.col(f"m.{t}_mean")), ("zone mean", F.col(f"{t}_zone")), rule[t])
    ]
    rows = attach_row(trips.join(means, "PULocationID").withColumnRenamed("y_true", "unused"), overall, "m").select(F.inline(F.array(*guesses)))
    return tidy(models.leaderboard(rows, TARGET))


# Importance -------------------------------------------------------------------------------------


def _scores_sql() -> str:
    rows = " union all ".join(
        f"select '{t}' as target, '{c}' as feature, coalesce(round(abs(corr({c}, {t})), 9), 0) as importance from feat" for c in features.FEATURES for t in features.TARGETS
    )
    return f"""raw_scores as ({rows}), sc as (select target, feature, case when isnan(importance) then 0 else importance end as importance from raw_scores),
tab as (select *, importance * 100 / sum(importance) over (partition by target) as pct, row_number() over (partition by target order by importance desc, feature) as place from sc),
full_ as (select *, sum(pct) over (partition by target order by place rows unbounded preceding) as cum from tab)"""


def _importance(spark, sf) -> DataFrame:
    return importance.importance_table(importance.correlation_scores(inputs.enriched(spark, sf), list(features.FEATURES), features.TARGETS))


@query(
    "feature_importance",
    sql(
        f"""with {_scores_sql()} select target, feature, {r('importance', 'importance')}, {r('pct', 'importance_pct')}, place::int as place, {r('cum', 'cumulative_pct')},
case when pct > 5 then '>5%' when pct > 1 then '1-5%' when pct > 0.5 then '0.5-1%' when pct > 0.1 then '0.1-0.5%' when pct > 0 then '<0.1%' end as size_class from full_""",
        "feat",
    ),
)
def feature_importance(spark, sf):
    return tidy(_importance(spark, sf))


@query(
    "importance_counts",
    sql(
        f"""with {_scores_sql()} select target, count(*) as features, count(*) filter (pct >= 1) as at_least_1_pct, count(*) filter (pct < 0.5) as below_half_pct, count(*) filter (cum <= 80) as within_80_pct,
count(*) filter (cum <= 90) as within_90_pct, {r('sum(pct) filter (place <= 5)', 'top5_pct')}, {r('sum(pct) filter (place <= 10)', 'top10_pct')} from full_ group by 1""",
        "feat",
    ),
)
def importance_counts(spark, sf):
    return tidy(importance.importance_counts(_importance(spark, sf)))


@query(
    "importance_by_category",
    sql(
        f"""with {_scores_sql()}, c as (select *, case when regexp_matches(lower(feature), 'hour|day|month|weekend|rush|night|holiday') then 'Temporal'
  when regexp_matches(lower(feature), 'distance|duration|route|typical|actual|ratio|efficiency') then 'Trip Metrics' when regexp_matches(lower(feature), 'airport|manhattan|borough|location|popular|cross') then 'Geographic'
  when regexp_matches(lower(feature), 'interaction|_x_|combined') then 'Interactions' when regexp_matches(lower(feature), 'sin|cos') then 'Cyclical' else 'Other' end as category from full_),
k as (select *, row_number() over (partition by target, category order by place) as n from c)
select target, category, {r('sum(pct)', 'total_pct')}, {r('avg(pct)', 'avg_pct')}, count(*) as features, max(feature) filter (n = 1) as top_1, max(feature) filter (n = 2) as top_2, max(feature) filter (n = 3) as top_3 from k group by 1, 2""",
        "feat",
    ),
)
def importance_by_category(spark, sf):
    return tidy(importance.by_category(_importance(spark, sf)))


@query(
    "importance_compare",
    sql(
        f"""with {_scores_sql()}, x as (select a.feature, a.pct as p1, b.pct as p2, (case when a.place <= 10 and b.place <= 10 then 1 else 0 end)::int as shared from full_ a join full_ b on a.feature = b.feature
where a.target = 'fare_amount' and b.target = 'trip_duration')
select feature, {r('p1', 'first_pct')}, {r('p2', 'second_pct')}, {r('(p1 + p2) / 2', 'avg_pct')}, {r('abs(p1 - p2)', 'diff_pct')}, shared as in_both_top, (sum(shared) over ())::bigint as overlap from x""",
        "feat",
    ),
)
def importance_compare(spark, sf):
    return tidy(importance.compare(_importance(spark, sf), "fare_amount", "trip_duration"))
