"""Queries: weather, holidays, feature composition and splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from faremill.functions import weather as wx
from faremill.operators import features, holidays, location, sampling, weather
from faremill.plans import inputs
from faremill.plans.inputs import tidy
from faremill.plans.registry import query
from faremill.plans.sql import KEYS, i, r, sql
from faremill.sources import views
from faremill.sources.views import HASH_KEY, KEY

# Weather ----------------------------------------------------------------------------------------


@query(
    "wmo_code_labels",
    sql(
        """select datetime, weathercode, coalesce(main, 'Unknown') as weather_main, coalesce(description, 'unknown') as weather_description
from weather left join wmo on code = weathercode""",
        "weather", "wmo",
    ),
)
def wmo_code_labels(spark, sf):
    return inputs.readings(spark, sf).select("datetime", "weathercode", *[c.alias(n) for n, c in wx.wmo_labels().items()])


@query(
    "weather_units",
    sql(
        f"""select datetime, {r('nullif(pressure_hpa, 0) * 0.02953::double', 'pressure_inhg')}, {r('nullif(visibility, 0) * 1000 / 1609.34::double', 'visibility_miles')},
{r('(temperature - 40) * 1.8::double + 32', 'temperature_f')}, {r('wind_speed * 2.23694::double', 'wind_mph')} from weather""",
        "weather",
    ),
)
def weather_units(spark, sf):
    return tidy(
        inputs.readings(spark, sf).select(
            "datetime", wx.hpa_to_inhg(F.col("pressure_hpa")).alias("pressure_inhg"), wx.metres_to_miles(F.col("visibility") * 1000.0).alias("visibility_miles"),
            wx.celsius_to_fahrenheit(F.col("temperature") - 40.0).alias("temperature_f"), wx.ms_to_mph(F.col("wind_speed")).alias("wind_mph"),
        )
    )


@query(
    "temp_category",
    sql(
        """select datetime, temperature, case when temperature > 80 then 'hot' when temperature > 65 then 'warm' when temperature > 50 then 'cool'
when temperature > 32 then 'cold' when temperature is not null then 'freezing' end as temp_category from weather""",
        "weather",
    ),
)
def temp_category(spark, sf):
    return inputs.readings(spark, sf).select("datetime", "temperature", wx.temp_category().alias("temp_category"))


FLAG_NAMES = "weather_severity, is_raining, is_snowing, is_heavy_rain, is_heavy_snow, is_extreme_weather, is_poor_visibility"


@query("weather_severity_flags", sql(f"select datetime, {FLAG_NAMES}, {i('wind_speed > 20 or precipitation > 5', 'is_severe')} from wflags", "wflags"))
def weather_severity_flags(spark, sf):
    return inputs.readings(spark, sf).select("datetime", *[c.alias(n) for n, c in wx.weather_flags().items()], wx.severe_simple().alias("is_severe"))


_LIVE = """live as (select datetime, temperature - 40 as temp_c, wind_speed / 2 as wind_ms, precipitation * 25 as rain_mm, snow * 5 as snow_mm, clouds as cloud_pct, case when humidity > 90 then null else humidity end as humidity_pct, pressure_hpa,
  case when visibility = 0 then null else visibility * 500 end as visibility_m from weather)"""


@query(
    "weather_tiers_live",
    sql(
        f"""with {_LIVE}, s as (select *, case when rain_mm >= 5 or snow_mm >= 5 then 5 when rain_mm > 0.1 or snow_mm > 0.1 then 3 when cloud_pct > 70 then 2 else 1 end::double as sev from live)
select datetime, {r('temp_c * 9 / 5 + 32', 'temperature')}, {r('temp_c * 9 / 5 + 32 - 0.7::double * greatest(0, wind_ms * 2.23694::double - 3)', 'feels_like')},
{r('wind_ms * 2.23694::double', 'wind_speed')}, {i('rain_mm > 0.1', 'is_raining')}, {i('snow_mm > 0.1', 'is_snowing')}, {i('rain_mm >= 5', 'is_heavy_rain')}, {i('snow_mm >= 5', 'is_heavy_snow')},
{r('coalesce(humidity_pct, 60)', 'humidity')}, {r('pressure_hpa', 'pressure')}, {r('cloud_pct', 'clouds')}, {r('rain_mm', 'precipitation')}, {r('snow_mm', 'snow')}, {r('coalesce(visibility_m, 10000)', 'visibility_m')},
{i('visibility_m < 1500', 'is_poor_visibility')}, sev as weather_severity, {i('sev >= 5', 'is_extreme_weather')} from s""",
        "weather",
    ),
)
def weather_tiers_live(spark, sf):
    live = inputs.readings(spark, sf).select(
        "datetime", (F.col("temperature") - 40.0).alias("temp_c"), (F.col("wind_speed") / 2.0).alias("wind_ms"), (F.col("precipitation") * 25.0).alias("rain_mm"),
        (F.col("snow") * 5.0).alias("snow_mm"), F.col("clouds").alias("cloud_pct"), (F.nullif("visibility", F.lit(0.0)) * 500.0).alias("visibility_m"),
        F.when(F.col("humidity") <= 90, F.col("humidity")).alias("humidity_pct"), "pressure_hpa",
    )
    return tidy(live.select("datetime", *[c.alias(n) for n, c in wx.live_tiers().items()]))


@query(
    "serving_weather",
    sql(
        f"""select datetime, temperature - 5 as feels_like, 60.0::double as humidity, 1013.0::double as pressure, 50.0::double as clouds, {r('case when is_snowing = 1 then precipitation else 0 end', 'snow')},
(is_raining + 2 * is_snowing)::double as weather_severity, {i('precipitation > 0.3', 'is_heavy_rain')}, {i('is_snowing = 1 and precipitation > 0.5', 'is_heavy_snow')},
{i('precipitation > 0.5 or wind_speed > 25', 'is_extreme_weather')}, {i('precipitation > 0.2 or is_snowing = 1', 'is_poor_visibility')} from wflags""",
        "wflags",
    ),
)
def serving_weather(spark, sf):
    """The weather columns a served request gets, for every hour with readings."""
    return tidy(inputs.hours(spark, sf).select("datetime", *[c.alias(n) for n, c in wx.serving_weather().items()]))


WEATHER_OUT = ", ".join(
    [r(c, c) for c in ("temperature", "feels_like", "humidity", "pressure", "wind_speed", "clouds", "precipitation", "snow", "weather_severity")]
    + ["is_raining", "is_snowing", "is_heavy_rain", "is_heavy_snow", "is_extreme_weather", "is_poor_visibility"]
)


@query("join_weather_hourly", sql(f"select {KEYS}, {WEATHER_OUT.replace(r('weather_severity', 'weather_severity'), 'weather_severity::int as weather_severity')} from joined", "joined"))
def join_weather_hourly(spark, sf):
    return tidy(weather.join_hourly(inputs.clean(spark, sf), inputs.hours(spark, sf)).select(*KEY, *weather.WEATHER_COLUMNS))


@query("impute_weather", sql(f"select {KEYS}, {WEATHER_OUT} from imputed", "imputed"))
def impute_weather(spark, sf):
    return tidy(weather.attach_weather(inputs.clean(spark, sf), inputs.hours(spark, sf)).select(*KEY, *weather.WEATHER_COLUMNS))


@query(
    "nearest_weather_hour",
    sql(
        f"""with q as (select request_id, date_trunc('hour', pickup_datetime) as h from requests),
b as (select distinct h from q), n as (select h, o from (select b.h, w.datetime as o, row_number() over (partition by b.h order by abs(epoch(w.datetime - b.h)), w.datetime) as k from b, weather w
  where w.datetime between b.h - interval 400 day and b.h + interval 400 day) where k = 1)
select request_id, o as observed_at, temperature, {r('precipitation', 'precipitation')} from q join n using (h) join weather w on w.datetime = n.o""",
        "requests", "weather",
    ),
)
def nearest_weather_hour(spark, sf):
    found = weather.nearest_hour(views.requests(spark, sf), inputs.readings(spark, sf))
    return tidy(
        found.select("request_id", F.col("obs.datetime").alias("observed_at"), F.col("obs.temperature").alias("temperature"), F.col("obs.precipitation").alias("precipitation"))
    )


@query(
    "weather_summary",
    sql(
        f"""select min(datetime) as first_hour, max(datetime) as last_hour, count(*) as hours, {r('avg(temperature)', 'mean_temperature')}, min(temperature) as min_temperature, max(temperature) as max_temperature,
sum(is_raining)::bigint as rainy_hours, {r('avg(is_raining) * 100', 'rainy_pct')}, sum(is_snowing)::bigint as snowy_hours, {r('avg(is_snowing) * 100', 'snowy_pct')},
{r('sum(precipitation)', 'total_precipitation', 4)}, {r('sum(snow)', 'total_snow', 4)}, {r('avg(wind_speed)', 'mean_wind')}, max(wind_speed) as max_wind, {r('avg(visibility)', 'mean_visibility')},
sum(is_extreme_weather)::bigint as extreme_hours, {r('avg(is_extreme_weather) * 100', 'extreme_pct')} from wflags""",
        "wflags",
    ),
)
def weather_summary(spark, sf):
    return tidy(tidy(weather.weather_summary(inputs.readings(spark, sf))).withColumns({c: F.round(c, 4) for c in ("total_precipitation", "total_snow")}))


@query(
    "weather_monthly",
    sql(
        f"""select month(datetime)::int as month, {r('avg(temperature)', 'mean_temperature')}, {r('sum(precipitation)', 'total_precipitation', 4)}, {r('sum(snow)', 'total_snow', 4)},
sum(is_extreme_weather)::bigint as extreme_hours from wflags group by 1""",
        "wflags",
    ),
)
def weather_monthly(spark, sf):
    return tidy(weather.weather_monthly(inputs.readings(spark, sf))).withColumns({c: F.round(c, 4) for c in ("total_precipitation", "total_snow")})


# Holidays ---------------------------------------------------------------------------------------


def _per_day(spark, sf):
    return inputs.raw(spark, sf).groupBy(F.to_date("tpep_pickup_datetime").alias("date")).agg(F.count("*").alias("trips"))


@query(
    "holiday_surrounding_days",
    sql("select s.date, s.name, s.type, s.major, coalesce(t.n, 0) as trips from surround s left join (select pickup_date, count(*) as n from parts group by 1) t on t.pickup_date = s.date", "surround", "parts"),
)
def holiday_surrounding_days(spark, sf):
    days = holidays.surrounding_days(holidays.base_calendar(spark)).select("date", "name", "type", "major")
    return days.join(_per_day(spark, sf), "date", "left").na.fill(0, ["trips"])


@query(
    "holiday_calendar",
    sql("select c.*, coalesce(t.n, 0) as trips from calendar c left join (select pickup_date, count(*) as n from parts group by 1) t on t.pickup_date = c.date", "calendar", "parts"),
)
def holiday_calendar(spark, sf):
    return inputs.calendar(spark).join(_per_day(spark, sf), "date", "left").na.fill(0, ["trips"])


@query("join_holiday_flags", sql(f"select {KEYS}, is_holiday, is_major_holiday from holi", "holi"))
def join_holiday_flags(spark, sf):
    return holidays.holiday_flags(inputs.clean(spark, sf), inputs.calendar(spark)).select(*KEY, "is_holiday", "is_major_holiday")


@query("holiday_week_flag", sql(f"select {KEYS}, is_holiday_week from holi", "holi"))
def holiday_week_flag(spark, sf):
    return holidays.holiday_week_flag(inputs.clean(spark, sf), inputs.calendar(spark)).select(*KEY, "is_holiday_week")


@query(
    "days_to_from_holiday",
    sql(
        f"""with d as (select distinct pickup_date from clean), g as (select pickup_date, (select min(c.date) from calendar c where c.date > d.pickup_date) - pickup_date as t,
  pickup_date - (select max(c.date) from calendar c where c.date < d.pickup_date) as f from d)
select {KEYS}, (case when t <= 3 then t else 0 end)::int as days_to_holiday, (case when f <= 3 then f else 0 end)::int as days_from_holiday from clean join g using (pickup_date)""",
        "clean", "calendar",
    ),
)
def days_to_from_holiday(spark, sf):
    return holidays.days_around(inputs.clean(spark, sf), inputs.calendar(spark)).select(*KEY, "days_to_holiday", "days_from_holiday")


@query(
    "holiday_summary",
    sql(
        """with c as (select c.*, coalesce(t.n, 0) as n from calendar c left join (select pickup_date, count(*) as n from parts group by 1) t on t.pickup_date = c.date)
select 'type' as breakdown, type as value, count(*) as dates, count(*) filter (major) as major_dates, min(date) as first_date, max(date) as last_date, sum(n)::bigint as trips from c group by type
union all select 'month', monthname(date), count(*), count(*) filter (major), min(date), max(date), sum(n)::bigint from c group by monthname(date)""",
        "calendar", "parts",
    ),
)
def holiday_summary(spark, sf):
    dated = holiday_calendar(spark, sf)
    sides = F.array(
        F.struct(F.lit("type").alias("breakdown"), F.col("type").alias("value")), F.struct(F.lit("month").alias("breakdown"), F.date_format("date", "MMMM").alias("value"))
    )
    return dated.select(F.inline(sides), "date", "major", "trips").groupBy("breakdown", "value").agg(
        F.count("*").alias("dates"), F.count_if("major").alias("major_dates"), F.min("date").alias("first_date"), F.max("date").alias("last_date"), F.sum("trips").alias("trips")
    )


# Features ---------------------------------------------------------------------------------------

_INT_FEATURES = {
    *features.LOCATION_COLUMNS, *features.TEMPORAL_COLUMNS, *features.HOLIDAY_COLUMNS, "is_raining", "is_snowing", "is_heavy_rain", "is_heavy_snow", "is_extreme_weather",
    "is_poor_visibility", "rushhour_airport_interaction", "latenight_manhattan_interaction", "holiday_airport_interaction", "holiday_manhattan_interaction",
}


def columns_sql(names) -> str:
    return ", ".join(n if n in _INT_FEATURES else r(n, n) for n in names)


@query("base_interactions", sql(f"select {KEYS}, {columns_sql(features.BASE_PRODUCTS)} from feat", "feat"))
def base_interactions(spark, sf):
    return tidy(inputs.enriched(spark, sf).select(*KEY, *features.BASE_PRODUCTS))


@query(
    "enhanced_interactions",
    sql(
        f"""select {KEYS}, {r('weather_severity * trip_distance', 'weather_distance_interaction')}, {r('weather_severity * is_rush_hour', 'weather_rushhour_interaction')},
(is_raining * is_airport_trip)::int as rain_airport_interaction, (is_holiday * pickup_hour)::int as holiday_hour_interaction, {r('is_holiday * trip_distance', 'holiday_distance_interaction')},
{r('is_extreme_weather * trip_distance', 'extreme_weather_distance')}, {i('temperature < 32 or temperature > 85', 'temp_demand_score')}, {r('is_snowing * trip_duration', 'snow_duration_interaction')} from feat""",
        "feat",
    ),
)
def enhanced_interactions(spark, sf):
    return tidy(inputs.enriched(spark, sf).select(*KEY, *[c.alias(n) for n, c in features.enhanced_interactions(leaky=True).items()]))


_D, _H, _P = "estimated_distance", "pickup_hour", "passenger_count"
_TWENTY = [
    r(f"{_D}*is_raining", "distance_rain"), r(f"{_D}*is_snowing", "distance_snow"), r(f"{_D}*weather_severity", "distance_weather_severity"), f"(is_holiday*{_H})::int as holiday_hour",
    "(is_major_holiday*is_rush_hour)::int as major_holiday_rush", "(is_rush_hour*is_raining)::int as rush_rain", "(is_rush_hour*is_snowing)::int as rush_snow",
    "(pickup_is_manhattan*is_rush_hour)::int as manhattan_rush", "(pickup_is_manhattan*is_weekend)::int as manhattan_weekend", r(f"pickup_is_manhattan*{_D}", "manhattan_distance"),
    f"(is_airport_trip*{_H})::int as airport_hour", "(is_airport_trip*is_weekend)::int as airport_weekend", r(f"is_airport_trip*{_D}", "airport_distance"),
    r(f"{_P}*{_D}", "passengers_distance"), r(f"{_P}*is_rush_hour", "passengers_rush"), r(f"{_P}*is_airport_trip", "passengers_airport"),
    "(is_weekend*is_raining)::int as weekend_rain", r("is_weekend*temperature", "weekend_temp"), r(f"{_D}/(1+{_H}/24.0::double)", "speed_proxy_hour"),
    r("(PULocationID+DOLocationID)/2.0::double", "route_complexity"),
]
_THIRTY_ONE = [
    r(f"{_D}*{_H}*is_raining", "distance_hour_rain"), r(f"{_D}*is_rush_hour*pickup_is_manhattan", "distance_rush_manhattan"), r(f"{_D}*{_D}", "distance_squared"), r(f"sqrt({_D})", "distance_sqrt"),
    f"({_H}*{_H})::int as hour_squared", r("temperature*temperature", "temp_squared"), r(f"temperature*{_D}", "temp_distance"), r("temperature*is_rush_hour", "temp_rush"),
    r(f"wind_speed*{_D}", "wind_distance"), r("wind_speed*is_rush_hour", "wind_rush"), r(f"precipitation*{_D}", "precip_distance"), r(f"precipitation*{_H}", "precip_hour"),
    f"(pickup_weekday*{_H})::int as weekday_hour", r(f"pickup_day*{_D}", "day_distance"), r(f"is_late_night*{_D}", "latenight_distance"),
    "(is_late_night*pickup_is_manhattan)::int as latenight_manhattan", "(is_late_night*is_weekend)::int as latenight_weekend", r(f"is_business_hours*{_D}", "business_distance"),
    "(is_business_hours*pickup_is_manhattan)::int as business_manhattan", r("PULocationID/265.0::double", "pickup_density"), r("DOLocationID/265.0::double", "dropoff_density"),
    "((PULocationID*1000+DOLocationID)%10000)::int as route_hash", r(f"hour_sin*{_D}", "hoursin_distance"), r(f"hour_cos*{_D}", "hourcos_distance"),
    r(f"is_extreme_weather*{_D}", "extreme_distance"), "(is_poor_visibility*is_rush_hour)::int as poorvis_rush", r(f"{_P}*pickup_is_manhattan", "passengers_manhattan"),
    r(f"{_P}*is_weekend", "passengers_weekend"), r(f"is_holiday_week*{_D}", "holidayweek_distance"), f"(is_holiday_week*{_H})::int as holidayweek_hour", r(f"{_D}/({_P}+1)", "distance_per_passenger"),
]


@query("interactions_20", sql(f"select {KEYS}, {', '.join(_TWENTY)} from feat", "feat"))
def interactions_20(spark, sf):
    return tidy(inputs.enriched(spark, sf).select(*KEY, *[c.alias(n) for n, c in features.interactions_20().items()]))


@query("interactions_51", sql(f"select {KEYS}, {', '.join(_TWENTY + _THIRTY_ONE)} from feat", "feat"))
def interactions_51(spark, sf):
    return tidy(inputs.enriched(spark, sf).select(*KEY, *[c.alias(n) for n, c in features.interactions_51().items()]))


SAFE_SQL = f"select {KEYS}, {columns_sql(features.FEATURES)}, {r('fare_amount', 'fare_amount')}, {r('trip_duration', 'trip_duration')} from feat"


@query("safe_features", sql(SAFE_SQL, "feat"))
def safe_features(spark, sf):
    return tidy(features.safe_features(inputs.clean(spark, sf), inputs.hours(spark, sf), inputs.calendar(spark), KEY))


@query(
    "project_safe_columns",
    sql(
        f"select {KEYS}, {columns_sql(features.FEATURES)}, is_night, is_morning_rush, is_evening_rush from feat", "feat"
    ),
)
def project_safe_columns(spark, sf):
    return tidy(features.project_safe(inputs.enriched(spark, sf), KEY))


_AUDITED = (*features.FEATURES, "trip_distance", "total_amount", "snow_duration_interaction", "fare_in_cents")


def _audit_sql() -> str:
    rows = [
        f"""select '{c}' as column_name, {r(f'corr({c}::double, fare_amount)', 'corr_fare')}, {r(f'corr({c}::double, trip_duration)', 'corr_duration')},
{r(f'avg(case when {c} = fare_amount or {c} = trip_duration then 1 else 0 end)', 'equal_share')} from a"""
        for c in _AUDITED
    ]
    body = f"""with a as (select *, fare_amount + 3.5 as total_amount, is_snowing * trip_duration as snow_duration_interaction, fare_amount * 100 as fare_in_cents from feat),
rows_ as ({' union all '.join(rows)}), m as (select *, greatest(abs(coalesce(corr_fare, 0)), abs(coalesce(corr_duration, 0))) as top from rows_)
select column_name, {i("column_name in ('trip_distance', 'total_amount')", 'is_forbidden')}, corr_fare, corr_duration, equal_share,
{i("column_name not in ('trip_distance', 'total_amount', 'snow_duration_interaction', 'fare_in_cents')", 'in_contract')},
case when column_name in ('trip_distance', 'total_amount') then 'forbidden' when top > 0.999 or equal_share > 0.99 then 'suspicious' else 'safe' end as verdict from m"""
    return sql(body, "feat")


@query("leakage_audit", _audit_sql())
def leakage_audit(spark, sf):
    leaky = inputs.enriched(spark, sf).withColumns(
        {
            "total_amount": F.col("fare_amount") + 3.5, "snow_duration_interaction": F.col("is_snowing") * F.col("trip_duration"), "fare_in_cents": F.col("fare_amount") * 100.0,
        }
    )
    return tidy(features.leakage_audit(leaky, list(_AUDITED)))


@query(
    "context_interactions",
    sql(
        f"""with e as (select f.*, p.Borough as pb, d.Borough as db from feat f left join lookup p on p.LocationID = f.PULocationID left join lookup d on d.LocationID = f.DOLocationID)
select {KEYS}, {i('is_rush_hour = 1 and is_airport_trip = 1', 'rush_airport')}, {i('is_weekend = 1 and is_night = 1', 'weekend_night')}, {i('pb <> db and is_rush_hour = 1', 'cross_borough_rush')},
{i('trip_distance > 10 and is_night = 1', 'long_trip_night')}, {i('is_raining = 1 and is_rush_hour = 1', 'rain_rush_hour')}, {i('is_weekend = 1 and pickup_hour >= 20', 'weekend_evening')} from e""",
        "feat", "lookup",
    ),
)
def context_interactions(spark, sf):
    trips = location.enrich_zones(inputs.enriched(spark, sf), views.zone_lookup(spark)).withColumns(location.borough_flow_flags())
    return trips.select(*KEY, *[c.alias(n) for n, c in features.context_interactions().items()])


# Splits and samples -----------------------------------------------------------------------------

HASH = "(l_orderkey*7919 + l_partkey*104729 + l_linenumber*1709 + l_suppkey*31)"


@query(
    "temporal_split",
    sql("select split, count(*) as trips, min(pickup_month) as first_month, max(pickup_month) as last_month from flagged group by 1", "flagged"),
)
def temporal_split(spark, sf):
    return sampling.split_counts(inputs.clean(spark, sf).withColumn("split", sampling.month_split()))


@query("random_split_80_20", sql(f"select {KEYS}, case when {HASH} % 100 < 20 then 'test' else 'train' end as split from clean", "clean"))
def random_split_80_20(spark, sf):
    return inputs.clean(spark, sf).select(*KEY, sampling.hash_split(HASH_KEY).alias("split"))


@query(
    "sample_per_month",
    sql(f"select {KEYS}, pickup_month from clean qualify row_number() over (partition by pickup_month order by {HASH} % 1000003, {KEYS}) <= 200", "clean"),
)
def sample_per_month(spark, sf):
    return sampling.sample_per_group(inputs.clean(spark, sf).select(*KEY, "pickup_month"), "pickup_month", 200, HASH_KEY, KEY)


@query("sample_n", sql(f"select {KEYS}, {r('fare_amount', 'fare_amount')} from clean order by {HASH} % 1000003, {KEYS} limit 1000", "clean"))
def sample_n(spark, sf):
    return tidy(sampling.sample_n(inputs.clean(spark, sf).select(*KEY, "fare_amount"), 1000, HASH_KEY, KEY))


_FOLDS = f"""f as (select {HASH} % 5 as fold, trip_duration as y from clean), t as (select fold, count(*) as n, avg(y) as own,
  (select avg(y) from f o where o.fold <> f.fold) as guess from f group by fold),
m as (select f.fold, count(*) as n, 1 - sum((y - guess) * (y - guess)) / sum((y - own) * (y - own)) as r2, sqrt(avg((y - guess) * (y - guess))) as rmse from f join t on t.fold = f.fold group by f.fold)"""


@query("kfold_metrics", sql(f"with {_FOLDS} select fold::int as fold, n, {r('r2', 'r2')}, {r('rmse', 'rmse')} from m", "clean"))
def kfold_metrics(spark, sf):
    return tidy(sampling.kfold_mean_metrics(inputs.clean(spark, sf), "trip_duration", HASH_KEY))


@query(
    "kfold_summary",
    sql(
        f"""with {_FOLDS}, s as (select count(*) as folds, avg(rmse) as mean_rmse, stddev_pop(rmse) as std_rmse, min(rmse) as min_rmse, max(rmse) as max_rmse, avg(r2) as mean_r2 from m)
select folds, {r('mean_r2', 'mean_r2')}, {r('mean_rmse', 'mean_rmse')}, {r('std_rmse', 'std_rmse')}, {r('min_rmse', 'min_rmse')}, {r('max_rmse', 'max_rmse')}, {r('std_rmse / mean_rmse * 100', 'cov_pct')},
case when std_rmse / mean_rmse < 0.01 then 'very stable' when std_rmse / mean_rmse < 0.03 then 'stable' when std_rmse / mean_rmse < 0.05 then 'moderate' else 'high variation' end as stability from s""",
        "clean",
    ),
)
def kfold_summary(spark, sf):
    return tidy(sampling.kfold_summary(sampling.kfold_mean_metrics(inputs.clean(spark, sf), "trip_duration", HASH_KEY)))
