"""Shared parts of the checking SQL (DuckDB dialect), written apart from the operators."""

from __future__ import annotations

from faremill.functions.weather import CLIMATE_RULES, NEUTRAL, WMO_CODES
from faremill.operators.holidays import BASE_ENTRIES

KEYS = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice"


def r(expression: str, name: str, digits: int = 6) -> str:
    """Rounded double under a name, nudged off decimal ties like the query's own rounding; abs keeps a negative zero out."""
    value = f"round(({expression})::double + 1e-9::double, {digits})::double"
    return f"(case when {value} = 0 then abs({value}) else {value} end) as {name}"


def i(condition: str, name: str) -> str:
    return f"(case when {condition} then 1 else 0 end)::int as {name}"


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


_BASE_VALUES = ", ".join(
    f"({n}, date '{d}', {text(name)}, {text(kind)}, {str(major).lower()})" for n, (d, name, kind, major) in enumerate(BASE_ENTRIES)
)
_WMO_VALUES = ", ".join(f"({code}, {text(group)}, {text(words)})" for code, (group, words) in WMO_CODES.items())

KEPT = """fare_amount is not null and trip_distance is not null and trip_duration is not null and passenger_count is not null
  and fare_amount >= 2.5 and fare_amount <= 250 and trip_distance >= 0.1 and trip_distance <= 50 and trip_duration >= 1
  and trip_duration <= 180 and passenger_count >= 1 and passenger_count <= 6 and trip_distance / (trip_duration / 60) <= 100"""

SEVERITY = """((case when precipitation > 0 then 2 else 0 end) + (case when precipitation > 0.1 then 2 else 0 end) + (case when snow > 0 then 3 else 0 end)
  + (case when snow > 1 then 2 else 0 end) + (case when wind_speed > 20 then 1 else 0 end) + (case when visibility < 5 then 2 else 0 end))::int"""

RUSH = "(pickup_hour between 7 and 9 or pickup_hour between 16 and 19)"
LATE = "(pickup_hour >= 22 or pickup_hour <= 4)"


def haversine(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    """Miles on the 6371 km sphere through the chord length."""
    a = (
        f"(pow(sin((radians({lat2}) - radians({lat1})) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2}))"
        f" * pow(sin((radians({lon2}) - radians({lon1})) / 2), 2))"
    )
    return f"(6371.0::double * 2 * asin(sqrt(case when {a} > 1 then 1 else {a} end)) * 0.621371::double)"


CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "trips": (
        (),
        f"""select {KEYS},
  timestamp '2022-01-01 00:00:00' + to_seconds((l_orderkey*7919 + l_partkey*104729 + l_linenumber*1709 + l_suppkey*31) % 31536000) as tpep_pickup_datetime,
  (l_orderkey*37 + l_partkey*101 + l_suppkey*13) % 12000 as duration_s,
  (l_partkey % 265 + 1)::int as PULocationID, ((l_orderkey*3 + l_suppkey) % 265 + 1)::int as DOLocationID,
  case when l_linenumber = 7 and l_partkey % 5 = 0 then null else ((l_linenumber + l_suppkey) % 8)::double end as passenger_count,
  (l_quantity - 1) * 1.05::double as trip_distance, l_extendedprice / 400::double as fare_amount, (l_linenumber % 6 + 1)::int as payment_type,
  ((l_orderkey*37 + l_partkey*101 + l_suppkey*13) % 12000)::double / 60 as trip_duration,
  tpep_pickup_datetime + to_seconds(duration_s) as tpep_dropoff_datetime
from lineitem""",
    ),
    "parts": (
        ("trips",),
        """select *, hour(tpep_pickup_datetime)::int as pickup_hour, day(tpep_pickup_datetime)::int as pickup_day, month(tpep_pickup_datetime)::int as pickup_month,
  (isodow(tpep_pickup_datetime) - 1)::int as pickup_weekday, dayofyear(tpep_pickup_datetime)::int as pickup_dayofyear,
  weekofyear(tpep_pickup_datetime)::int as pickup_weekofyear, tpep_pickup_datetime::date as pickup_date,
  (case when isodow(tpep_pickup_datetime) >= 6 then 1 else 0 end)::int as is_weekend from trips""",
    ),
    "clean": (("parts",), f"select * from parts where {KEPT}"),
    "weather": (
        (),
        """select timestamp '2022-01-01 00:00:00' + to_hours((o_orderkey*53) % 8760) as datetime, min(o_custkey % 100)::double as temperature,
  max(o_custkey % 61 + 35)::double as humidity, min(o_custkey % 31)::double as wind_speed,
  (case when min(o_custkey % 4) = 0 then min(o_custkey % 9) else 0 end) * 0.05::double as precipitation,
  (case when min(o_custkey % 7) = 0 then min(o_custkey % 5) else 0 end) * 0.5::double as snow, min(o_custkey % 12)::double as visibility,
  (max(o_custkey % 41) + 990)::double as pressure_hpa, max(o_custkey % 101)::double as clouds, min(o_custkey % 97)::int as weathercode
from orders where (o_orderkey*53) % 8760 % 10 <> 3 group by 1""",
    ),
    "wflags": (
        ("weather",),
        f"""select *, temperature as feels_like, pressure_hpa * 0.02953::double as pressure, {SEVERITY} as weather_severity, {i('precipitation > 0', 'is_raining')}, {i('snow > 0', 'is_snowing')},
  {i('precipitation > 0.1', 'is_heavy_rain')}, {i('snow > 1', 'is_heavy_snow')}, {i(SEVERITY + ' >= 5', 'is_extreme_weather')}, {i('visibility < 5', 'is_poor_visibility')} from weather""",
    ),
    "wmo": ((), f"select * from (values {_WMO_VALUES}) t(code, main, description)"),
    "base_days": ((), f"select * from (values {_BASE_VALUES}) t(list_order, date, name, type, major)"),
    "surround": (
        ("base_days",),
        """select (b.date + s.shift)::date as date, (case when s.shift < 0 then 'Day Before ' else 'Day After ' end) ||
    (select f.name from base_days f where f.date = b.date order by f.list_order limit 1) as name, 'surrounding' as type, false as major,
    b.date as source_date, b.list_order, s.shift from base_days b, (values (-1), (1)) s(shift) where b.major""",
    ),
    "calendar": (
        ("surround",),
        """select distinct on (date) date, name, type, major, dayname(date) as day_of_week from (
    select date, name, type, major, 0 as tier, date as source_date, list_order, 0 as shift from base_days
    union all select date, name, type, major, 1, source_date, list_order, shift from surround) order by date, tier, source_date, list_order, shift""",
    ),
    "flagged": (
        ("clean",),
        f"""select *, {i(RUSH, 'is_rush_hour')}, {i(LATE, 'is_late_night')}, {i('pickup_hour between 9 and 17 and pickup_weekday < 5', 'is_business_hours')},
  {i('PULocationID in (132,138,161)', 'pickup_is_airport')}, {i('DOLocationID in (132,138,161)', 'dropoff_is_airport')},
  {i('PULocationID in (132,138,161) or DOLocationID in (132,138,161)', 'is_airport_trip')},
  {i('PULocationID >= 4 and PULocationID < 234', 'pickup_is_manhattan')}, {i('DOLocationID >= 4 and DOLocationID < 234', 'dropoff_is_manhattan')},
  {i('PULocationID = DOLocationID', 'same_location')}, least(greatest(trip_distance, 0.1), 50)::double as estimated_distance,
  {i('pickup_hour <= 6 or pickup_hour >= 22', 'is_night')}, {i('pickup_hour in (7,8,9)', 'is_morning_rush')}, {i('pickup_hour in (17,18,19)', 'is_evening_rush')},
  case when pickup_month <= 10 then 'train' when pickup_month = 11 then 'val' else 'test' end as split from clean""",
    ),
    "joined": (
        ("flagged", "wflags"),
        """select f.*, w.temperature, w.feels_like, w.humidity, w.pressure, w.wind_speed, w.clouds, w.precipitation, w.snow, w.weather_severity::double as weather_severity,
  w.is_raining, w.is_snowing, w.is_heavy_rain, w.is_heavy_snow, w.is_extreme_weather, w.is_poor_visibility
from flagged f left join wflags w on date_trunc('hour', f.tpep_pickup_datetime) = w.datetime""",
    ),
    "medians": (
        ("joined",),
        "select pickup_month, " + ", ".join(f"quantile_cont({c}, 0.5) as m_{c}" for c in ("temperature", "humidity", "wind_speed", "precipitation", "snow", "weather_severity"))
        + " from joined group by pickup_month",
    ),
    "imputed": (
        ("medians",),
        "select j.* replace ("
        + ", ".join(f"coalesce(j.{c}, m.m_{c})::double as {c}" for c in ("temperature", "humidity", "wind_speed", "precipitation", "snow", "weather_severity"))
        + ", "
        + ", ".join(f"coalesce(j.{c}, 0)::int as {c}" for c in ("is_raining", "is_snowing", "is_extreme_weather", "is_poor_visibility"))
        + ") from joined j join medians m on j.pickup_month = m.pickup_month",
    ),
    "holi": (
        ("imputed", "calendar"),
        f"""select t.*, {i('exists (select 1 from calendar c where c.date = t.pickup_date)', 'is_holiday')},
  {i('exists (select 1 from calendar c where c.date = t.pickup_date and c.major)', 'is_major_holiday')},
  {i('exists (select 1 from calendar c where c.major and t.pickup_date >= c.date - 3 and t.pickup_date <= c.date + 3)', 'is_holiday_week')} from imputed t""",
    ),
    "feat": (
        ("holi",),
        """select *, weather_severity*is_airport_trip as weather_airport_interaction, weather_severity*is_rush_hour as weather_rushhour_interaction,
  (is_rush_hour*is_airport_trip)::int as rushhour_airport_interaction, (is_late_night*pickup_is_manhattan)::int as latenight_manhattan_interaction,
  estimated_distance*pickup_hour as distance_hour_interaction, estimated_distance*is_rush_hour as distance_rushhour_interaction,
  (is_holiday*is_airport_trip)::int as holiday_airport_interaction, (is_holiday*pickup_is_manhattan)::int as holiday_manhattan_interaction,
  is_raining*estimated_distance as rain_distance_interaction, is_snowing*estimated_distance as snow_distance_interaction,
  sin(2*pi()*pickup_hour/24) as hour_sin, cos(2*pi()*pickup_hour/24) as hour_cos, sin(2*pi()*pickup_weekday/7) as weekday_sin, cos(2*pi()*pickup_weekday/7) as weekday_cos,
  sin(2*pi()*pickup_month/12) as month_sin, cos(2*pi()*pickup_month/12) as month_cos, sin(2*pi()*pickup_dayofyear/365) as dayofyear_sin,
  cos(2*pi()*pickup_dayofyear/365) as dayofyear_cos from holi""",
    ),
    "folded": (
        ("clean",),
        "select * replace (((PULocationID - 1) % 20 + 1)::int as PULocationID, ((DOLocationID - 1) % 20 + 1)::int as DOLocationID) from clean",
    ),
    "zones": (
        (),
        """select id::int as LocationID, ['Manhattan','Queens','Brooklyn','Bronx','Staten Island','EWR'][id % 6 + 1] as Borough, 'Area ' || id as Zone,
  ['Yellow Zone','Boro Zone','Airports','EWR'][id % 4 + 1] as service_zone, 40.5::double + (id % 17) * 0.03::double as lat, -74.2::double + (id % 23) * 0.03::double as lon
from range(1, 266) t(id)""",
    ),
    "lookup": (("zones",), "select * from zones where LocationID % 50 <> 0"),
    "points": (
        (),
        """select event_id, 40.48::double + (event_id*37 % 560)*0.001::double + 0.0005::double as lat, -74.25::double + (event_id*101 % 750)*0.001::double + 0.0005::double as lon,
  40.48::double + (event_id*53 % 560)*0.001::double + 0.0005::double as lat2, -74.25::double + (event_id*211 % 750)*0.001::double + 0.0005::double as lon2 from events""",
    ),
    "requests": (
        (),
        """select event_id as request_id, ts as request_time, timestamp '2022-01-01 00:00:00' + to_seconds((event_id*7919 + user_id*104729) % 31536000) as pickup_datetime,
  (event_id % 270)::int as PULocationID, ((event_id*7 + user_id) % 265 + 1)::int as DOLocationID, (user_id % 8)::int as passenger_count,
  ((event_id*37 + user_id*11) % 5200) * 0.01::double as estimated_distance, (event_id % 25)::int as pickup_hour,
  40.48::double + (event_id*37 % 560)*0.001::double + 0.0005::double as pickup_latitude, -74.25::double + (event_id*101 % 750)*0.001::double + 0.0005::double as pickup_longitude
from events""",
    ),
    "scored_fare": (
        ("feat",),
        """select *, fare_amount as y_true, (2.5::double + estimated_distance*2.5::double + trip_duration*0.5::double) * (case when is_raining = 1 or is_snowing = 1 then 1.1::double else 1::double end) as y_pred from feat""",
    ),
    "scored_minutes": (
        ("feat",),
        """select f.*, trip_duration as y_true, z.y_pred from feat f join (select PULocationID as pu, sum(duration_s)::double / count(*) / 60 as y_pred from feat group by 1) z on z.pu = f.PULocationID""",
    ),
    "scored_duration": (
        ("flagged",),
        """select f.*, trip_duration as y_true, z.y_pred from flagged f join (select PULocationID as pu, sum(duration_s)::double / count(*) / 60 as y_pred from flagged group by 1) z on z.pu = f.PULocationID""",
    ),
}


def _add(name: str, done: list[str]) -> None:
    if name not in done:
        for need in CTES[name][0]:
            _add(need, done)
        done.append(name)


def sql(body: str, *needs: str) -> str:
    """Body with the shared tables it needs in front."""
    done: list[str] = []
    for need in needs:
        _add(need, done)
    if not done:
        return body
    head = ",\n".join(f"{name} as ({CTES[name][1]})" for name in done)
    glue = ",\n" + body[5:] if body.startswith("with ") else "\n" + body
    return f"with {head}{glue}"


def errors_of(scored: str) -> str:
    """Error columns over a scored table."""
    return f"""err as (select *, y_pred - y_true as raw_error, abs(y_pred - y_true) as abs_error, (y_pred - y_true)*(y_pred - y_true) as squared_error,
  (y_pred - y_true) / nullif(y_true, 0) * 100 as pct_error, abs(y_pred - y_true) / nullif(y_true, 0) * 100 as abs_pct_error from {scored})"""


def climate(column: str, kind: str = "double") -> str:
    """Climate default of one column: the last matching rule that sets it wins."""
    out = ""
    for months, (first, last), changes, label, reason in reversed(CLIMATE_RULES):
        values = {**changes, "weather_label": label, "weather_reason": reason}
        if column in values:
            value = values[column]
            shown = text(value) if isinstance(value, str) else repr(value)
            out += f" when pickup_month in ({', '.join(map(str, months))}) and pickup_hour between {first} and {last} then {shown}"
    default = {**NEUTRAL, "weather_label": "Mild / Clear", "weather_reason": "Typical transitional conditions"}[column]
    shown = text(default) if isinstance(default, str) else repr(default)
    return f"(case{out} else {shown} end)::{kind} as {column}" if out else f"{shown}::{kind} as {column}"
