"""Queries: calendar projections, zones, distances and routes."""

from __future__ import annotations

from pyspark.sql import functions as F

from faremill.functions import calendar as cal
from faremill.functions.geometry import bearing_degrees, haversine_miles, ring_centroid
from faremill.functions.weather import NEUTRAL, climate_defaults
from faremill.operators import location
from faremill.plans import inputs
from faremill.plans.inputs import tidy
from faremill.plans.registry import query
from faremill.plans.sql import KEYS, climate, haversine, i, r, sql
from faremill.profile import SERVING
from faremill.sources import views
from faremill.sources.views import KEY


def _timed_parts(spark, sf):
    return inputs.raw(spark, sf).withColumns({**cal.calendar_parts(), "pickup_date": F.to_date("tpep_pickup_datetime")})


@query(
    "calendar_parts",
    sql(f"select {KEYS}, pickup_hour, pickup_day, pickup_month, pickup_weekday, pickup_dayofyear, pickup_weekofyear, pickup_date from parts", "parts"),
)
def calendar_parts(spark, sf):
    return _timed_parts(spark, sf).select(*KEY, *cal.calendar_parts(), "pickup_date")


@query("time_flags", sql(f"select {KEYS}, is_weekend, is_rush_hour, is_late_night, is_business_hours from flagged", "flagged"))
def time_flags(spark, sf):
    return inputs.clean(spark, sf).withColumns(cal.time_flags()).select(*KEY, *cal.time_flags())


@query(
    "time_flags_serving",
    sql(
        f"""select {KEYS}, is_weekend, {i('pickup_hour in (7,8,9,17,18,19)', 'is_rush_hour')}, {i('pickup_hour >= 23 or pickup_hour < 4', 'is_late_night')},
{i('pickup_hour between 9 and 17 and pickup_weekday < 5', 'is_business_hours')} from clean""",
        "clean",
    ),
)
def time_flags_serving(spark, sf):
    return inputs.clean(spark, sf).withColumns(cal.time_flags(SERVING)).select(*KEY, *cal.time_flags())


@query(
    "night_and_rush_parts",
    sql(
        f"select {KEYS}, {i('pickup_hour in (0,1,2,3,4,5,6,22,23)', 'is_night')}, {i('pickup_hour in (7,8,9)', 'is_morning_rush')}, {i('pickup_hour in (17,18,19)', 'is_evening_rush')} from parts",
        "parts",
    ),
)
def night_and_rush_parts(spark, sf):
    return _timed_parts(spark, sf).withColumns(cal.night_and_rush_parts()).select(*KEY, *cal.night_and_rush_parts())


_CYCLES = ", ".join(
    r(f"{f}(2 * pi() * {source} / {period})", f"{name}_{f}")
    for name, source, period in (("hour", "pickup_hour", 24), ("weekday", "pickup_weekday", 7), ("month", "pickup_month", 12), ("dayofyear", "pickup_dayofyear", 365))
    for f in ("sin", "cos")
)


@query("cyclical_encoding", sql(f"select {KEYS}, {_CYCLES} from parts", "parts"))
def cyclical_encoding(spark, sf):
    return tidy(_timed_parts(spark, sf).withColumns(cal.cyclical_encoding()).select(*KEY, *cal.cyclical_encoding()))


@query(
    "time_of_day",
    sql(
        f"""select {KEYS}, case when pickup_hour >= 6 and pickup_hour < 12 then 'morning' when pickup_hour >= 12 and pickup_hour < 18 then 'afternoon'
when pickup_hour >= 18 and pickup_hour < 22 then 'evening' else 'night' end as time_of_day from parts""",
        "parts",
    ),
)
def time_of_day(spark, sf):
    return _timed_parts(spark, sf).select(*KEY, cal.time_of_day().alias("time_of_day"))


@query(
    "season_of_month",
    sql(f"select {KEYS}, ['Winter','Winter','Spring','Spring','Spring','Summer','Summer','Summer','Fall','Fall','Fall','Winter'][pickup_month] as season from parts", "parts"),
)
def season_of_month(spark, sf):
    return _timed_parts(spark, sf).select(*KEY, cal.season_of().alias("season"))


@query(
    "traffic_level",
    sql(
        f"""with l as (select *, case when (pickup_hour between 7 and 9 or pickup_hour between 16 and 19) and pickup_weekday < 5 then 'H' when pickup_weekday >= 5 and pickup_hour between 12 and 18 then 'W'
  when pickup_hour >= 22 or pickup_hour <= 5 then 'L' else 'M' end as k from parts)
select {KEYS}, case k when 'H' then 'Heavy' when 'L' then 'Light' else 'Moderate' end as traffic_level, case k when 'H' then 'Weekday rush hour' when 'W' then 'Weekend midday traffic'
when 'L' then 'Late night/early morning' else 'Typical daytime flow' end as traffic_reason from l""",
        "parts",
    ),
)
def traffic_level(spark, sf):
    return _timed_parts(spark, sf).select(*KEY, *[c.alias(n) for n, c in cal.traffic_level().items()])


@query(
    "rule_holiday",
    sql(
        f"""with h as (select *, case when strftime(pickup_date, '%m-%d') = '01-01' then 'New Year''s Day' when strftime(pickup_date, '%m-%d') = '07-04' then 'Independence Day'
  when strftime(pickup_date, '%m-%d') = '12-25' then 'Christmas Day' when pickup_month = 11 and pickup_day between 22 and 28 and pickup_weekday = 3 then 'Thanksgiving' else 'None' end as holiday_name from parts)
select {KEYS}, holiday_name, {i("holiday_name <> 'None'", 'is_holiday')}, {i("holiday_name <> 'None'", 'is_major_holiday')}, {i("holiday_name <> 'None'", 'is_holiday_week')} from h""",
        "parts",
    ),
)
def rule_holiday(spark, sf):
    return _timed_parts(spark, sf).select(*KEY, *[c.alias(n) for n, c in cal.rule_holiday().items()])


_CLIMATE = ", ".join(climate(n, "int" if n.startswith("is_") else "double") for n in NEUTRAL) + ", " + climate("weather_label", "varchar") + ", " + climate("weather_reason", "varchar")


@query("rule_weather", sql(f"select {KEYS}, {_CLIMATE} from parts", "parts"))
def rule_weather(spark, sf):
    return _timed_parts(spark, sf).select(*KEY, *[c.alias(n) for n, c in climate_defaults().items()])


# Location ---------------------------------------------------------------------------------------

@query(
    "location_flags",
    sql(f"select {KEYS}, pickup_is_airport, dropoff_is_airport, is_airport_trip, pickup_is_manhattan, dropoff_is_manhattan, same_location from flagged", "flagged"),
)
def location_flags(spark, sf):
    return inputs.clean(spark, sf).select(*KEY, *[c.alias(n) for n, c in location.location_flags().items()])


_ENRICHED = """enriched as (select t.*, p.Borough as pickup_borough, coalesce(p.Zone, 'Zone ' || t.PULocationID) as pickup_zone, p.service_zone as pickup_service_zone,
  d.Borough as dropoff_borough, coalesce(d.Zone, 'Zone ' || t.DOLocationID) as dropoff_zone, d.service_zone as dropoff_service_zone
  from clean t left join lookup p on p.LocationID = t.PULocationID left join lookup d on d.LocationID = t.DOLocationID)"""


@query(
    "zone_enrich",
    sql(f"with {_ENRICHED} select {KEYS}, pickup_borough, pickup_zone, pickup_service_zone, dropoff_borough, dropoff_zone, dropoff_service_zone from enriched", "clean", "lookup"),
)
def zone_enrich(spark, sf):
    names = [f"{end}_{what}" for end in ("pickup", "dropoff") for what in ("borough", "zone", "service_zone")]
    return location.enrich_zones(inputs.clean(spark, sf), views.zone_lookup(spark)).select(*KEY, *names)


@query(
    "borough_flow_flags",
    sql(
        f"""with {_ENRICHED} select {KEYS}, {i('pickup_borough <> dropoff_borough', 'is_cross_borough')}, {i("pickup_borough = 'Manhattan' and dropoff_borough = 'Manhattan'", 'both_manhattan')},
{i("pickup_borough = 'Manhattan' and DOLocationID in (132,138,161)", 'manhattan_to_airport')}, {i("dropoff_borough = 'Manhattan' and PULocationID in (132,138,161)", 'airport_to_manhattan')} from enriched""",
        "clean", "lookup",
    ),
)
def borough_flow_flags(spark, sf):
    trips = location.enrich_zones(inputs.clean(spark, sf), views.zone_lookup(spark))
    return trips.select(*KEY, *[c.alias(n) for n, c in location.borough_flow_flags().items()])


@query(
    "haversine_centroid",
    sql(
        f"""select {KEYS}, {r('coalesce(' + haversine('p.lat', 'p.lon', 'd.lat', 'd.lon') + ', 0)', 'centroid_distance')}
from clean t left join lookup p on p.LocationID = t.PULocationID left join lookup d on d.LocationID = t.DOLocationID""",
        "clean", "lookup",
    ),
)
def haversine_centroid(spark, sf):
    return tidy(location.centroid_distance(inputs.clean(spark, sf), views.zone_lookup(spark)).select(*KEY, "centroid_distance"))


@query(
    "haversine_points",
    sql(
        f"""select event_id, {r('2 * 3959::double * atan2(sqrt(a), sqrt(1 - a))', 'miles')} from (select event_id,
pow(sin((radians(lat2) - radians(lat)) / 2), 2) + cos(radians(lat)) * cos(radians(lat2)) * pow(sin((radians(lon2) - radians(lon)) / 2), 2) as a from points)""",
        "points",
    ),
)
def haversine_points(spark, sf):
    miles = haversine_miles(F.col("lat"), F.col("lon"), F.col("lat2"), F.col("lon2"))
    return tidy(views.points(spark, sf).select("event_id", miles.alias("miles")))


@query(
    "bearing_degrees",
    sql(
        f"""select event_id, {r('case when d < 0 then d + 360 else d end', 'bearing')} from (select event_id, degrees(atan2(sin(radians(lon2 - lon)) * cos(radians(lat2)),
cos(radians(lat)) * sin(radians(lat2)) - sin(radians(lat)) * cos(radians(lat2)) * cos(radians(lon2 - lon)))) as d from points)""",
        "points",
    ),
)
def bearing(spark, sf):
    return tidy(views.points(spark, sf).select("event_id", bearing_degrees(F.col("lat"), F.col("lon"), F.col("lat2"), F.col("lon2")).alias("bearing")))


@query(
    "polygon_centroid",
    f"""with p as (select c_custkey, 40::double + (c_custkey % 100) * 0.01::double as lat0, -75::double + (c_custkey % 77) * 0.01::double as lon0, (c_custkey % 9 + 1) * 0.001::double as w,
  (c_custkey % 7 + 1) * 0.001::double as h, (c_nationkey % 5 + 1) * 0.0005::double as d from customer),
c as (select c_custkey, lat0, lon0, w * h + w * d / 2 as area, w * h * h / 2 + w * d / 2 * (h + d / 3) as moment_y, w from p)
select c_custkey, {r('lat0 + moment_y / area', 'centroid_lat')}, {r('lon0 + w / 2', 'centroid_lon')} from c""",
)
def polygon_centroid(spark, sf):
    centre = views.parcel_rings(spark, sf).select("c_custkey", ring_centroid(F.col("ring")).alias("c"))
    return tidy(centre.select("c_custkey", F.col("c.lat").alias("centroid_lat"), F.col("c.lon").alias("centroid_lon")))


INSIDE = """inside as (select p.*, (select min(z.LocationID) from zones z where p.lat > z.lat - 0.01 and p.lat < z.lat + 0.01 and p.lon > z.lon - 0.01 and p.lon < z.lon + 0.01) as zone_id from points p)"""
NEAREST = f"""near as (select event_id, LocationID as nearest_zone_id, miles from (select p.event_id, z.LocationID, round({haversine('p.lat', 'p.lon', 'z.lat', 'z.lon')}, 9) as miles
  from points p, zones z) qualify row_number() over (partition by event_id order by miles, LocationID) = 1)"""


@query("point_in_zone", sql(f"with {INSIDE} select event_id, zone_id from inside", "points", "zones"))
def point_in_zone(spark, sf):
    return location.point_in_zone(views.points(spark, sf), views.zone_rings(spark)).select("event_id", "zone_id")


@query("nearest_zone", sql(f"with {NEAREST} select event_id, nearest_zone_id, {r('miles', 'nearest_miles')} from near", "points", "zones"))
def nearest_zone(spark, sf):
    return tidy(location.nearest_zone(views.points(spark, sf), views.zones(spark)).select("event_id", "nearest_zone_id", "nearest_miles"))


@query(
    "resolve_zone",
    sql(
        f"with {INSIDE}, {NEAREST} select event_id, coalesce(zone_id, nearest_zone_id) as zone_id, {i('zone_id is null', 'used_fallback')} from inside join near using (event_id)",
        "points", "zones",
    ),
)
def resolve_zone(spark, sf):
    return location.resolve_zone(views.points(spark, sf), views.zone_rings(spark), views.zones(spark)).select("event_id", "zone_id", "used_fallback")


@query(
    "distance_clip_category",
    sql(
        f"""with c as (select *, case when trip_distance < 0.1 then 0.1 when trip_distance > 50 then 50 else trip_distance end::double as e from trips)
select {KEYS}, {r('e', 'estimated_distance')}, case when e > 10 then 'very_long' when e > 5 then 'long' when e > 3 then 'medium' when e > 1 then 'short' else 'very_short' end as distance_category from c""",
        "trips",
    ),
)
def distance_clip_category(spark, sf):
    return tidy(inputs.raw(spark, sf).select(*KEY, *[c.alias(n) for n, c in location.distance_features().items()]))


@query(
    "route_encodings",
    sql(
        f"""select {KEYS}, {r('(PULocationID + DOLocationID) / 2.0::double', 'route_complexity')}, {r('PULocationID / 265.0::double', 'pickup_density')},
{r('DOLocationID / 265.0::double', 'dropoff_density')}, ((PULocationID * 1000 + DOLocationID) % 10000)::int as route_hash from clean""",
        "clean",
    ),
)
def route_encodings(spark, sf):
    return tidy(inputs.clean(spark, sf).select(*KEY, *[c.alias(n) for n, c in location.route_encodings().items()]))


_PROFILE = """prof as (select PULocationID, DOLocationID, avg(trip_distance) as d, avg(trip_duration) as m, avg(fare_amount) as f, count(*) as n from folded group by 1, 2)"""


@query(
    "route_profile",
    sql(
        f"""with {_PROFILE} select PULocationID, DOLocationID, {r('d', 'typical_distance')}, {r('m', 'typical_duration')}, {r('f', 'typical_fare')}, n as route_popularity,
{r('d / (m / 60)', 'route_efficiency')} from prof""",
        "folded",
    ),
)
def route_profile(spark, sf):
    return tidy(location.route_profile(inputs.folded(spark, sf)))


@query(
    "route_profile_prior",
    sql(
        f"""with w as (select *, count(*) over o as n, sum(trip_distance) over o as d, sum(trip_duration) over o as m, sum(fare_amount) over o as f from folded
  window o as (partition by PULocationID, DOLocationID order by tpep_pickup_datetime range between unbounded preceding and interval 1 second preceding))
select {KEYS}, n as prior_trips, {r('d / nullif(n, 0)', 'prior_distance')}, {r('m / nullif(n, 0)', 'prior_duration')}, {r('f / nullif(n, 0)', 'prior_fare')} from w""",
        "folded",
    ),
)
def route_profile_prior(spark, sf):
    return tidy(location.route_profile_prior(inputs.folded(spark, sf)).select(*KEY, "prior_trips", "prior_distance", "prior_duration", "prior_fare"))


@query(
    "route_ratios",
    sql(
        f"""with {_PROFILE} select {KEYS}, {r('trip_distance / d', 'distance_ratio')}, {r('trip_duration / m', 'duration_ratio')} from folded t
join prof p on p.PULocationID = t.PULocationID and p.DOLocationID = t.DOLocationID""",
        "folded",
    ),
)
def route_ratios(spark, sf):
    trips = inputs.folded(spark, sf)
    return tidy(location.route_ratios(trips, location.route_profile(trips)).select(*KEY, "distance_ratio", "duration_ratio"))


@query(
    "zone_popularity",
    sql(
        f"""with c as (select 'pickup' as trip_end, PULocationID as zone_id, count(*) as trips from clean group by 2 union all select 'dropoff', DOLocationID, count(*) from clean group by 2),
q as (select trip_end, quantile_cont(trips, 0.75) as cut from c group by 1)
select c.trip_end, zone_id, trips, {i('trips >= cut', 'is_popular')} from c join q on q.trip_end = c.trip_end""",
        "clean",
    ),
)
def zone_popularity(spark, sf):
    return location.zone_popularity(inputs.clean(spark, sf))
