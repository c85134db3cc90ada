"""Queries: scoring of request batches, and the streaming jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from faremill.functions.calendar import cyclical_encoding, night_and_rush_parts
from faremill.operators import location, models, scoring
from faremill.operators.features import base_interactions
from faremill.operators.quality import clean_trips
from faremill.plans import inputs
from faremill.plans.modelling import COUNTED, MODEL_COLUMNS, binned, model_data, train_rows
from faremill.plans.inputs import tidy
from faremill.plans.registry import query
from faremill.plans.places import INSIDE, NEAREST
from faremill.plans.sql import errors_of, haversine, i, r, sql
from faremill.session import fresh_path, path_exists, shared_dir, table_stamp
from faremill.sources import views
from faremill.sources.views import KEY
from faremill.streaming import jobs

_SCORED = f"""f as (select request_id, least(greatest(estimated_distance, 0.1), 50)::double as d, hour(q.pickup_datetime) as h, PULocationID between 100 and 170 as mh,
  PULocationID in (132, 138) or DOLocationID in (132, 138) as ap, case when is_snowing = 1 then precipitation * 25.4::double else 0 end as snow, coalesce(precipitation, 0) * 25.4::double as rain, coalesce(is_raining, 0) as wet, coalesce(is_snowing, 0) as white,
  coalesce(is_raining, 0) + 2 * coalesce(is_snowing, 0) as sev from requests q left join wflags w on w.datetime = date_trunc('hour', q.pickup_datetime)),
g as (select *, h in (7,8,9,17,18,19) as rush, (h >= 23 or h < 4) as late, d / 25 * 60 as pred from f),
v0 as (select *, least(60, case when white = 1 and snow > 8 then 25 when white = 1 and snow > 5 then 30 when white = 1 and snow > 2 then 40 else 60 end,
  case when wet = 1 and rain > 7 then 35 when wet = 1 and rain > 4 then 45 else 60 end,
  case when rush then least(case when mh then 20 else 30 end, case when ap then 25 else 60 end, case when sev >= 2 then 18 else 60 end) else 60 end) as c from g),
v as (select *, (case when late and not rush and sev < 2 then greatest(c, 50) else c end)::double as mph from v0),
k as (select *, case when pred < d / mph * 60 then d / mph * 60 when pred > d / 8 * 60 then d / 8 * 60 when d > 15 and not late then least(pred * 1.3, d / 8 * 60) else pred * 1.1 end as cal,
  case when pred < d / mph * 60 then 'Low (calibrated up)' when pred > d / 8 * 60 then 'Low (calibrated down)' when d > 15 and not late then 'Medium (long trip buffer)' else 'High (model reliable)' end as confidence from v),
s as (select request_id, {r('greatest(cal, 1)', 'duration_minutes')}, {r('greatest((2.5 + d * 2.5 + cal * 0.5) * (case when wet = 1 or white = 1 then 1.1 else 1 end), 2.5)', 'fare_usd')}, mph as speed_limit_mph, confidence from k)"""

_SCORE_SQL = sql(f"with {_SCORED} select * from s", "requests", "wflags")


def _shown(scored: DataFrame) -> DataFrame:
    """Unrounded outputs under the served names, for an exact comparison."""
    return scored.select(
        "request_id", F.col("served_duration").alias("duration_minutes"), F.col("served_fare").alias("fare_usd"), F.col("speed_limit").alias("speed_limit_mph"), "confidence"
    )


@query("rule_score", _SCORE_SQL)
def rule_score(spark, sf):
    ready = scoring.request_features(views.requests(spark, sf), inputs.hours(spark, sf), inputs.calendar(spark))
    return tidy(_shown(scoring.rule_scores(ready)))


def stored_models(spark, sf) -> dict[str, str]:
    """Where the trees of both targets are written. They are fitted the first time a state of the trip table is met, and found from then on."""
    stamp = table_stamp(spark, f"{sf}/lineitem.parquet", models.STORED_FORMAT, *MODEL_COLUMNS)
    folder = f"{shared_dir(spark).rstrip('/')}/faremill/models-{stamp}"
    paths = {t: f"{folder}/{t}" for t in COUNTED}
    missing = [t for t, path in paths.items() if not path_exists(spark, f"{path}/card/_SUCCESS")]
    if missing:
        train = binned(train_rows(model_data(spark, sf)))
        for t in missing:
            name, unit = COUNTED[t]
            models.save_model(models.fit_tree(train, MODEL_COLUMNS, name), MODEL_COLUMNS, name, unit, paths[t])
    return paths


def _request_rows(spark, sf) -> DataFrame:
    """Requests with coordinates, by zone, distance, weather and calendar: the models' inputs, and the distance they get."""
    requests = views.requests(spark, sf).drop("pickup_hour").withColumns({"lat": F.col("pickup_latitude"), "lon": F.col("pickup_longitude")})
    resolved = location.resolve_zone(requests, views.zone_rings(spark), views.zones(spark))
    placed = resolved.withColumn("PULocationID", F.col("zone_id")).drop("zone_id", "lat", "lon")
    measured = location.centroid_distance(placed, views.zones(spark))
    chosen = F.coalesce(F.nullif("estimated_distance", F.lit(0.0)), F.col("centroid_distance"))
    full = scoring.request_features(measured.withColumn("estimated_distance", chosen), inputs.hours(spark, sf), inputs.calendar(spark))
    full = full.withColumns(base_interactions()).withColumns({**cyclical_encoding(), **night_and_rush_parts()})
    return models.ready(full, MODEL_COLUMNS).select("request_id", "used_fallback", *MODEL_COLUMNS)


def _batch(spark, sf) -> DataFrame:
    rows = _request_rows(spark, sf)
    for t, path in stored_models(spark, sf).items():
        rows = models.load_model(spark, path).score(rows, {"trip_duration": "duration_minutes", "fare_amount": "fare_usd"}[t])
    return rows


@query("batch_score")
def batch_score(spark, sf):
    """Requests with coordinates scored by stored models: zone, distance, weather, features, loaded trees, rounded outputs."""
    rows = _batch(spark, sf)
    return rows.select("request_id", F.col("PULocationID").cast("int"), F.col("DOLocationID").cast("int"), F.round("duration_minutes", 2).alias("duration_minutes"), F.round("fare_usd", 2).alias("fare_usd"))


_PLACED = f"""z1 as (select event_id, coalesce(zone_id, nearest_zone_id) as zone_id, zone_id is null as lost from inside join near using (event_id)),
b as (select q.request_id, z1.zone_id, z1.lost, q.DOLocationID, least(greatest(coalesce(nullif(q.estimated_distance, 0), case when a.LocationID is null or e.LocationID is null then 0 else {haversine('a.lat', 'a.lon', 'e.lat', 'e.lon')} end), 0.1), 50) as d
  from requests q join z1 on z1.event_id = q.request_id left join zones a on a.LocationID = z1.zone_id left join zones e on e.LocationID = q.DOLocationID)"""


@query(
    "batch_limits",
    sql(
        f"with {INSIDE}, {NEAREST}, {_PLACED} select request_id, zone_id::int as PULocationID, DOLocationID, {r('d', 'estimated_distance')}, {i('lost', 'used_fallback')}, true as duration_in_limits, true as fare_in_limits from b",
        "points", "zones", "requests",
    ),
)
def batch_limits(spark, sf):
    """Zone, distance and fallback of each scored request, and whether both predictions lie in the limits the training trips kept."""
    rows = _batch(spark, sf)
    return tidy(
        rows.select(
            "request_id", *[F.col(c).cast("int").alias(c) for c in ("PULocationID", "DOLocationID")], "estimated_distance", "used_fallback",
            F.col("duration_minutes").between(1, 180).alias("duration_in_limits"), F.col("fare_usd").between(2.5, 250).alias("fare_in_limits"),
        )
    )


@query("stream_score", _SCORE_SQL)
def stream_score(spark, sf):
    """The same rules on a feed of requests, read as a stream and collected in a table."""
    schema = views.table(spark, sf, "events").schema
    feed = views.events_to_requests(jobs.file_feed(spark, sf, schema, "events.parquet")).drop("pickup_hour")
    scored = _shown(jobs.score_stream(feed, inputs.hours(spark, sf), inputs.calendar(spark)))
    path = fresh_path(spark, "scored-requests")
    jobs.run_to_table(scored, path, fresh_path(spark, "scored-requests-state")).awaitTermination()
    return tidy(spark.read.schema(scored.schema).parquet(path))


@query("stream_score_refreshed", _SCORE_SQL)
def stream_score_refreshed(spark, sf):
    """The feed scored batch by batch against a weather table that is read anew for each: first a stale delivery, then the readings."""
    weather = fresh_path(spark, "weather-deliveries")
    hours = inputs.hours(spark, sf)
    jobs.deliver_weather(hours.withColumns({"precipitation": F.lit(0.0), "is_raining": F.lit(0), "is_snowing": F.lit(0)}), weather, 1)
    jobs.deliver_weather(hours, weather, 2)
    feed = views.events_to_requests(jobs.file_feed(spark, sf, views.table(spark, sf, "events").schema, "events.parquet")).drop("pickup_hour")
    path = fresh_path(spark, "scored-refreshed")
    jobs.score_refreshing(feed, weather, inputs.calendar(spark), path, fresh_path(spark, "scored-refreshed-state")).awaitTermination()
    return tidy(_shown(jobs.scored_batches(spark, path)))


@query(
    "stream_monitor",
    sql(
        f"""with {errors_of('scored_duration')}, w as (select time_bucket(interval '7 days', tpep_pickup_datetime, timestamp '1970-01-01') as week_start, count(*) as n, avg(abs_error) as mae,
  1 - sum(squared_error) / (var_pop(y_true) * count(*)) as r2 from err group by 1)
select week_start, n, {r('mae', 'mae')}, {r('r2', 'r2')}, {i('r2 < 0.8 or mae > 3', 'alert')} from w where week_start + interval 7 day <= (select max(tpep_pickup_datetime) from clean) - interval 1 day""",
        "scored_duration",
    ),
)
def stream_monitor(spark, sf):
    """Weekly error windows over a feed of finished trips; only closed windows are reported."""
    schema = views.table(spark, sf, "lineitem").schema
    trips = clean_trips(views.lines_to_trips(jobs.file_feed(spark, sf, schema, "lineitem.parquet")), KEY)
    means = inputs.zone_means(inputs.clean(spark, sf))
    scored = trips.join(means, "PULocationID").withColumn("y_true", F.col("trip_duration"))
    weeks = jobs.monitor_stream(scored, "tpep_pickup_datetime")
    path = fresh_path(spark, "weeks")
    jobs.run_to_table(weeks, path, fresh_path(spark, "weeks-state")).awaitTermination()
    return tidy(spark.read.schema(weeks.schema).parquet(path))
