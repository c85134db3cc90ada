"""Cleaning rules, caps, audits and imputation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from faremill.functions.basics import clip, flag, share
from faremill.functions.calendar import calendar_parts, seconds_between
from faremill.operators.quantiles import attach_row, quantile_name, quantile_row
from faremill.profile import CleaningLimits, LIMITS

CORE = ("fare_amount", "trip_distance", "trip_duration", "passenger_count")

CLEAN_COLUMNS = (
    "tpep_pickup_datetime", "tpep_dropoff_datetime", "PULocationID", "DOLocationID", "trip_distance", "passenger_count",
    "fare_amount", "trip_duration", "pickup_hour", "pickup_day", "pickup_month", "pickup_weekday", "pickup_date",
    "pickup_dayofyear", "pickup_weekofyear", "is_weekend",
)


def with_duration(trips: DataFrame, start: str = "tpep_pickup_datetime", end: str = "tpep_dropoff_datetime") -> DataFrame:
    """Add trip_duration in minutes."""
    return trips.withColumn("trip_duration", seconds_between(start, end).cast("double") / 60.0)


def speed_mph(distance: str = "trip_distance", minutes: str = "trip_duration") -> Column:
    return F.try_divide(F.col(distance), F.col(minutes) / 60.0)


def cleaning_rules(limits: CleaningLimits = LIMITS) -> dict[str, Column]:
    """What a kept trip satisfies, in the order the rules apply; a missing comparison fails."""
    dist, dur = F.col("trip_distance"), F.col("trip_duration")
    present = F.col(CORE[0]).isNotNull()
    for name in CORE[1:]:
        present = present & F.col(name).isNotNull()
    short = dist < limits.short_distance
    return {
        "missing_core": present,
        "no_passengers": F.col("passenger_count") > 0,
        "fare": F.col("fare_amount").between(*limits.fare),
        "distance": dist.between(*limits.distance),
        "duration": dur.between(*limits.duration),
        "passengers": F.col("passenger_count").between(*limits.passengers),
        "zero_distance_long": ~(short & (dur > limits.long_wait_minutes)),
        "speed": speed_mph() <= limits.max_speed,
        "same_zone_short": ~((F.col("PULocationID") == F.col("DOLocationID")) & short),
    }


def keep(trips: DataFrame, *names: str, limits: CleaningLimits = LIMITS) -> DataFrame:
    """Apply the named cleaning rules only; plain comparisons, so they reach the Parquet scan."""
    rules = cleaning_rules(limits)
    for name in names:
        trips = trips.where(rules[name])
    return trips


def deciding_rules(limits: CleaningLimits = LIMITS) -> list[str]:
    """The rules that can still remove a trip once the others have run.

    A range comparison already drops missing values; a passenger range above zero covers the
    passenger rule; and no short trip is left to the two short-distance rules when the distance
    range starts at or above the short distance.
    """
    implied = {"missing_core"}
    if limits.passengers[0] > 0:
        implied.add("no_passengers")
    if limits.distance[0] >= limits.short_distance:
        implied |= {"zero_distance_long", "same_zone_short"}
    return [name for name in cleaning_rules(limits) if name not in implied]


def is_kept(limits: CleaningLimits = LIMITS) -> Column:
    """True for a trip that every cleaning rule keeps, false for any other."""
    rules = cleaning_rules(limits)
    ok = F.lit(True)
    for name in deciding_rules(limits):
        ok = ok & rules[name]
    return F.coalesce(ok, F.lit(False))


def clean_trips(raw: DataFrame, key: list[str], limits: CleaningLimits = LIMITS) -> DataFrame:
    """All cleaning rules, calendar parts and the keep-list, in one narrow pass."""
    kept = keep(with_duration(raw), *deciding_rules(limits), limits=limits)
    return (
        kept.withColumns({**calendar_parts(), "pickup_date": F.to_date("tpep_pickup_datetime")})
        .withColumn("is_weekend", flag(F.col("pickup_weekday") >= 5))
        .select(*key, *CLEAN_COLUMNS)
    )


def rejection_waterfall(raw: DataFrame, limits: CleaningLimits = LIMITS) -> DataFrame:
    """Trips per first failing rule, with their share of all trips."""
    reason = F
    for name, rule in cleaning_rules(limits).items():
        reason = reason.when(~F.coalesce(rule, F.lit(False)), name)
    total = with_duration(raw).agg(F.count("*").alias("n"))
    counts = with_duration(raw).groupBy(reason.otherwise("kept").alias("reason")).agg(F.count("*").alias("trips"))
    return attach_row(counts, total, "all").select("reason", "trips", share(F.col("trips"), F.col("all.n")).alias("pct"))


def caps(trips: DataFrame, duration: str = "trip_duration", distance: str = "estimated_distance", duration_p: float = 0.95, distance_p: float = 0.99) -> DataFrame:
    """One row with the duration and distance cap."""
    row = quantile_row(trips, [duration, distance], [duration_p, distance_p])
    return row.select(
        F.col(quantile_name(duration, duration_p)).alias("duration_cap"), F.col(quantile_name(distance, distance_p)).alias("distance_cap")
    )


def outlier_caps(trips: DataFrame, duration: str = "trip_duration", distance: str = "estimated_distance") -> DataFrame:
    """Caps with the number and share of trips above them."""
    above = attach_row(trips.select(duration, distance), caps(trips, duration, distance), "cap")
    return above.agg(
        F.max("cap.duration_cap").alias("duration_cap"),
        F.max("cap.distance_cap").alias("distance_cap"),
        F.count_if(F.col(duration) > F.col("cap.duration_cap")).alias("duration_above"),
        F.count_if(F.col(distance) > F.col("cap.distance_cap")).alias("distance_above"),
        F.count("*").alias("trips"),
    )


def percentile_exceedance(trips: DataFrame, columns: list[str], probs: list[float]) -> DataFrame:
    """Each percentile with the number and share of trips strictly above it."""
    levels = quantile_row(trips, columns, probs)
    marked = attach_row(trips.select(*columns), levels, "q")
    cells = [(c, p, quantile_name(c, p)) for c in columns for p in probs]
    one = marked.agg(
        F.count("*").alias("n"),
        *[F.max(F.col(f"q.{name}")).alias(name) for _, _, name in cells],
        *[F.count_if(F.col(c) > F.col(f"q.{name}")).alias(f"{name}_above") for c, _, name in cells],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("metric"), F.lit(p * 100.0).alias("percentile"), F.col(name).alias("value"),
                F.col(f"{name}_above").alias("trips_above"), share(F.col(f"{name}_above"), F.col("n")).alias("pct_above"),
            )
            for c, p, name in cells
        ]
    )
    return one.select(F.inline(rows))


def apply_caps(features: DataFrame, cap_row: DataFrame) -> DataFrame:
    """Lower duration and distance to their caps and recompute what is built on the distance."""
    distance = F.least("estimated_distance", F.col("cap.distance_cap"))
    return (
        attach_row(features, cap_row, "cap")
        .withColumns({"estimated_distance": distance, "trip_duration": F.least("trip_duration", F.col("cap.duration_cap"))})
        .withColumns(
            {
                "distance_hour_interaction": F.col("estimated_distance") * F.col("pickup_hour"),
                "distance_rushhour_interaction": F.col("estimated_distance") * F.col("is_rush_hour"),
                "snow_distance_interaction": F.col("is_snowing") * F.col("estimated_distance"),
                "rain_distance_interaction": F.col("is_raining") * F.col("estimated_distance"),
            }
        )
        .drop("cap")
    )


def cap_report(trips: DataFrame, cap_row: DataFrame) -> DataFrame:
    """Trips and capped values per split and month, with split totals and a grand total."""
    marked = attach_row(trips, cap_row, "cap")
    return (
        marked.rollup("split", "pickup_month")
        .agg(
            F.count("*").alias("trips"),
            F.count_if(F.col("trip_duration") > F.col("cap.duration_cap")).alias("duration_capped"),
            F.count_if(F.col("estimated_distance") > F.col("cap.distance_cap")).alias("distance_capped"),
        )
        .select(
            F.coalesce("split", F.lit("ALL")).alias("split"), F.coalesce("pickup_month", F.lit(0)).alias("pickup_month"),
            "trips", "duration_capped", "distance_capped",
        )
    )


def cap_target(trips: DataFrame, targets: list[str], p: float = 0.995) -> DataFrame:
    """Targets held between zero and their own high percentile."""
    levels = quantile_row(trips, targets, [p])
    marked = attach_row(trips, levels, "q")
    return marked.withColumns(
        {f"{t}_capped": F.least(F.greatest(F.col(t), F.lit(0.0)), F.col(f"q.{quantile_name(t, p)}")) for t in targets}
    ).drop("q")


def iqr_outliers(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows outside 1.5 interquartile ranges, per column."""
    levels = attach_row(df.select(*columns), quantile_row(df, columns, [0.25, 0.75]), "q")

    def fence(c: str, side: int) -> Column:
        low, high = F.col(f"q.{c}_p25"), F.col(f"q.{c}_p75")
        return low - (high - low) * 1.5 if side < 0 else high + (high - low) * 1.5

    one = levels.agg(
        F.count("*").alias("n"),
        *[F.max(fence(c, -1)).alias(f"{c}_low") for c in columns],
        *[F.max(fence(c, 1)).alias(f"{c}_high") for c in columns],
        *[F.count_if((F.col(c) < fence(c, -1)) | (F.col(c) > fence(c, 1))).alias(f"{c}_n") for c in columns],
        *[F.min(F.when((F.col(c) < fence(c, -1)) | (F.col(c) > fence(c, 1)), F.col(c))).alias(f"{c}_min") for c in columns],
        *[F.max(F.when((F.col(c) < fence(c, -1)) | (F.col(c) > fence(c, 1)), F.col(c))).alias(f"{c}_max") for c in columns],
    )
    return one.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(c).alias("metric"), F.col(f"{c}_low").alias("lower_bound"), F.col(f"{c}_high").alias("upper_bound"),
                        F.col(f"{c}_n").alias("outliers"), share(F.col(f"{c}_n"), F.col("n")).alias("pct"),
                        F.col(f"{c}_min").alias("min_outlier"), F.col(f"{c}_max").alias("max_outlier"),
                    )
                    for c in columns
                ]
            )
        )
    )


def missing_profile(df: DataFrame) -> DataFrame:
    """Missing values per column, columns without any left out."""
    one = df.agg(F.count("*").alias("n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("missing"), share(F.col(c), F.col("n")).alias("pct")) for c in df.columns])
    return one.select(F.inline(rows)).where("missing > 0").orderBy(F.desc("missing"), "column_name")


def duplicate_rows(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Repeats beyond the first copy, over the given columns or all of them."""
    groups = df.groupBy(*(columns or df.columns)).agg(F.count("*").alias("copies"))
    total = groups.agg(F.sum("copies").alias("rows"), F.sum(F.col("copies") - 1).alias("duplicates"))
    return total.select("rows", "duplicates", share(F.col("duplicates"), F.col("rows")).alias("pct"))


def sign_audit(df: DataFrame, columns: list[str]) -> DataFrame:
    one = df.agg(*[F.count_if(F.col(c) < 0).alias(f"{c}_neg") for c in columns], *[F.count_if(F.col(c) == 0).alias(f"{c}_zero") for c in columns])
    return one.select(
        F.inline(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(f"{c}_neg").alias("negative"), F.col(f"{c}_zero").alias("zero")) for c in columns]))
    )


def to_number(text: str) -> Column:
    """Text as a double; anything unreadable, and NaN, is missing."""
    return F.nanvl(F.col(text).try_cast("double"), F.lit(None).cast("double"))


def finite_or_zero(value: Column) -> Column:
    infinite = F.abs(value) == F.lit(float("inf"))
    return F.when(value.isNull() | F.isnan(value) | infinite, F.lit(0.0)).otherwise(value)


def impute_median(df: DataFrame, columns: list[str]) -> DataFrame:
    """Fill missing values with the column median."""
    marked = attach_row(df, quantile_row(df, columns, [0.5]), "q")
    return marked.withColumns({c: F.coalesce(F.col(c), F.col(f"q.{quantile_name(c, 0.5)}")) for c in columns}).drop("q")


def impute_mean(df: DataFrame, columns: list[str]) -> DataFrame:
    """Fill missing values with the column mean."""
    marked = attach_row(df, df.agg(*[F.avg(c).alias(c) for c in columns]), "q")
    return marked.withColumns({c: F.coalesce(F.col(c), F.col(f"q.{c}")) for c in columns}).drop("q")


