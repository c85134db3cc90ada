"""Distribution profiles, periodic reports and rankings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from faremill.functions.basics import flag, share
from faremill.functions.calendar import season_of
from faremill.operators.correlations import correlation_pairs, correlations_long
from faremill.operators.quality import is_kept, with_duration
from faremill.operators.quantiles import attach_row, exact_quantiles, quantile_name, quantile_row


def monthly_quality_report(raw: DataFrame) -> DataFrame:
    """Raw and kept trips per month with means over the kept ones, and a total row.

    One pass over the raw trips: a kept trip is a flag, not a second scan. The total's removed share
    is the unweighted mean of the months.
    """
    marked = with_duration(raw).select(
        F.date_format("tpep_pickup_datetime", "yyyy-MM").alias("month"), is_kept().alias("ok"), "fare_amount", "trip_duration", "trip_distance"
    )
    months = marked.groupBy("month").agg(
        F.count("*").alias("raw_count"), F.count_if("ok").alias("clean_count"),
        *[F.avg(F.when(F.col("ok"), F.col(c))).alias(f"avg_{n}") for n, c in (("fare", "fare_amount"), ("duration", "trip_duration"), ("distance", "trip_distance"))],
    ).withColumn("removed_count", F.col("raw_count") - F.col("clean_count")).withColumn("removed_pct", share(F.col("removed_count"), F.col("raw_count")))
    columns = ["month", "raw_count", "clean_count", "removed_count", "removed_pct", "avg_fare", "avg_duration", "avg_distance"]
    return months.rollup("month").agg(
        F.sum("raw_count").alias("raw_count"), F.sum("clean_count").alias("clean_count"), F.sum("removed_count").alias("removed_count"),
        F.avg("removed_pct").alias("removed_pct"), *[F.avg(c).alias(c) for c in columns[5:]],
    ).select(F.coalesce("month", F.lit("TOTAL")).alias("month"), *columns[1:])


def seasonal_rollup(report: DataFrame) -> DataFrame:
    """Trips per season and the mean of the monthly means."""
    months = report.where("month <> 'TOTAL'").withColumn("m", F.split("month", "-")[1].cast("int"))
    return months.groupBy(season_of("m").alias("season")).agg(
        F.sum("clean_count").alias("trips"), *[F.avg(c).alias(c) for c in ("avg_fare", "avg_duration", "avg_distance")]
    )


# The statistics wanted per column in the month summary.
MONTHLY_STATS = {
    "trip_duration": ("mean", "median", "std", "min", "max"),
    "fare_amount": ("mean", "median", "std"),
    "estimated_distance": ("mean", "median"),
    "passenger_count": ("mean", "median"),
    "temperature": ("mean", "min", "max"),
    "is_raining": ("mean",),
    "is_snowing": ("mean",),
    "is_rush_hour": ("mean",),
    "is_weekend": ("mean",),
}


def monthly_summary(features: DataFrame, stats: dict[str, tuple[str, ...]] = MONTHLY_STATS) -> DataFrame:
    """Several statistics per column and month."""
    simple = {"mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    plain = features.groupBy("pickup_month").agg(*[simple[s](c).alias(f"{c}_{s}") for c, names in stats.items() for s in names if s in simple])
    medians = [c for c, names in stats.items() if "median" in names]
    middle = quantile_row(features, medians, [0.5], by=("pickup_month",))
    renamed = middle.select("pickup_month", *[F.col(quantile_name(c, 0.5)).alias(f"{c}_median") for c in medians])
    return plain.join(renamed, "pickup_month").select("pickup_month", *[f"{c}_{s}" for c, names in stats.items() for s in names])


def hourly_volume(trips: DataFrame) -> DataFrame:
    """Trips per hour with share, peak flag (third quartile of the hours) and busiest/quietest marks; 24 rows reach the windows."""
    hours = trips.groupBy("pickup_hour").agg(F.count("*").alias("trips"))
    everything = Window.partitionBy()
    busy = Window.orderBy(F.desc("trips"), "pickup_hour")
    quiet = Window.orderBy("trips", "pickup_hour")
    return hours.select(
        "pickup_hour", "trips", share(F.col("trips"), F.sum("trips").over(everything)).alias("pct"),
        flag(F.col("trips") >= F.percentile("trips", F.lit(0.75)).over(everything)).alias("is_peak"),
        flag(F.row_number().over(busy) == 1).alias("is_busiest"), flag(F.row_number().over(quiet) == 1).alias("is_quietest"),
    )


DAY_NAMES = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")


def day_name(weekday: Column) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in DAY_NAMES]), (weekday + 1).cast("int"))


def weekday_profile(trips: DataFrame) -> DataFrame:
    days = trips.groupBy("pickup_weekday").agg(F.count("*").alias("trips"), F.avg("fare_amount").alias("avg_fare"))
    return days.select(
        "pickup_weekday", day_name(F.col("pickup_weekday")).alias("day_name"), "trips",
        share(F.col("trips"), F.sum("trips").over(Window.partitionBy())).alias("pct"), "avg_fare",
    )


def weekend_vs_weekday(trips: DataFrame) -> DataFrame:
    """Means per day kind, each also as a percentage of the larger one."""
    names = {"avg_fare": "fare_amount", "avg_distance": "trip_distance", "avg_duration": "trip_duration"}
    kinds = trips.groupBy("is_weekend").agg(F.count("*").alias("trips"), *[F.avg(c).alias(n) for n, c in names.items()])
    both = Window.partitionBy()
    return kinds.select(
        F.when(F.col("is_weekend") == 1, "Weekend").otherwise("Weekday").alias("day_kind"), "trips",
        share(F.col("trips"), F.sum("trips").over(both)).alias("pct"), *names,
        *[share(F.col(n), F.max(n).over(both)).alias(f"{n}_pct_of_max") for n in names],
    )


def hourly_fare_duration(trips: DataFrame) -> DataFrame:
    return trips.groupBy("pickup_hour").agg(F.avg("fare_amount").alias("avg_fare"), F.avg("trip_duration").alias("avg_duration"))


def describe_columns(df: DataFrame, columns: list[str], probs=(0.25, 0.5, 0.75, 0.9, 0.95, 0.99)) -> DataFrame:
    """Count, mean, deviation, extremes and exact percentiles, one row per column."""
    one = df.agg(*[f(c).alias(f"{c}~{n}") for c in columns for n, f in (("count", F.count), ("mean", F.avg), ("std", F.stddev_samp), ("min", F.min), ("max", F.max))])
    plain = one.select(
        F.inline(
            F.array(*[F.struct(F.lit(c).alias("metric"), *[F.col(f"`{c}~{n}`").cast("double" if n != "count" else "bigint").alias(n) for n in ("count", "mean", "std", "min", "max")]) for c in columns])
        )
    )
    levels = exact_quantiles(df, columns, list(probs)).groupBy("metric").agg(
        *[F.max(F.when(F.col("p") == F.lit(float(p)), F.col("value"))).alias(f"p{round(p * 100)}") for p in probs]
    )
    return plain.join(levels, "metric", "left")


def histogram(df: DataFrame, value: Column, bins: int = 100) -> DataFrame:
    """Equal-width bins from minimum to maximum, the last one closed; empty bins are listed."""
    values = df.select(value.cast("double").alias("x")).where("x is not null and not isnan(x)")
    span = values.agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    place = F.floor((F.col("x") - F.col("s.lo")) / (F.col("s.hi") - F.col("s.lo")) * bins)
    counts = (
        attach_row(values, span, "s")
        .groupBy(F.when(F.col("s.hi") > F.col("s.lo"), F.least(place, F.lit(bins - 1))).otherwise(F.lit(0)).cast("int").alias("bin"))
        .agg(F.count("*").alias("trips"))
    )
    width = (F.col("hi") - F.col("lo")) / bins
    frame = span.select(F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"), F.col("lo"), width.alias("width"))
    return frame.join(counts, "bin", "left").select(
        "bin", (F.col("lo") + F.col("width") * F.col("bin")).alias("lower"), (F.col("lo") + F.col("width") * (F.col("bin") + 1)).alias("upper"),
        F.coalesce("trips", F.lit(0)).alias("trips"),
    )


# Payment codes.
PAYMENT_TYPES = {1: "Credit Card", 2: "Cash", 3: "No Charge", 4: "Dispute", 5: "Unknown", 6: "Voided"}


def payment_label(code: str = "payment_type") -> Column:
    pairs = [F.lit(x) for item in PAYMENT_TYPES.items() for x in item]
    return F.try_element_at(F.create_map(*pairs), F.col(code))


def value_counts(trips: DataFrame) -> DataFrame:
    """Counts of passenger numbers and payment labels; missing values are not counted."""
    facts = F.array(
        F.struct(F.lit("passenger_count").alias("metric"), F.col("passenger_count").cast("int").cast("string").alias("value")),
        F.struct(F.lit("payment_type").alias("metric"), payment_label().alias("value")),
    )
    return trips.select(F.inline(facts)).where("value is not null").groupBy("metric", "value").agg(F.count("*").alias("trips"))


def top_zones(trips: DataFrame, n: int = 10) -> DataFrame:
    """Busiest pickup and dropoff zones; ties go to the lower zone number."""
    ends = F.array(
        F.struct(F.lit("pickup").alias("trip_end"), F.col("PULocationID").alias("zone_id")),
        F.struct(F.lit("dropoff").alias("trip_end"), F.col("DOLocationID").alias("zone_id")),
    )
    counts = trips.select(F.inline(ends)).groupBy("trip_end", "zone_id").agg(F.count("*").alias("trips"))
    order = Window.partitionBy("trip_end").orderBy(F.desc("trips"), "zone_id")
    return counts.withColumn("place", F.row_number().over(order)).where(F.col("place") <= n)


def correlation_matrix(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson correlation of every ordered pair, from one pass."""
    return correlation_pairs(df, columns, columns).select(F.col("a").alias("feature_a"), F.col("b").alias("feature_b"), "r")


def target_correlations(df: DataFrame, columns: list[str], targets: tuple[str, ...]) -> DataFrame:
    """Correlation with each target, ranked, with a strength word."""
    cells = [F.struct(F.lit(t).alias("target"), F.col(f"corr_{t}").alias("r")) for t in targets]
    rows = correlations_long(df, columns, targets).select(F.col("column_name").alias("feature"), F.inline(F.array(*cells)))
    size = F.abs("r")
    return rows.select(
        "target", "feature", "r", F.when(size > 0.5, "Strong").when(size > 0.3, "Moderate").otherwise("Weak").alias("strength"),
        F.row_number().over(Window.partitionBy("target").orderBy(F.desc_nulls_last(F.round("r", 9)), "feature")).alias("place"),
    )


def weather_impact(features: DataFrame) -> DataFrame:
    """Trips and means under clear sky, rain and snow; a trip with both rain and snow counts in both."""
    rain, snow = F.col("is_raining") == 1, F.col("is_snowing") == 1
    labels = F.array_compact(F.array(F.when(~rain & ~snow, F.lit("Clear")), F.when(rain, F.lit("Rain")), F.when(snow, F.lit("Snow"))))
    total = features.agg(F.count("*").alias("n"))
    groups = features.select(F.explode(labels).alias("condition"), "trip_duration", "fare_amount").groupBy("condition").agg(
        F.count("*").alias("trips"), F.avg("trip_duration").alias("avg_duration"), F.avg("fare_amount").alias("avg_fare")
    )
    return attach_row(groups, total, "t").select("condition", "trips", share(F.col("trips"), F.col("t.n")).alias("pct"), "avg_duration", "avg_fare")


def flag_impact(features: DataFrame, flags: tuple[str, ...] = ("is_holiday", "is_rush_hour")) -> DataFrame:
    """Means by each flag's value, both flags in one pass."""
    cells = F.array(*[F.struct(F.lit(name).alias("flag"), F.col(name).alias("flag_value")) for name in flags])
    return features.select(F.inline(cells), "trip_duration", "fare_amount", "estimated_distance").groupBy("flag", "flag_value").agg(
        F.count("*").alias("trips"), F.avg("trip_duration").alias("avg_duration"), F.avg("fare_amount").alias("avg_fare"), F.avg("estimated_distance").alias("avg_distance")
    )


def modal_value(df: DataFrame, column: str) -> DataFrame:
    """Most frequent value, the smallest on a tie."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    return counts.agg(F.min_by(F.col(column), F.struct(-F.col("n"), F.col(column))).alias(column))


def key_findings(trips: DataFrame, checked: list[str]) -> DataFrame:
    """One row of headline facts about raw trips with calendar parts."""
    gaps = sum((F.count_if(F.col(c).isNull()) for c in checked[1:]), F.count_if(F.col(checked[0]).isNull()))
    one = trips.agg(
        F.count("*").alias("trips"), F.min("tpep_pickup_datetime").alias("first_pickup"), F.max("tpep_pickup_datetime").alias("last_pickup"),
        share(gaps, F.count("*") * len(checked)).alias("missing_pct"), F.avg("fare_amount").alias("mean_fare"),
        F.avg("trip_duration").alias("mean_duration"), F.avg("trip_distance").alias("mean_distance"),
        F.count_if(F.col("fare_amount") < 0).alias("negative_fares"), F.count_if(F.col("trip_distance") == 0).alias("zero_distances"),
        F.count_if(F.col("trip_duration") < 0).alias("negative_durations"),
    )
    levels = quantile_row(trips, ["fare_amount", "trip_duration"], [0.05, 0.5, 0.95])
    out = attach_row(one, levels, "q").select(
        "*", F.col("q.fare_amount_p50").alias("median_fare"), F.col("q.trip_duration_p50").alias("median_duration"),
        F.col("q.fare_amount_p5").alias("fare_p5"), F.col("q.fare_amount_p95").alias("fare_p95"),
    ).drop("q")
    named = trips.select("pickup_hour", day_name(F.col("pickup_weekday")).alias("busiest_day"), F.col("passenger_count").cast("int").alias("modal_passengers"), payment_label().alias("modal_payment"))
    return out.withColumns(
        {
            "peak_hour": modal_value(named, "pickup_hour").scalar(), "busiest_day": modal_value(named, "busiest_day").scalar(),
            "modal_passengers": modal_value(named, "modal_passengers").scalar(), "modal_payment": modal_value(named, "modal_payment").scalar(),
        }
    )


def dataset_profile(df: DataFrame, targets: tuple[str, ...]) -> DataFrame:
    """Column names and types with the row count, and statistics of the targets."""
    one = df.agg(F.count("*").alias("n"), *[f(t).alias(f"{t}~{n}") for t in targets for n, f in (("min", F.min), ("max", F.max), ("mean", F.avg), ("std", F.stddev_samp))])
    middle = attach_row(one, quantile_row(df, list(targets), [0.5]), "q")

    def stat(column: str, name: str) -> Column:
        if column not in targets:
            return F.lit(None).cast("double").alias(name)
        return (F.col(f"q.{quantile_name(column, 0.5)}") if name == "median" else F.col(f"`{column}~{name}`")).alias(name)

    rows = [
        F.struct(F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("data_type"), F.col("n").alias("rows"), *[stat(f.name, s) for s in ("min", "max", "mean", "median", "std")])
        for f in df.schema.fields
    ]
    return middle.select(F.inline(F.array(*rows)))
