"""Feature importance tables from any (feature, importance) scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from faremill.functions.basics import share
from faremill.operators.correlations import correlations_long

# Name parts per category; the first category with a hit wins.
CATEGORIES = (
    ("Temporal", ("hour", "day", "month", "weekend", "rush", "night", "holiday")),
    ("Trip Metrics", ("distance", "duration", "route", "typical", "actual", "ratio", "efficiency")),
    ("Geographic", ("airport", "manhattan", "borough", "location", "popular", "cross")),
    ("Interactions", ("interaction", "_x_", "combined")),
    ("Cyclical", ("sin", "cos")),
)


def correlation_scores(df: DataFrame, columns: list[str], targets: tuple[str, ...]) -> DataFrame:
    """(target, feature, importance): absolute correlation with each target over all rows, in one pass."""
    rows = correlations_long(df, columns, targets)
    cells = [F.struct(F.lit(t).alias("target"), F.coalesce(F.abs(F.round(f"corr_{t}", 9)), F.lit(0.0)).alias("importance")) for t in targets]
    return rows.select(F.col("column_name").alias("feature"), F.inline(F.array(*cells)))


def importance_table(scores: DataFrame) -> DataFrame:
    """Percentage, rank, cumulative percentage and size class per target; one row per feature reaches the windows."""
    order = Window.partitionBy("target").orderBy(F.desc("importance"), "feature")
    pct = share(F.col("importance"), F.sum("importance").over(Window.partitionBy("target")))
    p = F.col("importance_pct")
    return (
        scores.withColumn("importance_pct", pct)
        .withColumns(
            {
                "place": F.row_number().over(order),
                "cumulative_pct": F.sum("importance_pct").over(order.rowsBetween(Window.unboundedPreceding, 0)),
                "size_class": F.when((p > 0) & (p <= 0.1), "<0.1%").when((p > 0.1) & (p <= 0.5), "0.1-0.5%").when((p > 0.5) & (p <= 1), "0.5-1%")
                .when((p > 1) & (p <= 5), "1-5%").when((p > 5) & (p <= 100), ">5%"),
            }
        )
    )


def importance_counts(table: DataFrame) -> DataFrame:
    """How many features matter: at least 1 %, below 0.5 %, and within the first 80 and 90 %."""
    return table.groupBy("target").agg(
        F.count("*").alias("features"), F.count_if(F.col("importance_pct") >= 1).alias("at_least_1_pct"), F.count_if(F.col("importance_pct") < 0.5).alias("below_half_pct"),
        F.count_if(F.col("cumulative_pct") <= 80).alias("within_80_pct"), F.count_if(F.col("cumulative_pct") <= 90).alias("within_90_pct"),
        F.sum(F.when(F.col("place") <= 5, F.col("importance_pct"))).alias("top5_pct"), F.sum(F.when(F.col("place") <= 10, F.col("importance_pct"))).alias("top10_pct"),
    )


def category_of(feature: str = "feature") -> Column:
    name = F.lower(feature)
    out = F
    for category, parts in CATEGORIES:
        hit = F.lit(False)
        for part in parts:
            hit = hit | F.contains(name, F.lit(part))
        out = out.when(hit, category)
    return out.otherwise("Other")


def by_category(table: DataFrame) -> DataFrame:
    """Sum, mean and count per category, and its three strongest features."""
    marked = table.withColumn("category", category_of())
    best = Window.partitionBy("target", "category").orderBy("place")
    return (
        marked.withColumn("inner_place", F.row_number().over(best))
        .groupBy("target", "category")
        .agg(
            F.sum("importance_pct").alias("total_pct"), F.avg("importance_pct").alias("avg_pct"), F.count("*").alias("features"),
            *[F.max(F.when(F.col("inner_place") == i, F.col("feature"))).alias(f"top_{i}") for i in (1, 2, 3)],
        )
    )


def compare(table: DataFrame, first: str, second: str, top: int = 10) -> DataFrame:
    """Two rankings side by side; a feature missing from one counts as zero there."""
    a = table.where(F.col("target") == first).select("feature", F.col("importance_pct").alias("first_pct"), F.col("place").alias("first_place"))
    b = table.where(F.col("target") == second).select("feature", F.col("importance_pct").alias("second_pct"), F.col("place").alias("second_place"))
    both = a.join(b, "feature", "full").na.fill(0.0, ["first_pct", "second_pct"])
    shared = a.where(F.col("first_place") <= top).select("feature").intersect(b.where(F.col("second_place") <= top).select("feature"))
    return (
        both.join(shared.withColumn("in_both_top", F.lit(1)), "feature", "left")
        .select(
            "feature", "first_pct", "second_pct", ((F.col("first_pct") + F.col("second_pct")) / 2.0).alias("avg_pct"),
            F.abs(F.col("first_pct") - F.col("second_pct")).alias("diff_pct"), F.coalesce("in_both_top", F.lit(0)).alias("in_both_top"),
        )
        .withColumn("overlap", F.sum("in_both_top").over(Window.partitionBy()))
    )
