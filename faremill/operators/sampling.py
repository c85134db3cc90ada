"""Splits, samples and folds that give the same answer on every run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from faremill.functions.basics import key_hash
from faremill.operators.quantiles import attach_row


def month_split(month: str = "pickup_month", validation: int = 11, test: int = 12) -> Column:
    m = F.col(month)
    return F.when(m < validation, "train").when(m < test, "val").otherwise("test")


def split_counts(trips: DataFrame) -> DataFrame:
    return trips.groupBy("split").agg(F.count("*").alias("trips"), F.min("pickup_month").alias("first_month"), F.max("pickup_month").alias("last_month"))


def hash_split(key: list[str], test_share: int = 20) -> Column:
    """Train or test by an arithmetic hash of the key."""
    return F.when(key_hash(key, 100) < test_share, "test").otherwise("train")


def random_split(trips: DataFrame, test_share: float = 0.2, seed: int = 42) -> list[DataFrame]:
    """Spark's own seeded split."""
    return trips.randomSplit([1 - test_share, test_share], seed)


def sample_per_group(df: DataFrame, group: str, n: int, hash_key: list[str], ties: list[str], slices: int = 64) -> DataFrame:
    """At most n rows per group, those with the lowest hash.

    Each group is first cut into slices and reduced to n rows per slice, so a group that holds a
    large part of all rows is never sorted in one task.
    """
    order = ["sample_hash", *ties]
    sliced = df.withColumns({"sample_hash": key_hash(hash_key, 1_000_003), "slice": key_hash(hash_key[::-1], slices)})
    first = sliced.withColumn("place", F.row_number().over(Window.partitionBy(group, "slice").orderBy(*order))).where(F.col("place") <= n)
    second = first.withColumn("place", F.row_number().over(Window.partitionBy(group).orderBy(*order))).where(F.col("place") <= n)
    return second.drop("sample_hash", "slice", "place")


def sample_n(df: DataFrame, n: int, hash_key: list[str], ties: list[str]) -> DataFrame:
    """The n rows with the lowest hash: a top-n per partition, then of those."""
    return df.withColumn("sample_hash", key_hash(hash_key, 1_000_003)).orderBy("sample_hash", *ties).limit(n).drop("sample_hash")


def kfold_mean_metrics(df: DataFrame, target: str, hash_key: list[str], folds: int = 5) -> DataFrame:
    """R² and RMSE per fold of the mean over the other folds, from one pass of sums per fold."""
    sums = df.groupBy(key_hash(hash_key, folds).alias("fold")).agg(
        F.count("*").alias("n"), F.sum(target).alias("s"), (F.var_pop(target) * F.count("*")).alias("sst"), F.avg(target).alias("mean")
    )
    total = sums.agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    scored = attach_row(sums, total, "t").withColumn("guess", (F.col("t.s") - F.col("s")) / (F.col("t.n") - F.col("n")))
    off = F.col("mean") - F.col("guess")
    return scored.withColumn("sse", F.col("sst") + F.col("n") * off * off).select(
        "fold", "n", (F.lit(1.0) - F.try_divide(F.col("sse"), F.col("sst"))).alias("r2"), F.sqrt(F.col("sse") / F.col("n")).alias("rmse")
    )


def stability(cov: Column) -> Column:
    return F.when(cov < 1, "very stable").when(cov < 3, "stable").when(cov < 5, "moderate").otherwise("high variation")


def kfold_summary(per_fold: DataFrame, metric: str = "rmse") -> DataFrame:
    """Mean R², and mean, population deviation, range and stability of one metric over the folds."""
    return per_fold.agg(
        F.count("*").alias("folds"), F.avg("r2").alias("mean_r2"), F.avg(metric).alias(f"mean_{metric}"), F.stddev_pop(metric).alias(f"std_{metric}"),
        F.min(metric).alias(f"min_{metric}"), F.max(metric).alias(f"max_{metric}"),
    ).withColumn("cov_pct", F.try_divide(F.col(f"std_{metric}"), F.col(f"mean_{metric}")) * 100.0).withColumn("stability", stability(F.col("cov_pct")))


def fold_summary(per_fold: DataFrame, by: str = "target") -> DataFrame:
    """Mean, population deviation, range and stability of the folds' R² per target, with the gap to the rows fitted on."""
    one = per_fold.groupBy(by).agg(
        F.count("*").alias("folds"), F.avg("r2").alias("mean_r2"), F.stddev_pop("r2").alias("std_r2"), F.min("r2").alias("min_r2"), F.max("r2").alias("max_r2"),
        F.avg("rmse").alias("mean_rmse"), F.avg("train_r2").alias("mean_train_r2"),
    )
    spread = F.try_divide(F.col("std_r2"), F.abs("mean_r2")) * 100.0
    return one.withColumns({"cov_pct": spread, "train_gap_pp": (F.col("mean_train_r2") - F.col("mean_r2")) * 100.0}).withColumn("stability", stability(F.col("cov_pct")))
