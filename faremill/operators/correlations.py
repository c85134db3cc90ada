"""Pearson correlations of many column pairs from one pass."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

PAIR_MOMENTS = "a string, b string, n double, mx double, my double, cxx double, cyy double, cxy double, same double, rows double"


def pair_moments(df: DataFrame, left: list[str], right: list[str]) -> DataFrame:
    """Count, means, centred squares and products, and equal values per pair of a left and a right column.

    Each task adds up its Arrow batches as matrix products, less a value near each column's mean so that no digits cancel, and
    emits one row per pair: the shuffle carries pairs times tasks rows whatever the number of input rows. As many aggregate
    expressions the same work would not fit into compiled code. A row counts for a pair when both values are there.
    """
    names = list(dict.fromkeys([*left, *right]))
    at_left, at_right = [names.index(c) for c in left], [names.index(c) for c in right]

    def add_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals, rows, shift = np.zeros((7, len(left), len(right))), 0, np.full(len(names), np.nan)
        for batch in batches:
            values = batch.to_numpy(dtype="float64", na_value=np.nan)
            there = ~np.isnan(values)
            sums, counts = np.where(there, values, 0.0).sum(0), there.sum(0)
            shift = np.where(np.isnan(shift) & (counts > 0), sums / np.maximum(counts, 1), shift)
            filled = np.where(there, values - np.nan_to_num(shift), 0.0)
            x, mx, y, my = filled[:, at_left], there[:, at_left].astype("float64"), filled[:, at_right], there[:, at_right].astype("float64")
            equal = [[float(np.count_nonzero(values[:, i] == values[:, j])) for j in at_right] for i in at_left]
            rows += len(values)
            totals += np.stack([mx.T @ my, x.T @ my, mx.T @ y, (x * x).T @ my, mx.T @ (y * y), x.T @ y, np.array(equal)])
        n, sx, sy, sxx, syy, sxy, same = totals
        count, move = np.maximum(n, 1), np.nan_to_num(shift)
        means = sx / count + move[at_left][:, None], sy / count + move[at_right][None, :]
        parts = np.stack([n, *means, sxx - sx * sx / count, syy - sy * sy / count, sxy - sx * sy / count, same])
        cells = [(a, b, *parts[:, i, j], float(rows)) for i, a in enumerate(left) for j, b in enumerate(right)]
        yield pd.DataFrame(cells, columns=["a", "b", "n", "mx", "my", "cxx", "cyy", "cxy", "same", "rows"])

    return df.select(*[F.col(c).cast("double").alias(c) for c in names]).mapInPandas(add_up, PAIR_MOMENTS)


def merged_moments(parts: DataFrame) -> DataFrame:
    """The tasks' moments per pair as those of all rows: what a task's mean is off the whole mean adds to the centred sums."""
    whole = Window.partitionBy("a", "b")
    n = F.sum("n").over(whole)
    means = {"gx": F.try_divide(F.sum(F.col("n") * F.col("mx")).over(whole), n), "gy": F.try_divide(F.sum(F.col("n") * F.col("my")).over(whole), n)}
    off_x, off_y = F.col("mx") - F.col("gx"), F.col("my") - F.col("gy")
    return parts.withColumns(means).groupBy("a", "b").agg(
        F.sum("n").alias("n"), F.max("gx").alias("mx"), F.max("gy").alias("my"),
        F.sum(F.col("cxx") + F.col("n") * off_x * off_x).alias("cxx"), F.sum(F.col("cyy") + F.col("n") * off_y * off_y).alias("cyy"),
        F.sum(F.col("cxy") + F.col("n") * off_x * off_y).alias("cxy"), F.sum("same").alias("same"), F.sum("rows").alias("rows"),
    )


def correlation() -> Column:
    """Correlation from the moments; missing when either side has no spread but the last bits of its own values."""
    n = F.col("n")

    def varies(centred: str, mean: str) -> Column:
        return F.col(centred) > n * F.pow(F.abs(F.col(mean)) * 4e-15, 2)

    return F.when(varies("cxx", "mx") & varies("cyy", "my"), F.col("cxy") / (F.sqrt("cxx") * F.sqrt("cyy")))


def correlation_pairs(df: DataFrame, left: list[str], right: list[str]) -> DataFrame:
    """Rows (a, b, r, same, rows) for every pair of a left and a right column; same counts the rows where both are equal."""
    return merged_moments(pair_moments(df, left, right)).select("a", "b", correlation().alias("r"), *[F.col(c).cast("bigint").alias(c) for c in ("same", "rows")])


def correlations_long(df: DataFrame, columns: list[str], targets: tuple[str, ...]) -> DataFrame:
    """One row per column with its correlation to each target (corr_<target>), its equal rows (same_<target>) and all rows."""
    pairs = correlation_pairs(df, columns, list(targets))
    return pairs.groupBy(F.col("a").alias("column_name")).agg(
        *[F.max(F.when(F.col("b") == t, F.col("r"))).alias(f"corr_{t}") for t in targets],
        *[F.max(F.when(F.col("b") == t, F.col("same"))).alias(f"same_{t}") for t in targets],
        F.max("rows").alias("rows"),
    )
