"""Linear fits from sums of products: one pass over the rows answers every fold, share and split.

A least squares line and its errors over any set of rows follow from the counts, sums and products of the columns over that set. They are
added up per group once, where a group is a fold, a slice or a split; a training set is then a sum of groups, so that k folds or a
learning curve cost no further pass over the trips, however many fits they ask for.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F


@dataclass(frozen=True)
class ProductSums:
    """Per group the matrix of summed products of (1, columns less `shift`)."""

    by: tuple[str, ...]
    columns: tuple[str, ...]
    shift: np.ndarray
    groups: dict[tuple, np.ndarray]

    def total(self, keep: Callable[..., bool] = lambda *key: True) -> np.ndarray:
        """The matrix over all groups whose key passes."""
        width = len(self.columns) + 1
        return sum((m for key, m in self.groups.items() if keep(*key)), np.zeros((width, width)))


@dataclass(frozen=True)
class Line:
    """target = base + weights · inputs."""

    inputs: tuple[str, ...]
    target: str
    weights: np.ndarray
    base: float

    def column(self) -> Column:
        """The prediction as a column expression."""
        return sum((F.col(c) * float(w) for c, w in zip(self.inputs, self.weights)), F.lit(float(self.base)))


def product_sums(df: DataFrame, columns: list[str], by: list[str] = ()) -> ProductSums:
    """Summed products of finite double columns per group.

    Groups are few (folds, slices, splits). Each task adds up its batches as matrix products, about values near the columns' means so
    that no digits cancel; what is shuffled is a number per task, group and pair of columns, and what the driver gets is one per group
    and pair.
    """
    # any values near the means will do: those of the first rows
    near = df.select(*columns).limit(1000).agg(*[F.coalesce(F.avg(c), F.lit(0.0)).alias(c) for c in columns]).first()
    shift, width = np.array([near[c] for c in columns], float), len(columns) + 1
    upper = np.triu_indices(width)
    types = {f.name: f.dataType.simpleString() for f in df.schema}

    def add_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals: dict[tuple, np.ndarray] = {}
        for batch in batches:
            if not len(batch):
                continue
            z = np.column_stack([np.ones(len(batch)), batch[columns].to_numpy(float) - shift])
            parts = batch.groupby(list(by), sort=False).indices.items() if by else [((), np.arange(len(batch)))]
            for key, rows in parts:
                key = key if isinstance(key, tuple) else (key,)
                totals[key] = totals.get(key, 0) + z[rows].T @ z[rows]
        rows = [(*key, m[upper].tolist()) for key, m in totals.items()]
        yield pd.DataFrame(rows, columns=[*by, "sums"])

    parts = df.select(*by, *[F.col(c).cast("double").alias(c) for c in columns]).mapInPandas(add_up, ", ".join([*(f"`{c}` {types[c]}" for c in by), "sums array<double>"]))
    whole = parts.select(*by, F.posexplode("sums").alias("place", "part")).groupBy(*by, "place").agg(F.sum("part").alias("total"))
    groups: dict[tuple, np.ndarray] = {}
    for r in whole.collect():
        m = groups.setdefault(tuple(r[c] for c in by), np.zeros((width, width)))
        i, j = upper[0][r["place"]], upper[1][r["place"]]
        m[i, j] = m[j, i] = r["total"]
    return ProductSums(tuple(by), tuple(columns), shift, groups)


def _centred(m: np.ndarray) -> np.ndarray:
    return m[1:, 1:] - np.outer(m[0, 1:], m[0, 1:]) / max(m[0, 0], 1.0)


def solve(matrix: np.ndarray, right: np.ndarray, dependent: float) -> np.ndarray:
    """The solution of scaled normal equations by elimination; an input that depends on those before it gets 0."""
    m, k_all = np.column_stack([matrix, right]), len(right)
    free = []
    for k in range(k_all):
        if m[k, k] < dependent:
            free.append(k)
            continue
        m -= np.outer(np.where(np.arange(k_all) == k, 0.0, m[:, k] / m[k, k]), m[k])
    found = m[:, -1] / np.where(np.diag(m) == 0, 1.0, np.diag(m))
    found[free] = 0.0
    return found


def fit_line(sums: ProductSums, over: np.ndarray, inputs: list[str], target: str, dependent: float = 1e-10) -> Line:
    """The least squares line over the rows that `over` sums up. A constant input, or one that depends on those before it, weighs nothing."""
    at, y = [sums.columns.index(c) for c in inputs], sums.columns.index(target)
    n = max(over[0, 0], 1.0)
    c = _centred(over) / n
    spread = np.sqrt(np.maximum(np.diag(c)[at], 0))
    scale = np.where(spread > 0, spread, 1.0)
    weights = solve(c[np.ix_(at, at)] / np.outer(scale, scale), c[at, y] / scale, dependent) / scale
    means = over[0, 1:] / n + sums.shift
    return Line(tuple(inputs), target, weights, float(means[y] - weights @ means[at]))


def line_metrics(sums: ProductSums, over: np.ndarray, line: Line) -> dict[str, float]:
    """Rows, R² and RMSE of a line over the rows that `over` sums up, without reading them again."""
    at, y = [sums.columns.index(c) for c in line.inputs], sums.columns.index(line.target)
    n = over[0, 0]
    a = np.zeros(len(over))
    for place, weight in zip(at, line.weights):
        a[place + 1] += weight
    a[y + 1] -= 1.0
    a[0] = line.base + line.weights @ sums.shift[at] - sums.shift[y]
    squares, spread = float(a @ over @ a), float(_centred(over)[y, y])
    return {"n": int(n), "r2": 1 - squares / spread if spread > 0 else None, "rmse": float(np.sqrt(max(squares, 0) / n)) if n else None}


FOLDS = "target string, fold int, train_rows bigint, n bigint, train_r2 double, r2 double, rmse double"


def kfold_lines(sums: ProductSums, inputs: list[str], targets: tuple[str, ...]) -> list[tuple]:
    """Rows as FOLDS: a line fitted without each fold, over its own rows and over the fold. sums has the key (split, fold)."""
    rows = []
    for target in targets:
        for fold in sorted({f for _, f in sums.groups}):
            train, held = sums.total(lambda s, f: s == "train" and f != fold), sums.total(lambda s, f: s == "train" and f == fold)
            line = fit_line(sums, train, inputs, target)
            own, other = line_metrics(sums, train, line), line_metrics(sums, held, line)
            rows.append((target, int(fold), own["n"], other["n"], own["r2"], other["r2"], other["rmse"]))
    return rows


def test_lines(sums: ProductSums, inputs: list[str], targets: tuple[str, ...]) -> list[tuple]:
    """(target, test R²) of the line over all training rows."""
    train, test = sums.total(lambda s, f: s == "train"), sums.total(lambda s, f: s == "test")
    return [(t, line_metrics(sums, test, fit_line(sums, train, inputs, t))["r2"]) for t in targets]


CURVE = "target string, fraction double, fold int, train_rows bigint, valid_rows bigint, train_r2 double, valid_r2 double, gap double"


def learning_curve(sums: ProductSums, inputs: list[str], targets: tuple[str, ...], steps: int = 10) -> list[tuple]:
    """Rows as CURVE: lines over growing shares of the rows outside each fold. sums has the key (fold, slice), slices 0 to steps - 1."""
    rows = []
    for target in targets:
        for fold in sorted({f for f, _ in sums.groups}):
            held = sums.total(lambda f, s: f == fold)
            for step in range(1, steps + 1):
                train = sums.total(lambda f, s: f != fold and s < step)
                line = fit_line(sums, train, inputs, target)
                own, other = line_metrics(sums, train, line), line_metrics(sums, held, line)
                gap = own["r2"] - other["r2"] if None not in (own["r2"], other["r2"]) else None
                rows.append((target, step / steps, int(fold), own["n"], other["n"], own["r2"], other["r2"], gap))
    return rows
