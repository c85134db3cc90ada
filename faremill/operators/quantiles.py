"""Exact, linearly interpolated quantiles without gathering a group in one task.

Spark's percentile keeps every distinct value of a group in one aggregation buffer. That is the
right tool where the number of distinct values is bounded (hours, weather readings); an error or a
price has no such bound. Here equal values are counted first, counts are added up per fine value
bucket, and only the few buckets that hold a wanted rank are looked into. As a column's values may all fall into one
bucket (readings from a billion up, say), such a bucket is cut once more, evenly between its least and greatest value, before
anything is sorted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from faremill.session import written_table

BUCKETS_PER_OCTAVE = 1024
# Buckets of rows that are read again.
COARSE_PER_OCTAVE = 64
# A bucket with a wanted rank is cut into so many even parts.
PARTS = 4096


def value_bucket(value: Column, per_octave: int = BUCKETS_PER_OCTAVE) -> Column:
    """A whole number that never decreases with value; it depends on nothing but the value.

    It is never null, so that no join on it adds a null filter to one of two otherwise equal
    branches, which would keep Spark from reusing their shared exchange.
    """
    size = F.floor(F.log2(F.abs(value)) * per_octave) + 1100 * per_octave
    beyond = 3000 * per_octave  # infinities have buckets of their own
    finite = F.when(value > 0, size).when(value < 0, -size)
    return F.coalesce(F.when(value == float("inf"), beyond).when(value == float("-inf"), -beyond).otherwise(finite).cast("bigint"), F.lit(0).cast("bigint"))


def value_counts(df: DataFrame, columns: list[str], by: tuple[str, ...] = ()) -> DataFrame:
    """Rows (by..., metric, value, copies): how often each value of each column stands in a group; missing values and NaN are left out."""
    numbers = df.select(*by, *[F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(c) for c in columns])
    return numbers.unpivot(list(by), columns, "metric", "value").where(F.col("value").isNotNull()).groupBy(*by, "metric", "value").agg(F.count("*").alias("copies"))


# Rows whose values are counted together before they are passed on.
COUNTED_ROWS = 131_072


def value_counts_in_batches(df: DataFrame, columns: list[str], by: str) -> DataFrame:
    """As value_counts by one whole-numbered column of few values, for many columns: values are counted a stretch of rows at a time before they
    become rows of their own. Rows without a group are left out."""
    stretch = COUNTED_ROWS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= stretch:
                yield from counted(held)
                held, rows = [], 0
        if rows:
            yield from counted(held)

    def counted(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = np.concatenate([b.column(0).to_numpy() for b in held])
        values = np.concatenate([b.column(1).flatten().to_numpy(zero_copy_only=False) for b in held]).reshape(len(parts), -1)
        for part in np.unique(parts):
            mine = np.ascontiguousarray(values[parts == part].T)
            for place, column in enumerate(mine, 1):
                found = pc.value_counts(pa.array(column[~np.isnan(column)]))
                first = [pa.array(np.full(len(found), v, np.int32)) for v in (part, place)]
                yield pa.RecordBatch.from_arrays([*first, found.field("values"), found.field("counts")], ["part", "place", "value", "copies"])

    # an array of all columns crosses to Python in half the time of a column each
    wide = df.where(F.col(by).isNotNull()).select(F.col(by).cast("int").alias("part"), F.array(*[F.col(c).cast("double") for c in columns]).alias("cells"))
    told = wide.mapInArrow(count, "part int, place int, value double, copies bigint").groupBy("part", "place", "value").agg(F.sum("copies").alias("copies"))
    names = F.array(*[F.lit(c) for c in columns])
    return told.select(F.col("part").cast(df.schema[by].dataType).alias(by), F.element_at(names, F.col("place")).alias("metric"), "value", "copies")


def exact_quantiles(df: DataFrame, columns: list[str], probs: list[float], by: tuple[str, ...] = ()) -> DataFrame:
    """Rows (by..., metric, p, value), one per column and probability; missing values and NaN are left out. Groups are few."""
    return quantiles_of(value_counts(df, columns, by), probs, by)


def quantiles_of(counts: DataFrame, probs: list[float], by: tuple[str, ...] = ()) -> DataFrame:
    """As exact_quantiles, of value_counts that were made, kept or added up before."""
    keys = [*by, "metric"]
    counts = counts.withColumn("bucket", value_bucket(F.col("value")))
    buckets = counts.groupBy(*keys, "bucket").agg(F.sum("copies").alias("rows"), F.min("value").alias("low_end"), F.max("value").alias("high_end"))
    targets = _wanted_buckets(buckets, probs, keys)
    # a bucket per wanted rank, two at most per group, metric and probability: a bounded side, and no bucket meets in one task
    return _ranked_values(counts.join(F.broadcast(targets), [*keys, "bucket"]), keys)


def coarse_bucket(value: Column) -> Column:
    """Few enough buckets that a task can count its rows by them; missing without a value, NaN included."""
    known = F.nanvl(value, F.lit(None).cast("double"))
    return F.when(known.isNotNull(), value_bucket(known, COARSE_PER_OCTAVE))


def quantiles_reread(rows: DataFrame, buckets: DataFrame, probs: list[float], keys: list[str]) -> DataFrame:
    """(keys..., p, value) of rows (keys..., bucket, value) that can be read again, such as written ones.

    buckets is a written table of their coarse_buckets (keys..., bucket, rows, low_end, high_end). Values are counted in the buckets that hold
    a wanted rank only, so the shuffle does not grow with the rows' distinct values. No key is missing.
    """
    targets = _wanted_buckets(buckets.where("bucket is not null"), probs, keys)
    spots = [*keys, "bucket"]
    inside = rows.join(F.broadcast(targets.select(*spots)), spots, "left_semi").groupBy(*spots, "value").agg(F.count("*").alias("copies"))
    return _ranked_values(written_table(inside, "value-counts").join(F.broadcast(targets), spots), keys)


def exact_quantiles_reread(df: DataFrame, columns: list[str], probs: list[float], by: tuple[str, ...] = ()) -> DataFrame:
    """As exact_quantiles, for a df that can be read twice, such as a written one: no shuffle grows with its distinct values."""
    keys = [*by, "metric"]
    cells = df.select(*by, *[F.col(c).cast("double").alias(c) for c in columns]).unpivot(list(by), columns, "metric", "value")
    rows = cells.withColumn("bucket", coarse_bucket(F.col("value"))).where("bucket is not null")
    buckets = rows.groupBy(*keys, "bucket").agg(F.count("*").alias("rows"), F.min("value").alias("low_end"), F.max("value").alias("high_end"))
    return quantiles_reread(rows, written_table(buckets, "buckets"), probs, keys)


def _wanted_buckets(buckets: DataFrame, probs: list[float], keys: list[str]) -> DataFrame:
    """Of buckets (keys..., bucket, rows, low_end, high_end) those with a wanted rank, the ranks, and the rows before them."""
    upto = Window.partitionBy(*keys).orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    ranked = (
        buckets.withColumn("n", F.sum("rows").over(Window.partitionBy(*keys)))
        .withColumn("before", F.sum("rows").over(upto) - F.col("rows"))
    )

    def wanted(p: Column) -> Column:
        position = p * (F.col("n") - 1).cast("double")
        low = F.floor(position)
        return F.array(
            F.struct(p.alias("p"), F.lit(0).alias("side"), low.alias("rank"), (position - low).alias("part")),
            F.struct(p.alias("p"), F.lit(1).alias("side"), F.ceil(position).alias("rank"), (position - low).alias("part")),
        )

    ranks = F.flatten(F.transform(F.array(*[F.lit(float(p)) for p in probs]), wanted))
    return (
        ranked.withColumn("ranks", _inside(ranks, F.col("before"), F.col("rows")))
        .where(F.size("ranks") > 0)
        .select(*keys, "bucket", "before", "ranks", "low_end", "high_end")
    )


def _inside(ranks: Column, start: Column, length: Column) -> Column:
    return F.filter(ranks, lambda r: (r["rank"] >= start) & (r["rank"] < start + length))


def _ranked_values(inside_buckets: DataFrame, keys: list[str]) -> DataFrame:
    """(keys..., p, value) of counted values beside what _wanted_buckets tells of their bucket."""
    even = F.when(F.col("high_end") > F.col("low_end"), F.floor((F.col("value") - F.col("low_end")) / (F.col("high_end") - F.col("low_end")) * PARTS))
    cut = inside_buckets.withColumn("part_no", F.coalesce(even, F.lit(0).cast("bigint")))
    spot = [*keys, "bucket", "part_no"]
    upto_part = Window.partitionBy(*keys, "bucket").orderBy("part_no").rowsBetween(Window.unboundedPreceding, 0)
    parts = (
        cut.groupBy(*spot)
        .agg(F.sum("copies").alias("rows"), F.max("before").alias("before"), F.max("ranks").alias("ranks"))
        .withColumn("start", F.col("before") + F.sum("rows").over(upto_part) - F.col("rows"))
        .withColumn("ranks", _inside(F.col("ranks"), F.col("start"), F.col("rows")))
        .where(F.size("ranks") > 0)
        .select(*spot, "start", "ranks")
    )
    within = Window.partitionBy(*spot).orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    return (
        cut.drop("ranks").join(F.broadcast(parts), spot)
        .withColumn("start", F.col("start") + F.sum("copies").over(within) - F.col("copies"))
        .select(*keys, "value", F.explode(_inside(F.col("ranks"), F.col("start"), F.col("copies"))).alias("r"))
        .groupBy(*keys, F.col("r.p").alias("p"))
        .agg(
            F.max(F.when(F.col("r.side") == 0, F.col("value"))).alias("low"),
            F.max(F.when(F.col("r.side") == 1, F.col("value"))).alias("high"),
            F.max("r.part").alias("part"),
        )
        .select(*keys, "p", F.when((F.col("low") == F.col("high")) | (F.col("part") == 0), F.col("low")).otherwise(F.col("low") + (F.col("high") - F.col("low")) * F.col("part")).alias("value"))
    )


def quantile_name(metric: str, p: float) -> str:
    return f"{metric}_p{format(p * 100, 'g').replace('.', '_')}"


def quantile_row(df: DataFrame, columns: list[str], probs: list[float], by: tuple[str, ...] = ()) -> DataFrame:
    """One row per group with a column such as fare_amount_p95 per metric and probability."""
    wide = [
        F.max(F.when((F.col("metric") == c) & (F.col("p") == F.lit(float(p))), F.col("value"))).alias(quantile_name(c, p))
        for c in columns
        for p in probs
    ]
    return exact_quantiles(df, columns, probs, by).groupBy(*by).agg(*wide)


def attach_row(df: DataFrame, one_row: DataFrame, name: str) -> DataFrame:
    """Add a one-row result as a struct column; it is computed once as a scalar subquery."""
    return df.withColumn(name, one_row.select(F.struct(*one_row.columns).alias(name)).scalar())


def attach_group(df: DataFrame, rows: DataFrame, by: tuple[str, ...], name: str) -> DataFrame:
    """Add a group's one row as a struct column. Groups are few, so their rows are broadcast; without groups it is a scalar subquery."""
    if not by:
        return attach_row(df, rows, name)
    packed = rows.select(*by, F.struct(*[c for c in rows.columns if c not in by]).alias(name))
    return df.join(F.broadcast(packed), list(by))
