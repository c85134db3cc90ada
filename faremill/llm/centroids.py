"""Centroid clustering in exact whole numbers, with the nearest centroid found by Orchard's search.

Every centroid keeps a list of all centroids in order of their distance from it. A vector starts at some centroid, walks that centroid's
list and measures each centroid it has not measured yet; as soon as one is closer it jumps to that one's list. It stops at the first entry
strictly further from the list's centroid than twice the vector's distance to it: by the triangle inequality nothing behind it can be as
close. Components are whole numbers, so squared distances, sums and means are exact and do not depend on how rows are dealt.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from faremill.llm.common import Written


@dataclass
class Lists:
    """Centroids, and for each the numbers of all centroids by distance (ties: smaller number) with those squared distances."""

    centroids: np.ndarray
    order: np.ndarray
    far: np.ndarray

    @classmethod
    def of(cls, centroids: np.ndarray) -> Lists:
        apart = np.stack([((centroids - c) ** 2).sum(1) for c in centroids])
        order = np.argsort(apart, axis=1, kind="stable")
        return cls(centroids, order, np.take_along_axis(apart, order, 1))

    def nearest(self, x: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """For each row its nearest centroid (ties: smaller number), the squared distance, and how many distances were measured.

        All rows walk their lists side by side, one entry a step. Distances are compared squared: strictly beyond twice is above 4 times.
        """
        here = start.astype(np.int64)
        best = ((x - self.centroids[here]) ** 2).sum(1)
        seen = np.zeros((len(x), len(self.centroids)), bool)
        seen[np.arange(len(x)), here] = True
        at, walking, measured = np.zeros(len(x), np.int64), np.arange(len(x)), len(x)
        while True:
            walking = walking[at[walking] < len(self.centroids)]
            walking = walking[self.far[here[walking], at[walking]] <= 4 * best[walking]]
            if not len(walking):
                return here, best, measured
            entry = self.order[here[walking], at[walking]]
            at[walking] += 1
            fresh = ~seen[walking, entry]
            rows, entry = walking[fresh], entry[fresh]
            seen[rows, entry] = True
            measured += len(rows)
            distance = ((x[rows] - self.centroids[entry]) ** 2).sum(1)
            closer = (distance < best[rows]) | ((distance == best[rows]) & (entry < here[rows]))
            jump = rows[closer]
            here[jump], best[jump], at[jump] = entry[closer], distance[closer], 0


def largest(length: int) -> int:
    """The greatest component, in size, with which four times a squared distance still is a long."""
    return math.isqrt((1 << 60) // length) // 2


def whole_vectors(vectors: DataFrame, length: int, scale: int, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, q): the vectors that take part, each component turned into floor(scale * x)."""
    v = F.col(f"`{vector_col}`").cast("array<double>")
    rows = vectors.select(F.col(f"`{id_col}`").cast("bigint").alias("vec_id"), v.alias("v")).where(F.size("v") == length)
    # a comparison with null or NaN does not hold either way; infinities are beyond any bound
    held = F.forall("v", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) <= largest(length) / scale), F.lit(False)))
    return rows.where(held).select("vec_id", F.transform("v", lambda x: F.floor(x * float(scale)).cast("int")).alias("q"))


def _matrix(batch: pa.RecordBatch, length: int) -> np.ndarray:
    return batch.column("q").flatten().to_numpy(zero_copy_only=False).reshape(-1, length).astype(np.int64)


def _assigned(rows: DataFrame, lists: Lists, start: bool) -> DataFrame:
    """(vec_id, q, cluster, distance); with `start` each search begins at the row's own `cluster`, else at centroid 0."""
    length = lists.centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch, length)
            first = batch.column("cluster").to_numpy(zero_copy_only=False) if start else np.zeros(len(x), np.int64)
            cluster, distance, _ = lists.nearest(x, first)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("q"), pa.array(cluster.astype(np.int32)), pa.array(distance)], names=["vec_id", "q", "cluster", "distance"]
            )

    return rows.mapInArrow(run, "vec_id bigint, q array<int>, cluster int, distance bigint")


def _moved(rows: DataFrame, lists: Lists, search: bool) -> np.ndarray:
    """The centroids after one round: the floor of each non-empty cluster's mean. Without `search` each row's `cluster` is taken as it is.

    A task adds up its vectors per cluster; what is shuffled is a number per task, cluster and component, and what comes back is a number
    per cluster and component, whatever the table.
    """
    k, length = lists.centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((k, length), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            x = _matrix(batch, length)
            cluster = batch.column("cluster").to_numpy(zero_copy_only=False)
            if search:
                cluster = lists.nearest(x, cluster)[0]
            np.add.at(sums, cluster, x)
            counts += np.bincount(cluster, minlength=k)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(counts[used]), pa.array(sums[used].tolist(), pa.list_(pa.int64()))], names=["cluster", "n", "sums"])

    parts = rows.mapInArrow(run, "cluster int, n bigint, sums array<bigint>")
    totals = parts.select("cluster", "n", F.posexplode("sums").alias("place", "part")).groupBy("cluster", "place").agg(F.sum("n").alias("n"), F.sum(F.col("part").cast("decimal(38,0)")).alias("total"))
    moved = lists.centroids.copy()
    for r in totals.collect():
        moved[r["cluster"], r["place"]] = int(r["total"]) // int(r["n"])
    return moved


RESULT = "vec_id bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string"


def cluster(
    vectors: DataFrame, clusters: int = 40, rounds: int = 5, length: int = 64, scale: int = 256, salt: str = "2:", id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) per vector that takes part.

    Vectors of exactly `length` components, none null or non-finite, take part, as floor(scale * x). The first centroids are the vectors
    with the smallest sha256 of `salt` and id; each of `rounds` rounds assigns all vectors and moves every non-empty centroid to the
    floor of its mean; then vectors are assigned once more. Distances are squared.

    Edge cases: a component beyond `largest(length) / scale` (262,144 with the defaults) in size has no distance that a long could hold,
    so its vector takes no part either; a row without an id takes part but is never a first centroid; rows that repeat an id are vectors
    of their own, in order of their components where they are first centroids; fewer vectors with an id than `clusters` make as many
    centroids; equal centroids: the smaller number takes all; without any vector with an id, or an empty table, there are no rows;
    an inertia beyond a long is null. Columns other than id and vector are not looked at.

    The whole numbers are written once, with each vector's first cluster, at which its later searches begin. Between rounds only sums
    per cluster and component are shuffled, so a cluster with a third of all vectors is no single task.
    """
    spark = vectors.sparkSession
    rows = whole_vectors(vectors, length, scale, id_col, vector_col)
    first = rows.where("vec_id is not null").select(F.sha2(F.concat(F.lit(salt), F.col("vec_id").cast("string")), 256).alias("hash"), "q").orderBy("hash", "q").limit(clusters)
    seeds = [r["q"] for r in first.collect()]
    if not seeds:
        return spark.createDataFrame([], RESULT)
    lists = Lists.of(np.array(seeds, np.int64))
    placed = Written(_assigned(rows, lists, start=False).select("vec_id", "q", "cluster"), "whole-vectors")
    for turn in range(rounds):
        # the first assignment is the written one
        lists = Lists.of(_moved(placed.df, lists, search=turn > 0))
    last = Written(_assigned(placed.df, lists, start=True).select("vec_id", "cluster", "distance"), "clustered")
    placed.drop()
    sums = {r["cluster"]: int(r["s"]) for r in last.df.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}

    def long(x: int) -> int | None:
        return x if x < 1 << 63 else None

    digests = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in lists.centroids]
    told = [(c, long(s), long(sum(sums.values())), digests[c]) for c, s in sorted(sums.items())]
    # a row per cluster
    names = spark.createDataFrame(told, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return last.df.join(F.broadcast(names), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def cluster_sql(clusters: int = 40, rounds: int = 5, length: int = 64, scale: int = 256, salt: str = "2:") -> str:
    """The same in DuckDB's SQL over a table `embeddings`; all products and sums are whole numbers that doubles hold exactly."""
    near = "(list_inner_product(v.q, v.q) - 2 * list_inner_product(v.q, c.q) + list_inner_product(c.q, c.q))::bigint"
    steps = [
        f"""v as materialized (select row_number() over () as rid, vec_id, list_transform(embedding, lambda x: floor(x::double * {scale})) as q from embeddings
where len(embedding) = {length} and len(list_filter(embedding, lambda x: x is not null and not isnan(x) and abs(x) <= {largest(length) / scale})) = {length})""",
        f"c0 as materialized (select (row_number() over (order by sha256('{salt}' || vec_id), q) - 1)::int as c, q from v where vec_id is not null order by c limit {clusters})",
    ]
    for n in range(rounds + 1):
        steps.append(f"a{n} as materialized (select rid, any_value(v.vec_id) as vec_id, any_value(v.q) as q, min({{'d': {near}, 'c': c.c}}) as hit from v, c{n} c group by rid)")
        if n < rounds:
            steps.append(
                f"""m{n} as (select c, list(f order by i) as q from (select c, i, ((s - ((s % n) + n) % n) // n)::double as f from (select hit.c as c, i, sum(x)::bigint as s, count(*) as n
from (select hit, unnest(q)::bigint as x, generate_subscripts(q, 1) as i from a{n}) group by 1, 2)) group by c)"""
            )
            steps.append(f"c{n + 1} as materialized (select c.c, coalesce(m.q, c.q) as q from c{n} c left join m{n} m using (c))")
    return f"""with {", ".join(steps)} select vec_id, hit.c as cluster, hit.d as distance, (sum(hit.d) over (partition by hit.c))::bigint as cluster_inertia, (sum(hit.d) over ())::bigint as inertia,
sha256(array_to_string(list_transform(c.q, lambda x: x::bigint::varchar), ',')) as centroid_sha256 from a{rounds} a join c{rounds} c on c.c = a.hit.c"""
