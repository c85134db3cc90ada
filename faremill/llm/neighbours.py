"""Approximate nearest neighbours by inner product: a hierarchical k-means tree, searched best bin first.

Vectors get one more coordinate, sqrt(M^2 - |x|^2) with M the largest norm, and queries a 0 there: the largest inner product is then the
smallest distance. A tree of k-means cells is fitted on a bounded sample and every row goes down to a leaf. A query keeps the cells it
has passed by in a priority queue ordered by distance to their centres and opens the nearest next, until it has visited as many
leaves as calibration against brute force asks for. It is answered in its first leaves at first; the k-th score found there is a bound
that a row of the leaves behind must reach to be passed on, and that a leaf's centre and radius must allow for it to be visited at all.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from faremill.llm.common import Written

BRANCHES = 8
# Rows of a shelf (leaves side by side, or a part of a large leaf) and queries of a block: what one group holds and streams.
SHELF_ROWS = 20_000
QUERY_ROWS = 10_000
BLOCK = 256
# Of the leaves a query visits, this many are answered first, for its bound.
FIRST_LEAVES = 4


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, v): rows with an id and a finite vector of the commonest length that isn't zero; all others take no part."""
    v = F.col(f"`{vector_col}`").cast("array<double>")
    rows = vectors.select(F.col(f"`{id_col}`").cast("bigint").alias("vec_id"), v.alias("v")).where("vec_id is not null and size(v) > 0")
    finite = F.forall("v", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    rows = rows.where(finite & F.exists("v", lambda x: x != 0))
    sizes = rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").first()
    return rows.where(F.size("v") == (sizes["d"] if sizes else 0))


@dataclass
class Tree:
    """Cells by number, the root 0: their centres, children (none: a leaf) and leaf numbers."""

    norm: float
    centres: list = field(default_factory=list)
    children: list = field(default_factory=list)
    leaf: list = field(default_factory=list)
    leaves: int = 0
    visits: int = 1

    def lift(self, x: np.ndarray) -> np.ndarray:
        return np.concatenate([x, np.sqrt(np.maximum(self.norm**2 - (x * x).sum(1), 0))[:, None]], axis=1)

    def grow(self, x: np.ndarray, most: int, rng: np.random.Generator) -> int:
        """A cell over the lifted sample x, split until it holds at most `most` of it or can't be told apart."""
        me = len(self.centres)
        self.centres.append(x.mean(0))
        self.children.append([])
        self.leaf.append(-1)
        parts = _kmeans(x, BRANCHES, rng) if len(x) > most else None
        if parts is None or parts.max() == 0:
            self.leaf[me] = self.leaves
            self.leaves += 1
        else:
            self.children[me] = [self.grow(x[parts == k], most, rng) for k in range(parts.max() + 1)]
        return me

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        """The leaf each lifted row goes down to, always to the nearest child."""
        out = np.zeros(len(x), np.int32)
        todo = [(0, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            kids = self.children[node]
            if not kids:
                out[rows] = self.leaf[node]
                continue
            c = np.stack([self.centres[k] for k in kids])
            near = ((c * c).sum(1)[None, :] - 2 * x[rows] @ c.T).argmin(1)
            todo += [(kid, rows[near == k]) for k, kid in enumerate(kids) if (near == k).any()]
        return out

    def leaf_centres(self) -> np.ndarray:
        """The lifted centres of the leaves, by leaf number."""
        return np.stack([self.centres[node] for _, node in sorted((leaf, node) for node, leaf in enumerate(self.leaf) if leaf >= 0)])

    def visit(self, queries: np.ndarray, leaves: int) -> list[list[int]]:
        """Best bin first: for each query the first `leaves` leaves in the order they are reached."""
        c = np.stack(self.centres)
        q = np.concatenate([queries, np.zeros((len(queries), 1))], axis=1)
        out = []
        for far in (c * c).sum(1)[None, :] - 2 * q @ c.T:
            found, queue = [], [(far[0], 0)]
            while queue and len(found) < leaves:
                node = heapq.heappop(queue)[1]
                while self.children[node]:
                    kids = sorted(self.children[node], key=far.__getitem__)
                    for kid in kids[1:]:
                        heapq.heappush(queue, (far[kid], kid))
                    node = kids[0]
                found.append(self.leaf[node])
            out.append(found)
        return out


def _kmeans(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 8) -> np.ndarray | None:
    """Cluster numbers without gaps, or None if the rows are all alike."""
    c = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(rounds):
        near = ((c * c).sum(1)[None, :] - 2 * x @ c.T).argmin(1)
        used = np.unique(near)
        c = np.stack([x[near == j].mean(0) for j in used])
    near = np.unique(((c * c).sum(1)[None, :] - 2 * x @ c.T).argmin(1), return_inverse=True)[1]
    return near if near.max() > 0 else None


def _best(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int) -> pd.DataFrame:
    """Each query's k best rows, ties to the smaller id, never its own id. Products are first taken as a matrix; what may be among
    the best is then summed row by row, so that equal vectors score equally wherever they stand."""
    out = []
    for start in range(0, len(queries), BLOCK):
        q, own = queries[start : start + BLOCK], query_ids[start : start + BLOCK]
        rough = q @ rows.T
        rough[own[:, None] == ids[None, :]] = -np.inf
        slack = 1e-9 * (np.abs(q).max() * np.abs(rows).max() * q.shape[1] + 1e-300)
        limit = np.partition(rough, -k, axis=1)[:, -k] - slack if rough.shape[1] > k else np.full(len(q), -np.inf)
        a, b = np.nonzero((rough >= limit[:, None]) & (rough > -np.inf))
        score = np.concatenate([(q[a[i : i + 4096]] * rows[b[i : i + 4096]]).sum(1) for i in range(0, len(a), 4096)] or [np.zeros(0)])
        order = np.lexsort((ids[b], -score, a))
        a, b, score = a[order], b[order], score[order]
        place = np.arange(len(a)) - np.searchsorted(a, a)
        top = place < k
        out.append(pd.DataFrame({"query_id": own[a[top]], "vec_id": ids[b[top]], "score": score[top]}))
    return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def brute_force(rows: DataFrame, queries: pd.DataFrame, k: int) -> DataFrame:
    """The exact answer for a bounded set of queries (vec_id, v), in blocks over all rows."""
    shared = rows.sparkSession.sparkContext.broadcast((queries["vec_id"].to_numpy(np.int64), np.stack(queries["v"].to_list())))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                yield _best(*shared.value, batch["vec_id"].to_numpy(np.int64), np.stack(batch["v"].to_list()), k)

    return _ranked(rows.select("vec_id", "v").mapInPandas(run, "query_id bigint, vec_id bigint, score double"), k)


def fit(rows: DataFrame, queries: DataFrame, k: int, sample_rows: int = 20_000, leaf_rows: int = 200, max_leaves: int = 4096, trial_queries: int = 100, target: float = 0.94, seed: int = 11) -> Tree | None:
    """A tree on about `sample_rows` rows at most, and the number of leaves to visit.

    Rows and trial queries are taken by a hash of their id. The tree has about a leaf per `leaf_rows` rows, `max_leaves` at most. The
    trial queries are answered by brute force over all rows, and `visits` is the smallest number of leaves with which the search finds
    `target` of their true neighbours. None if no row is usable.
    """
    size = rows.agg(F.count("*").alias("n"), F.max(F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))).alias("norm")).first()
    if not size["n"]:
        return None

    def taken(df: DataFrame, most: int, n: int, salt: int) -> pd.DataFrame:
        return df.where(F.pmod(F.xxhash64("vec_id", F.lit(salt)), F.lit(1 << 24)) < min(1.0, most / max(1, n)) * (1 << 24)).select("vec_id", "v").toArrow().to_pandas()

    sample = taken(rows, sample_rows, size["n"], 1)
    if not len(sample):
        sample = rows.limit(1).toArrow().to_pandas()
    tree = Tree(float(size["norm"]))
    x = tree.lift(np.stack(sample.sort_values("vec_id")["v"].to_list()))
    leaves = min(max_leaves, max(1, size["n"] // leaf_rows))
    tree.grow(x, max(2, len(x) // leaves), np.random.default_rng(seed))
    trials = taken(queries, trial_queries, queries.count(), 2)
    if not len(trials):
        tree.visits = tree.leaves
        return tree
    truth = brute_force(rows, trials, k)
    near = truth.join(rows.select("vec_id", "v").dropDuplicates(["vec_id"]), "vec_id").select("query_id", "v").toArrow().to_pandas()
    if not len(near):
        return tree
    order = {q: {leaf: n for n, leaf in enumerate(found)} for q, found in zip(trials["vec_id"], tree.visit(np.stack(trials["v"].to_list()), tree.leaves))}
    needed = np.sort([order[q][leaf] + 1 for q, leaf in zip(near["query_id"], tree.leaf_of(tree.lift(np.stack(near["v"].to_list()))))])
    tree.visits = int(needed[min(len(needed) - 1, int(np.ceil(target * len(needed))) - 1)])
    return tree


@dataclass(frozen=True)
class Shelves:
    """Leaves packed into pieces of at most about `most` rows: leaves side by side share one, a larger leaf is cut into several."""

    first: list[int]
    pieces: list[int]

    @classmethod
    def of(cls, counts: dict[int, int], leaves: int, most: int) -> Shelves:
        first, pieces, at, held = [], [], 0, 0
        for leaf in range(leaves):
            n = counts.get(leaf, 0)
            if held and held + n > most:
                at, held = at + 1, 0
            first.append(at)
            pieces.append(max(1, -(-n // most)))
            at, held = (at + pieces[-1], 0) if n > most else (at, held + n)
        return cls(first, pieces)

    def place(self, leaf: Column, salt: int) -> Column:
        """The piece of a row of that leaf; within a leaf of several the id's hash decides."""
        within = F.pmod(F.xxhash64("vec_id", F.lit(salt)), F.array(*map(F.lit, self.pieces))[leaf]).cast("int")
        return F.array(*map(F.lit, self.first))[leaf] + within


def _answer(asked: DataFrame, placed: DataFrame, tree: Tree, shelves: Shelves, radius: np.ndarray, k: int) -> DataFrame:
    """(query_id, vec_id, score): of every query the best rows of each shelf among the leaves it visits, at most k, none below its bound.

    asked is (vec_id, v, block, leaves, bound). A query is sent once to each shelf it has leaves on, and a shelf's rows once to each block
    with such queries. A task holds one block of queries with their best so far, while the shelf's rows stream past, leaf by leaf.
    """
    first, pieces = F.array(*map(F.lit, shelves.first)), F.array(*map(F.lit, shelves.pieces))
    # a leaf cut into several pieces lies on all of them
    on = F.flatten(F.transform("leaves", lambda leaf: F.transform(F.sequence(first[leaf], first[leaf] + pieces[leaf] - 1), lambda at: F.struct(at.alias("shelf"), leaf.alias("leaf")))))
    each = asked.withColumn("on", on).select("vec_id", "v", "block", "bound", "on", F.explode(F.array_distinct(F.transform("on", lambda x: x["shelf"]))).alias("shelf"))
    here = F.transform(F.filter("on", lambda x: x["shelf"] == F.col("shelf")), lambda x: x["leaf"])
    each = each.select("shelf", "block", F.lit(0).alias("kind"), F.lit(-1).alias("leaf"), "vec_id", "v", here.alias("leaves"), "bound")
    meet = each.groupBy("shelf").agg(F.collect_set("block").alias("blocks"))
    none = F.lit(None).cast("array<int>")
    rows = placed.withColumn("shelf", shelves.place(F.col("leaf"), 3)).join(meet, "shelf").select("shelf", F.explode("blocks").alias("block"), F.lit(1).alias("kind"), "leaf", "vec_id", "v", none.alias("leaves"), F.lit(None).cast("double").alias("bound"))
    met = each.unionByName(rows).repartition("shelf", "block").sortWithinPartitions("shelf", "block", "kind", "leaf", "vec_id")
    shared = asked.sparkSession.sparkContext.broadcast((tree.leaf_centres()[:, :-1], radius))

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        group = None
        for batch in batches:
            if not len(batch):
                continue
            cuts = np.flatnonzero((batch[["shelf", "block", "kind", "leaf"]].diff().fillna(0) != 0).any(axis=1).to_numpy())
            for a, b in zip([0, *cuts], [*cuts, len(batch)]):
                part = batch.iloc[a:b]
                if not len(part):
                    continue
                key = (part["shelf"].iloc[0], part["block"].iloc[0])
                if group is None or group.key != key:
                    if group is not None:
                        yield group.best()
                    group = Block(key, k, *shared.value)
                if part["kind"].iloc[0] == 0:
                    group.ask(part)
                else:
                    for start in range(0, len(part), 2000):
                        group.meet(int(part["leaf"].iloc[0]), part.iloc[start : start + 2000])
        if group is not None:
            yield group.best()

    return met.mapInPandas(compare, "query_id bigint, vec_id bigint, score double")


class Block:
    """One block of queries and the best rows it has met."""

    MOST = 200_000

    def __init__(self, key: tuple, k: int, centres: np.ndarray, radius: np.ndarray):
        self.key, self.k, self.centres, self.radius = key, k, centres, radius
        self.asked: list = []
        self.q = None
        self.found: list = []
        self.held = 0

    def ask(self, part: pd.DataFrame) -> None:
        self.asked.append(part[["vec_id", "v", "leaves", "bound"]])

    def _open(self) -> None:
        asked = pd.concat(self.asked)
        self.ids, self.q = asked["vec_id"].to_numpy(np.int64), np.stack(asked["v"].to_list())
        self.limit, self.length = asked["bound"].fillna(-np.inf).to_numpy(float).copy(), np.linalg.norm(self.q, axis=1)
        leaf = np.concatenate(asked["leaves"].to_list()).astype(np.int64)
        row = np.repeat(np.arange(len(asked)), asked["leaves"].map(len))
        order = np.argsort(leaf, kind="stable")
        values, starts = np.unique(leaf[order], return_index=True)
        self.visitors = dict(zip(values.tolist(), np.split(row[order], starts[1:])))
        self.asked = []

    def meet(self, leaf: int, part: pd.DataFrame) -> None:
        """Compare the leaf's visitors with some of its rows. No row's product can exceed that with the centre plus radius times length."""
        if self.q is None:
            if not self.asked:
                return
            self._open()
        who = self.visitors.get(leaf)
        if who is None:
            return
        most = self.q[who] @ self.centres[leaf] + self.length[who] * self.radius[leaf] * (1 + 1e-9) + 1e-12
        who = who[most >= self.limit[who]]
        ids, rows = part["vec_id"].to_numpy(np.int64), np.stack(part["v"].to_list())
        for start in range(0, len(who), BLOCK):
            some = who[start : start + BLOCK]
            q = self.q[some]
            rough = q @ rows.T
            rough[self.ids[some][:, None] == ids[None, :]] = -np.inf
            slack = 1e-9 * (np.abs(q).max() * np.abs(rows).max() * q.shape[1] + 1e-300)
            least = self.limit[some]
            if rough.shape[1] > self.k:
                least = np.maximum(least, np.partition(rough, -self.k, axis=1)[:, -self.k])
            a, b = np.nonzero((rough >= least[:, None] - slack) & (rough > -np.inf))
            if len(a):
                score = np.concatenate([(q[a[i : i + 4096]] * rows[b[i : i + 4096]]).sum(1) for i in range(0, len(a), 4096)])
                self.found.append((some[a], ids[b], score))
                self.held += len(a)
        if self.held > self.MOST:
            self._keep()

    def _keep(self) -> None:
        """Each query's k best so far; the k-th is its new limit."""
        row, ids, score = (np.concatenate(x) for x in zip(*self.found))
        order = np.lexsort((ids, -score, row))
        row, ids, score = row[order], ids[order], score[order]
        top = np.arange(len(row)) - np.searchsorted(row, row) < self.k
        row, ids, score = row[top], ids[top], score[top]
        last = np.flatnonzero(np.arange(len(row)) - np.searchsorted(row, row) == self.k - 1)
        self.limit[row[last]] = np.maximum(self.limit[row[last]], score[last])
        self.found, self.held = [(row, ids, score)], 0

    def best(self) -> pd.DataFrame:
        if not self.found:
            return pd.DataFrame({"query_id": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64), "score": np.zeros(0)})
        self._keep()
        row, ids, score = self.found[0]
        return pd.DataFrame({"query_id": self.ids[row], "vec_id": ids, "score": score})


# Beyond this size of a component, squares may overflow; vectors are then scaled by a power of two, which changes no digit.
LARGE = 2.0**400

RESULT = "query_id bigint, rank int, vec_id bigint, score double"


def search(vectors: DataFrame, k: int = 20, every: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", **fitting) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of every row whose id is divisible by `every`, over all rows but its own.

    Vectors that are null, zero, of another length than most, or hold null or non-finite components take no part, nor do rows without
    an id. Of rows that repeat an id each is a candidate (never for that id's query) and the smallest vector is the query. With fewer than
    k candidates in the leaves visited a query visits all leaves. A product too large for a double is an infinite score; order and ties are
    those of the true products. Queries are answered in their first FIRST_LEAVES leaves, whose k-th score bounds what the others pass on.
    Leaves are packed into shelves of about SHELF_ROWS rows, queries with the same first leaf into blocks of about QUERY_ROWS, so that
    equal vectors are no single task and neither side of a task grows with the table.
    """
    spark = vectors.sparkSession
    plain = Written(usable(vectors, id_col, vector_col), "vectors")
    greatest = plain.df.agg(F.max(F.array_max(F.transform("v", lambda x: F.abs(x))))).first()[0]
    if greatest is None:
        plain.drop()
        return spark.createDataFrame([], RESULT)
    scale = 2.0 ** math.frexp(greatest)[1] if greatest > LARGE else 1.0
    rows = plain.df if scale == 1.0 else plain.df.withColumn("v", F.transform("v", lambda x: x / scale))
    queries = rows.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("v").alias("v"))
    tree = fit(rows, queries, k, **fitting)
    shared = spark.sparkContext.broadcast(tree)

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tree = shared.value
        centres = tree.leaf_centres()[:, :-1]
        for batch in batches:
            if len(batch):
                x = np.stack(batch["v"].to_list())
                leaf = tree.leaf_of(tree.lift(x))
                yield pd.DataFrame({"leaf": leaf, "vec_id": batch["vec_id"], "v": batch["v"], "off": np.linalg.norm(x - centres[leaf], axis=1)})

    placed = Written(rows.mapInPandas(place, "leaf int, vec_id bigint, v array<double>, off double"), "placed-vectors")
    # a row per leaf, max_leaves at most
    leaves = placed.df.groupBy("leaf").agg(F.count("*").alias("n"), F.max("off").alias("off")).collect()
    counts, radius = {r["leaf"]: r["n"] for r in leaves}, np.zeros(tree.leaves)
    for r in leaves:
        radius[r["leaf"]] = r["off"]
    sizes = spark.sparkContext.broadcast(counts)

    def visit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tree, counts = shared.value, sizes.value
        for whole in batches:
            # a query may visit every leaf, so a few queries at a time are written out
            for start in range(0, len(whole), 32):
                batch = whole.iloc[start : start + 32]
                q = np.stack(batch["v"].to_list())
                out = []
                for k_row, found in enumerate(tree.visit(q, tree.visits)):
                    # its own row may be among them
                    if sum(counts.get(leaf, 0) for leaf in found) <= k:
                        found = tree.visit(q[k_row : k_row + 1], tree.leaves)[0]
                    out.append([leaf for leaf in found if leaf in counts])
                yield pd.DataFrame({"vec_id": batch["vec_id"], "v": batch["v"], "leaves": out})

    visits = Written(queries.select("vec_id", "v").mapInPandas(visit, "vec_id bigint, v array<double>, leaves array<int>"), "visits", shuffled=True)
    # again a row per leaf: queries by the leaf they visit first
    starts = {r["leaf"]: r["n"] for r in visits.df.groupBy(F.col("leaves")[0].alias("leaf")).agg(F.count("*").alias("n")).collect()}
    asked = visits.df.withColumn("block", Shelves.of(starts, tree.leaves, QUERY_ROWS).place(F.col("leaves")[0], 5))
    shelves = Shelves.of(counts, tree.leaves, SHELF_ROWS)
    stored = placed.df.select("leaf", "vec_id", "v")
    no_bound = F.lit(None).cast("double").alias("bound")
    near = Written(_answer(asked.select("vec_id", "v", "block", F.slice("leaves", 1, FIRST_LEAVES).alias("leaves"), no_bound), stored, tree, shelves, radius, k), "near", shuffled=True)
    bounds = _ranked(near.df, k).where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.col("score").alias("bound"))
    rest = asked.withColumn("leaves", F.slice("leaves", FIRST_LEAVES + 1, tree.leaves)).where(F.size("leaves") > 0)
    far = _answer(rest.join(bounds, "vec_id", "left").select("vec_id", "v", "block", "leaves", "bound"), stored, tree, shelves, radius, k)
    found = Written(_ranked(near.df.union(far), k), "neighbours", shuffled=True)
    for table in (plain, placed, visits, near):
        table.drop()
    return found.df if scale == 1.0 else found.df.withColumn("score", F.col("score") * scale * scale)
