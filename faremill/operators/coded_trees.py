"""Regression trees of many folds and targets, grown together over rows that are written once as small codes.

A value's code is the number of edges of any fold that it reaches, so a fold's bin of the value is a look-up. A level of all trees is one
pass over the codes: each task adds up counts and targets per tree, node, input and bin, a node's parts meet in one task, and that finds
the node's best split. The driver holds the trees alone. With whole-number targets the sums are exact, however the rows are dealt.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

# Rows a task works on at a time: the sums of a level are touched once for so many.
CHUNK = 65_536
# Rows of a written record: what Spark does for each record is then next to nothing, and a batch of records stays small.
BLOCK = 64


@dataclass(frozen=True)
class Codes:
    """The edges of all folds together per input, and per fold the bin of every code. A missing value has a code, and a bin, above all others."""

    edges: list[np.ndarray]
    bins: list[list[np.ndarray]]

    @staticmethod
    def of(edges: list[dict[str, list[float]]], columns: list[str]) -> Codes:
        union = [np.unique(np.concatenate([np.asarray(e[c], float) for e in edges])) for c in columns]
        bins = [[np.append(np.searchsorted(e[c], np.append(-np.inf, u), side="right"), len(e[c]) + 1) for c, u in zip(columns, union)] for e in edges]
        return Codes(union, bins)

    @property
    def dtype(self) -> np.dtype:
        return np.min_scalar_type(max(len(u) for u in self.edges) + 1)

    @property
    def width(self) -> int:
        """Bins of an input at most."""
        return 1 + max(int(b[-1]) for fold in self.bins for b in fold)


def coded(rows: DataFrame, columns: list[str], targets: list[str], codes: Codes) -> DataFrame:
    """Blocks of rows as three binaries: their folds, their targets and the codes of their inputs. A missing target is NaN."""
    edges, dtype, block, many = codes.edges, codes.dtype, BLOCK, len(targets)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            values = batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(n, len(edges))
            out = np.empty((n, len(edges)), dtype)
            for j, u in enumerate(edges):
                x = values[:, j].copy()
                out[:, j] = np.where(np.isnan(x), len(u) + 1, np.searchsorted(u, x, side="right"))
            y = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(n, many)
            starts = np.append(np.arange(0, n, block), n).astype(np.int32)
            packed = []
            for cells in (batch.column(0).to_numpy().reshape(n, 1).astype(np.int32), y, out):
                ends = starts * np.int32(cells.shape[1] * cells.itemsize)
                packed.append(pa.Array.from_buffers(pa.binary(), len(starts) - 1, [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(cells))]))
            yield pa.RecordBatch.from_arrays(packed, ["fold", "targets", "codes"])

    # an array of all inputs crosses to Python in half the time of a column each
    arrays = [F.array(*[F.col(c).cast("double") for c in names]).alias(to) for names, to in ((targets, "targets"), (columns, "inputs"))]
    return rows.where("fold is not null").select("fold", *arrays).mapInArrow(code, "fold binary, targets binary, codes binary")


@dataclass(frozen=True)
class CodedTree:
    """Nodes count from 1, those below n being 2n and 2n + 1. A row whose code of the node's input is above the node's cut goes to the second."""

    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray


def _chunks():
    """Functions for the tasks: blocks as (fold, targets, codes) arrays of CHUNK rows at most, and the nodes rows reach. Made here, so that tasks need no module of ours."""
    chunk = CHUNK

    def arrays(batches, targets: int, inputs: int, dtype):
        held, count = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            parts = []
            for column, kind, width in zip(batch.columns, (np.int32, np.float64, dtype), (1, targets, inputs)):
                ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
                parts.append(np.frombuffer(column.buffers()[2], np.uint8)[ends[0] : ends[-1]].view(kind).reshape(-1, width))
            held.append(parts)
            count += len(parts[0])
            if count >= chunk:
                yield from cut(held)
                held, count = [], 0
        if held:
            yield from cut(held)

    def cut(held):
        fold, y, codes = (np.concatenate(h) if len(h) > 1 else h[0] for h in zip(*held))
        for start in range(0, len(fold), chunk):
            some = slice(start, start + chunk)
            yield fold[some, 0], [np.ascontiguousarray(y[some, t]) for t in range(y.shape[1])], codes[some]

    def nodes(tree, codes, steps: int):
        feature, cut = tree
        at, row = np.ones(len(codes), np.intp), np.arange(len(codes)) * codes.shape[1]
        flat = codes.reshape(-1)
        for _ in range(steps):
            f = feature[at]
            below = 2 * at + (flat[row + np.maximum(f, 0)] > cut[at])
            at = np.where(f < 0, at, below)
        return at

    return arrays, nodes


SUMS = "tree int, node int, sums binary"
BEST = "tree int, node int, feature int, bin int, n double, total double, left_n double, left_total double, seen binary"


def grow(table: DataFrame, codes: Codes, targets: list[str], depth: int, leaf: int, gain: float) -> list[list[CodedTree]]:
    """Per target and fold a tree over the rows outside the fold. table is what coded gives.

    A node is split where the variance falls most, the first input and the lowest bin among equals, if it falls by `gain` and both sides have
    `leaf` rows. A split lies halfway between bins that hold rows to fit on.
    """
    folds, inputs, width, dtype = len(codes.bins), len(codes.edges), codes.width, codes.dtype
    size = 2 ** (depth + 1)
    trees = [CodedTree(np.full(size, -1), np.zeros(size, np.int64), np.zeros(size)) for _ in range(folds * len(targets))]
    seen: dict[int, np.ndarray] = {}
    arrays, nodes = _chunks()
    bins, many = [[b.astype(np.intp) for b in fold] for fold in codes.bins], len(targets)

    def level_sums(open_nodes: list[list[int]], step: int):
        grown = [(t.feature, t.cut) for t in trees]

        def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            slots, sums = [], []
            for wanted in open_nodes:
                slot = np.full(2 ** (step + 1), -1)
                slot[wanted] = np.arange(len(wanted))
                slots.append(slot)
                sums.append(np.zeros((inputs, 2, len(wanted) * width)))
            for fold, ys, code in arrays(batches, many, inputs, dtype):
                by_input = np.ascontiguousarray(code.T)
                for k, look_up in enumerate(bins):
                    grows = [t for t in range(many) if open_nodes[k * many + t]]
                    if not grows:
                        continue
                    outside = np.flatnonzero(fold != k)
                    there, own = code[outside], by_input.take(outside, 1)
                    taking = []
                    for t in grows:
                        tree = k * many + t
                        at = slots[tree][nodes(grown[tree], there, step)]
                        mine = np.flatnonzero(at >= 0)
                        weight = ys[t][outside[mine]]
                        if np.isnan(weight).any():
                            raise ValueError("a target to fit on is missing")
                        taking.append((sums[tree], None if len(mine) == len(at) else mine, at[mine] * width, weight))
                    for j in range(inputs):
                        every = look_up[j].take(own[j])
                        for total, mine, base, weight in taking:
                            spot = base + (every if mine is None else every.take(mine))
                            total[j, 0] += np.bincount(spot, minlength=total.shape[2])
                            total[j, 1] += np.bincount(spot, weight, total.shape[2])
            found = []
            for tree, wanted in enumerate(open_nodes):
                parts = sums[tree].reshape(inputs, 2, len(wanted), width)
                found += [(tree, node, parts[:, :, i].tobytes()) for i, node in enumerate(wanted) if parts[0, 0, i].any()]
            for start in range(0, len(found), 256):
                some = found[start : start + 256]
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in some], pa.int32()), pa.array([r[1] for r in some], pa.int32()), pa.array([r[2] for r in some], pa.binary())], ["tree", "node", "sums"])

        def best(key, parts):
            whole = np.zeros((inputs, 2, width))
            for part in parts.column("sums"):
                whole += np.frombuffer(part.as_buffer(), float).reshape(whole.shape)
            n, total = whole[0, 0].sum(), whole[0, 1].sum()
            left_n, left = whole[:, 0].cumsum(1)[:, :-1], whole[:, 1].cumsum(1)[:, :-1]
            right_n, right = n - left_n, total - left
            fine = (left_n >= max(leaf, 1)) & (right_n >= max(leaf, 1))
            with np.errstate(divide="ignore", invalid="ignore"):
                # about the node's mean, so that the digits of large sums do not cancel
                won = np.where(fine, (left - left_n * (total / n)) ** 2 / left_n + (right - right_n * (total / n)) ** 2 / right_n, -1.0) / n
            at = int(won.argmax()) if won.size else 0
            f, b = divmod(at, width - 1) if won.size else (-1, 0)
            if not won.size or won[f, b] < gain or won[f, b] <= 0:
                f, b, ln, ls = -1, 0, 0.0, 0.0
            else:
                ln, ls = left_n[f, b], left[f, b]
            row = [*(k.as_py() for k in key), f, b, n, total, ln, ls, (whole[:, 0] > 0).tobytes() if step == 0 else None]
            types = [pa.int32()] * 4 + [pa.float64()] * 4 + [pa.binary()]
            return pa.Table.from_arrays([pa.array([v], t) for v, t in zip(row, types)], ["tree", "node", "feature", "bin", "n", "total", "left_n", "left_total", "seen"])

        return table.mapInArrow(add_up, SUMS).groupBy("tree", "node").applyInArrow(best, BEST)

    open_nodes = [[1] for _ in trees]
    for step in range(depth):
        if not any(open_nodes):
            break
        following: list[list[int]] = [[] for _ in trees]
        for r in level_sums(open_nodes, step).collect():
            tree, node = trees[r["tree"]], r["node"]
            if step == 0:
                tree.value[1] = r["total"] / r["n"]
                seen[r["tree"]] = np.frombuffer(r["seen"], bool).reshape(inputs, width)
            if r["feature"] < 0:
                continue
            held = np.flatnonzero(seen[r["tree"]][r["feature"]])
            middle = (r["bin"] + held[held > r["bin"]][0]) / 2
            tree.feature[node], tree.cut[node] = r["feature"], np.flatnonzero(bins[r["tree"] // many][r["feature"]] <= middle)[-1]
            tree.value[2 * node] = r["left_total"] / r["left_n"]
            tree.value[2 * node + 1] = (r["total"] - r["left_total"]) / (r["n"] - r["left_n"])
            following[r["tree"]] += [2 * node, 2 * node + 1]
        if step == 0 and len(seen) < len(trees):
            raise ValueError("a fold leaves no rows to fit on")
        open_nodes = [sorted(f) for f in following]
    return [[trees[k * many + t] for k in range(folds)] for t in range(many)]


def scored_folds(table: DataFrame, codes: Codes, targets: list[str], fitted: list[list[CodedTree]], depth: int) -> DataFrame:
    """(target, fold, y_true, y_pred): every row by the trees that were grown without its fold, in one pass."""
    arrays, nodes = _chunks()
    many, inputs, dtype = len(targets), len(codes.edges), codes.dtype
    trees = [[((t.feature, t.cut), t.value) for t in per] for per in fitted]

    def guess(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for fold, ys, code in arrays(batches, many, inputs, dtype):
            told = [np.zeros(len(fold)) for _ in ys]
            for k in np.unique(fold):
                rows = np.flatnonzero(fold == k)
                there = code[rows]
                for t in range(many):
                    splits, values = trees[t][k]
                    told[t][rows] = values[nodes(splits, there, depth)]
            yield pa.RecordBatch.from_arrays([pa.array(a) for a in (fold, *ys, *told)], ["fold", *(f"y{t}" for t in range(many)), *(f"p{t}" for t in range(many))])

    shape = ", ".join(["fold int", *(f"y{t} double" for t in range(many)), *(f"p{t} double" for t in range(many))])
    sides = F.array(*[F.struct(F.lit(name).alias("target"), F.col(f"y{t}").alias("y_true"), F.col(f"p{t}").alias("y_pred")) for t, name in enumerate(targets)])
    return table.mapInArrow(guess, shape).select("fold", F.inline(sides))
