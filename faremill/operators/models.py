"""Standardisation, regressors and model comparison on spark.ml."""

from __future__ import annotations

import json
import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.feature import Bucketizer, SQLTransformer, VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from faremill.functions.basics import clip, key_hash
from faremill.operators import coded_trees
from faremill.operators.errors import metrics_by
from faremill.operators.least_squares import fit_line, product_sums
from faremill.operators.quality import finite_or_zero
from faremill.operators.quantiles import attach_row, quantiles_of, value_counts, value_counts_in_batches
from faremill.session import written_table


def standardize(features: DataFrame, columns: list[str], split: str = "split", population: bool = True, bound: float = 10.0) -> DataFrame:
    """Scale every split with mean and deviation of the training rows.

    Missing and non-finite values are zero before and after scaling, a zero deviation counts as one,
    and the result is held within the bound.
    """
    filled = features.withColumns({c: finite_or_zero(F.col(c).cast("double")) for c in columns})
    deviation = F.stddev_pop if population else F.stddev_samp
    stats = filled.where(F.col(split) == "train").agg(
        *[F.avg(c).alias(f"{c}_m") for c in columns],
        *[F.coalesce(F.nullif(deviation(c), F.lit(0.0)), F.lit(1.0)).alias(f"{c}_s") for c in columns],
    )
    scaled = {c: clip(finite_or_zero((F.col(c) - F.col(f"st.{c}_m")) / F.col(f"st.{c}_s")), -bound, bound) for c in columns}
    return attach_row(filled, stats, "st").withColumns(scaled).drop("st")


def moments_by(features: DataFrame, columns: list[str], by: str) -> DataFrame:
    """(part, column_name, n, mean, m2) rows, a part for each value of `by`: count, mean and centred squares of every column per group, as a table that can be kept.

    Missing and non-finite values count as zero, as in standardize.
    """
    filled = features.select(F.col(by).alias("part"), *[finite_or_zero(F.col(c).cast("double")).alias(c) for c in columns])
    wide = filled.groupBy("part").agg(F.count("*").alias("n"), *[F.struct(F.avg(c).alias("mean"), F.var_pop(c).alias("var")).alias(c) for c in columns])
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"{c}.mean").alias("mean"), (F.col(f"{c}.var") * F.col("n")).alias("m2")) for c in columns])
    return wide.select("part", "n", F.inline(rows))


def merge_moments(moments: DataFrame) -> DataFrame:
    """(column_name, n, mean, m2) of all groups together, centred about the common mean; neither their order nor their number matters."""
    total = moments.groupBy("column_name").agg(F.sum("n").alias("n"), (F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("centre"))
    shifted = moments.join(F.broadcast(total.select("column_name", "centre")), "column_name")
    gap = F.col("mean") - F.col("centre")
    return shifted.groupBy("column_name").agg(F.sum("n").alias("n"), F.first("centre").alias("mean"), F.sum(F.col("m2") + F.col("n") * gap * gap).alias("m2"))


def standardize_by(features: DataFrame, columns: list[str], moments: DataFrame, population: bool = True, bound: float = 10.0) -> DataFrame:
    """As standardize, with merged moments instead of a pass over the training rows. A spread within a mean's last bits counts as none."""
    spread = F.sqrt(F.col("m2") / (F.col("n") if population else F.col("n") - 1))
    spread = F.when(spread > F.abs("mean") * 1e-12, spread)
    one = moments.select("column_name", "mean", F.coalesce(spread, F.lit(1.0)).alias("spread"))
    row = one.agg(*[F.max(F.when(F.col("column_name") == c, F.struct("mean", "spread"))).alias(c) for c in columns])
    filled = {c: finite_or_zero(F.col(c).cast("double")) for c in columns}
    return attach_row(features, row, "st").withColumns({c: clip(finite_or_zero((filled[c] - F.col(f"st.{c}.mean")) / F.col(f"st.{c}.spread")), -bound, bound) for c in columns}).drop("st")


def _assembler(columns: list[str], into: str = "features") -> VectorAssembler:
    return VectorAssembler(inputCols=columns, outputCol=into, handleInvalid="keep")


def ready(df: DataFrame, columns: list[str]) -> DataFrame:
    """Model input: every column a finite double of six decimals, so that no split hangs on the last bit of a sine."""
    return df.withColumns({c: F.floor(finite_or_zero(F.col(c).cast("double")) * 1e6 + 0.5).cast("double") / 1e6 for c in columns})


def fit_linear(train: DataFrame, columns: list[str], target: str | list[str]) -> PipelineModel | list[PipelineModel]:
    """Least squares on all inputs from one pass over the rows, however many targets. A constant input, or one that depends on those before it, weighs nothing.

    A list of targets gives a model for each.
    """
    names = [target] if isinstance(target, str) else list(target)
    sums = product_sums(train, [*columns, *names])
    lines = [fit_line(sums, sums.total(), columns, name) for name in names]
    # Spark's way to write an expression as a stage: each term a column of the input times its weight
    terms = [[f"{line.base!r}D", *(f"`{c}` * {float(w)!r}D" for c, w in zip(line.inputs, line.weights))] for line in lines]
    fitted = [PipelineModel([SQLTransformer(statement=f"SELECT *, {' + '.join(t)} AS y_pred FROM __THIS__")]) for t in terms]
    return fitted[0] if isinstance(target, str) else fitted


def bin_edges(train: DataFrame, columns: list[str], bins: int) -> dict[str, list[float]]:
    """Where each column's bins begin: its distinct exact quantiles of `bins` levels above the smallest value, the greatest included.

    At most `bins` numbers a column reach the driver. A value's bin is the number of edges it reaches, so that every value of a column
    with few of them, a flag's rare 1 too, is a bin of its own.
    """
    return edges_of(written_table(value_counts(train, columns), "value-counts"), columns, bins)[()]


def edges_of(counts: DataFrame, columns: list[str], bins: int, by: tuple[str, ...] = ()) -> dict[tuple, dict[str, list[float]]]:
    """As bin_edges, per group of written value_counts. Groups are few."""
    lowest = {tuple(r)[:-1]: r["low"] for r in counts.groupBy(*by, "metric").agg(F.min("value").alias("low")).collect()}
    found: dict[tuple, set] = {}
    for r in quantiles_of(counts, [k / bins for k in range(1, bins + 1)], by).select(*by, "metric", "value").distinct().collect():
        found.setdefault(tuple(r)[:-1], set()).add(math.floor(r["value"] * 1e6 + 0.5) / 1e6)

    def edges(at: tuple) -> list[float]:
        low = lowest.get(at)
        return sorted(v for v in found.get(at, ()) if v > low) or [low or 0.0]

    return {group: {c: edges((*group, c)) for c in columns} for group in ({at[:-1] for at in lowest} if by else {()})}


RANK = "_rank"


def _binning(columns: list[str], edges: dict[str, list[float]]) -> list:
    outputs = [f"{c}_bin" for c in columns]
    splits = [[-math.inf, *edges[c], math.inf] for c in columns]
    # a bucket comes as a category; a sum with it is a number again, so that trees keep the bins' order
    ranks = SQLTransformer(statement=f"SELECT *, {', '.join(f'`{c}_bin` + 0D AS `{c}{RANK}`' for c in columns)} FROM __THIS__")
    return [Bucketizer(inputCols=columns, outputCols=outputs, splitsArray=splits, handleInvalid="keep"), ranks, _assembler([f"{c}{RANK}" for c in columns])]


@dataclass(frozen=True)
class Binned:
    """Rows with their bins as one vector, written once for all fits and scores that share them, and the stages that made the vector."""

    stages: list
    rows: DataFrame

    def where(self, condition) -> Binned:
        return Binned(self.stages, self.rows.where(condition))

    def pipeline(self, model) -> PipelineModel:
        """The model behind the stages, for rows that have no bins yet."""
        return PipelineModel([*self.stages, model])


# Rows of a file of bins. A task of a fit keeps its rows' bins in memory, about 300 bytes each with 56 inputs, where the file has 40.
FILE_ROWS = 250_000


def _written_bins(data: DataFrame, columns: list[str], edges: dict[str, list[float]]) -> Binned:
    stages = _binning(columns, edges)
    out = PipelineModel(stages).transform(data)
    return Binned(stages, written_table(out.select(*[c for c in data.columns if c not in columns], "features"), "binned", FILE_ROWS))


def binned(data: DataFrame, columns: list[str], bins: int = 32, fitted: Column | None = None) -> Binned:
    """All rows of data in the bins of the rows to fit on (by default all), beside the columns that are no inputs."""
    return _written_bins(data, columns, bin_edges(data if fitted is None else data.where(fitted), columns, bins))


class Folds(Sequence):
    """Rows dealt to folds, and per fold the edges of the rows outside it. An item is all rows in a fold's bins, written when it is first asked for."""

    def __init__(self, rows: DataFrame, columns: list[str], edges: list[dict[str, list[float]]]):
        self.rows, self.columns, self.edges = rows, columns, edges
        self.codes = coded_trees.Codes.of(edges, columns)
        self._written: dict = {}

    def __len__(self) -> int:
        return len(self.edges)

    def __getitem__(self, fold: int) -> Binned:
        if not 0 <= fold < len(self):
            raise IndexError(fold)
        if fold not in self._written:
            self._written[fold] = _written_bins(self.rows, self.columns, self.edges[fold])
        return self._written[fold]

    def coded(self, targets: list[str]) -> DataFrame:
        """Fold, targets and the inputs' codes of all rows, written once for all folds."""
        key = tuple(targets)
        if key not in self._written:
            self._written[key] = written_table(coded_trees.coded(self.rows, self.columns, targets, self.codes), "codes")
        return self._written[key]


def binned_folds(data: DataFrame, columns: list[str], folds: int, key: list[str], bins: int = 32) -> Folds:
    """Per fold all rows, with their fold, in the bins of the rows outside it. Values are counted once for all folds."""
    dealt = data.withColumn("fold", key_hash(list(key), folds))
    counts = written_table(value_counts_in_batches(dealt, columns, "fold"), "value-counts")
    others = F.explode(F.array(*[F.lit(k) for k in range(folds)])).alias("left_out")
    outside = counts.select("*", others).where("fold <> left_out").groupBy("left_out", "metric", "value").agg(F.sum("copies").alias("copies"))
    edges = edges_of(written_table(outside, "value-counts"), columns, bins, ("left_out",))
    nothing = {c: [0.0] for c in columns}
    return Folds(dealt, columns, [edges.get((k,), nothing) for k in range(folds)])


def on_bins(model: PipelineModel) -> PipelineModel:
    """The model alone, for rows that have their bins."""
    return PipelineModel(model.stages[-1:])


# Above any number of bins, so that every bin's border is a candidate; Spark looks for candidates on a sample of this size squared.
MAX_BINS = 512


def fit_tree(
    train: DataFrame | Binned | Folds, columns: list[str], target: str | list[str], depth: int = 8, leaf: int = 100, gain: float = 0.001, bins: int = 32
) -> PipelineModel | FoldTrees:
    """A regression tree over exact quantile bins. With a whole-number target its sums are exact, so that the same rows, dealt in any way,
    give the same tree; `gain` is in the target's unit squared. Rows that have their bins are fitted on as they are.

    Folds with a list of targets give a tree for each fold, over the rows outside it, and target: all of them are grown together.
    """
    if isinstance(train, Folds):
        return FoldTrees(train, target, depth, coded_trees.grow(train.coded(target), train.codes, target, depth, leaf, gain))
    train = train if isinstance(train, Binned) else binned(train, columns, bins)
    tree = DecisionTreeRegressor(
        featuresCol="features", labelCol=target, predictionCol="y_pred", maxDepth=depth, minInstancesPerNode=leaf, minInfoGain=gain, maxBins=MAX_BINS, seed=42
    )
    return train.pipeline(tree.fit(train.rows))


@dataclass(frozen=True)
class FoldTrees:
    """Trees per target and fold, grown without the fold's rows."""

    folds: Folds
    targets: list[str]
    depth: int
    trees: list[list[coded_trees.CodedTree]]

    def scored(self) -> DataFrame:
        """(fold, target, y_true, y_pred): every row by the trees that were grown without its fold."""
        return coded_trees.scored_folds(self.folds.coded(self.targets), self.folds.codes, self.targets, self.trees, self.depth)


def fit_gbt(
    data: DataFrame | Binned, columns: list[str], target: str, validation: str | None = "is_validation", rounds: int = 100, depth: int = 6, rate: float = 0.1,
    rows: float = 0.9, share: str = "0.9", leaf: int = 100, gain: float = 0.0, bins: int = 32,
) -> PipelineModel:
    """Boosted trees over exact quantile bins. With a validation column they stop once its rows no longer improve. Rows that have their bins are fitted on as they are."""
    trees = GBTRegressor(
        featuresCol="features", labelCol=target, predictionCol="y_pred", maxIter=rounds, maxDepth=depth, stepSize=rate, subsamplingRate=rows,
        minInstancesPerNode=leaf, minInfoGain=gain, featureSubsetStrategy=share, maxBins=MAX_BINS, seed=42,
    )
    if validation:
        trees = trees.setValidationIndicatorCol(validation)
    if not isinstance(data, Binned):
        data = binned(data, columns, bins, ~F.col(validation) if validation else None)
    return data.pipeline(trees.fit(data.rows))


def round_errors(model: PipelineModel, sides: dict[str, DataFrame], target: str) -> list[tuple[int, dict[str, float]]]:
    """(round, RMSE per side) of boosted trees after each of their rounds."""
    found = {}
    for side, df in sides.items():
        for stage in model.stages[:-1]:
            df = stage.transform(df)
        found[side] = [math.sqrt(x) for x in model.stages[-1].evaluateEachIteration(df.select("features", target), "squared")]
    return [(k + 1, {side: v[k] for side, v in found.items()}) for k in range(len(next(iter(found.values()))))]


def scored_by(model: PipelineModel, df: DataFrame, target: str, keep: list[str], unit: float = 1.0) -> DataFrame:
    """Truth and prediction, divided by the unit the target was counted in."""
    return model.transform(df).select(*keep, (F.col(target) / unit).alias("y_true"), (F.col("y_pred") / unit).alias("y_pred"))


def tree_importance(model: PipelineModel, columns: list[str], target: str) -> DataFrame:
    """(target, feature, importance) of a fitted tree model: one row per input column."""
    values = model.stages[-1].featureImportances.toArray().tolist()
    rows = [(target, c, float(v)) for c, v in zip(columns, values)]
    return SparkSession.active().createDataFrame(rows, "target string, feature string, importance double")


def vector_names(df: DataFrame, vector: str = "features") -> list[str]:
    """The names of a vector column's places, from its ML attributes."""
    attributes = df.schema[vector].metadata["ml_attr"]["attrs"]
    return [a["name"] for a in sorted((a for kind in attributes.values() for a in kind), key=lambda a: a["idx"])]


# Changes whenever a written model's stages or card do.
STORED_FORMAT = "ranks-1"


def save_model(model: PipelineModel, columns: list[str], target: str, unit: float, path: str) -> None:
    """Write a fitted pipeline and beside it the order of its inputs, its target and the unit that is counted in."""
    spark = SparkSession.active()
    model.write().overwrite().save(f"{path}/pipeline")
    card = json.dumps({"inputs": columns, "target": target, "unit": unit})
    spark.createDataFrame([(card,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/card")


@dataclass(frozen=True)
class StoredModel:
    """A pipeline as it was written, with its card."""

    pipeline: PipelineModel
    inputs: list[str]
    target: str
    unit: float

    def score(self, df: DataFrame, into: str) -> DataFrame:
        """df with the prediction in column `into`. The vector the model gets must hold the inputs in the order it was fitted with."""
        missing = [c for c in self.inputs if c not in df.columns]
        if missing:
            raise ValueError(f"the model for {self.target} lacks its inputs {missing}")
        out = self.pipeline.transform(df)
        names = [n.removesuffix(RANK) for n in vector_names(out)]
        if names != self.inputs:
            raise ValueError(f"the model for {self.target} was fitted on other inputs, or in another order, than {names}")
        return out.select(*df.columns, (F.col("y_pred") / self.unit).alias(into))


def load_model(spark: SparkSession, path: str) -> StoredModel:
    card = json.loads(spark.read.text(f"{path}/card").first()["value"])
    return StoredModel(PipelineModel.load(f"{path}/pipeline"), card["inputs"], card["target"], card["unit"])


def leaderboard(scored: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Metrics per group and model rounded and placed by RMSE, with wins over R² and MAE; one row per model reaches the windows."""
    per = metrics_by(scored, [*by, "model"]).select(*by, "model", "n", *[F.round(c, 4).alias(c) for c in ("rmse", "mae", "r2")])
    group = Window.partitionBy(*by)
    return per.select(
        "*", F.row_number().over(group.orderBy("rmse", "model")).alias("place"),
        (
            (F.row_number().over(group.orderBy(F.desc("r2"), "model")) == 1).cast("int") + (F.row_number().over(group.orderBy("mae", "model")) == 1).cast("int")
        ).alias("wins"),
    )


def kfold_fit(
    data: DataFrame, columns: list[str], target: str | dict[str, float], fit, folds: int = 5, key: list[str] = (), unit: float = 1.0, workers: int = 4,
    bins: Sequence[Binned] | None = None,
) -> DataFrame:
    """(fold, n, r2, rmse, mae) of any model fitted on the other folds. Fits run side by side; all folds are scored in one job.

    data is read folds times, so it should be a written table. With `bins` (binned_folds of data) trees are fitted and scored on these.
    Several targets, with the unit of each, need bins: `fit` gets all folds and targets at once, as fit_tree takes them, and the rows have the target.
    """
    if isinstance(target, dict):
        scored = fit(bins, columns, list(target)).scored()
        units = F.element_at(F.create_map(*[F.lit(x) for pair in target.items() for x in pair]), F.col("target"))
        counted = scored.withColumns({c: F.col(c) / units for c in ("y_true", "y_pred")})
        return metrics_by(counted, ["target", "fold"]).select("fold", "n", "r2", "rmse", "mae", "target")
    dealt = data.withColumn("fold", key_hash(list(key), folds))

    def one(fold: int) -> PipelineModel:
        outside = F.col("fold") != fold
        return on_bins(fit(bins[fold].where(outside), columns, target)) if bins else fit(dealt.where(outside), columns, target)

    with ThreadPool(min(workers, folds)) as pool:
        fitted = pool.map(inheritable_thread_target(data.sparkSession)(one), range(folds))
    parts = [scored_by(model, (bins[fold].rows if bins else dealt).where(F.col("fold") == fold), target, ["fold"], unit) for fold, model in enumerate(fitted)]
    return metrics_by(reduce(DataFrame.unionByName, parts), ["fold"]).select("fold", "n", "r2", "rmse", "mae")
