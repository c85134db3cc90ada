"""Queries: fitted models, their folds, curves and importances, each with SQL that fits the same model by itself."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from faremill.functions.basics import key_hash
from faremill.operators import features, least_squares, models, sampling
from faremill.operators.errors import metrics_by
from faremill.plans import inputs, model_sql
from faremill.plans.inputs import tidy
from faremill.plans.registry import query
from faremill.plans.sql import r, sql
from faremill.session import written_table
from faremill.sources.trips import concat_months
from faremill.sources.views import HASH_KEY, KEY

MODEL_COLUMNS = list(features.FEATURES)
TARGETS = features.TARGETS
# Trees count fares in whole cents and durations in whole seconds: sums of whole numbers are exact.
COUNTED = {"fare_amount": ("fare_cents", 100.0), "trip_duration": ("duration_seconds", 60.0)}


def model_data(spark: SparkSession, sf: str, kept=lambda data: data) -> DataFrame:
    """Model input with an 80/20 split and counted targets, written once because every fit reads it many times; `kept` may leave out rows no fit reads."""
    data = inputs.enriched(spark, sf).withColumn("split", sampling.hash_split(HASH_KEY))
    counted = {name: F.floor(F.col(t) * unit + 0.5).cast("double") for t, (name, unit) in COUNTED.items()}
    names = [*KEY, "split", *TARGETS, *counted, *MODEL_COLUMNS]
    return written_table(models.ready(kept(data), MODEL_COLUMNS).withColumns(counted).select(*names), "model-data")


def train_rows(data):
    """The rows to fit on, of a frame or of binned rows."""
    return data.where("split = 'train'")


def binned(data: DataFrame, fitted: str = "split = 'train'") -> models.Binned:
    """All rows in the bins of those to fit on, once for both targets."""
    return models.binned(data, MODEL_COLUMNS, _BINS, F.expr(fitted))


HASH = "(l_orderkey*7919 + l_partkey*104729 + l_linenumber*1709 + l_suppkey*31)"
_CELLS = ", ".join(f"floor(coalesce({c}, 0)::double * 1e6 + 0.5) / 1e6 as {c}" for c in MODEL_COLUMNS)
_DATA = f"""md as materialized (select row_number() over () as rid, {HASH} as h, {HASH} % 100 >= 20 as is_train, {_CELLS}, fare_amount::double as fare_amount, trip_duration::double as trip_duration,
floor(fare_amount * 100 + 0.5)::bigint as fare_cents, floor(trip_duration * 60 + 0.5)::bigint as duration_seconds from feat)"""
_SCORES = f"count(*) as n, {r('1 - sum((p - y) * (p - y)) / (var_pop(y) * count(*))', 'r2')}, {r('sqrt(avg((p - y) * (p - y)))', 'rmse')}, {r('avg(abs(p - y))', 'mae')}"
_VECTOR = f"[{', '.join(MODEL_COLUMNS)}]"


def _model_sql(body: str, *tables: str) -> str:
    return sql(f"with {', '.join([_DATA, *tables])} {body}", "feat")


def _scores(scored: DataFrame, by: list[str]) -> DataFrame:
    return metrics_by(scored, by).select(*by, "n", "r2", "rmse", "mae")


# Lines ------------------------------------------------------------------------------------------


@query(
    "fit_linear",
    _model_sql(
        f"""select 'linear' as model, target, case when is_train then 'train' else 'test' end as split, {_SCORES} from (select target, is_train,
  case target when 'fare_amount' then fare_amount else trip_duration end as y, base + list_inner_product(w, {_VECTOR}) as p from md, ls_line) group by target, is_train""",
        f"tr as (select 0 as g, {', '.join(MODEL_COLUMNS)}, fare_amount, trip_duration from md where is_train)", model_sql.least_squares("tr", MODEL_COLUMNS, list(TARGETS)),
    ),
)
def fit_linear(spark, sf):
    data = model_data(spark, sf)
    fitted = models.fit_linear(train_rows(data), MODEL_COLUMNS, list(TARGETS))
    scored = [models.scored_by(model, data, t, ["split"]).withColumn("target", F.lit(t)) for t, model in zip(TARGETS, fitted)]
    return tidy(_scores(concat_months(scored), ["target", "split"]).withColumn("model", F.lit("linear")))


_K = 5
_FOLD_LINES = (
    f"""tr as materialized (select f.g, {', '.join(MODEL_COLUMNS)}, fare_amount, trip_duration from md, (select unnest(range({_K + 1}))::int as g) f where is_train and h % {_K} <> f.g)""",
    model_sql.least_squares("tr", MODEL_COLUMNS, list(TARGETS)),
    f"""guess as materialized (select g, target, is_train, h % {_K} = g as held, case target when 'fare_amount' then fare_amount else trip_duration end as y, base + list_inner_product(w, {_VECTOR}) as p from md, ls_line),
sides as materialized (select g, target, is_train, held, count(*) as n, 1 - sum((p - y) * (p - y)) / (var_pop(y) * count(*)) as r2, sqrt(avg((p - y) * (p - y))) as rmse from guess group by all),
folds as (select a.target, a.g::int as fold, b.n as train_rows, a.n, b.r2 as train_r2, a.r2, a.rmse from sides a join sides b using (g, target) where a.is_train and a.held and b.is_train and not b.held)""",
)


def fold_sums(spark, sf) -> least_squares.ProductSums:
    data = inputs.enriched(spark, sf).withColumns({"split": sampling.hash_split(HASH_KEY), "fold": key_hash(HASH_KEY, _K)})
    return least_squares.product_sums(models.ready(data, MODEL_COLUMNS), [*MODEL_COLUMNS, *TARGETS], ["split", "fold"])


@query("kfold_fit", _model_sql(f"select target, fold, train_rows, n, {r('train_r2', 'train_r2')}, {r('r2', 'r2')}, {r('rmse', 'rmse')} from folds", *_FOLD_LINES))
def kfold_fit(spark, sf):
    """Lines on all features fitted without each of five folds of the training rows: one pass over the trips for all ten fits."""
    return tidy(spark.createDataFrame(least_squares.kfold_lines(fold_sums(spark, sf), MODEL_COLUMNS, TARGETS), least_squares.FOLDS))


@query(
    "kfold_fit_summary",
    _model_sql(
        f"""select target, folds, {r('m', 'mean_r2')}, {r('s', 'std_r2')}, {r('lo', 'min_r2')}, {r('hi', 'max_r2')}, {r('rm', 'mean_rmse')}, {r('s / abs(m) * 100', 'cov_pct', 4)}, {r('tr', 'mean_train_r2')}, {r('(tr - m) * 100', 'train_gap_pp', 4)},
{r('t.r2', 'test_r2')}, {r('(m - t.r2) * 100', 'test_gap_pp', 4)}, case when s / abs(m) < 0.01 then 'very stable' when s / abs(m) < 0.03 then 'stable' when s / abs(m) < 0.05 then 'moderate' else 'high variation' end as stability
from (select target, count(*) as folds, avg(r2) as m, stddev_pop(r2) as s, min(r2) as lo, max(r2) as hi, avg(rmse) as rm, avg(train_r2) as tr from folds group by 1) join (select target, r2 from sides where g = {_K} and not is_train) t using (target)""",
        *_FOLD_LINES,
    ),
)
def kfold_fit_summary(spark, sf):
    """Mean, spread and stability of the folds' R², its gap to the rows fitted on and to the test rows of the line over all training rows."""
    sums = fold_sums(spark, sf)
    folds = spark.createDataFrame(least_squares.kfold_lines(sums, MODEL_COLUMNS, TARGETS), least_squares.FOLDS)
    tests = spark.createDataFrame(least_squares.test_lines(sums, MODEL_COLUMNS, TARGETS), "target string, test_r2 double")
    return tidy(sampling.fold_summary(folds).join(tests, "target").withColumn("test_gap_pp", (F.col("mean_r2") - F.col("test_r2")) * 100.0), cov_pct=4, train_gap_pp=4, test_gap_pp=4)


_STEPS, _FOLDS = 10, 3


@query(
    "learning_curve",
    _model_sql(
        f"""select target, {r('fraction', 'fraction')}, fold, train_rows, valid_rows, {r('train_r2', 'train_r2')}, {r('valid_r2', 'valid_r2')}, {r('train_r2 - valid_r2', 'gap')},
case when avg(train_r2 - valid_r2) filter (step = {_STEPS}) over (partition by target) < avg(train_r2 - valid_r2) filter (step = 1) over (partition by target) then 'narrowing' else 'widening' end as gap_trend from curve""",
        f"""sets as (select unnest(range({_STEPS * _FOLDS}))::int as g),
tr as materialized (select g, {', '.join(MODEL_COLUMNS)}, fare_amount, trip_duration from md, sets where is_train and h % {_FOLDS} <> g % {_FOLDS} and h % 1000 // 100 <= g // {_FOLDS})""",
        model_sql.least_squares("tr", MODEL_COLUMNS, list(TARGETS)),
        f"""guess as (select g, target, h % {_FOLDS} = g % {_FOLDS} as held, case target when 'fare_amount' then fare_amount else trip_duration end as y, base + list_inner_product(w, {_VECTOR}) as p from md, ls_line
  where is_train and (h % {_FOLDS} = g % {_FOLDS} or h % 1000 // 100 <= g // {_FOLDS})),
sides as materialized (select g, target, held, count(*) as n, 1 - sum((p - y) * (p - y)) / (var_pop(y) * count(*)) as r2 from guess group by all),
curve as (select target, a.g // {_FOLDS} + 1 as step, (a.g // {_FOLDS} + 1) / {_STEPS}.0::double as fraction, (a.g % {_FOLDS})::int as fold, b.n as train_rows, a.n as valid_rows, b.r2 as train_r2, a.r2 as valid_r2
  from sides a join sides b using (g, target) where a.held and not b.held)""",
    ),
)
def learning_curve(spark, sf):
    """Lines on all features over growing shares of the training rows, in three folds: sixty fits from one pass over the trips."""
    data = inputs.enriched(spark, sf).withColumns({"split": sampling.hash_split(HASH_KEY), "fold": key_hash(HASH_KEY, _FOLDS), "slice": F.floor(key_hash(HASH_KEY, 1000) * _STEPS / 1000).cast("int")})
    sums = least_squares.product_sums(models.ready(train_rows(data), MODEL_COLUMNS), [*MODEL_COLUMNS, *TARGETS], ["fold", "slice"])
    curve = spark.createDataFrame(least_squares.learning_curve(sums, MODEL_COLUMNS, TARGETS, _STEPS), least_squares.CURVE)
    by_target = Window.partitionBy("target")
    last, first = (F.avg(F.when(F.round(F.col("fraction") * _STEPS) == k, F.col("gap"))).over(by_target) for k in (_STEPS, 1))
    return tidy(curve.withColumn("gap_trend", F.when(last < first, "narrowing").otherwise("widening")))


# Trees ------------------------------------------------------------------------------------------

_BINS, _DEPTH, _LEAF = 32, 8, 100
# a thousandth of a squared dollar, of a squared minute
_GAIN = {t: 0.001 * unit * unit for t, (_, unit) in COUNTED.items()}


def _tree(data: models.Binned, target: str):
    return models.fit_tree(train_rows(data), MODEL_COLUMNS, COUNTED[target][0], depth=_DEPTH, leaf=_LEAF, gain=_GAIN[target], bins=_BINS)


def _trees_sql() -> list[str]:
    out = [model_sql.binned("md", MODEL_COLUMNS, _BINS)]
    for t, (name, _) in COUNTED.items():
        out += [f"y_{name} as materialized (select rid, is_train, {name} as y from md)", model_sql.tree(f"t_{name}", f"y_{name}", _DEPTH, _LEAF, _GAIN[t])]
    return out


@query(
    "fit_tree",
    _model_sql(
        " union all ".join(
            f"select 'tree' as model, '{t}' as target, case when is_train then 'train' else 'test' end as split, {_SCORES} from (select is_train, {name} / {unit}::double as y, p / {unit}::double as p from md join t_{name}_fit using (rid)) group by is_train"
            for t, (name, unit) in COUNTED.items()
        ),
        *_trees_sql(),
    ),
)
def fit_tree(spark, sf):
    data = binned(model_data(spark, sf))
    scored = [models.scored_by(models.on_bins(_tree(data, t)), data.rows, name, ["split"], unit).withColumn("target", F.lit(t)) for t, (name, unit) in COUNTED.items()]
    return tidy(_scores(concat_months(scored), ["target", "split"]).withColumn("model", F.lit("tree")))


_NAMES = ", ".join(f"({k}, '{c}')" for k, c in enumerate(MODEL_COLUMNS))


@query(
    "tree_importance",
    _model_sql(
        " union all ".join(
            f"select '{t}' as target, feature, {r('coalesce(v / sum(v) over (), 0)', 'importance')} from (values {_NAMES}) c(f, feature) left join (select f, sum(gain * n) as v from t_{name}_splits group by f) using (f)"
            for t, (name, _) in COUNTED.items()
        ),
        *_trees_sql(),
    ),
)
def tree_importance(spark, sf):
    """Each feature's share of the gain of the fitted trees."""
    data = binned(train_rows(model_data(spark, sf)))
    return tidy(concat_months([models.tree_importance(_tree(data, t), MODEL_COLUMNS, t) for t in TARGETS]))


@query("kfold_trees")
def kfold_trees(spark, sf):
    """Trees of both targets fitted without each fold, grown together, and scored in one job."""
    data = model_data(spark, sf, train_rows)
    folds = models.binned_folds(data, MODEL_COLUMNS, _K, HASH_KEY, _BINS)

    def fit(parts, columns, targets):
        return models.fit_tree(parts, columns, targets, depth=_DEPTH, leaf=_LEAF, bins=_BINS)

    found = models.kfold_fit(data, MODEL_COLUMNS, dict(COUNTED.values()), fit, _K, HASH_KEY, bins=folds)
    names = F.create_map(*[F.lit(x) for t, (name, _) in COUNTED.items() for x in (name, t)])
    return tidy(found.withColumn("target", F.element_at(names, F.col("target"))))


# Boosting ---------------------------------------------------------------------------------------

_ROUNDS, _SHALLOW, _RATE = 4, 3, 0.3


def _boosting_sql() -> tuple[list[str], str]:
    tables, body = [model_sql.binned("md", MODEL_COLUMNS, _BINS)], []
    for t, (name, unit) in COUNTED.items():
        tables.append(f"b_{name}_0 as materialized (select rid, is_train, {name}::double as truth, 0::double as p, {name}::double as y from md)")
        for m in range(_ROUNDS):
            tables.append(model_sql.tree(f"g_{name}_{m}", f"b_{name}_{m}", _SHALLOW, _LEAF, 1e-9))
            step = f"p_.p + {_RATE if m else 1.0}::double * f_.p"
            tables.append(f"b_{name}_{m + 1} as materialized (select rid, is_train, truth, {step} as p, 2 * (truth - ({step})) as y from b_{name}_{m} p_ join g_{name}_{m}_fit f_ using (rid))")
            body.append(
                f"select '{t}' as target, {m + 1}::int as round, sqrt(avg((p - truth) * (p - truth)) filter (is_train)) / {unit}::double as train_rmse, sqrt(avg((p - truth) * (p - truth)) filter (not is_train)) / {unit}::double as valid_rmse from b_{name}_{m + 1}"
            )
    return tables, " union all ".join(body)


_BOOST_TABLES, _BOOST_BODY = _boosting_sql()


@query(
    "boosting_rounds",
    _model_sql(
        f"select target, round, {r('train_rmse', 'train_rmse')}, {r('valid_rmse', 'valid_rmse')}, row_number() over (partition by target order by round(valid_rmse, 9), round) = 1 as is_best from ({_BOOST_BODY})", *_BOOST_TABLES
    ),
)
def boosting_rounds(spark, sf):
    """RMSE of boosted trees after each round on the rows fitted on and on the others, and which round was best."""
    data, rows = binned(model_data(spark, sf)), []
    for t, (name, unit) in COUNTED.items():
        model = models.fit_gbt(train_rows(data), MODEL_COLUMNS, name, None, rounds=_ROUNDS, depth=_SHALLOW, rate=_RATE, rows=1.0, share="all", leaf=_LEAF, gain=1e-9, bins=_BINS)
        sides = {"train": train_rows(data).rows, "valid": data.where("split = 'test'").rows}
        rows += [(t, k, e["train"] / unit, e["valid"] / unit) for k, e in models.round_errors(models.on_bins(model), sides, name)]
    out = spark.createDataFrame(rows, "target string, round int, train_rmse double, valid_rmse double")
    best = F.row_number().over(Window.partitionBy("target").orderBy(F.round("valid_rmse", 9), "round")) == 1
    return tidy(out.withColumn("is_best", best))


@query("fit_gbt")
def fit_gbt(spark, sf):
    """Up to a hundred boosted trees per target, stopped by a tenth of the training rows, with the rounds that were kept."""
    held = model_data(spark, sf).withColumn("is_validation", key_hash(HASH_KEY[::-1], 10) == 0)
    data, parts = binned(held, "split = 'train' and not is_validation"), []
    for t, (name, unit) in COUNTED.items():
        model = models.fit_gbt(train_rows(data), MODEL_COLUMNS, name)
        parts.append(models.scored_by(models.on_bins(model), data.rows, name, ["split"], unit).withColumns({"target": F.lit(t), "rounds": F.lit(model.stages[-1].getNumTrees)}))
    return tidy(_scores(concat_months(parts), ["target", "split", "rounds"]).withColumn("model", F.lit("boosted trees")))
