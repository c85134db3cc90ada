"""Fits: against closed forms and numpy, stored and loaded, and their queries against SQL that fits by itself."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import compare
from faremill.functions.basics import decimals
from faremill.operators import least_squares, models

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(900, 4)) * [1, 50, 0.01, 3] + [0, 1e5, 3, -2]
    y = x @ [2, -0.1, 40, 0.5] + rng.normal(size=900)
    data = [(int(k), "train" if k % 4 else "test", int(k % 3), *map(float, v), float(2 * v[0] - v[3]), 7.0, float(t)) for k, (v, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(data, "id long, split string, fold int, a double, b double, c double, d double, twin double, same double, y double").repartition(5)


INPUTS = ["a", "b", "c", "d", "twin", "same"]


def test_lines_from_product_sums_are_least_squares(rows):
    sums = least_squares.product_sums(rows, [*INPUTS, "y"], ["split", "fold"])
    train = rows.where("split = 'train' and fold != 1").toPandas()
    test = rows.where("split = 'test'").toPandas()
    line = least_squares.fit_line(sums, sums.total(lambda s, f: s == "train" and f != 1), INPUTS, "y")
    best, *_ = np.linalg.lstsq(np.column_stack([np.ones(len(train)), train[["a", "b", "c", "d"]]]), train["y"], rcond=None)
    assert np.allclose([line.base, *line.weights[:4]], best, rtol=1e-6) and not line.weights[4:].any()
    guess = best[0] + test[["a", "b", "c", "d"]].to_numpy() @ best[1:]
    told = least_squares.line_metrics(sums, sums.total(lambda s, f: s == "test"), line)
    assert told["n"] == len(test) and np.isclose(told["r2"], 1 - ((test["y"] - guess) ** 2).sum() / ((test["y"] - test["y"].mean()) ** 2).sum(), rtol=1e-9)
    assert np.isclose(told["rmse"], np.sqrt(((test["y"] - guess) ** 2).mean()), rtol=1e-9)
    shown = rows.where("split = 'test'").select("id", line.column().alias("p")).toPandas().set_index("id")["p"]
    assert np.allclose(shown[test["id"]].to_numpy(), guess, rtol=1e-9)


def test_folds_and_curve_reuse_the_sums(rows):
    sums = least_squares.product_sums(rows, [*INPUTS, "y"], ["split", "fold"])
    folds = least_squares.kfold_lines(sums, INPUTS, ("y",))
    assert [f[1] for f in folds] == [0, 1, 2] and sum(f[3] for f in folds) == 675 and all(f[5] > 0.9 for f in folds)
    curve = least_squares.learning_curve(least_squares.product_sums(rows.withColumn("slice", (F.col("id") % 10).cast("int")), [*INPUTS, "y"], ["fold", "slice"]), INPUTS, ("y",), 10)
    assert [c[1] for c in curve[:10]] == [k / 10 for k in range(1, 11)]
    assert all(a[3] < b[3] for a, b in zip(curve[:9], curve[1:10])) and abs(curve[9][7]) < 0.05


def test_a_tree_keeps_the_order_of_bins_and_rare_values(rows, spark):
    steps = spark.range(4096).select((F.col("id") % 1024).cast("double").alias("x"), (F.col("id") % 200 == 0).cast("double").alias("rare"), (F.col("id") % 1024 >= 512).cast("int").alias("up"))
    data = steps.withColumn("y", F.col("up") * 100.0 + F.col("rare") * 5000.0)
    model = models.fit_tree(data, ["x", "rare"], "y", depth=2, leaf=5, gain=0.1)
    assert models.scored_by(model, data, "y", []).where("abs(y_pred - y_true) > 45").count() == 0
    shown = model.stages[-1].toDebugString
    assert "feature 1 <= " in shown and " in {" not in shown
    edges = models.bin_edges(data, ["x", "rare"], 8)
    assert edges["rare"] == [1.0] and len(edges["x"]) == 8


def test_stored_models_check_their_inputs(rows, spark, tmp_path):
    model = models.fit_tree(rows, ["a", "d"], "y", depth=3, leaf=10)
    models.save_model(model, ["a", "d"], "y", 10.0, str(tmp_path / "m"))
    stored = models.load_model(spark, str(tmp_path / "m"))
    want = {r["id"]: r["y_pred"] / 10 for r in model.transform(rows).collect()}
    # columns in another order do no harm, as the stored stages name them
    got = stored.score(rows.select("d", "id", "a"), "guess")
    assert got.columns == ["d", "id", "a", "guess"] and {r["id"]: r["guess"] for r in got.collect()} == want
    with pytest.raises(ValueError, match="lacks"):
        stored.score(rows.drop("d"), "guess")
    models.save_model(model, ["d", "a"], "y", 10.0, str(tmp_path / "w"))
    with pytest.raises(ValueError, match="another order"):
        models.load_model(spark, str(tmp_path / "w")).score(rows, "guess")


# those that are ill-conditioned on the smallest tables run on the next ones
@pytest.mark.parametrize("name", ["kfold_fit_summary", "learning_curve"])
def test_fits_against_sql(spark, name):
    note, _, fine = compare.compare(spark, compare.duck(SF), name, entry.queries()[name], entry.oracle_sql()[name], SF)
    assert fine, note


def test_the_sql_notices_a_wrong_fit(spark, monkeypatch):
    fit = models.fit_linear
    monkeypatch.setattr(models, "fit_linear", lambda train, columns, target: fit(train, columns[:-1], target))
    note, _, fine = compare.compare(spark, compare.duck(SF), "fit_linear", entry.queries()["fit_linear"], entry.oracle_sql()["fit_linear"], SF)
    assert not fine


def test_lines_of_several_targets_share_a_pass(rows, monkeypatch):
    passes = []
    sums = models.product_sums
    monkeypatch.setattr(models, "product_sums", lambda *a, **k: passes.append(1) or sums(*a, **k))
    both = models.fit_linear(rows.withColumn("z", 3 * F.col("a") - F.col("d")), INPUTS, ["y", "z"])
    assert len(passes) == 1
    shown = [m.transform(rows).select("id", "y_pred").toPandas().set_index("id")["y_pred"] for m in both]
    plain = rows.toPandas().set_index("id")
    best, *_ = np.linalg.lstsq(np.column_stack([np.ones(len(plain)), plain[["a", "b", "c", "d"]]]), plain["y"], rcond=None)
    assert np.allclose(shown[0][plain.index], best[0] + plain[["a", "b", "c", "d"]].to_numpy() @ best[1:], rtol=1e-6)
    assert np.allclose(shown[1][plain.index], 3 * plain["a"] - plain["d"], atol=1e-6)


def test_folds_share_counts_and_bins(rows):
    dealt = rows.withColumns({"k": F.col("id") % 7, "whole": F.round(F.col("y") * 10)})
    folds = models.binned_folds(dealt, ["a", "d", "same"], 3, ["id", "k"], 8)
    keyed = dealt.withColumn("fold", models.key_hash(["id", "k"], 3))
    for k, fold in enumerate(folds):
        edges = models.bin_edges(keyed.where(F.col("fold") != k), ["a", "d", "same"], 8)
        want = models.PipelineModel(models._binning(["a", "d", "same"], edges)).transform(keyed)
        assert {r["id"]: r["features"] for r in fold.rows.collect()} == {r["id"]: r["features"] for r in want.select("id", "features").collect()}
    # whole targets make sums exact
    alone = models.fit_tree(keyed.where("fold != 1"), ["a", "d", "same"], "whole", depth=3, leaf=10, bins=8)
    shared = models.fit_tree(folds[1].where("fold != 1"), ["a", "d", "same"], "whole", depth=3, leaf=10)
    assert alone.stages[-1].toDebugString.split("\n")[1:] == shared.stages[-1].toDebugString.split("\n")[1:]


def test_decimals_round_as_round_does(spark):
    rng = np.random.default_rng(3)
    values = [0.5, -0.5, 1.0000005, -1.0000005, 2.5e-7, 5e-7, -5e-7, -1e-9, 0.0, 1e300, -1e300, 123456.7890125, 1e17 + 0.5, float("inf"), float("-inf"), float("nan"), None]
    values += [float(v) for v in rng.normal(size=2000) * 10.0 ** rng.integers(-9, 12, 2000)] + [k * 5e-7 for k in range(-500, 500)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for digits in (2, 4, 6):
        assert df.where(~F.round("v", digits).eqNullSafe(decimals(F.col("v"), digits))).count() == 0
        assert "-0.0" not in {str(r["x"]) for r in df.select(decimals(F.col("v"), digits).alias("x")).collect()}


def test_files_of_bins_hold_few_rows(rows, monkeypatch):
    monkeypatch.setattr(models, "FILE_ROWS", 100)
    made = models.binned(rows.coalesce(1), ["a", "d"], 8).rows
    files = made.groupBy(F.input_file_name()).count().collect()
    assert sum(f["count"] for f in files) == 900 and max(f["count"] for f in files) <= 100


def test_trees_of_folds_grow_together_as_alone(rows, monkeypatch):
    whole = rows.withColumns({"k": F.col("id") % 7, "few": F.col("id") % 5 * 1.5, "gap": F.when(F.col("id") % 11 == 0, 1e6).otherwise(F.col("id") % 2.0)})
    whole = whole.withColumns({"up": F.round(F.col("y") * 10), "down": F.round(F.col("few") * 100 - F.col("d") * 10 + F.col("id") % 3)})
    inputs, key, units = ["a", "b", "d", "few", "gap", "same"], ["id", "k"], {"up": 10.0, "down": 100.0}

    def fit(data, columns, target):
        return models.fit_tree(data, columns, target, depth=4, leaf=15)

    want = {}
    for target, unit in units.items():
        for r in models.kfold_fit(whole, inputs, target, fit, 3, key, unit).collect():
            want[target, r["fold"]] = (r["n"], r["r2"], r["rmse"], r["mae"])
    # a pass over the codes for each level, and none over the rows for a tree
    levels = []
    grow = models.coded_trees.grow
    monkeypatch.setattr(models.coded_trees, "grow", lambda *a: levels.append(a[3]) or grow(*a))
    monkeypatch.setattr(models, "_written_bins", None)
    monkeypatch.setattr(models.coded_trees, "CHUNK", 50)
    got = models.kfold_fit(whole, inputs, units, fit, 3, key, bins=models.binned_folds(whole, inputs, 3, key)).collect()
    assert levels == [4] and len(got) == len(want) == 6
    for r in got:
        n, *told = want[r["target"], r["fold"]]
        assert r["n"] == n and np.allclose([r["r2"], r["rmse"], r["mae"]], told, rtol=1e-9)


def test_values_counted_in_batches_are_those_counted_one_by_one(rows, spark, monkeypatch):
    from faremill.operators import quantiles

    odd = rows.selectExpr("fold", "a", "if(id % 9 = 0, null, id % 4 + 0D) as b", "if(id % 5 = 0, double('nan'), -0D) as c", "cast(null as double) as d")
    monkeypatch.setattr(quantiles, "COUNTED_ROWS", 70)
    want, got = quantiles.value_counts(odd, list("abcd"), ("fold",)), quantiles.value_counts_in_batches(odd, list("abcd"), "fold")
    assert got.schema.simpleString() == want.schema.simpleString()
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
