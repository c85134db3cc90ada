"""Every registered query against its SQL on the smallest tables; those without SQL must give rows."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import compare
from faremill.operators import models

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()
# queries that fit many models, and those of the text operators, whose own tests use small tables
SLOW = {"learning_curve", "kfold_fit_summary", "kfold_trees", "fit_gbt", "batch_score", "pipeline"} | {n for n in entry.queries() if re.match(r"op\d+_", n)}


@pytest.fixture(scope="module")
def con(sf):
    return compare.duck(sf)


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in SLOW])
def test_query_matches_sql(spark, sf, con, name):
    note, _, fine = compare.compare(spark, con, name, QUERIES[name], ORACLES.get(name), sf)
    assert fine, note


def test_entry_gives_rows(spark):
    assert entry.entry(spark).count() == 13


def test_every_sql_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_linear_fit_is_least_squares(spark):
    rows = spark.range(500).select((F.col("id") % 37).cast("double").alias("x"), (F.col("id") % 11 * 3.0).alias("z"), (F.col("id") % 37 * 2.5 + F.col("id") % 5).alias("y"))
    model = models.fit_linear(rows, ["x"], "y")
    slope, base = rows.agg(F.regr_slope("y", "x"), F.regr_intercept("y", "x")).first()
    got = model.transform(rows).select("x", "y_pred").collect()
    assert np.allclose([r["y_pred"] for r in got], [base + slope * r["x"] for r in got], atol=1e-6)


def test_folds_of_a_fitted_model(spark):
    rows = spark.range(600).select("id", F.col("id").alias("one"), (F.col("id") % 20).cast("double").alias("x"), (F.col("id") % 20 * 2.0).alias("y"))
    folds = models.kfold_fit(rows, ["x"], "y", models.fit_linear, folds=3, key=["id", "one"]).collect()
    assert sorted(f["fold"] for f in folds) == [0, 1, 2] and sum(f["n"] for f in folds) == 600 and all(f["r2"] > 0.999 for f in folds)


def test_batch_score_answers_every_request(spark, sf):
    scored = QUERIES["batch_score"](spark, sf)
    requests = spark.read.parquet(f"{sf}/events.parquet").count()
    assert scored.count() == requests
    assert scored.where("duration_minutes is null or fare_usd is null or PULocationID is null").count() == 0
