"""The forest as a table of nodes, walked by DuckDB, and least squares from mergeable sums."""

from __future__ import annotations

import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from chartlens.operators import forest, linear, model
from chartlens.plans import questions as Q
from chartlens.plans import registry
from chartlens.plans.registry import charts_of
from chartlens.schema import FOREST_DEPTH, FOREST_TREES, MODEL_FEATURES
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def fitted(spark):
    data = Q.assembled_data(charts_of(spark, SF_SMALL))
    fit, predicted = Q.q5_forest(None, data)
    return data, fit, predicted, forest.forest_nodes(fit).cache()


def test_duckdb_walks_the_trees(fitted):
    """Predictions by recursive SQL over the node table, row by row."""
    _, _, predicted, nodes = fitted
    con = duckdb.connect()
    con.register("nodes", nodes.toPandas())
    rows = predicted.select("track_id", "region", "prediction", *[F.col(f).cast("double").alias(f) for f in MODEL_FEATURES]).toPandas()
    con.register("splitted", rows)
    values = ", ".join(f'"{f}"' for f in MODEL_FEATURES)
    got = con.execute(f"""
        WITH RECURSIVE x AS (SELECT track_id, region, prediction AS said, [{values}] AS v FROM splitted),
        walk AS (
          SELECT x.track_id, x.region, x.said, x.v, n.tree, n.node, n.feature, n.threshold, n."left", n."right", n.prediction
          FROM x, nodes n WHERE n.node = 0
          UNION ALL
          SELECT w.track_id, w.region, w.said, w.v, n.tree, n.node, n.feature, n.threshold, n."left", n."right", n.prediction
          FROM walk w JOIN nodes n ON n.tree = w.tree
           AND n.node = CASE WHEN w.v[w.feature::INT + 1] <= w.threshold THEN w."left" ELSE w."right" END
          WHERE w.feature IS NOT NULL)
        SELECT track_id, region, any_value(said), avg(prediction), count(*) FROM walk WHERE feature IS NULL GROUP BY 1, 2""").fetchall()
    assert len(got) == len(rows) > 0
    for _, _, said, walked, trees in got:
        assert trees == FOREST_TREES and walked == pytest.approx(said, abs=1e-9)


def test_importances_follow_from_the_nodes(fitted):
    _, fit, _, nodes = fitted
    said = {r["feature"]: r for r in model.feature_importance(fit).collect()}
    rows = forest.importance(nodes).collect()
    assert [r["feature"] for r in rows] == [r["feature"] for r in model.feature_importance(fit).collect()]
    for r in rows:
        assert r["importance"] == pytest.approx(said[r["feature"]]["importance"], abs=1e-9)
        assert r["above_cutoff"] == said[r["feature"]]["above_cutoff"]
    con = duckdb.connect()
    con.register("nodes", nodes.toPandas())
    sql = """WITH g AS (SELECT tree, feature, sum(gain * "count") AS g FROM nodes WHERE feature IS NOT NULL GROUP BY 1, 2),
             s AS (SELECT feature, sum(g / t) AS s FROM (SELECT *, sum(g) OVER (PARTITION BY tree) AS t FROM g) WHERE t > 0 GROUP BY 1)
             SELECT feature::INT, s / (SELECT sum(s) FROM s) FROM s"""
    for index, value in con.execute(sql).fetchall():
        assert value == pytest.approx(said[MODEL_FEATURES[index]]["importance"], abs=1e-9)


def test_nodes_are_consistent(fitted):
    """Children partition their parent's rows; gain is the fall of impurity; depth and trees as set."""
    _, _, _, nodes = fitted
    rows = {(r["tree"], r["node"]): r for r in nodes.collect()}
    assert {t for t, _ in rows} == set(range(FOREST_TREES))
    assert forest._depth(nodes) <= FOREST_DEPTH
    for (tree, _), r in rows.items():
        if r["feature"] is None:
            assert r["threshold"] is r["left"] is r["right"] is r["gain"] is None
            continue
        a, b = rows[tree, r["left"]], rows[tree, r["right"]]
        assert a["count"] + b["count"] == r["count"]
        mean = (a["prediction"] * a["count"] + b["prediction"] * b["count"]) / r["count"]
        fall = r["impurity"] - (a["impurity"] * a["count"] + b["impurity"] * b["count"]) / r["count"]
        assert r["prediction"] == pytest.approx(mean) and r["gain"] == pytest.approx(fall, abs=1e-6)


def test_walk_reaches_leaves(fitted):
    _, _, predicted, nodes = fitted
    leaves = forest.walk(predicted.limit(5), nodes, ["track_id", "region"]).collect()
    inner = {(r["tree"], r["node"]) for r in nodes.where("feature IS NOT NULL").collect()}
    assert len(leaves) == 5 * FOREST_TREES and not inner & {(r["tree"], r["node"]) for r in leaves}


def test_sums_merge_and_fit(spark, fitted):
    data, _, _, _ = fitted
    train = Q.split_of(data, "train")
    frame = linear.frame_of(train)
    parts = [linear.sums(train.where(F.pmod(F.xxhash64("track_id"), F.lit(3)) == i), frame) for i in range(3)]
    merged, whole = linear.solve(linear.merge_sums(*parts), frame), linear.solve(linear.sums(train, frame), frame)
    np.testing.assert_allclose(merged.coefficient, whole.coefficient, rtol=1e-8, atol=1e-10)
    said = model.coefficient_table(model.fit_linear(train)).collect()
    for name in ("coefficient", "std_error", "t_value", "p_value"):
        np.testing.assert_allclose(getattr(whole, name), [r[name] for r in said], rtol=1e-6, atol=1e-9)
    assert whole.n == train.count()
    residual = train.select(((F.col("label") - whole.prediction()) ** 2).alias("e")).agg(F.sum("e")).first()[0]
    assert residual == pytest.approx(whole.sse, rel=1e-9)


def test_far_off_columns_stay_exact(spark):
    """Large offsets and unlike units, where plain sums of squares cancel."""
    rng = np.random.default_rng(4)
    x = np.column_stack([1e6 + rng.normal(size=400), 1e-6 * rng.normal(size=400), rng.integers(0, 2, 400)])
    y = 3 * x[:, 0] - 2e5 * x[:, 1] + 0.5 * x[:, 2] + rng.normal(size=400)
    df = spark.createDataFrame([(*map(float, r), float(v)) for r, v in zip(x, y)], "a double, b double, c double, label double")
    frame = linear.frame_of(df, ["a", "b", "c"])
    fit = linear.solve(linear.sums(df, frame), frame)
    away = np.column_stack([x - x.mean(axis=0), np.ones(400)])
    want = np.linalg.lstsq(away, y, rcond=None)[0][:3]
    np.testing.assert_allclose(fit.coefficient[:3], want, rtol=1e-6)


def test_degenerate_fits(spark):
    schema = "a double, b double, label double"
    nothing = spark.createDataFrame([], schema)
    frame = linear.frame_of(nothing, ["a", "b"])
    fit = linear.solve(linear.sums(nothing, frame), frame)
    assert fit.n == 0 and all(r["coefficient"] is None for r in fit.table(spark).collect())
    same = spark.createDataFrame([(float(i), 2.0 * i, 5.0 * i + 1) for i in range(10)] + [(3.0, 6.0, 16.0)], schema)
    frame = linear.frame_of(same, ["a", "b"])
    fit = linear.solve(linear.sums(same, frame), frame)
    predicted = same.select(fit.prediction().alias("p"), "label").collect()
    assert all(r["p"] == pytest.approx(r["label"]) for r in predicted)
    few = spark.createDataFrame([(1.0, 1.0, 2.0)], schema)
    frame = linear.frame_of(few, ["a", "b"])
    fit = linear.solve(linear.sums(few, frame), frame)
    assert fit.table(spark).collect()[-1]["coefficient"] == 2.0 and math.isnan(fit.std_error[0])


@pytest.mark.parametrize("case", ["label", "features"])
def test_coefficient_table_where_spark_has_no_standard_errors(spark, case):
    """A label that does not vary (every track peaked at rank 1), or one feature that another determines."""
    rng = np.random.default_rng(6)
    x = rng.integers(0, 50, 60).astype(float)
    label = np.full(60, 1.0) if case == "label" else 3 * x + 1 + rng.normal(size=60)
    rows = [(float(a), float(2 * a if case == "features" else b), float(y)) for a, b, y in zip(x, rng.permutation(x), label)]
    df = model.assemble(spark.createDataFrame(rows, "a double, b double, label double"), ["a", "b"])
    table = model.coefficient_table(model.fit_linear(df), ["a", "b"])
    a, b, intercept = table.collect()
    if case == "label":
        assert [tuple(r)[2:] for r in (a, b)] == [(0.0, 0.0, None, None)] * 2
        assert (intercept["coefficient"], intercept["std_error"], intercept["t_value"]) == (1.0, 0.0, None)
    else:
        slope, at_0 = np.polyfit(x, label, 1)
        assert a["coefficient"] + 2 * b["coefficient"] == pytest.approx(slope)
        assert intercept["coefficient"] == pytest.approx(at_0) and a["std_error"] > 0
    said = registry.coefficient_identities(table).collect()
    assert len(said) == 3 and all(r["t_is_ratio"] and r["p_in_range"] for r in said)


@pytest.mark.parametrize(("t", "freedom", "p"), [
    (0.0, 5, 1.0), (1.0, 1, 0.5), (2.0, 2, 0.18350341907227397), (12.706204736432095, 1, 0.05), (1.959963984540054, 10**7, 0.05),
    (2.2281388519649385, 10, 0.05), (-2.2281388519649385, 10, 0.05), (40.0, 3000, 0.0), (math.inf, 3, 0.0),
])
def test_two_sided_probability(t, freedom, p):
    assert linear.two_sided(t, freedom) == pytest.approx(p, abs=1e-6)
    assert math.isnan(linear.two_sided(1.0, 0))
