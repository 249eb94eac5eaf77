"""Genre rules, shares and quartiles; model identities."""

from __future__ import annotations

import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from chartlens.operators import genres, model
from chartlens.plans import questions as Q
from chartlens.plans.registry import charts_of
from tests.conftest import SF_SMALL


@pytest.mark.parametrize(
    "dance,energy,key,expected",
    [
        (0.65, 0.8, 5.0, "Other"),
        (0.65, 0.8, 9.0, "Hip-Hop"),
        (0.4, 0.5, 2.0, "Classical"),
        (0.8, 0.8, 0.0, "Electronic"),
        (0.7, 0.7, 0.0, "Pop"),
        (0.6, 0.61, 0.0, "Rock"),
        (0.5, 0.5, 9.0, "Other"),  # Hip-Hop needs danceability above .5
        (0.5, 0.5, 2.0, "Other"),  # Classical needs danceability below .5
        (0.6, 0.7, 0.0, "Rock"),  # .6 is not above .6; energy .7 is above .6
        (0.7, 0.71, 0.0, "Other"),  # .7 is not above .7; energy above .7 is not Pop
        (0.61, 0.7, 9.0, "Pop"),  # rules are ordered: Pop before Hip-Hop
        (None, 0.8, 9.0, "Other"),
        (float("nan"), 0.8, 9.0, "Other"),
    ],
)
def test_genre_rules(charts, dance, energy, key, expected):
    c = charts([dict(af_danceability=dance, af_energy=energy, af_key=key)])
    assert genres.with_genre(c).first().genre == expected


def share_rows(charts, counts):
    rows = []
    for region, per_genre in counts.items():
        for g, n in per_genre.items():
            dance, energy, key = {"Electronic": (0.9, 0.9, 0), "Pop": (0.65, 0.5, 0), "Rock": (0.5, 0.9, 0),
                                  "Classical": (0.4, 0.5, 2), "Other": (0.55, 0.5, 0)}[g]
            rows += [dict(region=region, af_danceability=dance, af_energy=energy, af_key=float(key))] * n
    return genres.with_month(genres.with_genre(charts(rows)))


def test_quartiles_and_top_genre(charts):
    rows = share_rows(charts, {"A": {"Electronic": 1, "Pop": 2, "Rock": 3, "Classical": 4},
                               "B": {"Other": 5}})
    shares = genres.genre_share(genres.genre_counts(rows))
    q = {(r.region, r.genre): r.quartile for r in genres.share_quartile(shares).collect()}
    assert q == {("A", "Electronic"): "Q1", ("A", "Pop"): "Q2", ("A", "Rock"): "Q3", ("A", "Classical"): "Q4",
                 ("B", "Other"): "Q1"}
    top = {(r.region, r.quartile): r.genre
           for r in genres.top_genre_per_quartile(genres.share_quartile(shares)).collect()}
    assert top[("A", "Q4")] == "Classical" and top[("B", "Q1")] == "Other"


def test_shares_sum_to_100_and_pivot_matches_counts(spark):
    c = charts_of(spark, SF_SMALL)
    rows = Q.genre_rows(c, "long_date")
    counts = genres.genre_counts(rows)
    sums = genres.genre_share(counts).groupBy("region").agg(F.sum("percentage").alias("p")).collect()
    assert all(abs(r.p - 100.0) < 1e-9 for r in sums)
    piv = genres.genre_pivot(counts)
    total = piv.select(sum(F.col(f"`{g}`") for g in ["Classical", "Electronic", "Hip-Hop", "Other", "Pop", "Rock"])
                       .alias("t")).agg(F.sum("t")).first()[0]
    assert total == rows.count()


def test_best_genre_prefers_danceability_then_energy(charts):
    rows = share_rows(charts, {"A": {"Electronic": 1, "Pop": 1}})
    best = genres.best_genre(genres.genre_profile(rows)).collect()
    assert [r.genre for r in best] == ["Electronic"]


@pytest.fixture(scope="module")
def fitted(spark):
    c = charts_of(spark, SF_SMALL)
    forest, fpred = Q.q5_forest(c)
    linear, lpred = Q.q5_linear(c)
    return c, forest, fpred, linear, lpred


def test_metrics_equal_regression_evaluator(fitted):
    _, _, fpred, _, _ = fitted
    m = model.regression_metrics(fpred).first()
    for name in ("rmse", "mae", "r2"):
        ev = RegressionEvaluator(labelCol="label", predictionCol="prediction", metricName=name).evaluate(fpred)
        assert getattr(m, name) == pytest.approx(ev, rel=1e-9, abs=1e-12)


def test_forest_repeatable_with_seed(spark, fitted):
    c, _, fpred, _, _ = fitted
    _, again = Q.q5_forest(c)
    a = {(r.track_id, r.region): r.prediction for r in fpred.collect()}
    b = {(r.track_id, r.region): r.prediction for r in again.collect()}
    assert a == b


def test_linear_residuals_orthogonal_to_features(fitted):
    c, _, _, linear, _ = fitted
    train = Q.split_of(Q.assembled_data(c), "train")
    res = linear.transform(train).withColumn("e", F.col("label") - F.col("prediction"))
    feats = ["af_danceability", "af_energy", "af_tempo"]
    sums = res.agg(*[F.sum(F.col("e") * F.col(f)).alias(f) for f in feats], F.sum("e").alias("e")).first()
    scale = res.agg(F.sum(F.abs("e"))).first()[0]
    for f in [*feats, "e"]:
        assert abs(sums[f]) <= 1e-6 * scale * 200


def test_coefficient_table_has_intercept_row(fitted):
    _, _, _, linear, _ = fitted
    rows = model.coefficient_table(linear).collect()
    assert len(rows) == 14 and rows[-1].feature == "intercept"
    assert all(0.0 <= r.p_value <= 1.0 for r in rows)


def test_importances_sorted_and_sum_to_one(fitted):
    _, forest, _, _, _ = fitted
    rows = model.feature_importance(forest).collect()
    vals = [r.importance for r in rows]
    assert vals == sorted(vals, reverse=True)
    assert sum(vals) == pytest.approx(1.0)
    assert all(r.above_cutoff == (r.importance >= 0.05) for r in rows)


def test_split_is_partitioning_independent(spark):
    c = charts_of(spark, SF_SMALL)
    a = {(r.track_id, r.region): r.split for r in Q.model_data(c).collect()}
    b = {(r.track_id, r.region): r.split for r in Q.model_data(c.repartition(13)).collect()}
    assert a == b
    share = sum(v == "train" for v in a.values()) / len(a)
    assert 0.7 < share < 0.9


def test_linear_model_equals_numpy_least_squares(fitted):
    import numpy as np

    from chartlens.schema import MODEL_FEATURES

    c, _, _, linear, _ = fitted
    train = Q.split_of(Q.assembled_data(c), "train").select(*MODEL_FEATURES, "label")
    rows = train.collect()
    x = np.array([[float(r[f]) for f in MODEL_FEATURES] for r in rows])
    y = np.array([r.label for r in rows])
    design = np.hstack([x, np.ones((len(rows), 1))])
    beta, *_ = np.linalg.lstsq(design, y, rcond=None)
    resid = y - design @ beta
    sigma2 = resid @ resid / (len(rows) - design.shape[1])
    se = np.sqrt(np.diag(sigma2 * np.linalg.inv(design.T @ design)))
    table = model.coefficient_table(linear).collect()
    got_beta = np.array([r.coefficient for r in table])
    got_se = np.array([r.std_error for r in table])
    np.testing.assert_allclose(got_beta, beta, rtol=1e-6, atol=1e-8)
    np.testing.assert_allclose(got_se, se, rtol=1e-6, atol=1e-8)


def test_metrics_of_constant_labels(spark):
    rows = [(3.0, 2.0), (3.0, 4.0)]
    df = spark.createDataFrame(rows, "label double, prediction double")
    assert tuple(model.regression_metrics(df).first()) == (2, 1.0, 1.0, None)
    assert tuple(model.regression_metrics(df.where("label < 0")).first()) == (0, None, None, None)


def test_features_come_from_one_row(charts):
    rows = [
        dict(date="2017-03-02", explicit=True, af_energy=0.1, af_key=0.4),
        dict(date="2017-03-01", explicit=False, af_energy=0.9, af_key=None),
    ]
    for c in (charts(rows), charts(rows[::-1])):
        r = model.audio_features(c).first()
        assert (r.explicit, r.af_energy, r.af_key) == (False, 0.9, None)
        f = model.model_frame(c).first()
        assert (f.explicit, f.af_energy, f.af_key, f.days_in_chart) == (False, 0.9, None, 2)
        assert model.complete_rows(model.model_frame(c)).count() == 0


def test_forest_does_not_depend_on_cluster_settings(spark):
    c = charts_of(spark, SF_SMALL)
    found = []
    for partitions in ("2", "13"):
        before = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        try:
            data = Q.assembled_data(c.repartition(int(partitions)))
            assert data.rdd.getNumPartitions() == Q.MODEL_PARTITIONS > 1
            _, pred = Q.q5_forest(c, data)
            found.append({(r.track_id, r.region): r.prediction for r in pred.collect()})
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found[0] == found[1]


def test_model_frame_is_one_scan(spark, tmp_path):
    from chartlens.sources import chart_rows, read_chart_table, write_chart_table

    write_chart_table(chart_rows(spark, SF_SMALL), str(tmp_path / "t"))
    frame = model.model_frame(Q.lifecycle_base(read_chart_table(spark, str(tmp_path / "t"))))
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Join" not in plan


def test_distinct_sketches_merge(spark):
    """Sketches per month give the union's count within the stated error, also when a month is added later."""
    rows = spark.range(300_000).select(
        (F.col("id") % 120_000).cast("string").alias("track"), (F.col("id") % 7).alias("month"), F.when(F.col("id") % 5 > 0, F.lit("r")).alias("region")
    )
    sketches = genres.distinct_sketches(rows.where("month < 6"), ["month"], "track")
    later = genres.distinct_sketches(rows.where("month = 6"), ["month"], "track")
    found = genres.sketched_count(sketches.unionByName(later), name="n").first()["n"]
    assert abs(found - 120_000) <= 4 * genres.sketch_error() * 120_000
    assert found == genres.sketched_count(genres.distinct_sketches(rows, [], "track"), name="n").first()["n"]
    assert sketches.select(F.max(F.octet_length("sketch"))).first()[0] <= 2**genres.SKETCH_LG_K + 64
    few = genres.sketched_count(genres.distinct_sketches(rows, ["month"], "region"), ["month"])
    assert {r["month"]: r["n_regions"] for r in few.collect()} == dict.fromkeys(range(7), 1)
    assert genres.sketched_count(genres.distinct_sketches(rows.where("false"), ["month"], "track")).first()["n_regions"] == 0
