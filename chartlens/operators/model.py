"""Model frame and learning: can audio features predict the peak rank?

The frame has one row per (track, region); peak rank, streak and features
come from one pass over the chart rows.
Fitting uses Spark ML (distributed tree and least-squares aggregation).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import UnsupportedOperationException
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import (
    LinearRegression,
    LinearRegressionModel,
    RandomForestRegressionModel,
    RandomForestRegressor,
)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartlens.functions.buckets import hash_bucket
from chartlens.operators import linear
from chartlens.operators.lifecycle import block_pieces, month_blocks, numbered_pieces, summary_columns
from chartlens.schema import (
    AUDIO_FEATURES,
    FOREST_DEPTH,
    FOREST_TREES,
    IMPORTANCE_CUTOFF,
    LINEAR_MAX_ITER,
    MODEL_FEATURES,
)

KEY = ["track_id", "region"]
LABEL_SOURCE = "highest_ranking"


def _place() -> Column:
    """A row's place by date, then rank, NULLs last, as one number."""
    last = F.lit(2**31 - 1)
    day, rank = F.coalesce(F.unix_date("date"), last), F.coalesce(F.col("rank"), last)
    return F.shiftleft(day.cast("bigint"), 32) + rank.cast("bigint") + F.lit(2**31)


def _features_of_first_row(place: str) -> Column:
    """The features at the smallest ``place``, of equal ones by the features themselves, NULLs last.

    One whole row, so the vector is one that the data has; a missing value
    in it stays missing.
    """
    order = [x for c in MODEL_FEATURES for x in (F.col(c).isNull(), F.col(c))]
    keyed = F.struct(place, *[x.alias(f"_{i}") for i, x in enumerate(order)], *[F.col(c).alias(c) for c in MODEL_FEATURES])
    return F.min(keyed)


def audio_features(charts: DataFrame) -> DataFrame:
    """Explicit flag and audio features per (track, region) (R1), those of the first row by date and rank.

    Rows are first reduced to one per (track, region, features) by a hash
    aggregation (a track has one vector, or few); only those are compared as whole rows.
    """
    variants = charts.groupBy(*KEY, *MODEL_FEATURES).agg(F.min(_place()).alias("_place"))
    picked = variants.groupBy(*KEY).agg(_features_of_first_row("_place").alias("_f"))
    return picked.select(*KEY, *[F.col(f"_f.{c}").alias(c) for c in MODEL_FEATURES])


def lifecycle_frame(charts: DataFrame) -> DataFrame:
    """Everything the delay, streak and model questions need per (track, region), from one scan.

    The features are part of the month blocks' key (``lifecycle.month_blocks``),
    so peak rank, release day and the first row's place are fixed-size minima of
    one hash aggregation; whole feature rows are compared only among a track-region's blocks.
    Rows without a track or region have no features here and are one track-region
    per known part of the key, as in ``lifecycle.track_region``. Output: the columns
    of ``lifecycle.track_region_summary``, highest_ranking and the features.
    """
    keyed = F.col(KEY[0]).isNotNull() & F.col(KEY[1]).isNotNull()
    rows = charts.withColumns({c: F.when(keyed, F.col(c)) for c in MODEL_FEATURES})
    minima = [F.min("release_day").alias("release_day"), F.min("rank").alias("rank"), F.min(_place()).alias("_place")]
    blocks = month_blocks(rows, by=MODEL_FEATURES, aggs=minima)
    pieces = numbered_pieces(block_pieces(blocks, carry=["release_day", "rank", "_place", *MODEL_FEATURES]))
    per_run = pieces.groupBy(*KEY, "run_id").agg(
        F.sum("n").alias("run_len"),
        F.min("start").alias("run_first"),
        F.min("release_day").alias("release_day"),
        F.min("rank").alias("rank"),
        _features_of_first_row("_place").alias("_f"),
    )
    whole = per_run.groupBy(*KEY).agg(*summary_columns(), F.min("rank").alias(LABEL_SOURCE), F.min("_f").alias("_f"))
    return whole.select(*whole.columns[:-1], *[F.col(f"_f.{c}").alias(c) for c in MODEL_FEATURES])


def model_frame(charts: DataFrame) -> DataFrame:
    """Peak rank, streak and features per (track, region) (R2).

    One scan and two shuffles (``lifecycle_frame``). Rows without a track or region are not
    part of it. The streak is carried for analysis; it
    is neither feature nor label.
    """
    return frame_of(lifecycle_frame(charts.where(F.col(KEY[0]).isNotNull() & F.col(KEY[1]).isNotNull())))


def frame_of(summary: DataFrame) -> DataFrame:
    """The model frame (R2) from ``lifecycle_frame`` rows."""
    known = summary.where(F.col(KEY[0]).isNotNull() & F.col(KEY[1]).isNotNull())
    return known.select(*KEY, LABEL_SOURCE, "days_in_chart", *MODEL_FEATURES)


def complete_rows(frame: DataFrame, features: Sequence[str] = MODEL_FEATURES) -> DataFrame:
    """Rows with every feature and the peak rank present; adds ``label`` (F6 + label)."""
    return frame.dropna(subset=[*features, LABEL_SOURCE]).withColumn(
        "label", F.col(LABEL_SOURCE).cast("double")
    )


def assemble(df: DataFrame, features: Sequence[str] = MODEL_FEATURES, out: str = "features") -> DataFrame:
    """Feature vector column (R3); booleans enter as 0/1."""
    return VectorAssembler(inputCols=list(features), outputCol=out).transform(df)


def train_test_split(df: DataFrame, train_pct: int = 80, cols: Sequence[str] = KEY) -> DataFrame:
    """Add ``split`` = train/test from a hash of the key.

    ``randomSplit`` membership changes with the input partitioning; a hash
    bucket of (track, region) does not, and SQL can reproduce it.
    """
    return df.withColumn(
        "split", F.when(hash_bucket(*cols) < train_pct, F.lit("train")).otherwise(F.lit("test"))
    )


def fit_forest(train: DataFrame, features: str = "features", seed: int = 42) -> RandomForestRegressionModel:
    """Random forest regressor: 50 trees, depth 10 (R5). Fixed seed.

    ``cacheNodeIds`` keeps each row's current node per tree instead of
    walking every tree from the root at each level (same model, less work
    for deep trees); the node ids are checkpointed to the shared folder.
    """
    rf = RandomForestRegressor(
        featuresCol=features,
        labelCol="label",
        predictionCol="prediction",
        numTrees=FOREST_TREES,
        maxDepth=FOREST_DEPTH,
        seed=seed,
        cacheNodeIds=True,
    )
    return rf.fit(train)


def fit_linear(train: DataFrame, features: str = "features") -> LinearRegressionModel:
    """Least-squares linear regression, no regularisation.

    The normal-equation solver needs one aggregation pass over the data and
    gives standard errors, t and p values.
    """
    lr = LinearRegression(
        featuresCol=features,
        labelCol="label",
        predictionCol="prediction",
        maxIter=LINEAR_MAX_ITER,
        regParam=0.0,
        elasticNetParam=0.0,
        solver="normal",
    )
    return lr.fit(train)


def regression_metrics(
    pred: DataFrame, label: str = "label", prediction: str = "prediction", digits: int | None = None
) -> DataFrame:
    """RMSE, MAE and R^2 in one aggregation (R7): one row (n, rmse, mae, r2).

    R^2 = 1 - SSE / SST with SST around the mean of the evaluated labels,
    as Spark's ``RegressionEvaluator`` computes it; NULL where the labels do
    not vary, and all metrics are NULL without rows. ``digits`` rounds the
    three metrics (floating sums depend on summation order, so results
    compared across engines are rounded).
    """
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    e = y - p
    s = pred.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(e * e).alias("sse"),
        F.sum(F.abs(e)).alias("sae"),
        (F.var_pop(y) * F.count(y)).alias("sst"),
    )
    metrics = {
        "rmse": F.sqrt(F.try_divide("sse", "n")),
        "mae": F.try_divide("sae", "n"),
        "r2": F.lit(1.0) - F.try_divide("sse", "sst"),
    }
    return s.select(
        "n", *[(F.round(v, digits) if digits is not None else v).alias(k) for k, v in metrics.items()]
    )


def feature_importance(
    model: RandomForestRegressionModel, features: Sequence[str] = MODEL_FEATURES, cutoff: float = IMPORTANCE_CUTOFF
) -> DataFrame:
    """Forest feature importances, largest first, with the cutoff flag.

    One row per feature (the model's own small vector).
    """
    spark = _session()
    vals = model.featureImportances.toArray().tolist()
    rows = [(i, f, float(v), float(v) >= cutoff) for i, (f, v) in enumerate(zip(features, vals))]
    schema = "index int, feature string, importance double, above_cutoff boolean"
    return spark.createDataFrame(rows, schema).orderBy(F.col("importance").desc(), "index")


def formula(model: LinearRegressionModel, features: Sequence[str] = MODEL_FEATURES, digits: int = 4) -> DataFrame:
    """The linear model as one line of text: ``highest_ranking = ...`` (one row, ``formula``)."""
    terms = [f"{float(model.intercept):.{digits}f}"]
    terms += [f"({c:.{digits}f} * {f})" for f, c in zip(features, model.coefficients.toArray().tolist())]
    return _session().createDataFrame([(f"{LABEL_SOURCE} = " + " + ".join(terms),)], "formula string")


def coefficient_table(
    model: LinearRegressionModel, features: Sequence[str] = MODEL_FEATURES, digits: int | None = None
) -> DataFrame:
    """Coefficient, standard error, t and p value per feature and intercept (R9), rounded to ``digits`` if asked.

    The summary arrays carry the intercept as their last element. ``linear.solve`` gives
    the same table from mergeable sums; it does so here where Spark has no standard errors: for a
    label that does not vary, or features that determine one another. A t or p that is not
    defined (no residual, no coefficient) is then NULL.
    """
    spark = _session()
    s = model.summary
    coefs = [*model.coefficients.toArray().tolist(), float(model.intercept)]
    names = [*features, "intercept"]
    try:
        se, tv, pv = s.coefficientStandardErrors, s.tValues, s.pValues
    except UnsupportedOperationException:
        x = vector_to_array(F.col(s.featuresCol))
        rows = s.predictions.select(*[x[i].alias(f) for i, f in enumerate(features)], s.labelCol)
        frame = linear.frame_of(rows, features, s.labelCol)
        return linear.solve(linear.sums(rows, frame), frame).table(spark, digits)

    def out(x: float) -> float:
        return float(x) if digits is None else round(float(x), digits)

    rows = [(i, n, out(coefs[i]), out(se[i]), out(tv[i]), out(pv[i])) for i, n in enumerate(names)]
    schema = T.StructType(
        [
            T.StructField("index", T.IntegerType()),
            T.StructField("feature", T.StringType()),
            T.StructField("coefficient", T.DoubleType()),
            T.StructField("std_error", T.DoubleType()),
            T.StructField("t_value", T.DoubleType()),
            T.StructField("p_value", T.DoubleType()),
        ]
    )
    return spark.createDataFrame(rows, schema)


def _session():
    from pyspark.sql import SparkSession

    # the active session is per thread; fall back to the default one (report
    # jobs may run in worker threads)
    return SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()


__all__ = [
    "AUDIO_FEATURES",
    "audio_features",
    "lifecycle_frame",
    "model_frame",
    "frame_of",
    "complete_rows",
    "assemble",
    "train_test_split",
    "fit_forest",
    "fit_linear",
    "regression_metrics",
    "feature_importance",
    "coefficient_table",
    "formula",
]
