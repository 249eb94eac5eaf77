"""Least squares from mergeable sums (R6, R9): n, X'X, X'y and y'y of one aggregation.

The sums are state that adds up: those of new shards or regions are added to stored
ones without a rescan, and any least-squares question over the same columns
(coefficients, standard errors, t and p values, residual error) is answered from
them on the driver, whatever the number of rows. Columns are first shifted by
given centres and divided by given scales (the same for all states that are to be
merged), which keeps the sums well conditioned; the centres default to the first
aggregation's means.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chartlens.schema import MODEL_FEATURES

CELLS = "i int, j int, value double"


@dataclass(frozen=True)
class Frame:
    """The columns that sums are of, and their common centres and scales (label last)."""

    features: tuple[str, ...]
    label: str
    centre: tuple[float, ...]
    scale: tuple[float, ...]

    def columns(self) -> list[Column]:
        names = [*self.features, self.label]
        return [(F.col(c).cast("double") - F.lit(m)) / F.lit(s) for c, m, s in zip(names, self.centre, self.scale)]


def frame_of(rows: DataFrame, features: Sequence[str] = MODEL_FEATURES, label: str = "label") -> Frame:
    """Means and standard deviations of ``rows`` (one aggregation); a constant column is only shifted."""
    names = [*features, label]
    x = [F.col(c).cast("double") for c in names]
    found = rows.agg(*[f(c) for c in x for f in (F.avg, F.stddev_pop)]).first()
    centre = tuple(float(v or 0.0) for v in found[::2])
    scale = tuple(float(v) if v and v > 0 and math.isfinite(v) else 1.0 for v in found[1::2])
    return Frame(tuple(features), label, centre, scale)


def sums(rows: DataFrame, frame: Frame) -> DataFrame:
    """Sums of products of all pairs of (features, label, 1): rows (i, j, value), i <= j.

    One hash aggregation of fixed-size buffers; every row must be complete.
    """
    x = [*frame.columns(), F.lit(1.0)]
    pairs = [(i, j) for i in range(len(x)) for j in range(i, len(x))]
    wide = rows.agg(*[F.coalesce(F.sum(x[i] * x[j]), F.lit(0.0)).alias(f"s{i}_{j}") for i, j in pairs])
    stacked = ", ".join(f"{i}, {j}, s{i}_{j}" for i, j in pairs)
    return wide.selectExpr(f"stack({len(pairs)}, {stacked}) as (i, j, value)")


def merge_sums(*states: DataFrame) -> DataFrame:
    """The sums of all rows of several states with the same ``Frame``."""
    return reduce(DataFrame.unionByName, states).groupBy("i", "j").agg(F.sum("value").alias("value"))


@dataclass(frozen=True)
class Fit:
    """A least-squares fit in the units of the columns; arrays over features, then the intercept."""

    features: tuple[str, ...]
    n: int
    coefficient: np.ndarray
    std_error: np.ndarray
    t_value: np.ndarray
    p_value: np.ndarray
    sse: float
    sst: float

    def prediction(self) -> Column:
        terms = [F.col(f).cast("double") * F.lit(float(c)) for f, c in zip(self.features, self.coefficient)]
        return reduce(lambda a, b: a + b, terms, F.lit(float(self.coefficient[-1])))

    def table(self, spark: SparkSession, digits: int | None = None) -> DataFrame:
        """Rows (index, feature, coefficient, std_error, t_value, p_value), rounded if asked."""

        def out(x: float) -> float | None:
            if not math.isfinite(x):
                return None
            return float(x) if digits is None else round(float(x), digits)

        columns = zip([*self.features, "intercept"], self.coefficient, self.std_error, self.t_value, self.p_value)
        rows = [(i, name, *map(out, values)) for i, (name, *values) in enumerate(columns)]
        return spark.createDataFrame(
            rows, "index int, feature string, coefficient double, std_error double, t_value double, p_value double"
        )


def solve(state: DataFrame, frame: Frame) -> Fit:
    """The fit of ``sums``: at most one row per pair of columns is read.

    Columns that the others determine get the smallest coefficients that fit (a
    pseudo-inverse); without more rows than columns there are no standard errors (NaN).
    """
    k = len(frame.features)
    gram = np.zeros((k + 2, k + 2))
    for r in state.collect():
        gram[r["i"], r["j"]] = gram[r["j"], r["i"]] = r["value"]
    n = int(round(gram[-1, -1]))
    if not n:
        empty = np.full(k + 1, np.nan)
        return Fit(frame.features, 0, empty, empty, empty, empty, math.nan, math.nan)
    mean = gram[:-1, -1] / n
    about = gram[:-1, :-1] - n * np.outer(mean, mean)  # sums about the means
    xx, xy, yy = about[:k, :k], about[:k, k], about[k, k]
    inverse = np.linalg.pinv(xx, rcond=1e-12, hermitian=True)
    beta = inverse @ xy
    sse = max(float(yy - 2 * beta @ xy + beta @ xx @ beta), 0.0)
    scale, centre = np.array(frame.scale), np.array(frame.centre)
    mean = centre + scale * mean  # in the columns' own units
    slope = beta * scale[k] / scale[:k]
    own = inverse / np.outer(scale[:k], scale[:k])
    sse, sst = sse * scale[k] ** 2, float(yy) * scale[k] ** 2
    left = n - k - 1
    variance = sse / left if left > 0 else math.nan
    spread = np.append(np.diag(own), 1 / n + mean[:k] @ own @ mean[:k])
    coefficient = np.append(slope, mean[k] - slope @ mean[:k])
    with np.errstate(invalid="ignore", divide="ignore"):
        error = np.sqrt(variance * spread)
        t = coefficient / error
    p = np.array([two_sided(float(v), left) for v in t])
    return Fit(frame.features, n, coefficient, error, t, p, sse, sst)


def two_sided(t: float, freedom: int) -> float:
    """Probability of a Student t beyond ``t`` on either side: the regularized incomplete beta I(f / (f + t^2); f / 2, 1 / 2)."""
    if freedom <= 0 or math.isnan(t):
        return math.nan
    if math.isinf(t):
        return 0.0
    a, b, x = freedom / 2, 0.5, freedom / (freedom + t * t)
    if x >= 1:
        return 1.0
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x))
    if x < (a + 1) / (a + b + 2):
        return front * _fraction(a, b, x) / a
    return 1 - front * _fraction(b, a, 1 - x) / b


def _fraction(a: float, b: float, x: float) -> float:
    """The continued fraction of the incomplete beta function (DLMF 8.17.22), by Lentz's method."""
    tiny = 1e-300
    c, d = 1.0, 1 / ((1 - (a + b) * x / (a + 1)) or tiny)
    total = d
    for m in range(1, 10_000):
        for step in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1 / ((1 + step * d) or tiny)
            c = (1 + step / c) or tiny
            total *= d * c
        if abs(d * c - 1) < 1e-16:
            break
    return total
