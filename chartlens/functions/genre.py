"""Rule-based genre of a chart row from its audio features."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _clean(name: str) -> Column:
    # NaN must fail every rule, as a missing value does; Spark orders NaN
    # above every number, so turn it into NULL first.
    c = F.col(name)
    return F.when(F.isnan(c), F.lit(None).cast("double")).otherwise(c)


def genre_of(
    danceability: str = "af_danceability",
    energy: str = "af_energy",
    key: str = "af_key",
) -> Column:
    """Genre label by ordered rules; the first rule that holds wins.

    Fixed rule values (they must not change):
      danceability > 0.7 and energy > 0.7          -> Electronic
      danceability > 0.6 and energy <= 0.7         -> Pop
      danceability <= 0.6 and energy > 0.6         -> Rock
      key in (1, 2, 3) and danceability < 0.5      -> Classical
      key in (8, 9, 10) and danceability > 0.5     -> Hip-Hop
      otherwise                                    -> Other
    A missing (NULL or NaN) input makes a rule fail.
    """
    d, e, k = _clean(danceability), _clean(energy), _clean(key)
    return (
        F.when((d > 0.7) & (e > 0.7), "Electronic")
        .when((d > 0.6) & (e <= 0.7), "Pop")
        .when((d <= 0.6) & (e > 0.6), "Rock")
        .when(k.isin(1.0, 2.0, 3.0) & (d < 0.5), "Classical")
        .when(k.isin(8.0, 9.0, 10.0) & (d > 0.5), "Hip-Hop")
        .otherwise("Other")
    )
