"""Date expressions: typing of dirty release dates, months."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from chartlens.schema import NO_RELEASE


def release_day(raw: str | Column = "release_date") -> Column:
    """Type a raw release date text as a DATE.

    ``YYYY-MM-DD`` is kept, a bare year ``YYYY`` means 1 January, a year-month
    ``YYYY-MM`` means the 1st of that month; the ``0000`` sentinel, nulls and
    anything unparsable become NULL (never an error under ANSI mode).
    """
    text = F.nullif(F.trim(F.col(raw) if isinstance(raw, str) else raw), F.lit(NO_RELEASE))
    filled = (
        F.when(F.length(text) == 4, F.concat(text, F.lit("-01-01")))
        .when(F.length(text) == 7, F.concat(text, F.lit("-01")))
        .otherwise(text)
    )
    return filled.try_cast("date")


def month_of(day: str | Column) -> Column:
    """First day of the month of ``day`` (a DATE)."""
    return F.trunc(F.col(day) if isinstance(day, str) else day, "month")
