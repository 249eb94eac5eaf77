"""Funnel counts that ride on a job that runs anyway (S3 by side counters).

``SideCounter`` puts ``Dataset.observe`` metrics on a frame: whatever job first
reads the whole frame also counts its rows at each step, and the funnel is then
there without a scan of its own.

Counting exactly once. Spark adds a task's metrics when the task ends, and a shuffle
stage whose output was lost with an executor runs some of its tasks again, which
would add theirs twice. The counter therefore also counts the first row of every
partition and collects which partitions they were: if a partition reported
more than once, there are more first rows than partitions, the counts are
thrown away and the steps are counted by a scan. Spark skips
failed and speculative attempts itself. The set holds one number per task, no more than
the scheduler's own records of the stage.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

FUNNEL_SCHEMA = "level string, step_no int, step string, row_count bigint"
_PLACE = "_row_place"


class SideCounter:
    """Counts rows of ``df`` at cumulative steps on the way through the first job over ``rows``.

    ``steps`` are (name, condition) as in ``clean.filter_funnel``; ``input`` names the count
    of all rows; ``also`` are conditions counted each for itself. ``rows`` is ``df`` with the counter on it and must be read whole, once,
    by the first action: nothing may cut it short (a limit), and filters on it are not
    pushed below the counter. Put the counter where the rows it must see are read anyway.
    """

    def __init__(
        self,
        df: DataFrame,
        steps: Sequence[tuple[str, Column]] = (),
        level: str = "rows",
        input: str = "input",
        also: Mapping[str, Column] | None = None,
    ):
        self._df, self._level, self._names = df, level, [input, *[n for n, _ in steps]]
        self._observation = Observation()
        cond, self._counts = F.lit(True), {"c0": F.count(F.lit(1))}
        for i, (_, c) in enumerate(steps, start=1):
            cond = cond & F.coalesce(c, F.lit(False))
            self._counts[f"c{i}"] = F.count_if(cond)
        self._counts |= {f"also_{n}": F.count_if(F.coalesce(c, F.lit(False))) for n, c in (also or {}).items()}
        # partition in the upper 31 bits, number of the row in it in the lower 33
        first = F.col(_PLACE).bitwiseAND(F.lit((1 << 33) - 1)) == 0
        task = {
            "firsts": F.count_if(first),
            "partitions": F.size(F.collect_set(F.when(first, F.shiftright(_PLACE, 33)))),
        }
        marked = df.withColumn(_PLACE, F.monotonically_increasing_id())
        metrics = [c.alias(n) for n, c in (self._counts | task).items()]
        self.rows = marked.observe(self._observation, *metrics).drop(_PLACE)
        self.rescanned = False
        self._found: dict[str, int] | None = None

    def _all(self) -> dict[str, int]:
        if self._found is None:
            try:
                found = self._observation.get
            except Py4JJavaError:  # the planner left the counter out: it knew that there are no rows to read
                found = {}
            if not found or found["firsts"] != found["partitions"]:
                self.rescanned = True
                found = self._df.agg(*[c.alias(n) for n, c in self._counts.items()]).first().asDict()
            self._found = found
        return self._found

    def counts(self) -> list[int]:
        """Rows left at each step, the unfiltered count first. Waits for the job over ``rows``."""
        return [int(self._all()[f"c{i}"]) for i in range(len(self._names))]

    def other(self, name: str) -> int:
        """Rows that meet a condition of ``also``."""
        return int(self._all()[f"also_{name}"])

    def funnel(self) -> DataFrame:
        """The funnel as rows (level, step_no, step, row_count), as ``clean.filter_funnel`` gives them."""
        found = zip(self._names, self.counts())
        return counted(self._df.sparkSession, [(self._level, i, n, c) for i, (n, c) in enumerate(found)])


def counted(spark: SparkSession, rows: Sequence[tuple[str, int, str, int]]) -> DataFrame:
    """Funnel rows (level, step_no, step, row_count) that are already counted."""
    return spark.createDataFrame(list(rows), FUNNEL_SCHEMA)
