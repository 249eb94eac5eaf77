"""Sources and sinks: chart files, reports, and test-table chart rows."""

from chartlens.sources.charts import (
    read_chart_table,
    read_charts,
    read_report,
    typed_charts,
    with_release_day,
    write_chart_table,
    write_report,
)
from chartlens.sources.fixture import CHART_VIEW_SQL, GROWING_VIEW_SQL, chart_rows, growing_chart_rows

__all__ = [
    "read_charts",
    "read_chart_table",
    "write_chart_table",
    "read_report",
    "typed_charts",
    "with_release_day",
    "write_report",
    "chart_rows",
    "growing_chart_rows",
    "CHART_VIEW_SQL",
    "GROWING_VIEW_SQL",
]
