"""Independent SQL for each registered query (DuckDB dialect).

Run by the correctness check over the pre-registered test-table views.
Each text starts from the same chart rule (FIXTURES.md section 2) and then
states the question plainly in SQL, without the Spark plan's rewrites
(no summed forms, no windows where a join says it more directly).
"""

from __future__ import annotations

from chartlens.sources.fixture import CHART_VIEW_SQL, GROWING_VIEW_SQL

RELEASE_DAY_SQL = """try_cast(case length(nullif(trim(release_date), '0000'))
           when 4 then nullif(trim(release_date), '0000') || '-01-01'
           when 7 then nullif(trim(release_date), '0000') || '-01'
           else nullif(trim(release_date), '0000') end as date)"""

CHART_COLS = (
    "track_id, title, artist, region, chart, rank, date, release_date, explicit, "
    "af_danceability, af_energy, af_key, af_loudness, af_mode, af_speechiness, af_acousticness, "
    "af_instrumentalness, af_liveness, af_valence, af_tempo, af_time_signature"
)

BASE_CTES = {
    "chart_raw": CHART_VIEW_SQL,
    "chart": f"select *, {RELEASE_DAY_SQL} as release_day from chart_raw",
    # rows after the top200 filter and the exclusive 2017-01-01 release cutoff
    "top": "select * from chart where chart = 'top200' and release_day > date '2017-01-01'",
    "tr": """select track_id, region, min(release_day) as release_day, min(date) as first_chart_day,
                    count(date) as chart_entries
             from top group by track_id, region""",
}


def sql(final: str, **ctes: str) -> str:
    """Compose ``with`` clauses: the base chart CTEs, then ``ctes`` in order."""
    parts = {**BASE_CTES, **ctes}
    body = ",\n".join(f"{name} as (\n{text}\n)" for name, text in parts.items())
    return f"with {body}\n{final}"


def growing(text: str) -> str:
    """The same SQL over the growing fixture."""
    return text.replace(CHART_VIEW_SQL, GROWING_VIEW_SQL)


def stats_sql(src: str, by: str, value: str, suffix: str) -> str:
    return f"""select {by}, avg({value}) as avg_{suffix}, median({value}) as median_{suffix},
       min({value}) as min_{suffix}, max({value}) as max_{suffix}
from {src} group by {by} order by avg_{suffix} desc, {by}"""


ORACLE: dict[str, str] = {}


def register(name: str, text: str) -> None:
    ORACLE[name] = text
