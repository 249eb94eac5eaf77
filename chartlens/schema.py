"""Column names, types and fixed values of the chart data model.

One chart row is one entry of a track in a daily chart of one region:
(track, region, date, chart), plus the track's release date, artists and
audio features.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Audio feature columns, in the order used for the model vector.
AUDIO_FEATURES = [
    "af_danceability",
    "af_energy",
    "af_key",
    "af_loudness",
    "af_mode",
    "af_speechiness",
    "af_acousticness",
    "af_instrumentalness",
    "af_liveness",
    "af_valence",
    "af_tempo",
    "af_time_signature",
]

# Model inputs: the explicit flag, then the audio features.
MODEL_FEATURES = ["explicit", *AUDIO_FEATURES]

# Fixed values that results depend on (they must not change):
#   chart kept by the lifecycle, spread and model questions: "top200"
#   release cutoff day: 2017-01-01 (exclusive for Q1, Q2, Q4, Q5; inclusive for Q3)
#   "no release date" sentinel in the raw text: "0000"
#   streak rule: the next chart date is at most 3 days later (gap < 4 days)
#   danceability threshold of the title spread question: 0.75
#   origins of the corridor reports: France, Japan, United Kingdom (tier spread);
#     Luxembourg, France, Dominican Republic, Japan, United Kingdom (title spread)
#   genre labels: Electronic, Pop, Rock, Classical, Hip-Hop, Other
#   quartile labels: Q1, Q2, Q3, Q4
#   tier labels: top, middle, bottom
#   forest: 50 trees, depth 10; linear model: 50 iterations, no regularisation
#   importance cutoff line: 0.05
TOP_CHART = "top200"
RELEASE_CUTOFF = "2017-01-01"
NO_RELEASE = "0000"
STREAK_MAX_GAP_DAYS = 3
DANCEABLE_MIN = 0.75
TIER_ORIGINS = ["France", "Japan", "United Kingdom"]
TITLE_ORIGINS = ["Luxembourg", "France", "Dominican Republic", "Japan", "United Kingdom"]
GENRES = ["Classical", "Electronic", "Hip-Hop", "Other", "Pop", "Rock"]
QUARTILES = ["Q1", "Q2", "Q3", "Q4"]
TIERS = ["top", "middle", "bottom"]
FOREST_TREES = 50
FOREST_DEPTH = 10
LINEAR_MAX_ITER = 50
IMPORTANCE_CUTOFF = 0.05

# Raw chart file schema (CSV or parquet). release_date stays text: it mixes
# ISO days, years, year-months, "0000" and nulls, and is typed by
# ``chartlens.functions.dates.release_day``.
CHART_SCHEMA = T.StructType(
    [
        T.StructField("track_id", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("artist", T.StringType()),
        T.StructField("region", T.StringType()),
        T.StructField("chart", T.StringType()),
        T.StructField("rank", T.IntegerType()),
        T.StructField("date", T.DateType()),
        T.StructField("release_date", T.StringType()),
        T.StructField("explicit", T.BooleanType()),
        *[T.StructField(c, T.DoubleType()) for c in AUDIO_FEATURES],
    ]
)

CHART_COLUMNS = [f.name for f in CHART_SCHEMA.fields]
