"""Incremental ingest of chart shard files into the typed chart table.

Chart data arrives as CSV shards (one per day or per region). The batch
reader (``sources.read_charts``) reads a glob of them at once; this is the
same read done as a Structured Streaming file source, so each run only
picks up shards it has not seen, types them (``release_day``) and appends
them to the chart table partitioned by chart. The file sink's log in the
table and the checkpoint belong together, so the checkpoint lies beside the
table by default: every run of a table finds the same one, and each shard
lands exactly once, also when a run is retried after a failure.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from chartlens.schema import CHART_COLUMNS
from chartlens.sources.charts import (
    CORRUPT,
    CSV_OPTIONS,
    chart_columns,
    csv_header,
    csv_schema,
    headers_of,
    typed_charts,
)


def stream_chart_shards(
    spark: SparkSession,
    shard_dir: str,
    max_files_per_trigger: int | None = None,
    strict: bool = False,
    multi_line: bool = False,
    unlike_headers: bool = False,
) -> DataFrame:
    """Streaming DataFrame of chart rows from CSV shards in ``shard_dir``.

    Columns are taken by the names in the header of a shard that is there at
    the start; a shard with another header fails the query, unless ``unlike_headers`` is
    given (``_by_own_header``). Malformed rows are kept as in ``read_charts``.
    ``multi_line`` reads line breaks inside quoted fields, a file in one task.
    """
    if multi_line and unlike_headers:
        raise ValueError("multi_line needs shards with one header")
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if unlike_headers:
        return chart_columns(_by_own_header(spark, reader.format("text").load(shard_dir), shard_dir), strict)
    reader = reader.schema(csv_schema(csv_header(spark, shard_dir))).options(**CSV_OPTIONS)
    reader = reader.option("enforceSchema", False).option("mode", "PERMISSIVE").option("columnPruning", False)
    reader = reader.option("columnNameOfCorruptRecord", CORRUPT).option("multiLine", multi_line)
    return chart_columns(reader.csv(shard_dir), strict)


def _by_own_header(spark: SparkSession, lines: DataFrame, shard_dir: str) -> DataFrame:
    """Raw chart columns of text ``lines``, each line read by the header of its file.

    The first lines of all files there are looked at now (``headers_of``) and joined to the stream by
    file; each distinct header parses its own lines. A shard that lands later is in no such index: the query
    fails at it, with nothing of its batch written, and the next run, which sees it, goes on there. Lines that repeat
    their file's header are not rows; blank lines are skipped, as by the CSV reader.
    """
    found = headers_of(spark, shard_dir)
    as_uri = spark.sparkContext._jvm.org.apache.hadoop.fs.Path  # _metadata names files by their URIs
    index = [(as_uri(file).toUri().toString(), n) for n, files in enumerate(found.values()) for file in files]
    known = spark.createDataFrame(index, "_file string, _header int")
    on = lines.withColumn("_file", F.col("_metadata.file_path")).where(F.trim("value") != "")
    on = on.join(known, "_file", "left")
    unknown = F.raise_error(F.concat(F.lit("chart shard landed after the start: "), F.col("_file"))).cast("int")
    on = on.withColumn("_header", F.coalesce("_header", unknown))
    options = CSV_OPTIONS | {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    records = {}
    for n, (line, files) in enumerate(found.items()):
        if line.strip():
            fields = csv_schema(csv_header(spark, files[:1])).names
            named = [c if c in (*CHART_COLUMNS, CORRUPT) else f"_other{i}" for i, c in enumerate(fields)]
            own = (F.col("_header") == n) & (F.col("value") != F.lit(line))
            parsed = F.from_csv("value", ", ".join(f"`{c}` string" for c in named), options)
            records[f"_r{n}"] = F.when(own, parsed)
    if not records:
        raise ValueError(f"no chart file with a header: {shard_dir}")
    rows = on.select(*[r.alias(n) for n, r in records.items()])
    rows = rows.where(reduce(or_, [F.col(n).isNotNull() for n in records]))
    return rows.select(*[F.coalesce(*[F.col(n)[c] for n in records]).alias(c) for c in [*CHART_COLUMNS, CORRUPT]])


def ingest_chart_shards(
    spark: SparkSession,
    shard_dir: str,
    table_path: str,
    checkpoint_path: str | None = None,
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
    multi_line: bool = False,
    unlike_headers: bool = False,
) -> StreamingQuery:
    """Append new shards of ``shard_dir`` to the typed chart table at ``table_path``.

    ``available_now`` processes everything present and stops (a scheduled
    batch-style run); otherwise the query keeps running and picks up shards
    as they land. The checkpoint is ``<table_path>_checkpoint`` unless given;
    a table's runs must all use the same one.
    ``max_files_per_trigger`` bounds each micro-batch, so a large backlog
    of shards is appended in several commits instead of one huge one.
    ``multi_line`` and ``unlike_headers`` are those of ``stream_chart_shards``; the latter knows the
    headers of the shards that are there at the start, so it needs ``available_now``. Runs with
    and without either go on from one another.
    """
    if unlike_headers and not available_now:
        raise ValueError("unlike_headers reads the shards that are there at the start: it needs available_now")
    ckpt = checkpoint_path or f"{table_path.rstrip('/')}_checkpoint"
    writer = (
        typed_charts(stream_chart_shards(spark, shard_dir, max_files_per_trigger, False, multi_line, unlike_headers))
        .writeStream.format("parquet")
        .option("path", table_path)
        .option("checkpointLocation", ckpt)
        .partitionBy("chart")
        .outputMode("append")
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
