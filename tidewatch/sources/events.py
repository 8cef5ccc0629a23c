"""Event-log (NDJSON) sources: S8, S9 helpers, F7 accounting.

``read_event_lines`` scans text files (one JSON object per line) in parallel splits and
tags every line with an order key ``ord`` so order-sensitive operators (first value,
earliest alert on a tie, keep-first) are deterministic without a global sort.
``parse_event_lines`` turns a DataFrame of lines into typed events; it is shared by the
batch and the streaming paths.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from tidewatch import schemas
from tidewatch.session import package_for_workers

WHITE_SPACE = " \t\n\x0b\f\r"  # taken off at both ends of a line

def read_event_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Text scan of NDJSON files -> (value string, ord struct).

    ``ord`` = (file path, split start, position inside the split): true line order inside
    each file, a total order across files.  Bad UTF-8 bytes arrive as U+FFFD.
    """
    df = spark.read.text(path).select("value", "_metadata")
    return df.select(
        F.col("value"),
        F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("pos"),
        ).alias("ord"),
    )


def parse_event_lines(lines: DataFrame, value_col: str = "value", ord_col: str = "ord", encoding: str = "replace") -> DataFrame:
    """X20 + S8: lines -> one row per line with ``line_kind`` in {blank, malformed, event} and
    ``ev`` (the JSON parse; fields are reached by struct paths such as ``ev.flow.start``).

    Malformed = the line, white space at its ends taken off, is not exactly one JSON object in
    strict JSON.  The line is parsed as the only element of an array, so anything behind the
    first object (a second object, trailing text) makes the parse fail.

    ``encoding``: what becomes of a line whose bytes are no UTF-8.  ``replace`` reads each bad byte as
    U+FFFD and parses on; ``strict`` gives the line the kind ``undecodable`` and reads nothing from it.
    """
    if encoding not in ("replace", "strict"):
        raise ValueError(f"unknown encoding policy {encoding!r}")
    raw = F.col(value_col)
    undecodable = (~F.is_valid_utf8(raw) if encoding == "strict" else F.lit(False)).alias("_undecodable")
    text = F.make_valid_utf8(raw) if encoding == "replace" else F.when(F.is_valid_utf8(raw), raw)
    df = lines.select(F.col(ord_col).alias("ord"), F.btrim(text, F.lit(WHITE_SPACE)).alias("_line"), undecodable)
    parsed = F.from_json(F.concat(F.lit("["), F.col("_line"), F.lit("]")), ArrayType(schemas.EVE_SCHEMA), {"allowSingleQuotes": "false"})
    # one row each: filters on a parsed field stay above it, so no line is parsed a second time for them
    df = df.select("ord", "_line", "_undecodable", F.explode(F.array(parsed)).alias("_all"))
    blank = F.col("_line").isNull() | (F.col("_line") == "")
    one = F.col("_line").startswith("{") & F.coalesce(F.size("_all") == 1, F.lit(False))
    kind = F.when(F.col("_undecodable"), F.lit("undecodable")).when(blank, F.lit("blank")).when(one, F.lit("event")).otherwise(F.lit("malformed"))
    return df.select("ord", kind.alias("line_kind"), F.when(one, F.get("_all", F.lit(0))).alias("ev"))


def _num(c: str) -> Column:
    """JSON number (or numeric string) -> double; anything else -> null."""
    return F.col(c).try_cast("double")


def _bool(c: str) -> Column:
    return F.col(c).try_cast("boolean")


def typed_events(parsed: DataFrame) -> DataFrame:
    """Keep ``event`` lines and give every field its type (P10 casts via ``try_cast``; see
    schemas.TYPED_EVENT_COLUMNS)."""
    ev = parsed.filter(F.col("line_kind") == "event")
    return ev.select(
        "ord",
        F.col("ev.timestamp").alias("timestamp"),
        F.col("ev.event_type").alias("event_type"),
        F.col("ev.flow_id").try_cast("bigint").alias("flow_id"),
        F.col("ev.src_ip").alias("src_ip"),
        _num("ev.src_port").cast("int").alias("src_port"),
        F.col("ev.dest_ip").alias("dest_ip"),
        _num("ev.dest_port").cast("int").alias("dest_port"),
        F.col("ev.proto").alias("proto"),
        F.col("ev.app_proto").alias("app_proto"),
        F.col("ev.direction").alias("direction"),
        _num("ev.flow.pkts_toserver").alias("pkts_toserver"),
        _num("ev.flow.pkts_toclient").alias("pkts_toclient"),
        _num("ev.flow.bytes_toserver").alias("bytes_toserver"),
        _num("ev.flow.bytes_toclient").alias("bytes_toclient"),
        F.col("ev.flow.start").alias("flow_start"),
        F.col("ev.flow.end").alias("flow_end"),
        _num("ev.flow.age").cast("bigint").alias("flow_age"),
        _bool("ev.flow.alerted").alias("alerted"),
        _bool("ev.tcp.syn").alias("tcp_syn"),
        _bool("ev.tcp.rst").alias("tcp_rst"),
        _bool("ev.tcp.psh").alias("tcp_psh"),
        _bool("ev.tcp.ack").alias("tcp_ack"),
        _bool("ev.tcp.fin").alias("tcp_fin"),
        F.col("ev.flow").isNotNull().alias("has_flow"),
        F.col("ev.tcp").isNotNull().alias("has_tcp"),
        F.col("ev.alert").isNotNull().alias("has_alert"),
        F.col("ev.alert.signature").alias("signature"),
        F.col("ev.alert.category").alias("category"),
        F.col("ev.alert.severity").try_cast("int").alias("severity"),
    )


def read_events(spark: SparkSession, path: str | list[str], observation: Observation | None = None) -> DataFrame:
    """NDJSON files -> typed events (blank and malformed lines skipped).

    ``observation`` (K7) takes the line counters of the first action over the result, with no pass of its own."""
    parsed = parse_event_lines(read_event_lines(spark, path))
    return typed_events(parsed.observe(observation, *line_counters()) if observation is not None else parsed)


def ingest_events(events: DataFrame, path: str) -> DataFrame:
    """Parse once, read many: typed events written as Parquet partitioned by ``event_type``.

    Queries with several consumers of one log (flows and alerts of the comparison) read
    this table instead of re-parsing the JSON text per consumer; each consumer then gets
    partition pruning on ``event_type`` and column pruning.  ``path`` must be in shared
    storage (the session's checkpoint folder for ad-hoc runs).

    The ``rebalance`` hint lets AQE cluster rows by event type and split a dominant type
    into advisory-size partitions before the write, so a partitioned write produces a few
    right-sized files per type instead of one small file per (input split, type)."""
    events.hint("rebalance", "event_type").write.mode("overwrite").partitionBy("event_type").parquet(path)
    return events.sparkSession.read.parquet(path)


def line_counters(undecodable: bool = False) -> list[Column]:
    """Counters of parsed lines (total, blank, malformed, events, flows, alerts, stats), for an
    aggregate or an observation of the pass that reads them anyway."""
    k = F.col("line_kind")
    et = F.col("ev.event_type")
    return [
        F.count(F.lit(1)).alias("lines_total"),
        F.count_if(k == "blank").alias("lines_blank"),
        F.count_if(k == "malformed").alias("lines_malformed"),
        *([F.count_if(k == "undecodable").alias("lines_undecodable")] if undecodable else []),
        F.count_if(k == "event").alias("events"),
        F.count_if((k == "event") & (et == "flow")).alias("flow_events"),
        F.count_if((k == "event") & (et == "alert")).alias("alert_events"),
        F.count_if((k == "event") & et.eqNullSafe("stats")).alias("stats_events"),
    ]


def parse_accounting(parsed: DataFrame, undecodable: bool = False) -> DataFrame:
    """One row of line counters, with ``lines_undecodable`` if asked for (strict encoding).

    A single aggregate over the parsed lines: partial counts per task, one tiny merge.
    """
    return parsed.agg(*line_counters(undecodable))


def event_lines_stream(spark: SparkSession, directory: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """S9 / ST1 / ST3: a directory of rotated (whole, closed) NDJSON files as an unbounded
    stream; while the directory is empty the source simply idles (no polling loop needed).

    Yields (value, file, block, file_mtime); the in-split line position is added per
    micro-batch by ``with_line_order`` (row ids are not available on a streaming frame).
    """
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    df = reader.load(directory)
    return df.select(
        F.col("value"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("_metadata.file_modification_time").alias("file_mtime"),
    )


def event_lines_tail(spark: SparkSession, path: str, **options) -> DataFrame:
    """S9 / ST1 / ST2 / ST5: growing files (one, a folder or a pattern) as an unbounded stream of (value, ord).

    Lines appended while the stream runs are read, rotation is followed, and a batch is let go at 10 waiting
    flow lines or after 5 seconds; see ``tidewatch.sources.tail`` for the options."""
    from tidewatch.sources.tail import TailedFiles

    package_for_workers(spark)
    spark.dataSource.register(TailedFiles)
    settings = {"startingOffsets": "latest", "minLines": "10", "maxDelaySeconds": "5", "countPattern": r'"event_type"\s*:\s*"flow"'} | options
    df = spark.readStream.format("tailed_files").options(path=path, **settings).load()
    return df.select(F.col("value").cast("string").alias("value"), F.struct("file", "block", "pos").alias("ord"))


def event_lines_kafka(
    spark: SparkSession,
    servers: str,
    topic: str,
    starting: str = "latest",
    min_offsets_per_trigger: int | None = 10,
    max_trigger_delay: str = "5s",
) -> DataFrame:
    """S9 / ST2 / ST5 over Kafka: one event per message.

    ``starting="latest"`` ignores the backlog (start at the end of the log); a micro-batch
    fires once ``min_offsets_per_trigger`` messages are waiting or ``max_trigger_delay`` has
    passed, the count-or-time flush of the source scorer.  Offsets live in the query's
    checkpoint, so no line is lost or half-read.  Needs the spark-sql-kafka connector on the
    classpath; without it a clear error is raised."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
    )
    if min_offsets_per_trigger:
        reader = reader.option("minOffsetsPerTrigger", min_offsets_per_trigger).option(
            "maxTriggerDelay", max_trigger_delay)
    try:
        df = reader.load()
    except Exception as e:  # noqa: BLE001
        if "kafka" in str(e).lower():
            raise RuntimeError("Kafka source needs the spark-sql-kafka connector on the classpath") from e
        raise
    return df.select(
        F.col("value").cast("string").alias("value"),
        F.struct(F.col("partition").alias("file"), F.lit(0).cast("bigint").alias("block"),
                 F.col("offset").alias("pos")).alias("ord"),
    )


def with_line_order(batch: DataFrame) -> DataFrame:
    """Attach ``ord`` = (file, block, position) to one micro-batch of stream lines."""
    return batch.select(
        "value",
        F.struct(F.col("file"), F.col("block"), F.monotonically_increasing_id().alias("pos")).alias("ord"),
    )
