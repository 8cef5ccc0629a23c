"""Command line: the everyday workflows as Spark jobs.

    python -m tidewatch ingest   LOG TABLE           # parse once -> Parquet partitioned by event type
    python -m tidewatch convert  LOG OUT             # flow events -> converted flow table (CSV)
    python -m tidewatch alerts   LOG OUT             # alert events -> alert table (CSV)
    python -m tidewatch train    CSV_DIR MODEL       # labelled flows -> forest (+ report)
    python -m tidewatch compare  LOG MODEL OUT       # sensor vs forest, summary + rates
    python -m tidewatch kisti-map     LOG OUT        # events -> per-uid KISTI rows
    python -m tidewatch kisti-extract LOG OUT        # events -> KISTI feature rows
    python -m tidewatch stream   LOG_DIR MODEL OUT CHECKPOINT   # live scoring

LOG is a file, folder or glob of NDJSON event logs; outputs are folders of CSV part files
with the source header text.  Runs on whatever master ``spark-submit`` provides.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import Observation, SparkSession
from pyspark.sql import functions as F

from tidewatch import schemas
from tidewatch.operators import clean as CL
from tidewatch.operators import correlate as C
from tidewatch.operators import features as FX
from tidewatch.operators import learning as L
from tidewatch.operators import reports as R
from tidewatch.operators import sampling as M
from tidewatch.session import scratch_path
from tidewatch.sinks import as_reference_headers, write_csv
from tidewatch.sources import tables as T
from tidewatch.sources.events import ingest_events, read_events

PRINT_ROWS = 1_000_000  # reports have a row per class or column: print them whole


def _session() -> SparkSession:
    return SparkSession.builder.appName("tidewatch").getOrCreate()


def _accounted(lines: Observation) -> dict:
    """Print what the pass that just ended has read, kept and skipped; returns the counters."""
    n = lines.get
    print(f"lines {n['lines_total']}: events {n['events']}, skipped {n['lines_blank'] + n['lines_malformed']} "
          f"(blank {n['lines_blank']}, malformed {n['lines_malformed']}); flows {n['flow_events']}, alerts {n['alert_events']}")
    return n


def _no_flows() -> int:
    """the exit status of a command that needs flows and got none."""
    print("no flow events in the input: is the flow type switched on in the sensor?", file=sys.stderr)
    return 1


def cmd_ingest(spark, a):
    """S8 K7 + parse-once table: typed events as Parquet partitioned by ``event_type``."""
    lines = Observation("lines")
    ingest_events(read_events(spark, a.log, lines), a.table)
    _accounted(lines)


def cmd_convert(spark, a):
    """FX1 + K4 + K7 + F11: converted flow table with the source headers."""
    lines = Observation("lines")
    write_csv(as_reference_headers(FX.flow_features_16(read_events(spark, a.log, lines), keep=())), a.out)
    return 0 if _accounted(lines)["flow_events"] else _no_flows()


def cmd_alerts(spark, a):
    """FX7 + K4 + K7."""
    lines = Observation("lines")
    write_csv(FX.alert_extract(read_events(spark, a.log, lines)).drop("ord"), a.out)
    _accounted(lines)


def cmd_train(spark, a):
    """S1 P1 F4 F5 ML1 M2 ML4 ML10 A13 ML8 K5: train on a folder of labelled flow CSVs."""
    raw = T.read_labelled_flows(spark, a.csv_dir, headers=T.read_header(spark, a.csv_dir))
    snake = {v: k for k, v in schemas.CIC_HEADERS.items()}
    df = CL.clean_finite(raw.select(*[F.col(f"`{c}`").alias(snake.get(c, c)) for c in raw.columns]))
    df = df.withColumn("_key", F.xxhash64(*df.columns))
    df = M.stratified_split(df, "label", "_key", 0.2, 42)
    feats = [c for c in schemas.CIC_18 if c in df.columns]
    model = L.train_forest(df.filter(~F.col("is_test")), feats, label="label", num_trees=a.trees, max_depth=a.depth)
    L.save_model(model, a.model)
    scored = L.score(model, df.filter(F.col("is_test")))
    R.classification_report(scored.select(F.col("label").alias("y"), F.col("model_label").alias("p"))).show(PRINT_ROWS, truncate=False)
    R.top_k(L.feature_importances(model, spark), "importance", 10).show(PRINT_ROWS, truncate=False)


def cmd_compare(spark, a):
    """S10 S8 K7 F11 FX2/FX3 ML6 A5 J1/J2 X17 A6 A7 K1: sensor vs forest per flow."""
    model = L.load_model(a.model)
    if a.typed:  # an ingested table: partition pruning on event_type, no JSON parse
        events = spark.read.parquet(a.log)
        if FX.flow_events(events).isEmpty():
            return _no_flows()
    else:
        lines = Observation("lines")
        events = ingest_events(read_events(spark, a.log, lines), scratch_path(spark, "events"))
        if not _accounted(lines)["flow_events"]:
            return _no_flows()
    feats = "cic11" if a.reliable else "cic18"
    cmp = C.compare(events, lambda f: L.score(model, f), verdict=a.verdict, features=feats)
    write_csv(as_reference_headers(cmp.drop("ord")), a.out)
    R.outcome_summary(cmp).orderBy("rank").show(PRINT_ROWS, truncate=False)
    R.detection_rates(cmp).show(PRINT_ROWS, truncate=False)


def cmd_kisti_map(spark, a):
    """FX5 A4 A2 A9 A10 K1."""
    rows = C.dedup_by_uid(FX.kisti_map_events(read_events(spark, a.log)))
    write_csv(rows, a.out)
    R.value_counts_by_key(rows, "attackType").show(PRINT_ROWS, truncate=False)
    R.numeric_profile(rows, ["duration", "packetSize"]).show(PRINT_ROWS, truncate=False)
    R.null_profile(rows).show(PRINT_ROWS, truncate=False)


def cmd_kisti_extract(spark, a):
    """FX6 F8 A1 K1."""
    rows = FX.kisti_extract_features(read_events(spark, a.log)).drop("ord")
    write_csv(rows, a.out)
    R.value_counts_sorted(rows, "Label").show(PRINT_ROWS, truncate=False)


def cmd_stream(spark, a):
    """ST1–ST6: score rotated log files as they arrive (Ctrl-C to stop)."""
    from tidewatch.streaming.scoring import start_scoring_stream

    model = L.load_model(a.model)
    q = start_scoring_stream(spark, a.log_dir, a.out, a.checkpoint, lambda f: L.score(model, f),
                             start_at_end=a.from_end, ordinal=True)
    q.awaitTermination()


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="tidewatch", description=__doc__.split("\n")[0])
    sub = p.add_subparsers(dest="cmd", required=True)
    s = sub.add_parser("ingest"); s.add_argument("log"); s.add_argument("table"); s.set_defaults(fn=cmd_ingest)  # noqa: E702
    s = sub.add_parser("convert"); s.add_argument("log"); s.add_argument("out"); s.set_defaults(fn=cmd_convert)  # noqa: E702
    s = sub.add_parser("alerts"); s.add_argument("log"); s.add_argument("out"); s.set_defaults(fn=cmd_alerts)  # noqa: E702
    s = sub.add_parser("train")
    s.add_argument("csv_dir"); s.add_argument("model")  # noqa: E702
    s.add_argument("--trees", type=int, default=100); s.add_argument("--depth", type=int, default=10)  # noqa: E702
    s.set_defaults(fn=cmd_train)
    s = sub.add_parser("compare")
    s.add_argument("log"); s.add_argument("model"); s.add_argument("out")  # noqa: E702
    s.add_argument("--verdict", choices=["by_alerted", "by_alert_match"], default="by_alerted")
    s.add_argument("--reliable", action="store_true", help="score the 11 reliable features only")
    s.add_argument("--typed", action="store_true", help="LOG is a table written by `ingest`")
    s.set_defaults(fn=cmd_compare)
    s = sub.add_parser("kisti-map"); s.add_argument("log"); s.add_argument("out"); s.set_defaults(fn=cmd_kisti_map)  # noqa: E702
    s = sub.add_parser("kisti-extract"); s.add_argument("log"); s.add_argument("out")  # noqa: E702
    s.set_defaults(fn=cmd_kisti_extract)
    s = sub.add_parser("stream")
    s.add_argument("log_dir"); s.add_argument("model"); s.add_argument("out"); s.add_argument("checkpoint")  # noqa: E702
    s.add_argument("--from-end", action="store_true", help="skip files that exist when the stream starts")
    s.set_defaults(fn=cmd_stream)
    a = p.parse_args(argv)
    return a.fn(_session(), a) or 0


if __name__ == "__main__":
    sys.exit(main())
