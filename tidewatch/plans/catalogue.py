"""Query catalogue: every registered query as (Spark builder, DuckDB oracle SQL or None).

Spark builders take ``(spark, sf_dir)`` and return a lazy DataFrame over the whole driver
tables.  Oracle statements recompute the same result from the raw tables in SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch import schemas
from tidewatch.functions import scalar as X
from tidewatch.operators import correlate as C
from tidewatch.operators import features as FX
from tidewatch.operators import reports as R
from tidewatch.plans import oracle as O
from tidewatch.plans import views as V
from tidewatch.sources.events import parse_accounting

Builder = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Builder] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Builder) -> Builder:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


# ---------------------------------------------------------------------------------------
# Stand-in scorer with an exact SQL twin (the forest itself is checked rows-only)
# ---------------------------------------------------------------------------------------


def rule_scorer(feats: DataFrame) -> DataFrame:
    ddos = F.col("total_fwd_packets") >= 12
    scan = (F.col("syn_flag_count") == 1) & (F.col("destination_port") == 22)
    label = F.when(ddos, F.lit("DDoS")).when(scan, F.lit("PortScan")).otherwise(F.lit(schemas.BENIGN))
    conf = F.when(ddos, F.lit(90.0)).when(scan, F.lit(75.0)).otherwise(F.lit(60.0))
    return feats.withColumn("model_label", label).withColumn("model_confidence_pct", conf)


def _one_pass(spark, sf_dir):
    """Comparison by flow.alerted without alert columns: text scan to verdicts, no hand-off and no join."""
    return C.compare(V.eve_events(spark, sf_dir), rule_scorer, verdict="by_alerted", alert_info=False)


def _compare(spark, sf_dir, verdict, features="cic18"):
    return C.compare(V.eve_table(spark, sf_dir), rule_scorer, verdict=verdict, features=features)


# ---------------------------------------------------------------------------------------
# Event log family
# ---------------------------------------------------------------------------------------


@register("flow_outcome_summary", O.outcome_summary_sql(O.compare_sql("by_alerted")))
def q_flow_outcome_summary(spark, sf_dir):
    """Flagship: S8 F1 FX2 X15 X17 A6."""
    return R.outcome_summary(_one_pass(spark, sf_dir))


@register("flow_outcome_summary_by_alert_match", O.outcome_summary_sql(O.compare_sql("by_alert_match")))
def q_flow_outcome_summary_match(spark, sf_dir):
    """Flagship with the alert-match verdict: S8 F1 F2 FX2 A5 J2 X17 A6."""
    return R.outcome_summary(_compare(spark, sf_dir, "by_alert_match"))


_CMP_COLS = ("ord, flow_id, timestamp, src_ip, src_port, dest_ip, dest_port, proto, app_proto, ids_verdict, "
             "ids_severity, ids_signature, ids_category, model_label, model_confidence_pct")


@register("compare_by_alerted",
          O.compare_sql("by_alerted") + f"\nSELECT {_CMP_COLS}, {O.outcome_sql('ids_verdict', 'model_label')} AS outcome FROM cmp")
def q_compare_by_alerted(spark, sf_dir):
    """FX10 (verdict from flow.alerted): FX8 FX2 ML6 A5 J1 X15 X17, one row per flow event."""
    return _compare(spark, sf_dir, "by_alerted")


@register("compare_by_alert_match",
          O.compare_sql("by_alert_match") + f"\nSELECT {_CMP_COLS}, {O.outcome_sql('ids_verdict', 'model_label')} AS outcome FROM cmp")
def q_compare_by_alert_match(spark, sf_dir):
    """FX10 (verdict = any alert for the flow id): FX8 FX2 ML6 A5 J1 J2 X17."""
    return _compare(spark, sf_dir, "by_alert_match")


@register("compare_reliable_features",
          O.compare_sql("by_alerted", "cic11") + f"\nSELECT {_CMP_COLS}, {O.outcome_sql('ids_verdict', 'model_label')} AS outcome FROM cmp")
def q_compare_reliable(spark, sf_dir):
    """FX3 + P5 + FX10: the 11 reliable features, the 7 others zero-filled before scoring."""
    return _compare(spark, sf_dir, "by_alerted", features="cic11")


@register("detection_rates", O.compare_sql("by_alerted") + f""",
o AS (SELECT {O.outcome_sql('ids_verdict', 'model_label')} AS outcome FROM cmp),
c AS (SELECT count(*) AS n,
             count(*) FILTER (WHERE outcome IN ('BOTH', 'IDS_ONLY')) AS ids,
             count(*) FILTER (WHERE outcome IN ('BOTH', 'MODEL_ONLY')) AS model FROM o)
SELECT CAST(n AS BIGINT) AS total, CAST(ids AS BIGINT) AS ids_detected, CAST(model AS BIGINT) AS model_detected,
       CASE WHEN n > 0 THEN round_even(CAST(ids AS DOUBLE) * 100.0::DOUBLE / CAST(n AS DOUBLE), 4) END AS ids_rate_pct,
       CASE WHEN n > 0 THEN round_even(CAST(model AS DOUBLE) * 100.0::DOUBLE / CAST(n AS DOUBLE), 4) END AS model_rate_pct
FROM c""")
def q_detection_rates(spark, sf_dir):
    """Sensor and model detection rates over the comparison rows."""
    return R.detection_rates(_one_pass(spark, sf_dir))


_F18 = ", ".join(schemas.CIC_18)


@register("flow_features_18", f"WITH {O.EVE_CTE}, {O.FLOW_BASE}\nSELECT ord, flow_id, {O.flow18_select()} FROM fb")
def q_flow_features_18(spark, sf_dir):
    """FX2: flow events -> the 18 model features."""
    return FX.flow_features_18(V.eve_events(spark, sf_dir))


@register("flow_features_stream_rules",
          f"WITH {O.EVE_CTE}, {O.FLOW_BASE}\nSELECT ord, flow_id, {O.flow18_select(rounded=False, floor_1us=True)} FROM fb")
def q_flow_features_stream_rules(spark, sf_dir):
    """FX4 (live-scoring rules) on the batch table; the stream query reuses the same function."""
    return FX.flow_features_stream_rules(V.eve_events(spark, sf_dir))


_F11_SQL = ", ".join(schemas.CIC_11)


@register("flow_features_11",
          f"WITH {O.EVE_CTE}, {O.FLOW_BASE}, f AS (SELECT ord, flow_id, {O.flow18_select()} FROM fb)\n"
          f"SELECT ord, flow_id, {_F11_SQL} FROM f")
def q_flow_features_11(spark, sf_dir):
    """FX3: the 11 features a flow log measures reliably."""
    return FX.flow_features_11(V.eve_events(spark, sf_dir))


@register("flow_features_16", f"""WITH {O.EVE_CTE}, {O.FLOW_BASE}, f AS (SELECT ord, flow_id, alerted, dest_port AS dp, {O.flow18_select()} FROM fb)
SELECT ord, flow_id,
  COALESCE(dp, 0) AS destination_port, flow_duration,
  CAST(total_fwd_packets AS BIGINT) AS total_fwd_packets, CAST(total_backward_packets AS BIGINT) AS total_backward_packets,
  CAST(total_length_fwd_packets AS BIGINT) AS total_length_fwd_packets,
  CAST(total_length_bwd_packets AS BIGINT) AS total_length_bwd_packets,
  fwd_packet_length_mean, bwd_packet_length_mean, flow_bytes_per_s, flow_packets_per_s,
  CAST(syn_flag_count AS INTEGER) AS syn_flag_count, CAST(rst_flag_count AS INTEGER) AS rst_flag_count,
  CAST(psh_flag_count AS INTEGER) AS psh_flag_count, CAST(ack_flag_count AS INTEGER) AS ack_flag_count,
  average_packet_size,
  CASE WHEN COALESCE(alerted, FALSE) THEN 'ALERT' ELSE 'BENIGN' END AS label
FROM f""")
def q_flow_features_16(spark, sf_dir):
    """FX1: converted flow table (15 features + label from flow.alerted)."""
    return FX.flow_features_16(V.eve_events(spark, sf_dir))


@register("preprocessed_flows", f"""WITH {O.EVE_CTE}, {O.FLOW_BASE}, f AS (
  SELECT ord, flow_id, timestamp, src_ip, src_port, dest_ip, dest_port AS dp, proto, app_proto, alerted,
         {O.flow18_select()} FROM fb)
SELECT ord, flow_id, timestamp, src_ip, src_port, dest_ip, dp AS dest_port, proto, app_proto,
  CASE WHEN COALESCE(alerted, FALSE) THEN 'ALERT' ELSE 'BENIGN' END AS ids_verdict_alerted,
  {', '.join(schemas.CIC_11)}
FROM f""")
def q_preprocessed_flows(spark, sf_dir):
    """FX8 + FX3 + J4: flow identity, sensor verdict and the 11 reliable features side by side
    in one projection (the source concatenates two frames by position)."""
    ev = V.eve_events(spark, sf_dir)
    meta_cols = ["ord", "flow_id", "timestamp", "src_ip", "src_port", "dest_ip", "dest_port", "proto", "app_proto"]
    feats = FX.flow_features_11(ev, keep=[*meta_cols, "alerted"])
    return feats.select(*meta_cols, X.verdict_from_alerted("alerted").alias("ids_verdict_alerted"), *schemas.CIC_11)


@register("alert_extract", f"""WITH {O.EVE_CTE}
SELECT ord, COALESCE(timestamp, '') AS timestamp, COALESCE(src_ip, '') AS src_ip, COALESCE(dest_ip, '') AS dest_ip,
       COALESCE(CAST(dest_port AS VARCHAR), '') AS dest_port, COALESCE(signature, '') AS signature,
       COALESCE(CAST(severity AS VARCHAR), '') AS severity
FROM eve WHERE event_type = 'alert'""")
def q_alert_extract(spark, sf_dir):
    """F2 + FX7: alert events -> alert table, missing values as ''."""
    return FX.alert_extract(V.eve_events(spark, sf_dir))


@register("best_alert_per_flow", f"""WITH {O.EVE_CTE}, {O.BEST_ALERT}
SELECT flow_id, severity, signature, category, CAST(n_alerts AS BIGINT) AS n_alerts FROM best""")
def q_best_alert_per_flow(spark, sf_dir):
    """A5 + X21: lowest severity per flow id (missing = 99), earliest on a tie."""
    return C.best_alert_per_flow(V.eve_events(spark, sf_dir))


@register("flows_with_best_alert", f"""WITH {O.EVE_CTE}, {O.BEST_ALERT}
SELECT f.ord, f.flow_id, f.timestamp, f.src_ip, f.src_port, f.dest_ip, f.dest_port, f.proto, f.app_proto,
  CASE WHEN COALESCE(f.alerted, FALSE) THEN 'ALERT' ELSE 'BENIGN' END AS ids_verdict_alerted,
  CASE WHEN b.n_alerts IS NULL THEN '-' ELSE COALESCE(CAST(b.severity AS VARCHAR), '') END AS ids_severity,
  CASE WHEN b.n_alerts IS NULL THEN '-' ELSE COALESCE(b.signature, '') END AS ids_signature,
  CASE WHEN b.n_alerts IS NULL THEN '-' ELSE COALESCE(b.category, '') END AS ids_category,
  b.n_alerts IS NOT NULL AS _has_alert
FROM eve f LEFT JOIN best b ON f.flow_id IS NOT DISTINCT FROM b.flow_id
WHERE f.event_type = 'flow'""")
def q_flows_with_best_alert(spark, sf_dir):
    """J1 + J2 (existence flag ``_has_alert``)."""
    return C.flows_with_best_alert(V.eve_table(spark, sf_dir))


@register("existence_flag", f"""WITH {O.EVE_CTE}
SELECT f.ord, f.flow_id, EXISTS (SELECT 1 FROM eve a WHERE a.event_type = 'alert'
                                 AND a.flow_id IS NOT DISTINCT FROM f.flow_id) AS has_alert
FROM eve f WHERE f.event_type = 'flow'""")
def q_existence_flag(spark, sf_dir):
    """The sensor verdict of the alert-match rule, as a flag per flow event."""
    return C.alert_existence(V.eve_table(spark, sf_dir))


@register("parse_accounting", """
SELECT CAST(count(*) + count(*) FILTER (WHERE event_id % 83 = 0) AS BIGINT) AS lines_total,
  CAST(count(*) FILTER (WHERE event_id % 83 = 0) AS BIGINT) AS lines_blank,
  CAST(count(*) FILTER (WHERE event_id % 89 = 0 OR event_id % 71 = 0) AS BIGINT) AS lines_malformed,
  CAST(count(*) FILTER (WHERE event_id % 89 <> 0 AND event_id % 71 <> 0) AS BIGINT) AS events,
  CAST(count(*) FILTER (WHERE event_id % 89 <> 0 AND event_id % 71 <> 0 AND NOT (event_type = 'error' AND user_id % 3 = 0)
     AND event_type NOT IN ('signup', 'view') AND NOT (event_type = 'purchase' AND event_id % 50 = 0)) AS BIGINT) AS flow_events,
  CAST(count(*) FILTER (WHERE event_id % 89 <> 0 AND event_id % 71 <> 0 AND event_type = 'error' AND user_id % 3 = 0) AS BIGINT)
     AS alert_events,
  CAST(count(*) FILTER (WHERE event_id % 89 <> 0 AND event_id % 71 <> 0 AND event_type = 'signup') AS BIGINT) AS stats_events
FROM events""")
def q_parse_accounting(spark, sf_dir):
    """S8 + F7 + K7: line counters in one aggregate pass."""
    return parse_accounting(V.eve_parsed(spark, sf_dir))


@register("event_counts", f"""WITH {O.EVE_CTE}
SELECT CAST(count(*) FILTER (WHERE event_type = 'flow') AS BIGINT) AS flow_events,
       CAST(count(*) FILTER (WHERE event_type = 'alert') AS BIGINT) AS alert_rows,
       CAST((SELECT count(*) FROM (SELECT DISTINCT flow_id FROM eve WHERE event_type = 'alert')) AS BIGINT) AS alerted_flow_ids
FROM eve""")
def q_event_counts(spark, sf_dir):
    """A8."""
    return R.event_counts(V.eve_events(spark, sf_dir))


@register("kisti_map_events", f"""WITH {O.EVE_CTE}, {O.KISTI_MAP}
SELECT ord, uid, "sourceIP", "destinationIP", "sourcePort", "destinationPort", protocol, "attackType",
       "eventCount", "analyResult", duration, "packetSize" FROM km""")
def q_kisti_map_events(spark, sf_dir):
    """FX5 + X8 + J8 + F3."""
    return FX.kisti_map_events(V.eve_events(spark, sf_dir))


@register("kisti_dedup_uid", f"""WITH {O.EVE_CTE}, {O.KISTI_MAP}
SELECT uid,
  arg_min("sourceIP", ord) FILTER (WHERE "sourceIP" IS NOT NULL) AS "sourceIP",
  arg_min("destinationIP", ord) FILTER (WHERE "destinationIP" IS NOT NULL) AS "destinationIP",
  arg_min("sourcePort", ord) FILTER (WHERE "sourcePort" IS NOT NULL) AS "sourcePort",
  arg_min("destinationPort", ord) FILTER (WHERE "destinationPort" IS NOT NULL) AS "destinationPort",
  arg_min(protocol, ord) FILTER (WHERE protocol IS NOT NULL) AS protocol,
  max("attackType") AS "attackType", max("eventCount") AS "eventCount", max("analyResult") AS "analyResult",
  max(duration) AS duration, max("packetSize") AS "packetSize"
FROM km WHERE uid IS NOT NULL GROUP BY uid""")
def q_kisti_dedup_uid(spark, sf_dir):
    """FX5 + A4."""
    return C.dedup_by_uid(FX.kisti_map_events(V.eve_events(spark, sf_dir)))


@register("kisti_extract_features", f"""WITH {O.EVE_CTE}
SELECT ord, COALESCE(src_port, 0) AS "sourcePort", COALESCE(dest_port, 0) AS "destinationPort",
  CAST({O.PROTO_CODE_SQL} AS INTEGER) AS protocol,
  CAST(CASE direction WHEN 'to_server' THEN 0 WHEN 'to_client' THEN 1 ELSE -1 END AS INTEGER) AS "directionType",
  CAST(COALESCE(bytes_toserver, 0.0) + COALESCE(bytes_toclient, 0.0) AS BIGINT) AS "packetSize",
  CAST(COALESCE(pkts_toserver, 0.0) + COALESCE(pkts_toclient, 0.0) AS BIGINT) AS "eventCount",
  CAST(CASE WHEN COALESCE(pkts_toserver, 0.0) + COALESCE(pkts_toclient, 0.0) > 0
       AND (COALESCE(bytes_toserver, 0.0) + COALESCE(bytes_toclient, 0.0))
           / (COALESCE(pkts_toserver, 0.0) + COALESCE(pkts_toclient, 0.0)) > 1500 THEN 1 ELSE 0 END AS INTEGER)
       AS "jumboPayloadFlag",
  COALESCE(severity, 0) AS "analyResult",
  CAST(COALESCE(bytes_toserver, 0.0) AS BIGINT) AS flow_bytes_toserver,
  CAST(COALESCE(bytes_toclient, 0.0) AS BIGINT) AS flow_bytes_toclient,
  CAST(COALESCE(pkts_toserver, 0.0) AS BIGINT) AS flow_pkts_toserver,
  CAST(COALESCE(pkts_toclient, 0.0) AS BIGINT) AS flow_pkts_toclient,
  COALESCE(flow_age, 0) AS flow_age,
  CAST(COALESCE(tcp_syn, FALSE) AS INTEGER) AS tcp_syn, CAST(COALESCE(tcp_ack, FALSE) AS INTEGER) AS tcp_ack,
  CAST(COALESCE(tcp_fin, FALSE) AS INTEGER) AS tcp_fin, CAST(COALESCE(tcp_psh, FALSE) AS INTEGER) AS tcp_psh,
  COALESCE(severity, 0) AS alert_severity,
  CASE WHEN is_alert THEN 1 ELSE 0 END AS "Label"
FROM eve WHERE event_type IS NULL OR event_type <> 'stats'""")
def q_kisti_extract_features(spark, sf_dir):
    """FX6 + F3 + F8 + X14."""
    return FX.kisti_extract_features(V.eve_events(spark, sf_dir))


@register("signature_class", f"""
SELECT CAST({O.signature_class_sql("replace(text, 'ß', 'ss')")} AS INTEGER) AS attack_type,
       CAST(count(*) AS BIGINT) AS n
FROM documents GROUP BY 1""")
def q_signature_class(spark, sf_dir):
    """X2 + A2 over whole document texts: keyword class per text, counted per class."""
    docs = V.table(spark, sf_dir, "documents")
    classes = docs.select(X.signature_class("text").alias("attack_type"))
    return classes.groupBy("attack_type").agg(F.count(F.lit(1)).alias("n"))


# other query families register themselves on import
from tidewatch.plans import q_tables  # noqa: E402,F401
from tidewatch.plans import q_reports  # noqa: E402,F401
from tidewatch.plans import q_learning  # noqa: E402,F401
from tidewatch.plans import q_gap  # noqa: E402,F401
