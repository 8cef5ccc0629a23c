"""Report queries: distributions, profiles, metrics, previews, code lookups, ordinal zip."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch import schemas
from tidewatch.functions import scalar as X
from tidewatch.operators import clean as CL
from tidewatch.operators import correlate as C
from tidewatch.operators import features as FX
from tidewatch.operators import learning as L
from tidewatch.operators import reports as R
from tidewatch.plans import oracle as O
from tidewatch.plans import views as V
from tidewatch.plans.catalogue import _compare, register
from tidewatch.plans.q_tables import CIC_SQL, KISTI_SQL, _snake
from tidewatch.session import handed_off

# ---------------------------------------------------------------------------------------
# A1 A2 A3 W2 A11
# ---------------------------------------------------------------------------------------


@register("label_distribution", f"""WITH {CIC_SQL}
SELECT label, CAST(count(*) AS BIGINT) AS count FROM cic WHERE label IS NOT NULL GROUP BY label""")
def q_label_distribution(spark, sf_dir):
    """A1: value counts of the flow label (nulls excluded)."""
    return R.value_counts_sorted(_snake(V.cic_frame(spark, sf_dir)), "label")


@register("label_distribution_by_key", f"""WITH {KISTI_SQL}
SELECT "attackType", CAST(count(*) AS BIGINT) AS count FROM kr GROUP BY "attackType" """)
def q_label_distribution_by_key(spark, sf_dir):
    """A2: attack-type counts ordered by code."""
    return R.value_counts_by_key(V.kisti_frame(spark, sf_dir), "attackType")


@register("label_share", f"""WITH {CIC_SQL},
c AS (SELECT label, count(*) AS n FROM cic WHERE label IS NOT NULL GROUP BY label)
SELECT label, CAST(n AS BIGINT) AS count,
       round_even(CAST(n AS DOUBLE) * 100.0::DOUBLE / CAST(sum(n) OVER () AS DOUBLE), 4) AS share_pct FROM c""")
def q_label_share(spark, sf_dir):
    """A3 + W2: count and share of the total per label."""
    return R.value_shares(_snake(V.cic_frame(spark, sf_dir)), "label")


@register("distinct_values", f"""WITH {KISTI_SQL} SELECT DISTINCT "attackType" FROM kr""")
def q_distinct_values(spark, sf_dir):
    """A11."""
    return R.distinct_values(V.kisti_frame(spark, sf_dir), "attackType")


# ---------------------------------------------------------------------------------------
# A9 A10 — profiles of the mapped KISTI rows
# ---------------------------------------------------------------------------------------
def _prof(c: str) -> str:
    return f"""SELECT '{c}' AS "column", CAST(count({c}) AS BIGINT) AS count,
  round_even(avg({c}), 4) AS mean, round_even(stddev_samp({c}), 4) AS std,
  round_even(CAST(min({c}) AS DOUBLE), 4) AS min,
  round_even(quantile_cont({c}, 0.25), 4) AS p25, round_even(quantile_cont({c}, 0.5), 4) AS p50,
  round_even(quantile_cont({c}, 0.75), 4) AS p75, round_even(CAST(max({c}) AS DOUBLE), 4) AS max FROM kr"""


@register("numeric_profile", f"WITH {KISTI_SQL}\n{_prof('duration')}\nUNION ALL\n{_prof(chr(34) + 'packetSize' + chr(34))}"
          .replace("'\"packetSize\"' AS", "'packetSize' AS"))
def q_numeric_profile(spark, sf_dir):
    """A9 (describe): count, mean, std, min, exact quartiles, max of duration and packetSize."""
    raw = V.kisti_frame(spark, sf_dir).withColumn("duration", X.seconds_between_compact("detectStart", "detectEnd"))
    return R.numeric_profile(raw, ["duration", "packetSize"])


@register("null_profile", f"""WITH {KISTI_SQL},
c AS (SELECT count(*) FILTER (WHERE "sourceIP" IS NULL) AS a, count(*) FILTER (WHERE "destinationPort" IS NULL) AS b,
             count(*) FILTER (WHERE "analyResult" IS NULL) AS c, count(*) FILTER (WHERE duration IS NULL) AS d,
             count(*) FILTER (WHERE "packetSize" IS NULL) AS e, count(*) FILTER (WHERE uid IS NULL) AS f FROM kr)
SELECT * FROM (
  SELECT 'sourceIP' AS "column", CAST(a AS BIGINT) AS nulls FROM c UNION ALL
  SELECT 'destinationPort', CAST(b AS BIGINT) FROM c UNION ALL
  SELECT 'analyResult', CAST(c AS BIGINT) FROM c UNION ALL
  SELECT 'duration', CAST(d AS BIGINT) FROM c UNION ALL
  SELECT 'packetSize', CAST(e AS BIGINT) FROM c UNION ALL
  SELECT 'uid', CAST(f AS BIGINT) FROM c) t WHERE nulls > 0""")
def q_null_profile(spark, sf_dir):
    """A10: null count per column (nonzero only), after null-token normalisation."""
    raw = CL.normalise_nulls(V.kisti_frame(spark, sf_dir))
    raw = raw.withColumn("duration", X.seconds_between_compact("detectStart", "detectEnd"))
    return R.null_profile(raw, ["sourceIP", "destinationPort", "analyResult", "duration", "packetSize", "uid"])


# ---------------------------------------------------------------------------------------
# A12 A13 A14 U3 — metrics on (y = quality, p = toxic)
# ---------------------------------------------------------------------------------------
_PER_CLASS = """
cells AS (SELECT quality AS y, toxic AS p, count(*) AS n FROM labels GROUP BY 1, 2),
lab AS (SELECT y AS label FROM cells UNION SELECT p FROM cells),
per AS (
  SELECT lab.label,
    COALESCE((SELECT sum(n) FROM cells WHERE y = lab.label), 0) AS support,
    COALESCE((SELECT sum(n) FROM cells WHERE y = lab.label AND p = lab.label), 0) AS tp,
    COALESCE((SELECT sum(n) FROM cells WHERE p = lab.label), 0) AS predicted
  FROM lab),
m AS (
  SELECT label, support, tp,
    CASE WHEN predicted > 0 THEN CAST(tp AS DOUBLE) / CAST(predicted AS DOUBLE) ELSE 0.0 END AS precision,
    CASE WHEN support > 0 THEN CAST(tp AS DOUBLE) / CAST(support AS DOUBLE) ELSE 0.0 END AS recall
  FROM per),
f AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2.0 * precision * recall / (precision + recall) ELSE 0.0 END AS f1 FROM m)"""


@register("classification_report", f"""WITH {_PER_CLASS}
SELECT CAST(label AS VARCHAR) AS label, round_even(precision, 4) AS precision, round_even(recall, 4) AS recall,
       round_even(f1, 4) AS f1, CAST(support AS BIGINT) AS support FROM f
UNION ALL
SELECT 'accuracy', NULL, NULL, round_even(CAST(sum(tp) AS DOUBLE) / CAST(sum(support) AS DOUBLE), 4),
       CAST(sum(support) AS BIGINT) FROM f
UNION ALL
SELECT 'macro avg', round_even(avg(precision), 4), round_even(avg(recall), 4), round_even(avg(f1), 4),
       CAST(sum(support) AS BIGINT) FROM f
UNION ALL
SELECT 'weighted avg', round_even(sum(precision * support) / sum(support), 4),
       round_even(sum(recall * support) / sum(support), 4), round_even(sum(f1 * support) / sum(support), 4),
       CAST(sum(support) AS BIGINT) FROM f""")
def q_classification_report(spark, sf_dir):
    """A13."""
    return R.classification_report(V.pred_pairs(spark, sf_dir))


@register("accuracy", """SELECT avg(CASE WHEN quality = toxic THEN 1.0 ELSE 0.0 END)::DOUBLE AS accuracy,
       CAST(count(*) AS BIGINT) AS n FROM labels""")
def q_accuracy(spark, sf_dir):
    """A12."""
    return R.accuracy(V.pred_pairs(spark, sf_dir))


@register("confusion_matrix", """SELECT quality AS y, toxic AS p, CAST(count(*) AS BIGINT) AS n FROM labels GROUP BY 1, 2""")
def q_confusion_matrix(spark, sf_dir):
    """A14 (long form)."""
    return R.confusion_matrix(V.pred_pairs(spark, sf_dir))


@register("label_union", """SELECT quality AS label FROM labels UNION SELECT toxic FROM labels""")
def q_label_union(spark, sf_dir):
    """U3."""
    return R.label_union(V.pred_pairs(spark, sf_dir))


@register("balanced_weights", f"""WITH {CIC_SQL},
c AS (SELECT label, count(*) AS nc FROM cic WHERE label IS NOT NULL GROUP BY label)
SELECT label, round_even(CAST(sum(nc) OVER () AS DOUBLE) / (CAST(count(*) OVER () AS DOUBLE) * nc), 6) AS weight,
       CAST(nc AS BIGINT) AS n FROM c""")
def q_balanced_weights(spark, sf_dir):
    """ML5 weights n / (k · n_class) per label."""
    df = _snake(V.cic_frame(spark, sf_dir)).filter(F.col("label").isNotNull())
    w = L.class_balanced_weights(df, "label")
    return w.groupBy("label").agg(F.bround(F.first("weight"), 6).alias("weight"), F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------------------------------
# O3 F9 F10 ML11 — previews, threat rows, scored report
# ---------------------------------------------------------------------------------------
@register("topk_preview", f"""WITH {O.EVE_CTE}, {O.FLOW_BASE}
SELECT ord, flow_id, {O.flow18_select()} FROM fb ORDER BY ord LIMIT 3""")
def q_topk_preview(spark, sf_dir):
    """O3: first three converted flow rows in input order (the limit is the feature)."""
    return R.preview(FX.flow_features_18(V.eve_events(spark, sf_dir)), "ord", 3)


_CMP_COLS = ("ord, flow_id, timestamp, src_ip, src_port, dest_ip, dest_port, proto, app_proto, ids_verdict, "
             "ids_severity, ids_signature, ids_category, model_label, model_confidence_pct")


@register("threat_rows", O.compare_sql("by_alerted") + f"""
SELECT {_CMP_COLS}, {O.outcome_sql('ids_verdict', 'model_label')} AS outcome FROM cmp WHERE ids_verdict = 'ALERT'""")
def q_threat_rows(spark, sf_dir):
    """comparison rows the sensor alerted on."""
    return _compare(spark, sf_dir, "by_alerted").filter(F.col("ids_verdict") == schemas.ALERT)


def _kisti_scored(spark, sf_dir):
    """Mapped + deduplicated log rows, features null-filled (F8), scored by a fixed code rule."""
    rows = C.dedup_by_uid(FX.kisti_map_events(V.eve_events(spark, sf_dir)))
    rows = CL.fill_zero(rows, schemas.KISTI_FEATURES_V2)
    code = (F.when(F.col("attackType") > 0, F.col("attackType"))
            .when(F.col("eventCount") >= 18, F.lit(5)).when(F.col("destinationPort") == 22, F.lit(9)).otherwise(F.lit(0)))
    conf = F.bround(F.lit(0.5) + (F.col("eventCount") % 5).cast("double") / F.lit(10.0), 4)
    return rows.withColumn("pred_code", code).withColumn("pred_label", X.attack_label("pred_code")).withColumn(
        "confidence", conf)


_KSC = f"""WITH {O.EVE_CTE}, {O.KISTI_MAP},
dd AS (
  SELECT uid,
    arg_min("sourceIP", ord) FILTER (WHERE "sourceIP" IS NOT NULL) AS "sourceIP",
    arg_min("destinationIP", ord) FILTER (WHERE "destinationIP" IS NOT NULL) AS "destinationIP",
    arg_min("sourcePort", ord) FILTER (WHERE "sourcePort" IS NOT NULL) AS "sourcePort",
    arg_min("destinationPort", ord) FILTER (WHERE "destinationPort" IS NOT NULL) AS "destinationPort",
    arg_min(protocol, ord) FILTER (WHERE protocol IS NOT NULL) AS protocol,
    max("attackType") AS "attackType", max("eventCount") AS "eventCount", max("analyResult") AS "analyResult",
    max(duration) AS duration, max("packetSize") AS "packetSize"
  FROM km WHERE uid IS NOT NULL GROUP BY uid),
filled AS (
  SELECT uid, "sourceIP", "destinationIP", COALESCE("sourcePort", 0) AS "sourcePort",
    COALESCE("destinationPort", 0) AS "destinationPort", COALESCE(protocol, 0) AS protocol, "attackType",
    COALESCE("eventCount", 0) AS "eventCount", "analyResult", COALESCE(duration, 0) AS duration,
    COALESCE("packetSize", 0.0) AS "packetSize" FROM dd),
sc AS (
  SELECT *, CASE WHEN "attackType" > 0 THEN "attackType" WHEN "eventCount" >= 18 THEN 5
                 WHEN "destinationPort" = 22 THEN 9 ELSE 0 END AS pred_code,
         round_even(0.5 + CAST("eventCount" % 5 AS DOUBLE) / 10.0, 4) AS confidence FROM filled),
lab AS (
  SELECT *, CASE pred_code WHEN 0 THEN 'UNKNOWN' WHEN 1 THEN 'Worm' WHEN 2 THEN 'WebAttack'
    WHEN 3 THEN 'SystemExploit' WHEN 4 THEN 'Scanning' WHEN 5 THEN 'Other' ELSE CAST(pred_code AS VARCHAR) END AS pred_label
  FROM sc)"""


@register("scored_report", _KSC + """,
c AS (SELECT pred_label, count(*) AS n FROM lab GROUP BY 1)
SELECT pred_label, CAST(n AS BIGINT) AS count,
       round_even(CAST(n AS DOUBLE) * 100.0::DOUBLE / CAST(sum(n) OVER () AS DOUBLE), 4) AS share_pct FROM c""")
def q_scored_report(spark, sf_dir):
    """ML11 + A3: predicted-label distribution with shares."""
    return R.value_shares(_kisti_scored(spark, sf_dir), "pred_label")


@register("scored_threats", _KSC + """
SELECT uid, "sourceIP", "destinationIP", "sourcePort", "destinationPort", protocol, "eventCount", duration,
       "packetSize", pred_label, confidence FROM lab WHERE pred_label <> 'UNKNOWN'""")
def q_scored_threats(spark, sf_dir):
    """F9 + P2 + P7: threat rows (prediction not UNKNOWN) with the report columns; the first
    column is ``timestamp`` when the input has one, else ``uid``."""
    df = _kisti_scored(spark, sf_dir)
    first = CL.column_or_fallback(df, "timestamp", "uid").alias("timestamp" if "timestamp" in df.columns else "uid")
    cols = ["sourceIP", "destinationIP", "sourcePort", "destinationPort", "protocol", "eventCount", "duration",
            "packetSize", "pred_label", "confidence"]
    return df.filter(F.col("pred_label") != "UNKNOWN").select(first, *[c for c in cols if c in df.columns])


# ---------------------------------------------------------------------------------------
# J8 ML3 P5 F8 X4–X8
# ---------------------------------------------------------------------------------------
@register("code_lookup", f"""WITH {O.EVE_CTE}
SELECT ord, proto, CAST({O.PROTO_CODE_SQL} AS INTEGER) AS protocol,
  CAST(CASE direction WHEN 'to_server' THEN 0 WHEN 'to_client' THEN 1 ELSE -1 END AS INTEGER) AS "directionType"
FROM eve""")
def q_code_lookup(spark, sf_dir):
    """Protocol and direction codes with -1 for unknown or missing."""
    ev = V.eve_events(spark, sf_dir)
    return ev.select("ord", "proto", X.proto_code("proto").alias("protocol"),
                     X.direction_code("direction").alias("directionType"))


@register("code_decode", f"""WITH {KISTI_SQL}
SELECT uid, code, CASE code WHEN 0 THEN 'UNKNOWN' WHEN 1 THEN 'Worm' WHEN 2 THEN 'WebAttack' WHEN 3 THEN 'SystemExploit'
  WHEN 4 THEN 'Scanning' WHEN 5 THEN 'Other' ELSE CAST(code AS VARCHAR) END AS label
FROM (SELECT uid, CASE WHEN k1 % 43 = 0 THEN 9 ELSE "attackType" END AS code FROM kr) t""")
def q_code_decode(spark, sf_dir):
    """ML3: attack code -> label text (unknown codes keep their number as text)."""
    raw = V.kisti_frame(spark, sf_dir)
    code = F.when(F.col("ord.l_orderkey") % 43 == 0, F.lit(9)).otherwise(F.col("attackType"))
    return raw.select("uid", code.alias("code")).withColumn("label", X.attack_label("code"))


@register("fill_missing_features", f"""WITH {O.EVE_CTE}, {O.FLOW_BASE},
f AS (SELECT ord, flow_id, {O.flow18_select()} FROM fb)
SELECT ord, flow_id, {', '.join(c if c in schemas.CIC_11 else '0.0::DOUBLE AS ' + c for c in schemas.CIC_18)} FROM f""")
def q_fill_missing_features(spark, sf_dir):
    """P5 + P6 + P9: the 11 reliable features widened to the 18-feature model input."""
    return CL.fill_missing_features(FX.flow_features_11(V.eve_events(spark, sf_dir)), schemas.CIC_18)


@register("null_fill", f"""WITH {O.EVE_CTE}, {O.KISTI_MAP}
SELECT ord, uid, COALESCE("sourcePort", 0) AS "sourcePort", COALESCE("destinationPort", 0) AS "destinationPort",
  protocol, "eventCount", COALESCE(duration, 0) AS duration, "packetSize" FROM km""")
def q_null_fill(spark, sf_dir):
    """F8: model features of the mapped rows with nulls filled by 0."""
    km = FX.kisti_map_events(V.eve_events(spark, sf_dir))
    return CL.fill_zero(km, schemas.KISTI_FEATURES_V2).select("ord", "uid", *schemas.KISTI_FEATURES_V2)


@register("scalar_durations", f"""WITH {O.EVE_CTE}
SELECT ord,
  COALESCE(round_even(CAST(dur_micros AS DOUBLE) / 1000000.0::DOUBLE * 1000000.0::DOUBLE, 6), 0.0) AS duration_us,
  COALESCE(greatest(CAST(dur_micros AS DOUBLE) / 1000000.0::DOUBLE * 1000000.0::DOUBLE, 1.0), 1.0) AS duration_us_floor,
  CAST(COALESCE(flow_age, CASE WHEN NOT has_flow THEN NULL
       ELSE CAST(trunc(CAST(dur_micros AS DOUBLE) / 1000000.0::DOUBLE) AS BIGINT) END) AS BIGINT) AS duration_s,
  epoch_us(ts_raw) AS event_epoch_us
FROM eve""")
def q_scalar_durations(spark, sf_dir):
    """Timestamp parsing and the three duration rules on every event."""
    ev = V.eve_events(spark, sf_dir)
    return ev.select(
        "ord",
        X.duration_us_zero("flow_start", "flow_end").alias("duration_us"),
        X.duration_us_floor("flow_start", "flow_end").alias("duration_us_floor"),
        X.duration_seconds_kisti("flow_age", "flow_start", "flow_end", "timestamp").alias("duration_s"),
        F.unix_micros(X.parse_ts("timestamp")).alias("event_epoch_us"),
    )


# ---------------------------------------------------------------------------------------
# J3 J9 — ordinal zip of two inputs, count reconciliation
# ---------------------------------------------------------------------------------------
@register("zip_by_order", f"""WITH {O.EVE_CTE}, {O.FLOW_BASE},
a AS (SELECT row_number() OVER (ORDER BY ord) AS ordinal, ord AS ord_a, flow_id, src_ip FROM eve WHERE event_type = 'flow'),
b AS (SELECT row_number() OVER (ORDER BY ord) AS ordinal, ord AS ord_b,
             COALESCE(round_even(CAST(dur_micros AS DOUBLE) / 1000000.0::DOUBLE * 1000000.0::DOUBLE, 6), 0.0) AS flow_duration
      FROM fb WHERE dur_micros IS NOT NULL)
SELECT CAST(a.ordinal AS BIGINT) AS ordinal, ord_a, flow_id, src_ip, ord_b, flow_duration FROM a JOIN b ON a.ordinal = b.ordinal""")
def q_zip_by_order(spark, sf_dir):
    """I-th flow meta row paired with the i-th row of a second, shorter ordered input
    (feature rows of the timed flows only); length = the shorter input."""
    ev = V.eve_table(spark, sf_dir)  # two consumers: parse once
    meta = FX.flow_meta(ev).select(F.col("ord").alias("ord_a"), "flow_id", "src_ip")
    # second input: feature rows of the flows whose duration was measured (shorter file)
    timed = ev.filter(F.col("flow_end").isNotNull() & F.col("flow_start").isNotNull())
    feats = FX.flow_features_18(timed, keep=("ord",)).select(F.col("ord").alias("ord_b"), "flow_duration")
    return C.zip_by_order(meta, feats, "ord_a", "ord_b")


@register("count_reconciliation", f"""WITH {O.EVE_CTE}
SELECT CAST(count(*) AS BIGINT) AS rows_a, CAST(count(*) FILTER (WHERE dur_micros IS NOT NULL) AS BIGINT) AS rows_b,
       count(*) = count(*) FILTER (WHERE dur_micros IS NOT NULL) AS counts_match
FROM eve WHERE event_type = 'flow'""")
def q_count_reconciliation(spark, sf_dir):
    """Row counts of the two zipped inputs and whether they agree."""
    ev = handed_off(FX.flow_events(V.eve_events(spark, sf_dir)).select("flow_start", "flow_end"), "flow_times")  # parsed once for both inputs
    return C.count_reconciliation(ev, ev.filter(F.col("flow_end").isNotNull() & F.col("flow_start").isNotNull()))


@register("kisti_dedup_accounting", f"""WITH {O.EVE_CTE}, {O.KISTI_MAP}
SELECT CAST(count(*) AS BIGINT) AS records,
       CAST(count(DISTINCT uid) AS BIGINT) AS deduplicated,
       CAST(count(*) - count(DISTINCT uid) AS BIGINT) AS removed
FROM km""")
def q_kisti_dedup_accounting(spark, sf_dir):
    """Mapped records, rows left after the per-uid collapse (null uids dropped), rows removed."""
    km = FX.kisti_map_events(V.eve_events(spark, sf_dir))
    # rows after the collapse = distinct non-null uids (the collapse keeps one row per uid)
    counts = km.agg(F.count(F.lit(1)).alias("records"), F.count_distinct("uid").alias("deduplicated"))
    return counts.withColumn("removed", F.col("records") - F.col("deduplicated"))
