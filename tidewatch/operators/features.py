"""Composite feature operators FX1–FX9: typed events -> flow / KISTI feature rows.

All are single ``select`` projections over typed events (no shuffle, no UDF); batch and
streaming share them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch import schemas
from tidewatch.functions import scalar as X


def _z(c: str) -> Column:
    """P3 + P4: nested field with a default, truthiness default (null / 0 / missing -> 0.0)."""
    return F.coalesce(F.col(c), F.lit(0.0))


def flow_events(events: DataFrame) -> DataFrame:
    """F1."""
    return events.filter(F.col("event_type") == "flow")


def alert_events(events: DataFrame) -> DataFrame:
    """F2."""
    return events.filter(F.col("event_type") == "alert")


def non_stats_events(events: DataFrame) -> DataFrame:
    """drop stats; events without a type are kept."""
    return events.filter(~F.col("event_type").eqNullSafe("stats"))


def _flow_core(duration_policy: str = "zero", rounded: bool = True, strict_time: bool = False) -> dict[str, Column]:
    """Shared flow-feature expressions (keys are snake_case feature names).

    ``strict_time`` applies the source's fixed timestamp pattern (fraction required); by
    default any ISO-8601 form with an offset is accepted."""
    pf, pb, bf, bb = _z("pkts_toserver"), _z("pkts_toclient"), _z("bytes_toserver"), _z("bytes_toclient")
    tp, tb = pf + pb, bf + bb
    if duration_policy == "zero":
        dur_us = X.duration_us_zero("flow_start", "flow_end", strict_time)
        dur_s = X.duration_s_zero("flow_start", "flow_end", strict_time)
    elif duration_policy == "floor_1us":
        dur_us = X.duration_us_floor("flow_start", "flow_end", strict_time)
        dur_s = dur_us / F.lit(X.MICROS_PER_SECOND)
    else:
        raise ValueError(f"unknown duration policy {duration_policy!r}")
    r = (lambda c: F.bround(c, 6)) if rounded else (lambda c: c)
    return {
        "destination_port": F.coalesce(F.col("dest_port").cast("double"), F.lit(0.0)),
        "flow_duration": dur_us,
        "total_fwd_packets": pf,
        "total_backward_packets": pb,
        "total_length_fwd_packets": bf,
        "total_length_bwd_packets": bb,
        "fwd_packet_length_mean": r(X.safe_div(bf, pf)),
        "fwd_packet_length_std": F.lit(0.0),
        "bwd_packet_length_mean": r(X.safe_div(bb, pb)),
        "flow_bytes_per_s": r(X.safe_div(tb, dur_s)),
        "flow_packets_per_s": r(X.safe_div(tp, dur_s)),
        "flow_iat_mean": F.lit(0.0),
        "flow_iat_std": F.lit(0.0),
        "syn_flag_count": X.flag01("tcp_syn").cast("double"),
        "rst_flag_count": X.flag01("tcp_rst").cast("double"),
        "psh_flag_count": X.flag01("tcp_psh").cast("double"),
        "ack_flag_count": X.flag01("tcp_ack").cast("double"),
        "average_packet_size": r(X.safe_div(tb, tp)),
    }


def flow_features_18(events: DataFrame, keep: list[str] | tuple[str, ...] = ("ord", "flow_id"), strict_time: bool = False) -> DataFrame:
    """FX2: flow events -> the 18 model features (doubles, 6-digit rounding, 0 on bad time)."""
    core = _flow_core("zero", True, strict_time)
    return flow_events(events).select(*keep, *[core[c].alias(c) for c in schemas.CIC_18])


def flow_features_stream_rules(events: DataFrame, keep: list[str] | tuple[str, ...] = ("ord", "flow_id"), strict_time: bool = False) -> DataFrame:
    """FX4: the live-scoring variant: no rounding, duration floored at 1 microsecond."""
    core = _flow_core("floor_1us", False, strict_time)
    return flow_events(events).select(*keep, *[core[c].alias(c) for c in schemas.CIC_18])


def flow_features_16(events: DataFrame, keep: list[str] | tuple[str, ...] = ("ord", "flow_id"), strict_time: bool = False) -> DataFrame:
    """FX1: converted-log table (15 features + label); counters and flags keep integer type."""
    core = _flow_core("zero", True, strict_time)
    ints = {
        "destination_port": F.coalesce(F.col("dest_port"), F.lit(0)),
        "total_fwd_packets": _z("pkts_toserver").cast("bigint"),
        "total_backward_packets": _z("pkts_toclient").cast("bigint"),
        "total_length_fwd_packets": _z("bytes_toserver").cast("bigint"),
        "total_length_bwd_packets": _z("bytes_toclient").cast("bigint"),
        "syn_flag_count": X.flag01("tcp_syn"),
        "rst_flag_count": X.flag01("tcp_rst"),
        "psh_flag_count": X.flag01("tcp_psh"),
        "ack_flag_count": X.flag01("tcp_ack"),
    }
    cols = []
    for c in schemas.CIC_16:
        if c == "label":
            cols.append(X.verdict_from_alerted("alerted").alias("label"))
        else:
            cols.append(ints.get(c, core[c]).alias(c))
    return flow_events(events).select(*keep, *cols)


def flow_features_11(events: DataFrame, keep: list[str] | tuple[str, ...] = ("ord", "flow_id"), strict_time: bool = False) -> DataFrame:
    """FX3: the 11 features a flow log measures reliably."""
    core = _flow_core("zero", True, strict_time)
    return flow_events(events).select(*keep, *[core[c].alias(c) for c in schemas.CIC_11])


def flow_meta(events: DataFrame) -> DataFrame:
    """FX8: flow identity columns + sensor verdict from ``flow.alerted``."""
    return flow_events(events).select(
        "ord", "flow_id", "timestamp", "src_ip", "src_port", "dest_ip", "dest_port", "proto", "app_proto",
        X.verdict_from_alerted("alerted").alias("ids_verdict_alerted"),
    )


def alert_extract(events: DataFrame) -> DataFrame:
    """FX7: alert events -> (timestamp, src_ip, dest_ip, dest_port, signature, severity); missing -> ''."""
    s = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    return alert_events(events).select(
        "ord",
        s("timestamp").alias("timestamp"),
        s("src_ip").alias("src_ip"),
        s("dest_ip").alias("dest_ip"),
        s("dest_port").alias("dest_port"),
        s("signature").alias("signature"),
        s("severity").alias("severity"),
    )


def kisti_map_events(events: DataFrame) -> DataFrame:
    """FX5: any non-stats event -> KISTI_11 row (uid = flow_id; not yet deduplicated)."""
    pt, pc = _z("pkts_toserver"), _z("pkts_toclient")
    bt, bc = _z("bytes_toserver"), _z("bytes_toclient")
    tp, tb = pt + pc, bt + bc
    is_alert = F.col("event_type") == "alert"
    return non_stats_events(events).select(
        "ord",
        F.col("flow_id").alias("uid"),
        F.col("src_ip").alias("sourceIP"),
        F.col("dest_ip").alias("destinationIP"),
        F.col("src_port").alias("sourcePort"),
        F.col("dest_port").alias("destinationPort"),
        X.proto_code("proto").alias("protocol"),
        X.signature_class(F.when(is_alert, F.col("signature"))).alias("attackType"),
        tp.cast("bigint").alias("eventCount"),
        F.when(is_alert, F.lit(1)).alias("analyResult"),
        X.duration_seconds_kisti("flow_age", "flow_start", "flow_end", "timestamp").alias("duration"),
        F.when(tp > 0, F.bround(tb / tp, 2)).otherwise(F.lit(0.0)).alias("packetSize"),
    )


def kisti_extract_features(events: DataFrame) -> DataFrame:
    """FX6 + F8: any non-stats event -> KISTI_19 row, nulls filled with 0."""
    pt, pc = _z("pkts_toserver"), _z("pkts_toclient")
    bt, bc = _z("bytes_toserver"), _z("bytes_toclient")
    tp, tb = pt + pc, bt + bc
    sev = F.coalesce(F.col("severity"), F.lit(0))
    return non_stats_events(events).select(
        "ord",
        F.coalesce(F.col("src_port"), F.lit(0)).alias("sourcePort"),
        F.coalesce(F.col("dest_port"), F.lit(0)).alias("destinationPort"),
        X.proto_code("proto").alias("protocol"),
        X.direction_code("direction").alias("directionType"),
        tb.cast("bigint").alias("packetSize"),
        tp.cast("bigint").alias("eventCount"),
        X.jumbo_flag(X.safe_div(tb, tp)).alias("jumboPayloadFlag"),
        sev.alias("analyResult"),
        bt.cast("bigint").alias("flow_bytes_toserver"),
        bc.cast("bigint").alias("flow_bytes_toclient"),
        pt.cast("bigint").alias("flow_pkts_toserver"),
        pc.cast("bigint").alias("flow_pkts_toclient"),
        F.coalesce(F.col("flow_age"), F.lit(0)).alias("flow_age"),
        X.flag01("tcp_syn").alias("tcp_syn"),
        X.flag01("tcp_ack").alias("tcp_ack"),
        X.flag01("tcp_fin").alias("tcp_fin"),
        X.flag01("tcp_psh").alias("tcp_psh"),
        sev.alias("alert_severity"),
        F.when(F.col("event_type") == "alert", F.lit(1)).otherwise(F.lit(0)).alias("Label"),
    )


def kisti_with_duration(raw: DataFrame) -> DataFrame:
    """FX9: KISTI raw rows -> KISTI_11 with ``duration`` from the compact timestamps (X5),
    rows null in the required measures dropped (F6); ``duration`` may stay null."""
    out = raw.withColumn("duration", X.seconds_between_compact("detectStart", "detectEnd"))
    out = out.na.drop(subset=["sourcePort", "destinationPort", "protocol", "eventCount", "packetSize"])
    extra = [c for c in ("ord",) if c in raw.columns]
    return out.select(*extra, *schemas.KISTI_11)
