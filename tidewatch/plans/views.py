"""Adapters from the driver's parquet tables to reference-shaped inputs.

The driver tables hold no sensor log, so deterministic views derive one:

* ``eve_lines``  — ``events`` -> NDJSON text lines (built with ``to_json``), with broken,
  trailing-garbage and blank lines mixed in, so every query parses real JSON text
  through the same code path as ``read_events``.
* ``cic_frame`` — ``lineitem`` -> labelled-flow rows with ±inf / NaN / null cells.
* ``kisti_frame`` — ``lineitem ⋈ orders`` -> KISTI raw rows (compact timestamps, null tokens).
* ``pred_pairs`` — ``labels`` -> (y, p) pairs for the metric operators.

Every rule is a pure function of the row, and ``plans/oracle.py`` states the same rules in
SQL so DuckDB can check the Spark results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.session import dealt, scratch_path, spread
from tidewatch.sources.events import ingest_events, parse_event_lines, typed_events

PROTOS = ["TCP", "UDP", "ICMP", "ICMPv6", "SCTP", "GRE"]
DEST_PORTS = [22, 53, 80, 443, 3389]
SIGNATURES = [
    "ET SCAN Nmap Scripting Engine",
    "ET TROJAN Known Malware Beacon",
    "ET WEB_SERVER SQL Injection Attempt",
    "ET POLICY SSH brute FORCE attempt",
    "GPL ICMP PING",
    "",
]
CATEGORIES = ["Attempted Information Leak", "A Network Trojan was detected", "Web Application Attack"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet"))


def _pick(values: list, idx: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (idx + 1).cast("int"))


def _iso(ts: Column) -> Column:
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+0000"))


def eve_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` -> (value: NDJSON line, ord: event_id)."""
    e = dealt(table(spark, sf_dir, "events"))
    eid, uid = F.col("event_id"), F.col("user_id")
    k = F.get_json_object("props", "$.k").cast("bigint")
    src = F.col("event_type")
    et = (
        F.when((src == "error") & (uid % 3 == 0), F.lit("alert"))
        .when(src == "signup", F.lit("stats"))
        .when(src == "view", F.lit("dns"))
        .when((src == "purchase") & (eid % 50 == 0), F.lit(None).cast("string"))
        .otherwise(F.lit("flow"))
    )
    base = e.select(eid.alias("eid"), uid.alias("uid"), F.col("ts"), F.col("value").alias("v"), k.alias("k"),
                    et.alias("et"))
    eid, uid, k, et, v = F.col("eid"), F.col("uid"), F.col("k"), F.col("et"), F.col("v")
    proto = _pick(PROTOS, eid % 6)
    has_flow = et.isNull() | ~et.isin("dns", "stats")
    end_ts = F.expr("timestampadd(MILLISECOND, k, ts)")
    flow = F.when(
        has_flow,
        F.struct(
            (k % 17).alias("pkts_toserver"),
            (k % 5).alias("pkts_toclient"),
            F.floor(v * 10).alias("bytes_toserver"),
            (k * 40).alias("bytes_toclient"),
            _iso(F.col("ts")).alias("start"),
            F.when(k % 13 != 0, _iso(end_ts)).alias("end"),
            F.when(k % 3 == 0, k).alias("age"),
            (k % 4 == 0).alias("alerted"),
        ),
    )
    tcp = F.when(
        proto == "TCP",
        F.struct(
            ((k.bitwiseAND(1)) > 0).alias("syn"),
            ((k.bitwiseAND(8)) > 0).alias("rst"),
            ((k.bitwiseAND(4)) > 0).alias("psh"),
            ((k.bitwiseAND(2)) > 0).alias("ack"),
            ((k.bitwiseAND(16)) > 0).alias("fin"),
        ),
    )
    alert = F.when(
        et == "alert",
        F.struct(
            _pick(SIGNATURES, k % 6).alias("signature"),
            _pick(CATEGORIES, k % 3).alias("category"),
            F.when(k % 11 != 0, k % 3 + 1).alias("severity"),
        ),
    )
    record = F.struct(
        _iso(F.col("ts")).alias("timestamp"),
        et.alias("event_type"),
        F.when(eid % 97 != 0, uid).alias("flow_id"),
        F.concat(F.lit("10.0."), (uid % 256).cast("string"), F.lit("."), k.cast("string")).alias("src_ip"),
        (F.lit(1024) + eid % 50000).cast("int").alias("src_port"),
        F.concat(F.lit("172.16."), (eid % 7).cast("string"), F.lit("."), (k % 200).cast("string")).alias("dest_ip"),
        F.when(eid % 6 != 2, _pick(DEST_PORTS, eid % 5)).alias("dest_port"),
        proto.alias("proto"),
        F.when(eid % 6 == 0, F.lit("http")).when(eid % 6 == 1, F.lit("dns")).alias("app_proto"),
        F.when(eid % 3 == 0, F.lit("to_server")).when(eid % 3 == 1, F.lit("to_client")).alias("direction"),
        flow.alias("flow"),
        tcp.alias("tcp"),
        alert.alias("alert"),
    )
    # the text once, in a column of its own: a copy of it in each branch makes generated code too long for the JIT
    base = base.select("eid", F.to_json(record).alias("text"))
    line = F.col("text")
    line = (
        F.when(eid % 89 == 0, F.substring(line, 1, 30))  # cut-off line
        .when(eid % 71 == 0, F.concat(line, F.lit(" trailing")))  # trailing garbage
        .otherwise(line)
    )
    lines = F.when(eid % 83 == 0, F.array(line, F.lit("   "))).otherwise(F.array(line))  # + a blank line
    return base.select(F.explode(lines).alias("value"), eid.alias("ord"))


def eve_parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_event_lines(eve_lines(spark, sf_dir))


def eve_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V_EVE as typed events (what ``read_events`` yields for real files)."""
    return typed_events(eve_parsed(spark, sf_dir))


def eve_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flow and alert events of V_EVE parsed once into a Parquet table partitioned by event type
    (multi-consumer use); the comparisons read no other type."""
    return ingest_events(eve_events(spark, sf_dir).filter(F.col("event_type").isin("flow", "alert")), scratch_path(spark, "events"))


# ---------------------------------------------------------------------------------------
# V_CIC — labelled flows from lineitem (header spelling of the source CSVs)
# ---------------------------------------------------------------------------------------
CIC_VIEW_HEADERS = [
    " Destination Port", " Flow Duration", " Total Fwd Packets", " Total Backward Packets",
    "Flow Bytes/s", " Flow Packets/s", " Flow IAT Mean", " Bwd IAT Total", " Label",
]
CIC_VIEW_SNAKE = {
    "Destination Port": "destination_port", "Flow Duration": "flow_duration",
    "Total Fwd Packets": "total_fwd_packets", "Total Backward Packets": "total_backward_packets",
    "Flow Bytes/s": "flow_bytes_per_s", "Flow Packets/s": "flow_packets_per_s",
    "Flow IAT Mean": "flow_iat_mean", "Bwd IAT Total": "bwd_iat_total", "Label": "label",
}


def cic_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    ok, ln = F.col("l_orderkey"), F.col("l_linenumber")
    inf = F.lit(float("inf"))
    label = (
        F.when((ok % 13 == 0) & (ln == 1), F.lit(None).cast("string"))
        .when(F.col("l_returnflag") == "N", F.lit("BENIGN"))
        .when(F.col("l_returnflag") == "A", F.lit("DDoS"))
        .otherwise(F.lit("PortScan"))
    )
    cols = [
        (F.col("l_partkey") % 1000).cast("double"),
        F.when(ln == 7, inf).otherwise(F.col("l_extendedprice")),
        F.col("l_quantity"),
        (F.col("l_suppkey") % 50).cast("double"),
        F.when((ln == 5) & (ok % 3 == 0), -inf).otherwise(F.col("l_extendedprice") * (F.lit(1.0) - F.col("l_discount"))),
        F.when(ok % 11 == 0, F.lit(float("nan"))).otherwise(F.col("l_quantity") * (F.lit(1.0) + F.col("l_tax"))),
        F.when(ok % 17 == 0, F.lit(None).cast("double")).otherwise(F.col("l_discount")),
        F.col("l_tax"),
        label,
    ]
    return li.select(*[c.alias(h) for c, h in zip(cols, CIC_VIEW_HEADERS)])


# ---------------------------------------------------------------------------------------
# V_KISTI — KISTI raw rows from lineitem ⋈ orders
# ---------------------------------------------------------------------------------------


def kisti_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    j = li.join(od, li.l_orderkey == od.o_orderkey, "inner")
    ok, ln, pk, sk = F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey")
    attack = (
        F.when(F.col("o_orderstatus") == "F", F.lit(0))
        .when(F.col("o_orderstatus") == "O",
              F.when(F.col("l_returnflag") == "A", F.lit(1)).when(F.col("l_returnflag") == "R", F.lit(2)).otherwise(F.lit(0)))
        .otherwise((ln % 6).cast("int"))
    )
    compact = lambda c: F.date_format(c, "yyyyMMddHHmmss")
    return j.select(
        ok.cast("string").alias("uid"),
        F.when(pk % 31 == 0, F.lit("NA"))
        .otherwise(F.concat(F.lit("10.1."), (F.col("o_custkey") % 256).cast("string"), F.lit("."), (pk % 256).cast("string")))
        .alias("sourceIP"),
        F.concat(F.lit("192.168."), (sk % 256).cast("string"), F.lit("."), ln.cast("string")).alias("destinationIP"),
        (F.lit(1024) + pk % 60000).cast("int").alias("sourcePort"),
        F.when(pk % 23 != 0, _pick([80, 443, 22, 53, 3389], sk % 5)).cast("int").alias("destinationPort"),
        _pick([6, 17, 1], ln % 3).cast("int").alias("protocol"),
        attack.cast("int").alias("attackType"),
        F.col("l_quantity").cast("bigint").alias("eventCount"),
        F.when(F.col("l_returnflag") == "R", F.lit(1)).when(F.col("l_returnflag") == "A", F.lit(0)).cast("int").alias("analyResult"),
        compact(F.col("o_orderdate")).alias("detectStart"),
        F.when(ok % 19 == 0, F.lit("20170732000000")).otherwise(compact(F.col("l_shipdate"))).alias("detectEnd"),
        F.when(ok % 29 == 0, F.lit(None).cast("double"))
        .otherwise(F.col("l_extendedprice") / (F.col("l_quantity") + F.lit(1.0))).alias("packetSize"),
        # input-order key of the raw file (lineitem has no unique key; the whole row is used)
        F.struct(ok, ln, pk, sk, F.col("l_quantity"), F.col("l_extendedprice"), F.col("l_discount"),
                 F.col("l_tax"), F.col("l_shipdate")).alias("ord"),
    )


def pred_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V_PRED: truth y = quality, prediction p = toxic (both ints)."""
    return table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("y"), F.col("toxic").alias("p"))
