"""Tabular queries: labelled-flow CSV folders, KISTI TSV, cleaning, lookups, sampling."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch import schemas
from tidewatch.functions import scalar as X
from tidewatch.operators import clean as CL
from tidewatch.operators import correlate as C
from tidewatch.operators import features as FX
from tidewatch.operators import sampling as M
from tidewatch.plans import oracle as O
from tidewatch.plans import views as V
from tidewatch.plans.catalogue import register
from tidewatch.session import scratch_path
from tidewatch.sinks import write_csv, write_tsv
from tidewatch.sources import tables as T

# ---------------------------------------------------------------------------------------
# SQL twins of the views
# ---------------------------------------------------------------------------------------
CIC_SQL = """
cic AS (
  SELECT CAST(l_partkey % 1000 AS DOUBLE) AS destination_port,
    CASE WHEN l_linenumber = 7 THEN 'inf'::DOUBLE ELSE l_extendedprice END AS flow_duration,
    l_quantity AS total_fwd_packets,
    CAST(l_suppkey % 50 AS DOUBLE) AS total_backward_packets,
    CASE WHEN l_linenumber = 5 AND l_orderkey % 3 = 0 THEN '-inf'::DOUBLE
         ELSE l_extendedprice * (1.0::DOUBLE - l_discount) END AS flow_bytes_per_s,
    CASE WHEN l_orderkey % 11 = 0 THEN 'nan'::DOUBLE ELSE l_quantity * (1.0::DOUBLE + l_tax) END AS flow_packets_per_s,
    CASE WHEN l_orderkey % 17 = 0 THEN NULL ELSE l_discount END AS flow_iat_mean,
    l_tax AS bwd_iat_total,
    CASE WHEN l_orderkey % 13 = 0 AND l_linenumber = 1 THEN NULL
         WHEN l_returnflag = 'N' THEN 'BENIGN' WHEN l_returnflag = 'A' THEN 'DDoS' ELSE 'PortScan' END AS label
  FROM lineitem
)"""

KISTI_SQL = """
kr AS (
  SELECT CAST(l.l_orderkey AS VARCHAR) AS uid,
    CASE WHEN l.l_partkey % 31 = 0 THEN NULL
         ELSE '10.1.' || CAST(o.o_custkey % 256 AS VARCHAR) || '.' || CAST(l.l_partkey % 256 AS VARCHAR) END AS "sourceIP",
    '192.168.' || CAST(l.l_suppkey % 256 AS VARCHAR) || '.' || CAST(l.l_linenumber AS VARCHAR) AS "destinationIP",
    CAST(1024 + l.l_partkey % 60000 AS INTEGER) AS "sourcePort",
    CASE WHEN l.l_partkey % 23 <> 0 THEN CAST([80, 443, 22, 53, 3389][l.l_suppkey % 5 + 1] AS INTEGER) END AS "destinationPort",
    CAST([6, 17, 1][l.l_linenumber % 3 + 1] AS INTEGER) AS protocol,
    CAST(CASE WHEN o.o_orderstatus = 'F' THEN 0
              WHEN o.o_orderstatus = 'O' THEN (CASE l.l_returnflag WHEN 'A' THEN 1 WHEN 'R' THEN 2 ELSE 0 END)
              ELSE l.l_linenumber % 6 END AS INTEGER) AS "attackType",
    CAST(l.l_quantity AS BIGINT) AS "eventCount",
    CAST(CASE l.l_returnflag WHEN 'R' THEN 1 WHEN 'A' THEN 0 END AS INTEGER) AS "analyResult",
    CASE WHEN l.l_orderkey % 19 = 0 THEN NULL
         ELSE CAST(date_diff('second', o.o_orderdate, l.l_shipdate) AS BIGINT) END AS duration,
    CASE WHEN l.l_orderkey % 29 = 0 THEN NULL ELSE l.l_extendedprice / (l.l_quantity + 1.0::DOUBLE) END AS "packetSize",
    strftime(o.o_orderdate, '%Y%m%d%H%M%S') AS "detectStart",
    CASE WHEN l.l_orderkey % 19 = 0 THEN '20170732000000' ELSE strftime(l.l_shipdate, '%Y%m%d%H%M%S') END AS "detectEnd",
    l.l_orderkey AS k1, l.l_linenumber AS k2, l.l_partkey AS k3, l.l_suppkey AS k4, l.l_quantity AS k5,
    l.l_extendedprice AS k6, l.l_discount AS k7, l.l_tax AS k8, l.l_shipdate AS k9,
    o.o_orderpriority AS priority
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
)"""

KISTI_OUT = ('uid, "sourceIP", "destinationIP", "sourcePort", "destinationPort", protocol, "attackType", '
             '"eventCount", "analyResult", duration, "packetSize"')

CIC_FEATURES = ["destination_port", "flow_duration", "total_fwd_packets", "total_backward_packets",
                "flow_bytes_per_s", "flow_packets_per_s", "flow_iat_mean", "bwd_iat_total"]
SELECTED_HEADERS = [" Destination Port", " Flow Duration", " Total Fwd Packets", "Flow Bytes/s", " Flow Packets/s",
                    " Flow IAT Mean", " Label"]


def _snake(df):
    return df.select(*[F.col(f"`{c}`").alias(V.CIC_VIEW_SNAKE.get(c.strip(), c)) for c in df.columns])


def _cic_csv_folder(spark, sf_dir) -> str:
    """Write V_CIC as a folder of CSV part files with the source header spelling."""
    path = scratch_path(spark, "cic_csv")
    write_csv(V.cic_frame(spark, sf_dir), path)
    return path


def _finite(c: str) -> str:
    return f"{c} IS NOT NULL AND isfinite({c})"


# ---------------------------------------------------------------------------------------
# S1 S6 U1 P1 — merge a folder of CSV files
# ---------------------------------------------------------------------------------------
@register("merge_files", f"""WITH {CIC_SQL}
SELECT label, CAST(count(*) AS BIGINT) AS n_rows,
  CAST(count(*) FILTER (WHERE isinf(flow_duration) AND flow_duration > 0) AS BIGINT) AS n_pos_inf,
  CAST(count(*) FILTER (WHERE isinf(flow_bytes_per_s) AND flow_bytes_per_s < 0) AS BIGINT) AS n_neg_inf,
  CAST(count(*) FILTER (WHERE isnan(flow_packets_per_s)) AS BIGINT) AS n_nan,
  CAST(count(*) FILTER (WHERE flow_iat_mean IS NULL) AS BIGINT) AS n_null,
  CAST(sum(total_fwd_packets) AS DOUBLE) AS sum_fwd_packets
FROM cic GROUP BY label""")
def q_merge_files(spark, sf_dir):
    """Scan every *.csv part file of a folder (explicit schema, both inf
    spellings), union, trim header names; profile the merged rows per label."""
    path = _cic_csv_folder(spark, sf_dir)
    df = _snake(T.read_labelled_flows(spark, path, headers=V.CIC_VIEW_HEADERS))
    return df.groupBy("label").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("flow_duration") == float("inf")).alias("n_pos_inf"),
        F.count_if(F.col("flow_bytes_per_s") == float("-inf")).alias("n_neg_inf"),
        F.count_if(F.isnan("flow_packets_per_s")).alias("n_nan"),
        F.count_if(F.col("flow_iat_mean").isNull()).alias("n_null"),
        F.sum("total_fwd_packets").alias("sum_fwd_packets"),
    )


@register("clean_all_columns", f"""WITH {CIC_SQL}
SELECT * FROM cic WHERE {' AND '.join(_finite(c) for c in CIC_FEATURES)} AND label IS NOT NULL""")
def q_clean_all_columns(spark, sf_dir):
    """F4 + F5 over every column."""
    return CL.clean_finite(_snake(V.cic_frame(spark, sf_dir)))


_SEL = ["destination_port", "flow_duration", "total_fwd_packets", "flow_bytes_per_s", "flow_packets_per_s",
        "flow_iat_mean"]


@register("clean_selected", f"""WITH {CIC_SQL}
SELECT {', '.join(_SEL)}, label FROM cic WHERE {' AND '.join(_finite(c) for c in _SEL)} AND label IS NOT NULL""")
def q_clean_selected(spark, sf_dir):
    """S2 + P1 + F4 + F5: CSV folder scan pruned to the selected columns, names trimmed,
    non-finite and null rows removed."""
    path = _cic_csv_folder(spark, sf_dir)
    df = T.read_labelled_flows(spark, path, headers=V.CIC_VIEW_HEADERS)
    df = df.select(*[F.col(f"`{h.strip()}`") for h in SELECTED_HEADERS])
    return CL.clean_finite(_snake(df))


# ---------------------------------------------------------------------------------------
# S5 S7 X5 F6 FX9 — KISTI TSV with compact timestamps and null tokens
# ---------------------------------------------------------------------------------------
def _kisti_tsv(spark, sf_dir) -> str:
    path = scratch_path(spark, "kisti_tsv")
    raw = V.kisti_frame(spark, sf_dir).drop("ord")
    write_tsv(raw, path)
    return path


@register("kisti_duration_clean", f"""WITH {KISTI_SQL}
SELECT {KISTI_OUT} FROM kr
WHERE "sourcePort" IS NOT NULL AND "destinationPort" IS NOT NULL AND protocol IS NOT NULL
  AND "eventCount" IS NOT NULL AND "packetSize" IS NOT NULL""")
def q_kisti_duration_clean(spark, sf_dir):
    """S5 S7 X5 F6 FX9: KISTI TSV read with null tokens, durations from compact timestamps, incomplete rows dropped."""
    path = _kisti_tsv(spark, sf_dir)
    raw = T.read_kisti_tsv(spark, path)
    return FX.kisti_with_duration(raw).drop("ord")


_TSV_NAMES = ["uid", "sourceIP", "destinationIP", "sourcePort", "destinationPort", "protocol", "attackType",
              "eventCount", "analyResult", "detectStart", "detectEnd"]


@register("tsv_tolerant_scan", f"""WITH {KISTI_SQL}
SELECT uid, "sourceIP", "destinationIP", CAST("sourcePort" AS VARCHAR) AS "sourcePort",
  CAST("destinationPort" AS VARCHAR) AS "destinationPort", CAST(protocol AS VARCHAR) AS protocol,
  CAST("attackType" AS VARCHAR) AS "attackType", CAST("eventCount" AS VARCHAR) AS "eventCount",
  CASE WHEN k1 % 41 = 0 THEN NULL ELSE CAST("analyResult" AS VARCHAR) END AS "analyResult",
  CASE WHEN k1 % 41 = 0 THEN NULL ELSE "detectStart" END AS "detectStart",
  CASE WHEN k1 % 41 = 0 THEN NULL ELSE "detectEnd" END AS "detectEnd"
FROM kr WHERE k1 % 37 <> 0""")
def q_tsv_tolerant_scan(spark, sf_dir):
    """All-string TSV where some rows carry an extra cell (skipped) and some lack the
    last three (null-padded); pandas null tokens become null."""
    raw = V.kisti_frame(spark, sf_dir)
    cells = [F.coalesce(F.col(c).cast("string"), F.lit("NA")) for c in _TSV_NAMES]
    ok = F.col("ord.l_orderkey")
    line = (
        F.when(ok % 37 == 0, F.concat_ws("\t", *cells, F.lit("extra")))
        .when(ok % 41 == 0, F.concat_ws("\t", *cells[:-3]))
        .otherwise(F.concat_ws("\t", *cells))
    )
    path = scratch_path(spark, "tsv_ragged")
    raw.select(line.alias("value")).write.mode("overwrite").text(path)
    return T.read_tsv_tolerant(spark, path, _TSV_NAMES, header=False).drop("ord")


# ---------------------------------------------------------------------------------------
# J5 J6 J7 — sample ⋉ raw, keep-first lookup, map-and-drop
# ---------------------------------------------------------------------------------------
_SAMPLE_SQL = """sample AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS uid, o_orderpriority FROM (
    SELECT o_orderkey, o_orderpriority,
      row_number() OVER (PARTITION BY o_orderpriority
                         ORDER BY ('0x' || substr(md5(CAST(o_orderkey AS VARCHAR) || ':42'), 1, 8))::BIGINT, o_orderkey) AS rk,
      count(*) OVER (PARTITION BY o_orderpriority) AS n
    FROM orders) t
  WHERE rk <= greatest(1, floor(n * 0.1)))"""


def _order_sample(spark, sf_dir):
    """M1: the stratified 10 % sample of orders (class = priority) as sampled uids."""
    orders = V.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    sample = M.stratified_sample(orders, "o_orderpriority", "o_orderkey", 0.1, 42)
    return sample.select(F.col("o_orderkey").cast("string").alias("uid"), "o_orderpriority")


@register("semi_join_sample", f"""WITH {KISTI_SQL}, {_SAMPLE_SQL}
SELECT {KISTI_OUT} FROM kr WHERE uid IN (SELECT uid FROM sample)""")
def q_semi_join_sample(spark, sf_dir):
    """Raw KISTI rows whose uid is in the stratified sample."""
    raw = CL.normalise_nulls(V.kisti_frame(spark, sf_dir))
    raw = raw.withColumn("duration", X.seconds_between_compact("detectStart", "detectEnd"))
    return C.semi_join_reduce(raw, _order_sample(spark, sf_dir), "uid").select(
        *[c.strip('"') for c in KISTI_OUT.split(", ")])


@register("keep_first_lookup", f"""WITH {KISTI_SQL}
SELECT uid, "packetSize" FROM (
  SELECT uid, "packetSize", row_number() OVER (PARTITION BY uid ORDER BY k1, k2, k3, k4, k5, k6, k7, k8, k9) AS rn
  FROM kr) t WHERE rn = 1""")
def q_keep_first_lookup(spark, sf_dir):
    """First packetSize per uid in input order (a null first value stays null)."""
    return C.keep_first_lookup(V.kisti_frame(spark, sf_dir), "uid", "packetSize")


@register("lookup_join_drop", f"""WITH {KISTI_SQL}, {_SAMPLE_SQL},
lk AS (SELECT uid, "packetSize" FROM (
  SELECT uid, "packetSize", row_number() OVER (PARTITION BY uid ORDER BY k1, k2, k3, k4, k5, k6, k7, k8, k9) AS rn
  FROM kr) t WHERE rn = 1)
SELECT s.uid, s.o_orderpriority, lk."packetSize"
FROM sample s JOIN lk ON s.uid = lk.uid WHERE lk."packetSize" IS NOT NULL""")
def q_lookup_join_drop(spark, sf_dir):
    """The sampled orders mapped through the keep-first packetSize lookup; uids with
    no raw row or a null first value are dropped."""
    sample = _order_sample(spark, sf_dir)
    raw = C.semi_join_reduce(V.kisti_frame(spark, sf_dir), sample, "uid")  # J5 first: only sampled uids are aggregated
    return C.lookup_join_drop(sample, C.keep_first_lookup(raw, "uid", "packetSize"), "uid", "packetSize")


# ---------------------------------------------------------------------------------------
# M1 M2 M3 — sampling and splits on orders (o_orderkey is unique; class = priority)
# ---------------------------------------------------------------------------------------
_HASH = "('0x' || substr(md5(CAST(o_orderkey AS VARCHAR) || ':42'), 1, 8))::BIGINT"
_RANKED = f"""ranked AS (
  SELECT o_orderkey, o_orderpriority,
    row_number() OVER (PARTITION BY o_orderpriority ORDER BY {_HASH}, o_orderkey) AS rk,
    count(*) OVER (PARTITION BY o_orderpriority) AS n
  FROM orders)"""


@register("stratified_sample", f"""WITH {_RANKED}
SELECT o_orderkey, o_orderpriority FROM ranked WHERE rk <= greatest(1, floor(n * 0.1))""")
def q_stratified_sample(spark, sf_dir):
    """M1: exactly max(1, floor(0.1 n)) hash-ordered rows per priority class."""
    orders = V.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    return M.stratified_sample(orders, "o_orderpriority", "o_orderkey", 0.1, 42)


@register("stratified_split", f"""WITH {_RANKED}
SELECT o_orderkey, o_orderpriority, rk <= floor(n * 0.2) AS is_test FROM ranked""")
def q_stratified_split(spark, sf_dir):
    """M2: per class the floor(0.2 n) lowest-hash rows form the test part."""
    orders = V.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    return M.stratified_split(orders, "o_orderpriority", "o_orderkey", 0.2, 42)


@register("hash_split", f"""SELECT o_orderkey, ({_HASH}) % 100 < 20 AS is_test FROM orders""")
def q_hash_split(spark, sf_dir):
    """M3: test = md5(key ':42') mod 100 < 20 (partition-independent)."""
    orders = V.table(spark, sf_dir, "orders").select("o_orderkey")
    return M.hash_split(orders, "o_orderkey", 20, 42)


# ---------------------------------------------------------------------------------------
# P7, null tokens, scalar ratios and texts
# ---------------------------------------------------------------------------------------
@register("optional_columns", f"""WITH {CIC_SQL}
SELECT label, label AS verdict, '-' AS severity, CAST(count(*) AS BIGINT) AS n FROM cic GROUP BY label""")
def q_optional_columns(spark, sf_dir):
    """A column that is there, one taken from its fallback, one that is a literal."""
    df = _snake(V.cic_frame(spark, sf_dir))
    picked = df.select(CL.column_or_fallback(df, "label").alias("label"),
                       CL.column_or_fallback(df, "ids_verdict", "label").alias("verdict"),
                       CL.column_or_fallback(df, "ids_severity", "severity").alias("severity"))
    return picked.groupBy("label", "verdict", "severity").agg(F.count(F.lit(1)).alias("n"))


@register("null_tokens", """
SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN NULL WHEN o_orderkey % 5 = 0 THEN 'NA ' ELSE o_orderpriority END AS cell
FROM orders""")
def q_null_tokens(spark, sf_dir):
    """Null tokens of text columns: every token becomes null, look-alikes stay."""
    key, tokens = F.col("o_orderkey"), F.array(*[F.lit(t) for t in schemas.PANDAS_NULL_TOKENS])
    token = F.element_at(tokens, (F.floor(key / 3) % len(schemas.PANDAS_NULL_TOKENS) + 1).cast("int"))
    cell = F.when(key % 3 == 0, token).when(key % 5 == 0, F.lit("NA ")).otherwise(F.col("o_orderpriority"))
    return CL.normalise_nulls(V.table(spark, sf_dir, "orders").select("o_orderkey", cell.alias("cell")))


@register("scalar_ratios", """
WITH r AS (SELECT *, CASE WHEN l_quantity - 25 > 0 THEN l_extendedprice / (l_quantity - 25) ELSE 0.0::DOUBLE END AS ratio FROM lineitem)
SELECT l_orderkey, l_linenumber, ratio, round_even(l_discount * 100.0::DOUBLE, 2) AS discount_pct,
  CAST(ratio > 1500 AS INTEGER) AS jumbo, CAST(COALESCE(l_returnflag = 'R', FALSE) AS INTEGER) AS returned
FROM r""")
def q_scalar_ratios(spark, sf_dir):
    """Safe division, percent, flags."""
    ratio = X.safe_div(F.col("l_extendedprice"), F.col("l_quantity") - 25)
    return V.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", ratio.alias("ratio"), X.pct(F.col("l_discount")).alias("discount_pct"),
        X.jumbo_flag(ratio).alias("jumbo"), X.flag01(F.col("l_returnflag") == "R").alias("returned"))


_WHITE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


@register("scalar_text", f"""
SELECT doc_id, CAST(length(trim(text, {_WHITE})) AS BIGINT) AS n_trimmed, md5(trim(text, {_WHITE})) AS digest,
  CAST({O.signature_class_sql("replace(text, 'ß', 'ss')")} AS INTEGER) AS attack_type
FROM documents""")
def q_scalar_text(spark, sf_dir):
    """Whole texts with white space put around them, trimmed and classed."""
    padded = F.concat(F.when(F.col("doc_id") % 2 == 0, F.lit("\t ")).otherwise(F.lit(" \r\n")), "text", F.lit("\x0b \f"))
    docs = V.table(spark, sf_dir, "documents").select("doc_id", "text", X.trim(padded).alias("trimmed"))
    return docs.select("doc_id", F.length("trimmed").cast("long").alias("n_trimmed"), F.md5("trimmed").alias("digest"),
                       X.signature_class("text").alias("attack_type"))
