"""DuckDB statements of the test views (same rules as ``views.py``) and shared SQL pieces.

Used only by ``__spark_entry__.oracle_sql``: each registered query has an independent SQL
statement computed from the raw driver tables, so a Spark result is checked against a
second engine that never sees our JSON parser or DataFrame code.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------------------
# V_EVE: typed events straight from ``events`` (malformed lines already excluded)
# ---------------------------------------------------------------------------------------
EVE_CTE = """
ev0 AS (
  SELECT event_id AS ord, ts, user_id AS uid, value AS v,
         CAST(json_extract(props, '$.k') AS BIGINT) AS k,
         CASE WHEN event_type = 'error' AND user_id % 3 = 0 THEN 'alert'
              WHEN event_type = 'signup' THEN 'stats'
              WHEN event_type = 'view' THEN 'dns'
              WHEN event_type = 'purchase' AND event_id % 50 = 0 THEN NULL
              ELSE 'flow' END AS et
  FROM events
),
ev1 AS (
  SELECT *, (et IS NULL OR et NOT IN ('dns', 'stats')) AS has_flow,
            (ord % 6 = 0) AS has_tcp,
            COALESCE(et = 'alert', FALSE) AS is_alert
  FROM ev0
  WHERE ord % 89 <> 0 AND ord % 71 <> 0
),
eve AS (
  SELECT ord,
    strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+0000' AS timestamp,
    et AS event_type,
    CASE WHEN ord % 97 <> 0 THEN uid END AS flow_id,
    '10.0.' || CAST(uid % 256 AS VARCHAR) || '.' || CAST(k AS VARCHAR) AS src_ip,
    CAST(1024 + ord % 50000 AS INTEGER) AS src_port,
    '172.16.' || CAST(ord % 7 AS VARCHAR) || '.' || CAST(k % 200 AS VARCHAR) AS dest_ip,
    CASE WHEN ord % 6 <> 2 THEN CAST([22, 53, 80, 443, 3389][ord % 5 + 1] AS INTEGER) END AS dest_port,
    ['TCP', 'UDP', 'ICMP', 'ICMPv6', 'SCTP', 'GRE'][ord % 6 + 1] AS proto,
    CASE ord % 6 WHEN 0 THEN 'http' WHEN 1 THEN 'dns' END AS app_proto,
    CASE ord % 3 WHEN 0 THEN 'to_server' WHEN 1 THEN 'to_client' END AS direction,
    CASE WHEN has_flow THEN CAST(k % 17 AS DOUBLE) END AS pkts_toserver,
    CASE WHEN has_flow THEN CAST(k % 5 AS DOUBLE) END AS pkts_toclient,
    CASE WHEN has_flow THEN CAST(floor(v * 10) AS DOUBLE) END AS bytes_toserver,
    CASE WHEN has_flow THEN CAST(k * 40 AS DOUBLE) END AS bytes_toclient,
    CASE WHEN has_flow AND k % 13 <> 0 THEN k * 1000 END AS dur_micros,
    CASE WHEN has_flow THEN k % 4 = 0 END AS alerted,
    CASE WHEN has_flow AND k % 3 = 0 THEN k END AS flow_age,
    CASE WHEN has_tcp THEN (k & 1) > 0 END AS tcp_syn,
    CASE WHEN has_tcp THEN (k & 8) > 0 END AS tcp_rst,
    CASE WHEN has_tcp THEN (k & 4) > 0 END AS tcp_psh,
    CASE WHEN has_tcp THEN (k & 2) > 0 END AS tcp_ack,
    CASE WHEN has_tcp THEN (k & 16) > 0 END AS tcp_fin,
    has_flow, has_tcp, is_alert,
    CASE WHEN is_alert THEN ['ET SCAN Nmap Scripting Engine', 'ET TROJAN Known Malware Beacon',
         'ET WEB_SERVER SQL Injection Attempt', 'ET POLICY SSH brute FORCE attempt',
         'GPL ICMP PING', ''][k % 6 + 1] END AS signature,
    CASE WHEN is_alert THEN ['Attempted Information Leak', 'A Network Trojan was detected',
         'Web Application Attack'][k % 3 + 1] END AS category,
    CASE WHEN is_alert AND k % 11 <> 0 THEN CAST(k % 3 + 1 AS INTEGER) END AS severity,
    ts AS ts_raw
  FROM ev1
)"""

# zero-defaulted counters and durations of flow events
FLOW_BASE = """
fb AS (
  SELECT *,
    COALESCE(pkts_toserver, 0.0) AS pf, COALESCE(pkts_toclient, 0.0) AS pb,
    COALESCE(bytes_toserver, 0.0) AS bf, COALESCE(bytes_toclient, 0.0) AS bb,
    COALESCE(CAST(dur_micros AS DOUBLE) / 1000000.0::DOUBLE, 0.0) AS dur_s
  FROM eve WHERE event_type = 'flow'
)"""


def flow18_select(rounded: bool = True, floor_1us: bool = False) -> str:
    r = (lambda x: f"round_even({x}, 6)") if rounded else (lambda x: x)
    if floor_1us:
        dur_us = "COALESCE(greatest(CAST(dur_micros AS DOUBLE) / 1000000.0::DOUBLE * 1000000.0::DOUBLE, 1.0), 1.0)"
        dur_s = f"({dur_us} / 1000000.0::DOUBLE)"
    else:
        dur_us = "COALESCE(round_even(CAST(dur_micros AS DOUBLE) / 1000000.0::DOUBLE * 1000000.0::DOUBLE, 6), 0.0)"
        dur_s = "dur_s"
    return f"""
    COALESCE(CAST(dest_port AS DOUBLE), 0.0) AS destination_port,
    {dur_us} AS flow_duration,
    pf AS total_fwd_packets, pb AS total_backward_packets,
    bf AS total_length_fwd_packets, bb AS total_length_bwd_packets,
    CASE WHEN pf > 0 THEN {r('bf / pf')} ELSE 0.0 END AS fwd_packet_length_mean,
    0.0::DOUBLE AS fwd_packet_length_std,
    CASE WHEN pb > 0 THEN {r('bb / pb')} ELSE 0.0 END AS bwd_packet_length_mean,
    CASE WHEN {dur_s} > 0 THEN {r(f'(bf + bb) / {dur_s}')} ELSE 0.0 END AS flow_bytes_per_s,
    CASE WHEN {dur_s} > 0 THEN {r(f'(pf + pb) / {dur_s}')} ELSE 0.0 END AS flow_packets_per_s,
    0.0::DOUBLE AS flow_iat_mean, 0.0::DOUBLE AS flow_iat_std,
    CAST(CAST(COALESCE(tcp_syn, FALSE) AS INTEGER) AS DOUBLE) AS syn_flag_count,
    CAST(CAST(COALESCE(tcp_rst, FALSE) AS INTEGER) AS DOUBLE) AS rst_flag_count,
    CAST(CAST(COALESCE(tcp_psh, FALSE) AS INTEGER) AS DOUBLE) AS psh_flag_count,
    CAST(CAST(COALESCE(tcp_ack, FALSE) AS INTEGER) AS DOUBLE) AS ack_flag_count,
    CASE WHEN pf + pb > 0 THEN {r('(bf + bb) / (pf + pb)')} ELSE 0.0 END AS average_packet_size"""


BEST_ALERT = """
best AS (
  SELECT flow_id, severity, signature, category, n_alerts FROM (
    SELECT flow_id, severity, signature, category,
           row_number() OVER (PARTITION BY flow_id ORDER BY COALESCE(severity, 99), ord) AS rn,
           count(*) OVER (PARTITION BY flow_id) AS n_alerts
    FROM eve WHERE event_type = 'alert') t
  WHERE rn = 1
)"""

# deterministic stand-in model (same rule as catalogue.rule_scorer)
RULE_LABEL = """CASE WHEN total_fwd_packets >= 12 THEN 'DDoS'
         WHEN syn_flag_count = 1 AND destination_port = 22 THEN 'PortScan'
         ELSE 'BENIGN' END"""
RULE_CONF = """CASE WHEN total_fwd_packets >= 12 THEN 90.0::DOUBLE
         WHEN syn_flag_count = 1 AND destination_port = 22 THEN 75.0::DOUBLE
         ELSE 60.0::DOUBLE END"""


def outcome_sql(ids: str, model: str) -> str:
    return f"""CASE WHEN {ids} = 'ALERT' AND {model} = 'BENIGN' THEN 'IDS_ONLY'
         WHEN {ids} <> 'ALERT' AND {model} <> 'BENIGN' THEN 'MODEL_ONLY'
         WHEN {ids} = 'ALERT' AND {model} <> 'BENIGN' THEN 'BOTH'
         ELSE 'NEITHER' END"""


def compare_sql(verdict: str, features: str = "cic18") -> str:
    if verdict == "by_alerted":
        ids = "CASE WHEN COALESCE(f.alerted, FALSE) THEN 'ALERT' ELSE 'BENIGN' END"
    else:
        ids = "CASE WHEN b.n_alerts IS NOT NULL THEN 'ALERT' ELSE 'BENIGN' END"
    zero_flags = features == "cic11"
    feats = flow18_select()
    if zero_flags:
        for fl in ("syn", "rst", "psh", "ack"):
            feats = feats.replace(
                f"CAST(CAST(COALESCE(tcp_{fl}, FALSE) AS INTEGER) AS DOUBLE) AS {fl}_flag_count",
                f"0.0::DOUBLE AS {fl}_flag_count",
            )
    show = lambda c: f"CASE WHEN b.n_alerts IS NULL THEN '-' ELSE COALESCE(CAST(b.{c} AS VARCHAR), '') END"
    return f"""WITH {EVE_CTE}, {FLOW_BASE}, {BEST_ALERT},
feat AS (SELECT ord, flow_id, timestamp, src_ip, src_port, dest_ip, dest_port, proto, app_proto, alerted, {feats}
         FROM fb),
scored AS (SELECT *, {RULE_LABEL} AS model_label, {RULE_CONF} AS model_confidence_pct FROM feat),
cmp AS (
  SELECT f.ord, f.flow_id, f.timestamp, f.src_ip, f.src_port, f.dest_ip, f.dest_port, f.proto, f.app_proto,
         {ids} AS ids_verdict,
         {show('severity')} AS ids_severity, {show('signature')} AS ids_signature,
         {show('category')} AS ids_category,
         f.model_label, f.model_confidence_pct
  FROM scored f LEFT JOIN best b ON f.flow_id IS NOT DISTINCT FROM b.flow_id
)"""


def outcome_summary_sql(cmp_with: str) -> str:
    return f"""{cmp_with},
o AS (SELECT *, {outcome_sql('ids_verdict', 'model_label')} AS outcome FROM cmp),
c AS (SELECT count(*) FILTER (WHERE outcome = 'BOTH') AS "BOTH",
             count(*) FILTER (WHERE outcome = 'IDS_ONLY') AS "IDS_ONLY",
             count(*) FILTER (WHERE outcome = 'MODEL_ONLY') AS "MODEL_ONLY",
             count(*) FILTER (WHERE outcome = 'NEITHER') AS "NEITHER",
             count(*) AS "TOTAL" FROM o),
s AS (
  SELECT 1 AS rank, 'BOTH' AS outcome, "BOTH" AS n, "TOTAL" AS t FROM c UNION ALL
  SELECT 2, 'IDS_ONLY', "IDS_ONLY", "TOTAL" FROM c UNION ALL
  SELECT 3, 'MODEL_ONLY', "MODEL_ONLY", "TOTAL" FROM c UNION ALL
  SELECT 4, 'NEITHER', "NEITHER", "TOTAL" FROM c UNION ALL
  SELECT 5, 'TOTAL', "TOTAL", "TOTAL" FROM c)
SELECT CAST(rank AS INTEGER) AS rank, outcome, CAST(n AS BIGINT) AS n,
       CASE WHEN t > 0 THEN round_even(CAST(n AS DOUBLE) * 100.0::DOUBLE / CAST(t AS DOUBLE), 4) ELSE 0.0 END AS pct
FROM s"""


# ---------------------------------------------------------------------------------------
# KISTI mapping of events (FX5) — shared by kisti_map_events and kisti_dedup_uid
# ---------------------------------------------------------------------------------------
def signature_class_sql(x: str) -> str:
    u = f"upper({x})"
    return f"""CASE WHEN {x} IS NULL OR {x} = '' THEN 0
         WHEN regexp_matches({u}, 'SCAN|SWEEP|NMAP|MASSCAN|PORT SCAN') THEN 4
         WHEN regexp_matches({u}, 'MALWARE|TROJAN|WORM|BOTNET|VIRUS|RANSOMWARE') THEN 1
         WHEN regexp_matches({u}, 'WEB_SERVER|WEB_CLIENT|SQL|XSS|LFI|RFI|WEBSHELL|PHP|CMS|WORDPRESS|JOOMLA') THEN 2
         WHEN regexp_matches({u}, 'EXPLOIT|OVERFLOW|RCE|CVE|DOS|DDOS|SHELLCODE|STREAM|SMB|RDP|SSH') THEN 3
         ELSE 0 END"""


PROTO_CODE_SQL = """CASE proto WHEN 'TCP' THEN 6 WHEN 'UDP' THEN 17 WHEN 'ICMP' THEN 1
         WHEN 'ICMPv6' THEN 58 WHEN 'SCTP' THEN 132 ELSE -1 END"""

KISTI_MAP = f"""
km AS (
  SELECT ord, flow_id AS uid, src_ip AS "sourceIP", dest_ip AS "destinationIP",
    src_port AS "sourcePort", dest_port AS "destinationPort",
    CAST({PROTO_CODE_SQL} AS INTEGER) AS protocol,
    CAST({signature_class_sql("CASE WHEN is_alert THEN signature END")} AS INTEGER) AS "attackType",
    CAST(COALESCE(pkts_toserver, 0.0) + COALESCE(pkts_toclient, 0.0) AS BIGINT) AS "eventCount",
    CASE WHEN is_alert THEN 1 END AS "analyResult",
    CAST(COALESCE(flow_age,
      CASE WHEN NOT has_flow THEN NULL
           ELSE CAST(trunc(CAST(dur_micros AS DOUBLE) / 1000000.0::DOUBLE) AS BIGINT) END) AS BIGINT) AS duration,
    CASE WHEN COALESCE(pkts_toserver, 0.0) + COALESCE(pkts_toclient, 0.0) > 0
         THEN round_even((COALESCE(bytes_toserver, 0.0) + COALESCE(bytes_toclient, 0.0))
                         / (COALESCE(pkts_toserver, 0.0) + COALESCE(pkts_toclient, 0.0)), 2)
         ELSE 0.0 END AS "packetSize"
  FROM eve WHERE event_type IS NULL OR event_type <> 'stats'
)"""
