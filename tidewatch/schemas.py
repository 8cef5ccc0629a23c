"""Schemas, feature lists and code maps.

Values in the FIXED VALUES blocks must stay equal to the behaviour being reproduced
(column headers, code maps, keyword lists); everything else is our own naming.
"""

from __future__ import annotations

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

# --------------------------------------------------------------------------------------
# Event log (NDJSON).  Every leaf is read as *string* and converted with try_cast later:
# a typed JSON schema would null a whole record on ``"severity": "2"``.
# --------------------------------------------------------------------------------------


def _strings(*names: str) -> list[StructField]:
    return [StructField(n, StringType()) for n in names]


EVE_FLOW = StructType(
    _strings("pkts_toserver", "pkts_toclient", "bytes_toserver", "bytes_toclient", "start", "end", "age", "alerted")
)
EVE_TCP = StructType(_strings("syn", "rst", "psh", "ack", "fin"))
EVE_ALERT = StructType(_strings("signature", "category", "severity"))

EVE_SCHEMA = StructType(
    _strings(
        "timestamp", "event_type", "flow_id", "src_ip", "src_port", "dest_ip", "dest_port",
        "proto", "app_proto", "direction",
    )
    + [StructField("flow", EVE_FLOW), StructField("tcp", EVE_TCP), StructField("alert", EVE_ALERT)]
)

# Typed event row produced by sources.events.typed_events (documented for users).
TYPED_EVENT_COLUMNS = [
    "ord", "timestamp", "event_type", "flow_id", "src_ip", "src_port", "dest_ip", "dest_port",
    "proto", "app_proto", "direction", "pkts_toserver", "pkts_toclient", "bytes_toserver",
    "bytes_toclient", "flow_start", "flow_end", "flow_age", "alerted", "tcp_syn", "tcp_rst",
    "tcp_psh", "tcp_ack", "tcp_fin", "has_flow", "has_tcp", "has_alert", "signature",
    "category", "severity",
]

# --------------------------------------------------------------------------------------
# FIXED VALUES — flow feature names (labelled-flow CSV headers) and their snake_case names
# --------------------------------------------------------------------------------------
CIC_HEADERS = {
    "destination_port": "Destination Port",
    "flow_duration": "Flow Duration",
    "total_fwd_packets": "Total Fwd Packets",
    "total_backward_packets": "Total Backward Packets",
    "total_length_fwd_packets": "Total Length of Fwd Packets",
    "total_length_bwd_packets": "Total Length of Bwd Packets",
    "fwd_packet_length_mean": "Fwd Packet Length Mean",
    "fwd_packet_length_std": "Fwd Packet Length Std",
    "bwd_packet_length_mean": "Bwd Packet Length Mean",
    "flow_bytes_per_s": "Flow Bytes/s",
    "flow_packets_per_s": "Flow Packets/s",
    "flow_iat_mean": "Flow IAT Mean",
    "flow_iat_std": "Flow IAT Std",
    "syn_flag_count": "SYN Flag Count",
    "rst_flag_count": "RST Flag Count",
    "psh_flag_count": "PSH Flag Count",
    "ack_flag_count": "ACK Flag Count",
    "average_packet_size": "Average Packet Size",
    "label": "Label",
}

# Model input order (18 features).
CIC_18 = [
    "destination_port", "flow_duration", "total_fwd_packets", "total_backward_packets",
    "total_length_fwd_packets", "total_length_bwd_packets", "fwd_packet_length_mean",
    "fwd_packet_length_std", "bwd_packet_length_mean", "flow_bytes_per_s", "flow_packets_per_s",
    "flow_iat_mean", "flow_iat_std", "syn_flag_count", "rst_flag_count", "psh_flag_count",
    "ack_flag_count", "average_packet_size",
]
# Features a flow log cannot provide (always 0.0).
CIC_UNOBTAINABLE = ["fwd_packet_length_std", "flow_iat_mean", "flow_iat_std"]
CIC_FLAGS = ["syn_flag_count", "rst_flag_count", "psh_flag_count", "ack_flag_count"]
# Converted-log table: 15 features + label.
CIC_16 = [c for c in CIC_18 if c not in CIC_UNOBTAINABLE] + ["label"]
# Reliable-only feature set.
CIC_11 = [c for c in CIC_18 if c not in CIC_UNOBTAINABLE and c not in CIC_FLAGS]
# Labelled-flow training table: 18 features + label, header spelling of the source CSVs.
CIC_19_RAW_HEADERS = [
    " Destination Port", " Flow Duration", " Total Fwd Packets", " Total Backward Packets",
    "Total Length of Fwd Packets", " Total Length of Bwd Packets", " Fwd Packet Length Std",
    " Bwd Packet Length Mean", "Flow Bytes/s", " Fwd Packet Length Mean", " Flow Packets/s",
    " Flow IAT Mean", " Flow IAT Std", " SYN Flag Count", " RST Flag Count", " PSH Flag Count",
    " ACK Flag Count", " Average Packet Size", " Label",
]

# --------------------------------------------------------------------------------------
# FIXED VALUES — KISTI-style tables
# --------------------------------------------------------------------------------------
KISTI_RAW = StructType(
    [
        StructField("uid", StringType()),
        StructField("sourceIP", StringType()),
        StructField("destinationIP", StringType()),
        StructField("sourcePort", IntegerType()),
        StructField("destinationPort", IntegerType()),
        StructField("protocol", IntegerType()),
        StructField("attackType", IntegerType()),
        StructField("eventCount", LongType()),
        StructField("analyResult", IntegerType()),
        StructField("detectStart", StringType()),
        StructField("detectEnd", StringType()),
        StructField("packetSize", DoubleType()),
    ]
)
KISTI_11 = [
    "uid", "sourceIP", "destinationIP", "sourcePort", "destinationPort", "protocol",
    "attackType", "eventCount", "analyResult", "duration", "packetSize",
]
KISTI_FEATURES_V1 = ["sourcePort", "destinationPort", "protocol", "eventCount", "duration"]
KISTI_FEATURES_V2 = KISTI_FEATURES_V1 + ["packetSize"]
KISTI_19 = [
    "sourcePort", "destinationPort", "protocol", "directionType", "packetSize", "eventCount",
    "jumboPayloadFlag", "analyResult", "flow_bytes_toserver", "flow_bytes_toclient",
    "flow_pkts_toserver", "flow_pkts_toclient", "flow_age", "tcp_syn", "tcp_ack", "tcp_fin",
    "tcp_psh", "alert_severity", "Label",
]
ALERT_6 = ["timestamp", "src_ip", "dest_ip", "dest_port", "signature", "severity"]

# FIXED VALUES — protocol / direction / attack-type code maps
PROTO_CODES = {"TCP": 6, "UDP": 17, "ICMP": 1, "ICMPv6": 58, "SCTP": 132}
DIRECTION_CODES = {"to_server": 0, "to_client": 1}
ATTACK_LABELS = {0: "UNKNOWN", 1: "Worm", 2: "WebAttack", 3: "SystemExploit", 4: "Scanning", 5: "Other"}

# FIXED VALUES — signature keyword classes, checked in this order (first hit wins)
SIGNATURE_CLASSES = [
    (4, ["SCAN", "SWEEP", "NMAP", "MASSCAN", "PORT SCAN"]),
    (1, ["MALWARE", "TROJAN", "WORM", "BOTNET", "VIRUS", "RANSOMWARE"]),
    (2, ["WEB_SERVER", "WEB_CLIENT", "SQL", "XSS", "LFI", "RFI", "WEBSHELL", "PHP", "CMS", "WORDPRESS", "JOOMLA"]),
    (3, ["EXPLOIT", "OVERFLOW", "RCE", "CVE", "DOS", "DDOS", "SHELLCODE", "STREAM", "SMB", "RDP", "SSH"]),
]

# FIXED VALUES — pandas' default CSV null tokens (read_csv na_values default list)
PANDAS_NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Outcome classes of the sensor-vs-model comparison (ours; reference strings are Korean).
OUTCOME_BOTH = "BOTH"
OUTCOME_IDS_ONLY = "IDS_ONLY"
OUTCOME_MODEL_ONLY = "MODEL_ONLY"
OUTCOME_NEITHER = "NEITHER"
OUTCOMES = [OUTCOME_BOTH, OUTCOME_IDS_ONLY, OUTCOME_MODEL_ONLY, OUTCOME_NEITHER]

BENIGN = "BENIGN"
ALERT = "ALERT"

# FIXED VALUES — comparison-table header text and outcome labels of the source CSVs
COMPARE_HEADERS = {
    "ids_verdict": "suricata_판단",
    "ids_severity": "suricata_severity",
    "ids_signature": "suricata_signature",
    "ids_category": "suricata_category",
    "model_label": "RF_예측",
    "model_confidence_pct": "RF_확률(%)",
    "outcome": "결과분류",
}
OUTCOME_LABELS = {
    OUTCOME_BOTH: "둘 다 탐지",
    OUTCOME_IDS_ONLY: "Suricata만 탐지",
    OUTCOME_MODEL_ONLY: "RF만 탐지",
    OUTCOME_NEITHER: "둘 다 정상",
}
