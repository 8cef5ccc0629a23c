"""EVENT_LOG fixture (FIXTURES.md §1): parsing, flow features, best alert, joins, KISTI rows."""

import pytest
from pyspark.sql import functions as F

from conftest import write_lines
from tidewatch import schemas
from tidewatch.operators import correlate as C
from tidewatch.operators import features as FX
from tidewatch.operators import reports as R
from tidewatch.session import dealt
from tidewatch.sources.events import parse_accounting, parse_event_lines, read_event_lines, read_events, typed_events

T0 = "2026-03-24T12:00:00.000000+0900"
LINES = [
    '{"event_type":"flow","flow_id":1,"proto":"TCP","dest_port":22,"src_port":50000,"src_ip":"10.0.0.1",'
    '"dest_ip":"10.0.0.2","flow":{"pkts_toserver":15,"pkts_toclient":10,"bytes_toserver":1690,'
    f'"bytes_toclient":2310,"start":"{T0}","end":"2026-03-24T12:00:02.500000+0900","age":2,"alerted":true}},'
    '"tcp":{"syn":true,"ack":true,"psh":true}}',
    '{"event_type":"alert","flow_id":1,"alert":{"severity":3,"signature":"ET SCAN X"}}',
    '{"event_type":"alert","flow_id":1,"alert":{"severity":"1","signature":"SSH brute FORCE"}}',
    '{"event_type":"alert","flow_id":1,"alert":{"severity":1,"signature":"later"}}',
    '{"event_type":"flow","flow_id":2,"proto":"UDP","dest_port":53,"flow":{"pkts_toserver":1,"pkts_toclient":0,'
    f'"bytes_toserver":60,"bytes_toclient":0,"start":"{T0}","end":"{T0}","alerted":false}}}}',
    '{"event_type":"flow","flow_id":3,"flow":{"pkts_toserver":null,"pkts_toclient":null,"bytes_toserver":null,'
    '"bytes_toclient":null,"alerted":true}}',
    '{"event_type":"stats","stats":{"uptime":1}}',
    '{"event_type":"flow"',
    "",
    '{"event_type":"dns","flow_id":2,"proto":"UDP"}',
    '{"event_type":"alert","alert":{"signature":"TROJAN Y"}}',
    '{"event_type":"flow","flow":{"pkts_toserver":2,"pkts_toclient":2,"bytes_toserver":200,"bytes_toclient":200,'
    '"alerted":true}}',
    '{"event_type":"flow","flow_id":9} trailing',
    '{"flow_id":4,"proto":"ICMP"}',
]


@pytest.fixture(scope="module")
def log_path(tmp_path_factory):
    return write_lines(tmp_path_factory.mktemp("eve") / "eve.json", LINES)


@pytest.fixture(scope="module")
def events(spark, log_path):
    return read_events(spark, log_path).cache()


def line_no(df):
    """1-based line number from the order key (single small file: one split)."""
    return df.withColumn("line", F.col("ord.pos") + 1)


def test_parse_accounting(spark, log_path):
    acc = parse_accounting(parse_event_lines(read_event_lines(spark, log_path))).first()
    assert acc.lines_total == 14
    assert acc.lines_blank == 1
    assert acc.lines_malformed == 2
    assert acc.flow_events == 4
    assert acc.alert_events == 4
    assert acc.stats_events == 1


def test_flow_lines(events):
    lines = sorted(r.line for r in line_no(FX.flow_events(events)).collect())
    assert lines == [1, 5, 6, 12]


def test_fx2_values(events):
    rows = {r.line: r for r in line_no(FX.flow_features_18(events)).collect()}
    r1 = rows[1]
    assert r1.flow_duration == 2500000.0
    assert r1.fwd_packet_length_mean == 112.666667
    assert r1.bwd_packet_length_mean == 231.0
    assert r1.flow_bytes_per_s == 1600.0
    assert r1.flow_packets_per_s == 10.0
    assert r1.average_packet_size == 160.0
    assert (r1.syn_flag_count, r1.psh_flag_count, r1.ack_flag_count, r1.rst_flag_count) == (1.0, 1.0, 1.0, 0.0)
    assert (r1.fwd_packet_length_std, r1.flow_iat_mean, r1.flow_iat_std) == (0.0, 0.0, 0.0)
    r5 = rows[5]
    assert (r5.flow_duration, r5.flow_bytes_per_s, r5.flow_packets_per_s) == (0.0, 0.0, 0.0)
    assert (r5.fwd_packet_length_mean, r5.bwd_packet_length_mean) == (60.0, 0.0)
    r6 = rows[6]
    assert all(getattr(r6, c) == 0.0 for c in schemas.CIC_18)


def test_fx4_floor(events):
    r5 = {r.line: r for r in line_no(FX.flow_features_stream_rules(events)).collect()}[5]
    assert r5.flow_duration == 1.0
    assert r5.flow_bytes_per_s == pytest.approx(60_000_000.0)
    assert r5.flow_packets_per_s == pytest.approx(1_000_000.0)


def test_fx1_null_counters_and_label(events):
    rows = {r.line: r for r in line_no(FX.flow_features_16(events)).collect()}
    assert rows[6].total_fwd_packets == 0 and rows[6].label == "ALERT"
    assert rows[5].label == "BENIGN"
    assert rows[1].destination_port == 22 and rows[1].syn_flag_count == 1


def test_alert_extract(events):
    rows = {r.line: r for r in line_no(FX.alert_extract(events)).collect()}
    assert sorted(rows) == [2, 3, 4, 11]
    assert rows[11].severity == "" and rows[11].dest_port == "" and rows[11].signature == "TROJAN Y"
    assert rows[3].severity == "1"


def test_best_alert(events):
    best = {r.flow_id: r for r in C.best_alert_per_flow(events).collect()}
    assert best[1].severity == 1 and best[1].signature == "SSH brute FORCE"
    assert best[None].severity is None and best[None].signature == "TROJAN Y"


def test_best_alert_order_free(spark, events):
    shuffled = events.repartition(7, F.rand(3))
    a = sorted(map(tuple, C.best_alert_per_flow(events).collect()), key=str)
    b = sorted(map(tuple, C.best_alert_per_flow(shuffled).collect()), key=str)
    assert a == b


def test_flow_alert_join(events):
    rows = {r.line: r for r in line_no(C.flows_with_best_alert(events)).collect()}
    assert rows[5].ids_severity == "-" and rows[6].ids_signature == "-"
    assert rows[12].ids_severity == "" and rows[12].ids_signature == "TROJAN Y"
    assert rows[1].ids_severity == "1"


def test_kisti_extract(events):
    rows = {r.line: r for r in line_no(FX.kisti_extract_features(events)).collect()}
    assert sorted(rows) == [1, 2, 3, 4, 5, 6, 10, 11, 12, 14]
    assert [ln for ln, r in rows.items() if r.Label == 1] == [2, 3, 4, 11]
    assert rows[1].packetSize == 4000 and rows[1].jumboPayloadFlag == 0
    assert rows[1].directionType == -1


def test_kisti_map_dedup(events):
    d = {r.uid: r for r in C.dedup_by_uid(FX.kisti_map_events(events)).collect()}
    assert sorted(d) == [1, 2, 3, 4]
    assert (d[1].attackType, d[1].eventCount, d[1].packetSize, d[1].analyResult, d[1].duration) == (4, 25, 160.0, 1, 2)
    assert (d[2].attackType, d[2].eventCount, d[2].packetSize, d[2].analyResult, d[2].duration) == (0, 1, 60.0, None, 0)
    assert d[3].eventCount == 0 and d[3].duration is None
    assert d[4].protocol == 1 and d[4].eventCount == 0


def fixed_rule(feats):
    label = F.when(F.col("flow_id").isin(1, 2), F.lit("DDoS")).otherwise(F.lit("BENIGN"))
    return feats.withColumn("model_label", label).withColumn("model_confidence_pct", F.lit(100.0))


@pytest.mark.parametrize(
    "verdict,expected,rates",
    [
        ("by_alerted", {"BOTH": 1, "IDS_ONLY": 2, "MODEL_ONLY": 1, "NEITHER": 0, "TOTAL": 4}, (75.0, 50.0)),
        ("by_alert_match", {"BOTH": 1, "IDS_ONLY": 1, "MODEL_ONLY": 1, "NEITHER": 1, "TOTAL": 4}, (50.0, 50.0)),
    ],
)
def test_outcome_tables(events, verdict, expected, rates):
    cmp = C.compare(events, fixed_rule, verdict=verdict)
    summary = {r.outcome: (r.n, r.pct) for r in R.outcome_summary(cmp).collect()}
    assert {k: v[0] for k, v in summary.items()} == expected
    assert summary["NEITHER"][1] == expected["NEITHER"] * 25.0
    assert summary["TOTAL"][1] == 100.0
    dr = R.detection_rates(cmp).first()
    assert (dr.ids_rate_pct, dr.model_rate_pct) == rates


def test_outcome_counts_sum_to_n(events):
    cmp = C.compare(events, fixed_rule, verdict="by_alerted")
    s = {r.outcome: r.n for r in R.outcome_summary(cmp).collect()}
    assert sum(s[k] for k in schemas.OUTCOMES) == s["TOTAL"] == cmp.count()


def test_empty_summary_zero_pct(spark, events):
    cmp = C.compare(events.filter(F.lit(False)), fixed_rule, verdict="by_alerted")
    rows = R.outcome_summary(cmp).collect()
    assert all(r.n == 0 and r.pct == 0.0 for r in rows)
    assert R.detection_rates(cmp).first().ids_rate_pct is None


def test_alert_existence(events):
    rows = {r.line: r.has_alert for r in line_no(C.alert_existence(events)).collect()}
    assert rows == {1: True, 5: False, 6: False, 12: True}


def test_strict_time_parity(spark, tmp_path):
    line = ('{"event_type":"flow","flow_id":7,"flow":{"pkts_toserver":2,"pkts_toclient":0,"bytes_toserver":10,'
            '"bytes_toclient":0,"start":"2026-03-24T12:00:00+0900","end":"2026-03-24T12:00:02+0900"}}')
    ev = read_events(spark, write_lines(tmp_path / "e.json", [line]))
    assert FX.flow_features_18(ev).first().flow_duration == 2_000_000.0
    assert FX.flow_features_18(ev, strict_time=True).first().flow_duration == 0.0
    assert FX.flow_features_stream_rules(ev, strict_time=True).first().flow_duration == 1.0
    ok = line.replace(":00+0900", ":00.5+09:00").replace(":02+0900", ":02.5Z")
    ev2 = read_events(spark, write_lines(tmp_path / "f.json", [ok]))
    assert FX.flow_features_18(ev2, strict_time=True).first().flow_duration == 32_402_000_000.0


def test_strict_single_object_lines(spark):
    from tidewatch.sources.events import parse_event_lines

    lines = ['{"event_type":"flow"}', '\t{"event_type":"flow"} \t', '{"event_type":"flow"} {"event_type":"flow"}', '{"event_type":"flow"} x}',
             "{'event_type':'flow'}", "\t", '{"a":1}', '[{"a":1}]', '{"event_type":"fl']
    df = spark.createDataFrame(list(enumerate(lines)), "ord long, value string")
    got = [r.line_kind for r in parse_event_lines(df).orderBy("ord").collect()]
    assert got == ["event", "event", "malformed", "malformed", "malformed", "blank", "event", "malformed", "malformed"]


def test_encoding_policies(spark, tmp_path):
    import pytest

    from tidewatch.sources.events import parse_accounting, parse_event_lines, read_event_lines, typed_events

    path = tmp_path / "bad.json"
    good = b'{"event_type": "alert", "alert": {"signature": "caf\xc3\xa9"}}'
    path.write_bytes(good + b"\n" + good.replace(b"\xc3\xa9", b"\xe9") + b"\n\xff\n\n")
    lines = read_event_lines(spark, str(path))
    rows = typed_events(parse_event_lines(lines)).collect()
    assert sorted(r.signature for r in rows) == ["café", "caf�"]
    strict = parse_event_lines(lines, encoding="strict")
    assert [r.signature for r in typed_events(strict).collect()] == ["café"]
    r = parse_accounting(strict, undecodable=True).first()
    assert (r.lines_total, r.lines_undecodable, r.lines_blank, r.lines_malformed, r.events) == (4, 2, 1, 0, 1)
    r = parse_accounting(parse_event_lines(lines)).first()
    assert (r.lines_total, r.lines_blank, r.lines_malformed, r.events) == (4, 1, 1, 2)
    with pytest.raises(ValueError):
        parse_event_lines(lines, encoding="latin")


def test_each_line_is_parsed_once(spark):
    lines = spark.createDataFrame([(' \x0b\t{"event_type":"flow","flow_id":1}\r\x0c ', 0), ('\u00a0{"event_type":"flow","flow_id":2}', 1), ("\x0b\x0c", 2)], "value string, ord long")
    parsed = parse_event_lines(lines)
    assert [r.line_kind for r in parsed.orderBy("ord").collect()] == ["event", "malformed", "blank"]
    plan = FX.flow_features_18(typed_events(parsed))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_few_splits_are_dealt_to_all_cores(spark):
    cores = spark.sparkContext.defaultParallelism
    assert dealt(spark.range(100, numPartitions=1)).rdd.getNumPartitions() == cores
    assert dealt(spark.range(100, numPartitions=cores + 3)).rdd.getNumPartitions() == cores + 3
