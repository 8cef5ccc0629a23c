"""The command line drives the same operators end to end."""

from conftest import write_lines
from test_events import LINES
from tidewatch.__main__ import main


def _csv(path, rows):
    header = " Destination Port, Flow Duration, Total Fwd Packets,Flow Bytes/s, Label"
    write_lines(path, [header] + [",".join(r) for r in rows])


def test_counters_and_the_stop_without_flows(spark, tmp_path, capsys):
    log = write_lines(tmp_path / "eve.json", LINES)
    assert main(["convert", log, str(tmp_path / "conv")]) == 0
    assert "lines 14: events 11, skipped 3 (blank 1, malformed 2); flows 4, alerts 4" in capsys.readouterr().out
    assert main(["ingest", log, str(tmp_path / "typed")]) == 0
    assert "flows 4, alerts 4" in capsys.readouterr().out
    quiet = write_lines(tmp_path / "quiet.json", [x for x in LINES if '"flow"' not in x])
    assert main(["convert", quiet, str(tmp_path / "none")]) == 1
    said = capsys.readouterr()
    assert "flows 0, alerts 4" in said.out and "no flow events" in said.err


def test_cli_workflows(spark, tmp_path):
    log = write_lines(tmp_path / "eve.json", LINES)
    csv_dir = tmp_path / "cic"
    csv_dir.mkdir()
    rows = [[str(p), str(d), str(n), str(b), lab] for p, d, n, b, lab in
            [(22 + i % 3, 100 * i, i % 7, 10.0 * i, ["BENIGN", "DDoS", "PortScan"][i % 3]) for i in range(90)]]
    rows.append(["80", "inf", "1", "1", "BENIGN"])
    _csv(csv_dir / "day1.csv", rows)
    model = str(tmp_path / "model")

    assert main(["convert", log, str(tmp_path / "conv")]) == 0
    conv = spark.read.option("header", True).csv(str(tmp_path / "conv"))
    assert conv.count() == 4 and "Flow Bytes/s" in conv.columns

    assert main(["alerts", log, str(tmp_path / "alerts")]) == 0
    assert spark.read.option("header", True).csv(str(tmp_path / "alerts")).count() == 4

    assert main(["train", str(csv_dir), model, "--trees", "3", "--depth", "3"]) == 0
    assert main(["compare", log, model, str(tmp_path / "cmp"), "--verdict", "by_alert_match"]) == 0
    cmp = spark.read.option("header", True).csv(str(tmp_path / "cmp"))
    assert cmp.count() == 4 and "결과분류" in cmp.columns

    assert main(["ingest", log, str(tmp_path / "typed")]) == 0
    assert main(["compare", str(tmp_path / "typed"), model, str(tmp_path / "cmp2"), "--typed"]) == 0
    assert spark.read.option("header", True).csv(str(tmp_path / "cmp2")).count() == 4

    assert main(["kisti-map", log, str(tmp_path / "km")]) == 0
    assert spark.read.option("header", True).csv(str(tmp_path / "km")).count() == 4
    assert main(["kisti-extract", log, str(tmp_path / "kx")]) == 0
    assert spark.read.option("header", True).csv(str(tmp_path / "kx")).count() == 10
