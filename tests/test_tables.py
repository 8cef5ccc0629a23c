"""LABELLED_FLOW_CSV and KISTI_TSV fixtures (FIXTURES.md §3, §4) and lookups."""

import pytest
from pyspark.sql import functions as F

from conftest import write_lines
from tidewatch.operators import clean as CL
from tidewatch.operators import correlate as C
from tidewatch.operators import features as FX
from tidewatch.sources import tables as T

HEADERS = [" Destination Port", " Flow Duration", "Flow Bytes/s", " Label"]


def _csv(path, header, rows, bom=False):
    text = ",".join(header) + "\n" + "\n".join(",".join(r) for r in rows) + "\n"
    with open(path, "w", encoding="utf-8-sig" if bom else "utf-8") as f:
        f.write(text)


@pytest.fixture()
def flow_folder(tmp_path):
    d = tmp_path / "cic"
    d.mkdir()
    _csv(d / "monday.csv", HEADERS, [["80", "1.5", "Infinity", "BENIGN"], ["22", "inf", "3", "DDoS"],
                                    ["53", "2", "-Infinity", "BENIGN"]], bom=True)
    _csv(d / "TUESDAY.CSV", HEADERS, [["443", "NaN", "1", "BENIGN"], ["8080", "", "1", "PortScan"],
                                     ["21", "4", "5", ""], ["25", "7", "9", "DDoS"], ["110", "-inf", "1", "BENIGN"]])
    (d / "notes.txt").write_text("not a csv\n")
    return str(d)


def test_merge_and_clean(spark, flow_folder):
    df = T.read_labelled_flows(spark, flow_folder, headers=HEADERS)
    assert df.columns == ["Destination Port", "Flow Duration", "Flow Bytes/s", "Label"]
    assert df.count() == 8
    inf_rows = df.filter(F.col("`Flow Duration`") == float("inf")).count()
    assert inf_rows == 1  # 'inf' spelling parsed as +inf
    cleaned = CL.clean_finite(df)
    assert sorted(r["Destination Port"] for r in cleaned.collect()) == [25.0]
    # idempotent
    assert CL.clean_finite(cleaned).count() == cleaned.count()


def test_header_mismatch_refused(spark, flow_folder, tmp_path):
    import os

    _csv(os.path.join(flow_folder, "wednesday.csv"), [" Destination Port", " Other", "Flow Bytes/s", " Label"],
         [["1", "2", "3", "BENIGN"]])
    with pytest.raises(Exception):
        T.read_labelled_flows(spark, flow_folder, headers=HEADERS).collect()


KISTI_HEADER = "uid\tsourceIP\tdestinationIP\tsourcePort\tdestinationPort\tprotocol\tattackType\teventCount\t" \
               "analyResult\tdetectStart\tdetectEnd\tpacketSize"


def test_kisti_duration(spark, tmp_path):
    rows = [
        "u1\t10.0.0.1\t10.0.0.2\t1000\t80\t6\t1\t5\t1\t20170703153045\t20170703153145\t10.0",
        "u2\tNA\tnull\t1001\t80\t6\t0\t3\t0\t20170732000000\t20170703153145\t20.0",
        "u3\tNone\tN/A\t1002\t80\t6\t0\t3\t0\t20170703153045\t20170703153145\t",
        "u4\t10.0.0.4\t10.0.0.5\t1003\t443\t17\t2\t4\t1\t\t20170703153145\t30.0",
    ]
    p = write_lines(tmp_path / "kisti.tsv", [KISTI_HEADER] + rows)
    out = {r.uid: r for r in FX.kisti_with_duration(T.read_kisti_tsv(spark, p)).collect()}
    assert sorted(out) == ["u1", "u2", "u4"]  # empty packetSize dropped
    assert out["u1"].duration == 60
    assert out["u2"].duration is None and out["u2"].sourceIP is None and out["u2"].destinationIP is None
    assert out["u4"].duration is None


def test_tsv_tolerant(spark, tmp_path):
    p = write_lines(tmp_path / "t.tsv", ["a\tb\tc", "1\t2\t3", "4\t5", "6\t7\t8\t9", "NA\tx\ty"])
    rows = [(r.a, r.b, r.c) for r in T.read_tsv_tolerant(spark, p, ["a", "b", "c"]).orderBy("ord").collect()]
    assert rows == [("1", "2", "3"), ("4", "5", None), (None, "x", "y")]


def test_keep_first_lookup_and_join(spark):
    raw = spark.createDataFrame(
        [("a", 10.0, 1), ("a", 20.0, 2), ("b", None, 3), ("b", 5.0, 4), ("c", 7.0, 5)], "uid string, packetSize double, ord int")
    lk = {r.uid: r.packetSize for r in C.keep_first_lookup(raw, "uid", "packetSize").collect()}
    assert lk == {"a": 10.0, "b": None, "c": 7.0}
    sample = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), ("z", 4)], "uid string, attackType int")
    joined = C.lookup_join_drop(sample, C.keep_first_lookup(raw, "uid", "packetSize"), "uid", "packetSize")
    assert sorted((r.uid, r.attackType, r.packetSize) for r in joined.collect()) == [("a", 1, 10.0), ("a", 2, 10.0)]
    semi = C.semi_join_reduce(raw, sample.select("uid"), "uid")
    assert sorted(r.uid for r in semi.collect()) == ["a", "a", "b", "b"]


def test_fill_missing_features(spark):
    df = spark.createDataFrame([(1, 2.0)], "ord int, b double")
    out = CL.fill_missing_features(df, ["a", "b", "c"])
    assert out.columns == ["ord", "a", "b", "c"]
    assert tuple(out.first()) == (1, 0.0, 2.0, 0.0)
    assert CL.missing_features(df, ["a", "b", "c"]) == ["a", "c"]


def test_require_rows(spark):
    with pytest.raises(ValueError):
        CL.require_rows(spark.range(0))


def test_row_accounting_observe(spark):
    from pyspark.sql import Observation

    df = spark.createDataFrame([(1.0,), (float("inf"),), (None,)], "x double")
    obs = Observation("acc")
    watched = CL.with_row_accounting(df, obs, non_finite=F.col("x") == float("inf"), missing=F.col("x").isNull())
    assert CL.clean_finite(watched).count() == 1
    assert obs.get == {"rows": 3, "non_finite": 1, "missing": 1}


def test_merge_excludes_output_file(spark, flow_folder):
    import os

    _csv(os.path.join(flow_folder, "combined.csv"), HEADERS, [["1", "1", "1", "BENIGN"]] * 5)
    df = T.read_labelled_flows(spark, flow_folder, headers=HEADERS, exclude="combined.csv")
    assert df.count() == 8


def test_sink_in_input_order(spark, tmp_path):
    from tidewatch.sinks import in_input_order

    p = write_lines(tmp_path / "t.tsv", ["a\tb\tc"] + [f"{i}\tx\ty" for i in (5, 3, 9, 1)])
    df = T.read_tsv_tolerant(spark, p, ["a", "b", "c"]).repartition(3)
    assert [r.a for r in in_input_order(df).collect()] == ["5", "3", "9", "1"]


def test_kisti_by_name_in_a_wider_file(spark, tmp_path):
    from tidewatch import schemas
    from tidewatch.sources.tables import read_kisti_tsv

    names = [f.name for f in schemas.KISTI_RAW.fields]
    cells = ["443.0" if f.dataType.simpleString() in ("int", "bigint") else "1" for f in schemas.KISTI_RAW.fields]
    path = tmp_path / "wide.tsv"
    path.write_text("\t".join(["extra", *reversed(names), "tail"]) + "\n" + "\t".join(["x", *reversed(cells), "y"]) + "\n")
    row = read_kisti_tsv(spark, str(path)).first()
    for f in schemas.KISTI_RAW.fields:
        if f.dataType.simpleString() in ("int", "bigint"):
            assert row[f.name] == 443
    (tmp_path / "narrow.tsv").write_text("extra\n1\n")
    with pytest.raises(ValueError):
        read_kisti_tsv(spark, str(tmp_path / "narrow.tsv"))


def test_repeated_headers_and_text_columns(spark, tmp_path):
    from tidewatch.sources.tables import read_labelled_flows

    (tmp_path / "a.csv").write_text("Flow ID, Fwd Header Length, Fwd Header Length, Label\nf-1,1,2,BENIGN\n")
    row = read_labelled_flows(spark, str(tmp_path)).first().asDict()
    assert row == {"Flow ID": "f-1", "Fwd Header Length": 1.0, "Fwd Header Length.1": 2.0, "Label": "BENIGN"}
