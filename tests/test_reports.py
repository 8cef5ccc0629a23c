"""Scalar functions, metrics (FIXTURES §2, §5), sampling (§6) and report properties."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidewatch.functions import scalar as X
from tidewatch.operators import correlate as C
from tidewatch.operators import learning as L
from tidewatch.operators import reports as R
from tidewatch.operators import sampling as M


def test_signature_classes(spark):
    cases = [("ET SCAN nmap", 4), ("scan trojan", 4), ("Trojan.X", 1), ("sql injection", 2), ("SSH login", 3),
             ("brute force", 3), ("hello", 0), ("", 0), (None, 0), ("straßhausen", 3)]
    df = spark.createDataFrame(cases, "s string, expected int")
    got = [(r.s, r.c) for r in df.select("s", X.signature_class("s").alias("c")).collect()]
    assert got == [(s, e) for s, e in cases]


def test_code_lookups(spark):
    df = spark.createDataFrame([("TCP",), ("tcp",), (None,), ("ICMPv6",)], "p string")
    assert [r.c for r in df.select(X.proto_code("p").alias("c")).collect()] == [6, -1, -1, 58]
    codes = spark.createDataFrame([(0,), (4,), (9,)], "c int")
    assert [r.l for r in codes.select(X.attack_label("c").alias("l")).collect()] == ["UNKNOWN", "Scanning", "9"]


def test_compact_timestamps(spark):
    df = spark.createDataFrame([("20170703153045", "20170703153145"), ("20170732000000", "20170703153145"),
                                ("2017070315304", "20170703153145"), (None, "20170703153145")], "s string, e string")
    assert [r.d for r in df.select(X.seconds_between_compact("s", "e").alias("d")).collect()] == [60, None, None, None]


@pytest.fixture()
def pairs(spark):
    return spark.createDataFrame([(0, 0), (0, 1), (1, 1), (1, 1), (2, 1)], "y int, p int")


def test_classification_report(pairs):
    rep = {r.label: r for r in R.classification_report(pairs).collect()}
    assert (rep["0"].precision, rep["0"].recall, rep["0"].f1, rep["0"].support) == (1.0, 0.5, 0.6667, 2)
    assert (rep["1"].precision, rep["1"].recall, rep["1"].f1, rep["1"].support) == (0.5, 1.0, 0.6667, 2)
    assert (rep["2"].precision, rep["2"].recall, rep["2"].f1, rep["2"].support) == (0.0, 0.0, 0.0, 1)
    assert (rep["accuracy"].f1, rep["accuracy"].support) == (0.6, 5)
    assert (rep["macro avg"].precision, rep["macro avg"].recall, rep["macro avg"].f1) == (0.5, 0.5, 0.4444)
    assert (rep["weighted avg"].precision, rep["weighted avg"].recall, rep["weighted avg"].f1) == (0.6, 0.6, 0.5333)
    # weighted recall equals accuracy
    assert rep["weighted avg"].recall == R.accuracy(pairs).first().accuracy


def test_confusion_and_union(pairs):
    cm = {(r.y, r.p): r.n for r in R.confusion_matrix(pairs).collect()}
    assert cm == {(0, 0): 1, (0, 1): 1, (1, 1): 2, (2, 1): 1}
    assert sorted(r.label for r in R.label_union(pairs).collect()) == [0, 1, 2]


def test_balanced_weights(pairs):
    w = {r.y: round(r.weight, 4) for r in L.class_balanced_weights(pairs, "y").select("y", "weight").distinct().collect()}
    assert w == {0: 0.8333, 1: 0.8333, 2: 1.6667}


def test_stratified_sample_sizes(spark):
    rows = [(i, c) for c, n in (("a", 1), ("b", 9), ("c", 10), ("d", 25)) for i in range(n)]
    df = spark.createDataFrame([(f"{c}{i}", c) for i, c in rows], "key string, cls string")
    got = {r.cls: r["count"] for r in M.stratified_sample(df, "cls", "key", 0.1, 42).groupBy("cls").count().collect()}
    assert got == {"a": 1, "b": 1, "c": 1, "d": 2}
    # independent of partitioning
    again = M.stratified_sample(df.repartition(5), "cls", "key", 0.1, 42)
    a = sorted(r.key for r in M.stratified_sample(df, "cls", "key", 0.1, 42).collect())
    assert a == sorted(r.key for r in again.collect())


def test_stratified_split_and_hash_split(spark):
    df = spark.range(1000).withColumn("cls", (F.col("id") % 3).cast("string"))
    split = M.stratified_split(df, "cls", "id", 0.2, 42)
    assert {r.cls: r["count"] for r in split.filter("is_test").groupBy("cls").count().collect()} == {"0": 66, "1": 66, "2": 66}
    hs = M.hash_split(df, "id", 20, 42)
    n_test = hs.filter("is_test").count()
    assert 120 < n_test < 280


def test_exact_quantiles_match_pandas(spark):
    vals = [3.0, 1.0, 4.0, 1.0, 5.0, 9.0, 2.0, 6.0, 5.0, 3.0, 5.0, None]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    got = {r.q: r.value for r in R.exact_quantiles(df, "v", [0.25, 0.5, 0.75]).collect()}
    s = pd.Series([v for v in vals if v is not None])
    assert got == {q: pytest.approx(s.quantile(q)) for q in (0.25, 0.5, 0.75)}
    prof = R.numeric_profile(df, ["v"]).first()
    assert prof["count"] == 11 and prof["p50"] == s.quantile(0.5) and prof["max"] == 9.0


def test_null_profile(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, "x")], "a int, b string")
    assert {r.column: r.nulls for r in R.null_profile(df).collect()} == {"a": 1, "b": 2}
    assert R.total_nulls(df).first().nulls == 3


def test_value_counts_and_shares(spark):
    df = spark.createDataFrame([("x",), ("y",), ("x",), (None,)], "c string")
    assert [(r.c, r["count"]) for r in R.value_counts_sorted(df, "c").collect()] == [("x", 2), ("y", 1)]
    shares = {r.c: r.share_pct for r in R.value_shares(df, "c").collect()}
    assert shares == {"x": 66.6667, "y": 33.3333}


def test_with_ordinal_and_zip(spark):
    a = spark.range(0, 100, 1, numPartitions=7).withColumnRenamed("id", "ka")
    b = spark.range(0, 60, 1, numPartitions=3).select((F.col("id") * 10).alias("kb"))
    z = C.zip_by_order(a, b, "ka", "kb").orderBy("ordinal").collect()
    assert len(z) == 60
    assert all(r.ordinal == r.ka + 1 and r.kb == r.ka * 10 for r in z)
    rec = C.count_reconciliation(a, b).first()
    assert (rec.rows_a, rec.rows_b, rec.counts_match) == (100, 60, False)


def test_shuffle_partitions_invariance(spark, pairs):
    before = sorted(map(tuple, R.classification_report(pairs).collect()), key=str)
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        after = sorted(map(tuple, R.classification_report(pairs).collect()), key=str)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert before == after


def test_confusion_matrix_wide(pairs):
    wide = {r.y: (r["0"], r["1"], r["2"]) for r in R.confusion_matrix_wide(pairs, [0, 1, 2]).collect()}
    assert wide == {0: (1, 1, 0), 1: (0, 2, 0), 2: (0, 1, 0)}
