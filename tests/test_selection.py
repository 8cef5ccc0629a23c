"""Draws and quartiles by selection: exact, and without moving the wide rows."""

import hashlib
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidewatch.operators import sampling as M


def position(key):
    return -1 if key is None else int(hashlib.md5(f"{key}:42".encode()).hexdigest()[:8], 16)


def rows_of(spark, repeated=False):
    rng = random.Random(2)
    rows = [(rng.choice(["a", "a", "a", "b", None]), "c%d" % (i % 3), i if not repeated else i % 40, f"wide{i}") for i in range(900)]
    rows += [("alone", "c0", -5, "w"), ("b", "c1", None, "no key")]
    return spark.createDataFrame(rows, "cls string, chunk string, key long, payload string").repartition(5)


@pytest.mark.parametrize("groups", [["cls"], ["cls", "chunk"]])
def test_draw_equals_ranking(spark, groups):
    df = rows_of(spark)
    pdf = df.toPandas()
    pdf["key"] = pd.Series([None if pd.isna(k) else int(k) for k in pdf["key"]], dtype=object)
    want = set()
    for _, g in pdf.groupby(groups, dropna=False):
        g = sorted(g.itertuples(), key=lambda r: (position(r.key), r.key is not None, r.key or 0))
        want |= {r.payload for r in g[:max(1, len(g) // 10)]}
    got = M.stratified_sample(df, "cls", "key", 0.1, 42, chunk="chunk" if len(groups) > 1 else None)
    assert got.columns == df.columns and sorted(r.payload for r in got.collect()) == sorted(want)


def test_repeated_keys_keep_exact_sizes(spark):
    df = rows_of(spark, repeated=True)
    split = M.stratified_split(df, "cls", "key", 0.2, 42)
    got = {r.cls: (r.n, r.t) for r in split.groupBy("cls").agg(F.count("*").alias("n"), F.count_if("is_test").alias("t")).collect()}
    assert all(t == int(n * 0.2) for n, t in got.values()) and got["alone"] == (1, 0)
    assert sum(n for n, _ in got.values()) == df.count()


def test_wide_rows_are_not_shuffled(spark):
    df = spark.range(5000).selectExpr("id AS key", "cast(id % 3 AS string) AS cls", "repeat('x', 50) AS payload")
    plan = M.stratified_split(df, "cls", "key")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "Exchange rangepartitioning" not in plan and "Sort " not in plan
    assert M.stratified_sample(spark.createDataFrame([], "cls string, key long"), "cls", "key").count() == 0


def _profiled(spark, n):
    hot = F.col("id") % 3 == 0
    return spark.range(0, n, 1, 6).select(
        F.when(hot, F.lit("hot")).when(F.col("id") % 3 == 1, F.lit("wide")).when(F.col("id") % 9 == 2, F.lit(None)).otherwise(F.lit("few")).alias("grp"),
        F.when(hot & (F.col("id") % 2 == 0), F.lit(5.0)).when(F.col("id") % 97 == 1, F.lit(float("nan"))).otherwise(F.exp(F.sin(F.col("id") * 1.0) * 50)).alias("v"))


@pytest.mark.parametrize("bracket, grid", [(100_000, 1000), (40, 10)])
def test_quantiles_by_narrowing(spark, monkeypatch, bracket, grid):
    from tidewatch.operators import reports as R

    monkeypatch.setattr(R, "BRACKET_ROWS", bracket)
    monkeypatch.setattr(R, "GRID", grid)
    qs = [0.0, 0.25, 0.9]
    df = _profiled(spark, 1500)
    got = {(r.grp, r.q): r.value for r in R.grouped_exact_quantiles(df, "grp", "v", qs).collect()}
    pdf = df.toPandas()
    for name in ("hot", "wide", "few", None):
        own = pdf[pdf.grp.isna() if name is None else pdf.grp == name].v.dropna()
        for q in qs:
            assert got[name, q] == pytest.approx(own.quantile(q), rel=1e-12)
    assert len(got) == 12


def test_profile_of_empty_columns(spark):
    from tidewatch.operators import reports as R

    df = spark.createDataFrame([(1.0, None, 7), (float("nan"), None, 7), (3.0, None, None)], "a double, b double, c long")
    rows = {r["column"]: r for r in R.numeric_profile(df, ["a", "b", "c"]).collect()}
    assert (rows["a"]["count"], rows["a"].p50, rows["a"]["max"]) == (2, 2.0, 3.0)
    assert rows["b"]["count"] == 0 and rows["b"].mean is None and rows["b"].p25 is None
    assert (rows["c"]["count"], rows["c"].p25, rows["c"].p75, rows["c"]["std"]) == (2, 7.0, 7.0, 0.0)
    assert {r["column"]: r["count"] for r in R.numeric_profile(df.limit(0), ["a", "b"]).collect()} == {"a": 0, "b": 0}


def test_profile_sorts_no_whole_column(spark):
    from tidewatch.operators import reports as R

    plan = R.numeric_profile(_profiled(spark, 3000), ["v"])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange rangepartitioning" not in plan
