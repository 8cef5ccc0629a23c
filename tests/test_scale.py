"""Skew behaviour: one key holding a third of all rows."""

import pandas as pd
from pyspark.sql import functions as F

from tidewatch.operators import correlate as C
from tidewatch.operators import reports as R
from tidewatch.operators import sampling as M


def _hot(spark, n=3000):
    # a third of the rows: group 'hot' with one repeated value
    rows = [("hot", 5.0) if i % 3 == 0 else (f"g{i % 7}", float(i % 101)) for i in range(n)]
    return spark.createDataFrame(rows, "grp string, v double")


def test_ordinal_spreads_a_hot_repeated_key(spark):
    df = _hot(spark)
    ranked = C.with_ordinal(df, ["grp", "v"], "r")
    sizes = [r["count"] for r in ranked.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert max(sizes) < 1000  # the 1000 identical ('hot', 5.0) rows are not in one task
    ords = sorted(r.r for r in ranked.select("r").collect())
    assert ords == list(range(1, 3001))
    # order is respected: ranks follow (grp, v)
    pdf = ranked.toPandas().sort_values("r")
    assert list(zip(pdf.grp, pdf.v)) == sorted(zip(pdf.grp, pdf.v))


def test_quantiles_and_sampling_with_hot_group(spark):
    df = _hot(spark)
    got = {(r.grp, r.q): r.value for r in R.grouped_exact_quantiles(df, "grp", "v", [0.25, 0.5, 0.9]).collect()}
    pdf = df.toPandas()
    for (g, q), v in got.items():
        assert abs(v - pdf[pdf.grp == g].v.quantile(q)) < 1e-9
    keyed = df.withColumn("k", F.monotonically_increasing_id())
    sample = M.stratified_sample(keyed, "grp", "k", 0.1, 42)
    counts = {r.grp: r["count"] for r in sample.groupBy("grp").count().collect()}
    assert counts["hot"] == 100


def test_best_alert_aggregates_before_shuffle(spark):
    rows = [(1 if i % 3 == 0 else i, "alert", i % 4, f"sig{i % 5}", None, i) for i in range(600)]
    ev = spark.createDataFrame(rows, "flow_id long, event_type string, severity int, signature string, "
                                     "category string, ord long")
    plan = C.best_alert_per_flow(ev)._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by" in plan  # map-side partial aggregation of the hot flow id
    best = {r.flow_id: r for r in C.best_alert_per_flow(ev).collect()}
    hot = pd.DataFrame([r for r in rows if r[0] == 1], columns=["f", "e", "s", "sig", "c", "o"])
    first = hot.sort_values(["s", "o"]).iloc[0]
    assert (best[1].severity, best[1].signature) == (first.s, first.sig)


def test_null_keys_take_the_broadcast_path(spark):
    left = spark.createDataFrame([(None if i % 3 == 0 else i % 10, i) for i in range(300)], "k long, x long")
    right = spark.createDataFrame([(None, "n"), (1, "a"), (2, "b")], "k long, tag string")
    out = C.null_safe_left_join(left, right, "k")
    got = {r.x: r.tag for r in out.collect()}
    assert all(got[i] == "n" for i in range(0, 300, 3))
    assert got[1] == "a" and got[4] is None and len(got) == 300
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_joins_split_a_hot_key(spark):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k"}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        ids = F.col("id")
        flows = spark.range(0, 40000, 1, 8).select(
            F.when(ids % 2 == 0, F.lit(7)).otherwise(ids).alias("flow_id"), F.md5(ids.cast("string")).alias("x"))
        best = spark.range(0, 40000, 1, 8).groupBy((ids % 20000).alias("flow_id")).agg(F.count(F.lit(1)).alias("n"))
        for joined in (C.null_safe_left_join(flows, best, "flow_id"),
                       C.semi_join_reduce(flows, best, "flow_id"),
                       C.lookup_join_drop(flows, best, "flow_id", "n")):
            per_task = joined.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("rows"))
            sizes = [r["rows"] for r in per_task.collect()]
            assert max(sizes) < 15000, sizes  # the 20000 rows of flow 7 lie in several tasks
    finally:
        for k in conf:
            spark.conf.unset(k)


def test_rows_of_one_row_group_are_dealt(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    from tidewatch.session import dealt

    pq.write_table(pa.table({"a": list(range(50_000)), "b": [f"x{i * 7919 % 50_021}" for i in range(50_000)]}), tmp_path / "one.parquet")
    known = {c: spark.conf.get(c) for c in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for c in known:
            spark.conf.set(c, "16k")
        df = spark.read.parquet(str(tmp_path / "one.parquet"))
        assert df.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism  # many splits, one of them with rows
        sizes = [len(x) for x in dealt(df).rdd.glom().collect()]
        assert sum(sizes) == 50_000 and max(sizes) <= 2 * 50_000 / spark.sparkContext.defaultParallelism
        assert dealt(df.limit(0)).count() == 0
    finally:
        for c, v in known.items():
            spark.conf.set(c, v)


def _events(spark, folder, n=400):
    kinds = "element_at(array('click', 'view', 'error', 'purchase', 'signup'), int(id % 5) + 1)"
    spark.range(0, n, 1, 2).selectExpr(
        "id AS event_id", "timestamp_micros(id * 1000000) AS ts", "id % 23 AS user_id", f"{kinds} AS event_type", "double(id % 9) AS value",
        "concat('{\"k\": ', id % 101, '}') AS props").write.parquet(f"{folder}/events.parquet")
    return str(folder)


def test_log_lines_are_made_in_code_the_jit_compiles(spark, tmp_path):
    from tidewatch.plans import views as V

    sf = _events(spark, tmp_path)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = V.eve_events(spark, sf)
        mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen")
        code = df._jdf.queryExecution().explainString(mode)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    sizes = [int(x.split(";")[0]) for x in code.split("maxMethodCodeSize:")[1:]]
    assert sizes and max(sizes) < 8000  # HotSpot interprets longer methods


def test_counts_parse_the_log_once(spark, tmp_path):
    from tidewatch.plans import q_reports as Q

    got = Q.q_count_reconciliation(spark, _events(spark, tmp_path))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "JsonToStructs" not in plan and "from_json" not in plan  # both inputs read the flows written by the one parse
    assert got.first().rows_a > got.first().rows_b > 0
