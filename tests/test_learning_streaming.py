"""Forest train / save / load / score, and batch == stream for the live-scoring rules."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import write_lines
from test_events import LINES
from tidewatch import schemas
from tidewatch.operators import features as FX
from tidewatch.operators import learning as L
from tidewatch.plans.catalogue import rule_scorer
from tidewatch.sources.events import read_events
from tidewatch.streaming.scoring import read_scored, start_scoring_stream


def _toy(spark):
    rows = []
    for i in range(300):
        c = i % 3
        rows.append((float(c * 10 + (i % 7)), float((i * 13) % 11), ["BENIGN", "DDoS", "PortScan"][c]))
    return spark.createDataFrame(rows, "a double, b double, Label string")


def test_forest_save_load_score(spark, tmp_path):
    df = _toy(spark)
    model = L.train_forest(df, ["a", "b"], num_trees=5, max_depth=4)
    path = str(tmp_path / "model")
    L.save_model(model, path)
    loaded = L.load_model(path)
    s1 = L.score(model, df).select("model_label", "model_confidence_pct").collect()
    s2 = L.score(loaded, df).select("model_label", "model_confidence_pct").collect()
    assert s1 == s2
    acc = L.score(model, df).agg(F.avg((F.col("Label") == F.col("model_label")).cast("double"))).first()[0]
    assert acc > 0.9
    imps = L.feature_importances(model, spark).collect()
    assert {r.feature for r in imps} == {"a", "b"}
    d = L.describe_model(model, spark).first()
    assert d.num_trees == "5" and d.classes == "BENIGN,DDoS,PortScan"
    # input columns survive scoring (no positional pairing needed)
    assert set(df.columns) <= set(L.score(model, df).columns)


def test_weighted_forest(spark):
    df = L.class_balanced_weights(_toy(spark), "Label")
    model = L.train_forest(df, ["a", "b"], num_trees=3, max_depth=3, weight_col="weight")
    assert L.score(model, df).count() == 300


def test_stream_equals_batch(spark, tmp_path):
    in_dir = tmp_path / "in"
    in_dir.mkdir()
    write_lines(in_dir / "eve-0001.json", LINES[:7])
    write_lines(in_dir / "eve-0002.json", LINES[7:])
    out, ckpt = str(tmp_path / "out"), str(tmp_path / "ckpt")
    q = start_scoring_stream(spark, str(in_dir), out, ckpt, rule_scorer, trigger={"availableNow": True},
                             max_files_per_trigger=1)
    q.awaitTermination()
    streamed = read_scored(spark, out)
    assert sorted(r.batch_id for r in streamed.select("batch_id").distinct().collect()) == [0, 1]
    cols = ["flow_id", *schemas.CIC_18, "model_label"]
    batch = rule_scorer(FX.flow_features_stream_rules(read_events(spark, str(in_dir))))
    key = lambda rows: sorted(map(tuple, rows), key=str)
    assert key(streamed.select(*cols).collect()) == key(batch.select(*cols).collect())
    assert streamed.filter("is_alert").count() == batch.filter(F.col("model_label") != "BENIGN").count()
    assert os.path.isdir(ckpt)


def test_stream_start_at_end_and_batch_ordinal(spark, tmp_path):
    import time

    in_dir = tmp_path / "in2"
    in_dir.mkdir()
    old = write_lines(in_dir / "eve-old.json", LINES)
    past = time.time() - 3600
    os.utime(old, (past, past))
    out, ckpt = str(tmp_path / "out2"), str(tmp_path / "ckpt2")
    q = start_scoring_stream(spark, str(in_dir), out, ckpt, rule_scorer, start_at_end=True,
                             trigger={"availableNow": True})
    q.awaitTermination()
    assert not os.path.exists(out) or read_scored(spark, out).count() == 0  # backlog skipped
    new = write_lines(in_dir / "eve-new.json", LINES)
    future = time.time() + 3600
    os.utime(new, (future, future))
    q = start_scoring_stream(spark, str(in_dir), out, ckpt, rule_scorer, start_at_end=True,
                             trigger={"availableNow": True}, ordinal=True)
    q.awaitTermination()
    rows = read_scored(spark, out).collect()
    assert len(rows) == 4
    assert sorted(r.batch_ordinal for r in rows) == [1, 2, 3, 4]


def test_reference_headers(spark):
    from tidewatch.sinks import as_reference_headers

    df = spark.createDataFrame([(1.0, "BOTH", 2.0)], "flow_bytes_per_s double, outcome string, other double")
    out = as_reference_headers(df)
    assert out.columns == ["Flow Bytes/s", "결과분류", "other"]
    assert out.first()[1] == "둘 다 탐지"


def test_kafka_source_needs_connector(spark):
    import pytest

    from tidewatch.sources.events import event_lines_kafka

    try:
        df = event_lines_kafka(spark, "localhost:1", "eve")
    except RuntimeError as e:
        assert "connector" in str(e)
    else:  # connector present: the frame has the line schema
        assert df.columns == ["value", "ord"]
        pytest.skip("kafka connector available")


def test_forest_is_the_same_without_cached_node_ids(spark):
    df = spark.range(0, 4000, numPartitions=4).selectExpr("double(id % 97) AS a", "double(id * 7 % 31) AS b", "if(id % 97 > 40 AND id * 7 % 31 < 17, 'x', 'y') AS Label")
    kept, walked = (L.train_forest(df, ["a", "b"], num_trees=5, max_depth=6, **x) for x in ({}, {"cached_ids": 0}))
    trees = lambda m: [t.toDebugString.split("\n", 1)[1] for t in L.forest_of(m).trees]
    assert trees(kept) == trees(walked)
    assert L.forest_of(kept).getCacheNodeIds() and not L.forest_of(walked).getCacheNodeIds()


def test_forest_deals_large_partitions_anew(spark, monkeypatch):
    seen = []
    fit = L.RandomForestClassifier.fit
    monkeypatch.setattr(L.RandomForestClassifier, "fit", lambda self, df: seen.append(df.rdd.getNumPartitions()) or fit(self, df))
    df = spark.range(0, 4000, numPartitions=1).selectExpr("double(id % 97) AS a", "if(id % 97 > 40, 'x', 'y') AS Label")
    L.train_forest(df, ["a"], num_trees=5, max_depth=3)
    L.train_forest(df, ["a"], num_trees=5, max_depth=3, task_ids=5000)
    assert seen == [1, 8]


def test_forest_has_no_more_tasks_than_needed(spark, monkeypatch):
    seen = []
    fit = L.RandomForestClassifier.fit
    monkeypatch.setattr(L.RandomForestClassifier, "fit", lambda self, df: seen.append((df.rdd.getNumPartitions(), df.count())) or fit(self, df))
    df = spark.range(0, 4000, numPartitions=100).selectExpr("double(id % 97) AS a", "if(id % 97 > 40, 'x', 'y') AS Label")
    L.train_forest(df, ["a"], num_trees=5, max_depth=3)  # each task would shuffle the statistics of all nodes
    monkeypatch.setattr(L, "DEALT_IDS", 5000)
    L.train_forest(df.coalesce(1), ["a"], num_trees=5, max_depth=3)
    cores = spark.sparkContext.defaultParallelism
    assert seen == [(cores, 4000), (cores, 4000)]


def counted(spark, df):
    """``df`` and an accumulator of its rows that were computed, over all passes."""
    seen = spark.sparkContext.accumulator(0)

    def run(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    return df.mapInArrow(run, df.schema), seen


@pytest.fixture
def small_tables():
    path = "/root/testdata/sf0.001"
    if not os.path.isdir(path):
        pytest.skip("driver tables not present")
    return path


def test_gap_forest_parses_the_log_once(spark, monkeypatch, small_tables):
    from tidewatch.plans import q_gap

    lines, parsed = counted(spark, q_gap.gap_lines(spark, small_tables))
    monkeypatch.setattr(q_gap, "gap_lines", lambda *a: lines)
    for name, value in (("_FORESTS", {}), ("NUM_TREES", 2), ("MAX_DEPTH", 2)):
        monkeypatch.setattr(q_gap, name, value)
    _, flows = q_gap.gap_forest(spark, small_tables)
    assert flows.filter("is_test").count()
    assert parsed.value == spark.read.parquet(f"{small_tables}/events.parquet").count()


def test_kisti_rows_are_joined_once(spark, monkeypatch, small_tables):
    from tidewatch.plans import q_learning, views

    raw, joined = counted(spark, views.kisti_frame(spark, small_tables))
    monkeypatch.setattr(views, "kisti_frame", lambda *a: raw)
    monkeypatch.setattr(q_learning, "_MODELS", {})
    _, rows = q_learning.kisti_model(spark, small_tables, 2, 2)
    assert rows.filter("is_test").count()
    lines, orders = (spark.read.parquet(f"{small_tables}/{t}.parquet") for t in ("lineitem", "orders"))
    assert joined.value == lines.join(orders, F.expr("l_orderkey = o_orderkey")).count()


def _rule_rows(spark, n=4000):
    b = F.pmod(F.hash("id"), F.lit(1000))
    label = F.when(b > 600, "A").when(F.col("id") % 7 > 3, "B").otherwise("C")
    return spark.range(0, n, 1, 3).select((F.col("id") % 7).cast("double").alias("a"), b.cast("double").alias("b"), F.lit(0.0).alias("c"), label.alias("Label"))


def test_forest_in_blocks_learns_as_sparks_does(spark, monkeypatch, tmp_path):
    """A fit of many rows x trees leaves Spark's forest; same settings, and what it says of a rule with gaps."""
    from tidewatch.operators import forest as B

    monkeypatch.setattr(B, "BLOCK_ROWS", 500)
    used = []
    plain = B.fitted
    monkeypatch.setattr(B, "fitted", lambda *a: used.append(1) or plain(*a))
    rows = _rule_rows(spark)
    kept = L.train_forest(rows, ["a", "b", "c"], num_trees=12, max_depth=6)
    assert not used
    model, again = (L.train_forest(rows, ["a", "b", "c"], num_trees=12, max_depth=6, block_ids=10_000) for _ in range(2))
    assert len(used) == 2 and L.forest_of(model).toDebugString.split("\n")[1:] == L.forest_of(again).toDebugString.split("\n")[1:]
    assert L.describe_model(model, spark).first() == L.describe_model(kept, spark).first()
    assert L.forest_of(model).getMaxDepth() == 6 and max(t.depth for t in L.forest_of(model).trees) <= 6
    L.save_model(model, str(tmp_path / "m"))
    for m in (kept, L.load_model(str(tmp_path / "m"))):
        assert L.score(m, rows).filter("model_label <> Label").count() < 0.05 * rows.count()
    x, y = (L.forest_of(m).featureImportances.toArray() for m in (model, kept))
    assert x[2] == 0 and abs(x - y).max() < 0.15
    deep = L.train_forest(rows.limit(300), ["a", "b"], num_trees=2, max_depth=B.DEEPEST + 1, block_ids=0)
    assert len(used) == 2 and L.forest_of(deep).getNumTrees == 2  # too deep for it: Spark's


def test_forest_in_blocks_on_odd_rows(spark):
    rows = _rule_rows(spark, 1000).withColumn("d", F.when(F.col("a") < 3, F.lit(None).cast("double")).otherwise(F.lit(float("nan"))))
    none = L.train_forest(rows, ["c", "d"], num_trees=3, max_depth=4, block_ids=0)  # nothing to split by
    assert L.forest_of(none).totalNumNodes == 3
    weighted = L.train_forest(L.class_balanced_weights(rows, "Label"), ["a", "b", "d"], num_trees=8, max_depth=5, weight_col="weight", block_ids=0)
    assert L.score(weighted, rows).filter("model_label <> Label").count() < 100
    one = L.train_forest(rows.withColumn("Label", F.lit("A")), ["a", "b"], num_trees=2, max_depth=3, block_ids=0)
    assert {r.model_label for r in L.score(one, rows).select("model_label").distinct().collect()} == {"A"}


def test_blocks_count_each_row_in_each_tree():
    import numpy as np
    import pandas as pd

    from tidewatch.operators import forest as B

    rng = np.random.default_rng(5)
    x, y = rng.integers(0, 4, (2, 300)).astype(np.uint8), rng.integers(0, 3, 300).astype("<u2")
    frame = pd.DataFrame({"block": [7], "n": [300], "bins": [x.tobytes()], "y": [y.tobytes()], "w": [b""]})
    level = B._Level(1, 2, 3, 4, 42)
    level.add(3, np.array([-1, 1]), np.array([0, 2]), [2, 3], [[0, 1], [0]])  # the root asks feature 1 for more than 2
    found = np.frombuffer(next(level.histograms([frame]))["found"][0])[:-3].reshape(3, 4, 3)
    times = B._poisson()[np.random.Generator(np.random.SFC64([42, 7, 3])).integers(0, 65536, 300, dtype=np.uint16)]
    want = np.zeros((3, 4, 3))
    for r in range(300):
        if x[1, r] > 2:
            want[2, x[0, r], y[r]] += times[r]
        else:
            want[0, x[0, r], y[r]] += times[r]
            want[1, x[1, r], y[r]] += times[r]
    assert (found == want).all() and 0.9 < B._poisson().mean() < 1.1
    leaf = lambda *s: (list(s), None, None, None)
    tree = {1: ([9, 3], 0.1, 0, 1.5), 2: leaf(4, 3), 3: ([5, 0], 0.0, 1, 2.5), 6: leaf(3, 0), 7: leaf(2, 0)}
    assert [(r[1][0], r[1][1], r[1][6]) for r in B.node_rows(0, tree)] == [(0, 0.0, -1)]  # all leaves say class 0
    tree[2] = leaf(1, 3)
    assert [(r[1][0], r[1][1], r[1][6], r[1][7]) for r in B.node_rows(0, tree)] == [(0, 0.0, 1, 2), (1, 1.0, -1, -1), (2, 0.0, -1, -1)]
