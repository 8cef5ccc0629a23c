"""Registered queries: SQL twins, and the pipeline on small tables."""

import math

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidewatch.llm import registry, topk


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_query_matches_sql(spark, sf, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    got, want = registry.QUERIES[name](spark, sf), con.execute(registry.ORACLE[name])
    cols = [d[0] for d in want.description]
    assert sorted(cols) == sorted(got.columns)
    key = lambda r: tuple((x is None, str(x)) for x in r)
    assert sorted((tuple(r) for r in got.select(*cols).collect()), key=key) == sorted(want.fetchall(), key=key)


def test_top_k_of_odd_vectors(spark):
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (1, [3.0, -1.0]), (2, None), (3, [float("nan"), 1.0]), (4, [None, 1.0]), (5, [3.0, -1.0]), (50, [0.5]), (None, [9.0, 9.0]), (6, []), (7, [float("inf"), 0.0])]
    got = topk.exact_top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 50 == 0, 2)
    assert sorted(tuple(r) for r in got.collect()) == [(0, 1, 1, 65536), (0, 2, 5, 65536), (50, 1, 1, 98304), (50, 2, 5, 98304)]
    assert topk.exact_top_k(spark.createDataFrame([], "vec_id long, embedding array<double>"), F.lit(True)).count() == 0


def test_top_k_with_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(topk, "CHUNK", 8)
    v = spark.range(400).select(F.col("id").alias("vec_id"), F.transform(F.sequence(F.lit(1), F.lit(5)), lambda i: F.sin(F.col("id") * i)).alias("embedding"))
    rows = [(r.vec_id, [math.floor(256 * x) for x in r.embedding]) for r in v.collect()]
    want = [(q, k + 1, i, s) for q, a in rows if q % 50 == 0 for k, (s, i) in enumerate(sorted(((sum(x * y for x, y in zip(a, b)), i) for i, b in rows if i != q), key=lambda z: (-z[0], z[1]))[:5])]
    assert sorted(tuple(r) for r in topk.exact_top_k(v, F.col("vec_id") % 50 == 0).collect()) == sorted(want)


def test_pipeline_stages(spark, sf, odd_documents):
    docs = odd_documents.select(*corpus_pipeline.COLUMNS)
    kept = corpus_pipeline.language(spark, docs, sf)
    assert kept.columns == corpus_pipeline.COLUMNS and {r.doc_id for r in kept.collect()} == {1, 2, 6, 7, None, 9, 10}
    kept = corpus_pipeline.near_duplicates(spark, kept, sf)
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 1, 6, 9, 10]
    item = spark.read.parquet(f"{sf}/benchmark.parquet").orderBy("item_id").first()
    leak = kept.unionByName(spark.createDataFrame([(77, "before " + item.text + " after", "en", "a", 1)], kept.schema))
    assert sorted((r.doc_id or 0) for r in corpus_pipeline.decontamination(spark, leak, sf).collect()) == [0, 1, 6, 9, 10]
    clean = {r.doc_id: r for r in corpus_pipeline.personal_data(spark, kept, sf).collect()}
    assert "joe@" not in clean[10].text and clean[10].n_chars == len(clean[10].text) and clean[9].text == "x"


def test_pipeline_without_languages(spark, sf, odd_documents):
    docs = odd_documents.select(*corpus_pipeline.COLUMNS).withColumn("lang", F.lit(None).cast("string"))
    assert {r.doc_id for r in corpus_pipeline.language(spark, docs, sf).collect()} == {1, 2, 6, 7, None, 9, 10}


def test_pipeline_runs(spark, sf):
    got = corpus_pipeline.run(spark, sf).toPandas()
    assert got.groupby("sequence_id").length.sum().max() <= 4096 and got.doc_id.nunique() <= 200
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "ngram_jaccard_join", "benchmark_decontamination", "pii", "best_fit_packing"]
