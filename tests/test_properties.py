"""Property tests: Spark column rules against plain-Python statements of the same rules."""

from datetime import datetime, timedelta, timezone

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidewatch import schemas
from tidewatch.functions import scalar as X


def py_signature_class(sig):
    if not sig:
        return 0
    up = sig.upper()
    for code, words in schemas.SIGNATURE_CLASSES:
        if any(w in up for w in words):
            return code
    return 0


WORDS = ["scan", "Trojan", "sql", "ssh", "force", "hello", "port scan", "wOrM", "php", "ß", "stream", "x", " "]
texts = st.one_of(st.none(), st.lists(st.sampled_from(WORDS), max_size=6).map("".join), st.text(max_size=12))


@settings(max_examples=1, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(texts, min_size=50, max_size=50))
def test_signature_class_matches_python(spark, batch):
    df = spark.createDataFrame([(s,) for s in batch], "s string")
    got = [r.c for r in df.select(X.signature_class("s").alias("c")).collect()]
    assert got == [py_signature_class(s) for s in batch]


def py_duration_us(start, end):
    try:
        return round((end - start).total_seconds() * 1_000_000, 6)
    except TypeError:
        return 0.0


stamps = st.datetimes(min_value=datetime(2020, 1, 1), max_value=datetime(2030, 1, 1)).map(
    lambda d: d.replace(tzinfo=timezone(timedelta(hours=9))))


@settings(max_examples=1, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.one_of(st.none(), stamps), st.one_of(st.none(), stamps)), min_size=40, max_size=40))
def test_duration_rules_match_python(spark, pairs):
    fmt = lambda d: None if d is None else d.strftime("%Y-%m-%dT%H:%M:%S.%f%z")
    df = spark.createDataFrame([(fmt(a), fmt(b)) for a, b in pairs], "s string, e string")
    got = [r.d for r in df.select(X.duration_us_zero("s", "e").alias("d")).collect()]
    assert got == [py_duration_us(a, b) for a, b in pairs]
    floor = [r.d for r in df.select(X.duration_us_floor("s", "e").alias("d")).collect()]
    assert floor == [max((b - a).total_seconds() * 1e6, 1) if a and b else 1.0 for a, b in pairs]


@settings(max_examples=1, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.floats(0, 1e6, allow_nan=False), st.integers(0, 50)), min_size=40, max_size=40))
def test_safe_rounded_mean_matches_python(spark, rows):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(float(b), float(p)) for b, p in rows], "b double, p double")
    got = [r.m for r in df.select(F.bround(X.safe_div(F.col("b"), F.col("p")), 6).alias("m")).collect()]
    want = [round(b / p, 6) if p > 0 else 0.0 for b, p in rows]
    assert all(abs(g - w) <= 1e-6 for g, w in zip(got, want))
