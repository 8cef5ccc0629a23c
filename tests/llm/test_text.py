"""Operators 1, 5, 6, 7, 8 and 9 against brute force on small tables."""

import hashlib
import math
import random
import re
import time
import zlib
from collections import Counter
from fractions import Fraction
from itertools import combinations

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewatch.llm import decontaminate, language_id, lm_ctw, ngram_join, pii, quotes


def _sets(rows, k):
    out = []
    for key, text in rows:
        w = (text or "").encode().lower().split()
        out.append((key, frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)]) if w else frozenset()))
    return out


def _brute(rows, k, t):
    sets = _sets(rows, k)
    root, links = list(range(len(sets))), [0] * len(sets)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in combinations(range(len(sets)), 2):
        a, b = sets[i][1], sets[j][1]
        if a and b and Fraction(len(a & b), len(a | b)) >= t:
            links[i] += 1
            links[j] += 1
            root[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for i, (key, _) in enumerate(sets):
        if key is not None:
            least[find(i)] = min(least.get(find(i), key), key)
    return Counter((key, len(s), least.get(find(i)), links[i]) for i, (key, s) in enumerate(sets))


@pytest.mark.parametrize("k, t", [(4, "0.85"), (5, "0.8")])
def test_join_equals_brute_force(spark, odd_documents, k, t):
    base = [f"w{(i * 7919) % 501}" for i in range(120)]
    near = [(100 + i, " ".join(base[:i % 9] + ["zz"] * (i % 3) + base[i % 11:])) for i in range(60)]
    short = [(300 + i, " ".join(base[:n])) for i, n in enumerate((1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 9, 10))]
    docs = odd_documents.unionByName(spark.createDataFrame(near + short, "doc_id long, text string"), allowMissingColumns=True)
    want = _brute([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()], k, Fraction(t))
    got = Counter((r.doc_id, r.n_shingles, r.component_id, r.n_links) for r in ngram_join.similar_documents(docs, k, t).collect())
    assert got == want


def test_join_in_block_pairs_and_long_lists(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "TASK_SETS", 8)
    monkeypatch.setattr(ngram_join, "SHORT_LIST", 4)
    base = [f"w{i}" for i in range(80)]
    rows = [(i, " ".join(base[:i % 70] + [f"x{i}"] + base[i % 70 + 1:])) for i in range(70)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter((r.doc_id, r.n_shingles, r.component_id, r.n_links) for r in ngram_join.similar_documents(docs, 4, "0.85").collect())
    assert got == _brute(rows, 4, Fraction("0.85"))


@pytest.mark.parametrize("hot", [16_000, 5])
def test_common_ngrams_do_not_chain_most_sets(spark, monkeypatch, hot):
    """Texts that share passages but not enough of them stay apart before the tasks' joins; lists beyond HOT_LIST chain them."""
    monkeypatch.setattr(ngram_join, "SHORT_LIST", 4)
    monkeypatch.setattr(ngram_join, "HEAVY_MOST", 0)
    monkeypatch.setattr(ngram_join, "HOT_LIST", hot)
    monkeypatch.setattr(ngram_join, "TASK_SETS", 20)
    passage = [[f"p{k}w{i}" for i in range(12)] for k in range(6)]
    rows = [(i, " ".join([f"own{i}x{k}" for k in range(60)] + passage[i % 6] + passage[(i // 6) % 6])) for i in range(120)]
    rows += [(200 + i, rows[i][1] + " end") for i in range(0, 120, 10)]
    sizes = []
    real = ngram_join.clusters_of

    def spy(edges):
        got = real(edges)
        sizes.append([r["count"] for r in got.groupBy("cluster").count().collect()])
        return got

    monkeypatch.setattr(ngram_join, "clusters_of", spy)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter((r.doc_id, r.n_shingles, r.component_id, r.n_links) for r in ngram_join.similar_documents(docs, 4, "0.85").collect())
    assert got == _brute(rows, 4, Fraction("0.85"))
    assert (max(sizes[0]) > 60) if hot == 5 else (max(sizes[0]) == 2 and len(sizes[0]) == 12)


def test_bitmaps_keep_every_linked_pair():
    rng = np.random.default_rng(3)
    t = Fraction("0.8")
    for n in (1, 5, 100, 255, 256, 257, 300, 3000, 80_000):
        s = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
        for m in (ngram_join.least_overlap(len(s), t), len(s)):
            less = np.sort(rng.choice(s, max(1, m), replace=False))
            a, b = (np.frombuffer(ngram_join.bitmap(x), "<u8") for x in (s, less))
            words = min(len(a), len(b))
            assert (ngram_join.folded(b, words) == np.frombuffer(ngram_join.bitmap(less), "<u8")[:words]).all() or len(b) > words
            differ = np.bitwise_count(ngram_join.folded(a, words) ^ ngram_join.folded(b, words)).sum()
            assert differ <= len(s) - len(less)
            assert ngram_join.leaves_room(differ, np.array([len(s)]), np.array([len(less)]), t).all()
    apart = [np.unique(rng.integers(0, 2**64, 400, dtype=np.uint64)) for _ in range(2)]
    a, b = (np.frombuffer(ngram_join.bitmap(x), "<u8") for x in apart)
    assert not ngram_join.leaves_room(np.bitwise_count(a ^ b).sum(), np.array([400]), np.array([400]), t).any()


def test_shuffle_files_are_freed_after_a_write(spark):
    import glob

    from tidewatch.llm import common

    before = spark.conf.get(common.FREE_SHUFFLE, None)
    common.written(spark.range(5).groupBy("id").count(), "freed")  # the folders of this session
    root = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()[0]
    files = set(glob.glob(f"{root}/*/shuffle_*"))
    common.written(spark.range(100_000).groupBy("id").count(), "freed")
    for _ in range(50):
        left = set(glob.glob(f"{root}/*/shuffle_*")) - files
        if not left:
            break
        time.sleep(0.1)
    assert not left and spark.conf.get(common.FREE_SHUFFLE, None) == before


def test_join_of_nothing(no_documents):
    assert ngram_join.similar_documents(no_documents).count() == 0


def test_only_texts_to_be_joined_are_shuffled(spark, monkeypatch):
    texts = spark.createDataFrame([(i, f"t{i}") for i in range(20)] + [(None, "none")], "doc_id long, payload string")
    chosen = spark.createDataFrame([(3, 1), (3, 2), (None, 3)], "rep long, uid long")
    got = ngram_join.wanted(texts, chosen)
    assert sorted(r.payload for r in got.collect()) == ["none", "t3"]
    assert "BroadcastHashJoin" in got._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(ngram_join, "BROADCAST_REPS", 1)
    assert ngram_join.wanted(texts, chosen).count() == 21


def test_lists_of_the_same_sets_are_paired_once(spark, monkeypatch):
    """Twelve near copies share very many lists; their pairs are made from the distinct ones."""
    words = [f"w{i}" for i in range(400)]
    docs = spark.createDataFrame([(k, " ".join([*words[:200], f"own{k}", *words[200:]])) for k in range(12)], "doc_id long, text string")
    plans = []
    own = ngram_join.written

    def spy(df, kind, *more):
        plans.append((kind, df._jdf.queryExecution().optimizedPlan().toString()))
        return own(df, kind, *more)

    monkeypatch.setattr(ngram_join, "written", spy)
    monkeypatch.setattr(ngram_join, "clusters_of", lambda e, real=ngram_join.clusters_of: plans.append(("edges", e._jdf.queryExecution().optimizedPlan().toString())) or real(e))
    got = ngram_join.similar_documents(docs, 4, "0.85").collect()
    assert {(r.component_id, r.n_links) for r in got} == {(0, 11)}
    edges = next(p for kind, p in plans if kind == "edges")
    assert "count(1) AS keys" in edges[edges.index("Generate"):]


def test_boundary_follows_cost():
    t = Fraction("0.85")
    assert ngram_join.boundary({10: 100, 400: 100}, t, 1.0) <= ngram_join.boundary({10: 100, 400: 100}, t, 50.0)


def test_pii_base_and_added(odd_documents, no_documents):
    trees = pii.fitted(odd_documents)
    got = {r.doc_id: r for r in pii.with_pii(odd_documents, trees, "doc_id").collect()}
    r = got[10]
    assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == (1, 1, 1, 1)
    assert r.redacted == "mail [email] or [phone], [ip], [card]"
    assert got[3].spans == "" and got[3].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert pii.with_pii(no_documents, pii.fitted(no_documents), "doc_id").count() == 0


@pytest.mark.parametrize("text, want", [
    ("a 999.1.1.1 b", []), ("4111111111111112", []), ("+12 34", []), ("x@y", []),
    ("a.b@c.d.e, 1.2.3.4.5", [("email", 0, 9), ("ip", 11, 18)]),
])
def test_pii_patterns(text, want):
    assert pii.base_spans(text) == want


@pytest.mark.parametrize("text, want", [
    ("write john at example.com", ("email", 6, 25)), ("john at example[dot]com", ("email", 0, 23)), ("JOHN (AT) EXAMPLE DOT COM", ("email", 0, 25)),
    ("go to j.doe at ex-a.co.uk. Thanks", ("email", 6, 25)), ("0 6 1 2 3 4 5 6 7 8", ("phone", 0, 19)),
    ("4.1.1.1.1.1.1.1.1.1.1.1.1.1.1.1", ("card", 0, 31)), ("call 06 12 34 5 67 8 9 now", ("phone", 5, 22)), ("10 . 0 . 0 . 1", ("ip", 0, 14)),
])
def test_pii_proposals(text, want):
    assert want in pii.proposals(text)


def test_every_trained_disguise_is_proposed():
    for i in range(40):
        for kind, own in [("email", f"jo.{'x' * i}b{i}@m{i}.co.uk"), ("ip", f"10.{i}.0.{i * 3}"), ("card", "4111 1111 1111 1111"[:17 + i % 3]), ("phone", f"+1 555 {100 + i} 4567"), ("phone", f"+49 {i + 10000} 123-4567")]:
            for text, span, label in pii.disguised(own, (kind, 0, len(own))):
                assert not label or span in pii.proposals(text), (text, span)


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _plain_base(text):
    out = []
    for k, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            luhn = sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0
            good = {"email": True, "ip": all(int(x) <= 255 for x in m.group().split(".")) if kind == "ip" else False, "card": 14 <= len(digits) <= 19 and luhn, "phone": 10 <= len(digits) <= 15}
            out += [(m.start(), k, m.end())] if good[kind] else []
    return [(list(PATTERNS)[k], s, e) for s, k, e in sorted(out)]


@given(st.text(alphabet="a1240.@@+-( )%_x", max_size=60) | st.text(alphabet="0123456789 .-+", max_size=80))
@settings(max_examples=400, deadline=None)
def test_pii_base_equals_plain_patterns(text):
    assert pii.base_spans(text) == _plain_base(text)


def test_pii_base_of_a_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    got = {r.doc_id: r for r in pii.with_pii(docs, pii.Trees(), "doc_id").collect()}
    for key, text in docs.collect():
        want = _plain_base(text or "")
        assert [got[key][f"n_{k}"] for k in pii.KINDS] == [sum(x[0] == k for x in want) for k in pii.KINDS]
        assert got[key].spans == ",".join(f"{k}:{s}:{e}" for k, s, e in want)
        assert got[key].base_sha256 == hashlib.sha256(got[key].spans.encode()).hexdigest()


@pytest.mark.parametrize("text", [
    "." + "7" * 400_000, "@" + "a" * 400_000, "a" * 400_000 + "@", "0" * 400_000 + ".1.2.3", "+1" + "(" * 400_000, "a dot " * 60_000 + "at b" + " dot c" * 60_000,
    "jo@ex.com, " * 20_000, "a@" * 200_000, "1." * 200_000,
], ids=str.__len__)
def test_pii_of_long_runs_is_linear(text):
    trees = pii.Trees()
    trees.trees = [tuple(np.array([v]) for v in (-1, 0.0, 0, 0, 1.0))]
    trees.thresholds = dict.fromkeys(pii.KINDS, 0.99)
    start = time.process_time()
    spans = pii.all_spans(text, pii.base_spans(text), trees)
    assert time.process_time() - start < 40 and all(s < e for _, s, e in spans)


def test_pii_fit_under_any_partitioning(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    one, seven = (pii.fitted(docs.repartition(n), most_rows=200) for n in (1, 7))
    assert one.thresholds == seven.thresholds
    assert all(np.array_equal(x, y) for a, b in zip(one.trees, seven.trees, strict=True) for x, y in zip(a, b))


def test_pii_fit_reads_every_document(spark, monkeypatch):
    docs = spark.range(0, 9000, numPartitions=4).selectExpr("id AS doc_id", "if(id % 2 = 0, concat('mail joe', id, '@example.com'), concat('room 12 34 ', id)) AS text")
    counts, own = {}, pii.written

    def spy(df, kind):
        got = own(df, kind)
        counts[kind] = got.count()
        return got

    monkeypatch.setattr(pii, "written", spy)
    pii.fitted(docs)
    assert counts["pii_fit"] >= 9000


@pytest.mark.parametrize("n", [30, 3000])
def test_pii_thresholds_are_the_lowest_of_wanted_precision(spark, n):
    rng = np.random.default_rng(n)
    x = rng.random((n, 1))
    y = (rng.random(n) < np.where(x[:, 0] > 0.6, 0.999, 0.7)).astype(float)
    trees = pii.Trees()
    trees.trees = [tuple(map(np.array, ([0, -1, -1], [k / 50, 0.0, 0.0], [1, 0, 0], [2, 0, 0], [0.0, -0.1, 0.1]))) for k in range(50)]
    trees.calibrate(spark.createDataFrame([("card", float(b), a.tolist()) for a, b in zip(x, y)], "kind string, label double, x array<double>"))
    p, want = trees.probability(x), 2.0
    for least in np.unique(p[p > 0.5]):
        some = p >= least
        if ((y[some].sum() + 1) / (some.sum() + 1) if n < 50 else y[some].mean()) >= pii.PRECISION:
            want = min(want, float(least))
    assert want < 1 and trees.thresholds == dict.fromkeys(pii.KINDS, 2.0) | {"card": want}


def test_lm_base_and_tree(odd_documents, no_documents):
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 10 == 0, F.lit(True))
    docs = odd_documents.select("doc_id", "text", held.alias("held_out"), F.lit(1).cast("long").alias("block"))
    rows = docs.collect()
    count = Counter()
    for r in rows:
        if not r.held_out:
            count.update((r.text or "").encode().lower().split())
            count[None] += 1
    n, v = sum(count.values()), len(count)
    want = sorted((r.doc_id or -1, sum(math.log10((count[w] + 0.1) / (n + 0.1 * (v + 1))) for w in [*(r.text or "").encode().lower().split(), None])) for r in rows)
    got = lm_ctw.scored(docs).collect()
    assert np.allclose(sorted((r.doc_id or -1, r.base_score) for r in got), want, rtol=1e-9)
    assert all(r.train_tokens == n and r.score < 0 for r in got)
    again = lm_ctw.scored(docs.withColumn("block", F.coalesce(F.col("doc_id") % 3, F.lit(7)))).collect()
    close = lambda rs: sorted((r.doc_id or -1, round(r.score, 2)) for r in rs)
    assert [k for k, _ in close(again)] == [k for k, _ in close(got)]
    assert np.allclose([s for _, s in close(again)], [s for _, s in close(got)], rtol=1e-5, atol=0.02)
    assert lm_ctw.scored(no_documents.select("doc_id", "text", F.lit(False).alias("held_out"), F.lit(1).cast("long").alias("block"))).count() == 0


def _ctw(train: list[bytes], depth: int):
    """Plain recursive context-tree weighting: probability of a byte after a context."""
    counts: dict = {}
    for t in train:
        s = b"\xff" * depth + t + b"\xff"
        for i in range(depth, len(s)):
            for level in range(8):
                node, bit = (1 << level) | (s[i] >> (8 - level)), s[i] >> (7 - level) & 1
                for d in range(depth + 1):
                    counts.setdefault((node, s[i - d:i]), [0, 0])[bit] += 1
    kt = lambda a, b: math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    def weighted(node, ctx):
        own = kt(*counts[node, ctx])
        if len(ctx) == depth:
            return own, None
        below = sum(weighted(node, bytes([c]) + ctx)[0] for c in range(256) if (node, bytes([c]) + ctx) in counts)
        return np.logaddexp(own, below) - math.log(2), math.exp(min(700, own - below))

    def prob(node, bit, ctx, d):
        a = counts.get((node, ctx[len(ctx) - d:]), [0, 0])
        own = (a[bit] + 0.5) / (sum(a) + 1)
        if d == depth or (node, ctx[len(ctx) - d - 1:]) not in counts:
            return own
        odds = weighted(node, ctx[len(ctx) - d:])[1]
        return (odds * own + prob(node, bit, ctx, d + 1)) / (odds + 1)

    return lambda ctx, byte: sum(math.log10(prob((1 << k) | (byte >> (8 - k)), byte >> (7 - k) & 1, ctx, 0)) for k in range(8))


def test_lm_equals_plain_weighting(spark):
    texts = [(1, "abracadabra", False), (2, "abra cad", False), (3, "cadabra zz", True)]
    docs = spark.createDataFrame(texts, "doc_id long, text string, held_out boolean").withColumn("block", F.lit(1).cast("long"))
    p = _ctw([t.encode() for _, t, h in texts if not h], 3)
    got = {r.doc_id: r.score for r in lm_ctw.scored(docs, 3).collect()}
    for key, text, _ in texts:
        s = b"\xff" * 3 + text.encode() + b"\xff"
        assert got[key] == pytest.approx(sum(p(s[i - 3:i], s[i]) for i in range(3, len(s))), rel=1e-5)


def test_language_of_held_out_rows(spark, sf, odd_documents, no_documents):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    got = language_id.with_language(docs, language_id.fitted(docs, ~held), "doc_id", "lang").where(held).toPandas()
    assert (got.lang == got.lang_pred).mean() >= 0.95
    odd = language_id.with_language(odd_documents, language_id.fitted(odd_documents, F.lit(True)), "doc_id").toPandas()
    assert set(odd[odd.doc_id.isin([3, 4, 5, 8])].lang_pred) == {"und"} and odd.score.between(0, 1).all()
    assert language_id.with_language(no_documents, language_id.fitted(no_documents, F.lit(True)), "doc_id").count() == 0


def test_rare_language_is_a_label(spark):
    docs = spark.range(3000).selectExpr("id AS doc_id", "concat('the house and garden number ', id) AS text", "'en' AS lang")
    docs = docs.unionByName(spark.createDataFrame([(9001, "das haus und der garten", "de")] * 5, docs.schema))
    field = language_id.fitted(docs, F.lit(True), most=40)
    assert field.labels == ["de", "en"] and field.predict(pa.array(["das haus und der garten"]))[0] == ["de"]


def test_pipeline_holds_little_text_at_a_time(spark, odd_documents, monkeypatch):
    import corpus_pipeline
    from tidewatch.llm import packing

    field = language_id.fitted(odd_documents, F.lit(True))
    rows = [sorted(map(str, language_id.with_language(odd_documents, field, "doc_id", lean=x).collect())) for x in (False, True)]
    assert rows[0] == rows[1]
    seen = []
    plain, packed = language_id.with_language, packing.packed_documents
    monkeypatch.setattr(language_id, "with_language", lambda *a, **b: seen.append(b) or plain(*a, **b))
    monkeypatch.setattr(packing, "packed_documents", lambda *a, **b: seen.append(b) or packed(*a, **b))
    corpus_pipeline.language(spark, odd_documents, "")
    corpus_pipeline.pack(spark, odd_documents, "")
    assert seen == [{"lean": True}, {"most": 2 << 20}]


def test_pipeline_workers_keep_little_after_a_task(spark, monkeypatch):
    from types import SimpleNamespace

    import public_tokenizers
    from tidewatch.llm import packing
    from tidewatch.llm.tokens import WordIds, loaded

    class Frame:
        select = lambda self, *a: self

        def mapInArrow(self, run, schema):
            self.run = run

    path, frame, rows = public_tokenizers.path("word_bpe_49k.json"), Frame(), []
    monkeypatch.setattr(packing, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    batch = pa.RecordBatch.from_pydict({"doc_id": [1, 2, 3], "text": ["some words to remember", None, "words again"]})
    for most, kept in ((packing.TAKE_BYTES, 5), (packing.TAKE_BYTES // 4, 0)):
        loaded(WordIds, path).forget()
        packing.pieces_of(frame, path, most=most)
        rows.append([x.to_pylist() for x in frame.run([batch])])
        assert len(loaded(WordIds, path).words) == kept
    assert rows[0] == rows[1] and sum(map(len, rows[0])) == 3


def test_sets_of_a_block_are_made_a_few_texts_at_a_time(monkeypatch):
    batch = pa.RecordBatch.from_pydict({"text": [f"a b c d{i % 3} e{i % 50}" for i in range(200)]})
    want = [x.to_pylist() for x in ngram_join._recurring(2)([batch])]
    sizes, plain = [], ngram_join.gram_sets
    monkeypatch.setattr(ngram_join, "gram_sets", lambda texts, words: sizes.append(len(texts)) or plain(texts, words))
    monkeypatch.setattr(ngram_join, "SET_BYTES", 100)
    assert [x.to_pylist() for x in ngram_join._recurring(2)([batch])] == want and want[0]
    assert max(sizes) <= 20 and sum(sizes) == 150  # the distinct ones of the whole block


def test_language_of_text_without_blanks():
    rows = [("en", "the house and the garden with that thing which they have".split())] * 20 + [("de", "das haus und der garten mit dem ding welches sie haben".split())] * 20
    field = language_id.fit(rows)
    title, body = "thehouseandthegardenwiththatthingwhichtheyhavethehouseand", "dashausunddergartenmitdemdingwelchessiehaben" * 60
    lang, score = field.predict(pa.array([title + body, title, title + " " + body + "and", "", "x" + "1" * 200]))
    assert lang[:4] == ["de", "en", "de", "und"] and lang[4] != "und" and score[0] > 0.9
    codes, words, off = language_id.positions(pa.array(["a " + body + " b", "c"]))
    assert "".join(words[k] for k in codes) == "a" + body + "bc" and off[2] - off[1] == 1 and max(map(len, words)) <= language_id.LETTERS


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(1)
    emit, trans, init = rng.normal(size=(4, 2)), rng.normal(size=(2, 2)), rng.normal(size=2)
    got = language_id.forward_backward(emit, np.array([0, 4]), trans, init)
    want = np.zeros((4, 2))
    for path in np.ndindex(2, 2, 2, 2):
        w = np.exp(init[path[0]] + sum(emit[t, y] for t, y in enumerate(path)) + sum(trans[a, b] for a, b in zip(path, path[1:])))
        for t, y in enumerate(path):
            want[t, y] += w
    assert np.allclose(got, want / want.sum(axis=1, keepdims=True))


def test_reparameterised_questions(spark, odd_documents, no_documents):
    items = spark.createDataFrame([(1, "If tom buys 12 apples and tom sells 5 kg of the apples to Anna how many are left"), (2, None), (3, "short one")], "item_id long, text string")
    stem = "If tom buys {} apples and tom sells {} kg of the apples to {} how many are left"
    rows = [
        (50, "Intro words. " + stem.format(12, 5, "Anna") + " indeed"), (51, stem.format(30, 7, "Bella")), (52, stem.format(30, 30, "Bella")),
        (53, "an unrelated text about apples that anna sells to tom"),
    ]
    docs = odd_documents.unionByName(spark.createDataFrame(rows, "doc_id long, text string"), allowMissingColumns=True)
    got = {r.doc_id: r for r in decontaminate.contaminated(docs, items).collect()}
    assert set(got) == {50, 51} and got[50].verbatim and not got[51].verbatim
    assert decontaminate.contaminated(no_documents, items).count() == 0
    assert decontaminate.contaminated(docs, items.limit(0)).count() == 0


def test_near_copies_outlast_one_contradiction(spark):
    words = "the bridge over the wide grey river was opened in {} by a mayor who had waited long for the day and left the town for good again in {}"
    far = " and so the people of the valley told their children for many years to come until nobody knew it any more" * 2
    items = spark.createDataFrame([(1, words.format(1990, 1990)), (2, words.format(1990, 7) + far), (3, "If tom buys 12 apples and sells 5 kg today")], "item_id long, text string")
    rows = [
        (1, words.format(1990, 1991)), (2, words.format(30, 30) + far), (3, "If tom buys 30 apples and sells 30 kg today"),
        (4, words.format(1990, 1990)),
    ]
    got = {(r.doc_id, r.item_id): r for r in decontaminate.contaminated(spark.createDataFrame(rows, "doc_id long, text string"), items).collect()}
    assert not got[1, 1].verbatim and got[4, 1].verbatim and got[1, 1].n_windows == got[4, 1].n_windows == 23
    assert (2, 2) in got and (3, 3) not in got  # verbatim windows stand; near slots that contradict each other still fall


def test_verbatim_copies_whatever_the_marks(spark):
    items = [
        (1, "What is the capital of France"), (2, "Name the author of the play Hamlet please"), (3, "Who wrote Moby Dick"), (4, "What is 2 plus 2"),
        (5, "Yes"), (6, "1 2 3 5 8 13 21 34 55"), (7, ""), (8, "two words"), (9, "the tall man went over the long bridge at noon with Anna"),
    ]
    rows = [
        (1, "he was asked, What is the capital of France yesterday"), (2, "so Name the author of the play Hamlet please"), (3, "who wrote Moby Dick?"),
        (4, "What is 2 plus 2"), (5, "yes"), (6, "add 1, 2, 3, 5, 8, 13, 21, 34 and go"), (7, ""), (8, "only two words here"),
        (9, "THE TALL MAN WENT OVER THE LONG BRIDGE AT NOON WITH ANNA"), (10, "what is the capital of"), (11, "we wrote Moby Dick"),
        (12, "Yes yes"), (13, "- Two words!"), (14, None), (15, "Tell me: what is 2 plus 2 now"),
    ]
    got = decontaminate.contaminated(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    want = {(1, 1), (2, 2), (3, 3), (4, 4), (5, 5), (6, 6), (9, 9), (13, 8), (15, 4)}
    assert {(r.doc_id, r.item_id): r.verbatim for r in got.collect()} == dict.fromkeys(want, True)


def test_windows_are_hashed_in_generated_code(spark):
    texts = ["", "one", "Take 12 apples", "we ask Anna for 3 kg of flour", "then Bob gives Carl 12 coins and 7.5 kg of rice, then Dora 9 more"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("t64", F.xxhash64("text"))
    sizes = [1, 3, 5, 8]
    got = decontaminate.document_windows(rows, sizes)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "transform(sequence(" not in plan and plan.count("transform(") == 2  # the hashes of single tokens
    m = rows.select("doc_id", decontaminate.marked(F.col("text")).alias("m"))
    m = m.select("doc_id", *[decontaminate._hashes(F.split(f(F.col("m")), " ")).alias(c) for c, f in (("th", decontaminate.template), ("ph", decontaminate.plain))])
    want = {(r.doc_id, w.at, w.size, h) for size in sizes for r in m.select("doc_id", decontaminate._windows(F.col("th"), F.col("ph"), F.lit(size)).alias("w")).collect() for w in r.w or [] for h in (w.t, w.p)}
    assert {(r.doc_id, r.p, r.size, r.h) for r in got.where("h is not null").collect()} == want
    assert len({w[2] for w in want}) == 4


def test_quotes(spark):
    rows = [
        (1, 0, "user", "Where is the red house?\nI look for it."), (1, 1, "assistant", "> where is the RED house\n\nOn the hill."),
        (1, 2, "user", "Joe wrote:\n> > Where is the red house?\n> On the hill.\nThanks"), (1, 3, "user", "> I look for it\nMe too"),
        (2, 0, "user", "> On the hill.\nWhich hill?"), (2, 1, "assistant", None), (None, 0, "user", "> x"), (2, 0, "user", "> On the hill.\nWhich hill?"),
    ]
    got = quotes.linked(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert len(got) == len(rows)
    by = {(r.conv_id, r.turn): r for r in got}
    assert by[1, 1].own_text == "On the hill." and by[1, 1].reply_to == 0 and by[1, 1].n_linked == 1
    assert by[1, 2].levels == 2 and by[1, 2].own_text == "Thanks" and by[1, 2].reply_to == 1 and by[1, 2].n_linked == 2
    assert by[1, 3].reply_to == 0 and (by[2, 0].from_conv, by[2, 0].from_turn, by[2, 0].reply_to) == (1, 1, None)
    assert by[2, 1].own_text == "" and by[None, 0].reply_to is None


MESSAGES = "conv_id long, turn long, role string, text string"


def test_quotes_wrapped_anew_and_trimmed(spark):
    said = "We should move the whole archive to the new disks before the end of the month."
    rows = [
        (1, 0, "user", said), (1, 1, "assistant", "ok"), (1, 2, "user", "> We should move the\n> whole archive to the new\n>\n> disks before the end of the month.\nWhen?"),
        (1, 3, "assistant", "> move the whole archive to the new disks\nToday."), (1, 4, "user", "> ok\nFine."), (3, 0, "user", "> ok\nNot mine."),
        (4, 0, "user", "> the end of the month\nWhich month?"), (4, 1, "user", "It is the end of the month"), (5, 0, "user", "> quite another thing that nobody has said here\nHm."),
    ]
    by = {(r.conv_id, r.turn): r for r in quotes.linked(spark.createDataFrame(rows, MESSAGES)).collect()}
    assert (by[1, 2].n_quoted, by[1, 2].n_linked, by[1, 2].reply_to) == (1, 1, 0) and by[1, 3].reply_to == 0 and by[1, 4].reply_to == 1
    assert by[3, 0].n_linked == 0 and by[3, 0].from_conv is None  # so short a passage is no link to a stranger
    assert (by[4, 0].from_conv, by[4, 0].from_turn) == (1, 0)  # the own conversation has it only later
    assert by[5, 0].n_quoted == 1 and by[5, 0].n_linked == 0
    assert [(by[1, t].thread, by[1, t].depth) for t in range(5)] == [(0, 0), (0, 1), (0, 1), (0, 1), (0, 2)]


def test_quotes_of_odd_tables(spark):
    empty = spark.createDataFrame([], MESSAGES)
    assert quotes.linked(empty).count() == 0
    own = "\n".join(f"line {i} says word{i * 7 % 1000}" for i in range(20_000))
    rows = [(1, 0, "user", own), (1, 1, "user", "> " + own.replace("\n", "\n> ")), (None, 2, "user", None), (2, None, "user", "> a"), (7, 5, None, "x"), (7, 5, None, "> x")]
    rows += [(9, t, "user", f"turn {t}") for t in range(40)]
    clash = spark.createDataFrame(rows, MESSAGES).selectExpr("*", "1 AS key", "2 AS thread", "text AS ls", "3 AS level", "4 AS orig")
    got = quotes.linked(clash).collect()
    by = {(r.conv_id, r.turn): r for r in got}
    assert len(got) == len(rows) and (by[1, 1].n_linked, by[1, 1].reply_to, by[1, 1].own_text) == (1, 0, "")
    assert by[9, 39].depth == 39 and by[9, 39].thread == 0 and by[None, 2].depth is None and by[7, 5].depth == 0


def test_quotes_equal_sql_on_quoting_messages(spark):
    """The tables given hold no quotes, so the twin is compared on made-up conversations, too."""
    rng = random.Random(7)
    words = "we you move the old new disks house before after month day ok thanks red hill go now why".split()
    rows = []
    for conv in range(60):
        for turn in range(rng.randint(1, 8)):
            lines = [" ".join(rng.choices(words, k=rng.randint(1, 9))) for _ in range(rng.randint(0, 4))]
            for _ in range(rng.randint(0, 2) if rows else 0):
                said = (rng.choice(rows)[3] or "").replace("\n", " ").split()
                s = rng.randint(0, len(said))
                quote, size = said[s:s + rng.randint(2, 30)], rng.randint(2, 6)
                level = rng.choice(["> ", ">> ", "> > "])
                lines[:0] = [*rng.choice([[], ["Joe wrote:"]]), *(level + " ".join(quote[i:i + size]).upper() for i in range(0, len(quote), size)), *rng.choice([[], ["", ">"]])]
            rows.append((conv, turn, rng.choice(["user", None]), rng.choice([None, "\n".join(lines)]) if turn % 5 == 4 else "\n".join(lines)))
    rows += [(3, 0, "user", "ok\n> go now why"), (None, 1, "user", "> a"), (5, None, None, "red hill")]
    got = quotes.linked(spark.createDataFrame(rows, MESSAGES))
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    want = Counter(con.execute(f"SELECT {', '.join(got.columns)} FROM ({quotes.ORACLE})").fetchall())
    have = Counter(tuple(r) for r in got.collect())
    assert have == want and sum(r[6] for r in have) > 40 and any(r[8] not in (None, r[0]) for r in have) and any(r[5] > r[6] for r in have)
