"""Collocations against a plain count of everything."""

import random
import re
from collections import Counter

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tidewatch.llm import collocations as C


def brute(rows, most, least, longest=5):
    f, n = Counter(), Counter()
    for r in rows:
        lang, text = r.lang or "und", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r.text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            f.update((lang, *w[i:i + m]) for m in range(1, longest + 1) for i in range(len(w) - m + 1))
    cand = {p: a for p, a in f.items() if len(p) > 2 and a >= least}
    inside = Counter()
    for p, a in cand.items():
        for i in range(1, len(p)):
            for j in range(i + 1, len(p) + 1):
                if j - i < len(p) - 1:
                    q = (p[0], *p[i:j])
                    inside[q] = max(inside[q], a)
    out = {}
    for p, a in cand.items():
        if inside[p] < a:
            lang, w = p[0], p[1:]
            cuts = [(1000 * a * n[lang] // (f[lang, *w[:k]] * f[lang, *w[k:]]), k, f[lang, *w[:k]], f[lang, *w[k:]]) for k in range(1, len(w))]
            score, _, l, r = min(cuts)
            out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), l, r))
    return sorted((lang, k, p.decode(), -a, l, r, n[lang], -s) for lang, v in out.items() for k, (s, a, p, l, r) in enumerate(sorted(v)[:most], 1))


def corpus(spark, docs=120):
    rng = random.Random(5)
    vocab = [f"{c}{i}" for i in range(12) for c in "aßZ"]
    passage = "Alpha beta gamma delta epsilon zeta eta"
    rows = []
    for d in range(docs):
        parts = [rng.choice(vocab[:rng.choice([4, 12, 36])]) + rng.choice([" ", " ", " ", "\t", ", ", ".\n", "!"]) for _ in range(rng.randrange(60))]
        for _ in range(rng.randrange(3)):
            parts.insert(rng.randrange(len(parts) + 1), f" {passage} ")
        rows.append((rng.choice(["en", "en", "en", "de", None]), "".join(parts) if rng.random() > 0.03 else None))
    return spark.createDataFrame(rows, "lang string, text string")


@pytest.mark.parametrize("most, share, bits", [(1000, 8, 1 << 16), (3, 30, 64), (40, 2, 1 << 20)])
def test_against_all_counts(spark, most, share, bits):
    docs = corpus(spark).repartition(3).cache()
    got = C.collocations(docs, most=most, least=6, first_share=share, bits=bits)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(tuple(r) for r in got.collect()) == brute(docs.collect(), most, 6)


def test_ties_and_overlaps(spark):
    docs = spark.createDataFrame([("x", "a a a a a b a b. c d. c d. d c. d c"), ("x", "c\td"), ("x", "a b a b")], "lang string, text string")
    for most in (2, 50):
        assert sorted(tuple(r) for r in C.collocations(docs, most=most, least=2).collect()) == brute(docs.collect(), most, 2)


def test_branches_are_settled_without_being_counted(spark, monkeypatch):
    """With a floor from the first wave, frequent first words are never grown."""
    rows = [("en", f"rare{i} pair{i} . the of and the of and to") for i in range(30) for _ in range(4)]
    docs = spark.createDataFrame(rows, "lang string, text string")
    waves, grown = [], C._grown
    monkeypatch.setattr(C, "_grown", lambda t, w, wave, *a: waves.append({r.phrase for r in wave.collect()}) or grown(t, w, wave, *a))
    got = C.collocations(docs, most=5, least=4, first_share=8)
    assert sorted(tuple(r) for r in got.collect()) == brute(docs.collect(), 5, 4)
    assert not set().union(*waves) & {"the", "of", "and", "to"}


def test_odd_and_empty_tables(spark, odd_documents, no_documents):
    assert C.collocations(no_documents).count() == 0
    docs = odd_documents.withColumns({"phrase": F.lit("x"), "h": F.lit(1), "a": F.lit(2)})
    assert sorted(tuple(r) for r in C.collocations(docs, least=2).collect()) == brute(docs.collect(), 2000, 2)


def test_exact_beyond_64_bits(spark):
    found = spark.createDataFrame([("x", 2, "p q", 0, 3 * 10**9, False)], "lang string, words int, phrase string, h long, a long, bound boolean")
    counts = spark.createDataFrame([("x", "p", 5 * 10**9 + 1), ("x", "q", 7 * 10**9 + 3)], "lang string, phrase string, a long")
    totals = spark.createDataFrame([("x", 10**13 + 7)], "lang string, n long")
    r = C._scored(found, counts, totals, 5).first()
    assert r.score == 1000 * 3 * 10**9 * (10**13 + 7) // ((5 * 10**9 + 1) * (7 * 10**9 + 3))


def test_blocks_are_written_and_read_a_few_at_a_time(spark, monkeypatch):
    monkeypatch.setattr(C, "small_batches", lambda batches, col: (b.slice(i, 1) for b in batches for i in range(b.num_rows)))
    monkeypatch.setattr(C, "GROUP_BYTES", 1 << 16)
    texts = spark.range(30).coalesce(1).selectExpr("'en' AS lang", "concat_ws(' ', transform(sequence(1, 5000), i -> hash(i, id))) AS text")
    key = "spark.sql.parquet.enableNestedColumnVectorizedReader"
    before = spark.conf.get(key)
    blocks = C.encoded(texts)
    files = [pq.ParquetFile(f.split("file:")[-1]) for f in blocks.inputFiles()]
    assert sum(f.metadata.num_rows for f in files) == 30
    assert max(f.metadata.row_group(g).num_rows for f in files for g in range(f.num_row_groups)) <= 5
    with C.block_by_block(spark):
        assert spark.conf.get(key) == "false"
    assert spark.conf.get(key) == before
