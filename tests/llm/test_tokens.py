"""Operators 2, 3 and 10 against the tokenizer libraries."""

import random
import zlib

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidewatch.llm import id_store, packing, token_count
from tidewatch.llm.tokens import PieceIds, WordIds

WORDS, PIECES = P.path("word_bpe_49k.json"), P.path("piece_bpe_32k.model")
ALPHABET = "\u2581aàéßñABC019 .,'’\n\t  ́İΣς中文😀<|endoftext|>\x00\x85\xa0ªº²½'s're  don't"


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 60))) for _ in range(500)] + ["<|endoftext|>a", "</s> <s>", "  ", " a ", "ab" * 3000, "\u2581", "a\u2581\u2581b \u2581c" * 40]


def test_memo_equals_the_libraries(texts):
    words, pieces = WordIds(WORDS), PieceIds(PIECES)
    ids, off = words.encode(pa.array(texts))
    for i, t in enumerate(texts):
        assert ids[off[i]:off[i + 1]].tolist() == words.tok.encode(t, add_special_tokens=False).ids
    assert pieces.count(pa.array(texts)).tolist() == [len(pieces.plain.encode(t)) for t in texts]


@pytest.mark.parametrize("chunk, overlap", [(20, 4), (50, 8), (300, 32)])
def test_spliced_chunks_equal_the_whole(texts, chunk, overlap):
    tok = PieceIds(PIECES)
    for t in filter(None, texts):
        assert token_count.spliced_ids(tok, t, chunk, overlap).tolist() == tok.plain.encode(t)


def test_counts_of_odd_rows(odd_documents, no_documents):
    tok = PieceIds(PIECES)
    got = token_count.with_token_counts(odd_documents, PIECES).collect()
    want = sorted((r.doc_id or -1, len((r.text or "").encode()), len(tok.plain.encode(r.text or ""))) for r in odd_documents.collect())
    assert sorted((r.doc_id or -1, r.n_bytes, r.n_tokens) for r in got) == want
    assert all(r.over_limit == (r.n_tokens > 4096) for r in got)
    assert token_count.with_token_counts(no_documents, PIECES).count() == 0


def test_store_round_trip(spark, odd_documents, no_documents, tmp_path):
    n = id_store.write_store(odd_documents, f"{tmp_path}/s", WORDS, shard_ids=20_000, bucket_keys=4)
    got = sorted(id_store.read_all(spark, f"{tmp_path}/s", n).collect(), key=lambda r: r.start)
    tok = WordIds(WORDS).tok
    rows = sorted(((r.doc_id is not None, r.doc_id, r.text or "") for r in odd_documents.collect()), key=lambda x: (x[0], x[1] or 0, x[2]))
    start = 0
    assert len(got) == len(rows)
    for r, (_, key, text) in zip(got, rows):
        ids = [*tok.encode(text, add_special_tokens=False).ids, 2]
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (key, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    absent = spark.createDataFrame([(10**9, 0)], "key long, copy long")
    assert id_store.lookup(spark, f"{tmp_path}/s/index", absent, n).count() == 0
    n = id_store.write_store(no_documents, f"{tmp_path}/e", WORDS)
    assert id_store.read_all(spark, f"{tmp_path}/e", n).count() == 0


@pytest.mark.parametrize("apart", [3, 10**6])
def test_store_keeps_keys_of_equal_hash(spark, odd_documents, tmp_path, monkeypatch, apart):
    """Keys that differ in less than ``apart`` get one hash; 10**6 leaves no key for the perfect hash."""
    hashed = id_store.key_hash
    monkeypatch.setattr(id_store, "key_hash", lambda k, c, z: hashed(np.asarray(k) // apart, np.zeros(len(k), int), np.zeros(len(k), bool)))
    n = id_store.write_store(odd_documents, f"{tmp_path}/s", WORDS, bucket_keys=4)
    got = sorted(id_store.read_all(spark, f"{tmp_path}/s", n).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted((r.doc_id for r in odd_documents.collect()), key=lambda k: k or 0)
    assert [r.start for r in got[1:]] == np.cumsum([r.n_tokens for r in got])[:-1].tolist()
    assert sum(len(r.shared) for r in spark.read.parquet(f"{tmp_path}/s/index").collect()) >= 8 * id_store.SHARED.itemsize
    absent = spark.createDataFrame([(2, 7)], "key long, copy long")
    assert apart == 3 or id_store.lookup(spark, f"{tmp_path}/s/index", absent, n).count() == 0


def test_perfect_hash_is_minimal():
    h = id_store.key_hash(np.arange(5000), np.zeros(5000, int), np.zeros(5000, bool))
    salt, seeds, slots = id_store.perfect_hash(h)
    assert sorted(slots) == list(range(5000))
    assert (id_store.slot_of(h, 5000, salt, seeds) == slots).all()


def test_packing(odd_documents, no_documents, spark, sf):
    for docs in (odd_documents, spark.read.parquet(f"{sf}/documents.parquet")):
        got = packing.packed_documents(docs, WORDS).toPandas()
        assert len(got) == docs.count() + (got.piece > 0).sum()
        got = got.sort_values(["sequence_id", "offset"])
        assert (got.groupby("sequence_id").length.cumsum() - got.length == got.offset).all()
        assert got.groupby("sequence_id").length.sum().max() <= 4096
        assert got.sequence_id.nunique() <= -(-got.length.sum() // 4096) + 1
        assert got[got.piece > 0].start.mod(4096).eq(0).all()
    assert packing.packed_documents(no_documents, WORDS).count() == 0


def test_packing_over_levels(spark):
    rows = spark.range(3000).select(F.col("id").alias("uid"), (F.col("id") % 700 + 1).alias("length"))
    got = packing.pack(rows, 1000, 400).join(rows, "uid").toPandas()
    assert len(got) == 3000 and got.groupby("sequence_id").length.sum().max() <= 1000
    assert got.sequence_id.nunique() <= -(-got.length.sum() // 1000) * 1.02


def test_packing_takes_every_genetic_step(monkeypatch):
    """Crossover runs as often whether or not the first packings meet the bound, and never makes a packing worse."""
    made, plain = [], packing.crossover
    monkeypatch.setattr(packing, "crossover", lambda *a: made.append(1) or plain(*a))
    rng = np.random.default_rng(7)
    for lens in (np.sort(rng.integers(1, 100, 400))[::-1], np.repeat([34, 33, 33], 50), np.array([70])):
        first = [packing.first_packing(lens, 100, rng, x) for x in (0.0, 0.05, 0.05)]
        before = len(made)
        packings = packing._evolved(first, lens, 100, rng)
        assert len(made) - before == packing.CHILDREN == len(packings) - len(first)
        for p in packings:
            assert len(p) == len(lens) and np.bincount(p, weights=lens).max() <= 100


def test_genetic_steps_reach_fewer_sequences_than_best_fit():
    """Two or three tight pieces a sequence: best-fit from the longest misses the bound."""
    rng = np.random.default_rng(2)
    lens = np.sort(rng.integers(260, 420, 300))[::-1]
    packings = [packing.first_packing(lens, 1000, rng, x) for x in (0.0, 0.05, 0.05)]
    first = int(packings[0].max()) + 1
    for _ in range(12):
        packings = sorted(packing._evolved(packings, lens, 1000, rng), key=lambda p: packing.fitness(p, lens, 1000))[-3:]
    assert int(packings[-1].max()) + 1 < first


@pytest.mark.parametrize(("lengths", "capacity", "sequences"), [
    ("600", 1000, 3000),  # no two pieces go together
    ("if(id % 3 = 0, 1, 601)", 1000, 2000),
    ("1", 1000, 3),  # one sequence holds more pieces than a shard
])
def test_packing_again_does_not_stop_where_most_is_ill_filled(spark, lengths, capacity, sequences):
    rows = spark.range(3000).select(F.col("id").alias("uid"), F.expr(lengths).cast("long").alias("length"))
    got = packing.pack(rows, capacity, 400).join(rows, "uid").toPandas()
    assert len(got) == 3000 == got.uid.nunique() and got.groupby("sequence_id").length.sum().max() <= capacity
    assert got.sequence_id.nunique() == sequences


def test_word_ids_equal_the_library_for_every_simple_letter():
    tok = WordIds(P.path("word_bpe_49k.json"))
    letters = [chr(c) for c in range(0x21, 0x250) if not chr(c).isspace()]
    words = [w for c in letters for w in (c, f"x{c}", f"{c}.", f"a{c}b!", f"Ab{c}'s,")]
    words += ["<|endoftext|>", "a<|endoftext|>.", "é.", "x" * 200 + ".", "é" * 90 + ",", "中文.", "a\x00b", "\x1f."]
    words = [w for w in words if not set(w) & set(" \t\n\v\f\r")]
    ids, off = tok.encode(pa.array(words))
    want = [tok.tok.encode(w, add_special_tokens=False).ids for w in words]
    assert [ids[s:e].tolist() for s, e in zip(off, off[1:])] == want
