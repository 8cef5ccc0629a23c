"""Language-model scoring by context-tree weighting over bytes (operator 6).

Each byte is eight binary decisions.  A decision's node is its bit prefix; each node has a tree of
byte contexts of depth 0 to ``DEPTH`` (most recent byte first).  Every context holds the counts of
zeros and ones seen in training, the Krichevsky-Trofimov (KT) probability of them, and the weighted
probability ``1/2 KT + 1/2 product of the children's weighted probabilities``.  Scoring uses the
trained tree as it stands: the KT estimates of all depths on the path are mixed by their posterior
weights.  A context that training never saw adds nothing; its parent's estimate stands.  A text ends
with the byte 0xFF, which UTF-8 never holds, and is preceded by it.

How it runs: a block is some neighbouring rows of the input.  Each block sends its distinct
(context, byte) grams with their training counts to slices, dealt by the two most recent context
bytes; hot grams meet there once per block, not once per occurrence.  A slice holds whole subtrees
below depth 2, so it weights them alone; the at most 256 x 255 nodes of depth 1 are summed in Spark
and their weights go to all tasks (bounded by that number, 1 MB).  Each slice then answers each
block's grams with log-probabilities, and the texts meet the answers by block.  Words of the
unigram base travel the same way.  Nothing grows in the driver.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm.common import mix64, small_batches, split_words, table, texts_of, written

DEPTH = 4  # context bytes
BLOCK_ROWS = 2048
SLICE_ROWS = 4096  # documents a slice, for the number of slices
TAKE = 4 << 20  # text bytes handled at a time
EDGE = 0xFF

ASKED = "kind int, slice int, block long, keys binary, train binary"
ANSWER = "kind int, block long, keys binary, vals binary"


def grams(texts: pa.Array, depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray]:
    """(gram of every byte and end of the texts, offset of each text); a gram is (c1, ..., c_depth, byte)."""
    raw = [t.encode() for t in texts.to_pylist()]
    pad = bytes([EDGE]) * depth
    buf = np.frombuffer(b"".join(x for t in raw for x in (pad, t, pad[:1])), np.uint8)
    n = np.fromiter(map(len, raw), np.int64, len(raw)) + 1
    off = np.concatenate([[0], np.cumsum(n)])
    valid = np.repeat(np.arange(1, len(raw) + 1) * depth, n) + np.arange(off[-1])
    key = buf[valid].astype(np.uint64)
    for k in range(1, depth + 1):
        key |= buf[valid - k].astype(np.uint64) << np.uint64(8 * (depth - k + 1))
    return key, off


def packed(key: np.ndarray, depth: int) -> bytes:
    """Sorted grams byte plane by byte plane: the high planes are runs that shuffle files compress."""
    return np.ascontiguousarray(key.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :depth + 1].T).tobytes()


def unpacked(raw: bytes, depth: int) -> np.ndarray:
    planes = np.frombuffer(raw, np.uint8).reshape(depth + 1, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :depth + 1] = planes.T
    return out.view("<u8").ravel()


def lgamma(x: np.ndarray) -> np.ndarray:
    """log Gamma of positive numbers: Stirling's series at x + 8."""
    y = x + 8.0
    out = (y - 0.5) * np.log(y) - y + 0.9189385332046727 + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5)
    prod = np.ones_like(y)
    for k in range(8):
        prod *= x + k
    return out - np.log(prod)


def log_kt(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return lgamma(a + 0.5) + lgamma(b + 0.5) - lgamma(a + b + 1.0) - np.log(np.pi)


def _weights(lkt: np.ndarray, below: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(log weighted probability, posterior odds of the node's own KT against its children)."""
    return np.logaddexp(lkt, below) - np.log(2.0), np.exp(np.clip(lkt - below, -700, 700))


class Subtrees:
    """Contexts of depth 2 and more for sorted distinct grams and their training counts."""

    def __init__(self, key: np.ndarray, count: np.ndarray, depth: int = DEPTH):
        byte = (key & np.uint64(0xFF)).astype(np.int64)
        ctx = key >> np.uint64(8)
        level = np.arange(8)[:, None]
        self.prefix = (1 << level) | (byte[None, :] >> (8 - level))  # (8, grams): node of each decision
        self.bit = (byte[None, :] >> (7 - level)) & 1
        at = (ctx[None, :].astype(np.uint64) << np.uint64(8)) | self.prefix.astype(np.uint64)
        node, inv = np.unique(at.ravel(), return_inverse=True)
        w = np.broadcast_to(count, at.shape).ravel().astype(float)
        ones = self.bit.ravel() == 1
        a, b = np.bincount(inv, w * ~ones, len(node)), np.bincount(inv, w * ones, len(node))
        lkt = log_kt(a, b)
        self.path, self.layers = [inv], [(a, b, None)]
        lpw = lkt
        for d in range(depth - 1, 1, -1):
            up = ((node >> np.uint64(16)) << np.uint64(8)) | (node & np.uint64(0xFF))
            node, par = np.unique(up, return_inverse=True)
            a, b = np.bincount(par, a, len(node)), np.bincount(par, b, len(node))
            lkt = log_kt(a, b)
            lpw, odds = _weights(lkt, np.bincount(par, lpw, len(node)))
            self.path.append(par[self.path[-1]])
            self.layers.append((a, b, odds))
        self.node, self.a, self.b, self.lpw = node, a, b, lpw

    def depth1(self) -> pd.DataFrame:
        """Sums for the nodes (c1, prefix) above."""
        up = ((self.node >> np.uint64(16)) << np.uint64(8)) | (self.node & np.uint64(0xFF))
        node, par = np.unique(up, return_inverse=True)
        s = lambda x: np.bincount(par, x, len(node))
        return pd.DataFrame({"node": node.astype(np.int64), "a": s(self.a), "b": s(self.b), "below": s(self.lpw)})

    def log10(self, key: np.ndarray, top: dict[str, np.ndarray], depth: int) -> np.ndarray:
        """log10 probability of each gram's byte after its context."""
        ones = self.bit.ravel()
        kt = lambda a, b, i: (np.where(ones == 1, b[i], a[i]) + 0.5) / (a[i] + b[i] + 1.0)
        p, seen = None, None
        for i, (a, b, odds) in zip(self.path, self.layers):
            own = kt(a, b, i)
            p = own if p is None else np.where(seen, (odds[i] * own + p) / (odds[i] + 1.0), own)
            seen = (a + b)[i] > 0
        c1 = (key >> np.uint64(8 * depth)).astype(np.int64)
        one = ((c1 << 8)[None, :] | self.prefix).ravel()
        for i, k in ((one, "1"), (self.prefix.ravel(), "0")):
            a, b, odds = top["a" + k], top["b" + k], top["w" + k]
            own = kt(a, b, i)
            p = np.where(seen, (odds[i] * own + p) / (odds[i] + 1.0), own)
            seen = (a + b)[i] > 0
        return np.log10(p).reshape(8, -1).sum(axis=0)


def top_tables(rows: pd.DataFrame) -> dict[str, np.ndarray]:
    """Counts and weights of depth 1 (c1, prefix) and depth 0 (prefix)."""
    n = 256 * 256
    node = rows["node"].to_numpy(np.int64)
    put = lambda c: np.bincount(node, rows[c].to_numpy(float), n)[:n] if len(node) else np.zeros(n)
    a1, b1, below = put("a"), put("b"), put("below")
    lpw1, w1 = _weights(log_kt(a1, b1), below)
    fold = lambda x: x.reshape(256, 256).sum(axis=0)
    a0, b0 = fold(a1), fold(b1)
    _, w0 = _weights(log_kt(a0, b0), fold(np.where(a1 + b1 > 0, lpw1, 0.0)))
    return {"a1": a1, "b1": b1, "w1": w1, "a0": a0, "b0": b0, "w0": w0}


def _merged(frames: pd.DataFrame, depth: int) -> tuple[np.ndarray, np.ndarray]:
    key = np.concatenate([unpacked(k, depth) for k in frames["keys"]])
    n = np.concatenate([np.frombuffer(t, "<u4") for t in frames["train"]])
    uniq, inv = np.unique(key, return_inverse=True)
    return uniq, np.bincount(inv, n, len(uniq))


def _ask(slices: int, depth: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("kind", pa.int32()), ("slice", pa.int32()), ("block", pa.int64()), ("keys", pa.binary()), ("train", pa.binary())])
        for whole in small_batches(batches, "text", TAKE):
            blocks = whole.column("block").to_numpy()
            edge = [0, *(np.flatnonzero(np.diff(blocks)) + 1).tolist(), len(blocks)]
            for s, e in zip(edge, edge[1:]):
                b, block, out = whole.slice(s, e - s), int(blocks[s]), []
                texts, learn = texts_of(b), ~b.column("held_out").to_numpy(zero_copy_only=False)
                key, off = grams(texts, depth)
                codes, uniq = pd.factorize(key)
                n = np.bincount(codes, np.repeat(learn, np.diff(off)), len(uniq)).astype("<u4")
                del key, codes
                at = (mix64(uniq >> np.uint64(8 * (depth - 1))) % np.uint64(slices)).astype(np.int64)
                out += _dealt(0, block, at, uniq.astype("<u8"), n, depth)
                codes, words, off = split_words(pc.ascii_lower(texts))
                n = np.bincount(codes, np.repeat(learn, np.diff(off)), len(words)).astype("<u4")
                raw = [w.encode() for w in words.to_pylist()]
                at = np.fromiter((zlib.crc32(w) % slices for w in raw), np.int64, len(raw))
                out += _dealt(1, block, at, np.array(raw, dtype=object), n, depth)
                yield pa.RecordBatch.from_pylist(out, schema)

    return run


def _dealt(kind: int, block: int, at: np.ndarray, keys: np.ndarray, n: np.ndarray, depth: int) -> list[dict]:
    order = np.argsort(at, kind="stable")
    cut = np.flatnonzero(np.diff(at[order])) + 1
    pack = (lambda k: b" ".join(k)) if kind else (lambda k: packed(k, depth))
    out = []
    for own in np.split(order, cut) if len(order) else []:
        if not kind:
            own = own[np.argsort(keys[own], kind="stable")]
        out.append({"kind": kind, "slice": int(at[own[0]]), "block": block, "keys": pack(keys[own]), "train": n[own].tobytes()})
    return out


def _word_answers(pdf: pd.DataFrame) -> pd.DataFrame:
    """Training count of each asked word; block -1: the slice's sum and number of trained words."""
    total: dict[bytes, int] = {}
    asked = [k.split(b" ") for k in pdf["keys"]]
    for words, t in zip(asked, pdf["train"]):
        for w, n in zip(words, np.frombuffer(t, "<u4").tolist()):
            if n:
                total[w] = total.get(w, 0) + n
    vals = [np.array([total.get(w, 0) for w in words], "<f8").tobytes() for words in asked]
    sums = np.array([sum(total.values()), len(total)], "<f8").tobytes()
    return pd.DataFrame({"kind": 1, "block": [*pdf["block"], -1], "keys": [*pdf["keys"], b""], "vals": [*vals, sums]})


def _score(depth: int, tokens: float, distinct: float, train_docs: int):
    rest = np.log10(tokens + 0.1 * (distinct + 1)) if tokens else -1.0
    end = np.log10(train_docs + 0.1) - rest
    out_cols = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]

    def run(docs: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        g, w = answers[answers["kind"] == 0], answers[answers["kind"] == 1]
        key = np.concatenate([np.zeros(0, "<u8"), *(unpacked(k, depth) for k in g["keys"])])
        val = np.concatenate([np.zeros(0), *(np.frombuffer(v, "<f4") for v in g["vals"])])
        order = np.argsort(key, kind="stable")
        key, val = key[order], val[order]
        count = {x: n for k, v in zip(w["keys"], w["vals"]) for x, n in zip(k.split(b" "), np.frombuffer(v, "<f8").tolist())}
        parts = []
        batch = pa.RecordBatch.from_pandas(docs[["doc_id", "text", "held_out"]].astype({"doc_id": "Int64"}), preserve_index=False)
        for b in small_batches([batch], "text", TAKE):
            texts = texts_of(b)
            gram, off = grams(texts, depth)
            codes, uniq = pd.factorize(gram)
            at = np.searchsorted(key, uniq)
            if len(uniq) and (at.max() >= len(key) or (key[at] != uniq).any()):
                raise RuntimeError("a block's grams were not answered in full")
            score = np.add.reduceat(val[at][codes], off[:-1])
            codes, words, off = split_words(pc.ascii_lower(texts))
            c = np.array([count[x.encode()] for x in words.to_pylist()], float)[codes] if len(words) else np.zeros(0)
            sums = lambda x: np.diff(np.concatenate([[0.0], np.cumsum(x)])[off])  # noqa: B023,E731
            base = sums(np.log10(c + 0.1) - rest) + end
            parts.append(pd.DataFrame({
                "doc_id": b.column("doc_id").to_pandas().astype("Int64"), "held_out": b.column("held_out").to_pandas(),
                "n_tokens": np.diff(off) + 1, "n_known": sums((c > 0).astype(float)).round().astype(np.int64) + int(train_docs > 0),
                "train_tokens": int(tokens), "base_score": base, "score": score}))
        return pd.concat(parts)[out_cols] if parts else pd.DataFrame(columns=out_cols)

    return run


def scored(docs: DataFrame, depth: int = DEPTH) -> DataFrame:
    """Score every row of (doc_id, text, held_out, block); learn from the rows that are not held out.

    ``block`` groups some thousand neighbouring rows; any value is right, it only sets how much is
    gathered at a time.  Null text counts as empty (its end alone); repeated rows count each."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), "held_out", "block")
    row = docs.agg(F.count(F.lit(1)), F.count_if(~F.col("held_out"))).first()
    slices, train_docs = 8 + row[0] // SLICE_ROWS, row[1]
    asked = written(docs.mapInArrow(_ask(slices, depth), ASKED), "lm_asked")
    gram, word = asked.where("kind = 0").select("slice", "block", "keys", "train"), asked.where("kind = 1").select("slice", "block", "keys", "train")

    words = written(word.groupBy("slice").applyInPandas(_word_answers, ANSWER), "lm_words")
    sums = [np.frombuffer(r.vals, "<f8") for r in words.where("block = -1").select("vals").toLocalIterator()]  # two numbers a slice
    tokens, distinct = (np.sum(sums, axis=0) if sums else np.zeros(2)) + [train_docs, int(train_docs > 0)]

    def sums_of(pdf: pd.DataFrame) -> pd.DataFrame:
        return Subtrees(*_merged(pdf, depth), depth).depth1()

    rows = gram.select("slice", "keys", "train").groupBy("slice").applyInPandas(sums_of, "node long, a double, b double, below double")
    top = top_tables(rows.groupBy("node").agg(*(F.sum(c).alias(c) for c in ("a", "b", "below"))).toPandas())  # at most 256 x 255 rows
    top = spark.sparkContext.broadcast(top)

    def answer(pdf: pd.DataFrame) -> pd.DataFrame:
        key, n = _merged(pdf, depth)
        p = Subtrees(key, n, depth).log10(key, top.value, depth)
        vals = [p[np.searchsorted(key, unpacked(k, depth))].astype("<f4").tobytes() for k in pdf["keys"]]
        return pd.DataFrame({"kind": 0, "block": pdf["block"], "keys": pdf["keys"], "vals": vals})

    answers = gram.groupBy("slice").applyInPandas(answer, ANSWER).unionByName(words.where("block >= 0"))
    out = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return docs.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(_score(depth, float(tokens), float(distinct), train_docs), out)


def op6_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 6 over all documents; crc32(doc_id as text) mod 10 = 0 is held out (a null id too)."""
    docs = table(spark, sf_dir, "documents")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 10 == 0, F.lit(True))
    place = F.xxhash64(F.col("_metadata.file_path"), F.floor(F.col("_metadata.row_index") / BLOCK_ROWS))
    return scored(docs.select("doc_id", "text", held.alias("held_out"), F.shiftrightunsigned(place, 1).alias("block")))
