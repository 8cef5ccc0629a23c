"""Language of code-switched text by a linear-chain conditional random field (operator 8).

Each white-space word is a position, and of a word beyond ``LETTERS`` characters (a sentence in scripts
without blanks) each piece of that length; each language is a label.  A word's features are its affixes, its
character n-grams, its own form and the languages whose frequent-word lexicon holds it, hashed into
``2 ** BITS`` weights per label.  Transitions between languages are learned with them, from rows in
which stretches of documents of different languages follow each other.  Labels are marginals by the
forward-backward recursion over the whole text; a document's language is the label with the largest
mean marginal over its positions that have letters, and that mean is its score.

The field is fitted on some ``FIT_DOCS`` labelled documents, the same number of each language where there
are enough and ``FIT_LEAST`` at least (by hash order, one window of ``FIT_WORDS`` words of each): a
documented bound.  A language with any labelled document is a label at every size.  Prediction covers every word of every text.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewatch.llm.common import TAKE_BYTES, give_back, ragged, small_batches, split_words, table, texts_of, written

BITS = 15
FIT_DOCS = 1500
FIT_LEAST = 20  # of each language, however many languages there are
FIT_WORDS = 36
STRETCHES = 3  # of different documents, in one training row
LEXICON = 200  # frequent words of each language
STEPS = 60
LETTERS = 48  # of a position
MEMO_WORDS = 200_000
LEAN_BYTES = 2 << 20  # text handled at a time beside other stages; scores and messages of its positions take some 15 times that
NEW_WORDS = 16_384  # words without a memo whose features are held at a time
LETTER = regex.compile(r"\p{L}")


_HASHED: dict[str, int] = {}


def _hashed(keys: list[str]) -> list[int]:
    if len(_HASHED) > MEMO_WORDS:
        _HASHED.clear()
    out = list(map(_HASHED.get, keys))
    for i, h in enumerate(out):
        if h is None:
            out[i] = _HASHED[keys[i]] = zlib.crc32(keys[i].encode()) & ((1 << BITS) - 1)
    return out


def features(word: str, lexicon: dict[str, tuple[int, ...]]) -> list[int]:
    """Hashed features of a word; none for a word without letters."""
    core = word.lower()
    if not core.isalpha():
        core = "".join(filter(str.isalpha, core))
        if not core:
            return []
    n = len(core)
    own = ["p" + core[:1], "p" + core[:2], "p" + core[:3], "s" + core[-1:], "s" + core[-2:], "s" + core[-3:]]
    own += ["b" + core[i:i + 2] for i in range(n - 1)] + ["t" + core[i:i + 3] for i in range(n - 2)]
    own += [f"l{k}" for k in lexicon.get(core, ())]
    return [*_hashed(own), zlib.crc32(b"w" + core.encode()) & ((1 << BITS) - 1)]


def pieces(word: str) -> list[str]:
    """The positions of a word."""
    return [word[i:i + LETTERS] for i in range(0, len(word), LETTERS)]


def positions(texts: pa.Array) -> tuple[np.ndarray, list[str], np.ndarray]:
    """``split_words`` with long words in pieces: (code of each position, words, offset of each text)."""
    codes, uniq, off = split_words(texts)
    words = uniq.to_pylist()
    if not words or pc.max(pc.utf8_length(uniq)).as_py() <= LETTERS:
        return codes, words, off
    cut = list(map(pieces, words))
    starts = np.concatenate([[0], np.cumsum(list(map(len, cut)), dtype=np.int64)])
    codes, ends = ragged(starts, np.arange(starts[-1]), codes)
    return codes, [x for c in cut for x in c], ends[off]


def forward_backward(emit: np.ndarray, off: np.ndarray, trans: np.ndarray, init: np.ndarray) -> np.ndarray:
    """Marginals of every word of many texts; ``emit``: scores (words, labels); ``off``: text offsets.

    All texts advance together, the longest first, so each step is one matrix product."""
    n = np.diff(off)
    order = np.argsort(-n, kind="stable")
    start, length = off[:-1][order], n[order]
    if not len(emit):
        return emit
    e = emit - emit.max(axis=1, keepdims=True)
    np.exp(e, out=e)
    a, b = np.empty_like(e), np.empty_like(e)
    m, first = np.exp(trans).astype(e.dtype), np.exp(init).astype(e.dtype)
    steps = int(length[0]) if len(length) else 0
    active = np.searchsorted(-length, -np.arange(steps), side="left")  # texts longer than t
    for t in range(steps):
        at = start[:active[t]] + t
        v = e[at] * (first if t == 0 else a[at - 1] @ m)
        a[at] = v / v.sum(axis=1, keepdims=True)
    for t in range(steps - 1, -1, -1):
        k = active[t]
        at = start[:k] + t
        more = active[t + 1] if t + 1 < steps else 0
        v = np.ones((k, e.shape[1]), e.dtype)
        if more:
            nxt = at[:more] + 1
            v[:more] = (b[nxt] * e[nxt]) @ m.T
            v[:more] /= v[:more].sum(axis=1, keepdims=True)
        b[at] = v
    a *= b
    a /= a.sum(axis=1, keepdims=True)
    return a


class Field:
    """Fitted labels, weights and transitions."""

    def __init__(self, labels: list[str], lexicon, weights, trans, init):
        self.labels, self.lexicon, self.weights, self.trans, self.init = labels, lexicon, weights, trans, init
        self.memo: dict[str, bytes] = {}

    def emissions(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(scores of each word, whether it has a letter)."""
        got = list(map(self.memo.get, words))
        missing = [i for i, g in enumerate(got) if g is None]
        for s in range(0, len(missing), NEW_WORDS):
            new = missing[s:s + NEW_WORDS]
            feats = [features(words[i], self.lexicon) for i in new]
            size = np.fromiter(map(len, feats), np.int64, len(feats))
            flat = np.fromiter((x for f in feats for x in f), np.int64, int(size.sum()))
            total = np.concatenate([np.zeros((1, len(self.labels))), np.cumsum(self.weights[flat], axis=0, dtype=np.float64)])
            end = np.cumsum(size)
            rows = np.hstack([total[end] - total[end - size], (size > 0)[:, None]]).astype("<f4")
            for i, f, row in zip(new, feats, rows):
                if not f:
                    row[-1] = LETTER.search(words[i]) is not None
                got[i] = row.tobytes()
                self.memo[words[i]] = got[i]
        if len(self.memo) > MEMO_WORDS:
            self.memo.clear()
        table_ = np.frombuffer(b"".join(got), "<f4").reshape(len(words), len(self.labels) + 1)
        return table_[:, :-1], table_[:, -1] > 0

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        codes, words, off = positions(texts)
        score, letter = self.emissions(words)
        p = forward_backward(score[codes], off, self.trans, self.init)
        has = letter[codes]
        p *= has[:, None]
        some = np.diff(off) > 0
        total = np.zeros((len(some), len(self.labels)))
        if some.any():
            total[some] = np.add.reduceat(p, off[:-1][some], axis=0, dtype=np.float64)
        n = np.diff(np.concatenate([[0], np.cumsum(has)])[off])
        mean = total / np.maximum(n, 1)[:, None]
        best = mean.argmax(axis=1)
        lang = [self.labels[k] if c else "und" for k, c in zip(best, n)]
        return lang, np.where(n > 0, np.clip(mean.max(axis=1), 0, 1), 0.0)


def fit(rows: list[tuple[str, list[str]]], seed: int = 8) -> Field | None:
    """Fit on (language, window of words) rows: conditional likelihood by Adam on all rows at once."""
    rows = sorted(r for r in rows if r[1])
    labels = sorted({lang for lang, _ in rows})
    if not labels:
        return None
    rng = np.random.default_rng(seed)
    lexicon: dict[str, tuple[int, ...]] = {}
    for k, lang in enumerate(labels):
        seen = Counter("".join(c for c in w.lower() if c.isalpha()) for x, ws in rows if x == lang for w in ws)
        for w, _ in sorted(seen.items(), key=lambda x: (-x[1], x[0]))[:LEXICON]:
            lexicon[w] = (*lexicon.get(w, ()), k)
    by_lang = {k: [ws for lang, ws in rows if lang == name] for k, name in enumerate(labels)}
    width, each = FIT_WORDS, FIT_WORDS // STRETCHES
    words, gold = [], []
    for lang, ws in rows:  # a row: stretches of this and of other documents
        line: list[str] = []
        tag: list[int] = []
        k = labels.index(lang)
        while len(line) < width:
            take = int(rng.integers(each // 2, each * 2))
            at = int(rng.integers(0, max(1, len(ws) - take + 1)))
            got = ws[at:at + take]
            line += got
            tag += [k] * len(got)
            k = int(rng.integers(len(labels)))
            ws = by_lang[k][int(rng.integers(len(by_lang[k])))]
        words.append(line[:width])
        gold.append(tag[:width])
    flat = [w for x in words for w in x]
    uniq, codes = np.unique(np.array(flat, dtype=object), return_inverse=True)
    codes = codes.ravel()
    feats = [features(w, lexicon) for w in uniq]
    owner = np.repeat(np.arange(len(feats)), [len(f) for f in feats])
    feat = np.array([x for f in feats for x in f], dtype=np.int64)
    n, m = len(words), len(labels)
    y = np.array(gold)
    off = np.arange(n + 1) * width
    params = [np.zeros((1 << BITS, m)), np.zeros((m, m)), np.zeros(m)]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    hot = np.eye(m)[y.ravel()]
    scatter = lambda idx, val, size: np.stack([np.bincount(idx, val[:, k], size) for k in range(m)], axis=1)
    for step in range(1, STEPS + 1):
        w, trans, init = params
        emit = scatter(owner, w[feat], len(uniq))[codes]
        p = forward_backward(emit, off, trans, init)
        grad_w = scatter(feat, scatter(codes, p - hot, len(uniq))[owner], 1 << BITS) + 1e-2 * w
        # expected transitions: pairwise marginals from the marginals' recursion
        e = np.exp(emit - emit.max(axis=1, keepdims=True)).reshape(n, width, m)
        a, b = _messages(e, trans, init)
        pair = a[:, :-1, :, None] * np.exp(trans)[None, None] * (b * e)[:, 1:, None, :]
        pair /= pair.sum(axis=(2, 3), keepdims=True)
        real = np.zeros((m, m))
        np.add.at(real, (y[:, :-1].ravel(), y[:, 1:].ravel()), 1)
        grads = [grad_w, pair.sum(axis=(0, 1)) - real + 1e-2 * trans, (p.reshape(n, width, m)[:, 0] - hot.reshape(n, width, m)[:, 0]).sum(axis=0) + 1e-2 * init]
        for i, (x, g) in enumerate(zip(params, grads)):
            m1, m2 = moments[i]
            m1 += 0.1 * (g - m1)
            m2 += 0.001 * (g * g - m2)
            x -= 0.1 * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.999**step)) + 1e-8)
    return Field(labels, lexicon, params[0].astype(np.float32), params[1], params[2])


def _messages(e: np.ndarray, trans: np.ndarray, init: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    m = np.exp(trans)
    a, b = np.empty_like(e), np.ones_like(e)
    for t in range(e.shape[1]):
        v = e[:, t] * (np.exp(init) if t == 0 else a[:, t - 1] @ m)
        a[:, t] = v / v.sum(axis=1, keepdims=True)
    for t in range(e.shape[1] - 2, -1, -1):
        v = (b[:, t + 1] * e[:, t + 1]) @ m.T
        b[:, t] = v / v.sum(axis=1, keepdims=True)
    return a, b


def _windows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        lang, text, key, at = (b.column(c).to_pylist() for c in ("lang", "text", "h", "at"))
        out = []
        for x, t, k, h in zip(lang, text, key, at):
            ws = [x for w in t.split() for x in pieces(w)]
            s = h % max(1, len(ws) - FIT_WORDS + 1)
            out.append({"lang": x, "words": " ".join(ws[s:s + FIT_WORDS]), "h": k})
        yield pa.RecordBatch.from_pylist(out, pa.schema([("lang", pa.string()), ("words", pa.string()), ("h", pa.int64())]))


def fitted(docs: DataFrame, learn, most: int = FIT_DOCS) -> Field | None:
    """Fit on the labelled rows of least hash of each language that ``learn`` selects, one window of words of each.

    Of equal rows one counts."""
    rows = docs.where(learn & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    h = F.xxhash64("doc_id", "text")
    # ranks up to the limit are cut before the shuffle, so no task gets a whole language
    rank = F.dense_rank().over(Window.partitionBy("lang").orderBy("h"))
    first = rows.select("lang", h.alias("h")).withColumn("r", rank).where(F.col("r") <= min(most, 1000))
    first = written(first.groupBy("lang", "r").agg(F.min("h").alias("h")), "language_fit")  # languages x 1000 rows
    n = first.select("lang").distinct().count()
    if not n:
        return None
    bound = first.where(F.col("r") <= max(FIT_LEAST, most // n)).groupBy(F.col("lang").alias("b_lang")).agg(F.max("h").alias("b_h"))
    sample = rows.withColumn("h", h).join(F.broadcast(bound), (F.col("lang") == F.col("b_lang")) & (F.col("h") <= F.col("b_h")))
    sample = sample.select("lang", "text", "h", F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(1)), 1).alias("at"))
    got = sample.mapInArrow(_windows, "lang string, words string, h long").groupBy("lang", "h").agg(F.min("words").alias("words")).collect()  # short rows, as many as picked
    return fit([(r["lang"], r["words"].split()) for r in got])


def with_language(docs: DataFrame, field: Field | None, *keep: str, lean: bool = False) -> DataFrame:
    """``keep`` columns plus (lang_pred, score) of every row; no shuffle.

    ``und`` with score 0 stands for null and empty texts, texts without a letter, and everything
    if there was nothing to learn from.  Repeated rows are labelled each on its own.  ``lean``: less text at a time
    and no hashes kept after a task, for workers that hold the memory of other stages too."""
    shared = docs.sparkSession.sparkContext.broadcast(field)  # 2 ** BITS weights a label and the lexicon
    names = list(keep)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = shared.value
        for b in small_batches(batches, "text__", LEAN_BYTES if lean else TAKE_BYTES):
            texts = texts_of(b, "text__")
            lang, score = field.predict(texts) if field else (["und"] * len(texts), np.zeros(len(texts)))
            cols = [b.column(i) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(lang), pa.array(score)], names=[*names, "lang_pred", "score"])
        if lean:
            _HASHED.clear()
            give_back()

    out = docs.select(*keep).schema.add("lang_pred", "string").add("score", "double")
    return docs.select(*keep, F.col("text").cast("string").alias("text__")).mapInArrow(run, out)


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 8 over all documents; crc32(doc_id as text) mod 4 = 2 is held out (a null id too)."""
    docs = table(spark, sf_dir, "documents")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(True))
    field = fitted(docs, ~held)
    return with_language(docs.withColumn("held_out", held), field, "doc_id", "held_out")
