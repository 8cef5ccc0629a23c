"""Phrase collocation mining by best-first branch-and-bound growth (operator 11).

Phrases of 2 to ``longest`` words with at least ``least`` occurrences are scored by their weakest cut,
floor(1000 a n / (l r)); each language's first ``most`` are returned.

*Bound.*  A phrase starting with w scores at most floor(1000 n / f(w)): its cut after w has l = f(w), and
r >= a.  So the prefix w is a branch, and rare first words promise most.

*Blocks.*  The texts are cut into words once and written as streams of unit numbers; all passes read these.

*Waves.*  Branches are expanded best first, in two waves over the blocks.  The first takes each language's
rarest first words, up to a share of its occurrences.  The ``most``-th surviving score found is then a
floor for the result: the second wave takes every branch whose bound meets it, ties included (all
branches if fewer than ``most`` phrases were found), and the rest is settled without being counted.

*Growth.*  A prefix grows by a word only while it is frequent.  Pairs are counted by a 64-bit hash first;
exact counts by the words themselves follow for pairs whose hash is frequent, then for prefixes of 3, 4
and 5 words level by level.  Tasks know frequent prefixes by bit sketches of a fixed size
(``SKETCH_BITS``): a false positive costs a row that the exact count drops, none is missed.  Counts are
combined per block of text, then per task, then by phrase.

*Suffixes.*  A cut needs the count of the phrase's rest, whose first word may not be expanded; such rests
are counted exactly in one more pass.

*Survival.*  A candidate inside a longer one of equal count is inside one with one word more of equal
count, so it is dropped just if all its occurrences have the same word before, or the same behind, within
their piece (and it has fewer than ``longest`` words).  Every count brings that along.

Edge cases: null text is read as empty, null lang as ``und``; repeated rows count as often as they stand;
words keep everything but A-Z as it is; without candidates the result is empty.  Only lang and text are
read.  Arithmetic is in 38 decimal digits.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from tidewatch.llm.common import importable, mix64, small_batches, table, texts_of, written
from tidewatch.session import scratch_path

SKETCH_BITS = 1 << 25  # 4 MB; a corpus of billions of frequent phrases wants more, or filters less
GROUP_BYTES = 16 << 20  # of a row group of blocks, which is what a reading task holds
FIRST_SHARE = 8  # the first wave takes the rarest first words up to this part of their occurrences
SALTS = 16  # parts of a language that are cut to the best before they meet

_BYTES = np.arange(256)
_LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)
_KIND = np.zeros(256, np.uint8)  # of a byte: 0 in a word, 1 between words, 2 between pieces
_KIND[[0x20, 0x09]] = 1
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = 2
_ODD = np.uint64(0x9E3779B97F4A7C15)


# --- words of a block ---------------------------------------------------------------------

BLOCK = "langs array<string>, words array<string>, hashes array<long>, counts array<long>, stream binary"


def encoded_block(langs: pa.Array, texts: pa.Array) -> pa.RecordBatch:
    """One row: the units (language and word) of some texts, their hashes and counts, and the texts as a stream
    of unit numbers, -1 between pieces."""
    texts = texts.cast(pa.large_binary())
    off = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[off[0]:off[-1]]
    off = off - off[0]
    kind = _KIND[data]
    inside = kind == 0
    edge = np.zeros(len(data) + 1, bool)
    edge[off] = True  # texts begin and end here
    begin, end = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1] | edge[1:-1]
    end[:-1] &= ~inside[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    place = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(place), pa.py_buffer(_LOWER[data[inside]])]).dictionary_encode()
    text = np.searchsorted(off, starts, "right") - 1
    piece = np.cumsum(kind == 2, dtype=np.int32)[starts] + text if len(starts) else starts
    lang, many = langs.dictionary_encode(), max(1, len(words.dictionary))
    both = lang.indices.to_numpy(zero_copy_only=False).astype(np.int64)[text] * many + words.indices.to_numpy(zero_copy_only=False)
    if len(lang.dictionary) * many <= 8 * len(both):  # as a rule: no sort
        n = np.bincount(both, minlength=len(lang.dictionary) * many)
        units = np.flatnonzero(n)
        unit, n = (np.cumsum(n > 0) - 1)[both], n[units]
    else:
        units, unit, n = np.unique(both, return_inverse=True, return_counts=True)
    own = lang.dictionary.take(pa.array(units // many)).cast(pa.string())
    word = words.dictionary.take(pa.array(units % many)).cast(pa.large_string()).cast(pa.string())
    h = unit_hash(np.array(own.to_pylist(), object), np.array(word.to_pylist(), object)) if len(units) else np.zeros(0, np.uint64)
    fresh = np.concatenate([[False], piece[1:] != piece[:-1]]) if len(piece) else np.zeros(0, bool)
    stream = np.full(len(unit) + int(fresh.sum()), -1, np.int32)
    stream[np.arange(len(unit)) + np.cumsum(fresh)] = unit
    one = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)
    cols = [one(own), one(word), one(pa.array(h.view(np.int64))), one(pa.array(n.astype(np.int64))), pa.array([stream.tobytes()], pa.binary())]
    return pa.RecordBatch.from_arrays(cols, names=["langs", "words", "hashes", "counts", "stream"])


class Block:
    """A row of encoded texts: ``unit`` of each place (-1 between pieces), language, word and hash of each unit."""

    def __init__(self, langs: pa.Array, words: pa.Array, hashes: pa.Array, stream: bytes):
        self.langs, self.words = langs, words.cast(pa.large_string())
        self.hash = hashes.to_numpy(zero_copy_only=False).view(np.uint64)
        self.unit = np.frombuffer(stream, np.int32)

    def places(self, words: int, opens: np.ndarray | None = None) -> np.ndarray:
        """Where a phrase of so many words can begin, with one of the units ``opens``."""
        at = np.flatnonzero(self.unit >= 0 if opens is None else np.append(opens, False)[self.unit])
        for k in range(1, words):
            at = at[at + k < len(self.unit)]
            at = at[self.unit[at + k] >= 0]
        return at

    def hashes(self, at: np.ndarray, words: int) -> np.ndarray:
        h = self.hash[self.unit[at]]
        for k in range(1, words):
            h = longer_hash(h, self.hash[self.unit[at + k]])
        return h

    def phrases(self, at: np.ndarray, words: int) -> pa.RecordBatch:
        """(lang, words, phrase, h, n, left, right) of the phrases of 2 words or more that begin at ``at``: their
        number here, and the word before and behind if it is always the same one."""
        key = self.unit[at].astype(np.int64)
        for k in range(1, words):
            _, rank = np.unique(key, return_inverse=True)
            key = rank * (len(self.words) + 1) + self.unit[at + k]
        order = np.argsort(key, kind="stable")
        key, at = key[order], at[order]
        head = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
        n = np.diff(np.append(head, len(key)))
        one = at[head]

        def beside(step: int) -> pa.Array:
            if not len(one):
                return pa.nulls(0, pa.large_string())
            to = at + step
            ok = (to >= 0) & (to < len(self.unit))
            unit = np.where(ok, self.unit[np.where(ok, to, 0)], -1)
            low, high = np.minimum.reduceat(unit, head), np.maximum.reduceat(unit, head)
            return self.words.take(pa.array(low, mask=(low != high) | (low < 0)))

        word = [self.words.take(pa.array(self.unit[one + k])) for k in range(words)]
        text = pc.binary_join_element_wise(*word, pa.scalar(" ", pa.large_string()))
        cols = [self.langs.take(pa.array(self.unit[one])), pa.array(np.full(len(one), words, np.int32)), text, pa.array(self.hashes(one, words).view(np.int64)), pa.array(n.astype(np.int64)), beside(-1), beside(words)]
        return pa.RecordBatch.from_arrays([c.cast(pa.string()) if pa.types.is_large_string(c.type) else c for c in cols], names=["lang", "words", "phrase", "h", "n", "left", "right"])


def unit_hash(langs: np.ndarray, words: np.ndarray) -> np.ndarray:
    return mix64(pd.util.hash_array(langs, categorize=True) * _ODD + pd.util.hash_array(words, categorize=False))


def longer_hash(h: np.ndarray, unit: np.ndarray) -> np.ndarray:
    return mix64(h * _ODD + unit)


@F.pandas_udf(LongType())
def phrase_hash(lang: pd.Series, phrase: pd.Series) -> pd.Series:
    """The hash of a phrase as ``Block.hashes`` has it."""
    out = np.zeros(len(lang), np.uint64)
    split = phrase.str.split(" ", regex=False)
    for k in range(int(split.str.len().max()) if len(split) else 0):
        some = (split.str.len() > k).to_numpy()
        unit = unit_hash(lang[some].to_numpy(object), split[some].str[k].to_numpy(object))
        out[some] = longer_hash(out[some], unit) if k else unit
    return pd.Series(out.view(np.int64), index=lang.index)


# --- sketches -----------------------------------------------------------------------------


def sketch(hashes: DataFrame, bits: int) -> np.ndarray:
    """Bit array of the hashes ``h``; at most bits / 64 rows come to the driver, whatever their number."""
    at = F.col("h").bitwiseAND(F.lit(bits - 1))
    rows = hashes.select(F.shiftright(at, 6).alias("word"), at.bitwiseAND(F.lit(63)).cast("int").alias("bit"))
    got = rows.groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("set")).toPandas()
    out = np.zeros(bits // 64, np.int64)
    out[got["word"].to_numpy(np.int64)] = got["set"].to_numpy(np.int64)
    return out.view(np.uint64)


def holds(set_: np.ndarray, h: np.ndarray) -> np.ndarray:
    at = h & np.uint64(len(set_) * 64 - 1)
    return (set_[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) != 0


# --- passes over the texts -----------------------------------------------------------------

ROW = "lang string, words int, phrase string, h long, n long, left string, right string"


def encoded(texts: DataFrame) -> DataFrame:
    """The texts (lang, text) cut into words once, in blocks; a third to a half of their size on disk."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches, "text"):
            yield encoded_block(b.column("lang"), texts_of(b))

    # the writer looks at its size after every block, not after 100 of them, so a task holds few at a time
    path = scratch_path(texts.sparkSession, "phrase_blocks")
    sizes = {"parquet.block.size": GROUP_BYTES, "parquet.block.size.row.check.min": 1, "parquet.block.size.row.check.max": 1, "parquet.page.size.row.check.min": 1}
    texts.mapInArrow(run, BLOCK).write.options(compression="zstd", **sizes).parquet(path)
    return texts.sparkSession.read.schema(BLOCK).parquet(path)


@contextmanager
def block_by_block(spark: SparkSession) -> Iterator[None]:
    """Parquet rows with arrays are read one at a time: the vectorised reader takes 4096, here all blocks of a split."""
    key = "spark.sql.parquet.enableNestedColumnVectorizedReader"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _pass(blocks: DataFrame, schema: str, rows_of: Callable[[Block], Iterable[pa.RecordBatch]]) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                own = [b.column(c)[i] for c in ("langs", "words", "hashes", "stream")]
                yield from rows_of(Block(*(x.values for x in own[:3]), own[3].as_py()))

    return blocks.select("langs", "words", "hashes", "stream").mapInArrow(run, schema)


def _summed(rows: DataFrame, least: int) -> DataFrame:
    """(lang, words, phrase, h, a, bound): counts, and whether one word always stands before or always behind."""
    same = lambda c: (F.count(c) == F.count(F.lit(1))) & (F.min(c) == F.max(c))
    got = rows.groupBy("lang", "words", "phrase", "h").agg(F.sum("n").alias("a"), F.coalesce(same("left") | same("right"), F.lit(False)).alias("bound"))
    return got.where(F.col("a") >= least)


def _grown(blocks: DataFrame, words: DataFrame, wave: DataFrame, least: int, longest: int, bits: int) -> DataFrame:
    """The frequent phrases that begin with a word of ``wave``."""
    spark = blocks.sparkSession
    share = spark.sparkContext.broadcast
    first, frequent = share(sketch(wave, bits)), share(sketch(words, bits))

    def starts(block: Block, n: int) -> np.ndarray:
        opens, goes_on = holds(first.value, block.hash), holds(frequent.value, block.hash)
        at = block.places(n, opens)
        return at[goes_on[block.unit[at + n - 1]]]

    def pairs(block: Block) -> Iterator[pa.RecordBatch]:
        h, n = np.unique(block.hashes(starts(block, 2), 2), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n.astype(np.int64))], names=["h", "n"])

    often = _pass(blocks, "h long, n long", pairs).groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    known = share(sketch(written(often.select("h"), "phrase_pairs"), bits))
    out = None
    for n in range(min(3, longest), longest + 1):

        def longer(block: Block, n=n, known=known) -> Iterator[pa.RecordBatch]:
            if n <= 3:  # the pairs themselves, by their words
                at = starts(block, 2)
                yield block.phrases(at[holds(known.value, block.hashes(at, 2))], 2)
            if n > 2:
                at = starts(block, n)
                yield block.phrases(at[holds(known.value, block.hashes(at, n - 1))], n)

        got = written(_summed(_pass(blocks, ROW, longer), least), "phrases")
        out = got if out is None else out.unionByName(got)
        last = sketch(got.where(F.col("words") == n), bits)
        if not last.any():
            break
        known = share(last)
    return out


def _counted(blocks: DataFrame, wanted: DataFrame, longest: int, bits: int) -> DataFrame:
    """(lang, phrase, a) of the ``wanted`` (lang, phrase) of 2 words and more."""
    known = blocks.sparkSession.sparkContext.broadcast(sketch(wanted.withColumn("h", phrase_hash("lang", "phrase")), bits))

    def rows_of(block: Block) -> Iterator[pa.RecordBatch]:
        for n in range(2, longest):
            at = block.places(n)
            yield block.phrases(at[holds(known.value, block.hashes(at, n))], n)

    rows = _pass(blocks, ROW, rows_of).groupBy("lang", "phrase").agg(F.sum("n").alias("a"))
    return rows.join(wanted, ["lang", "phrase"], "left_semi")


# --- scores --------------------------------------------------------------------------------


def _parts(size: Column) -> Column:
    """Array of (k, head, rest): the cuts of ``phrase`` after its first k words."""
    w = F.split("phrase", " ", -1)
    return F.transform(F.sequence(F.lit(1), size - 1), lambda k: F.struct(
        k.alias("k"), F.array_join(F.slice(w, 1, k), " ").alias("head"), F.array_join(F.slice(w, k + 1, size - k), " ").alias("rest")))


def _scored(found: DataFrame, counts: DataFrame, totals: DataFrame, longest: int) -> DataFrame:
    """(lang, phrase, a, l, r, n, score) of the surviving phrases.  ``counts``: (lang, phrase, a) of all their parts."""
    left = found.where((F.col("words") == longest) | ~F.col("bound"))
    cuts = left.select("lang", "phrase", "a", F.explode(_parts(F.col("words"))).alias("c")).select("lang", "phrase", "a", "c.*")
    of = lambda part, name: counts.select("lang", F.col("phrase").alias(part), F.col("a").alias(name))
    cuts = cuts.join(of("head", "l"), ["lang", "head"]).join(of("rest", "r"), ["lang", "rest"]).join(totals, "lang")
    big = lambda c: F.col(c).cast("decimal(38,0)")
    cuts = cuts.select("lang", "phrase", "a", "n", "k", "l", "r", (F.lit(1000).cast("decimal(38,0)") * big("a") * big("n")).alias("top"), (big("l") * big("r")).alias("under"))
    cuts = cuts.withColumn("score", F.expr("top div under").cast("long"))
    got = cuts.groupBy("lang", "phrase").agg(F.first("a").alias("a"), F.first("n").alias("n"), F.min(F.struct("score", "k", "l", "r")).alias("c"))
    return got.select("lang", "phrase", "a", "c.l", "c.r", "n", "c.score")


def _best(scored: DataFrame, most: int) -> DataFrame:
    """``scored`` with ``rank``, its first ``most`` of each language; parts of a language are cut before they meet."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salted = scored.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    salted = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("rank") <= most).drop("salt")
    return salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= most)


def collocations(docs: DataFrame, most: int = 2000, least: int = 100, longest: int = 5, first_share: int = FIRST_SHARE, bits: int = SKETCH_BITS) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of each language's first ``most`` collocations."""
    with block_by_block(docs.sparkSession):  # every pass over the blocks ends in here
        return _collocations(docs, most, least, longest, first_share, bits)


def _collocations(docs: DataFrame, most: int, least: int, longest: int, first_share: int, bits: int) -> DataFrame:
    importable(docs.sparkSession)
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text"))
    blocks = encoded(texts)
    units = F.arrays_zip(F.col("langs").alias("lang"), F.col("words").alias("phrase"), F.col("hashes").alias("h"), F.col("counts").alias("n"))
    every = blocks.select(F.explode(units).alias("u")).select("u.*").groupBy("lang", "phrase", "h").agg(F.sum("n").alias("a"))
    every = written(every, "phrase_words")
    totals = written(every.groupBy("lang").agg(F.sum("a").alias("n")), "phrase_totals")
    words = every.where(F.col("a") >= least)

    # the first wave: words up to the count at which the rarest ones have their share of the occurrences
    level = F.floor(F.log2("a") * 4).cast("int")
    steps = words.groupBy("lang", level.alias("level")).agg(F.sum("a").alias("sum"), F.max("a").alias("top"))  # some 4 log2(a) rows a language
    own = Window.partitionBy("lang")
    so_far = F.sum("sum").over(own.orderBy("level"))
    steps = steps.withColumn("over", (so_far - F.col("sum")) * first_share >= F.sum("sum").over(own))
    high = written(steps.groupBy("lang").agg(F.max(F.when(~F.col("over"), F.col("top"))).alias("high")), "phrase_limits")
    wave = written(words.join(high, "lang").where("a <= high").select("lang", "phrase", "h", "a"), "phrase_wave")
    found, counts, best = None, words.select("lang", "phrase", "a"), None
    for last in (False, True):
        more = _grown(blocks, words, wave, least, longest, bits)
        found = more if found is None else found.unionByName(more)
        counts = counts.unionByName(more.select("lang", "phrase", "a"))
        # languages with too few phrases have no floor yet: if all are such, the scores can wait
        lasting = found.where((F.col("words") == longest) | ~F.col("bound")).groupBy("lang").count()
        if not last and lasting.where(F.col("count") >= most).isEmpty():
            wave = written(words.join(high, "lang").where("a > high").select("lang", "phrase", "h", "a"), "phrase_wave")
            continue
        rests = found.where((F.col("words") > 2) & ((F.col("words") == longest) | ~F.col("bound"))).select("lang", F.explode(_parts(F.col("words"))).alias("c"))
        rests = rests.select("lang", F.col("c.rest").alias("phrase")).distinct().join(counts, ["lang", "phrase"], "left_anti")
        rests = written(rests, "phrase_rests")
        if not rests.isEmpty():
            counts = counts.unionByName(written(_counted(blocks, rests, longest, bits), "phrase_rest_counts"))
        best = written(_best(_scored(found, counts, totals, longest), most), "phrase_best")
        if last:
            break
        floor = best.where(F.col("rank") == most).select("lang", F.col("score").alias("floor"))
        open_ = words.join(high, "lang").where("a > high").join(totals, "lang").join(floor, "lang", "left")
        bound = F.expr("1000 * cast(n as decimal(38,0)) div a")
        wave = written(open_.where(F.col("floor").isNull() | (bound >= F.col("floor"))).select("lang", "phrase", "h", "a"), "phrase_wave")
        if wave.isEmpty():
            break
    return best.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 11 over all documents: phrases of 2 to 5 words, 100 occurrences, the first 2000 of each language."""
    return collocations(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
split AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM split),
totals AS (SELECT lang, count(*) AS n FROM places GROUP BY lang),
grams AS (
  SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase, count(*) AS a
  FROM places, range(1, 6) t(m) WHERE i + m - 1 <= len(w) GROUP BY ALL HAVING count(*) >= 100),
cands AS (SELECT *, string_split(phrase, ' ') AS w FROM grams WHERE m >= 2),
inner_parts AS (
  SELECT DISTINCT c.lang, array_to_string(c.w[s.i:s.i + k.k - 1], ' ') AS phrase, c.a FROM cands c, range(1, 6) s(i), range(2, 5) k(k)
  WHERE k.k < c.m AND s.i + k.k - 1 <= c.m),
left_over AS (SELECT c.* FROM cands c ANTI JOIN inner_parts p ON c.lang = p.lang AND c.phrase = p.phrase AND p.a >= c.a),
cuts AS (
  SELECT c.lang, c.phrase, c.a, t.n, k.k, g.a AS l, h.a AS r, CAST((1000::HUGEINT * c.a * t.n) // (g.a::HUGEINT * h.a) AS BIGINT) AS score
  FROM left_over c JOIN totals t ON c.lang = t.lang JOIN range(1, 5) k(k) ON k.k < c.m
  JOIN grams g ON g.lang = c.lang AND g.phrase = array_to_string(c.w[1:k.k], ' ')
  JOIN grams h ON h.lang = c.lang AND h.phrase = array_to_string(c.w[k.k + 1:], ' ')),
weakest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
placed AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM weakest)
SELECT lang, rank, phrase, a, l, r, n, score FROM placed WHERE rank <= 2000
"""
