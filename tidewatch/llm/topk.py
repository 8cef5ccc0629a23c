"""Exact top-k inner products by a pivot-distance index (operator 4).

Vectors are lifted by one component, sqrt(M^2 - |v|^2) with M the largest norm, queries by 0; then
|q - v|^2 = |q|^2 + M^2 - 2 q.v, so the highest inner products are the nearest lifted vectors.
Each vector is keyed by its nearest pivot and its distance to it; a pivot's rings (annuli of equal
width) are the index's blocks.  For a query q at distance d from a pivot, a ring [lo, hi] holds no
vector nearer than max(d - hi, lo - d, 0).  A query first searches the block of the least bound that
holds enough vectors, which gives its k-th best score; it then searches, in a second round, all
blocks whose bound does not exceed that score's distance, in order of the bound, and drops those
that the growing k-th score rules out.  Inner products are exact integers.

Pivots are a bounded sample (at most ``PIVOTS``); every vector is indexed and every result exact.
Queries meet the blocks by shuffle, not by broadcast.  Large blocks are cut into chunks by hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm.common import importable, table, written

PIVOTS = 64
RINGS = 16
CHUNK = 4096  # vectors of a block that one task row group holds, on average
SCALE = 256
K = 5
SLACK = 1e-6  # of M, for distances in floating point

HIT = "query_id long, vec_id long, score long"


def quantised(vectors: DataFrame) -> DataFrame:
    """(vec_id, q) with q = floor(256 x) of every component; null or non-finite vectors and null ids are left out.

    Equal rows count once."""
    x = F.col("embedding").cast("array<double>")
    sound = F.col("vec_id").isNotNull() & F.coalesce(F.forall(x, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) != float("inf")), F.lit(False))), F.lit(False))
    rows = vectors.where(sound & (F.size("embedding") > 0)).select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(x, lambda c: F.floor(c * SCALE).cast("long")).alias("q"))
    return rows.dropDuplicates(["vec_id", "q"])


def _matrix(col, dim: int) -> np.ndarray:
    out = np.zeros((len(col), dim), np.int64)
    for i, v in enumerate(col):
        out[i, :len(v)] = v
    return out


def _product(a: np.ndarray, b: np.ndarray, exact: bool) -> np.ndarray:
    """a b^T; in floating point where every product sum is below 2^53, and so exact."""
    return (a.astype(np.float64) @ b.T.astype(np.float64)).round().astype(np.int64) if exact else a @ b.T


class Space:
    """Dimension, largest norm and lifted pivots."""

    def __init__(self, dim: int, m2: int, pivots: np.ndarray):
        self.dim, self.m2, self.m = dim, m2, float(np.sqrt(m2))
        self.exact = m2 < 1 << 52
        self.pivots = self.lifted(pivots)
        self.width = max(2 * self.m / RINGS, 1e-9)

    def lifted(self, q: np.ndarray) -> np.ndarray:
        n2 = (q.astype(np.float64) ** 2).sum(axis=1)
        return np.hstack([q.astype(np.float64), np.sqrt(np.maximum(self.m2 - n2, 0.0))[:, None]])

    def distances(self, x: np.ndarray) -> np.ndarray:
        """Of lifted rows to the pivots."""
        d2 = (x**2).sum(axis=1)[:, None] + (self.pivots**2).sum(axis=1)[None] - 2 * x @ self.pivots.T
        return np.sqrt(np.maximum(d2, 0.0))

    def query(self, q: np.ndarray) -> np.ndarray:
        return np.hstack([q.astype(np.float64), np.zeros((len(q), 1))])

    def score_at(self, q: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """The highest score that a vector at a distance of at least the bound can have."""
        n2 = (q.astype(np.float64) ** 2).sum(axis=1)[:, None]
        return (n2 + self.m2 - np.maximum(bound - SLACK * max(self.m, 1.0), 0.0) ** 2) / 2.0


def space_of(rows: DataFrame, pivots: int = PIVOTS) -> Space | None:
    norm = F.aggregate("q", F.lit(0).cast("long"), lambda s, c: s + c * c)
    dim, m2, n = rows.agg(F.max(F.size("q")), F.max(norm), F.count(F.lit(1))).first()
    if not n:
        return None
    picked = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(max(1, min(pivots, int(n**0.5)))).collect()  # at most PIVOTS rows
    return Space(dim, m2, np.unique(_matrix([r["q"] for r in picked], dim), axis=0))


def index_of(rows: DataFrame, space: Space, n: int) -> DataFrame:
    """(cell, ring, chunk, dist, vec_id, q) of every vector, written by block."""
    chunks = 1 + n // (max(1, len(space.pivots)) * CHUNK)
    shared = rows.sparkSession.sparkContext.broadcast(space)

    def keyed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        s = shared.value
        for pdf in frames:
            if len(pdf):
                d = s.distances(s.lifted(_matrix(pdf["q"], s.dim)))
                cell = d.argmin(axis=1)
                near = d[np.arange(len(d)), cell]
                yield pd.DataFrame({"cell": cell, "ring": (near / s.width).astype(int), "dist": near, "vec_id": pdf["vec_id"], "q": pdf["q"]})

    got = rows.mapInPandas(keyed, "cell int, ring int, dist double, vec_id long, q array<long>")
    return written(got.withColumn("chunk", F.pmod(F.xxhash64("vec_id"), F.lit(chunks)).cast("int")), "pivot_index")


def _best(score: np.ndarray, ids: np.ndarray, own: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray]]:
    for i, row in enumerate(score):
        ok = ids != own[i]
        s, v = row[ok], ids[ok]
        if len(s) > 4 * k:
            near = s >= np.partition(s, len(s) - k)[len(s) - k]
            s, v = s[near], v[near]
        o = np.lexsort((v, -s))[:k]
        yield i, np.stack([v[o], s[o]], axis=1)


def searched(asked: DataFrame, index: DataFrame, space: Space, k: int) -> DataFrame:
    """The k best of each (query, block chunk) asked for: (query_id, vec_id, score)."""
    shared = index.sparkSession.sparkContext.broadcast(space)

    def run(own: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        s, out = shared.value, []
        if len(own) and len(block):
            ids, vecs = block["vec_id"].to_numpy(np.int64), _matrix(block["q"], s.dim)
            for at in range(0, len(own), 512):
                part = own.iloc[at:at + 512]
                query = part["vec_id"].to_numpy(np.int64)
                score = _product(_matrix(part["q"], s.dim), vecs, s.exact)
                least = part["least"].to_numpy(float)
                for i, found in _best(score, ids, query, k):
                    found = found[found[:, 1] >= least[i]]
                    out.append(np.column_stack([np.full(len(found), query[i]), found]))
        got = np.concatenate(out) if out else np.zeros((0, 3), np.int64)
        return pd.DataFrame(got, columns=["query_id", "vec_id", "score"])

    return asked.groupBy("cell", "ring", "chunk").cogroup(index.groupBy("cell", "ring", "chunk")).applyInPandas(run, HIT)


def top_of(hits: DataFrame, k: int) -> DataFrame:
    """The k best hits of each query, by partial aggregation: (query_id, best)."""
    best = F.slice(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("s"), "vec_id"))), 1, k)
    return hits.groupBy("query_id").agg(best.alias("best"))


def exact_top_k(vectors: DataFrame, is_query, k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k highest integer inner products of every query row.

    Vectors that are null, empty, or hold a null or non-finite component, and rows without an id,
    take no part; a shorter vector counts as padded with zeros; rows equal in id and vector count
    once; no row of a query's own id is its result.  Ties go to the smaller vec_id."""
    spark = vectors.sparkSession
    importable(spark)
    rows = written(quantised(vectors), "vectors")
    space = space_of(rows)
    if space is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    n = rows.count()
    index = index_of(rows, space, n)
    blocks = index.groupBy("cell", "ring").agg(F.min("dist").alias("lo"), F.max("dist").alias("hi"), F.count(F.lit(1)).alias("n")).toPandas()  # at most PIVOTS x RINGS rows
    blocks = blocks.sort_values(["cell", "ring"]).reset_index(drop=True)
    shared = spark.sparkContext.broadcast((space, blocks))
    chunks = F.explode(F.sequence(F.lit(0), F.lit(n // (max(1, len(space.pivots)) * CHUNK))))
    asked_type = "vec_id long, q array<long>, least double, cell int, ring int"

    def bounds(q: np.ndarray) -> np.ndarray:
        """The highest score possible in each block, for each query."""
        s, b = shared.value
        d = s.distances(s.query(q))[:, b["cell"].to_numpy(int)]
        return s.score_at(q, np.maximum(np.maximum(d - b["hi"].to_numpy(float), b["lo"].to_numpy(float) - d), 0.0))

    def first(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        s, b = shared.value
        for pdf in frames:
            if len(pdf):
                high = bounds(_matrix(pdf["q"], s.dim))
                high[:, (b["n"].to_numpy() <= k)] -= 2.0 * s.m2 + 1.0  # small blocks last
                at = high.argmax(axis=1)
                yield pdf[["vec_id", "q"]].assign(least=-np.inf, cell=b["cell"].to_numpy()[at], ring=b["ring"].to_numpy()[at], at=0)[["vec_id", "q", "least", "cell", "ring"]]

    def later(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        s, b = shared.value
        cell, ring = b["cell"].to_numpy(), b["ring"].to_numpy()
        for pdf in frames:
            if not len(pdf):
                continue
            q = _matrix(pdf["q"], s.dim)
            high = bounds(q)
            least = np.array([float(-x[-1]["s"]) if x is not None and len(x) >= k else -np.inf for x in pdf["best"]])
            need = high >= least[:, None]
            need &= ~((cell[None] == pdf["cell"].to_numpy()[:, None]) & (ring[None] == pdf["ring"].to_numpy()[:, None]))
            i, j = np.nonzero(need)
            yield pd.DataFrame({"vec_id": pdf["vec_id"].to_numpy()[i], "q": pdf["q"].to_numpy()[i], "least": least[i], "cell": cell[j], "ring": ring[j]})

    queries = rows.where(is_query)
    begun = written(queries.mapInPandas(first, asked_type), "first_blocks")
    hits = written(searched(begun.withColumn("chunk", chunks), index, space, k), "first_hits")
    known = begun.join(top_of(hits, k).withColumnRenamed("query_id", "vec_id"), "vec_id", "left").select("vec_id", "q", "cell", "ring", "best")
    rest = known.mapInPandas(later, asked_type).withColumn("chunk", chunks)
    best = top_of(hits.unionByName(searched(rest, index, space, k)).distinct(), k)
    return best.select("query_id", F.posexplode("best").alias("p", "b")).select("query_id", (F.col("p") + 1).cast("int").alias("rank"), F.col("b.vec_id").alias("vec_id"), (-F.col("b.s")).alias("score"))


def op4_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 4: the rows whose vec_id is divisible by 50 against all rows of ``embeddings``, five each."""
    return exact_top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, K)


ORACLE = """WITH v AS (SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(embedding) > 0),
s AS (SELECT a.vec_id AS query_id, b.vec_id, list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM
 (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5"""
