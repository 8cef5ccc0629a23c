"""Sampling and splits: M1 (stratified sample), M2 (stratified split), M3 (hash split).

The per-chunk samples of the source are concatenated (U2); here one draw over all rows replaces
them, or one draw per chunk if a chunk key is given.

All draws are *hash-ordered*: a row's pseudo-random position is md5(key ':' seed), so the
result is identical under any partitioning, re-execution after executor loss, or another
engine (the SQL oracle reproduces it).

The k-th row of a class is found by selection, not by ranking: counts of the upper half of the
32-bit hash show which bucket holds the cut, counts of the lower half inside that bucket show the
hash, and the keys of that hash the key.  Each step is an aggregate with at most 65,536 rows a class,
over the class and key columns alone.  The wide rows are then only filtered against the cut of their
class; they are not sorted, shuffled or written.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.operators.correlate import rank_within_group
from tidewatch.session import handed_off

MAX_BROADCAST_CLASSES = 1_000_000


def hash_key(key: Column | str, seed: int = 42) -> Column:
    """First 32 bits of md5(key ':' seed) as a non-negative bigint."""
    k = F.col(key) if isinstance(key, str) else key
    h = F.md5(F.concat(k.cast("string"), F.lit(f":{seed}")))
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("bigint")


def _with_cuts(rows: DataFrame, cuts: DataFrame, groups: list[str], how: str) -> DataFrame:
    """``rows`` with the cut of their class (a row a class; broadcast after a look at their number)."""
    cuts = cuts.select(*[F.col(g).alias(f"__c_{g}") for g in groups], *[c for c in cuts.columns if c not in groups])
    same = reduce(lambda x, y: x & y, [F.col(g).eqNullSafe(F.col(f"__c_{g}")) for g in groups])
    cuts = F.broadcast(cuts) if cuts.count() <= MAX_BROADCAST_CLASSES else cuts
    return rows.join(cuts, same, how).drop(*[f"__c_{g}" for g in groups])


def _holding(counts: DataFrame, groups: list[str], by: str) -> DataFrame:
    """Of counts (groups, ``by``, __n, __want) the row of each class in which its wanted rank lies; ``__want``
    becomes the rank inside that row."""
    before = F.sum("__n").over(Window.partitionBy(*groups).orderBy(F.col(by).asc_nulls_first())) - F.col("__n")
    placed = counts.withColumn("__before", before)
    placed = placed.filter((F.col("__before") < F.col("__want")) & (F.col("__want") <= F.col("__before") + F.col("__n")))
    return placed.withColumn("__want", F.col("__want") - F.col("__before")).drop("__before")


def class_cuts(df: DataFrame, groups: list[str], key: str, seed: int, size) -> DataFrame:
    """(groups, __h, __k, __want, __n): the row at rank ``size(n)`` of each class of n rows, in (hash, key) order.

    ``__n`` rows have that hash and key; ``__want`` of them belong to the draw.  A class of size 0 has no row."""
    rows = df.select(*groups, F.coalesce(hash_key(key, seed), F.lit(-1)).alias("__h"), F.col(key).alias("__k"))
    high = rows.groupBy(*groups, F.shiftright("__h", 16).alias("__high")).agg(F.count(F.lit(1)).alias("__n"))
    high = high.withColumn("__want", size(F.sum("__n").over(Window.partitionBy(*groups))))
    cut = handed_off(_holding(high, groups, "__high").drop("__n"), "cuts")
    near = _with_cuts(rows, cut, groups, "inner").filter(F.shiftright("__h", 16) == F.col("__high"))
    low = near.groupBy(*groups, "__h", "__want").agg(F.count(F.lit(1)).alias("__n"))
    cut = handed_off(_holding(low, groups, "__h").drop("__n").withColumnRenamed("__h", "__at"), "cuts")
    near = _with_cuts(rows, cut, groups, "inner").filter(F.col("__h") == F.col("__at"))
    last = near.groupBy(*groups, "__h", "__k", "__want").agg(F.count(F.lit(1)).alias("__n"))
    return handed_off(_holding(last, groups, "__k"), "cuts")


def _drawn(df: DataFrame, groups: list[str], key: str, seed: int, size) -> DataFrame:
    """``df`` with ``__drawn``: whether a row is among the first ``size(n)`` of its class.

    Rows that share the key at a cut, of which only some belong to the draw, are told apart by a rank among
    themselves; with unique keys there are none."""
    cuts = class_cuts(df, groups, key, seed, size)
    marked = _with_cuts(df.withColumn("__own", F.coalesce(hash_key(key, seed), F.lit(-1))), cuts, groups, "left")
    at = (F.col("__own") == F.col("__h")) & F.col(key).eqNullSafe(F.col("__k"))
    below = (F.col("__own") < F.col("__h")) | ((F.col("__own") == F.col("__h")) & ((F.col(key) < F.col("__k")) | (F.col(key).isNull() & F.col("__k").isNotNull())))
    work = ["__own", "__h", "__k", "__want", "__n"]
    if cuts.filter("__want < __n").isEmpty():
        return marked.withColumn("__drawn", F.coalesce(below | at, F.lit(False))).drop(*work)
    tied = F.coalesce(at & (F.col("__want") < F.col("__n")), F.lit(False))
    clear = marked.filter(~tied).withColumn("__drawn", F.coalesce(below | at, F.lit(False)))
    ranked = rank_within_group(marked.filter(tied).withColumn("__grp_of", F.struct(*groups)), "__grp_of", ["__own"], "__rank", MAX_BROADCAST_CLASSES)
    ranked = ranked.withColumn("__drawn", F.col("__rank") <= F.col("__want")).drop("__rank", "_n", "__grp_of")
    return clear.unionByName(ranked).drop(*work)


def stratified_sample(df: DataFrame, cls: str, key: str, fraction: float = 0.1, seed: int = 42, chunk: str | None = None) -> DataFrame:
    """M1: per class exactly max(1, floor(fraction·n)) rows, without replacement; with ``chunk`` (a column)
    per class and chunk, as the source draws from each piece of its file."""
    size = lambda n: F.greatest(F.lit(1), F.floor(n * F.lit(fraction)))
    return _drawn(df, [cls] + ([chunk] if chunk else []), key, seed, size).filter("__drawn").drop("__drawn")


def stratified_split(df: DataFrame, cls: str, key: str, test_fraction: float = 0.2, seed: int = 42) -> DataFrame:
    """M2: adds ``is_test``: per class the floor(test_fraction·n) lowest-hash rows."""
    return _drawn(df, [cls], key, seed, lambda n: F.floor(n * F.lit(test_fraction))).withColumnRenamed("__drawn", "is_test")


def hash_split(df: DataFrame, key: str, test_percent: int = 20, seed: int = 42) -> DataFrame:
    """M3: adds ``is_test`` = hash(key) mod 100 < test_percent (stable, shuffle-free)."""
    return df.withColumn("is_test", (hash_key(key, seed) % 100) < F.lit(test_percent))
