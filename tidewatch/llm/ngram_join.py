"""N-gram Jaccard join: size-aware heavy-light similarity join (operator 1).

A document's set holds the 64-bit hashes of its distinct word n-grams.  Equal sets form a class;
classes are joined.  With similarity t, two sets of sizes n <= m need an overlap of at least
ceil(t m) >= ceil(t n), so in any common order of n-grams two linked sets share at least c members
among the first n - ceil(t n) + c of each.  The order puts n-grams that recur within blocks of the
input last, by their count (an approximate document frequency; any order is right, this one keeps
lists short), and the rest by hash.

* Small sets enumerate all 2-subsets of their prefix (c = 2); sets that share one meet.
* Large sets are found by inverted lists of their prefix (c = 1); small sets within a factor t of
  the boundary enter the lists too, for pairs of a small and a large set.
* The boundary between small and large minimises the estimated cost: subsets enumerated against
  list entries times the expected list length.

A list of at most ``SHORT_LIST`` sets gives its pairs, which are kept only if enough of their list
entries agree; a longer one is joined inside tasks and gives one edge from each set that is kept, and one beyond
``HOT_LIST`` sets an edge from each set to its smallest.  So the rows stay linear
in the list entries.  A pair of either kind is kept only if the parity bitmaps of its sets (a bit or two for each
member) leave room for a link: each bit in which they differ stands for a member that only one of them has.  So chance pairs
that share a common n-gram don't grow into clusters of most sets, whose prefixes each of many tasks would need.  Entries are shuffled once; keys that a block of entries holds very often are
folded to one entry of the block before that.  The edges' components are candidate clusters: every linked pair lies in one.  Tasks count the clusters' common prefix members and keep the sets whose prefixes
leave room for a link with another; the clusters that are left are joined exactly, by counting
overlaps through their own inverted lists, on texts read again.  Clusters beyond a task's bound are
dealt as pairs of blocks.  Tasks
return stars and link counts, never pairs.  Components of the stars are the result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from fractions import Fraction
from math import ceil

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewatch.llm.common import give_back, mix64, small_batches, split_words, table, texts_of, written
from tidewatch.llm.components import components

HEAVY_MOST = 300_000  # n-grams whose counts go to all tasks: 5 MB
BLOCK_BYTES = 16 << 20  # text among which an n-gram must recur to count as frequent
SET_BYTES = 4 << 20  # text whose sets are made at a time; the work arrays take some ten times that
SHORT_LIST = 32  # lists up to this length are paired one by one
LEAST_BITS, MOST_BITS = 256, 1 << 16  # of a set's bitmap
BLOCK_ENTRIES = 1 << 20  # list entries among which hot keys are folded before the shuffle
TASK_SETS = 4000  # sets joined in one task
HOT_LIST = 4 * TASK_SETS  # lists up to this length are joined by bitmaps, at most 8 times the rows of the list
TASK_GRAMS = 4_000_000  # n-grams joined in one task
BROADCAST_REPS = 1_000_000  # doc_ids that go to all tasks to pick the texts joined exactly
GROUP_SETS = 1000  # sets of small clusters that share a task, on average


def gram_sets(texts: pa.Array, words: int) -> list[np.ndarray]:
    """Sorted distinct n-gram hashes of each text; fewer words than n: the whole sequence as one."""
    codes, uniq, off = split_words(pc.ascii_lower(texts))
    w = pd.util.hash_array(np.array(uniq.to_pylist(), dtype=object)) if len(uniq) else np.zeros(0, np.uint64)
    h = mix64(w)[codes]
    n = np.diff(off)
    chain = np.full(max(0, len(h) - words + 1), words, np.uint64)
    for k in range(words):
        chain = mix64(chain * np.uint64(0x9E3779B97F4A7C15) + h[k:len(h) - words + 1 + k]) if len(chain) else chain
    out = []
    for i, s in enumerate(off[:-1]):
        if n[i] >= words:
            out.append(np.unique(chain[s:s + n[i] - words + 1]))
        elif n[i]:
            one = np.array([n[i]], np.uint64)
            for x in h[s:s + n[i]]:
                one = mix64(one * np.uint64(0x9E3779B97F4A7C15) + x)
            out.append(one)
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def least_overlap(n: int, t: Fraction) -> int:
    return ceil(t * n)


def prefix_length(n: int, t: Fraction, c: int) -> int:
    return min(n, n - least_overlap(n, t) + c)


def can_link(n: int, t: Fraction) -> bool:
    """Whether a set of n members can reach t with any different set."""
    return n > 0 and Fraction(n, n + 1) >= t


def bitmap(s: np.ndarray) -> bytes:
    """The parity of the number of members at each bit; a power of two of bits, for each member one up to MOST_BITS.

    Its halves' xor is the bitmap of half as many bits."""
    size = min(MOST_BITS, max(LEAST_BITS, 1 << (len(s) - 1).bit_length()))
    odd = np.bincount((s & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def folded(bits: np.ndarray, words: int) -> np.ndarray:
    """Bitmaps (a row of 64-bit words each) with fewer words."""
    while bits.shape[-1] > words:
        half = bits.shape[-1] // 2
        bits = bits[..., :half] ^ bits[..., half:]
    return bits


def leaves_room(differ: np.ndarray, n: np.ndarray, m: np.ndarray, t: Fraction) -> np.ndarray:
    """Whether sets of n and m members whose bitmaps differ in so many bits can link."""
    most = np.minimum((n + m - differ) // 2, np.minimum(n, m))
    return most * t.denominator >= t.numerator * (n + m - most)


# --- pass 1: frequent n-grams, sets' prefixes ---------------------------------------------


def _recurring(words: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches, "text", BLOCK_BYTES):
            own = pa.RecordBatch.from_arrays([texts_of(b).unique()], names=["text"])
            every = np.concatenate([np.zeros(0, np.uint64), *(s for x in small_batches([own], "text", SET_BYTES) for s in gram_sets(x.column("text"), words))])
            every.sort()
            same = np.concatenate([[False], every[1:] == every[:-1], [False]])  # as the one before
            first, last = (np.flatnonzero(x) for x in (~same[:-1] & same[1:], same[:-1] & ~same[1:]))  # of those that recur
            yield pa.RecordBatch.from_arrays([pa.array(every[first].view(np.int64)), pa.array(last - first + 1)], names=["gram", "n"])
        give_back()

    return run


def frequent(docs: DataFrame, words: int) -> tuple[np.ndarray, np.ndarray]:
    """(n-grams, counts), sorted, at most HEAVY_MOST: those that recur within blocks the most."""
    from tidewatch.llm.common import importable

    importable(docs.sparkSession)
    rows = docs.select("text").mapInArrow(_recurring(words), "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    rows = written(rows, "frequent")
    sizes = rows.groupBy(F.floor(F.log2("n")).cast("int").alias("level")).count().collect()  # at most 64 rows
    level, room = 64, HEAVY_MOST
    for r in sorted(sizes, reverse=True):
        if r["count"] > room:
            break
        level, room = r["level"], room - r["count"]
    got = rows.where(F.col("n") >= F.lit(float(2**level))).toPandas()
    gram = got["gram"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(gram)
    return gram[order], got["n"].to_numpy(np.int64)[order]


def ordered(s: np.ndarray, most: int, gram: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The first ``most`` members of a sorted set in the common order."""
    if not len(gram) or not len(s):
        return s[:most]
    at = np.minimum(np.searchsorted(gram, s), len(gram) - 1)
    n = np.where(gram[at] == s, count[at], 0)
    return s[:most] if not n.any() else s[np.lexsort((s, n))[:most]]


def sets_of(docs: DataFrame, words: int, t: Fraction, heavy) -> DataFrame:
    """(doc_id, t64, n, class, prefix, bits) of every row; the class is a 128-bit digest of the set."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram, count = heavy.value
        for b in small_batches(batches, "text", SET_BYTES):
            sets = gram_sets(texts_of(b), words)
            digest = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
            pre = [ordered(s, prefix_length(len(s), t, 2), gram, count).tobytes() if can_link(len(s), t) else b"" for s in sets]
            bits = [bitmap(s) if can_link(len(s), t) else b"" for s in sets]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("t64"), pa.array([len(s) for s in sets], pa.int64()), pa.array(digest, pa.binary()), pa.array(pre, pa.binary()), pa.array(bits, pa.binary())], names=["doc_id", "t64", "n", "class", "prefix", "bits"])
        give_back()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("t64"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, t64 long, n long, class binary, prefix binary, bits binary")


# --- candidates ---------------------------------------------------------------------------


def boundary(sizes: dict[int, int], t: Fraction, list_length: float) -> int:
    """The largest size treated as small, of least estimated cost."""

    def cost(x: int) -> float:
        total = 0.0
        for n, k in sizes.items():
            p1, p2 = prefix_length(n, t, 1), prefix_length(n, t, 2)
            if n <= x:
                total += k * p2 * (p2 - 1) / 2
            if n >= least_overlap(x + 1, t):
                total += k * p1 * list_length
        return total

    return min([0, *(2**i for i in range(3, 13))], key=lambda x: (cost(x), x))


def keys_of(n: int, prefix: np.ndarray, t: Fraction, small: int) -> tuple[np.ndarray, np.ndarray]:
    """The keys a set is found by: (2-subsets of its prefix, members of its prefix)."""
    subsets = members = prefix[:0]
    if n <= small and least_overlap(n, t) >= 2:
        i, j = np.triu_indices(len(prefix), 1)
        lo, hi = np.minimum(prefix[i], prefix[j]), np.maximum(prefix[i], prefix[j])
        subsets = mix64(mix64(lo) * np.uint64(0x9E3779B97F4A7C15) + hi + np.uint64(2))
    if n >= least_overlap(small + 1, t) or least_overlap(n, t) < 2:
        members = prefix[:prefix_length(n, t, 1)]
    return subsets, members


def entries_of(classes: DataFrame, t: Fraction, small: int) -> DataFrame:
    """(key, uid, n, first, many) of every list entry; n is negative in the lists of 2-subsets.

    Sets of one block of entries that hold a key more than ``SHORT_LIST`` times give one entry, of the
    smallest uid, that stands for ``many``, and an edge to it from each other one (``first``, else
    null).  So a key that very many sets hold sends at most SHORT_LIST entries of a block to its list."""

    most, bound = SHORT_LIST, BLOCK_ENTRIES

    def block(rows: list[tuple[int, int, np.ndarray]]) -> pa.RecordBatch:
        keys, uids, ns = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for uid, n, prefix in rows:
            for k, m in zip(keys_of(n, prefix, t, small), (-n, n)):
                keys.append(k)
                uids.append(np.full(len(k), uid, np.int64))
                ns.append(np.full(len(k), m, np.int64))
        key, uid, n = np.concatenate(keys), np.concatenate(uids), np.concatenate(ns)
        order = np.lexsort((uid, key))
        key, uid, n = key[order], uid[order], n[order]
        head = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, int)
        size = np.diff(np.append(head, len(key)))
        many = np.ones(len(key), np.int64)
        first, edge = np.zeros(len(key), np.int64), np.zeros(len(key), bool)
        for h, c in zip(head[size > most].tolist(), size[size > most].tolist()):
            many[h] = c
            first[h + 1:h + c], edge[h + 1:h + c] = uid[h], True
        cols = [pa.array(key.view(np.int64)), pa.array(uid), pa.array(n), pa.array(first, mask=~edge), pa.array(many)]
        return pa.RecordBatch.from_arrays(cols, names=["key", "uid", "n", "first", "many"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, entries = [], 0
        for b in small_batches(batches, "prefix", 1 << 20):
            for uid, n, p in zip(*(b.column(c).to_pylist() for c in ("uid", "n", "prefix"))):
                rows.append((uid, n, np.frombuffer(p, "<u8")))
                c = len(rows[-1][2])
                entries += c + (c * (c - 1) // 2 if n <= small else 0)
                if entries >= bound:
                    yield block(rows)
                    rows, entries = [], 0
        if rows:
            yield block(rows)

    return classes.select("uid", "n", "prefix").mapInArrow(run, "key long, uid long, n long, first long, many long")


def lists_of(entries: DataFrame) -> DataFrame:
    """(key, total, least, first, u) of the keys that several sets hold, after one shuffle of the entries.

    A list of at most SHORT_LIST sets is one row with all its sets in ``u``, its key null; each entry of a longer one,
    and each edge of ``entries_of``, is a row of its own, so no long list is gathered."""
    own = Window.partitionBy("key", "first")
    found = entries.withColumn("total", F.sum("many").over(own)).withColumn("least", F.min("uid").over(own)).where(F.col("first").isNotNull() | (F.col("total") > 1))
    apart = F.when(F.col("first").isNotNull() | (F.col("total") > SHORT_LIST), F.col("uid"))
    rows = found.groupBy("key", "first", "total", "least", apart.alias("apart")).agg(F.collect_list(F.struct("uid", "n")).alias("u"))
    return rows.select(F.when(F.col("apart").isNotNull(), F.col("key")).alias("key"), "total", "least", "first", "u")


def candidate_edges(classes: DataFrame, t: Fraction, small: int) -> DataFrame:
    """Edges (a, b) whose components hold every linked pair, linear in the number of list entries.

    Lists of at most SHORT_LIST sets give their pairs, and a pair is kept if its common list
    entries, with what longer lists and the members behind both prefixes may add, leave room for a
    link (a common 2-subset always does) and their bitmaps do.  A longer list gives the edges of ``_listed``, one beyond
    HOT_LIST one edge of each set to its smallest one, directly or by way of the smallest of its block."""
    lists = written(lists_of(entries_of(classes, t, small)), "lists")
    apart = F.col("first").isNotNull() | (F.col("total") > SHORT_LIST)
    short = lists.where(~apart).groupBy(F.sort_array("u").alias("u")).agg(F.count(F.lit(1)).alias("keys"))  # copies share many lists
    pairs = F.flatten(F.transform("u", lambda x, i: F.transform(F.slice("u", i + 2, SHORT_LIST), lambda y: F.struct(x["uid"].alias("b"), y["uid"].alias("a"), x["n"].alias("nb"), y["n"].alias("na")))))
    pairs = short.select("keys", F.explode(pairs).alias("p")).groupBy("p.a", "p.b").agg(F.sum(F.when(F.col("p.na") > 0, F.col("keys")).otherwise(0)).alias("both"), F.max(F.abs("p.na")).alias("na"), F.max(F.abs("p.nb")).alias("nb"), F.bool_or(F.col("p.na") < 0).alias("sure"))
    every = lists.where(apart).select("key", F.col("u")[0]["uid"].alias("uid"), F.abs(F.col("u")[0]["n"]).alias("n"), F.coalesce("first", "least").alias("first"))
    long = every.where("uid <> first")
    first = long.groupBy(F.col("first").alias("uid")).count()  # at least the lists that it begins
    more = long.groupBy("uid").count().unionByName(first).groupBy("uid").agg(F.sum("count").alias("more"))
    more_of = lambda c: more.select(F.col("uid").alias(c), F.col("more").alias(f"more_{c}"))
    pairs = pairs.join(more_of("a"), "a", "left").join(more_of("b"), "b", "left")
    num, den = t.numerator, t.denominator
    need = lambda n: F.ceil(F.lit(num) * n / F.lit(den))  # noqa: E731  at most what least_overlap says, see below
    behind = lambda n: need(n) - 1  # noqa: E731  members behind the first n - need + 1
    most = F.col("both") + F.least(F.coalesce("more_a", F.lit(0)), F.coalesce("more_b", F.lit(0))) + F.greatest(behind(F.col("na")), behind(F.col("nb"))) + 1  # one more: division is in floating point
    most = F.least(most, "na", "nb")
    room = most * F.lit(den) >= F.lit(num) * (F.col("na") + F.col("nb") - most)
    near = pairs.where(F.col("sure") | room).select("a", "b", "na", "nb")
    bits = classes.select("uid", "bits")
    for c in "ab":
        near = near.join(bits.select(F.col("uid").alias(c), F.col("bits").alias(f"bits_{c}")), c)
    near = near.mapInPandas(_roomy(t), "a long, b long")
    hot = written(every.groupBy("key").count().where(F.col("count") > HOT_LIST).select("key"), "hot_lists")
    hot_edges = long.join(hot, "key", "left_semi").select(F.col("uid").alias("a"), F.col("first").alias("b"))
    warm = every.join(hot, "key", "left_anti").select("uid", "n", F.col("key").alias("cluster"))
    dealt = with_deal(warm).join(bits, "uid").withColumn("d", F.explode("deal")).select("d.*", "cluster", "uid", "n", "bits")
    warm_edges = dealt.groupBy("c", "i", "j").applyInPandas(_listed(t), "a long, b long")
    return near.unionByName(hot_edges).unionByName(warm_edges)


def _roomy(t: Fraction):
    """The pairs whose bitmaps leave room for a link."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            for _, own in pdf.groupby([pdf["bits_a"].str.len(), pdf["bits_b"].str.len()]):
                a, b = (np.frombuffer(b"".join(own[c]), "<u8").reshape(len(own), -1) for c in ("bits_a", "bits_b"))
                words = min(a.shape[1], b.shape[1])
                differ = np.bitwise_count(folded(a, words) ^ folded(b, words)).sum(axis=1, dtype=np.int64)
                yield own.loc[leaves_room(differ, own["na"].to_numpy(np.int64), own["nb"].to_numpy(np.int64), t), ["a", "b"]]

    return run


def _listed(t: Fraction):
    """Edges (a, b) from each set to the smallest one that it reaches by pairs of its list whose bitmaps leave room for a link."""

    def edges(uid: np.ndarray, n: np.ndarray, side: np.ndarray, bits: list[bytes]) -> np.ndarray:
        root = np.arange(len(uid))
        words = np.array([len(x) // 8 for x in bits])
        sizes = [(w, np.flatnonzero(words == w)) for w in np.unique(words)]
        rows = {w: np.frombuffer(b"".join(bits[k] for k in at), "<u8").reshape(len(at), w) for w, at in sizes}
        for w, at in sizes:
            for v, to in sizes:
                if v > w or n[to].max() * t.denominator < n[at].min() * t.numerator:
                    continue
                own, other = folded(rows[w], v), rows[v]
                for k, x in enumerate(at):
                    differ = np.bitwise_count(other ^ own[k]).sum(axis=1, dtype=np.int64)
                    ok = leaves_room(differ, n[to], n[x], t) & ((side[to] != side[x]) | (side[x] == 2)) & (to != x)
                    if ok.any():
                        met = np.union1d(root[to[ok]], root[x])
                        if len(met) > 1:
                            root[np.isin(root, met)] = met[0]
        return root

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        found = [np.zeros((0, 2), np.int64)]
        for _, own in pdf.sort_values("uid").groupby("cluster"):
            uid = own["uid"].to_numpy(np.int64)
            root = edges(uid, own["n"].to_numpy(np.int64), own["side"].to_numpy(), own["bits"].tolist())
            found.append(np.stack([uid, uid[root]], axis=1)[root != np.arange(len(uid))])
        return pd.DataFrame(np.concatenate(found), columns=["a", "b"])

    return run


# --- joins inside tasks -------------------------------------------------------------------


def joined(sets: list[np.ndarray], weight: np.ndarray, side: np.ndarray, may_link) -> tuple[np.ndarray, np.ndarray]:
    """(smallest index reached, weighted number of links) of each set, by counting overlaps.

    ``may_link(x, others, overlaps)`` says which of the others, all before x, link with x.
    ``side``: 0 and 1 pair only across, 2 pairs with its like."""
    n = np.array([len(s) for s in sets], np.int64)
    owner = np.repeat(np.arange(len(sets)), n)
    every = np.concatenate(sets)
    order = np.argsort(every, kind="stable")
    token = np.concatenate([[0], np.cumsum(every[order][1:] != every[order][:-1])])
    post = owner[order]  # sets of each token, ascending
    head = np.append(np.flatnonzero(np.diff(token, prepend=-1)), len(post))
    of = np.empty(len(every), np.int64)
    of[order] = token
    at = np.concatenate([[0], np.cumsum(n)])
    root, links = np.arange(len(sets)), np.zeros(len(sets), np.int64)

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for x in range(1, len(sets)):
        own = of[at[x]:at[x + 1]]
        s, e = head[own], head[own + 1]
        some = e - s > 1
        if not some.any():
            continue
        s, e = s[some], e[some]
        size = e - s
        idx = np.repeat(s - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        both = np.bincount(post[idx], minlength=len(sets))[:x]
        cand = np.flatnonzero(both)
        ok = may_link(x, cand, both[cand]) & ((side[cand] != side[x]) | (side[x] == 2))
        for y in cand[ok].tolist():
            links[x] += weight[y]
            links[y] += weight[x]
            a, b = find(x), find(y)
            if a != b:
                root[max(a, b)] = min(a, b)
    return np.array([find(i) for i in range(len(sets))]), links


def _bounded(t: Fraction):
    """Pairs whose prefixes leave room for a link.

    Up to the smaller of the two last prefix members all common members are counted; beyond it
    that set has only its members behind the prefix."""
    num, den = t.numerator, t.denominator

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("uid")
        pre = [np.frombuffer(x, "<u8") for x in pdf["payload"]]
        n, uid = pdf["n"].to_numpy(np.int64), pdf["uid"].to_numpy(np.int64)
        behind = n - np.array([len(x) for x in pre])

        def may_link(x, y, both):
            most = np.minimum(both + np.maximum(behind[x], behind[y]), np.minimum(n[x], n[y]))
            return most * den >= num * (n[x] + n[y] - most)

        root, links = joined(pre, np.ones(len(n), np.int64), pdf["side"].to_numpy(), may_link)
        return pd.DataFrame({"uid": uid, "root": uid[root], "links": links})[links > 0]

    return run


def _exact(words: int, t: Fraction):
    num, den = t.numerator, t.denominator

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        sets = gram_sets(pa.array(pdf["payload"].tolist(), pa.string()), words)
        # one text of each class: a doc_id that names several texts brings them all
        own = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() == c for s, c in zip(sets, pdf["class"])]
        pdf = pdf.assign(k=np.arange(len(pdf)))[own].drop_duplicates("uid").sort_values("uid")
        if not len(pdf):
            return pd.DataFrame({c: np.zeros(0, np.int64) for c in ("uid", "root", "links")})
        sets, uid = [sets[k] for k in pdf["k"]], pdf["uid"].to_numpy(np.int64)
        n = np.array([len(s) for s in sets], np.int64)
        may_link = lambda x, y, both: both * den >= num * (n[x] + n[y] - both)
        root, links = joined(sets, pdf["size"].to_numpy(np.int64), pdf["side"].to_numpy(), may_link)
        return pd.DataFrame({"uid": uid, "root": uid[root], "links": links})

    return run


def with_deal(chosen: DataFrame) -> DataFrame:
    """``chosen`` (uid, n, cluster, ...) with ``deal``: the tasks (c, i, j, side) that each set goes to.

    Small clusters share tasks; a cluster beyond a task's bound is cut into blocks by hash and
    every pair of blocks is a task."""
    total = chosen.groupBy("cluster").agg(F.count(F.lit(1)).alias("sets"), F.sum("n").alias("grams"))
    blocks = F.when((F.col("sets") > TASK_SETS) | (F.col("grams") > TASK_GRAMS), F.greatest(F.ceil(2 * F.col("sets") / TASK_SETS), F.ceil(2 * F.col("grams") / TASK_GRAMS))).otherwise(F.lit(1))
    total = written(total.select("cluster", blocks.cast("int").alias("blocks"), "sets"), "cluster_sizes")
    groups = 1 + (total.where("blocks = 1").agg(F.sum("sets")).first()[0] or 0) // GROUP_SETS
    own = F.pmod(F.xxhash64("uid"), F.col("blocks")).cast("int")
    alone = F.struct((-1 - F.pmod(F.xxhash64("cluster"), F.lit(groups))).alias("c"), F.lit(0).alias("i"), F.lit(0).alias("j"), F.lit(2).alias("side"))
    pair = lambda o: F.struct(F.col("cluster").alias("c"), F.least(o, F.col("own")).alias("i"), F.greatest(o, F.col("own")).alias("j"),
                              F.when(o == F.col("own"), 2).when(o > F.col("own"), 0).otherwise(1).alias("side"))
    deal = F.when(F.col("blocks") == 1, F.array(alone)).otherwise(F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), pair))
    return chosen.join(total.select("cluster", "blocks"), "cluster").withColumn("own", own).withColumn("deal", deal).drop("own", "blocks")


def stars_of(dealt: DataFrame, run) -> DataFrame:
    """(uid, root, links) of the tasks' joins over (deal, uid, n, size, class, payload)."""
    rows = dealt.withColumn("d", F.explode("deal")).select("d.*", "uid", "n", "size", "class", "payload")
    return written(rows.groupBy("c", "i", "j").applyInPandas(run, "uid long, root long, links long"), "stars")


def wanted(texts: DataFrame, chosen: DataFrame) -> DataFrame:
    """The rows of ``texts`` whose doc_id is a ``rep`` of ``chosen``: the others aren't shuffled while the reps can be broadcast."""
    reps = chosen.select("rep").distinct()
    return texts.join(F.broadcast(reps), F.col("doc_id").eqNullSafe(F.col("rep")), "left_semi") if reps.count() <= BROADCAST_REPS else texts


def clusters_of(edges: DataFrame) -> DataFrame:
    return written(components(edges).select(F.col("node").alias("uid"), F.col("root").alias("cluster")), "clusters")


def similar_documents(docs: DataFrame, words: int = 5, similarity: str = "0.8") -> DataFrame:
    """(doc_id, t64, n_shingles, component, component_id, n_links) of every row.

    ``component`` names the component, ``component_id`` is its smallest doc_id, ``n_links`` counts
    the other rows that this one links with.  Null and empty texts and texts of white space have an
    empty set, link with nothing and stand alone (component null, component_id their own doc_id).
    Repeated rows link with each other.  A null doc_id never names a component unless all are null.
    Other columns are not read.  ``t64`` is a hash of the text, to tell rows of one doc_id apart."""
    t = Fraction(similarity)
    spark = docs.sparkSession
    heavy = spark.sparkContext.broadcast(frequent(docs, words))
    member = written(sets_of(docs, words, t, heavy), "sets")
    some = member.where("n > 0")
    classes = some.groupBy("class").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("size"), F.first("n").alias("n"), F.first("prefix").alias("prefix"), F.first("bits").alias("bits"))
    classes = written(classes.withColumn("uid", F.monotonically_increasing_id()), "classes")

    able = classes.where(F.length("prefix") > 0)
    step = F.pow(F.lit(1.2), F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(1.2)))).cast("long")
    sizes = {int(r[0]): int(r[1]) for r in able.groupBy(step.alias("s")).count().collect()}  # a row for each fifth of growth
    gram, count = heavy.value
    list_length = 1.0 + float(count.sum()) / max(1.0, float(sum(n * k for n, k in sizes.items())))
    small = boundary(sizes, t, list_length)

    met = candidate_edges(able, t, small)
    base = classes.select("uid", "n", "size", "class", F.col("prefix").alias("payload"))
    near = stars_of(with_deal(base.join(clusters_of(met), "uid")), _bounded(t))
    chosen = classes.select("uid", "n", "size", "class", "rep").join(clusters_of(near.select(F.col("uid").alias("a"), F.col("root").alias("b"))), "uid")
    chosen = with_deal(chosen).drop("cluster")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("payload"))
    chosen = written(chosen, "chosen")
    stars = stars_of(wanted(texts, chosen).join(chosen, F.col("doc_id").eqNullSafe(F.col("rep"))), _exact(words, t))
    root = components(stars.select(F.col("uid").alias("a"), F.col("root").alias("b")))
    links = stars.groupBy("uid").agg(F.sum("links").alias("links"))

    named = classes.select("uid", "class", "rep", "size").join(root.withColumnRenamed("node", "uid"), "uid", "left").join(links, "uid", "left")
    named = written(named.select("class", "rep", F.coalesce("root", "uid").alias("component"), (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links")), "named")
    least = named.groupBy("component").agg(F.min("rep").alias("component_id"))
    got = member.select("doc_id", "t64", "n", "class").join(named.join(least, "component").drop("rep"), "class", "left")
    none = F.col("n") == 0
    return got.select("doc_id", "t64", F.col("n").alias("n_shingles"), F.when(~none, F.col("component")).alias("component"),
                      F.when(none, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"), F.when(none, F.lit(0)).otherwise(F.col("n_links")).cast("long").alias("n_links"))


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 1 over all documents: 4-word shingles, Jaccard similarity of 85 hundredths or more."""
    return similar_documents(table(spark, sf_dir, "documents"), 4, "0.85").select("doc_id", "n_shingles", "component_id", "n_links")
