"""Random forest on blocks of binned rows (ML4), for inputs on which Spark's own takes too long.

The method is that of Spark's forest: ordered bins for each feature, a Poisson(1) draw of the rows and a random
subset of ceil(sqrt(features)) for each node of each tree, the split of largest Gini gain, a depth cap, and leaves of one
parent that say the same merged.  Every row takes part in every level of every tree.  Spark handles a row and
tree at a time, through maps and trees of objects; here a task holds a block of rows by feature, one byte a
value, and handles a block and tree at a time.  Features of one value, which no node can split by, are left
out of the blocks, though not of the draws.  Candidate thresholds come from all rows.

A level is one pass: rows walk down their trees (nothing is kept between levels), a task adds up its
histograms of at most ``HISTOGRAM_MB`` at a time, and a group for each tree sums them and picks the splits.
The draws are those of (seed, block, tree), so tasks that run again give the same; they aren't Spark's draws.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, sqrt

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.session import handed_off, package_for_workers, scratch_path

BLOCK_ROWS = 131_072
HISTOGRAM_MB = 256  # of one task at a time
DEEPEST = 12  # trees are arrays of 2^depth nodes
MOST_BINS = 256

NODES = ("treeID int, nodeData struct<id:int,prediction:double,impurity:double,impurityStats:array<double>,rawCount:bigint,gain:double,"
         "leftChild:int,rightChild:int,split:struct<featureIndex:int,leftCategoriesOrThreshold:array<double>,numCategories:int>>")


def _poisson() -> np.ndarray:
    """Poisson(1) of each 16-bit number."""
    p, below, out = np.exp(-1.0), 0.0, []
    for k in range(12):
        below += p
        p /= k + 1
        out.append(below * 65536)
    return np.searchsorted(np.array(out), np.arange(65536), side="right").astype(np.uint8)


def split_points(df: DataFrame, features: list[str], max_bins: int) -> list[np.ndarray]:
    """Ascending thresholds of each feature, at most ``max_bins`` - 1: between all its values, or quantiles of all rows."""
    cells = [F.col(f"`{c}`").cast("double") for c in features]
    about = df.agg(*[F.approx_count_distinct(c) for c in cells]).first()
    few = [k for k, n in enumerate(about) if n <= 2 * max_bins]
    many = [k for k in range(len(cells)) if k not in few]
    share = [k / max_bins for k in range(1, max_bins)]
    wanted = [F.collect_set(cells[k]) for k in few] + [F.percentile_approx(cells[k], share, 10_000) for k in many]
    got = dict(zip(few + many, df.agg(*wanted).first() if wanted else ()))
    points = []
    for k in range(len(cells)):
        v = np.unique(np.array(got[k] or [], float))
        v = v[~np.isnan(v)]
        if k in few and len(v) <= max_bins:
            with np.errstate(invalid="ignore"):
                middle = v[:-1] + (v[1:] - v[:-1]) / 2
            points.append(np.where(np.isfinite(middle), middle, v[:-1]))
        else:
            points.append(v if len(v) < max_bins else v[np.linspace(0, len(v) - 1, max_bins - 1).astype(int)])
    return points


def blocks_of(df: DataFrame, label: str, features: list[str], points: list[np.ndarray], weight: str | None) -> DataFrame:
    """(block, n, bins, y, w) of up to BLOCK_ROWS rows each: bins by feature, classes, weights (empty without)."""
    names = [f"f{k}" for k in range(len(features))]

    def block(own: pd.DataFrame, number: int) -> pd.DataFrame:
        bins = [np.searchsorted(p, own[c].to_numpy(float), side="left").astype(np.uint8).tobytes() for c, p in zip(names, points)]
        w = own["w"].to_numpy(float).tobytes() if weight else b""
        return pd.DataFrame({"block": [number], "n": [len(own)], "bins": [b"".join(bins)], "y": [own["y"].to_numpy().astype("<u2").tobytes()], "w": [w]})

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, rows, number = [], 0, TaskContext.get().partitionId() << 32
        for pdf in frames:
            held.append(pdf)
            rows += len(pdf)
            if rows >= BLOCK_ROWS:
                yield block(pd.concat(held), number)
                held, rows, number = [], 0, number + 1
        if rows:
            yield block(pd.concat(held), number)

    cols = [F.col(f"`{c}`").cast("double").alias(n) for c, n in zip(features, names)]
    rows = df.select(F.col(label).cast("int").alias("y"), *cols, *([F.col(weight).cast("double").alias("w")] if weight else []))
    found = rows.mapInPandas(run, "block long, n int, bins binary, y binary, w binary")
    return handed_off(found.repartition(2 * df.sparkSession.sparkContext.defaultParallelism, "block"), "forest_blocks")


class _Level:
    """What tasks need of a level: for each tree the splits above it, and slots for the features of its nodes.

    A slot holds the histogram of one feature at one node; a node's slots follow one another."""

    def __init__(self, depth: int, width: int, classes: int, bins: int, seed: int):
        self.depth, self.width, self.classes, self.bins, self.seed = depth, width, classes, bins, seed
        self.trees: dict[int, dict] = {}

    def add(self, tree: int, by: np.ndarray, at: np.ndarray, nodes: list[int], subsets: list[list[int]]) -> None:
        first = 1 << self.depth
        start, count, by_slot, node_of = np.full(first, -1, np.int64), np.zeros(first, np.uint8), [], []
        for node, own in zip(nodes, subsets):
            start[node - first], count[node - first] = len(by_slot), len(own)
            by_slot += own
            node_of += [node] * len(own)
        self.trees[tree] = {"by": np.where(by[:first] < 0, 0, by[:first]).astype(np.int64), "at": np.where(by[:first] < 0, 255, at[:first]).astype(np.uint8),
                            "start": start, "count": count, "slot": np.array(by_slot, np.int64), "node": np.array(node_of, np.int32)}

    def size(self, tree: int) -> int:
        """Numbers in the tree's histograms, with the classes of all its rows at the end."""
        return len(self.trees[tree]["slot"]) * self.bins * self.classes + self.classes

    def only(self, trees: list[int]) -> _Level:
        part = _Level(self.depth, self.width, self.classes, self.bins, self.seed)
        part.trees = {k: self.trees[k] for k in trees}
        return part

    def histograms(self, frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cells, drawn = self.bins * self.classes, _poisson()
        total = {k: np.zeros(self.size(k)) for k in self.trees}
        for pdf in frames:
            for r in pdf.itertuples(index=False):
                n = int(r.n)
                x = np.frombuffer(r.bins, np.uint8)
                y = np.frombuffer(r.y, "<u2").astype(np.int32)
                cell = (x.reshape(self.width, n).astype(np.int32) * self.classes + y).ravel()
                weight = np.frombuffer(r.w, "<f8") if len(r.w) else None
                for k, tree in self.trees.items():
                    self._add(total[k], tree, k, int(r.block), n, x, y, cell, weight, cells, drawn)
        for k, found in total.items():
            yield pd.DataFrame({"tree": [k], "found": [found.tobytes()]})

    def _add(self, total, tree, number, block, n, x, y, cell, weight, cells, drawn) -> None:
        times = drawn[np.random.Generator(np.random.SFC64([self.seed, block, number])).integers(0, 65536, n, dtype=np.uint16)]
        rows = np.flatnonzero(times)
        node = np.ones(len(rows), np.int64)  # 64 bits, or each lookup would convert
        by = tree["by"] * n
        for _ in range(self.depth):
            cell_of = by.take(node)
            cell_of += rows
            right = x.take(cell_of) > tree["at"].take(node)
            node += node
            node += right
        node -= 1 << self.depth
        slot = tree["start"].take(node)
        some = np.flatnonzero(slot >= 0)
        if len(some) < len(rows):
            rows, slot, node = rows.take(some), slot.take(some), node.take(some)
        count = tree["count"].take(node)
        w = times.take(rows).astype(float)
        if weight is not None:
            w *= weight.take(rows)
        if not self.depth:  # at the root also where it has no feature to split by
            all_rows = np.flatnonzero(times)
            total[-self.classes:] += np.bincount(y[all_rows], times[all_rows] * (1.0 if weight is None else weight[all_rows]), self.classes)
        of = tree["slot"] * n
        for j in range(int(tree["count"].max(initial=0))):
            if j:
                own = np.flatnonzero(count > j)
                rows, slot, count, w = rows.take(own), slot.take(own), count.take(own), w.take(own)
            s = slot + j
            at = of.take(s)
            at += rows
            s *= cells
            s += cell.take(at)
            total[:-self.classes] += np.bincount(s, w, len(total) - self.classes)

    def chooser(self):
        return lambda pdf: self.splits(pdf)  # Spark counts the arguments of a bound method with ``self``

    def splits(self, pdf: pd.DataFrame) -> pd.DataFrame:
        """The best split of each node of a tree that gains; for the root also a row (node 0) of its classes in ``low``."""
        tree = int(pdf["tree"].iloc[0])
        slot, node = self.trees[tree]["slot"], self.trees[tree]["node"]
        total = sum(np.frombuffer(v, "<f8") for v in pdf["found"])
        out = [(tree, 0, -1, -1, -1.0, total[-self.classes:].tolist(), [])] if not self.depth else []
        if len(slot):
            h = total[:-self.classes].reshape(len(slot), self.bins, self.classes)
            low = h.cumsum(axis=1)
            every = low[:, -1:]
            low = low[:, :-1]
            high = every - low
            wl, wr = low.sum(axis=2), high.sum(axis=2)
            gain = gini(every) - (wl * gini(low) + wr * gini(high)) / np.where(wl + wr > 0, wl + wr, 1.0)
            gain[(wl <= 0) | (wr <= 0)] = -1.0
            at = gain.argmax(axis=1)
            best = gain[np.arange(len(slot)), at]
            for s, e in zip(*_runs(node)):
                k = s + int(best[s:e].argmax())
                if best[k] > 0:
                    out.append((tree, int(node[k]), int(slot[k]), int(at[k]), float(best[k]), low[k, at[k]].tolist(), high[k, at[k]].tolist()))
        return pd.DataFrame(out, columns=["tree", "node", "feature", "bin", "gain", "low", "high"])


def _runs(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    head = np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]]))
    return head, np.append(head[1:], len(x))


def gini(stats: np.ndarray) -> np.ndarray:
    n = stats.sum(axis=-1)
    return np.where(n > 0, 1.0 - (stats**2).sum(axis=-1) / np.where(n > 0, n, 1.0) ** 2, 0.0)


def grow(blocks: DataFrame, points: list[np.ndarray], usable: list[int], classes: int, num_trees: int, max_depth: int, seed: int) -> list[dict]:
    """The trees, each a dict of its nodes by number (root 1, children 2k and 2k + 1): (classes, gain, feature, threshold)."""
    width, subset = len(usable), ceil(sqrt(len(points)))
    bins = max([len(points[f]) + 1 for f in usable], default=1)
    place = {f: k for k, f in enumerate(usable)}
    by, at = np.full((num_trees, 1 << max_depth), -1, np.int32), np.zeros((num_trees, 1 << max_depth), np.uint8)
    trees: list[dict] = [{} for _ in range(num_trees)]
    active = [[1] for _ in range(num_trees)]
    tasks = blocks.sparkSession.sparkContext.defaultParallelism
    blocks = blocks.coalesce(tasks) if blocks.rdd.getNumPartitions() > 2 * tasks else blocks  # each task sends all histograms
    for depth in range(max_depth):
        level = _Level(depth, width, classes, bins, seed)
        for k in range(num_trees):
            drawn = [[place[f] for f in np.random.default_rng([seed, k, x]).permutation(len(points))[:subset].tolist() if f in place] for x in active[k]]
            some = [(x, own) for x, own in zip(active[k], drawn) if own]
            if some or not depth:
                level.add(k, by[k], at[k], [x for x, _ in some], [own for _, own in some])
        active = [[] for _ in range(num_trees)]
        groups, room = [], 0
        for k in level.trees:
            if not groups or level.size(k) * 8 > room:
                groups.append([])
                room = HISTOGRAM_MB << 20
            groups[-1].append(k)
            room -= level.size(k) * 8
        for own in groups:
            part = level.only(own)
            found = blocks.mapInPandas(part.histograms, "tree int, found binary").groupBy("tree").applyInPandas(
                part.chooser(), "tree int, node int, feature int, bin int, gain double, low array<double>, high array<double>")
            for r in found.collect():  # at most a row for each node of the level
                if not r.node:
                    trees[r.tree][1] = (r.low, None, None, None)
                    continue
                f = usable[r.feature]
                by[r.tree, r.node], at[r.tree, r.node] = r.feature, r.bin
                trees[r.tree][r.node] = (trees[r.tree][r.node][0], r.gain, f, float(points[f][r.bin]))
                for child, stats in ((2 * r.node, r.low), (2 * r.node + 1, r.high)):
                    trees[r.tree][child] = (stats, None, None, None)
                    if gini(np.array(stats)) > 0:
                        active[r.tree].append(child)
        active = [sorted(x) for x in active]
        if not any(active):
            break
    return trees


def node_rows(number: int, tree: dict) -> list[tuple]:
    """The tree's nodes in the order and form in which Spark saves them; sibling leaves that say the same are merged."""
    rows: list = []

    def put(k: int) -> int | None:
        """The class a leaf says, or None."""
        stats, gain, feature, threshold = tree[k]
        own, says = len(rows), int(np.argmax(stats))
        rows.append(None)
        children = []
        if feature is not None:
            children = [(len(rows), put(2 * k)), (len(rows), put(2 * k + 1))]
            if children[0][1] is not None and children[0][1] == children[1][1]:
                del rows[own + 1:]
                says, children = children[0][1], []
        split = (feature, [threshold], -1) if children else (-1, [], -1)
        ids = [c for c, _ in children] or [-1, -1]
        rows[own] = (number, (own, float(says), float(gini(np.array(stats))), [float(x) for x in stats], round(sum(stats)), float(gain) if children else -1.0, *ids, split))
        return None if children else says

    put(1)
    return rows


def fitted(df: DataFrame, rf: RandomForestClassifier, features: list[str], classes: int, seed: int, weight: str | None) -> RandomForestClassificationModel:
    """The model of ``rf``'s settings over ``df`` (its label column indexed, the features still columns)."""
    spark: SparkSession = df.sparkSession
    package_for_workers(spark)
    points = split_points(df, features, rf.getMaxBins())
    usable = [k for k, p in enumerate(points) if len(p)]
    blocks = blocks_of(df, rf.getLabelCol(), [features[k] for k in usable], [points[k] for k in usable], weight)
    trees = grow(blocks, points, usable, classes, rf.getNumTrees(), rf.getMaxDepth(), seed)
    # Spark saves a model of these settings, made of one row a class; its nodes are then written anew
    cols = [rf.getLabelCol(), rf.getFeaturesCol(), *([weight] if weight else [])]
    shell = rf.fit(spark.createDataFrame([(float(k), Vectors.dense([0.0] * len(features)), 1.0)[:len(cols)] for k in range(classes)], cols))
    path = scratch_path(spark, "forest")
    shell.write().overwrite().save(path)
    rows = [r for k, tree in enumerate(trees) for r in node_rows(k, tree)]
    spark.createDataFrame(rows, NODES).coalesce(1).write.mode("overwrite").parquet(f"{path}/data")
    return RandomForestClassificationModel.load(path)
