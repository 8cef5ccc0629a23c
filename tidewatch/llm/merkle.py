"""Merkle dataset manifest by cogrouped subtree exchange (operator 13).

Every row is a leaf: sha256 over its fields, each written as ``-`` (null) or byte length, colon and
value.  Per source the leaves stand in ascending doc_id order; three consecutive nodes at a time
become their hash until one is left, the subroot; the subroots, by source, become the root likewise.

* ``ranked`` numbers the leaves of each source without a task that holds a source: rows are
  range-partitioned and written once with partition and position; counts per (partition, source)
  give the offsets.  All partition numbers are left to Spark.
* A superblock is ``3 ** levels`` aligned consecutive nodes of one tree.  ``tiers`` reduces each to
  the node above it; the tiers shrink by that factor, and so a few rounds reach the top.
* Downwards, ``paths`` cogroups the nodes of a tier with the path above their superblock (the outer
  nodes that their proofs need).  At the leaves one cogroup (``_finish``) does the rest: the local
  reduction, the proof joined from local and outer siblings, and the fold of the leaf to check.

Superblocks are dealt to cogroups by hash, many to one when they are small, so a hot source is spread
over its superblocks and a million tiny sources share tasks.  A task holds about ``DEALT`` nodes.

Edge cases: a null doc_id comes first in its source; rows equal in source and doc_id stand in the
order of their leaves (equal rows are interchangeable).  Null source is a source of its own.  Null and
empty fields differ (``-`` and ``0:``).  An empty table gives no rows.  Columns other than the five
fields are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewatch.llm.common import importable, table, written

LEVELS = 7  # levels inside a superblock: 3 ** 7 = 2187 nodes
DEALT = 20_000  # nodes of a cogroup, about
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def field(c: Column) -> Column:
    """``-`` for null, else byte length, colon, value (integers decimal)."""
    s = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def leaf_of(text: Column) -> Column:
    return F.sha2(F.concat(*[field(F.col(c)) for c in FIELDS[:-1]], field(text)), 256)


# --- positions ------------------------------------------------------------------------------


def ranked(rows: DataFrame, group: str, order: list[str], kind: str) -> DataFrame:
    """``rows`` with ``at`` (position in its group by ``order``, from 0) and ``n`` (size of the group).

    ``seq`` of the first writing breaks ties, so equal rows spread as well as others do."""
    rows = written(rows.withColumn("seq", F.monotonically_increasing_id()), f"{kind}_rows")
    keys = list(dict.fromkeys([group, *order, "seq"]))
    rows = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("seq")
    rows = written(rows.withColumn("mid", F.monotonically_increasing_id()), f"{kind}_sorted")
    part = F.shiftright("mid", 33)  # the partition that wrote the row
    runs = rows.groupBy(part.alias("part"), group).agg(F.count(F.lit(1)).alias("many"), F.min("mid").alias("first"))
    own = Window.partitionBy(group)  # a row for each partition that holds a piece of the group
    before = F.coalesce(F.sum("many").over(own.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = runs.select(F.col("part").alias("r_part"), F.col(group).alias("r_group"), "first", before.alias("before"), F.sum("many").over(own).alias("n"))
    runs = written(runs, f"{kind}_runs")
    met = rows.join(runs, (part == F.col("r_part")) & F.col(group).eqNullSafe(F.col("r_group")))
    return met.withColumn("at", F.col("mid") - F.col("first") + F.col("before")).drop("mid", "first", "before", "r_part", "r_group")


# --- one superblock ---------------------------------------------------------------------------


def levels_of(nodes: list[str], n: int, levels: int) -> list[list[str]]:
    """The levels of a superblock from its nodes up, in a tier of ``n`` nodes: to the top if that lies inside."""
    out = [nodes]
    while len(out[-1]) > 1 if n <= 3**levels else len(out) <= levels:
        low = out[-1]
        out.append([digest("".join(low[i:i + 3])) for i in range(0, len(low), 3)])
    return out


def path_of(levels: list[list[str]], at: int) -> list[tuple[str, str]]:
    """(left siblings, right siblings) of the node at ``at``, level by level."""
    out = []
    for low in levels[:-1]:
        s = at - at % 3
        out.append(("".join(low[s:at]), "".join(low[at + 1:s + 3])))
        at //= 3
    return out


def packed(path: list[tuple[str, str]]) -> str:
    return "".join(f"{a},{b};" for a, b in path)


def unpacked(text: str) -> list[tuple[str, str]]:
    return [tuple(x.split(",")) for x in text.split(";")[:-1]]


def folded(node: str, path: list[tuple[str, str]], known: dict) -> str:
    for level, (a, b) in enumerate(path):
        key = (level, a, node, b)
        node = known.get(key) or known.setdefault(key, digest(a + node + b))
    return node


def _blocks(pdf: pd.DataFrame, levels: int) -> Iterator[tuple[tuple, pd.DataFrame, list[list[str]]]]:
    """((group, block), rows in order, levels) of each superblock of the frame; a null group is None."""
    pdf = pdf.assign(block=pdf["at"] // 3**levels).sort_values("at")
    for (g, b), x in pdf.groupby(["grp", "block"], dropna=False, sort=False):
        yield (None if pd.isna(g) else g, int(b)), x, levels_of(x["node"].tolist(), int(x["n"].iloc[0]), levels)


# --- up -----------------------------------------------------------------------------------------


def _rise(levels: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out = [(g, b, -(-int(x["n"].iloc[0]) // 3**levels), up[-1][0]) for (g, b), x, up in _blocks(pdf, levels)]
        return pd.DataFrame(out, columns=["grp", "at", "n", "node"])

    return run


def dealt(nodes: DataFrame, tasks: int, block: Column) -> DataFrame:
    return nodes.withColumn("deal", F.pmod(F.xxhash64("grp", block), F.lit(tasks)))


def block(levels: int) -> Column:
    return F.floor(F.col("at") / 3**levels).cast("long")


def tiers(nodes: DataFrame, levels: int, kind: str) -> list[tuple[DataFrame, int]]:
    """(nodes (grp, at, n, node), cogroups to deal them to) of each tier; the last has one node a group.

    A group that is down to one node goes no further."""
    out = []
    while True:
        many, most = nodes.agg(F.count(F.lit(1)), F.max("n")).first()
        tasks = 1 + many // DEALT
        out.append((nodes, tasks))
        if (most or 0) <= 1:
            return out
        more = dealt(nodes.where("n > 1"), tasks, block(levels))
        nodes = written(more.groupBy("deal").applyInPandas(_rise(levels), "grp string, at long, n long, node string"), kind)


def subroots(made: list[tuple[DataFrame, int]]) -> DataFrame:
    """(grp, node) of each group's top."""
    tops = [nodes.where("n = 1").select("grp", "node") for nodes, _ in made]
    out = tops[0]
    for t in tops[1:]:
        out = out.unionByName(t)
    return out


# --- down ---------------------------------------------------------------------------------------


def _descend(levels: int):
    def run(key, nodes: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        above = {(None if pd.isna(g) else g, a): p for g, a, p in zip(outer["grp"], outer["at"], outer["path"])}
        out = []
        for (g, b), x, up in _blocks(nodes, levels):
            out += [(g, a, packed(path_of(up, a - b * 3**levels)) + above[g, b]) for a in x["at"]]
        return pd.DataFrame(out, columns=["grp", "at", "path"])

    return run


def paths(made: list[tuple[DataFrame, int]], top: DataFrame, levels: int, kind: str, first: int = 0) -> DataFrame:
    """(grp, at, path) of the nodes of tier ``first``: siblings up to the root, in levels.

    ``top`` (grp, path) has the path of each group's subroot."""
    known = None
    for nodes, tasks in reversed(made[first:]):
        ends = nodes.where("n = 1").select(F.col("grp").alias("e_grp"), "at")
        got = ends.join(top, F.col("e_grp").eqNullSafe(F.col("grp"))).select("grp", "at", "path")
        if known is not None:
            left = dealt(nodes.where("n > 1"), tasks, block(levels)).groupBy("deal")
            right = dealt(known, tasks, F.col("at")).groupBy("deal")
            got = got.unionByName(left.cogroup(right).applyInPandas(_descend(levels), "grp string, at long, path string"))
        known = written(got, kind)
    return known


def _finish(root: str, levels: int, with_proof: bool):
    def run(key, nodes: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        above = {(None if pd.isna(g) else g, a): (p, s) for g, a, p, s in zip(outer["grp"], outer["at"], outer["path"], outer["subroot"])}
        out = []
        for (g, b), x, up in _blocks(nodes, levels):
            path, subroot = above[g, b]
            upper, known = unpacked(path), {}
            for d, a, leaf, other in zip(x["doc_id"], x["at"], x["node"], x["other"]):
                own = path_of(up, a - b * 3**levels) + upper
                proof = "".join(l + r for l, r in own)
                got = folded(leaf if other is None else other, own, known)
                hexes = [proof[i:i + 64] for i in range(0, len(proof), 64)] if with_proof else None
                out.append((d, g, a, leaf, subroot, root, hexes, digest(proof), got, got == root))
        cols = ["doc_id", "source", "position", "leaf", "subroot", "root", "proof", "proof_sha256", "folded_root", "verified"]
        return pd.DataFrame(out, columns=cols)

    return run


ATTESTED = "doc_id long, source string, position long, leaf string, subroot string, root string, proof array<string>, proof_sha256 string, folded_root string, verified boolean"


def attested(docs: DataFrame, text_to_check: Column | None = None, with_proof: bool = True, levels: int = LEVELS) -> DataFrame:
    """The manifest of ``docs``: position, leaf, subroot, root and proof of every row, and its check.

    ``text_to_check``: the text that stands in the data now (default: the text itself); the leaf that
    it gives is folded with the row's proof, and ``verified`` tells whether that meets the root.
    ``with_proof=False`` leaves the list of siblings out (null); its digest stays."""
    importable(docs.sparkSession)
    leaf, other = leaf_of(F.col("text")), leaf_of(F.col("text") if text_to_check is None else text_to_check)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("grp"), leaf.alias("node"), other.alias("other"))
    rows = rows.withColumn("other", F.when(F.col("other") != F.col("node"), F.col("other")))
    rows = written(ranked(rows, "grp", ["doc_id", "node"], "merkle"), "merkle_leaves")
    made = tiers(rows.select("grp", "at", "n", "node"), levels, "merkle_tier")
    tops = written(subroots(made), "merkle_subroots")

    names = ranked(tops.select(F.lit("").alias("grp"), F.col("grp").alias("source"), "node"), "grp", ["source"], "merkle_top")
    names = written(names, "merkle_sources")
    high = tiers(names.select("grp", "at", "n", "node"), levels, "merkle_top_tier")
    top = subroots(high).first()
    if top is None:
        return docs.sparkSession.createDataFrame([], ATTESTED)
    none = docs.sparkSession.createDataFrame([("", "")], "grp string, path string")
    above = paths(high, none, levels, "merkle_top_path").select(F.col("at").alias("p_at"), "path")
    above = names.join(above, F.col("at") == F.col("p_at")).select(F.col("source").alias("grp"), "path", F.col("node").alias("subroot"))
    above = written(above, "merkle_source_path")

    # the path above every superblock of leaves: through the tiers, or that of the source if it has one superblock
    outer = paths(made, above.select("grp", "path"), levels, "merkle_path", 1) if len(made) > 1 else None
    lone = rows.where("n = 1").select(F.col("grp").alias("l_grp"), "at")
    lone = lone.join(above, F.col("l_grp").eqNullSafe(F.col("grp"))).select("grp", "at", "path")
    outer = lone if outer is None else lone.unionByName(outer)
    own = above.select(F.col("grp").alias("s_grp"), "subroot")
    outer = written(outer.join(own, F.col("grp").eqNullSafe(F.col("s_grp"))).drop("s_grp"), "merkle_outer")
    tasks = made[0][1]
    # as text: pandas would turn a column of long with nulls into floats
    left = dealt(rows.withColumn("doc_id", F.col("doc_id").cast("string")), tasks, block(levels)).groupBy("deal")
    right = dealt(outer, tasks, F.col("at")).groupBy("deal")
    got = left.cogroup(right).applyInPandas(_finish(top["node"], levels, with_proof), ATTESTED.replace("doc_id long", "doc_id string"))
    return got.withColumn("doc_id", F.col("doc_id").cast("long"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 13 over all documents; texts of even crc32(doc_id) have lost their line feeds."""
    text = F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.translate("text", "\n", "")).otherwise(F.col("text"))
    got = attested(table(spark, sf_dir, "documents"), text, with_proof=False)
    return got.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


ORACLE = """
WITH RECURSIVE texts AS (
  SELECT *, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)),
      lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)) AS inv
  FROM documents),
heads AS (
  SELECT doc_id, source, text, CASE WHEN xor(inv, 4294967295) % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS other,
    coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || CAST(doc_id AS VARCHAR), '-') || coalesce(strlen(source) || ':' || source, '-')
    || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || CAST(n_chars AS VARCHAR), '-') AS head
  FROM texts),
hashed AS (
  SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    sha256(head || coalesce(strlen(other) || ':' || other, '-')) AS other FROM heads),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY source) AS n,
    row_number() OVER () AS row_nr FROM hashed),
tree AS (
  SELECT 0 AS lvl, source, pos, n, leaf AS h FROM leaves
  UNION ALL
  SELECT lvl + 1, source, pos // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY pos)) FROM tree WHERE n > 1 GROUP BY lvl, source, pos // 3, n),
tops AS (
  SELECT source, h AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM tree WHERE n = 1),
high AS (
  SELECT 0 AS lvl, pos, n, subroot AS h FROM tops
  UNION ALL
  SELECT lvl + 1, pos // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY pos)) FROM high WHERE n > 1 GROUP BY lvl, pos // 3, n),
steps AS (
  SELECT l.row_nr, t.lvl, coalesce(string_agg(t.h, '' ORDER BY t.pos) FILTER (t.pos < l.pos // CAST(3 ** t.lvl AS BIGINT)), '') AS a,
    coalesce(string_agg(t.h, '' ORDER BY t.pos) FILTER (t.pos > l.pos // CAST(3 ** t.lvl AS BIGINT)), '') AS b
  FROM leaves l JOIN tree t ON l.source IS NOT DISTINCT FROM t.source AND t.n > 1 AND t.pos // 3 = l.pos // CAST(3 ** (t.lvl + 1) AS BIGINT)
  GROUP BY l.row_nr, t.lvl
  UNION ALL
  SELECT l.row_nr, 1000 + t.lvl, coalesce(string_agg(t.h, '' ORDER BY t.pos) FILTER (t.pos < s.pos // CAST(3 ** t.lvl AS BIGINT)), ''),
    coalesce(string_agg(t.h, '' ORDER BY t.pos) FILTER (t.pos > s.pos // CAST(3 ** t.lvl AS BIGINT)), '')
  FROM leaves l JOIN tops s ON l.source IS NOT DISTINCT FROM s.source JOIN high t ON t.n > 1 AND t.pos // 3 = s.pos // CAST(3 ** (t.lvl + 1) AS BIGINT)
  GROUP BY l.row_nr, t.lvl),
ways AS (
  SELECT row_nr, list({'a': a, 'b': b} ORDER BY lvl) AS way, string_agg(a || b, '' ORDER BY lvl) AS siblings FROM steps GROUP BY row_nr),
ends AS (
  SELECT l.doc_id, l.leaf, s.subroot, (SELECT h FROM high WHERE n = 1) AS root, sha256(coalesce(w.siblings, '')) AS proof_sha256,
    list_reduce(list_prepend({'a': l.other, 'b': ''}, coalesce(w.way, [])), lambda x, y: {'a': sha256(y.a || x.a || y.b), 'b': ''}).a AS folded_root
  FROM leaves l JOIN tops s ON l.source IS NOT DISTINCT FROM s.source LEFT JOIN ways w USING (row_nr))
SELECT *, folded_root = root AS verified FROM ends
"""
