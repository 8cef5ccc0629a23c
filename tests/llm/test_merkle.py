"""Merkle manifest against a plain one-process version."""

import zlib
from hashlib import sha256

from pyspark.sql import functions as F

from tidewatch.llm import merkle


def h(s):
    return sha256(s.encode()).hexdigest()


def leaf(r, text):
    vals = [r.doc_id, r.source, r.lang, r.n_chars, text]
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in vals))


def climb(nodes):
    """(root, path of each node) of a list of nodes."""
    where, paths = list(range(len(nodes))), [[] for _ in nodes]
    while len(nodes) > 1:
        for i, w in enumerate(where):
            s = w // 3 * 3
            paths[i].append((nodes[s:w], nodes[w + 1:s + 3]))
            where[i] = w // 3
        nodes = [h("".join(nodes[i:i + 3])) for i in range(0, len(nodes), 3)]
    return nodes[0], paths


def brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r.source, []).append(r)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        groups[s].sort(key=lambda r: (r.doc_id is not None, r.doc_id or 0, leaf(r, r.text)))
        trees[s] = climb([leaf(r, r.text) for r in groups[s]])
    root, above = climb([trees[s][0] for s in order])
    out = []
    for s, up in zip(order, above):
        sub, paths = trees[s]
        for r, own in zip(groups[s], paths):
            bent = r.text is not None and r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 2 == 0
            node = leaf(r, r.text.replace("\n", "") if bent else r.text)
            for a, b in own + up:
                node = h("".join(a) + node + "".join(b))
            out.append((r.doc_id, leaf(r, r.text), sub, root, h("".join("".join(a + b) for a, b in own + up)), node, node == root))
    return sorted(out, key=str)


def checked(docs, **more):
    text = F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.translate("text", "\n", "")).otherwise(F.col("text"))
    got = merkle.attested(docs, text, **more).select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    return sorted((tuple(r) for r in got.collect()), key=str)


def test_odd_documents(odd_documents):
    assert checked(odd_documents) == brute(odd_documents.collect())


def test_empty_table_and_one_row(no_documents, odd_documents):
    assert merkle.attested(no_documents).count() == 0
    one = odd_documents.where("doc_id = 9")
    got = merkle.attested(one).first()
    assert got.leaf == got.subroot == got.root == got.folded_root and got.proof == [] and got.proof_sha256 == h("") and got.verified


def test_many_superblocks(spark, monkeypatch):
    monkeypatch.setattr(merkle, "DEALT", 50)  # read on the driver only
    docs = spark.range(1500).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("zeile\nnr "), F.col("id")).alias("text"), F.lit(None).cast("string").alias("lang"),
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.concat(F.lit("é"), F.col("id") % 40)).when(F.col("id") % 7 > 1, F.concat(F.lit("z"), F.col("id") % 333)).alias("source"), (F.col("id") % 5).alias("n_chars"))
    docs = docs.unionByName(docs.where("doc_id % 10 = 3"))  # repeated rows
    assert checked(docs, levels=2) == brute(docs.collect())  # superblocks of nine: four tiers


def test_proof_alone_leads_to_the_root(odd_documents):
    """A reader with a row, its position and its proof list needs nothing else."""
    rows = merkle.attested(odd_documents).collect()
    assert len({r.root for r in rows}) == 1 and all(r.verified for r in rows)
    assert all(r.proof_sha256 == h("".join(r.proof)) for r in rows)
