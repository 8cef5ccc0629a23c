"""Personal data by candidate gradient boosting (operator 5).

Two layers.  The base finds e-mail addresses, IP addresses, card numbers and phone numbers by fixed
patterns and checks; its spans always stand.  High-recall generators also propose overlapping spans:
obfuscated addresses (every run of their mailbox and domain parts around an "at"), digit runs with up
to three separators between digits, and every window of a run's groups of at most 19 digits.  Boosted
trees (Spark ML) judge each proposal by its format and its surroundings; a span is added where the
probability passes its kind's calibrated threshold and it overlaps no span taken before.

The trees are fitted on the proposals of three quarters of the documents and calibrated on those of the
others.  Work on one text grows linearly with its length.  A proposal is positive if it is a base span.  As clean rows hold few
disguised data, each positive also gives disguised copies (other separators, " at ", no plus sign;
positive) and damaged ones (a digit changed, a group lost; negative) in the same surroundings.
Thresholds are the lowest that keep ``PRECISION`` on documents held out of the fit.  Detection
covers every document; the fitted trees (some hundred nodes) go to the tasks.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewatch.llm.common import small_batches, table, texts_of, written

KINDS = ["email", "ip", "card", "phone"]
# The base patterns, written so that a search takes linear time: an address is looked for from its
# "@", a number from the start of a digit run (one that fails there fails within the run too), without backtracking.
BASE = {
    "email": re.compile(r"@[A-Za-z0-9-]++(\.[A-Za-z0-9-]++)++"),
    "ip": re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])++"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}
STEPS = 4096  # parts of the probabilities that are summed before they are looked into
PRECISION = 0.99
TREES, TREE_DEPTH = 10, 4
AROUND = 24  # characters of surroundings
LOCAL, DOMAIN = 64, 255  # characters of an address before and after the "@", by the mail standard
DIGITS = 19  # of the longest number, a card's

AT = re.compile(r"@|\((?i:at)\)|\[(?i:at)\]|(?<= )(?i:at)(?= )")
MAILBOX = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOT = r"\((?i:dot)\)|\[(?i:dot)\]|(?<= )(?i:dot)(?= )"
DOT_BEFORE = re.compile(rf" ?(?:{_DOT}) ?$")  # at most 7 characters, and one that it looks at
HOST = re.compile(r" ?[A-Za-z0-9-]+")
LABEL = re.compile(rf" ?(?:\.|{_DOT}) ?[A-Za-z0-9-]+")
DIGIT_RUN = re.compile(r"[+(]{0,2}[0-9](?:[\x20().:/_-]{0,3}[0-9])+")
GROUP = re.compile(r"[+(]*[0-9]+\)?")
DIGIT = re.compile(r"[0-9]")
CUES = {
    "email": re.compile(r"mail|contact|write|courriel|correo", re.I),
    "ip": re.compile(r"\bip\b|host|server|addr", re.I),
    "card": re.compile(r"card|visa|master|amex|karte|carte|tarjeta", re.I),
    "phone": re.compile(r"phone|tel|call|fax|mobile|ruf|appel|llam", re.I),
}

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def passes(kind: str, found: str) -> bool:
    """The check behind each base pattern."""
    if kind == "ip":
        return all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or "0") <= 255 for x in found.split("."))
    if kind in ("card", "phone"):
        digits = "".join(DIGIT.findall(found))
        return 14 <= len(digits) <= 19 and luhn(digits) if kind == "card" else 10 <= len(digits) <= 15
    return True


def found_spans(kind: str, text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping matches of a base pattern; linear in the text."""
    last = 0
    for m in BASE[kind].finditer(text):
        s = m.start()
        if kind == "email":  # the mailbox run before the "@", as far as the match or "@" before it
            before = text[max(last, text.rfind("@", last, s) + 1):s]
            s = len(before.rstrip(MAILBOX)) + s - len(before)
        if kind != "email" or s < m.start():
            yield s, m.end()
            last = m.end()


def base_spans(text: str) -> list[Span]:
    """Base spans by start, then by kind as listed."""
    out = []
    digits = DIGIT.search(text) is not None
    for k, kind in enumerate(KINDS):
        if "@" in text if kind == "email" else digits and ("." in text if kind == "ip" else "+" in text if kind == "phone" else True):
            out += [(s, k, e) for s, e in found_spans(kind, text) if passes(kind, text[s:e])]
    return [(KINDS[k], s, e) for s, k, e in sorted(out)]


def addresses(text: str) -> Iterator[Span]:
    """Written out or plain addresses around every "at": each start of a mailbox part with each end of a domain part.

    Parts beyond ``LOCAL`` and ``DOMAIN`` characters, dots counted as one, belong to no address."""
    for at in AT.finditer(text):
        end = HOST.match(text, at.end(), at.end() + DOMAIN + 2)
        label = end and LABEL.match(text, end.end(), end.end() + DOMAIN)
        if not label:
            continue
        starts, s, size = [], at.start() - (text[at.start() - 1:at.start()] == " "), 0
        while True:
            e = s
            before = text[max(0, e - LOCAL - 1):e]
            s = e - len(before) + len(before.rstrip(MAILBOX))
            size += e - s + (size > 0)
            if s == e or size > LOCAL:
                break
            starts.append(s)
            dot = DOT_BEFORE.search(text[max(0, s - 8):s])
            if not dot:
                break
            s -= len(dot.group())
        size = end.end() - at.end()
        while label and starts:
            size += 1 + len(label.group().split(".")[-1].split()[-1].split(")")[-1].split("]")[-1])
            if size > DOMAIN:
                break
            yield from (("email", s, label.end()) for s in starts)
            label = LABEL.match(text, label.end(), label.end() + DOMAIN)


def proposals(text: str) -> list[Span]:
    """Spans, overlapping ones among them, that might be personal data."""
    out: set[Span] = set(addresses(text))
    if DIGIT.search(text):
        for run in DIGIT_RUN.finditer(text):
            if run.end() - run.start() < 7:
                continue
            groups = [(run.start() + g.start(), run.start() + g.end(), sum(c.isdigit() for c in g.group())) for g in GROUP.finditer(run.group())]
            for i in range(len(groups)):
                s, n = groups[i][0], 0
                for j in range(i, len(groups)):
                    e, n = groups[j][1], n + groups[j][2]
                    if n > DIGITS:
                        break
                    out |= {("card", s, e)} if n >= 13 else set()
                    out |= {("phone", s, e)} if 9 <= n <= 15 else set()
                    out |= {("ip", s, e)} if j - i == 3 and n <= 12 else set()
    return sorted(out, key=lambda x: (x[1], x[2], x[0]))


def features(text: str, span: Span) -> list[float]:
    """Format and surroundings of a proposal."""
    kind, s, e = span
    own = text[s:e]
    digits = "".join(DIGIT.findall(own))
    groups = re.findall(r"[0-9]+", own)
    sizes = [len(g) for g in groups] or [0]
    seps = re.sub(r"[A-Za-z0-9]", "", own)
    before, after = text[max(0, s - AROUND):s], text[e:e + 2]
    side = lambda c: 0.0 if not c else 1.0 if c.isspace() else 2.0 if c.isalpha() else 3.0 if c.isdigit() else 4.0
    tail = re.split(r"[^A-Za-z0-9]+", own)[-1]
    return [
        *(float(kind == k) for k in KINDS), float(e - s), float(len(digits)), float(len(groups)), float(min(sizes)), float(max(sizes)),
        float(bool(digits) and luhn(digits)), float(max([int(g) if len(g) < 5 else 9999 for g in groups] or [0])), float(own[:1] == "+"),
        float("@" in own), float(bool(re.search(r"\bat\b", own, re.I))), float(bool(re.search(r"\bdot\b", own, re.I))), float(seps.count(" ")), float(seps.count(".")), float(seps.count("-")),
        float(seps.count("(")) - float(seps.count(")")), float(len(set(seps))), float(len(tail)), float(tail.isalpha()), side(before[-1:]), side(after[:1]), float(side(after[1:2]) == 3.0),
        float(before.endswith(("+", "."))), float(bool(CUES[kind].search(before))), float(len(set(digits))),
    ]


N_FEATURES = 28


def disguised(text: str, span: Span) -> list[tuple[str, Span, float]]:
    """(text, span, label) of disguised and damaged copies of a base span."""
    kind, s, e = span
    own, out = text[s:e], []
    first = int(hashlib.md5(own.encode()).hexdigest()[:8], 16)
    put = lambda new, label: out.append((text[:s] + new + text[e:], (kind, s, s + len(new)), label))
    if kind == "email":
        dots = re.sub(r"(?<=[A-Za-z0-9])\.(?=[A-Za-z0-9])", (" dot ", ".", "[dot]")[first // 3 % 3], own)
        put(dots.replace("@", (" at ", " (at) ", "[at]")[first % 3]), 1.0)
    elif kind == "ip":
        put(re.sub(r"^[0-9]+", str(256 + first % 700), own), 0.0)
        put("-".join(own.split(".")[:2]) + " " + ":".join(own.split(".")[2:]), 0.0)
        put(own.replace(".", " . " if first % 2 else ". "), 1.0)
    else:
        digits = "".join(DIGIT.findall(own))
        if kind == "card":
            four = [digits[i:i + 4] for i in range(0, len(digits), 4)]
            put((".", "  ", "_")[first % 3].join(four), 1.0)
            put(digits[:-1] + str((int(digits[-1]) + 1 + first % 8) % 10), 0.0)
        else:
            put(" ".join([digits[:-10] or "1", digits[-10:-7], digits[-7:-4], digits[-4:]]), 1.0)
            put(digits, 0.0)
            put(digits[:-2], 0.0)
    return out


def labelled(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(h, at, calibrate, kind, label, features) of the proposals of the documents; ``at`` counts those of one."""
    schema = pa.schema([("h", pa.int64()), ("at", pa.int32()), ("calibrate", pa.bool_()), ("kind", pa.string()), ("label", pa.float64()), ("x", pa.list_(pa.float64()))])
    for b in small_batches(batches, "text"):
        out = []
        for key, h, text in zip(b.column("doc_id").to_pylist(), b.column("h").to_pylist(), texts_of(b).to_pylist()):
            first = len(out)
            held = hashlib.md5(str(key).encode()).digest()[0] % 4 == 0
            base = set(base_spans(text))
            near = [(kind, text[max(0, s - 60):e + 60], (kind, min(s, 60), min(s, 60) + e - s), float((kind, s, e) in base)) for kind, s, e in proposals(text)]
            out += [{"calibrate": held, "kind": k, "label": y, "x": features(t, sp)} for k, t, sp, y in near]
            for kind, s, e in base:
                t, sp = text[max(0, s - 60):e + 60], (kind, min(s, 60), min(s, 60) + e - s)
                out += [{"calibrate": held, "kind": kind, "label": y, "x": features(t2, sp2)} for t2, sp2, y in disguised(t, sp)]
            for i, row in enumerate(out[first:]):
                row |= {"h": h, "at": i}
        yield pa.RecordBatch.from_pylist(out, schema)


class Trees:
    """Boosted regression trees as arrays, and the threshold of each kind."""

    def __init__(self, model=None):
        self.trees: list[tuple[np.ndarray, ...]] = []
        self.thresholds = dict.fromkeys(KINDS, 2.0)  # 2: never
        for weight, tree in zip(model.treeWeights, model.trees) if model else ():
            nodes: list[list[float]] = []

            def add(node, nodes=nodes, weight=weight) -> int:
                k = len(nodes)
                nodes.append([-1, 0.0, 0, 0, node.prediction() * weight])
                if node.subtreeDepth() > 0:
                    split = node.split()
                    nodes[k][:2] = [split.featureIndex(), split.threshold()]
                    nodes[k][2], nodes[k][3] = add(node.leftChild()), add(node.rightChild())
                return k

            add(tree._call_java("rootNode"))
            a = np.array(nodes, dtype=float)
            self.trees.append((a[:, 0].astype(int), a[:, 1], a[:, 2].astype(int), a[:, 3].astype(int), a[:, 4]))

    def probability(self, x: np.ndarray) -> np.ndarray:
        margin = np.zeros(len(x))
        rows = np.arange(len(x))
        for feat, cut, left, right, value in self.trees:
            at = np.zeros(len(x), int)
            for _ in range(TREE_DEPTH):
                f = feat[at]
                at = np.where(f < 0, at, np.where(x[rows, np.maximum(f, 0)] <= cut[at], left[at], right[at]))
            margin += value[at]
        return 1.0 / (1.0 + np.exp(-2.0 * margin))

    def calibrate(self, rows: DataFrame) -> None:
        """The lowest threshold of each kind that keeps ``PRECISION`` on the rows (kind, label, x)."""
        shared = rows.sparkSession.sparkContext.broadcast(self)

        def scored(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                x = b.column("x").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
                yield pa.RecordBatch.from_arrays([b.column("kind"), b.column("label"), pa.array(shared.value.probability(x))], names=["kind", "label", "p"])

        # equal probabilities stand or fall together; sums over steps of p first, so no window spans all of a kind's rows
        every = rows.select("kind", "label", "x").mapInArrow(scored, "kind string, label double, p double").groupBy("kind", "p")
        every = written(every.agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("y")).withColumn("step", F.floor(F.col("p") * STEPS)), "pii_scores")
        steps = every.groupBy("kind", "step").agg(F.sum("n").alias("n"), F.sum("y").alias("y"))  # at most STEPS + 1 rows a kind
        above = Window.partitionBy("kind").orderBy(F.desc("step"))
        before = [F.coalesce(F.sum(c).over(above.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias(f"{c}_above") for c in ("n", "y")]
        steps = steps.select("kind", "step", F.sum("n").over(Window.partitionBy("kind")).alias("of"), *before)
        own = Window.partitionBy("kind", "step").orderBy(F.desc("p"))
        sums = every.join(F.broadcast(steps), ["kind", "step"]).select("kind", "p", "of", *[(F.sum(c).over(own) + F.col(f"{c}_above")).alias(c) for c in ("n", "y")])
        precision = F.when(F.col("of") < 50, (F.col("y") + 1.0) / (F.col("n") + 1.0)).otherwise(F.col("y") / F.col("n"))
        good = sums.where((precision >= PRECISION) & (F.col("p") > 0.5)).groupBy("kind").agg(F.min("p").alias("p"))
        self.thresholds |= {r["kind"]: r["p"] for r in good.collect()}  # a row a kind


def fitted(docs: DataFrame, most_docs: int | None = None, most_rows: int | None = None) -> Trees:
    """Fit and calibrate the trees on the proposals of all documents; without both labels there are none, and the
    base stands alone.

    A caller may bound the documents (about ``most_docs``) and the proposals (``most_rows``), taken in hash
    order; the queries don't."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.functions import array_to_vector

    some = docs.where(F.col("text").rlike("[0-9@]"))
    if most_docs is not None:
        some = some.where(F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(1_000_000)) < F.lit(int(1e6 * min(1.0, most_docs / max(1, docs.count())))))
    some = some.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("h"))
    rows = some.mapInArrow(labelled, "h long, at int, calibrate boolean, kind string, label double, x array<double>")
    rows = written(rows, "pii_proposals").orderBy("h", "at")  # written first: a sort reads its input twice
    rows = written(rows if most_rows is None else rows.limit(most_rows), "pii_fit")
    learn = rows.where("not calibrate")
    if learn.select("label").distinct().count() < 2:
        return Trees()
    gbt = GBTClassifier(featuresCol="f", maxIter=TREES, maxDepth=TREE_DEPTH, seed=5, stepSize=0.3)
    out = Trees(gbt.fit(learn.select("label", array_to_vector("x").alias("f"))))
    out.calibrate(rows.where("calibrate"))
    return out


def all_spans(text: str, base: list[Span], trees: Trees) -> list[Span]:
    """Base spans and the added ones, by start, then by kind as listed."""
    if not trees.trees:
        return base
    taken = [[], []]  # starts and ends of base spans, overlapping ones joined
    for _, s, e in base:
        if taken[1] and s < taken[1][-1]:
            taken[1][-1] = max(taken[1][-1], e)
        else:
            taken[0].append(s)
            taken[1].append(e)
    free = [c for c in proposals(text) if clear(taken, c[1], c[2])]
    added: list[Span] = []
    if free:
        near = [(text[max(0, s - 60):e + 60], (k, min(s, 60), min(s, 60) + e - s)) for k, s, e in free]
        p = trees.probability(np.array([features(t, sp) for t, sp in near]))
        for i in np.argsort(-p, kind="stable"):
            k, s, e = free[i]
            if p[i] >= trees.thresholds[k] and clear(taken, s, e):
                added.append(free[i])
                at = bisect_right(taken[0], s)
                taken[0].insert(at, s)
                taken[1].insert(at, e)
    return sorted(base + added, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


def clear(taken: list[list[int]], s: int, e: int) -> bool:
    """Whether a span meets none of the disjoint spans, given as sorted starts and ends."""
    i = bisect_right(taken[1], s)
    return i == len(taken[0]) or e <= taken[0][i]


def redact(text: str, spans: list[Span]) -> str:
    """The text with each span (overlapping ones joined) replaced by its kind in brackets."""
    out, at = [], 0
    for kind, s, e in sorted(spans, key=lambda x: (x[1], -x[2])):
        if s >= at:
            out += [text[at:s], f"[{kind}]"]
        at = max(at, e)
    return "".join([*out, text[at:]])


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def with_pii(docs: DataFrame, trees: Trees, *keep: str) -> DataFrame:
    """``keep`` columns, n_email, n_ip, n_card, n_phone, base_sha256, spans, redacted; no shuffle.

    Null text counts as empty: no spans.  Repeated rows are judged each on its own; whole texts."""
    shared = docs.sparkSession.sparkContext.broadcast(trees)
    names = list(keep)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = shared.value
        for b in small_batches(batches, "text__"):
            counts, digest, every, clean = [], [], [], []
            for text in texts_of(b, "text__").to_pylist():
                base = base_spans(text)
                spans = all_spans(text, base, trees)
                counts.append([sum(k == kind for k, _, _ in base) for kind in KINDS])
                digest.append(hashlib.sha256(joined(base).encode()).hexdigest())
                every.append(joined(spans))
                clean.append(redact(text, spans) if spans else text)
            cols = [b.column(i) for i in range(len(names))]
            more = [pa.array([c[k] for c in counts], pa.int64()) for k in range(4)]
            yield pa.RecordBatch.from_arrays([*cols, *more, pa.array(digest), pa.array(every), pa.array(clean)], names=[*names, *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "redacted"])

    out = docs.select(*keep).schema
    for k in KINDS:
        out = out.add(f"n_{k}", "long")
    out = out.add("base_sha256", "string").add("spans", "string").add("redacted", "string")
    return docs.select(*keep, F.col("text").cast("string").alias("text__")).mapInArrow(run, out)


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 5 over all documents: counts and digest of the base spans, and all spans."""
    docs = table(spark, sf_dir, "documents")
    return with_pii(docs, fitted(docs), "doc_id").drop("redacted")
