"""Benchmark decontamination by template windows (operator 9).  DataFrame functions only.

Texts become tokens in which names, numbers and units carry a type mark before their value
(``@anna``, ``#12.5``, ``~kg``); a template is the row of tokens with the values left out.  Every
window of ``WINDOW`` template tokens of a benchmark item is hashed and joined with the windows of
all documents.  Hits on one alignment (document position less item position) belong together.  The
values then decide for each window that was hit: one whose values are all the item's own (verbatim)
stands whatever lies around it; else its slots and those of the alignment's hits up to ``WINDOW``
tokens before and after it must map each item value to one document value and back (a consistent
substitution).  A contradiction drops the windows near it, not the alignment.

A template window counts if at least ``LITERALS`` of its tokens are no placeholders.  Beside it the
same tokens without marks, case folded, form a plain window, hashed and joined alike: it finds
verbatim copies whatever the marks say (capitals, what stands before the copy, few literals) and
always stands.  Items shorter than a window are one window of their own length, as a template if
longer than ``LITERALS`` tokens; of fewer than ``LITERALS`` tokens only a whole document equal to
the item is a copy.  Null and empty texts have no window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm.common import table, written

WINDOW = 8
LITERALS = 4
BROADCAST_ROWS = 500_000  # rows of two longs: 8 MB

# Units of measure, long forms and symbols.
UNITS = [
    "kg", "g", "mg", "km", "m", "cm", "mm", "l", "ml", "s", "min", "h", "hours", "hour", "minutes", "seconds", "days", "day", "weeks", "years", "year",
    "miles", "mile", "feet", "inches", "pounds", "ounces", "gallons", "liters", "litres", "meters", "metres", "grams", "kilometers", "degrees", "percent",
    "dollars", "dollar", "euros", "euro", "cents", "usd", "eur",
]
_UNIT = "|".join(UNITS)

# (pattern, replacement) in order; the same text serves Java and RE2 but for the group mark.
STEPS = [
    (r"([a-zß-öø-ÿ,;] )(\p{Lu}\p{L}+)", r"\1@\2"),
    (r"([0-9])[.,]([0-9])", r"\1_\2"),
    (r"([0-9][0-9_]*)", r"#\1"),
    (r"[^\p{L}\p{N}@#_]+", " "),
]
UNIT_STEP = (rf"(#[^ ]+) ({_UNIT})( |$)", r"\1 ~\2\3")


def marked(text: Column) -> Column:
    """The tokens of a text with type marks, one blank between them."""
    s = F.translate(F.coalesce(text.cast("string"), F.lit("")), "@#~_", "    ")
    for pattern, to in STEPS:
        s = F.regexp_replace(s, pattern, to.replace("\\", "$"))
    return F.trim(F.regexp_replace(F.lower(s), UNIT_STEP[0], UNIT_STEP[1].replace("\\", "$")))


def template(tokens: Column) -> Column:
    """Marked tokens without their values."""
    return F.regexp_replace(tokens, "([@#~])[^ ]*", "$1")


def plain(tokens: Column) -> Column:
    """Marked tokens without their marks."""
    return F.translate(tokens, "@#~", "")


def _windows(th: Column, ph: Column, size: Column) -> Column:
    """(at, t, p, size) of all windows of a text by its template and plain token hashes; ``at`` counts from 0.

    None if the text is shorter; sizes below ``LITERALS`` take texts of that very size."""
    fits = (F.size(th) >= size) & ((size >= LITERALS) | (F.size(th) == size))
    own = F.transform(F.sequence(F.lit(1), F.size(th) - size + 1), lambda i: F.struct(
        (i - 1).alias("at"), F.xxhash64(F.slice(th, i, size)).alias("t"), F.xxhash64(F.slice(ph, i, size)).alias("p"), size.alias("size")))
    return F.when(fits, own)


def _window_at(hashes: Column, at: Column, size: int) -> Column:
    """Hash of the window of ``size`` tokens at ``at``, as in ``_windows``; null if there is none."""
    fits = (F.size(hashes) - at >= size) if size >= LITERALS else (F.size(hashes) == size) & (at == 0)
    return F.when(fits, F.xxhash64(F.slice(hashes, at + 1, F.lit(size))))


def _hashes(tokens: Column) -> Column:
    return F.transform(tokens, lambda x: F.xxhash64(x))


def _judged(at: Column, k: Column) -> Column:
    """(stands, same) of the ``k``-th hit window of an alignment, by ``b``, ``d``, ``shift``, ``size`` and ``ats``."""
    end, first = at + F.col("size"), F.greatest(k - 2 * WINDOW, F.lit(0))
    near = F.slice("ats", first + 1, F.lit(4 * WINDOW + 1))  # sorted and distinct: all hits that reach the surroundings
    places = F.sequence(F.greatest(at - WINDOW, F.lit(0)), F.least(end + WINDOW, F.size("b")) - 1)
    places = F.filter(places, lambda i: F.exists(near, lambda a: (a <= i) & (i < a + F.col("size"))))
    slots = F.transform(places, lambda i: F.struct(i.alias("i"), F.get("b", i).alias("bs"), F.get("d", F.col("shift") + i).alias("ds")))
    slots = F.filter(slots, lambda z: z["bs"].rlike("^[@#~]") & z["ds"].rlike("^[@#~]"))
    same = F.forall(slots, lambda z: (z["i"] < at) | (z["i"] >= end) | (z["bs"] == z["ds"]))
    n = lambda f: F.size(F.array_distinct(F.transform(slots, f)))
    pairs = n(lambda z: F.struct(z["bs"], z["ds"]))
    return F.struct((same | ((pairs == n(lambda z: z["bs"])) & (pairs == n(lambda z: z["ds"])))).alias("stands"), same.alias("same"))


def item_windows(benchmark: DataFrame) -> DataFrame:
    """(h, item_id, at, size) of the template and plain windows of all items; ``at`` counts from 0."""
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), marked(F.col("text")).alias("m")).where(F.length("m") > 0)
    rows = rows.withColumn("t", F.split(template(F.col("m")), " ")).withColumn("size", F.least(F.size("t"), F.lit(WINDOW)))
    rows = rows.withColumn("th", _hashes(F.col("t"))).withColumn("ph", _hashes(F.split(plain(F.col("m")), " ")))
    rows = rows.select("item_id", "t", F.explode(_windows(F.col("th"), F.col("ph"), F.col("size"))).alias("w")).select("item_id", "t", "w.at", "w.size", F.col("w.t").alias("wt"), F.col("w.p").alias("wp"))
    literals = F.size(F.filter(F.slice("t", F.col("at") + 1, F.col("size")), lambda x: ~x.rlike("^[@#~]$")))
    own = F.when((F.col("size") > LITERALS) & (literals >= LITERALS), F.array("wt", "wp")).otherwise(F.array("wp"))
    return rows.select(F.explode(own).alias("h"), "item_id", "at", "size").distinct()


def document_windows(rows: DataFrame, sizes: list[int]) -> DataFrame:
    """(doc_id, t64, p, size, h) of the template and plain windows of all texts; ``p`` counts from 0, ``h`` is null where there is none."""
    # one parse of each text for all sizes; no filter on the number of tokens: pushed down, it would parse every text twice
    # the marked text is a column of its own: inside the two transforms each would parse it again
    w = rows.select("doc_id", "t64", marked(F.col("text")).alias("m"))
    w = w.select("doc_id", "t64", _hashes(F.split(template(F.col("m")), " ")).alias("th"), _hashes(F.split(plain(F.col("m")), " ")).alias("ph"))
    # a row for each position first, so that slices and hashes run in generated code, not in an interpreted transform
    w = w.select("doc_id", "t64", "th", "ph", F.explode(F.sequence(F.lit(0), F.size("th") - 1)).alias("p"))
    w = w.select("doc_id", "t64", "p", *[_window_at(F.col(c), F.col("p"), size).alias(f"{c}{size}") for size in sizes for c in ("th", "ph")])
    own = [F.struct(F.lit(size).alias("size"), h.alias("h")) for size in sizes for h in (F.col(f"th{size}"), F.when(F.col(f"th{size}") != F.col(f"ph{size}"), F.col(f"ph{size}")))]
    return w.select("doc_id", "t64", "p", F.explode(F.array(*own)).alias("w")).select("doc_id", "t64", "p", "w.size", "w.h")


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, t64, item_id, n_windows, verbatim) for each document and item that it holds.

    ``n_windows``: standing windows of the document's best alignment with the item; ``verbatim``: that
    all values in the windows hit on a best alignment are the item's own.  ``t64`` hashes the text, to tell rows of one
    doc_id apart; equal rows give one result.  Other columns are not read."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("t64"), F.col("text").cast("string").alias("text"))
    items = written(item_windows(benchmark), "item_windows")
    n_items, sizes = items.count(), sorted(r[0] for r in items.select("size").distinct().collect())  # at most WINDOW sizes
    small = items.hint("broadcast") if n_items <= BROADCAST_ROWS else items
    w = document_windows(rows, sizes or [WINDOW])
    # the hash alone is the key of the join: one long, looked up faster than a pair
    by_hash = small.withColumnsRenamed({"h": "i_h", "size": "i_size"})
    hits = w.join(by_hash, (F.col("h") == F.col("i_h")) & (F.col("size") - F.col("i_size") == 0))
    lines = written(hits.groupBy("doc_id", "t64", "item_id", "size", (F.col("p") - F.col("at")).alias("shift"))
                    .agg(F.sort_array(F.collect_set("at")).alias("ats")), "window_hits")  # at most the item's windows
    # the values of the aligned stretches, from the texts of the documents that were hit
    chosen = written(lines.select("doc_id", "t64").distinct(), "hit_documents")
    chosen = F.broadcast(chosen) if chosen.count() <= BROADCAST_ROWS else chosen
    c = chosen.select(F.col("doc_id").alias("c_id"), F.col("t64").alias("c_t64"))
    texts = rows.join(c, F.col("doc_id").eqNullSafe(F.col("c_id")) & (F.col("t64") == F.col("c_t64")), "left_semi")
    texts = texts.select("doc_id", "t64", F.split(marked(F.col("text")), " ").alias("d")).dropDuplicates(["doc_id", "t64"])
    own = benchmark.select(F.col("item_id").cast("long").alias("i_id"), F.split(marked(F.col("text")), " ").alias("b"))
    x = lines.join(texts.withColumnsRenamed({"doc_id": "x_id", "t64": "x_t64"}), F.col("doc_id").eqNullSafe(F.col("x_id")) & (F.col("t64") == F.col("x_t64")))
    # one row each: the filter on the judged windows stays above them, so they are judged once
    x = x.join(own, F.col("item_id") == F.col("i_id")).select("doc_id", "t64", "item_id", F.explode(F.array(F.transform("ats", _judged))).alias("w"))
    x = x.withColumn("n_windows", F.size(F.filter("w", lambda w: w["stands"])).cast("long")).where(F.col("n_windows") > 0)
    same = F.forall("w", lambda w: w["same"])
    return x.groupBy("doc_id", "t64", "item_id").agg(F.max("n_windows").alias("n_windows"), F.max(F.struct("n_windows", same.alias("same")))["same"].alias("verbatim"))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 9: every document that holds a passage of a benchmark item, all documents against all items."""
    got = contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return got.groupBy("doc_id", "item_id").agg(F.max("n_windows").alias("n_windows"), F.max(F.struct("n_windows", "verbatim"))["verbatim"].alias("verbatim"))


def _marked_sql(col: str) -> str:
    s = f"translate(coalesce({col}, ''), '@#~_', '    ')"
    for pattern, to in STEPS:
        s = f"regexp_replace({s}, '{pattern}', '{to}', 'g')"
    return f"trim(regexp_replace(lower({s}), '{UNIT_STEP[0]}', '{UNIT_STEP[1]}', 'g'))"


def _window_sql(src: str, key: str, col: str) -> str:
    return f"""SELECT {key}, size, i - 1 AS pos, array_to_string({col}[i:i + size - 1], ' ') AS w, {col}[i:i + size - 1] AS ws
  FROM (SELECT {key}, {col}, size, unnest(range(1, len({col}) - size + 2)) AS i FROM {src} WHERE len({col}) >= size AND (size >= {LITERALS} OR len({col}) = size))"""


ORACLE = f"""WITH
im AS (SELECT item_id, string_split({_marked_sql('text')}, ' ') AS b FROM benchmark),
it AS (SELECT item_id, list_transform(b, lambda x: regexp_replace(x, '([@#~]).*', '\\1')) AS t, list_transform(b, lambda x: translate(x, '@#~', '')) AS q,
         least(len(b), {WINDOW}) AS size FROM im WHERE b <> ['']),
iw AS (SELECT item_id, size, pos, w FROM ({_window_sql('it', 'item_id', 't')})
       WHERE size > {LITERALS} AND len(list_filter(ws, lambda x: NOT regexp_matches(x, '^[@#~]$'))) >= {LITERALS}
       UNION SELECT item_id, size, pos, w FROM ({_window_sql('it', 'item_id', 'q')})),
dm AS MATERIALIZED (SELECT row_number() OVER () AS r, * FROM (SELECT DISTINCT doc_id, text, string_split({_marked_sql('text')}, ' ') AS d FROM documents)),
dt AS (SELECT r, list_transform(d, lambda x: regexp_replace(x, '([@#~]).*', '\\1')) AS t, list_transform(d, lambda x: translate(x, '@#~', '')) AS q FROM dm),
dz AS (SELECT r, t, q, s.size FROM dt, (SELECT DISTINCT size FROM iw) s),
dw AS ({_window_sql('dz', 'r', 't')} UNION {_window_sql('dz', 'r', 'q')}),
l AS MATERIALIZED (SELECT DISTINCT r, item_id, dw.pos - iw.pos AS shift, iw.pos AS k, size FROM dw JOIN iw USING (w, size)),
c AS (SELECT DISTINCT r, item_id, shift, unnest(range(k, k + size)) AS i FROM l),
z AS (SELECT r, item_id, shift, i, b[i + 1] AS v, d[shift + i + 1] AS w FROM c JOIN dm USING (r) JOIN im USING (item_id)
      WHERE regexp_matches(b[i + 1], '^[@#~]') AND regexp_matches(d[shift + i + 1], '^[@#~]')),
j AS (SELECT l.r, l.item_id, l.shift, k, coalesce(bool_and(i < k OR i >= k + size OR v = w), true) AS same,
        count(DISTINCT v || ' ' || w) = count(DISTINCT v) AND count(DISTINCT v || ' ' || w) = count(DISTINCT w) AS fits
      FROM l LEFT JOIN z ON z.r = l.r AND z.item_id = l.item_id AND z.shift = l.shift AND i >= k - {WINDOW} AND i < k + size + {WINDOW} GROUP BY ALL),
ok AS (SELECT doc_id, item_id, count(*) FILTER (same OR fits) AS n_windows, bool_and(same) AS same FROM j JOIN dm USING (r) GROUP BY r, doc_id, item_id, shift)
SELECT doc_id, item_id, max(n_windows) AS n_windows, max({{'n': n_windows, 's': same}}).s AS verbatim FROM ok WHERE n_windows > 0 GROUP BY doc_id, item_id"""
