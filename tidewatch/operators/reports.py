"""Reports: value counts, outcome summary, detection rates, profiles, classification metrics.

Everything aggregates with partial (map-side) aggregation first; the only single-task steps
run over already-aggregated frames whose size is bounded by a class count (4 outcomes, the
label set) or by the partition count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch import schemas
from tidewatch.session import handed_off

# ---------------------------------------------------------------------------------------
# A1 / A2 / A3 / W2
# ---------------------------------------------------------------------------------------


def value_counts(df: DataFrame, c: str, name: str = "count") -> DataFrame:
    """A1: count per non-null value (present most-frequent-first with ``orderBy``)."""
    return df.filter(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias(name))


def value_counts_sorted(df: DataFrame, c: str, name: str = "count") -> DataFrame:
    """A1 with its presentation order (count desc, value asc)."""
    return value_counts(df, c, name).orderBy(F.desc(name), F.asc(c))


def value_counts_by_key(df: DataFrame, c: str, name: str = "count") -> DataFrame:
    """A2: count per value ordered by value."""
    return value_counts(df, c, name).orderBy(c)


def value_shares(df: DataFrame, c: str, digits: int = 4) -> DataFrame:
    """Count and percent of the total per value.

    The window has no partition key, but it runs over the *aggregated* frame (one row per
    distinct label), never over raw rows."""
    counts = value_counts(df, c)
    total = F.sum("count").over(Window.partitionBy())
    return counts.withColumn("share_pct", F.bround(F.col("count").cast("double") * F.lit(100.0) / total, digits))


# ---------------------------------------------------------------------------------------
# A6 / A7 — outcome summary and detection rates
# ---------------------------------------------------------------------------------------


def _outcome_counts(compared: DataFrame) -> DataFrame:
    o = F.col("outcome")
    return compared.agg(
        *[F.count_if(o == k).alias(k) for k in schemas.OUTCOMES],
        F.count(F.lit(1)).alias("TOTAL"),
    )


def outcome_summary(compared: DataFrame, digits: int = 4) -> DataFrame:
    """The fixed 4 outcome classes (zero-filled), each with its share of all rows, and a
    TOTAL row.  One global aggregate (partial per task), then a 5-row ``stack``."""
    counts = _outcome_counts(compared)
    parts = []
    for i, k in enumerate(schemas.OUTCOMES + ["TOTAL"], start=1):
        parts += [f"'{k}'", f"`{k}`", str(i)]
    stacked = counts.select(
        F.expr(f"stack({len(schemas.OUTCOMES) + 1}, {', '.join(parts)}) AS (outcome, n, rank)"),
        F.col("TOTAL").alias("_total"),
    )
    share = F.when(
        F.col("_total") > 0, F.bround(F.col("n").cast("double") * F.lit(100.0) / F.col("_total").cast("double"), digits)
    ).otherwise(F.lit(0.0))
    return stacked.select("rank", "outcome", F.col("n").cast("bigint").alias("n"), share.alias("pct"))


def detection_rates(compared: DataFrame, digits: int = 4) -> DataFrame:
    """IDS rate = (both + IDS-only)/N, model rate = (both + model-only)/N; N = 0 -> null."""
    c = _outcome_counts(compared)
    ids = F.col(schemas.OUTCOME_BOTH) + F.col(schemas.OUTCOME_IDS_ONLY)
    model = F.col(schemas.OUTCOME_BOTH) + F.col(schemas.OUTCOME_MODEL_ONLY)
    n = F.col("TOTAL")

    def rate(x: Column) -> Column:
        return F.when(n > 0, F.bround(x.cast("double") * F.lit(100.0) / n.cast("double"), digits))

    return c.select(
        n.alias("total"),
        ids.alias("ids_detected"),
        model.alias("model_detected"),
        rate(ids).alias("ids_rate_pct"),
        rate(model).alias("model_rate_pct"),
    )


# ---------------------------------------------------------------------------------------
# A8 — global counts
# ---------------------------------------------------------------------------------------


def event_counts(events: DataFrame) -> DataFrame:
    """Flow rows, alert rows, distinct alerted flow ids (null counts as one key)."""
    et = F.col("event_type")
    fid_null = F.col("flow_id").isNull()
    return events.agg(
        F.count_if(et == "flow").alias("flow_events"),
        F.count_if(et == "alert").alias("alert_rows"),
        (
            F.count_distinct(F.when(et == "alert", F.col("flow_id")))
            + F.max(F.when((et == "alert") & fid_null, F.lit(1)).otherwise(F.lit(0)))
        ).cast("bigint").alias("alerted_flow_ids"),
    )


# ---------------------------------------------------------------------------------------
# A9 / A10 / A11 — profiles
# ---------------------------------------------------------------------------------------


BRACKET_ROWS = 100_000  # a bracket with no more rows is looked at value by value
GRID = 1000  # sketch points among which a wider bracket is narrowed


def _brackets(vals: DataFrame, qs: list[float]) -> tuple[DataFrame, int]:
    """One row a group: count, extremes and moments of its values, and for each wanted rank a bracket.

    Wanted are the two ranks (from 0) around h = (n - 1) q of each quantile.  A bracket is a closed interval
    that holds the value of that rank: ``lo_i``, ``hi_i``, the rows before it ``before_i`` and inside it
    ``inside_i``.  At first it spans all values; one sketch, made in the same pass, serves to narrow them all."""
    v = F.col("__v")
    stats = vals.groupBy("__grp").agg(F.count(F.lit(1)).alias("_n"), F.min(v).alias("min"), F.max(v).alias("max"),
                                      F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"),
                                      F.percentile_approx(v, _grid(), 10 * GRID).alias("grid"))
    cols = []
    for k, q in enumerate(qs):
        h = (F.col("_n") - 1) * F.lit(float(q))
        for i, rank in ((2 * k, F.floor(h)), (2 * k + 1, F.ceil(h))):
            cols += [rank.cast("bigint").alias(f"rank_{i}"), F.col("min").alias(f"lo_{i}"), F.col("max").alias(f"hi_{i}"),
                     F.lit(0).cast("bigint").alias(f"before_{i}"), F.col("_n").alias(f"inside_{i}")]
    many = 2 * len(qs)
    brackets = stats.select("*", *cols, *[F.col("grid").alias(f"grid_{i}") for i in range(many)]).drop("grid")
    return _cut_to_grid(vals, handed_off(brackets, "brackets"), many), many


def _grid() -> list[float]:
    return [x / GRID for x in range(GRID + 1)]


def _beside(vals: DataFrame, brackets: DataFrame) -> DataFrame:
    """Values with their group's brackets; the brackets are read from files, so a hot group is split."""
    return vals.join(brackets.withColumnRenamed("__grp", "__b"), F.col("__grp").eqNullSafe(F.col("__b"))).drop("__b")


def _narrowed(vals: DataFrame, brackets: DataFrame, many: int) -> DataFrame:
    """Each wide bracket cut to the three steps of a sketch grid around its rank, then counted exactly.

    Sketches are merged from partial ones (bounded, whatever the group's size)."""
    wide = lambda i: (F.col(f"inside_{i}") > BRACKET_ROWS) & (F.col(f"lo_{i}") < F.col(f"hi_{i}"))
    points = _beside(vals, brackets).groupBy("__grp").agg(
        *[F.percentile_approx(F.when(_inside(i) & wide(i), F.col("__v")), _grid(), 10 * GRID).alias(f"grid_{i}") for i in range(many)])
    met = brackets.join(points.withColumnRenamed("__grp", "__b"), F.col("__grp").eqNullSafe(F.col("__b"))).drop("__b")
    return _cut_to_grid(vals, handed_off(met, "brackets"), many)


def _inside(i: int) -> Column:
    return F.col("__v").between(F.col(f"lo_{i}"), F.col(f"hi_{i}"))


def _cut_to_grid(vals: DataFrame, met: DataFrame, many: int) -> DataFrame:
    """Brackets with grids, cut and counted; should a sketch have missed its rank, the bracket stays as it was."""
    step = lambda i: F.floor((F.col(f"rank_{i}") - F.col(f"before_{i}")) * GRID / F.col(f"inside_{i}")).cast("int")
    tried = met.select("__grp", *[x for i in range(many) for x in (
        F.coalesce(F.get(f"grid_{i}", F.greatest(step(i) - 1, F.lit(0))), F.col(f"lo_{i}")).alias(f"lo_{i}"),
        F.coalesce(F.get(f"grid_{i}", F.least(step(i) + 2, F.lit(GRID))), F.col(f"hi_{i}")).alias(f"hi_{i}"))])
    counts = _beside(vals, handed_off(tried, "brackets")).groupBy("__grp").agg(
        *[x for i in range(many) for x in (F.count_if(F.col("__v") < F.col(f"lo_{i}")).alias(f"nb_{i}"), F.count_if(_inside(i)).alias(f"ni_{i}"),
                                          F.first(f"lo_{i}").alias(f"nl_{i}"), F.first(f"hi_{i}").alias(f"nh_{i}"))])
    kept = [c for c in met.columns if c.split("_")[0] not in ("lo", "hi", "before", "inside", "grid")]
    met = met.join(counts.withColumnRenamed("__grp", "__b"), F.col("__grp").eqNullSafe(F.col("__b"))).drop("__b")
    new = {"lo": "nl", "hi": "nh", "before": "nb", "inside": "ni"}
    good = lambda i: (F.col(f"nb_{i}") <= F.col(f"rank_{i}")) & (F.col(f"rank_{i}") < F.col(f"nb_{i}") + F.col(f"ni_{i}"))
    return handed_off(met.select(*kept, *[F.when(good(i), F.col(f"{b}_{i}")).otherwise(F.col(f"{a}_{i}")).alias(f"{a}_{i}")
                                          for i in range(many) for a, b in new.items()]), "brackets")


def _selected(vals: DataFrame, qs: list[float]) -> DataFrame:
    """Per group: ``_n``, min, max, mean, std and the exact quantiles ``q_0``, ``q_1``, ... (pandas' linear rule).

    Bracketed selection: brackets are narrowed by sketches and exact counts until each holds few rows or one
    value; then the distinct values inside, with their counts, are walked to the rank.  Every pass is a partial
    aggregate; no value is sorted or shuffled unless it lies in a last bracket."""
    vals = handed_off(vals, "profile_values")
    brackets, many = _brackets(vals, qs)
    before = None
    while True:
        left = brackets.agg(*[F.sum(F.when(F.col(f"lo_{i}") < F.col(f"hi_{i}"), F.col(f"inside_{i}"))) for i in range(many)],
                            *[F.max(F.when(F.col(f"lo_{i}") < F.col(f"hi_{i}"), F.col(f"inside_{i}"))) for i in range(many)]).first()
        if max([x or 0 for x in left[many:]], default=0) <= BRACKET_ROWS or left == before:
            break
        before = left
        brackets = _narrowed(vals, brackets, many)
    wanted = [F.struct(F.lit(i).alias("i"), *[F.col(f"{c}_{i}").alias(c) for c in ("rank", "lo", "hi", "before")]) for i in range(many)]
    hit = lambda x: F.col("__v").between(x["lo"], x["hi"]) & (x["lo"] < x["hi"])
    near = _beside(vals, brackets.select("__grp", F.array(*wanted).alias("__w"))).filter(F.exists("__w", hit))
    near = near.groupBy("__grp", "__v").agg(F.count(F.lit(1)).alias("__c"), F.first("__w").alias("__w"))
    near = near.select("__grp", "__v", "__c", F.explode(F.filter("__w", hit)).alias("w")).select("__grp", "__v", "__c", "w.*")
    upto = F.col("before") + F.sum("__c").over(Window.partitionBy("__grp", "i").orderBy("__v"))
    near = near.withColumn("__upto", upto).filter((F.col("__upto") > F.col("rank")) & (F.col("__upto") - F.col("__c") <= F.col("rank")))
    at = near.groupBy(F.col("__grp").alias("__b")).agg(*[F.max(F.when(F.col("i") == i, F.col("__v"))).alias(f"at_{i}") for i in range(many)])
    got = brackets.join(at, F.col("__grp").eqNullSafe(F.col("__b")), "left")
    value = lambda i: F.coalesce(F.col(f"at_{i}"), F.col(f"lo_{i}"))  # noqa: E731  a bracket of one value needs no look
    out = []
    for k, q in enumerate(qs):
        h = (F.col("_n") - 1) * F.lit(float(q))
        out.append((value(2 * k) + (value(2 * k + 1) - value(2 * k)) * (h - F.floor(h))).alias(f"q_{k}"))
    return got.select("__grp", "_n", "min", "max", "mean", "std", *out)


def _values(df: DataFrame, group: str, v: str) -> DataFrame:
    vals = df.select(F.col(group).alias("__grp"), F.col(v).cast("double").alias("__v"))
    return vals.filter(F.col("__v").isNotNull() & ~F.isnan("__v"))


def grouped_exact_quantiles(df: DataFrame, group: str, v: str, qs: list[float]) -> DataFrame:
    """Exact linear-interpolated quantiles (pandas / ``quantile_cont`` rule) of ``v`` per group, by selection.

    No task ever holds a whole group, and no value is sorted but those of the last, narrow brackets."""
    got = _selected(_values(df, group, v), qs)
    each = F.explode(F.array(*[F.struct(F.lit(float(q)).alias("q"), F.col(f"q_{k}").alias("value")) for k, q in enumerate(qs)]))
    return got.select(F.col("__grp").alias(group), each.alias("p")).select(group, "p.*")


def exact_quantiles(df: DataFrame, c: str, qs: list[float]) -> DataFrame:
    """Exact quantiles of one column (see ``grouped_exact_quantiles``)."""
    one = df.select(F.lit(c).alias("__col"), F.col(c))
    return grouped_exact_quantiles(one, "__col", c, qs).select("q", "value")


def numeric_profile(df: DataFrame, cols: list[str], digits: int = 4) -> DataFrame:
    """A9 (``describe()``): per column count, mean, std, min, 25/50/75 %, max over the
    non-missing values (NaN counts as missing, as in pandas).  A column with no value at all has
    count 0 and nulls.

    All columns are unpivoted into (column, value) once; moments come from one partial aggregate and the
    quartiles from bracketed selection."""
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v")) for c in cols])).alias("x")).select("x.*")
    got = _selected(_values(long, "column", "v"), [0.25, 0.5, 0.75])
    named = df.sparkSession.createDataFrame([(c,) for c in cols], "column string")  # one row per profiled column
    row = named.join(got, F.col("column") == F.col("__grp"), "left").withColumnsRenamed({"q_0": "p25", "q_1": "p50", "q_2": "p75"})
    return row.select(
        "column", F.coalesce(F.col("_n"), F.lit(0)).cast("bigint").alias("count"),
        *[F.bround(F.col(m), digits).alias(m) for m in ("mean", "std", "min", "p25", "p50", "p75", "max")],
    )


def null_profile(df: DataFrame, cols: list[str] | None = None, nonzero_only: bool = True) -> DataFrame:
    """A10: null count per column (one aggregate pass, then unpivot)."""
    cols = cols or df.columns
    agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    parts = ", ".join(f"'{c}', `{c}`" for c in cols)
    long = agg.select(F.expr(f"stack({len(cols)}, {parts}) AS (column, nulls)"))
    long = long.withColumn("nulls", F.col("nulls").cast("bigint"))
    return long.filter(F.col("nulls") > 0) if nonzero_only else long


def total_nulls(df: DataFrame) -> DataFrame:
    """A10 (grand total variant)."""
    per_row = sum((F.col(c).isNull().cast("bigint") for c in df.columns), F.lit(0).cast("bigint"))
    return df.agg(F.sum(per_row).cast("bigint").alias("nulls"))


def distinct_values(df: DataFrame, c: str) -> DataFrame:
    """A11."""
    return df.select(c).distinct()


# ---------------------------------------------------------------------------------------
# A12 / A13 / A14 / U3 — classification metrics from (y, p) pairs
# ---------------------------------------------------------------------------------------


def accuracy(pairs: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """A12."""
    return pairs.agg(F.avg((F.col(y) == F.col(p)).cast("double")).alias("accuracy"), F.count(F.lit(1)).alias("n"))


def confusion_matrix(pairs: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """A14 (long form: one row per (true, predicted) cell that occurs)."""
    return pairs.groupBy(F.col(y).alias("y"), F.col(p).alias("p")).agg(F.count(F.lit(1)).alias("n"))


def confusion_matrix_wide(pairs: DataFrame, labels: list, y: str = "y", p: str = "p") -> DataFrame:
    """A14 (matrix form): one row per true class, one column per predicted class.  The class
    list is given (e.g. the encoder's labels), so no pass collects pivot values."""
    cells = confusion_matrix(pairs, y, p)
    wide = cells.groupBy("y").pivot("p", labels).agg(F.sum("n"))
    return wide.na.fill(0, subset=[str(c) for c in labels])


def label_union(pairs: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """Classes present in truth or prediction."""
    return pairs.select(F.col(y).alias("label")).union(pairs.select(F.col(p).alias("label"))).distinct()


def classification_report(pairs: DataFrame, y: str = "y", p: str = "p", digits: int = 4) -> DataFrame:
    """Per-class precision / recall / F1 / support plus accuracy, macro and weighted
    averages; zero denominators give 0.  Works on the confusion cells (≤ classes² rows),
    so no raw row is ever collected."""
    cells = confusion_matrix(pairs, y, p)
    # each cell counts toward its true class (support, hits) and its predicted class:
    # one aggregate over the exploded cells, no join between the two sides
    n, hit = F.col("n"), F.when(F.col("y") == F.col("p"), F.col("n")).otherwise(F.lit(0))
    sides = F.array(
        F.struct(F.col("y").alias("label"), n.alias("support"), hit.alias("tp"), F.lit(0).cast("bigint").alias("predicted")),
        F.struct(F.col("p").alias("label"), F.lit(0).cast("bigint").alias("support"), F.lit(0).cast("bigint").alias("tp"),
                 n.alias("predicted")),
    )
    per = cells.select(F.explode(sides).alias("s")).select("s.*").groupBy("label").agg(
        F.sum("support").cast("bigint").alias("support"),
        F.sum("tp").cast("double").alias("tp"),
        F.sum("predicted").cast("double").alias("predicted"),
    )
    prec = F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted")).otherwise(F.lit(0.0))
    rec = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(F.lit(0.0))
    per = per.withColumn("precision", prec).withColumn("recall", rec)
    f1 = F.when((F.col("precision") + F.col("recall")) > 0,
                F.lit(2.0) * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))
                ).otherwise(F.lit(0.0))
    per = per.withColumn("f1", f1)
    tot = per.agg(
        F.sum("support").alias("n"),
        F.sum("tp").alias("tp"),
        F.avg("precision").alias("mp"), F.avg("recall").alias("mr"), F.avg("f1").alias("mf"),
        (F.sum(F.col("precision") * F.col("support")) / F.sum("support")).alias("wp"),
        (F.sum(F.col("recall") * F.col("support")) / F.sum("support")).alias("wr"),
        (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("wf"),
    )
    r = lambda c: F.bround(c, digits)
    classes = per.select(
        F.col("label").cast("string").alias("label"), r(F.col("precision")).alias("precision"),
        r(F.col("recall")).alias("recall"), r(F.col("f1")).alias("f1"), F.col("support"),
    )
    acc = tot.select(F.lit("accuracy").alias("label"), F.lit(None).cast("double").alias("precision"),
                     F.lit(None).cast("double").alias("recall"), r(F.col("tp") / F.col("n")).alias("f1"),
                     F.col("n").cast("bigint").alias("support"))
    macro = tot.select(F.lit("macro avg").alias("label"), r(F.col("mp")).alias("precision"),
                       r(F.col("mr")).alias("recall"), r(F.col("mf")).alias("f1"),
                       F.col("n").cast("bigint").alias("support"))
    weighted = tot.select(F.lit("weighted avg").alias("label"), r(F.col("wp")).alias("precision"),
                          r(F.col("wr")).alias("recall"), r(F.col("wf")).alias("f1"),
                          F.col("n").cast("bigint").alias("support"))
    return classes.unionByName(acc).unionByName(macro).unionByName(weighted)


# ---------------------------------------------------------------------------------------
# O1 / O2 / O3 — ordering and limits (limits only where they are the feature)
# ---------------------------------------------------------------------------------------


def top_k(df: DataFrame, by: str, k: int, desc: bool = True) -> DataFrame:
    """O1: top-k report (TakeOrderedAndProject: per-task top-k, then a k-row merge); ties by the other columns."""
    return ranking(df, by, desc).limit(k)


def ranking(df: DataFrame, by: str, desc: bool = True) -> DataFrame:
    """O2: full ranking; ties by the other columns, in their order."""
    return df.orderBy(F.desc(by) if desc else F.asc(by), *[F.asc(c) for c in df.columns if c != by])


def preview(df: DataFrame, order: str = "ord", n: int = 3) -> DataFrame:
    """O3: first n rows in input order."""
    return df.orderBy(order).limit(n)
