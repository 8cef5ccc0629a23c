"""Projections and null handling: P1–P11, F4–F11, pandas null-token normalisation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StringType

from tidewatch import schemas
from tidewatch.functions.scalar import finite_or_null


def trim_column_names(df: DataFrame) -> DataFrame:
    """P1."""
    return df.toDF(*[c.strip() for c in df.columns])


def select_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    """Fixed column list in the given order (fails loudly on a missing column)."""
    return df.select(*cols)


def fill_missing_features(df: DataFrame, features: list[str], keep_others: bool = True) -> DataFrame:
    """Add every absent feature as 0.0; present ones keep their values.
    Output = the other columns (if kept) followed by ``features`` in model order."""
    present = set(df.columns)
    feats = [F.col(c).cast("double").alias(c) if c in present else F.lit(0.0).alias(c) for c in features]
    others = [c for c in df.columns if c not in features] if keep_others else []
    return df.select(*others, *feats)


def missing_features(df: DataFrame, features: list[str]) -> list[str]:
    """Ordered list difference (schema-only, no data touched)."""
    return [c for c in features if c not in df.columns]


def column_or_fallback(df: DataFrame, name: str, fallback: str | None = None, default: str = "-"):
    """The column if present, else a fallback column, else a literal."""
    if name in df.columns:
        return F.col(name)
    if fallback and fallback in df.columns:
        return F.col(fallback)
    return F.lit(default)


def features_except(df: DataFrame, label: str = "Label") -> list[str]:
    """P8."""
    return [c for c in df.columns if c != label]


def infinities_to_null(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """±inf and NaN -> null in every floating column (others unchanged)."""
    cols = set(cols or df.columns)
    out = []
    for f in df.schema.fields:
        if f.name in cols and isinstance(f.dataType, (DoubleType, FloatType)):
            out.append(finite_or_null(F.col(f"`{f.name}`")).alias(f.name))
        else:
            out.append(F.col(f"`{f.name}`"))
    return df.select(*out)


def drop_incomplete(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """Drop rows with a null in any (or the given) column."""
    return df.na.drop(how="any", subset=subset)


def clean_finite(df: DataFrame) -> DataFrame:
    """F4 then F5: the labelled-flow cleaning step."""
    return drop_incomplete(infinities_to_null(df))


def fill_zero(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """F8: nulls -> 0 in numeric columns (all, or a subset)."""
    return df.na.fill(0, subset=subset) if subset else df.na.fill(0)


def normalise_nulls(df: DataFrame, tokens: list[str] | None = None) -> DataFrame:
    """pandas' CSV readers turn 'NA', 'null', 'None', '' ... into missing values even for text
    columns; Spark keeps the text.  Map those tokens to null in every string column."""
    tokens = tokens if tokens is not None else schemas.PANDAS_NULL_TOKENS
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, StringType):
            out.append(F.when(c.isin(*tokens), F.lit(None).cast("string")).otherwise(c).alias(f.name))
        else:
            out.append(c)
    return df.select(*out)


def require_rows(df: DataFrame, what: str = "flow events") -> DataFrame:
    """stop when the input has no rows (a one-row probe, not a count)."""
    if df.isEmpty():
        raise ValueError(f"no {what} in input")
    return df


def with_row_accounting(df: DataFrame, observation, **conds):
    """K7: attach counters to a DataFrame without an extra pass (``DataFrame.observe``)."""
    exprs = [F.count(F.lit(1)).alias("rows")] + [F.count_if(c).alias(n) for n, c in conds.items()]
    return df.observe(observation, *exprs)
