"""Sinks K1–K6: distributed CSV / TSV / Parquet writes and reference-header projections.

A write is one distributed job producing part files (the chunk-append loop of the source
scripts is what part files already are); ``overwrite`` replaces an earlier output (K3).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch import schemas


def write_csv(df: DataFrame, path: str, header: bool = True, sep: str = ",", mode: str = "overwrite") -> None:
    """K1 / K2 / K3 / K4: header once per part file, every row written once."""
    (
        df.write.mode(mode)
        .option("header", str(header).lower())
        .option("sep", sep)
        .option("ignoreLeadingWhiteSpace", "false")
        .option("ignoreTrailingWhiteSpace", "false")
        .csv(path)
    )


def write_tsv(df: DataFrame, path: str, header: bool = True, mode: str = "overwrite") -> None:
    write_csv(df, path, header=header, sep="\t", mode=mode)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None) -> None:
    """Engine-internal hand-off; e.g. parsed events partitioned by ``event_type`` so later
    readers of one type prune the others."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def in_input_order(df: DataFrame, order: str = "ord") -> DataFrame:
    """Rows in input (file) order for a sink that must keep it; a range-partitioned
    sort, applied only at the sink and only when asked for."""
    return df.orderBy(order)


def as_reference_headers(df: DataFrame) -> DataFrame:
    """Rename snake_case feature / comparison columns to the source tables' header text and
    spell outcome classes as the source does."""
    names = {**schemas.CIC_HEADERS, **schemas.COMPARE_HEADERS}
    labels = F.create_map(*[F.lit(x) for kv in schemas.OUTCOME_LABELS.items() for x in kv])
    cols = []
    for c in df.columns:
        col = F.coalesce(labels[F.col(c)], F.col(c)) if c == "outcome" else F.col(c)
        cols.append(col.alias(names.get(c, c)))
    return df.select(*cols)


def batch_report(batch: DataFrame, batch_id: int) -> DataFrame:
    """K6: per micro-batch result rows with the alert marker and the batch's clock stamp."""
    return batch.select(
        F.lit(batch_id).cast("bigint").alias("batch_id"),
        F.date_format(F.current_timestamp(), "HH:mm:ss").alias("clock"),
        "*",
        (~F.col("model_label").eqNullSafe(F.lit(schemas.BENIGN))).alias("is_alert"),
    )
