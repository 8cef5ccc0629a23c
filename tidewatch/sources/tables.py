"""Tabular sources: labelled-flow CSV folders (S1–S3, S6) and KISTI TSV.

All scans use an explicit schema (no inference pass); CSV infinities in both spellings
are accepted; the order key ``ord`` = (file, split start, position) is attached where
first-row semantics matter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegralType, StringType, StructField, StructType

from tidewatch import schemas
from tidewatch.operators.clean import normalise_nulls, trim_column_names

CSV_OPTIONS = {
    "header": "true",
    "positiveInf": "inf",
    "negativeInf": "-inf",
    "mode": "PERMISSIVE",
    "enforceSchema": "false",
}


def _with_ord(df: DataFrame) -> DataFrame:
    return df.withColumn(
        "ord",
        F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("pos"),
        ),
    )


# Text columns of labelled-flow files; every other column is numeric.
TEXT_HEADERS = {"Flow ID", "Source IP", "Src IP", "Destination IP", "Dst IP", "Timestamp", "External IP", "Label"}


def labelled_flow_schema(headers: list[str], label: str = " Label") -> StructType:
    """Doubles for numeric columns, strings for the label and the known text columns.

    Header text is kept (trimmed later); a repeated name gets its repetition as a suffix."""
    text = TEXT_HEADERS | {label.strip()}
    fields, seen = [], {}
    for h in headers:
        seen[h.strip()] = k = seen.get(h.strip(), -1) + 1
        fields.append(StructField(f"{h}.{k}" if k else h, StringType() if h.strip() in text else DoubleType()))
    return StructType(fields)


def read_header(spark: SparkSession, path: str, sep: str = ",", glob: str | None = None, exclude: str | None = None) -> list[str]:
    """First line of one of the files that a scan with the same glob and exclusion reads."""
    reader = spark.read.options(header="false", sep=sep)
    df = (reader.option("pathGlobFilter", glob) if glob else reader).csv(path)
    if exclude:
        df = df.filter(~F.col("_metadata.file_name").eqNullSafe(exclude))
    first = df.limit(1).collect()
    return [c if c is not None else "" for c in first[0]] if first else []


def read_labelled_flows(
    spark: SparkSession, folder: str, headers: list[str] | None = None, exclude: str | None = None
) -> DataFrame:
    """S1 / S6 + U1: every ``*.csv`` (any case, X3: a ``pathGlobFilter`` instead of
    lower()+endswith()) in a folder, unioned, names trimmed (P1).

    Files are unioned by name after trimming, which fails loudly when headers differ (the
    positional append it replaces would silently misalign columns)."""
    glob = "*.[cC][sS][vV]"
    reader = spark.read.options(**CSV_OPTIONS).option("pathGlobFilter", glob)
    if headers is None:
        headers = read_header(spark, folder, glob=glob, exclude=exclude)
    if len({h.strip() for h in headers}) < len(headers):
        reader = reader.option("enforceSchema", "true")  # suffixed names differ from the header's
    df = reader.schema(labelled_flow_schema(headers)).csv(folder)
    if exclude:
        df = df.filter(~F.col("_metadata.file_name").eqNullSafe(exclude))
    return trim_column_names(df)


def read_kisti_tsv(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """The raw columns of a KISTI TSV by name, wherever they stand in the file.

    Cells are read as text and typed; a whole number in an integer column may be written like
    ``443.0``.  A missing column is an error."""
    header = [h.strip() for h in read_header(spark, path, sep="\t")]
    missing = [f.name for f in schemas.KISTI_RAW.fields if f.name not in header]
    if missing:
        raise ValueError(f"columns missing from {path}: {missing}")
    names = [h if header.index(h) == i else f"{h}.{i}" for i, h in enumerate(header)]
    text = StructType([StructField(n, StringType()) for n in names])
    df = normalise_nulls(_with_ord(spark.read.options(header="true", sep="\t", mode="PERMISSIVE").schema(text).csv(path)))

    def typed(f: StructField):
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, IntegralType):
            whole = c.try_cast("double")
            return F.coalesce(c.try_cast(f.dataType), F.when(whole == F.floor(whole), whole.try_cast(f.dataType))).alias(f.name)
        return c.alias(f.name) if isinstance(f.dataType, StringType) else c.try_cast(f.dataType).alias(f.name)

    df = df.select("ord", *(typed(f) for f in schemas.KISTI_RAW.fields))
    return df.select("ord", *(columns or [f.name for f in schemas.KISTI_RAW.fields]))


def read_tsv_tolerant(spark: SparkSession, path: str, names: list[str], header: bool = True) -> DataFrame:
    """All-string TSV; rows with too many cells are skipped, short rows are null-padded.

    PERMISSIVE truncates long rows and flags them (and short ones) as corrupt, so the raw
    line is kept in ``_corrupt`` and a row is dropped only when it has more cells than the
    header."""
    schema = StructType([StructField(n, StringType()) for n in names] + [StructField("_corrupt", StringType())])
    df = (
        spark.read.options(header=str(header).lower(), sep="\t", mode="PERMISSIVE", columnNameOfCorruptRecord="_corrupt")
        .schema(schema)
        .csv(path)
    )
    df = _with_ord(df)
    too_long = F.col("_corrupt").isNotNull() & (F.size(F.split(F.col("_corrupt"), "\t")) > len(names))
    return normalise_nulls(df.filter(~too_long).drop("_corrupt"))
