"""Session helpers: a sane default session and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Settings the engine relies on; everything else is left to the cluster's defaults.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "tidewatch",
                  driver_memory: str = "8g") -> SparkSession:
    """Local / single-JVM session (tests, bench).  On a cluster, use the cluster's session."""
    builder = SparkSession.builder.master(master).appName(app).config("spark.driver.memory", driver_memory)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def package_for_workers(spark: SparkSession) -> None:
    """Let Python workers that share this machine's files import the package (a cluster gets it by --py-files)."""
    home, env = str(Path(__file__).resolve().parents[1]), spark.sparkContext.environment
    known = env.get("PYTHONPATH", "")
    if home not in known.split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (home, known) if x)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir`` (HDFS, object store, shared disk).

    A local master, as in unit tests, may go without: its one process then gets a private folder.
    On a cluster a missing setting is an error, since no folder of the driver is shared.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="tidewatch-ckpt-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, kind: str) -> str:
    """A fresh path under the shared checkpoint folder; the writer that uses it creates it."""
    return f"{checkpoint_root(spark)}/tidewatch/{kind}/{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives executor loss)."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def handed_off(df: DataFrame, kind: str) -> DataFrame:
    """``df`` written once as Parquet into the shared folder and read back.

    A side of a join that comes straight from an aggregate keeps AQE from splitting a hot key of
    the other side; a side that is read from files does not."""
    path = scratch_path(df.sparkSession, kind)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Deal the rows of a test table to ``spark.tidewatch.spread`` partitions; off unless that is set.

    Only for inputs with fewer splits than cores (one row group), as in a benchmark on one machine."""
    n = df.sparkSession.conf.get("spark.tidewatch.spread", None)
    return df.repartition(int(n)) if n else df


def dealt(df: DataFrame) -> DataFrame:
    """Deal the rows of a scan to all cores if its largest split holds more than twice a core's share, for much
    work on few bytes.  Splits are counted by rows: a file of one row group has many splits, of which one has rows."""
    n = df.sparkSession.sparkContext.defaultParallelism
    total, most = df.groupBy(F.spark_partition_id()).count().agg(F.sum("count"), F.max("count")).first()
    return df.repartition(n) if most and most * n > 2 * total else df
