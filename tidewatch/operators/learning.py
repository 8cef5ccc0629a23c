"""Random-forest training, scoring and inspection (ML1–ML11) on Spark ML.

The model is a ``PipelineModel`` (label index -> feature vector -> forest -> label text),
so the feature order is stored with the model and a row is scored in place: the output
keeps every input column, no positional pairing of predictions with metadata is needed.
Training is Spark's distributed forest (per-level histogram aggregation across tasks).
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import IndexToString, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from tidewatch.functions.scalar import max_probability
from tidewatch.operators import forest as B
from tidewatch.session import cut_lineage

MAX_DEPTH_CEILING = 30  # Spark's limit; an unlimited depth is not offered
HISTOGRAM_MB = 256  # fixed: the buffer groups tree nodes, and the grouping orders the random feature draws
MAX_BROADCAST_CLASSES = 1_000_000
CACHED_IDS = 200_000_000  # node ids (rows x trees) kept between levels; beyond it they'd be spilled and written at every level
TASK_IDS = 200_000_000  # rows x trees of one task, some 1.2 GB at most and 0.6 GB once dealt
BLOCK_IDS = 200_000_000  # rows x trees beyond which the forest is fitted on blocks of binned rows (``forest.py``)
DEALT_IDS = 25_000_000  # rows x trees of a partition from which dealing them to idle cores pays


def train_forest(
    df: DataFrame,
    features: list[str],
    label: str = "Label",
    num_trees: int = 100,
    max_depth: int = 10,
    seed: int = 42,
    weight_col: str | None = None,
    max_bins: int = 32,
    max_memory_mb: int = HISTOGRAM_MB,
    materialize: bool = True,
    cached_ids: int = CACHED_IDS,
    task_ids: int = TASK_IDS,
    block_ids: int = BLOCK_IDS,
) -> PipelineModel:
    """ML1 + ML4 (+ ML5 via ``weight_col``): label encoder with lexicographic classes, vector
    assembly by name, forest with sqrt feature subsets.

    Beyond ``block_ids`` rows x trees the forest is fitted by ``forest.fitted``, the same method with other random draws,
    unless it is too deep or has too many bins for it; else by Spark.  The histogram buffer is the same everywhere, since another one may give another forest; a
    depth beyond Spark's limit is refused.  Up to ``cached_ids`` node ids are cached between levels
    (checkpointed every 10 levels into the shared checkpoint folder); with more, a row's node is found
    by walking down its trees, which gives the same forest.  Rows are dealt anew if a partition
    holds more than ``task_ids`` rows x trees, or much more than a core's share.  Every partition, an
    empty one too, shuffles the statistics of all nodes at each level (some 400 MB a fit of 100 trees), so there
    are no more partitions than cores and ``task_ids`` ask for."""
    if max_depth > MAX_DEPTH_CEILING:
        raise ValueError(f"max_depth {max_depth} is beyond Spark's limit of {MAX_DEPTH_CEILING}")
    indexer = StringIndexer(inputCol=label, outputCol="_label_idx", stringOrderType="alphabetAsc", handleInvalid="error")
    assembler = VectorAssembler(inputCols=list(features), outputCol="_features", handleInvalid="keep")
    # Fitting reads its input several times (label index, split candidates, training
    # points): materialise only the needed columns once, in the shared checkpoint folder,
    # instead of recomputing the upstream sample / lookup / join lineage on every pass.
    if materialize:
        df = cut_lineage(df.select(label, *features, *([weight_col] if weight_col else [])))
    held = df.groupBy(F.spark_partition_id().alias("p")).count().agg(F.sum("count"), F.max("count")).first()
    ids, most = (num_trees * (x or 0) for x in held)
    cores = df.sparkSession.sparkContext.defaultParallelism
    tasks = max(cores, 2 * -(-ids // task_ids))
    in_blocks = ids > block_ids and max_depth <= B.DEEPEST and max_bins <= B.MOST_BINS
    if in_blocks:
        if most * cores > 2 * ids:
            df = df.repartition(cores)
    elif most > task_ids or (most > DEALT_IDS and most * cores > 2 * ids):
        df = df.repartition(tasks)
    elif df.rdd.getNumPartitions() > 2 * tasks:
        df = df.coalesce(tasks)
    rf = RandomForestClassifier(
        featuresCol="_features", labelCol="_label_idx", numTrees=num_trees,
        maxDepth=max_depth, featureSubsetStrategy="sqrt", seed=seed,
        maxBins=max_bins, maxMemoryInMB=max_memory_mb,
        cacheNodeIds=ids <= cached_ids, checkpointInterval=10, predictionCol="_pred_idx", probabilityCol="_prob", rawPredictionCol="_raw",
    )
    if weight_col:
        rf.setWeightCol(weight_col)
    # IndexToString needs the fitted labels, so fit in two steps.
    prep = Pipeline(stages=[indexer, assembler]).fit(df)
    labels = prep.stages[0].labels
    decoder = IndexToString(inputCol="_pred_idx", outputCol="model_label", labels=labels)
    if in_blocks:
        forest = B.fitted(prep.stages[0].transform(df), rf, list(features), len(labels), seed, weight_col)
    else:
        forest = rf.fit(prep.transform(df))
    return PipelineModel(stages=[*prep.stages, forest, decoder])


def class_balanced_weights(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """ML5: weight = n / (k · n_class).  The per-class counts are one row per class; the
    totals over them use an unpartitioned window over those k rows only, and the k-row
    weight table is broadcast back after its row count has been checked."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_nc"))
    everything = Window.partitionBy()
    weights = counts.select(
        label,
        (F.sum("_nc").over(everything).cast("double") / (F.count(F.lit(1)).over(everything) * F.col("_nc"))).alias(out),
    )
    # broadcast only after checking the row count (one row per class); a normal join beyond it
    small = weights.count() <= MAX_BROADCAST_CLASSES
    return df.join(F.broadcast(weights) if small else weights, on=label, how="left")


def score(model: PipelineModel, df: DataFrame, pct_digits: int | None = 2) -> DataFrame:
    """ML6 / ML7: add ``model_label`` and ``model_confidence_pct`` (max class probability
    ×100, 2 digits) — or the fraction with 4 digits when ``pct_digits`` is None."""
    scored = model.transform(df)
    p = max_probability("_prob")
    conf = F.bround(p * 100.0, pct_digits) if pct_digits is not None else F.bround(p, 4)
    out = scored.withColumn("model_confidence_pct", conf)
    return out.drop("_features", "_raw", "_prob", "_pred_idx", "_label_idx")


def forest_of(model: PipelineModel):
    return next(s for s in model.stages if hasattr(s, "featureImportances"))


def feature_importances(model: PipelineModel, spark) -> DataFrame:
    """ML8: (feature, importance) as a DataFrame (one row per feature: bounded by the model)."""
    assembler = next(s for s in model.stages if isinstance(s, VectorAssembler))
    imps = forest_of(model).featureImportances.toArray().tolist()
    rows = list(zip(assembler.getInputCols(), [float(x) for x in imps]))
    schema = StructType([StructField("feature", StringType()), StructField("importance", DoubleType())])
    return spark.createDataFrame(rows, schema)


def describe_model(model: PipelineModel, spark) -> DataFrame:
    """ML9: model type, tree count, classes, feature count (one row)."""
    forest = forest_of(model)
    idx = next(s for s in model.stages if isinstance(s, StringIndexerModel))
    schema = StructType([
        StructField("model_type", StringType()), StructField("num_trees", StringType()),
        StructField("classes", StringType()), StructField("num_features", StringType()),
    ])
    row = (type(forest).__name__, str(forest.getNumTrees), ",".join(idx.labels), str(forest.numFeatures))
    return spark.createDataFrame([row], schema)


def fixed_label_encoder(labels: list[str]) -> StringIndexerModel:
    """ML2: encoder over a fixed class list (saved with the model, not fitted)."""
    return StringIndexerModel.from_labels(labels, inputCol="label", outputCol="label_idx")


def save_model(model: PipelineModel, path: str) -> None:
    """K5."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    """S10."""
    return PipelineModel.load(path)
