"""Severity classifier: training, prediction, evaluation, baseline."""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata import presets as P
from strata.operators.ingest import split_hash

# Rows a partition should hold at most where a task sorts a whole partition.
PARTITION_ROWS = 250_000


def train_test_split(df: DataFrame, key: str = P.KEY, weights: list[float] | None = None,
                     seed: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Hash split by key (stable under re-partitioning and task retries);
    pass `seed` to use Spark's seeded `randomSplit` instead."""
    weights = P.TRAIN_TEST_WEIGHTS if weights is None else weights
    if seed is not None:
        train, test = df.randomSplit(weights, seed)
    else:
        train, test = split_hash(df, key, weights)
    return train, test


def train_forest(train: DataFrame, label: str = P.LABEL, features: str = "features",
                 num_trees: int = P.RF_NUM_TREES, max_bins: int = P.RF_MAX_BINS,
                 seed: int = P.SPLIT_SEED, **params) -> RandomForestClassificationModel:
    """Random-forest fit (distributed: per-node histogram aggregates).

    Each tree samples rows partition by partition, so the forest depends on
    the layout of `train` and the seed: a frame laid out by `lay_out` gives the
    same forest on any number of cores.  Extra `params` (maxDepth,
    subsamplingRate, maxMemoryInMB, cacheNodeIds, checkpointInterval, ...) pass
    through.
    """
    rf = RandomForestClassifier(labelCol=label, featuresCol=features, numTrees=num_trees,
                                maxBins=max_bins, seed=seed, **params)
    return rf.fit(train)


def partitions_for(spark: SparkSession, rows: int) -> int:
    """Partitions for `rows` rows: the session's shuffle partition count, or as
    many more as keep a partition at about `PARTITION_ROWS`, so that a sort's
    memory does not grow with the input."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // PARTITION_ROWS))


def lay_out(df: DataFrame, partitions: int | None = None, key: str = P.KEY) -> DataFrame:
    """Rows hashed by key into an explicit number of partitions and sorted
    within them: the layout follows the keys and that number alone.  The
    default is the session's shuffle partition count, which a cluster sizes to
    its data."""
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, key).sortWithinPartitions(key)


def predict_all(model, assembled: DataFrame, keep: list[str],
                out: str = P.PREDICTION_CLASS) -> DataFrame:
    """Score every row; keep the given original columns plus the int class."""
    scored = model.transform(assembled)
    return scored.select(*[F.col(f"`{c}`") for c in keep],
                         F.col("prediction").cast("int").alias(out))


def save_model(model: RandomForestClassificationModel, path: str) -> None:
    """Store a fitted forest, replacing an earlier one."""
    model.write().overwrite().save(path)


def load_model(path: str) -> RandomForestClassificationModel:
    return RandomForestClassificationModel.load(path)


def accuracy(scored: DataFrame, label: str = P.LABEL, prediction: str = "prediction") -> float:
    """Share of rows whose prediction equals the label (Spark ML evaluator)."""
    ev = MulticlassClassificationEvaluator(labelCol=label, predictionCol=prediction,
                                           metricName="accuracy")
    return ev.evaluate(scored)


def accuracy_frame(scored: DataFrame, label: str = P.LABEL,
                   prediction: str = "prediction") -> DataFrame:
    """The same metric as a one-row aggregate: (rows, correct, accuracy)."""
    hit = (F.col(label).cast("double") == F.col(prediction).cast("double"))
    return scored.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count(F.when(hit, F.lit(1))).alias("correct"),
        F.avg(hit.cast("double")).alias("accuracy"),
    )


def class_counts(df: DataFrame, label: str = P.LABEL) -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def majority_baseline(df: DataFrame, label: str = P.LABEL) -> DataFrame:
    """Most frequent label (ties: smallest) and its share of the rows.

    A grouped count (one row per class after partial aggregation) followed
    by a global aggregate over the few class rows.
    """
    counts = class_counts(df, label)
    return counts.agg(
        F.max_by(F.col(label), F.struct(F.col("n"), -F.col(label))).alias("majority_class"),
        F.max("n").alias("majority_rows"),
        F.sum("n").alias("rows"),
    ).withColumn("majority_share", F.col("majority_rows") / F.col("rows"))


def majority_class(df: DataFrame, label: str = P.LABEL):
    """The majority label as a scalar (one aggregate; one value to the driver)."""
    return majority_baseline(df, label).first()["majority_class"]


def predict_constant(df: DataFrame, value, out: str = "prediction") -> DataFrame:
    """Score every row with a constant model (e.g. the majority class)."""
    return df.withColumn(out, F.lit(value).cast("double"))
