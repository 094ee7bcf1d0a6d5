"""Boosted-tree quality model: training, search over settings, scoring and records."""

from __future__ import annotations

import random
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from serpscope import schema as S
from serpscope.operators.kpi import sample_n
from serpscope.plans.training import clipped, feature_columns, regression_metrics
from serpscope.session import materialize

# Search ranges per setting.
MAX_DEPTH = (3, 8)
STEP_SIZE = (0.01, 0.15)
TREES = (50, 150)
ROW_SHARE = (0.6, 1.0)
COLUMN_SHARE = (0.6, 1.0)


def assemble(df: DataFrame) -> DataFrame:
    """Model input vector in contract order, from 32-bit features."""
    keep = [c for c in df.columns if c not in S.FEATURES]
    narrow = feature_columns(df, *keep)
    return VectorAssembler(inputCols=S.FEATURES, outputCol="features").transform(narrow)


#: Settings of a model that no search has tuned, within the ranges above.
DEFAULTS = {"maxDepth": 5, "stepSize": 0.1, "maxIter": 50, "subsamplingRate": 0.8}
#: Rows for which a task is worth its start: every level of a tree passes over the data.
TASK_ROWS = 100_000


def training_vectors(matrix: DataFrame, partitions: int | None = None) -> DataFrame:
    """Input vectors and label of every row, written in ``partitions`` parts, by default one for
    each TASK_ROWS rows. Trainings on the same rows share them."""
    vectors = assemble(matrix).select("features", S.LABEL)
    if partitions is None:
        vectors = materialize(vectors, "vectors")
        partitions = max(1, -(-vectors.count() // TASK_ROWS))
    return materialize(vectors.repartition(partitions), "vectors")


def train_quality_model(
    matrix: DataFrame, seed: int = 42, partitions: int | None = None, **params
) -> GBTRegressionModel:
    """Trains on every row given; statistics per split are aggregated on the executors.

    The input vectors are assembled and written first, unless the rows are `training_vectors`
    already. Settings that are not given are those of DEFAULTS.
    """
    trainer = GBTRegressor(
        labelCol=S.LABEL, featuresCol="features", seed=seed, cacheNodeIds=True, **(DEFAULTS | params)
    )
    ready = "features" in matrix.columns
    return trainer.fit(matrix if ready else training_vectors(matrix, partitions))


def predict(model: GBTRegressionModel, df: DataFrame) -> DataFrame:
    scored = model.transform(assemble(df))
    return clipped(scored, "prediction").drop("features")


def holdout_metrics(model: GBTRegressionModel, matrix: DataFrame) -> DataFrame:
    return regression_metrics(predict(model, matrix), S.LABEL, "prediction")


def trial_settings(
    trials: int, seed: int, depths: tuple = MAX_DEPTH, trees: tuple = TREES
) -> list[dict]:
    """Seeded random settings within the search ranges."""
    draw = random.Random(seed)
    return [
        {
            "maxDepth": draw.randint(*depths),
            "stepSize": draw.uniform(*STEP_SIZE),
            "maxIter": draw.randint(*trees),
            "subsamplingRate": draw.uniform(*ROW_SHARE),
            "featureSubsetStrategy": str(draw.uniform(*COLUMN_SHARE)),
        }
        for _ in range(trials)
    ]


#: Rows that a search looks at: a bound on labelled rows, drawn by hash from larger tables.
SEARCH_ROWS = 50_000


def tune_quality_model(
    matrix: DataFrame,
    trials: int = 5,
    seed: int = 42,
    parallelism: int = 4,
    depths: tuple = MAX_DEPTH,
    trees: tuple = TREES,
    key: str = "event_id",
    rows: int = SEARCH_ROWS,
) -> tuple[dict, DataFrame]:
    """Lowest hold-out MAE over random settings: (best settings, one row per trial).

    The input vectors are assembled and written once and shared by all trials, which run side by
    side; a fifth of the rows, by hash, is held out. The best settings go to `train_quality_model`,
    which learns from every row.
    """
    spark = matrix.sparkSession
    some = sample_n(matrix.select(key, *S.FEATURES, S.LABEL), rows, seed, key)
    vectors = assemble(some).select(
        "features", S.LABEL, (F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(5)) == 0).alias("_held")
    )
    # Bounded by `rows`: a single file, so that a level of a tree is one short task.
    vectors = materialize(vectors.coalesce(1), "search")
    fit, held = vectors.where("not _held"), vectors.where("_held")
    settings = trial_settings(trials, seed, depths, trees)

    def trial(own: dict) -> float:
        trainer = GBTRegressor(
            labelCol=S.LABEL, featuresCol="features", seed=seed, cacheNodeIds=True, **own
        )
        scored = trainer.fit(fit).transform(held)
        return scored.agg(F.avg(F.abs(F.col(S.LABEL) - F.col("prediction")))).first()[0]

    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        scores = list(pool.map(inheritable_thread_target(spark)(trial), settings))
    names = ["maxDepth", "stepSize", "maxIter", "subsamplingRate"]
    table = spark.createDataFrame(
        [
            (i, *(s[n] for n in names), float(s["featureSubsetStrategy"]), float(mae))
            for i, (s, mae) in enumerate(zip(settings, scores, strict=True))
        ],
        "trial int, max_depth int, step_size double, trees int, row_share double, "
        "column_share double, mae double",
    )
    return settings[min(range(trials), key=lambda i: scores[i])], table


def model_record(
    spark: SparkSession,
    name: str,
    version: str,
    metrics: DataFrame,
    importances: DataFrame,
    recorded_at: str | None = None,
) -> DataFrame:
    """One row per trained model with its measured metrics and ranked importances; the time is
    now unless one is given."""
    at = F.current_timestamp() if recorded_at is None else F.lit(recorded_at).cast("timestamp")
    ranked = importances.agg(
        F.sort_array(F.collect_list(F.struct("importance", "feature")), asc=False).alias(
            "importances"
        )
    )
    one = F.lit(1)
    return (
        metrics.withColumn("_one", one)
        .join(ranked.withColumn("_one", one), "_one")
        .select(
            F.lit(name).alias("model_name"),
            F.lit(version).alias("version"),
            "mae",
            "r2",
            F.col("row_count").alias("holdout_rows"),
            "importances",
            at.alias("recorded_at"),
        )
    )


def promote_if_better(records: DataFrame) -> DataFrame:
    """Per model name the version with the lowest MAE becomes active; a challenger must beat
    the version before it, so earlier records win ties."""
    best = records.groupBy("model_name").agg(
        F.min_by("version", F.struct("mae", "recorded_at", "version")).alias("_active")
    )
    status = F.when(F.col("version") == F.col("_active"), "active").otherwise("shadow")
    return records.join(best, "model_name").withColumn("status", status).drop("_active")
