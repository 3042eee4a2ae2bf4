"""Splitting, grids, cross-validation, model choice, saving."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from contextlib import ExitStack
from datetime import datetime, timezone
from itertools import takewhile

from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import (
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    NaiveBayes,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickweir.functions.columns import hash_bucket
from clickweir.ml.evaluate import evaluate
from clickweir.operators.layout import cached

MODELS = {
    "logistic": LogisticRegression,
    "random_forest": RandomForestClassifier,
    "gbt": GBTClassifier,
    "linear_svc": LinearSVC,
    "naive_bayes": NaiveBayes,
}

# Fixed parameters and search grids of the classifiers.
FIXED_PARAMS = {
    "logistic": {
        "maxIter": 10,
        "regParam": 0.1,
        "elasticNetParam": 0.8,
        "standardization": True,
        "threshold": 0.5,
    },
}
GRIDS = {
    "logistic": {"regParam": [0.1], "elasticNetParam": [0.8], "maxIter": [10]},
    "random_forest": {
        "maxDepth": [5, 10, 15],
        "numTrees": [50, 100, 200],
        "minInstancesPerNode": [1, 5, 10],
    },
    "gbt": {"maxDepth": [3, 5, 7], "maxIter": [10, 20, 30], "stepSize": [0.01, 0.1, 0.5]},
    "linear_svc": {
        "regParam": [0.01, 0.1, 1.0],
        "maxIter": [50, 100, 200],
        "aggregationDepth": [2, 4, 8],
    },
    "naive_bayes": {"smoothing": [0.5, 1.0, 2.0]},
}


def classifier(name: str, label: str = "label", features: str = "features"):
    """A classifier by name with its fixed parameters."""
    return MODELS[name](labelCol=label, featuresCol=features, **FIXED_PARAMS.get(name, {}))


def param_grid(model, grid: Mapping[str, Sequence]) -> list:
    """Every combination of the values in ``grid``."""
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(model.getParam(name), list(values))
    return builder.build()


def split(
    df: DataFrame, key: Sequence[str], share: float = 0.8, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """Two disjoint parts by a hash of ``key``: the same row always goes the same way,
    whatever the files or partitions look like."""
    bucket = hash_bucket([F.lit(seed), *[F.col(k) for k in key]], 10_000)
    limit = round(share * 10_000)
    return df.where(bucket < limit), df.where(bucket >= limit)


def label_rows(df: DataFrame, labels: DataFrame, key: str) -> DataFrame:
    """Rows with their label from a second table; rows without one drop out."""
    return df.join(labels, key).dropna(subset=["label"])


def _needs_no_fit(stage) -> bool:
    """True for a stage that maps one column without having seen any data."""
    return isinstance(stage, Transformer) and stage.hasParam("inputCol") and stage.isSet("inputCol")


def train(
    train_df: DataFrame,
    test_df: DataFrame,
    features: Pipeline,
    *,
    models: Sequence[str] = ("logistic",),
    grids: Mapping[str, Mapping[str, Sequence]] | None = None,
    key: Sequence[str] = ("id",),
    folds: int = 3,
    parallelism: int = 4,
    seed: int = 42,
    features_per_fold: bool = False,
) -> tuple[PipelineModel, DataFrame]:
    """The model with the best area under ROC on ``test_df``, and the leaderboard.

    The feature stages never look at the label, so they are fitted once, on
    term vectors hashed once, and the folds only refit the classifier;
    ``features_per_fold=True`` refits them in every fold instead. Folds come
    from a hash of ``key``.
    """
    grids = grids or GRIDS
    folded = train_df.withColumn(
        "fold", hash_bucket([F.lit(seed + 1), *[F.col(k) for k in key]], folds)
    )
    stages = list(features.getStages())
    shared: list = []
    results = []
    with ExitStack() as stack:
        held = stack.enter_context(ExitStack())
        if features_per_fold:
            fit_on, test_on = folded, test_df
        else:
            lead = list(takewhile(_needs_no_fit, stages))
            spent = [stage.getInputCol() for stage in lead]
            # Word splitting and hashing once; only the hashed vectors are kept.
            hashed = [
                held.enter_context(cached(PipelineModel(lead).transform(df).drop(*spent)))
                for df in (folded, test_df)
            ]
            rest = Pipeline(stages=stages[len(lead) :]).fit(hashed[0])
            shared = [*lead, *rest.stages]
            fit_on = rest.transform(hashed[0]).select("features", "label", "fold")
            test_on = rest.transform(hashed[1]).select("features", "label")
        fit_rows = stack.enter_context(cached(fit_on))
        test_rows = stack.enter_context(cached(test_on))
        # Filled before the parallel fits ask for them; the hashed rows are then done with.
        for rows in (fit_rows, test_rows):
            rows.count()
        held.close()
        for name in models:
            model = classifier(name)
            search = CrossValidator(
                estimator=Pipeline(stages=[model] if shared else [*stages, model]),
                estimatorParamMaps=param_grid(model, grids.get(name, {})),
                evaluator=BinaryClassificationEvaluator(metricName="areaUnderROC", numBins=0),
                numFolds=folds,
                foldCol="fold",
                parallelism=parallelism,
                seed=seed,
            )
            best = search.fit(fit_rows).bestModel
            metrics = evaluate(best.transform(test_rows))
            results.append((name, metrics, best))
    if not results:
        raise ValueError("no model was trained")
    board = [
        (
            name,
            *[metrics[m] for m in METRICS],
            json.dumps({p.name: str(v) for p, v in best.stages[-1].extractParamMap().items()}),
        )
        for name, metrics, best in results
    ]
    _, _, winner = max(results, key=lambda r: r[1]["auc"])
    whole = PipelineModel([*shared, *winner.stages])
    spark = train_df.sparkSession
    columns = ", ".join(["model string", *[f"{m} double" for m in METRICS], "params string"])
    return whole, spark.createDataFrame(board, columns).orderBy(F.desc("auc"), "model")


METRICS = ("auc", "pr_auc", "accuracy", "f1", "weighted_precision", "weighted_recall")


def save(
    model: PipelineModel,
    path: str,
    spark: SparkSession,
    *,
    request_schema: T.StructType,
    kinds: Mapping[str, Sequence[str]],
    stamp: datetime | None = None,
) -> str:
    """Save a model below ``path`` with a metadata row next to it; returns its folder.

    The metadata goes through Spark, so any file system will do; it names the
    columns a scoring request must bring.
    """
    when = (stamp or datetime.now(timezone.utc)).strftime("%Y%m%dT%H%M%S%f")
    folder = f"{path}/model_{when}"
    model.write().overwrite().save(f"{folder}/stages")
    meta = [
        (
            when,
            folder,
            json.dumps({k: list(v) for k, v in kinds.items()}),
            request_schema.json(),
            len(model.stages),
            spark.version,
        )
    ]
    columns = (
        "saved_at string, model_path string, column_roles string, request_schema string, "
        "stage_count int, spark_version string"
    )
    spark.createDataFrame(meta, columns).coalesce(1).write.mode("overwrite").json(
        f"{folder}/metadata"
    )
    return folder


def load(spark: SparkSession, folder: str) -> tuple[PipelineModel, T.StructType]:
    """A saved model and the schema of the requests it scores."""
    meta = spark.read.schema("request_schema string").json(f"{folder}/metadata").first()
    schema = T.StructType.fromJson(json.loads(meta["request_schema"]))
    return PipelineModel.load(f"{folder}/stages"), schema
