"""The training job: load, profile, split, train, save."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from clickweir.ml import features as feat
from clickweir.ml import train as training
from clickweir.workspace import materialise


def run_training(
    df: DataFrame,
    path: str | None = None,
    *,
    test_df: DataFrame | None = None,
    key: Sequence[str] = ("id",),
    models: Sequence[str] = ("logistic",),
    grids: Mapping[str, Mapping[str, Sequence]] | None = None,
    folds: int = 3,
) -> tuple[PipelineModel, DataFrame, str | None]:
    """Train on ``df`` and, given a ``path``, save; returns model, leaderboard and folder.

    A given ``test_df`` is used as it is; without one a fifth of the rows is
    held back. Profiling and fitting read the rows many times, so whatever
    ``df`` joins or filters runs once and is written down first.
    """
    labelled = materialise(df.dropna(subset=["label"]))
    if test_df is None:
        train_df, test_df = training.split(labelled, key)
    else:
        train_df, test_df = labelled, test_df.dropna(subset=["label"])
    kinds = feat.roles_by_kind(feat.column_roles(train_df, skip=["label", *key]))
    model, board = training.train(
        train_df,
        test_df,
        feat.feature_pipeline(kinds),
        models=models,
        grids=grids,
        key=key,
        folds=folds,
    )
    folder = None
    if path:
        used = {c for names in kinds.values() for c in names}
        request = T.StructType([f for f in df.schema.fields if f.name in used])
        folder = training.save(
            model, path, df.sparkSession, request_schema=request, kinds=kinds
        )
    return model, board, folder
