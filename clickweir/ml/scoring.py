"""Scoring of batch tables and streams."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.feature import StringIndexerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """``df`` with prediction columns."""
    return model.transform(df)


def required_columns(model: PipelineModel) -> list[str]:
    """Input columns in which a row to be scored must not be null.

    The inputs of all stages that no stage makes, but for those of string
    indexers, which have an index for unknown values.
    """
    needed: list[str] = []
    made: set[str] = set()
    for stage in model.stages:
        for kind, into in (("input", needed), ("output", None)):
            names: list[str] = []
            if stage.hasParam(f"{kind}Col") and stage.isDefined(stage.getParam(f"{kind}Col")):
                names.append(stage.getOrDefault(f"{kind}Col"))
            if stage.hasParam(f"{kind}Cols") and stage.isDefined(stage.getParam(f"{kind}Cols")):
                names += stage.getOrDefault(f"{kind}Cols")
            if into is None:
                made.update(names)
            elif not isinstance(stage, StringIndexerModel):
                into += names
    return [c for c in dict.fromkeys(needed) if c not in made]


def reply(scored: DataFrame, stamp: Column) -> DataFrame:
    """Scored requests as messages: the request id as key, the result as JSON value."""
    fields = [F.col("request_id"), F.col("prediction")]
    if "probability" in scored.columns:
        fields.append(vector_to_array("probability").alias("probability"))
    fields.append(stamp.alias("prediction_timestamp"))
    return scored.select(
        F.col("request_id").alias("key"), F.to_json(F.struct(*fields)).alias("value")
    )
