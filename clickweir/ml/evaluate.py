"""Evaluation of predictions as table jobs."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickweir.functions.columns import ratio


def confusion(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Rows per (label, prediction)."""
    return pred.groupBy(label, prediction).agg(F.count("*").alias("n"))


def distribution(pred: DataFrame, prediction: str = "prediction") -> DataFrame:
    """Rows per predicted class."""
    return pred.groupBy(prediction).agg(F.count("*").alias("n"))


def eval_table(
    pred: DataFrame, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """One row: accuracy and class-weighted precision, recall and F1.

    Everything follows from the confusion counts, so the predictions are read
    once and only (classes x classes) rows are shuffled.
    """
    cells = confusion(pred, label, prediction)
    hit = F.col(label).cast("double") == F.col(prediction).cast("double")
    zero = F.lit(0)
    sides = F.array(
        F.struct(
            F.col(label).cast("double").alias("class"),
            F.when(hit, F.col("n")).otherwise(zero).alias("tp"),
            F.col("n").alias("actual"),
            zero.cast("long").alias("predicted"),
        ),
        F.struct(
            F.col(prediction).cast("double").alias("class"),
            zero.cast("long").alias("tp"),
            zero.cast("long").alias("actual"),
            F.col("n").alias("predicted"),
        ),
    )
    classes = (
        cells.select(F.inline(sides))
        .groupBy("class")
        .agg(
            F.sum("tp").alias("tp"),
            F.sum("actual").alias("actual"),
            F.sum("predicted").alias("predicted"),
        )
        .withColumns(
            {
                "p": ratio(F.col("tp"), F.col("predicted")),
                "r": ratio(F.col("tp"), F.col("actual")),
            }
        )
    )
    f1 = ratio(2 * F.col("p") * F.col("r"), F.col("p") + F.col("r"))
    weight = F.col("actual")
    total = F.sum("actual")
    return classes.agg(
        F.try_divide(F.sum("tp"), total).alias("accuracy"),
        F.try_divide(F.sum(f1 * weight), total).alias("f1"),
        F.try_divide(F.sum(F.col("p") * weight), total).alias("weighted_precision"),
        F.try_divide(F.sum(F.col("r") * weight), total).alias("weighted_recall"),
    )


def threshold_curve(
    pred: DataFrame,
    score: str,
    label: str = "label",
    *,
    bins: int = 1000,
    low: float | None = None,
    high: float | None = None,
    fold: bool = False,
) -> DataFrame:
    """Precision and recall at each threshold ``low + i * (high - low) / bins``.

    ``low`` and ``high`` default to the least and the greatest score there is.
    The rows are folded to (bin, hits) counts first. The running sums then see
    at most ``bins`` rows and are exact at every threshold. A score below
    ``low`` or null is not above any threshold: it counts in the recall's
    total only. One above ``high`` is above all of them.

    ``fold`` is for predictions that cost much to make and have few distinct scores:
    they are made once and folded to one row per score, from which both the ends and
    the bins come. Otherwise ``pred`` is read twice where an end is not given, and no
    row is shuffled before it is in its bin.
    """
    value = F.col("score")
    rows = pred.select(
        F.col(score).cast("double").alias("score"),
        F.lit(1).cast("long").alias("rows"),
        F.col(label).cast("long").alias("hits"),
    )
    totals = [F.sum("rows").alias("rows"), F.sum("hits").alias("hits")]
    if fold:
        rows = rows.groupBy("score").agg(*totals)
    # With the sums in it, it is made from the same shuffled rows as the bins are.
    edges = [F.min(value).alias("low"), F.max(value).alias("high"), *(totals if fold else [])]
    ends = rows.agg(F.struct(*edges)).scalar()
    begin = ends["low"] if low is None else F.lit(float(low))
    end = ends["high"] if high is None else F.lit(float(high))

    def lower(number: Column) -> Column:
        return begin + number * (end - begin) / F.lit(float(bins))

    width = F.when(end > begin, end - begin).otherwise(F.lit(1.0))
    guess = F.floor((value - begin) * F.lit(float(bins)) / width)
    # The division may round across a bound; the bounds themselves decide.
    above = (lower(guess + 1) <= value).cast("int")
    below = (lower(guess) > value).cast("int")
    inside = F.when(end > begin, guess + above - below).otherwise(F.lit(bins - 1))
    bin_of = F.when(value >= begin, F.least(F.lit(bins - 1), inside)).cast("int")
    counted = rows.groupBy(bin_of.alias("bin")).agg(*totals)
    down = Window.orderBy(F.col("bin").desc_nulls_last())
    whole = Window.partitionBy()
    curve = counted.select(
        "bin",
        lower(F.col("bin")).alias("threshold"),
        F.sum("rows").over(down).alias("predicted_positive"),
        F.sum("hits").over(down).alias("true_positive"),
        ratio(F.sum("hits").over(down), F.sum("rows").over(down)).alias("precision"),
        ratio(F.sum("hits").over(down), F.sum("hits").over(whole)).alias("recall"),
    )
    return curve.where("bin is not null").drop("bin")


def areas(pred: DataFrame, score: str, label: str = "label") -> DataFrame:
    """One row: areas under the ROC and the precision-recall curve, over every distinct score."""
    known = pred.select(F.col(score).cast("double").alias("score"), F.col(label).cast("double").alias("label"))
    judge = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", numBins=0)
    found = [
        float(judge.setMetricName(name).evaluate(known.dropna()))
        for name in ("areaUnderROC", "areaUnderPR")
    ]
    return pred.sparkSession.createDataFrame([tuple(found)], "auc double, pr_auc double")


def evaluate(pred: DataFrame, label: str = "label") -> dict[str, float]:
    """All figures of one model: areas under ROC and PR, and ``eval_table``."""
    raw = BinaryClassificationEvaluator(labelCol=label, numBins=0)
    figures = {
        "auc": raw.setMetricName("areaUnderROC").evaluate(pred),
        "pr_auc": raw.setMetricName("areaUnderPR").evaluate(pred),
    }
    figures.update(eval_table(pred, label).first().asDict())
    return {k: float(v) for k, v in figures.items()}


def importance(model: PipelineModel, scored: DataFrame, top: int | None = 10) -> DataFrame:
    """``(feature, importance)``, largest first, with names from the vector's metadata.

    Tree models give their importances, linear models the size of their
    coefficients.
    """
    last = model.stages[-1]
    if hasattr(last, "featureImportances"):
        weights = last.featureImportances.toArray()
    elif hasattr(last, "coefficients"):
        weights = abs(last.coefficients.toArray())
    else:
        raise ValueError(f"{type(last).__name__} has no importances")
    names = {i: f"feature_{i}" for i in range(len(weights))}
    attributes = scored.schema["raw_features"].metadata.get("ml_attr", {}).get("attrs", {})
    for group in attributes.values():
        names.update({a["idx"]: a.get("name", names[a["idx"]]) for a in group})
    rows = [(names[i], float(w)) for i, w in enumerate(weights)]
    table = (
        scored.sparkSession.createDataFrame(rows, "feature string, importance double")
        .orderBy(F.desc("importance"), "feature")
    )
    return table.limit(top) if top else table
