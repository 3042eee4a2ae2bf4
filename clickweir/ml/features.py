"""Column roles, feature stages, term weights and feature selection."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.ml import Pipeline
from pyspark.ml.feature import (
    IDF,
    PCA,
    HashingTF,
    NGram,
    OneHotEncoder,
    QuantileDiscretizer,
    StandardScaler,
    StopWordsRemover,
    StringIndexer,
    Tokenizer,
    UnivariateFeatureSelector,
    VarianceThresholdSelector,
    VectorAssembler,
    VectorSlicer,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickweir.functions.columns import hash_bucket
from clickweir.operators.joins import salted_join
from clickweir.operators.quality import column_profile
from clickweir.workspace import materialise, release_shuffles, remove, scratch, shared_dir


# Bytes of text a task takes whose words are counted: the counts of n-grams take some
# 45 times as much memory.
TASK_TEXT = 16 * 1024 * 1024
# Terms are weighed in at most so many slices, of the n-grams of so many bytes of text at least.
SLICES, SLICE_TEXT = 16, 32 * 1024 * 1024


def column_roles(
    df: DataFrame, *, max_categories: int = 50, skip: Sequence[str] = ("label", "id")
) -> DataFrame:
    """``(column_name, role)``: numeric, categorical (fewer than ``max_categories`` values) or text.

    A first pass estimates the distinct values of all string columns without
    moving them; only columns anywhere near the limit are counted exactly, so
    long free text is never shuffled. Null counts as a value. Columns of other
    types have no role.
    """
    names = [f for f in df.schema.fields if f.name not in skip]
    strings = [f.name for f in names if isinstance(f.dataType, T.StringType)]
    roles = [
        (f.name, "numeric") for f in names if isinstance(f.dataType, T.NumericType)
    ]
    if strings:
        estimate = {
            r["column_name"]: r["distinct_count"]
            for r in column_profile(df, strings).collect()
        }
        near = [c for c in strings if estimate[c] < 2 * max_categories]
        exact = (
            {r["column_name"]: r["distinct_count"] for r in column_profile(df, near, exact=True).collect()}
            if near
            else {}
        )
        roles += [
            (c, "categorical" if exact.get(c, max_categories) < max_categories else "text")
            for c in strings
        ]
    return df.sparkSession.createDataFrame(roles, "column_name string, role string")


def roles_by_kind(roles: DataFrame) -> dict[str, list[str]]:
    """The role table (one row per column) as ``{role: [columns]}``."""
    kinds: dict[str, list[str]] = {"categorical": [], "numeric": [], "text": []}
    for row in roles.orderBy("column_name").collect():
        kinds[row["role"]].append(row["column_name"])
    return kinds


def feature_pipeline(
    kinds: Mapping[str, Sequence[str]],
    *,
    bucketed: Sequence[str] = (),
    buckets: int = 10,
    hashed_terms: int = 1000,
    ngram: int = 2,
    language: str = "english",
    output: str = "features",
) -> Pipeline:
    """Stages that turn columns of each role into one scaled vector.

    Categories are indexed alphabetically and one-hot encoded, text becomes
    tf-idf over hashed n-grams without stop words, numbers go in as they are;
    those in ``bucketed`` also as quantile buckets. Rows with a null feature
    are skipped. The text stages that need no fitting come first, so that the
    fitted ones can start from stored term vectors; all categories share one
    indexer and are fitted in one pass.
    """
    plain: list = []
    fitted: list = []
    inputs: list[str] = []
    stop_words = StopWordsRemover.loadDefaultStopWords(language)
    for c in kinds.get("text", ()):
        plain += [
            Tokenizer(inputCol=c, outputCol=f"{c}_tokens"),
            StopWordsRemover(
                inputCol=f"{c}_tokens", outputCol=f"{c}_filtered", stopWords=stop_words
            ),
            NGram(n=ngram, inputCol=f"{c}_filtered", outputCol=f"{c}_ngrams"),
            HashingTF(inputCol=f"{c}_ngrams", outputCol=f"{c}_tf", numFeatures=hashed_terms),
        ]
        fitted.append(IDF(inputCol=f"{c}_tf", outputCol=f"{c}_tfidf"))
        inputs.append(f"{c}_tfidf")
    categories = list(kinds.get("categorical", ()))
    if categories:
        indexed = [f"{c}_indexed" for c in categories]
        encoded = [f"{c}_encoded" for c in categories]
        fitted += [
            StringIndexer(
                inputCols=categories,
                outputCols=indexed,
                handleInvalid="keep",
                stringOrderType="alphabetAsc",
            ),
            OneHotEncoder(inputCols=indexed, outputCols=encoded, dropLast=True),
        ]
        inputs += encoded
    if bucketed:
        outputs = [f"{c}_buckets" for c in bucketed]
        fitted.append(
            QuantileDiscretizer(
                numBuckets=buckets, inputCols=list(bucketed), outputCols=outputs
            )
        )
        inputs += outputs
    inputs += list(kinds.get("numeric", ()))
    last = [
        VectorAssembler(inputCols=inputs, outputCol="raw_features", handleInvalid="skip"),
        StandardScaler(
            inputCol="raw_features", outputCol=output, withStd=True, withMean=False
        ),
    ]
    return Pipeline(stages=[*plain, *fitted, *last])


def index_categories(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Alphabetical index of each column's value in ``<column>_indexed``."""
    indexer = StringIndexer(
        inputCols=list(columns),
        outputCols=[f"{c}_indexed" for c in columns],
        handleInvalid="keep",
        stringOrderType="alphabetAsc",
    )
    return indexer.fit(df).transform(df)


def words(text: Column) -> Column:
    """Lower-case words of a text, split at white space."""
    return F.array_remove(F.split(F.lower(text), r"\s+"), "")


def ngrams(tokens: Column, n: int) -> Column:
    """Runs of ``n`` neighbouring words, joined by blanks."""
    count = F.greatest(F.size(tokens) - (n - 1), F.lit(0))
    joined = F.slice(tokens, 1, count)
    for shift in range(2, n + 1):
        joined = F.zip_with(
            joined,
            F.slice(tokens, shift, count),
            lambda left, right: F.concat(left, F.lit(" "), right),
        )
    return joined


def _text_bytes(df: DataFrame, text: str) -> int:
    return df.agg(F.sum(F.octet_length(text))).first()[0] or 0


def terms(df: DataFrame, key: str, text: str, n: int = 1) -> DataFrame:
    """``(key, term, tf)``: how often each n-gram occurs in each row's whole text.

    The texts are dealt out by key before they are split. Spark then counts the
    terms of a key where its text is, so the texts move once and the terms,
    which are far more bytes, do not move at all. The number of tasks follows from
    the bytes of all texts, so what one of them holds does not grow with the table.
    """
    size = _text_bytes(df, text)
    tasks = max(math.ceil(size / TASK_TEXT), df.sparkSession.sparkContext.defaultParallelism)
    dealt = df.select(key, text).repartition(tasks, key)
    listed = dealt.select(key, words(F.col(text)).alias("_words"))
    found = F.col("_words") if n == 1 else ngrams(F.col("_words"), n)
    return (
        listed.select(key, F.explode(found).alias("term"))
        .groupBy(key, "term")
        .agg(F.count("*").alias("tf"))
    )


def tfidf_table(
    df: DataFrame, key: str, text: str, n: int = 2, share: float = 0.001
) -> DataFrame:
    """Exact tf-idf of every n-gram: ``(key, term, tf, df, tfidf)``, nothing hashed.

    ``idf = ln((N + 1) / (df + 1))`` with N rows. The counts per row and term
    are written once, since the frequencies and the result both need them.
    Terms that make up more than ``share`` of them are spread over several
    tasks in the join that brings the document frequency back.

    The counts take several times the room of the texts, and more on their way to the
    join. So they are written in slices of the terms, which are joined one after the
    other; the result is written, and what a slice wrote and moved is deleted with its end.
    """
    spark = df.sparkSession
    slices = max(1, min(SLICES, math.ceil(_text_bytes(df, text) / SLICE_TEXT)))
    rows = df.agg(F.count("*")).first()[0]
    found = terms(df, key, text, n)
    part = "term_slice"
    counts, joined = shared_dir(spark, "counts"), shared_dir(spark, "weighed")
    found = found.withColumn(part, hash_bucket([F.col("term")], slices))
    found.write.partitionBy(part).parquet(counts, compression="zstd")
    release_shuffles(spark)
    kinds = found.schema
    pairs = spark.read.schema(kinds).parquet(counts).count()
    for number in range(slices):
        counted = spark.read.schema(kinds).parquet(counts).where(F.col(part) == number).drop(part)
        with scratch(spark):
            weighed = _with_frequency(counted, key, share * pairs)
            weighed.write.parquet(joined, mode="append", compression="zstd")
        remove(spark, f"{counts}/{part}={number}")
        release_shuffles(spark)
    remove(spark, counts)
    weighed = spark.read.schema(weighed.schema).parquet(joined)
    idf = F.log((F.lit(rows).cast("long") + 1) / (F.col("df") + 1))
    return weighed.select(key, "term", "tf", "df", (F.col("tf") * idf).alias("tfidf"))


def _with_frequency(counted: DataFrame, key: str, often: float) -> DataFrame:
    """``counted`` with ``df``, the rows of the term; those of more than ``often`` are spread."""
    frequency = counted.groupBy("term").agg(F.count("*").alias("df"))
    frequency = materialise(frequency, compression="zstd")
    release_shuffles(counted.sparkSession)
    hot = frequency.where(F.col("df") > often).select("term")
    weighed = salted_join(counted, frequency, ["term"], hot=hot, spread_by=[key])
    return weighed.select(key, "term", "tf", "df")


def mutual_information(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """``(feature, mutual_information)`` in nats of discrete columns with a label."""
    long = df.select(
        label, *[F.col(c).cast("string").alias(c) for c in features]
    ).unpivot([label], list(features), "feature", "value")
    return long_information(long, label)


def long_information(long: DataFrame, label: str) -> DataFrame:
    """Mutual information from rows of ``(feature, value, label)``.

    One pass folds the rows to (feature, value, label) counts. From those the
    joint and both marginal entropies come out of one grouping-sets aggregate:
    MI = ln N + (Σ n ln n over pairs - over values - over labels) / N, with no
    join and no window over a column's values.
    """
    pairs = (
        long.where(F.col("value").isNotNull() & F.col(label).isNotNull())
        .groupBy("feature", "value", label)
        .agg(F.count("*").alias("n"))
    )
    return _information(pairs, label)


def _information(pairs: DataFrame, label: str) -> DataFrame:
    """From ``(feature, value, label, n)`` counts: both marginals in one grouping-sets pass."""
    sets = [
        [F.col("feature"), F.col("value"), F.col(label)],
        [F.col("feature"), F.col("value")],
        [F.col("feature"), F.col(label)],
    ]
    margins = pairs.groupingSets(sets, "feature", "value", label).agg(
        F.sum("n").alias("n"),
        (F.grouping("value") + F.grouping(label)).alias("_rolled"),
    )
    joint = F.col("_rolled") == 0
    n_log_n = F.col("n") * F.log("n")
    folded = margins.groupBy("feature").agg(
        F.sum(F.when(joint, F.col("n"))).alias("rows"),
        F.sum(F.when(joint, n_log_n).otherwise(-n_log_n)).alias("entropy_terms"),
    )
    return folded.select(
        "feature",
        (F.log("rows") + F.col("entropy_terms") / F.col("rows")).alias("mutual_information"),
    )


def vector_information(df: DataFrame, vectors: str, label: str) -> DataFrame:
    """``(feature, mutual_information)`` of each position of a vector column of discrete values.

    Only values other than zero become rows. How often a position is zero for a
    label follows from the rows of that label: one more (feature, 0, label)
    count per position, so a sparse vector costs its stored entries.
    """
    values = vector_to_array(vectors)
    known = df.where(F.col(label).isNotNull() & F.col(vectors).isNotNull())
    stored = F.filter(
        F.transform(values, lambda x, i: F.struct(i.alias("feature"), x.alias("value"))),
        lambda x: x["value"] != 0.0,
    )
    pairs = (
        known.select(label, F.inline(stored))
        .groupBy("feature", "value", label)
        .agg(F.count("*").alias("n"))
    )
    totals = known.groupBy(label).agg(
        F.count("*").alias("rows"), F.max(F.size(values)).alias("size")
    )
    positions = F.explode(F.sequence(F.lit(0), F.col("size") - 1)).alias("feature")
    every = totals.select(label, "rows", positions)
    met = pairs.groupBy("feature", label).agg(F.sum("n").alias("met"))
    zeros = every.join(met, ["feature", label], "left").select(
        "feature",
        F.lit(0.0).alias("value"),
        label,
        (F.col("rows") - F.coalesce("met", F.lit(0))).alias("n"),
    )
    return _information(pairs.unionByName(zeros.where(F.col("n") > 0)), label)


def variance_by_feature(df: DataFrame, vectors: str) -> DataFrame:
    """``(feature, variance)`` of each position of an array column, from one aggregate."""
    as_vector = array_to_vector(F.col(vectors).cast("array<double>"))
    variance = df.agg(Summarizer.variance(as_vector).alias("v"))
    return variance.select(
        F.posexplode(vector_to_array("v")).alias("feature", "variance")
    )


def scale(df: DataFrame, columns: Sequence[str], output: str = "scaled") -> DataFrame:
    """``columns`` divided by their sample deviation, as an array column.

    Every row stays: a null stays null, and does not count for its column's
    deviation. A column that does not vary becomes 0.
    """
    deviations = df.agg(F.struct(*[F.stddev_samp(c).alias(c) for c in columns])).scalar()

    def scaled(c: str) -> Column:
        std = deviations.getField(c)
        return F.when(std > 0, F.col(c) / std).when(F.col(c).isNotNull(), F.lit(0.0))

    return df.withColumn(output, F.array(*[scaled(c).cast("double") for c in columns]))


def project(df: DataFrame, vectors: str, k: int, output: str = "components") -> DataFrame:
    """First ``k`` principal components of a vector column."""
    return PCA(k=k, inputCol=vectors, outputCol=output).fit(df).transform(df)


def discretise(df: DataFrame, column: str, buckets: int = 10) -> DataFrame:
    """Quantile bucket of ``column`` in ``<column>_buckets``."""
    stage = QuantileDiscretizer(
        numBuckets=buckets, inputCol=column, outputCol=f"{column}_buckets"
    )
    return stage.fit(df).transform(df)


def select_features(
    df: DataFrame,
    method: str,
    k: float,
    *,
    features: str = "features",
    label: str = "label",
    output: str = "selected",
):
    """A fitted transformer that keeps some positions of a vector column.

    ``chi_squared`` and ``mutual_info`` keep the ``k`` best positions (their
    values must be discrete), ``variance_threshold`` those whose variance
    exceeds ``k``.
    """
    if method == "chi_squared":
        selector = UnivariateFeatureSelector(
            featuresCol=features,
            labelCol=label,
            outputCol=output,
            selectionMode="numTopFeatures",
        )
        selector.setFeatureType("categorical").setLabelType("categorical")
        return selector.setSelectionThreshold(k).fit(df)
    if method == "variance_threshold":
        return VarianceThresholdSelector(
            featuresCol=features, outputCol=output, varianceThreshold=float(k)
        ).fit(df)
    if method == "mutual_info":
        scores = vector_information(df, features, label)
        best = scores.orderBy(F.desc("mutual_information"), "feature").limit(int(k)).collect()
        indices = sorted(r["feature"] for r in best)
        return VectorSlicer(inputCol=features, outputCol=output, indices=indices)
    raise ValueError(f"unknown method {method!r}")
