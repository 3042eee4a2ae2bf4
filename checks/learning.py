"""Features, evaluation, training and scoring."""

from __future__ import annotations

from pyspark.ml.feature import StopWordsRemover
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from checks.tables import rounded, table
from clickweir.ml import evaluate, features, train
from clickweir.ml.scoring import score
from clickweir.plans.training import run_training
from clickweir.workspace import shared_dir


def labelled(spark: SparkSession, d: str) -> DataFrame:
    """Documents with a quality label, as training rows."""
    labels = table(spark, d, "labels").select(
        "doc_id", F.col("quality").cast("double").alias("label")
    )
    return train.label_rows(table(spark, d, "documents"), labels, "doc_id")


def string_index(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "lang", "source")
    return features.index_categories(docs, ["lang", "source"])


def one_hot(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "lang", "n_chars")
    stages = features.feature_pipeline({"categorical": ["lang"], "numeric": ["n_chars"]})
    rows = stages.fit(docs).transform(docs)
    return rows.select("doc_id", F.array_position(vector_to_array("lang_encoded"), 1.0).alias("at"))


def tokens(spark: SparkSession, d: str) -> DataFrame:
    found = features.terms(table(spark, d, "documents"), "doc_id", "text", 1)
    return found.groupBy("term").agg(F.sum("tf").alias("n"), F.count("*").alias("docs"))


def bigrams(spark: SparkSession, d: str) -> DataFrame:
    found = features.terms(table(spark, d, "documents"), "doc_id", "text", 2)
    return found.groupBy("doc_id").agg(
        F.sum("tf").alias("n"), F.count("*").alias("terms"), F.max("tf").alias("top")
    )


def tfidf(spark: SparkSession, d: str) -> DataFrame:
    return rounded(features.tfidf_table(table(spark, d, "documents"), "doc_id", "text"), 6)


def mutual_information(spark: SparkSession, d: str) -> DataFrame:
    rows = labelled(spark, d).select("label", "lang", "source")
    return rounded(features.mutual_information(rows, ["lang", "source"], "label"), 8)


def variance(spark: SparkSession, d: str) -> DataFrame:
    return rounded(features.variance_by_feature(table(spark, d, "embeddings"), "embedding"), 8)


def scaled(spark: SparkSession, d: str) -> DataFrame:
    rows = features.scale(table(spark, d, "lineitem"), ["l_quantity", "l_extendedprice"])
    return rounded(
        rows.select(
            "l_orderkey",
            F.col("scaled")[0].alias("quantity"),
            F.col("scaled")[1].alias("price"),
        )
    )


def quantile_buckets(spark: SparkSession, d: str) -> DataFrame:
    """Buckets in the order of their values, each within the stated error of a tenth."""
    rows = features.discretise(table(spark, d, "orders"), "o_totalprice", 10)
    found = rows.groupBy("o_totalprice_buckets").agg(
        F.count("*").alias("n"),
        F.min("o_totalprice").alias("least"),
        F.max("o_totalprice").alias("most"),
    )
    in_order = Window.orderBy("o_totalprice_buckets")
    total = F.sum("n").over(Window.partitionBy())
    return found.select(
        F.col("o_totalprice_buckets").alias("bucket"),
        F.coalesce(F.col("least") > F.lag("most").over(in_order), F.lit(True)).alias("apart"),
        (F.abs(F.col("n") - total / 10) <= 2 * 0.001 * total + 1).alias("even"),
    )


def _vectors(spark, d):
    values = F.col("embedding").cast("array<double>")
    return table(spark, d, "embeddings").select(
        "vec_id",
        F.col("label").cast("double").alias("label"),
        array_to_vector(values).alias("vector"),
        array_to_vector(
            F.transform(values, lambda x: F.when(x > 0, 1.0).otherwise(0.0))
        ).alias("signs"),
    )


def components(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of components: variances fall, different components do not vary together."""
    rows = features.project(_vectors(spark, d), "vector", 4)
    c = vector_to_array("components")
    wide = rows.select(*[F.get(c, F.lit(i)).alias(f"c{i}") for i in range(4)])
    pairs = [(i, j) for i in range(4) for j in range(i, 4)]
    found = wide.agg(*[F.covar_samp(f"c{i}", f"c{j}").alias(f"v{i}{j}") for i, j in pairs])
    entries = [
        F.struct(
            F.lit(i).alias("i"),
            F.lit(j).alias("j"),
            (
                F.abs(F.col(f"v{i}{j}")) < 1e-9
                if i != j
                else (F.col(f"v{i}{i}") > 0)
                & (F.col(f"v{max(i - 1, 0)}{max(i - 1, 0)}") >= F.col(f"v{i}{i}"))
            ).alias("as_expected"),
        )
        for i, j in pairs
    ]
    return found.select(F.inline(F.array(*entries)))


def _selected(spark, d, method, k, column):
    rows = _vectors(spark, d)
    chosen = features.select_features(rows, method, k, features=column).transform(rows)
    kept = vector_to_array("selected")
    if column == "signs":  # one digit per kept position
        kept = F.transform(kept, lambda x: x.cast("int").cast("string"))
        return chosen.select("vec_id", F.array_join(kept, "").alias("selected"))
    total = F.aggregate(kept, F.lit(0.0), lambda a, x: a + x)
    return chosen.select(
        "vec_id", F.size(kept).alias("kept"), F.round(total, 4).alias("total")
    )


def selected_chi_squared(spark: SparkSession, d: str) -> DataFrame:
    return _selected(spark, d, "chi_squared", 10, "signs")


def selected_mutual_info(spark: SparkSession, d: str) -> DataFrame:
    return _selected(spark, d, "mutual_info", 10, "signs")


def selected_by_variance(spark: SparkSession, d: str) -> DataFrame:
    return _selected(spark, d, "variance_threshold", 0.016, "vector")


def vector_information(spark: SparkSession, d: str) -> DataFrame:
    return rounded(features.vector_information(_vectors(spark, d), "signs", "label"), 8)


def feature_vectors(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").withColumnRenamed("doc_id", "id")
    kinds = features.roles_by_kind(features.column_roles(docs))
    rows = features.feature_pipeline(kinds, bucketed=["n_chars"]).fit(docs).transform(docs)
    vector = vector_to_array("raw_features")
    terms = F.aggregate(vector_to_array("text_tf"), F.lit(0.0), lambda a, x: a + x)
    stop = F.array(*map(F.lit, StopWordsRemover.loadDefaultStopWords("english")))
    return rows.select(
        "id",
        F.size(F.array_remove("text_tokens", "")).alias("words"),
        (F.size(F.array_except("text_tokens", stop)) == F.size(F.array_distinct("text_filtered")))
        .alias("stopped"),
        (terms == F.greatest(F.size("text_filtered") - 1, F.lit(0))).alias("pairs_hashed"),
        F.array_position(vector_to_array("lang_encoded"), 1.0).alias("lang_at"),
        F.array_position(vector_to_array("source_encoded"), 1.0).alias("source_at"),
        F.element_at(vector, -1).cast("long").alias("n_chars"),
        (F.size(vector_to_array("features")) == F.size(vector)).alias("same_size"),
    )


# A model-free score and a stand-in prediction, so SQL can follow.


def confusion_matrix(spark: SparkSession, d: str) -> DataFrame:
    return evaluate.confusion(table(spark, d, "labels"), "quality", "toxic")


def prediction_distribution(spark: SparkSession, d: str) -> DataFrame:
    return evaluate.distribution(table(spark, d, "labels"), "toxic")


def eval_metrics(spark: SparkSession, d: str) -> DataFrame:
    return rounded(evaluate.eval_table(table(spark, d, "labels"), "quality", "toxic"), 8)


def threshold_curve(spark: SparkSession, d: str) -> DataFrame:
    rows = labelled(spark, d).select("n_chars", "label")
    return rounded(evaluate.threshold_curve(rows, "n_chars", bins=200, fold=True), 8)


def threshold_nulls(spark: SparkSession, d: str) -> DataFrame:
    """Scores that are null, below the range and above it."""
    n = F.col("n_chars")
    score = F.when(F.col("doc_id") % 5 != 0, n - 500)
    rows = labelled(spark, d).select(score.alias("score"), "label")
    return rounded(
        evaluate.threshold_curve(rows, "score", bins=10, low=0.0, high=1000.0), 8
    )


def areas(spark: SparkSession, d: str) -> DataFrame:
    return rounded(evaluate.areas(labelled(spark, d), "n_chars"), 8)


def _trained(spark, d, models=("logistic",), grids=None, path=None):
    return run_training(
        labelled(spark, d), path, key=["doc_id"], models=models, grids=grids
    )


def train_logistic(spark: SparkSession, d: str) -> DataFrame:
    """Train, save, load, and score the whole table with the loaded model."""
    _, _, folder = _trained(spark, d, path=shared_dir(spark, "models"))
    model, _ = train.load(spark, folder)
    whole = Window.partitionBy()
    hit = F.avg((F.col("prediction") == F.col("label")).cast("double")).over(whole)
    ones = F.avg("label").over(whole)
    return score(model, labelled(spark, d)).select(
        "doc_id",
        "label",
        F.col("prediction").isin(0.0, 1.0).alias("is_class"),
        (hit >= F.greatest(ones, 1 - ones) - 1e-9).alias("beats_majority"),
    )


SMALL_GRIDS = {
    "logistic": {"regParam": [0.01, 0.1], "elasticNetParam": [0.8]},
    "random_forest": {"maxDepth": [5], "numTrees": [20]},
    "naive_bayes": {"smoothing": [1.0]},
    "linear_svc": {"regParam": [0.1], "maxIter": [10]},
    "gbt": {"maxDepth": [3], "maxIter": [5]},
}


def leaderboard(spark: SparkSession, d: str) -> DataFrame:
    _, board, _ = _trained(spark, d, models=list(SMALL_GRIDS), grids=SMALL_GRIDS)
    in_order = Window.orderBy(F.desc("auc"))
    bounded = F.lit(True)
    for name in train.METRICS:
        bounded = bounded & F.col(name).between(0.0, 1.0)
    return board.select(
        "model", bounded.alias("bounded"), (F.max("auc").over(in_order) >= F.col("auc")).alias("in_order")
    )


def feature_importance(spark: SparkSession, d: str) -> DataFrame:
    rows = labelled(spark, d)
    model, _, _ = _trained(spark, d)
    found = evaluate.importance(model, score(model, rows))
    place = F.row_number().over(Window.orderBy(F.desc("importance"), "feature"))
    return found.select(
        place.cast("long").alias("place"),
        (F.col("importance") >= 0).alias("not_negative"),
        (F.length("feature") > 0).alias("named"),
    )


def stable_split(spark: SparkSession, d: str) -> DataFrame:
    """Each document is in one part, the same one however the rows are dealt out."""
    docs = table(spark, d, "documents")
    parts = None
    for frame in (docs, docs.repartition(7, "n_chars")):
        for name, part in zip(("train", "test"), train.split(frame, ["doc_id"])):
            rows = part.select("doc_id", F.lit(name).alias("part"))
            parts = rows if parts is None else parts.unionByName(rows)
    by_doc = parts.groupBy("doc_id").agg(
        F.count("*").alias("times"), F.countDistinct("part").alias("parts"), F.min("part").alias("part")
    )
    share = F.avg((F.col("part") == "train").cast("double")).over(Window.partitionBy())
    return by_doc.select(
        "doc_id", "times", "parts", (F.abs(share - 0.8) < 0.1).alias("near_share")
    )


_WORDS = r"""
with words as (
  select doc_id, list_filter(string_split_regex(lower(text), '\s'), lambda w: w <> '') as ws
  from documents)
"""

_BIGRAMS = _WORDS + """,
grams as (
  select doc_id, unnest(list_transform(generate_series(1, len(ws) - 1),
                                       lambda i: ws[i] || ' ' || ws[i + 1])) as term
  from words),
counted as (select doc_id, term, count(*) as tf from grams group by all)
"""

def _curve(score: str, bins: int, low: str, high: str) -> str:
    return f"""
with r as (
  select {score} as score, quality as label from documents join labels using (doc_id)),
e as (select {low} as low, {high} as high from r),
t as (select i, low + i * (high - low) / {bins}.0 as threshold,
        low + (i + 1) * (high - low) / {bins}.0 as next, i = {bins} - 1 as last
      from e, (select unnest(generate_series(0, {bins} - 1)) as i))
select round(threshold, 8) as threshold, count(*) as predicted_positive,
  cast(sum(label) as bigint) as true_positive, round(sum(label) / count(*), 8) as precision,
  round(sum(label) / (select sum(label) from r), 8) as recall
from t join r on score >= threshold
group by i, threshold, next, last
having count(*) filter (where score < next or last) > 0
"""


_AREAS = """
with r as (
  select n_chars as score, quality as label from documents join labels using (doc_id)),
c as (select score, count(*) as n, sum(label) as hits from r group by score),
p as (
  select score, sum(n) over w as predicted, sum(hits) over w as tp,
    sum(hits) over () as pos, sum(n) over () - sum(hits) over () as neg
  from c window w as (order by score desc)),
q as (select score, tp / pos as recall, (predicted - tp) / neg as fall, tp / predicted as precision
      from p),
s as (select *, lag(recall, 1, 0) over w as r0, lag(fall, 1, 0) over w as f0,
        coalesce(lag(precision) over w, precision) as p0
      from q window w as (order by score desc))
select round(sum((fall - f0) * (recall + r0) / 2), 8) as auc,
  round(sum((recall - r0) * (precision + p0) / 2), 8) as pr_auc
from s
"""

_MI_PARTS = """
pairs as (select feature, value, label, count(*) as n from long group by all),
parts as (
  select feature, n, sum(n) over (partition by feature) as total,
    sum(n) over (partition by feature, value) as nv,
    sum(n) over (partition by feature, label) as nl from pairs)
"""
_MI = _MI_PARTS + """
select feature, round(sum(n / total * ln(n * total / (nv * nl))), 8) as mutual_information
from parts group by feature
"""

# Signs of the vectors as rows; a selection keeps ten positions, in their order.
_SIGNS = """
with long as (
  select cast(i as integer) as feature, embedding[i] > 0 as value, label
  from embeddings, (select unnest(generate_series(1, 64)) as i))
"""

_CHI = """,
cells as (
  select feature, value, label, count(*) as n from long group by all),
full_cells as (
  select f.feature, v.value, l.label, coalesce(n, 0) as n
  from (select distinct feature from long) f, (select unnest([true, false]) as value) v,
    (select distinct label from long) l
  left join cells c on c.feature = f.feature and c.value = v.value and c.label = l.label),
expected as (
  select *, sum(n) over (partition by feature, value) * sum(n) over (partition by feature, label)
    / sum(n) over (partition by feature) as e from full_cells),
best as (
  select feature, sum((n - e) * (n - e) / e) as chi from expected group by feature
  order by 2 desc, 1 limit 10)
"""

_PICKED = """
select vec_id, string_agg(case when embedding[feature] > 0 then '1' else '0' end, ''
                          order by feature) as selected
from embeddings, best group by vec_id
"""

_EVAL = """
with classes as (select unnest([0, 1]) as c),
per_class as (
  select c, count(*) filter (where quality = c) as actual,
    count(*) filter (where toxic = c) as predicted,
    count(*) filter (where quality = c and toxic = c) as tp, count(*) as total
  from labels, classes group by c),
scores as (
  select *, case when predicted > 0 then tp / predicted else 0 end as p,
    case when actual > 0 then tp / actual else 0 end as r from per_class)
select round(sum(tp) / max(total), 8) as accuracy,
  round(sum(actual * case when p + r > 0 then 2 * p * r / (p + r) else 0 end) / max(total), 8)
    as f1,
  round(sum(actual * p) / max(total), 8) as weighted_precision,
  round(sum(actual * r) / max(total), 8) as weighted_recall
from scores
"""

CHECKS = {
    "string_index": (
        string_index,
        """select doc_id, lang, source,
             cast(dense_rank() over (order by lang) - 1 as double) as lang_indexed,
             cast(dense_rank() over (order by source) - 1 as double) as source_indexed
           from documents""",
    ),
    "one_hot": (
        one_hot,
        """select doc_id, dense_rank() over (order by lang) as at from documents""",
    ),
    "tokens": (
        tokens,
        _WORDS
        + """select term, count(*) as n, count(distinct doc_id) as docs
             from (select doc_id, unnest(ws) as term from words) group by term""",
    ),
    "bigrams": (
        bigrams,
        _BIGRAMS
        + """select doc_id, cast(sum(tf) as bigint) as n, count(*) as terms, max(tf) as top
             from counted group by doc_id""",
    ),
    "tfidf_exact": (
        tfidf,
        _BIGRAMS
        + """, freq as (select term, count(*) as df from counted group by term)
             select doc_id, term, tf, df,
               round(tf * ln(((select count(*) from documents) + 1) / (df + 1)), 6) as tfidf
             from counted join freq using (term)""",
    ),
    "mutual_information": (
        mutual_information,
        """with long as (
             select 'lang' as feature, lang as value, quality as label
               from documents join labels using (doc_id)
             union all select 'source', source, quality
               from documents join labels using (doc_id)),"""
        + _MI,
    ),
    "vector_information": (
        vector_information,
        """with long as (
             select cast(i - 1 as integer) as feature, embedding[i] > 0 as value, label
             from embeddings, (select unnest(generate_series(1, 64)) as i)),"""
        + _MI,
    ),
    "variance_by_feature": (
        variance,
        """select cast(i - 1 as integer) as feature,
             round(var_samp(cast(embedding[i] as double)), 8) as variance
           from embeddings, (select unnest(generate_series(1, 64)) as i) group by i""",
    ),
    "scaled_features": (
        scaled,
        """select l_orderkey,
             round(l_quantity / stddev_samp(l_quantity) over (), 4) as quantity,
             round(l_extendedprice / stddev_samp(l_extendedprice) over (), 4) as price
           from lineitem""",
    ),
    "quantile_buckets": (
        quantile_buckets,
        """select cast(unnest(generate_series(0, 9)) as double) as bucket,
             true as apart, true as even""",
    ),
    "pca_components": (
        components,
        """select cast(i as integer) as i, cast(j as integer) as j, true as as_expected
           from (select unnest(generate_series(0, 3)) as i),
                (select unnest(generate_series(0, 3)) as j) where i <= j""",
    ),
    "selected_chi_squared": (selected_chi_squared, _SIGNS + _CHI + _PICKED),
    "selected_mutual_info": (
        selected_mutual_info,
        _SIGNS + "," + _MI_PARTS + """,
best as (
  select feature, round(sum(n / total * ln(n * total / (nv * nl))), 10) as mi
  from parts group by feature order by 2 desc, 1 limit 10)
""" + _PICKED,
    ),
    "selected_by_variance": (
        selected_by_variance,
        """with v as (
             select i, var_samp(cast(embedding[i] as double)) as v
             from embeddings, (select unnest(generate_series(1, 64)) as i) group by i)
           select vec_id, cast(count(*) as integer) as kept,
             round(sum(cast(embedding[i] as double)), 4) as total
           from embeddings, v where v.v > 0.016 group by vec_id""",
    ),
    "feature_vectors": (
        feature_vectors,
        _WORDS
        + """select doc_id as id, cast(len(ws) as integer) as words, true as stopped,
             true as pairs_hashed, dense_rank() over (order by lang) as lang_at,
             dense_rank() over (order by source) as source_at, n_chars, true as same_size
           from words join documents using (doc_id)""",
    ),
    "confusion_matrix": (
        confusion_matrix,
        "select quality, toxic, count(*) as n from labels group by all",
    ),
    "prediction_distribution": (
        prediction_distribution,
        "select toxic, count(*) as n from labels group by toxic",
    ),
    "eval_metrics": (eval_metrics, _EVAL),
    "threshold_curve": (
        threshold_curve,
        _curve("n_chars", 200, "cast(min(score) as double)", "cast(max(score) as double)"),
    ),
    "threshold_nulls": (
        threshold_nulls,
        _curve("case when doc_id % 5 <> 0 then n_chars - 500 end", 10, "any_value(0.0)", "any_value(1000.0)"),
    ),
    "areas": (areas, _AREAS),
    "stable_split": (
        stable_split,
        """select doc_id, 2 as times, 1 as parts, true as near_share from documents""",
    ),
    "train_logistic": (
        train_logistic,
        """select doc_id, cast(quality as double) as label, true as is_class,
             true as beats_majority from documents join labels using (doc_id)""",
    ),
    "leaderboard": (
        leaderboard,
        "select unnest(["
        + ", ".join(f"'{m}'" for m in SMALL_GRIDS)
        + "]) as model, true as bounded, true as in_order",
    ),
    "feature_importance": (
        feature_importance,
        """select unnest(generate_series(1, 10)) as place, true as not_negative, true as named""",
    ),
}
