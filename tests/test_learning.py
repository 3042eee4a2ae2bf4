"""Features, evaluation, training: exact where possible, structural elsewhere."""

from __future__ import annotations

import math
from datetime import datetime

import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from clickweir import schema
from clickweir.ml import evaluate, features, train
from clickweir.ml.scoring import reply, score
from clickweir.operators import layout
from clickweir.plans.batch import run_day
from clickweir.plans.stream import score_messages
from clickweir.plans.training import run_training
from clickweir.sources.stream import to_envelope


@pytest.fixture(scope="module")
def rows(spark):
    """400 rows whose label follows x, with a category, a text and an int column."""
    return spark.range(400).select(
        "id",
        (F.col("id") % 20).cast("double").alias("x"),
        (F.col("id") % 7).cast("int").alias("n"),
        F.concat(F.lit("c"), (F.col("id") % 3).cast("string")).alias("kind"),
        F.concat_ws(" ", F.lit("the red fox"), F.col("id"), F.lit("runs"), F.col("id") % 5).alias(
            "text"
        ),
        F.when(F.col("id") % 20 >= 10, 1.0).otherwise(0.0).alias("label"),
    )


def test_roles_cover_every_numeric_type(rows):
    kinds = features.roles_by_kind(features.column_roles(rows))
    assert kinds == {"categorical": ["kind"], "numeric": ["n", "x"], "text": ["text"]}


def test_role_limit_is_exact_and_null_is_a_value(spark):
    df = spark.range(300).select(
        (F.col("id") % 49).cast("string").alias("a"),
        (F.col("id") % 50).cast("string").alias("b"),
        F.when(F.col("id") > 0, (F.col("id") % 49).cast("string")).alias("c"),
        F.when(F.col("id") % 50 < 49, (F.col("id") % 50).cast("string")).alias("d"),
    )
    kinds = features.roles_by_kind(features.column_roles(df))
    assert kinds["categorical"] == ["a"]
    assert kinds["text"] == ["b", "c", "d"]


def test_words_and_ngrams(spark):
    df = spark.createDataFrame([("  A b\n\tA  b ",), ("",), ("one",)], "t string")
    got = df.select(features.words(F.col("t")).alias("w"))
    assert [r["w"] for r in got.collect()] == [["a", "b", "a", "b"], [], ["one"]]
    grams = got.select(features.ngrams(F.col("w"), 2), features.ngrams(F.col("w"), 3)).collect()
    assert tuple(grams[0]) == (["a b", "b a", "a b"], ["a b a", "b a b"])
    assert tuple(grams[1]) == tuple(grams[2]) == ([], [])


def test_tfidf_with_hot_terms(spark):
    df = spark.createDataFrame([(i, f"hot word{i}") for i in range(50)], "id long, t string")
    got = features.tfidf_table(df, "id", "t", n=1, share=0.1)
    assert got.count() == 100
    hot = got.where("term = 'hot'").agg(F.max("df"), F.max("tfidf")).first()
    assert tuple(hot) == (50, 0.0)
    cold = got.where("term = 'word7'").first()
    assert cold["tfidf"] == pytest.approx(math.log(51 / 2))


def test_tfidf_in_slices_of_the_terms(spark, tmp_path, monkeypatch):
    from collections import Counter

    from clickweir import workspace

    monkeypatch.setattr(workspace, "shared_base", lambda spark: str(tmp_path))
    monkeypatch.setattr(features, "SLICE_TEXT", 16)
    rows = [(i % 9, f"the word{i % 4} of the word{i}") for i in range(20)]
    rows += [(None, "the word1"), (None, "The word1"), (30, None), (31, ""), (32, "one")]
    df = spark.createDataFrame(rows, "id long, t string")
    got = features.tfidf_table(df, "id", "t", n=2, share=0.02)
    tf = Counter()
    for key, text in rows:
        ws = (text or "").lower().split()
        tf.update((key, f"{a} {b}") for a, b in zip(ws, ws[1:]))
    often = Counter(term for _, term in tf)
    expected = {
        (key, term): (n, often[term], round(n * math.log((len(rows) + 1) / (often[term] + 1)), 9))
        for (key, term), n in tf.items()
    }
    found = got.collect()
    assert len(found) == len(expected)
    assert {(r.id, r.term): (r.tf, r.df, round(r.tfidf, 9)) for r in found} == expected
    # Only the rows of the result stay: no counts, no frequencies.
    left = [p for p in tmp_path.iterdir() if any(p.rglob("part-*"))]
    assert [spark.read.parquet(str(p)).columns for p in left] == [["id", "term", "tf", "df"]]
    nothing = features.tfidf_table(df.where("id > 99"), "id", "t")
    assert nothing.count() == 0 and nothing.columns == ["id", "term", "tf", "df", "tfidf"]


def test_mutual_information_of_known_cases(spark):
    df = spark.range(400).select(
        (F.col("id") % 2).alias("label"),
        (F.col("id") % 2).alias("same"),
        (F.floor(F.col("id") / 2) % 2).alias("independent"),
    )
    got = dict(map(tuple, features.mutual_information(df, ["same", "independent"], "label").collect()))
    assert got["same"] == pytest.approx(math.log(2))
    assert got["independent"] == pytest.approx(0.0, abs=1e-12)


@pytest.mark.parametrize("method, k, kept", [("mutual_info", 1, 1), ("chi_squared", 1, 1), ("variance_threshold", 0.2, 2)])
def test_selection_keeps_the_informative_position(spark, method, k, kept):
    df = features.feature_pipeline({"numeric": ["a", "b", "c"]}).fit(
        base := spark.range(200).select(
            (F.col("id") % 2).cast("double").alias("label"),
            F.lit(1.0).alias("a"),
            (F.col("id") % 2).cast("double").alias("b"),
            (F.floor(F.col("id") / 2) % 2).cast("double").alias("c"),
        )
    ).transform(base)
    chosen = features.select_features(df, method, k, features="raw_features").transform(df)
    got = chosen.select("b", vector_to_array("selected").alias("s")).collect()
    assert {len(r["s"]) for r in got} == {kept}
    assert all(r["s"][0] == r["b"] for r in got)
    with pytest.raises(ValueError):
        features.select_features(df, "guess", 1)


def test_split_does_not_depend_on_partitions(spark):
    df = spark.range(5000)
    left, right = train.split(df, ["id"])
    again, _ = train.split(df.repartition(7), ["id"])
    ids = {r["id"] for r in left.collect()}
    assert ids == {r["id"] for r in again.collect()}
    assert left.intersect(right).isEmpty() and len(ids) + right.count() == 5000
    assert 0.75 < len(ids) / 5000 < 0.85


def test_eval_table_equals_the_evaluators(spark):
    df = spark.range(300).select(
        (F.col("id") % 3).cast("double").alias("label"),
        (F.floor(F.col("id") / 4) % 2).cast("double").alias("prediction"),
    )
    got = evaluate.eval_table(df).first().asDict()
    names = {
        "accuracy": "accuracy",
        "f1": "f1",
        "weighted_precision": "weightedPrecision",
        "weighted_recall": "weightedRecall",
    }
    for ours, theirs in names.items():
        reference = MulticlassClassificationEvaluator(metricName=theirs).evaluate(df)
        assert got[ours] == pytest.approx(reference), ours


def test_threshold_curve_ends(spark):
    df = spark.range(100).select((F.col("id") / 100).alias("s"), (F.col("id") >= 50).cast("int").alias("label"))
    curve = evaluate.threshold_curve(df, "s", bins=10, low=0.0, high=1.0)
    curve = curve.orderBy("threshold").collect()
    assert (curve[0]["recall"], curve[0]["precision"]) == (1.0, 0.5)
    assert curve[-1]["precision"] == 1.0
    assert [r["predicted_positive"] for r in curve] == list(range(100, 0, -10))


def test_threshold_curve_counts_no_null_or_low_score_as_positive(spark):
    df = spark.createDataFrame(
        [(None, 1), (None, 0), (-3.0, 1), (0.5, 1), (7.0, 0)], "s double, label int"
    )
    curve = evaluate.threshold_curve(df, "s", bins=10, low=0.0, high=1.0).orderBy("threshold")
    got = [(r["threshold"], r["predicted_positive"], r["recall"]) for r in curve.collect()]
    assert got == [(0.5, 2, pytest.approx(1 / 3)), (0.9, 1, 0.0)]
    whole = evaluate.threshold_curve(df, "s", bins=10).orderBy("threshold").collect()
    assert (whole[0]["threshold"], whole[0]["predicted_positive"]) == (-3.0, 3)


def test_threshold_curve_folds_scores_in_one_scan(spark, tmp_path):
    path = str(tmp_path / "scores")
    spark.range(1000).select(
        F.when(F.col("id") % 11 != 0, F.col("id") % 37).alias("s"), (F.col("id") % 2).alias("label")
    ).write.parquet(path)
    df = spark.read.parquet(path)
    two, one = (
        evaluate.threshold_curve(df, "s", bins=10, fold=fold).orderBy("threshold")
        for fold in (False, True)
    )
    assert one.collect() == two.collect()
    final = one._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in final or final.count("ReusedSubquery") > 0


def test_scaling_keeps_rows_with_a_null(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, None), (5.0, 4.0)], "a double, b double")
    got = [r["scaled"] for r in features.scale(df, ["a", "b"]).orderBy("a").collect()]
    assert len(got) == 3 and got[1][1] is None
    assert got[0][0] == pytest.approx(0.5)


def test_vector_information_of_sparse_and_dense_rows(spark):
    rows = spark.range(60).select(
        (F.col("id") % 2).cast("double").alias("label"),
        F.array(
            F.lit(0.0),
            (F.col("id") % 2).cast("double"),
            (F.col("id") % 3).cast("double"),
            F.lit(4.0),
        ).alias("x"),
    )
    vectors = rows.select("label", array_to_vector("x").alias("v"))
    long = rows.select("label", F.posexplode("x").alias("feature", "value"))
    want = {r[0]: r[1] for r in features.long_information(long, "label").collect()}
    got = {r[0]: r[1] for r in features.vector_information(vectors, "v", "label").collect()}
    assert got == pytest.approx(want, abs=1e-9)


def test_texts_are_dealt_out_once(spark, plan):
    df = spark.createDataFrame([(1, "a b a")], "id long, text string")
    tree = plan(features.terms(df, "id", "text", 2)).split("\n\n")[0]
    assert tree.count("Exchange") == 1
    assert tree.rfind("Exchange") > tree.rfind("Generate")


def test_tasks_that_count_terms_follow_from_the_bytes(spark, monkeypatch):
    df = spark.range(64).select("id", F.repeat(F.lit("ab cd "), 100).alias("text"))
    monkeypatch.setattr(features, "TASK_TEXT", 600)
    assert features.terms(df, "id", "text", 2).rdd.getNumPartitions() == 64


def test_train_save_load_score(spark, rows, tmp_path):
    path = str(tmp_path / "models")
    grids = {"logistic": {"regParam": [0.01]}, "random_forest": {"numTrees": [5]}}
    model, board, folder = run_training(rows, path, models=["logistic", "random_forest"], grids=grids, folds=2)
    got = board.collect()
    assert {r["model"] for r in got} == {"logistic", "random_forest"}
    assert got[0]["auc"] == max(r["auc"] for r in got) > 0.9
    assert all(0 <= r[m] <= 1 for r in got for m in train.METRICS)
    assert ":" not in folder.removeprefix("file:")

    loaded, request = train.load(spark, folder)
    assert set(request.names) == {"x", "n", "kind", "text"}
    requests = to_envelope(rows.withColumn("at", F.current_timestamp()), "id", "at")
    replies = score_messages(requests, loaded, request)
    assert replies.columns == ["key", "value"]
    assert replies.count() == 400
    parsed = replies.select(F.get_json_object("value", "$.prediction").cast("double").alias("p"), "key")
    direct = score(model, rows).select(F.col("id").cast("string").alias("key"), F.col("prediction").alias("p"))
    assert parsed.select("key", "p").exceptAll(direct).isEmpty()

    top = evaluate.importance(model, score(model, rows), top=3).collect()
    assert len(top) == 3 and top[0]["importance"] >= top[1]["importance"]
    assert any("x" in r["feature"] for r in top)


def test_training_and_scoring_after_the_daily_job(spark, rows, tmp_path):
    start = datetime(2024, 1, 2)
    events = rows.select(
        F.col("id").cast("string").alias("event_id"),
        F.lit(1).cast("long").alias("user_id"),
        F.timestamp_add("MINUTE", F.col("id").cast("int"), F.lit(start)).alias("timestamp"),
        F.lit("VIEW").alias("event_type"),
        F.lit("c").alias("category"),
        F.col("x").alias("amount"),
        F.lit(None).cast("map<string,string>").alias("properties"),
        F.lit(None).cast("array<string>").alias("tags"),
        F.lit(None).cast(schema.EVENT["location"].dataType).alias("location"),
    ).withColumn("date", F.to_date("timestamp"))
    layout.write_partitioned(events, str(tmp_path / "days"), ["date"])
    report = run_day(spark, str(tmp_path / "days"), str(tmp_path / "out"), "2024-01-02")
    assert report.first()["detail_rows"] == 400
    grids = {"logistic": {"regParam": [0.01]}}
    path = str(tmp_path / "models")
    model, _, folder = run_training(rows, path, grids=grids, folds=2)
    loaded, request = train.load(spark, folder)
    requests = to_envelope(rows.withColumn("at", F.current_timestamp()), "id", "at")
    assert score_messages(requests, model, request).count() == 400
    assert score_messages(requests, loaded, request).count() == 400


def test_features_per_fold_and_models_without_probability(spark, rows):
    train_df, test_df = train.split(rows, ["id"])
    pipeline = features.feature_pipeline({"numeric": ["x"]})
    model, board = train.train(
        train_df,
        test_df,
        pipeline,
        models=["linear_svc"],
        grids={"linear_svc": {"maxIter": [5]}},
        folds=2,
        features_per_fold=True,
    )
    assert board.count() == 1
    scored = score(model, rows.withColumn("request_id", F.col("id").cast("string")))
    assert "probability" not in reply(scored, F.current_timestamp()).first()["value"]
    with pytest.raises(ValueError):
        train.train(train_df, test_df, pipeline, models=[])


def test_grids_have_every_combination():
    forest = train.classifier("random_forest")
    assert len(train.param_grid(forest, train.GRIDS["random_forest"])) == 27
    assert train.classifier("logistic").getElasticNetParam() == 0.8
