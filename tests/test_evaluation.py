import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from stayline.operators import evaluation

SCHEMA = "model_version string, label int, prediction int, score decimal(5,4)"


def frame(spark, rows):
    return spark.createDataFrame(rows, "m string, l int, p int, s double").select(
        F.col("m").alias("model_version"),
        F.col("l").alias("label"),
        F.col("p").alias("prediction"),
        F.col("s").cast("decimal(5,4)").alias("score"),
    )


@pytest.fixture(scope="module")
def outcomes(spark):
    draw = random.Random(7)
    rows = []
    for version in ("a", "b"):
        for _ in range(400):
            score = draw.randint(0, 40) / 40  # many ties
            rows.append((version, int(draw.random() < score), int(score >= 0.5), score))
    return rows, frame(spark, rows)


def test_auc_equals_all_pairs(outcomes):
    rows, df = outcomes
    found = {r["model_version"]: r["roc_auc"] for r in evaluation.roc_auc(df).collect()}
    for version in ("a", "b"):
        pos = [r[3] for r in rows if r[0] == version and r[1] == 1]
        neg = [r[3] for r in rows if r[0] == version and r[1] == 0]
        wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
        assert found[version] == pytest.approx(wins / (len(pos) * len(neg)), abs=5.1e-5)


def test_auc_of_raw_probabilities_is_not_rounded(spark):
    draw = random.Random(3)
    rows = [("a", int(draw.random() < 0.5), 0, 0.5 + draw.random() * 1e-5) for _ in range(300)]
    df = spark.createDataFrame(rows, "model_version string, label int, prediction int, score double")
    pos, neg = ([r[3] for r in rows if r[1] == k] for k in (1, 0))
    wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert evaluation.roc_auc(df, digits=8).first()["roc_auc"] == pytest.approx(wins, abs=1e-8)
    assert evaluation.roc_auc(df, digits=8, score_digits=4).first()["roc_auc"] == 0.5


def test_auc_equals_mllib(outcomes):
    _, df = outcomes
    one = df.filter("model_version = 'a'").withColumn("raw", F.col("score").cast("double"))
    area = BinaryClassificationEvaluator(rawPredictionCol="raw", numBins=0).evaluate(one)
    assert evaluation.roc_auc(one).first()["roc_auc"] == round(area, 4)


def test_metrics_and_cells(outcomes):
    rows, df = outcomes
    found = {r["model_version"]: r for r in evaluation.metrics(df).collect()}
    cells = {(r["model_version"], r["label"]): r for r in evaluation.confusion(df).collect()}
    for version in ("a", "b"):
        count = lambda l, p: sum(r[0] == version and r[1] == l and r[2] == p for r in rows)
        tp, fp, tn, fn = count(1, 1), count(0, 1), count(0, 0), count(1, 0)
        row = found[version]
        assert row["accuracy"] == pytest.approx((tp + tn) / 400, abs=5.1e-5)
        assert row["precision"] == pytest.approx(tp / (tp + fp), abs=5.1e-5)
        assert row["recall"] == pytest.approx(tp / (tp + fn), abs=5.1e-5)
        assert row["f1"] == pytest.approx(2 * tp / (2 * tp + fp + fn), abs=5.1e-5)
        assert (cells[version, 0]["predicted_stay"], cells[version, 0]["predicted_churn"]) == (tn, fp)
        assert (cells[version, 1]["predicted_stay"], cells[version, 1]["predicted_churn"]) == (fn, tp)


def test_published_confusion_matrix(spark):
    """965 / 53 / 60 / 331."""
    cells = {(0, 0): 965, (0, 1): 53, (1, 0): 60, (1, 1): 331}
    df = frame(spark, [("m", l, p, float(p)) for (l, p), n in cells.items() for _ in range(n)])
    row = evaluation.metrics(df).first()
    assert (row["accuracy"], row["precision"], row["recall"], row["f1"]) == (0.9198, 0.862, 0.8465, 0.8542)
    report = {r["class"]: r for r in evaluation.class_report(df).collect()}
    assert report["Churn"]["precision"] == 0.862 and report["Churn"]["support"] == 391
    assert report["Stay"]["recall"] == 0.9479 and report["accuracy"]["f1"] == 0.9198
    assert report["macro avg"]["support"] == report["weighted avg"]["support"] == 1409


def test_undefined_metrics_are_zero(spark):
    row = evaluation.metrics(frame(spark, [("m", 0, 0, 0.1), ("m", 0, 0, 0.2)])).first()
    assert (row["precision"], row["recall"], row["f1"], row["accuracy"]) == (0.0, 0.0, 0.0, 1.0)
    assert evaluation.roc_auc(frame(spark, [("m", 0, 0, 0.1)])).first()["roc_auc"] is None


def test_class_weight(spark):
    rows = spark.createDataFrame([(1,), (0,), (0,), (0,), (None,)], "label int")
    assert tuple(evaluation.class_weight(rows).first()) == (1, 3, 3.0)


def test_a_hot_customer_reaches_the_join_once_per_score(spark):
    """Rows are counted on both sides of the exchange before they meet their outcome."""
    rows = [("hot", day, "v1", 0.25, 0) for day in range(300)] + [("hot", 400, "v1", 0.75, 1), ("b", 1, "v1", 0.5, 1), ("c", 1, "v1", 0.5, 1)]
    scores = spark.createDataFrame(rows, "customer_id string, run_date int, model_version string, churn_probability double, churn_prediction int")
    people = spark.createDataFrame([("hot", "No"), ("b", "Yes"), ("c", None)], "customer_id string, churn string")
    found = evaluation.outcomes(scores, people)
    assert sorted((r["customer_id"], r["score"], r["label"], r["n"]) for r in found.collect()) == [("b", 0.5, 1, 1), ("hot", 0.25, 0, 300), ("hot", 0.75, 0, 1)]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join") < plan.index("Aggregate")  # the aggregate is below the join
    assert [(r["tp"], r["fp"]) for r in found.groupBy("model_version").agg(*[c.alias(k) for k, c in evaluation._cells(found).items()]).collect()] == [(1, 1)]
    assert evaluation.roc_auc(found).first()["roc_auc"] == round(300 / 301, 4)
    assert {r["label"]: (r["predicted_stay"], r["predicted_churn"]) for r in evaluation.confusion(found).collect()} == {0: (300, 1), 1: (0, 1)}


def test_counts_weigh_as_the_rows_they_stand_for(outcomes):
    rows, df = outcomes
    counted = df.groupBy(*df.columns).agg(F.count("*").alias("n"))
    for metric in (evaluation.metrics, evaluation.roc_auc, evaluation.confusion, evaluation.class_report):
        assert sorted(map(str, metric(counted).collect())) == sorted(map(str, metric(df).collect()))
