import itertools
import json
import os
import subprocess
import sys
from math import factorial
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from stayline.operators import boosting, explain, modeling
from stayline.plans import catalog, pipeline
from stayline.schemas import MODEL_FEATURES
from stayline.sources.derived import raw_subscribers

SMALL = modeling.Boosting(trees=12, depth=3, rate=0.2, patience=5)


@pytest.fixture(scope="module")
def trained(spark, tiny):
    matrix = pipeline.training_matrix(raw_subscribers(spark, tiny)).cache()
    model, report = modeling.train_tuned(matrix, SMALL)
    return matrix, model, report


def test_best_round():
    assert boosting.best_round([0.1, 0.2, 0.3], 2) == (3, False)
    assert boosting.best_round([0.1, 0.5, 0.5, 0.4, 0.9], 2) == (2, True)
    assert boosting.best_round([0.7], 5) == (1, False)


def test_the_model_is_cut_to_the_best_area(spark, trained):
    """The areas are those of the model's first trees, and no more trees are grown than patience asks for."""
    matrix, _, _ = trained
    train = modeling.split_frames(matrix).filter("NOT is_test")
    table = modeling.bin_table(train)
    _, pos_weight = modeling.class_weights(train.filter("NOT is_validation"))
    rows = table.rows.withColumn("weight", F.when(F.col("label") == 1, pos_weight).otherwise(1.0))
    settings = modeling.Boosting(trees=30, depth=3, rate=0.2, patience=4)
    trees, areas = boosting.grow(rows.filter("NOT is_validation"), rows.filter("is_validation"), table.cuts, settings, modeling.SEED)
    best, _ = boosting.best_round(areas, settings.patience)
    assert len(trees) == len(areas) <= best + settings.patience + boosting.CHUNK
    model = modeling.train_boosted(train, settings, table=table)
    assert model.stages[-1].getNumTrees == best
    naive = []
    for n in sorted({1, 3, best}):
        first = modeling.PipelineModel([modeling._features(), boosting.as_mllib(spark, trees[:n], table.cuts, 3)])
        pairs = first.transform(train.filter("is_validation")).select("label", modeling.probability().alias("score")).collect()
        pos, neg = ([r["score"] for r in pairs if r["label"] == k] for k in (1, 0))
        naive.append(sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg)))
        assert areas[n - 1] == pytest.approx(naive[-1], abs=1e-9)
    assert len(model.stages[-1].trees) == best


def test_a_saved_model_is_loaded_for_the_same_rows_only(spark, trained, monkeypatch):
    matrix, _, _ = trained
    first = modeling.saved_or_trained(matrix, SMALL)
    monkeypatch.setattr(modeling, "train_tuned", lambda *a: pytest.fail("trained again"))
    again = modeling.saved_or_trained(matrix.repartition(3), SMALL)
    assert first.stages[-1].toDebugString.split("\n")[1:] == again.stages[-1].toDebugString.split("\n")[1:]
    other = matrix.withColumn("tenure", F.col("tenure") + 1)
    assert modeling.fingerprint(other) != modeling.fingerprint(matrix)


def test_a_model_is_named_by_the_files_of_its_training_set(spark, trained, tmp_path, monkeypatch):
    import shutil

    matrix, _, _ = trained
    (tmp_path / "t.parquet").write_bytes(b"x")
    name = modeling.source_name(spark, str(tmp_path), ["t"])
    assert name == modeling.source_name(spark, str(tmp_path), ["t"])
    modeling.saved_or_trained(matrix, SMALL, name)
    monkeypatch.setattr(modeling, "train_tuned", lambda *a: pytest.fail("trained again"))
    monkeypatch.setattr(modeling, "fingerprint", lambda *a: pytest.fail("the rows were read"))
    modeling.saved_or_trained(matrix, SMALL, name)
    shutil.copy(tmp_path / "t.parquet", tmp_path / "u.parquet")
    (tmp_path / "t.parquet").write_bytes(b"xy")
    assert modeling.source_name(spark, str(tmp_path), ["t"]) != name != modeling.source_name(spark, str(tmp_path), ["u"])


def test_the_nodes_of_a_loaded_model_are_read_where_it_lies(spark, trained, tmp_path, monkeypatch):
    _, model, _ = trained
    modeling.save_model(model, str(tmp_path / "model"))
    again = modeling.load_model(str(tmp_path / "model"))
    expected = explain.saved_nodes(spark, model.stages[-1])
    monkeypatch.setattr(type(again.stages[-1]), "write", lambda self: pytest.fail("saved again"))
    assert explain.saved_nodes(spark, again.stages[-1]) == expected


def test_one_customer_is_looked_up_in_one_bucket(spark, trained):
    from stayline.sources import tables

    matrix, model, _ = trained
    try:
        # A scan that no join needs in buckets prunes them without saying so.
        spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
        spark.sql("DROP TABLE IF EXISTS matrix_bucketed")
        tables.store_matrix_bucketed(matrix, "matrix_bucketed", 8)
        plan = spark.table("matrix_bucketed").filter("customer_id = 'CUST-00000011'")._jdf.queryExecution().executedPlan().toString()
        assert "SelectedBucketsCount: 1 out of 8" in plan
        found = pipeline.explain_stored(spark, "matrix_bucketed", model, "CUST-00000011")
        assert sorted(found.collect()) == sorted(pipeline.explain_one(matrix, model, "CUST-00000011").collect())
        with pytest.raises(KeyError):
            pipeline.explain_stored(spark, "matrix_bucketed", model, "nobody")
    finally:
        spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")
        spark.sql("DROP TABLE IF EXISTS matrix_bucketed")


def test_scoring_evaluates_the_model_once(spark, tiny, trained):
    """The sort and its sampling read stored probabilities: no model in the plan above the stored table."""
    _, model, _ = trained
    ranked = pipeline.score(raw_subscribers(spark, tiny), model)
    assert "rangepartitioning" in ranked._jdf.queryExecution().executedPlan().toString()
    assert ranked.inputFiles() and all("/scored-" in name for name in ranked.inputFiles())


def test_reports_of_a_trained_model(trained):
    matrix, model, report = trained
    test = modeling.split_frames(matrix).filter("is_test")
    lines, cells = modeling.outcome_report(model, test)
    by_class = {r["class"]: r for r in lines.collect()}
    assert by_class["Churn"]["precision"] == report["precision"] and by_class["accuracy"]["f1"] == report["accuracy"]
    assert sum(r["predicted_stay"] + r["predicted_churn"] for r in cells.collect()) == report["test_rows"]


def test_scores_reach_the_reports(spark, tiny, trained, tmp_path):
    """Raw customers to published scores to the report: reasons group by feature and direction."""
    from datetime import date

    from stayline.plans import reports
    from stayline.sources import tables

    _, model, _ = trained
    scores = pipeline.score(raw_subscribers(spark, tiny), model, order=False)
    tables.publish_run(scores, str(tmp_path / "runs"), date(2024, 1, 10))
    found = reports.top_drivers(tables.read_predictions(spark, str(tmp_path / "runs")), date(2024, 1, 10)).collect()
    assert 1 <= len(found) <= 2 * len(MODEL_FEATURES)
    names = {f"{f} ({d})" for f in MODEL_FEATURES for d in ("high risk", "low risk")}
    assert {r["risk_factor"] for r in found} <= names
    assert sum(r["times_cited_as_primary"] for r in found) == scores.filter("churn_prediction = 1").count()


def test_the_parts_are_disjoint_and_complete(trained):
    matrix, _, report = trained
    labelled = matrix.filter("label IS NOT NULL").count()
    assert report["train_rows"] + report["validation_rows"] + report["test_rows"] == labelled
    frames = modeling.split_frames(matrix)
    assert frames.filter("is_test AND is_validation").count() == 0


def test_better_than_chance(trained):
    _, model, report = trained
    assert report["roc_auc"] > 0.6
    assert 1 <= report["trees"] <= SMALL.trees == 12
    assert sum(model.stages[-1].featureImportances.toArray()) == pytest.approx(1.0)


def test_the_area_of_a_single_tree_ranks_by_probability(trained):
    matrix, _, _ = trained
    frames = modeling.split_frames(matrix)
    model = modeling.train_tree(frames.filter("NOT is_test"), depth=3)
    test = frames.filter("is_test")
    scored = model.transform(test).select("label", modeling.probability().alias("p")).collect()
    pos = [r["p"] for r in scored if r["label"] == 1]
    neg = [r["p"] for r in scored if r["label"] == 0]
    wins = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg)
    found = modeling.evaluate("tree", model, test)["roc_auc"]
    assert found == pytest.approx(wins / (len(pos) * len(neg)), abs=5.1e-5)


def test_importances(spark, trained):
    rows = modeling.feature_importance(trained[1], spark, 15).collect()
    assert len(rows) == 15
    assert [r["importance"] for r in rows] == sorted((r["importance"] for r in rows), reverse=True)


def test_scaling_uses_the_population_deviation(spark):
    train = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    fitted = modeling.scaler(train, ["a", "b"])
    assert fitted == {"a": (2.0, 1.0), "b": (5.0, 1.0)}
    assert [tuple(r) for r in modeling.scale(train, fitted).collect()] == [(-1.0, 0.0), (1.0, 0.0)]


def test_contributions_add_up_to_the_log_odds(spark, trained):
    matrix, model, _ = trained
    tables = explain.leaf_tables(spark, model.stages[-1])
    scored = pipeline.with_probability(matrix, model)
    p = F.col("churn_probability")
    total = F.aggregate("contributions", F.lit(explain.base_value(tables)), lambda a, b: a + b)
    worst = (
        pipeline.explained(scored, model, tables)
        .agg(F.max(F.abs(total - F.log(p / (1 - p)))))
        .first()[0]
    )
    assert worst < 1e-9


def expected_value(nodes, at, x, known):
    """A tree's prediction when only the ``known`` features of x are given."""
    node = nodes[at]
    if node["leftChild"] < 0:
        return node["prediction"]
    feature, cut = node["split"]["featureIndex"], node["split"]["leftCategoriesOrThreshold"][0]
    left, right = node["leftChild"], node["rightChild"]
    if feature in known:
        return expected_value(nodes, left if x[feature] <= cut else right, x, known)
    rows = node["impurityStats"][0]
    return sum(
        nodes[side]["impurityStats"][0] / rows * expected_value(nodes, side, x, known)
        for side in (left, right)
    )


def test_contributions_equal_brute_force(spark, trained):
    """Shapley values over all coalitions of the features a tree uses."""
    matrix, model, _ = trained
    gbt = model.stages[-1]
    first = matrix.orderBy("customer_id").limit(3).collect()
    rows = np.array([[r[c] for c in MODEL_FEATURES] for r in first])
    for tree, nodes in explain.saved_nodes(spark, gbt).items():
        weight = gbt.treeWeights[tree]
        tables = explain.group_leaves(list(explain.leaf_paths(nodes, weight)), 20)
        used = {n["split"]["featureIndex"] for n in nodes.values() if n["leftChild"] >= 0}
        for x, found in zip(rows, tables.contributions(rows)):
            brute = np.zeros(20)
            for i in used:
                others = used - {i}
                for size in range(len(used)):
                    share = factorial(size) * factorial(len(others) - size) / factorial(len(used))
                    for known in map(set, itertools.combinations(others, size)):
                        gain = expected_value(nodes, 0, x, known | {i})
                        brute[i] += share * (gain - expected_value(nodes, 0, x, known))
            np.testing.assert_allclose(found, brute * weight, atol=1e-12)


def test_a_missing_value_goes_right(spark, trained):
    tables = explain.leaf_tables(spark, trained[1].stages[-1])
    row = np.full((1, 20), np.nan)
    high = np.full((1, 20), 1e12)
    np.testing.assert_array_equal(tables.contributions(row), tables.contributions(high))


def test_scores(spark, tiny, trained):
    _, model, _ = trained
    raw = raw_subscribers(spark, tiny)
    scored = pipeline.score(raw, model).collect()
    assert [r["churn_probability"] for r in scored] == sorted(
        (r["churn_probability"] for r in scored), reverse=True
    )
    assert {r["customer_id"] for r in scored} < {r["customer_id"] for r in raw.collect()}
    first = scored[0]
    assert list(json.loads(first["shap_values_json"])) == MODEL_FEATURES
    assert first["top_reason_1"].split(" ")[0] in MODEL_FEATURES
    assert first["churn_prediction"] == int(first["churn_probability"] >= 0.5)


def test_unlabelled_customers_are_scored_the_same(spark, tiny, trained):
    _, model, _ = trained
    raw = raw_subscribers(spark, tiny)
    labelled, unlabelled = (
        pipeline.score(frame, model).drop("shap_values_json") for frame in (raw, raw.drop("churn"))
    )
    assert labelled.exceptAll(unlabelled).count() == 0


def test_a_loaded_model_scores_the_same(spark, tiny, trained, tmp_path):
    _, model, _ = trained
    modeling.save_model(model, str(tmp_path / "model"))
    again = modeling.load_model(str(tmp_path / "model"))
    raw = raw_subscribers(spark, tiny)
    first, second = pipeline.score(raw, model), pipeline.score(raw, again)
    assert first.exceptAll(second).count() == 0


def test_one_customer(spark, trained):
    matrix, model, _ = trained
    rows = pipeline.explain_one(matrix, model, "CUST-00000011").collect()
    assert [r["rank"] for r in rows] == list(range(1, 9))
    assert [abs(r["shap"]) for r in rows] == sorted((abs(r["shap"]) for r in rows), reverse=True)
    assert [r["reason"] is not None for r in rows] == [True] * 3 + [False] * 5
    assert "risk signal (SHAP=" in rows[0]["reason"]
    with pytest.raises(KeyError):
        pipeline.explain_one(matrix, model, "nobody")


def test_large_models_are_explained_in_chunks(spark, trained, monkeypatch):
    whole = explain.leaf_tables(spark, trained[1].stages[-1])
    rows = np.array([[r[c] for c in MODEL_FEATURES] for r in trained[0].limit(40).collect()], dtype=float)
    expected = whole.contributions(rows)
    monkeypatch.setattr(explain, "CHUNK_BYTES", 600)
    monkeypatch.setattr(explain, "KEPT_BYTES", 1000)
    monkeypatch.setattr(explain, "ROWS_PER_BLOCK", 7)
    chunked = explain.leaf_tables(spark, trained[1].stages[-1])
    assert len(chunked.groups) > 2 * len(whole.groups)
    np.testing.assert_allclose(chunked.contributions(rows), expected, atol=1e-12)


def test_nothing_is_left_in_the_shared_folder(spark, trained):
    from stayline.session import shared_folder

    explain.leaf_tables(spark, trained[1].stages[-1])
    left = [n for n in os.listdir(shared_folder(spark)) if n.startswith(("model-", "boosting-"))]
    assert left == []


def test_workers_do_not_need_the_package(tiny, tmp_path):
    """A driver elsewhere, whose workers cannot import this package."""
    root = Path(explain.__file__).resolve().parents[2]
    script = tmp_path / "elsewhere.py"
    script.write_text(
        f"""
import sys
sys.path.insert(0, {str(root)!r})
from pyspark.sql import functions as F
from stayline.operators import explain
from stayline.schemas import MODEL_FEATURES
from stayline.session import local_session
spark = local_session(2)
node = lambda i, p, n, l, r, s: dict(id=i, prediction=p, impurityStats=[n], leftChild=l, rightChild=r, split=s)
split = dict(featureIndex=1, leftCategoriesOrThreshold=[5.0])
nodes = {{0: node(0, 0.0, 4.0, 1, 2, split), 1: node(1, -1.0, 1.0, -1, -1, None), 2: node(2, 3.0, 3.0, -1, -1, None)}}
tables = explain.group_leaves(list(explain.leaf_paths(nodes, 1.0)), 20)
rows = spark.range(2).select(*[(F.col("id") * 10.0).alias(c) for c in MODEL_FEATURES])
found = rows.select(explain.shap_values(spark, tables).alias("c")).collect()
print("FOUND", [r["c"][1] for r in found])
"""
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=180
    )
    # base 2.0; twice the margin's (-1 - 2) and (3 - 2)
    assert "FOUND [-6.0, 2.0]" in done.stdout, done.stderr[-2000:]


def test_tables_are_looked_up_by_indices_that_need_no_conversion(monkeypatch):
    paths = [(1.0, {0: (-np.inf, 1.0, 0.4), 1: (-np.inf, 2.0, 0.5)}), (2.0, {0: (1.0, np.inf, 0.6)})]
    tables = explain.group_leaves(paths, 2)
    rows = np.array([[0.0, 0.0], [2.0, 3.0], [1.0, 2.0]])
    kinds, take = set(), np.take
    monkeypatch.setattr(explain.np, "take", lambda a, at, **more: (kinds.add(at.dtype) if a.dtype == float else None, take(a, at, **more))[1])
    found = tables.contributions(rows)
    assert kinds == {np.dtype(np.intp)}
    for row, own in zip(rows, found):
        whole = sum(v * all(low < row[f] <= high for f, (low, high, _) in path.items()) for v, path in paths)
        assert own.sum() + tables.base == pytest.approx(whole)


def test_the_test_rows_of_a_trained_model_are_derived_once(spark, tiny, trained, monkeypatch):
    """The split and the result read a table that was written once, not the customers and orders again."""
    matrix, model, report = trained
    monkeypatch.setattr(catalog, "_tuned", lambda *_: model)
    found = catalog.catalog()["gbt_confusion"](spark, tiny)
    assert found.inputFiles() and all("/labelled-" in file for file in found.inputFiles())
    assert sum(r["predicted_stay"] + r["predicted_churn"] for r in found.collect()) == report["test_rows"]
