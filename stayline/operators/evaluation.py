"""Classifier metrics as aggregates over (label, prediction, score) rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayline.functions.numeric import count_if, fixed, ratio

CELLS = 4096  # of scores between 0 and 1


def outcomes(predictions: DataFrame, customers: DataFrame) -> DataFrame:
    """Scores with a known outcome, counted: ``n`` rows of a customer with equal version, score and prediction.

    They are counted before the join, so a customer with a third of all rows reaches it as few lines, and all
    metrics below work on counts. A frame without ``n`` counts each row once.
    """
    known = customers.filter(F.col("churn").isNotNull()).select(
        "customer_id", F.when(F.col("churn") == "Yes", 1).otherwise(0).alias("label")
    )
    counted = predictions.groupBy(
        "customer_id",
        "model_version",
        F.col("churn_prediction").alias("prediction"),
        F.col("churn_probability").alias("score"),
    ).agg(F.count("*").alias("n"))
    return counted.join(known, "customer_id")


def _often(rows: DataFrame) -> Column:
    return F.col("n") if "n" in rows.columns else F.lit(1)


def _zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0.0))


def _cells(rows: DataFrame) -> dict[str, Column]:
    hit, says, often = F.col("label") == 1, F.col("prediction") == 1, _often(rows)

    def total(which: Column) -> Column:
        return F.sum(F.when(which, often).otherwise(0))

    return {
        "tp": total(hit & says),
        "fp": total(~hit & says),
        "tn": total(~hit & ~says),
        "fn": total(hit & ~says),
    }


def _f1(precision: Column, recall: Column) -> Column:
    return F.try_divide(precision * recall * 2, precision + recall)


def metrics(rows: DataFrame, by: Sequence[str] = ("model_version",), digits: int = 4) -> DataFrame:
    """Accuracy, and precision, recall and F1 of the positive class; 0 where undefined."""
    counted = rows.groupBy(*by).agg(*[cell.alias(name) for name, cell in _cells(rows).items()])
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    return counted.select(
        *by,
        ratio(tp + tn, tp + fp + tn + fn, digits).alias("accuracy"),
        _zero(ratio(tp, tp + fp, digits)).alias("precision"),
        _zero(ratio(tp, tp + fn, digits)).alias("recall"),
        _zero(ratio(tp * 2, tp * 2 + fp + fn, digits)).alias("f1"),
    )


def roc_auc(
    rows: DataFrame,
    by: Sequence[str] = ("model_version",),
    digits: int = 4,
    score_digits: int | None = None,
) -> DataFrame:
    """Area under the ROC curve, ties counting one half; scores are rounded only if asked.

    Rows are first counted per score. The running count of negatives goes over cells of scores first
    and then within each cell, so no task sees all scores of a group.
    """
    often = _often(rows)
    score = F.col("score") if score_digits is None else F.round("score", score_digits)
    per_score = rows.groupBy(*by, score.alias("score")).agg(
        F.sum(F.col("label") * often).alias("pos"), F.sum((1 - F.col("label")) * often).alias("neg")
    )
    per_score = per_score.withColumn("cell", F.floor(F.col("score").cast("double") * CELLS))
    cells = per_score.groupBy(*by, "cell").agg(F.sum("neg").alias("all_neg"))
    below_cell = F.sum("all_neg").over(Window.partitionBy(*by).orderBy("cell")) - F.col("all_neg")
    cells = cells.select(*by, "cell", below_cell.alias("base"))
    inside = F.sum("neg").over(Window.partitionBy(*by, "cell").orderBy("score")) - F.col("neg")
    placed = per_score.withColumn("inside", inside).join(cells, [*by, "cell"])
    below = F.col("base") + F.col("inside")
    # Twice the area, in whole numbers: exact in any order.
    doubled = F.col("pos").cast("decimal(19,0)") * (below * 2 + F.col("neg")).cast("decimal(19,0)")
    summed = placed.withColumn("doubled", doubled).groupBy(*by).agg(
        F.sum("doubled").cast("double").alias("area"),
        F.sum("pos").cast("double").alias("p"),
        F.sum("neg").cast("double").alias("n"),
    )
    area = F.try_divide(F.col("area") / 2, F.col("p") * F.col("n"))
    return summed.select(*by, fixed(area, digits).alias("roc_auc"))


def confusion(rows: DataFrame, by: Sequence[str] = ("model_version",)) -> DataFrame:
    """One row per actual label, one column per prediction."""
    wide = rows.groupBy(*by, "label").pivot("prediction", [0, 1]).agg(F.sum(_often(rows)).cast("long"))
    return wide.select(
        *by,
        "label",
        F.coalesce("0", F.lit(0)).alias("predicted_stay"),
        F.coalesce("1", F.lit(0)).alias("predicted_churn"),
    )


def class_report(
    rows: DataFrame, by: Sequence[str] = ("model_version",), digits: int = 4
) -> DataFrame:
    """Precision, recall, F1 and support per class, then accuracy, macro and weighted averages.

    Everything after the four cell counts is arithmetic on one row per group.
    """
    counted = rows.groupBy(*by).agg(*[cell.alias(name) for name, cell in _cells(rows).items()])
    double = {c: F.col(c).cast("double") for c in ("tp", "fp", "tn", "fn")}

    def scores(hit: Column, false: Column, miss: Column) -> tuple[Column, Column, Column, Column]:
        precision = _zero(F.try_divide(hit, hit + false))
        recall = _zero(F.try_divide(hit, hit + miss))
        return precision, recall, _zero(_f1(precision, recall)), hit + miss

    stay = scores(double["tn"], double["fn"], double["fp"])
    churn = scores(double["tp"], double["fp"], double["fn"])
    total = stay[3] + churn[3]
    right = F.try_divide(double["tp"] + double["tn"], total)

    def line(name: str, p: Column, r: Column, f: Column, n: Column) -> Column:
        return F.struct(
            F.lit(name).alias("class"),
            fixed(p, digits).alias("precision"),
            fixed(r, digits).alias("recall"),
            fixed(f, digits).alias("f1"),
            n.cast("long").alias("support"),
        )

    def average(weight_stay: Column, weight_churn: Column) -> list[Column]:
        return [
            F.try_divide(stay[i] * weight_stay + churn[i] * weight_churn, weight_stay + weight_churn)
            for i in range(3)
        ]

    lines = F.array(
        line("Stay", *stay),
        line("Churn", *churn),
        line("accuracy", right, right, right, total),
        line("macro avg", *average(F.lit(1.0), F.lit(1.0)), total),
        line("weighted avg", *average(stay[3], churn[3]), total),
    )
    return counted.select(*by, F.explode(lines).alias("line")).select(*by, "line.*")


def class_weight(rows: DataFrame, label: str = "label") -> DataFrame:
    """Negatives per positive."""
    positives, negatives = count_if(F.col(label) == 1), count_if(F.col(label) == 0)
    return rows.agg(
        positives.alias("positives"),
        negatives.alias("negatives"),
        ratio(negatives, positives, 6).alias("pos_weight"),
    )
