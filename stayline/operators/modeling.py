"""Estimators on the model matrix, and their comparison."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import asdict, dataclass

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stayline.functions.numeric import fixed
from stayline.operators import boosting
from stayline.operators.boosting import DEFAULT, TUNED, Boosting
from stayline.operators.evaluation import class_report, confusion, metrics
from stayline.operators.split import stratified_split
from stayline.schemas import MODEL_FEATURES
from stayline.session import files_below, folder_exists, shared_folder

SEED = 42
PARTS = {"is_test": 0.20, "is_validation": 0.10}


@dataclass(frozen=True)
class Sizes:
    """Model sizes of a comparison."""

    # The published sizes.

    logistic_iterations: int = 1000
    tree_depth: int = 6
    forest_trees: int = 200
    forest_depth: int = 10
    boosted: Boosting = DEFAULT
    tuned: Boosting = TUNED


def probability() -> Column:
    return vector_to_array("probability")[1]


# --- scaling ---------------------------------------------------------------------------------


def scaler(train: DataFrame, columns: Sequence[str] = MODEL_FEATURES) -> dict[str, tuple[float, float]]:
    """Mean and population deviation per column, from one pass; a constant column keeps scale 1."""
    row = train.agg(
        *[F.avg(c).alias(f"m_{c}") for c in columns],
        *[F.stddev_pop(c).alias(f"s_{c}") for c in columns],
    ).first()
    return {c: (row[f"m_{c}"], row[f"s_{c}"] or 1.0) for c in columns}


def scale(df: DataFrame, fitted: dict[str, tuple[float, float]], digits: int | None = None) -> DataFrame:
    def z(name: str) -> Column:
        centre, spread = fitted[name]
        value = (F.col(name) - F.lit(centre)) / F.lit(spread)
        return value if digits is None else fixed(value, digits)

    return df.withColumns({c: z(c) for c in fitted})


# --- frames ----------------------------------------------------------------------------------


def split_frames(matrix: DataFrame, seed: int = SEED) -> DataFrame:
    """Labelled rows, each marked as test, validation or (neither) training.

    The test rows never steer the training: early stopping has validation rows of its own.
    """
    labelled = matrix.filter(F.col("label").isNotNull())
    return stratified_split(labelled, PARTS, seed=seed)


def class_weights(train: DataFrame) -> tuple[int, float]:
    """Training rows and negatives per positive."""
    row = train.agg(
        F.count("*").alias("n"), F.count_if(F.col("label") == 1).alias("positives")
    ).first()
    return row["n"], (row["n"] - row["positives"]) / max(row["positives"], 1)


def _features() -> VectorAssembler:
    return VectorAssembler(inputCols=list(MODEL_FEATURES), outputCol="features")


# --- estimators ------------------------------------------------------------------------------


def train_logistic(train: DataFrame, iterations: int = 1000) -> PipelineModel:
    """L2 with strength 1 on the summed loss; MLlib averages the loss, hence 1/n. Scale first."""
    n = train.count()
    estimator = LogisticRegression(
        maxIter=iterations, regParam=1.0 / max(n, 1), elasticNetParam=0.0, standardization=False
    )
    return Pipeline(stages=[_features(), estimator]).fit(train)


def train_tree(train: DataFrame, depth: int = 6, seed: int = SEED) -> PipelineModel:
    return Pipeline(stages=[_features(), DecisionTreeClassifier(maxDepth=depth, seed=seed)]).fit(train)


def train_forest(
    train: DataFrame, trees: int = 200, depth: int = 10, seed: int = SEED
) -> PipelineModel:
    estimator = RandomForestClassifier(
        numTrees=trees, maxDepth=depth, featureSubsetStrategy="sqrt", seed=seed
    )
    # Every task sends sums for all nodes of all trees, however few its rows are: no more tasks than run at once.
    cores = train.sparkSession.sparkContext.defaultParallelism
    return Pipeline(stages=[_features(), estimator]).fit(train.coalesce(cores))


@dataclass
class BinnedTable:
    """Rows with a byte per feature, and the cuts between the bytes: found once, shared by all boosted models."""

    rows: DataFrame
    cuts: list


def bin_table(train: DataFrame) -> BinnedTable:
    cuts = boosting.find_cuts(train)
    flags = [c for c in ("is_validation",) if c in train.columns]
    return BinnedTable(boosting.binned(train, cuts).select("bins", "unit", "label", *flags), cuts)


def train_boosted(
    train: DataFrame, settings: Boosting = TUNED, seed: int = SEED, table: BinnedTable | None = None
) -> PipelineModel:
    """``train`` carries ``label`` and, for early stopping, ``is_validation``; ``table`` are the same rows, binned.

    With patience, trees are grown until that many of them have brought no better area under the
    validation rows' ROC curve, and the model is cut to the best number: nothing is grown twice, and
    at most a chunk of trees more than patience asks for. Everything that lasts is written to the shared
    folder, so a lost executor costs a chunk at most.
    """
    spark = train.sparkSession
    shared_folder(spark)
    table = table or bin_table(train)
    rows, held_out = table.rows, None
    if settings.patience:
        rows, held_out = rows.filter(~F.col("is_validation")), rows.filter("is_validation")
    weight = F.lit(1.0)
    if settings.weighted:
        weight = F.when(F.col("label") == 1, class_weights(rows)[1]).otherwise(1.0)
    rows, held_out = (None if f is None else f.withColumn("weight", weight) for f in (rows, held_out))
    trees, areas = boosting.grow(rows, held_out, table.cuts, settings, seed)
    if settings.patience:
        trees = trees[: boosting.best_round(areas, settings.patience)[0]]
    return PipelineModel([_features(), boosting.as_mllib(spark, trees, table.cuts, settings.depth)])


# --- evaluation ------------------------------------------------------------------------------


def evaluate(name: str, model: PipelineModel, test: DataFrame) -> dict:
    """One metrics row. The area is MLlib's exact one: a distributed sort, no bins.

    It ranks by probability: the raw prediction of a single tree is a row count of its leaf.
    """
    scored = model.transform(test).select(
        "label", F.col("prediction").cast("int").alias("prediction"), "probability"
    )
    row = metrics(scored.withColumn("model", F.lit(name)), by=["model"]).first().asDict()
    area = BinaryClassificationEvaluator(
        labelCol="label", rawPredictionCol="probability", numBins=0
    ).evaluate(scored)
    return {**row, "roc_auc": round(area, 4)}


def outcome_report(model: PipelineModel, test: DataFrame, name: str = "model") -> tuple[DataFrame, DataFrame]:
    """Class report and confusion of a trained model on labelled rows."""
    scored = model.transform(test).select(
        F.lit(name).alias("model"), "label", F.col("prediction").cast("int").alias("prediction")
    )
    return class_report(scored, ["model"]), confusion(scored, ["model"])


def compare(matrix: DataFrame, sizes: Sizes = Sizes()) -> tuple[DataFrame, PipelineModel]:
    """All five classifiers on one split: a metrics row each, and the tuned model."""
    spark = matrix.sparkSession
    matrix = matrix.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        frames = split_frames(matrix)
        train, test = frames.filter("NOT is_test"), frames.filter("is_test")
        fitted = scaler(train)
        plain = {
            "Decision Tree": lambda: train_tree(train, sizes.tree_depth),
            "Random Forest": lambda: train_forest(train, sizes.forest_trees, sizes.forest_depth),
            "Boosted Trees (default)": lambda: train_boosted(train, sizes.boosted, table=table),
            "Boosted Trees (tuned)": lambda: train_boosted(train, sizes.tuned, table=table),
        }
        table = bin_table(train)
        table.rows = table.rows.persist(StorageLevel.MEMORY_AND_DISK)
        logistic = train_logistic(scale(train, fitted), sizes.logistic_iterations)
        rows = [{**evaluate("Logistic Regression", logistic, scale(test, fitted)), "trees": None}]
        for name, fit in plain.items():
            model = fit()
            size = getattr(model.stages[-1], "getNumTrees", 1)
            rows.append({**evaluate(name, model, test), "trees": size})
        table.rows.unpersist()
    finally:
        matrix.unpersist()
    return metrics_frame(spark, rows), model


def metrics_frame(spark: SparkSession, rows: list[dict]) -> DataFrame:
    schema = (
        "model string, accuracy double, precision double, recall double, f1 double, roc_auc double, trees int"
    )
    names = ("model", "accuracy", "precision", "recall", "f1", "roc_auc", "trees")
    return spark.createDataFrame(
        [[row[name] for name in names] for row in rows],
        schema,
    )


def store_comparison(comparison: DataFrame, path: str) -> None:
    """The report: one row per model, best area first."""
    comparison.orderBy(F.col("roc_auc").desc()).coalesce(1).write.mode("overwrite").parquet(path)


def train_tuned(matrix: DataFrame, settings: Boosting = TUNED) -> tuple[PipelineModel, dict]:
    """The tuned model with its sizes and test metrics."""
    # Kept before the split, which looks at the rows' keys more than once.
    matrix = matrix.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        frames = split_frames(matrix)
        train, test = frames.filter("NOT is_test"), frames.filter("is_test")
        model = train_boosted(train, settings)
        counts = frames.agg(
            F.count_if("is_test").alias("test_rows"),
            F.count_if("is_validation").alias("validation_rows"),
            F.count_if(~F.col("is_test") & ~F.col("is_validation")).alias("train_rows"),
        ).first()
        report = {**evaluate("Boosted Trees (tuned)", model, test), **counts.asDict()}
    finally:
        matrix.unpersist()
    return model, {**report, "trees": len(model.stages[-1].treeWeights)}


def feature_importance(model: PipelineModel, spark: SparkSession, top: int = 15) -> DataFrame:
    """One row per model feature, most important first."""
    values = model.stages[-1].featureImportances.toArray().tolist()
    return (
        spark.createDataFrame(list(zip(MODEL_FEATURES, values)), "feature string, importance double")
        .orderBy(F.col("importance").desc(), "feature")
        .limit(top)
    )


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    """The model, which remembers where its last stage lies: its nodes are read there when it is explained."""
    model = PipelineModel.load(path)
    last = model.stages[-1]
    last.saved_in = f"{path}/stages/{len(model.stages) - 1}_{last.uid}"
    return model


def fingerprint(matrix: DataFrame) -> str:
    """Names a training set: one pass over the rows, in any order."""
    row = matrix.agg(
        F.count("*").alias("n"), F.sum(F.xxhash64(*matrix.columns).cast("decimal(38,0)")).alias("sum")
    ).first()
    return hashlib.md5(f"{row['n']} {row['sum']} {matrix.columns}".encode()).hexdigest()


def source_name(spark: SparkSession, folder: str, tables: Sequence[str]) -> str:
    """Names the files a training set is derived from, by path, size and time: no row is read."""
    files = sorted(f for table in tables for f in files_below(spark, f"{folder}/{table}.parquet"))
    return hashlib.md5(str(files).encode()).hexdigest()


def saved_path(spark: SparkSession, name: str, settings: Boosting = TUNED) -> str:
    """Where the model of a training set and settings is kept: other data has another name."""
    text = f"{name} {sorted(asdict(settings).items())} {MODEL_FEATURES}"
    return f"{shared_folder(spark)}/tuned-{hashlib.md5(text.encode()).hexdigest()}"


def saved_or_trained(matrix: DataFrame, settings: Boosting = TUNED, name: str | None = None) -> PipelineModel:
    """The model that was saved for this training set and settings, or a new one, then saved.

    ``name`` tells the training set; without one its rows do.
    """
    path = saved_path(matrix.sparkSession, name or fingerprint(matrix), settings)
    # The stages are written last.
    if not folder_exists(matrix.sparkSession, f"{path}/stages"):
        model, _ = train_tuned(matrix, settings)
        save_model(model, path)
    return load_model(path)
