"""Raw customers to published scores."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayline.functions.rules import DECISION_THRESHOLD
from stayline.operators.cleaning import clean
from stayline.operators.explain import LeafTables, explain_rows, leaf_tables, shap_values
from stayline.operators.features import model_matrix
from stayline.operators.modeling import probability
from stayline.operators.quality import enforce_sound
from stayline.operators.scoring import assemble, ranked
from stayline.session import keep_table


def training_matrix(raw: DataFrame) -> DataFrame:
    """Cleaned and encoded. Unlabelled customers stay in, with a null label."""
    return model_matrix(clean(raw, require_label=False, check=False))


def with_probability(matrix: DataFrame, model: PipelineModel) -> DataFrame:
    scored = model.transform(matrix)
    return scored.select(*matrix.columns, probability().alias("churn_probability"))


def explained(
    scored: DataFrame, model: PipelineModel, tables: LeafTables | None = None
) -> DataFrame:
    """The scored matrix with the contributions of each feature."""
    spark = scored.sparkSession
    lookup = tables or leaf_tables(spark, model.stages[-1])
    return scored.withColumn("contributions", shap_values(spark, lookup))


def score(
    raw: DataFrame,
    model: PipelineModel,
    threshold: float = DECISION_THRESHOLD,
    tables: LeafTables | None = None,
    check: bool = True,
    order: bool = True,
) -> DataFrame:
    """One published row per customer that survives cleaning, most likely leaver first.

    The sort comes before the explanation: it moves the numeric matrix instead of reason texts. What it
    sorts is stored first, so its sampling reads probabilities, and cleaning, features and model run once.
    """
    cleaned = clean(raw, require_label=False, check=False)
    if check:
        cleaned = enforce_sound(cleaned, None)
    scored = with_probability(model_matrix(cleaned), model)
    if order:
        scored = ranked(keep_table(scored, "scored"))
    return assemble(explained(scored, model, tables), threshold)


def explain_one(
    matrix: DataFrame,
    model: PipelineModel,
    customer_id: str,
    top: int = 8,
    tables: LeafTables | None = None,
) -> DataFrame:
    """Why this customer: an unknown id is an error, not some other customer."""
    one = matrix.filter(F.col("customer_id") == customer_id).collect()
    if not one:
        raise KeyError(f"no customer {customer_id}")
    rows = matrix.sparkSession.createDataFrame(one, matrix.schema)
    return explain_rows(explained(with_probability(rows, model), model, tables), top)


def explain_stored(
    spark: SparkSession,
    table: str,
    model: PipelineModel,
    customer_id: str,
    top: int = 8,
    tables: LeafTables | None = None,
) -> DataFrame:
    """``explain_one`` from a matrix stored in buckets by customer: one bucket is read, whatever the table's size."""
    return explain_one(spark.table(table), model, customer_id, top, tables)
