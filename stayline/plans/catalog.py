"""Every query by name: ``name -> (spark, folder) -> DataFrame`` over the tables in ``folder``."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stayline.functions.numeric import fixed
from stayline.functions.reasons import (
    RETENTION,
    SCORING,
    contribution_json,
    describe,
    rank_contributions,
)
from stayline.functions.rules import decide, recommended_action, risk_tier
from stayline.operators import cleaning, evaluation, explain, explore, features, modeling, quality
from stayline.operators import scoring
from stayline.operators.split import stratified_split
from stayline.plans import daily, pipeline, reports
from stayline.schemas import MODEL_FEATURES, REQUIRED, RUN_KEY
from stayline.session import keep_table
from stayline.sources.derived import AS_OF, predictions, raw_subscribers, subscribers

Query = Callable[[SparkSession, str], DataFrame]

# Fixed scorecard, in thousandths of log-odds per unit, for reasons that need no model.
SCORECARD = {
    "tenure": -31,
    "senior_citizen": 214,
    "is_month_to_month": 1120,
    "total_services_count": -187,
    "partner_encoded": -95,
    "dependents_encoded": -143,
    "paperless_billing_encoded": 187,
    "internet_fiber": 640,
    "payment_electronic_check": 374,
    "contract_one_year": -310,
}

SOURCES = ("customer", "orders")  # what the customers are derived from

SCALED = ["tenure", "monthly_charges", "total_charges", "avg_monthly_bill"]

def _clean(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.clean(raw_subscribers(spark, folder), require_label=False, check=False)


def _matrix(spark: SparkSession, folder: str) -> DataFrame:
    return pipeline.training_matrix(raw_subscribers(spark, folder))


def _outcomes(spark: SparkSession, folder: str) -> DataFrame:
    return evaluation.outcomes(predictions(spark, folder), subscribers(spark, folder))


def _tuned(spark: SparkSession, folder: str) -> PipelineModel:
    """The tuned model of these customers: loaded if it was saved for the same files, else trained."""
    return modeling.saved_or_trained(_matrix(spark, folder), name=modeling.source_name(spark, folder, SOURCES))


def _explained(spark: SparkSession, folder: str) -> DataFrame:
    model = _tuned(spark, folder)
    return pipeline.explained(pipeline.with_probability(_matrix(spark, folder), model), model)


# --- sources and constraints -----------------------------------------------------------------


def fix_zero_total(spark: SparkSession, folder: str) -> DataFrame:
    """First-month totals arrive as zero and leave as unknown."""
    loaded = subscribers(spark, folder).withColumn(
        "total_charges",
        F.when(F.col("tenure") == 0, F.lit(0).cast("decimal(10,2)")).otherwise(F.col("total_charges")),
    )
    return cleaning.fix_zero_totals(loaded).select("customer_id", "tenure", "total_charges")


def dq_duplicate_keys(spark: SparkSession, folder: str) -> DataFrame:
    customers = subscribers(spark, folder)
    return quality.key_summary(
        {
            "customers": (customers, ["customer_id"]),
            "churn_features": (features.feature_table(customers), ["customer_id"]),
        }
    )


def dq_orphans(spark: SparkSession, folder: str) -> DataFrame:
    """Features and predictions against the customers with a known total: some have no parent."""
    customers = subscribers(spark, folder)
    return quality.orphan_summary(
        {
            "churn_features": features.feature_table(customers),
            "churn_predictions": predictions(spark, folder),
        },
        cleaning.drop_missing_totals(customers),
    )


def dq_run_unique(spark: SparkSession, folder: str) -> DataFrame:
    """On the run key, and on the key without the day, which does repeat."""
    scores = predictions(spark, folder)
    return quality.key_summary(
        {
            "churn_predictions": (scores, RUN_KEY),
            "churn_predictions by version": (scores, ["customer_id", "model_version"]),
        }
    )


def dq_not_null(spark: SparkSession, folder: str) -> DataFrame:
    customers = subscribers(spark, folder)
    return quality.required_columns(
        {
            "customers": (customers, REQUIRED["customers"] + ["total_charges", "churn"]),
            "churn_predictions": (
                predictions(spark, folder),
                REQUIRED["churn_predictions"] + ["top_reason_1", "top_reason_3"],
            ),
        }
    )


def feat_count_check(spark: SparkSession, folder: str) -> DataFrame:
    customers = subscribers(spark, folder)
    return quality.feature_count_check(customers, features.feature_table(customers))


# --- modelling -------------------------------------------------------------------------------


def split_stratified(spark: SparkSession, folder: str) -> DataFrame:
    labelled = keep_table(_matrix(spark, folder).select("customer_id", "label").filter("label IS NOT NULL"), "labelled")
    sides = stratified_split(labelled, modeling.PARTS)
    side = F.when(F.col("is_test"), "test").when(F.col("is_validation"), "validation").otherwise("train")
    return sides.select("customer_id", "label", side.alias("side"))


def scale_zscore(spark: SparkSession, folder: str) -> DataFrame:
    """Scaled by the statistics of all customers, as plain aggregates."""
    matrix = _matrix(spark, folder)
    return modeling.scale(matrix, modeling.scaler(matrix, SCALED), digits=4).select("customer_id", *SCALED)


def scale_train(spark: SparkSession, folder: str) -> DataFrame:
    """Both sides of the split, scaled by the statistics of the training side."""
    # The cuts and the statistics look at the rows several times, their source once.
    labelled = _matrix(spark, folder).filter("label IS NOT NULL").select("customer_id", "label", *SCALED)
    sides = stratified_split(keep_table(labelled, "labelled"))
    fitted = modeling.scaler(sides.filter("NOT is_test"), SCALED)
    return modeling.scale(sides, fitted, digits=4).select("customer_id", "is_test", *SCALED)


def model_compare(spark: SparkSession, folder: str) -> DataFrame:
    return modeling.compare(_matrix(spark, folder))[0]


def gbt_train(spark: SparkSession, folder: str) -> DataFrame:
    """Trains anew each time, with the library's settings, and saves the model for the other queries."""
    matrix = _matrix(spark, folder)
    model, report = modeling.train_tuned(matrix)
    modeling.save_model(model, modeling.saved_path(spark, modeling.source_name(spark, folder, SOURCES)))
    names = ["model", "trees", "train_rows", "validation_rows", "test_rows"]
    scores = ["accuracy", "precision", "recall", "f1", "roc_auc"]
    return spark.createDataFrame(
        [[report[name] for name in names + scores]],
        "model string, trees int, train_rows long, validation_rows long, test_rows long, "
        + ", ".join(f"{name} double" for name in scores),
    )


def feature_importance(spark: SparkSession, folder: str) -> DataFrame:
    return modeling.feature_importance(_tuned(spark, folder), spark)


def _on_test_rows(which: int) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        # The split looks at the rows several times, their source once.
        labelled = _matrix(spark, folder).filter("label IS NOT NULL")
        test = modeling.split_frames(keep_table(labelled, "labelled")).filter("is_test")
        return modeling.outcome_report(_tuned(spark, folder), test, "Boosted Trees (tuned)")[which]

    return query


def class_weight(spark: SparkSession, folder: str) -> DataFrame:
    return evaluation.class_weight(_matrix(spark, folder))


def per_version(metric: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: metric(_outcomes(spark, folder))


# --- scoring ---------------------------------------------------------------------------------


def score_customers(spark: SparkSession, folder: str) -> DataFrame:
    return pipeline.score(raw_subscribers(spark, folder), _tuned(spark, folder))


def _rule(name: str, rule: Callable[[Column], Column]) -> Query:
    return lambda spark, folder: predictions(spark, folder).select(
        *RUN_KEY, "churn_probability", rule(F.col("churn_probability")).alias(name)
    )


def shap_values(spark: SparkSession, folder: str) -> DataFrame:
    """Contributions, with what they leave unexplained of the log-odds: zero but for rounding."""
    model, matrix = _tuned(spark, folder), _matrix(spark, folder)
    tables = explain.leaf_tables(spark, model.stages[-1])
    p = F.col("churn_probability")
    total = F.aggregate("contributions", F.lit(explain.base_value(tables)), lambda a, b: a + b)
    return pipeline.explained(pipeline.with_probability(matrix, model), model, tables).select(
        "customer_id",
        "churn_probability",
        contribution_json("contributions", MODEL_FEATURES).alias("shap_values_json"),
        F.round(F.abs(total - F.log(p / (1 - p))), 6).alias("unexplained"),
    )


def shap_additivity(spark: SparkSession, folder: str) -> DataFrame:
    """Per customer: how many contributions there are and what they leave unexplained."""
    return shap_values(spark, folder).select(
        "customer_id",
        F.size(F.json_object_keys("shap_values_json")).alias("contributions"),
        "unexplained",
    )


def _scorecard(spark: SparkSession, folder: str) -> DataFrame:
    matrix = _matrix(spark, folder)
    parts = [(F.col(c) * weight / 1000).cast("double") for c, weight in SCORECARD.items()]
    return matrix.select("customer_id", F.array(*parts).alias("contributions"))


def _scorecard_reasons(
    spark: SparkSession, folder: str, top: int, wording: tuple[str, str, str]
) -> DataFrame:
    ranked = _scorecard(spark, folder).select(
        "customer_id", rank_contributions("contributions", top).alias("ranked")
    )
    return ranked.select(
        "customer_id",
        *[c.alias(f"reason_{n + 1}") for n, c in enumerate(describe("ranked", list(SCORECARD), top, wording))],
        *[
            fixed(F.expr(f"ranked[{n}].value"), 3).alias(f"value_{n + 1}")
            for n in range(top)
        ],
    )


def shap_global(spark: SparkSession, folder: str) -> DataFrame:
    return explain.global_importance(_explained(spark, folder))


def shap_pairs(spark: SparkSession, folder: str) -> DataFrame:
    return explain.value_pairs(_explained(spark, folder))


def explain_customer(spark: SparkSession, folder: str) -> DataFrame:
    """The customer most likely to leave, of all of them."""
    model, matrix = _tuned(spark, folder), _matrix(spark, folder)
    first = scoring.ranked(pipeline.with_probability(matrix, model)).select("customer_id").first()
    return pipeline.explain_one(matrix, model, first["customer_id"])


def shap_pair_values(spark: SparkSession, folder: str) -> DataFrame:
    """Which pairs there are, and that none lacks its contribution."""
    pairs = shap_pairs(spark, folder)
    return pairs.select("customer_id", "feature", "value", F.col("shap").isNotNull().alias("has_shap"))


def shap_global_features(spark: SparkSession, folder: str) -> DataFrame:
    """Which features are ranked, and that each mean is one of magnitudes."""
    ranked = shap_global(spark, folder)
    return ranked.select("feature", (F.col("mean_abs_shap") >= 0).alias("is_magnitude"))


def gbt_confusion_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Test rows per label, as the cells of the trained model add up to them."""
    cells = _on_test_rows(1)(spark, folder)
    return cells.select("label", (F.col("predicted_stay") + F.col("predicted_churn")).alias("test_rows"))


def gbt_class_support(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of the trained model's report, their support and that all rates lie between 0 and 1."""
    lines = _on_test_rows(0)(spark, folder)
    sound = [F.col(c).between(0, 1) for c in ("precision", "recall", "f1")]
    return lines.select("class", "support", (sound[0] & sound[1] & sound[2]).alias("sound"))


def score_consistency(spark: SparkSession, folder: str) -> DataFrame:
    """Per scored customer: whether tier, prediction and action agree with the published probability.

    Bands look at the raw probability, so half a unit of its fourth digit is allowed for.
    """
    p, half = F.col("churn_probability").cast("double"), 5e-5
    low = {"LOW": 0.0, "MEDIUM": 0.40, "HIGH": 0.65}
    high = {"LOW": 0.40, "MEDIUM": 0.65, "HIGH": 1.0}

    def within(bounds: dict[str, float]) -> Column:
        return F.element_at(F.create_map(*[c for k, v in bounds.items() for c in (F.lit(k), F.lit(v))]), F.col("risk_tier"))

    decided = F.when(p >= 0.5 + half, 1).when(p <= 0.5 - half, 0).otherwise(F.col("churn_prediction"))
    action = recommended_action(p)
    near = (F.abs(p - 0.75) <= half) | (F.abs(p - 0.55) <= half) | (F.abs(p - 0.40) <= half)
    return score_customers(spark, folder).select(
        "customer_id",
        ((p >= within(low) - half) & (p <= within(high) + half)).alias("tier_agrees"),
        (F.col("churn_prediction") == decided).alias("prediction_agrees"),
        (near | (F.col("recommended_action") == action)).alias("action_agrees"),
        F.size(F.array_distinct(F.transform(F.array("top_reason_1", "top_reason_2", "top_reason_3"), lambda r: F.split_part(r, F.lit(" "), F.lit(1))))).alias("reasons"),
    )


def score_top10(spark: SparkSession, folder: str) -> DataFrame:
    return scoring.top_at_risk(reports.of_day(predictions(spark, folder), AS_OF))


def score_summary(spark: SparkSession, folder: str) -> DataFrame:
    return scoring.run_summary(reports.of_day(predictions(spark, folder), AS_OF))


# --- registry --------------------------------------------------------------------------------


def _on(source: Callable[[SparkSession, str], DataFrame], operator: Callable, *columns: str) -> Query:
    """``operator`` over ``source``, reduced to ``columns`` if given."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        result = operator(source(spark, folder))
        return result.select(*columns) if columns else result

    return query


def _report(operator: Callable, **options) -> Query:
    return lambda spark, folder: operator(
        predictions(spark, folder), subscribers(spark, folder), **options
    )


def _from_sums(report: Callable[[DataFrame], DataFrame]) -> Query:
    """A report from one row of sums per run."""
    return lambda spark, folder: report(daily.run_sums(predictions(spark, folder), subscribers(spark, folder)))


def _coerced(raw: DataFrame) -> DataFrame:
    return raw.select(
        "customer_id",
        F.col("total_charges").alias("delivered"),
        cleaning.to_number(F.col("total_charges")).alias("total_charges"),
    )


def catalog() -> dict[str, Query]:
    on_customers, on_raw = partial(_on, subscribers), partial(_on, raw_subscribers)
    on_features = partial(_on, _on(subscribers, features.feature_table))
    today = {"as_of": AS_OF}
    return {
        "fix_zero_total": fix_zero_total,
        "dq_duplicate_keys": dq_duplicate_keys,
        "dq_orphans": dq_orphans,
        "dq_run_unique": dq_run_unique,
        "dq_not_null": dq_not_null,
        "dq_row_count": on_customers(quality.row_count),
        "dq_churn_distribution": on_customers(quality.label_distribution),
        "dq_null_audit": on_customers(quality.null_audit),
        "dq_assertions": _on(_clean, quality.assertion_report),
        "feat_count_check": feat_count_check,
        "feat_churn_rate": on_features(quality.feature_churn_rate),
        "feat_spot_check": on_features(quality.feature_spot_check),
        "clean_coerce": on_raw(_coerced),
        "clean_customers": _clean,
        "clean_summary": on_raw(cleaning.clean_summary),
        "clean_label_counts": _on(_clean, cleaning.label_counts),
        "clean_preview": _on(_clean, cleaning.preview),
        "eda_overview": on_customers(explore.overview),
        "eda_numeric_summary": on_customers(explore.numeric_summary),
        "eda_by_contract": on_customers(explore.by_contract),
        "eda_by_tenure": on_customers(explore.by_tenure),
        "eda_by_internet": on_customers(explore.by_internet),
        "eda_by_bill": on_customers(explore.by_bill),
        "eda_by_payment": on_customers(explore.by_payment),
        "eda_danger_zone": on_customers(explore.danger_zone),
        "eda_revenue_at_risk": on_customers(explore.revenue_at_risk),
        "eda_by_senior": on_customers(explore.by_senior),
        "eda_by_churn": on_customers(explore.by_churn),
        "feat_binary": on_customers(features.binary_flags, "customer_id", *features.BINARY),
        "feat_contract_onehot": on_customers(
            features.contract_onehot, "customer_id", *features.CONTRACT
        ),
        "feat_internet_onehot": on_customers(
            features.internet_onehot, "customer_id", *features.INTERNET
        ),
        "feat_payment_onehot": on_customers(
            features.payment_onehot, "customer_id", *features.PAYMENT
        ),
        "feat_tenure_group": on_customers(features.add_tenure_group, "customer_id", "tenure_group"),
        "feat_avg_bill": on_customers(features.add_computed, "customer_id", "avg_monthly_bill"),
        "feat_charge_ratio": on_customers(
            features.add_computed, "customer_id", "charge_to_tenure_ratio"
        ),
        "feat_service_count": on_customers(
            features.add_computed, "customer_id", "total_services_count"
        ),
        "feat_table": on_customers(features.feature_table),
        "feat_model_matrix": _matrix,
        "split_stratified": split_stratified,
        "scale_train": scale_train,
        "scale_zscore": scale_zscore,
        "class_weight": class_weight,
        "eval_metrics": per_version(evaluation.metrics),
        "eval_roc_auc": per_version(evaluation.roc_auc),
        "eval_class_report": per_version(evaluation.class_report),
        "eval_confusion": per_version(evaluation.confusion),
        "model_compare": model_compare,
        "gbt_train": gbt_train,
        "gbt_class_report": _on_test_rows(0),
        "gbt_confusion": _on_test_rows(1),
        "gbt_class_support": gbt_class_support,
        "gbt_confusion_rows": gbt_confusion_rows,
        "feature_importance": feature_importance,
        "score_customers": score_customers,
        "score_consistency": score_consistency,
        "score_threshold": _rule("churn_prediction", decide),
        "risk_tier": _rule("risk_tier", risk_tier),
        "recommended_action": _rule("recommended_action", recommended_action),
        "shap_values": shap_values,
        "shap_additivity": shap_additivity,
        "reason_codes": partial(_scorecard_reasons, top=3, wording=SCORING),
        "top_reasons_n": partial(_scorecard_reasons, top=5, wording=RETENTION),
        "score_summary": score_summary,
        "score_top10": score_top10,
        "shap_global": shap_global,
        "shap_pairs": shap_pairs,
        "shap_global_features": shap_global_features,
        "shap_pair_values": shap_pair_values,
        "explain_customer": explain_customer,
        "view_at_risk": _report(reports.at_risk_view, **today),
        "view_daily_summary": _on(predictions, reports.daily_summary),
        "report_call_list": _report(reports.call_list, **today),
        "report_exec_summary": _report(reports.executive_summary, **today),
        "report_weekly_trend": _report(reports.weekly_trend),
        "report_top_drivers": _on(predictions, partial(reports.top_drivers, as_of=AS_OF)),
        "report_segments": _report(reports.segments, **today),
        "report_retention_roi": _report(reports.retention_roi, **today),
        "report_model_tracking": _report(reports.model_tracking),
        "daily_summary_from_sums": _from_sums(daily.daily_summary),
        "weekly_trend_from_sums": _from_sums(daily.weekly_trend),
        "model_tracking_from_sums": _from_sums(daily.model_tracking),
    }
