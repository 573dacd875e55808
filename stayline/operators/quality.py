"""Constraints as data-quality queries: nothing is enforced on write, everything can be audited."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayline.functions.numeric import count_if, mean, percent
from stayline.schemas import CUSTOMER_COLUMNS


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).filter("copies > 1")


def key_summary(tables: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """Per table: rows, distinct keys, keys that occur more than once, rows beyond the first."""

    def one(name: str, df: DataFrame, keys: Sequence[str]) -> DataFrame:
        return (
            df.groupBy(*keys)
            .agg(F.count("*").alias("copies"))
            .agg(
                F.lit(name).alias("table_name"),
                F.coalesce(F.sum("copies"), F.lit(0)).alias("total_rows"),
                F.count("*").alias("distinct_keys"),
                F.count_if(F.col("copies") > 1).alias("duplicated_keys"),
                F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("surplus_rows"),
            )
        )

    return reduce(DataFrame.unionByName, [one(n, df, keys) for n, (df, keys) in tables.items()])


def orphans(child: DataFrame, parent: DataFrame, key: str = "customer_id") -> DataFrame:
    """Child keys without a parent, with their row count; a hot child key is counted before the join."""
    counted = child.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("child_rows"))
    return counted.join(parent.select(key), key, "left_anti")


def unknown_parents(child: DataFrame, parent: DataFrame, key: str = "customer_id") -> DataFrame:
    """Rows of the child whose key the parent does not have: a foreign key that is checked.

    Written as an outer join, so that Spark may put its own Bloom filter of the child's keys in front of the
    parent's shuffle: where a few rows are checked against a large table, only parents that may be asked
    for are moved. The join behind it is exact, whatever the filter lets through. The comparison
    is true of every text; it tells the optimizer that the child is worth a filter.
    """
    known = parent.select(F.col(key).alias("_parent"))
    asked = child.filter(F.col(key) >= "") if child.schema[key].dataType.simpleString() == "string" else child
    return asked.join(known, F.col(key) == F.col("_parent"), "left").filter("_parent IS NULL").drop("_parent")


def orphan_summary(
    children: Mapping[str, DataFrame], parent: DataFrame, key: str = "customer_id"
) -> DataFrame:
    def one(name: str, child: DataFrame) -> DataFrame:
        return orphans(child, parent, key).agg(
            F.lit(name).alias("table_name"),
            F.count("*").alias("orphan_keys"),
            F.coalesce(F.sum("child_rows"), F.lit(0)).alias("orphan_rows"),
        )

    return reduce(DataFrame.unionByName, [one(n, child) for n, child in children.items()])


def null_counts(df: DataFrame, columns: Sequence[str], prefix: str = "null_") -> DataFrame:
    """All null counts in one pass."""
    return df.agg(
        F.count("*").alias("total_rows"),
        *[count_if(F.col(c).isNull()).alias(f"{prefix}{c}") for c in columns],
    )


def required_columns(tables: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """One row per table and required column, from one pass over each table."""

    def one(name: str, df: DataFrame, columns: Sequence[str]) -> DataFrame:
        wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
        return wide.unpivot([], list(columns), "column_name", "null_rows").select(
            F.lit(name).alias("table_name"), "column_name", "null_rows"
        )

    return reduce(DataFrame.unionByName, [one(n, df, cols) for n, (df, cols) in tables.items()])


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("total_customers"))


def label_distribution(df: DataFrame, label: str = "churn") -> DataFrame:
    """Count and share per label: the total is a window over the few grouped rows."""
    counted = df.groupBy(label).agg(F.count("*").alias("count"))
    everything = F.expr("sum(`count`) OVER ()")
    return counted.select(label, "count", percent(F.col("count"), everything).alias("pct"))


def null_audit(df: DataFrame) -> DataFrame:
    return null_counts(df, ["tenure", "monthly_charges", "total_charges", "contract", "churn"])


def _breaches(label: str) -> dict[str, Column]:
    # A null fails its comparison, so it counts as a breach too.
    return {
        "null_label": F.col(label).isNull(),
        "bad_tenure": ~F.coalesce(F.col("tenure") >= 0, F.lit(False)),
        "bad_charge": ~F.coalesce(F.col("monthly_charges") > 0, F.lit(False)),
    }


def assertion_report(df: DataFrame, label: str = "churn") -> DataFrame:
    return df.agg(*[F.count_if(bad).alias(name) for name, bad in _breaches(label).items()])


def _rules(label: str | None) -> dict[str, Column]:
    rules = _breaches(label or "tenure")
    if label is None:
        rules.pop("null_label")
    return rules


def require_sound(df: DataFrame, label: str | None = "churn") -> DataFrame:
    """Abort on a breach: one aggregate pass that counts them all, then the unchanged frame."""
    rules = _rules(label)
    found = df.agg(*[F.count_if(bad).alias(name) for name, bad in rules.items()]).first().asDict()
    failed = {name: n for name, n in found.items() if n}
    if failed:
        raise ValueError(f"unsound customers: {failed}")
    return df


def enforce_sound(df: DataFrame, label: str | None = "churn") -> DataFrame:
    """The same rules inside the plan: the job that first reads a breach fails; no pass of its own."""
    checked = F.col("tenure")
    for name, bad in _rules(label).items():
        error = F.raise_error(F.lit(f"unsound customers: {name}")).cast(df.schema["tenure"].dataType)
        checked = F.when(bad, error).otherwise(checked)
    return df.withColumn("tenure", checked)


def require_columns(df: DataFrame, columns: Sequence[str] = CUSTOMER_COLUMNS) -> DataFrame:
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df


def feature_count_check(customers: DataFrame, features: DataFrame) -> DataFrame:
    """Two one-row aggregates side by side, as scalar subqueries."""
    labelled = customers.filter(F.col("churn").isNotNull()).agg(F.count("*")).scalar()
    return features.agg(F.count("*").alias("feature_rows")).select(
        labelled.alias("labelled_customers"),
        "feature_rows",
        (labelled == F.col("feature_rows")).alias("counts_match"),
    )


def feature_churn_rate(features: DataFrame) -> DataFrame:
    return features.agg(mean("churn_encoded", 2, 100).alias("churn_rate_pct_in_features"))


def feature_spot_check(features: DataFrame) -> DataFrame:
    return features.agg(
        mean("tenure", 1).alias("avg_tenure"),
        mean("monthly_charges", 2).alias("avg_monthly_charges"),
        mean("avg_monthly_bill", 2).alias("avg_computed_bill"),
        mean("charge_to_tenure_ratio", 4).alias("avg_ctr"),
        mean("total_services_count", 2).alias("avg_services"),
        F.sum("is_month_to_month").alias("month_to_month_count"),
        F.sum("contract_two_year").alias("two_year_count"),
    )
