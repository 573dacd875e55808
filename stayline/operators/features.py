"""Feature table (stored form) and model matrix (numeric form).

Both are narrow projections with a fixed vocabulary of categories, so a batch that lacks a level
still has every column and nothing is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayline.functions.numeric import fixed
from stayline.functions.rules import tenure_group
from stayline.operators.quality import require_columns
from stayline.schemas import ADD_ONS, BALANCE, CUSTOMER_COLUMNS, MODEL_FEATURES, MONEY, RATIO

# Which value of which column sets each flag.
BINARY = {
    "gender_encoded": ("gender", "Male"),
    "partner_encoded": ("partner", "Yes"),
    "dependents_encoded": ("dependents", "Yes"),
    "phone_service_encoded": ("phone_service", "Yes"),
    "paperless_billing_encoded": ("paperless_billing", "Yes"),
}
CONTRACT = {
    "contract_month_to_month": ("contract", "Month-to-month"),
    "contract_one_year": ("contract", "One year"),
    "contract_two_year": ("contract", "Two year"),
}
INTERNET = {
    "internet_dsl": ("internet_service", "DSL"),
    "internet_fiber": ("internet_service", "Fiber optic"),
    "internet_none": ("internet_service", "No"),
}
PAYMENT = {
    "payment_bank_transfer": "%bank transfer%",
    "payment_credit_card": "%credit card%",
    "payment_electronic_check": "%electronic check%",
    "payment_mailed_check": "%mailed check%",
}


def flag(condition: str) -> Column:
    """1 where the condition holds, 0 where it does not or is unknown."""
    return F.expr(f"if({condition}, 1, 0)")


def _equals(rules: dict[str, tuple[str, str]]) -> dict[str, Column]:
    return {name: flag(f"{column} = '{value}'") for name, (column, value) in rules.items()}


def binary_flags(df: DataFrame) -> DataFrame:
    return df.withColumns(_equals(BINARY))


def contract_onehot(df: DataFrame) -> DataFrame:
    return df.withColumns(_equals(CONTRACT))


def internet_onehot(df: DataFrame) -> DataFrame:
    return df.withColumns(_equals(INTERNET))


def payment_onehot(df: DataFrame) -> DataFrame:
    """By substring in any case: both spellings of the automatic methods match."""
    return df.withColumns(
        {name: flag(f"payment_method ILIKE '{like}'") for name, like in PAYMENT.items()}
    )


def add_tenure_group(df: DataFrame) -> DataFrame:
    return df.withColumn("tenure_group", tenure_group(F.col("tenure")))


def average_bill(digits: int = 2) -> Column:
    """Total over months where both are known, the monthly charge otherwise."""
    tenure, total = F.col("tenure"), F.col("total_charges")
    return F.when(
        (tenure > 0) & total.isNotNull(),
        fixed(F.try_divide(total.cast("double"), tenure.cast("double")), digits),
    ).otherwise(F.col("monthly_charges").cast("double"))


def charge_ratio(digits: int = 4) -> Column:
    return fixed(
        F.try_divide(F.col("monthly_charges").cast("double"), (F.col("tenure") + 1).cast("double")),
        digits,
    )


def service_count() -> Column:
    return F.expr(" + ".join(f"if({name} = 'Yes', 1, 0)" for name in ADD_ONS))


def add_computed(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "avg_monthly_bill": average_bill(),
            "charge_to_tenure_ratio": charge_ratio(),
            "is_month_to_month": flag("contract = 'Month-to-month'"),
            "total_services_count": service_count(),
        }
    )


def encode(df: DataFrame) -> DataFrame:
    return (
        df.transform(binary_flags)
        .transform(contract_onehot)
        .transform(internet_onehot)
        .transform(payment_onehot)
    )


def feature_table(customers: DataFrame) -> DataFrame:
    """Stored features of the labelled customers; an unknown total becomes the monthly charge."""
    built = (
        customers.filter(F.col("churn").isNotNull())
        .transform(encode)
        .transform(add_tenure_group)
        .transform(add_computed)
    )
    return built.select(
        "customer_id",
        *BINARY,
        *CONTRACT,
        *INTERNET,
        *PAYMENT,
        "tenure_group",
        F.col("avg_monthly_bill").cast(MONEY).alias("avg_monthly_bill"),
        F.col("charge_to_tenure_ratio").cast(RATIO).alias("charge_to_tenure_ratio"),
        "is_month_to_month",
        "total_services_count",
        "tenure",
        "monthly_charges",
        F.coalesce("total_charges", F.col("monthly_charges").cast(BALANCE)).alias("total_charges"),
        "senior_citizen",
        flag("churn = 'Yes'").alias("churn_encoded"),
    )


def model_matrix(cleaned: DataFrame) -> DataFrame:
    """Key, the ordered model features as doubles without nulls, and the label of a cleaned frame."""
    require_columns(cleaned, [c for c in CUSTOMER_COLUMNS if c != "multiple_lines"])
    built = cleaned.transform(add_computed).transform(encode)
    require_columns(built, MODEL_FEATURES)
    return built.select(
        "customer_id",
        *[F.expr(f"coalesce(double({c}), 0.0D) AS {c}") for c in MODEL_FEATURES],
        F.expr("int(churn) AS label"),
    )
