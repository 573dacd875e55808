"""Declared schemas of the three tables and the naming rule between raw and stored columns."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(8, 2)
BALANCE = T.DecimalType(10, 2)
RATIO = T.DecimalType(8, 4)
PROBABILITY = T.DecimalType(5, 4)

_string, _int = T.StringType(), T.IntegerType()

# The six add-on services that count as "Yes" services.
ADD_ONS = [
    "online_security",
    "online_backup",
    "device_protection",
    "tech_support",
    "streaming_tv",
    "streaming_movies",
]

# The 21 business columns in file order.
CUSTOMER_FIELDS = [
    T.StructField("customer_id", _string, False),
    T.StructField("gender", _string),
    T.StructField("senior_citizen", _int),
    T.StructField("partner", _string),
    T.StructField("dependents", _string),
    T.StructField("tenure", _int, False),
    T.StructField("phone_service", _string),
    T.StructField("multiple_lines", _string),
    T.StructField("internet_service", _string),
    *[T.StructField(name, _string) for name in ADD_ONS],
    T.StructField("contract", _string, False),
    T.StructField("paperless_billing", _string),
    T.StructField("payment_method", _string),
    T.StructField("monthly_charges", MONEY, False),
    T.StructField("total_charges", BALANCE),
    T.StructField("churn", _string),
]
CUSTOMER_COLUMNS = [field.name for field in CUSTOMER_FIELDS]

CUSTOMERS = T.StructType(
    CUSTOMER_FIELDS
    + [
        T.StructField("created_at", T.TimestampType()),
        T.StructField("updated_at", T.TimestampType()),
    ]
)

# As delivered: the total may hold blanks, so it stays text until it is coerced.
RAW_CUSTOMERS = T.StructType(
    [
        T.StructField(f.name, _string if f.name == "total_charges" else f.dataType)
        for f in CUSTOMER_FIELDS
    ]
)

BINARY_FEATURES = [
    "gender_encoded",
    "partner_encoded",
    "dependents_encoded",
    "phone_service_encoded",
    "paperless_billing_encoded",
]
CONTRACT_FEATURES = ["contract_month_to_month", "contract_one_year", "contract_two_year"]
INTERNET_FEATURES = ["internet_dsl", "internet_fiber", "internet_none"]
PAYMENT_FEATURES = [
    "payment_bank_transfer",
    "payment_credit_card",
    "payment_electronic_check",
    "payment_mailed_check",
]

CHURN_FEATURES = T.StructType(
    [T.StructField("customer_id", _string, False)]
    + [
        T.StructField(name, _int)
        for name in BINARY_FEATURES + CONTRACT_FEATURES + INTERNET_FEATURES + PAYMENT_FEATURES
    ]
    + [
        T.StructField("tenure_group", _string),
        T.StructField("avg_monthly_bill", MONEY),
        T.StructField("charge_to_tenure_ratio", RATIO),
        T.StructField("is_month_to_month", _int),
        T.StructField("total_services_count", _int),
        T.StructField("tenure", _int),
        T.StructField("monthly_charges", MONEY),
        T.StructField("total_charges", BALANCE),
        T.StructField("senior_citizen", _int),
        T.StructField("churn_encoded", _int),
        T.StructField("created_at", T.TimestampType()),
    ]
)

CHURN_PREDICTIONS = T.StructType(
    [
        T.StructField("customer_id", _string, False),
        T.StructField("run_date", T.DateType(), False),
        T.StructField("model_version", _string, False),
        T.StructField("churn_probability", PROBABILITY, False),
        T.StructField("churn_prediction", _int, False),
        T.StructField("risk_tier", _string),
        T.StructField("top_reason_1", _string),
        T.StructField("top_reason_2", _string),
        T.StructField("top_reason_3", _string),
        T.StructField("shap_values_json", _string),
        T.StructField("recommended_action", _string),
        T.StructField("created_at", T.TimestampType()),
    ]
)
RUN_KEY = ["customer_id", "run_date", "model_version"]

# Columns that may not be null, per table.
REQUIRED = {
    "customers": ["customer_id", "tenure", "monthly_charges", "contract"],
    "churn_predictions": RUN_KEY + ["churn_probability", "churn_prediction"],
}

# Model input, in model order: one level of each one-hot group is left out.
MODEL_FEATURES = [
    "tenure",
    "monthly_charges",
    "total_charges",
    "senior_citizen",
    "avg_monthly_bill",
    "charge_to_tenure_ratio",
    "is_month_to_month",
    "total_services_count",
    *BINARY_FEATURES,
    "contract_month_to_month",
    "contract_one_year",
    "internet_dsl",
    "internet_fiber",
    "payment_electronic_check",
    "payment_mailed_check",
    "payment_bank_transfer",
]


def stored_name(raw: str) -> str:
    """``customerID``, ``Customer ID`` and ``customer_id`` all name the column ``customer_id``."""
    plain = raw.strip().lower().replace(" ", "_")
    squashed = plain.replace("_", "")
    return next((c for c in CUSTOMER_COLUMNS if c.replace("_", "") == squashed), plain)
