from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from stayline.functions.rules import bill_bucket, tenure_band, tenure_bucket, tenure_group
from stayline.operators import features, quality
from stayline.operators.cleaning import clean
from stayline.schemas import CHURN_FEATURES, MODEL_FEATURES


def column(df, name):
    return [row[name] for row in df.orderBy("customer_id").collect()]


def test_raw_customers(raw):
    built = clean(raw).transform(features.add_tenure_group).transform(features.add_computed)
    assert column(built, "tenure_group") == ["new", "mid", "loyal", "new"]
    assert column(built, "avg_monthly_bill") == [85.70, 55.00, 115.50, 45.20]
    assert column(built, "charge_to_tenure_ratio") == [42.85, 2.2, 1.8934, 45.2]
    assert column(built, "total_services_count") == [0, 2, 6, 0]
    assert column(built, "is_month_to_month") == [1, 0, 0, 1]


def test_average_bill(spark):
    rows = spark.createDataFrame(
        [("a", 12, 55.0, 660.0), ("b", 0, 55.0, 10.0), ("c", 5, 60.0, None), ("d", 8, 1.0, 0.04)],
        "customer_id string, tenure int, monthly_charges double, total_charges double",
    )
    built = rows.withColumn("bill", features.average_bill())
    assert column(built, "bill") == [55.0, 55.0, 60.0, 0.01]  # 0.005 rounds up


@pytest.mark.parametrize(
    "rule, edges",
    [
        (tenure_group, {0: "new", 6: "new", 7: "mid", 24: "mid", 25: "established",
                        48: "established", 49: "loyal", None: "loyal"}),
        (tenure_bucket, {0: "0-6 months (New)", 6: "0-6 months (New)", 7: "7-24 months (Growing)",
                         24: "7-24 months (Growing)", 25: "25-48 months (Established)",
                         48: "25-48 months (Established)", 49: "49+ months (Loyal)",
                         None: "49+ months (Loyal)"}),
        (tenure_band, {5: "New (< 6 mo)", 6: "Mid (6-24 mo)", 23: "Mid (6-24 mo)",
                       24: "Loyal (24+ mo)", None: "Loyal (24+ mo)"}),
        (bill_bucket, {34: "< ₹35 (Budget)", 35: "₹35-65 (Mid)", 65: "₹65-85 (Premium)",
                       85: "₹85+ (High-end)", None: "₹85+ (High-end)"}),
    ],
)
def test_band_edges(spark, rule, edges):
    rows = spark.createDataFrame([(v,) for v in edges], "v int").select("v", rule(F.col("v")).alias("b"))
    assert {r["v"]: r["b"] for r in rows.collect()} == edges


def test_feature_table(sample):
    table = features.feature_table(sample)
    assert table.columns == [f.name for f in CHURN_FEATURES if f.name != "created_at"]
    types = {f.name: f.dataType for f in CHURN_FEATURES}
    assert all(f.dataType == types[f.name] for f in table.schema)
    for group in (features.CONTRACT, features.INTERNET, features.PAYMENT):
        assert {sum(row[c] for c in group) for row in table.collect()} == {1}
    row = table.filter("customer_id = 'CUST-0006'").first()
    assert (row["tenure_group"], row["payment_bank_transfer"]) == ("established", 1)
    assert row["avg_monthly_bill"] == Decimal("55.00")


def test_unlabelled_rows_leave_the_feature_table_and_missing_totals_are_imputed(sample):
    changed = sample.withColumn(
        "churn", F.when(F.col("customer_id") != "CUST-0001", F.col("churn"))
    ).withColumn("total_charges", F.lit(None).cast("decimal(10,2)"))
    table = features.feature_table(changed)
    assert table.count() == 9
    assert table.filter("total_charges <> monthly_charges").count() == 0
    check = quality.feature_count_check(changed, table).first()
    assert tuple(check) == (9, 9, True)


def test_null_categories_set_no_flag(sample):
    blank = sample.select(
        *[F.lit(None).cast("string").alias(f.name) if f.name in
          ("gender", "internet_service", "payment_method", "online_security") else f.name
          for f in sample.schema]
    )
    row = features.feature_table(blank).first()
    names = ["gender_encoded", *features.INTERNET, *features.PAYMENT]
    assert [row[n] for n in names] == [0] * len(names)


def test_matrix_has_every_column_whatever_the_batch(raw):
    one = clean(raw).filter("customer_id = 'C003'")
    matrix = features.model_matrix(one)
    assert matrix.columns == ["customer_id", *MODEL_FEATURES, "label"]
    assert len(MODEL_FEATURES) == 20
    assert "internet_fiber" in MODEL_FEATURES
    row = matrix.first()
    assert (row["internet_fiber"], row["payment_bank_transfer"], row["label"]) == (1.0, 0.0, 0)


def test_a_missing_input_column_is_an_error(raw):
    with pytest.raises(ValueError, match="contract"):
        features.model_matrix(clean(raw).drop("contract"))


def test_matrix_has_no_nulls(raw):
    nulled = clean(raw).withColumn("senior_citizen", F.lit(None).cast("int"))
    assert {r["senior_citizen"] for r in features.model_matrix(nulled).collect()} == {0.0}


def test_features_need_no_shuffle(sample):
    plan = features.feature_table(sample)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
