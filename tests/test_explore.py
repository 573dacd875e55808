from decimal import Decimal

from pyspark.sql import functions as F

from stayline.operators import explore


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_sample_customers(sample):
    assert rows(explore.overview(sample)) == [(10, 5, 5, 50.0)]
    assert rows(explore.by_contract(sample)) == [
        ("Month-to-month", 6, 5, 83.33, 73.62),
        ("One year", 2, 0, 0.0, 72.05),
        ("Two year", 2, 0, 0.0, 82.7),
    ]
    assert [r[:4] for r in rows(explore.by_tenure(sample))] == [
        ("0-6 months (New)", 4, 4, 100.0),
        ("7-24 months (Growing)", 3, 1, 33.33),
        ("25-48 months (Established)", 2, 0, 0.0),
        ("49+ months (Loyal)", 1, 0, 0.0),
    ]
    assert rows(explore.danger_zone(sample)) == [(4, 4, 100.0)]
    assert rows(explore.revenue_at_risk(sample)) == [(Decimal("751.20"), Decimal("385.80"), 51.36)]


def test_bill_buckets_are_ordered_by_bill(sample):
    assert [r[0] for r in rows(explore.by_bill(sample))] == [
        "₹35-65 (Mid)",
        "₹65-85 (Premium)",
        "₹85+ (High-end)",
    ]


def test_missing_label_counts_only_as_a_customer(sample):
    blank = sample.withColumn("churn", F.lit(None).cast("string"))
    assert rows(explore.overview(blank)) == [(10, 0, 0, 0.0)]


def test_empty_input_has_no_rate(sample):
    assert rows(explore.overview(sample.limit(0))) == [(0, None, None, None)]
    assert rows(explore.revenue_at_risk(sample.limit(0))) == [(None, None, None)]
    assert rows(explore.by_contract(sample.limit(0))) == []


def test_missing_flag_is_a_group_of_its_own(sample):
    flags = sample.withColumn(
        "senior_citizen", F.when(F.col("customer_id") != "CUST-0001", F.col("senior_citizen"))
    )
    assert sorted(r[:2] for r in rows(explore.by_senior(flags))) == [
        ("Non-senior", 1),
        ("Non-senior", 7),
        ("Senior", 2),
    ]
