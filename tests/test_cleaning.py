from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from stayline.operators import cleaning, quality
from stayline.schemas import CUSTOMER_COLUMNS, stored_name


def by_id(df):
    return {row["customer_id"]: row for row in df.collect()}


def test_names():
    assert stored_name(" customerID ") == "customer_id"
    assert stored_name("StreamingTV") == "streaming_tv"
    assert stored_name("Monthly Charges") == "monthly_charges"
    assert stored_name("Something Else") == "something_else"


def test_delivered_names_become_stored_names(spark):
    camel = ["".join(w.title() for w in c.split("_")) for c in CUSTOMER_COLUMNS]
    frame = spark.range(1).select(*[F.lit(1).alias(c) for c in camel])
    assert cleaning.standardise_names(frame).columns == CUSTOMER_COLUMNS


def test_raw_customers(raw):
    rows = by_id(cleaning.clean(raw))
    assert {k: r["churn"] for k, r in rows.items()} == {"C001": 1, "C002": 0, "C003": 0, "C004": 1}
    assert rows["C004"]["total_charges"] == Decimal("45.20")
    assert rows["C003"]["total_charges"] == Decimal("6930.00")
    assert all(r["tenure"] >= 0 for r in rows.values())


@pytest.mark.parametrize(
    "text, number",
    [("", None), ("  ", None), (" 12.5 ", "12.50"), ("n/a", None), ("7", "7.00"), (None, None)],
)
def test_coercion_never_aborts(spark, text, number):
    value = spark.createDataFrame([(text,)], "t string").select(cleaning.to_number(F.col("t"))).first()[0]
    assert value == (number and Decimal(number))


def test_first_month_overwrites_and_missing_totals_drop(raw):
    changed = raw.withColumn(
        "total_charges",
        F.when(F.col("customer_id") == "C004", "999").when(F.col("customer_id") == "C002", " "),
    )
    rows = by_id(cleaning.clean(changed))
    assert set(rows) == {"C004"}
    assert rows["C004"]["total_charges"] == Decimal("45.20")


def test_text_is_stripped_before_the_label_is_read(raw):
    padded = raw.withColumn("churn", F.concat(F.lit("\t "), "churn", F.lit(" \n")))
    assert by_id(cleaning.clean(padded))["C001"]["churn"] == 1


def test_unlabelled_input(raw):
    with pytest.raises(ValueError, match="null_label"):
        cleaning.clean(raw.withColumn("churn", F.lit("maybe")))
    with pytest.raises(ValueError, match="churn"):
        cleaning.clean(raw.drop("churn"))
    assert cleaning.clean(raw.drop("churn"), require_label=False).count() == 4


def test_unsound_rows_abort(raw):
    with pytest.raises(ValueError, match="bad_tenure"):
        cleaning.clean(raw.withColumn("tenure", F.lit(-1)))
    with pytest.raises(ValueError, match="bad_charge"):
        cleaning.clean(raw.withColumn("monthly_charges", F.lit(0).cast("decimal(8,2)")))


def test_statistics_agree_with_observation(raw):
    summary = cleaning.clean_summary(raw).first()
    cleaned, before, after = cleaning.observed_clean(raw)
    assert cleaned.count() == 4
    assert (summary["rows_in"], summary["imputed"], summary["dropped"]) == (4, 1, 0)
    assert summary["churn_rate_pct"] == 50.0
    assert before.get == {"rows_in": 4, "imputed": 1}
    assert after.get == {"rows_out": 4, "churn_rate": 0.5}


def test_zero_total_is_unknown_only_in_the_first_month(spark):
    rows = spark.createDataFrame(
        [("a", 0, 0), ("b", 3, 0), ("c", 0, 5), ("d", None, 0)],
        "customer_id string, tenure int, total_charges int",
    )
    fixed = by_id(cleaning.fix_zero_totals(rows))
    assert [fixed[k]["total_charges"] for k in "abcd"] == [None, 0, 5, 0]


def test_preview_and_label_counts(raw):
    cleaned = cleaning.clean(raw)
    assert cleaning.preview(cleaned, 2).count() == 2
    assert {r["churn"]: r["count"] for r in cleaning.label_counts(cleaned).collect()} == {0: 2, 1: 2}


def test_quality_of_a_dirty_table(spark):
    rows = spark.createDataFrame(
        [("a", 1), ("a", 2), ("a", 3), ("b", None), (None, 4)], "customer_id string, tenure int"
    )
    parents = spark.createDataFrame([("a",)], "customer_id string")
    assert quality.duplicate_keys(rows, ["customer_id"]).collect() == [("a", 3)]
    summary = quality.key_summary({"t": (rows, ["customer_id"])}).first()
    assert tuple(summary) == ("t", 5, 3, 1, 2)
    assert quality.orphans(rows, parents).collect() == [("b", 1)]
    assert tuple(quality.null_counts(rows, ["customer_id", "tenure"]).first()) == (5, 1, 1)
    with pytest.raises(ValueError, match="contract"):
        quality.require_columns(rows, ["tenure", "contract"])


def test_quality_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "customer_id string, tenure int")
    assert tuple(quality.key_summary({"t": (empty, ["customer_id"])}).first()) == ("t", 0, 0, 0, 0)
    assert quality.row_count(empty).first()[0] == 0


def test_label_shares(sample):
    shares = {r["churn"]: (r["count"], r["pct"]) for r in quality.label_distribution(sample).collect()}
    assert shares == {"Yes": (5, 50.0), "No": (5, 50.0)}
