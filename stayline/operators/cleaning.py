"""Cleaning of raw customers; every step is a narrow projection or filter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stayline.functions.numeric import count_if, mean
from stayline.operators.quality import require_sound
from stayline.schemas import BALANCE, stored_name


def standardise_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[stored_name(name) for name in df.columns])


def to_number(text: Column, kind: T.DataType = BALANCE) -> Column:
    """Blank, padded or malformed text never aborts: what is not a number is null."""
    return text.try_cast(kind)


def coerce_totals(df: DataFrame) -> DataFrame:
    return df.withColumn("total_charges", to_number(F.col("total_charges")))


def impute_new_customers(df: DataFrame) -> DataFrame:
    """In the first month the total is the monthly charge, even where a total was delivered."""
    return df.withColumn(
        "total_charges",
        F.when(F.col("tenure") == 0, F.col("monthly_charges").cast(BALANCE)).otherwise(
            F.col("total_charges")
        ),
    )


def drop_missing_totals(df: DataFrame) -> DataFrame:
    return df.dropna(subset=["total_charges"])


def stripped(text: Column) -> Column:
    return F.trim(text, F.lit(" \t\r\n\f\x0b"))


def strip_text(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {f.name: stripped(F.col(f.name)) for f in df.schema if isinstance(f.dataType, T.StringType)}
    )


def label_code(label: Column) -> Column:
    return F.when(label == "Yes", 1).when(label == "No", 0)


def encode_label(df: DataFrame) -> DataFrame:
    return df.withColumn("churn", label_code(F.col("churn")))


def clean(df: DataFrame, require_label: bool = True, check: bool = True) -> DataFrame:
    """Coerce, impute, drop, strip, encode, then check. Scoring input may be unlabelled."""
    frame = standardise_names(df)
    if "churn" not in frame.columns:
        if require_label:
            raise ValueError("missing columns: ['churn']")
        frame = frame.withColumn("churn", F.lit(None).cast("string"))
    cleaned = (
        frame.transform(coerce_totals)
        .transform(impute_new_customers)
        .transform(drop_missing_totals)
        .transform(strip_text)
        .transform(encode_label)
    )
    return require_sound(cleaned, "churn" if require_label else None) if check else cleaned


def observed_clean(df: DataFrame) -> tuple[DataFrame, Observation, Observation]:
    """The cleaned frame with its row counts observed on the way: no second job."""
    before, after = Observation("before"), Observation("after")
    watched = standardise_names(df).observe(
        before,
        F.count("*").alias("rows_in"),
        F.count_if(F.col("tenure") == 0).alias("imputed"),
    )
    cleaned = clean(watched, require_label=False, check=False).observe(
        after, F.count("*").alias("rows_out"), F.avg("churn").alias("churn_rate")
    )
    return cleaned, before, after


def clean_summary(df: DataFrame) -> DataFrame:
    """The same statistics as a table, in one pass over the raw rows."""
    ready = standardise_names(df).transform(coerce_totals).transform(impute_new_customers)
    label = label_code(stripped(F.col("churn")))
    kept = F.col("total_charges").isNotNull()
    return ready.agg(
        F.count("*").alias("rows_in"),
        count_if(F.col("tenure") == 0).alias("imputed"),
        count_if(~kept).alias("dropped"),
        count_if(kept).alias("rows_out"),
        mean(F.when(kept, label), 2, 100).alias("churn_rate_pct"),
    )


def label_counts(cleaned: DataFrame) -> DataFrame:
    return cleaned.groupBy("churn").agg(F.count("*").alias("count"))


def preview(cleaned: DataFrame, rows: int = 5, key: str = "customer_id") -> DataFrame:
    """The first rows by key, the same ones every time."""
    return cleaned.orderBy(key).limit(rows)


def fix_zero_totals(df: DataFrame) -> DataFrame:
    """A zero total in the first month stands for an unknown one."""
    total = F.col("total_charges")
    unknown = (total == 0) & (F.col("tenure") == 0)
    return df.withColumn("total_charges", F.when(unknown, None).otherwise(total))
