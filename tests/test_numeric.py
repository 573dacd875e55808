from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from stayline.functions.numeric import count_if, fixed, mean, percent


def half_up(part, whole, digits):
    exact = Decimal(part) * 100 / Decimal(whole)
    return float(exact.quantize(Decimal(1).scaleb(-digits), ROUND_HALF_UP))


@pytest.mark.parametrize("digits", [0, 1, 2])
def test_percent_is_exact_for_every_small_fraction(spark, digits):
    """Among them every tie: 1/8 is 12.5, 1/16 is 6.25, 1/160 is 0.625."""
    pairs = spark.range(200).selectExpr("id AS part").crossJoin(spark.range(1, 201).selectExpr("id AS whole"))
    rows = pairs.select("part", "whole", percent(F.col("part"), F.col("whole"), digits).alias("p"))
    wrong = [r for r in rows.collect() if r["p"] != half_up(r["part"], r["whole"], digits)]
    assert wrong == []


def test_a_value_just_below_a_tie_rounds_down(spark):
    row = spark.sql("SELECT 0.12499999D AS a, 83.335D AS b, -0.125D AS c, double(NULL) AS d")
    found = row.select(*[fixed(F.col(c), 2).alias(c) for c in "abcd"]).first()
    assert tuple(found) == (0.12, 83.34, -0.13, None)


def test_nothing_to_divide_by(spark):
    none = spark.createDataFrame([], "x int")
    row = none.agg(mean("x", 2), percent(F.sum("x"), F.count("x")), count_if(F.col("x") > 0)).first()
    assert tuple(row) == (None, None, None)
    zero = spark.createDataFrame([(0,)], "x int")
    assert zero.agg(percent(F.sum("x"), F.sum("x"))).first()[0] is None
