import hashlib

import pytest
from pyspark.sql import functions as F

from stayline.operators.split import stratified_split


def expected(rows, shares, seed=42):
    """By sorting all hashes: the part each key falls in, or None."""
    sides = {}
    for label in {l for _, l in rows}:
        keys = sorted(
            (hashlib.md5(f"{k}|{seed}".encode()).hexdigest(), k) for k, l in rows if l == label
        )
        total, done = 0.0, 0
        for part, share in shares.items():
            total += share
            goal = int(len(keys) * total + 1e-9)
            for at in range(done, goal):
                sides[keys[at][1]] = part
            done = max(done, goal)
    return {k: sides.get(k) for k, _ in rows}


@pytest.mark.parametrize("options", [{}, {"step": 1}])
@pytest.mark.parametrize("shares", [{"is_test": 0.2}, {"is_test": 0.2, "is_validation": 0.1}])
@pytest.mark.parametrize("n", [1, 7, 300])
def test_equal_to_ranking_every_row(spark, n, shares, options):
    rows = [(f"K{i}", int(i % 3 == 0)) for i in range(n)]
    frame = spark.createDataFrame(rows, "customer_id string, label int")
    found = {
        r["customer_id"]: next((p for p in shares if r[p]), None)
        for r in stratified_split(frame, shares, **options).collect()
    }
    assert found == expected(rows, shares)


def test_the_seed_changes_the_sides(spark):
    frame = spark.range(200).select(F.col("id").cast("string").alias("customer_id"), F.lit(1).alias("label"))
    sides = [
        {r[0] for r in stratified_split(frame, seed=s).filter("is_test").select("customer_id").collect()}
        for s in (1, 2)
    ]
    assert len(sides[0]) == len(sides[1]) == 40 and sides[0] != sides[1]


def test_copies_of_one_key_stay_together(spark):
    """One key with a third of all rows goes to one side, whole, and no row is lost."""
    rows = [("hot", 0)] * 150 + [(f"K{i}", 0) for i in range(300)]
    frame = spark.createDataFrame(rows, "customer_id string, label int")
    for seed in range(4):
        split = stratified_split(frame, seed=seed, step=1).cache()
        sides = {(r["customer_id"], r["is_test"]) for r in split.collect()}
        assert split.count() == 450
        assert len({side for key, side in sides if key == "hot"}) == 1
        # Whole keys in hash order, as long as they fit.
        ordered = sorted(sides, key=lambda k: hashlib.md5(f"{k[0]}|{seed}".encode()).hexdigest())
        count, expected = 0, {}
        for key, _ in ordered:
            count += 150 if key == "hot" else 1
            expected[key] = count <= 90
        assert dict(sides) == expected
        split.unpersist()


def test_unlabelled_rows_are_in_no_part(spark):
    frame = spark.createDataFrame([("a", None), ("b", 1)], "customer_id string, label int")
    assert [r["is_test"] for r in stratified_split(frame).collect()] == [False, False]


def test_a_thousand_labels(spark):
    rows = [(f"K{i}", i % 1000) for i in range(10_000)]
    frame = spark.createDataFrame(rows, "customer_id string, label int")
    split = stratified_split(frame, {"is_test": 0.2, "is_validation": 0.1})
    counts = split.groupBy("label").agg(F.count_if("is_test").alias("t"), F.count_if("is_validation").alias("v"))
    assert {(r["t"], r["v"]) for r in counts.collect()} == {(2, 1)} and counts.count() == 1000


def test_a_null_key_is_an_error(spark):
    frame = spark.createDataFrame([(None, 1), ("b", 1)], "customer_id string, label int")
    with pytest.raises(Exception, match="null in customer_id"):
        stratified_split(frame).collect()
