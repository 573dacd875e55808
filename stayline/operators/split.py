"""Exact stratified split by key hash."""

from __future__ import annotations

from collections.abc import Mapping
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

TEST = {"is_test": 0.20}
HASH_DIGITS = 32
STEP = 3


def key_hash(key: str, seed: int) -> Column:
    """A null key has no place in the order: it is an error."""
    text = F.coalesce(F.col(key).cast("string"), F.raise_error(F.lit(f"null in {key}")).cast("string"))
    return F.md5(F.concat_ws("|", text, F.lit(str(seed))))


def _first_crossing(counted: DataFrame, upto: Column, by: list[str]) -> DataFrame:
    """Per label and part, the first prefix that takes the running count beyond the goal."""
    return (
        counted.withColumn("upto", upto)
        .filter("upto > goal")
        .groupBy(*by)
        .agg(
            F.min(
                F.struct("prefix", (F.col("upto") - F.col("n")).alias("before"), "goal", "n", "alone")
            ).alias("edge")
        )
        .select(*by, "edge.*")
    )


def split_cuts(
    df: DataFrame,
    parts: Mapping[str, float] = TEST,
    label: str = "label",
    key: str = "customer_id",
    seed: int = 42,
    step: int = STEP,
) -> dict[object, list[str]]:
    """Per label value, the first hash that is beyond each part.

    Found by counting, not by ranking rows: first by the leading ``step`` hex digits, then, only
    among the rows that share the prefix in which a cut falls, by ``step`` further digits at a time. A
    prefix that is one single hash, however many rows have it, needs no further look. The driver
    holds one line per label value and part.
    """
    hashed = df.select(F.col(label).alias("label"), key_hash(key, seed).alias("hash")).filter(
        F.col("label").isNotNull()
    )

    def count_by(rows: DataFrame, digits: int) -> DataFrame:
        return rows.groupBy("label", F.substring("hash", 1, digits).alias("prefix")).agg(
            F.count("*").alias("n"), (F.min("hash") == F.max("hash")).alias("alone")
        )

    of_label = Window.partitionBy("label")
    goals = F.array(
        *[
            F.struct(
                F.lit(part).alias("part"),
                F.floor(F.sum("n").over(of_label) * share + 1e-9).alias("goal"),
            )
            for part, share in enumerate(accumulate(parts.values()))
        ]
    )
    running = F.sum("n").over(of_label.orderBy("prefix"))
    counted = count_by(hashed, step).withColumns({"upto": running, "goals": goals})
    edges = (
        _first_crossing(counted.select("*", F.inline("goals")), F.col("upto"), ["label", "part"])
        .collect()
    )

    done: list[Row] = []
    digits = step
    while edges:
        done += [edge for edge in edges if edge["alone"]]
        edges = [edge for edge in edges if not edge["alone"]]
        if not edges:
            break
        longer = min(HASH_DIGITS, digits + step)
        opened = df.sparkSession.createDataFrame(
            [tuple(edge[c] for c in ("label", "part", "prefix", "before", "goal")) for edge in edges],
            T.StructType(
                [
                    T.StructField("of", df.schema[label].dataType),
                    T.StructField("part", T.IntegerType()),
                    T.StructField("within", T.StringType()),
                    T.StructField("before", T.LongType()),
                    T.StructField("goal", T.LongType()),
                ]
            ),
        )
        inside = hashed.filter(
            F.substring("hash", 1, digits).isin(sorted({edge["prefix"] for edge in edges}))
        )
        narrowed = count_by(inside, longer).join(
            F.broadcast(opened),  # one row per label and part
            (F.col("label") == F.col("of")) & (F.substring("prefix", 1, digits) == F.col("within")),
        )
        so_far = F.sum("n").over(Window.partitionBy("label", "part").orderBy("prefix"))
        edges = _first_crossing(narrowed, F.col("before") + so_far, ["label", "part"]).collect()
        digits = longer

    cuts: dict[object, list[str]] = {}
    for edge in done:
        # A prefix sorts before every hash that starts with it; "g" sorts after all of them.
        cuts.setdefault(edge["label"], ["g"] * len(parts))[edge["part"]] = edge["prefix"]
    return cuts


def stratified_split(
    df: DataFrame,
    parts: Mapping[str, float] = TEST,
    label: str = "label",
    key: str = "customer_id",
    seed: int = 42,
    **options: int,
) -> DataFrame:
    """Add one flag per part: its share of each label's rows, in order of the key's hash.

    Equal to ranking every row by hash within its label. The cuts are found once; marking the rows
    is a narrow projection, so a frame that is read many times, as in training, is not split again.
    Copies of a key stay on one side and are counted, not moved.
    """
    cuts = split_cuts(df, parts, label, key, seed, **options)
    hashed, of = key_hash(key, seed), F.col(label)
    if not cuts:
        return df.withColumns({flag: F.lit(False) for flag in parts})
    # One map from label to its cuts: the expression is as flat for a thousand labels as for two.
    pairs = [c for value, ends in cuts.items() for c in (F.lit(value), F.array(*map(F.lit, ends)))]
    ends = F.try_element_at(F.create_map(*pairs), of.cast(df.schema[label].dataType))
    flags: dict[str, Column] = {}
    for at, flag in enumerate(parts):
        inside = hashed < F.get(ends, F.lit(at))
        if at:
            inside = inside & (hashed >= F.get(ends, F.lit(at - 1)))
        flags[flag] = F.coalesce(inside, F.lit(False))
    return df.withColumns(flags)
