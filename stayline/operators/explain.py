"""Exact Shapley contributions of a boosted tree model, one array per row.

Every leaf is a product of conditions on the few features of its path. For each leaf and each set
of path features whose conditions a row meets, the contribution of every path feature is known in
advance; scoring a row means finding that set and adding up. Only the paths are broadcast, a few
numbers per leaf. The tables, 2**n x n numbers for a leaf of n path features, are made by the tasks
in chunks of leaves, and kept between batches as far as ``KEPT_BYTES`` reach.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.classification import GBTClassificationModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stayline.functions.reasons import SIGNAL, describe, name_of, rank_contributions
from stayline.functions.rules import DECISION_THRESHOLD
from stayline.schemas import MODEL_FEATURES
from stayline.session import delete_folder, folder_exists, shared_folder

# Workers need not have this package: its functions travel with the job.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

KEPT_BYTES = 256 << 20
CHUNK_BYTES = 32 << 20
ROWS_PER_BLOCK = 512


@dataclass
class LeafTables:
    """Plain arrays only, so that workers need nothing but NumPy to use them."""

    base: float
    cuts: list[np.ndarray]  # per feature: its thresholds, ascending
    # One group per number n of distinct path features and chunk of leaves:
    #   features [n, leaves]: feature index, low [n, leaves]: first bin inside the condition,
    #   width [n, leaves]: number of bins inside, value [leaves], share [leaves, n],
    #   users: per path position the (feature, leaves that test it there).
    groups: list[tuple]

    def contributions(self, rows: np.ndarray) -> np.ndarray:
        """[rows, features] contributions to the margin."""
        return _contributions(self.cuts, self.groups, rows, {})


def _bin_type(cuts: list[np.ndarray]) -> np.dtype:
    """Wide enough for the bins of a feature and for the number of them."""
    return np.min_scalar_type(max((len(c) for c in cuts), default=0) + 1)


def _contributions(cuts: list[np.ndarray], groups: list[tuple], rows: np.ndarray, kept: dict[int, np.ndarray]) -> np.ndarray:
    """``kept`` holds tables by group from one call to the next."""
    bins = np.empty((len(cuts), len(rows)), dtype=_bin_type(cuts))
    for f, thresholds in enumerate(cuts):
        # x <= thresholds[k] exactly when bin <= k; a NaN sorts last and so always goes right.
        bins[f] = np.searchsorted(thresholds, rows[:, f], side="left")
    total = np.zeros(bins.shape)
    for at_group, (features, low, width, value, share, users) in enumerate(groups):
        n, leaves = features.shape
        table = kept.get(at_group)
        if table is None:
            table = _shapley_table(value, share).reshape(n, -1)
            if sum(t.nbytes for t in kept.values()) + table.nbytes <= KEPT_BYTES:
                kept[at_group] = table
        total += _group_contributions(features, low, width, table, users, bins, total.shape)
    return total.T


def _group_contributions(features, low, width, table, users, bins: np.ndarray, shape: tuple[int, int]) -> np.ndarray:
    """[features, rows] what one group of leaves adds; a block of rows at a time."""
    n, leaves = features.shape
    total = np.zeros(shape)
    for start in range(0, shape[1], ROWS_PER_BLOCK):
        block = slice(start, start + ROWS_PER_BLOCK)
        own = bins[:, block]
        met = np.zeros((leaves, own.shape[1]), dtype=np.min_scalar_type(2**n - 1))
        for j in range(n):
            # Unsigned difference: one comparison tests both ends of the interval.
            inside = np.take(own, features[j], axis=0)
            inside -= low[j, :, None]
            met |= (inside < width[j, :, None]).astype(met.dtype) << met.dtype.type(j)
        at = met.astype(np.intp)  # what an index is turned into anyway
        at += (np.arange(leaves) << n)[:, None]
        for j, found in enumerate(users):
            for f, chosen in found:
                total[f, block] += np.take(table[j], np.take(at, chosen, axis=0), mode="clip").sum(axis=0)
    return total


def _shapley_table(value: np.ndarray, share: np.ndarray) -> np.ndarray:
    """[n, leaves, 2**n]: for each set of met conditions, what each path feature contributes."""
    leaves, n = share.shape
    met = (np.arange(2**n)[:, None] >> np.arange(n)) & 1
    weight = [factorial(k) * factorial(n - 1 - k) / factorial(n) for k in range(n)]
    table = np.empty((n, leaves, 2**n))
    for i in range(n):
        # Polynomial over coalition size; every other feature is either in (met) or out (share).
        poly = np.zeros((leaves, 2**n, n))
        poly[:, :, 0] = 1.0
        for j in range(n):
            if j != i:
                shifted = np.roll(poly, 1, axis=2)
                shifted[:, :, 0] = 0.0
                poly = share[:, j, None, None] * poly + met[None, :, j, None] * shifted
        table[i] = value[:, None] * (met[None, :, i] - share[:, i, None]) * (poly @ weight)
    return table


def leaf_paths(nodes: dict, scale: float) -> Iterator[tuple[float, dict]]:
    """Each leaf's value, with per path feature its interval and the share of rows that stay."""

    def walk(at: int, seen: dict) -> Iterator[tuple[float, dict]]:
        node = nodes[at]
        if node["leftChild"] < 0:
            yield node["prediction"] * scale, seen
            return
        feature = node["split"]["featureIndex"]
        cut = node["split"]["leftCategoriesOrThreshold"][0]
        low, high, share = seen.get(feature, (-np.inf, np.inf, 1.0))
        rows = node["impurityStats"][0]
        for child, bounds in (
            (node["leftChild"], (low, min(high, cut))),
            (node["rightChild"], (max(low, cut), high)),
        ):
            kept = share * nodes[child]["impurityStats"][0] / rows
            yield from walk(child, {**seen, feature: (*bounds, kept)})

    yield from walk(0, {})


_NODES = (
    "treeID int, nodeData struct<id:int, prediction:double, impurityStats:array<double>, leftChild:int, rightChild:int,"
    " split:struct<featureIndex:int, leftCategoriesOrThreshold:array<double>>>"
)


def saved_nodes(spark: SparkSession, model: GBTClassificationModel) -> dict[int, dict]:
    """Node rows by tree and node id; there are trees x nodes per tree of them.

    They are read where the model was loaded from; only a model that is not saved yet is saved for this.
    """
    folder = getattr(model, "saved_in", None)
    own = folder is None or not folder_exists(spark, folder)
    if own:
        folder = f"{shared_folder(spark)}/model-{uuid.uuid4().hex}"
    trees: dict[int, dict] = {}
    try:
        if own:
            model.write().save(folder)
        for row in spark.read.schema(_NODES).parquet(f"{folder}/data").toArrow().to_pylist():
            trees.setdefault(row["treeID"], {})[row["nodeData"]["id"]] = row["nodeData"]
    finally:
        if own:
            delete_folder(spark, folder)
    return trees


def leaf_tables(spark: SparkSession, model: GBTClassificationModel) -> LeafTables:
    weights = model.treeWeights
    leaves = [
        leaf
        for tree, nodes in sorted(saved_nodes(spark, model).items())
        for leaf in leaf_paths(nodes, weights[tree])
    ]
    return group_leaves(leaves, model.numFeatures)


def group_leaves(leaves: list[tuple[float, dict]], width: int) -> LeafTables:
    bounds: list[set[float]] = [set() for _ in range(width)]
    for _, path in leaves:
        for feature, (low, high, _) in path.items():
            bounds[feature] |= {b for b in (low, high) if np.isfinite(b)}
    cuts = [np.array(sorted(found)) for found in bounds]

    base, groups = 0.0, []
    bin_type = _bin_type(cuts)
    for chosen in _chunks(leaves):
        n = len(chosen[0][1])
        value = np.array([v for v, _ in chosen])
        share = np.array([[s for _, (_, _, s) in path] for _, path in chosen]).reshape(-1, n)
        base += float((value * share.prod(axis=1)).sum())
        if not n:
            continue
        features = np.array([[f for f, _ in path] for _, path in chosen]).T.copy()
        low = np.zeros((len(chosen), n), dtype=int)
        last = np.zeros((len(chosen), n), dtype=int)
        for r, (_, path) in enumerate(chosen):
            for j, (f, (a, b, _)) in enumerate(path):
                low[r, j] = 0 if a == -np.inf else np.searchsorted(cuts[f], a) + 1
                last[r, j] = len(cuts[f]) if b == np.inf else np.searchsorted(cuts[f], b)
        groups.append(
            (
                features,
                low.T.astype(bin_type, order="C"),
                (last - low + 1).T.astype(bin_type, order="C"),
                value,
                share,
                [[(int(f), np.flatnonzero(at == f)) for f in np.unique(at)] for at in features],
            )
        )
    return LeafTables(base, cuts, groups)


def _chunks(leaves: list[tuple[float, dict]]) -> Iterator[list[tuple[float, list]]]:
    """Leaves with equally many path features, as many together as a table of ``CHUNK_BYTES`` holds."""
    for n in sorted({len(path) for _, path in leaves}):
        chosen = [(v, sorted(path.items())) for v, path in leaves if len(path) == n]
        most = max(1, CHUNK_BYTES // (8 * max(1, n) * 2**n * max(1, n)))
        for at in range(0, len(chosen), most):
            yield chosen[at : at + most]


def shap_values(spark: SparkSession, tables: LeafTables) -> Column:
    """``array<double>`` of log-odds contributions in feature order.

    The margin F of a boosted model gives the probability 1 / (1 + exp(-2F)), so log-odds are 2F.
    Only the features cross to Python, in Arrow batches; all other columns stay in the JVM.
    """
    shared = spark.sparkContext.broadcast((tables.cuts, tables.groups))
    width = len(tables.cuts)

    def explain(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        cuts, groups = shared.value
        kept: dict[int, np.ndarray] = {}
        for batch in batches:
            rows = batch.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            out = 2.0 * _contributions(cuts, groups, rows, kept)
            offsets = np.arange(0, len(rows) * width + 1, width, dtype=np.int32)
            yield pa.ListArray.from_arrays(offsets, np.ascontiguousarray(out).ravel())

    explain.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    run = F.arrow_udf(explain, T.ArrayType(T.DoubleType()))
    return run(F.array(*[F.col(c) for c in MODEL_FEATURES]))


def base_value(tables: LeafTables) -> float:
    """Log-odds before any contribution."""
    return 2.0 * tables.base


def global_importance(explained: DataFrame, contributions: str = "contributions") -> DataFrame:
    """Mean magnitude per feature: one aggregate row, turned on its side."""
    wide = explained.agg(
        *[
            F.avg(F.abs(F.get(contributions, F.lit(i)))).alias(name)
            for i, name in enumerate(MODEL_FEATURES)
        ]
    )
    return wide.unpivot([], list(MODEL_FEATURES), "feature", "mean_abs_shap").orderBy(
        F.col("mean_abs_shap").desc(), "feature"
    )


def value_pairs(explained: DataFrame, contributions: str = "contributions") -> DataFrame:
    """(feature, value, contribution) per customer: what a beeswarm plots."""
    items = F.array(
        *[
            F.struct(
                F.lit(name).alias("feature"),
                F.col(name).alias("value"),
                F.get(contributions, F.lit(i)).alias("shap"),
            )
            for i, name in enumerate(MODEL_FEATURES)
        ]
    )
    return explained.select("customer_id", F.explode(items).alias("item")).select("customer_id", "item.*")


def explain_rows(explained: DataFrame, top: int = 8) -> DataFrame:
    """Per customer: probability, verdict and the strongest features, the first three in words.

    ``explained`` carries the model features, ``churn_probability`` and ``contributions``.
    """
    rows = (
        explained.withColumn("ranked", rank_contributions("contributions", top))
        .withColumn("reasons", F.array(*describe("ranked", MODEL_FEATURES, min(3, top), SIGNAL)))
        .select(
            "customer_id",
            F.round("churn_probability", 4).alias("churn_probability"),
            F.when(F.col("churn_probability") >= DECISION_THRESHOLD, "WILL CHURN")
            .otherwise("WILL STAY")
            .alias("verdict"),
            F.array(*MODEL_FEATURES).alias("values"),
            "reasons",
            F.posexplode("ranked").alias("rank", "item"),
        )
    )
    return rows.select(
        "customer_id",
        "churn_probability",
        "verdict",
        (F.col("rank") + 1).alias("rank"),
        F.expr(name_of(MODEL_FEATURES, "item.at")).alias("feature"),
        F.get("values", F.col("item.at")).alias("value"),
        F.col("item.value").alias("shap"),
        F.when(F.col("item.value") > 0, "toward churn").otherwise("away from churn").alias("direction"),
        F.get("reasons", F.col("rank")).alias("reason"),
    )
