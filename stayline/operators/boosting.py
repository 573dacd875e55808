"""Second-order boosting over one binned table.

Cut points are found once, from a quantile sketch per feature, and every row is stored as one byte per feature.
Features of few bins share a byte, as digits of one number (``Packing``), so a level has fewer columns to add up. A
tree is grown level by level: one job sums the gradients and hessians of the logistic loss per node,
byte and value, of the smaller of two sisters only; the other is what is left of their parent. The driver picks the splits
from these sums, whose number depends on depth, features and bins, not on rows. Sums are whole multiples of 2**-24, so a
tree does not depend on how the rows are dealt out.

Gain of a split with sums G and H, and the weight of a leaf, with T shrinking G by ``l1``::

    T(G_left)**2 / (H_left + l2) + T(G_right)**2 / (H_right + l2) - T(G)**2 / (H + l2)     -T(G) / (H + l2)

A split needs at least ``min_gain``, and a hessian of ``min_child`` on both sides. Rows are drawn per tree by a hash
of their key, columns per tree by the seed. Rows lie in blocks of arrays, with their margins. Once per tree the rows it draws are kept as bytes and
gradients alone: that is all its levels read. Margins are brought up to date and written to the shared folder every ``CHUNK`` trees, and the validation area after each of these trees is taken in one job, from unrounded scores.
"""

from __future__ import annotations

import json
import pickle
import sys
import time
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel, cloudpickle
from pyspark.ml.classification import GBTClassificationModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stayline.operators.evaluation import CELLS
from stayline.schemas import MODEL_FEATURES
from stayline.session import delete_folder, shared_folder

# Workers need not have this package: its functions travel with the job.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BINS = 256
SKETCH = 10_000  # accuracy of the quantile sketch: ranks are right to one part in so many
CHUNK = 10  # trees between two looks at the validation rows
UNIT = float(1 << 24)
LEAST_GAIN = 1e-6
ROWS_AT_ONCE = 1 << 16
TASK_ROWS = 1 << 18  # rows of one task at most; some 8 MB
LEAST_ROWS = 1 << 14  # fewer are not worth another task
BLOCK_ROWS = 1 << 14
READERS = 8  # tasks that add up the sums of more tasks than ``DIRECT``
DIRECT = 24  # tasks whose sums go to the driver as they are


@dataclass(frozen=True)
class Boosting:
    """Hyper-parameters of a boosted model; the defaults are those of the tuned one."""

    # The published settings of the tuned model.

    trees: int = 500
    depth: int = 5
    rate: float = 0.05
    rows: float = 0.8
    columns: float = 0.8
    min_child: float = 3.0
    min_gain: float = 0.1
    l1: float = 0.1
    l2: float = 1.0
    weighted: bool = True
    patience: int = 30


# The published settings of the default model.
DEFAULT = Boosting(trees=200, rate=0.1, min_child=1.0, min_gain=0.0, l1=0.0, weighted=False, patience=0)
TUNED = Boosting()


# --- bins ------------------------------------------------------------------------------------


def find_cuts(rows: DataFrame, columns: Sequence[str] = MODEL_FEATURES, bins: int = BINS) -> list[np.ndarray]:
    """Ascending cut points per feature, at most ``bins`` - 1, from one pass over the rows.

    A value belongs to the first bin whose cut it does not exceed; what exceeds all cuts, and NaN, to the last.
    A feature with fewer distinct values has a cut at each of them but the highest.
    """
    shares = [k / bins for k in range(1, bins)] + [1.0]
    found = rows.agg(*[F.percentile_approx(F.col(c).cast("double"), shares, SKETCH).alias(c) for c in columns]).first()
    return [np.unique(np.array(found[c] or [0.0]))[:-1] for c in columns]


def binned(rows: DataFrame, cuts: Sequence[np.ndarray], columns: Sequence[str] = MODEL_FEATURES, key: str = "customer_id") -> DataFrame:
    """The rows with ``bins``, a byte per feature, and ``unit``, a hash of the key by which rows are drawn."""
    width = len(columns)

    def assign(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            values = batch.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            out = np.empty(values.shape, np.uint8)
            for f, at in enumerate(cuts):
                out[:, f] = np.searchsorted(at, values[:, f], side="left")
            yield pa.FixedSizeBinaryArray.from_buffers(pa.binary(width), len(out), [None, pa.py_buffer(out)]).cast(pa.binary())

    values = F.array(*[F.col(c).cast("double") for c in columns])
    return rows.withColumns({"bins": F.arrow_udf(assign, "binary")(values), "unit": F.xxhash64(key)})


def bin_matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, width)


class Packing:
    """Which features share a byte: a feature's bin is a digit of it, by ``group``, ``stride`` and number of bins."""

    def __init__(self, cuts: Sequence[np.ndarray]) -> None:
        self.bins = [len(c) + 1 for c in cuts]
        self.group, self.stride, self.sizes = [0] * len(cuts), [1] * len(cuts), []
        for f in sorted(range(len(cuts)), key=lambda f: (-self.bins[f], f)):
            at = next((g for g, size in enumerate(self.sizes) if size * self.bins[f] <= BINS), len(self.sizes))
            if at == len(self.sizes):
                self.sizes.append(1)
            self.group[f], self.stride[f] = at, self.sizes[at]
            self.sizes[at] *= self.bins[f]

    def pack(self, bins: np.ndarray) -> np.ndarray:
        """[groups, rows] from [rows, features]."""
        out = np.zeros((len(self.sizes), len(bins)), np.uint8)
        for f, (group, stride) in enumerate(zip(self.group, self.stride)):
            out[group] += bins[:, f] * np.uint8(stride if self.bins[f] > 1 else 0)
        return out

    def digit(self, f: int) -> np.ndarray:
        """The feature's bin by the value of its byte."""
        return np.arange(BINS) // self.stride[f] % self.bins[f]

    def per_feature(self, sums: np.ndarray, columns: np.ndarray) -> np.ndarray:
        """[3, nodes, columns, bins] from [3, nodes, groups, bytes]."""
        out = np.zeros((*sums.shape[:2], len(columns), BINS), sums.dtype)
        for c, f in enumerate(columns):
            g, bins, stride = self.group[f], self.bins[f], self.stride[f]
            own = sums[:, :, g, : self.sizes[g]].reshape(*sums.shape[:2], -1, bins, stride)
            out[:, :, c, :bins] = own.sum(axis=(2, 4))
        return out


# --- trees -----------------------------------------------------------------------------------


@dataclass
class Tree:
    """A tree in heap order: the children of node i are 2i + 1 and 2i + 2. ``feature`` is -1 in a leaf, -2 where
    there is no node."""

    depth: int
    feature: np.ndarray = field(init=False)
    bin: np.ndarray = field(init=False)  # the last bin that goes left
    value: np.ndarray = field(init=False)  # what a leaf adds to the margin
    gain: np.ndarray = field(init=False)
    sums: np.ndarray = field(init=False)  # [nodes, 3]: gradients, hessians, rows

    def __post_init__(self) -> None:
        size = 2 ** (self.depth + 1) - 1
        self.feature, self.bin = np.full(size, -2, np.int32), np.zeros(size, np.int32)
        self.value, self.gain, self.sums = np.zeros(size), np.zeros(size), np.zeros((size, 3))
        self.feature[0] = -1

    def nodes_of(self, bins: np.ndarray) -> np.ndarray:
        """The leaf, or the node without a split yet, that each row reaches."""
        at = np.zeros(len(bins), np.int64)
        for _ in range(self.depth):
            feature = self.feature[at]
            inner = feature >= 0
            if not inner.any():
                break
            right = bins[np.arange(len(bins)), np.maximum(feature, 0)] > self.bin[at]
            at = np.where(inner, 2 * at + 1 + right, at)
        return at

    def predict(self, bins: np.ndarray) -> np.ndarray:
        return self.value[self.nodes_of(bins)]


def shrunk(total: np.ndarray, l1: float) -> np.ndarray:
    return np.sign(total) * np.maximum(np.abs(total) - l1, 0.0)


def best_splits(sums: np.ndarray, columns: np.ndarray, n_cuts: np.ndarray, settings: Boosting) -> tuple[np.ndarray, ...]:
    """Per node the best gain (0 if none), feature and bin. ``sums`` is [3, nodes, columns, bins]; of equal gains
    the first feature and the lowest bin win."""
    g, h, n = np.cumsum(sums, axis=3)
    all_g, all_h, all_n = g[..., -1:], h[..., -1:], n[..., -1:]

    def score(grad: np.ndarray, hess: np.ndarray) -> np.ndarray:
        return shrunk(grad, settings.l1) ** 2 / np.maximum(hess + settings.l2, 1e-300)

    gain = score(g, h) + score(all_g - g, all_h - h) - score(all_g, all_h)
    allowed = (h >= settings.min_child) & (all_h - h >= settings.min_child) & (n > 0) & (all_n - n > 0)
    allowed &= np.arange(sums.shape[3]) < n_cuts[columns][:, None]
    gain = np.where(allowed & (gain > LEAST_GAIN) & (gain >= settings.min_gain), gain, 0.0).reshape(len(g), -1)
    best = gain.argmax(axis=1)
    return gain[np.arange(len(gain)), best], columns[best // sums.shape[3]], best % sums.shape[3]


def grow_level(tree: Tree, open_nodes: list[int], sums: np.ndarray, columns: np.ndarray, n_cuts: np.ndarray, settings: Boosting) -> list[int]:
    """Splits the open nodes where that pays, makes the others leaves; returns the new open nodes."""
    gains, features, bins = best_splits(sums, columns, n_cuts, settings)
    opened = []
    for i, node in enumerate(open_nodes):
        whole = sums[:, i, 0].sum(axis=1)
        tree.sums[node] = whole
        if gains[i] <= 0:
            tree.value[node] = leaf_value(whole, settings)
            continue
        tree.feature[node], tree.bin[node], tree.gain[node] = features[i], bins[i], gains[i]
        at = int(np.flatnonzero(columns == features[i])[0])
        left = sums[:, i, at, : bins[i] + 1].sum(axis=1)
        for child, part in ((2 * node + 1, left), (2 * node + 2, whole - left)):
            tree.feature[child], tree.sums[child], tree.value[child] = -1, part, leaf_value(part, settings)
            opened.append(child)
    return opened


def leaf_value(sums: np.ndarray, settings: Boosting) -> float:
    return float(-settings.rate * shrunk(sums[0], settings.l1) / max(sums[1] + settings.l2, 1e-300))


def drawn_rows(unit: np.ndarray, seed: int, tree: int, share: float) -> np.ndarray:
    """Which rows a tree is grown on: each by a hash of its key, the seed and the tree's number."""
    x = unit.astype(np.uint64) ^ np.uint64((seed * 0x9E3779B97F4A7C15 + tree * 0xD6E8FEB86659FD93) & (2**64 - 1))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)) * 2.0**-53 < share


def drawn_columns(width: int, seed: int, tree: int, share: float) -> np.ndarray:
    return np.sort(np.random.default_rng([seed, tree]).permutation(width)[: max(1, round(share * width))])


def gradients(margin: np.ndarray, label: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and second derivative of the logistic loss, in whole units."""
    p = 1 / (1 + np.exp(-margin))
    return np.rint(UNIT * weight * (p - label)), np.rint(UNIT * weight * p * (1 - p))


# --- jobs ------------------------------------------------------------------------------------

ROWS = ["bins", "unit", "label", "weight", "margin"]
_SUMS = T.StructType([T.StructField(name, T.LongType()) for name in ("cell", "g", "h", "n")])


def _plain_session(spark: SparkSession) -> SparkSession:
    """A session for the many small jobs of a level: their shuffle is bounded by the cells, so there is nothing to
    adapt, and planning it anew at each stage would take longer than the work. The caller's session stays as it is."""
    session = spark.newSession()
    for name in ("spark.sql.shuffle.partitions", "spark.sql.session.timeZone"):
        session.conf.set(name, spark.conf.get(name))
    session.conf.set("spark.sql.adaptive.enabled", "false")
    # Nor does anybody read the plans of hundreds of like jobs: describing them takes a tenth of each.
    session.conf.set("spark.sql.ui.explainMode", "simple")
    session.conf.set("spark.sql.maxPlanStringLength", "100")
    return session


def _parts(batch: pa.RecordBatch, width: int, trees: Sequence[Tree]) -> Iterator[tuple[np.ndarray, ...]]:
    """bins, unit, label, weight and the margin after ``trees``, some rows at a time."""
    for at in range(0, batch.num_rows, ROWS_AT_ONCE):
        part = batch.slice(at, ROWS_AT_ONCE)
        bins = bin_matrix(part.column("bins"), width)
        unit, label, weight, margin = (part.column(c).to_numpy(zero_copy_only=False) for c in ROWS[1:])
        yield bins, unit, label, weight, margin + sum(t.predict(bins) for t in trees)


class Walk:
    """A tree as tables over packed bytes: where a row goes next from a node, by the value of one byte."""

    def __init__(self, tree: Tree, packing: Packing) -> None:
        size = len(tree.feature)
        self.depth, self.next = tree.depth, np.arange(size)
        self.group, self.right = np.zeros(size, np.int64), np.zeros((size, BINS), np.uint8)
        for node in np.flatnonzero(tree.feature >= 0):
            f = tree.feature[node]
            self.next[node], self.group[node] = 2 * node + 1, packing.group[f]
            self.right[node] = packing.digit(f) > tree.bin[node]
        self.inner = tree.feature >= 0

    def nodes_of(self, codes: np.ndarray) -> np.ndarray:
        """``Tree.nodes_of``, from packed bytes."""
        rows = codes.shape[1]
        at, row, flat, right = np.zeros(rows, np.int64), np.arange(rows), codes.ravel(), self.right.ravel()
        if self.inner[0]:
            at = 1 + right[: BINS][codes[self.group[0]]].astype(np.int64)
            starts = self.group * rows
            for level in range(1, self.depth):
                if not self.inner[2**level - 1 : 2 ** (level + 1) - 1].any():
                    break
                code = flat.take(starts.take(at) + row)
                at = self.next.take(at) + right.take(at * BINS + code)
        return at


def tasks_for(rows: int, cores: int) -> int:
    """Tasks for so many rows: whole rounds of all cores, if there are rows for them, and none with too many."""
    tasks = max(1, -(-rows // TASK_ROWS))
    return max(tasks, min(-(-tasks // cores) * cores, rows // LEAST_ROWS))


# A block of rows: packed bytes, hash of the key, label, weight and margin.
# What a tree's levels read of it: packed bytes, gradient and hessian of the rows that are drawn.
Block = tuple[np.ndarray, ...]


def in_blocks(rows: DataFrame, packing: Packing, folder: str) -> RDD:
    """The rows as blocks, written to the folder, with at most about ``TASK_ROWS`` rows a task."""
    width = len(packing.group)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(parts: list[tuple]) -> pa.RecordBatch:
            own, *rest = (np.concatenate(c) for c in zip(*parts))
            block = (packing.pack(own), *rest)
            return pa.RecordBatch.from_arrays([pa.array([pickle.dumps(block, 5)], pa.binary()), pa.array([len(own)], pa.int64())], names=["block", "n"])

        held, n = [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS)
                held.append((bin_matrix(part.column("bins"), width), *(part.column(c).to_numpy(zero_copy_only=False) for c in ROWS[1:4])))
                n += part.num_rows
                if n >= BLOCK_ROWS:
                    yield made(held)
                    held, n = [], 0
        if n:
            yield made(held)

    rows.mapInArrow(pack, "block binary, n long").write.parquet(folder)
    kept = rows.sparkSession.read.schema("block binary, n long").parquet(folder)
    tasks = tasks_for(kept.agg(F.sum("n")).first()[0] or 0, rows.sparkSession.sparkContext.defaultParallelism)
    numbered = kept.select("block").rdd.map(lambda row: row[0]).zipWithIndex().map(lambda pair: (pair[1], pair[0]))

    def opened(pair: tuple[int, bytes]) -> Block:
        codes, unit, label, weight = pickle.loads(pair[1])
        return codes, unit, label, weight, np.zeros(len(unit))

    return numbered.partitionBy(tasks, lambda number: number).map(opened)


# Trees as they are sent to tasks: the walk, and the values of the nodes.
Grown = Sequence[tuple[Walk, np.ndarray]]


def added(codes: np.ndarray, margin: np.ndarray, trees: Grown) -> np.ndarray:
    since = np.zeros(len(margin))
    for walk, values in trees:
        since = since + values.take(walk.nodes_of(codes))
    return margin + since


def after_trees(blocks: RDD, trees: Grown) -> RDD:
    """The blocks with the trees added to their margins."""
    return blocks.map(lambda block: (*block[:4], added(block[0], block[4], trees)))


def for_tree(blocks: RDD, number: int, since: Grown, settings: Boosting, seed: int) -> RDD:
    """What the levels of tree ``number`` read, ``since`` being the trees that the blocks' margins lack."""

    def draw(block: Block) -> Block:
        codes, unit, label, weight, margin = block
        use = np.flatnonzero(drawn_rows(unit, seed, number, settings.rows))
        codes = codes.take(use, axis=1)
        found = gradients(added(codes, margin.take(use), since), label.take(use), weight.take(use))
        return codes, *(x.astype(np.int32) if np.abs(x).max(initial=0) < 2**31 else x for x in found)

    return blocks.map(draw)


def level_sums(blocks: RDD, tree: Tree, nodes: Sequence[int], groups: Sequence[int], packing: Packing) -> np.ndarray:
    """[3, nodes, groups, bytes]: sums of gradients, hessians and rows in whole units, of these groups, in one job."""
    place = np.full(len(tree.feature), -1, np.int64)
    place[list(nodes)] = np.arange(len(nodes))
    walk, shape = Walk(tree, packing), (len(nodes), len(packing.sizes), BINS)

    def add_up(number: int, found: Iterator[Block]) -> Iterator[tuple[int, np.ndarray]]:
        total = np.zeros((3, len(groups), len(nodes) * BINS))
        for codes, g, h in found:
            node = place.take(walk.nodes_of(codes))
            use = np.flatnonzero(node >= 0)
            base, g, h = node.take(use) * BINS, g.take(use).astype(np.float64), h.take(use).astype(np.float64)
            for at, group in enumerate(groups):
                cell = base + codes[group].take(use)
                for k, value in enumerate((g, h, None)):
                    total[k, at] += np.bincount(cell, value, minlength=total.shape[2])
        # Below 2**53 these sums are whole.
        yield number % READERS, total.astype(np.int64)

    sums = blocks.mapPartitionsWithIndex(add_up)
    if blocks.getNumPartitions() > DIRECT:
        sums = sums.reduceByKey(np.add, READERS)
    out = np.zeros((3, *shape), np.int64)
    out[:, :, list(groups)] = sum(part for _, part in sums.collect()).reshape(3, len(groups), len(nodes), BINS).transpose(0, 2, 1, 3)
    return out


def grow_tree(blocks: RDD, columns: np.ndarray, packing: Packing, settings: Boosting) -> Tree:
    """One tree over the rows it draws, in a job per level."""
    tree, nodes, sums = Tree(settings.depth), [0], {}
    groups = sorted({packing.group[f] for f in columns})
    n_cuts = np.array(packing.bins) - 1
    units = np.array([UNIT, UNIT, 1.0])[:, None, None, None]
    for _ in range(settings.depth):
        if not nodes:
            break
        # Of two sisters, the one with fewer rows.
        asked = nodes if nodes == [0] else [min(pair, key=lambda node: tree.sums[node, 2]) for pair in zip(nodes[::2], nodes[1::2])]
        found = level_sums(blocks, tree, asked, groups, packing)
        own = {node: found[:, i] for i, node in enumerate(asked)}
        for node in set(nodes) - set(own):
            parent = (node - 1) // 2
            own[node] = sums[parent] - own[4 * parent + 3 - node]
        sums = own
        stacked = packing.per_feature(np.stack([sums[node] for node in nodes], axis=1), columns)
        nodes = grow_level(tree, nodes, stacked / units, columns, n_cuts, settings)
    return tree


def with_margins(rows: DataFrame, trees: Sequence[Tree], width: int) -> DataFrame:
    """The rows with the trees added to their margins."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            margin = [part[4] for part in _parts(batch, width, trees)] or [np.empty(0)]
            columns = [batch.column(c) for c in ROWS[:-1]] + [pa.array(np.concatenate(margin))]
            yield pa.RecordBatch.from_arrays(columns, names=ROWS)

    return rows.mapInArrow(add, rows.schema)


_SCORES = np.dtype([("code", "<i8"), ("score", "<f8"), ("pos", "<i8"), ("neg", "<i8")])


def areas_after(valid: DataFrame, trees: Sequence[Tree], width: int) -> list[float]:
    """The area under the ROC curve of the validation rows after each tree, in one job and from unrounded scores.

    Rows are counted per score, first in tasks, then per tree and cell of scores, of which a task gets some; the driver
    adds up the cells. All of it is whole numbers: exact in any order.
    """
    parts = 4 * valid.rdd.getNumPartitions()

    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _gathered(batches):
            found = []
            for own, _, label, _, margin in _parts(batch, width, ()):
                for number, tree in enumerate(trees):
                    margin = margin + tree.predict(own)
                    p, which = np.unique(1 / (1 + np.exp(-margin)), return_inverse=True)
                    out = np.empty(len(p), _SCORES)
                    out["code"], out["score"] = number * CELLS + np.minimum(p * CELLS, CELLS - 1).astype(np.int64), p
                    out["pos"], out["neg"] = (np.bincount(which, side, len(p)) for side in (label, 1 - label))
                    found.append(out)
            found = np.concatenate(found)
            # Neighbouring cells go to different tasks.
            part = found["code"] % parts
            found = found[np.argsort(part, kind="stable")]
            ends = np.cumsum(np.bincount(part, minlength=parts))
            sent = [(i, found[e - n : e].tobytes()) for i, (e, n) in enumerate(zip(ends, np.diff(ends, prepend=0))) if n]
            yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*sent), (pa.int64(), pa.binary()))], names=["part", "scores"])

    def cells(_: tuple, group: pa.Table) -> pa.Table:
        found = np.frombuffer(b"".join(group.column("scores").to_pylist()), _SCORES)
        found = found[np.lexsort((found["score"], found["code"]))]
        first = np.append(True, (found["code"][1:] != found["code"][:-1]) | (found["score"][1:] != found["score"][:-1]))
        code, at = found["code"][first], np.flatnonzero(first)
        pos, neg = (np.add.reduceat(found[side], at) for side in ("pos", "neg"))
        starts = np.flatnonzero(np.append(True, code[1:] != code[:-1]))
        below = np.cumsum(neg) - neg
        below -= np.repeat(below[starts], np.diff(np.append(starts, len(code))))
        sums = [np.add.reduceat(x, starts) for x in (pos * (2 * below + neg), pos, neg)]
        return pa.table(dict(zip(("code", "doubled", "pos", "neg"), map(pa.array, (code[starts], *sums)))))

    sent = valid.select(*ROWS).mapInArrow(scores, "part long, scores binary")
    found = sent.groupBy("part").applyInArrow(cells, "code long, doubled long, pos long, neg long").toArrow().sort_by("code")
    rows: list[list[tuple[int, ...]]] = [[] for _ in trees]
    for code, *sums in zip(*(found.column(c).to_pylist() for c in ("code", "doubled", "pos", "neg"))):
        rows[code // CELLS].append(tuple(sums))
    return [_area(cells) for cells in rows]


def _area(cells: Sequence[tuple[int, ...]]) -> float:
    """The area from twice the area within each cell, its positives and negatives, lowest cell first; 0 without both."""
    doubled = below = positives = 0
    for within, pos, neg in cells:
        doubled, below, positives = doubled + within + 2 * pos * below, below + neg, positives + pos
    if not positives or not below:
        return 0.0
    area = Decimal(repr(float(doubled) / 2 / (float(positives) * float(below))))
    return float(area.quantize(Decimal("1e-10"), ROUND_HALF_UP))


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of about ``ROWS_AT_ONCE`` rows."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= ROWS_AT_ONCE:
            yield pa.concat_batches(held)
            held = []
    if sum(b.num_rows for b in held):
        yield pa.concat_batches(held)


def best_round(scores: Sequence[float], patience: int) -> tuple[int, bool]:
    """Rounds up to the highest score, and whether ``patience`` rounds then passed without a higher."""
    best = 0
    for at, score in enumerate(scores):
        if score > scores[best]:
            best = at
        elif at - best >= patience:
            return best + 1, True
    return best + 1, False


def grow(train: DataFrame, valid: DataFrame | None, cuts: Sequence[np.ndarray], settings: Boosting, seed: int) -> tuple[list[Tree], list[float]]:
    """Trees one by one, and the validation area after each, until patience runs out.

    Both frames have bins, unit, label and weight. Every tree is grown on margins that all trees before it
    have been added to. What a tree's levels read is kept while it grows; a lost part is made again from the
    blocks, and these from the last that were written.
    """
    spark = _plain_session(train.sparkSession)
    width, packing = len(cuts), Packing(cuts)
    folder = f"{shared_folder(train.sparkSession)}/boosting-{uuid.uuid4().hex}"

    def stored(rows: DataFrame, name: str) -> DataFrame:
        rows.write.parquet(f"{folder}/{name}")
        kept = spark.read.schema(rows.schema).parquet(f"{folder}/{name}")
        # A task for every so many rows, in all of the jobs to come; their number stays as it is.
        if not tasks:
            tasks.append(tasks_for(kept.count(), spark.sparkContext.defaultParallelism))
        return kept.coalesce(tasks[0]).persist(StorageLevel.MEMORY_AND_DISK)

    def plain(rows: DataFrame) -> DataFrame:
        return rows.select("bins", "unit", F.col("label").cast("double"), F.col("weight").cast("double"), F.lit(0.0).alias("margin"))

    trees: list[Tree] = []
    areas: list[float] = []
    watched: DataFrame | None = None
    tasks: list[int] = []
    held: list[RDD] = []
    written: list[str] = []
    try:
        blocks = in_blocks(plain(train), packing, f"{folder}/train").persist(StorageLevel.MEMORY_AND_DISK)
        held.append(blocks)
        if valid is not None and settings.patience:
            watched = stored(plain(valid), "valid-0")
        since: list[tuple[Walk, np.ndarray]] = []
        while len(trees) < settings.trees:
            number = len(trees)
            if number and number % CHUNK == 0:
                blocks, since = after_trees(blocks, since).persist(StorageLevel.MEMORY_AND_DISK), []
                held.append(blocks)
                blocks.checkpoint()
            drawn = for_tree(blocks, number, since, settings, seed).persist(StorageLevel.MEMORY_AND_DISK)
            held.append(drawn)
            trees.append(grow_tree(drawn, drawn_columns(width, seed, number, settings.columns), packing, settings))
            since = [*since, (Walk(trees[-1], packing), trees[-1].value)]
            for rdd in held:
                if rdd is not blocks:
                    rdd.unpersist()
            held = [blocks]
            if blocks.isCheckpointed() and blocks.getCheckpointFile() not in written:
                written.append(blocks.getCheckpointFile())
                if len(written) > 1:
                    delete_folder(spark, written.pop(0))
            if watched is not None and (len(trees) % CHUNK == 0 or len(trees) == settings.trees):
                late = trees[len(areas) :]
                areas += areas_after(watched, late, width)
                if best_round(areas, settings.patience)[1]:
                    break
                if len(trees) < settings.trees:
                    before, watched = watched, stored(with_margins(watched, late, width), f"valid-{len(trees)}")
                    before.unpersist()
    finally:
        for frame in (*held, *([watched] if watched is not None else [])):
            frame.unpersist()
        for path in (folder, *written):
            delete_folder(spark, path)
    return trees, areas


# --- the model -------------------------------------------------------------------------------


def node_rows(trees: Sequence[Tree], cuts: Sequence[np.ndarray]) -> list[tuple]:
    """(tree, node) in the order in which MLlib numbers them: a node, its left side, its right side.

    The margin of MLlib's boosted model is half the log-odds. A node's weight is its sum of hessians.
    """
    out = []
    for number, tree in enumerate(trees):
        order: list[int] = []
        stack = [0]
        while stack:
            at = stack.pop()
            order.append(at)
            if tree.feature[at] >= 0:
                stack += [2 * at + 2, 2 * at + 1]
        place = {at: i for i, at in enumerate(order)}
        for at in order:
            grad, hess, rows = tree.sums[at].tolist()
            inner = tree.feature[at] >= 0
            split = (int(tree.feature[at]), [float(cuts[tree.feature[at]][tree.bin[at]])], -1) if inner else (-1, [], -1)
            children = (place[2 * at + 1], place[2 * at + 2]) if inner else (-1, -1)
            gain = float(tree.gain[at]) / max(hess, 1e-300) if inner else -1.0
            stats = [hess, grad, hess]
            out.append((number, (place[at], 0.5 * float(tree.value[at]), 0.0, stats, int(rows), gain, *children, split)))
    return out


_NODES = (
    "treeID int, nodeData struct<id:int, prediction:double, impurity:double, impurityStats:array<double>, rawCount:long, gain:double,"
    " leftChild:int, rightChild:int, split:struct<featureIndex:int, leftCategoriesOrThreshold:array<double>, numCategories:int>>"
)


def as_mllib(spark: SparkSession, trees: Sequence[Tree], cuts: Sequence[np.ndarray], depth: int) -> GBTClassificationModel:
    """The trees as MLlib's boosted model: its saved form is a table of nodes, written here and loaded."""
    folder = f"{shared_folder(spark)}/model-{uuid.uuid4().hex}"

    def about(name: str, **more) -> str:
        uid = f"{name.rpartition('.')[2]}_{uuid.uuid4().hex[:12]}"
        return json.dumps({"class": name, "timestamp": int(time.time() * 1000), "sparkVersion": spark.version, "uid": uid, "paramMap": {"maxDepth": depth, "impurity": "variance"}, "defaultParamMap": {}, **more})

    ensemble = about("org.apache.spark.ml.classification.GBTClassificationModel", numFeatures=len(cuts), numTrees=len(trees))
    each = [(i, about("org.apache.spark.ml.regression.DecisionTreeRegressionModel"), 1.0) for i in range(len(trees))]
    try:
        spark.createDataFrame([(ensemble,)], "value string").coalesce(1).write.text(f"{folder}/metadata")
        spark.createDataFrame(node_rows(trees, cuts), _NODES).coalesce(1).write.parquet(f"{folder}/data")
        spark.createDataFrame(each, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{folder}/treesMetadata")
        return GBTClassificationModel.load(folder)
    finally:
        delete_folder(spark, folder)
