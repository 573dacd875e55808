"""Second-order boosting against a plain NumPy version of the same rules."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from stayline.operators import boosting, modeling
from stayline.operators.evaluation import roc_auc
from stayline.plans import pipeline
from stayline.schemas import MODEL_FEATURES
from stayline.sources.derived import raw_subscribers

N = 2000
COLUMNS = [f"x{i}" for i in range(6)]
SETTINGS = boosting.Boosting(trees=23, depth=4, rate=0.3, patience=0, weighted=False)


def made(seed=1):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(N, len(COLUMNS))), 2)
    x[:, 4] = rng.integers(0, 3, N)
    x[:, 5] = 7.0  # tells nothing
    y = (x[:, 0] + x[:, 1] * x[:, 4] + rng.normal(size=N) > 0.5).astype(float)
    return x, y


def table(spark, x, y):
    rows = [(i, *map(float, v), int(t)) for i, (v, t) in enumerate(zip(x, y))]
    frame = spark.createDataFrame(rows, "id long, " + ", ".join(f"{c} double" for c in COLUMNS) + ", label int")
    cuts = boosting.find_cuts(frame, COLUMNS)
    binned = boosting.binned(frame, cuts, COLUMNS, key="id").withColumn("weight", F.when(F.col("label") == 1, 2.0).otherwise(1.0))
    return binned.repartition(3), cuts


def brute_force(bins, unit, label, weight, n_cuts, settings, seed):
    """Node by node, feature by feature, bin by bin."""

    def shrink(v):
        return np.sign(v) * max(abs(v) - settings.l1, 0)

    def part(g, h):
        return shrink(g) ** 2 / (h + settings.l2)

    def build(rows, g, h, columns, depth):
        total = part(g[rows].sum(), h[rows].sum())
        best = (0.0, None, None)
        for f in columns if depth < settings.depth else []:
            for b in range(n_cuts[f]):
                left, right = rows[bins[rows, f] <= b], rows[bins[rows, f] > b]
                if not len(left) or not len(right) or min(h[left].sum(), h[right].sum()) < settings.min_child:
                    continue
                gain = part(g[left].sum(), h[left].sum()) + part(g[right].sum(), h[right].sum()) - total
                if gain > max(best[0], 1e-6) and gain >= settings.min_gain:
                    best = (gain, f, b)
        if best[1] is None:
            return -settings.rate * shrink(g[rows].sum()) / (h[rows].sum() + settings.l2)
        _, f, b = best
        return (f, b, *(build(rows[side], g, h, columns, depth + 1) for side in (bins[rows, f] <= b, bins[rows, f] > b)))

    def predict(node, row):
        while isinstance(node, tuple):
            node = node[2] if row[node[0]] <= node[1] else node[3]
        return node

    margin, trees = np.zeros(len(label)), []
    for t in range(settings.trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = (np.rint(v * 2**24) / 2**24 for v in (weight * (p - label), weight * p * (1 - p)))
        rows = np.flatnonzero(boosting.drawn_rows(unit, seed, t, settings.rows))
        tree = build(rows, g, h, boosting.drawn_columns(bins.shape[1], seed, t, settings.columns), 0)
        trees.append(tree)
        margin = margin + np.array([predict(tree, row) for row in bins])
    return trees, margin


def as_tuples(tree, at=0):
    if tree.feature[at] < 0:
        return tree.value[at]
    return (int(tree.feature[at]), int(tree.bin[at]), as_tuples(tree, 2 * at + 1), as_tuples(tree, 2 * at + 2))


def close(a, b):
    if isinstance(a, tuple):
        return isinstance(b, tuple) and a[:2] == b[:2] and close(a[2], b[2]) and close(a[3], b[3])
    return not isinstance(b, tuple) and a == pytest.approx(b, abs=1e-9)


@pytest.mark.parametrize("settings", [SETTINGS, boosting.Boosting(trees=4, depth=3, rate=0.5, min_child=20.0, min_gain=2.0, l1=0.0, l2=0.0, rows=1.0, columns=0.5, patience=0)])
def test_trees_equal_brute_force(spark, settings):
    x, y = made()
    rows, cuts = table(spark, x, y)
    found = rows.orderBy("id").toArrow()
    bins = boosting.bin_matrix(found.column("bins").combine_chunks(), len(COLUMNS))
    for f, c in enumerate(cuts):
        assert (bins[:, f] == np.searchsorted(c, x[:, f])).all() and len(c) < boosting.BINS
    unit, label, weight = (found.column(c).to_numpy() for c in ("unit", "label", "weight"))
    trees, areas = boosting.grow(rows, None, cuts, settings, 5)
    naive, margin = brute_force(bins, unit, label, weight, [len(c) for c in cuts], settings, 5)
    assert areas == [] and len(trees) == settings.trees
    assert all(close(as_tuples(t), n) for t, n in zip(trees, naive))
    # MLlib's model of them gives the same probabilities, from the values themselves.
    model = boosting.as_mllib(spark, trees, cuts, settings.depth)
    from pyspark.ml.feature import VectorAssembler

    frame = spark.createDataFrame([(i, *map(float, v)) for i, v in enumerate(x)], "id long, " + ", ".join(f"{c} double" for c in COLUMNS))
    scored = model.transform(VectorAssembler(inputCols=COLUMNS, outputCol="features").transform(frame))
    mine = [r["p"] for r in scored.orderBy("id").select(modeling.probability().alias("p")).collect()]
    np.testing.assert_allclose(mine, 1 / (1 + np.exp(-margin)), atol=1e-9)


def test_how_rows_are_dealt_out_does_not_matter(spark):
    rows, cuts = table(spark, *made(2))
    first, second = (boosting.grow(rows.repartition(n), None, cuts, boosting.Boosting(trees=3, depth=3, patience=0), 1)[0] for n in (1, 7))
    assert [as_tuples(t) for t in first] == [as_tuples(t) for t in second]


def test_a_tree_takes_one_job_per_level(spark):
    rows, cuts = table(spark, *made(3))
    settings = boosting.Boosting(trees=3, depth=4, patience=0)
    spark.sparkContext.setJobGroup("levels", "levels")
    before = len(spark.sparkContext.statusTracker().getJobIdsForGroup("levels"))
    calls = []
    level_sums = boosting.level_sums

    def counted(*args, **more):
        at = len(spark.sparkContext.statusTracker().getJobIdsForGroup("levels"))
        out = level_sums(*args, **more)
        calls.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup("levels")) - at)
        return out

    try:
        boosting.level_sums = counted
        boosting.grow(rows, None, cuts, settings, 1)
    finally:
        boosting.level_sums = level_sums
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert before == 0 and len(calls) <= settings.trees * settings.depth
    # One aggregation: the adaptive plan runs its two sides as jobs. The first also fills the cache.
    assert set(calls[1:]) <= {1, 2}


def test_the_area_after_each_tree_is_exact_to_the_last_digit(spark):
    """Scores that differ in the fifth digit only: rounding them would tie them, and pick another round."""
    labels = np.array([0, 1] * 40 + [0] * 20)
    bins = np.arange(100, dtype=np.uint8)[:, None]
    rows = spark.createDataFrame([(bytes([b]), i, float(t), 1.0, 0.0) for i, (b, t) in enumerate(zip(bins[:, 0], labels))], "bins binary, unit long, label double, weight double, margin double")
    trees, exact, rounded = [], [], []
    margin = np.zeros(100)
    rng = np.random.default_rng(3)
    for _ in range(6):
        tree = boosting.Tree(7)
        for node in range(127):  # a leaf of its own for each bin
            level = int(np.log2(node + 1))
            low, size = (node + 1 - 2**level) * 2 ** (7 - level), 2 ** (7 - level)
            tree.feature[node], tree.bin[node] = 0, low + size // 2 - 1
        tree.feature[127:] = -1
        tree.value[127:] = rng.normal(size=128) * 4e-5
        trees.append(tree)
        margin = margin + tree.predict(bins)
        p = 1 / (1 + np.exp(-margin))
        for out, score in ((exact, p), (rounded, np.round(p, 4))):
            pos, neg = score[labels == 1][:, None], score[labels == 0][None, :]
            out.append(float(((pos > neg) + 0.5 * (pos == neg)).mean()))
    found = boosting.areas_after(rows.repartition(4), trees, 1)
    np.testing.assert_allclose(found, exact, atol=1e-9)
    assert boosting.best_round(found, 10) == boosting.best_round(exact, 10) != boosting.best_round(rounded, 10)


def test_missing_values_go_right_and_constant_columns_tell_nothing(spark):
    rows = spark.createDataFrame([(i, None if i % 3 else float(i), 1.0, i % 2) for i in range(30)], "id long, a double, b double, label int")
    cuts = boosting.find_cuts(rows, ["a", "b"])
    assert len(cuts[1]) == 0 and len(cuts[0]) == 9
    bins = boosting.binned(rows.withColumn("a", F.lit(float("nan"))), cuts, ["a", "b"], key="id")
    assert {tuple(r["bins"]) for r in bins.collect()} == {(9, 0)}


def test_one_class_only(spark):
    x, y = made(4)
    rows, cuts = table(spark, x, np.zeros(N))
    trees, _ = boosting.grow(rows, None, cuts, boosting.Boosting(trees=2, depth=2, patience=0), 1)
    assert all(t.value[t.feature == -1].max() < 0 for t in trees)


def test_patience_and_quality(spark, tiny):
    matrix = pipeline.training_matrix(raw_subscribers(spark, tiny)).cache()
    train = modeling.split_frames(matrix).filter("NOT is_test")
    bins = modeling.bin_table(train)
    weighted = bins.rows.withColumn("weight", F.lit(1.0))
    settings = boosting.Boosting(trees=40, depth=3, rate=0.3, patience=4)
    trees, areas = boosting.grow(weighted.filter("NOT is_validation"), weighted.filter("is_validation"), bins.cuts, settings, 42)
    best, stopped = boosting.best_round(areas, settings.patience)
    assert len(trees) == len(areas) <= best + settings.patience + boosting.CHUNK
    assert max(areas) > 0.6 and (stopped or len(trees) == 40)
    assert len(bins.cuts) == len(MODEL_FEATURES)


def test_features_of_few_bins_share_a_byte():
    """Sums per byte and nodes found from bytes are those of the features themselves."""
    rng = np.random.default_rng(7)
    bins = [256, 3, 2, 2, 9, 1, 73, 2, 40]
    packing = boosting.Packing([np.arange(n - 1.0) for n in bins])
    rows = np.stack([rng.integers(0, n, 500) for n in bins], axis=1).astype(np.uint8)
    codes = packing.pack(rows)
    assert len(codes) == len(packing.sizes) < len(bins) and max(packing.sizes) <= boosting.BINS
    for f in range(len(bins)):
        assert (packing.digit(f)[codes[packing.group[f]]] == rows[:, f]).all()
    sums = np.stack([np.bincount(c, minlength=boosting.BINS) for c in codes])[None, None].repeat(3, axis=0)
    wide = packing.per_feature(sums, np.arange(len(bins)))
    assert all((wide[2, 0, f] == np.bincount(rows[:, f], minlength=boosting.BINS)).all() for f in range(len(bins)))
    tree = boosting.Tree(4)
    for node in (0, 1, 2, 4, 9):
        tree.feature[node], tree.bin[node] = (node * 5 + 1) % len(bins), 0
        tree.feature[[2 * node + 1, 2 * node + 2]] = -1
    assert (boosting.Walk(tree, packing).nodes_of(codes) == tree.nodes_of(rows)).all()


def test_only_the_smaller_of_two_sisters_is_added_up(spark, monkeypatch):
    rows, cuts = table(spark, *made(5))
    asked, level_sums = [], boosting.level_sums
    monkeypatch.setattr(boosting, "level_sums", lambda blocks, tree, nodes, *more: asked.append(list(nodes)) or level_sums(blocks, tree, nodes, *more))
    boosting.grow(rows, None, cuts, boosting.Boosting(trees=2, depth=4, patience=0), 1)
    assert all(len({(node - 1) // 2 for node in nodes}) == len(nodes) for nodes in asked)


def test_rows_of_one_task_are_dealt_out(spark, monkeypatch):
    """Blocks in many tasks, whose sums are added up on executors first, give the same trees."""
    rows, cuts = table(spark, *made(6))
    settings = boosting.Boosting(trees=12, depth=3, patience=0)
    whole = boosting.grow(rows.coalesce(1), None, cuts, settings, 1)[0]
    for name, value in (("TASK_ROWS", 400), ("BLOCK_ROWS", 100), ("DIRECT", 2)):
        monkeypatch.setattr(boosting, name, value)
    tasks, for_tree = [], boosting.for_tree
    monkeypatch.setattr(boosting, "for_tree", lambda blocks, *more: tasks.append(blocks.getNumPartitions()) or for_tree(blocks, *more))
    split = boosting.grow(rows.coalesce(1), None, cuts, settings, 1)[0]
    assert set(tasks) == {5} and [as_tuples(t) for t in split] == [as_tuples(t) for t in whole]


def test_all_cores_have_rows_to_add_up():
    assert [boosting.tasks_for(n, 12) for n in (0, 2000, 100_000, 648_000, 3_900_000)] == [1, 1, 6, 12, 24]
    assert boosting.tasks_for(10**9, 12) >= 10**9 / boosting.TASK_ROWS


def test_the_levels_of_a_tree_read_bytes_and_gradients_of_drawn_rows_only(spark, monkeypatch):
    rows, cuts = table(spark, *made(7))
    unit = np.array([r["unit"] for r in rows.select("unit").collect()])
    seen, level_sums = [], boosting.level_sums

    def watch(blocks, *more):
        seen.append(blocks.map(lambda block: (len(block), block[0].shape[1], sum(x.nbytes for x in block[1:]))).collect())
        return level_sums(blocks, *more)

    monkeypatch.setattr(boosting, "level_sums", watch)
    settings = boosting.Boosting(trees=12, depth=1, rows=0.5, patience=0)
    boosting.grow(rows, None, cuts, settings, 1)
    for number, blocks in enumerate(seen):
        drawn = boosting.drawn_rows(unit, 1, number, 0.5).sum()
        assert {b[0] for b in blocks} == {3} and sum(b[1] for b in blocks) == drawn and sum(b[2] for b in blocks) == 8 * drawn


def test_areas_take_one_shuffle_and_equal_the_metric(spark, monkeypatch):
    """Many pieces, ties across pieces and cells, one tree that tells nothing and a round of one class only."""
    monkeypatch.setattr(boosting, "ROWS_AT_ONCE", 50)
    rng = np.random.default_rng(9)
    bins, label = rng.integers(0, 8, 600).astype(np.uint8), rng.integers(0, 2, 600)
    rows = spark.createDataFrame([(bytes([b]), i, float(t), 1.0, float(b % 3)) for i, (b, t) in enumerate(zip(bins, label))], "bins binary, unit long, label double, weight double, margin double")
    trees = [boosting.Tree(1), boosting.Tree(1)]
    trees[1].feature[:], trees[1].bin[0], trees[1].value[1:] = [0, -1, -1], 3, [-0.7, 0.4]
    plain = boosting._plain_session(spark)
    own = plain.createDataFrame(rows.toArrow()).repartition(5)
    spark.sparkContext.setJobGroup("areas", "areas")
    try:
        found = boosting.areas_after(own, trees, 1)
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("areas")
        stages = {s for j in jobs for s in spark.sparkContext.statusTracker().getJobInfo(j).stageIds}
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) == 1 and len(stages) == 3  # one of them is the test's own repartition
    margin = (bins % 3).astype(float)
    for area, tree in zip(found, trees):
        margin = margin + tree.predict(bins[:, None])
        scored = [(float(1 / (1 + np.exp(-m))), int(t)) for m, t in zip(margin, label)]
        frame = spark.createDataFrame(scored, "score double, label int").withColumn("round", F.lit(0))
        assert area == roc_auc(frame, ["round"], digits=10).first()["roc_auc"]
    assert boosting.areas_after(own.filter("label = 1"), trees, 1) == [0.0, 0.0]
    assert boosting.areas_after(own.filter("label = 2"), trees, 1) == [0.0, 0.0]
