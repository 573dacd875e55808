import numpy as np
import pytest

from stayline.llm import ann

SCHEMA = "vec_id long, embedding array<float>"


def table(spark, ids, rows):
    return spark.createDataFrame([(int(i), None if v is None else [float(x) if x is not None else None for x in v]) for i, v in zip(ids, rows)], SCHEMA)


def exact(ids, rows, query, k):
    score = rows.astype(np.float32).astype(float) @ rows[query].astype(np.float32).astype(float)
    order = sorted((-s, i) for s, i in zip(score, ids) if i != ids[query])[:k]
    return [(i, -s) for s, i in order]


@pytest.mark.parametrize("clustered", [False, True])
def test_recall_and_scores(spark, clustered, monkeypatch):
    monkeypatch.setattr(ann, "INDEX_BLOCK", 700)
    draw = np.random.default_rng(3)
    rows = draw.standard_normal((2000, 48))
    if clustered:
        rows = rows * 0.3 + draw.standard_normal((20, 48))[draw.integers(0, 20, 2000)]
    ids = draw.permutation(2000)
    found = {}
    for r in ann.nearest(table(spark, ids, rows)).collect():
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert set(found) == {i for i in ids if i % 20 == 0}
    hits = 0
    for q in np.flatnonzero(ids % 20 == 0):
        mine, want = sorted(found[ids[q]]), exact(ids, rows, q, 20)
        assert [r for r, *_ in mine] == list(range(1, 21))
        assert all(a[2] >= b[2] for a, b in zip(mine, mine[1:]))
        scores = dict(exact(ids, rows, q, 1999))
        assert all(scores[i] == pytest.approx(s, abs=1e-9) for _, i, s in mine)
        hits += len({i for _, i, _ in mine} & {i for i, _ in want})
    assert hits / (20 * len(found)) >= 0.9


def test_probing_finds_every_code_within_the_radius():
    draw = np.random.default_rng(4)
    for bits, radius in ((64, 13), (64, 31), (64, 3), (20, 6), (64, 0), (64, 64)):
        codes = draw.integers(0, 1 << 63, 500, dtype=np.uint64) & np.uint64((1 << bits) - 1)
        queries = np.concatenate([codes[:20] ^ np.uint64(1 << 5), codes[20:30]])
        got = ann.retrieve(queries, codes, bits, radius)
        assert (got == (np.bitwise_count(queries[:, None] ^ codes[None, :]) <= radius)).all()


def test_ties_few_candidates_and_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [[1, 0], [1, 0], [1, 0], None, [0, 0], [nan, 1], [inf, 1], [None, 1], [], [0, 2], [1, 0, 0]]
    ids = [0, 3, 2, 20, 40, 60, 80, 100, 120, 5, 140]
    found = ann.nearest(table(spark, ids, rows)).collect()
    assert [(r.query_id, r["rank"], r.vec_id, r.score) for r in sorted(found, key=lambda r: r["rank"])] == [(0, 1, 2, 1.0), (0, 2, 3, 1.0), (0, 3, 5, 0.0)]


def test_many_equal_vectors_and_repeated_rows(spark):
    ids, rows = [*range(0, 900), 20, 20], [[1.0, 2.0]] * 902
    found = ann.nearest(table(spark, ids, rows)).where("query_id = 20").orderBy("rank").collect()
    assert [r.vec_id for r in found] == [i for i in range(22) if i != 20][:20]


def test_nothing_to_search(spark):
    assert ann.nearest(table(spark, [], [])).count() == 0
    assert ann.nearest(table(spark, [20], [[1, 2]])).count() == 0
    extra = table(spark, range(0, 60), np.eye(60)).selectExpr("*", "1 AS id", "2 AS vec", "3 AS code", "4 AS q", "5 AS r", "6 AS score")
    assert ann.nearest(extra).count() == 3 * 20
