from collections import defaultdict

import pytest
from odd import clashing, documents, none_of

from checks.compare import connect, difference
from stayline.llm import mixing
from stayline.llm.queries import oracle_sql, queries


def test_equals_sql(spark, tiny):
    assert difference(queries()["op2_source_mix"](spark, tiny), connect(tiny), oracle_sql()["op2_source_mix"]) is None


def made(spark, sizes):
    """Documents of the given word counts by source."""
    rows = [(i, " ".join(["w"] * n), s) for i, (s, n) in enumerate((s, n) for s, ns in sizes.items() for n in ns)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def water_filling(sizes, weights=(5, 2, 1), most=3):
    """Targets by repeated resharing."""
    names = sorted(sizes)
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in fixed]
        rest, by = total - sum(fixed.values()), sum(weight[s] for s in free)
        share = {s: rest * weight[s] / by for s in free}
        over = [s for s in free if share[s] > most * sizes[s]]
        if not over:
            return {**fixed, **share}
        fixed.update({s: most * sizes[s] for s in over})


@pytest.mark.parametrize("sizes", [{"a": [10], "b": [500], "c": [90]}, {"a": [1], "b": [2], "c": [3], "d": [9000], "e": [40]}, {"x": [7, 5]}])
def test_targets_and_taken(spark, sizes):
    rows = mixing.mix_documents(made(spark, sizes), block_words=16).collect()
    want = water_filling({s: sum(n) for s, n in sizes.items()})
    taken = defaultdict(int)
    for r in rows:
        assert r.target == pytest.approx(want[r.source]) and r.taken <= 3 * r.size
        taken[r.source] += r.taken
    assert all(want[s] - 1 < taken[s] <= want[s] + 1e-6 for s in sizes)


def test_pieces_fill_every_slot_once(spark):
    docs = made(spark, {"a": [3, 50, 20], "b": [400, 7], "c": [90], "d": [1]})
    spans, parts = mixing.mix(docs, block_words=8)
    rows, size = parts.collect(), {(r.nth, r.offset): r.size for r in spans.collect() if r.size}
    filled, used = defaultdict(int), defaultdict(list)
    for r in rows:
        filled[r.slot, r.nth] += r.n_words
        assert 0 <= r.first_word < r.first_word + r.n_words <= size[r.nth, r.offset]
        used[r.nth, r.offset, r.repeat].append((r.first_word, r.first_word + r.n_words))
    assert len({slot for slot, _ in filled}) == len(filled)  # one source in a slot
    assert all(a[1] == b[0] for spans in used.values() for a, b in zip(sorted(spans), sorted(spans)[1:]))


def test_the_schedule_keeps_to_the_weights_all_along(spark):
    docs = made(spark, {"a": [5000], "b": [5000], "c": [5000]})
    goals = mixing.targets(mixing.sized(docs))
    slots = sorted(mixing.schedule(goals, 10).collect(), key=lambda r: r.slot)
    share = {r.nth: r.target / 15000 for r in goals.collect()}
    seen = defaultdict(int)
    for k, r in enumerate(slots, 1):
        assert r.rank == seen[r.nth]
        seen[r.nth] += 1
        assert all(abs(seen[n] - share[n] * k) < 4 for n in share)


def test_reruns_agree(spark, tiny):
    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    first, second = (sorted(map(tuple, mixing.mix_documents(d).collect())) for d in (docs, docs.repartition(7)))
    assert first == second


def test_odd_rows(spark):
    rows = mixing.mix_documents(clashing(documents(spark))).collect()
    assert len(rows) == 10
    assert {r.doc_id: r.size for r in rows}[2] == 0
    assert {r.source for r in rows} == {"a", "b", "c", "d", None}
    assert mixing.mix_documents(none_of(spark)).count() == 0
    blank = spark.createDataFrame([(1, None, "a"), (2, " ", None)], "doc_id long, text string, source string")
    assert [r.taken for r in mixing.mix_documents(blank).collect()] == [0, 0]
