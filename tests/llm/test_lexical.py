import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from odd import clashing, documents, none_of

from stayline.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return TERM.findall((text or "").translate(LOWER))


def brute_force(docs, items, k=20):
    """item -> [(score, doc_id)], straight from the formula."""
    counts = [(i, Counter(words(t))) for i, t in docs]
    n_docs = sum(1 for _, c in counts if c)
    total = sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = {}
    for item, text in set(items):
        wanted, hits = Counter(words(text)), []
        for doc, found in counts:
            n = sum(found.values())
            score = 0
            for term, times in wanted.items():
                if term in found:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[term] + 1)))
                    m = 100 - 25 + (25 * n * n_docs) // total
                    score += times * w * ((1_000_000_000 * found[term]) // (1000 * found[term] + 12 * m))
            if score > 0:
                hits.append((-score, doc is None, doc or 0))
        out.setdefault(item, []).extend((r, None if gone else d, -s) for r, (s, gone, d) in enumerate(sorted(hits)[:k], 1))
    return {item: sorted(rows, key=str) for item, rows in out.items() if rows}


def found(frame):
    out = {}
    for r in frame.collect():
        out.setdefault(r.item_id, []).append((r["rank"], r.doc_id, r.score))
    return {item: sorted(rows, key=str) for item, rows in out.items()}


def corpus(seed, n, vocabulary=300):
    draw = random.Random(seed)
    names = [f"w{i}" if i % 7 else f"Ünï{i}" for i in range(vocabulary)]
    weights = [1 / (i + 1) for i in range(vocabulary)]
    return [(i, " ".join(draw.choices(names, weights, k=draw.choice((0, 1, 5, 40, 200))))) for i in draw.sample(range(n * 3), n)]


def test_terms_are_runs_of_letters_digits_and_all_beyond_ascii(monkeypatch):
    text = "Don't STOP_it\x00now\x7f3.14 Été—ok A1b2  x İI 日本語 😀,"
    assert [t.decode() for part in lexical.terms(text) for t in part] == words(text)
    monkeypatch.setattr(lexical, "SLICE_BYTES", 7)
    assert [t.decode() for part in lexical.terms(text * 9) for t in part] == words(text * 9)


@pytest.mark.parametrize(("block", "terms"), [(4096, 1 << 17), (50, 60)])
def test_ranks_and_scores(spark, block, terms, monkeypatch):
    monkeypatch.setattr(lexical, "BLOCK", block)
    monkeypatch.setattr(lexical, "QUERY_TERMS", terms)
    docs = corpus(1, 900)
    draw = random.Random(2)
    items = [(i, " ".join(draw.choice(docs)[1].split()[:12] + draw.choices(["w1", "w2", "w2", "nowhere", "W5!"], k=3))) for i in range(30)]
    got = lexical.search(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(items, "item_id long, text string"))
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert found(got) == brute_force(docs, items)


def test_pair_bounds_read_less_than_single_bounds_and_lose_nothing():
    docs = corpus(4, 3000, 120)
    rng = random.Random(6)
    queries = lexical.Queries.of([" ".join(rng.choice(docs)[1].split()[:15]) for _ in range(40)])
    counts = [lexical.term_counts(t) for _, t in docs]
    rows = pa.RecordBatch.from_pydict(
        {
            "doc_id": pa.array([i for i, _ in docs], pa.int64()),
            "n": pa.array([sum(c.values()) for c in counts], pa.int64()),
            "terms": pa.array([[queries.vocabulary[t] for t in c if t in queries.vocabulary] for c in counts], pa.list_(pa.int32())),
            "tfs": pa.array([[n for t, n in c.items() if t in queries.vocabulary] for c in counts], pa.list_(pa.int64())),
        }
    )
    df = np.bincount(np.concatenate([t for t in rows.column("terms").to_pylist() if t]).astype(int), minlength=len(queries.vocabulary))
    weights = np.array([lexical.weight(len(docs), int(x)) for x in df], np.int64)
    queries.pair_up(df)
    block = lexical.build_block(rows, weights, len(docs), int(sum(rows.column("n").to_pylist())), queries.pairs)
    pairs, single = lexical.Work(), lexical.Work()
    for query, plan in zip(queries.wanted, queries.plans):
        every, scores = lexical.search_block(block, query, plan, queries.pairs, 0)
        exact = np.zeros(len(docs), np.int64)
        for t, times in zip(*query):
            at, impact = block.list_of(t)
            exact[at] += impact * times
        assert (every == np.flatnonzero(exact)).all() and (scores == exact[every]).all()
        if len(scores) < 20:
            continue
        least = int(np.sort(scores)[-20])
        for plan_, work in ((plan, pairs), ([], single)):
            at, reached = lexical.search_block(block, query, plan_, queries.pairs, least, work)
            assert (at == np.flatnonzero(exact >= least)).all() and (reached == exact[at]).all()
    assert pairs.of == single.of and pairs.read < single.read < single.of


def test_more_pairs_than_are_kept(spark, monkeypatch):
    monkeypatch.setattr(lexical, "PAIRS", 3)
    docs, items = corpus(9, 200), [(i, f"w{i} w{i + 1} w{i + 2} w1 w1") for i in range(20)]
    got = lexical.search(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert found(got) == brute_force(docs, items)


def test_whole_tables(spark, tiny):
    docs, items = (spark.read.parquet(f"{tiny}/{t}.parquet") for t in ("documents", "benchmark"))
    want = brute_force([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert found(lexical.search(docs, items)) == want


def test_odd_and_empty_documents_and_items(spark):
    rows = documents(spark)
    asked = [(1, "quick words for all"), (1, "quick words for all"), (2, None), (3, ""), (4, "... !!!"), (None, "word1 and word2 日本語 quick"), (5, "quick quick QUICK été"), (5, "another text with and")]
    items = spark.createDataFrame(asked, "item_id long, text string")
    want = brute_force([(r.doc_id, r.text) for r in rows.collect()], asked)
    for docs in (rows, clashing(rows)):
        assert found(lexical.search(docs, items)) == want
    assert lexical.search(none_of(spark), items).count() == 0
    assert lexical.search(rows, items.limit(0)).count() == 0


def test_ties_go_by_document(spark):
    docs = spark.createDataFrame([(i, "same words here") for i in (9, 3, 7, None, 1)] + [(i, "other") for i in range(100, 140)], "doc_id long, text string")
    items = spark.createDataFrame([(1, "same words"), (2, "other")], "item_id long, text string")
    got = {i: [d for _, d, _ in sorted(rows)] for i, rows in found(lexical.search(docs, items)).items()}
    assert got == {1: [1, 3, 7, 9, None], 2: list(range(100, 120))}
