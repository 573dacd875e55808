import re
import shutil
import subprocess
import sys
from pathlib import Path

import corpus_pipeline
import pytest
from odd import clashing, documents, none_of

from stayline.llm.queries import oracle_sql, queries

ROOT = Path(__file__).resolve().parents[2]


@pytest.fixture(scope="module")
def steps(spark, tiny):
    """The input of every stage and its output, over the tiny documents and some odd ones."""
    docs = spark.read.parquet(f"{tiny}/documents.parquet").unionByName(
        spark.createDataFrame([(900_001, "12 34 !!", None, "src1", 8), (900_002, None, "en", "src2", 0), (900_003, 'with password: "Zx9kQ2vLr7Tn4" in it and words', "en", None, 40)], documents(spark).schema)
    )
    out = []
    for name, stage in corpus_pipeline.STAGES:
        result = stage(spark, docs, tiny).cache()
        out.append((name, docs, result))
        docs = result
    return out


def test_stages_keep_the_columns_and_drop_what_they_should(steps):
    names = [n for n, *_ in steps]
    assert names == ["language", "near_dedup", "decontaminate", "secrets", "mix"]
    for _, before, after in steps[:-1]:
        assert after.columns == before.columns and {f.name: f.dataType for f in after.schema} == {f.name: f.dataType for f in before.schema}
    ids = {n: ({r.doc_id for r in b.select("doc_id").collect()}, {r.doc_id for r in a.select("doc_id").collect()}) for n, b, a in steps}
    assert ids["language"][0] - ids["language"][1] == {900_001, 900_002}
    assert ids["near_dedup"][1] < ids["near_dedup"][0] and ids["decontaminate"][1] < ids["decontaminate"][0]
    assert ids["secrets"][0] == ids["secrets"][1] == ids["mix"][1]


def test_near_copies_leave_one_of_each_group(steps):
    from test_neardup import brute_force

    _, before, after = steps[1]
    groups = brute_force([(r.doc_id, r.text) for r in before.collect()], 5)
    assert {r.doc_id for r in after.collect()} == {c for _, c in groups.values()}


def test_secrets_are_gone(steps):
    _, before, after = steps[3]
    pattern = re.compile(r"(?i)(password|token)[\"']? *[:=] *[\"']?[A-Za-z0-9+/_.=-]{8,}")
    assert any(pattern.search(r.text) for r in before.collect()) and not any(pattern.search(r.text) for r in after.collect())


def test_run_equals_the_stages(spark, tiny):
    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, tiny)
    assert sorted(map(tuple, docs.collect())) == sorted(map(tuple, corpus_pipeline.run(spark, tiny).collect()))


def test_odd_and_empty_documents(spark, tiny):
    for docs in (clashing(documents(spark)), none_of(spark)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            after = stage(spark, docs, tiny)
            assert after.columns == docs.columns
            docs = after
        corpus_pipeline.STAGES[-1][1](spark, docs, tiny).count()


def test_every_query_is_registered():
    names = list(queries())
    assert [int(re.match(r"op(\d+)_", n)[1]) for n in names] == list(range(1, 14))
    assert set(oracle_sql()) <= set(names)


def test_the_rest_imports_without_this_package(tmp_path):
    for name in ("stayline", "checks", "__spark_entry__.py"):
        source = ROOT / name
        if source.is_dir():
            shutil.copytree(source, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
        else:
            shutil.copy(source, tmp_path / name)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'report_call_list' in q and not [n for n in q if n.startswith('op')]; assert set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, timeout=120)


def test_documents_without_any_label_all_stay(spark, tiny):
    rows = [(1, "some words", None, "a", 10), (2, "12 34", None, "a", 5), (None, None, None, None, None)]
    docs = spark.createDataFrame(rows, documents(spark).schema)
    assert sorted(map(str, corpus_pipeline.language(spark, docs, tiny).collect())) == sorted(map(str, docs.collect()))
