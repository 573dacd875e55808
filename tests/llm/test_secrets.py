import hashlib
import random
import re

import pytest
from odd import clashing, documents, none_of

from stayline.llm import secrets


@pytest.fixture(scope="module")
def ratio(spark, tiny):
    return secrets.fit(secrets.corpus_samples(spark.read.parquet(f"{tiny}/documents.parquet")))


def plain_spans(text):
    """The contract's patterns, one by one, unoptimised."""
    assign = re.compile(r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    out = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[1]) >= 8]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 32]
    return [(k, a, b) for a, k, b in sorted(out)]


def test_patterns_equal_the_plain_ones():
    draw = random.Random(2)
    parts = ["token", "API_KEY", "ApiKey", "secret", "paſſword", "toKen", " ", "  ", ":", "=", '"', "'", "AKIA", "AKIAX", "0f" * 16, "0f" * 15, "ABCDEFGHIJKL", "x.y=z", "é", "\n", "abcdefgh", "1234567"]
    for _ in range(5000):
        text = "".join(draw.choices(parts, k=draw.randint(1, 12)))
        assert secrets.base_spans(text) == plain_spans(text), text


def test_random_strings_are_found_and_words_are_not(ratio, spark):
    draw = random.Random(8)
    keys = secrets.random_samples(400, seed=99)
    words = ["internationalisation_of_everything", "get_user_account_by_identifier", "https//example/org/the/long/path/of/words", "Donaudampfschifffahrtsgesellschaft", "------------------------------", "====================", "thereoningationthatwhichis", "20240131-20240229-20240331"]
    rows = [(i, f"prose {k} more") for i, k in enumerate(keys)] + [(1000 + i, f"prose {w} more") for i, w in enumerate(words)]
    draw.shuffle(rows)
    found = {r.doc_id: r for r in secrets.scan(spark.createDataFrame(rows, "doc_id long, text string"), ratio).collect()}
    long = [i for i, k in enumerate(keys) if len(k) >= 24]
    assert sum(bool(found[i].spans) for i in long) >= 0.97 * len(long)
    assert [words[i - 1000] for i in found if i >= 1000 and found[i].spans] == []


def test_digest_and_spans(spark, ratio):
    text = 'é token = "abcdefgh1" and AKIA1234567890AB, ' + "0f" * 16
    row = secrets.scan(spark.createDataFrame([(1, text)], "doc_id long, text string"), ratio).first()
    assert (row.n_assign, row.n_access, row.n_hex) == (1, 1, 1)
    want = ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for k, a, b in plain_spans(text))
    assert row.spans == want and row.base_sha256 == hashlib.sha256(want.encode()).hexdigest()


def test_redaction_takes_the_secrets_and_nothing_else(spark, ratio):
    text = 'before token: "Zx9kQ2vLr7Tn4Wb8" after AKIA1234567890ABCD end'
    docs = clashing(spark.createDataFrame([(1, text), (2, "plain words"), (3, None)], "doc_id long, text string"))
    out = secrets.redact(docs, ratio)
    assert out.schema == docs.schema
    assert {r.doc_id: r.text for r in out.collect()} == {1: 'before [assign]" after [access] end', 2: "plain words", 3: None}


def test_odd_rows(spark, ratio):
    rows = secrets.scan(clashing(documents(spark)), ratio).collect()
    assert len(rows) == 10 and all(r.spans == "" for r in rows)
    assert secrets.redact(documents(spark), ratio).count() == 10
    assert secrets.scan(none_of(spark), secrets.fit(secrets.corpus_samples(none_of(spark)))).count() == 0


def test_labels_other_than_0_and_1_are_left_out(spark):
    rows = [("abab", 0), ("zqzq", 1), (None, 1), ("cccc", None), ("cccc", 7)]
    ratio = secrets.fit(spark.createDataFrame(rows, "text string, label int"))
    assert ratio[0, 1] < 0 < ratio[25, 16] and ratio[2, 2] == pytest.approx(ratio[2, 3])


def test_short_keys_and_letters_alone(ratio, spark):
    draw = random.Random(21)
    letters, both = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    keys = [("".join(draw.choices(a, k=n)), (len(a), n)) for a in (letters, both) for n in (16, 17, 19, 24) for _ in range(100)]
    plain = "getUserAccountByIdentifier HttpServletRequestWrapper MAXIMUM_NUMBER_OF_RETRIES electroencefalografista Kraftfahrzeughaftpflichtversicherung AbstractSingletonProxyFactoryBean usr/local/lib/python/site".split()
    rows = [(i, f"prose {k} more") for i, (k, _) in enumerate(keys)] + [(5000 + i, f"prose {w} more") for i, w in enumerate(plain)]
    found = {r.doc_id: r.spans for r in secrets.scan(spark.createDataFrame(rows, "doc_id long, text string"), ratio).collect()}
    for kind in {k for _, k in keys}:
        mine = [i for i, (_, k) in enumerate(keys) if k == kind]
        assert sum(found[i] == f"markov:6:{6 + kind[1]}" for i in mine) >= (0.97 if kind[0] == 62 else 0.75) * len(mine), kind
    assert [plain[i - 5000] for i in found if i >= 5000 and found[i]] == []


def test_what_a_run_holds_beside_a_pattern_is_judged_by_itself(ratio, spark):
    key, hexed = "q7Zx9kQ2vLr7Tn4Wb8Xy", "0f1e2d3c" * 4
    rows = [(1, f"x {hexed}_{key} y"), (2, f"x {key}_{hexed} y"), (3, f"x {hexed}_of_everything y"), (4, f"x {hexed} y"), (5, f"x {hexed}_{key}_{hexed}_{key[::-1]} y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    spans = {r.doc_id: r.spans.split(",") for r in secrets.scan(docs, ratio).collect()}
    assert spans[1] == ["hex:2:34", "markov:34:55"] and spans[2] == ["markov:2:23", "hex:23:55"]
    assert spans[3] == spans[4] == ["hex:2:34"] and [s.split(":")[0] for s in spans[5]] == ["hex", "markov", "hex", "markov"]
    assert all(key not in r.text and key[::-1] not in r.text for r in secrets.redact(docs, ratio).collect())
