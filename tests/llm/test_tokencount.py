import random

import public_tokenizers
import pytest
from odd import clashing, documents, none_of
from tokenizers import Tokenizer

from stayline.llm import tokencount

PATH = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string"


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda text: len(tokenizer.encode(text, add_special_tokens=False).ids)


def test_every_plain_character_is_counted_as_the_library_does(library):
    counter = tokencount.TokenCounter(PATH, {})
    for first, last in tokencount.PLAIN:
        for start in range(first, last + 1, 64):
            for probe in (f"a{c}b{c}{c}1{c}.{c}'s" for c in map(chr, range(start, min(start + 64, last + 1)))):
                assert counter.count(probe) == library(probe), ascii(probe)


def test_random_texts_of_all_planes(library):
    draw = random.Random(5)
    alphabet = [*"abcXYZ'sdm019 \n\t.,<|>_-é̂ßİΣσς가각ㄱ漢字가́ǅ\u0085 ​ \x1c﻿😀👩‍🚀", "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "'ll", "fi", "K"]
    counter = tokencount.TokenCounter(PATH, {"abc": library("abc")})
    for _ in range(3000):
        text = "".join(draw.choices(alphabet, k=draw.randint(0, 40)))
        assert counter.count(text) == library(text), ascii(text)


def test_long_texts_are_sliced_at_white_space_and_the_cache_stays_bounded(library, monkeypatch):
    monkeypatch.setattr(tokencount, "SLICE_CHARS", 50)
    monkeypatch.setattr(tokencount, "CACHED", 10)
    counter = tokencount.TokenCounter(PATH, {"and": 1})
    text = " ".join(f"word{i} and é{i}, 漢😀{i}" + "x" * (i % 90) for i in range(300))
    assert counter.count(text) == library(text) and counter.count(text) == library(text)
    assert len(counter.cache) <= 11 and counter.cache.frequent == {"and": 1}


def test_whole_table(spark, tiny, library):
    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    found = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in tokencount.count_tokens(docs, PATH).collect()}
    for r in docs.collect():
        n = library(r.text or "")
        assert found[r.doc_id] == (len((r.text or "").encode()), n, n > 2048)


def test_no_pre_token_is_shuffled(spark, tiny):
    plan = tokencount.count_tokens(spark.read.parquet(f"{tiny}/documents.parquet"), PATH)._jdf.queryExecution().toString()
    assert "Exchange" not in plan.split("== Physical Plan ==")[1]


def test_odd_and_empty_documents(spark, library):
    rows = documents(spark)
    expected = sorted((str(r.doc_id), len((r.text or "").encode()), library(r.text or "")) for r in rows.collect())
    for docs in (rows, clashing(rows)):
        found = tokencount.count_tokens(docs, PATH)
        assert found.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
        assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in found.collect()) == expected
    assert tokencount.count_tokens(none_of(spark), PATH).count() == 0


def test_another_kind_of_tokenizer_is_refused(tmp_path):
    with pytest.raises(ValueError):
        tokencount.split_pattern(public_tokenizers.path("byte_bpe_50k.json"))
