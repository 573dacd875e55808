import re
from collections import defaultdict

from odd import clashing, documents, none_of

from stayline.llm.decontaminate import decontaminate, leaks, tokens
from stayline.llm.words import pieces

ITEM = "A train leaves the station near Boston at 60 mph and after 3 hours the driver Alice meets another train near Boston again."
ITEMS = [(1, ITEM), (2, "short words only here"), (3, None), (None, "an item without an id should never be found at all"), (4, "Every one of these nine words stays exactly itself")]
CLEAN = "a sentence of ordinary words that says nothing about the questions in any benchmark at all"


def found(spark, texts, items=ITEMS):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {(r.doc_id, r.item_id): r.reparameterised for r in leaks(docs, spark.createDataFrame(items, "item_id long, text string")).collect()}


def test_other_numbers_names_and_units_are_found(spark):
    changed = ITEM.replace("60", "75").replace("mph", "kmh").replace("3 hours", "4 days").replace("Alice", "Peter").replace("Boston", "Denver")
    texts = [f"{CLEAN} {ITEM} {CLEAN}", f"{CLEAN}\n{changed} {CLEAN}", ITEM.upper(), re.sub(r"(\w+)", r"\1***", ITEM), CLEAN, "", None]
    assert found(spark, texts) == {(0, 1): False, (1, 1): True, (2, 1): False, (3, 1): False} or found(spark, texts) == {(0, 1): False, (1, 1): True, (3, 1): False}


def test_values_must_change_consistently(spark):
    item = [(1, "we saw Boston and then Boston and then Boston and then Boston and more")]
    same = "we saw Denver and then Denver and then Denver and then Denver and more"
    mixed = "we saw Denver and then Austin and then Dallas and then Tucson and more"
    assert found(spark, [same, mixed], item) == {(0, 1): True}


def test_short_items_and_parts(spark):
    texts = ["Every one of these nine words stays exactly itself", "one of these nine words stays exactly", "short words only here", "x Every one of these nine words stays exactly y"]
    assert set(found(spark, texts)) == {(0, 4)} | ({(3, 4)} if (3, 4) in found(spark, texts) else set())
    assert (2, 2) not in found(spark, texts)  # fewer than five tokens are not searched for
    five = [(9, "just five plain words here")]
    assert set(found(spark, ["so just five plain words here then", "just five plain words"], five)) == {(0, 9)}


def test_equals_word_windows_where_nothing_is_a_slot(spark, tiny):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{tiny}/documents.parquet").collect()}
    items = {r.item_id: r.text for r in spark.read.parquet(f"{tiny}/benchmark.parquet").collect()}

    def windows(text):
        words = [w.lower().strip(".,!#$%&*|-?") for w in text.split()]
        words = [w for w in words if w]
        return {tuple(words[i : i + 8]) for i in range(len(words) - 7)}

    index = defaultdict(set)
    for i, text in items.items():
        for w in windows(text):
            index[w].add(i)
    want = set()
    for d, text in docs.items():
        hits = defaultdict(int)
        for w in windows(text):
            for i in index[w]:
                hits[i] += 1
        want |= {(d, i) for i, n in hits.items() if n >= 3}
    frames = [spark.read.parquet(f"{tiny}/{t}.parquet") for t in ("documents", "benchmark")]
    assert {(r.doc_id, r.item_id) for r in leaks(*frames).collect()} == want and want


def test_removal_keeps_the_others(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    docs = clashing(documents(spark).unionByName(spark.createDataFrame([(None, ITEM, "en", "a", 1), (70, ITEM, "en", "a", 1)], documents(spark).schema)))
    kept = decontaminate(docs, items)
    assert kept.schema == docs.schema and sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in documents(spark).collect())
    assert decontaminate(none_of(spark), items).count() == 0
    assert decontaminate(docs, items.limit(0)).count() == 12


def test_tokens():
    import pyarrow as pa

    template, value, slot, text = tokens(next(pieces(pa.array(["He met Anna in 2020. Then 5 kg, in É x", "ANNA!! met"]))))
    assert slot.tolist() == [False, False, True, False, True, False, True, True, False, False, False, False, False]
    assert text.tolist() == [0] * 11 + [1, 1]
    assert template[1] == template[12] and value[2] == template[11]


def test_items_of_few_plain_words_are_found_as_they_are(spark):
    items = [(1, "Compute 12 + 45 - 7 * 3 + 99 - 18 + 4"), (2, "Anna Smith paid 20 dollars, Bob Jones paid 30 dollars"), (3, "What is 12 + 30?"), (4, "Add 5 kg to 7 kg")]
    for i, text in items:
        other = text.translate(str.maketrans("0123456789", "1234567890"))
        want = {(d, i): False for d in (0, 1, 2)}
        got = found(spark, [text, f"{CLEAN} {text} {CLEAN}", f"Q1) {text}", other, CLEAN], items)
        assert got == want, (text, got)


def test_the_first_word_may_be_a_word_or_a_name(spark):
    items = [(1, "What is the sum of 12 and 45"), (2, "Anna has a bag of 12 red apples")]
    texts = ["Q1) What is the sum of 12 and 45", ", What is the sum of 13 and 44", "Now Peter has a bag of 7 red apples", "Peter has a bag of 7 red apples", "it is the sum of 12 and 45"]
    assert found(spark, texts, items) == {(0, 1): False, (1, 1): True, (2, 2): True, (3, 2): True}


def test_a_bare_value_is_no_item(spark):
    assert found(spark, ["the year 2020 was long", "2020"], [(1, "2020"), (2, "yes")]) == {}
