from odd import clashing, documents, none_of

from checks.compare import connect, difference
from stayline.llm import licenses
from stayline.llm.queries import oracle_sql, queries


def test_equals_sql(spark, tiny):
    assert difference(queries()["op1_license_scan"](spark, tiny), connect(tiny), oracle_sql()["op1_license_scan"]) is None


def scanned(spark, files):
    rows = licenses.scan(spark.createDataFrame(files, "path string, text string")).collect()
    return {r.path: (r.own_licence, r.licence, r.licence_from) for r in rows}


def test_the_nearest_directory_counts(spark):
    gpl, mit = "This work is licensed under the GNU General Public License, version 3.", "Released under the MIT License."
    found = scanned(
        spark,
        [
            ("/LICENSE", gpl),
            ("/a/b/LICENSE", mit),
            ("/a/x.py", "print(1)"),
            ("/a/b/c/y.py", "print(2)"),
            ("/a/bb/z.py", "print(3)"),
            ("/a/b/own.py", "some words of prose stand before it and many more follow\nLicensed under CC BY-NC 4.0.\nprint(4)"),
        ],
    )
    assert found["/a/x.py"] == (None, "GPL-3.0", "")
    assert found["/a/b/c/y.py"] == (None, "MIT", "/a/b")
    assert found["/a/bb/z.py"] == (None, "GPL-3.0", "")
    assert found["/a/b/own.py"] == ("CC-BY-NC-4.0", "CC-BY-NC-4.0", "/a/b/own.py")
    assert found["/LICENSE"][0] == "GPL-3.0"


def test_each_notice_is_itself_and_prose_is_nothing(spark):
    files = [(f"/{k}/f", f"lines before\n{text}\nlines after") for k, (_, text) in enumerate(licenses.NOTICES)]
    found = scanned(spark, [*files, ("/p/f", "members of the public may see the work of the museum in general\nrights and wrongs")])
    assert [found[f"/{k}/f"][0] for k in range(len(licenses.NOTICES))] == [name for name, _ in licenses.NOTICES]
    assert found["/p/f"] == (None, None, None)


def test_every_similar_segment_holds_a_key_term():
    idf, rows = licenses.notice_weights()
    keys = set(licenses.key_terms(0.6))
    for k in range(len(licenses.NOTICES)):
        light = sum(w * w for term, n, _, w in rows if n == k and term not in keys)
        assert light**0.5 < 0.6


def test_odd_rows(spark):
    files = licenses.document_paths(clashing(documents(spark)).drop("path"))
    rows = licenses.scan(files).collect()
    assert len(rows) == 10 and all(r.licence is None for r in rows)
    assert licenses.scan(licenses.document_paths(none_of(spark))).count() == 0
    more = spark.createDataFrame([(None, "Released under the MIT License."), ("/a", None), ("/a", None), ("b", "All rights reserved.")], "path string, text string")
    found = sorted((r.path or "", r.own_licence or "") for r in licenses.scan(clashing(more.withColumnRenamed("text", "t")).withColumnRenamed("t", "text").drop("path_")).collect())
    assert found == [("", ""), ("/a", ""), ("/a", ""), ("b", "Proprietary")]


def test_genuine_licence_files_cover_their_directories(spark):
    texts = dict(licenses.full_texts())
    holder = lambda text: text.replace("Copyright (c)", "Copyright (c) 2016-2019, Jane Roe and the frobnicate contributors. All rights reserved.")
    bsd = texts["BSD-3-Clause"]
    short = holder(bsd[: bsd.index("THIS SOFTWARE IS")]) + 'THIS SOFTWARE IS PROVIDED "AS IS" WITHOUT WARRANTY OF ANY KIND.\n'
    files = [(f"/{name}/LICENSE", holder(text)) for name, text in texts.items()] + [("/short/LICENSE", short), ("/two/COPYING", texts["GPL-3.0"] + "more"), ("/two/NOTICE", "All rights reserved.")]
    below = [(f"{path.rsplit('/', 1)[0]}/src/x.py", "print(1)") for path, _ in files]
    found = scanned(spark, files + below)
    for name in texts:
        assert found[f"/{name}/LICENSE"] == (name, name, f"/{name}/LICENSE")
        assert found[f"/{name}/src/x.py"] == (None, name, f"/{name}")
    assert found["/short/src/x.py"] == (None, "BSD-3-Clause", "/short") and found["/short/LICENSE"][0] == "BSD-3-Clause"
    assert found["/two/src/x.py"] == (None, "GPL-3.0", "/two") and found["/two/NOTICE"][0] == "Proprietary"
    assert {"MIT", "GPL-2.0", "GPL-3.0", "AGPL-3.0", "LGPL-3.0", "Apache-2.0", "MPL-2.0", "BSD-2-Clause", "BSD-3-Clause", "ISC"} <= set(texts)


def test_a_file_with_fewer_terms_is_not_similar_enough():
    _, rows = licenses.notice_weights(licenses.full_texts())
    for k, (words, least) in enumerate(licenses.least_terms(0.5)):
        parts = sorted((w * w for _, n, _, w in rows if n == k), reverse=True)
        assert len(words) == len(parts) and sum(parts[: least - 1]) < 0.25 <= sum(parts[:least]) + 1e-6


def test_a_file_of_very_many_lines_takes_time_in_proportion(spark):
    import time

    notice = "Licensed under the Apache License, Version 2.0"
    text = "\n".join([*(f"event {i} of the log was written at {i * 7919}" for i in range(100_000)), notice])
    files = spark.createDataFrame([("/log.txt", text)], "path string, text string")
    start = time.time()
    found = licenses.scan(files).collect()
    assert [r.own_licence for r in found] == ["Apache-2.0"] and time.time() - start < 60
