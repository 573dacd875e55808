"""The registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from stayline.llm import (
    ann,
    chat,
    decontaminate,
    htmltext,
    langid,
    lexical,
    licenses,
    mixing,
    neardup,
    ngrams,
    repair,
    secrets,
    tokencount,
)
from stayline.llm.store import documents


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(licenses.document_paths(documents(spark, sf_dir)))


OP1_SQL = r"""
WITH notices AS (SELECT * FROM (VALUES __NOTICES__) AS t(notice, licence, words)),
nt AS (
  SELECT notice, licence, term, 1 + ln(count(*)) AS tf
  FROM (SELECT notice, licence, unnest(regexp_extract_all(lower(words), '__TERM__')) AS term FROM notices)
  WHERE term NOT IN (__STOPS__) GROUP BY ALL
), idf AS (
  SELECT term, ln((1 + (SELECT count(*) FROM notices)) / (1 + count(*))) + 1 AS idf FROM nt GROUP BY term
), parts AS (
  SELECT notice, licence, term, tf * idf / sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY notice)) AS part FROM nt JOIN idf USING (term)
), files AS (
  SELECT doc_id, text, '/' || CASE WHEN rtrim(doc_id::VARCHAR, '0') = '' THEN ''
    ELSE array_to_string(string_split(rtrim(doc_id::VARCHAR, '0'), ''), '/') || '/' END || doc_id::VARCHAR || '.txt' AS path FROM documents
), cuts AS (
  SELECT DISTINCT doc_id, whole, seg FROM (
    SELECT doc_id, false AS whole, unnest(string_split(text, chr(10))) AS seg FROM files
    UNION ALL SELECT doc_id, false, unnest(regexp_split_to_array(text, '\n[\x20\t\r]*\n')) FROM files
    UNION ALL SELECT doc_id, true, text FROM files)
), tf AS (
  SELECT doc_id, whole, seg, term, 1 + ln(count(*)) AS tf
  FROM (SELECT doc_id, whole, seg, unnest(regexp_extract_all(lower(seg), '__TERM__')) AS term FROM cuts)
  WHERE term NOT IN (__STOPS__) GROUP BY ALL
), w AS (
  SELECT tf.*, tf * coalesce(idf, ln(1 + (SELECT count(*) FROM notices)) + 1) AS weight FROM tf LEFT JOIN idf USING (term)
), n AS (
  SELECT doc_id, whole, seg, sqrt(sum(weight * weight)) AS norm FROM w GROUP BY ALL
), d AS (
  SELECT doc_id, whole, seg, notice, licence, sum(weight * part) AS dot FROM w JOIN parts USING (term) GROUP BY ALL
), s AS (
  SELECT d.doc_id, d.whole, d.licence, round(dot / norm, 6) AS score
  FROM d JOIN n ON d.doc_id = n.doc_id AND d.whole = n.whole AND d.seg = n.seg
), own AS (
  SELECT doc_id, licence, score FROM s WHERE score >= 0.6 QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, licence) = 1
), whole AS (
  SELECT doc_id, licence, score FROM s WHERE whole AND score >= 0.5 QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, licence) = 1
), placed AS (SELECT doc_id, path, regexp_extract(path, '^(.*)/[^/]*$', 1) AS dir FROM files
), covering AS (
  SELECT dir AS above, licence FROM whole JOIN placed USING (doc_id) QUALIFY row_number() OVER (PARTITION BY dir ORDER BY score DESC, licence) = 1
), up AS (
  SELECT p.doc_id, above, licence FROM placed p JOIN covering c ON p.dir = c.above OR starts_with(p.dir, c.above || '/')
  QUALIFY row_number() OVER (PARTITION BY p.doc_id ORDER BY length(above) DESC) = 1
)
SELECT p.doc_id, p.path, coalesce(own.licence, whole.licence) AS own_licence, coalesce(own.score, whole.score) AS own_score,
  coalesce(own.licence, whole.licence, up.licence) AS licence,
  CASE WHEN own.licence IS NOT NULL OR whole.licence IS NOT NULL THEN p.path ELSE up.above END AS licence_from
FROM placed p LEFT JOIN own USING (doc_id) LEFT JOIN whole ON whole.doc_id = p.doc_id LEFT JOIN up ON up.doc_id = p.doc_id
"""


def op2_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(documents(spark, sf_dir))


OP2_SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents
), p AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS nth
  FROM d GROUP BY source
), w AS (
  SELECT *, [5, 2, 1][nth % 3 + 1]::BIGINT AS weight, 3 * source_size AS capacity FROM p
), f AS (
  SELECT *, row_number() OVER (ORDER BY capacity / weight, nth) AS place FROM w
), l AS (
  SELECT a.place, (SELECT sum(source_size) FROM w) - coalesce((SELECT sum(capacity) FROM f b WHERE b.place < a.place), 0) AS rest,
    (SELECT sum(weight) FROM f b WHERE b.place >= a.place) AS share_by, a.weight, a.capacity
  FROM f a
), v AS (
  SELECT rest, share_by FROM l WHERE rest * weight <= capacity * share_by ORDER BY place LIMIT 1
), t AS (
  SELECT source, source_size, least(v.rest::DOUBLE * weight / v.share_by::DOUBLE, capacity::DOUBLE) AS target FROM w, v
), o AS (
  SELECT d.*, t.source_size, t.target,
    sum(size) OVER (PARTITION BY d.source ORDER BY md5(doc_id::VARCHAR), doc_id, size ROWS UNBOUNDED PRECEDING) - size AS before
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, source, size::BIGINT AS size, source_size, target, (
  greatest(0, least(before + size, floor(target)) - before)
  + greatest(0, least(source_size + before + size, floor(target)) - (source_size + before))
  + greatest(0, least(2 * source_size + before + size, floor(target)) - (2 * source_size + before)))::BIGINT AS taken
FROM o
"""


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return secrets.scan(docs, secrets.fit(secrets.corpus_samples(docs)))


ESCAPES = r"\### Assistant: </turn> ok"


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-7, 0, "user", ESCAPES), (-7, 1, "assistant", ESCAPES)], turns.schema)
    return chat.read_back(chat.format_windows(turns.unionByName(probe)))


def op5_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.leaks(documents(spark, sf_dir), items).drop("doc_key")


def op6_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op7_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngrams.score_documents(documents(spark, sf_dir))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = langid.fit(docs.where(~langid.held_out()))
    found = langid.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score")


def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(documents(spark, sf_dir), size=4)


def op10_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return htmltext.main_texts(pages, htmltext.fit(htmltext.labelled_pages()))


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.count_tokens(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair(repair.damaged(spark.read.parquet(f"{sf_dir}/conversations.parquet")))


# The search as a walk over all states, row by row. An insertion costs more than deleting the row that
# stands alone without it, so the cheapest edits have none.
OP12_SQL = r"""
WITH RECURSIVE bits AS (
  SELECT list_transform(range(256), lambda x: list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, x)) AS t
), src AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name FROM conversations
), faults AS (
  SELECT src.*, xor(list_reduce(list_transform(range(1, length(name) + 1), lambda i: ascii(name[i])::BIGINT),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) % 20 AS fault
  FROM src, bits
), damaged AS (
  SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN fault = 1 THEN '' WHEN fault = 2 THEN translate(text, '.!?', '') ELSE text END AS text, copy
  FROM faults, (VALUES (1), (2)) AS c(copy) WHERE fault <> 0 AND (copy = 1 OR fault = 3)
), placed AS (
  SELECT *, md5(length(role)::VARCHAR || ':' || role || text) AS key, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS trimmed,
    CASE WHEN left(role, 1) IN ('s', 'u', 'a') THEN left(role, 1) ELSE 'o' END AS initial
  FROM damaged
), marked AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, key, copy) AS i,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS seen
  FROM placed
), r AS (
  SELECT *, trimmed = '' AS blank, trimmed <> '' AND seen > 1 AS duplicate,
    trimmed <> '' AND seen = 1 AND right(trimmed, 1) NOT IN ('.', '!', '?') AS truncated,
    initial || lead(initial) OVER (PARTITION BY conv_id ORDER BY i) AS pair
  FROM marked
), sums AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, count(*) FILTER (blank) AS blank,
    count(*) FILTER (duplicate) AS duplicate, count(*) FILTER (truncated) AS truncated,
    count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
  FROM r GROUP BY conv_id
), moves AS (SELECT * FROM (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)) AS m(p, role, q)
), edits AS (
  SELECT conv_id, i, p, p AS q, 2 AS price, 'D' AS edit FROM r, range(4) AS s(p)
  UNION ALL SELECT conv_id, i, p, q, 5 * truncated::INT, 'K' FROM r JOIN moves ON moves.role = r.initial WHERE NOT blank AND NOT duplicate
  UNION ALL SELECT conv_id, i, p, q, 1 + 5 * truncated::INT, 'R' FROM r, moves WHERE moves.role <> 's' AND NOT blank AND NOT duplicate
), walk AS (
  SELECT conv_id, 0::BIGINT AS i, 0::BIGINT AS q, lpad('', 12, '0') AS label FROM sums
  UNION ALL
  SELECT w.conv_id, e.i, e.q, min(lpad((left(w.label, 12)::BIGINT + e.price)::VARCHAR, 12, '0') || substr(w.label, 13) || e.edit)
  FROM walk w JOIN edits e ON w.conv_id IS NOT DISTINCT FROM e.conv_id AND e.i = w.i + 1 AND e.p = w.q GROUP BY w.conv_id, e.i, e.q
), best AS (
  SELECT w.conv_id, min(label) AS label FROM walk w JOIN sums s ON w.conv_id IS NOT DISTINCT FROM s.conv_id
  WHERE w.i = s.n AND w.q IN (0, 3) GROUP BY w.conv_id
), kept AS (
  SELECT r.conv_id, r.i, r.role, r.text, substr(b.label, 12 + r.i::INT, 1) AS edit, r.initial,
    sum(CASE WHEN substr(b.label, 12 + r.i::INT, 1) = 'K' AND r.initial = 's' THEN 0 ELSE 1 END) OVER (PARTITION BY r.conv_id ORDER BY r.i) AS nth
  FROM r JOIN best b ON r.conv_id IS NOT DISTINCT FROM b.conv_id WHERE substr(b.label, 12 + r.i::INT, 1) <> 'D'
), said AS (
  SELECT conv_id, string_agg(CASE WHEN edit = 'K' THEN role WHEN nth % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text, chr(10) ORDER BY i) AS repaired
  FROM kept GROUP BY conv_id
), every AS (SELECT DISTINCT conv_id FROM conversations)
SELECT e.conv_id, coalesce(s.gaps, 0) AS gaps, coalesce(s.blank, 0) AS blank, coalesce(s.duplicate, 0) AS duplicate, coalesce(s.truncated, 0) AS truncated,
  coalesce(s.illegal, 0) AS illegal, coalesce(left(b.label, 12)::BIGINT, 0) AS cost, coalesce(substr(b.label, 13), '') AS audit,
  sha256(coalesce(k.repaired, '')) AS repaired_sha256
FROM every e LEFT JOIN sums s ON e.conv_id IS NOT DISTINCT FROM s.conv_id LEFT JOIN best b ON e.conv_id IS NOT DISTINCT FROM b.conv_id
LEFT JOIN said k ON e.conv_id IS NOT DISTINCT FROM k.conv_id
"""


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


OP13_SQL = r"""
WITH words AS (
  SELECT doc_id, row_number() OVER () AS doc, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '__TERM__') AS terms
  FROM documents
), sizes AS (SELECT doc, doc_id, len(terms)::BIGINT AS n FROM words WHERE len(terms) > 0
), totals AS (SELECT count(*) AS docs, sum(n)::BIGINT AS every FROM sizes
), tf AS (SELECT doc, term, count(*) AS tf FROM (SELECT doc, unnest(terms) AS term FROM words) GROUP BY ALL
), w AS (SELECT term, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM tf, totals GROUP BY term, docs
), asked AS (
  SELECT item_id, term, count(*) AS times FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '__TERM__')) AS term
    FROM (SELECT DISTINCT item_id, text FROM benchmark)) GROUP BY ALL
), scored AS (
  SELECT item_id, doc_id, doc, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // every))))::BIGINT AS score
  FROM asked JOIN w USING (term) JOIN tf USING (term) JOIN sizes USING (doc), totals GROUP BY item_id, doc_id, doc
)
SELECT item_id, rank, doc_id, score FROM (
  SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INT AS rank FROM scored WHERE score > 0
) WHERE rank <= 20
"""
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (
            op1_license_scan,
            op2_source_mix,
            op3_secret_scan,
            op4_chat_format,
            op5_benchmark_leaks,
            op6_nearest_vectors,
            op7_lm_score,
            op8_language_id,
            op9_minhash_near_dedup,
            op10_main_text,
            op11_token_counts,
            op12_conversation_repair,
            op13_ranked_search,
        )
    }


def oracle_sql() -> dict[str, str]:
    notices = ", ".join(f"({k}, '{name}', '{words}')" for k, (name, words) in enumerate(licenses.NOTICES))
    op1 = OP1_SQL.replace("__NOTICES__", notices).replace("__TERM__", licenses.TERM)
    op1 = op1.replace("__STOPS__", ", ".join(f"'{w}'" for w in licenses.STOP_WORDS))
    return {
        "op1_license_scan": op1,
        "op2_source_mix": OP2_SQL,
        "op12_conversation_repair": OP12_SQL,
        "op13_ranked_search": OP13_SQL.replace("__TERM__", TERM),
    }
