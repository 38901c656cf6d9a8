"""One query for each operator, on its whole table, and comparison SQL where SQL can say it."""

from __future__ import annotations

import corpus_pipeline
from cohortloom.llm import (
    divergence,
    gru_lm,
    jaccard_join,
    langid,
    packing,
    permuterm,
    piece_spans,
    pivot_index,
    repair_store,
    suffix_repeats,
    wrappers,
    wu_manber,
    zstd_quality,
)
from cohortloom.llm.text import lower_sql, table

QUERIES, ORACLES = {}, {}

QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL


def query(name, sql=None):
    def register(build):
        QUERIES[name] = build
        if sql:
            ORACLES[name] = sql
        return build

    return register


@query(
    "op10_decontaminate",
    f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all({lower_sql("text")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), []) AS w FROM documents),
b AS (SELECT item_id, coalesce(regexp_extract_all({lower_sql("text")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), []) AS w FROM benchmark),
p AS (SELECT item_id, least(10, len(w)) AS k, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM b WHERE len(w) > 0),
pattern AS (SELECT DISTINCT item_id, k, array_to_string(w[i : i + k - 1], ' ') AS win FROM p),
sizes AS (SELECT DISTINCT k FROM pattern),
place AS (SELECT r, k, w, unnest(range(1, len(w) - k + 2)) AS i FROM d, sizes WHERE len(w) >= k),
win AS (SELECT r, k, i, array_to_string(w[i : i + k - 1], ' ') AS win FROM place),
hit AS (SELECT r, item_id, k, i FROM win JOIN pattern USING (k, win)),
words AS (SELECT r, count(DISTINCT j) AS n_hit FROM (SELECT r, unnest(range(i, i + k)) AS j FROM (SELECT DISTINCT r, k, i FROM hit)) GROUP BY r),
items AS (SELECT r, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids FROM hit GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r)
""",
)
def op10(spark, folder):
    return wu_manber.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op7_pack")
def op7(spark, folder):
    return packing.packed(table(spark, folder, "documents"))


@query("op4_token_shards")
def op4(spark, folder):
    return repair_store.read_documents(repair_store.write_shards(table(spark, folder, "documents")))


@query("op6_quality")
def op6(spark, folder):
    return zstd_quality.quality(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op8_language")
def op8(spark, folder):
    return langid.languages_of(table(spark, folder, "documents"))


@query("op9_vector_duplicates")
def op9(spark, folder):
    return pivot_index.near_duplicates(table(spark, folder, "embeddings"))


@query(
    "op2_repeated_passages",
    """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
w AS (SELECT r, i, md5(substr(x, 2 * i + 1, 400)) AS m FROM (SELECT r, x, unnest(range(0, len(x) // 2 - 199)) AS i FROM d WHERE len(x) >= 400)),
again AS (SELECT m FROM w GROUP BY m HAVING count(*) > 1),
hit AS (SELECT r, i, CASE WHEN i <= lag(i) OVER (PARTITION BY r ORDER BY i) + 200 THEN 0 ELSE 1 END AS fresh FROM w SEMI JOIN again USING (m)),
run AS (SELECT r, min(i) AS a, max(i) + 200 AS b FROM (SELECT r, i, sum(fresh) OVER (PARTITION BY r ORDER BY i) AS k FROM hit) GROUP BY r, k),
part AS (SELECT r, a, b, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS before FROM run),
gone AS (SELECT r, sum(b - a) AS n, count(*) AS k, max(b) AS last, string_agg(substr(x, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS head FROM part JOIN d USING (r) GROUP BY r)
SELECT doc_id, CAST(len(x) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n, 0) AS BIGINT) AS n_removed, CAST(coalesce(k, 0) AS BIGINT) AS n_spans,
       sha256(unhex(coalesce(head, '') || substr(x, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN gone USING (r)
""",
)
def op2(spark, folder):
    return suffix_repeats.removed(table(spark, folder, "documents"))


@query(
    "op3_jaccard_join",
    f"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all({lower_sql("text")}, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
s AS (SELECT r, unnest(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE [array_to_string(w[i : i + 4], ' ') FOR i IN range(1, len(w) - 3)] END)) AS g FROM d),
n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
p AS (SELECT a.r AS x, b.r AS y, count(*) AS i FROM s AS a JOIN s AS b ON a.g = b.g AND a.r < b.r GROUP BY ALL),
e AS (SELECT x, y FROM p JOIN n AS nx ON nx.r = x JOIN n AS ny ON ny.r = y WHERE 100 * i >= 80 * (nx.n + ny.n - i)),
both_ways AS (SELECT x AS a, y AS b FROM e UNION SELECT y, x FROM e),
reach(a, b) AS (SELECT r, r FROM d UNION SELECT reach.a, both_ways.b FROM reach JOIN both_ways ON reach.b = both_ways.a)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id
FROM d LEFT JOIN n USING (r) JOIN (SELECT a AS r, min(t.doc_id) AS component_id FROM reach JOIN d AS t ON t.r = reach.b GROUP BY a) USING (r)
""",
)
def op3(spark, folder):
    return jaccard_join.similar(table(spark, folder, "documents"))


@query("op1_lm_score")
def op1(spark, folder):
    return gru_lm.likelihood(table(spark, folder, "documents"))


@query("op5_main_text")
def op5(spark, folder):
    return wrappers.main_texts(table(spark, folder, "pages"))


@query("op11_piece_spans")
def op11(spark, folder):
    return piece_spans.digests(table(spark, folder, "documents"))


@query(
    "op12_spelling_groups",
    f"""
WITH RECURSIVE crc AS (
  SELECT i, list_reduce([CAST(i AS UBIGINT), 0, 0, 0, 0, 0, 0, 0, 0], lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, CAST(3988292384 AS UBIGINT)) ELSE a >> 1 END) AS v
  FROM range(256) AS t(i)),
runs AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, unnest(regexp_extract_all({lower_sql("text")}, '[A-Za-zÀ-ÿ]+')) AS w FROM documents),
pairs AS (SELECT id, w, count(*) AS n, hex(encode(id || ':' || w)) AS x FROM runs GROUP BY ALL),
step(id, w, n, x, k, c) AS (
  SELECT id, w, n, x, 0, CAST(4294967295 AS UBIGINT) FROM pairs
  UNION ALL
  SELECT id, w, n, x, k + 1, xor(c >> 8, v) FROM step JOIN crc ON i = xor(c, CAST('0x' || substr(x, 2 * k + 1, 2) AS UBIGINT)) & 255 WHERE 2 * k < len(x)),
sums AS (SELECT w, n, xor(c, CAST(4294967295 AS UBIGINT)) AS h FROM step WHERE 2 * k = len(x)),
made AS (SELECT CASE WHEN h % 199 = 0 THEN substr(w, 1, CAST(h % len(w) AS BIGINT)) || substr(w, CAST(h % len(w) AS BIGINT) + 2) ELSE w END AS word, n FROM sums),
words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM made WHERE len(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
cut AS (SELECT word, n, i, substr(word, 1, i) AS a, substr(word, i + 2) AS b FROM (SELECT word, n, unnest(range(len(word))) AS i FROM words)),
one AS (
  SELECT x.word, y.word AS near FROM cut AS x JOIN cut AS y ON x.i = y.i AND x.a = y.a AND x.b = y.b AND x.word != y.word
  UNION SELECT cut.word, words.word FROM cut JOIN words ON words.word = a || b
  UNION SELECT words.word, cut.word FROM cut JOIN words ON words.word = a || b),
ranked AS (SELECT one.word, near, v.n AS near_n, w.n, row_number() OVER (PARTITION BY one.word ORDER BY v.n DESC, near) AS k, count(*) OVER (PARTITION BY one.word) AS n_near
           FROM one JOIN words AS v ON v.word = near JOIN words AS w ON w.word = one.word),
form AS (SELECT word, near AS form, near_n AS form_n FROM ranked WHERE k = 1 AND near_n >= 5 * n),
chain(word, spot) AS (SELECT word, word FROM words UNION ALL SELECT chain.word, form.form FROM chain JOIN form ON form.word = spot),
ends AS (SELECT chain.word, spot AS root FROM chain ANTI JOIN form ON form.word = spot)
SELECT words.word, form, root, words.n, CAST(coalesce(n_near, 0) AS BIGINT) AS n_near, form_n
FROM words JOIN ends USING (word) LEFT JOIN form USING (word) LEFT JOIN (SELECT word, n_near FROM ranked WHERE k = 1) USING (word)
""",
)
def op12(spark, folder):
    return permuterm.spelling_groups(table(spark, folder, "documents"))


@query(
    "op13_source_divergence",
    f"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  regexp_extract_all({lower_sql("coalesce(text, '')")}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
t AS (SELECT r, lang, source, unnest(w) AS term FROM d),
kept AS (SELECT lang, term FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= 10),
c AS (SELECT lang, source, term, CAST(count(*) AS HUGEINT) AS n FROM t SEMI JOIN kept USING (lang, term) GROUP BY ALL),
g AS (SELECT DISTINCT lang, source FROM d),
full_g AS (SELECT lang, source, term, coalesce(n, 0) AS n FROM g JOIN kept USING (lang) LEFT JOIN c USING (lang, source, term)),
p AS (SELECT *, 1 + (1000000000 * (n + 2)) // (sum(n) OVER (PARTITION BY lang, source) + 2 * count(*) OVER (PARTITION BY lang, source)) AS p FROM full_g),
whole AS (SELECT lang, term, sum(n) AS n FROM c GROUP BY ALL),
q AS (SELECT lang, term, 1 + (1000000000 * (n + 2)) // (sum(n) OVER (PARTITION BY lang) + 2 * count(*) OVER (PARTITION BY lang)) AS q FROM whole),
sums AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
         FROM p AS a JOIN p AS b ON a.lang = b.lang AND a.term = b.term AND a.source != b.source GROUP BY ALL),
pairs AS (SELECT x.lang, x.source, 'pair' AS part, y.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
          FROM g AS x JOIN g AS y ON x.lang = y.lang AND x.source != y.source LEFT JOIN sums ON sums.lang = x.lang AND sums.source = x.source AND sums.item = y.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, CAST(((p - q) * (p - q)) // (p + q) AS BIGINT) AS value FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 10
""",
)
def op13(spark, folder):
    return divergence.audit(table(spark, folder, "documents"))
