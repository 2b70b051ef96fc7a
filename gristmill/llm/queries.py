"""One query per operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gristmill.llm import decontaminate, extract, language, neighbours, packing, pii, quality, repair, repeats, simhash, toxicity, trie, urls
from gristmill.llm.common import table


#: The rules of the URL query: action, host and start of the path.
URL_RULES = [(urls.ALLOW, "com/"), (urls.BLOCK, "example.com/en/"), (urls.ALLOW, "www.example.com/en/"), (urls.BLOCK, "net/es/"), (urls.BLOCK, "net/fr/")]


def op1_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return urls.judge(table(spark, folder, "pages"), URL_RULES)


def op2_repeated_passages(spark: SparkSession, folder: str) -> DataFrame:
    return repeats.repeated_passages(table(spark, folder, "documents"))


def op3_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op4_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.graded_documents(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op5_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"))


def op6_simhash_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


def op7_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return extract.extract(table(spark, folder, "pages"))


def op8_language(spark: SparkSession, folder: str) -> DataFrame:
    return language.languages(table(spark, folder, "documents"))


def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxic_documents(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op10_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.search_every(table(spark, folder, "embeddings"), 20)


def op11_conversation_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return trie.prefix_trie(table(spark, folder, "conversations"))


def op12_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    return pii.personal_data(table(spark, folder, "documents"))


def op13_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    return repair.damaged_report(table(spark, folder, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_url_filter, op2_repeated_passages, op3_benchmark_decontamination, op4_quality, op5_best_fit_packing, op6_simhash_near_duplicates,
    op7_html_extraction, op8_language, op9_toxicity, op10_nearest_neighbours,
    op11_conversation_prefix_trie, op12_personal_data, op13_conversation_repair,
)}
#: crc32 of an ASCII text, which ``format`` puts in.
_CRC = """xor(list_reduce(list_transform(range(0, CAST(octet_length(encode({0})) AS BIGINT)), lambda i: CAST(ascii(substr({0}, CAST(i + 1 AS BIGINT), 1)) AS BIGINT)), lambda acc, b:
    list_reduce(range(8), lambda a, k: xor(a >> 1, 3988292384 * (a & 1)), xor(acc, b)), 4294967295), 4294967295)"""
_WHITE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _edit(costs: str, more: str, letter: str) -> str:
    """A cost of twelve digits and an audit, with an edit in front."""
    return f"(lpad(CAST(CAST({costs}[1:12] AS BIGINT) + {more} AS VARCHAR), 12, '0') || '{letter}' || {costs}[13:])"


def _before(state: int) -> str:
    """The least edits in a state before a row, from those behind it (v0 to v3), without insertions."""
    made = (2, 2, 3, 2)[state]
    keeps = " ".join(f"WHEN x = '{x}' THEN {_edit(f'v{t}', 'more', 'K')}" for x, t in (({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})[state]).items())
    return f"least({_edit(f'v{state}', '4', 'D')}, CASE WHEN NOT held THEN {_edit(f'v{made}', '3 + more', 'R')} END, CASE WHEN held THEN NULL {keeps} END) AS b{state}"


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS = rf"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

SQL: dict[str, str] = {
    "op3_benchmark_decontamination": f"""WITH d AS (SELECT doc_id, {_WORDS} AS ws FROM documents), i AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS ws FROM benchmark),
  wins AS (SELECT DISTINCT item, ws[k:k + 9] AS g FROM (SELECT item, ws, unnest(range(1, greatest(1, len(ws) - 9) + 1)) AS k FROM i WHERE len(ws) > 0) t),
  lens AS (SELECT DISTINCT len(g) AS n FROM wins),
  places AS (SELECT doc_id, n, k, ws[k:k + n - 1] AS g FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS k FROM d, lens WHERE len(ws) >= n) t),
  met AS (SELECT doc_id, n, k, item FROM places JOIN wins USING (g)),
  hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + n)) AS p FROM met) t GROUP BY 1),
  who AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM met) t GROUP BY 1)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN who USING (doc_id)""",
    "op11_conversation_prefix_trie": f"""WITH t AS (SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS pos, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations WHERE conv_id IS NOT NULL),
  k AS (SELECT c, count(*) AS n, {_CRC.format("CAST(c AS VARCHAR)")} % 6 AS h, c - c % 100 AS b FROM t GROUP BY c),
  g AS (SELECT k.c, k.h, k.b, least(k.h, coalesce(f.n, 0)) AS taken FROM k LEFT JOIN k AS f ON f.c = k.b),
  s AS (SELECT g.c, t.pos AS d, r, x FROM g JOIN t ON t.c = g.b AND t.pos <= g.taken
        UNION ALL SELECT g.c, taken + pos - h, r, x FROM g JOIN t USING (c) WHERE pos > h),
  p AS (SELECT c, d, list({{'r': r, 'x': x}}) OVER (PARTITION BY c ORDER BY d) AS path, x, max(d) OVER (PARTITION BY c) AS total FROM s
        UNION ALL SELECT g.c, 0, [], '', coalesce(m, 0) FROM g LEFT JOIN (SELECT c, max(d) AS m FROM s GROUP BY c) AS l USING (c)),
  v AS (SELECT path, d, min(c) AS conv_id, count(*) AS n_convs, max(length(x)) AS chars, string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (d = total) AS ends FROM p GROUP BY path, d),
  kids AS (SELECT path[1:d - 1] AS path, count(*) AS n_children FROM v WHERE d > 0 GROUP BY 1),
  w AS (SELECT v.*, coalesce(n_children, 0) AS n_children FROM v LEFT JOIN kids USING (path)),
  sums AS (SELECT path[1:k] AS path, count(*) FILTER (n_children = 0) AS n_leaves, sum((n_convs - 1) * chars) AS saved FROM (SELECT *, unnest(range(0, d + 1)) AS k FROM w) AS e GROUP BY 1)
SELECT w.conv_id, w.d AS depth, u.conv_id AS parent_conv_id, w.n_convs, w.n_children, n_leaves, CAST(saved AS BIGINT) AS saved_tokens, sha256(coalesce(w.ends, '')) AS ends_sha256
FROM w JOIN sums USING (path) LEFT JOIN w AS u ON w.d > 0 AND u.path = w.path[1:w.d - 1]""",
    "op13_conversation_repair": f"""WITH RECURSIVE k AS (SELECT conv_id AS c, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, CAST(conv_id AS VARCHAR) || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS id FROM conversations WHERE conv_id IS NOT NULL),
  f AS (SELECT c, turn, role, text, {_CRC.format("id")} % 20 AS fault FROM k),
  d AS (SELECT c, turn, CASE fault WHEN 4 THEN 'user' ELSE role END AS role, CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
        unnest(range(CASE fault WHEN 3 THEN 2 ELSE 1 END)) AS copy, rtrim(CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END, {_WHITE}) AS bare FROM f WHERE fault <> 0),
  n AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST) AS i FROM d),
  o AS (SELECT *, row_number() OVER (PARTITION BY c, role, text ORDER BY i) > 1 AS seen, lag(left(role, 1)) OVER (PARTITION BY c ORDER BY i) || left(role, 1) NOT IN ('su', 'ua', 'au') AS illegal FROM n),
  r AS (SELECT *, left(role, 1) AS x, bare = '' OR seen AS held, CASE WHEN right(bare, 1) IN ('.', '!', '?') THEN 0 ELSE 3 END AS more FROM o),
  v AS (SELECT c, count(*) AS i, '000000000000' AS v0, '000000000006II' AS v1, '000000000003I' AS v2, '000000000000' AS v3 FROM r GROUP BY c
        UNION ALL SELECT c, i - 1, least(b0, {_edit("w2", "3", "I")}), least(b1, {_edit("w2", "3", "I")}), w2, w3 FROM (
          SELECT *, least(b2, {_edit("b3", "3", "I")}) AS w2, least(b3, {_edit("b2", "3", "I")}) AS w3 FROM (
            SELECT v.c, v.i, {", ".join(map(_before, range(4)))} FROM v JOIN r ON r.c = v.c AND r.i = v.i) AS y) AS z),
  a AS (SELECT c, CAST(v0[1:12] AS BIGINT) AS cost, v0[13:] AS audit FROM v WHERE i = 0),
  e AS (SELECT c, j, audit[j] AS l, sum(CAST(audit[j] <> 'I' AS INT)) OVER w AS i, sum(CAST(audit[j] <> 'D' AS INT)) OVER w AS p
        FROM (SELECT c, audit, unnest(range(1, length(audit) + 1)) AS j FROM a) AS q WINDOW w AS (PARTITION BY c ORDER BY j)),
  g AS (SELECT e.c, e.p, l, r.role, r.text, max(CAST(p = 1 AND l = 'K' AND x = 's' AS INT)) OVER (PARTITION BY e.c) AS s FROM e LEFT JOIN r ON r.c = e.c AND r.i = e.i AND l <> 'I' WHERE l <> 'D'),
  h AS (SELECT c, string_agg(CASE WHEN l = 'K' THEN role WHEN (p - s) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || coalesce(text, ''), chr(10) ORDER BY p) AS made FROM g GROUP BY c),
  t AS (SELECT c, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (bare = '') AS blank, count(*) FILTER (bare <> '' AND seen) AS duplicate,
        count(*) FILTER (NOT held AND more > 0) AS truncated, count(*) FILTER (illegal) AS illegal FROM r GROUP BY c)
SELECT c AS conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, sha256(coalesce(made, '')) AS repaired_sha256
FROM (SELECT DISTINCT c FROM k) AS every LEFT JOIN t USING (c) LEFT JOIN a USING (c) LEFT JOIN h USING (c)""",
}
