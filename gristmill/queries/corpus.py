"""Corpus inventory on documents, pages and conversations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.functions.text import size_label
from gristmill.plans import corpus
from gristmill.queries.base import Data, query
from gristmill.sources.trees import corpus_from_table

# A path rule set of its own for the demonstration tables.
INCLUDE = [r"\.md$", r"\.gz$", r"/en/"]
EXCLUDE = [r"/de/", r"7\.", r"^web/fr"]
_FLAG = "(regexp_matches(path, '\\.md$|\\.gz$|/en/') AND NOT regexp_matches(path, '/de/|7\\.|^web/fr'))"
_NAME = "split_part(path, '/', 3)"
_EXT = f"regexp_extract({_NAME}, '[^.].*(\\.[^.]*)$', 1)"
_DEFAULT = "|".join(corpus.DEFAULT_EXCLUDES)


def _texts(d: Data) -> DataFrame:
    return corpus.with_tokens(d.corpus)


def _ingested(d: Data, max_kb: int | None = None) -> DataFrame:
    flagged = corpus.flag_included(d.corpus, INCLUDE, EXCLUDE).filter("is_included")
    return corpus.with_tokens(corpus.limit_size(flagged, max_kb))


@query("corpus_include_flags", f"SELECT path, size, {_FLAG} AS is_included FROM @corpus c")
def corpus_include_flags(d: Data) -> DataFrame:
    return corpus.flag_included(d.corpus, INCLUDE, EXCLUDE).select("path", "size", "is_included")


@query("corpus_default_excludes", f"SELECT page_id, url FROM pages WHERE NOT regexp_matches(url, '{_DEFAULT}')")
def corpus_default_excludes(d: Data) -> DataFrame:
    return corpus.exclude_paths(d.pages.withColumn("path", F.col("url"))).select("page_id", "url")


@query("corpus_include_only", "SELECT path FROM @corpus c WHERE regexp_matches(path, '\\.md$|\\.gz$|/en/')")
def corpus_include_only(d: Data) -> DataFrame:
    return corpus.include_paths(d.corpus, INCLUDE).select("path")


@query("corpus_subfolders", "SELECT path, regexp_matches(path, '^web/en(/.*)?$') AND NOT regexp_matches(path, '\\.md$') AND path <> 'web/en/1.tar.gz' AS is_included FROM @corpus c")
def corpus_subfolders(d: Data) -> DataFrame:
    include, exclude = corpus.path_rules(exclude=[r"\.md$"], subfolders=["web/en"], exclude_files=["web/en/1.tar.gz"])
    return corpus.flag_included(d.corpus, include, exclude).select("path", "is_included")


@query("corpus_root_files", "SELECT page_id, regexp_matches(url, '^https?://[^/]+/.*$') AS deep FROM (SELECT page_id, url FROM pages) t")
def corpus_root_files(d: Data) -> DataFrame:
    """Pages straight below their host are the root files of that host."""
    include, exclude = corpus.path_rules(exclude=[], root_files=False)
    paths = d.pages.select("page_id", F.regexp_replace("url", "^https?://[^/]+", "x").alias("path"))
    return corpus.flag_included(paths, include, exclude).select("page_id", F.col("is_included").alias("deep"))


@query("corpus_size_limit", "SELECT path, size, CASE WHEN size < 1024 THEN CAST(size AS STRING) || ' B' WHEN size < 1024 * 1024 THEN printf('%.1f KB', floor(size / 1024.0 * 10 + 0.5) / 10) ELSE printf('%.1f MB', size / 1048576.0) END AS label FROM @corpus c WHERE size <= 4096")
def corpus_size_limit(d: Data) -> DataFrame:
    return corpus.limit_size(d.corpus, 4).select("path", "size", size_label(F.col("size")).alias("label"))


@query("corpus_text_only", "SELECT path, size FROM @corpus c WHERE size % 7 NOT IN (1, 2, 3, 4)")
def corpus_text_only(d: Data) -> DataFrame:
    """Documents damaged by their size: a stray byte in front, in the middle, at the end, or a cut sequence there; the others stay text."""
    content, bad = F.encode("content", "UTF-8"), F.unhex(F.lit("FF"))
    kind, half = F.col("size") % 7, (F.col("size") / 2).cast("int")
    damaged = (
        F.when(kind == 1, F.concat(bad, content)).when(kind == 2, F.concat(content, bad)).when(kind == 3, F.concat(content, F.unhex(F.lit("E282"))))
        .when(kind == 4, F.concat(F.substr(content, F.lit(1), half), bad, F.substr(content, half + 1))).otherwise(content)
    )
    return corpus.keep_text(d.corpus.withColumn("content", damaged)).select("path", "size")


@query("corpus_decoded", "SELECT path, length(replace(replace(content, chr(13) || chr(10), chr(10)), chr(13), chr(10))) AS chars FROM (SELECT path, replace(content, '. ', '.' || chr(13) || chr(10)) AS content FROM @corpus c) t")
def corpus_decoded(d: Data) -> DataFrame:
    windows = d.corpus.withColumn("content", F.encode(F.replace("content", F.lit(". "), F.lit(".\r\n")), "UTF-8"))
    return corpus.decode_text(windows).select("path", F.char_length("content").cast("bigint").alias("chars"))


@query("corpus_token_estimates", "SELECT path, CAST(floor(length(content) * 0.25) AS INT) AS tokens FROM @corpus c")
def corpus_token_estimates(d: Data) -> DataFrame:
    return _texts(d).select("path", "tokens")


@query("corpus_ingested", f"SELECT path, size, CAST(floor(length(content) * 0.25) AS INT) AS tokens FROM @corpus c WHERE {_FLAG} AND size <= 8192")
def corpus_ingested(d: Data) -> DataFrame:
    return _ingested(d, 8).select("path", "size", "tokens")


@query("corpus_summary", "SELECT source AS root, count(*) AS files, CAST(floor(sum(length(text)) * 0.25) AS BIGINT) AS tokens FROM documents GROUP BY 1")
def corpus_summary(d: Data) -> DataFrame:
    return corpus.corpus_summary(corpus_from_table(d.documents, "doc_id", "source", "text"))


@query("corpus_total", "SELECT CAST(sum(files) AS BIGINT) AS files, CAST(sum(tokens) AS BIGINT) AS tokens FROM (SELECT source, count(*) AS files, CAST(floor(sum(length(text)) * 0.25) AS BIGINT) AS tokens FROM documents GROUP BY 1) t")
def corpus_total(d: Data) -> DataFrame:
    return corpus.corpus_total(corpus_summary(d))


@query("corpus_by_extension", f"SELECT {_EXT} AS extension, count(*) AS files, CAST(sum(length(content)) AS BIGINT) AS chars, CAST(sum(CAST(floor(length(content) * 0.25) AS BIGINT)) AS BIGINT) AS tokens FROM @corpus c GROUP BY 1")
def corpus_by_extension(d: Data) -> DataFrame:
    return corpus.by_extension(d.corpus)


@query("corpus_file_count_label", "SELECT n AS files, CASE WHEN n > 100 THEN '100+' ELSE CAST(n AS STRING) END AS file_count FROM (SELECT count(*) AS n FROM documents) t")
def corpus_file_count_label(d: Data) -> DataFrame:
    return corpus.file_count(d.documents).select("files", corpus.count_label(F.col("files")).alias("file_count"))


@query("corpus_preview", """SELECT path, CASE WHEN len(string_split(content, chr(10))) > 10 THEN array_to_string(string_split(content, chr(10))[1:10], chr(10)) || chr(10) || '[...] (content truncated)' ELSE content END AS preview
FROM @corpus c ORDER BY path LIMIT 3""")
def corpus_preview(d: Data) -> DataFrame:
    return corpus.preview(d.corpus, ["path"]).select("path", "preview")


@query("conversation_corpus", "SELECT CAST(conv_id AS STRING) AS root, count(*) AS files, CAST(floor(sum(length(text)) * 0.25) AS BIGINT) AS tokens FROM conversations GROUP BY 1")
def conversation_corpus(d: Data) -> DataFrame:
    return corpus.corpus_summary(corpus_from_table(d.conversations, "turn", "conv_id", "text").withColumn("root", F.col("root").cast("string")))


# --- tree and report -------------------------------------------------------------------------------------------

_FLAG_OF = "(regexp_matches({0}, '\\.md$|\\.gz$|/en/') AND NOT regexp_matches({0}, '/de/|7\\.|^web/fr'))"
_NODES = f"""WITH leaf AS (SELECT path, split_part(path, '/', 1) AS a, split_part(path, '/', 2) AS b, split_part(path, '/', 3) AS f, size FROM @corpus c),
nodes AS (SELECT path, a || '/' || b AS parent, f AS name, 'file' AS node_type, size FROM leaf UNION ALL SELECT DISTINCT a || '/' || b, a, b, 'directory', NULL FROM leaf
  UNION ALL SELECT DISTINCT a, '', a, 'directory', NULL FROM leaf)"""


@query("corpus_tree_nodes", f"{_NODES} SELECT path, parent, name, node_type, CAST(size AS BIGINT) AS size, {_FLAG_OF.format('path')} AS is_included FROM nodes")
def corpus_tree_nodes(d: Data) -> DataFrame:
    return corpus.tree_nodes(d.corpus, INCLUDE, EXCLUDE).drop("root")


_LINES = f"""{_NODES}, la AS (SELECT max(a) AS m FROM leaf), lb AS (SELECT a, max(b) AS m FROM leaf GROUP BY a), lf AS (SELECT a, b, max(f) AS m FROM leaf GROUP BY a, b),
sa AS (SELECT DISTINCT a, a = m AS last FROM leaf, la), sb AS (SELECT DISTINCT leaf.a, b, b = m AS last FROM leaf JOIN lb ON lb.a = leaf.a),
lines AS (SELECT a AS path, CASE WHEN last THEN '└── ' ELSE '├── ' END || a AS line FROM sa
  UNION ALL SELECT sb.a || '/' || b, CASE WHEN sa.last THEN '    ' ELSE '│   ' END || CASE WHEN sb.last THEN '└── ' ELSE '├── ' END || b FROM sb JOIN sa ON sa.a = sb.a
  UNION ALL SELECT leaf.path, CASE WHEN sa.last THEN '    ' ELSE '│   ' END || CASE WHEN sb.last THEN '    ' ELSE '│   ' END || CASE WHEN f = m THEN '└── ' ELSE '├── ' END || f
    FROM leaf JOIN sa ON sa.a = leaf.a JOIN sb ON sb.a = leaf.a AND sb.b = leaf.b JOIN lf ON lf.a = leaf.a AND lf.b = leaf.b),
flagged AS (SELECT path, line || CASE WHEN {_FLAG_OF.format('path')} THEN '' ELSE ' (excluded)' END AS line FROM lines)"""


@query("corpus_tree_lines", f"{_LINES} SELECT line FROM flagged")
def corpus_tree_lines(d: Data) -> DataFrame:
    return corpus.tree_lines(corpus.tree_nodes(d.corpus, INCLUDE, EXCLUDE)).select("line")


@query("corpus_tree_order", f"""{_NODES} SELECT path, CASE WHEN strpos(path, '/') = 0 THEN '0' || path WHEN node_type = 'file' THEN '0' || split_part(path, '/', 1) || chr(1) || '0' || split_part(path, '/', 2) || chr(1) || '1' || name
  ELSE '0' || parent || chr(1) || '0' || name END AS sort_key FROM nodes""")
def corpus_tree_order(d: Data) -> DataFrame:
    nodes = corpus.tree_nodes(d.corpus, INCLUDE, EXCLUDE)
    return nodes.select("path", corpus.tree_order(F.col("path"), F.col("node_type")).alias("sort_key"))


_TEXTS = f"(SELECT * FROM @corpus c WHERE {_FLAG})"


@query("corpus_report", f"""{_LINES}, t AS {_TEXTS}, s AS (SELECT count(*) AS files, CAST(floor(sum(length(content)) * 0.25) AS BIGINT) AS tokens FROM t)
SELECT 0 AS section, '# Project Summary' || chr(10) || 'Repository: docs' || chr(10) || 'Branch: main' || chr(10) || 'Files analyzed: ' || files || chr(10) || 'Estimated tokens: ' || printf('%.1fk', tokens / 1000.0) || chr(10)
  || 'Analysis time: 0.00 seconds' || chr(10) || chr(10) || '# Directory Structure' || chr(10) || chr(10) || '```' AS text FROM s
UNION ALL SELECT 1, line FROM flagged UNION ALL SELECT 2, '```' || chr(10) || chr(10) || '# Files Content' || chr(10)
UNION ALL SELECT 3, '## ' || path || chr(10) || chr(10) || '```' || substr({_EXT}, 2) || chr(10) || content || chr(10) || '```' || chr(10) FROM t""")
def corpus_report(d: Data) -> DataFrame:
    texts = _ingested(d)
    lines = corpus.report_lines(texts, corpus.tree_nodes(d.corpus, INCLUDE, EXCLUDE), corpus.corpus_summary(texts))
    return lines.select("section", "text")


_ROOTED = f"""WITH p AS (SELECT source AS root, CAST(doc_id AS STRING) || '.txt' AS f FROM documents), m AS (SELECT root, max(f) AS last_f FROM p GROUP BY 1)
SELECT root, CASE root WHEN 'src19' THEN '    ' ELSE '│   ' END || CASE WHEN f = last_f THEN '└── ' ELSE '├── ' END || f AS line FROM p JOIN m USING (root)
UNION ALL SELECT root, CASE root WHEN 'src19' THEN '└── ' ELSE '├── ' END || root FROM m"""


@query("corpus_tree_of_roots", _ROOTED)
def corpus_tree_of_roots(d: Data) -> DataFrame:
    """The twenty sources as roots, printed in a given order."""
    roots = [f"src{i}" for i in range(20)]
    texts = corpus_from_table(d.documents, "doc_id", "source", "text")
    files = texts.select("root", F.concat(F.col("path").cast("string"), F.lit(".txt")).alias("path"), "size")
    return corpus.tree_lines(corpus.tree_nodes(files, [], []), roots).select("root", "line")


@query("corpus_inventory_flags", f"SELECT path, {_FLAG} AS is_included, {_FLAG} AS is_ingested FROM @corpus c")
def corpus_inventory_flags(d: Data) -> DataFrame:
    files = d.corpus.withColumn("content", F.encode("content", "UTF-8"))
    nodes = corpus.inventory(files, include=INCLUDE, exclude=EXCLUDE)["nodes"]
    return nodes.filter("node_type = 'file'").select("path", "is_included", "is_ingested")
