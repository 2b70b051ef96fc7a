"""Corpus inventory: which files are included, which are read, how many tokens they hold, and the printed report.

Input rows are ``(root, path, size[, content])`` from :mod:`gristmill.sources.trees` or from a table of texts.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.operators.joins import enrich

# Path patterns left out by default. They are searched for anywhere in the relative path.
DEFAULT_EXCLUDES = [
    r"\.git", r"\.hg", r"\.svn", r"\.mypy_cache", r"\.ruff_cache", r"\.venv", r"\.env", r"__pycache__",
    r"\.pytest_cache", r"\.coverage", r"\.tox", r"\.nox", r"\.eggs", r"\.egg-info", r"\.vscode", r"\.idea",
    r"\.DS_Store", r"node_modules", r"dist", r"build", r"\.parcel-cache", r"\.next", r"\.turbo", r"\.svelte-kit",
    r"\.cache", r"\.coverage.*", r"\.yarn-cache", r"\.pnp", r"\.gradle", r"\.ccls-cache", r"target", r"Cargo.lock",
    r"package-lock\.json", r"yarn\.lock", r"pnpm-lock\.yaml", r"Pipfile\.lock", r"uv\.lock", r"\.sqlite3?",
]
ROOT_FILE = r"^[^/\\]+$"

# --- path rules ------------------------------------------------------------------------------------------------

def matches_any(path: Column, patterns: list[str]) -> Column:
    """One alternation instead of a chain of tests: the path is scanned by a single compiled expression."""
    if not patterns:
        return F.lit(False)
    return path.rlike("|".join(f"(?:{p})" for p in patterns))


def subfolder_patterns(folders: list[str]) -> list[str]:
    return [f"^{re.escape(folder)}(/.*)?$" for folder in folders]


def path_rules(
    include: list[str] | None = None,
    exclude: list[str] | None = None,
    subfolders: list[str] | None = None,
    exclude_files: list[str] | None = None,
    root_files: bool = True,
) -> tuple[list[str], list[str]]:
    """Effective include and exclude patterns; ``exclude=None`` means the defaults, ``[]`` means none."""
    excluded = list(DEFAULT_EXCLUDES if exclude is None else exclude)
    excluded += [f"^{re.escape(name)}$" for name in exclude_files or []]
    if not root_files:
        excluded.append(ROOT_FILE)
    return list(include or []) + subfolder_patterns(subfolders or []), excluded


def include_paths(df: DataFrame, patterns: list[str]) -> DataFrame:
    return df.filter(matches_any(F.col("path"), patterns)) if patterns else df


def exclude_paths(df: DataFrame, patterns: list[str] | None = None) -> DataFrame:
    return df.filter(~matches_any(F.col("path"), DEFAULT_EXCLUDES if patterns is None else patterns))


def flag_included(df: DataFrame, include: list[str], exclude: list[str]) -> DataFrame:
    path = F.col("path")
    kept = matches_any(path, include) if include else F.lit(True)
    return df.withColumn("is_included", kept & ~matches_any(path, exclude))


def limit_size(df: DataFrame, max_kb: int | None = None) -> DataFrame:
    """Rows of at most ``max_kb`` kilobytes; all rows without a limit."""
    return df if max_kb is None else df.filter(F.col("size") <= max_kb * 1024)


# --- content ---------------------------------------------------------------------------------------------------

def is_text(content: Column) -> Column:
    """All bytes decode as UTF-8, however long the file is."""
    return F.is_valid_utf8(content.cast("string"))


def keep_text(df: DataFrame) -> DataFrame:
    return df.filter(is_text(F.col("content")))


def decode_text(df: DataFrame) -> DataFrame:
    """Bytes to text: bad sequences become the replacement character, line ends become ``\\n``."""
    text = F.make_valid_utf8(F.col("content").cast("string"))
    return df.withColumn("content", F.regexp_replace(text, "\r\n?", "\n"))


def estimate_tokens(content: Column) -> Column:
    """A quarter of the characters, truncated."""
    return F.floor(F.char_length(content) / 4).cast("int")


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def extension(path: Column) -> Column:
    """Last dot suffix of the file name; leading dots do not start one."""
    return F.regexp_extract(base_name(path), r"(?s)[^.].*(\.[^.]*)$", 1)


def fence_language(path: Column) -> Column:
    return F.substring(extension(path), 2, 1 << 20)


def read_texts(files: DataFrame, include: list[str], exclude: list[str], max_kb: int | None = None, load=None) -> DataFrame:
    """Included textual files, of at most ``max_kb`` where that is given, with decoded content and token estimate.

    ``load`` adds the bytes after the path and size filters, so rejected files are never opened.
    """
    wanted = limit_size(flag_included(files, include, exclude).filter("is_included"), max_kb)
    loaded = load(wanted) if load else wanted
    return with_tokens(decode_text(keep_text(loaded)))


def with_tokens(texts: DataFrame) -> DataFrame:
    return texts.withColumn("tokens", estimate_tokens(F.col("content")))


def preview(df: DataFrame, order: list[str], files: int = 3, lines: int = 10) -> DataFrame:
    """The first lines of the first files."""
    parts = F.split("content", "\n")
    shortened = F.concat(F.array_join(F.slice(parts, 1, lines), "\n"), F.lit("\n[...] (content truncated)"))
    first = df.orderBy(*order).limit(files)
    return first.withColumn("preview", F.when(F.size(parts) > lines, shortened).otherwise(F.col("content"))).drop("content")


# --- totals ----------------------------------------------------------------------------------------------------

def corpus_summary(texts: DataFrame) -> DataFrame:
    """Per root; tokens come from the summed characters, not from the truncated estimates."""
    return texts.groupBy("root").agg(
        F.count("*").alias("files"), F.floor(F.sum(F.char_length("content").cast("bigint")) / 4).cast("bigint").alias("tokens")
    )


def corpus_total(summary: DataFrame) -> DataFrame:
    return summary.agg(F.sum("files").alias("files"), F.sum("tokens").alias("tokens"))


def by_extension(texts: DataFrame) -> DataFrame:
    return texts.groupBy(extension(F.col("path")).alias("extension")).agg(
        F.count("*").alias("files"), F.sum(F.char_length("content").cast("bigint")).alias("chars"),
        F.sum(estimate_tokens(F.col("content")).cast("bigint")).alias("tokens"),
    )


def file_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("files"))


def count_label(n: Column, cap: int = 100) -> Column:
    """A count for display: exact up to ``cap``, then ``cap+``."""
    return F.when(n > cap, f"{cap}+").otherwise(n.cast("string"))


# --- tree ------------------------------------------------------------------------------------------------------

def _parent(path: Column) -> Column:
    return F.array_join(F.slice(F.split(path, "/"), 1, F.size(F.split(path, "/")) - 1), "/")


def tree_nodes(files: DataFrame, include: list[str], exclude: list[str]) -> DataFrame:
    """Files and the folders above them: ``(root, path, parent, name, node_type, size, is_included)``.

    Folders are reduced to distinct parents before their ancestors are unfolded, so the exchange carries folders, not
    files.
    """
    parents = files.select("root", _parent(F.col("path")).alias("path")).filter("path <> ''").distinct()
    parts = F.split("path", "/")
    ancestors = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda depth: F.array_join(F.slice(parts, 1, depth), "/"))
    folders = parents.select("root", F.explode(ancestors).alias("path")).distinct()
    kinds = files.select("root", "path", F.lit("file").alias("node_type"), F.col("size").cast("bigint").alias("size")).unionByName(
        folders.select("root", "path", F.lit("directory").alias("node_type"), F.lit(None).cast("bigint").alias("size"))
    )
    flagged = flag_included(kinds, include, exclude)
    return flagged.select(
        "root", "path", _parent(F.col("path")).alias("parent"), base_name(F.col("path")).alias("name"), "node_type", "size",
        "is_included",
    )


def tree_order(path: Column, node_type: Column) -> Column:
    """Sort key of the printed tree: folders before files at every level, then code point order of the names."""
    parts = F.split(path, "/")
    folders = F.transform(F.slice(parts, 1, F.size(parts) - 1), lambda name: F.concat(F.lit("0"), name))
    leaf = F.concat(F.when(node_type == "directory", "0").otherwise("1"), base_name(path))
    return F.array_join(F.concat(folders, F.array(leaf)), "\x01")


def tree_lines(nodes: DataFrame, roots: list[str] | None = None, salt: int = 16) -> DataFrame:
    """``(root, sort_key, line)``; with ``roots`` each tree hangs below a node named after its root, in that order.

    The entries of one huge folder are spread over ``salt`` tasks, and so are the folders below one huge top folder.

    The last child of a folder is an aggregate, not a window, so one huge flat folder is not sorted in one task.
    The indent of a folder needs its ancestors only; files pick it up with one join on their parent.
    """
    is_file = (F.col("node_type") == "file").cast("int")
    last = nodes.groupBy("root", "parent").agg(F.max(F.struct(is_file.alias("f"), F.col("name").alias("n"))).alias("last"))

    def is_last(prefix: str) -> Column:
        return F.struct(is_file.alias("f"), F.col("name").alias("n")) == F.col(f"{prefix}last")

    folders = nodes.filter("node_type = 'directory'").join(last, ["root", "parent"]).select(
        "root", "path", is_last("").alias("is_last")
    )
    piece = F.when(F.col("is_last"), "    ").otherwise("│   ")
    parts = F.split("path", "/")
    steps = F.transform(
        F.sequence(F.lit(1), F.size(parts)),
        lambda depth: F.struct(depth.alias("depth"), F.array_join(F.slice(parts, 1, depth), "/").alias("step")),
    )
    above = folders.select("root", "path", F.inline(steps))
    pieces = folders.select("root", F.col("path").alias("step"), piece.alias("piece"))
    # One row per ancestor of a folder: a group is as large as the folder is deep.
    indents = enrich(above, pieces, ["root", "step"], ["piece"], salt=salt, unique=True).groupBy("root", "path").agg(
        F.array_sort(F.collect_list(F.struct("depth", "piece"))).alias("p")
    ).select("root", F.col("path").alias("parent"), F.array_join(F.col("p.piece"), "").alias("indent"))
    context = last.join(indents, ["root", "parent"], "left")
    joined = enrich(nodes, context, ["root", "parent"], ["last", "indent"], salt=salt, unique=True)
    mark = F.when(is_last(""), "└── ").otherwise("├── ")
    shown = F.when(F.col("is_included"), F.col("name")).otherwise(F.concat("name", F.lit(" (excluded)")))
    line = F.concat(F.coalesce("indent", F.lit("")), mark, shown)
    order = tree_order(F.col("path"), F.col("node_type"))
    if not roots:
        return joined.select("root", order.alias("sort_key"), line.alias("line"))
    last_root = F.col("root") == roots[-1]
    below = joined.select("root", order.alias("sort_key"), F.concat(F.when(last_root, "    ").otherwise("│   "), line).alias("line"))
    names = [F.struct(F.lit(r).alias("root"), F.lit(r.rstrip("/").rsplit("/", 1)[-1]).alias("name")) for r in roots]
    heads = nodes.sparkSession.range(1).select(F.inline(F.array(*names)))
    top = heads.select("root", F.lit("").alias("sort_key"), F.concat(F.when(last_root, "└── ").otherwise("├── "), "name").alias("line"))
    return top.unionByName(below)


# --- report ----------------------------------------------------------------------------------------------------

def _summary_text(where: Column, branch: str, seconds: float) -> Column:
    thousands = F.format_string("%.1fk", F.coalesce("tokens", F.lit(0)) / 1000)
    return F.concat(
        F.lit("# Project Summary\n"), where, F.lit(f"\nBranch: {branch}\nFiles analyzed: "), F.coalesce("files", F.lit(0)).cast("string"),
        F.lit("\nEstimated tokens: "), thousands, F.lit(f"\nAnalysis time: {seconds:.2f} seconds\n\n# Directory Structure\n\n```"),
    )


def _file_block() -> Column:
    return F.concat(F.lit("## "), "path", F.lit("\n\n```"), fence_language(F.col("path")), F.lit("\n"), "content", F.lit("\n```\n"))


_AFTER_TREE = "```\n\n# Files Content\n"


def _section(df: DataFrame, root, number: int, key, text: Column) -> DataFrame:
    return df.select(root.alias("root"), F.lit(number).alias("section"), key.alias("sort_key"), text.alias("text"))


def report_lines(texts: DataFrame, nodes: DataFrame, summary: DataFrame, branch: str = "main", seconds: float = 0.0) -> DataFrame:
    """One report per root as ordered text blocks ``(root, section, sort_key, text)``; a block has no trailing line end."""
    root, first = F.col("root"), F.lit("")
    where = F.concat(F.lit("Repository: "), "root")
    return (
        _section(summary, root, 0, first, _summary_text(where, branch, seconds))
        .unionByName(_section(tree_lines(nodes), root, 1, F.col("sort_key"), F.col("line")))
        .unionByName(_section(summary, root, 2, first, F.lit(_AFTER_TREE)))
        .unionByName(_section(texts, root, 3, tree_order(F.col("path"), F.lit("file")), _file_block()))
    )


def combined_report_lines(
    texts: DataFrame, nodes: DataFrame, summary: DataFrame, roots: list[str], branch: str = "main", seconds: float = 0.0
) -> DataFrame:
    """One report over all ``roots`` in their order, in the same blocks, under the root name ``all``."""
    everything, first = F.lit("all"), F.lit("")
    where = F.lit("## Repositories\n" + "\n".join(f"- {root}" for root in roots))
    place = F.lpad(F.array_position(F.array(*[F.lit(root) for root in roots]), F.col("root")).cast("string"), 9, "0")

    def key(inner: Column) -> Column:
        return F.concat(place, F.lit("\x01"), inner)

    total = corpus_total(summary)
    return (
        _section(total, everything, 0, first, _summary_text(where, branch, seconds))
        .unionByName(_section(tree_lines(nodes, roots), everything, 1, key(F.col("sort_key")), F.col("line")))
        .unionByName(_section(total, everything, 2, first, F.lit(_AFTER_TREE)))
        .unionByName(_section(texts, everything, 3, key(tree_order(F.col("path"), F.lit("file"))), _file_block()))
    )


def inventory(files: DataFrame, load=None, max_kb: int | None = None, roots: list[str] | None = None, **rules) -> dict[str, DataFrame]:
    """Everything about a corpus: ``texts``, ``nodes`` (with ``is_ingested``), ``summary``, ``total`` and ``report``.

    ``roots`` asks for the combined report in that order, else there is one per root. The other results are derived from
    ``texts``; to use several of them on raw files, write ``texts`` once and pass the table to :func:`corpus_summary`,
    :func:`tree_nodes` and :func:`report_lines`, so that files are opened only once.
    """
    include, exclude = path_rules(**rules)
    texts = read_texts(files, include, exclude, max_kb, load)
    nodes = tree_nodes(files, include, exclude)
    # A root whose files were all rejected still has its line, with zeros.
    summary = files.select("root").distinct().join(corpus_summary(texts), "root", "left").fillna(0, ["files", "tokens"])
    read = texts.select("root", "path", F.lit(True).alias("is_ingested"))
    marked = nodes.join(read, ["root", "path"], "left").withColumn("is_ingested", F.coalesce("is_ingested", F.lit(False)))
    report = combined_report_lines(texts, nodes, summary, roots) if roots else report_lines(texts, nodes, summary)
    return {"texts": texts, "nodes": marked, "summary": summary, "total": corpus_total(summary), "report": report}
