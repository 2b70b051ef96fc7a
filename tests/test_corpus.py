"""A small real tree, read through the listing source, down to the printed report."""

import pytest
from pyspark.sql import functions as F

from gristmill.plans import corpus
from gristmill.sources import sinks, trees

REPORT_TREE = """├── .config
│   └── settings.toml
├── dist (excluded)
│   └── bundle.js (excluded)
├── pkg
│   ├── deep
│   │   └── note.txt
│   ├── __init__.py
│   └── distance.py (excluded)
├── .gitignore (excluded)
├── big.txt
├── edge.txt
├── late.txt
├── photo.bin
└── win.txt"""


@pytest.fixture(scope="module")
def tree(tmp_path_factory):
    root = tmp_path_factory.mktemp("tree")
    files = {
        "pkg/__init__.py": b"x = 1\n", "pkg/distance.py": b"far", "pkg/deep/note.txt": "café".encode(), "dist/bundle.js": b"js",
        ".gitignore": b"*.pyc", ".config/settings.toml": b"a = 1", "big.txt": b"z" * 1025, "edge.txt": b"e" * 1024, "win.txt": b"a\r\nb\rc\n",
        "photo.bin": b"\xff\xfe\x00\x01", "late.txt": b"ok",
    }
    for name, data in files.items():
        path = root / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(data)
    (root / "empty").mkdir()
    return root


@pytest.fixture(scope="module")
def result(spark, tree):
    listed = trees.scan_tree(spark, [str(tree)])
    return corpus.inventory(listed, load=trees.with_content, max_kb=1)


def test_listing_has_hidden_names_and_sizes(spark, tree):
    listed = {r.path: r.size for r in trees.scan_tree(spark, [str(tree)]).collect()}
    assert listed["pkg/__init__.py"] == 6 and listed[".gitignore"] == 5 and listed["big.txt"] == 1025 and len(listed) == 11
    folders = {r.path for r in trees.scan_tree(spark, [str(tree)], keep_folders=True).filter("is_dir").collect()}
    assert folders == {"pkg", "pkg/deep", "dist", ".config", "empty"}


def test_missing_root_is_empty(spark, tree):
    listed = trees.scan_tree(spark, [str(tree), str(tree / "nowhere")])
    assert {r.root for r in listed.select("root").distinct().collect()} == {str(tree)}


def test_builtin_source_sees_the_visible_part(spark, tree):
    seen = trees.scan_visible(spark, [str(tree)])
    assert {r.path for r in seen.select("path").collect()} == {"pkg/distance.py", "pkg/deep/note.txt", "dist/bundle.js", "big.txt", "edge.txt", "win.txt", "photo.bin", "late.txt"}
    plan = seen.filter("size <= 1024").select("path")._jdf.queryExecution().executedPlan().toString()
    assert "LessThanOrEqual(length,1024)" in plan and "content" not in plan.split("ReadSchema")[1]


def test_ingested_texts(result):
    rows = {r.path: r for r in result["texts"].collect()}
    assert set(rows) == {"pkg/__init__.py", "pkg/deep/note.txt", ".config/settings.toml", "edge.txt", "win.txt", "late.txt"}
    assert rows["win.txt"].content == "a\nb\nc\n" and rows["edge.txt"].tokens == 256 and rows["pkg/deep/note.txt"].tokens == 1


def test_totals(result):
    s = result["summary"].first()
    chars = 6 + 4 + 5 + 1024 + 6 + 2
    assert (s.files, s.tokens) == (6, chars // 4)
    assert tuple(result["total"].first()) == (6, chars // 4)


def test_tree_text(result):
    lines = corpus.tree_lines(result["nodes"]).orderBy("sort_key").collect()
    assert "\n".join(r.line for r in lines) == REPORT_TREE


def test_nodes_know_what_was_read(result):
    flags = {r.path: (r.is_included, r.is_ingested) for r in result["nodes"].collect()}
    assert flags["photo.bin"] == (True, False) and flags["big.txt"] == (True, False) and flags["pkg/distance.py"] == (False, False) and flags["win.txt"] == (True, True)


def test_report_file(spark, result, tmp_path):
    sinks.write_report(result["report"].withColumn("root", F.lit("r")), str(tmp_path / "report"))
    parts = sorted((tmp_path / "report" / "root=r").glob("part-*.txt"))
    text = "".join(p.read_text() for p in parts)
    body = "".join(f"## {p}\n\n```{ext}\n{content}\n```\n\n" for p, ext, content in [
        (".config/settings.toml", "toml", "a = 1"), ("pkg/deep/note.txt", "txt", "café"), ("pkg/__init__.py", "py", "x = 1\n"), ("edge.txt", "txt", "e" * 1024),
        ("late.txt", "txt", "ok"), ("win.txt", "txt", "a\nb\nc\n"),
    ])
    head = f"# Project Summary\nRepository: {result['summary'].first().root}\nBranch: main\nFiles analyzed: 6\nEstimated tokens: 0.3k\nAnalysis time: 0.00 seconds\n\n"
    assert text == head + "# Directory Structure\n\n```\n" + REPORT_TREE + "\n```\n\n# Files Content\n\n" + body


def test_report_of_many_parts_reads_in_order(spark, tmp_path):
    rows = [("r", s, f"{k:05d}", f"line {s} {k}\nmore") for s in range(3) for k in range(400)] + [("q", 0, "", "only")]
    lines = spark.createDataFrame(rows, "root string, section int, sort_key string, text string").repartition(7)
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # keeps all eight parts
    sinks.write_report(lines, str(tmp_path / "report"))
    spark.conf.set("spark.sql.adaptive.enabled", before)
    assert len(list((tmp_path / "report" / "root=r").glob("part-*.txt"))) > 3
    got = [r.line for r in sinks.read_report(spark, str(tmp_path / "report")).filter("root = 'r'").repartition(4).orderBy("place").collect()]
    assert got == [x for s in range(3) for k in range(400) for x in (f"line {s} {k}", "more")]


def test_published_report_is_whole_or_not_there(spark, tmp_path):
    """Many parts are the printed report byte for byte; a version with a task that fails is never seen."""
    rows = [(r, s, f"{k:05d}", f"{r} liné {s} {k}\nmore") for r in ("r", "s t") for s in range(3) for k in range(300)] + [("q", 0, "", "only")]
    lines = spark.createDataFrame(rows, "root string, section int, sort_key string, text string").repartition(7)
    folder = str(tmp_path / "reports")
    broken = lines.withColumn("text", F.when(F.col("sort_key") == "00123", F.raise_error(F.lit("task fails"))).otherwise(F.col("text")))
    with pytest.raises(Exception, match="task fails"):
        sinks.publish_report(broken, folder)
    assert sinks.published(spark, folder) is None
    with pytest.raises(ValueError, match="no report"):
        sinks.report_manifest(spark, folder)
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # keeps all eight parts
    first = sinks.publish_report(lines, folder)
    spark.conf.set("spark.sql.adaptive.enabled", before)

    def texts():
        out = {}
        for m in sorted(sinks.report_manifest(spark, folder).collect(), key=lambda m: (m.root, m.offset)):
            content = spark.read.format("binaryFile").load(m.path).first().content
            assert len(content) == m.bytes and m.offset == len(out.get(m.root, b""))
            out[m.root] = out.get(m.root, b"") + content
        return out

    want = {r: "".join(x + "\n" for root, *_, x in rows if root == r).encode() for r in ("r", "s t", "q")}
    assert texts() == want and sum(m.root == "r" for m in sinks.report_manifest(spark, folder).collect()) > 2
    with pytest.raises(Exception, match="task fails"):
        sinks.publish_report(broken, folder)
    assert sinks.published(spark, folder) == first and texts() == want
    second = sinks.publish_report(lines.where("section = 0"), folder)
    assert sinks.published(spark, folder) == second != first and texts()["r"] == "".join(f"r liné 0 {k}\nmore\n" for k in range(300)).encode()


def test_two_roots(spark, tmp_path):
    for name in ("one", "two"):
        (tmp_path / name / "d").mkdir(parents=True)
        (tmp_path / name / "d" / "same.txt").write_text(name)
    roots = [str(tmp_path / "one"), str(tmp_path / "two")]
    result = corpus.inventory(trees.scan_tree(spark, roots), load=trees.with_content)
    assert {(r.root, r.content) for r in result["texts"].collect()} == {(roots[0], "one"), (roots[1], "two")}
    shown = corpus.inventory(trees.scan_tree(spark, roots), load=trees.with_content, roots=roots)["report"].orderBy("section", "sort_key").collect()
    assert "\n".join(r.text for r in shown) + "\n" == (
        f"# Project Summary\n## Repositories\n- {roots[0]}\n- {roots[1]}\nBranch: main\nFiles analyzed: 2\nEstimated tokens: 0.0k\n"
        "Analysis time: 0.00 seconds\n\n# Directory Structure\n\n```\n├── one\n│   └── d\n│       └── same.txt\n└── two\n    └── d\n        └── same.txt\n"
        "```\n\n# Files Content\n\n## d/same.txt\n\n```txt\none\n```\n\n## d/same.txt\n\n```txt\ntwo\n```\n\n"
    )
    lines = corpus.tree_lines(result["nodes"], roots).orderBy("root", "sort_key").collect()
    assert [r.line for r in lines] == ["├── one", "│   └── d", "│       └── same.txt", "└── two", "    └── d", "        └── same.txt"]


def test_root_without_texts_is_counted(spark, tmp_path):
    (tmp_path / "r").mkdir()
    (tmp_path / "r" / "x.bin").write_bytes(b"\xff\xff")
    result = corpus.inventory(trees.scan_tree(spark, [str(tmp_path / "r")]), load=trees.with_content)
    assert [(r.files, r.tokens) for r in result["summary"].collect()] == [(0, 0)]
    assert result["report"].filter("section = 0").first().text.count("Files analyzed: 0") == 1


def test_text_test_matches_python(spark):
    head = b"a" * 8190
    contents = {
        "plain": b"abc", "empty": b"", "bad": b"ab\xff", "cut char over the head": head + "é€".encode() + b"tail", "bad after the head": b"a" * 9000 + b"\xff",
        "three of four": b"a" * 8189 + "\U0001f600".encode(), "short cut at the end": b"ab\xe2\x82", "long cut at the end": b"a" * 2000 + b"\xe2\x82", "stray continuation": head + b"\x80\x80zz",
    }
    rows = spark.createDataFrame([(n, bytearray(b)) for n, b in contents.items()], "name string, content binary")
    got = {r.name: r.t for r in rows.select("name", corpus.is_text(F.col("content")).alias("t")).collect()}

    def model(data):
        try:
            data.decode("utf-8")
            return True
        except UnicodeDecodeError:
            return False

    assert got == {n: model(b) for n, b in contents.items()}


def test_extension_like_splitext(spark):
    import os
    names = ["a.py", "a.tar.gz", ".bashrc", "..x", "..x.y", "noext", "dir.d/file", "a.", ".a.b", "a..b"]
    rows = spark.createDataFrame([(n,) for n in names], "path string")
    got = [r.e for r in rows.select(corpus.extension(F.col("path")).alias("e")).collect()]
    assert got == [os.path.splitext(n)[1] for n in names]


def test_path_rules():
    include, exclude = corpus.path_rules(subfolders=["a b/c"], root_files=False, exclude_files=["x.y"])
    assert include == [r"^a\ b/c(/.*)?$"] and exclude[:len(corpus.DEFAULT_EXCLUDES)] == corpus.DEFAULT_EXCLUDES
    assert exclude[-2:] == [r"^x\.y$", corpus.ROOT_FILE] and corpus.path_rules(exclude=[])[1] == []


def test_preview_and_count(spark):
    rows = spark.createDataFrame([(f"f{i}", "\n".join(map(str, range(i)))) for i in range(1, 13)], "path string, content string")
    shown = {r.path: r.preview for r in corpus.preview(rows, [F.length("path").desc(), F.col("path").desc()], files=2).collect()}
    assert shown["f12"].endswith("8\n9\n[...] (content truncated)") and shown["f11"].count("\n") == 10
    assert corpus.file_count(rows).first().files == 12
    assert tuple(rows.select(corpus.count_label(F.lit(12), 11), corpus.count_label(F.lit(12), 12)).first()) == ("11+", "12")


def test_nothing_is_dropped_by_default(spark, tmp_path):
    (tmp_path / "large.txt").write_text("z" * 70000)
    files = trees.scan_tree(spark, [str(tmp_path)])
    assert corpus.limit_size(files).count() == corpus.read_texts(files, [], [], load=trees.with_content).count() == 1
