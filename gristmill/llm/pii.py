"""Personal data: base spans by pattern, and further candidates chosen by boosted trees. All of it runs as DataFrame expressions."""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gristmill.llm import common
from gristmill.llm.common import stored
from gristmill.llm.quality import Forest, grow

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)

_LOCAL = "[A-Za-z0-9._%+-]"
# A match can only begin where a run of such characters does or where the match before ended; saying so keeps the search linear in long runs.
_AT_RUN = rf"(?:\G|(?<!{_LOCAL}))"
#: The base patterns. Possessive where nothing behind could ask for a shorter piece, so that no repetition recurses.
BASE = (
    rf"{_AT_RUN}{_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    r"[0-9](?:[\x20-]?+[0-9])++",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)
_OPEN, _SHUT = r"[\[({<]\x20?", r"\x20?[\])}>]"
_SIGN = rf"(?:\x20?@\x20?|\x20?{_OPEN}(?:at|AT|@){_SHUT}\x20?|\x20(?:at|AT)\x20)"
_DOT = rf"(?:\x20?\.\x20?|\x20?{_OPEN}(?:dot|DOT|\.){_SHUT}\x20?|\x20(?:dot|DOT)\x20)"
_PART = rf"(?:{_DOT}|\x20?[,:]\x20?)"
#: Generators of high recall: addresses with written signs, four numbers, and long numbers however divided, which may be cards or phones.
WIDE = (
    rf"{_AT_RUN}{_LOCAL}++{_SIGN}[A-Za-z0-9-]++(?:{_DOT}[A-Za-z0-9-]++)++",
    rf"(?<![0-9])[0-9]{{1,3}}+(?:{_PART}[0-9]{{1,3}}+){{3}}(?![0-9])",
    r"\+?\(?[0-9](?:[\x20().,/_-]{0,3}+[0-9]){7,}+",
)
PATTERNS = (*BASE, *WIDE)
#: A quick test of whether a text can hold a match at all.
GUARDS = ("@", r"[0-9]\.[0-9]", "[0-9]", r"\+[0-9]", r"@|[\[({<\x20](?:at|AT)[\])}>\x20]", "[0-9]", "[0-9]")
#: Kinds that the wide generators propose.
PROPOSED = {4: (EMAIL,), 5: (IP,), 6: (CARD, PHONE)}
#: Code points around a candidate that are looked at.
CONTEXT = 48
WORDS = (
    "mail|contact|kontakt|correo|courriel|write|schreib", r"\bip\b|host|server|serveur|servidor|address|adresse", "card|karte|carte|tarjeta|visa|konto|account|pay", "tel|phone|call|fax|mobil|handy|anruf",
    "order|number|nummer|version|page|seite|ref|code|isbn|serial|http|key|hash|year",
)

#: Spans and candidates that may teach, taken by hash; trees; the least margin of what is added, and the share of wrong spellings that may pass.
MOST_SPANS, MOST_OTHERS = 4000, 20_000
TREES, DEPTH = 40, 3
SURE, PASSING = 1.0, 0.001


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the check digit of a number of 13 to 19 digits is right."""
    backwards = F.reverse(digits)

    def add(total, i):
        d = F.substring(backwards, i, F.lit(1)).try_cast("int")
        twice = 2 * d
        return total + F.when(i % 2 == 1, d).when(twice > 9, twice - 9).otherwise(twice)

    right = F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0
    return F.when(F.length(digits).between(13, 19), right).otherwise(F.lit(False))


_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"


def _valid(kind: Column, m: Column) -> Column:
    """Whether a match of a base pattern is personal data."""
    small = F.when(F.length(m) <= 40, m).otherwise("")  # nineteen digits and what may stand between them
    return (
        F.when(kind == EMAIL, F.lit(True)).when(kind == IP, m.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}\z"))
        .when(kind == CARD, _luhn(_digits(small))).otherwise(F.length(_digits(m)).between(9, 15))
    )


def matches(rows: DataFrame) -> DataFrame:
    """(key, h, gen, start, end, m, before, after) of all matches of all patterns in (key, h, text); places count code points.

    Matches and the pieces between them are taken in one pass each; a running sum of their lengths gives the places. Rows that repeat key
    and h count once.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    item = "struct<gen:int,idx:int,gap:int,m:string,tail:string,head:string>"

    def pieces(gen, pattern):
        both = F.arrays_zip(F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))
        return F.transform(both, lambda z, i: F.struct(F.lit(gen).alias("gen"), i.alias("idx"), F.length(z["0"]).alias("gap"), z["1"].alias("m"), F.right(z["0"], F.lit(CONTEXT)).alias("tail"), F.left(z["0"], F.lit(CONTEXT)).alias("head")).cast(item))

    arrays = [F.when(text.rlike(guard), pieces(gen, pattern)).otherwise(F.array().cast(f"array<{item}>")) for gen, (pattern, guard) in enumerate(zip(PATTERNS, GUARDS))]
    found = rows.select("key", "h", F.explode(F.concat(*arrays)).alias("x")).select("key", "h", "x.*").where("m IS NOT NULL OR idx > 0")
    found = found.repartition("key", "h", "gen")
    same = Window.partitionBy("key", "h", "gen", "idx").orderBy("idx")
    order = Window.partitionBy("key", "h", "gen").orderBy("idx")
    found = found.withColumn("copy", F.row_number().over(same)).where("copy = 1")
    end = F.sum(F.col("gap") + F.coalesce(F.length("m"), F.lit(0))).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    found = found.withColumns({"end": end, "after": F.lead("head").over(order)}).where("m IS NOT NULL")
    return found.select("key", "h", "gen", (F.col("end") - F.length("m")).alias("start"), "end", "m", F.col("tail").alias("before"), F.coalesce("after", F.lit("")).alias("after"))


def base_spans(found: DataFrame) -> DataFrame:
    """(key, h, kind, start, end, m, before, after) of the matches of base patterns that hold."""
    return found.where(F.col("gen") < len(BASE)).where(_valid(F.col("gen"), F.col("m"))).withColumnRenamed("gen", "kind")


def _count(text: Column, pattern: str) -> Column:
    return F.length(F.regexp_replace(text, f"[^{pattern}]", ""))


def candidates(found: DataFrame) -> DataFrame:
    """(key, h, kind, start, end, x) proposed by the wide generators; x holds the features of format and context."""
    kinds = F.when(F.col("gen") == 4, F.array(F.lit(EMAIL))).when(F.col("gen") == 5, F.array(F.lit(IP))).otherwise(F.array(F.lit(CARD), F.lit(PHONE)))
    rows = found.where(F.col("gen") >= len(BASE)).select("key", "h", F.explode(kinds).alias("kind"), "start", "end", "m", "before", "after", _digits(F.col("m")).alias("digits"))
    n = F.length("digits")
    rows = rows.where((F.col("kind") < CARD) | (F.col("kind") == CARD) & n.between(13, 19) | (F.col("kind") == PHONE) & n.between(8, 15))
    m, before, after = F.col("m"), F.col("before"), F.col("after")
    last, next_ = F.right(before, F.lit(1)), F.left(after, F.lit(1))
    final = F.regexp_extract(m, "([A-Za-z0-9-]+)$", 1)
    octets = F.regexp_extract_all(m, F.lit("[0-9]+"), F.lit(0))
    features = [
        F.col("kind"), F.length(m), n, _count(m, "A-Za-z"), _count(m, r"\x20"), _count(m, "."), _count(m, ","), _count(m, ":"), _count(m, "()"), _count(m, "/_"), _count(m, r"\x2D"), _count(m, r"\[\]{}<>"), _count(m, "A-Z"), F.size(octets),
        m.rlike(r"^\+"), m.rlike("^00"), m.contains("@"), m.rlike(rf"{_OPEN}(?:at|AT|@)"), m.rlike(r"\x20(?:at|AT)\x20"), m.rlike(r"\x20(?:dot|DOT)\x20|(?:dot|DOT)[\])}>]"), m.rlike(r"\.\x20|,\x20"),
        F.length(final), final.rlike("^[a-z]{2,6}$"), final.rlike("^[A-Z]"), F.when(F.col("kind") == CARD, _luhn(F.col("digits"))).otherwise(F.lit(False)), F.substring("digits", 1, 1).try_cast("int"),
        F.when(F.col("kind") == IP, F.forall(octets, lambda o: F.when(F.length(o) <= 3, o).otherwise("999").try_cast("int") <= 255)).otherwise(F.lit(False)),
        last.rlike("[A-Za-z]"), last.rlike("[0-9]"), last.rlike(r"\s"), next_.rlike("[A-Za-z]"), next_.rlike("[0-9]"), next_.rlike(r"\s"), _count(before, "0-9"), _count(after, "0-9"),
        *(F.lower(before).rlike(w) for w in WORDS),
    ]
    return rows.select("key", "h", "kind", "start", "end", F.array(*(F.coalesce(f.cast("double"), F.lit(-1.0)) for f in features)).alias("x"))


def _beside(base: DataFrame, others: DataFrame) -> DataFrame:
    """``others`` (key, h, start, end, …) that overlap no span of ``base``. Both are swept by place within a text; no pairs are made."""
    names = [c for c in others.columns if c not in ("key", "h", "start", "end")]
    rows = others.withColumn("own", F.lit(False)).unionByName(base.select("key", "h", "start", "end", F.lit(True).alias("own")), allowMissingColumns=True)
    by = Window.partitionBy("key", "h").orderBy("start")
    reach = F.max(F.when(F.col("own"), F.col("end"))).over(by.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    ahead = F.min(F.when(F.col("own"), F.col("start"))).over(by.rangeBetween(Window.currentRow, Window.unboundedFollowing))
    rows = rows.withColumns({"reach": reach, "ahead": ahead}).where("NOT own AND coalesce(reach, 0) <= start AND (ahead IS NULL OR ahead >= end)")
    return rows.select("key", "h", "start", "end", *names)


def _disguised() -> list[tuple[int, int, Column]]:
    """(kind, label, how a base span of this kind may be written otherwise); label 0 marks spellings that are no longer personal data."""
    m = F.col("m")
    fours = F.regexp_replace(_digits(m), "([0-9]{4})(?=[0-9])", "$1_")
    wrong = F.concat(F.substring(_digits(m), 1, 5), ((F.substring(_digits(m), 6, 1).try_cast("int") + 1) % 10).cast("string"), F.substring(_digits(m), 7, 40))
    wrong_fours = F.regexp_replace(wrong, "([0-9]{4})(?=[0-9])", "$1_")
    inner = F.regexp_replace(F.substring(m, 2, 40), r"[()\x20]+", "-")

    def signs(at, dot):
        name, host = F.substring_index(m, "@", 1), F.substring_index(m, "@", -1)
        return F.concat(name, F.lit(at), F.replace(host, F.lit("."), F.lit(dot)))

    return [
        *((EMAIL, 1, signs(at, dot)) for at, dot in ((" at ", " dot "), (" (at) ", "."), ("[at]", "[dot]"), (" @ ", "."), ("(at)", "(dot)"), (" AT ", " DOT "))),
        *((IP, 1, F.replace(m, F.lit("."), F.lit(dot))) for dot in ("[.]", " dot ", "(.)", "[dot]", " . ")),
        (IP, 0, F.replace(m, F.lit("."), F.lit(", "))), (IP, 0, F.replace(m, F.lit("."), F.lit(":"))), (IP, 0, F.regexp_replace(F.replace(m, F.lit("."), F.lit("[.]")), "^[0-9]+", "777")),
        *((CARD, 1, F.replace(fours, F.lit("_"), F.lit(gap))) for gap in (".", "/", "_", "  ", " - ")),
        *((CARD, 0, F.replace(wrong_fours, F.lit("_"), F.lit(gap))) for gap in ("", " ", ".", "/", "  ")),
        (PHONE, 1, F.concat(F.lit("00"), inner)), (PHONE, 1, F.replace(m, F.lit(" "), F.lit("/"))), (PHONE, 1, F.concat(F.lit("(00"), inner)), (PHONE, 1, F.concat(F.lit("+"), F.replace(inner, F.lit("-"), F.lit("/")))),
        (PHONE, 0, _digits(m)), (PHONE, 0, F.replace(inner, F.lit("-"), F.lit(", "))),
    ]


def _some(rows: DataFrame, most: int) -> DataFrame:
    """At most ``most`` rows of (key, h, start, kind, …), those of the smallest hashes; the others are filtered out before they are compared."""
    place, n = F.xxhash64("key", "h", "start", "kind"), rows.count()
    low = rows.where(F.shiftrightunsigned(place, 24) < int(2**40 * min(1.0, 2 * most / max(n, 1))))
    return low.orderBy(F.shiftrightunsigned(place, 24), place, "start", "kind").limit(most)


def lessons(base: DataFrame, others: DataFrame) -> DataFrame:
    """(kind, label, spelt, x, test) to learn from, a quarter of them for testing.

    At most ``MOST_SPANS`` base spans, taken by hash, are written in other ways within their own surroundings and searched again: what the
    generators propose there is right, or wrong where the spelling is. At most ``MOST_OTHERS`` candidates that overlap no base span count as wrong;
    a few of these may be disguised data themselves, so only wrong spellings (``spelt``) calibrate.
    """
    some = stored(_some(base.where(F.length("m") <= 64), MOST_SPANS))
    ways = F.array(*(F.when(F.col("kind") == kind, F.struct(F.lit(n).alias("way"), F.lit(label).alias("label"), text.alias("text"))) for n, (kind, label, text) in enumerate(_disguised())))
    spelt = some.select("key", "h", "start", "kind", "before", "after", F.explode(F.filter(ways, lambda w: w.isNotNull())).alias("w"))
    spelt = spelt.select(
        F.xxhash64("key", "h", "start", "kind", "w.way").alias("key"), F.lit(0).cast("long").alias("h"), F.concat("before", "w.text", "after").alias("text"), F.col("kind").alias("of"), "w.label",
        F.length("before").alias("low"), (F.length("before") + F.length("w.text")).alias("high"),
    )
    spelt = stored(spelt)
    again = candidates(matches(spelt)).join(spelt.drop("h", "text"), "key").where("kind = of AND start < high AND end > low")
    taught = again.select("key", "kind", "start", "label", F.lit(True).alias("spelt"), "x")
    wrong = _some(others, MOST_OTHERS).select("key", "kind", "start", F.lit(0).alias("label"), F.lit(False).alias("spelt"), "x")
    fold = F.pmod(F.xxhash64("key", "start", F.lit(4)), F.lit(4)) == 0
    return taught.unionByName(wrong).select("kind", "label", "spelt", "x", fold.alias("test"), F.xxhash64("key", "start", "kind").alias("place")).orderBy("place", "label").drop("place")


def fitted(rows: list) -> tuple[Forest, list[float]]:
    """Trees and the least margin that is added of each kind: ``SURE``, or more until ``PASSING`` of the held-out wrong spellings lie above it."""
    x, y = np.array([r.x for r in rows], float), np.array([r.label for r in rows], float)
    kind, test, spelt = (np.array([getattr(r, c) for r in rows], t) for c, t in (("kind", int), ("test", bool), ("spelt", bool)))
    if not len(rows) or y.min() == y.max():
        return Forest(0.0, np.zeros((0, 1), int), np.zeros((0, 1)), np.zeros((0, 2))), [np.inf] * len(KINDS)
    forest, limits = grow(x[~test], y[~test], trees=TREES, depth=DEPTH), []
    margin = forest.margin(x)
    for k in range(len(KINDS)):
        wrong = np.sort(margin[test & spelt & (kind == k) & (y == 0)])[::-1]
        above = wrong[int(PASSING * len(wrong))] + 1e-9 if len(wrong) else SURE
        limits.append(max(SURE, float(above)) if (y[kind == k] == 1).any() else np.inf)
    return forest, limits


def _array(values: np.ndarray, kind: str) -> str:
    """A constant array in SQL."""
    return f"cast(array({', '.join(f'{min(v, 1e300)!r}D' for v in values.ravel().astype(float).tolist())}) as array<{kind}>)"


def margin(forest: Forest) -> Column:
    """The sum of the leaves that ``x`` reaches. Trees lie flat in arrays: a node's children follow at twice its place."""
    if not len(forest.feature):
        return F.lit(float(forest.base))
    inner, leaves = forest.feature.shape[1], forest.leaf.shape[1]
    feature, cut, leaf = _array(forest.feature, "int"), _array(forest.cut, "double"), _array(forest.leaf, "double")
    at = f"t * {inner} + node"
    node = f"aggregate(sequence(1, {int(np.log2(leaves))}), 0, (node, level) -> 2 * node + if(x[{feature}[{at}]] > {cut}[{at}], 2, 1))"
    return F.expr(f"aggregate(sequence(0, {len(forest.feature) - 1}), {float(forest.base)!r}D, (total, t) -> total + {leaf}[t * {leaves} + {node} - {inner}])")


def _best(added: DataFrame) -> DataFrame:
    """Of each chain of overlapping candidates the one with the largest margin beyond its threshold."""
    by = Window.partitionBy("key", "h").orderBy("start", "end", "kind")
    reach = F.max("end").over(by.rowsBetween(Window.unboundedPreceding, -1))
    rows = added.withColumn("first", F.coalesce(F.col("start") >= reach, F.lit(True)).cast("int"))
    rows = rows.withColumn("chain", F.sum("first").over(by.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    best = F.row_number().over(Window.partitionBy("key", "h", "chain").orderBy(F.desc("over"), "start", F.desc("end"), "kind"))
    return rows.withColumn("place", best).where("place = 1").select("key", "h", "kind", "start", "end")


def keyed(docs: DataFrame) -> DataFrame:
    return docs.select(common.row_id(docs).alias("key"), F.xxhash64("text").alias("h"), "text")


def spans(docs: DataFrame) -> DataFrame:
    """(key, h, kind, start, end, base) of the personal data in (doc_id, text), for each different text of an id; end is exclusive.

    Base spans are the valid matches of ``BASE``. Candidates of ``WIDE`` that overlap none of them are judged by boosted trees, which learn
    from base spans written otherwise (:func:`lessons`); those beyond their kind's threshold are added, the best of each chain of overlapping ones.
    """
    found = stored(matches(keyed(docs)))
    base = stored(base_spans(found))
    others = stored(_beside(base, candidates(found)))
    forest, limits = fitted(lessons(base, others).collect())
    limit = F.element_at(F.expr(_array(np.array(limits), "double")), F.col("kind") + 1)
    added = others.select("key", "h", "kind", "start", "end", (margin(forest) - limit).alias("over")).where("over >= 0")
    return base.select("key", "h", "kind", "start", "end", F.lit(True).alias("base")).unionByName(_best(stored(added)).withColumn("base", F.lit(False)))


def _listed(rows: Column) -> Column:
    """``kind:start:end`` by kind as listed, then start."""
    names = F.array(*map(F.lit, KINDS))
    return F.concat_ws(",", F.transform(F.sort_array(rows), lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))))


def personal_data(docs: DataFrame) -> DataFrame:
    """Per row of (doc_id, text): doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans (all spans).

    Null texts are empty; rows without an id keep a null doc_id; repeated rows each give a row; further columns are ignored. Without base
    spans there is nothing to learn from and nothing is added.
    """
    span = F.struct("kind", "start", "end")
    counts = [F.count(F.when(F.col("base") & (F.col("kind") == k), 1)).alias(f"n_{n}") for k, n in enumerate(KINDS)]
    found = spans(docs).groupBy("key", "h").agg(*counts, F.collect_list(F.when(F.col("base"), span)).alias("own"), F.collect_list(span).alias("all"))
    found = found.select("key", "h", *(f"n_{n}" for n in KINDS), F.sha2(_listed(F.col("own")), 256).alias("base_sha256"), _listed(F.col("all")).alias("spans"))
    out = keyed(docs).select("key", "h").join(stored(found), ["key", "h"], "left")
    zero = F.lit(0).cast("long")
    return out.select(
        common.real_id(F.col("key")).alias("doc_id"), *(F.coalesce(f"n_{n}", zero).alias(f"n_{n}") for n in KINDS),
        F.coalesce("base_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("base_sha256"), F.coalesce("spans", F.lit("")).alias("spans"),
    )


def redacted(docs: DataFrame) -> DataFrame:
    """``docs`` with each span of personal data replaced by its kind in brackets; overlapping spans go as one, named by the first."""
    key, h, out = (common.free_name(docs, n) for n in ("_key", "_h", "_spans"))
    by = Window.partitionBy("key", "h").orderBy("start", "end", "kind")
    rows = spans(docs).withColumn("reach", F.max("end").over(by.rowsBetween(Window.unboundedPreceding, -1)))
    rows = rows.withColumn("chain", F.sum(F.coalesce(F.col("start") >= F.col("reach"), F.lit(True)).cast("int")).over(by.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    whole = rows.groupBy("key", "h", "chain").agg(F.min(F.struct("start", "end", "kind")).alias("s"), F.max("end").alias("end"))
    listed = stored(whole.groupBy(F.col("key").alias(key), F.col("h").alias(h)).agg(F.sort_array(F.collect_list(F.struct("s.start", F.col("end").alias("end"), "s.kind"))).alias(out)))
    names = F.array(*map(F.lit, KINDS))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("done"))

    def cut(state, s):
        kept = F.substring(F.col("text"), (state["at"] + 1).cast("int"), (s["start"] - state["at"]).cast("int"))
        return F.struct(s["end"].alias("at"), F.concat(state["done"], kept, F.lit("["), F.element_at(names, s["kind"] + 1), F.lit("]")).alias("done"))

    text = F.aggregate(F.col(out), start, cut, lambda s: F.concat(s["done"], F.substring(F.col("text"), (s["at"] + 1).cast("int"), F.length("text"))))
    met = docs.withColumns({key: common.row_id(docs), h: F.xxhash64("text")}).join(listed, [key, h], "left")
    return met.select(*(F.when(F.col(out).isNull(), F.col("text")).otherwise(text).alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns))
