"""Main text of web pages by equivalence classes of tokens over the pages of a host."""

from __future__ import annotations

import html
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.llm import common
from gristmill.llm.urls import host_and_path

#: Share of a host's pages on which a class must occur to be part of the template, and share of the free text that makes a container a main one.
SUPPORT, SHARE = 0.5, 0.1
#: Tokens that a class has at least, and pages from which equal texts and counts tell something.
LEAST_TOKENS, LEAST_PAGES = 2, 3

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|svg|iframe|textarea)\b[^>]*>.*?(?:</\1\s*>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)>|<[!?][^>]*>",
    re.S | re.I,
)
_CLASS = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_SPACE = re.compile(r"\s+")
_APART, _NUMBER = re.compile(r"[\s/]+"), re.compile(r"[0-9]+")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset("address article aside blockquote body br center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section select summary table tbody td tfoot th thead title tr ul".split())
_CLOSES_P = _BLOCK - frozenset("br option select title tbody td tfoot th thead tr html body legend summary figcaption".split())
_CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_SCOPE = frozenset("ul ol dl table div section article main body html nav aside header footer form blockquote select".split())
_MAIN = frozenset(["article", "main"])
_HOLDS = frozenset("html body div section center".split())
_OUTSIDE = frozenset("head title nav header footer aside form menu dialog button select option label input script style noscript".split())
# Words in class, id or role that name a part beside the article.
_BESIDE = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|adv|advert|adverts|advertisement|banner|promo|sponsor|sponsored|nav|navbar|navigation|menu|breadcrumb|breadcrumbs|header|masthead|footer|sidebar|aside|widget|related|"
    r"comment|comments|reply|replies|disqus|cookie|cookies|consent|gdpr|notice|popup|modal|overlay|newsletter|subscribe|signup|login|search|share|sharing|social|toolbar|complementary|contentinfo|alert)(?:$|[\s_-])",
    re.I,
)


def walk(page: str) -> Iterator[tuple[tuple[str, ...], str | None, bool]]:
    """Tokens of a page in order: (path, None, False) where an element opens, (path, text, new block before it) for text.

    A path names the elements from the root, each with its class, id and role, numbers in them as 0. Unclosed paragraphs and items end where the next begins.
    """
    stack: list[tuple[str, str]] = []
    names: tuple[str, ...] = ()
    at, fresh = 0, True
    for m in _TOKEN.finditer(page):
        if m.start() > at:
            yield names, html.unescape(page[at : m.start()]), fresh
            fresh = False
        at = m.end()
        tag = (m[3] or "").lower()
        if not tag:
            continue
        if tag in _BLOCK:
            fresh = True
        if m[2]:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    del stack[i:]
                    names = tuple(n for _, n in stack)
                    break
            continue
        closes = _CLOSED_BY.get(tag, ())
        for i in range(len(stack) - 1, -1, -1):
            open_ = stack[i][0]
            if open_ in closes or (open_ == "p" and tag in _CLOSES_P):
                del stack[i:]
                break
            if open_ in _SCOPE:
                break
        marks = " ".join(next(g for g in c.groups()[1:] if g is not None) for c in _CLASS.finditer(m[4])) if "=" in m[4] else ""
        name = f"{tag}.{_NUMBER.sub('0', _APART.sub('_', marks.strip()))}" if marks.strip() else tag
        names = (*(n for _, n in stack), name)
        yield names, None, False
        if tag in _VOID or m[4].endswith("/"):
            names = names[:-1]
        else:
            stack.append((tag, name))
    if at < len(page):
        yield names, html.unescape(page[at:]), fresh


def beside(name: str) -> bool:
    """Whether an element is none of the article's: by its tag or by the words of its class."""
    tag, _, marks = name.partition(".")
    return tag in _OUTSIDE or bool(marks and _BESIDE.search(marks.replace(".", " ")))


def ancestors(role: str) -> list[str]:
    """A role and the roles around it, up to the empty one."""
    path = role.split("/")
    return ["/".join(path[:n]) for n in range(len(path), -1, -1)]


def container(role: str) -> str:
    """The nearest element of a role that holds parts of a page, not a part such as a heading, a paragraph or a table itself."""
    return next((r for r in ancestors(role) if r.rpartition("/")[2].partition(".")[0] in _HOLDS), "")


def profile(page: str) -> dict[str, list]:
    """Token (path): [times it opens, crc of the text directly in it]."""
    found: dict[str, list] = {}
    for path, text, _ in walk(page):
        entry = found.setdefault("/".join(path), [0, 0])
        if text is None:
            entry[0] += 1
        else:
            entry[1] = zlib.crc32(_SPACE.sub(" ", text).strip().encode("utf-8", "replace"), entry[1])
    return found


@dataclass
class Template:
    """Tokens of valid classes with the numbers of their classes; tokens of repeated classes; tokens whose text is the same on all pages."""

    classes: dict[str, int]
    records: frozenset[str]
    fixed: frozenset[str]


def deduce(tokens: list[tuple[str, int, int, str, int, int]], pages: int) -> Template:
    """From (token, pages, most times on a page, vector, least and greatest crc of its text) over ``pages`` pages.

    Tokens with equal occurrence vectors form a class; one of fewer than ``LEAST_TOKENS`` tokens, or on too few pages, is not valid. Tokens of
    a class that open once a page are the template. A class that opens more often and holds one of its tokens inside another repeats a
    record: menus, comments, teasers. A paragraph is no record, since nothing in it occurs as often as it does.
    """
    classes: dict[tuple[int, str], list[tuple[str, int]]] = {}
    for token, n, most, vector, _, _ in tokens:
        if token and n >= SUPPORT * pages:
            classes.setdefault((n, vector), []).append((token, most))
    once, records = {}, set()
    for number, (_, members) in enumerate(sorted(classes.items(), key=lambda c: (-c[0][0], c[0][1]))):
        single = [t for t, most in members if most == 1]
        if len(single) >= LEAST_TOKENS:
            once |= dict.fromkeys(single, number)
        many = {t for t, most in members if most > 1}
        if pages >= LEAST_PAGES and len(many) >= LEAST_TOKENS:
            records |= {t for t in many if any(u != t and u.startswith(t + "/") for u in many)}
    same = {t for t, n, _, _, low, high in tokens if pages >= LEAST_PAGES and n >= SUPPORT * pages and low == high}
    return Template(once, frozenset(records), frozenset(same))


def slotted(page: str, template: dict[str, int]) -> Iterator[tuple[str, tuple[str, ...], str | None, bool]]:
    """(token, path, None, False) for each template token that opens, (slot, path, text, new block before it) for each text.

    A slot lies between two template tokens: it is named by the innermost template element around the text and the template token that opened last in it.
    """
    last: dict[str, str] = {}
    known: dict[tuple[str, ...], str] = {(): ""}

    def element(path: tuple[str, ...]) -> str:
        found = known.get(path)
        if found is None:
            role = "/".join(path)
            found = known[path] = role if role in template else element(path[:-1])
        return found

    for path, text, fresh in walk(page):
        if text is None:
            role = "/".join(path)
            if role in template:
                last[element(path[:-1])] = role
                yield role, path, None, False
        else:
            inner = element(path)
            yield f"{inner}\n{last.get(inner, '')}", path, text, fresh


def measure(page: str, template: Template) -> tuple[dict[str, list[int]], dict[int, int]]:
    """(slot: [free characters, all characters, those in links], class: crc of the order in which its tokens open) of a page; what stands beside the article counts nowhere."""
    slots: dict[str, list[int]] = {}
    orders: dict[int, int] = {}
    flags: dict[tuple[str, ...], tuple[bool, bool, bool]] = {}
    for slot, path, text, _ in slotted(page, template.classes):
        if text is None:
            number = template.classes[slot]
            orders[number] = zlib.crc32(slot.encode("utf-8", "replace"), orders.get(number, 0))
            continue
        if path not in flags:
            around = ["/".join(path[:n]) for n in range(1, len(path) + 1)]
            flags[path] = any(map(beside, path)), any(p.partition(".")[0] == "a" for p in path), "/".join(path) in template.fixed or any(r in template.records for r in around)
        out, linked, known = flags[path]
        if not out:
            n, entry = len(text.strip()), slots.setdefault(slot, [0, 0, 0])
            entry[0] += 0 if linked or known else n
            entry[1] += n
            entry[2] += n if linked else 0
    return slots, orders


def choose(slots: list[tuple[str, int, int, int]]) -> list[str]:
    """Main slots from (slot, free characters, all characters, those in links) over all pages of a host.

    Containers with at least ``SHARE`` of the free text hold the article. However small, every slot in them and every part directly beside
    them counts if it is not mostly links. Where some of these containers are article or main elements, those elements alone hold it.
    Where no text is free, as on a single page's host without any, all text that is not linked counts as free, or all.
    """
    element = {s: s.partition("\n")[0] for s, *_ in slots}
    for value in ((lambda r: r[1]), (lambda r: r[2] - r[3]), (lambda r: r[2])):
        free = Counter()
        for row in slots:
            free[container(element[row[0]])] += value(row)
        total = sum(free.values())
        if total:
            break
    held = {c for c, n in free.items() if n and n >= SHARE * total}
    if any(named(c) for c in held):
        return sorted(s for s in element if named(element[s]))
    around = {c.rpartition("/")[0] for c in held if c}
    fit = [s for s, _, every, linked in slots if 2 * linked <= every]
    return sorted(s for s in fit if container(element[s]) in around or any(c in held for c in ancestors(container(element[s]))))


def named(role: str) -> bool:
    return any(p.partition(".")[0] in _MAIN for p in role.split("/"))


def main_text(page: str, template: list[str], main: list[str], others: list[str] | None = None) -> str:
    """Text of the page's main slots, white space as one space; of all slots that its own tokens give, where the host's give none.

    ``others`` are the host's slots that hold no main text; a slot that is in neither list goes with the main ones of its element.
    """
    if not page:
        return ""
    for attempt in range(2):
        if attempt:
            own = deduce([(r, 1, n, str(n), crc, crc) for r, (n, crc) in profile(page).items()], 1)
            template, main, others = own.classes, choose([(s, *v) for s, v in measure(page, own)[0].items()]), None
        inside, wanted, beyond, outside = dict.fromkeys(template, 0), set(main), set(others or ()), {}
        elements = {s.partition("\n")[0] for s in main}
        parts: list[str] = []
        for slot, path, text, fresh in slotted(page, inside):
            if text is None:
                continue
            if path not in outside:
                outside[path] = any(map(beside, path))
            if fresh:
                parts.append(" ")
            if not outside[path] and (slot in wanted or (slot not in beyond and slot.partition("\n")[0] in elements)):
                parts.append(text)
        found = _SPACE.sub(" ", "".join(parts)).strip()
        if found:
            return found
    return ""


def _profiled(batches):
    for batch in common.slices(batches, "html"):
        rows = []
        for host, page_id, page in zip(batch.column("host").to_pylist(), batch.column("page_id").to_pylist(), common.texts(batch.column("html"))):
            for role, (n, crc) in profile(page.decode("utf-8", "replace")).items():
                rows.append((host, role, n, crc, page_id))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64()))], ["host", "role", "n", "crc", "page"])


def tokens(pages: DataFrame) -> DataFrame:
    """(host, of, role, pages, most, vector, low, high) for (host, page_id, html): sums over all pages of a host, for tokens on enough of its ``of`` pages.

    An occurrence vector is a sum of hashes of (page, times it opens), so it needs no list of pages. Tokens of single pages end here, so a
    host's rows are as many as its template allows, however many pages it has.
    """
    found = pages.mapInArrow(_profiled, "host string, role string, n int, crc long, page long")
    vector = F.sum(F.xxhash64("page", "n").cast("decimal(38,0)")).cast("string")
    summed = common.stored(found.groupBy("host", "role").agg(F.count("*").alias("pages"), F.max("n").alias("most"), vector.alias("vector"), F.min("crc").alias("low"), F.max("crc").alias("high")))
    # Each page of a host opens at least one token, so its most frequent one tells how many pages there are.
    size = summed.groupBy("host").agg(F.max("pages").alias("of"))
    return summed.join(common.apart(size), "host").where(F.col("pages") >= SUPPORT * F.col("of"))


def _deduced(key, pdf):
    found = deduce(list(zip(pdf["role"], pdf["pages"], pdf["most"], pdf["vector"], pdf["low"], pdf["high"])), int(pdf["of"].iloc[0]))
    return pd.DataFrame([{"host": key[0], "template": list(found.classes), "classes": list(found.classes.values()), "records": sorted(found.records), "fixed": sorted(found.fixed)}])


def _template(row: dict) -> Template:
    return Template(dict(zip(row["template"] or [], row["classes"] or [])), frozenset(row["records"] or ()), frozenset(row["fixed"] or ()))


def _measured(batches):
    """(host, slot, free, every, linked, class, low, high): sums of a batch by slot, and the orders met of each class."""
    for batch in common.slices(batches, "html"):
        slots, orders, made = {}, {}, {}
        columns = ["host", "template", "classes", "records", "fixed"]
        for host, page, *rest in zip(batch.column("host").to_pylist(), common.texts(batch.column("html")), *(batch.column(c).to_pylist() for c in columns[1:])):
            if host not in made:
                made[host] = _template(dict(zip(columns[1:], rest)))
            found, order = measure(page.decode("utf-8", "replace"), made[host])
            for slot, values in found.items():
                entry = slots.setdefault((host, slot), [0, 0, 0])
                for i, v in enumerate(values):
                    entry[i] += v
            for number, crc in order.items():
                low, high = orders.get((host, number), (crc, crc))
                orders[host, number] = min(low, crc), max(high, crc)
        rows = [(h, s, *v, None, None, None) for (h, s), v in slots.items()] + [(h, None, 0, 0, 0, n, *v) for (h, n), v in orders.items()]
        if rows:
            yield pa.RecordBatch.from_pylist([dict(zip(_SUMS, r)) for r in rows], pa.schema([pa.field(n, pa.string() if n in ("host", "slot") else pa.int64()) for n in _SUMS]))


_SUMS = ("host", "slot", "free", "every", "linked", "class", "low", "high")


def templates(pages: DataFrame) -> DataFrame:
    """(host, template, main, others) for (host, page_id, html): the template's tokens, and the slots between them that hold main text or none.

    A class whose tokens do not open in one order on all pages is no part of the template: its slots join those of the elements around them.
    """
    classes = common.stored(tokens(pages).groupBy("host").applyInPandas(_deduced, "host string, template array<string>, classes array<int>, records array<string>, fixed array<string>"))
    found = pages.join(classes, "host").mapInArrow(_measured, "host string, slot string, free long, every long, linked long, class long, low long, high long")
    sums = found.groupBy("host", "slot", "class").agg(*(F.sum(c).alias(c) for c in ("free", "every", "linked")), F.min("low").alias("low"), F.max("high").alias("high"))

    def one(key, left, right):
        if not len(left):
            return pd.DataFrame({"host": [], "template": [], "main": [], "others": []})
        known = dict(zip(left["template"].iloc[0], left["classes"].iloc[0]))
        mixed = set(right["class"][right["class"].notna() & (right["low"] != right["high"])].astype(int))
        template = sorted(r for r, number in known.items() if number not in mixed)
        valid, slots = set(template), {}
        for slot, *values in right[right["slot"].notna()][["slot", "free", "every", "linked"]].itertuples(index=False):
            inner, _, after = slot.partition("\n")
            inner = next(r for r in ancestors(inner) if r in valid or not r)
            entry = slots.setdefault(f"{inner}\n{after if after in valid else ''}", [0, 0, 0])
            for i, v in enumerate(values):
                entry[i] += int(v)
        main = choose([(s, *v) for s, v in sorted(slots.items())])
        return pd.DataFrame([{"host": key[0], "template": template, "main": main, "others": sorted(set(slots) - set(main))}])

    return classes.groupBy("host").cogroup(sums.groupBy("host")).applyInPandas(one, "host string, template array<string>, main array<string>, others array<string>")


def _extracted(batches):
    for batch in common.slices(batches, "html"):
        pages = common.texts(batch.column("html"))
        columns = [batch.column(c).to_pylist() for c in ("template", "main", "others")]
        out = [main_text(p.decode("utf-8", "replace"), *(v or [] for v in found)) for p, *found in zip(pages, *columns)]
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(out, pa.string())], ["page_id", "url", "text"])


def extract(pages: DataFrame) -> DataFrame:
    """Per row of (page_id, url, html): page_id, url, text, n_chars.

    Null pages have an empty text. Pages without a host in their url share one template; a page that its host's template leaves without
    text is read by its own tokens. Repeated pages each give a row.
    """
    host, _ = host_and_path(F.col("url"))
    rows = pages.select("page_id", "url", F.coalesce(host, F.lit("")).alias("host"), F.col("html").cast("binary").alias("html"))
    known = common.stored(templates(rows.select("host", F.col("page_id").cast("long").alias("page_id"), "html")))
    done = rows.join(known, "host", "left").select("page_id", "url", "html", "template", "main", "others")
    out = done.mapInArrow(_extracted, f"page_id {dict(pages.dtypes)['page_id']}, url string, text string")
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
