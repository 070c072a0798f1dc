"""Postings on stored pages."""

from __future__ import annotations

import functools
import re
from collections.abc import Callable, Iterator
from html import unescape
from html.parser import HTMLParser

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import is_tech
from ..operators.contract import format_salary

# Addresses, classes and headings of the sites' pages.

BASE_URLS = {"wuzzuf": "https://wuzzuf.net", "bayt": "https://www.bayt.com", "forasna": "https://forasna.com", "jobzella": "https://www.jobzella.com"}

#: Lists of a page that belong together by position.
WUZZUF = {"title": "h2.css-193uk2c", "company": "a.css-ipsyv7", "location": "span.css-16x61xq"}

BAYT = {
    "card": "li.has-pointer-d", "title": "h2 a", "company": ("div.job-company-location-wrapper >a", "div.job-company-location-wrapper >b"), "location": "div.t-mute.t-small a.t-mute",
    "description": "div.jb-descr", "salary": "dt.jb-label-salary", "experience": "dt.jb-label-careerlevel", "posted_at_raw": "div.jb-date span",
}

FORASNA = {
    "card": ".result-wrp", "title": ("h2.job-title a span", "h2.job-title a"), "link": "h2.job-title a", "company": ("span.company-name a span", "span.company-name a", "span.company-name"),
    "location": (".company-meta span.location-desktop span", ".location-mobile span.location span"), "detail": "div.job-details", "detail_title": "span.job-details__title", "salary": "الراتب",
}

SECTIONS = ("Job Description", "Job Requirements", "Skills And Tools")

FIELDS = ("title", "company", "location", "salary", "description", "experience", "posted_at_raw", "job_url")

_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_UNREAD = frozenset("script style template".split())
#: Elements that a start tag of their kind ends.
_ENDS = {"li": {"li"}, "p": {"p"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}}


#: Elements whose content isn't read as markup, or not always.
_RAW = frozenset("script style title textarea xmp iframe noembed noframes noscript plaintext".split())
_TAGS = re.compile("(<[^<>]*>)")
#: A tag with attributes in double quotes and without references.
_PLAIN = re.compile(r"""<(?:/([A-Za-z][A-Za-z0-9]*)|([A-Za-z][A-Za-z0-9]*)((?:[ \t\n\r\f]+[A-Za-z][A-Za-z0-9_:.-]*="[^"<>&]*")*))[ \t\n\r\f]*(/?)>""")
_ATTRIBUTE = re.compile(r"""([A-Za-z][A-Za-z0-9_:.-]*)="([^"]*)\"""")


@functools.lru_cache(maxsize=4096)
def _plain_tag(tag: str) -> tuple[str, str, dict[str, str], bool] | None:
    """(name if it ends an element, name if it begins one, attributes, whether that is empty) of a plain tag, which pages
    repeat; null for others."""
    if not (m := _PLAIN.fullmatch(tag)):
        return None
    end, begin, attrs, empty = m.groups("")
    if (end or begin).lower() in _RAW or (end and empty):
        return None
    return end.lower(), begin.lower(), {k.lower(): v for k, v in _ATTRIBUTE.findall(attrs)}, bool(empty)


@functools.lru_cache(maxsize=4096)
def _classes(value: str | None) -> frozenset[str]:
    return frozenset((value or "").split())


_NONE: frozenset[str] = frozenset()


@functools.lru_cache(maxsize=4096)
def _steps(path: str) -> tuple[tuple[str, frozenset[str], bool], ...]:
    """Tag, classes, and whether directly in the one before, of each step of a path."""
    out = []
    for step in path.split():
        tag, *classes = step.lstrip(">").split(".")
        out.append((tag, frozenset(classes), step.startswith(">")))
    return tuple(out)


class Element:
    """An element of a page: tag, classes, attributes, and texts and elements in it.  The page has its elements in their order;
    those in an element are a range of it."""

    __slots__ = ("tag", "attrs", "classes", "parent", "inside", "page", "at", "end")

    def __init__(self, tag: str, attrs: dict[str, str | None], parent: Element | None, page: list[Element]):
        self.tag, self.attrs, self.parent, self.inside, self.page = tag, attrs, parent, [], page
        self.classes = _classes(attrs["class"]) if "class" in attrs else _NONE
        self.at = self.end = -1
        if parent is not None:
            parent.inside.append(self)
            self.at = len(page)
            page.append(self)
            self.end = self.at + 1

    def elements(self) -> list[Element]:
        """All elements in it, in page order."""
        return self.page[self.at + 1 : self.end]

    def text(self, between: str = "") -> str:
        """The texts in it, each trimmed, without blank ones."""
        if len(self.inside) == 1 and isinstance(self.inside[0], str):
            return self.inside[0].strip()
        parts, todo = [], self.inside[::-1]
        while todo:
            x = todo.pop()
            if isinstance(x, str):
                parts.append(x.strip())
            elif x.tag not in _UNREAD:
                todo += x.inside[::-1]
        return between.join([p for p in parts if p])

    def _within(self, e: Element, steps: tuple, k: int) -> bool:
        """Whether elements above e, and in this one, are at the steps before the k-th."""
        if k == 0:
            return True
        tag, classes, _ = steps[k - 1]
        above = e.parent
        while above is not None and above is not self:
            if (not tag or above.tag == tag) and classes <= above.classes and self._within(above, steps, k - 1):
                return True
            above = None if steps[k][2] else above.parent
        return False

    def all(self, path: str) -> list[Element]:
        """Elements in it at a path of tags and classes, each within the one before (directly, if it begins with >)."""
        steps = _steps(path)
        tag, classes, _ = steps[-1]
        found = self.page[self.at + 1 : self.end]
        if tag:
            found = [e for e in found if e.tag == tag]
        if classes:
            found = [e for e in found if classes <= e.classes]
        last = len(steps) - 1
        return [e for e in found if self._within(e, steps, last)] if last and found else found

    def first(self, paths: str | tuple[str, ...]) -> Element | None:
        """The first element at the first path that has one."""
        for path in (paths,) if isinstance(paths, str) else paths:
            if found := self.all(path):
                return found[0]
        return None


class _Tree:
    def __init__(self) -> None:
        self.page: list[Element] = []
        self.root = self.at = Element("", {}, None, self.page)

    def start(self, tag: str, attrs: dict[str, str | None]) -> None:
        if tag in _ENDS and self.at.tag in _ENDS[tag]:
            self._leave(self.at)
        e = Element(tag, attrs, self.at, self.page)
        if tag not in _VOID:
            self.at = e

    def finish(self, tag: str) -> None:
        e = self.at
        while e is not self.root and e.tag != tag:
            e = e.parent
        if e is not self.root:
            self._leave(e)

    def _leave(self, e: Element) -> None:
        """Ends an element and those that are open in it."""
        n, x = len(self.page), self.at
        while x is not e:
            x.end, x = n, x.parent
        e.end, self.at = n, e.parent

    def whole(self) -> Element:
        self.root.end = len(self.page)
        while self.at is not self.root:
            self._leave(self.at)
        return self.root


class _Events(HTMLParser):
    def __init__(self, tree: _Tree) -> None:
        super().__init__(convert_charrefs=True)
        self.tree = tree

    def handle_starttag(self, tag: str, attrs: list) -> None:
        self.tree.start(tag, dict(attrs))

    def handle_endtag(self, tag: str) -> None:
        self.tree.finish(tag)

    def handle_data(self, data: str) -> None:
        self.tree.at.inside.append(data)


def parsed_page(html: str) -> Element:
    """A page by the parser's events."""
    events = _Events(_Tree())
    events.feed(html)
    events.close()
    return events.tree.whole()


def page_of(html: str | None) -> Element:
    """A page.  One that has only texts and plain tags is cut at these; the first thing that is neither gives the whole page
    to the parser."""
    html = html or ""
    tree = _Tree()
    for k, piece in enumerate(_TAGS.split(html)):
        if k % 2:
            if (known := _plain_tag(piece)) is None:
                return parsed_page(html)
            end, begin, attrs, empty = known
            if end:
                tree.finish(end)
            else:
                tree.start(begin, attrs)
                if empty:
                    tree.finish(begin)
        elif piece:
            if "<" in piece:
                return parsed_page(html)
            tree.at.inside.append(unescape(piece) if "&" in piece else piece)
    return tree.whole()


def _text(e: Element | None, between: str = "") -> str:
    return e.text(between) if e is not None else ""


def _absolute(href: str | None, base: str, default: str = "") -> str:
    return default if not href else href if href.startswith("http") else base + href


def wuzzuf_records(page: Element) -> list[dict[str, str]]:
    """Titles with the company and the location at the same place of their own lists."""
    companies, locations = page.all(WUZZUF["company"]), page.all(WUZZUF["location"])
    out = []
    for k, title in enumerate(page.all(WUZZUF["title"])):
        link = title.first("a")
        href = link.attrs.get("href") if link is not None else None
        out.append({
            "title": title.text(), "company": companies[k].text() if k < len(companies) else "", "location": locations[k].text() if k < len(locations) else "",
            "job_url": BASE_URLS["wuzzuf"] + href if href else "",
        })
    return out


def bayt_records(page: Element) -> list[dict[str, str]]:
    out = []
    for card in page.all(BAYT["card"]):
        title = card.first(BAYT["title"])
        if title is not None and not title.attrs.get("href"):
            continue  # such a card fails
        out.append({
            "title": _text(title), "company": _text(card.first(BAYT["company"])), "location": ", ".join(x.text() for x in card.all(BAYT["location"])),
            "description": _text(card.first(BAYT["description"]), " ").replace("Summary:", "").strip(), "salary": _text(card.first(BAYT["salary"])),
            "experience": _text(card.first(BAYT["experience"])).replace(" · ", " - "), "posted_at_raw": _text(card.first(BAYT["posted_at_raw"])),
            "job_url": _absolute(title.attrs.get("href") if title is not None else None, BASE_URLS["bayt"]),
        })
    return out


def forasna_records(page: Element) -> list[dict[str, str]]:
    out = []
    for card in page.all(FORASNA["card"]):
        link = card.first(FORASNA["link"])
        salary = ""
        for detail in card.all(FORASNA["detail"]):
            name = detail.first(FORASNA["detail_title"])
            if name is not None and FORASNA["salary"] in name.text():
                salary = next((x.text() for x in detail.all("span") if "job-details__title" not in x.classes), "")
                break
        out.append({
            "title": _text(card.first(FORASNA["title"])), "company": _text(card.first(FORASNA["company"])), "location": _text(card.first(FORASNA["location"])), "salary": salary,
            "job_url": _absolute(link.attrs.get("href") if link is not None else None, BASE_URLS["forasna"], BASE_URLS["forasna"]),
        })
    return out


PARSERS: dict[str, Callable[[Element], list[dict[str, str]]]] = {"wuzzuf": wuzzuf_records, "bayt": bayt_records, "forasna": forasna_records}


def parse_listing_pages(pages: DataFrame, source: str) -> DataFrame:
    """A row per posting of each listing page (page_id, html) of a source, with the contract's text fields."""
    parse = PARSERS[source]
    schema = pa.schema([("page_id", pa.int64()), ("ordinal", pa.int32()), *[(f, pa.string()) for f in FIELDS]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(p, k, *[record.get(f, "") for f in FIELDS]) for p, h in zip(*[c.to_pylist() for c in batch.columns], strict=True) for k, record in enumerate(parse(page_of(h)))]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    out = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "html").mapInArrow(run, "page_id bigint, ordinal int, " + ", ".join(f"{f} string" for f in FIELDS))
    return out.withColumn("source", F.lit(source))


def register_table_functions(spark: SparkSession) -> None:
    """parse_listing(html, source) and extract_sections(html) as table functions of SQL, for LATERAL over a table of pages:

    ``SELECT page_id, l.* FROM pages, LATERAL parse_listing(html, 'bayt') l``.  An unknown source is an error, null pages give
    no postings and empty sections.  (Functions of whole Arrow batches can't stand in a LATERAL join, and those of rows with
    useArrow make a table of each row's result; pickled rows go in batches.)"""

    @F.udtf(returnType="ordinal int, " + ", ".join(f"{f} string" for f in FIELDS) + ", source string", useArrow=False)
    class Listing:
        def eval(self, html: str, source: str) -> Iterator[tuple]:
            for k, record in enumerate(PARSERS[source](page_of(html))):
                yield (k, *[record.get(f, "") for f in FIELDS], source)

    @F.udtf(returnType="sections string", useArrow=False)
    class Sections:
        def eval(self, html: str) -> Iterator[tuple]:
            yield (sections_of(html),)

    spark.udtf.register("parse_listing", Listing)
    spark.udtf.register("extract_sections", Sections)


def sections_of(html: str | None, limit: int = 2500) -> str:
    """Texts of the elements that follow a heading of SECTIONS beside it, up to the next heading beside it."""
    parts = []
    for heading in page_of(html).elements():
        if heading.tag not in ("h2", "h3", "h4") or heading.text() not in SECTIONS:
            continue
        beside = [x for x in heading.parent.inside if isinstance(x, Element)]
        for e in beside[next(k for k, x in enumerate(beside) if x is heading) + 1 :]:
            if e.tag in ("h2", "h3", "h4"):
                break
            if e.tag not in _UNREAD and (text := e.text(" ")):
                parts.append(text)
    return " ".join(parts)[:limit]


def extract_sections(pages: DataFrame, limit: int = 2500) -> DataFrame:
    """page_id and the text under the known headings."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame({"page_id": frame.page_id, "sections": [sections_of(h, limit) for h in frame.html]})

    return pages.select("page_id", "html").mapInPandas(run, "page_id bigint, sections string")


_NAME = "struct<name: string>"
_EMBEDDED = (
    f"props struct<pageProps: struct<jobs: array<struct<position: {_NAME}, jobRole: {_NAME}, company: struct<title: string>, location: string, min_salary: string, max_salary: string, currency: string>>>>"
)


def parse_embedded_json(pages: DataFrame, html_col: str = "html", tech_only: bool = True) -> DataFrame:
    """A row per (technical) job in the page's __NEXT_DATA__ script; pages without it give none."""
    body = F.regexp_extract(html_col, r'(?s)<script[^>]*id="__NEXT_DATA__"[^>]*>(.*?)</script>', 1)
    jobs = F.from_json(body, _EMBEDDED)["props"]["pageProps"]["jobs"]
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    out = pages.select("page_id", F.posexplode(jobs).alias("ordinal", "j")).select(
        "page_id", "ordinal", text("j.position.name").alias("title"), text("j.company.title").alias("company"), text("j.location").alias("location"),
        format_salary(F.col("j.min_salary"), F.col("j.max_salary"), F.col("j.currency"), F.lit("")).alias("salary"), text("j.jobRole.name").alias("industry"),
        F.lit(BASE_URLS["jobzella"]).alias("job_url"), F.lit("jobzella").alias("source"),
    )
    return out.where(is_tech(F.col("title"), F.col("industry"))) if tech_only else out
