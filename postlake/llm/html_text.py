"""Main text of web pages from parser events, text-to-tag ratios and Gaussian smoothing.

The standard library's parser turns a page into lines: text between block-level tags, each with the tags met in it.
Elements that never hold article text (menus, headers, footers, forms, scripts, elements whose class or id names an
advert, a notice, a side bar or reader comments) give no lines.  A line's ratio is its characters to its tags; ratios are
smoothed with a Gaussian along the page and split into two clusters by an iterated threshold.

Lines of the high cluster are content, unless they are link lines (most of their text is in links) of a low ratio of
their own.  On a page with articles or mains, each of these that holds a content line, or another line of a high ratio
of its own, is content as a whole (if none does, the one with most text), but for runs of at least LINK_RUN low link lines; lines of a main around such an article
follow the rule for bodies.  On other pages, and there, content lines form regions: a region grows over the paragraphs,
headings, items and cells beside it, and two of them over what lies between them if no link line does; what lies in none
is dropped.  If nothing is high but links, they stay.  Ties in text go to the earlier container.

A class or id is a notice if it consists of words that name one and of words of layout ("left-sidebar", but neither
"with-sidebar" nor "related-work").  Such an element is dropped at any length, as are forms, noscripts, dialogs and
objects, unless it is a wrapper: it holds an article or main while none lies elsewhere, else the page's only h1.  Where
no text is left without them, outermost such elements with a heading, paragraph, item or cell stay.  What names reader
comments or consent is no wrapper, nor is a noscript, dialog or object without article, main or h1.  A head ends with
its end tag, with <body> or with the first content that no head can hold.

A tag that doesn't end within NEAR characters is looked for in the whole rest; after FAR such searches in vain what looks
like a tag longer than NEAR / 4 is text, so that time is bounded by the page's length.

Null and empty pages give an empty text.  Pages of any length and depth are read whole; unclosed elements end with their
parents; nothing is capped.  Repeated rows each get a row, an empty table gives none.  Other columns stay; text and n_chars
replace columns of these names.
"""

from __future__ import annotations

import functools
import math
import re
from collections.abc import Iterator
from html import unescape
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_SKIP = frozenset("nav footer aside script style template svg iframe select button textarea head menu canvas".split())
#: Dropped unless they are wrappers.
_SOFT = frozenset("form noscript dialog object".split())
_BLOCK = frozenset(
    "address article blockquote body caption center dd details div dl dt fieldset figcaption figure h1 h2 h3 h4 h5 h6 header hr html li main ol p "
    "pre section summary table tbody td tfoot th thead tr ul".split()
)
_NOTICE = frozenset(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr notice popup modal overlay sidebar "
    "menu nav navbar navigation navigational breadcrumb breadcrumbs footer masthead toolbar pagination pager share sharing social newsletter subscribe "
    "subscription related recommended comments comment disqus replies respond login signup widget".split()
)
#: Words of notices that are never wrappers.
_NEVER = frozenset("ad ads adv advert adverts advertisement advertising cookie cookies consent gdpr popup modal newsletter subscribe subscription comments comment disqus replies respond".split())
#: Words of layout that may stand beside those of a notice in one class or id.
_LAYOUT = frozenset(
    "a area article articles bar block body bottom box button buttons center col column component container content desktop element entry fixed foot global group head header icon icons "
    "id inner item items js layer left line link links list main mobile module news outer page panel post posts primary right row secondary section side site slot small sticky stories story "
    "text the title toggle top unit view wide wp wrap wrapper".split()
)
#: What a head can hold; anything else ends it.
_HEAD = frozenset("base link meta title style script noscript template".split())
_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar toolbar".split())
#: End tags that a start tag implies: a new item or cell ends the last one, a block ends a paragraph.
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"tr", "td", "th"}, "option": {"option"}}
#: Blocks over which a region of a body grows.
_TEXT_BLOCKS = frozenset("p h1 h2 h3 h4 h5 h6 pre blockquote li dd dt td th figcaption caption".split())
#: Link lines in a row that are a list of links inside an article.
LINK_RUN = 3
#: Characters within which a tag's end is looked for first, and searches of the whole rest that may fail.
NEAR, FAR = 1024, 32
_SPACE = re.compile(r"\s+")
_HUMP = re.compile(r"([a-z])([A-Z])")


@functools.lru_cache(1 << 16)
def names_notice(name: str) -> bool:
    """Whether a class or id consists of words of notices and of layout."""
    words = _words(name)
    return any(w in _NOTICE for w in words) and all(w in _NOTICE or w in _LAYOUT for w in words)


def _words(name: str) -> list[str]:
    return [w for w in re.split(r"[^a-z]+", _HUMP.sub(r"\1-\2", name).lower()) if w]


class Lines(HTMLParser):
    """Collects [container, (text, notice) parts, tags, block, characters in links] for each line of a page."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, bool, int, int, str]] = []  # tag, skipped, container, notice, innermost block
        self.at: dict[str, list[int]] = {}  # places in the stack by tag
        self.lines: list[list] = []
        self.around: list[int] = [0]  # the container around each container; the body is 0
        self.notices: list[int] = [0]  # the notice around each notice; 0 is none
        self.kinds: list[str] = [""]  # of each notice: its tag if that is soft, "never" if it is no wrapper, else "named"
        self.holding: set[int] = set()  # notices in which an article or main opens
        self.headed: set[int] = set()  # notices in which an h1 opens
        self.plain_h1 = False  # whether one opens elsewhere
        self.failed, self.endless = 0, False
        self.open: list | None = None
        self.tags = 0
        self.link = False

    def _break(self) -> None:
        if self.open is not None:
            self.open[2] += self.tags
            self.tags = 0
        self.open = None

    def check_for_whole_start_tag(self, i: int) -> int:
        """Where the tag at i ends, -1 if it doesn't, without searching the rest of the page for each of many such tags."""
        whole = self.rawdata
        near = NEAR if self.failed < FAR else NEAR // 4
        if len(whole) - i <= near:
            return super().check_for_whole_start_tag(i)
        self.rawdata = whole[i : i + near]
        try:
            end = super().check_for_whole_start_tag(0)
        finally:
            self.rawdata = whole
        if 0 <= end < near:
            return i + end
        if self.failed >= FAR:
            return -1
        end = super().check_for_whole_start_tag(i)
        self.failed += end < 0
        return end

    def parse_comment(self, i: int, report: bool = True) -> int:
        """A comment without an end is looked for once: none after it has one."""
        if self.endless:
            return -1
        end = super().parse_comment(i, report)
        self.endless = end < 0
        return end

    def read(self, html: str) -> None:
        """The page in one piece.  After the last > no tag can end: what is there is text."""
        last = html.rfind(">") + 1
        self.feed(html[:last])
        self.close()
        self.handle_data(unescape(html[last:]))

    def _state(self) -> tuple[bool, int, int, str]:
        return self.stack[-1][1:] if self.stack else (False, 0, 0, "")

    def _cut(self, place: int) -> None:
        """Ends the elements from this place of the stack on."""
        while len(self.stack) > place:
            self.at[self.stack.pop()[0]].pop()

    def handle_starttag(self, tag: str, attrs: list) -> None:
        self.tags += 1
        if self.at.get("head") and (tag == "body" or (self.stack[-1][0] == "head" and tag not in _HEAD)):
            self._break()
            self._cut(self.at["head"][-1])
        if tag in _BLOCK:
            self._break()
            ends = _CLOSES.get(tag, {"p"})
            if self.stack and self.stack[-1][0] in ends:
                self._cut(len(self.stack) - 1)
        if tag == "a":
            self.link = any(name == "href" for name, _ in attrs)
        if tag in _VOID:
            if tag == "br":
                self.handle_data(" ")
            return
        skipped, container, notice, block = self._state()
        if tag in ("article", "main") and not skipped:
            self.around.append(container)
            container = len(self.around) - 1
        elif tag == "body":
            container = 0
        skipped = skipped or tag in _SKIP or (tag == "header" and not self.at.get("article")) or self._is_hidden(tag, dict(attrs))
        if not skipped and (tag in _SOFT or self._is_notice(tag, dict(attrs))):
            self.notices.append(notice)
            self.kinds.append("never" if self._is_never(dict(attrs)) else tag if tag in _SOFT else "named")
            notice = len(self.notices) - 1
        elif tag in ("article", "main", "h1") and not skipped:
            self.plain_h1 |= tag == "h1" and not notice
            at, held = notice, self.headed if tag == "h1" else self.holding
            while at and at not in held:
                held.add(at)
                at = self.notices[at]
        self.at.setdefault(tag, []).append(len(self.stack))
        self.stack.append((tag, skipped, container, notice, tag if tag in _BLOCK else block))

    @staticmethod
    def _is_hidden(tag: str, attrs: dict) -> bool:
        if tag in ("html", "body", "article", "main"):
            return False
        return (attrs.get("role") or "").lower() in _ROLES or attrs.get("hidden", "no") != "no" or (attrs.get("aria-hidden") or "") == "true"

    @staticmethod
    def _is_notice(tag: str, attrs: dict) -> bool:
        if tag in ("html", "body", "main"):
            return False
        return any(names_notice(name) for name in (attrs.get("class") or "").split() + (attrs.get("id") or "").split())

    @staticmethod
    def _is_never(attrs: dict) -> bool:
        names = (attrs.get("class") or "").split() + (attrs.get("id") or "").split()
        return any(w in _NEVER for name in names if names_notice(name) for w in _words(name))

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        if tag in _BLOCK:
            self._break()
        if tag in _BLOCK or tag == "a":
            self.link = False
        if not self.at.get(tag):
            return
        place = self.at[tag][-1]
        walls = () if tag in ("article", "main", "body", "html", "table") else ("article", "body", "table")
        if all(not self.at.get(w) or self.at[w][-1] < place for w in walls):
            self._cut(place)

    def handle_data(self, data: str) -> None:
        if self.stack and self.stack[-1][0] == "head" and data.strip():
            self._cut(len(self.stack) - 1)
        skipped, container, notice, block = self._state()
        if skipped or not data:
            return
        if self.open is None:
            if not data.strip():
                return
            self.open = [container, [], 0, block, 0]
            self.lines.append(self.open)
        self.open[1].append((data, notice))
        self.open[4] += len(data.strip()) if self.link else 0
        self.open[2] += self.tags
        self.tags = 0

    def page_lines(self) -> list[tuple[int, str, int, str, bool]]:
        """Container, text, tags, block and whether most of it is links, of the lines that no notice drops."""
        may = [k for k in range(1, len(self.notices)) if self.kinds[k] != "never"]

        def left(wrappers: set[int]) -> list:
            dropped = [False]
            for k in range(1, len(self.notices)):  # a notice has a larger number than the one around it
                dropped.append(dropped[self.notices[k]] or k not in wrappers)
            made = ((line, _SPACE.sub(" ", "".join([part for part, notice in line[1] if not dropped[notice]])).strip()) for line in self.lines)
            return [(line, text) for line, text in made if text]

        kept = left(set())
        if not any(line[0] for line, _ in kept):
            # No article or main outside of notices.
            if held := {k for k in may if k in self.holding}:
                kept = left(held)
            elif not self.plain_h1 and (headed := {k for k in may if k in self.headed}):
                kept = left(headed)
            elif not kept:
                # Outermost ones that hold blocks of text.
                full = {notice for line in self.lines if line[3] in _TEXT_BLOCKS for _, notice in line[1]}
                kept = left({k for k in may if not self.notices[k] and self.kinds[k] in ("named", "form") and k in full})
        return [(line[0], text, line[2], line[3], 2 * line[4] > len(text)) for line, text in kept]


def smoothed(values: list[float], sigma: float = 2.0) -> list[float]:
    """Gaussian smoothing; at the ends the weights that remain are scaled to one."""
    reach = max(1, math.ceil(3 * sigma))
    weights = [math.exp(-(d * d) / (2 * sigma * sigma)) for d in range(-reach, reach + 1)]
    out = []
    for i in range(len(values)):
        low, high = max(0, i - reach), min(len(values), i + reach + 1)
        used = weights[low - i + reach : high - i + reach]
        out.append(sum(w * v for w, v in zip(used, values[low:high], strict=True)) / sum(used))
    return out


def threshold(values: list[float], rounds: int = 20) -> float:
    """The middle between the means of two clusters, found by iteration from the overall mean."""
    t = sum(values) / len(values)
    for _ in range(rounds):
        low, high = [v for v in values if v < t], [v for v in values if v >= t]
        if not low or not high:
            break
        new = (sum(low) / len(low) + sum(high) / len(high)) / 2
        if abs(new - t) < 1e-9:
            break
        t = new
    return t


def main_text(html: str | None, sigma: float = 2.0) -> str:
    """The page's article, one block a line."""
    if not html:
        return ""
    parser = Lines()
    parser.read(html)
    lines = parser.page_lines()
    if not lines:
        return ""
    own = [len(text) / max(1, tags) for _, text, tags, _, _ in lines]
    ratios = smoothed(own, sigma)
    limit = threshold(ratios)
    high = [ratio >= limit for ratio in ratios]
    links = [link for *_, link in lines]
    core = [h and not (link and ratio < limit) for h, link, ratio in zip(high, links, own, strict=True)]
    text = [block in _TEXT_BLOCKS and not link for _, _, _, block, link in lines]
    named = {c for c, *_ in lines if c}
    if named:
        dense = [c or (ratio >= limit and not link) for c, ratio, link in zip(core, own, links, strict=True)]
        chosen = {line[0] for line, yes in zip(lines, dense, strict=True) if yes and line[0]} or {max(named, key=lambda c: (sum(len(line[1]) for line in lines if line[0] == c), -c))}
        beside = _beside(chosen, named, parser.around)
        inside = [k for k, line in enumerate(lines) if line[0] in chosen | beside]
        free = [lines[k][0] in beside for k in inside]
        begun = _without_link_runs([links[k] for k in inside], [high[k] for k in inside])
        begun = [core[k] if f else keep for f, keep, k in zip(free, begun, inside, strict=True)]
        kept = _regions(begun, [f and text[k] for f, k in zip(free, inside, strict=True)], [links[k] for k in inside], free)
    else:
        inside, kept = range(len(lines)), _regions(core, text, links)
    return "\n".join(lines[k][1] for k, keep in zip(inside, kept, strict=True) if keep or not any(kept))


def _beside(chosen: set[int], named: set[int], around: list[int]) -> set[int]:
    """The articles and mains around the chosen ones, and those in them that aren't chosen."""
    out: set[int] = set()
    for c in chosen:
        while c := around[c]:
            out.add(c)
    for c in named - chosen:
        at = c
        while at and at not in chosen:
            at = around[at]
        out |= {c} if at else set()
    return out


def _without_link_runs(links: list[bool], high: list[bool]) -> list[bool]:
    """Which lines stay when runs of at least LINK_RUN low link lines go."""
    kept = [True] * len(links)
    begin = 0
    for k in range(len(links) + 1):
        if k == len(links) or not links[k] or high[k]:
            if k - begin >= LINK_RUN:
                kept[begin:k] = [False] * (k - begin)
            begin = k + 1
    return kept


def _regions(core: list[bool], text: list[bool], links: list[bool], free: list[bool] | None = None) -> list[bool]:
    """The core lines, the text lines that join them without a gap, and gaps without link lines; of lines that aren't
    ``free`` only the core."""
    kept = list(core)
    for order in (range(1, len(kept)), range(len(kept) - 2, -1, -1)):
        for k in order:
            kept[k] = kept[k] or (text[k] and kept[k - order.step])
    last = None
    for k in [k for k, keep in enumerate(kept) if keep]:
        if last is not None and not any(links[last + 1 : k]):
            for j in range(last + 1, k):
                kept[j] = kept[j] or free is None or free[j]
        last = k
    return kept


def extract_main_text(pages: DataFrame, html_col: str = "html", sigma: float = 2.0) -> DataFrame:
    """The pages without the html, with text and n_chars (code points of text); columns of these names are replaced."""
    from pyspark.sql import types as T
    from pyspark.sql.pandas.types import to_arrow_schema

    kept = [f for f in pages.schema if f.name not in (html_col, "text", "n_chars")]
    schema = T.StructType([*kept, T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])
    arrow = to_arrow_schema(schema)
    html = html_col

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x, sigma) for x in batch.column(html).to_pylist()]
            made = {"text": pa.array(texts, pa.string()), "n_chars": pa.array([len(t) for t in texts], pa.int64())}
            yield pa.RecordBatch.from_arrays([made.get(f.name, None) if f.name in made else batch.column(f.name).cast(f.type) for f in arrow], schema=arrow)

    return pages.select(*[f.name for f in kept], html).mapInArrow(run, schema)
