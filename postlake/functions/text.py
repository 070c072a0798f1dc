"""Column expressions on strings."""

from __future__ import annotations

import functools
import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .. import reference as ref

#: White space as Unicode has it; Java's \s is ASCII only.
SPACE = r"[\s\p{Z}]"
NOT_BLANK = r"[^\s\p{Z}]"


def bound(c: Column, f) -> Column:
    """f of the column's value, which is made once however often f uses it."""
    return F.get(F.transform(F.array(c), f), F.lit(0))


def strip(c: Column) -> Column:
    """Without white space of any kind at either end."""
    return F.regexp_replace(c, rf"^{SPACE}+|{SPACE}+$", "")


def blank_to(c: Column, value: str) -> Column:
    """Stripped; null and blank become the value."""
    return bound(strip(c), lambda s: F.when(F.coalesce(s, F.lit("")) == "", F.lit(value)).otherwise(s))


class _Text(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.parts: list[str] = []

    def handle_data(self, data: str) -> None:
        self.parts.append(data)


def _html_text(html: str | None) -> str | None:
    if html is None:
        return None
    p = _Text()
    p.feed(html)
    p.close()
    return "".join(p.parts)


@F.pandas_udf(StringType())
def _strip_html(html: pd.Series) -> pd.Series:
    full = html.notna()
    out = pd.Series([None] * len(html), index=html.index, dtype=object)
    if full.any():
        out[full] = [_html_text(h) for h in html[full]]
    return out


#: A tag without quotes or references, of an element whose content is read as markup.
_PLAIN_TAG = r"(?i)</?(?!(?:script|style|title|textarea|xmp|iframe|noembed|noframes|noscript|plaintext)[\s/>])[a-z][a-z0-9]*(?:[\s/][^<>&\"']*)?>"

#: References that are decoded without a parser, & last as it may stand before the others' names.
_REFERENCES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&amp;", "&"))


def strip_html(c: Column) -> Column:
    """Text of a fragment with both < and >, other strings as they are.  Fragments that have only plain tags and the most
    common references are handled in place; others are parsed."""

    def in_place(x: Column) -> Column:
        def decoded(bare: Column) -> Column:
            out = functools.reduce(lambda t, r: F.replace(t, F.lit(r[0]), F.lit(r[1])), _REFERENCES, bare)
            return F.when(~F.regexp_replace(bare, "&(?:lt|gt|quot|amp);", "").rlike("[<>&]"), out)

        return F.when(x.contains("<") & x.contains(">"), bound(F.regexp_replace(x, _PLAIN_TAG, ""), decoded)).otherwise(x)

    easy = bound(c, in_place)
    return F.coalesce(easy, _strip_html(F.when(easy.isNull(), c)))


def clean_text(c: Column, html: bool = True) -> Column:
    """Letters, numbers, _ - . ( ) / , and single spaces only."""
    t = strip_html(c) if html else c
    t = F.regexp_replace(t, r"[^\p{L}\p{N}_\s\p{Z}.()/,-]", "")
    return F.coalesce(strip(F.regexp_replace(t, rf"{SPACE}+", " ")), F.lit(""))


def strip_title_noise(c: Column, html: bool = True) -> Column:
    """Without what brackets enclose (first to last) and without advertising words, then cleaned."""

    def noise(x: Column) -> Column:
        # One after the other: what is left of a removed word may be another.
        without = functools.reduce(lambda t, word: F.regexp_replace(t, f"(?i){word}", ""), ref.TITLE_NOISE, x)
        return F.when(x.rlike("(?i)" + "|".join(ref.TITLE_NOISE)), without).otherwise(x)

    t = bound(c, lambda x: F.when(x.contains("("), F.regexp_replace(x, r"\([^\n]*\)", "")).otherwise(x))
    t = bound(t, lambda x: F.when(x.contains("["), F.regexp_replace(x, r"\[[^\n]*\]", "")).otherwise(x))
    return clean_text(bound(t, noise), html)


def company_clean(c: Column, html: bool = True) -> Column:
    return blank_to(clean_text(blank_to(c, "Confidential"), html), "Confidential")


def job_hash(title: Column, company: Column, city: Column) -> Column:
    return F.md5(F.concat_ws("|", *[F.lower(strip(F.coalesce(c, F.lit("")))) for c in (title, company, city)]))


def first_match(c: Column, rules, default: Column) -> Column:
    """The name of the first rule of which a word occurs in the string."""

    def choose(x: Column) -> Column:
        out = F
        for name, words in rules:
            out = out.when(functools.reduce(lambda a, b: a | b, [x.contains(w) for w in words]), F.lit(name))
        return out.otherwise(default)

    return bound(c, choose)


def joined_lower(*texts: Column) -> Column:
    """Non-blank texts, joined by a space."""
    return F.lower(F.concat_ws(" ", *[F.when(t.rlike(NOT_BLANK), t) for t in texts]))


def automaton(words: list[str]) -> str:
    """One pattern for many words, as a tree of their characters: the longest that begins at a place."""
    tree: dict = {}
    for w in words:
        node = tree
        for ch in w:
            node = node.setdefault(ch, {})
        node[""] = {}

    def pattern(node: dict) -> str:
        branches = [(re.escape(ch) if not ch.isalnum() else ch) + pattern(child) for ch, child in node.items() if ch]
        if not branches:
            return ""
        one = branches[0] if len(branches) == 1 else "(?:" + "|".join(branches) + ")"
        return f"(?:{one})?" if "" in node else one

    return pattern(tree)


def hits(x: Column, words: list[str]) -> Column:
    """The longest of the words at each place of a string where one begins.  One pass, whatever the number of words."""
    return F.regexp_extract_all(x, F.lit(f"(?=({automaton(words)}))"), F.lit(1))


def _literal_map(of: dict[str, object]) -> Column:
    return F.create_map(*[F.lit(v) if not isinstance(v, list) else F.array(*map(F.lit, v)) for pair in of.items() for v in pair])


def normalize_location(c: Column) -> Column:
    """struct(city, governorate) of the first place of the list that is named."""
    ranks = {word: k + 1 for k, (word, _, _) in reversed(list(enumerate(ref.LOCATIONS)))}
    # The word that is found at a place stands for those it begins with, too.
    least = {w: min(r for v, r in ranks.items() if w.startswith(v)) for w in ranks}
    places = F.array(*[F.struct(F.lit(city).alias("city"), F.lit(gov).alias("governorate")) for _, city, gov in (*ref.LOCATIONS, ("", "Unknown", "Egypt"))])
    found = F.transform(hits(F.lower(c), list(ranks)), lambda w: F.element_at(_literal_map(least), w))
    return F.element_at(places, F.coalesce(F.array_min(found), F.lit(len(ref.LOCATIONS) + 1)))


def word_pattern(word: str, open_ended: bool = False) -> str:
    """The word, not within a longer run of a-z and 0-9."""
    return r"(?<![a-z0-9])" + re.sub(r"([^a-z0-9 ])", r"\\\1", word.lower()) + ("" if open_ended else r"(?![a-z0-9])")


def skill_pattern(words: tuple[str, ...]) -> str:
    return "|".join(word_pattern(w, w in ref.OPEN_ENDED) for w in words)


def _named(blob: Column, names: list[tuple[str, tuple[str, ...], str]]) -> Column:
    """The names of which a pattern occurs.  Most texts name few skills: a pattern is searched for only where one of its
    words occurs at all."""
    has = lambda x, words: functools.reduce(lambda a, b: a | b, [x.contains(w.lower()) for w in words])
    return bound(blob, lambda x: F.array_compact(F.array(*[F.when(has(x, words), F.when(x.rlike(p), F.lit(n))) for n, words, p in names])))


def extract_skills(*texts: Column) -> Column:
    """Skills named in the texts, in the lexicon's order.

    One pass finds the longest word at each place that doesn't follow a-z or 0-9; a word also stands for those that it
    begins with and whose own end is a border in it.  A word that may not be followed by a-z or 0-9 gives way to a
    shorter one where it is."""
    closed, opened = [], []
    of: dict[str, list[str]] = {}
    for name, _, words in ref.SKILLS:
        for w in words:
            (opened if w in ref.OPEN_ENDED else closed).append(w.lower())
    border = lambda w, v: v == w or v in opened or not re.match("[a-z0-9]", w[len(v)])
    for w in [*closed, *opened]:
        of[w] = [name for name, _, words in ref.SKILLS if any(w.startswith(v.lower()) and border(w, v.lower()) for v in words)]
    longest = sorted(of, key=len, reverse=True)
    branches: dict[str, list[str]] = {}
    for w in longest:
        branches.setdefault(w[0], []).append(re.escape(w[1:]) + ("" if w in opened else "(?![a-z0-9])"))
    pattern = "(?<![a-z0-9])(?=(" + "|".join(re.escape(first) + "(?:" + "|".join(rest) + ")" for first, rest in branches.items()) + "))"
    found = lambda x: F.flatten(F.transform(F.regexp_extract_all(x, F.lit(pattern), F.lit(1)), lambda w: F.element_at(_literal_map(of), w)))
    names = F.array(*[F.lit(name) for name, *_ in ref.SKILLS])
    return bound(found(joined_lower(*texts)), lambda y: F.when(F.size(y) == 0, F.array().cast("array<string>")).otherwise(F.array_intersect(names, y)))


def detect_skills_in_title(title: Column, names: list[str]) -> Column:
    """Names of a dimension that occur as words of a title."""
    return _named(F.lower(F.coalesce(title, F.lit(""))), [(n, (n,), word_pattern(n)) for n in names])


def classify_work_mode(*texts: Column) -> Column:
    return first_match(joined_lower(*texts), ref.WORK_MODES, F.lit("on-site"))


def classify_employment_type(*texts: Column) -> Column:
    return first_match(joined_lower(*texts), ref.EMPLOYMENT_TYPES, F.lit("full-time"))


def is_remote(work_mode: Column) -> Column:
    return work_mode == "remote"


def split_skills(c: Column) -> Column:
    """Names between | signs, trimmed, without blanks; of names that differ in case, the first."""
    names = F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), r"\|"), strip), lambda x: x != "")
    return F.aggregate(
        names, F.array().cast("array<string>"),
        lambda done, x: F.when(F.exists(done, lambda y: F.lower(y) == F.lower(x)), done).otherwise(F.array_append(done, x)),
    )


def seniority(title: Column) -> Column:
    return first_match(F.lower(title), ref.SENIORITIES, F.lit("Unspecified"))


def normalize_source(c: Column) -> Column:
    return F.lower(strip(F.coalesce(c, F.lit("unknown"))))


def short_label(c: Column, limit: int = 18, keep: int = 16) -> Column:
    return F.when(F.length(c) > limit, F.concat(F.substring(c, 1, keep), F.lit("…"))).otherwise(c)


def month_label(month_name: Column, year: Column) -> Column:
    return F.concat_ws(" ", F.substring(month_name, 1, 3), year.cast("string"))


def display_label(c: Column) -> Column:
    return F.regexp_replace(c, "[_-]", " ")


def is_tech(title: Column, industry: Column) -> Column:
    blob = F.lower(F.concat_ws(" ", title, industry))
    return functools.reduce(lambda a, b: a | b, [blob.contains(w) for w in ref.TECH_WORDS])


def categorize(title: Column) -> Column:
    """The category with most keywords in the title; the earlier of equals; Other if none."""
    rules = [(k, name, words) for k, (name, words) in enumerate(ref.CATEGORIES) if words]
    words = sorted({w for _, _, ws in rules for w in ws})
    of = {w: [v for v in words if w.startswith(v)] for w in words}

    def choose(found: Column) -> Column:
        score = lambda ws: F.size(F.array_intersect(found, F.array(*map(F.lit, ws))))
        best = F.array_max(F.array(*[F.struct(score(ws).alias("score"), F.lit(-k).alias("rank"), F.lit(name).alias("name")) for k, name, ws in rules]))
        return F.when(F.size(found) == 0, "Other").otherwise(best["name"])

    found = F.flatten(F.transform(hits(F.lower(F.coalesce(title, F.lit(""))), words), lambda w: F.element_at(_literal_map(of), w)))
    return bound(found, choose)
