"""Bill texts: extraction from pages, choice of the extractor, weighted search postings."""

from __future__ import annotations

import re
from collections.abc import Callable
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType

from billforge.functions import scalars

_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}


class _Picker(HTMLParser):
    """Collects the text of elements that a test accepts; nested matches belong to the outer one."""

    def __init__(self, accepts: Callable[[str, dict[str, str]], bool]) -> None:
        super().__init__(convert_charrefs=True)
        self.accepts, self.depth, self.hidden, self.found = accepts, 0, 0, []

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in ("script", "style"):
            self.hidden += 1
        if tag in _VOID:
            return
        if self.depth:
            self.depth += 1
        elif self.accepts(tag, {k: v or "" for k, v in attrs}):
            self.depth = 1
            self.found.append("")

    def handle_endtag(self, tag: str) -> None:
        if tag in ("script", "style"):
            self.hidden = max(0, self.hidden - 1)
        if self.depth and tag not in _VOID:
            self.depth -= 1

    def handle_data(self, data: str) -> None:
        if self.depth and not self.hidden:
            self.found[-1] += data


def pick(html: str | None, mode: str, selector: str) -> str:
    """The text of the elements of a tag, class or id, joined by line feeds; none gives an empty text."""
    tests = {"tag": lambda t, a: t == selector, "class": lambda t, a: selector in a.get("class", "").split(), "id": lambda t, a: a.get("id") == selector}
    parser = _Picker(tests[mode])
    parser.feed(html or "")
    parser.close()
    return "\n".join(x.strip() for x in parser.found)


def html_text(html: Column, mode: str = "tag", selector: str = "p") -> Column:
    """pick() over a column; Arrow batches, since HTML need not be well-formed and SQL's xpath needs that."""

    @F.pandas_udf(StringType())
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda x: pick(x, mode, selector))

    return run(html)


#: Extractors by name: column expressions from a document's raw text to its text.
EXTRACTORS: dict[str, Callable[[Column], Column]] = {
    "plain": scalars.clean_text,
    "numbered": lambda x: scalars.numbered_lines(scalars.clean_text(x)),
    "numbered_after": lambda x: scalars.numbered_lines(scalars.clean_text(x), after=False),
    "sometimes_numbered": lambda x: scalars.sometimes_numbered(scalars.clean_text(x)),
    "paragraphs": lambda x: html_text(x, "tag", "p"),
    "pre": lambda x: html_text(x, "tag", "pre"),
    "code": lambda x: html_text(x, "tag", "code"),
    "skip": lambda x: F.lit(None).cast("string"),
    "empty": lambda x: F.lit(""),
}


def extract(rows: DataFrame, rules: list[tuple[str | None, str, str]], place: str, media: str, raw: str, default: str = "plain") -> DataFrame:
    """rows with extractor and text, chosen by the first rule (place or None for any, media type, extractor) that fits."""
    chosen = F.lit(default)
    for p, m, name in reversed(rules):
        fits = F.col(media) == m if p is None else (F.col(place) == p) & (F.col(media) == m)
        chosen = F.when(fits, name).otherwise(chosen)
    rows = rows.withColumn("extractor", chosen)
    text = None
    for name in dict.fromkeys([default, *(r[2] for r in rules)]):
        got = EXTRACTORS[name](F.when(F.col("extractor") == name, F.col(raw)))
        text = F.when(F.col("extractor") == name, got) if text is None else text.when(F.col("extractor") == name, got)
    return rows.withColumn("text", text)


STOP = "a an and any are as at be been but by for from has have if in into is it its may no not of on or shall such than that the their there this to under upon was were which will with".split()
_SUFFIX = re.compile(r"(?:ations?|ings?|edly|ed|es|ly|s)$")


def stem(word: Column) -> Column:
    """A light English stem: common endings off words of five letters or more."""
    return F.when(F.length(word) >= 5, F.regexp_replace(word, _SUFFIX.pattern, "")).otherwise(word)


def postings(rows: DataFrame, key: str, title: str, text: str) -> DataFrame:
    """(key, term, weight, n, first_position): weight A for terms of the title, B for those of the text only."""
    tokens = lambda c: F.filter(F.split(F.lower(F.coalesce(F.col(c), F.lit(""))), "[^a-z0-9]+"), lambda w: (w != "") & ~w.isin(*STOP))
    both = F.concat(F.transform(tokens(title), lambda w: F.struct(w.alias("w"), F.lit("A").alias("c"))), F.transform(tokens(text), lambda w: F.struct(w.alias("w"), F.lit("B").alias("c"))))
    each = rows.select(key, F.posexplode(both).alias("position", "t")).select(key, "position", stem(F.col("t.w")).alias("term"), F.col("t.c").alias("c"))
    return each.groupBy(key, "term").agg(F.min("c").alias("weight"), F.count(F.lit(1)).alias("n"), F.min("position").alias("first_position"))
