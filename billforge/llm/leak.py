"""Evaluation texts that leaked into a corpus: one Aho-Corasick automaton over the normalised items, one scan of each text.

Texts are matched as a reader sees them: as the stream of their letters and digits, without letter case, accents, markup,
invisible characters, punctuation and blanks, so that it does not matter how a word was broken. The automaton holds seeds:
the letters of every SPACING-th sequence of SEED words of each item. Any ten successive words of an item hold such a seed,
so no passage is missed. A hit is extended word by word in both directions, with its offsets mapped to the original text, and
counts if at least ``words`` successive words of the item are there, beginning and ending between words.

Scale: a map over the documents, without shuffle until the distinct pairs (few), that reads them once. The automaton grows with
the items only, which are broadcast once; every Python worker builds it once and keeps it for all its tasks. Evaluation items are
far fewer than documents by their nature: 240 items make 3,000 seeds, and a seed takes about a kilobyte.
"""

from __future__ import annotations

import hashlib
import html
import re
import unicodedata
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame

from billforge.session import spread

#: The scanner of this Python worker, by the items it was built from.
_BUILT: dict[tuple[str, int], Scanner] = {}
_TAG = re.compile(r"<(?:[a-zA-Z/!?][^<>]*)>")
_ENTITY = re.compile(r"&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[a-zA-Z][a-zA-Z0-9]{1,30});")
_PIECE = re.compile(f"{_TAG.pattern}|{_ENTITY.pattern}|.", re.S)
_OUT = re.compile(r"[\W_]+")
_SEEN: dict[str, tuple[str, bool]] = {}


def _plain(text: str) -> str:
    """The letters and digits of a text without markup and entities."""
    if not text.isascii():
        text = unicodedata.normalize("NFKD", unicodedata.normalize("NFKD", text).casefold())
    return _OUT.sub("", text.lower())


def letters(text: str) -> str:
    """The stream of letters and digits that is matched."""
    if "<" in text:
        text = _TAG.sub("", text)
    if "&" in text:
        text = _ENTITY.sub(lambda m: html.unescape(m[0]), text)
    return _plain(text)


def mapped(text: str) -> tuple[str, list[int], list[int], list[bool]]:
    """letters(text), for each of them where it starts and ends in the text, and whether a word may begin there."""
    out, start, end, first = [], [], [], []
    gap = True
    for m in _PIECE.finditer(text):
        piece = m[0]
        if len(piece) > 1 and piece[0] == "<":
            gap = True
            continue
        known = _SEEN.get(piece)
        if known is None:
            shown = html.unescape(piece) if len(piece) > 1 else piece
            hidden = all(unicodedata.category(c) in ("Cf", "Mn", "Me", "Cc") and c not in "\t\n\v\f\r\x85" for c in shown)
            known = _SEEN[piece] = (_plain(shown), hidden)
        own, hidden = known
        if not own:
            gap = gap or not hidden
            continue
        for c in own:
            out.append(c)
            start.append(m.start())
            end.append(m.end())
            first.append(gap)
            gap = False
    return "".join(out), start, end, first


def item_words(text: str) -> list[str]:
    """The words of an item as a reader counts them: what stands between blanks and has a letter or digit."""
    return [w for w in (letters(x) for x in _TAG.sub(" ", text).split()) if w]


class Scanner:
    """One automaton over items (id, text). Items with fewer than ``words`` words, or none, can not leak."""

    def __init__(self, items: list[tuple[int, str]], words: int) -> None:
        self.words, seed = words, max(1, words // 2)
        spacing = words - seed + 1
        self.items = {i: w for i, t in items if t and len(w := item_words(t)) >= words}
        self.automaton = ahocorasick.Automaton()
        seeds: dict[str, list[tuple[int, int]]] = {}
        for i, w in self.items.items():
            for k in range(0, len(w) - seed + 1, spacing):
                seeds.setdefault("".join(w[k : k + seed]), []).append((i, k))
        for text, where in seeds.items():
            self.automaton.add_word(text, (len(text), where))
        if seeds:
            self.automaton.make_automaton()

    def spans(self, text: str | None) -> list[tuple[int, int, int, int]]:
        """(item, from, to, words): the longest passages of items in the text, by offsets in the original."""
        if not text or not self.items:
            return []
        stream = letters(text)
        hits = [(e + 1 - n, where) for e, (n, where) in self.automaton.iter(stream)]
        if not hits:
            return []
        stream, start, end, first = mapped(text)
        begins = [k for k, x in enumerate(first) if x] + [len(stream)]
        is_begin = set(begins)
        out: dict[tuple[int, int, int], int] = {}
        for at, where in hits:
            for item, k in where:
                w = self.items[item]
                left, i = at, k
                best_left, best_i = (at, k) if at in is_begin else (None, k)
                while i and stream.startswith(w[i - 1], left - len(w[i - 1])) and left >= len(w[i - 1]):
                    i, left = i - 1, left - len(w[i - 1])
                    if left in is_begin:
                        best_left, best_i = left, i
                right, j = at, k
                best_right, best_j = at, k
                while j < len(w) and stream.startswith(w[j], right):
                    right, j = right + len(w[j]), j + 1
                    if right in is_begin:
                        best_right, best_j = right, j
                if best_left is None:  # the seed begins inside a word: a later word of it may begin one
                    i, left = k, at
                    while i < best_j and left not in is_begin:
                        left, i = left + len(w[i]), i + 1
                    best_left, best_i = left, i
                if best_j - best_i >= self.words:
                    out[item, start[best_left], end[best_right - 1]] = best_j - best_i
        return [(*x, n) for x, n in sorted(out.items())]


def _scan(items: Broadcast, name: str, words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if (name, words) not in _BUILT:
            _BUILT.clear()
            _BUILT[name, words] = Scanner(items.value, words)
        scanner = _BUILT[name, words]
        for b in batches:
            rows = [(d, *s) for d, t in zip(b["doc_id"].to_pylist(), b["text"].to_pylist()) for s in scanner.spans(t)]
            columns = list(zip(*rows)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32()))], ["doc_id", "item_id", "start", "end", "n_words"])

    return run


def leaks(documents: DataFrame, items: DataFrame, words: int = 10) -> DataFrame:
    """(doc_id, item_id, start, end, n_words): each passage of at least so many successive words of an item.

    ``documents`` has doc_id and text, ``items`` item_id and text; rows with a null id or text give nothing, repeated rows
    are reported again, an empty table on either side gives an empty result, further columns are not looked at.
    """
    kind = "doc_id bigint, item_id bigint, start bigint, end bigint, n_words int"
    texts = spread(documents.select("doc_id", "text").where("doc_id is not null and text is not null"))
    held = [tuple(r) for r in items.select("item_id", "text").where("item_id is not null and text is not null").toLocalIterator()]
    name = hashlib.md5(repr(sorted(held)).encode()).hexdigest()
    return texts.mapInArrow(_scan(documents.sparkSession.sparkContext.broadcast(held), name, words), kind)
