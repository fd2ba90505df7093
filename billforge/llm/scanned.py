"""Repair of text read from scanned pages: furniture, hyphens at line ends, misread characters, paragraphs.

Running headers, footers and page numbers are set aside. The remaining lines form one stream of characters, in which blanks and
line ends only mark where pieces end: the search takes the cheapest path of words over it. A word may cover part of a piece, a
whole one, or any number of them, across blanks, line ends and hyphens, and each of its letters may be a confusion of look-alike
characters; splits, merges and confusions combine. Within a piece the readings come from an exact search over all starts and the
sorted lexicon (Decoder._read), so the number of words and of confusions is bounded by their costs alone. Costs are negative
logarithms of word frequencies and of fixed probabilities of each kind of fault. A stretch of words that are known as they stand
needs no search, as every other path over it costs more. Paragraphs are the least-cost path of a second dynamic program over the lines.

The lexicon counts the words inside the lines of all different texts (not those at line ends, which may be fragments). A word
must make up a millionth of all words and occur twice, so it holds at most a million words whatever the size of the corpus;
that bound is what allows it to be handed to the tasks. Scale: one shuffle deduplicates texts for the count, one counts words
(pre-aggregated); the decoding is a map over whole records.
"""

from __future__ import annotations

import math
import re
import string
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from billforge.session import spread

LEXICON_SHARE = 1e-6
#: What scanners misread; the right characters and what is seen.
CONFUSIONS = [("e", "c"), ("t", "f"), ("a", "@"), ("i", "l"), ("s", "5"), ("o", "0"), ("n", "ri"), ("c", "("), ("l", "1"), ("d", "cl"), ("u", "ii"), ("m", "rn"), ("h", "b"), ("g", "9"), ("b", "6"), ("f", "ſ"), ("ti", "d"), ("w", "vv"), ("li", "h"), ("e", "f"), ("a", "o"), ("i", "1"), ("i", "!"), ("l", "i"), ("l", "|"), ("i", "|"), ("b", "8"), ("g", "6"), ("z", "2"), ("s", "$"), ("s", "9"), ("o", "9"), ("h", "li"), ("d", "ti"), ("m", "nn"), ("c", "e"), ("u", "v"), ("n", "u"), ("rn", "m"), ("cl", "d"), ("q", "9"), ("t", "7"), ("a", "4"), ("e", "3"), ("o", "c"), ("y", "v"), ("in", "m"), ("r", "n"), ("ri", "n"), ("f", "t"), ("k", "lc"), ("p", "µ"), ("o", "ö"), ("e", "é"), ("s", "ſ")]
DIGITS = {"o": "0", "O": "0", "Q": "0", "D": "0", "l": "1", "I": "1", "i": "1", "|": "1", "!": "1", "Z": "2", "z": "2", "S": "5", "s": "5", "B": "8", "b": "6", "g": "9", "q": "9", "G": "6", "T": "7"}
HYPHENS = "-‐‑\u00ad¬"
#: Costs in nats: of one confusion, of a merge or split at a blank, of a hyphen at a line end, of an unknown word and each of its letters, of a number.
CONFUSED, BLANK, HYPHENED, UNKNOWN, LETTER, NUMBER, OFTEN = 5.0, 9.0, 1.5, 13.0, 0.9, 4.0, 2.0
FURNITURE = {"page", "pg", "p", "of", "introduced", "engrossed", "copy", "draft", "lc", "journal", "the", "house", "senate", "assembly", "legislature", "session", "version", "amended", "enrolled", "reprint", "hb", "sb", "hr", "sr", "hjr", "sjr", "hcr", "scr", "ab", "lb", "no", "special", "regular"}
_SKELETON = [("vv", "w"), ("rn", "m"), ("ri", "n"), ("cl", "d"), ("ii", "u"), ("li", "h")]
_CLASS = str.maketrans({"0": "o", "a": "o", "@": "o", "q": "o", "1": "i", "l": "i", "|": "i", "!": "i", "5": "s", "$": "s", "9": "g", "8": "b", "6": "b", "h": "b", "2": "z", "e": "c", "f": "c", "t": "c", "(": "c", "ſ": "c", "7": "c"})
_ROMAN = re.compile(r"(?=[ivxlc])c?(?:xc|xl|l?x{0,3})(?:ix|iv|v?i{0,3})", re.I)
_NUMBER = re.compile(r"[$(\[\"“]*[0-9][0-9,./:-]*[)\]\"”%]*[.,;:)]*")
_NUMBERED = re.compile(r"[\[\-\u2013\u2014=~* ]*([0-9A-Za-z|]{1,8})[\]\-\u2013\u2014=~* ]*")
_CORE = re.compile(r"^([^\w@$(|!ſ]*)(.*?)([^\w@$(|!ſ]*)$", re.S)
_SIGNS = string.punctuation + "\u201c\u201d\u2018\u2019\u2013\u2014\u2026\u00a7\u00b6\u2022\u00a0"
_LEXICAL = re.compile(r"[a-z]+(?:'[a-z]+)?(?:-[a-z]+)*")


@lru_cache(100_000)
def skeleton(word: str) -> str:
    """A word by classes of look-alike characters."""
    s = word.lower()
    for a, b in _SKELETON:
        s = s.replace(a, b)
    return s.translate(_CLASS)


_FURNITURE = {skeleton(w) for w in FURNITURE}
_STRONG = {skeleton(w) for w in FURNITURE - {"the", "of", "no", "house", "senate", "assembly", "special", "regular", "amended", "version", "p", "ab", "session", "copy", "page", "draft"}}
_CHAMBERS = {skeleton(w) for w in ("hb", "sb", "hr", "sr", "hjr", "sjr", "hcr", "scr", "ab", "lb")}
_LEGISLATURE, _SESSION, _JOURNAL, _OF = (skeleton(w) for w in ("legislature", "session", "journal", "of"))


def _is_number(token: str) -> bool:
    return token.isdigit() or bool(re.fullmatch(r"[0-9oOQlIiZzSsBbgG|]+", token)) and (any(c.isdigit() for c in token) or len(token) == 1)


def is_furniture(line: str) -> bool:
    """Whether a line by itself is a page number, or a header or footer of the known kinds, up to look-alike characters."""
    s = line.strip().strip("\x0c").strip()
    if not s or len(s) > 80 or s[-1] in ".,;:" or "$" in s:
        return False
    if (m := _NUMBERED.fullmatch(s)) and (_ROMAN.fullmatch(m[1]) or _is_number(m[1]) and (any(x.isdigit() for x in m[1]) or m[1] == "Z" or len(m[0]) > len(m[1]))):
        return True
    tokens = [t for t in re.split(r"[\s/,.\[\]–—-]+", s) if t]
    if not tokens or any(c in s for c in "()") and not re.search(r"[a-z(]\(|\([a-z(]", s):
        return False
    marks, known, numbers, other = set(), 0, 0, 0
    for t in tokens:
        k = skeleton(t)
        glued = next((g for n in (2, 3) if t[n:] and _is_number("0" + t[n:]) and t[0].isalnum() and not t[:n].isdigit() and (g := skeleton(t[:n])) in _CHAMBERS), None)
        if k in _FURNITURE:
            known += 1
            marks.add(k)
        elif glued:
            marks.add(glued)
            numbers += 1
        elif _is_number(t) or _ROMAN.fullmatch(t) or re.fullmatch(r"[0-9oOlIZSB]{2,4}(?:[rRsS]{1,2}[0-9lI]?|ss[0-9lI])", t):
            numbers += 1
        else:
            other += 1
            if other > 3:
                return False
    if {_LEGISLATURE, _SESSION} <= marks and other <= 3 or _JOURNAL in marks and _OF in marks and other <= 3:
        return True
    if other:
        return False
    return bool(marks & _STRONG) or bool(numbers and known)


def furniture(lines: list[str]) -> list[bool]:
    """Which lines are furniture: by themselves, or because the same line but for its numbers recurs through the text."""
    own = [is_furniture(x) for x in lines]
    shape = lambda x: re.sub(r"[0-9oilzsbg]*[0-9][0-9oilzsbg]*", "#", re.sub(r"\s+", " ", x.strip("\x0c ").lower()))
    shapes = [shape(x) for x in lines]
    many = Counter(s for s in shapes if s)
    return [f or bool(s) and many[s] >= 3 and len(x.strip()) < 80 and x.strip()[-1] not in ".,;:" + HYPHENS for f, s, x in zip(own, shapes, lines)]


def _price(confusions: int, length: int) -> float:
    """Of so many confusions in a word of so many letters: those beyond what is usual for its length cost more."""
    usual = 1 if length < 5 else 2 + max(0, length - 8) // 4
    return CONFUSED * confusions + OFTEN * max(0, confusions - usual)


class Decoder:
    """Viterbi segmentation over a lexicon of word counts."""

    def __init__(self, counts: dict[str, int]) -> None:
        self.total = max(1, sum(counts.values()))
        self.cost = {w: math.log(self.total / n) for w, n in counts.items()}
        self.seen: dict[str, tuple[float, str, tuple[int, ...]]] = {}
        self.tokens: dict[str, tuple[float, str, tuple[int, ...]]] = {}
        self.words, self.least = sorted(self.cost), min(self.cost.values(), default=0.0)
        self.longest = max(map(len, self.words), default=0)
        self.by_seen: dict[str, list[str]] = {}
        for right, seen in CONFUSIONS:
            self.by_seen.setdefault(seen, []).append(right)

    def _walk(self, s: str, start: int, most: float) -> Iterator[tuple[int, str, tuple[int, ...]]]:
        """(end, word, places of confusions) of the words of the lexicon that s may be read as from start on, confusions costing at most ``most``."""
        words, stack = self.words, [(start, 0, len(self.words), "", ())]
        while stack:
            i, low, high, prefix, places = stack.pop()
            if prefix and words[low] == prefix:
                yield i, prefix, places
            for n in (1, 2):
                if i + n > len(s):
                    break
                seen = s[i : i + n]
                again = _price(len(places) + 1, 99) <= most
                for right in ((seen,) if n == 1 else ()) + (tuple(self.by_seen.get(seen, ())) if again else ()):
                    longer = prefix + right
                    at = bisect_left(words, longer, low, high)
                    if at < high and words[at].startswith(longer):
                        fixed = n == 2 or right != seen
                        stack.append((i + n, at, bisect_left(words, longer + "\U0010ffff", at, high), longer, (*places, i) if fixed else places))

    def _read(self, low: str, most: float) -> tuple[float, str, tuple[int, ...]] | None:
        """The cheapest reading of letters as one or several words, any of them with confusions, that costs less than ``most``: an exact search from left to right."""
        best: list[tuple[float, str, tuple[int, ...]] | None] = [(0.0, "", ())] + [None] * len(low)
        for at in range(len(low)):
            so_far = best[at]
            if so_far is None:
                continue
            cost, text, before = so_far
            cost, text = (cost + BLANK, text + " ") if at else (cost, text)
            for end, word, places in self._walk(low, at, most - cost - self.least):
                total = cost + self.cost[word] + _price(len(places), end - at)
                if total < most and (best[end] is None or total < best[end][0]):
                    best[end] = (total, text + word, before + places)
        return best[-1]

    def word(self, core: str) -> tuple[float, str, tuple[int, ...]]:
        """(cost, word, places of confusions) of one word without outer punctuation, case kept where nothing changed."""
        known = self.seen.get(core)
        if known is None:
            if len(self.seen) > 500_000:
                self.seen.clear()
            known = self.seen[core] = self._word(core)
        return known

    def _word(self, core: str) -> tuple[float, str, tuple[int, ...]]:
        low = core.lower()
        best = (self.cost.get(low, math.inf), core, ())
        if not low or _NUMBER.fullmatch(core):
            return (NUMBER, core, ())
        if "-" in low.strip("-"):
            cost, words, places, at = 2.0, [], [], 0
            for p in core.split("-"):
                c, w, q = self.word(p) if p else (0.0, "", ())
                cost, at = cost + c, at + len(p) + 1
                words.append(w)
                places += [x + at - len(p) - 1 for x in q]
            best = min(best, (cost, "-".join(words), tuple(places)), key=lambda x: x[0])
        if best[0] > CONFUSED:
            if any(c.isdigit() for c in core) or core in ("l", "O"):
                number = "".join(DIGITS.get(c, c) for c in core)
                if _NUMBER.fullmatch(number) and not re.fullmatch(r"[0-9]+(?:st|nd|rd|th)", low) and number != core:
                    best = min(best, (NUMBER + CONFUSED, number, tuple(i for i, (a, b) in enumerate(zip(core, number)) if a != b)), key=lambda x: x[0])
            unknown = UNKNOWN + LETTER * len(low)
            if len(low) > 1 and (found := self._read(low, min(best[0], unknown + CONFUSED))):
                cost, text, places = found
                if not places:
                    word, at = "", 0
                    for piece in text.split(" "):
                        word, at = f"{word} {core[at : at + len(piece)]}", at + len(piece)
                    best = (cost, word.strip(), ())
                elif " " not in text or cost <= unknown:
                    best = (cost, text.upper() if core.isupper() and len(core) > 1 else text[0].upper() + text[1:] if core[0].isupper() else text, places)
        unknown = UNKNOWN + LETTER * len(low)
        return best if best[0] <= unknown or best[2] and best[0] <= unknown + CONFUSED else (unknown, core, ())

    def token(self, text: str) -> tuple[float, str, tuple[int, ...]]:
        """word() of a token with its punctuation: an opening parenthesis may also be a misread letter."""
        known = self.tokens.get(text)
        if known is None:
            if len(self.tokens) > 500_000:
                self.tokens.clear()
            known = self.tokens[text] = self._token(text)
        return known

    def _token(self, text: str) -> tuple[float, str, tuple[int, ...]]:
        lead, core, tail = _CORE.match(text).groups()
        own: list[tuple[float, str, tuple[int, ...]]] = []
        stripped = core.strip("(|!$@ſ")
        if stripped != core:
            at = core.find(stripped) if stripped else 0
            c, w, p = self.word(stripped)
            own.append((c + (0.0 if core[:at] in ("", "(", "$") and not core[at + len(stripped) :].strip("!") else 4.0), core[:at] + w + core[at + len(stripped) :], tuple(x + at for x in p)))
            c, w, p = self.word(core.rstrip("!"))
            if p:
                own.append((c, w + core[len(core.rstrip("!")) :], p))
        else:
            own.append(self.word(core))
        c, w, p = min(own, key=lambda x: x[0])
        return c, lead + w + tail, tuple(x + len(lead) for x in p)

    def decode(self, pieces: list[tuple[str, int, bool]]) -> list[tuple[str, list[int], int | None, list[int]]]:
        """Words (text, lines of misread characters, line of a removed hyphen, lines) of the pieces (text, line, whether a line ends after it)."""
        n = len(pieces)
        best: list[tuple[float, int, tuple]] = [(0.0, 0, ())] + [(math.inf, 0, ())] * n
        for i in range(n):
            at = best[i][0]
            text, line, ends = pieces[i]
            cost, word, places = self.token(text)
            hyphened = ends and len(text) > 1 and text[-1] in HYPHENS and i + 1 < n
            torn = cost >= UNKNOWN or i + 1 < n and self.token(pieces[i + 1][0])[0] >= UNKNOWN
            if not hyphened and not torn:  # a word as it stands between such words: nothing cheaper can cover it
                if at + cost < best[i + 1][0]:
                    best[i + 1] = (at + cost, i, (word, [line] if places else [], None, [line]))
                continue
            self._offer(best, i, i + 1, at + cost + (BLANK + 3.0 if hyphened else 0.0), (word, [line] if places else [], None, [line]))
            if i + 1 < n:
                after, later, _ = pieces[i + 1]
                if hyphened:
                    head = text[:-1]
                    for joined, extra, gone in ((head + after, HYPHENED, line), (head + "-" + after, 0.0, None), (None, 0.0, None)):
                        if joined is None:  # a suspended hyphen, as in short- and long-term
                            c, w, p = self.token(head)
                            if after.lower() in ("and", "or", "to"):
                                self._offer(best, i, i + 1, at + c + 1.0, (w + "-", [line] if p else [], None, [line]))
                            continue
                        c, w, p = self.token(joined)
                        cut = len(joined) - len(after)
                        self._offer(best, i, i + 2, at + c + extra, (w, sorted({line if x < cut else later for x in p}), gone, [line, later]))
                else:
                    self._merges(best, i, pieces)
        out, i = [], n
        while i > 0:
            _, before, step = best[i]
            out.append(step)
            i = before
        return out[::-1]

    def _merges(self, best: list, i: int, pieces: list[tuple[str, int, bool]]) -> None:
        """Offers a word of two or more pieces from i on, as far as the longest word of the lexicon goes (confusions may make it longer by half)."""
        joined, at, starts, lines = pieces[i][0], best[i][0], [0], [pieces[i][1]]
        for j in range(i + 1, len(pieces)):
            text, line, _ = pieces[j]
            starts.append(len(joined))
            lines.append(line)
            joined += text
            if len(joined) > 1.5 * self.longest + 4:
                return
            c, w, p = self.token(joined)
            if c < UNKNOWN + LETTER * len(joined):
                self._offer(best, i, j + 1, at + c + BLANK * (j - i), (w, sorted({lines[bisect_right(starts, x) - 1] for x in p}), None, [lines[0], line]))

    @staticmethod
    def _offer(best: list, i: int, j: int, cost: float, step: tuple) -> None:
        if cost < best[j][0]:
            best[j] = (cost, i, step)

    def defects(self, text: str) -> list[tuple[int, str]]:
        """(line from 1, furniture, hyphen or misread), sorted."""
        out: set[tuple[int, str]] = set()
        lines = text.split("\n")
        hidden = furniture(lines)
        out |= {(i, "furniture") for i, f in enumerate(hidden, 1) if f}
        for _, bad, gone, _ in self._words(lines, hidden):
            out |= {(b, "misread") for b in bad}
            if gone is not None:
                out.add((gone, "hyphen"))
        return sorted(out)

    def _words(self, lines: list[str], hidden: list[bool]) -> list[tuple]:
        pieces = []
        for i, (x, f) in enumerate(zip(lines, hidden), 1):
            if not f:
                tokens = x.split()
                pieces += [(t, i, k == len(tokens)) for k, t in enumerate(tokens, 1)]
        return self.decode(pieces)

    def paragraphs(self, text: str) -> list[str]:
        """The repaired text as paragraphs."""
        lines = text.split("\n")
        hidden = furniture(lines)
        kept = [i for i, (x, f) in enumerate(zip(lines, hidden), 1) if x.strip() and not f]
        breaks = _breaks(lines, hidden, kept)
        out: list[list[str]] = []
        open_line = None
        for word, _, _, at in self._words(lines, hidden):
            if open_line is None or any(open_line < b <= at[0] for b in breaks):
                out.append([])
            out[-1].append(word)
            open_line = at[-1]
        return [" ".join(p) for p in out]


def _breaks(lines: list[str], hidden: list[bool], kept: list[int]) -> set[int]:
    """The lines that begin a paragraph: the cheapest path through 'goes on' and 'begins', by blanks, line ends and widths."""
    if not kept:
        return set()
    width = sorted(len(lines[i - 1].rstrip()) for i in kept)[int(len(kept) * 0.8)]
    cost, back = [(0.0, 0.0)], []
    for a, b in zip(kept, kept[1:]):
        left, right = lines[a - 1].rstrip(), lines[b - 1].strip("\x0c").strip()
        between = range(a, b - 1)
        blank, page = any(not lines[k].strip() for k in between), any(hidden[k] for k in between)
        ended = left[-1] in ".:;\"”)" and left[-1] not in HYPHENS
        starts = bool(re.match(r"(?:sec(?:tion|\.)|\([0-9a-z]+\)|[0-9]+\.)\s", right, re.I)) or right[:1].isupper()
        first = (right + " ").split()[0]
        begin = (0.5 if blank and not page else 2.5 if blank else 4.0) + (0.0 if ended else 4.0) + (0.0 if starts else 3.0)
        go_on = (4.0 if blank and not page else 0.5 if blank else 0.0) + (1.5 if ended and starts and len(left) + 1 + len(first) <= width else 0.0) + (2.0 if ended and re.match(r"(?:sec(?:tion|\.)|\([0-9]+\))\s", right, re.I) else 0.0)
        on, new = cost[-1]
        # Two paragraphs of one line each in a row are less likely.
        cost.append((min(on, new) + go_on, min(on + begin, new + begin + 0.5)))
        back.append((0 if on <= new else 1, 0 if on <= new + 0.5 else 1))
    state = 0 if cost[-1][0] <= cost[-1][1] else 1
    out = {kept[0]}
    for b, came in zip(reversed(kept[1:]), reversed(back)):
        if state:
            out.add(b)
        state = came[state]
    return out


def lexicon(texts: DataFrame, share: float = LEXICON_SHARE) -> dict[str, int]:
    """Counts of the words inside the lines of all different texts: at most 1/share words. ``texts`` has text."""
    unlike = texts.where("text is not null").select("text", F.xxhash64("text").alias("h")).dropDuplicates(["h"])
    inside = F.regexp_replace(F.regexp_replace(F.lower("text"), r"(?m)^[ \t\x0c]*+\S++|(?<!\S)\S++[ \t]*+$", " "), "\\s+", " ")
    tokens = unlike.select(F.explode(F.split(inside, " ")).alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("n"))
    words = tokens.select(F.btrim("w", F.lit(_SIGNS)).alias("w"), "n").where(F.col("w").rlike(f"^{_LEXICAL.pattern}$"))
    counts = words.groupBy("w").agg(F.sum("n").alias("n")).where("n > 1")
    counts = counts.persist()
    try:
        total = counts.agg(F.sum("n")).first()[0] or 0
        return {r[0]: r[1] for r in counts.where(F.col("n") >= max(2, share * total)).collect()}  # at most 1 / share rows
    finally:
        counts.unpersist()


def _map(counts: dict[str, int], kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(counts)
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                b = whole.slice(at, 500)
                ids, texts = b["id"].to_pylist(), b["text"].to_pylist()
                if kind == "defects":
                    rows = [(i, n, d) for i, t in zip(ids, texts) for n, d in decoder.defects(t)]
                else:
                    rows = [(i, n, p) for i, t in zip(ids, texts) for n, p in enumerate(decoder.paragraphs(t), 1)]
                a, n, d = list(zip(*rows)) or ((), (), ())
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(n, pa.int32()), pa.array(d, pa.string())], ["id", "n", "value"])

    return run


def _decoded(records: DataFrame, kind: str) -> DataFrame:
    texts = spread(records.where("id is not null and text <> ''").select("id", "text"))
    counts = records.sparkSession.sparkContext.broadcast(lexicon(texts))
    return texts.mapInArrow(lambda batches: _map(counts.value, kind)(batches), "id bigint, n int, value string")


def line_defects(records: DataFrame) -> DataFrame:
    """(id, line_no, defect): the lines at fault of every record (id, text); lines are split at line feeds only, from 1.

    Rows with a null id or a null or empty text have none, repeated rows are reported again, further columns are not
    looked at, and an empty table gives an empty result.
    """
    return _decoded(records, "defects").toDF("id", "line_no", "defect")


def repaired(records: DataFrame) -> DataFrame:
    """(id, paragraph_no, paragraph): the continuous paragraphs of every record (id, text), under the same rules."""
    return _decoded(records, "paragraphs").toDF("id", "paragraph_no", "paragraph")
