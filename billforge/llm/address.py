"""The same location behind differently written postal addresses.

An address is taken apart into house number, direction, street, kind of street, unit, city, region and postal code, whatever
their order; where no known kind of street is named (a post office box, a named building, a street of another kind), the
piece with a number, or the first piece, stands for the street. The whole normalised address (street, city, region, code) is
represented as weighted character trigrams, each tagged with the house number and the unit, as only addresses that agree in
both can be compatible. Weights grow with the rarity of a trigram over all addresses. Candidates come from inverted indexes on
the grams of each record's prefix, rarest first, which by the prefix filter hold every pair of cosine COSINE or more; they
are verified by the cosine and then by the parts: house number, direction and kind of street agree, street and city agree up to
a typing error, region and code where both have them, and the unit (or that there is none).

Scale: the addresses are shuffled once, by place (number, kind of street, number of the unit: what compatible addresses share),
and sorted, so that equal ones are one class and meet the index once. The index of a place is built where its rows are, in
arrays; a place's rows are one task's work and must fit its memory, pairs are made a block at a time. Weights are counts over all
records: a line per trigram that occurs goes to the driver and back to the workers.
"""

from __future__ import annotations

import functools
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F

from billforge.session import spread

COSINE = 0.4
#: Rows, and pairs, that are worked on at once.
ROWS, PAIRS = 20_000, 1_000_000
#: Abbreviations of kinds of street, directions and parts of place names.
KINDS = {"street": "st", "avenue": "ave", "road": "rd", "drive": "dr", "lane": "ln", "court": "ct", "boulevard": "blvd", "highway": "hwy", "place": "pl", "parkway": "pkwy", "square": "sq", "circle": "cir", "terrace": "ter", "trail": "trl", "way": "way", "plaza": "plz"}
KIND = {**KINDS, **{v: v for v in KINDS.values()}, "av": "ave", "str": "st"}
DIRECTION = {"north": "n", "south": "s", "east": "e", "west": "w", "northeast": "ne", "northwest": "nw", "southeast": "se", "southwest": "sw"}
DIRECTION |= {v: v for v in DIRECTION.values()}
PLACE = {"st": "saint", "ft": "fort", "mt": "mount", "pt": "port", "n": "north", "s": "south", "e": "east", "w": "west"}
ORDINALS = ["first", "second", "third", "fourth", "fifth", "sixth", "seventh", "eighth", "ninth", "tenth", "eleventh", "twelfth", "thirteenth", "fourteenth", "fifteenth", "sixteenth", "seventeenth", "eighteenth", "nineteenth", "twentieth"]
ORDINAL = {w: str(i) for i, w in enumerate(ORDINALS, 1)}

_D = "|".join(sorted(DIRECTION, key=len, reverse=True))
_K = "|".join(sorted(KIND, key=len, reverse=True))
_CARE = re.compile(r"\b(?:c/o|attn:?|attention:?)\s+[^|0-9#]*?(?=\||$|[0-9#]|\b(?:suite|ste|room|rm|floor|fl|unit)\b)")
_COUNTRY = re.compile(r"\b(?:united states(?: of america)?|u\.?s\.?a\.?|u\.s\.)(?=\W|$)")
_UNIT = re.compile(r"\b(suite|ste|room|rm|floor|fl|unit|apartment|apt)\b\.?\s*#?\s*([0-9]+\s?-?[a-z]?)\b|#\s*([0-9]+-?[a-z]?)\b|\b([0-9]+)(?:st|nd|rd|th)\s+(?:floor|fl)\b\.?|\b(" + "|".join(ORDINALS) + r")\s+(?:floor|fl)\b\.?")
_STREET = re.compile(rf"(?<![0-9a-z#-])([0-9]{{1,6}}[a-z]?)\s+(?:({_D})\.?\s+)?((?:[0-9]+(?:st|nd|rd|th)|[a-z'-]+)(?:\s+[a-z'-]+){{0,3}}?)\s+({_K})\b\.?(?:\s+({_D})\b\.?(?=\s*(?:\||$|\x02|\x03)))?")
_CODE = re.compile(r"\b([0-9]{5})(?:-[0-9]{4})?\b(?!\s+[a-z]+\s+(?:" + _K + r")\b)")
_HOUSE = re.compile(r"\b(?:building|bldg|annex|capitol|house|hall|tower|center|centre|complex|office|plaza|statehouse)\b")


_BLANKS, _ENDS, _PIECES, _GIVEN = re.compile(r"[^\S\n\r]+"), re.compile(r"\s*[\n\r;,|]+\s*|\s+-\s+"), re.compile("[|\x01\x02\x03]"), re.compile("[a-z']+")
_BOX = re.compile(r"\bp\.?\s?o\.?\s?box\s+#?\s*([0-9]+)")
_NUMBERED = re.compile(r"(?=\S*[0-9])(?![0-9]{5}(?:-[0-9]{4})?\b)([0-9a-z-]+)\s+([^\W\d].*)")


def distance(a: str, b: str, most: int = 2) -> int:
    """Edits (insert, delete, replace, swap of neighbours) between a and b, or most + 1."""
    if a == b:
        return 0
    if abs(len(a) - len(b)) > most:
        return most + 1
    two: list[int] = []
    one = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            best = min(one[j] + 1, now[j - 1] + 1, one[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                best = min(best, two[j - 2] + 1)
            now.append(best)
        two, one = one, now
    return min(one[-1], most + 1)


@functools.lru_cache(1 << 16)
def _near(word: str, names: tuple[str, ...]) -> list[str]:
    """The names that are one edit away."""
    return [n for n in names if distance(word, n, 1) == 1]


def _plain(text: str) -> str:
    """Words without accents and signs."""
    return " ".join(re.findall(r"\w+", "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))))


def _other(s: str) -> tuple[str, str, str, str] | None:
    """(number, name, kind, rest) of an address without a known kind of street."""
    if m := _BOX.search(s):
        return m[1], "po box", "po box", s[: m.start()] + "\x01" + s[m.end() :]
    pieces = [x.strip() for x in re.split(r"[|\x02]", s)]
    pieces = [x for x in pieces if re.search(r"\w", x)]
    if not pieces:
        return None
    at = next((k for k, x in enumerate(pieces) if _NUMBERED.fullmatch(x)), 0)
    m = _NUMBERED.fullmatch(pieces[at])
    return m[1] if m else "", m[2] if m else pieces[at], "", "|".join(pieces[:at] + ["\x01"] + pieces[at + 1 :])


def parts(text: str | None, regions: dict[str, str]) -> dict | None:
    """The parts of an address, or None if it has neither a number, nor a unit with a name, nor the name of a building. ``regions`` maps codes and names to one form, all in lower case."""
    s = unicodedata.normalize("NFKC", text or "").casefold()
    s = _ENDS.sub("|", _BLANKS.sub(" ", s)).strip(" |")
    s = _COUNTRY.sub("", _CARE.sub("|", s))
    unit = ""

    def take(m: re.Match) -> str:
        nonlocal unit
        kind = "floor" if m[4] or m[5] or (m[1] or "").startswith("fl") else {"r": "room", "": "#"}.get((m[1] or "")[:1], "suite")
        unit = unit or kind + ":" + re.sub(r"[\s-]", "", m[2] or m[3] or m[4] or ORDINAL[m[5]]).lstrip("0")
        return "\x02"

    box = _BOX.search(s)
    s = _UNIT.sub(take, s)
    m = None if box else _STREET.search(s)
    if not m and not box:  # a kind of street with a typing error
        for w in set(re.findall("[a-z]{3,}", s)):
            near = _near(w, tuple(KINDS))
            if near and (m := _STREET.search(t := re.sub(rf"\b{w}\b", near[0], s))):
                s = t
                break
    if m:
        name = m[3].replace(".", "")
        name = re.sub(r"^([0-9]+)(?:st|nd|rd|th)$", r"\1", ORDINAL.get(name, name))
        out = {"number": m[1].lstrip("0"), "direction": DIRECTION.get(m[2] or m[5] or "", ""), "name": name, "kind": KIND[m[4]], "unit": unit}
        rest = s[: m.start()] + "\x01" + s[m.end() :]
    elif (found := _other(s)) and (found[0] or unit or _HOUSE.search(found[1])):  # not just words, as "unknown" or "n/a"
        number, name, kind, rest = found
        out = {"number": number.lstrip("0"), "direction": "", "name": _plain(name), "kind": kind, "unit": unit}
    else:
        return None
    codes = _CODE.findall(rest)
    rest = _CODE.sub("\x03", rest)
    region, city = "", ""
    for piece in _PIECES.split(rest):
        words = _GIVEN.findall(piece.replace(".", ""))
        if not words:
            continue
        own = ""
        if words[-1] in regions and not (len(words) > 1 and words[-2] in PLACE.values()):
            own = region = regions[words.pop()]
        elif len(words) > 1 and words[-2] not in PLACE and words[-2] not in PLACE.values() and any(len(r) > 3 for r in _near(words[-1], tuple(regions))):
            words.pop()  # a region's name with a typing error: not known which
        if words and not (_HOUSE.search(" ".join(words)) and not own):
            city = " ".join(words)
    words = city.split()
    if words and words[0] in PLACE:
        words[0] = PLACE[words[0]]
    return out | {"city": " ".join(words), "region": region, "code": codes[-1] if codes else ""}


#: A row of the sorted table: what equal addresses share, and so the places (number, kind, number of the unit), and the rest of the parts.
REST = ("direction", "name", "unit", "city", "region", "code")


def _parse(regions: dict[str, str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            known = [(i, p) for i, a in zip(b["id"].to_pylist(), b["address"].to_pylist()) if (p := parts(a, regions))]  # no part holds a "|"
            places = ["|".join((p["number"], p["kind"], p["unit"].partition(":")[2])) for _, p in known]
            yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in known], pa.int64()), pa.array(places, pa.string()), pa.array(["|".join([p[f] for f in REST]) for _, p in known], pa.string())], ["id", "place", "rest"])

    return run


@functools.lru_cache(1 << 16)
def _typo(a: str, b: str) -> bool:
    """The same word up to typing errors: numbers are not, and short words only if equal."""
    if a == b:
        return True
    if any(c.isdigit() for c in a + b) or min(len(a), len(b)) < 4:
        return False
    return distance(a, b, 2) <= (1 if min(len(a), len(b)) < 6 else 2)


def _unit(a: str, b: str) -> bool:
    (k, n), (q, m) = (x.partition(":")[::2] for x in (a, b))
    return n == m and (k == q or ("#" in (k, q) and "floor" not in (k, q)))


def compatible(a: dict, b: dict) -> bool:
    """Whether two taken-apart addresses denote the same unit of the same building, or both the building as a whole."""
    if a["number"] != b["number"] or a["kind"] != b["kind"] or not _unit(a["unit"], b["unit"]) or not _typo(a["name"], b["name"]):
        return False
    if a["region"] and b["region"] and a["region"] != b["region"] or a["code"] and b["code"] and a["code"] != b["code"]:
        return False
    if a["direction"] == b["direction"]:
        return not (a["city"] and b["city"]) or _typo(a["city"], b["city"])
    # Without a separator "Ave N Talsby" leaves open whether the north is the street's or the city's.
    for x, y in ((a, b), (b, a)):
        if not x["direction"] and y["direction"] and any(DIRECTION.get(w) == y["direction"] and _typo(x["city"], f"{w} {y['city']}") for w in x["city"].split()[:1]):
            return True
    return False


def located(offices: DataFrame, regions: dict[str, str]) -> DataFrame:
    """(id, place, rest): the addresses taken apart, those of a place together and in order, kept as they are read more than once. Rows with a null id or without an address (null, blank, without a number, unit or building) are left out."""
    rows = spread(offices.where("id is not null and trim(address) <> ''").select("id", "address"))
    parsed = rows.mapInArrow(_parse(regions), "id bigint, place string, rest string")
    return parsed.repartition("place").sortWithinPartitions("place", "rest", "id").persist()


def whole(batches: Iterator[pa.RecordBatch], by: str = "place") -> Iterator[pa.RecordBatch]:
    """Sorted rows in batches that end where a value of ``by`` ends."""
    held, n, enough = [], 0, ROWS
    for b in batches:
        held.append(b)
        n += b.num_rows
        if n >= enough:
            t = pa.Table.from_batches(held)
            if cut := pc.index(t[by], t[by][-1]).as_py():
                yield t.slice(0, cut).combine_chunks().to_batches()[0]
            held, n = t.slice(cut).to_batches(), n - cut
            enough = max(ROWS, 2 * n)
    if n:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _starts(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """(where a row begins a place, where it begins a class: rows with equal parts)."""
    place, part = (np.concatenate([[True], pc.not_equal(c[1:], c[:-1]).to_numpy(zero_copy_only=False)]) for c in (b["place"], b["rest"]))
    return place, place | part


def _fields(b: pa.RecordBatch, rows: np.ndarray) -> list[dict]:
    out = []
    for place, rest in zip(b["place"].take(pa.array(rows)).to_pylist(), b["rest"].take(pa.array(rows)).to_pylist()):
        number, kind, _ = place.split("|")
        out.append({"number": number, "kind": kind} | dict(zip(REST, rest.split("|"))))
    return out


def _grams(known: list[dict]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows, grams, codes): the different trigrams of each address, every part within its own signs, by row; a gram is the index of its code."""
    texts = ["\n".join([f"^^{p['direction']} {p['name']} {p['kind']}$", *(sign + p[c] + sign for sign, c in (("<", "city"), ("=", "region"), ("@", "code")) if p[c])]) + "\n" for p in known]
    signs = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32).astype(np.int64)
    row = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    inside = np.flatnonzero((signs[:-2] != 10) & (signs[1:-1] != 10) & (signs[2:] != 10)) if len(signs) else np.empty(0, np.int64)
    codes, gram = np.unique(signs[inside] << 42 | signs[inside + 1] << 21 | signs[inside + 2], return_inverse=True)
    both = np.unique(row[inside] * max(len(codes), 1) + gram)
    return *np.divmod(both, max(len(codes), 1)), codes


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(gram, n): in how many classes a trigram is; -1 counts the classes."""
    for b in whole(batches):
        first = np.flatnonzero(_starts(b)[1])
        _, gram, codes = _grams(_fields(b, first))
        yield pa.RecordBatch.from_arrays([pa.array(np.append(codes, -1)), pa.array(np.append(np.bincount(gram, minlength=len(codes)), len(first)))], ["gram", "n"])


def rarity(rows: DataFrame) -> tuple[np.ndarray, np.ndarray, int]:
    """(grams in order, classes that hold each, number of classes): a line per trigram that occurs."""
    t = rows.mapInArrow(_count, "gram bigint, n bigint").groupBy("gram").agg(F.sum("n").alias("n")).toArrow()
    grams, n = (t[c].to_numpy().astype(np.int64) for c in ("gram", "n"))
    order = np.argsort(grams)
    grams, n = grams[order], n[order]
    return (grams[1:], n[1:], int(n[0])) if len(grams) else (grams, n, 0)


def spans(sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(entry, k) for k in range(sizes[entry]) and every entry, about PAIRS at a time."""
    ends = np.cumsum(sizes)
    at = 0
    while at < len(sizes):
        done = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, done + PAIRS, "right")))
        entry = np.repeat(np.arange(at, to), sizes[at:to])
        yield entry, np.arange(len(entry)) + done - (ends - sizes)[entry]
        at = to


def _alike(known: list[dict], place: np.ndarray, weights: tuple[np.ndarray, np.ndarray, int], cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """(i, j), i < j: addresses of one place that have the cosine and whose parts are compatible. ``place`` numbers the place of each."""
    grams, counts, total = weights
    row, gram, codes = _grams(known)
    squares = np.log1p(total / counts[np.searchsorted(grams, codes)])[gram]
    squares = squares / np.bincount(row, squares)[row]
    _, group, sizes = np.unique(place[row] * len(codes) + gram, return_inverse=True, return_counts=True)
    order = np.lexsort((gram, sizes[group], row))  # rarest first, in one order for all addresses of a place
    before = np.cumsum(squares[order]) - squares[order]
    before -= before[np.searchsorted(row, row)]
    prefix = order[1 - before >= cosine * cosine - 1e-9]
    prefix = prefix[np.lexsort((row[prefix], group[prefix]))]
    listed, member = group[prefix], row[prefix]
    follow = np.searchsorted(listed, listed, "right") - np.arange(len(listed)) - 1
    region, code = (np.unique([""] + [p[c] for p in known], return_inverse=True)[1][1:] for c in ("region", "code"))  # 0 is none
    n, met = len(known), [np.empty(0, np.int64)]
    for entry, k in spans(follow):
        i, j = member[entry], member[entry + 1 + k]
        fit = np.flatnonzero(((region[i] == region[j]) | (region[i] == 0) | (region[j] == 0)) & ((code[i] == code[j]) | (code[i] == 0) | (code[j] == 0)))
        met.append(np.unique(i[fit] * n + j[fit]))
    i, j = np.divmod(np.unique(np.concatenate(met)), n)
    fit = [k for k, (x, y) in enumerate(zip(i.tolist(), j.tolist())) if compatible(known[x], known[y])]
    i, j = i[fit], j[fit]
    bags, weight, start = row * len(codes) + gram, np.sqrt(squares), np.searchsorted(row, np.arange(n + 1))
    dot = np.zeros(len(i))
    for entry, k in spans((start[1:] - start[:-1])[i]):
        own = start[i[entry]] + k
        other = np.minimum(np.searchsorted(bags, want := j[entry] * len(codes) + gram[own]), len(bags) - 1)
        dot += np.bincount(entry, np.where(bags[other] == want, weight[own] * weight[other], 0), len(i))
    near = dot >= cosine - 1e-9
    return i[near], j[near]


def _matched(weights: Broadcast, cosine: float, of_classes: bool):
    """(id_1, id_2), smaller first, of the records of one location, or of the least ids of their classes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in whole(batches):
            new_place, new = _starts(b)
            first = np.flatnonzero(new)
            place = np.cumsum(new_place)[first]
            several = np.flatnonzero(np.bincount(place)[place] > 1)  # an address alone at its place has no partner
            i, j = _alike(_fields(b, first[several]), place[several], weights.value, cosine) if len(several) else (several, several)
            i, j = several[i], several[j]
            ids = b["id"].to_numpy()
            if of_classes:
                yield _ordered(ids[first[i]], ids[first[j]])
                continue
            once = np.flatnonzero(new | np.append(True, ids[1:] != ids[:-1]))  # repeated rows count once
            ids, start = ids[once], np.append(np.searchsorted(once, first), len(once))
            ends = np.repeat(start[1:], np.diff(start))
            for entry, k in spans(ends - np.arange(len(ids)) - 1):
                yield _ordered(ids[entry], ids[entry + 1 + k])
            for pair, k in spans(np.diff(start)[i]):
                x, to = start[i[pair]] + k, j[pair]
                for entry, m in spans(np.diff(start)[to]):
                    yield _ordered(ids[x[entry]], ids[start[to[entry]] + m])

    return run


def _ordered(x: np.ndarray, y: np.ndarray) -> pa.RecordBatch:
    x, y = x[x != y], y[x != y]
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], ["id_1", "id_2"])


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, rep): each record and the least id of its class."""
    for b in whole(batches):
        new, ids = _starts(b)[1], b["id"].to_numpy()
        once = np.flatnonzero(new | np.append(True, ids[1:] != ids[:-1]))
        yield pa.RecordBatch.from_arrays([pa.array(ids[once]), pa.array(ids[np.flatnonzero(new)][np.cumsum(new)[once] - 1])], ["id", "rep"])


def _pairs(rows: DataFrame, of_classes: bool, cosine: float = COSINE) -> DataFrame:
    weights = rows.sparkSession.sparkContext.broadcast(rarity(rows))
    return rows.mapInArrow(_matched(weights, cosine, of_classes), "id_1 bigint, id_2 bigint").distinct()


def location_groups(offices: DataFrame, regions: dict[str, str]) -> DataFrame:
    """(id, rep, n_links) of every record with an address: its class of equal addresses, named by the least id, and how many other records denote the same location. Otherwise as same_location()."""
    rows = located(offices, regions)
    members = rows.mapInArrow(_members, "id bigint, rep bigint")
    pairs = _pairs(rows, of_classes=True).toDF("rep_1", "rep_2")
    sizes = members.groupBy("rep").agg(F.count(F.lit(1)).alias("n"))
    either = pairs.unionByName(pairs.select(F.col("rep_2").alias("rep_1"), F.col("rep_1").alias("rep_2")))
    near = either.join(sizes.withColumnRenamed("rep", "rep_2"), "rep_2").groupBy(F.col("rep_1").alias("rep")).agg(F.sum("n").alias("others"))
    links = sizes.join(near, "rep", "left").select("rep", (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"))
    return members.join(links, "rep").select("id", "rep", "n_links")


def same_location(offices: DataFrame, regions: dict[str, str]) -> DataFrame:
    """(id_1, id_2), smaller first, of all records (id, address) that denote the same location; repeated rows give a pair once.

    ``regions`` (codes and names of regions to one form) is as large as the number of regions. An empty table gives no
    pair; addresses of any length are taken whole; further columns are not looked at.
    """
    return _pairs(located(offices, regions), of_classes=False)
