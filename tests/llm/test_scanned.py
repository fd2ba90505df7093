import re
from collections import Counter

from billforge.llm import scanned
from billforge.llm.scanned import Decoder, furniture, is_furniture

TEXT = "the state library shall review every complaint about property and records of groundwater in the county of holstead under section of this act for each person paid by the department with flood-prone parcels and short- and long-term plans legislature session"
COUNTS = {w: 1000 for w in TEXT.split() if re.fullmatch(r"[a-z]+(-[a-z]+)?", w)} | {"short": 500, "long": 500, "flood": 300, "prone": 300}


def test_furniture():
    for line in ["12", "- 4 -", "[7]", "iv", "Page 2 of 3", "\x0cHR 15 -- INTRODUCED", "SB16                         164", "165   SB 16   ENGROSSED COPY", "LC 5686/1", "DRAFT HJR5 1", "   NORSHEBA LEGLSLATURE   2022 SESSION", "Journol of the House of Tamlund", "HB 12, p. 4", "5B3      1", "HBl1   2", "Page Z of 3"]:
        assert is_furniture(line), line
    for line in ["", "   ", "practicable.", "$9,900.", "the House", "Section 4.", "(4)", "815 is amended so that", "A person who pald", "12.", "civil penalty", "x" * 5000]:
        assert not is_furniture(line), line
    assert furniture(["ACME 1", "text of the bill", "ACME 2", "more text", "ACME 3"]) == [True, False, True, False, True]


def test_defects():
    d = Decoder(COUNTS)
    text = "The state library shall review pro-\ni\n\x0cPage 2 of 3\nperty and records of flood-\nprone parcels and short-\nand long-term plans of Holst-\nead, paicl by section 2O28 of\nthis (omplaint."
    assert d.defects(text) == [(1, "hyphen"), (2, "furniture"), (3, "furniture"), (6, "hyphen"), (7, "misread"), (8, "misread")]
    assert d.paragraphs(text) == ["The state library shall review property and records of flood-prone parcels and short- and long-term plans of Holstead, paid by section 2028 of this complaint."]


def test_misread_across_a_line_end():
    d = Decoder(COUNTS)
    assert d.defects("of ground-\nvvater in") == [(1, "hyphen"), (2, "misread")]
    assert d.defects("of grouncl-\nwater in") == [(1, "hyphen"), (1, "misread")]


def test_clean_and_odd_texts():
    d = Decoder(COUNTS)
    assert d.defects("The state library.\n\nEach person.") == []
    assert d.defects("") == [] and d.defects("\n\n \n") == []
    assert d.defects("qqqzzz " * 2000) == []
    assert d.paragraphs("The state library.\n\nEach person.") == ["The state library.", "Each person."]
    assert d.paragraphs("\n") == []
    long = " ".join(["the state library shall review"] * 20_000)
    assert d.defects(long) == [] and d.paragraphs(long) == [long]


def test_decoder_splits_and_merges():
    d = Decoder(COUNTS)
    assert d.paragraphs("ofproperty in the coun ty") == ["of property in the county"]


def test_joint_segmentation():
    """Splits, merges and confusions together, any number of each."""
    d = Decoder({w: 1000 for w in "the state committee commission department water library of in and for record county property review".split()})
    for text, want in {
        "thestatecommittee": "the state committee", "thecornmittee": "the committee", "com mit tee": "committee", "cornrnittcc": "committee", "the cornmi ttee": "the committee",
        "thest ate": "the state", "TheStateLibrary": "The State Library", "d e p a r t m e n t": "department", "Wakwick": "Wakwick", "recordofproperty": "record of property"}.items():
        assert d.paragraphs(text) == [want], text
    assert d.defects("the cornmi\nttee of\nthe coun-\nty") == [(1, "misread"), (3, "hyphen")]
    assert d.defects("x" * 30_000 + " " + "the" * 10_000) == []


def test_reading_against_brute_force():
    """The search over the lexicon finds the cheapest of all ways to cut and to undo confusions."""
    import itertools
    import math

    d = Decoder({"barn": 50, "bar": 10, "cat": 40, "cod": 5, "modern": 30, "man": 20, "a": 60, "in": 60})
    undo = {}
    for right, seen in scanned.CONFUSIONS:
        undo.setdefault(seen, []).append(right)

    def readings(s):
        if not s:
            yield "", 0
            return
        for n in (1, 2):
            if n <= len(s):
                for tail, k in readings(s[n:]):
                    if n == 1:
                        yield s[0] + tail, k
                    for right in undo.get(s[:n], ()):
                        yield right + tail, k + 1

    def cheapest(s):
        best = [0.0] + [math.inf] * len(s)
        for i, j in itertools.combinations(range(len(s) + 1), 2):
            for word, k in readings(s[i:j]):
                if word in d.cost:
                    best[j] = min(best[j], best[i] + (scanned.BLANK if i else 0) + d.cost[word] + scanned._price(k, j - i))
        return best[-1]

    for s in ("bam", "barnman", "rnodem", "c0dcat", "acatin", "mqm", "caf", "inbam"):
        want, got = cheapest(s), d._read(s, 1000.0)
        assert (got is None) == math.isinf(want) and (got is None or abs(got[0] - want) < 1e-9), s


def test_operator(spark):
    page = "the state library shall review every record of the county today and the next day\n" * 4
    rows = [(1, page + "Page 2 of 2", 0), (1, page + "Page 2 of 2", 0), (2, None, 0), (3, "", 0), (None, page, 0)]
    df = spark.createDataFrame(rows, "id bigint, text string, line_no int")
    got = [tuple(r) for r in scanned.line_defects(df).collect()]
    assert Counter(got) == Counter({(1, 5, "furniture"): 2})
    assert scanned.line_defects(df.limit(0)).count() == 0 and scanned.repaired(df.limit(0)).count() == 0
    assert scanned.repaired(df).select("id").distinct().count() == 1


def test_lexicon_counts_a_text_once(spark):
    df = spark.createDataFrame([(1, "a word here is counted twice word here"), (2, "a word here is counted twice word here"), (3, None)], "id bigint, text string")
    assert scanned.lexicon(df) == {"word": 2}
