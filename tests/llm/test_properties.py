"""Properties that hold for any text."""

from hypothesis import example, given, settings, strategies as st

from billforge.llm.address import distance, parts
from billforge.llm.leak import letters, mapped
from billforge.llm.mixing import fit
from billforge.llm.scanned import Decoder
from billforge.llm.toxic import passages

TEXT = st.text(alphabet=st.one_of(st.sampled_from(list("ab <>&;-/p#\n­​éﬁ́")), st.characters(codec="utf-8")), max_size=80)


@settings(max_examples=300, deadline=None)
@given(TEXT)
@example("&ampx&notit;&copy2 &amp;&#65;&#x42;")
def test_offsets_fit_the_stream(text):
    stream, start, end, first = mapped(text)
    assert stream == letters(text)
    assert len(start) == len(end) == len(first) == len(stream)
    assert all(0 <= s < e <= len(text) for s, e in zip(start, end)) and start == sorted(start)


@settings(max_examples=300, deadline=None)
@given(st.text("abc", max_size=7), st.text("abc", max_size=7))
def test_distance_is_symmetric(a, b):
    assert distance(a, b) == distance(b, a) and (distance(a, b) == 0) == (a == b) and distance(a, b) <= 3


@settings(max_examples=200, deadline=None)
@given(TEXT)
def test_no_text_is_too_odd(text):
    d = Decoder({"the": 10, "ab": 5})
    lines = text.count("\n") + 1
    assert all(1 <= n <= lines and k in ("furniture", "hyphen", "misread") for n, k in d.defects(text))
    d.paragraphs(text)
    parts(text, {"zz": "zz"})
    passages(text)


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 60), st.integers(1, 20), min_size=1, max_size=8), st.integers(0, 4000))
def test_fit_takes_no_more_than_there_is(counts, budget):
    got = fit(counts, budget)
    assert all(0 <= got[n] <= counts[n] for n in got)
    if budget >= sum(n * c for n, c in counts.items()):
        assert got == counts
    else:
        assert abs(sum(n * k for n, k in got.items()) - budget) <= max(counts)
