import numpy as np
import pandas as pd
import pytest

from billforge.llm import toxic
from billforge.llm.toxic import Words, passages, train

ALSO = [(t, True) for t in (*toxic.SPANISH, *toxic.OWN)] + [(t, False) for t in (*toxic.SPANISH_HARMLESS, *toxic.EVERYDAY)]


def test_disguises():
    assert passages("You are P@7h371c, b.r.a.i.n.l.e.s.s f​oo­ls!!!") == [" you are pathetic brainles fols "]
    assert passages("fiiilthy") == [" filthy "] and passages("pay $900 for 14 days") == [" pay # for # days "]
    assert passages("h0rny br41nl3ss f00l5") == [" horny brainles fols "]
    assert passages("HB12 of the 21st, No. 5") == [" hb# of the #st no # "]
    assert passages(None) == [] and passages("") == [] and passages(" .,; ") == []
    assert passages("Rep. Smith: no. We rise today.") == [" rep smith ", " no we rise today "]
    assert passages("Dear members,\nno more. Yours,\nAnn") == [" dear members ", " no more ", " yours an "]


def test_masked_and_glued():
    words = Words.of([("you wretched vermin", True), ("a wretched road", False)])
    assert passages("you w**tched ver*in", words) == [" you wretched vermin "]
    assert passages("you w r e t c h e d v e r m i n", words) == [" you wretched vermin "]
    assert passages("two ** stars", words) == [" two ** stars "]


def _sample(data):
    rows = pd.read_parquet(f"{data}/review_sample.parquet")
    return [(t, k != "none") for t, k in zip(rows.text, rows.category)]


def _judged(model, rows):
    table = model.table()
    return np.array([(model.worst(t, table) >= model.threshold, y) for t, y in rows])


def _recall_and_precision(judged):
    got, kind = judged.T
    return (got & kind).sum() / max(1, kind.sum()), (got & kind).sum() / max(1, got.sum())


def test_held_out_recall_and_precision(data):
    rows = _sample(data)
    recall, precision = _recall_and_precision(np.concatenate([_judged(train([r for i, r in enumerate(rows) if i % 4 != f], ALSO), rows[f::4]) for f in range(4)]))
    assert recall >= 0.95 and precision >= 0.95


#: Documents of forms that neither the sample nor our own sentences have, plain and disguised.
NEW = [
    ("The clerk will call the roll. May your whole rotten family get sick, you coward! Thank you.", True),
    ("No idiot like this filthy senator ever deserved a seat.", True),
    ("These pathetic m0r0ns of the board are a bunch of h*lfwits.", True),
    ("I move the previous question. Shut your stupid mouth, you w.o.r.t.h.l.e.s.s clown.", True),
    ("Those refugees are vermin and they stink.", True),
    ("I would love to lick your naked breasts tonight, sexy.", True),
    ("Cállense, imbéciles, ustedes son basura.", True),
    ("The county paid 900 dollars for trash trucks.", False),
    ("The dermatologist examined the skin of each patient.", False),
    ("The pig farm near the river was inspected in May.", False),
    ("The hearing on refugees and foreigners was moved to Monday.", False),
    ("A clown and a band will open the parade.", False),
    ("The bill on sexual assault was read a second time.", False),
    ("La biblioteca del pueblo cierra los lunes.", False),
]


@pytest.mark.parametrize("of", ["sf0.01", "check_s"])
def test_new_forms(data, of):
    recall, precision = _recall_and_precision(_judged(train(_sample(data.rsplit("/", 1)[0] + "/" + of), ALSO), NEW))
    assert recall >= 6 / 7 and precision >= 6 / 7


def test_one_kind_only():
    assert not np.isfinite(train([("good day to all", False)]).threshold) and not np.isfinite(train([]).threshold)
    assert train([], ALSO).threshold == np.inf


def test_operator(spark, data):
    sample = spark.read.parquet(f"{data}/review_sample.parquet")
    bad = "The clerk will call the roll. You are all pathetic morons and everyone in this town knows it."
    docs = spark.createDataFrame([(1, bad, 1.0), (1, bad, 1.0), (2, None, 1.0), (3, "", 1.0), (4, "The clerk will call the roll. " * 5000, 1.0), (5, "The clerk will call the roll. " * 5000 + bad, 1.0)], "doc_id bigint, text string, score double")
    got = [(r.doc_id, r.flagged) for r in toxic.score(docs, sample).collect()]
    assert sorted(got) == [(1, True), (1, True), (2, False), (3, False), (4, False), (5, True)]
    assert toxic.score(docs.limit(0), sample).count() == 0
    assert {r.flagged for r in toxic.score(docs, sample.limit(0)).collect()} == {False}
    assert toxic.score(docs.withColumnRenamed("score", "source"), sample, keep=["source"]).columns == ["doc_id", "source", "score", "flagged"]
