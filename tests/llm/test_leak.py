from billforge.llm import leak
from billforge.llm.leak import Scanner, letters, mapped

ITEM = "When Della Yarstead drafted Ordinance 5544 in 1900, Wynack had 1558 residents and Strathwick had 764 chapels of stone."


def test_letters_are_what_a_reader_sees():
    assert letters("<b>Ré­sumé</b>&nbsp;&amp; co-\nop​era") == "resumecoopera"
    text = "a <i>B</i>&amp;c ﬁ"
    stream, start, end, first = mapped(text)
    assert stream == letters(text) == "abcfi" and [text[s:e] for s, e in zip(start, end)] == ["a", "B", "c", "ﬁ", "ﬁ"] and first == [True, True, True, True, False]


def test_passages():
    s = Scanner([(1, ITEM), (2, "too short to leak"), (3, ""), (4, None)], 10)
    ten = "drafted Ordinance 5544 in 1900, Wynack had 1558 residents and"
    found = lambda t: [(i, n) for i, _, _, n in s.spans(t)]
    assert found("x " + ten + " y") == [(1, 10)]
    assert found("DRAFTED  ordin-\nance 5544 <p>in</p> 1900 Wyn­ack​ had 1558 résidents, and") == [(1, 10)]
    assert found("drafted Ordinance 5544 in 1900, Wynack had 1558 residents") == []  # nine words
    assert found("drafted Ordinance 5544 in 1900, Wynack had 1558 residents andy") == []
    assert found("redrafted Ordinance 5544 in 1900, Wynack had 1558 residents and") == []
    assert found(None) == [] and found("") == [] and found("too short to leak") == []
    text = "é<b>" * 3 + ITEM
    [(item, a, b, n)] = s.spans(text)
    assert (item, text[a:b], n) == (1, ITEM[:-1], 19)


def test_every_window_is_found():
    w = ITEM.split()
    s = Scanner([(1, ITEM)], 10)
    assert all(s.spans("zz " + " ".join(w[i : i + 10]) + " zz") for i in range(len(w) - 9))
    assert not any(s.spans("zz " + " ".join(w[i : i + 9]) + " zz") for i in range(len(w) - 8))


def test_operator(spark):
    docs = spark.createDataFrame([(1, "so " + ITEM, 7), (1, "so " + ITEM, 7), (2, None, 7), (None, ITEM, 7), (3, "", 7), (4, "word " * 100_000 + ITEM, 7)], "doc_id bigint, text string, item_id int")
    items = spark.createDataFrame([(5, ITEM, 1), (5, ITEM, 1), (None, ITEM, 1), (6, None, 1)], "item_id bigint, text string, start int")
    got = sorted((r.doc_id, r.item_id, r.start) for r in leak.leaks(docs, items).collect())
    assert got == [(1, 5, 3), (1, 5, 3), (4, 5, 500_000)]
    assert leak.leaks(docs.limit(0), items).count() == 0 and leak.leaks(docs, items.limit(0)).count() == 0


def test_items_alike_and_one_scan(spark):
    docs = spark.createDataFrame([(1, "x " + ITEM)], "doc_id bigint, text string")
    items = spark.createDataFrame([(1, ITEM), (2, ITEM), (3, "other " * 20)], "item_id bigint, text string")
    found = leak.leaks(docs, items)
    assert sorted(r.item_id for r in found.collect()) == [1, 2]
    assert found._jdf.queryExecution().toString().count("MapInArrow") <= 4  # the same scan in each stage of the plan
    # Other items in the same workers are not answered from the scanner built before.
    assert sorted(r.item_id for r in leak.leaks(docs, items.where("item_id = 2")).collect()) == [2]
