import itertools
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from billforge.llm import address, neardup


def shingles(text, width):
    w = re.findall("[a-z0-9]+", text.lower())
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)}


def likeness(a, b):
    return len(a & b) / len(a | b) if a and b else 0


def _corpus():
    rng = random.Random(3)
    words = [f"w{i}" for i in range(400)]
    texts = {}
    for g in range(12):
        base = [rng.choice(words) for _ in range(rng.choice([40, 120]))]
        for _ in range(8):
            t = list(base)
            for _ in range(rng.randrange(0, 9)):
                t[rng.randrange(len(t))] = rng.choice(words)
            texts[len(texts)] = " ".join(t)
    copy = " ".join(rng.choice(words) for _ in range(60))
    for _ in range(40):  # a hot class of copies
        texts[len(texts)] = rng.choice([copy, copy.upper(), copy.replace(" ", "  --  ")])
    texts |= {900: "", 901: "one two", 902: "one two", 903: "a b c", 904: "a, b; c!", 905: None, 906: "..."}
    return texts


def _pairs(spark, texts, width, threshold):
    rows = [(i, t, 1, "clash") for i, t in texts.items()] + [(0, texts[0], 1, "clash"), (0, "older " * 30, 0, "clash"), (None, "x y z", 1, "")]
    df = spark.createDataFrame(rows, "k bigint, t string, m int, rep string")
    return df, neardup.similar_pairs(df, F.col("k"), F.col("m"), F.col("t"), width, threshold)


def test_pairs_against_brute_force(spark):
    texts = _corpus()
    for width, threshold in ((3, 0.7), (5, 0.8), (3, 0.5), (2, 0.4)):
        sets = {i: shingles(t or "", width) for i, t in texts.items()}
        want = {(a, b) for a, b in itertools.combinations(sorted(sets), 2) if likeness(sets[a], sets[b]) >= threshold}
        got = [tuple(r) for r in _pairs(spark, texts, width, threshold)[1].collect()]
        assert len(want) > 780 and len(got) == len(set(got)) and set(got) == want


def test_groups(spark):
    texts = _corpus()
    df, pairs = _pairs(spark, texts, 3, 0.7)
    group = {r.id: r for r in neardup.similar_groups(df, F.col("k"), F.col("m"), F.col("t"), 3, 0.7).collect()}
    assert set(group) == {i for i, t in texts.items() if t is not None}
    parent = {i: i for i in group}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs.collect():
        parent[max(find(a), find(b))] = min(find(a), find(b))
    for i, r in group.items():
        if len((texts[i] or "").split()) >= 3:
            assert r.group_id == find(i)


def test_empty(spark):
    df = spark.createDataFrame([], "k bigint, t string, m int")
    assert neardup.similar_pairs(df, F.col("k"), F.col("m"), F.col("t")).count() == 0
    assert neardup.similar_groups(df, F.col("k"), F.col("m"), F.col("t")).count() == 0


def test_connected_chain(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "rep_1 bigint, rep_2 bigint")
    got = {r.rep: r.group_id for r in neardup.connected(chain).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


def test_variants_meet():
    """Fingerprints that differ in one symbol share a variant; those of unlike records do not."""
    words = np.arange(300, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    changed = words.copy()
    changed[150] = np.uint64(12345)
    flat, offsets = np.concatenate([words, changed, words[::-1]]), np.array([0, 300, 600, 900])
    variants, bits, some = neardup.fingerprint(flat, offsets, 3, neardup.Plan.of(0.7))
    assert list(some) == [0, 1, 2] and set(variants[0]) & set(variants[1]) and not set(variants[0]) & set(variants[2])
    assert variants.shape == (3, 96) and bits.shape == (3, 2)


def test_very_long_text(spark):
    long = " ".join(f"w{i % 5000}x{i}" for i in range(200_000))
    df = spark.createDataFrame([(1, long, 1), (2, long + " more words here", 1)], "k bigint, t string, m int")
    assert [tuple(r) for r in neardup.similar_pairs(df, F.col("k"), F.col("m"), F.col("t")).collect()] == [(1, 2)]


def test_plan_follows_the_threshold():
    assert neardup.Plan.of(0.7) == neardup.Plan(6, 16, 42)
    for t in (0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0):
        p = neardup.Plan.of(t)
        meet = t**p.symbols + p.symbols * t ** (p.symbols - 1) * (1 - t)
        assert (1 - meet) ** p.fingerprints <= 2e-4 and p.symbols * p.fingerprints <= neardup.SKETCH
    with pytest.raises(ValueError):
        neardup.Plan.of(0.1)


def test_texts_are_not_shuffled(spark):
    """Only digests, variants and the sets of candidates go through an exchange, and each text is taken apart in Python once a reading."""
    plan = _pairs(spark, _corpus(), 3, 0.7)[1]._jdf.queryExecution().executedPlan().toString()
    assert "words" not in plan and "md5" not in plan and "split(" not in plan


def test_word_hashes():
    texts = ["The  Act, of 1999", "", "act", "...", "ﬁ é İ the ACT\n", "of"]
    normal = [neardup.normal(t) for t in texts]
    assert normal == [b"the act of 1999", b"", b"act", b"", b"i the act", b"of"]
    h, at = neardup.word_hashes(normal)
    words = [h[a:b].tolist() for a, b in zip(at[:-1], at[1:])]
    assert [len(w) for w in words] == [4, 0, 1, 0, 3, 1] and len(set(h.tolist())) == 5
    assert words[0][1:2] == words[2] == words[4][2:] and words[0][0] == words[4][1] and words[0][2:3] == words[5]
    assert [len(x) for x in neardup.word_hashes([b"", b""])] == [0, 3]


def test_copies_meet_once(monkeypatch):
    rows = sorted((v, k) for v in range(5) for k in ([1] * 30 + [2, 3, 3] if v % 2 else [v])) + [(9, 1), (9, 2)]
    want = sorted([(1, 2), (1, 3), (2, 3)] * 2 + [(1, 2)])
    for size, most in ((20_000, 1_000_000), (7, 1)):
        monkeypatch.setattr(address, "ROWS", size)
        monkeypatch.setattr(address, "PAIRS", most)
        batches = (pa.RecordBatch.from_pydict({"variant": [v], "key": [k]}) for v, k in rows)
        assert sorted(pair for b in neardup._met(batches) for pair in zip(b["key_1"].to_pylist(), b["key_2"].to_pylist())) == want
