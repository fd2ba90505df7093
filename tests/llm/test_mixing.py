import itertools
import os
import random
from collections import Counter

import pytest

from billforge.llm import mixing
from billforge.llm.mixing import fit, knapsack, plan


def test_knapsack_is_exact():
    rng = random.Random(1)
    for _ in range(60):
        counts = {rng.randrange(1, 30): rng.randrange(1, 4) for _ in range(4)}
        items = [n for n, c in counts.items() for _ in range(c)]
        sums = {sum(x) for k in range(len(items) + 1) for x in itertools.combinations(items, k)}
        budget = rng.randrange(0, sum(items) + 5)
        got = knapsack(counts, budget)
        assert all(0 < got[n] <= counts[n] for n in got)
        assert sum(n * k for n, k in got.items()) == min(sums, key=lambda s: (abs(s - budget), s))


def test_fit_large_budgets():
    rng = random.Random(2)
    counts = {n: rng.randrange(1, 2000) for n in rng.sample(range(20, 900), 200)}
    size = sum(n * c for n, c in counts.items())
    for share in (0.0, 0.001, 0.3, 0.77, 1.0):
        got = fit(counts, int(size * share))
        assert all(0 <= got[n] <= counts[n] for n in got) and sum(n * k for n, k in got.items()) == int(size * share)
    assert fit({5: 3}, 100) == {5: 3}


def test_plan_keeps_caps():
    lengths = {"a": {10: 100}, "b": {7: 10}, "c": {}}
    plans, total = plan(lengths, {"a": (0.5, 1), "b": (0.4, 3), "c": (0.1, 1), "d": (0.0, 5)})
    assert total == int(3 * 70 / (0.4 / 0.9)) and plans["b"][1] == 3 and set(plans) == {"a", "b"}
    assert plan({}, {"a": (1.0, 1)}) == ({}, 0)
    assert plan(lengths, {"a": (0.5, 1), "b": (0.5, 3)}, total=100)[0]["a"][0] == 50


def test_operator(spark):
    if not os.path.exists(mixing.TOKENIZER):
        pytest.skip("no tokenizer")
    rng = random.Random(4)
    docs = [(i, rng.choice(["a", "a", "a", "b", "c", None]), " ".join(["word"] * rng.randrange(1, 60)), 1) for i in range(600)]
    docs += [(1000 + i, "a", "the same text here", 1) for i in range(300)] + [(2000, "a", None, 1), (2001, "b", "", 1)]
    df = spark.createDataFrame(docs, "doc_id bigint, source string, text string, bucket int")
    targets = spark.createDataFrame([("a", 0.3, 1, 0), ("b", 0.7, 4, 0), ("zz", None, None, 0), (None, 0.5, 1, 0)], "source string, target_share double, max_repeats int, times int")
    mixed = mixing.mix(df, targets).collect()
    assert Counter(r.doc_id for r in mixed) == Counter(d[0] for d in docs)
    used = Counter()
    for r in mixed:
        used[r.source] += r.n_tokens * r.times
        assert r.times <= {"a": 1, "b": 4}.get(r.source, 0)
    assert abs(used["a"] / (used["a"] + used["b"]) - 0.3) < 1e-3
    assert {(r.doc_id, r.times) for r in mixed} == {(r.doc_id, r.times) for r in mixing.mix(df.repartition(7), targets).collect()}
    report = {r.source: r for r in mixing.shares(mixing.mix(df, targets), targets).collect()}
    assert report["a"].n_documents == sum(d[1] == "a" for d in docs) and report["c"].used_tokens == 0
    assert mixing.mix(df.limit(0), targets).count() == 0
    assert {r.times for r in mixing.mix(df, targets.limit(0)).collect()} == {0}
