import itertools
import random
from types import SimpleNamespace

import numpy as np
import pyarrow as pa

from billforge.llm import address
from billforge.llm.address import compatible, distance, parts

REGIONS = {"zz": "zz", "monsheba": "zz", "yy": "yy", "mondora": "yy"}


def same(a, b):
    return compatible(parts(a, REGIONS), parts(b, REGIONS))


def test_distance():
    assert [distance("abc", x) for x in ("abc", "ab", "acb", "abcd", "xyz", "abcdefg")] == [0, 1, 1, 1, 3, 3]


def test_parts():
    p = parts("c/o Constituent Services; Holridge, ZZ 64235-1208; 8416 West Harvest Street; Room 190; U.S.A.", REGIONS)
    assert p == {"number": "8416", "direction": "w", "name": "harvest", "kind": "st", "unit": "room:190", "city": "holridge", "region": "zz", "code": "64235"}
    assert parts("State Office Building - 330 Foundry Avenue 5th Fl. - Bristack", REGIONS)["unit"] == "floor:5"
    assert parts("159 Fourth Av, St. Olmmore", REGIONS) | {"unit": ""} == parts("159 4th Ave., Saint Olmmore", REGIONS)
    for nothing in (None, "", "   ", "N/A", "nowhere", "Suite 4", "???", "x" * 10_000):
        assert parts(nothing, REGIONS) is None


def test_addresses_without_a_known_street():
    for text, want in {
        "PO Box 1234, Holridge": ("1234", "po box", ""), "State Capitol, Room 210": ("", "state capitol", "room:210"), "100 Broadway, Holridge": ("100", "broadway", ""),
        "450 Alameda": ("450", "alameda", ""), "77 Pine Crescent": ("77", "pine crescent", ""), "12 Rue de l'Église": ("12", "rue de l eglise", ""), "N4W22000 Bluemound Road": ("n4w22000", "bluemound road", "")}.items():
        p = parts(text, REGIONS)
        assert (p["number"], p["name"], p["unit"]) == want, text
    assert same("P.O. Box 01234, Holridge ZZ", "PO BOX 1234; Holridge") and not same("PO Box 1234, Holridge", "PO Box 1235, Holridge")
    assert same("12 Rue de l'Eglise, Holridge", "12 rue de l’église") and not same("12 Rue de l'Eglise", "14 Rue de l'Eglise")
    assert same("State Capitol, Room 210", "STATE CAPITOL - Rm. 210") and not same("State Capitol, Room 210", "State Capitol")


def test_groups(spark):
    rows = [(1, "11 Harvest St, Holridge"), (2, "11 Harvest St, Holridge"), (3, "11 Hravest Street, Holridge"), (4, "11 Harvest St #5, Holridge"), (5, None), (6, "PO Box 9"), (6, "PO Box 9")]
    got = address.location_groups(spark.createDataFrame(rows, "id bigint, address string"), REGIONS)
    assert sorted(map(tuple, got.collect())) == [(1, 1, 2), (2, 1, 2), (3, 3, 2), (4, 4, 0), (6, 6, 0)]


def test_same_location():
    a = "8416 W. Harvest St. Rm. 190, Holridge, ZZ 64235"
    for b in ("Room 190\n8416 West Harvest Street\nHolridge, Monsheba", "8416 W Hravest St - #190 - Holridge 64235", "8416 Harvest St W., Rm 190; Hollridge ZZ", "Legislative Annex; 8416 W HARVEST ST ROOM 190; ZZ 64235"):
        assert same(a, b), b
    for b in ("8416 W. Harvest St. Rm. 191, Holridge, ZZ 64235", "8416 W. Harvest St., Holridge, ZZ 64235", "8416 E. Harvest St. Rm. 190, Holridge, ZZ 64235", "8416 W. Harvest Ave. Rm. 190, Holridge, ZZ 64235", "8417 W. Harvest St. Rm. 190, Holridge, ZZ 64235", "8416 W. Harvest St. Rm. 190, Holridge, YY 64235", "8416 W. Harvest St. Rm. 190, Fenmoor, ZZ", "8416 W. Harvest St. 190th Floor, Holridge, ZZ"):
        assert not same(a, b), b
    assert not same("91 4th St, Holridge, ZZ", "91 5th St, Holridge, ZZ") and not same("91 First St, Holridge", "91 11th St, Holridge")


def test_operator_against_brute_force(spark):
    rng = random.Random(5)
    streets = ["Harvest", "Hravest", "Foundry", "4th", "Fourth", "Northgate"]
    texts = [f"{rng.choice([11, 77])} {rng.choice(['N. ', 'North ', ''])}{rng.choice(streets)} {rng.choice(['St', 'Street', 'Ave'])}{rng.choice([', Rm 5', ' #5', ''])}, Holridge, {rng.choice(['ZZ', 'Monsheba', 'YY'])}" for _ in range(120)]
    rows = list(enumerate(texts + ["11 Harvest St, Holridge, ZZ"] * 60)) + [(0, texts[0]), (500, None), (501, " "), (None, texts[0]), (502, "nowhere")]
    df = spark.createDataFrame([(i, t, "clash") for i, t in rows], "id bigint, address string, rep string")
    known = {i: p for i, t in rows if i is not None and (p := parts(t, REGIONS))}
    want = {(a, b) for a, b in itertools.combinations(sorted(known), 2) if compatible(known[a], known[b])}
    got = [tuple(r) for r in address.same_location(df, REGIONS).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    assert address.same_location(df.limit(0), REGIONS).count() == 0


def test_plan_is_a_few_shuffles(spark):
    """The driver holds the plan: it must not grow with the steps of the search."""
    rows = [(i, f"{11 + i % 3} Harvest St, Holridge") for i in range(30)]
    plan = address.same_location(spark.createDataFrame(rows, "id bigint, address string"), REGIONS)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") <= 5 and "Join" not in plan


def test_one_record_at_two_locations(spark):
    """The least id of two classes that share no letter: each is searched by its own grams."""
    rows = [(1, "11 Harvest St, Holridge, ZZ"), (1, "11 Quincy St, Fenmoor, YY"), (2, "11 Hravest St, Holridge, ZZ"), (3, "11 Quincy St, Fenmor, YY"), (4, "11 Quincy St, Fenmoor, YY")]
    df = spark.createDataFrame(rows, "id bigint, address string")
    assert {tuple(r) for r in address.same_location(df, REGIONS).collect()} == {(1, 2), (1, 3), (1, 4), (3, 4)}


def test_blocks_do_not_matter(monkeypatch):
    rng = random.Random(7)
    texts = sorted(f"{rng.choice([11, 77])} {rng.choice(['Harvest', 'Hravest', 'Foundry', 'Foundri'])} St, {rng.choice(['Holridge', 'Hollridge', 'Fenmoor'])}" for _ in range(90))
    known = [(i, parts(t, REGIONS)) for i, t in enumerate(texts)]
    rows = sorted(("|".join((p["number"], p["kind"], "")), "|".join(p[f] for f in address.REST), i) for i, p in known)
    want = {(a, b) for (a, p), (b, q) in itertools.combinations(known, 2) if compatible(p, q)}
    for size, most in ((20_000, 1_000_000), (4, 3), (50, 1)):
        monkeypatch.setattr(address, "ROWS", size)
        monkeypatch.setattr(address, "PAIRS", most)
        batches = lambda: (pa.RecordBatch.from_pydict({"id": [i], "place": [p], "rest": [r]}) for p, r, i in rows)
        counts = [(g, n) for b in address._count(batches()) for g, n in zip(b["gram"].to_pylist(), b["n"].to_pylist())]
        grams = sorted({g for g, _ in counts} - {-1})
        held = SimpleNamespace(value=(np.array(grams), np.array([sum(n for g, n in counts if g == x) for x in grams]), sum(n for g, n in counts if g == -1)))
        got = [pair for b in address._matched(held, address.COSINE, False)(batches()) for pair in zip(b["id_1"].to_pylist(), b["id_2"].to_pylist())]
        assert len(got) == len(set(got)) and set(got) == want
