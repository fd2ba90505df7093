"""The engine's own operators on small records with known results."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from billforge.functions import scalars as S
from billforge.operators import derive, fulltext, hierarchy, people, quality, reconcile, resolve, validate
from billforge.sources import readers, sinks
from billforge.streaming import realtime

c = F.col


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(f(c("x"))).first()[0]


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("text,want", [("HB1", "HB 1"), ("   HB1  ", "HB 1"), ("HB 0001", "HB 1"), ("hb    1", "HB 1"), ("SJRA", "SJR A"), ("HR 1", "HR 1"), ("HCONRES 1", "HCONRES 1"), ("HB 7", "HB 7")])
def test_bill_id(spark, text, want):
    assert one(spark, text, S.fix_bill_id) == want


@pytest.mark.parametrize("text,want", [("9193114500", "919-311-4500"), ("Tel. +1 (919) 311-4500", "1-919-311-4500"), ("919/311/4500, desk EXT.7", "919-311-4500 ext. 7"), ("919-311-4500 eXt 7", "919-311-4500"), ("919 311 4500 or ask", "919-311-4500"), ("311-4500", "311-4500"), ("", "")])
def test_phone(spark, text, want):
    assert one(spark, text, S.phone) == want


def test_scalars(spark):
    assert one(spark, "Room 9 \n\t 4 Elm   St\nTalsby", S.address) == "Room 9;4 Elm St;Talsby"
    assert one(spark, "N/A", S.office_phone) == "" and one(spark, "Same As Above", S.office_phone) == "" and one(spark, "toll (919)\t311-4500 x9", S.office_phone) == "919-311-4500" and one(spark, "919–311–4500", S.office_phone) == "919-311-4500"
    assert one(spark, "x", lambda x: S.uuid5("6ba7b8109dad11d180b400c04fd430c8", F.lit("python.org"))) == "886313e1-3b8a-5372-9b90-0c9aee199e5d"
    assert one(spark, '~{"name": "A", "x": 1}', lambda x: S.pseudo_field(x, "name")) == "A"
    assert one(spark, "{urn:uuid:886313E1-3b8a-5372-9b90-0c9aee199e5d}", S.is_uuid) is False and one(spark, "886313e13b8a53729b900c9aee199e5d", S.is_uuid)
    assert one(spark, " 1  first\nno number\n  2 second \n", S.numbered_lines) == "first\nsecond "
    assert one(spark, "first  1\nnone\nsecond 2 more 3 tail", lambda x: S.numbered_lines(x, after=False)) == "first\nsecond"
    assert one(spark, " ind", S.party_name) == " ind" and one(spark, "DEM", S.party_name) == "Democratic" and one(spark, "i", S.party_name) == "i"
    assert one(spark, "Bo\t de  Vries Jr.", lambda x: S.safe_filename(x, F.lit("ocd-person/12/3"))) == "Bo-de-Vries-Jr-12.yml"
    assert one(spark, "a\x00b\r\nc d\te", S.clean_text) == "ab\nc d e"


def test_bill_fields(spark):
    actions = [(100, "2020-04-20", "Introduced", []), (2, "2020-04-21", "Adopted", ["passage"]), (3, "2020-04-22", "Read twice", []), (4, "2020-04-22", "Laid on the table", [])]
    df = spark.createDataFrame([("b", *a) for a in actions], "bill string, o int, d string, t string, k array<string>")
    want = ("2020-04-20", "2020-04-22", "Laid on the table", "2020-04-21")
    assert derive.bill_fields(df, "bill", "d", "o", "t", "k").first()[1:] == want
    folded = df.groupBy("bill").agg(F.collect_list(F.struct("o", "d", "t", c("k").alias("c"))).alias("a")).select(derive.bill_fields_exact(c("a"))).first()[0]
    assert tuple(folded) == want


def test_update_cycle(spark):
    def action(old, new):
        kind = "id string, actions array<struct<d:string>>"
        o, n = spark.createDataFrame([("b", [(x,) for x in old])], kind), spark.createDataFrame([("b", [(x,) for x in new])], kind)
        return reconcile.changes(n, o, ["id"], ["actions"]).first().action

    cycle = [["a"], ["a", "b"], ["a", "b"], ["b", "a"], ["b", "x"], ["b"], [], ["a"]]
    assert [action(x, y) for x, y in zip(cycle, cycle[1:])] == ["update", "noop", "update", "update", "update", "update", "update"]


def test_reconcile(spark):
    old, new = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "k int, v string"), spark.createDataFrame([(2, "B"), (3, None), (4, "d")], "k int, v string")
    changed = reconcile.changes(new, old, ["k"], ["v"])
    assert {(r.k, r.action) for r in changed.collect()} == {(1, "missing"), (2, "update"), (3, "noop"), (4, "insert")}
    assert rows(reconcile.apply_changes(changed, ["k"])) == [(1, "a"), (2, "B"), (3, None), (4, "d")]
    assert rows(reconcile.apply_changes(changed, ["k"], purge=True)) == [(2, "B"), (3, None), (4, "d")]
    with pytest.raises(ValueError):
        reconcile.guard_missing(old, new, "k")
    with pytest.raises(ValueError):
        reconcile.duplicate_targets(spark.createDataFrame([("t", 1), ("t", 2)], "t string, o int"), "t", ["o"])
    tagged = reconcile.dedupe(spark.createDataFrame([(1, "x"), (2, "x"), (3, "y")], "id int, v string"), ["v"], ["id"])
    assert {(r.id, r.duplicate_of and r.duplicate_of.id) for r in tagged.collect()} == {(1, None), (2, 1), (3, None)}


def test_same_children(spark):
    kind = "a array<struct<k:int,v:string>>, b array<struct<k:int,v:string>>"
    df = spark.createDataFrame([([(1, "x"), (2, None)], [(2, None), (1, "x")]), ([(1, "x"), (1, "x")], [(1, "x")]), (None, [])], kind)
    assert [r[0] for r in df.select(reconcile.same_children(c("a"), c("b"), False)).collect()] == [True, False, True]
    assert [r[0] for r in df.select(reconcile.same_children(c("a"), c("b"), True)).collect()] == [False, False, True]


def test_sponsor_in_term(spark):
    """A name borne by two persons goes to the one who served at the time."""
    names = spark.createDataFrame([("j", "SPRINGFIELD"), ("f", "SPRINGFIELD")], "id string, uname string")
    members = spark.createDataFrame([("j", "x", "lower", "", "1910-01-01", False), ("f", "x", "lower", "2020-04-01", "", True)], "id string, jurisdiction string, chamber string, start_date string, end_date string, active boolean")
    refs = spark.createDataFrame([("1900", "SPRINGFIELD", "x", None, "1900-01-01", "1900-12-31"), ("2021", "SPRINGFIELD", "x", "lower", "2021-01-01", "2021-12-31"), ("up", "SPRINGFIELD", "x", "upper", "", ""), ("any", "SPRINGFIELD", "x", None, "", "")], "ref string, uname string, jurisdiction string, chamber string, from_date string, to_date string")
    assert {(r.ref, r.person) for r in resolve.resolve_person(refs, names, members, "id").collect()} == {("1900", "j"), ("2021", "f"), ("up", None), ("any", "f")}


def test_claims(spark):
    links = spark.createDataFrame([("v1", "a"), ("v2", "a"), ("v3", "b"), ("v3", "c"), ("v4", "d")], "v string, a string")
    taken = spark.createDataFrame([("d",)], "a string")
    assert rows(resolve.claim_once(links, "a", "v", ["v"], taken)) == [("v1", "a"), ("v2", None), ("v3", None), ("v4", None)]


def test_resolve_kinds_and_refs(spark):
    known = spark.createDataFrame([("1", "d1", "m1"), ("2", None, "m2"), ("3", None, "m2")], "id string, d string, m string")
    refs = spark.createDataFrame([("r1", "d1", None), ("r2", None, "m2"), ("r3", None, None), ("r4", "zz", "m1")], "ref string, d string, m string")
    assert rows(resolve.resolve_first_kind(refs, known, {"d": ["d"], "m": ["m"]}, "ref", "id")) == [("r1", "d", "1", 1), ("r2", "m", None, 2), ("r3", "invalid", None, 0), ("r4", "d", None, 0)]
    parents = spark.createDataFrame([(1, [("a",), ("b",)]), (2, [("a",), ("?",)]), (3, [])], "id int, kids array<struct<org:string>>")
    good, bad = resolve.rewrite_refs(parents, "kids", "org", "id", spark.createDataFrame([("a", 10), ("b", 20)], "org string, oid int"), "oid")
    assert {r.id: [k.org_id for k in r.kids or []] for r in good.collect()} == {1: [10, 20], 3: []} and [r.id for r in bad.collect()] == [2]
    assert one(spark, "joint COMMITTEE on ways & means", resolve.organization_name) == "Joint Committee on Ways and Means"


def test_bad_counts(spark):
    votes = lambda declared: spark.createDataFrame([("v", declared)], "v string, counts array<struct<option:string,value:int>>")
    ballots = lambda xs: spark.createDataFrame([("v", x) for x in xs], "v string, option string")
    bad = lambda d, b: quality.vote_counts(votes(d), ballots(b), "v", "option", "counts").first().bad_counts
    cycle = [([], []), ([("yes", 1)], []), ([("yes", 1)], ["yes"]), ([("yes", 1)], ["yes", "no"]), ([("yes", 1), ("no", 2)], ["yes", "no"]), ([("yes", 1), ("no", 2)], ["yes", "no", "no"])]
    assert [int(bad(d, b)) for d, b in cycle] == [0, 1, 0, 1, 1, 0]


def test_seats(spark):
    def problems(expected, actual):
        e = spark.createDataFrame(list(expected.items()), "d string, seats int")
        a = spark.createDataFrame([(k,) for k in actual], "d string")
        return quality.seats(e, a, ["d"]).count()

    assert [problems({"A": 1, "B": 1}, ["A", "B"]), problems({"A": 1}, ["A", "B"]), problems({"A": 1, "B": 1}, ["A"]), problems({"A": 0}, [])] == [0, 1, 1, 0]


def test_people(spark):
    kind = "array<struct<k:string,v:string>>"
    df = spark.createDataFrame([([("a", "1"), ("b", "2"), ("a", "9")], [("b", "3"), ("c", "4"), ("c", "5")])], f"o {kind}, n {kind}")
    assert [tuple(x) for x in df.select(people.merge_lists(c("o"), c("n"), "k")).first()[0]] == [("a", "1"), ("b", "3"), ("c", "5")]
    maps = spark.createDataFrame([({"a": 1, "b": 2}, {"b": 3})], "o map<string,int>, n map<string,int>")
    assert maps.select(people.merge_maps(c("o"), c("n"))).first()[0] == {"a": 1, "b": 3}
    offices = "array<struct<name:string,address:string,voice:string,fax:string>>"
    df = spark.createDataFrame([([("Capitol", "x", "1", "")], [("Capitol", "", "2", ""), ("District", "y", "", "")])], f"o {offices}, n {offices}")
    assert [tuple(x) for x in df.select(people.merge_offices(c("o"), c("n"))).first()[0]] == [("Capitol", "x", "2", ""), ("District", "y", "", "")]
    party = "array<struct<name:string,start_date:string,end_date:string>>"
    df = spark.createDataFrame([([("R", "", "")], "D")], f"o {party}, n string")
    assert [tuple(x) for x in df.select(people.merge_parties(c("o"), c("n"), F.lit("2023-01-01"))).first()[0]] == [("R", "", "2023-01-01"), ("D", "2023-01-01", "")]
    found = people.search(spark.createDataFrame([("A 100% Worm",), ("Wormer",)], "name string"), F.lit("100%"))
    assert found.count() == 1


def test_members(spark):
    df = spark.createDataFrame([("a", "o", "", ""), ("b", "o", "2030-01-01", "2040-01-01"), ("c", "o", "", "2020-01-01"), ("a", "o", "", "")], "person_id string, org string, start_date string, end_date string")
    assert rows(people.members_of(df, c("org") == "o", F.lit("2023-01-01"))) == [("a",)]
    assert people.members_of(df, c("org") == "o", F.lit("2023-01-01"), current_only=False).count() == 3


def test_divisions(spark):
    base = "ocd-division/country:us"
    ids = [base, f"{base}/state:ak", f"{base}/state:ak/county:wild", f"{base}/state:ak/county:wild/place:a", f"{base}/state:nc"]
    df = spark.createDataFrame([(x,) for x in ids], "d string")
    assert hierarchy.below(df, "d", base).count() == 2
    assert hierarchy.below(df, "d", f"{base}/state:ak", "county", 2).count() == 2
    assert hierarchy.below(df, "d", f"{base}/state:ak", "place", 2).count() == 0
    got = hierarchy.divisions(df, "d").where(c("d") == ids[3]).first()
    assert (got.country, got.kind2, got.value2, got.value3) == ("us", "county", "wild", "a")
    specs = spark.createDataFrame([("n", 2, None, None), ("l", None, ["A", "B"], None), ("m", None, None, {"X": 3})], "c string, n int, l array<string>, m map<string,int>")
    assert rows(hierarchy.seat_specs(specs, "n", "l", "m")) == [("l", "A", 1), ("l", "B", 1), ("m", "X", 3), ("n", "1", 1), ("n", "2", 1)]
    tree = spark.createDataFrame([("a", None), ("b", "a"), ("c", "b")], "i string, p string")
    assert rows(resolve.ancestors(tree, "i", "p")) == [("b", "a", 1), ("c", "a", 2), ("c", "b", 1)]


def test_validation(spark):
    df = spark.createDataFrame([("1", "A bill", "upper", ["bill"]), ("2", " ", "middle", ["bill", "joke"]), ("3", None, None, None)], "id string, title string, org string, kinds array<string>")
    checked = validate.check(df, [validate.filled("title"), validate.one_of("org", ["upper", "lower"]), validate.all_of("kinds", ["bill"])])
    good, bad = validate.split(checked)
    assert [r.id for r in good.collect()] == ["1"]
    assert {r.id: r.errors for r in bad.collect()} == {"2": ["title: empty", "org: not allowed", "kinds: not allowed"], "3": ["title: empty"]}
    role, party = "array<struct<type:string,district:string,end_date:string>>", "array<struct<name:string,end_date:string>>"
    people_df = spark.createDataFrame([("A B", "", "B", [("upper", "", "")], []), ("A B C", "A", "C", [("upper", "1", "")], [("X", "")])], f"name string, given_name string, family_name string, roles {role}, party {party}")
    got = [r.errors for r in validate.check(people_df, validate.person_rules(F.lit("2023-01-01"), ["X", "Y"])).collect()]
    assert got == [["roles: no district", "party: none active", "name: no given or family name"], []]


def test_json_and_yaml(spark, tmp_path):
    schema = StructType([StructField("_id", StringType()), StructField("name", StringType())])
    (tmp_path / "bill_1.json").write_text(json.dumps({"_id": "1", "name": "a", "odd": 1}))
    (tmp_path / "vote_2.json").write_text(json.dumps({"_id": "2"}))
    got = readers.json_objects(spark, str(tmp_path), "bill", schema).collect()
    assert [(r.file_name, r.unknown_keys, r.name) for r in got] == [("bill_1.json", ["odd"], "a")]
    pytest.importorskip("yaml")
    (tmp_path / "x.yml").write_text("_id: '7'\nname: b\n")
    (tmp_path / "y.yml").write_text("- not\n- a mapping\n")
    good, bad = readers.yaml_objects(spark, str(tmp_path), schema)
    assert [r.name for r in good.collect()] == ["b"] and [r.file_name for r in bad.collect()] == ["y.yml"]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("1", "j", ["a", "b"])], "id string, j string, xs array<string>")
    sinks.write_csv(df, f"{tmp_path}/csv")
    assert readers.csv_rows(spark, f"{tmp_path}/csv", ["id", "j", "xs"]).first().xs == "a;b"
    sinks.archive(df, f"{tmp_path}/arch", "j", "2023")
    assert spark.read.json(f"{tmp_path}/arch/archived_jurisdiction=j/archived_run=2023").count() == 1
    seen, metrics = sinks.metered(df, "m", n=F.count(F.lit(1)))
    seen.collect()
    assert metrics.get["n"] == 1
    assert sinks.create_tables(spark, str(tmp_path), {"t": df.schema}) == ["t"] and sinks.create_tables(spark, str(tmp_path), {"t": df.schema}) == []
    assert sinks.write_texts(df, f"{tmp_path}/txt", "id", "j").first().n_chars == 1


def test_stream(spark, tmp_path):
    src = str(tmp_path / "in")
    at = datetime(2023, 1, 2)
    spark.createDataFrame([(1, "bill", "x", at), (2, "vote", "x", at)], "id int, kind string, place string, at timestamp").coalesce(1).write.parquet(src)
    schema = spark.read.parquet(src).schema
    for _ in range(2):  # the second run adds nothing
        realtime.to_json_lines(realtime.stream(spark, src, schema, "parquet"), f"{tmp_path}/out", f"{tmp_path}/state", "kind", "place", "at").awaitTermination()
    assert spark.read.json(f"{tmp_path}/out").count() == 2
    spark.createDataFrame([(1, "law", "x", datetime(2023, 1, 3))], schema).coalesce(1).write.mode("append").parquet(src)
    got = realtime.reconciled(spark, src, schema, ["id"], ["kind"], "at", str(tmp_path / "work"))
    assert rows(got) == [(1, "law"), (2, "vote")]


def test_fulltext(spark):
    assert fulltext.pick("<p>a<b>b</b></p><script>x</script><div class='t p'>c<br>d</div>", "tag", "p") == "ab"
    assert fulltext.pick("<div class='t p'>c<br>d</div><div id=k>e", "class", "t") == "cd" and fulltext.pick("<div id=k>e", "id", "k") == "e" and fulltext.pick(None, "tag", "p") == ""
    df = spark.createDataFrame([("a", "text/html", "<p>x</p>"), ("a", "text/plain", " 1 y"), ("b", "text/plain", "z")], "place string, media string, raw string")
    got = fulltext.extract(df, [(None, "text/html", "paragraphs"), ("a", "text/plain", "numbered")], "place", "media", "raw")
    assert [r.text for r in got.collect()] == ["x", "y", "z"]


def test_ancestors_to_root(spark):
    chain = spark.range(1, 41).select(c("id").alias("i"), F.when(c("id") > 1, c("id") - 1).alias("p"))
    got = {(r.id, r.ancestor): r.depth for r in resolve.ancestors(chain, "i", "p").collect()}
    assert got == {(str(i), str(a)): i - a for i in range(1, 41) for a in range(1, i)}
    loop = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "d"), ("d", "b"), ("e", "e"), ("f", None)], "i string, p string")
    assert rows(resolve.ancestors(loop, "i", "p")) == [("a", "b", 1), ("a", "c", 2), ("a", "d", 3), ("b", "c", 1), ("b", "d", 2), ("c", "b", 2), ("c", "d", 1), ("d", "b", 1), ("d", "c", 2)]


def test_incoming_match(spark, data):
    kind = "id int, name string, a string, b string, seats int"
    old = spark.createDataFrame([(1, "Ann", "u", "1", 2), (2, "ann", "l", "1", 1), (3, "Bo", "l", "1", 1), (4, None, "l", None, 1)], kind)
    new = spark.createDataFrame([(10, "ANN", "l", "1", 1), (11, "Cy", "l", "1", 1), (12, "Cy", "u", "1", 1), (13, None, "l", None, 1), (14, "bo", "x", "1", 1)], kind)
    assert rows(people.match_incoming(new, old, "id", "name", ["a", "b"], "seats")) == [(10, 1, "name"), (11, 2, "role"), (14, 3, "name")]
    # One role for all: the pairs of a group would be 4,000,000,000,000.
    many = spark.range(2_000_000).select("id", F.concat(F.lit("n"), "id").alias("name"), F.lit("x").alias("a"), F.lit("y").alias("b"), F.lit(1).alias("seats"))
    got = people.match_incoming(many.withColumn("name", F.concat(F.lit("m"), "id")), many, "id", "name", ["a", "b"], "seats")
    assert rows(got.groupBy("old_id", "by").count()) == [(0, "role", 2_000_000)]


def test_incoming_match_whole(spark, data):
    from billforge.plans import reference

    got = {r.by: r["count"] for r in reference.QUERIES["incoming_match"](spark, data).groupBy("by").count().collect()}
    orders = spark.read.parquet(f"{data}/orders.parquet").count()
    assert set(got) == {"name", "role"} and sum(got.values()) > 0.9 * orders


def test_every_person_snapshot(spark, data, tmp_path):
    from billforge.plans import reference

    rest = "'g' given_name, 'f' family_name, 'e' email, '' birth_date, array(struct('P' name, '' start_date, '' end_date)) party"
    role = "array(struct('upper' type, 'ocd-jurisdiction/country:us/state:zz/government' jurisdiction, '{}' district, '2020-01-01' start_date, '{}' end_date, '' end_reason)) roles"
    who = [("2022-01-01", "p1", "A", "1", ""), ("2022-02-01", "p1", "B", "1", "2022-02-01"), ("2022-02-01", "p2", "C", "", "")]
    spark.sql(" union all ".join(f"select '{d}' snapshot_date, timestamp '{d} 01:00:00' delivered_at, '{i}' id, 'j' jurisdiction_id, '{n}' name, {rest}, {role.format(x, e)}" for d, i, n, x, e in who)).write.parquet(f"{tmp_path}/person_snapshot.parquet")
    spark.sql("select 1L office_id, 'c' person_name, 'ocd-jurisdiction/country:us/state:zz/government' jurisdiction_id").write.parquet(f"{tmp_path}/scrape_office.parquet")
    run = lambda name: reference.QUERIES[name](spark, str(tmp_path))
    assert rows(run("lint_person").select("id", "snapshot_date", "errors")) == [("p1", "2022-01-01", []), ("p1", "2022-02-01", ["roles: none active"]), ("p2", "2022-02-01", ["roles: no district"])]
    assert rows(run("person_summary").select("snapshot_date", "n")) == [("2022-01-01", 1), ("2022-02-01", 2)]
    assert rows(run("member_of").select("person_id")) == [("p2",)] and rows(run("current_legislators")) == [("p2", "upper", 1)]
    assert rows(run("resolve_person").select("person")) == [("p2",)]
    assert rows(run("person_merge")) == [("p1", "2022-01-01", "2022-02-01", "B", "e", ["name"])]


def test_extracted_text(spark, tmp_path):
    from billforge.plans import reference

    docs = [(1, "bill_text", "one <b> &amp; two\n\n three "), (2, "fiscal_note", " 1 first\n 2 second"), (3, "letter", "a\u00a0b"), (4, "letter", None), (5, "fiscal_note", "no\nnumbers")]
    spark.createDataFrame([(*d, "j") for d in docs], "doc_id long, source string, text string, jurisdiction_id string").write.parquet(f"{tmp_path}/documents.parquet")
    got = reference.QUERIES["extracted_text"](spark, str(tmp_path))
    assert rows(got) == [(1, "paragraphs", "one <b> &amp; two\nthree"), (2, "sometimes_numbered", "first\nsecond"), (3, "plain", "a b"), (4, "plain", None), (5, "sometimes_numbered", "no\nnumbers")]


def test_filed_names(spark):
    persons = spark.createDataFrame([(1, "upper", "Ann Lee", "LEE", ["Annie"]), (2, "lower", "Bo Lee", "Lee", None), (3, "legislature", "Cy", None, [])], "id int, chamber string, name string, family_name string, others array<string>")
    names = resolve.filed_names(persons, [], "chamber", "id", ["name", "family_name"], "others")
    assert names.where("id = 1").count() == 6 and rows(names.where("id = 3")) == [("legislature", "cy", 3)]
    refs = spark.createDataFrame([("upper", "lee"), ("legislature", "lee"), ("legislature", "annie"), ("lower", "annie"), ("lower", "bo lee")], "chamber string, name string")
    got = resolve.match_names(refs, names, ["chamber", "name"], "id")
    assert rows(got) == [("legislature", "annie", 1), ("legislature", "lee", None), ("lower", "annie", None), ("lower", "bo lee", 2), ("upper", "lee", 1)]
    assert "collect_set" not in got._jdf.queryExecution().toString()


def test_stripped_and_named(spark):
    from billforge.sources.readers import stripped

    df = spark.sql("select ' a\t' x, array(' b', null, 'c ') y, named_struct('z', ' d ', 'n', 1) s, 2 k")
    assert rows(stripped(df).selectExpr("x", "y", "s.z", "s.n", "k")) == [("a", ["b", None, "c"], "d", 1, 2)]
    people_ = spark.createDataFrame([("Ann Lee", None, ""), ("Ann van Lee", None, None), ("Bo Ek", "Bo", "Ek"), (None, None, None)], "name string, given_name string, family_name string")
    assert rows(people.fix_names(people_).select("name", "given_name", "family_name", "fixed")) == [("Ann Lee", "Ann", "Lee", True), ("Ann van Lee", "", "", False), ("Bo Ek", "Bo", "Ek", False), (None, "", "", None)]
    assert one(spark, 'a"b', lambda x: S.make_pseudo_id({"z": F.lit(None).cast("string"), "b": F.lit("2"), "a": x})) == '~{"a": "a\\"b", "b": "2"}'
    tree = spark.createDataFrame([(1, None), (2, 1), (3, 2), (4, 9), (5, 5)], "id int, parent int")
    assert rows(resolve.write_passes(tree, "id", "parent").select("id", "pass")) == [(1, 0), (2, 1), (3, 2), (4, 1), (5, 0)]
