"""Problems 1 to 4: edge cases of each operator, and brute force over a whole table where there is no SQL."""

import re
from datetime import datetime, timedelta, timezone
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F

from billforge.functions.text import bill_key, fold, strip
from billforge.operators.history import append_late, append_snapshot, effective, satellite_rows, satellite_view, versions
from billforge.operators.references import orphan_references
from billforge.operators.snapshots import snapshot_changes
from billforge.operators.timestamps import moments, parsed
from billforge.plans import general


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_fold_and_keys(spark):
    df = spark.createDataFrame([("  Unión  RURAL ",), ("unión rural",), (None,), ("",)], "x string")
    assert [r[0] for r in df.select(F.trim(fold(F.col("x")))).collect()] == ["unión rural", "unión rural", None, ""]
    ids = spark.createDataFrame([("  h.b. 0012",), ("HB12",), ("HB 12",), ("hb-00012",), (None,), ("0",), ("SJR",)], "x string")
    assert [r[0] for r in ids.select(bill_key(F.col("x"))).collect()] == ["HB 12"] * 4 + ["", "0", "SJR"]
    assert ids.select(strip(F.lit(" a b　"))).first()[0] == "a b"


def _history(spark, data, extra=""):
    df = spark.createDataFrame(data, "k string, p string, d int, a string, b string, entity string, n int")
    made = satellite_rows(df, F.col("k"), F.col("p"), F.col("d"), {"a": F.col("a"), "b": F.col("b")})
    return made


def test_history(spark):
    data = [
        ("x", "1", 1, "A", "B", "?", 0), ("x", "2", 1, "A", "B", "?", 0), ("x", "2", 9, "A", "C", "?", 0),  # a late correction of period 2
        ("x", "4", 1, "A", "C", "?", 0), ("x", "4", 1, "A", "C", "?", 0), ("y", "3", None, None, "", "?", 0), ("y", "4", None, "", None, "?", 0),
        (None, "1", 1, "A", "B", "?", 0), ("z", None, 1, "A", "B", "?", 0), ("w", "2", 1, "A", "B", "?", 0)]
    made = _history(spark, data)
    assert rows(versions(made)) == [("w", "2", "3"), ("x", "1", "2"), ("x", "2", "3"), ("x", "4", ""), ("y", "3", "")]
    view = {(r.entity, r.satellite, r.load_period): (r.end_period, r.present) for r in satellite_view(made).collect()}
    assert view["x", "a", "1"] == ("", True) and view["x", "b", "1"] == ("2", True) and view["x", "status", "3"] == ("4", False)
    assert rows(versions(_history(spark, []))) == []


def test_history_ties_are_stable(spark):
    a = [("x", "1", 1, "A", "B", "", 0), ("x", "1", 1, "Z", "B", "", 0), ("x", "2", 1, "A", "B", "", 0)]
    assert rows(versions(_history(spark, a))) == rows(versions(_history(spark, a[::-1])))


def test_snapshot_changes(spark):
    data = [("s", "1", "a", 1, "x"), ("s", "1", "b", 1, "x"), ("s", "2", "a", 1, "y"), ("s", "4", "a", 1, "y"), ("s", "4", "b", 1, "x"), ("s", "4", "c", 2, None), ("s", "4", "c", 1, "q"), ("s", "5", "c", 1, ""), ("t", "2", "a", 1, "x"), (None, "1", "a", 1, "x"), ("t", None, "a", 1, "x"), ("t", "3", None, 1, "x")]
    df = spark.createDataFrame(data, "s string, p string, k string, d int, v string").withColumn("source", F.lit("clash")).withColumn("n0", F.lit(1))
    got = snapshot_changes(df, F.col("s"), [F.col("k")], F.col("p"), F.col("d"), F.col("v"))
    assert rows(got) == rows(spark.createDataFrame([
        ("s", "a", "2", "changed"), ("s", "b", "2", "removed"), ("s", "b", "4", "added"), ("s", "c", "4", "added"), ("s", "a", "5", "removed"), ("s", "b", "5", "removed"),
        ("t", "a", "3", "removed"), ("t", "", "3", "added")], "a string, b string, c string, d string"))
    assert snapshot_changes(df.limit(0), F.col("s"), [F.col("k")], F.col("p"), F.col("d"), F.col("v")).count() == 0


def test_orphan_references(spark):
    kind = "source string, field string, row_id string, key string, at timestamp, range int"
    at = lambda d: datetime(2023, 1, d)
    hot = [("t", "f", f"h{i}", "there", at(9), 0) for i in range(300)] + [("t", "f", f"g{i}", "gone", at(9), 0) for i in range(300)]
    refs = spark.createDataFrame([("t", "f", "1", "there", at(9), 0), ("t", "f", "2", "there", at(1), 0), ("t", "f", "3", "deleted", at(9), 0), ("t", "f", "4", "gone", None, 0), ("t", "f", "5", None, at(9), 0), ("t", "f", None, "there", None, 0), *hot], kind)
    parents = spark.createDataFrame([("there", at(5), 1), ("there", at(7), 1), ("deleted", None, 1), (None, at(1), 1), *((f"k{i}", at(1), 1) for i in range(500))], "key string, since timestamp, block int")
    got = orphan_references(refs, parents, parents_per_range=50, references_per_block=40)
    what = {(r.row_id, r.reason) for r in got.collect()}
    assert what == {("2", "late"), ("3", "deleted"), ("4", "missing")} | {(f"g{i}", "missing") for i in range(300)}
    assert {r.reason for r in orphan_references(refs, parents.limit(0)).collect()} == {"missing"}
    assert orphan_references(refs.limit(0), parents).count() == 0


ZONES = [("ny", "America/New_York"), ("az", "America/Phoenix"), ("xx", None)]


def _moments(spark, data):
    events = spark.createDataFrame(data, "event_id bigint, place string, s string, e string, at int").withColumn("zone", F.lit("clash")).withColumn("utc", F.lit(1))
    zones = spark.createDataFrame(ZONES, "place string, time_zone string")
    return {(r.event_id, r.field_name): datetime.fromtimestamp(r.utc, timezone.utc).strftime("%Y-%m-%d %H:%M:%S") for r in moments(events, zones, "event_id", "place", "s", "e", "at").collect()}


def test_history_load_by_load(spark):
    """Fourteen snapshots one by one, then late corrections, give the rows of the whole rebuilt at once."""
    import random

    rng, raw = random.Random(3), []
    for n in range(14):
        for k in range(12):
            if rng.random() < 0.8:
                raw.append((f"k{k}", f"2023-{n:02d}", n * 10, rng.choice("xy"), rng.choice(["u", "u", "v", None])))
    cols = "k string, p string, d int, a string, b string"
    how = {"key": F.col("k"), "period": F.col("p"), "delivered": F.col("d"), "satellites": {"a": F.col("a"), "b": F.col("b")}}
    got = lambda df: sorted(map(tuple, df.select("entity", "satellite", "load_period", "hash_diff", "present", "value").collect()), key=repr)
    log, names = [], "entity string, satellite string, load_period string, hash_diff long, present boolean, value string"
    for n in range(14):
        one = spark.createDataFrame([r for r in raw if r[1] == f"2023-{n:02d}"], cols).coalesce(1)
        log += got(append_snapshot(spark.createDataFrame(log, names).coalesce(1), one, **how))
    assert sorted(log, key=repr) == got(satellite_rows(spark.createDataFrame(raw, cols).coalesce(1), **how))
    late = [("k1", "2023-05", 999, "z", "w"), ("k2", "2023-00", 999, "x", "u"), ("k3", "2023-13", 1, "q", "q"), ("new", "2023-07", 5, "x", None)]
    everything = spark.createDataFrame(raw + late, cols).coalesce(1)
    touched = everything.where(F.col("k").isin([r[0] for r in late]))
    more = append_late(spark.createDataFrame(log, names).coalesce(1), touched, everything.select(F.col("p").alias("period")), **how)
    whole = spark.createDataFrame(log, names).withColumns({"loaded": F.lit(1), "retracted": F.lit(False)}).unionByName(more.withColumn("loaded", F.lit(2)))
    assert got(effective(whole)) == got(satellite_rows(everything, **how))
    assert append_snapshot(spark.createDataFrame(log, names), everything.limit(0), **how).count() == 0


def test_years_beyond_the_listed(spark):
    from zoneinfo import ZoneInfo

    texts = ["1885-07-04 12:00", "2150-07-04 12:00", "1790-01-01 00:00", "2101-03-13 02:30", "9998-07-01 00:00", "2399-02-28 23:00"]
    events = spark.createDataFrame([(i, "c", x, None, datetime(2024, 1, 1)) for i, x in enumerate(texts)], "event_id long, place string, s string, e string, at timestamp")
    zones = spark.createDataFrame([("c", "America/Chicago")], "place string, time_zone string")
    for r in moments(events, zones, "event_id", "place", "s", "e", "at").collect():
        want = datetime.fromisoformat(texts[r.event_id]).replace(tzinfo=ZoneInfo("America/Chicago")) - datetime(1970, 1, 1, tzinfo=timezone.utc)
        assert r.utc == want.total_seconds(), texts[r.event_id]


def test_moments(spark):
    got = _moments(spark, [
        (1, "ny", "2023-11-05 01:30", "2:00 p.m.", 1), (2, "ny", "2023-03-12T02:30:00", None, 1), (3, "az", "3/5/23 12:00 noon", "TBD", 1), (4, "ny", "2023-07-04", "", 1),
        (5, "??", "2023-07-04 10:00", "2023-07-04T10:00:00.999Z", 1), (6, "ny", "old", "1:00 pm", 1), (6, "ny", "2023-07-04 23:30 EDT", "12:15 AM ET", 2), (7, "ny", "1688479200", "1688479200999", 1),
        (None, "ny", "2023-07-04", None, 1), (8, None, None, None, 1), (9, "xx", "2023-07-04 10:00 PST", "2023-02-30", 1), (10, "ny", "x" * 100_000, "2023-07-04T10:00:00+02:00", 1)])
    assert got == {
        (1, "s"): "2023-11-05 05:30:00", (1, "e"): "2023-11-05 19:00:00", (2, "s"): "2023-03-12 07:30:00", (3, "s"): "2023-03-05 19:00:00", (4, "s"): "2023-07-04 04:00:00",
        (5, "e"): "2023-07-04 10:00:00", (6, "s"): "2023-07-05 03:30:00", (6, "e"): "2023-07-04 04:15:00", (7, "s"): "2023-07-04 14:00:00", (7, "e"): "2023-07-04 14:00:00",
        (9, "s"): "2023-07-04 18:00:00", (10, "e"): "2023-07-04 08:00:00"}
    assert _moments(spark, []) == {}


OFFSETS = {"EST": -5, "EDT": -4, "CST": -6, "CDT": -5, "MST": -7, "MDT": -6, "PST": -8, "PDT": -7, "AKST": -9, "AKDT": -8, "HST": -10, "AST": -4}
FORMS = ["%Y-%m-%dT%H:%M:%S.%f", "%Y-%m-%dT%H:%M:%S", "%Y-%m-%dT%H:%M", "%Y-%m-%d %H:%M:%S", "%Y-%m-%d %H:%M", "%Y-%m-%d", "%Y%m%dT%H%M%S", "%m/%d/%Y %I:%M %p", "%m/%d/%y %I:%M %p", "%B %d, %Y %I:%M %p", "%b %d, %Y %I:%M %p", "%A, %B %d, %Y at %I:%M %p"]


def _brute(text, zone, start_day):
    """A plain reading of one text: epoch seconds, or None."""
    s = (text or "").strip()
    if re.fullmatch(r"\d{10}|\d{13}", s):
        return int(s[:10])
    tz = zone
    if m := re.search(r"(?<=\d)(Z|[+-]\d\d:?\d\d)$", s):
        h = 0 if m[1] == "Z" else int(m[1][:3]) * 60 + int(m[1][0] + m[1][-2:])
        if m[1] == "Z" or ":" in s or "T" in s:
            tz, s = timezone(timedelta(minutes=h)), s[: m.start()]
    elif m := re.search(r" ([A-Z]{2,4}|[A-Z][a-z]+/\w+)$", s):
        if m[1] in OFFSETS:
            tz, s = timezone(timedelta(hours=OFFSETS[m[1]])), s[: m.start()]
        elif m[1] not in ("AM", "PM"):
            s = s[: m.start()]
    s = s.replace("12:00 noon", "12:00 PM").replace("a.m.", "AM").replace("p.m.", "PM")
    for f in FORMS:
        try:
            return int(datetime.strptime(s, f).replace(tzinfo=tz).timestamp() // 1)
        except ValueError:
            pass
    try:
        t = datetime.strptime(s, "%I:%M %p")
        return int(datetime(start_day.year, start_day.month, start_day.day, t.hour, t.minute, tzinfo=tz).timestamp()) if start_day else None
    except ValueError:
        return None


def test_p4_against_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    try:
        events = spark.read.parquet(f"{sf}/scrape_event.parquet")
    except Exception:
        pytest.skip("no test data")
    zones = {r[0]: ZoneInfo(r[1]) for r in spark.read.parquet(f"{sf}/jurisdiction_zone.parquet").select("jurisdiction_id", "time_zone").collect()}
    want = set()
    for r in events.collect():
        zone = zones[r.jurisdiction_id]
        s = _brute(r.start_date, zone, None)
        e = _brute(r.end_date, zone, datetime.fromtimestamp(s, zone) if s is not None else None)
        for name, x in (("start_date", s), ("end_date", e)):
            if x is not None:
                want.add((r.event_id, name, datetime.fromtimestamp(x, timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")))
    got = [tuple(r) for r in general.p4_found(spark, sf).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_parsed_keeps_rows(spark):
    df = spark.createDataFrame([(None,), ("",), ("2023-07-04 25:00",), ("13/40/2023 1:00 PM",), (" 2023-07-04T10:00Z ",)], "t string")
    got = parsed(df, "t")
    assert got.count() == 5 and got.where("clock is not null").count() == 1 and set(got.columns) == {"t", "epoch", "day", "clock", "offset"}
