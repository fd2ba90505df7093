"""Timestamps of mixed formats, precisions and zones as one moment in UTC.

Texts are taken apart by JVM expressions into a local time and, if given, an offset. Local times are joined as of their
moment to the intervals of constant offset of their zone (exploded by year, so the join is an equality on zone and year
plus a range): one matching interval gives the offset, two mean the time occurs twice and the earlier moment counts, none
means it was skipped and the offset before the gap counts.

Scale: the interval table is bounded by the zone database (about 600 zones, 201 years, at most a few intervals a year), so
it is broadcast; the events are read once and never shuffled for parsing.
"""

from __future__ import annotations

import functools
from datetime import datetime, timedelta, timezone
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from billforge.functions.text import BLANKS, strip
from billforge.session import broadcast_if_small

#: The years whose changes of offset are listed; others are looked up in these (_charted).
FIRST_YEAR, LAST_YEAR = 1800, 2100
#: Zone abbreviations that tell standard from daylight time, in hours from UTC.
FIXED_OFFSETS = {"Z": 0, "UTC": 0, "GMT": 0, "EST": -5, "EDT": -4, "CST": -6, "CDT": -5, "MST": -7, "MDT": -6, "PST": -8, "PDT": -7, "AKST": -9, "AKDT": -8, "HST": -10, "HDT": -9, "AST": -4, "ADT": -3}
MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]

_ZONE = r"(?i)(?:(?<=[0-9])(?:z|[+-][0-9]{2}:?[0-9]{2})|(?<=[0-9m.n]) ?(?:[ecmpah]t|utc|gmt|(?:e|c|m|p|ak|h|a)[sd]t|[a-z]+/[a-z_]+(?:/[a-z_]+)?)|(?<=[0-9]) (?:[+-][0-9]{2}:?[0-9]{2}))$"
_TIME = r"(?i)^(?:t|,? at |, ?| )?([0-9]{1,2})(?::([0-9]{2}))?(?::([0-9]{2})(?:[.,][0-9]+)?)? ?(a\.?m\.?|p\.?m\.?|noon|midnight)?$"
_MONTH = f"({'|'.join(MONTHS)})[a-z]*"
_DAY = r"(?i)^(?:[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}|[0-9]{1,2}/[0-9]{1,2}/(?:[0-9]{4}|[0-9]{2})|" + _MONTH + r"\.? [0-9]{1,2}(?:st|nd|rd|th)?,? [0-9]{4})(?![0-9])"


@functools.lru_cache(1000)
def _changes(zone: str) -> list[tuple[int, int]]:
    """(moment, offset from then on) of a zone's changes from FIRST_YEAR to LAST_YEAR, the first before all of them."""
    tz = ZoneInfo(zone)
    off = lambda s: int(datetime.fromtimestamp(s, tz).utcoffset().total_seconds())
    start, end = (int(datetime(y, 1, 1, tzinfo=timezone.utc).timestamp()) for y in (FIRST_YEAR, LAST_YEAR + 1))
    cuts, week, before = [(start - 10**9, off(start))], start, off(start)
    while week < end:
        if (after := off(week + 604800)) != before:
            lo, hi = week, week + 604800
            while hi - lo > 1:
                mid = (lo + hi) // 2
                lo, hi = (mid, hi) if off(mid) == before else (lo, mid)
            cuts.append((hi, after))
            before = after
        week += 604800
    return cuts


def offset_intervals(spark: SparkSession, zones: list[str]) -> DataFrame:
    """(zone, year, local_from, local_to, offset, gap_from): intervals of constant offset in local seconds, exploded by local year.

    ``gap_from`` is where the local times start that are skipped before the interval (or local_from if none are).
    """
    rows = []
    start, end = (int(datetime(y, 1, 1, tzinfo=timezone.utc).timestamp()) for y in (FIRST_YEAR, LAST_YEAR + 1))
    for zone in sorted(set(zones)):
        cuts = _changes(zone)
        for i, (at, o) in enumerate(cuts):
            local, until = at + o, (cuts[i + 1][0] if i + 1 < len(cuts) else end + 10**9) + o
            gap = min(local, at + cuts[i - 1][1]) if i else local
            years = [(datetime(1970, 1, 1) + timedelta(seconds=max(min(s, end), start))).year for s in (gap, until)]
            rows += [(zone, y, local, until, o, gap, cuts[i - 1][1] if i else o) for y in range(years[0], years[1] + 1)]
    return spark.createDataFrame(rows, "zone string, year int, local_from long, local_to long, offset int, gap_from long, offset_before int")


def _charted(local: Column) -> Column:
    """The local time at which a zone's intervals are looked up: itself within their years.

    Before FIRST_YEAR a zone keeps its first offset, so any time of that year stands for it. After LAST_YEAR the rules repeat
    with the calendar: the year of the 28 before the last ones that begins on the same weekday and is as long stands for it.
    """
    day = F.date_from_unix_date(F.floor(local / 86400).cast("int"))
    year = F.year(day)
    first = lambda y: F.unix_date(F.make_date(y, F.lit(1), F.lit(1)))
    leap = (year % 4 == 0) & ((year % 100 != 0) | (year % 400 == 0))
    like = {}
    for y in range(LAST_YEAR - 28, LAST_YEAR):
        like.setdefault((datetime(y, 1, 1).toordinal() % 7, y % 4 == 0 and (y % 100 != 0 or y % 400 == 0)), y)
    epoch = datetime(1970, 1, 1).toordinal()
    chart = F.create_map(*(F.lit(x) for (weekday, long), y in sorted(like.items()) for x in (weekday * 2 + long, y)))
    other = F.element_at(chart, F.pmod(first(year) + epoch, F.lit(7)) * 2 + leap.cast("int"))
    shifted = local + (first(other) - first(year)).cast("long") * 86400
    early = int(datetime(FIRST_YEAR, 7, 1, tzinfo=timezone.utc).timestamp())
    return F.when(year < FIRST_YEAR, F.lit(early).cast("long")).when(year > LAST_YEAR, shifted).otherwise(local)


def _apart(x: Column) -> Column:
    """x, in a projection that is not compiled into one method with its neighbours.

    All of parsed() in one method is more than the JVM compiles (8,000 bytecodes), and then it is interpreted, three times
    slower. A higher-order function keeps its projection out of whole-stage code; expressions are still compiled.
    """
    return F.get(F.transform(F.array(x), lambda v: v), F.lit(0))


def parsed(rows: DataFrame, text: str) -> DataFrame:
    """rows with epoch (seconds), or day (since 1970) and clock (seconds into it) of the local time, and offset (seconds) if the text has one.

    All are null if the text denotes no moment; day alone is null for a bare clock time. The stages are projections of
    their own, so that each text is taken apart once and the generated code stays small.
    """
    c = F.col
    rows = rows.withColumn("_s", strip(F.regexp_replace(text, f"{BLANKS}+", " ")))
    rows = rows.withColumns({"_epoch": F.when(c("_s").rlike("^[0-9]{10}$|^[0-9]{13}$"), F.substring("_s", 1, 10).cast("long")), "_zone": F.upper(F.trim(F.regexp_extract("_s", _ZONE, 0)))})
    body = F.trim(F.regexp_replace("_s", _ZONE, ""))
    body = F.regexp_replace(body, r"^([0-9]{4})([0-9]{2})([0-9]{2})(?:T([0-9]{2})([0-9]{2})([0-9]{2})?)?$", "$1-$2-$3T$4:$5:$6")
    body = F.regexp_replace(F.regexp_replace(body, "T::$", ""), ":$", "")
    rows = rows.withColumn("_body", _apart(F.regexp_replace(body, r"(?i)^(?:mon|tue|wed|thu|fri|sat|sun)[a-z]*\.?,? ", "")))
    rows = rows.withColumn("_day", F.lower(F.regexp_extract("_body", _DAY, 0)))
    rows = rows.withColumn("_rest", F.substring(c("_body"), F.length("_day") + 1, F.length("_body")))
    # Every form of a day becomes year-month-day: a month's name by its number, the year of m/d/y to the front.
    day = F.regexp_replace("_day", r"(?:st|nd|rd|th)?,? ([0-9]{4})$", "/$1")
    day = F.regexp_replace(day, f"^{_MONTH}\\.? ", "$1/")
    rows = rows.withColumn("_parts", F.split(F.regexp_replace(day, r"^([0-9]+)-([0-9]+)-([0-9]+)$", "$2/$3/$1"), "/"))
    digits = lambda x: F.when(x.rlike("^[0-9]+$"), x.cast("int"))
    first, second, third = (F.get("_parts", F.lit(k)) for k in range(3))
    month = F.coalesce(digits(first), F.nullif(F.array_position(F.array(*map(F.lit, MONTHS)), first).cast("int"), F.lit(0)))
    rows = rows.withColumns({"_mm": month, "_dd": digits(second), "_yy": digits(third) + F.when(F.length(third) == 2, 2000).otherwise(0)})
    leap = ((c("_yy") % 4 == 0) & (c("_yy") % 100 != 0)) | (c("_yy") % 400 == 0)
    last = F.when(c("_mm") == 2, F.when(leap, 29).otherwise(28)).when(c("_mm").isin(4, 6, 9, 11), 30).otherwise(31)
    exists = c("_mm").between(1, 12) & c("_dd").between(1, last) & c("_yy").between(1, 9999)
    rows = rows.withColumn("_date", F.when(exists, F.make_date("_yy", "_mm", "_dd")))
    g = lambda k: F.regexp_extract("_rest", _TIME, k)
    rows = rows.withColumns({"_g1": _apart(g(1)), "_g2": g(2), "_g3": g(3), "_mark": F.lower(F.replace(g(4), F.lit("."), F.lit("")))})
    n = lambda x: F.when(c(x) != "", c(x).cast("int"))
    rows = rows.withColumns({"_h": n("_g1"), "_m": n("_g2"), "_sec": F.coalesce(n("_g3"), F.lit(0))})
    twelve = c("_mark").isin("am", "pm", "noon", "midnight")
    hour = F.when(twelve & c("_h").between(1, 12), c("_h") % 12 + F.when(c("_mark").isin("pm", "noon"), 12).otherwise(0)).when((c("_mark") == "") & c("_m").isNotNull() & (c("_h") <= 23), c("_h"))
    minute = F.coalesce("_m", F.lit(0))
    clock = F.when((minute < 60) & (c("_sec") < 60), hour * 3600 + minute * 60 + c("_sec"))
    clock = F.when((c("_rest") == "") & c("_date").isNotNull() & (c("_zone") == ""), F.lit(0)).otherwise(clock)
    fixed = F.create_map(*(F.lit(x) for k, v in FIXED_OFFSETS.items() for x in (k, v * 3600)))
    digits = F.regexp_replace("_zone", "[^0-9]", "")
    numeric = F.when(c("_zone").rlike("^[+-]"), F.when(c("_zone").startswith("-"), -1).otherwise(1) * (F.substring(digits, 1, 2).cast("int") * 3600 + F.substring(digits, 3, 2).cast("int") * 60))
    rows = rows.withColumns({"_clock": _apart(clock), "_offset": F.coalesce(numeric, F.try_element_at(fixed, c("_zone")))})
    usable = c("_epoch").isNull() & c("_clock").isNotNull() & (c("_date").isNotNull() | (c("_day") == ""))
    f = lambda x: F.when(usable, x)
    rows = rows.withColumns({"epoch": c("_epoch"), "day": f(F.unix_date("_date")), "clock": f(c("_clock")), "offset": f(c("_offset"))})
    return rows.drop(*(x for x in rows.columns if x.startswith("_") and x != text))


def to_utc(rows: DataFrame, intervals: DataFrame, by: list[str], local: Column, out: str) -> DataFrame:
    """One row for each row of ``by`` (with zone and offset among them), ``out`` being UTC seconds of the local seconds: by
    the offset where given, else as of the zone's intervals. An unknown zone gives null.
    """
    rows = rows.withColumn("_local", local)
    need = F.col("_local").isNotNull() & F.col("offset").isNull()
    rows = rows.withColumn("_at", _charted(F.col("_local")))
    year = F.year(F.date_from_unix_date(F.floor(F.col("_at") / 86400).cast("int")))
    left = rows.withColumns({"_zone": F.when(need, F.col("zone")), "_year": F.when(need, year)})
    inside = (F.col("_at") >= F.col("i.local_from")) & (F.col("_at") < F.col("i.local_to"))
    skipped = (F.col("_at") >= F.col("i.gap_from")) & (F.col("_at") < F.col("i.local_from"))
    hit = left.join(F.broadcast(intervals.select(F.struct("*").alias("i"))), (F.col("_zone") == F.col("i.zone")) & (F.col("_year") == F.col("i.year")) & (inside | skipped), "left")
    used = F.coalesce(F.col("offset"), F.when(inside, F.col("i.offset")).when(skipped, F.col("i.offset_before")))
    # Of two intervals that match a repeated local time the earlier moment counts: the least.
    return hit.groupBy(*by).agg(F.min(F.col("_local") - used).alias(out))


def moments(events: DataFrame, zones: DataFrame, key: str, place: str, start: str, end: str, scraped: str) -> DataFrame:
    """(key, field_name, utc): the moment of every usable start and end in UTC.

    Of several rows for a key the greatest ``scraped`` counts (ties to the greatest texts). Rows with a null key are left
    out. Text without a zone, or with a zone name that does not tell standard from daylight time, is local time of the
    row's place; of a place that ``zones`` (place, time_zone) lacks, only texts with an offset denote a moment. Local time
    that occurs twice is the earlier moment; local time that is skipped is read with the offset before the change. A bare
    clock time in the end falls on the local day of the start. An empty input gives an empty result.

    One shuffle, on the key; explode, joins with the broadcast intervals, window and aggregations keep its partitioning.
    """
    known = [r[0] for r in zones.select("time_zone").where("time_zone is not null").distinct().collect()]  # names of the zone database
    intervals = offset_intervals(events.sparkSession, known)
    fields = F.struct(F.col(scraped).alias("at"), F.col(place).alias("place"), F.col(start).alias("s"), F.col(end).alias("e"))
    one = events.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("key")).agg(F.max(fields).alias("m")).select("key", "m.place", F.explode(F.array(F.struct(F.lit(start).alias("field_name"), F.col("m.s").alias("text")), F.struct(F.lit(end).alias("field_name"), F.col("m.e").alias("text")))).alias("f"))
    places = zones.groupBy(F.col(place).alias("place")).agg(F.max("time_zone").alias("zone"))
    rows = parsed(one.join(broadcast_if_small(places), "place", "left").select("key", "zone", "f.field_name", "f.text"), "text").drop("text")
    names = ["key", "zone", "field_name", "epoch", "day", "clock", "offset"]
    seconds = F.lit(86400).cast("long")
    rows = to_utc(rows, intervals, names, F.col("day") * seconds + F.col("clock"), "utc").withColumn("utc", F.coalesce("epoch", "utc"))
    there = F.from_utc_timestamp(F.timestamp_seconds("utc"), F.col("zone"))
    start_day = F.max(F.when(F.col("field_name") == start, F.unix_date(there.cast("date")))).over(W.partitionBy("key"))
    rows = rows.withColumn("start_day", start_day)
    bare = (F.col("field_name") == end) & F.col("day").isNull()
    rows = to_utc(rows, intervals, [*names, "utc", "start_day"], F.when(bare, F.col("start_day") * seconds + F.col("clock")), "late")
    return rows.select(F.col("key").alias(key), "field_name", F.coalesce("utc", "late").alias("utc")).where("utc is not null")
