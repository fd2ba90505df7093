"""Quality reports: what a session, a roster or the stored texts lack. Aggregations and anti joins, one plan for all groups at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def childless(parents: DataFrame, children: DataFrame, key: str, by: list[str], name: str) -> DataFrame:
    """How many parents of each group have no child."""
    return parents.join(children.select(key), key, "left_anti").groupBy(*by).agg(F.count(F.lit(1)).alias(name))


def vote_counts(votes: DataFrame, ballots: DataFrame, vote: str, option: str, counts: str) -> DataFrame:
    """Per vote the declared and actual yes, no and other, and whether they disagree; an option not declared counts as 0.

    ``counts`` is array<struct<option, value>> of votes. Other is what ``ballots`` call other.
    """
    kinds = ("yes", "no", "other")
    actual = ballots.groupBy(vote).agg(*(F.count_if(F.col(option) == k).alias(f"actual_{k}") for k in kinds))
    of = lambda k: F.get(F.filter(counts, lambda x: x["option"] == k), F.lit(0))["value"]
    declared = [of(k).alias(f"declared_{k}") for k in kinds]
    both = votes.select(vote, *declared).join(actual, vote, "left")
    both = both.select(vote, *(F.coalesce(f"actual_{k}", F.lit(0)).alias(f"actual_{k}") for k in kinds), *(f"declared_{k}" for k in kinds))
    bad = F.lit(False)
    for k in kinds:
        bad = bad | (F.col(f"actual_{k}") != F.coalesce(f"declared_{k}", F.lit(0)))
    return both.withColumn("bad_counts", bad)


def unmatched(rows: DataFrame, name: str, when: Column, by: list[str]) -> DataFrame:
    """Per group the names that match nothing, with their numbers."""
    return rows.where(when).groupBy(*by, name).agg(F.count(F.lit(1)).alias("n"))


def as_map(counts: DataFrame, by: list[str], name: str) -> DataFrame:
    """unmatched() as one map per group, as stored in a report; a group's map holds a row per different name."""
    return counts.groupBy(*by).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(name, "n")))).alias("names"))


def duplicate_values(rows: DataFrame, value: list[str], owner: str, most: int = 3) -> DataFrame:
    """Values that several owners have: their number and the first ``most`` of them by name.

    Each value keeps only its least names while it is aggregated, so a value that everyone has needs no more room than another.
    """
    owners = rows.where(F.coalesce(F.col(value[-1]), F.lit("")) != "").select(*value, owner).distinct()
    per = owners.groupBy(*value).agg(F.count(F.lit(1)).alias("n_owners")).where("n_owners > 1")
    rank = Window.partitionBy(*value).orderBy(owner)
    first = owners.select(*value, owner, F.row_number().over(rank).alias("_k")).where(F.col("_k") <= most)  # cut within each task before the shuffle
    names = first.groupBy(*value).agg(F.array_sort(F.collect_list(owner)).alias("owners"))
    return per.join(names, value)


def seats(expected: DataFrame, actual: DataFrame, by: list[str]) -> DataFrame:
    """Districts whose number of members is not as expected: missing, extra or unexpected; empty expected districts are skipped.

    ``expected`` has by.. and seats, ``actual`` by.. one row per member.
    """
    have = actual.groupBy(*by).agg(F.count(F.lit(1)).alias("members"))
    both = expected.join(have, by, "full_outer")
    n, m = F.coalesce("seats", F.lit(0)), F.coalesce("members", F.lit(0))
    problem = F.when(F.col("seats").isNull(), "unexpected").when(m < n, "missing").when(m > n, "extra")
    return both.select(*by, n.alias("seats"), m.alias("members"), problem.alias("problem")).where("problem is not null")


def seats_left(seats_by: DataFrame, vacancies: DataFrame, by: list[str], today: Column) -> DataFrame:
    """Seats less the vacancies that still hold; n_expired vacancies are an error of the settings."""
    v = vacancies.groupBy(*by).agg(F.count_if(F.col("vacant_until") >= today).alias("v"), F.count_if(F.col("vacant_until") < today).alias("n_expired"))
    return seats_by.join(v, by, "left").select(*by, (F.col("seats") - F.coalesce("v", F.lit(0))).alias("seats"), F.coalesce("n_expired", F.lit(0)).alias("n_expired"))


def coverage(rows: DataFrame, by: list[str], fields: list[str]) -> DataFrame:
    """Per group the number of rows, and of each field how many have it and the percentage."""
    n = F.count(F.lit(1))
    has = {f: F.count_if(F.coalesce(F.col(f).cast("string"), F.lit("")) != "") for f in fields}
    return rows.groupBy(*by).agg(n.alias("n"), *(c.alias(f"n_{f}") for f, c in has.items()), *(F.round(100.0 * c / n, 2).alias(f"pct_{f}") for f, c in has.items()))


def text_status(parents: DataFrame, texts: DataFrame, key: str, by: list[str]) -> DataFrame:
    """Per group its parents, and the percentages, rounded up, without text and with a text in error. ``texts`` has key and is_error."""
    one = texts.groupBy(key).agg(F.max("is_error").alias("is_error"))
    both = parents.join(one, key, "left")
    n = F.count(F.lit(1))
    missing, wrong = F.count_if(F.col("is_error").isNull()), F.count_if("is_error")
    return both.groupBy(*by).agg(n.alias("n"), F.ceil(100.0 * missing / n).cast("int").alias("pct_missing"), F.ceil(100.0 * wrong / n).cast("int").alias("pct_error"))


def within_cap(rows: DataFrame, by: list[str], most: int) -> DataFrame:
    """rows without the groups of more than ``most`` rows."""
    over = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > most)
    return rows.join(over.select(*by), by, "left_anti")


def session_report(bills: DataFrame, children: dict[str, DataFrame], sponsors: DataFrame, votes: DataFrame, ballots: DataFrame, bill: str, vote: str, session: str) -> DataFrame:
    """One row per session: bills and those missing each kind of child; votes and those without voters, without a declared yes or no, or whose ballots are not as declared; how many names match nothing.

    ``sponsors`` has bill, name, entity_type and matched, ``votes`` vote, session and counts (option, value), ``ballots`` vote, option,
    name and matched. An option that is not declared cannot disagree, but for others, of which none are expected then.
    """
    n = F.count(F.lit(1))
    has = bills.select(bill, session)
    for kind, rows in children.items():
        has = has.join(rows.select(bill).distinct().withColumn(f"_{kind}", F.lit(True)), bill, "left")
    of_bills = has.groupBy(session).agg(n.alias("bills"), *(F.count_if(F.col(f"_{k}").isNull()).alias(f"missing_{k}") for k in children))
    actual = ballots.groupBy(vote).agg(*(F.count_if(F.col("option") == k).alias(f"_{k}") for k in ("yes", "no", "other")), F.lit(True).alias("_voted"))
    both = votes.select(vote, session, *(F.try_element_at(F.map_from_entries("counts"), F.lit(k)).alias(f"_said_{k}") for k in ("yes", "no", "other"))).join(actual, vote, "left")
    differs = lambda k, none: F.coalesce(f"_{k}", F.lit(0)) != F.coalesce(f"_said_{k}", none)
    bad = differs("yes", F.coalesce("_yes", F.lit(0))) | differs("no", F.coalesce("_no", F.lit(0))) | differs("other", F.lit(0))
    of_votes = both.groupBy(session).agg(n.alias("votes"), F.count_if(F.col("_voted").isNull()).alias("missing_voters"), F.count_if(F.col("_said_yes").isNull()).alias("missing_yes"), F.count_if(F.col("_said_no").isNull()).alias("missing_no"), F.count_if(bad).alias("bad_counts"))
    lost = sponsors.where("not matched").select(bill, "name", F.when(F.col("entity_type") == "organization", "organizations").otherwise("people").alias("_kind")).join(bills.select(bill, session), bill)
    lost = lost.select(session, "_kind", "name").unionByName(ballots.where("not matched").join(votes.select(vote, session), vote).select(session, F.lit("voters").alias("_kind"), "name")).distinct()
    of_names = lost.groupBy(session).agg(*(F.count_if(F.col("_kind") == k).alias(f"unmatched_{k}") for k in ("people", "organizations", "voters")))
    out = of_bills.join(of_votes, session, "left").join(of_names, session, "left")
    return out.select(session, *(F.coalesce(c, F.lit(0)).alias(c) for c in out.columns if c != session))


def roster(persons: DataFrame, ident: str, by: list[str], today: Column) -> DataFrame:
    """(by.., kind, name, district, n): how many persons hold an active role of each type and district, and are in each active party."""
    active = lambda c: F.filter(F.coalesce(F.col(c), F.array()), lambda x: (F.coalesce(x["end_date"], F.lit("")) == "") | (x["end_date"] > today))
    entry = lambda kind, name, district: F.struct(F.lit(kind).alias("kind"), name.alias("name"), district.alias("district"))
    roles = F.transform(active("roles"), lambda r: entry("role", r["type"], F.coalesce(r["district"], F.lit(""))))
    parties = F.transform(active("party"), lambda p: entry("party", p["name"], F.lit("")))
    each = persons.select(ident, *by, F.explode(F.array_distinct(F.concat(roles, parties))).alias("_e")).select(ident, *by, "_e.*")
    return each.groupBy(*by, "kind", "name", "district").agg(F.count_distinct(ident).alias("n"))
