"""Persons and committees: structural merges, diffs, memberships, search. Lists are merged as arrays inside a row, in the JVM."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F


def merge_lists(old: Column, new: Column, key: str) -> Column:
    """old's order, items replaced by new ones of the same key, then the items only new has; of repeated keys old keeps its first, new its last."""
    o, n = F.coalesce(old, F.array()), F.coalesce(new, F.array())
    at = lambda xs, k: F.filter(xs, lambda y: y[key] == k)
    first = F.filter(o, lambda x, i: ~F.exists(F.slice(o, 1, i), lambda y: y[key] == x[key]))
    lasts = F.filter(n, lambda x, i: ~F.exists(F.slice(n, i + 2, F.greatest(F.size(n), F.lit(1))), lambda y: y[key] == x[key]))
    replaced = F.transform(first, lambda x: F.coalesce(F.get(at(lasts, x[key]), F.lit(0)), x))
    # What only new has stands in the order of its first appearance, with its last value.
    firsts_new = F.filter(n, lambda x, i: ~F.exists(F.slice(n, 1, i), lambda y: y[key] == x[key]) & ~F.exists(o, lambda y: y[key] == x[key]))
    return F.concat(replaced, F.transform(firsts_new, lambda x: F.get(at(lasts, x[key]), F.lit(0))))


def merge_maps(old: Column, new: Column) -> Column:
    """Both maps' entries; new wins."""
    return F.map_from_entries(F.concat(F.filter(F.map_entries(old), lambda e: ~F.map_contains_key(new, e["key"])), F.map_entries(new)))


def merge_plan(old: DataFrame, new: DataFrame, on: list[str], payload: str) -> DataFrame:
    """(on.., plan): add, remove, same or to_merge."""
    both = old.select(*on, F.col(payload).alias("_o"), F.lit(True).alias("_a")).join(new.select(*on, F.col(payload).alias("_n"), F.lit(True).alias("_b")), on, "full_outer")
    plan = F.when(F.col("_a").isNull(), "add").when(F.col("_b").isNull(), "remove").when(F.col("_o").eqNullSafe(F.col("_n")), "same").otherwise("to_merge")
    return both.select(*on, plan.alias("plan"))


def field_diff(old: Column, new: Column, scalars: list[str], lists: list[str]) -> Column:
    """array<struct<op, key, old, new>> of what a merge would do: scalars are replaced by new values that are not empty and differ,
    of lists an empty old one is replaced, else unseen items are appended. Values are given as JSON text."""
    kind = lambda op, key, a, b: F.struct(F.lit(op).alias("op"), F.lit(key).alias("key"), a.alias("old"), b.alias("new"))
    text = lambda x: F.coalesce(x.cast("string"), F.lit(""))
    out = [F.when((text(new[f]) != "") & (text(new[f]) != text(old[f])), kind("replace", f, text(old[f]), text(new[f]))) for f in scalars]
    for f in lists:
        added = F.array_except(F.coalesce(new[f], F.array()), F.coalesce(old[f], F.array()))
        empty = F.coalesce(F.size(old[f]), F.lit(0)) <= 0
        out.append(F.when(F.size(new[f]) > 0, F.when(empty, kind("replace", f, F.lit(""), F.to_json(new[f]))).when(F.size(added) > 0, kind("append", f, F.lit(""), F.to_json(added)))))
    return F.array_compact(F.array(*out))


def apply_diff(old: Column, new: Column, scalars: list[str], lists: list[str]) -> Column:
    """The merged struct."""
    keep = lambda f: F.when(F.coalesce(new[f].cast("string"), F.lit("")) != "", new[f]).otherwise(old[f]).alias(f)
    join = lambda f: F.concat(F.coalesce(old[f], F.array()), F.array_except(F.coalesce(new[f], F.array()), F.coalesce(old[f], F.array()))).alias(f)
    return F.struct(*(keep(f) for f in scalars), *(join(f) for f in lists))


def merge_offices(old: Column, new: Column, key: str = "name", fields: tuple[str, ...] = ("address", "voice", "fax")) -> Column:
    """Offices by name: of each field the new value unless empty; offices of one side are kept."""
    o, n = F.coalesce(old, F.array()), F.coalesce(new, F.array())
    mine = lambda x: F.get(F.filter(n, lambda y: y[key] == x[key]), F.lit(0))
    both = F.transform(o, lambda x: F.struct(x[key].alias(key), *(F.coalesce(F.nullif(mine(x)[f], F.lit("")), x[f]).alias(f) for f in fields)))
    only = F.transform(F.filter(n, lambda y: ~F.exists(o, lambda x: x[key] == y[key])), lambda y: F.struct(y[key].alias(key), *(y[f].alias(f) for f in fields)))
    return collapse_offices(F.concat(both, only), fields)


def collapse_offices(offices: Column, fields: tuple[str, ...] = ("address", "voice", "fax")) -> Column:
    """Without the offices all of whose values an earlier office has too."""
    within = lambda x, y: _all((F.coalesce(x[f], F.lit("")) == "") | x[f].eqNullSafe(y[f]) for f in fields)
    return F.filter(offices, lambda x, i: ~F.exists(F.slice(offices, 1, i), lambda y: within(x, y)))


def _all(conditions) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & c
    return out


def merge_parties(old: Column, new: Column, today: Column) -> Column:
    """A new party closes the old one today and follows it; the same party changes nothing."""
    last = F.get(old, F.size(old) - 1)
    closed = F.transform(old, lambda x, i: F.struct(x["name"].alias("name"), x["start_date"].alias("start_date"), F.when(i == F.size(old) - 1, today).otherwise(x["end_date"]).alias("end_date")))
    opened = F.array(F.struct(new.alias("name"), today.alias("start_date"), F.lit("").alias("end_date")))
    return F.when(F.coalesce(F.size(old), F.lit(0)) <= 0, opened).when(new.isNull() | (last["name"] == new), old).otherwise(F.concat(closed, opened))


def retire(roles: Column, end: Column, reason: Column) -> Column:
    """Roles with those still open closed."""
    is_open = lambda r: F.coalesce(r["end_date"], F.lit("")) == ""
    return F.transform(roles, lambda r: r.withField("end_date", F.when(is_open(r), end).otherwise(r["end_date"])).withField("end_reason", F.when(is_open(r), reason).otherwise(r["end_reason"])))


def members_of(memberships: DataFrame, organization: Column, today: Column, current_only: bool = True, ident: str = "person_id", post: Column | None = None) -> DataFrame:
    """The persons that are, or ever were, members (of a post there); each once."""
    rows = memberships.where(organization if post is None else organization & post)
    if current_only:
        s, e = F.coalesce("start_date", F.lit("")), F.coalesce("end_date", F.lit(""))
        rows = rows.where(((s == "") | (s <= today)) & ((e == "") | (e >= today)))
    return rows.select(ident).distinct()


def search(persons: DataFrame, query: Column, name: str = "name", current: Column | None = None, state: Column | None = None, exact: dict[str, Column] | None = None) -> DataFrame:
    """Persons whose name contains the query, or one of whose ``exact`` columns equals its value, ignoring case; signs of patterns stand for themselves."""
    hit = F.contains(F.upper(F.col(name)), F.upper(query))
    for column, value in (exact or {}).items():
        hit = hit | (F.upper(F.col(column)) == F.upper(value))
    for also in (current, state):
        hit = hit if also is None else hit & also
    return persons.where(hit)


def fix_names(persons: DataFrame) -> DataFrame:
    """Persons (name, given_name, family_name) with the parts of a name of two words where they lack them, and whether that was so."""
    words = F.split(F.trim("name"), r"\s+")
    given, family = (F.coalesce(x, F.lit("")) for x in ("given_name", "family_name"))
    two = F.size(words) == 2
    return persons.withColumns({"fixed": two & ((given == "") | (family == "")), "given_name": F.when(two & (given == ""), words[0]).otherwise(given), "family_name": F.when(two & (family == ""), words[1]).otherwise(family)})


def match_incoming(new: DataFrame, old: DataFrame, ident: str, name: str, role: list[str], seats: str) -> DataFrame:
    """(new id, old id, by): persons of equal name, else of equal role where it has one seat; of several the first old id.

    Old persons are first reduced to one per name and one per role, so that no join multiplies rows.
    """
    named = old.groupBy(F.upper(name).alias("_name")).agg(F.min(ident).alias("_by_name"))
    seated = old.where(F.col(seats) == 1).groupBy(*(F.col(r).alias(f"_{r}") for r in role)).agg(F.min(ident).alias("_by_role"))
    rows = new.select(F.col(ident).alias("new_id"), F.upper(name).alias("_upper"), *role)
    both = rows.join(named, F.col("_upper") == F.col("_name"), "left").join(seated, _all(F.col(r) == F.col(f"_{r}") for r in role), "left")
    found = F.when(F.col("_by_name").isNotNull(), F.struct(F.lit(1).alias("k"), F.col("_by_name").alias("old_id"))).when(F.col("_by_role").isNotNull(), F.struct(F.lit(2).alias("k"), F.col("_by_role").alias("old_id")))
    best = both.groupBy("new_id").agg(F.min(found).alias("m")).where("m is not null")
    return best.select("new_id", F.col("m.old_id").alias("old_id"), F.when(F.col("m.k") == 1, "name").otherwise("role").alias("by"))


def current_legislators(memberships: DataFrame, today: Column, chambers: list[str]) -> DataFrame:
    """One row per current membership in one of the chambers: a person with two is there twice."""
    s, e = F.coalesce("start_date", F.lit("")), F.coalesce("end_date", F.lit(""))
    return memberships.where(F.col("chamber").isin(*chambers) & ((s == "") | (s <= today)) & ((e == "") | (e >= today)))


def browse(rows: DataFrame, query: str, fields: list[str]) -> DataFrame:
    """Rows in which every word of the query is inside some field, ignoring case."""
    for word in query.split():
        hit = F.lit(False)
        for f in fields:
            hit = hit | F.coalesce(F.contains(F.upper(F.col(f).cast("string")), F.lit(word.upper())), F.lit(False))
        rows = rows.where(hit)
    return rows


def merge_committees(old: DataFrame, new: DataFrame, on: list[str], fixed: list[str], lists: dict[str, str]) -> DataFrame:
    """Committees of both sides merged: lists by key; conflict names the fixed fields that disagree, and such a committee must not be merged."""
    a = old.select(*on, F.struct(*fixed, *lists).alias("_o"))
    b = new.select(*on, F.struct(*fixed, *lists).alias("_n"))
    both = a.join(b, on)
    conflict = F.array_compact(F.array(*(F.when(~F.col(f"_o.{f}").eqNullSafe(F.col(f"_n.{f}")), F.lit(f)) for f in fixed)))
    merged = [merge_lists(F.col(f"_o.{c}"), F.col(f"_n.{c}"), k).alias(c) for c, k in lists.items()]
    return both.select(*on, conflict.alias("conflict"), *(F.col(f"_n.{f}").alias(f) for f in fixed), *merged)


def same_members(old: Column, new: Column) -> Column:
    """Whether two lists hold the same entries, whatever their order and number."""
    o, n = F.coalesce(old, F.array()), F.coalesce(new, F.array())
    return (F.size(F.array_except(o, n)) == 0) & (F.size(F.array_except(n, o)) == 0)


def process_offices(offices: Column, phone: Callable[[Column], Column], address: Callable[[Column], Column]) -> Column:
    """Offices with their phones and addresses in one form, without those that have no value."""
    blank = lambda x: F.coalesce(F.trim(x), F.lit("")) == ""
    done = F.transform(offices, lambda x: x.withField("voice", phone(x["voice"])).withField("fax", phone(x["fax"])).withField("address", address(x["address"])))
    return F.filter(done, lambda x: ~(blank(x["voice"]) & blank(x["fax"]) & blank(x["address"])))
