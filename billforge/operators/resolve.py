"""Entity resolution: references by natural keys, names, partial specs and dates, as equi joins with counted candidates."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from billforge.session import broadcast_if_small, checkpoint


def resolve_unique(refs: DataFrame, candidates: DataFrame, on: list[str], ident: str) -> DataFrame:
    """refs with resolved (the one candidate of the key, else null) and n_candidates."""
    one = candidates.groupBy(*on).agg(F.min(ident).alias("_id"), F.count_distinct(F.col(ident)).alias("n_candidates"))
    both = refs.join(one, on, "left")
    return both.withColumn("resolved", F.when(F.col("n_candidates") == 1, F.col("_id"))).withColumn("n_candidates", F.coalesce("n_candidates", F.lit(0))).drop("_id")


def resolve_first_kind(refs: DataFrame, candidates: DataFrame, kinds: dict[str, list[str]], ref: str, ident: str) -> DataFrame:
    """(ref, kind, resolved, n_candidates): each reference by the first kind of key all of whose columns it has."""
    out = None
    earlier: Column = F.lit(False)
    for kind, columns in kinds.items():
        has = F.lit(True)
        for c in columns:
            has = has & F.col(c).isNotNull()
        own = refs.where(has & ~earlier).select(ref, F.lit(kind).alias("kind"), *columns)
        found = resolve_unique(own, candidates, columns, ident).select(ref, "kind", "resolved", "n_candidates")
        out = found if out is None else out.unionByName(found)
        earlier = earlier | has
    none = refs.where(~earlier).select(ref, F.lit("invalid").alias("kind"), F.lit(None).cast(dict(candidates.dtypes)[ident]).alias("resolved"), F.lit(0).cast("bigint").alias("n_candidates"))
    return out.unionByName(none)


def names_of(persons: DataFrame, ident: str, name: str, family: str, others: str | None = None) -> DataFrame:
    """(ident, uname): every name a person goes by, in upper case."""
    all_names = F.array(name, family) if others is None else F.concat(F.array(name, family), F.coalesce(others, F.array().cast("array<string>")))
    return persons.select(ident, F.explode(F.array_distinct(F.transform(all_names, lambda n: F.upper(F.regexp_replace(F.trim(n), r"\s+", " "))))).alias("uname")).where("uname <> ''")


def resolve_person(refs: DataFrame, names: DataFrame, memberships: DataFrame, ident: str) -> DataFrame:
    """refs (ref, uname, jurisdiction, chamber, from_date, to_date) with person, by name and one membership that fits.

    A membership (ident, jurisdiction, chamber, start_date, end_date, active) must be of the jurisdiction, of the chamber if one
    is asked for, and meet the dates (text; empty is unbounded). One person: that one; several: the only active one; else null.
    """
    fits = (F.col("m.jurisdiction") == F.col("r.jurisdiction")) & (F.col("r.chamber").isNull() | (F.col("m.chamber") == F.col("r.chamber")))
    s, e = F.coalesce("m.start_date", F.lit("")), F.coalesce("m.end_date", F.lit(""))
    fits = fits & ((e == "") | (F.col("r.from_date") == "") | (e > F.col("r.from_date"))) & ((s == "") | (F.col("r.to_date") == "") | (s < F.col("r.to_date")))
    hit = refs.alias("r").join(names.alias("n"), F.col("r.uname") == F.col("n.uname")).join(memberships.alias("m"), (F.col(f"n.{ident}") == F.col(f"m.{ident}")) & fits)
    who, active = F.col(f"n.{ident}"), F.when(F.col("m.active"), F.col(f"n.{ident}"))
    per = hit.groupBy(F.col("r.ref").alias("ref")).agg(F.count_distinct(who).alias("k"), F.min(who).alias("one"), F.count_distinct(active).alias("ka"), F.min(active).alias("onea"))
    picked = per.select("ref", F.when(F.col("k") == 1, F.col("one")).when(F.col("ka") == 1, F.col("onea")).alias("person"), F.col("k").alias("n_candidates"))
    return refs.join(picked, "ref", "left").withColumn("n_candidates", F.coalesce("n_candidates", F.lit(0)))


def session_at(refs: DataFrame, sessions: DataFrame) -> DataFrame:
    """refs (ref, jurisdiction, date) with session: the only one that holds the date, else the one that starts last of the jurisdiction.

    Sessions have jurisdiction, session, start_date, end_date, all text; an empty end is open.
    """
    last = sessions.groupBy("jurisdiction").agg(F.max(F.struct("start_date", "session")).alias("_l")).select("jurisdiction", F.col("_l.session").alias("_last"))
    inside = refs.join(broadcast_if_small(sessions), "jurisdiction").where("start_date <= date and (end_date >= date or end_date = '')")
    held = inside.groupBy("ref").agg(F.count(F.lit(1)).alias("_n"), F.min("session").alias("_one"))
    both = refs.join(held, "ref", "left").join(last, "jurisdiction", "left")
    return both.withColumn("session", F.when(F.col("_n") == 1, F.col("_one")).otherwise(F.col("_last"))).drop("_n", "_one", "_last")


def claim_once(links: DataFrame, claimed: str, claimant: str, order: list[str], taken: DataFrame | None = None) -> DataFrame:
    """links with claimed null where the claimant has not exactly one candidate, or another one came first, or it is taken."""
    counts = links.groupBy(claimant).agg(F.count_distinct(F.col(claimed)).alias("_n"))
    one = links.join(counts, claimant)
    if taken is not None:
        one = one.join(taken.select(F.col(claimed), F.lit(True).alias("_t")), claimed, "left")
        free = (F.col("_n") == 1) & F.col("_t").isNull()
    else:
        free = F.col("_n") == 1
    w = W.partitionBy(claimed, "_free").orderBy(*order)
    ranked = one.withColumn("_free", free).withColumn("_k", F.row_number().over(w))
    won = ranked.withColumn(claimed, F.when(F.col("_free") & (F.col("_k") == 1), F.col(claimed)))
    return won.groupBy(claimant).agg(F.max(claimed).alias(claimed))


def match_names(refs: DataFrame, names: DataFrame, on: list[str], ident: str) -> DataFrame:
    """refs with the person that alone bears the name in the chamber; none or several give null."""
    one = names.groupBy(*on).agg(F.min(ident).alias("_id"), F.count_distinct(F.col(ident)).alias("_n"))
    return refs.join(one, on, "left").withColumn("person", F.when(F.col("_n") == 1, F.col("_id"))).drop("_id", "_n")


def filed_names(persons: DataFrame, by: list[str], chamber: str, ident: str, names: list[str], others: str | None = None) -> DataFrame:
    """(by.., chamber, name, ident): every name of a person in lower case, under the chamber and under legislature.

    ``names`` are columns, ``others`` is an array of further names; refs are folded alike, by lower().
    """
    every = F.array(*names) if others is None else F.concat(F.array(*names), F.coalesce(others, F.array().cast("array<string>")))
    each = persons.select(*by, chamber, ident, F.explode(F.array_distinct(F.transform(every, lambda n: F.lower(n)))).alias("name")).where("name <> ''")
    return each.select(*by, F.explode(F.array_distinct(F.array(F.col(chamber), F.lit("legislature")))).alias("chamber"), "name", ident).distinct()


def get_or_create(wanted: DataFrame, existing: DataFrame, key: list[str]) -> DataFrame:
    """The rows of wanted that exist nowhere yet, each once."""
    return wanted.select(*key).distinct().join(existing.select(*key), key, "left_anti")


def repoint(rows: DataFrame, merged: DataFrame, column: str) -> DataFrame:
    """rows with ids in column replaced by what they were merged into (old_id, new_id)."""
    to = merged.groupBy(F.col("old_id").alias(column)).agg(F.min("new_id").alias("_new"))
    return rows.join(to, column, "left").withColumn(column, F.coalesce("_new", column)).drop("_new")


def ancestors(tree: DataFrame, ident: str, parent: str) -> DataFrame:
    """(id, ancestor, depth), nearest first; the walk ends at a root or at a node already met, however far that is.

    By doubling: the pairs at the greatest depth so far, a power of two, are joined to all pairs, until none is new. Of several
    ways to an ancestor the shortest counts.
    """
    edges = tree.select(F.col(ident).cast("string").alias("id"), F.col(parent).cast("string").alias("ancestor"), F.lit(1).alias("depth"))
    found = checkpoint(edges.where("id <> ancestor").distinct())
    far, reach = found, 1
    while not far.isEmpty():
        way = far.select("id", F.col("ancestor").alias("_via"), F.col("depth").alias("_d")).join(found.select(F.col("id").alias("_via"), "ancestor", "depth"), "_via")
        longer = way.where("id <> ancestor").groupBy("id", "ancestor").agg(F.min(F.col("_d") + F.col("depth")).alias("depth"))
        new = checkpoint(longer.join(found.select("id", "ancestor"), ["id", "ancestor"], "left_anti"))
        found, reach = found.unionByName(new), 2 * reach
        far = new.where(F.col("depth") == reach)
    return found


def rewrite_refs(parents: DataFrame, children: str, ref: str, key: str, known: DataFrame, ident: str, required: bool = True) -> tuple[DataFrame, DataFrame]:
    """(parents with the resolved id of ``ref`` in every entry of an array of structs as ``{ref}_id``, parents left out).

    Entries are exploded, joined and put together again in order. With ``required`` a parent any of whose entries names
    something unknown is left out whole; without it such an entry gets null. ``known`` has ref and ident, one row per ref.
    """
    each = parents.select(key, F.posexplode(children).alias("_pos", "_e")).withColumn(ref, F.col(f"_e.{ref}"))
    hit = each.join(known.select(ref, F.col(ident).alias("_id")), ref, "left")
    again = hit.groupBy(key).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("_pos", F.col("_e").withField(f"{ref}_id", F.col("_id")).alias("_e")))), lambda x: x["_e"]).alias("_children"),
        F.max((F.col("_id").isNull() & F.col(ref).isNotNull()).cast("int")).alias("_bad"))
    both = parents.join(again, key, "left")
    bad = F.coalesce(F.col("_bad"), F.lit(0)) == 1 if required else F.lit(False)
    good = both.where(~bad).withColumn(children, F.col("_children")).drop("_children", "_bad")
    return good, both.where(bad).select(*parents.columns)


def organization_name(name: Column) -> Column:
    """A name in title case with small prepositions and `` and `` for `` & ``; runs of letters begin with a capital wherever they stand."""
    runs = F.regexp_extract_all(F.lower(name), F.lit("([a-z]+|[^a-z]+)"), F.lit(1))
    title = F.array_join(F.transform(runs, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, 2, 1000))), "")
    for word in ("And", "Of", "The", "On", "For", "In", "To"):
        title = F.regexp_replace(title, f" {word} ", f" {word.lower()} ")
    return F.replace(title, F.lit(" & "), F.lit(" and "))


def polymorphic(kind: Column, ids: dict[str, Column], name: Column) -> tuple[Column, Column]:
    """(id, display name) of a reference that is to one of several tables, by its kind; without an id the name stands for it."""
    ident = F.coalesce(*(F.when(kind == k, i) for k, i in ids.items()))
    return ident, F.coalesce(ident.cast("string"), name)


def parent_or_chamber(bodies: DataFrame, organizations: DataFrame, on: list[str]) -> DataFrame:
    """bodies (parent, chamber, on..) with parent_id: of the parent they name, else of their chamber. ``organizations`` has on.., name, chamber and id."""
    named = organizations.groupBy(*on, F.col("name").alias("parent")).agg(F.min("id").alias("_by_name"))
    chambers = organizations.where("chamber is not null").groupBy(*on, "chamber").agg(F.min("id").alias("_by_chamber"))
    both = bodies.join(named, [*on, "parent"], "left").join(chambers, [*on, "chamber"], "left")
    return both.withColumn("parent_id", F.when(F.col("parent").isNotNull(), F.col("_by_name")).otherwise(F.col("_by_chamber"))).drop("_by_name", "_by_chamber")


def listed_members(lists: DataFrame, people: DataFrame, on: list[str], ids: str, ident: str) -> DataFrame:
    """One row per body and listed id, with the person of that id if there is one."""
    each = lists.select(*on, F.explode(ids).alias(ident))
    return each.join(people, ident, "left")


def abnormal(rows: DataFrame, column: str, fix: Callable[[Column], Column]) -> DataFrame:
    """Rows whose identifier has no blank, with the fixed one."""
    return rows.where(~F.col(column).contains(" ")).withColumn("fixed", fix(F.col(column)))


def resolve_named(refs: DataFrame, known: DataFrame, ref: str, by: list[str], name: str, others: str, ident: str) -> DataFrame:
    """refs (ref, by.., name) with ``resolved``: the one known (ident, by.., name, others) of equal name, ignoring case, or that has the very name among its other names; null where there is none or several.

    The either-or is a union of two keys of each known, so both are equi joins.
    """
    keys = known.select(*by, ident, F.explode(F.array_append(F.transform(F.coalesce(others, F.array().cast("array<string>")), lambda x: F.concat(F.lit("o"), x)), F.concat(F.lit("n"), F.upper(name)))).alias("_key"))
    wanted = refs.select(ref, *by, F.explode(F.array(F.concat(F.lit("o"), name), F.concat(F.lit("n"), F.upper(name)))).alias("_key"))
    found = wanted.join(keys.distinct(), [*by, "_key"]).groupBy(ref).agg(F.min(ident).alias("_one"), F.count_distinct(ident).alias("_n"))
    return refs.join(found, ref, "left").withColumn("resolved", F.when(F.col("_n") == 1, F.col("_one"))).drop("_one", "_n")


def write_passes(tree: DataFrame, ident: str, parent: str) -> DataFrame:
    """tree with ``pass``: roots are written in pass 0, every other record in the pass after its parent's."""
    far = ancestors(tree, ident, parent).groupBy(F.col("id").alias("_id")).agg(F.max("depth").alias("_pass"))
    both = tree.join(far, F.col(ident).cast("string") == F.col("_id"), "left")
    return both.select(*tree.columns, F.coalesce("_pass", F.lit(0)).alias("pass"))
