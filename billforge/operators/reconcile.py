"""Snapshot reconciliation: dedupe, classify against the current table, apply, purge.

A snapshot and the current table meet in one full outer join on the natural key; everything else (counters, new table
version, removals) derives from that change table. Comparisons are of whole structs, null-safe, in the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F


def dedupe(rows: DataFrame, content: list[str], order: list[str]) -> DataFrame:
    """rows with duplicate_of: the order columns' first row of equal content (itself null); content is compared as canonical JSON."""
    canonical = F.sha2(F.to_json(F.struct(*sorted(content)), {"ignoreNullFields": "false"}), 256)
    tagged = rows.withColumn("_h", canonical)
    # Least rows are found before the shuffle, so a content that a third of the rows share fills no task; the join back is split by AQE.
    first = tagged.groupBy("_h").agg(F.min(F.struct(*order)).alias("_first"), F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
    both = tagged.join(first, "_h", "left")
    return both.withColumn("duplicate_of", F.when(F.col("_first") != F.struct(*order), F.col("_first"))).drop("_h", "_first")


def changes(staged: DataFrame, current: DataFrame, key: list[str], fields: list[str]) -> DataFrame:
    """(key.., action, old, new) with action insert, update, noop or missing; old and new are structs of the fields."""
    a = staged.select(*key, F.struct(*fields).alias("new"))
    b = current.select(*key, F.struct(*fields).alias("old"))
    both = a.join(b, key, "full_outer")
    action = F.when(F.col("old").isNull(), "insert").when(F.col("new").isNull(), "missing").when(F.col("new").eqNullSafe(F.col("old")), "noop").otherwise("update")
    return both.select(*key, action.alias("action"), "old", "new")


def nested_changes(staged: DataFrame, current: DataFrame, key: list[str], fields: list[str], children: dict[str, bool]) -> DataFrame:
    """(key.., action, changed): records with child arrays reconciled as a whole; ``changed`` names the fields and children that differ.

    ``children`` maps an array column to whether its order counts. A record is updated if a field or any child differs, and just
    the children named need to be replaced; a null and an empty array are alike.
    """
    columns = [*fields, *children]
    a = staged.select(*key, F.struct(*columns).alias("n"))
    b = current.select(*key, F.struct(*columns).alias("o"))
    both = a.join(b, key, "full_outer")
    differs = [F.when(~F.col(f"n.{f}").eqNullSafe(F.col(f"o.{f}")), F.lit(f)) for f in fields]
    differs += [F.when(~same_children(F.col(f"n.{k}"), F.col(f"o.{k}"), ordered), F.lit(k)) for k, ordered in children.items()]
    found = both.withColumn("changed", F.when(F.col("n").isNotNull() & F.col("o").isNotNull(), F.array_compact(F.array(*differs))))
    action = F.when(F.col("o").isNull(), "insert").when(F.col("n").isNull(), "missing").when(F.size("changed") == 0, "noop").otherwise("update")
    return found.select(*key, action.alias("action"), F.coalesce("changed", F.array().cast("array<string>")).alias("changed"))


def must_recreate(new: Column, old: Column) -> Column:
    """Whether stored sub-objects are wiped and written again: another number of them, or a stored one that matches none of the new."""
    a, b = (F.coalesce(x, F.array()) for x in (new, old))
    return (F.size(a) != F.size(b)) | (F.size(F.array_except(b, a)) > 0)


def counters(changed: DataFrame) -> DataFrame:
    return changed.groupBy("action").agg(F.count(F.lit(1)).alias("n"))


def apply_changes(changed: DataFrame, key: list[str], purge: bool = False) -> DataFrame:
    """The next version of the table: new where there is one, else old; missing rows go if purge."""
    kept = changed.where("action <> 'missing'") if purge else changed
    return kept.select(*key, F.coalesce("new", "old").alias("row")).select(*key, "row.*")


def same_children(new: Column, old: Column, ordered: bool) -> Column:
    """Whether two arrays of structs are equal: as lists, or as multisets. Null and empty are alike."""
    a, b = (F.when(F.size(x) > 0, x if ordered else F.array_sort(x)) for x in (new, old))
    return a.eqNullSafe(b)


def merge_by_key(new: DataFrame, old: DataFrame, key: list[str], fields: list[str]) -> DataFrame:
    """Children merged by key: updated and added from new, never deleted."""
    a, b = new.select(*key, F.struct(*fields).alias("n")), old.select(*key, F.struct(*fields).alias("o"))
    return a.join(b, key, "full_outer").select(*key, F.coalesce("n", "o").alias("r")).select(*key, "r.*")


def replace_children(children: DataFrame, new: DataFrame, changed_parents: DataFrame, parent: str) -> DataFrame:
    """The children table with those of the changed parents replaced by new ones."""
    kept = children.join(changed_parents.select(parent).distinct(), parent, "left_anti")
    return kept.unionByName(new.join(changed_parents.select(parent).distinct(), parent, "left_semi"))


def purge_stale(current: DataFrame, imported: DataFrame, parent: str, key: str) -> DataFrame:
    """Rows of current whose parent the batch touched but which it did not bring again."""
    touched = imported.select(parent).distinct()
    return current.join(touched, parent, "left_semi").join(imported.select(key).distinct(), key, "left_anti")


def soft_delete(current: DataFrame, imported: DataFrame, key: str, scope: str) -> DataFrame:
    """current with deleted set for rows of the batch's scopes that it lacks, and cleared for those it has."""
    have = imported.select(key).distinct().withColumn("_in", F.lit(True))
    scopes = imported.select(scope).distinct().withColumn("_scope", F.lit(True))
    both = current.join(have, key, "left").join(scopes, scope, "left")
    return both.withColumn("deleted", F.when(F.col("_in"), F.lit(False)).when(F.col("_scope"), F.lit(True)).otherwise(F.coalesce("deleted", F.lit(False)))).drop("_in", "_scope")


def missing_ids(current: DataFrame, loaded: DataFrame, key: str) -> DataFrame:
    """Ids of current that a load does not bring; a load without purge must stop if there are any."""
    return current.select(key).subtract(loaded.select(key))


def guard_missing(current: DataFrame, loaded: DataFrame, key: str, purge: bool = False) -> DataFrame:
    gone = missing_ids(current, loaded, key)
    if not purge and not gone.isEmpty():
        raise ValueError("rows of the current table are missing from the load; load with purge to remove them")
    return gone


def duplicate_targets(resolved: DataFrame, target: str, order: list[str], allow: bool = False) -> DataFrame:
    """One input per target: with allow the last by order wins, else two inputs for one target are an error."""
    if not allow:
        twice = resolved.groupBy(target).count().where("count > 1")
        if not twice.isEmpty():
            raise ValueError("two inputs resolve to one target")
        return resolved
    w = W.partitionBy(target).orderBy(*(F.desc(c) for c in order))
    return resolved.withColumn("_k", F.row_number().over(w)).where("_k = 1").drop("_k")


def sessions_allowed(scraped: DataFrame, known: DataFrame, ignored: DataFrame, column: str = "session") -> DataFrame:
    """Scraped sessions that are neither known nor ignored."""
    return scraped.select(column).subtract(known.select(column).unionByName(ignored.select(column)))


def link_groups(links: DataFrame, owner: str, group: list[str], url: str, order: str) -> DataFrame:
    """One row per owner and group with its links in order; an owner has a url only once, where it came first."""
    w = W.partitionBy(owner, url).orderBy(order)
    once = links.withColumn("_k", F.row_number().over(w)).where("_k = 1")
    return once.groupBy(owner, *group).agg(F.transform(F.array_sort(F.collect_list(F.struct(order, url))), lambda x: x[url]).alias("links"))


def combine_reports(reports: DataFrame, by: list[str], start: str, end: str, counts: list[str]) -> DataFrame:
    """Reports of several runs as one: the first start, the last end, summed counts."""
    return reports.groupBy(*by).agg(F.min(start).alias(start), F.max(end).alias(end), *(F.sum(x).alias(x) for x in counts))
