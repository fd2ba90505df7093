"""Derived fields: what bills, votes, persons and texts say in sum, by aggregation with argmax instead of ordered loops."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F


def bill_fields(actions: DataFrame, bill: str, date: str, order: str, text: str, kinds: str) -> DataFrame:
    """(bill, first_action_date, latest_action_date, latest_action_description, latest_passage_date).

    The latest action is the greatest (date, order), the passage the greatest date of an action of kind passage. For blank dates
    see bill_fields_exact().
    """
    latest = F.struct(date, order, text)
    return actions.groupBy(bill).agg(
        F.min(date).alias("first_action_date"), F.max(date).alias("latest_action_date"), F.max(latest)[text].alias("latest_action_description"),
        F.max(F.when(F.array_contains(kinds, "passage"), F.col(date))).alias("latest_passage_date"))


def bill_fields_exact(actions: Column) -> Column:
    """The same as an ordered fold over array<struct<o, d, t, c>>, in which a blank date counts as unset and so depends on the order."""
    zero = F.struct(F.lit(None).cast("string").alias("first"), F.lit(None).cast("string").alias("latest"), F.lit("").alias("description"), F.lit(None).cast("string").alias("passage"))

    def step(s: Column, e: Column) -> Column:
        unset = lambda x: F.coalesce(x, F.lit("")) == ""
        later = unset(s["latest"]) | (e["d"] >= s["latest"])
        passed = F.array_contains(e["c"], "passage") & (unset(s["passage"]) | (e["d"] >= s["passage"]))
        return F.struct(
            F.when(unset(s["first"]) | (e["d"] < s["first"]), e["d"]).otherwise(s["first"]).alias("first"), F.when(later, e["d"]).otherwise(s["latest"]).alias("latest"),
            F.when(later, e["t"]).otherwise(s["description"]).alias("description"), F.when(passed, e["d"]).otherwise(s["passage"]).alias("passage"))

    return F.aggregate(F.array_sort(actions), zero, step)


def vote_tally(counts: Column) -> Column:
    """``yes-no-other`` of array<struct<option, value>>; the last yes and no count, other is the sum of the rest."""
    rest = F.aggregate(F.filter(counts, lambda x: ~x["option"].isin("yes", "no")), F.lit(0), lambda s, x: s + F.coalesce(x["value"], F.lit(0)))
    last = lambda o: F.coalesce(F.get(F.filter(counts, lambda x: x["option"] == o), F.size(F.filter(counts, lambda x: x["option"] == o)) - 1)["value"], F.lit(0))
    return F.concat_ws("-", last("yes"), last("no"), rest)


def ranges(rows: DataFrame, by: list[str], start: str, end: str) -> DataFrame:
    """The span of each group: its least start and greatest end."""
    return rows.groupBy(*by).agg(F.min(start).alias("start_date"), F.max(end).alias("end_date"))


def latest(rows: DataFrame, by: list[str], order: list[Column]) -> DataFrame:
    """The first row of each group in the order."""
    return rows.withColumn("_k", F.row_number().over(W.partitionBy(*by).orderBy(*order))).where("_k = 1").drop("_k")


def first_text(links: DataFrame, by: list[str], order: str, text: str) -> DataFrame:
    """The first text of each group that is not empty, and the last link tried."""
    some = F.when(F.coalesce(F.col(text), F.lit("")) != "", F.struct(order, text))
    got = links.groupBy(*by).agg(F.min(some).alias("s"), F.max(order).alias("_last"))
    return got.select(*by, F.col(f"s.{text}").alias(text), F.col("s").isNull().alias("is_error"), F.coalesce(F.col(f"s.{order}"), F.col("_last")).alias("link"))


def current_role(roles: Column, today: Column) -> Column:
    """The last role that is active today, else null."""
    active = F.filter(roles, lambda r: (F.coalesce(r["end_date"], F.lit("")) == "") | (r["end_date"] > today))
    return F.get(active, F.size(active) - 1)


def primary_party(parties: Column, today: Column) -> Column:
    active = F.filter(parties, lambda r: (F.coalesce(r["end_date"], F.lit("")) == "") | (r["end_date"] > today))
    return F.get(active, F.size(active) - 1)["name"]


def numbered(rows: DataFrame, by: list[str], order: list[Column], name: str) -> DataFrame:
    """rows with their number from 1 within each group; the order must be total for the result to be one."""
    return rows.withColumn(name, F.row_number().over(W.partitionBy(*by).orderBy(*order)))
