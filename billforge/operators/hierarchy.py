"""Places and bodies: division paths, districts and seats, organization trees, and static reference tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from billforge.functions.scalars import children_of, division_part


def divisions(rows: DataFrame, column: str, levels: int = 3) -> DataFrame:
    """rows with the country and (kind, value) of each level of a division path."""
    country = F.regexp_extract(F.element_at(F.split(column, "/"), 2), "^country:(.*)$", 1)
    named = {f"{n}{i}": part for i in range(1, levels + 1) for n, part in zip(("kind", "value"), division_part(F.col(column), i))}
    return rows.withColumns({"country": country, **named})


def below(rows: DataFrame, column: str, parent: str, kind: str | None = None, depth: int = 1) -> DataFrame:
    return rows.where(children_of(F.col(column), parent, kind, depth))


def numbered_districts(chambers: DataFrame, n: str, seats: int = 1) -> DataFrame:
    """One row per district 1..n of each chamber, with its seats."""
    return chambers.select("*", F.explode(F.sequence(F.lit(1), F.col(n))).alias("k")).select("*", F.col("k").cast("string").alias("district"), F.lit(seats).alias("seats")).drop("k")


def seat_specs(chambers: DataFrame, count: str, names: str, seats: str) -> DataFrame:
    """Districts from any of three forms: a number of districts, a list of names, or a map of names to seats."""
    keep = [c for c in chambers.columns if c not in (count, names, seats)]
    row = lambda d, s: F.struct(d.cast("string").alias("district"), s.cast("int").alias("seats"))
    numbered = F.transform(F.sequence(F.lit(1), F.col(count)), lambda i: row(i, F.lit(1)))
    named = F.transform(F.col(names), lambda x: row(x, F.lit(1)))
    mapped = F.transform(F.map_entries(seats), lambda e: row(e["key"], e["value"]))
    spec = F.when(F.col(seats).isNotNull(), mapped).when(F.col(names).isNotNull(), named).otherwise(F.when(F.col(count) > 0, numbered))
    return chambers.select(*keep, F.explode(spec).alias("d")).select(*keep, "d.*")


def lookup(refs: DataFrame, places: DataFrame, abbr: str = "abbr", name: str = "name", jurisdiction: str = "jurisdiction_id") -> DataFrame:
    """refs with the jurisdiction found by the first key they have: abbreviation, name, id. ``places`` has the same three."""
    key = F.when(F.col(abbr).isNotNull(), F.concat(F.lit("a"), F.upper(abbr))).when(F.col(name).isNotNull(), F.concat(F.lit("n"), F.lower(name))).when(F.col(jurisdiction).isNotNull(), F.concat(F.lit("j"), F.col(jurisdiction)))
    keys = places.select(F.explode(F.array(F.concat(F.lit("a"), F.upper(abbr)), F.concat(F.lit("n"), F.lower(name)), F.concat(F.lit("j"), F.col(jurisdiction)))).alias("_key"), F.col(jurisdiction).alias("found"))
    return refs.withColumn("_key", key).join(F.broadcast(keys) if _fixed(places) else keys, "_key", "left").drop("_key")


def _fixed(places: DataFrame, most: int = 5000) -> bool:
    """Whether a static table of places is as small as it should be."""
    return places.limit(most + 1).count() <= most


def static_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A small reference table kept in memory."""
    return spark.createDataFrame(rows, schema)


def chamber_of(name: Column, upper: Column, lower: Column) -> Column:
    """The chamber whose name alone is within the first word of an event's name."""
    word = F.lower(F.split(F.trim(name), r"\s+")[0])
    u, l = F.contains(word, F.lower(upper)), F.contains(word, F.lower(lower))  # noqa: E741
    return F.when(u & ~l, "upper").when(l & ~u, "lower")


def district_status(roles: DataFrame, current: DataFrame, legacy: DataFrame, on: list[str]) -> DataFrame:
    """roles with ``status``: whether their district is a current one, one of former maps, or unknown."""
    known = current.select(*on, F.lit(1).alias("_k")).unionByName(legacy.select(*on, F.lit(2).alias("_k"))).groupBy(*on).agg(F.min("_k").alias("_k"))
    return roles.join(known, on, "left").withColumn("status", F.when(F.col("_k") == 1, "current").when(F.col("_k") == 2, "legacy").otherwise("unknown")).drop("_k")
