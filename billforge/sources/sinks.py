"""Sinks: JSON objects, archives, CSV, YAML, text files, reports, metrics. All write from the executors."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from pathlib import Path

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StructType


def write_json(rows: DataFrame, folder: str, by: list[str] | None = None) -> None:
    """One JSON object a line, optionally in a folder per value of some columns; validation goes on its own branch."""
    writer = rows.write.mode("append")
    (writer.partitionBy(*by) if by else writer).json(folder)


def archive(rows: DataFrame, folder: str, jurisdiction: str, run: str) -> None:
    """A snapshot under jurisdiction and run."""
    rows.withColumns({"archived_jurisdiction": F.col(jurisdiction), "archived_run": F.lit(run)}).write.mode("append").partitionBy("archived_jurisdiction", "archived_run").json(folder)


def write_csv(rows: DataFrame, path: str) -> None:
    """With a header; arrays as text joined by ``;``."""
    flat = [F.array_join(c, ";").alias(c) if t.startswith("array") else F.col(c) for c, t in rows.dtypes]
    rows.select(*flat).write.mode("overwrite").option("header", True).csv(path)


def people_csv(persons: DataFrame, today: Column) -> DataFrame:
    """One flat row per person: current party and role, links joined."""
    active = lambda c: F.filter(F.coalesce(F.col(c), F.array()), lambda x: (F.coalesce(x["end_date"], F.lit("")) == "") | (x["end_date"] > today))
    role = F.get(active("roles"), F.size(active("roles")) - 1)
    return persons.select(
        "id", "name", F.get(active("party"), F.size(active("party")) - 1)["name"].alias("current_party"), role["district"].alias("current_district"),
        role["type"].alias("current_chamber"), "given_name", "family_name", "email", "birth_date")


def write_yaml(rows: DataFrame, folder: str, name: str) -> None:
    """A YAML document per row, named by a column, fields without a value left out; folder is shared by all executors."""

    def save(part) -> None:
        import yaml

        Path(folder).mkdir(parents=True, exist_ok=True)
        for r in part:
            doc = {k: v for k, v in json.loads(r["j"]).items() if v not in (None, "", [], {})}
            Path(folder, f"{r['n']}.yml").write_text(yaml.safe_dump(doc, sort_keys=False, allow_unicode=True))

    rows.select(F.col(name).alias("n"), F.to_json(F.struct(*rows.columns)).alias("j")).foreachPartition(save)


def write_texts(rows: DataFrame, folder: str, key: str, text: str) -> DataFrame:
    """The texts under their keys, as parquet; returns (key, n_chars)."""
    rows.select(key, text).write.mode("overwrite").parquet(folder)
    return rows.sparkSession.read.parquet(folder).select(key, F.length(text).alias("n_chars"))


def handle(rows: DataFrame, handler: Callable[[dict], None]) -> None:
    """Every row to a handler, on the executors."""
    rows.select(F.to_json(F.struct(*rows.columns)).alias("j")).foreachPartition(lambda part: [handler(json.loads(r["j"])) for r in part] and None)


def save_report(report: DataFrame, path: str, run: str) -> None:
    """Report rows appended under their run; groups without anything to report are left out by the caller."""
    report.withColumn("run", F.lit(run)).write.mode("append").parquet(path)


def print_report(report: DataFrame) -> Iterator[str]:
    """All lines of a report as text, a partition at a time."""
    for r in report.toLocalIterator():
        yield ", ".join(f"{k}: {v}" for k, v in r.asDict().items())


def metered(rows: DataFrame, name: str, **metrics: Column) -> tuple[DataFrame, Observation]:
    """rows, and metrics that are there once an action has run over them."""
    seen = Observation(name)
    return rows.observe(seen, *(c.alias(k) for k, c in metrics.items())), seen


def create_tables(spark: SparkSession, folder: str, schemas: dict[str, StructType]) -> list[str]:
    """Empty tables for those that do not exist yet; the names of the new ones."""
    made = []
    for name, schema in schemas.items():
        if not Path(folder, name).exists():
            spark.createDataFrame([], schema).write.parquet(f"{folder}/{name}")
            made.append(name)
    return made
