"""Sources: scraped JSON by type, YAML documents, CSV, stored tables, and a scraper as a data source."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from pathlib import Path

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import ArrayType, DataType, StringType, StructType

from billforge.functions.scalars import clean_whitespace
from billforge.operators import validate

try:
    import yaml
except ImportError:  # YAML documents are then an error where they are read, not here
    yaml = None


def json_objects(spark: SparkSession, folder: str, kind: str, schema: StructType) -> DataFrame:
    """One row per file ``{kind}_*.json`` with file_name, and unknown_keys for keys that the schema lacks."""
    text = spark.read.option("pathGlobFilter", f"{kind}_*.json").text(folder, wholetext=True)
    rows = text.select(F.col("_metadata.file_name").alias("file_name"), F.from_json("value", schema).alias("r"), validate.unknown_keys(F.col("value"), schema).alias("unknown_keys"))
    return rows.select("file_name", "unknown_keys", "r.*")


def yaml_objects(spark: SparkSession, folder: str, schema: StructType) -> tuple[DataFrame, DataFrame]:
    """(rows with file_name, (file_name, error) of documents that could not be read)."""

    @F.pandas_udf(StringType())
    def to_json(texts: pd.Series) -> pd.Series:
        def one(text: str) -> str:
            try:
                if yaml is None:
                    raise ValueError("no YAML library")
                got = yaml.safe_load(text)
                if not isinstance(got, dict):
                    raise ValueError("not a mapping")
                return json.dumps(got, default=str)
            except Exception as e:  # noqa: BLE001
                return json.dumps({"_error": str(e)[:300]})

        return texts.map(one)

    files = spark.read.option("pathGlobFilter", "*.yml").text(folder, wholetext=True)
    rows = files.select(F.col("_metadata.file_name").alias("file_name"), to_json("value").alias("j")).withColumn("error", F.get_json_object("j", "$._error"))
    good = rows.where("error is null").select("file_name", F.from_json("j", schema).alias("r")).select("file_name", "r.*")
    return good, rows.where("error is not null").select("file_name", "error")


def csv_rows(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """A CSV file with a header, all columns text."""
    return spark.read.option("header", True).schema(", ".join(f"`{c}` string" for c in columns)).csv(path)


def table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def optional_lines(spark: SparkSession, path: str) -> DataFrame:
    """The lines of a text file, none if there is no such file."""
    return spark.read.text(path) if Path(path).exists() else spark.createDataFrame([], "value string")


def sample_rows(rows: DataFrame, n: int, seed: int) -> DataFrame:
    """n rows at random."""
    return rows.orderBy(F.rand(seed)).limit(n)


def with_order(rows: DataFrame, children: str, keep: list[str]) -> DataFrame:
    """One row per entry of an array of structs, with its place as order."""
    return rows.select(*keep, F.posexplode(children).alias("order", "_c")).select(*keep, "order", "_c.*")


class ScraperSource(DataSource):
    """Objects of a scraper as rows (type, json): ``.option("module", ...)`` names a module with ``scrape(part) -> Iterator[dict]`` and ``PARTS``."""

    @classmethod
    def name(cls) -> str:
        return "scraper"

    def schema(self) -> str:
        return "type string, json string"

    def reader(self, schema: StructType) -> DataSourceReader:
        return _ScraperReader(self.options)


class _ScraperReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.module = options["module"]

    def _load(self):
        import importlib

        return importlib.import_module(self.module)

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(p) for p in self._load().PARTS]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        for x in self._load().scrape(partition.value):
            yield x.get("_type", ""), json.dumps(x)


def counted(objects: DataFrame) -> DataFrame:
    """Objects per type; a scrape without any is an error of the caller."""
    return objects.groupBy("type").agg(F.count(F.lit(1)).alias("n"))


Transformer = Callable[[Column], Column]


def transformed(rows: DataFrame, config: dict[str, Transformer | list[Transformer]]) -> DataFrame:
    """rows with the configured functions applied to their columns, in order."""
    out = {}
    for name, fs in config.items():
        c = F.col(name)
        for f in fs if isinstance(fs, list) else [fs]:
            c = f(c)
        out[name] = c
    return rows.withColumns(out)


def stripped(rows: DataFrame) -> DataFrame:
    """rows without blanks at the ends of any text, in arrays and structs too."""

    def strip(value: Column, kind: DataType) -> Column:
        if isinstance(kind, StringType):
            return clean_whitespace(value)
        if isinstance(kind, ArrayType):
            return F.transform(value, lambda x: strip(x, kind.elementType))
        if isinstance(kind, StructType):
            return F.when(value.isNotNull(), F.struct(*(strip(value[f.name], f.dataType).alias(f.name) for f in kind)))
        return value

    return rows.select(*(strip(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in rows.schema))
