"""Streams: micro-batches of scraped objects to partitioned JSON lines, and reconciliation of each batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from billforge.operators import reconcile


def stream(spark: SparkSession, folder: str, schema: StructType | str, form: str = "json", per_trigger: int | None = None, only: str | None = None) -> DataFrame:
    """The files of a folder as a stream; ``only`` is a pattern of file names."""
    reader = spark.readStream.schema(schema)
    if only:
        reader = reader.option("pathGlobFilter", only)
    return (reader.option("maxFilesPerTrigger", per_trigger) if per_trigger else reader).format(form).load(folder)


def to_json_lines(rows: DataFrame, out: str, state: str, kind: str, jurisdiction: str, at: str, every: str | None = None) -> StreamingQuery:
    """Rows appended under kind, jurisdiction and month; with ``every`` as a running query, else all that is there and stop."""
    tagged = rows.withColumns({"object_kind": F.col(kind), "object_place": F.col(jurisdiction), "object_month": F.date_format(at, "yyyy-MM")})
    writer = tagged.writeStream.partitionBy("object_kind", "object_place", "object_month").format("json").option("path", out).option("checkpointLocation", state)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def windowed_counts(rows: DataFrame, at: str, by: list[str], width: str = "1 day", late: str = "2 days") -> DataFrame:
    """Counts by event-time window; rows later than the watermark are dropped by a stream, none by a batch."""
    return rows.withWatermark(at, late).groupBy(F.window(at, width).alias("w"), *by).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("window_start"), *by, "n")


def deduplicated(rows: DataFrame, key: list[str], at: str, late: str = "2 days") -> DataFrame:
    return rows.withWatermark(at, late).dropDuplicatesWithinWatermark(key)


def _versions(spark: SparkSession, table: str) -> list[int]:
    """The versions of a table that are written to their end, in order; any error of the storage is raised."""
    path = spark._jvm.org.apache.hadoop.fs.Path(table)
    storage = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not storage.exists(path):
        return []
    found = [f.getPath() for f in storage.listStatus(path) if f.getPath().getName().startswith("v=")]
    return sorted(int(p.getName()[2:]) for p in found if storage.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")))


def reconcile_batches(rows: DataFrame, table: str, state: str, key: list[str], fields: list[str], order: Column, after: Callable[[DataFrame, int], None] | None = None) -> StreamingQuery:
    """Each micro-batch reconciled into versions of a table (folders ``v=<batch>``); a batch run again writes the same version.

    A micro-batch is no full snapshot, so nothing is purged.
    """

    def run(batch: DataFrame, n: int) -> None:
        spark = batch.sparkSession
        last = batch.groupBy(*key).agg(F.max(F.struct(order.alias("_o"), F.struct(*fields).alias("_f"))).alias("m")).select(*key, "m._f.*")
        before = [v for v in _versions(spark, table) if v < n]
        current = spark.read.parquet(f"{table}/v={before[-1]}") if before else last.limit(0)
        changed = reconcile.changes(last, current, key, fields)
        reconcile.apply_changes(changed, key).write.mode("overwrite").parquet(f"{table}/v={n}")
        if after:
            after(changed, n)

    return rows.writeStream.foreachBatch(run).option("checkpointLocation", state).trigger(availableNow=True).start()


def reconciled(spark: SparkSession, path: str, schema: StructType, key: list[str], fields: list[str], order: str, work: str, per_trigger: int = 1, only: str | None = None) -> DataFrame:
    """The table that a stream over parquet files at path leads to, reconciled batch by batch in the shared folder ``work``."""
    rows = stream(spark, path, schema, "parquet", per_trigger, only)
    reconcile_batches(rows, f"{work}/table", f"{work}/state", key, fields, F.col(order)).awaitTermination()
    return spark.read.parquet(f"{work}/table/v={_versions(spark, f'{work}/table')[-1]}")
