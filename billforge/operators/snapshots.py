"""What changed between full snapshots: each key windowed by snapshot index.

A lag of the content hash shows changes, gaps in the index show removals and later additions. One shuffle with partial
aggregation picks the row that counts for a key and snapshot, one more puts a key's snapshots side by side (at most as many
rows as there are snapshots, however often a key was delivered). No snapshot is joined with another.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from billforge.session import broadcast_if_small


def snapshot_changes(rows: DataFrame, source: Column, key: list[Column], snapshot: Column, delivered: Column, content: Column) -> DataFrame:
    """(source, key_0.., snapshot, change_kind) with change_kind added, removed or changed.

    A source's snapshots are those for which it has any row, in order; its first one gives no changes. Of several rows
    for a key and snapshot the greatest ``delivered`` counts (null the least, ties to the greatest content hash). Rows
    without source or snapshot are left out, null keys count as empty text, an empty input gives an empty result.
    """
    names = [f"key_{i}" for i in range(len(key))]
    at = rows.select(source.alias("source"), snapshot.alias("snapshot")).where("source is not null and snapshot is not null")
    order = W.partitionBy("source").orderBy("snapshot")
    calendar = at.distinct().select("source", "snapshot", F.row_number().over(order).alias("n"), F.lead("snapshot").over(order).alias("next_snapshot"))
    flat = rows.select(source.alias("source"), snapshot.alias("snapshot"), delivered.alias("at"), *(F.coalesce(k, F.lit("")).alias(n) for k, n in zip(key, names)), F.xxhash64(F.coalesce(content, F.lit(""))).alias("h")).where("source is not null and snapshot is not null")
    current = flat.groupBy("source", *names, "snapshot").agg(F.max(F.struct("at", "h")).alias("m")).select("source", *names, "snapshot", "m.h")
    w = W.partitionBy("source", *names).orderBy("n")
    seen = current.join(broadcast_if_small(calendar), ["source", "snapshot"])
    seen = seen.select("*", F.lag("n").over(w).alias("n0"), F.lead("n").over(w).alias("n1"), F.lag("h").over(w).alias("h0"))
    kind = lambda when, at, name: F.when(when, F.struct(F.col(at).alias("snapshot"), F.lit(name).alias("change_kind")))
    found = F.array(
        kind((F.col("n") > 1) & F.coalesce(F.col("n0") != F.col("n") - 1, F.lit(True)), "snapshot", "added"),
        kind((F.col("n0") == F.col("n") - 1) & (F.col("h") != F.col("h0")), "snapshot", "changed"),
        kind(F.col("next_snapshot").isNotNull() & F.coalesce(F.col("n1") != F.col("n") + 1, F.lit(True)), "next_snapshot", "removed"),
    )
    return seen.select("source", *names, F.explode(F.array_compact(found)).alias("c")).select("source", *names, "c.*")
