"""References to records that do not exist, are deleted, or arrive later than the row that names them.

Keys are laid out on a line by their hash, which is cut into ranges of about equal size. Each range of parents is stored
as one array of 128-bit digests, sorted; batches of references of the same range probe it by binary search, vectorised. A range that
gets many references (a hot key may hold a third of them) is split into blocks, each of which gets its own copy of the
range's small array, so no task holds more than a bounded batch. Only misses leave the probe.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from billforge.session import broadcast_if_small

PARENTS_PER_RANGE = 50_000
REFERENCES_PER_BLOCK = 100_000
_NEVER = np.iinfo(np.int64).max


def _range(key: str, ranges: int) -> Column:
    """The range of a key: its place on the line 0..2^32, which its hash gives, cut into equal pieces."""
    return F.floor(F.shiftrightunsigned(F.xxhash64(key), 32) * ranges / F.lit(1 << 32)).cast("int")


def parent_arrays(parents: DataFrame, ranges: int) -> DataFrame:
    """(range, keys, since): per range the sorted digests and, beside them, the microsecond from which each parent exists.

    ``parents`` has key (text) and since (timestamp; null: deleted). Of several rows of a key the earliest counts.
    """
    one = parents.where("key is not null").groupBy("key").agg(F.min("since").alias("since"))
    digest = one.select(_range("key", ranges).alias("range"), F.unhex(F.md5("key")).alias("d"), F.coalesce(F.unix_micros("since"), F.lit(int(_NEVER))).alias("s"))
    packed = digest.groupBy("range").agg(F.array_sort(F.collect_list(F.struct("d", "s"))).alias("p"))
    return packed.select("range", F.col("p.d").alias("keys"), F.col("p.s").alias("since"))


def _digests(column: pa.Array) -> np.ndarray:
    """A column of digests as one array over Arrow's own memory."""
    fixed = column.cast(pa.binary(16))
    return np.frombuffer(fixed.buffers()[1], "S16")[fixed.offset : fixed.offset + len(fixed)]


def _probe(_: tuple, refs: pa.Table, parents: pa.Table) -> pa.Table:
    n = refs.num_rows
    what = np.full(n, "missing", dtype=object)
    if n and parents.num_rows:
        keys = _digests(parents["keys"].combine_chunks().flatten())
        since = parents["since"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
        probe = _digests(refs["digest"].combine_chunks())
        at = np.minimum(np.searchsorted(keys, probe), len(keys) - 1)
        hit, exists = keys[at] == probe, since[at]
        made = refs["at"].combine_chunks()
        known = ~np.asarray(made.is_null())
        made = made.fill_null(0).to_numpy(zero_copy_only=False)
        what[hit] = "ok"
        what[hit & known & (exists > made)] = "late"
        what[hit & (exists == _NEVER)] = "deleted"
    out = refs.select(["source", "field", "row_id", "at"]).append_column("reason", pa.array(what, pa.string()))
    return out.filter(pa.array(what != "ok"))


def orphan_references(references: DataFrame, parents: DataFrame, parents_per_range: int = PARENTS_PER_RANGE, references_per_block: int = REFERENCES_PER_BLOCK) -> DataFrame:
    """(source, field, row_id, created_at, reason) of each reference that finds no parent; reason missing, deleted or late.

    ``references`` has source, field, row_id, key (text as the parents' keys; null: no reference, left out) and at
    (timestamp of the referring row; null is never too early). Repeated references are each reported. Without parents all
    references are missing; without references the result is empty.
    """
    ranges = max(1, -(-parents.count() // parents_per_range))
    arrays = parent_arrays(parents, ranges)
    refs = references.where("key is not null").select("source", "field", "row_id", F.unix_micros("at").alias("at"), F.unhex(F.md5("key")).alias("digest"), _range("key", ranges).alias("range"))
    load = refs.groupBy("range").count().select("range", F.greatest(F.lit(1), F.ceil(F.col("count") / references_per_block)).cast("int").alias("blocks"))
    load = broadcast_if_small(load)  # a row per range
    refs = refs.join(load, "range").withColumn("block", F.pmod(F.xxhash64("row_id", "at", "digest"), F.col("blocks")).cast("int")).drop("blocks")
    copies = arrays.join(load, "range").select("range", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "keys", "since")
    found = refs.groupBy("range", "block").cogroup(copies.groupBy("range", "block")).applyInArrow(_probe, "source string, field string, row_id string, at long, reason string")
    return found.select("source", "field", "row_id", F.timestamp_micros("at").alias("created_at"), "reason")

