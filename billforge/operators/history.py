"""History of changing attributes from periodic full snapshots, as insert-only satellites with lead-based end dates.

Attributes are split by change rate into satellites. A satellite gets a row (with the attributes' text) for an entity only when
the hash of its attributes differs from the one before; a status satellite records when the entity appears and disappears.
Nothing is ever updated: end dates exist only in the views, as the lead of the next row's date. A further snapshot appends to the
satellites what it changes (append_snapshot), a late correction what it changes of the entities it touches (append_late).

Scale: one shuffle on (key, period) with partial aggregation, one on the key. After the first there are at most as many
rows per key as there are periods, so a key that holds a third of all rows is reduced before it meets a window. To append a
snapshot costs one shuffle of the satellites' last rows and of the snapshot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from billforge.session import broadcast_if_small

STATUS = "status"


def _current(rows: DataFrame, key: Column, period: Column, delivered: Column, satellites: dict[str, Column], values: bool) -> DataFrame:
    """(entity, period, {satellite}, {satellite}_text): of several rows the greatest ``delivered``."""
    hashes = [F.xxhash64(F.coalesce(text, F.lit(""))).alias(name) for name, text in satellites.items()]
    texts = [(F.coalesce(text, F.lit("")) if values else F.lit(None).cast("string")).alias(f"{name}_text") for name, text in satellites.items()]
    flat = rows.select(key.alias("entity"), period.alias("period"), delivered.alias("at"), F.struct(*hashes, *texts).alias("h")).where("entity is not null and period is not null")
    return flat.groupBy("entity", "period").agg(F.max(F.struct("at", "h")).alias("m")).select("entity", "period", "m.h.*")


def _made(name: str, when: Column, at: Column, present: bool = True) -> Column:
    """The row of a satellite, if there is one: of the status without attributes."""
    h, text = (F.lit(None).cast("long"), F.lit(None).cast("string")) if name == STATUS else (F.col(name), F.col(f"{name}_text"))
    return F.when(when, F.struct(F.lit(name).alias("satellite"), at.alias("load_period"), h.alias("hash_diff"), F.lit(present).alias("present"), text.alias("value")))


def satellite_rows(rows: DataFrame, key: Column, period: Column, delivered: Column, satellites: dict[str, Column], values: bool = True, periods: DataFrame | None = None) -> DataFrame:
    """Insert-only rows (entity, satellite, load_period, hash_diff, present, value).

    ``satellites`` maps a name to the canonical text of its attributes, which ``value`` keeps (null without ``values``, where
    only the versions' dates are asked for). Of several rows with one key and period the one with the greatest ``delivered``
    counts (null is the least; ties go to the greatest hash, so a repeated delivery gives one result). Rows whose key or period
    is null are left out; an empty input gives an empty result; further columns, whatever their names, are not looked at.
    ``periods`` (period) are those of the whole table where ``rows`` are only some entities of it.
    """
    current = _current(rows, key, period, delivered, satellites, values)
    periods = rows.select(period.alias("period")) if periods is None else periods.select("period")
    order = W.orderBy("period")  # a row per snapshot, not per record
    calendar = periods.where("period is not null").distinct().select("period", F.row_number().over(order).alias("n"), F.lead("period").over(order).alias("next_period"))
    w = W.partitionBy("entity").orderBy("n")
    seen = current.join(broadcast_if_small(calendar), "period")
    seen = seen.select("*", F.lag("n").over(w).alias("n0"), F.lead("n").over(w).alias("n1"), *(F.lag(s).over(w).alias(f"{s}_0") for s in satellites))
    new = F.coalesce(F.col("n0") != F.col("n") - 1, F.lit(True))
    gone = F.col("next_period").isNotNull() & F.coalesce(F.col("n1") != F.col("n") + 1, F.lit(True))
    out = [_made(STATUS, new, F.col("period")), _made(STATUS, gone, F.col("next_period"), False)]
    out += [_made(s, F.coalesce(F.col(s) != F.col(f"{s}_0"), F.lit(True)), F.col("period")) for s in satellites]
    return seen.select("entity", F.explode(F.array_compact(F.array(*out))).alias("r")).select("entity", "r.*")


def append_snapshot(log: DataFrame, rows: DataFrame, key: Column, period: Column, delivered: Column, satellites: dict[str, Column]) -> DataFrame:
    """The rows to append to ``log`` (satellite rows) for the full snapshot of one period later than all that are loaded.

    An entity gets a row in a satellite where its hash is not that of its last row there, a status row where it comes (back),
    and one of absence where it was present and the snapshot lacks it. An empty snapshot appends nothing, as it names no period.
    """
    last = log.groupBy("entity", "satellite").agg(F.max_by(F.struct("hash_diff", "present"), "load_period").alias("l"))
    known = last.groupBy("entity").agg(
        F.bool_or(F.when(F.col("satellite") == STATUS, F.col("l.present"))).alias("there"),
        *(F.max(F.when(F.col("satellite") == s, F.col("l.hash_diff"))).alias(f"{s}_0") for s in satellites))
    incoming = _current(rows, key, period, delivered, satellites, True)
    now = incoming.agg(F.max("period")).scalar()
    both = known.join(incoming, "entity", "full_outer").withColumn("now", now).where("now is not null")
    there = F.coalesce("there", F.lit(False))
    came = F.col("period").isNotNull()
    out = [_made(STATUS, came & ~there, F.col("now")), _made(STATUS, ~came & there, F.col("now"), False)]
    out += [_made(s, came & ~F.col(s).eqNullSafe(F.col(f"{s}_0")), F.col("now")) for s in satellites]
    return both.select("entity", F.explode(F.array_compact(F.array(*out))).alias("r")).select("entity", "r.*")


def append_late(log: DataFrame, rows: DataFrame, periods: DataFrame, key: Column, period: Column, delivered: Column, satellites: dict[str, Column]) -> DataFrame:
    """The rows to append to ``log`` for late deliveries of periods already loaded, with ``retracted``.

    ``rows`` are all deliveries, late ones included, of the entities that got a late one, ``periods`` (period) those of the whole
    table. What the rebuilt rows of these entities have and the log lacks is appended, what the log has too much is retracted.
    """
    keys = ["entity", "satellite", "load_period"]
    rebuilt = satellite_rows(rows, key, period, delivered, satellites, periods=periods)
    old = log.join(rows.select(key.alias("entity")).distinct(), "entity", "left_semi")
    fields = [c for c in rebuilt.columns if c not in keys]
    both = rebuilt.select(*keys, F.struct(*fields).alias("a")).join(old.select(*keys, F.struct(*fields).alias("b")), keys, "full_outer").where(~F.col("a").eqNullSafe(F.col("b")))
    side = F.coalesce("a", "b")
    return both.select(*keys, *(side[f].alias(f) for f in fields), F.col("a").isNull().alias("retracted"))


def effective(log: DataFrame) -> DataFrame:
    """The rows that hold of a log with ``loaded`` (the number of the load) and ``retracted``: of each entity, satellite and period the last."""
    keys = ["entity", "satellite", "load_period"]
    rest = [c for c in log.columns if c not in keys]
    last = log.groupBy(*keys).agg(F.max_by(F.struct(*rest), "loaded").alias("l")).select(*keys, "l.*")
    return last.where(~F.coalesce("retracted", F.lit(False))).drop("loaded", "retracted")


def satellite_view(made: DataFrame) -> DataFrame:
    """Each satellite's rows with their end, the load_period of the next one, or an empty string."""
    w = W.partitionBy("entity", "satellite").orderBy("load_period", F.col("present").desc())
    return made.select("*", F.coalesce(F.lead("load_period").over(w), F.lit("")).alias("end_period"))


def versions(made: DataFrame) -> DataFrame:
    """(entity, valid_from, valid_to): one row for each longest run of periods with the same satellites, absence ending it."""
    points = made.groupBy("entity", "load_period").agg(F.max("present").alias("present"))
    w = W.partitionBy("entity").orderBy("load_period")
    ended = points.select("*", F.coalesce(F.lead("load_period").over(w), F.lit("")).alias("valid_to"))
    return ended.where("present").select("entity", F.col("load_period").alias("valid_from"), "valid_to")
