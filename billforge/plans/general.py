"""The queries of problems 1 to 4 over the project's tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from billforge.functions.text import COLUMN, ENTRY, FIELD, bill_key, entries, entry, id_key, packed, part, same_set, strip, with_folded
from billforge.operators.history import STATUS, append_snapshot, satellite_rows, satellite_view, versions
from billforge.operators.references import orphan_references
from billforge.operators.snapshots import snapshot_changes
from billforge.operators.timestamps import moments
from billforge.session import read

PARTY = ("name", "start_date", "end_date")
ROLE = ("type", "jurisdiction", "district", "start_date", "end_date", "end_reason")


def _role_field(role: Column, name: str) -> Column:
    return F.regexp_replace(strip(role[name]), "^0+(?=[0-9A-Za-z])", "") if name == "district" else role[name]


def _persons(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, dict]:
    """The snapshots with their folded attributes, and how the history reads them."""
    rows = read(spark, sf_dir, "person_snapshot").select("id", "snapshot_date", "delivered_at", "party", "roles")
    party = entries(F.transform("party", lambda p: entry(*(p[n] for n in PARTY))))
    roles = entries(F.transform("roles", lambda r: entry(*(_role_field(r, n) for n in ROLE))))
    rows = with_folded(rows, packed(party, roles), "folded")
    satellites = {"party": same_set(part(F.col("folded"), 0)), "roles": same_set(part(F.col("folded"), 1))}
    return rows, {"key": F.col("id"), "period": F.col("snapshot_date"), "delivered": F.col("delivered_at"), "satellites": satellites}


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, how = _persons(spark, sf_dir)
    return versions(satellite_rows(rows, **how, values=False)).select(F.col("entity").alias("person_id"), "valid_from", "valid_to")


def _shown(made: DataFrame) -> DataFrame:
    readable = F.transform(F.split("value", ENTRY), lambda x: F.translate(x, FIELD, "|"))
    made = satellite_view(made).withColumn("attributes", F.when(F.col("satellite") != STATUS, F.array_sort(F.filter(readable, lambda x: x != ""))))
    return made.select(F.col("entity").alias("person_id"), "satellite", F.col("load_period").alias("valid_from"), F.col("end_period").alias("valid_to"), "present", "attributes")


def p1_satellites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every satellite row with its attributes and its lead-based end."""
    rows, how = _persons(spark, sf_dir)
    return _shown(satellite_rows(rows, **how))


def p1_appended(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, with the last snapshot appended to the satellites of those before it."""
    rows, how = _persons(spark, sf_dir)
    rows = rows.withColumn("last", rows.agg(F.max("snapshot_date")).scalar())
    before = satellite_rows(rows.where("snapshot_date < last"), **how)
    return _shown(before.unionByName(append_snapshot(before, rows.where("snapshot_date = last"), **how)))


def _references(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    bill, vote, related = (read(spark, sf_dir, t) for t in ("bill", "vote_event", "related_bill"))
    natural = lambda place, session, name: F.concat_ws(COLUMN, F.lit("n"), id_key(place), id_key(session), bill_key(name))
    by_id = lambda x: F.concat_ws(COLUMN, F.lit("i"), id_key(x))
    state = F.struct("updated_at", "deleted", "created_at", "jurisdiction_id", "legislative_session", "identifier")
    current = bill.groupBy(id_key(F.col("id")).alias("bid")).agg(F.max(state).alias("b")).select("bid", "b.*")
    since = F.when(~F.coalesce("deleted", F.lit(False)), F.coalesce("created_at", F.timestamp_seconds(F.lit(0)))).alias("since")
    keys = F.array(by_id(F.col("bid")), natural(F.col("jurisdiction_id"), F.col("legislative_session"), F.col("identifier")))
    parents = current.select(F.explode(keys).alias("key"), since)
    some = lambda x: F.coalesce(strip(x), F.lit("")) != ""
    told = F.get_json_object(F.substring(strip(F.col("bill_id")), F.lit(2), F.length("bill_id")), "$.identifier")
    pseudo = strip(F.col("bill_id")).startswith("~")
    of_vote = vote.where(some(F.col("bill_id"))).select(
        F.lit("vote_event").alias("source"), F.lit("bill_id").alias("field"), F.col("id").alias("row_id"),
        F.when(pseudo, natural(F.col("jurisdiction_id"), F.col("legislative_session"), told)).otherwise(by_id(F.col("bill_id"))).alias("key"), F.col("created_at").alias("at"))
    of_id = related.where(some(F.col("related_bill"))).select(F.lit("related_bill").alias("source"), F.lit("related_bill").alias("field"), F.col("id").alias("row_id"), by_id(F.col("related_bill")).alias("key"), F.col("created_at").alias("at"))
    owners = current.select(F.col("bid").alias("owner"), "jurisdiction_id")
    of_name = related.where(some(F.col("identifier"))).withColumn("owner", id_key(F.col("bill_id"))).join(owners, "owner", "left").select(
        F.lit("related_bill").alias("source"), F.lit("identifier").alias("field"), F.col("id").alias("row_id"),
        natural(F.col("jurisdiction_id"), F.col("legislative_session"), F.col("identifier")).alias("key"), F.col("created_at").alias("at"))
    return of_vote.unionByName(of_id).unionByName(of_name), parents


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = orphan_references(*_references(spark, sf_dir))
    return found.select(F.col("source").alias("table_name"), F.col("field").alias("field_name"), "row_id", F.date_format("created_at", "yyyy-MM").alias("period")).distinct()


def p2_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orphan references by table, field, month and reason."""
    found = orphan_references(*_references(spark, sf_dir))
    return found.groupBy(F.col("source").alias("table_name"), F.col("field").alias("field_name"), F.date_format("created_at", "yyyy-MM").alias("period"), "reason").agg(F.count(F.lit(1)).alias("n_references"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "bill_snapshot")
    folded = packed(F.col("title"), F.col("from_organization"), F.col("latest_action_description"), entries(F.col("classification")), entries(F.col("subject")))
    content = F.concat_ws(COLUMN, *(part(F.col("_folded"), i) for i in range(3)), *(same_set(part(F.col("_folded"), i)) for i in (3, 4)))
    rows = with_folded(rows, folded, "_folded")
    found = snapshot_changes(rows, F.col("jurisdiction_id"), [id_key(F.col("legislative_session")), bill_key(F.col("identifier"))], F.col("snapshot_date"), F.col("scraped_at"), content)
    return found.select(F.col("source").alias("jurisdiction_id"), F.col("key_0").alias("legislative_session"), F.col("key_1").alias("identifier"), F.col("snapshot").alias("snapshot_date"), "change_kind")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = moments(read(spark, sf_dir, "scrape_event"), read(spark, sf_dir, "jurisdiction_zone").select("jurisdiction_id", "time_zone"), "event_id", "jurisdiction_id", "start_date", "end_date", "scraped_at")
    return found.select("event_id", "field_name", F.date_format(F.timestamp_seconds("utc"), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("utc_value"))


QUERIES = {"p1_found": p1_found, "p1_satellites": p1_satellites, "p1_appended": p1_appended, "p2_found": p2_found, "p2_report": p2_report, "p3_found": p3_found, "p4_found": p4_found}
