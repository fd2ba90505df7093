"""Validation: every record gets the list of all its errors; good and bad records part ways in one pass, without UDFs."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, StructType

from billforge.functions import scalars

Rule = tuple[str, Column]
BILL_TYPES = ["bill", "resolution", "joint resolution", "concurrent resolution", "constitutional amendment", "memorial", "appointment"]
RESULTS = ["pass", "fail"]
OPTIONS = ["yes", "no", "absent", "abstain", "not voting", "paired", "excused", "other"]
STATUSES = ["cancelled", "tentative", "confirmed", "passed"]
CHAMBERS = ["upper", "lower", "legislature"]


def filled(name: str) -> Rule:
    return f"{name}: empty", F.coalesce(scalars.clean_whitespace(F.col(name).cast("string")), F.lit("")) == ""


def one_of(name: str, values: list[str]) -> Rule:
    return f"{name}: not allowed", F.col(name).isNotNull() & ~F.col(name).isin(*values)


def all_of(name: str, values: list[str]) -> Rule:
    return f"{name}: not allowed", F.exists(F.coalesce(F.col(name), F.array().cast("array<string>")), lambda x: ~x.isin(*values))


def like(name: str, pattern: str, blank: bool = True) -> Rule:
    bad = ~F.col(name).rlike(pattern)
    return f"{name}: form", F.coalesce(bad & (F.col(name) != "") if blank else bad, F.lit(not blank))


def single_line(name: str) -> Rule:
    return f"{name}: line break", F.coalesce(F.col(name).contains("\n"), F.lit(False))


def longest(name: str, most: int) -> Rule:
    return f"{name}: too long", F.coalesce(F.length(name) > most, F.lit(False))


def each(name: str, what: str, bad: Callable[[Column], Column]) -> Rule:
    """An error if any entry of an array is bad."""
    return f"{name}: {what}", F.coalesce(F.exists(F.col(name), bad), F.lit(False))


def errors(rules: Iterable[Rule]) -> Column:
    return F.array_compact(F.array(*(F.when(bad, F.lit(text)) for text, bad in rules)))


def check(rows: DataFrame, rules: Iterable[Rule]) -> DataFrame:
    """rows with errors, the texts of all rules a row breaks."""
    return rows.withColumn("errors", errors(list(rules)))


def split(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows, quarantine with the errors)."""
    return checked.where(F.size("errors") == 0).drop("errors"), checked.where(F.size("errors") > 0)


def unknown_keys(json: Column, schema: StructType) -> Column:
    """The keys of a JSON object that a schema does not have: they must be an error, not be dropped."""
    return F.array_except(F.coalesce(F.json_object_keys(json), F.array().cast("array<string>")), F.array(*(F.lit(f.name) for f in schema)))


def required(schema: StructType) -> list[Rule]:
    return [(f"{f.name}: missing", F.col(f.name).isNull()) for f in schema if not f.nullable and not isinstance(f.dataType, ArrayType)]


def person_rules(today: Column, majors: list[str]) -> list[Rule]:
    """Roles and parties of a person with party and roles: arrays of structs."""
    active = lambda c: F.filter(F.coalesce(F.col(c), F.array()), lambda x: (F.coalesce(x["end_date"], F.lit("")) == "") | (x["end_date"] > today))
    legislative = F.exists(active("roles"), lambda r: r["type"].isin(*CHAMBERS))
    return [
        ("roles: none active", F.size(active("roles")) == 0),
        ("roles: several active", F.size(active("roles")) > 1),
        ("roles: no district", F.exists(F.coalesce("roles", F.array()), lambda r: r["type"].isin("upper", "lower") & (F.coalesce(r["district"], F.lit("")) == ""))),
        ("party: none active", legislative & (F.size(active("party")) == 0)),
        ("party: several major", F.size(F.filter(active("party"), lambda p: p["name"].isin(*majors))) > 1),
        ("name: commas", F.size(F.split("name", ",")) > 2),
        ("name: suffix", (F.size(F.split("name", ",")) == 2) & ~F.col("name").rlike(r"(?i),.*\b(jr|sr|i{2,3}|iv|v|m\.?d|ph\.?d|esq)\b")),
        name_rule(),
    ]


def name_rule() -> Rule:
    return "name: no given or family name", (F.size(F.split(F.trim("name"), r"\s+")) == 2) & ((F.coalesce("given_name", F.lit("")) == "") | (F.coalesce("family_name", F.lit("")) == ""))


def role_rules(today: Column) -> list[Rule]:
    """Legislators have a district, executives but mayors an end; exactly one role is active."""
    roles = F.coalesce("roles", F.array())
    blank = lambda x: F.coalesce(x, F.lit("")) == ""
    active = F.size(F.filter(roles, lambda r: blank(r["end_date"]) | (r["end_date"] > today)))
    return [
        ("roles: none active", active == 0),
        ("roles: several active", active > 1),
        ("roles: no district", F.exists(roles, lambda r: r["type"].isin("upper", "lower") & blank(r["district"]))),
        ("roles: executive without end", F.exists(roles, lambda r: ~r["type"].isin("upper", "lower", "legislature", "mayor") & blank(r["end_date"]))),
    ]


def report(rows: DataFrame, key: str, rules: dict[str, list[Rule]]) -> DataFrame:
    """(key, severity, message): a row for each rule that a row breaks, of all severities in one pass."""
    found = [F.when(F.coalesce(broken, F.lit(False)), F.struct(F.lit(severity).alias("severity"), F.lit(message).alias("message"))) for severity, own in rules.items() for message, broken in own]
    return rows.select(key, F.explode(F.array_compact(F.array(*found))).alias("_e")).select(key, "_e.*")


def office_rules() -> list[Rule]:
    blank = lambda c: F.coalesce(F.trim(c), F.lit("")) == ""
    return [("office: no value", blank("address") & blank("voice") & blank("fax")), like("voice", scalars.PHONE), like("fax", scalars.PHONE), single_line("voice")]


def handle_rule(name: str) -> Rule:
    """A social handle is neither a link nor begins with an at sign."""
    return f"{name}: not a handle", F.coalesce(F.col(name).rlike(r"^@|://|/"), F.lit(False))


def committee_rules() -> list[Rule]:
    """A committee (name, classification, parent, n_members): a subcommittee and only it has a parent; somebody is in it."""
    has_parent = F.coalesce(F.col("parent"), F.lit("")) != ""
    return [
        filled("name"),
        one_of("classification", ["committee", "subcommittee"]),
        ("parent: missing", (F.col("classification") == "subcommittee") & ~has_parent),
        ("parent: of a committee", (F.col("classification") == "committee") & has_parent),
        ("members: none", F.coalesce(F.col("n_members"), F.lit(0)) < 1),
    ]


def repeated_values(rows: DataFrame, owner: list[str], fields: list[str]) -> DataFrame:
    """(owner.., field, value, n): values of a field that an owner has more than once; empty ones do not count."""
    each = rows.select(*owner, F.explode(F.array(*(F.struct(F.lit(f).alias("field"), F.col(f).alias("value")) for f in fields))).alias("_v")).select(*owner, "_v.*")
    return each.where(F.coalesce(F.trim("value"), F.lit("")) != "").groupBy(*owner, "field", "value").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def unknown(rows: DataFrame, known: DataFrame, column: str) -> DataFrame:
    """Rows whose value in column is not among the known ones; a null is not known either."""
    return rows.join(known.select(column).distinct(), column, "left_anti")
