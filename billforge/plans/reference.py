"""The engine's own operators as queries over the test tables, each beside the same result in SQL."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from billforge.functions import scalars as S
from billforge.functions.text import bill_key, id_key
from billforge.operators import derive, fulltext, hierarchy, people, quality, reconcile, resolve, validate
from billforge.session import read
from billforge.streaming import realtime

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
#: The namespace of ids derived from names, the day on which "current" is judged.
NAMESPACE, TODAY = "6ba7b8109dad11d180b400c04fd430c8", "2023-06-15"


def query(sql: str | None = None):
    def add(f: Callable[[Callable[[str], DataFrame]], DataFrame]):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(lambda t: read(spark, sf_dir, t))
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


c = F.col
#: Current bills, as of the greatest updated_at.
CURRENT = "(select * from (select *, row_number() over (partition by id order by updated_at desc, deleted desc, title desc) k from bill) where k = 1)"


def current_bills(t: Callable[[str], DataFrame]) -> DataFrame:
    return derive.latest(t("bill"), ["id"], [F.desc("updated_at"), F.desc("deleted"), F.desc("title")])


#: Persons as last delivered, each once.
PERSONS = "(select * from (select *, row_number() over (partition by id order by snapshot_date desc, delivered_at desc) k from person_snapshot) where k = 1)"


def latest_persons(t: Callable[[str], DataFrame]) -> DataFrame:
    return derive.latest(t("person_snapshot"), ["id"], [F.desc("snapshot_date"), F.desc("delivered_at")])


# Scalar functions


@query("""select id, identifier, regexp_replace(case when regexp_matches(upper(identifier), '^(SJR|HJR)[\\s\\x{a0}]*([A-Z]+)[\\s\\x{a0}]*$') then regexp_replace(upper(identifier), '^(SJR|HJR)[\\s\\x{a0}]*([A-Z]+)[\\s\\x{a0}]*$', '\\1 \\2')
 else regexp_replace(upper(identifier), '(?s)^(.*?)([A-Z]*)[\\s\\x{a0}]*0*([-0-9]+)(.*)$', '\\1\\2 \\3\\4') end, '^[\\s\\x{a0}]+|[\\s\\x{a0}]+$', '', 'g') as fixed from related_bill""")
def fix_bill_id(t):
    return t("related_bill").select("id", "identifier", S.fix_bill_id(c("identifier")).alias("fixed"))


@query("select snapshot_date, source_url, regexp_replace(title, '[\\s\\x{a0}]+', ' ', 'g') as title, left(title, 300) as cut from bill_snapshot")
def collapse_whitespace(t):
    return t("bill_snapshot").select("snapshot_date", "source_url", S.collapse_whitespace(c("title")).alias("title"), S.truncate(c("title")).alias("cut"))


_PHONES = "select office_id, case office_id % 6 when 0 then voice when 1 then '+1 (' || left(voice, 3) || ') ' || substr(voice, 5) when 2 then 'Phone: ' || replace(voice, '-', '.') || ' EXT.12' when 3 then left(voice, 3) || chr(9) || substr(voice, 5) || ' eXt 7' when 4 then '(' || left(voice, 3) || ') ' || substr(voice, 5) else voice || ' or call' end as voice from scrape_office where voice <> ''"


def _phones(t) -> DataFrame:
    v, k, rest = c("voice"), c("office_id") % 6, F.substring(c("voice"), F.lit(5), F.length("voice"))
    bracketed = F.concat(F.lit("("), F.substring(v, 1, 3), F.lit(") "), rest)
    made = F.when(k == 0, v).when(k == 1, F.concat(F.lit("+1 "), bracketed)).when(k == 2, F.concat(F.lit("Phone: "), F.replace(v, F.lit("-"), F.lit(".")), F.lit(" EXT.12"))).when(k == 3, F.concat(F.substring(v, 1, 3), F.lit("\t"), rest, F.lit(" eXt 7"))).when(k == 4, bracketed).otherwise(F.concat(v, F.lit(" or call")))
    return t("scrape_office").where(v != "").select("office_id", made.alias("voice"))


@query(f"""with p as ({_PHONES}), d as (select *, regexp_replace(voice, '[^0-9]', '', 'g') as d, regexp_extract(voice, '(?:ext|Ext|EXT)[.]?\\s*([0-9]{{1,4}})$', 1) as ext from p),
 n as (select *, left(d, 1) = '1' and len(d) >= 11 as one from d)
 select office_id, voice, case when len(d) < 10 then voice else case when one then '1-' else '' end || substr(d, 1 + one::int, 3) || '-' || substr(d, 4 + one::int, 3) || '-' || substr(d, 7 + one::int, 4) || case when ext <> '' then ' ext. ' || ext else '' end end as formatted from n""")
def phone_format(t):
    return _phones(t).select("office_id", "voice", S.phone(c("voice")).alias("formatted"))


@query(f"""with p as ({_PHONES} union all select office_id, case office_id % 3 when 0 then 'N/A' when 1 then 'Same as above' else replace(voice, '-', chr(8211)) end from scrape_office where voice <> '')
 select office_id, voice, case when lower(voice) in ('n/a', 'same as above') then '' when regexp_matches(voice, '\\([0-9]{{3}}\\)\\s*[0-9]{{3}}-[0-9]{{4}}') then regexp_extract(voice, '\\(([0-9]{{3}})\\)\\s*[0-9]{{3}}-[0-9]{{4}}', 1) || '-' || regexp_extract(voice, '\\([0-9]{{3}}\\)\\s*([0-9]{{3}}-[0-9]{{4}})', 1) else replace(voice, chr(8211), '-') end as plain from p""")
def office_phone_format(t):
    k = c("office_id") % 3
    more = t("scrape_office").where("voice <> ''").select("office_id", F.when(k == 0, "N/A").when(k == 1, "Same as above").otherwise(F.replace(c("voice"), F.lit("-"), F.lit("\u2013"))).alias("voice"))
    return _phones(t).unionByName(more).select("office_id", "voice", S.office_phone(c("voice")).alias("plain"))


@query("select office_id, address, regexp_replace(regexp_replace(address, '\\s*\\n\\s*', ';', 'g'), '\\s+', ' ', 'g') as formatted from scrape_office")
def address_format(t):
    return t("scrape_office").select("office_id", "address", S.address(c("address")).alias("formatted"))


@query("select id, 'ocd-bill-' || regexp_extract(jurisdiction_id, '([a-z]{2})/government$', 1) || '-' || replace(replace(legislative_session, '-', '_'), ' ', '') || '-' || replace(replace(identifier, '-', '_'), ' ', '') as namespaced from bill")
def bill_namespace_id(t):
    return t("bill").select("id", S.namespaced_bill_id(c("jurisdiction_id"), c("legislative_session"), c("identifier")).alias("namespaced"))


@query(f"""with h as (select id, sha1(unhex('{NAMESPACE}') || encode(id)) as h from bill)
 select id, left(h, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' || translate(substr(h, 17, 1), '0123456789abcdef', '89ab89ab89ab89ab') || substr(h, 18, 3) || '-' || substr(h, 21, 12) as made from h""")
def uuid5_id(t):
    return t("bill").select("id", S.uuid5(NAMESPACE, c("id")).alias("made"))


@query("select distinct id, regexp_replace(regexp_replace(replace(name, ' ', chr(9) || ' '), '\\s+', '-', 'g'), '[^a-zA-Z-]', '', 'g') || '-' || string_split(id, '/')[2] || '.yml' as file_name from person_snapshot")
def safe_filename(t):
    return t("person_snapshot").select("id", S.safe_filename(F.replace("name", F.lit(" "), F.lit("\t ")), c("id")).alias("file_name")).distinct()


@query("""select id, case when bill_id like '~%' then json_extract_string(substr(bill_id, 2), '$.identifier') end as identifier, case when bill_id like '~%' then json_extract_string(substr(bill_id, 2), '$.from_organization__classification') end as chamber,
 case when coalesce(organization, '') <> '' then organization else '~{"classification": "legislature"}' end as organization from vote_event""")
def pseudo_ids(t):
    return t("vote_event").select("id", S.pseudo_field(c("bill_id"), "identifier").alias("identifier"), S.pseudo_field(c("bill_id"), "from_organization__classification").alias("chamber"), S.pseudo_organization(c("organization"), F.lit(None), F.lit("legislature")).alias("organization"))


@query("select id, id like 'ocd-%' as is_ocd, regexp_matches(regexp_replace(regexp_replace(lower(list_last(string_split(id, '/'))), '^urn:uuid:', ''), '[{}-]', '', 'g'), '^[0-9a-f]{32}$') as is_uuid, regexp_matches(lower(id), '^ocd-bill/[0-9a-f]{8}-([0-9a-f]{4}-){3}[0-9a-f]{12}$') as is_bill_id from bill")
def id_forms(t):
    return t("bill").select("id", c("id").startswith("ocd-").alias("is_ocd"), S.is_uuid(F.element_at(F.split("id", "/"), -1)).alias("is_uuid"), F.lower("id").rlike(S.OCD_ID.format(kind="bill")).alias("is_bill_id"))


@query("select event_id, start_date, coalesce(regexp_matches(start_date, '^[0-9]{4}(-[0-9]{2}){0,2}$'), false) as fuzzy_date, coalesce(regexp_matches(start_date, '^[0-9]{4}(-[0-9]{2}){0,2}(T[0-9]{2}(:[0-9]{2}){0,2}(Z|[+-][0-9]{2}(:?[0-9]{2})?))?$'), false) as fuzzy_datetime from scrape_event")
def fuzzy_date_check(t):
    return t("scrape_event").select("event_id", "start_date", *(F.coalesce(c("start_date").rlike(x), F.lit(False)).alias(n) for n, x in (("fuzzy_date", S.FUZZY_DATE), ("fuzzy_datetime", S.FUZZY_DATETIME))))


@query("select office_id, coalesce(nullif(name, ''), upper(left(classification, 1)) || substr(classification, 2) || ' Office') as display_name from scrape_office")
def office_display_name(t):
    return t("scrape_office").select("office_id", S.office_name(c("name"), c("classification")).alias("display_name"))


@query("with p as (select c_custkey, case c_custkey % 5 when 0 then 'D' when 1 then ' rep ' when 2 then 'ind' when 3 then 'dem' else c_mktsegment end as party from customer) select c_custkey, party, case lower(party) when 'd' then 'Democratic' when 'r' then 'Republican' when 'dem' then 'Democratic' when 'rep' then 'Republican' when 'ind' then 'Independent' when 'democrat' then 'Democratic' else party end as party_name from p")
def party_abbreviation(t):
    k = c("c_custkey") % 5
    rows = t("customer").select("c_custkey", F.when(k == 0, "D").when(k == 1, " rep ").when(k == 2, "ind").when(k == 3, "dem").otherwise(c("c_mktsegment")).alias("party"))
    return rows.select("c_custkey", "party", S.party_name(c("party")).alias("party_name"))


@query("select doc_id, array_to_string(list_transform(list_filter(string_split_regex(text, '\\r\\n|[\\n\\r]'), lambda x: regexp_matches(x, '^.*?\\s+[0-9]+')), lambda x: regexp_extract(x, '^(.*?)\\s+[0-9]+', 1)), chr(10)) as plain from documents")
def line_text_before_numbers(t):
    return t("documents").select("doc_id", S.numbered_lines(c("text"), after=False).alias("plain"))


@query("with p as (select doc_id, '  ' || (doc_id % 90) || '  ' || replace(text, chr(10), chr(10) || ' ' || (doc_id % 7 + 1) || '  ') as text from documents) select doc_id, array_to_string(list_transform(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '^\\s*[0-9]+\\s+(.*)$')), lambda x: regexp_extract(x, '^\\s*[0-9]+\\s+(.*)$', 1)), chr(10)) as plain from p")
def numbered_line_text(t):
    made = F.concat(F.lit("  "), (c("doc_id") % 90).cast("string"), F.lit("  "), F.regexp_replace("text", "\n", F.concat(F.lit("\n "), (c("doc_id") % 7 + 1).cast("string"), F.lit("  "))))
    return t("documents").select("doc_id", S.numbered_lines(made).alias("plain"))


@query("select sb_id, length(raw_text) as n_chars, list_count(list_filter(string_split(raw_text, chr(10)), lambda x: regexp_matches(x, '^\\s*[0-9]+\\s+\\S'))) * 1.0 / len(string_split(raw_text, chr(10))) > 0.1 as is_numbered from searchable_bill where raw_text is not null")
def numbering_ratio(t):
    lines = F.split("raw_text", "\n")
    share = F.size(F.filter(lines, lambda x: x.rlike(r"^\s*[0-9]+\s+\S"))) / F.size(lines)
    return t("searchable_bill").where("raw_text is not null").select("sb_id", F.length("raw_text").alias("n_chars"), (share > 0.1).alias("is_numbered"))


@query("select doc_id, replace(replace(replace(text, chr(13) || chr(10), chr(10)), chr(160), ' '), chr(9), ' ') as cleaned from documents")
def clean_text(t):
    return t("documents").select("doc_id", S.clean_text(c("text")).alias("cleaned"))


@query("select n_name, case when n_nationkey % 2 = 0 then n_name else upper(left(n_name, 2)) || '-' || case when n_nationkey = 1 then 'AL' else cast(n_nationkey as varchar) end end as label from nation")
def district_label(t):
    k = c("n_nationkey")
    return t("nation").select("n_name", S.district_label(F.when(k % 2 == 0, "upper").otherwise("lower"), F.substring("n_name", 1, 2), c("n_name"), F.when(k == 1, "at-large").otherwise(k.cast("string"))).alias("label"))


@query("select event_id, strftime(scraped_at at time zone 'UTC', '%Y-%m-%dT%H:%M:%SZ') as scraped, case when coalesce(location_name, '') = '' then ['unknown'] else [location_name] end as places from scrape_event")
def utc_and_lists(t):
    return t("scrape_event").select("event_id", S.utc_text(c("scraped_at")).alias("scraped"), S.as_list(c("location_name"), "unknown").alias("places"))


# Filters and time


@query(f"""with r as (select distinct * from (select id, unnest(roles, recursive := true) from person_snapshot))
 select id, type, district, coalesce(start_date, '') as start_date, coalesce(end_date, '') as end_date,
 (coalesce(end_date, '') = '' or end_date > '2020-01-01') and (coalesce(start_date, '') = '' or start_date < '2023-01-01') as overlaps,
 (coalesce(start_date, '') = '' or start_date <= '{TODAY}') and (coalesce(end_date, '') = '' or end_date >= '{TODAY}') as is_current, coalesce(end_date, '') = '' or end_date > '{TODAY}' as is_active from r""")
def temporal_filters(t):
    r = t("person_snapshot").select("id", F.explode("roles").alias("r")).select("id", "r.*").distinct()
    s, e = c("start_date"), c("end_date")
    return r.select("id", "type", "district", F.coalesce(s, F.lit("")).alias("start_date"), F.coalesce(e, F.lit("")).alias("end_date"), S.overlaps(s, e, F.lit("2020-01-01"), F.lit("2023-01-01")).alias("overlaps"), S.is_current(s, e, F.lit(TODAY)).alias("is_current"), S.is_current(s, e, F.lit(TODAY), inclusive=False).alias("is_active"))


@query("select event_id, strftime(cast(scraped_at at time zone 'UTC' as date) - 30, '%Y-%m-%d') as window_start, strftime(cast(scraped_at at time zone 'UTC' as date) + 90, '%Y-%m-%d') as window_end from scrape_event")
def event_window(t):
    day = F.to_date("scraped_at")
    return t("scrape_event").select("event_id", F.date_sub(day, 30).cast("string").alias("window_start"), F.date_add(day, 90).cast("string").alias("window_end"))


@query("select distinct id, name from person_snapshot where contains(upper(name), upper('or')) or contains(upper(family_name), upper('holt'))")
def person_search(t):
    hit = F.contains(F.upper("name"), F.upper(F.lit("or"))) | F.contains(F.upper("family_name"), F.upper(F.lit("holt")))
    return t("person_snapshot").where(hit).select("id", "name").distinct()


@query("select source, count(*) as n from documents where source not in (select source from documents group by source having count(*) > 150) group by source")
def over_cap(t):
    return quality.within_cap(t("documents"), ["source"], 150).groupBy("source").agg(F.count(F.lit(1)).alias("n"))


@query("select l_orderkey, l_linenumber, l_extendedprice from lineitem where l_returnflag in ('A', 'R') and not exists (select 1 from orders where o_orderkey = l_orderkey and o_orderstatus = 'F')")
def set_complement(t):
    done = t("orders").where("o_orderstatus = 'F'").select(c("o_orderkey").alias("l_orderkey"))
    return t("lineitem").where(c("l_returnflag").isin("A", "R")).join(done, "l_orderkey", "left_anti").select("l_orderkey", "l_linenumber", "l_extendedprice")


# Derived fields and reports

_ACTIONS = """(select l_orderkey as bill, cast(cast(l_shipdate as date) as varchar) as date, l_linenumber * 100000 + l_suppkey as ord, l_returnflag || '-' || l_linestatus || '-' || l_partkey as text, l_returnflag = 'R' as passage from lineitem)"""


def _actions(t) -> DataFrame:
    kinds = F.when(c("l_returnflag") == "R", F.array(F.lit("passage"))).otherwise(F.array(F.lit("introduction")))
    return t("lineitem").select(c("l_orderkey").alias("bill"), c("l_shipdate").cast("date").cast("string").alias("date"), (c("l_linenumber") * 100000 + c("l_suppkey")).alias("ord"), F.concat_ws("-", "l_returnflag", "l_linestatus", "l_partkey").alias("text"), kinds.alias("kinds"))


@query(f"select bill, min(date) as first_action_date, max(date) as latest_action_date, arg_max(text, (date, ord, text)) as latest_action_description, max(case when passage then date end) as latest_passage_date from {_ACTIONS} group by bill")
def bill_computed_fields(t):
    return derive.bill_fields(_actions(t), "bill", "date", "ord", "text", "kinds")


@query(f"select bill, min(date) as first, max(date) as latest, arg_max(text, (date, ord, text)) as description, max(case when passage then date end) as passage from {_ACTIONS} group by bill")
def bill_computed_fields_fold(t):
    grouped = _actions(t).groupBy("bill").agg(F.collect_list(F.struct(c("ord").alias("o"), c("date").alias("d"), c("text").alias("t"), c("kinds").alias("c"))).alias("a"))
    return grouped.select("bill", derive.bill_fields_exact(c("a")).alias("r")).select("bill", "r.*")


@query("select year(o_orderdate) as session, count(*) as bills_missing_actions from orders where not exists (select 1 from lineitem where l_orderkey = o_orderkey) group by 1")
def session_missing_actions(t):
    return quality.childless(t("orders").select(c("o_orderkey").alias("l_orderkey"), F.year("o_orderdate").alias("session")), t("lineitem"), "l_orderkey", ["session"], "bills_missing_actions")


@query("select jurisdiction_id, legislative_session, count(*) as votes, count(*) filter (coalesce(trim(bill_id), '') = '') as votes_missing_bill, count(*) filter (coalesce(len(counts), 0) = 0) as votes_missing_counts from vote_event group by all")
def session_vote_report(t):
    blank = F.coalesce(F.trim("bill_id"), F.lit("")) == ""
    return t("vote_event").groupBy("jurisdiction_id", "legislative_session").agg(F.count(F.lit(1)).alias("votes"), F.count_if(blank).alias("votes_missing_bill"), F.count_if(F.coalesce(F.size("counts"), F.lit(0)) <= 0).alias("votes_missing_counts"))


_DECLARED = "[{'option': 'yes', 'value': cast(o_orderkey % 3 as int)}, {'option': 'no', 'value': cast(o_orderkey % 2 as int)}]"


@query(f"""with b as (select l_orderkey as vote, count(*) filter (l_returnflag = 'A') as y, count(*) filter (l_returnflag = 'N') as n, count(*) filter (l_returnflag = 'R') as o from lineitem group by 1),
 v as (select o_orderkey as vote, coalesce(y, 0) as y, coalesce(n, 0) as n, coalesce(o, 0) as o, cast(o_orderkey % 3 as int) as dy, cast(o_orderkey % 2 as int) as dn from orders left join b on vote = o_orderkey)
 select vote, y as actual_yes, n as actual_no, o as actual_other, dy as declared_yes, dn as declared_no, cast(null as int) as declared_other, y <> dy or n <> dn or o <> 0 as bad_counts from v""")
def vote_bad_counts(t):
    votes = t("orders").select(c("o_orderkey").alias("vote"), F.array(F.struct(F.lit("yes").alias("option"), (c("o_orderkey") % 3).cast("int").alias("value")), F.struct(F.lit("no").alias("option"), (c("o_orderkey") % 2).cast("int").alias("value"))).alias("counts"))
    ballots = t("lineitem").select(c("l_orderkey").alias("vote"), F.when(c("l_returnflag") == "A", "yes").when(c("l_returnflag") == "N", "no").otherwise("other").alias("option"))
    return quality.vote_counts(votes, ballots, "vote", "option", "counts")


@query("""select id, coalesce(list_last(list_filter(counts, lambda x: x.option = 'yes')).value, 0) || '-' || coalesce(list_last(list_filter(counts, lambda x: x.option = 'no')).value, 0) || '-' || cast(coalesce(list_sum(list_transform(list_filter(counts, lambda x: x.option not in ('yes', 'no')), lambda x: x.value)), 0) as bigint) as tally from vote_event where counts is not null""")
def vote_tally(t):
    return t("vote_event").where("counts is not null").select("id", derive.vote_tally(c("counts")).alias("tally"))


@query("select year(o_orderdate) as session, c_name as name, count(*) as n from orders join customer on c_custkey = o_custkey where o_orderstatus = 'F' group by all")
def unmatched_names(t):
    rows = t("orders").join(t("customer"), c("o_custkey") == c("c_custkey")).select(F.year("o_orderdate").alias("session"), c("c_name").alias("name"), "o_orderstatus")
    return quality.unmatched(rows, "name", c("o_orderstatus") == "F", ["session"])


@query("select voice, count(distinct person_name) as n_owners, list_sort(list(distinct person_name))[1:3] as owners from scrape_office where voice <> '' and person_name is not null group by voice having count(distinct person_name) > 1")
def duplicate_values(t):
    return quality.duplicate_values(t("scrape_office").where("person_name is not null"), ["voice"], "person_name")


@query("""with e as (select n_nationkey as district, n_nationkey % 4 * 3 as seats from nation where n_nationkey < 22), a as (select s_nationkey as district, count(*) as members from supplier group by 1)
 select coalesce(e.district, a.district) as district, coalesce(seats, 0) as seats, coalesce(members, 0) as members, case when seats is null then 'unexpected' when coalesce(members, 0) < seats then 'missing' else 'extra' end as problem
 from e full join a on e.district = a.district where seats is null or coalesce(members, 0) <> seats""")
def seat_accounting(t):
    expected = t("nation").where("n_nationkey < 22").select(c("n_nationkey").alias("district"), (c("n_nationkey") % 4 * 3).alias("seats"))
    return quality.seats(expected, t("supplier").select(c("s_nationkey").alias("district")), ["district"])


@query("""select snapshot_date, jurisdiction_id, count(*) as n, count(*) filter (coalesce(email, '') <> '') as n_email, count(*) filter (coalesce(birth_date, '') <> '') as n_birth_date, round(100.0 * count(*) filter (coalesce(email, '') <> '') / count(*), 2) as pct_email, round(100.0 * count(*) filter (coalesce(birth_date, '') <> '') / count(*), 2) as pct_birth_date
 from person_snapshot group by 1, 2""")
def person_summary(t):
    return quality.coverage(t("person_snapshot"), ["snapshot_date", "jurisdiction_id"], ["email", "birth_date"])


@query(f"""with x as (select bill_id, bool_or(is_error) as is_error from searchable_bill group by 1), b as (select distinct id, jurisdiction_id from bill)
 select jurisdiction_id, count(*) as n, cast(ceil(100.0 * count(*) filter (is_error is null) / count(*)) as int) as pct_missing, cast(ceil(100.0 * count(*) filter (is_error) / count(*)) as int) as pct_error from b left join x on bill_id = id group by 1""")
def text_status(t):
    bills = t("bill").select(c("id").alias("bill_id"), "jurisdiction_id").distinct()
    return quality.text_status(bills, t("searchable_bill").select("bill_id", "is_error"), "bill_id", ["jurisdiction_id"])


@query("select b.jurisdiction_id, count(distinct id) as n_missing from bill b where not exists (select 1 from searchable_bill s where s.bill_id = b.id) group by 1")
def missing_text(t):
    return t("bill").join(t("searchable_bill").select(c("bill_id").alias("id")), "id", "left_anti").groupBy("jurisdiction_id").agg(F.count_distinct("id").alias("n_missing"))


@query("select o_custkey, o_orderpriority, min(cast(cast(o_orderdate as date) as varchar)) as start_date, max(cast(cast(o_orderdate as date) as varchar)) as end_date from orders group by all")
def party_ranges(t):
    return derive.ranges(t("orders").withColumn("d", c("o_orderdate").cast("date").cast("string")), ["o_custkey", "o_orderpriority"], "d", "d")


@query("select l_orderkey, l_linenumber, l_suppkey, l_partkey from (select *, row_number() over (partition by l_orderkey order by l_shipdate desc, l_linenumber desc, l_suppkey, l_partkey) k from lineitem) where k = 1")
def latest_version(t):
    return derive.latest(t("lineitem"), ["l_orderkey"], [F.desc("l_shipdate"), F.desc("l_linenumber"), c("l_suppkey"), c("l_partkey")]).select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey")


@query("""with f as (select bill_id, min(sb_id) filter (coalesce(raw_text, '') <> '') as s, max(sb_id) as l from searchable_bill group by 1)
 select bill_id, (select any_value(raw_text) from searchable_bill x where x.sb_id = f.s) as raw_text, s is null as is_error, coalesce(s, l) as link from f""")
def first_extraction(t):
    return derive.first_text(t("searchable_bill"), ["bill_id"], "sb_id", "raw_text")


@query(f"""with p as (select id, roles, party from (select *, row_number() over (partition by id order by snapshot_date desc, delivered_at desc) k from person_snapshot) where k = 1)
 select id, list_last(list_filter(roles, lambda r: coalesce(r.end_date, '') = '' or r.end_date > '{TODAY}')).district as district, list_last(list_filter(party, lambda r: coalesce(r.end_date, '') = '' or r.end_date > '{TODAY}')).name as party from p""")
def current_role(t):
    rows = derive.latest(t("person_snapshot"), ["id"], [F.desc("snapshot_date"), F.desc("delivered_at")])
    return rows.select("id", derive.current_role(c("roles"), F.lit(TODAY))["district"].alias("district"), derive.primary_party(c("party"), F.lit(TODAY)).alias("party"))


@query("""select jurisdiction_id, count(*) as n_bills, count(*) filter (deleted) as n_deleted, count(*) filter (list_contains(classification, 'bill')) as n_of_kind_bill, count(distinct legislative_session) as n_sessions, max(latest_action_date) as latest from """ + CURRENT + """ group by 1""")
def jurisdiction_report(t):
    return current_bills(t).groupBy("jurisdiction_id").agg(F.count(F.lit(1)).alias("n_bills"), F.count_if("deleted").alias("n_deleted"), F.count_if(F.array_contains("classification", "bill")).alias("n_of_kind_bill"), F.count_distinct("legislative_session").alias("n_sessions"), F.max("latest_action_date").alias("latest"))


# Reconciliation


@query("select text, count(*) as copies, min(doc_id) as kept from documents group by text having count(*) > 1")
def exact_dedupe(t):
    tagged = reconcile.dedupe(t("documents").select("doc_id", "text"), ["text"], ["doc_id"])
    copies = tagged.where("duplicate_of is not null").groupBy("text", c("duplicate_of.doc_id").alias("kept")).agg((F.count(F.lit(1)) + 1).alias("copies"))
    return copies.select("text", "copies", "kept")


_OLD = "(select * from (select *, row_number() over (partition by o_orderkey order by o_orderdate) k from orders) where k = 1 and o_orderkey % 5 <> 0)"
_NEW = "(select o_orderkey, o_custkey, case when o_orderkey % 7 = 0 then 'X' else o_orderstatus end as o_orderstatus, o_orderpriority from orders where o_orderkey % 11 <> 0)"
_CHANGE = f"""select coalesce(n.o_orderkey, o.o_orderkey) as o_orderkey, case when o.o_orderkey is null then 'insert' when n.o_orderkey is null then 'missing' when n.o_custkey is not distinct from o.o_custkey and n.o_orderstatus is not distinct from o.o_orderstatus and n.o_orderpriority is not distinct from o.o_orderpriority then 'noop' else 'update' end as action,
 coalesce(n.o_custkey, o.o_custkey) as o_custkey, coalesce(n.o_orderstatus, o.o_orderstatus) as o_orderstatus from {_NEW} n full join {_OLD} o on n.o_orderkey = o.o_orderkey"""
_FIELDS = ["o_custkey", "o_orderstatus", "o_orderpriority"]


def _staged(t) -> tuple[DataFrame, DataFrame]:
    k = c("o_orderkey")
    status = F.when(k % 7 == 0, "X").otherwise(c("o_orderstatus")).alias("o_orderstatus")
    return t("orders").where(k % 11 != 0).select("o_orderkey", "o_custkey", status, "o_orderpriority"), t("orders").where(k % 5 != 0).select("o_orderkey", *_FIELDS)


@query(f"select o_orderkey, action from ({_CHANGE})")
def change_classification(t):
    return reconcile.changes(*_staged(t), ["o_orderkey"], _FIELDS).select("o_orderkey", "action")


@query(f"select action, count(*) as n from ({_CHANGE}) group by 1")
def import_counters(t):
    return reconcile.counters(reconcile.changes(*_staged(t), ["o_orderkey"], _FIELDS))


@query(f"select o_orderkey, o_custkey, o_orderstatus from ({_CHANGE}) where action <> 'missing'")
def apply_snapshot(t):
    return reconcile.apply_changes(reconcile.changes(*_staged(t), ["o_orderkey"], _FIELDS), ["o_orderkey"], purge=True).select("o_orderkey", "o_custkey", "o_orderstatus")


@query("""with a as (select l_orderkey, list_sort(list(l_partkey)) as x, list(l_partkey order by l_linenumber, l_suppkey, l_partkey) as xo from lineitem group by 1),
 b as (select l_orderkey, list_sort(list(case when l_orderkey % 3 = 0 then l_partkey + 1 else l_partkey end)) as y, list(case when l_orderkey % 3 = 0 then l_partkey + 1 else l_partkey end order by l_linenumber desc, l_suppkey, l_partkey) as yo from lineitem where l_orderkey % 4 <> 0 group by 1)
 select l_orderkey, x is not distinct from y as same_set, xo is not distinct from yo as same_list from a left join b using (l_orderkey)""")
def child_list_diff(t):
    part = F.when(c("l_orderkey") % 3 == 0, c("l_partkey") + 1).otherwise(c("l_partkey"))
    sort = lambda x, k: F.transform(F.array_sort(x), lambda s: F.struct(s[k]))
    a = t("lineitem").groupBy("l_orderkey").agg(F.collect_list(F.struct("l_linenumber", "l_suppkey", c("l_partkey").alias("p"))).alias("a"))
    b = t("lineitem").where("l_orderkey % 4 <> 0").groupBy("l_orderkey").agg(F.collect_list(F.struct((-c("l_linenumber")).alias("o"), "l_suppkey", part.alias("p"))).alias("b"))
    # The unchanged part number decides ties in the order of a changed list as well.
    both = a.join(b, "l_orderkey", "left").select("l_orderkey", sort("a", "p").alias("a"), sort("b", "p").alias("b"))
    return both.select("l_orderkey", reconcile.same_children(c("a"), c("b"), ordered=False).alias("same_set"), reconcile.same_children(c("a"), c("b"), ordered=True).alias("same_list"))


@query("""with o as (select distinct legislative_session as session, 'old' as origin from bill where legislative_session < '2022'), n as (select distinct legislative_session as session, 'new' as origin from bill where legislative_session > '2020')
 select coalesce(n.session, o.session) as session, coalesce(n.origin, o.origin) as origin from n full join o on n.session = o.session""")
def session_merge(t):
    s = t("bill").select(c("legislative_session").alias("session")).distinct()
    return reconcile.merge_by_key(s.where("session > '2020'").withColumn("origin", F.lit("new")), s.where("session < '2022'").withColumn("origin", F.lit("old")), ["session"], ["origin"])


_BATCH = "(select * from lineitem where l_orderkey % 3 = 0 and l_linenumber <= 2)"


@query(f"select distinct l_orderkey, l_linenumber from lineitem l where exists (select 1 from {_BATCH} b where b.l_orderkey = l.l_orderkey) and not exists (select 1 from {_BATCH} b where b.l_orderkey * 10 + b.l_linenumber = l.l_orderkey * 10 + l.l_linenumber)")
def vote_purge(t):
    rows = t("lineitem").withColumn("key", c("l_orderkey") * 10 + c("l_linenumber"))
    return reconcile.purge_stale(rows, rows.where("l_orderkey % 3 = 0 and l_linenumber <= 2"), "l_orderkey", "key").select("l_orderkey", "l_linenumber").distinct()


@query("""with batch as (select * from scrape_event where event_id % 2 = 0 and jurisdiction_id < 'ocd-jurisdiction/country:us/state:m')
 select distinct event_id, case when event_id in (select event_id from batch) then false when jurisdiction_id in (select jurisdiction_id from batch) then true else false end as deleted from scrape_event""")
def event_soft_delete(t):
    rows = t("scrape_event").select("event_id", "jurisdiction_id").distinct().withColumn("deleted", F.lit(False))
    batch = rows.where("event_id % 2 = 0 and jurisdiction_id < 'ocd-jurisdiction/country:us/state:m'")
    return reconcile.soft_delete(rows, batch, "event_id", "jurisdiction_id").select("event_id", "deleted")


@query("select c_custkey from customer except select o_custkey from orders where o_orderkey % 2 = 0")
def missing_id_guard(t):
    return reconcile.missing_ids(t("customer"), t("orders").where("o_orderkey % 2 = 0").select(c("o_custkey").alias("c_custkey")), "c_custkey")


@query("with m as (select o_custkey as old_id, min(o_custkey // 10 * 10) as new_id from orders where o_custkey % 10 = 3 group by 1) select o_orderkey, coalesce(new_id, o_custkey) as o_custkey from orders left join m on old_id = o_custkey")
def merged_id_repoint(t):
    merged = t("orders").where("o_custkey % 10 = 3").select(c("o_custkey").alias("old_id"), (F.floor(c("o_custkey") / 10) * 10).alias("new_id"))
    return resolve.repoint(t("orders"), merged, "o_custkey").select("o_orderkey", "o_custkey")


@query("select distinct legislative_session as session from bill_snapshot where legislative_session not in (select legislative_session from bill where legislative_session <> '2023') and legislative_session <> '2022'")
def session_check(t):
    known = t("bill").where("legislative_session <> '2023'").select(c("legislative_session").alias("session"))
    ignored = t("bill").limit(1).select(F.lit("2022").alias("session"))
    return reconcile.sessions_allowed(t("bill_snapshot").select(c("legislative_session").alias("session")), known, ignored)


@query("select l_orderkey, l_linenumber, l_partkey, true as fresh from lineitem where l_orderkey % 3 = 0 and l_linenumber = 1 union all select l_orderkey, l_linenumber, l_partkey, false from lineitem where l_orderkey not in (select l_orderkey from lineitem where l_orderkey % 3 = 0)")
def child_replace(t):
    rows = t("lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    changed = rows.where("l_orderkey % 3 = 0")
    return reconcile.replace_children(rows.withColumn("fresh", F.lit(False)), changed.where("l_linenumber = 1").withColumn("fresh", F.lit(True)), changed, "l_orderkey")


@query("select o_custkey, max_by(o_orderkey, (o_orderdate, o_orderkey)) as o_orderkey from orders group by 1".replace("max_by", "arg_max"))
def duplicate_targets(t):
    return reconcile.duplicate_targets(t("orders"), "o_custkey", ["o_orderdate", "o_orderkey"], allow=True).select("o_custkey", "o_orderkey")


# Resolution

_SESSIONS = """(select n_regionkey as j, n_name as s, cast(1992 + n_nationkey % 5 as varchar) || '-01-01' as a, case when n_nationkey % 3 = 0 then '' else cast(1993 + n_nationkey % 6 as varchar) || '-06-30' end as b from nation)"""


@query(f"""with r as (select o_orderkey as ref, o_custkey % 5 as j, cast(cast(o_orderdate as date) as varchar) as d from orders), h as (select ref, count(*) as n, min(s) as s from r join {_SESSIONS} x on x.j = r.j and a <= d and (b >= d or b = '') group by ref),
 l as (select j, arg_max(s, (a, s)) as s from {_SESSIONS} group by j) select r.ref, case when h.n = 1 then h.s else l.s end as session from r left join h on h.ref = r.ref left join l on l.j = r.j""")
def resolve_bill_by_date(t):
    refs = t("orders").select(c("o_orderkey").alias("ref"), (c("o_custkey") % 5).cast("int").alias("jurisdiction"), c("o_orderdate").cast("date").cast("string").alias("date"))
    k = c("n_nationkey")
    end = F.when(k % 3 == 0, "").otherwise(F.concat((k % 6 + 1993).cast("string"), F.lit("-06-30")))
    sessions = t("nation").select(c("n_regionkey").alias("jurisdiction"), c("n_name").alias("session"), F.concat((k % 5 + 1992).cast("string"), F.lit("-01-01")).alias("start_date"), end.alias("end_date"))
    return resolve.session_at(refs, sessions).select("ref", "session")


_LETTERS = "trim(regexp_replace(upper({0}), '[^A-Z]', '', 'g') || ' ' || regexp_replace(regexp_extract({0}, '[0-9]+'), '^0+([0-9])', '\\1'))"


@query(f"""with b as (select id, jurisdiction_id as j, legislative_session as s, {_LETTERS.format('identifier')} as i from {CURRENT}), o as (select lower(trim(id)) as id, any_value(jurisdiction_id) as j from bill group by 1),
 r as (select distinct r.id as ref, o.j, lower(trim(r.legislative_session)) as s, {_LETTERS.format('r.identifier')} as i from related_bill r left join o on o.id = lower(trim(r.bill_id))),
 n as (select j, lower(trim(s)) as s, i, min(id) as one, count(distinct id) as n from b group by all)
 select ref, case when n = 1 then one end as resolved, coalesce(n, 0) as n_candidates from r left join n on r.j = n.j and r.s = n.s and r.i = n.i""")
def related_bill_resolve(t):
    current = current_bills(t)
    owner = current.groupBy(id_key(c("id")).alias("owner")).agg(F.max("jurisdiction_id").alias("j"))
    refs = t("related_bill").select(c("id").alias("ref"), id_key(c("bill_id")).alias("owner"), id_key(c("legislative_session")).alias("s"), bill_key(c("identifier")).alias("i")).join(owner, "owner", "left").drop("owner").distinct()
    known = current.select("id", c("jurisdiction_id").alias("j"), id_key(c("legislative_session")).alias("s"), bill_key(c("identifier")).alias("i"))
    return resolve.resolve_unique(refs, known, ["j", "s", "i"], "id").select("ref", "resolved", "n_candidates")


@query("""with p as (select id, dedupe_key as k, jurisdiction_id as j, motion_text as m, start_date as d from vote_event where cast(created_at as date) < '2022-06-01'),
 r as (select distinct id as ref, dedupe_key as k, jurisdiction_id as j, motion_text as m, start_date as d from vote_event),
 a as (select k, min(id) as one, count(distinct id) as n from p where k is not null group by 1), b as (select j, m, d, min(id) as one, count(distinct id) as n from p where j is not null and m is not null and d is not null group by all)
 select ref, 'dedupe' as kind, case when n = 1 then one end as resolved, coalesce(n, 0) as n_candidates from r left join a on a.k = r.k where r.k is not null
 union all select ref, 'motion', case when n = 1 then one end, coalesce(n, 0) from r left join b on b.j = r.j and b.m = r.m and b.d = r.d where r.k is null and r.j is not null and r.m is not null and r.d is not null
 union all select ref, 'invalid', null, 0 from r where k is null and (j is null or m is null or d is null)""")
def vote_key_lookup(t):
    rows = t("vote_event").select(c("id").alias("ref"), "id", "dedupe_key", "jurisdiction_id", "motion_text", "start_date", "created_at")
    known = rows.where(c("created_at").cast("date") < "2022-06-01").drop("ref", "created_at")
    return resolve.resolve_first_kind(rows.drop("id", "created_at").distinct(), known, {"dedupe": ["dedupe_key"], "motion": ["jurisdiction_id", "motion_text", "start_date"]}, "ref", "id")


@query("""with l as (select distinct l_orderkey as claimant, l_partkey as claimed from lineitem), k as (select *, count(*) over (partition by claimant) as n from l),
 w as (select claimant, claimed, row_number() over (partition by claimed order by claimant) as r from k where n = 1) select c.claimant, w.claimed from (select distinct claimant from l) c left join w on w.claimant = c.claimant and r = 1""")
def vote_action_claim(t):
    links = t("lineitem").select(c("l_orderkey").alias("claimant"), c("l_partkey").alias("claimed")).distinct()
    return resolve.claim_once(links, "claimed", "claimant", ["claimant"])


@query(f"""with p as (select id, name, family_name, unnest(roles, recursive := true) from (select id, name, family_name, list_filter(roles, lambda r: coalesce(r.end_date, '') = '' or r.end_date > '{TODAY}') as roles from {PERSONS})),
 f as (select jurisdiction, type as chamber, lower(name) as n, id from p union select jurisdiction, type, lower(family_name), id from p), l as (select * from f where chamber is not null and n <> '' union select jurisdiction, 'legislature', n, id from f where n <> ''),
 m as (select jurisdiction, chamber, n, count(distinct id) as k, min(id) as one from l group by all), r as (select distinct jurisdiction_id, person_name, unnest(['upper', 'lower', 'legislature']) as chamber from scrape_office where person_name is not null)
 select jurisdiction_id, person_name, r.chamber, case when k = 1 then one end as person from r left join m on m.jurisdiction = jurisdiction_id and m.chamber = r.chamber and m.n = lower(person_name)""")
def name_matcher(t):
    active = F.filter("roles", lambda r: (F.coalesce(r["end_date"], F.lit("")) == "") | (r["end_date"] > TODAY))
    persons = latest_persons(t).select("id", "name", "family_name", F.explode(active).alias("r")).select("id", c("name").alias("whole"), "family_name", c("r.jurisdiction").alias("jurisdiction_id"), c("r.type").alias("chamber"))
    names = resolve.filed_names(persons, ["jurisdiction_id"], "chamber", "id", ["whole", "family_name"])
    refs = t("scrape_office").where("person_name is not null").select("jurisdiction_id", "person_name", F.lower("person_name").alias("name")).distinct()
    refs = refs.select("*", F.explode(F.array(F.lit("upper"), F.lit("lower"), F.lit("legislature"))).alias("chamber"))
    return resolve.match_names(refs, names, ["jurisdiction_id", "chamber", "name"], "id").select("jurisdiction_id", "person_name", "chamber", "person")


@query(f"""with s as (select id, name, family_name, unnest(roles, recursive := true) from {PERSONS}),
 m as (select id, jurisdiction as j, type as ch, coalesce(start_date, '') as a, coalesce(end_date, '') as b, coalesce(end_date, '') = '' as act from s), n as (select distinct id, upper(trim(name)) as u from s union select distinct id, upper(trim(family_name)) from s),
 r as (select distinct person_name || '@' || jurisdiction_id as ref, upper(trim(person_name)) as u, jurisdiction_id as j from scrape_office where person_name is not null),
 h as (select ref, count(distinct n.id) as k, min(n.id) as one, count(distinct case when act then n.id end) as ka, min(case when act then n.id end) as onea from r join n on n.u = r.u join m on m.id = n.id and m.j = r.j and (b = '' or b > '2015-01-01') and (a = '' or a < '2024-01-01') group by ref)
 select r.ref, case when k = 1 then one when ka = 1 then onea end as person, coalesce(k, 0) as n_candidates from r left join h on h.ref = r.ref""")
def resolve_person(t):
    persons = latest_persons(t)
    roles = persons.select("id", F.explode("roles").alias("r"))
    members = roles.select("id", c("r.jurisdiction").alias("jurisdiction"), c("r.type").alias("chamber"), c("r.start_date").alias("start_date"), c("r.end_date").alias("end_date"), (F.coalesce("r.end_date", F.lit("")) == "").alias("active"))
    refs = t("scrape_office").where("person_name is not null").select(F.concat_ws("@", "person_name", "jurisdiction_id").alias("ref"), F.upper(F.trim("person_name")).alias("uname"), c("jurisdiction_id").alias("jurisdiction"), F.lit(None).cast("string").alias("chamber"), F.lit("2015-01-01").alias("from_date"), F.lit("2024-01-01").alias("to_date")).distinct()
    return resolve.resolve_person(refs, resolve.names_of(persons, "id", "name", "family_name"), members, "id").select("ref", "person", "n_candidates")


@query("select distinct coalesce(location_name, '') as name, jurisdiction_id from scrape_event where event_id % 2 = 0 except select coalesce(location_name, ''), jurisdiction_id from scrape_event where event_id % 2 = 1")
def location_get_or_create(t):
    rows = t("scrape_event").select("event_id", F.coalesce("location_name", F.lit("")).alias("name"), "jurisdiction_id")
    return resolve.get_or_create(rows.where("event_id % 2 = 0"), rows.where("event_id % 2 = 1"), ["name", "jurisdiction_id"])


@query("""with r as (select c_custkey, case when c_custkey % 3 = 0 then upper(regexp_extract(jurisdiction_id, '([a-z]{2})/government$', 1)) end as abbr, case when c_custkey % 3 = 1 then upper(name) end as name, jurisdiction_id from customer join (select *, row_number() over (order by jurisdiction_id) - 1 as k from jurisdiction_zone) on k = c_custkey % 48)
 select c_custkey, jurisdiction_id as found from r""")
def district_lookup(t):
    zone = t("jurisdiction_zone").select("jurisdiction_id", "name", F.upper(F.regexp_extract("jurisdiction_id", "([a-z]{2})/government$", 1)).alias("abbr"))
    from pyspark.sql import Window as W

    numbered = zone.withColumn("k", F.row_number().over(W.orderBy("jurisdiction_id")) - 1)
    refs = t("customer").withColumn("k", (c("c_custkey") % 48).cast("int")).join(F.broadcast(numbered), "k")
    third = c("c_custkey") % 3
    refs = refs.select("c_custkey", F.when(third == 0, c("abbr")).alias("abbr"), F.when(third == 1, F.upper("name")).alias("name"), F.when(third == 2, c("jurisdiction_id")).alias("jurisdiction_id"))
    return hierarchy.lookup(refs, zone).select("c_custkey", "found")


# People and committees


@query(f"""with s as (select id, unnest(roles, recursive := true) from {PERSONS}) select distinct jurisdiction as organization, id as person_id from s
 where (coalesce(start_date, '') = '' or start_date <= '{TODAY}') and (coalesce(end_date, '') = '' or end_date >= '{TODAY}') and jurisdiction is not null""")
def member_of(t):
    roles = latest_persons(t).select(c("id").alias("person_id"), F.explode("roles").alias("r")).select(F.struct(c("r.jurisdiction").alias("organization"), "person_id").alias("m"), c("r.start_date").alias("start_date"), c("r.end_date").alias("end_date"))
    return people.members_of(roles, c("m.organization").isNotNull(), F.lit(TODAY), ident="m").select("m.*")


@query("""with a as (select l_orderkey, l_linenumber as k, min(l_partkey) as v from lineitem where l_linenumber <= 4 group by all), b as (select l_orderkey, l_linenumber as k, max(l_partkey + 1) as v from lineitem where l_linenumber >= 3 group by all),
 m as (select coalesce(a.l_orderkey, b.l_orderkey) as l_orderkey, coalesce(a.k, b.k) as k, coalesce(b.v, a.v) as v from a full join b on a.l_orderkey = b.l_orderkey and a.k = b.k)
 select l_orderkey, string_agg(k || ':' || v, ',' order by k) as merged from m group by 1""")
def keyed_list_merge(t):
    rows = t("lineitem").select("l_orderkey", c("l_linenumber").alias("k"), c("l_partkey").alias("v"))
    a = rows.where("k <= 4").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("k", "v"))).alias("old"))
    b = rows.where("k >= 3").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("k", (c("v") + 1).alias("v")))).alias("new"))
    both = a.join(b, "l_orderkey", "full_outer").select("l_orderkey", people.merge_lists(F.coalesce("old", F.array().cast("array<struct<k:int,v:bigint>>")), F.coalesce("new", F.array().cast("array<struct<k:int,v:bigint>>")), "k").alias("m"))
    return both.select("l_orderkey", F.array_join(F.transform("m", lambda x: F.concat_ws(":", x["k"], x["v"])), ",").alias("merged"))


@query("""with o as (select n_regionkey as parent, n_name as name, n_nationkey as v from nation where n_nationkey < 20), n as (select n_regionkey as parent, n_name as name, n_nationkey // 12 * 12 as v from nation where n_nationkey > 5)
 select coalesce(o.parent, n.parent) as parent, coalesce(o.name, n.name) as name, case when o.name is null then 'add' when n.name is null then 'remove' when o.v = n.v then 'same' else 'to_merge' end as plan from o full join n on o.parent = n.parent and o.name = n.name""")
def merge_plan(t):
    rows = t("nation").select(c("n_regionkey").alias("parent"), c("n_name").alias("name"), c("n_nationkey").alias("v"))
    return people.merge_plan(rows.where("v < 20"), rows.where("v > 5").withColumn("v", (F.floor(c("v") / 12) * 12).cast("int")), ["parent", "name"], "v")


@query("""with p as (select id, snapshot_date, min(coalesce(name, '')) as on_, min(coalesce(email, '')) as oe, max(coalesce(name, '')) as nn, max(coalesce(email, '')) as ne from person_snapshot group by 1, 2),
 b as (select id, snapshot_date, nn, ne, lag(on_) over w as on_, lag(oe) over w as oe, lag(snapshot_date) over w as since from p window w as (partition by id order by snapshot_date))
 select id, since, snapshot_date, case when nn <> '' then nn else on_ end as name, case when ne <> '' then ne else oe end as email, list_filter([case when nn <> '' and nn <> on_ then 'name' end, case when ne <> '' and ne <> oe then 'email' end], lambda x: x is not null) as changed from b where since is not null""")
def person_merge(t):
    from pyspark.sql import Window as W

    rows = t("person_snapshot").select("id", "snapshot_date", F.coalesce("name", F.lit("")).alias("name"), F.coalesce("email", F.lit("")).alias("email"))
    each = rows.groupBy("id", "snapshot_date").agg(F.struct(F.min("name").alias("name"), F.min("email").alias("email")).alias("first"), F.struct(F.max("name").alias("name"), F.max("email").alias("email")).alias("n"))
    before = W.partitionBy("id").orderBy("snapshot_date")
    both = each.select("id", "snapshot_date", "n", F.lag("first").over(before).alias("o"), F.lag("snapshot_date").over(before).alias("since")).where("since is not null")
    merged = people.apply_diff(c("o"), c("n"), ["name", "email"], [])
    return both.select("id", "since", "snapshot_date", merged.alias("m"), F.transform(people.field_diff(c("o"), c("n"), ["name", "email"], []), lambda d: d["key"]).alias("changed")).select("id", "since", "snapshot_date", "m.name", "m.email", "changed")


@query("""select distinct id, snapshot_date, list_transform(roles, lambda r: case when coalesce(r.end_date, '') = '' then '2023-12-31' else r.end_date end) as ends from person_snapshot where roles is not null""")
def retire_person(t):
    rows = t("person_snapshot").where("roles is not null")
    return rows.select("id", "snapshot_date", F.transform(people.retire(c("roles"), F.lit("2023-12-31"), F.lit("retired")), lambda r: r["end_date"]).alias("ends")).distinct()


# Hierarchy


@query("""select jurisdiction_id, regexp_extract(jurisdiction_id, 'country:([a-z]+)', 1) as country, string_split(string_split(jurisdiction_id, '/')[3], ':')[1] as kind1, string_split(string_split(jurisdiction_id, '/')[3], ':')[2] as value1, string_split(string_split(jurisdiction_id, '/')[4], ':')[1] as kind2 from jurisdiction_zone""")
def division_parse(t):
    return hierarchy.divisions(t("jurisdiction_zone"), "jurisdiction_id", 2).select("jurisdiction_id", "country", "kind1", "value1", "kind2")


_DIVISIONS = "(select 'ocd-division/country:us/state:' || lower(left(n_name, 2)) || case when n_nationkey % 3 = 0 then '' when n_nationkey % 3 = 1 then '/county:' || n_nationkey else '/county:' || n_nationkey || '/place:' || n_regionkey end as d from nation)"


@query(f"select d, len(d) - len(replace(d, '/', '')) as level from {_DIVISIONS} where d like 'ocd-division/country:us/%' and len(d) - len(replace(d, '/', '')) between 2 and 3")
def division_children(t):
    k = c("n_nationkey")
    tail = F.when(k % 3 == 0, "").when(k % 3 == 1, F.concat(F.lit("/county:"), k.cast("string"))).otherwise(F.concat(F.lit("/county:"), k.cast("string"), F.lit("/place:"), c("n_regionkey").cast("string")))
    rows = t("nation").select(F.concat(F.lit("ocd-division/country:us/state:"), F.lower(F.substring("n_name", 1, 2)), tail).alias("d"))
    return hierarchy.below(rows, "d", "ocd-division/country:us", depth=2).select("d", (F.size(F.split("d", "/")) - 1).alias("level"))


@query("""with recursive tree(i, p) as (select cast(p_partkey as varchar), case when p_partkey > 1 then cast(p_partkey // 2 as varchar) end from part), up(id, ancestor, depth) as (select i, p, 1 from tree where p is not null union all select up.id, t.p, up.depth + 1 from up join tree t on t.i = up.ancestor where t.p is not null)
 select id, ancestor, depth from up""")
def org_ancestors(t):
    k = c("p_partkey")
    tree = t("part").select(k.alias("i"), F.when(k > 1, F.floor(k / 2)).alias("p"))
    return resolve.ancestors(tree, "i", "p")


@query("select r_name, cast(d as varchar) as district, 2 as seats from region, unnest(generate_series(1, r_regionkey + 3)) as t(d)")
def numbered_districts(t):
    return hierarchy.numbered_districts(t("region").select("r_name", (c("r_regionkey") + 3).alias("n")), "n", 2).select("r_name", "district", "seats")


# Full text


@query("select doc_id, case when source = 'bill_text' then 'paragraphs' when source = 'fiscal_note' then 'numbered' else 'plain' end as extractor from documents")
def extractor_dispatch(t):
    return fulltext.extract(t("documents"), [(None, "bill_text", "paragraphs"), (None, "fiscal_note", "numbered")], "jurisdiction_id", "source", "text").select("doc_id", "extractor")


@query()  # no SQL: it cannot pick elements out of HTML
def extracted_text(t):
    page = F.concat(F.lit("<html><body><p>"), F.regexp_replace(F.replace(F.replace("text", F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), "\n\n", "</p><p>"), F.lit("</p></body></html>"))
    raw = t("documents").withColumn("raw", F.when(c("source") == "bill_text", page).otherwise(c("text")))
    return fulltext.extract(raw, [(None, "bill_text", "paragraphs"), (None, "fiscal_note", "sometimes_numbered")], "jurisdiction_id", "source", "raw").select("doc_id", "extractor", "text")


@query("select doc_id, array_to_string(list_transform(string_split(text, chr(10) || chr(10)), lambda x: regexp_replace(x, '^[\\s\\x{a0}]+|[\\s\\x{a0}]+$', '', 'g')), chr(10)) as text from documents")
def html_paragraph_text(t):
    page = F.concat(F.lit("<html><body><p>"), F.regexp_replace(F.replace("text", F.lit("<"), F.lit("&lt;")), "\n\n", "</p><p>"), F.lit("</p><script>no()</script></body></html>"))
    return t("documents").select("doc_id", fulltext.html_text(page).alias("text"))


_STOP = "'" + "', '".join(fulltext.STOP) + "'"
_TOKENS = "list_transform(list_filter(string_split_regex(lower(coalesce({0}, '')), '[^a-z0-9]+'), lambda w: w <> '' and w not in ({1})), lambda w: {{'w': w, 'c': '{2}'}})"


@query(f"""with d as (select sb_id, max(all_titles) as a, max(raw_text) as r from searchable_bill group by 1), l as (select sb_id, list_concat({_TOKENS.format('a', _STOP, 'A')}, {_TOKENS.format('r', _STOP, 'B')}) as l from d),
 u as (select sb_id, unnest(l) as x, generate_subscripts(l, 1) - 1 as position from l) select sb_id, case when length(x.w) >= 5 then regexp_replace(x.w, '(?:ations?|ings?|edly|ed|es|ly|s)$', '') else x.w end as term, min(x.c) as weight, count(*) as n, min(position) as first_position from u group by 1, 2""")
def search_postings(t):
    return fulltext.postings(t("searchable_bill").groupBy("sb_id").agg(F.max("all_titles").alias("all_titles"), F.max("raw_text").alias("raw_text")), "sb_id", "all_titles", "raw_text")


# Validation


@query(f"""select id, title, list_filter([case when trim(coalesce(title, '')) = '' then 'title: empty' end, case when from_organization is not null and from_organization not in ('upper', 'lower', 'legislature') then 'from_organization: not allowed' end,
 case when len(list_filter(coalesce(classification, []), lambda x: x not in ('bill', 'resolution'))) > 0 then 'classification: not allowed' end, case when first_action_date <> '' and not regexp_matches(first_action_date, '{S.FUZZY_DATE}') then 'first_action_date: form' end], lambda x: x is not null) as errors from bill""")
def validate_bill(t):
    rules = [validate.filled("title"), validate.one_of("from_organization", validate.CHAMBERS), validate.all_of("classification", ["bill", "resolution"]), validate.like("first_action_date", S.FUZZY_DATE)]
    return validate.check(t("bill"), rules).select("id", "title", "errors")


@query("""select id, list_filter([case when trim(coalesce(motion_text, '')) = '' then 'motion_text: empty' end, case when result is not null and result not in ('pass', 'fail') then 'result: not allowed' end, case when len(list_filter(coalesce(counts, []), lambda x: x.value < 0)) > 0 then 'counts: negative' end,
 case when trim(coalesce(bill_id, '')) = '' then 'bill_id: empty' end], lambda x: x is not null) as errors from vote_event""")
def validate_vote_event(t):
    rules = [validate.filled("motion_text"), validate.one_of("result", validate.RESULTS), validate.each("counts", "negative", lambda x: x["value"] < 0), validate.filled("bill_id")]
    return validate.check(t("vote_event"), rules).select("id", "errors")


@query("""select event_id, list_filter([case when trim(coalesce(name, '')) = '' then 'name: empty' end, case when status is not null and status not in ('cancelled', 'tentative', 'confirmed', 'passed') then 'status: not allowed' end,
 case when start_date is null or not regexp_matches(start_date, '^[0-9]{4}-[0-9]{2}-[0-9]{2}T') then 'start_date: form' end], lambda x: x is not null) as errors from scrape_event""")
def validate_event(t):
    rules = [validate.filled("name"), validate.one_of("status", validate.STATUSES), validate.like("start_date", "^[0-9]{4}-[0-9]{2}-[0-9]{2}T", blank=False)]
    return validate.check(t("scrape_event"), rules).select("event_id", "errors")


@query("""select office_id, person_name, list_filter([case when trim(coalesce(address, '')) = '' and trim(coalesce(voice, '')) = '' and trim(coalesce(fax, '')) = '' then 'office: no value' end, case when voice <> '' and not regexp_matches(voice, '^(1-)?[0-9]{3}-[0-9]{3}-[0-9]{4}( ext\\. [0-9]+)?$') then 'voice: form' end,
 case when fax <> '' and not regexp_matches(fax, '^(1-)?[0-9]{3}-[0-9]{3}-[0-9]{4}( ext\\. [0-9]+)?$') then 'fax: form' end, case when contains(voice, chr(10)) then 'voice: line break' end], lambda x: x is not null) as errors from scrape_office""")
def lint_office(t):
    return validate.check(t("scrape_office"), validate.office_rules()).select("office_id", "person_name", "errors")


@query(f"""with p as (select id, snapshot_date, delivered_at, name, given_name, family_name, coalesce(roles, []) as r, list_filter(coalesce(roles, []), lambda x: coalesce(x.end_date, '') = '' or x.end_date > '{TODAY}') as ar, list_filter(coalesce(party, []), lambda x: coalesce(x.end_date, '') = '' or x.end_date > '{TODAY}') as ap from person_snapshot)
 select id, snapshot_date, delivered_at, list_filter([case when len(ar) = 0 then 'roles: none active' end, case when len(ar) > 1 then 'roles: several active' end, case when len(list_filter(r, lambda x: x.type in ('upper', 'lower') and coalesce(x.district, '') = '')) > 0 then 'roles: no district' end,
 case when len(list_filter(ar, lambda x: x.type in ('upper', 'lower', 'legislature'))) > 0 and len(ap) = 0 then 'party: none active' end, case when len(list_filter(ap, lambda x: x.name in ('Harbor Liberal', 'Prairie Labor'))) > 1 then 'party: several major' end, case when len(string_split(name, ',')) > 2 then 'name: commas' end,
 case when len(string_split(name, ',')) = 2 and not regexp_matches(name, '(?i),.*\\b(jr|sr|i{{2,3}}|iv|v|m\\.?d|ph\\.?d|esq)\\b') then 'name: suffix' end, case when len(string_split_regex(trim(name), '\\s+')) = 2 and (coalesce(given_name, '') = '' or coalesce(family_name, '') = '') then 'name: no given or family name' end], lambda e: e is not null) as errors from p""")
def lint_person(t):
    return validate.check(t("person_snapshot"), validate.person_rules(F.lit(TODAY), ["Harbor Liberal", "Prairie Labor"])).select("id", "snapshot_date", "delivered_at", "errors")


# Streaming


@query("select cast(date_trunc('day', ts) as timestamp) as window_start, event_type, count(*) as n from events group by all")
def windowed_events(t):
    return realtime.windowed_counts(t("events"), "ts", ["event_type"])


@query("select event_id, arg_max(user_id, (ts, user_id, event_type)) as user_id, arg_max(event_type, (ts, user_id, event_type)) as event_type from events group by 1")
def realtime_microbatch(t):
    rows = t("events")
    spark, path = rows.sparkSession, rows.inputFiles()
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir") or tempfile.gettempdir()
    folder, name = path[0].rsplit("/", 1)
    only = None if folder.endswith(".parquet") else name
    return realtime.reconciled(spark, folder, rows.schema, ["event_id"], ["user_id", "event_type"], "ts", f"{shared}/billforge-stream-{uuid.uuid4().hex}", only=only)


# Nested references, links, names


@query("""with a as (select l_orderkey, list({'o': l_linenumber * 100000 + l_suppkey, 's': l_suppkey, 'id': case when s_acctbal > 0 then s_name end} order by l_linenumber * 100000 + l_suppkey, l_partkey) as entries, bool_or(coalesce(s_acctbal, 0) <= 0) as bad from lineitem left join supplier on s_suppkey = l_suppkey group by 1)
 select l_orderkey, array_to_string(list_transform(entries, lambda e: e.id), ',') as suppliers from a where not bad""")
def nested_ref_rewrite(t):
    nested = t("lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct((c("l_linenumber") * 100000 + c("l_suppkey")).alias("o"), c("l_partkey").alias("p"), c("l_suppkey").alias("s")))).alias("entries"))
    known = t("supplier").where("s_acctbal > 0").select(c("s_suppkey").alias("s"), "s_name")
    good, _ = resolve.rewrite_refs(nested, "entries", "s", "l_orderkey", known, "s_name")
    return good.select("l_orderkey", F.array_join(F.transform("entries", lambda e: e["s_id"]), ",").alias("suppliers"))


@query("""with o as (select *, row_number() over (partition by l_orderkey, l_partkey order by l_linenumber * 100000 + l_suppkey) as k from lineitem) select l_orderkey, l_returnflag, array_to_string(list(l_partkey order by l_linenumber * 100000 + l_suppkey, l_partkey), ',') as links from o where k = 1 group by all""")
def link_groups(t):
    rows = t("lineitem").select("l_orderkey", "l_returnflag", "l_partkey", (c("l_linenumber") * 100000 + c("l_suppkey")).alias("o"))
    return reconcile.link_groups(rows, "l_orderkey", ["l_returnflag"], "l_partkey", "o").select("l_orderkey", "l_returnflag", F.array_join(F.transform("links", lambda x: x.cast("string")), ",").alias("links"))


@query("select distinct name, replace(array_to_string(list_transform(regexp_extract_all(lower(name), '[a-z]+|[^a-z]+'), lambda w: upper(w[1]) || w[2:]), ''), ' & ', ' and ') as plain from scrape_event")
def organization_names(t):
    name = resolve.organization_name(c("name"))
    for word in ("and", "of", "the", "on", "for", "in", "to"):  # the query shows the title case alone
        name = F.regexp_replace(name, f" {word} ", f" {word.capitalize()} ")
    return t("scrape_event").select("name", name.alias("plain")).distinct()


@query("""with o as (select o_orderkey as id, o_custkey * 2 as name, o_orderstatus as a, o_orderpriority as b, o_orderkey % 2 + 1 as seats from orders), x as (select name, min(id) as id from o group by 1), y as (select a, b, min(id) as id from o where seats = 1 group by 1, 2)
 select n.o_orderkey as new_id, coalesce(x.id, y.id) as old_id, case when x.id is not null then 'name' else 'role' end as by from orders n left join x on x.name = n.o_custkey left join y on y.a = n.o_orderstatus and y.b = n.o_orderpriority where x.id is not null or y.id is not null""")
def incoming_match(t):
    k = c("o_orderkey")
    rows = t("orders").select(k.alias("id"), c("o_custkey").cast("string").alias("name"), c("o_orderstatus").alias("a"), c("o_orderpriority").alias("b"), (k % 2 + 1).alias("seats"))
    return people.match_incoming(rows, rows.withColumn("name", (c("name").cast("bigint") * 2).cast("string")), "id", "name", ["a", "b"], "seats")


@query("select jurisdiction_id, min(snapshot_date) as start_date, max(snapshot_date) as end_date, sum(n) as n from (select jurisdiction_id, snapshot_date, count(*) as n from bill_snapshot group by all) group by 1")
def report_combine(t):
    runs = t("bill_snapshot").groupBy("jurisdiction_id", "snapshot_date").agg(F.count(F.lit(1)).alias("n")).withColumns({"start_date": c("snapshot_date"), "end_date": c("snapshot_date")})
    return reconcile.combine_reports(runs, ["jurisdiction_id"], "start_date", "end_date", ["n"])


@query("""with o as (select office_id, jurisdiction_id, coalesce(nullif(name, ''), 'Office') as name, coalesce(voice, '') as voice, coalesce(fax, '') as fax from scrape_office), a as (select jurisdiction_id, name, max(voice) as v, max(fax) as f from o where office_id % 2 = 0 group by all), b as (select jurisdiction_id, name, min(voice) as v, min(fax) as f from o where office_id % 2 = 1 group by all),
 m as (select coalesce(a.jurisdiction_id, b.jurisdiction_id) as jurisdiction_id, coalesce(a.name, b.name) as name, coalesce(nullif(b.v, ''), a.v, '') as v, coalesce(nullif(b.f, ''), a.f, '') as f from a full join b on a.jurisdiction_id = b.jurisdiction_id and a.name = b.name) select jurisdiction_id, name, v as voice, f as fax from m where v <> '' or f <> ''""")
def office_merge(t):
    rows = t("scrape_office").select("office_id", "jurisdiction_id", F.coalesce(F.nullif("name", F.lit("")), F.lit("Office")).alias("name"), F.coalesce("voice", F.lit("")).alias("voice"), F.coalesce("fax", F.lit("")).alias("fax"))
    side = lambda k, f, n: rows.where(c("office_id") % 2 == k).groupBy("jurisdiction_id", "name").agg(f("voice").alias("voice"), f("fax").alias("fax")).groupBy("jurisdiction_id").agg(F.array_sort(F.collect_list(F.struct("name", "voice", "fax"))).alias(n))
    kind = "array<struct<name:string,voice:string,fax:string>>"
    both = side(0, F.max, "old").join(side(1, F.min, "new"), "jurisdiction_id", "full_outer")
    merged = people.merge_offices(F.coalesce("old", F.array().cast(kind)), F.coalesce("new", F.array().cast(kind)), "name", ("voice", "fax"))
    return both.select("jurisdiction_id", F.explode(merged).alias("o")).select("jurisdiction_id", "o.*").where("voice <> '' or fax <> ''")


@query("select case when substr(source, 1, 1) < 'f' then 'x' || source else source end as kind, count(distinct bill_identifier) as n_files from documents where bill_identifier is not null group by 1")
def scrape_counters(t):
    kind = F.when(F.substring("source", 1, 1) < "f", F.concat(F.lit("x"), "source")).otherwise(c("source"))
    return t("documents").where("bill_identifier is not null").groupBy(kind.alias("kind")).agg(F.count_distinct("bill_identifier").alias("n_files"))


@query("select event_id, name, case when contains(lower(string_split(name, ' ')[1]), 'floor') and not contains(lower(string_split(name, ' ')[1]), 'task') then 'upper' when contains(lower(string_split(name, ' ')[1]), 'task') then 'lower' end as chamber from scrape_event")
def event_chamber(t):
    return t("scrape_event").select("event_id", "name", hierarchy.chamber_of(c("name"), F.lit("floor"), F.lit("task")).alias("chamber"))


# More of the roster and import operators


@query(f"""with r as (select id as person_id, unnest(roles, recursive := true) from {PERSONS})
 select person_id, type as chamber, count(*) as n from r where type in ('upper', 'lower') and (coalesce(start_date, '') = '' or start_date <= '{TODAY}') and (coalesce(end_date, '') = '' or end_date >= '{TODAY}') group by all""")
def current_legislators(t):
    roles = latest_persons(t).select(c("id").alias("person_id"), F.explode("roles").alias("r")).select("person_id", c("r.type").alias("chamber"), c("r.start_date").alias("start_date"), c("r.end_date").alias("end_date"))
    return people.current_legislators(roles, F.lit(TODAY), ["upper", "lower"]).groupBy("person_id", "chamber").agg(F.count(F.lit(1)).alias("n"))


@query("select distinct id, title from bill where (contains(upper(title), 'WATER') or contains(upper(coalesce(identifier, '')), 'WATER')) and (contains(upper(title), 'HB') or contains(upper(coalesce(identifier, '')), 'HB'))")
def browse_bills(t):
    return people.browse(t("bill"), "water hb", ["title", "identifier"]).select("id", "title").distinct()


@query("""with b as (select n_nationkey as k, n_regionkey as r, case when n_nationkey % 3 = 0 then 'NATION_' || (n_nationkey - 5) when n_nationkey % 3 = 1 then n_name end as parent, case when n_nationkey % 2 = 0 then 'upper' else 'lower' end as chamber from nation),
 o as (select n_regionkey as r, n_name as name, case n_nationkey % 4 when 0 then 'upper' when 1 then 'lower' end as chamber, n_nationkey as id from nation)
 select k, case when parent is not null then (select min(id) from o where o.r = b.r and o.name = b.parent) else (select min(id) from o where o.r = b.r and o.chamber = b.chamber) end as parent_id from b""")
def committee_parent(t):
    k, q = c("n_nationkey"), c("n_nationkey") % 4
    parent = F.when(k % 3 == 0, F.concat(F.lit("NATION_"), (k - 5).cast("string"))).when(k % 3 == 1, c("n_name"))
    bodies = t("nation").select(k.alias("k"), c("n_regionkey").alias("r"), parent.alias("parent"), F.when(k % 2 == 0, "upper").otherwise("lower").alias("chamber"))
    organizations = t("nation").select(c("n_regionkey").alias("r"), c("n_name").alias("name"), F.when(q == 0, "upper").when(q == 1, "lower").alias("chamber"), k.alias("id"))
    return resolve.parent_or_chamber(bodies, organizations, ["r"]).select("k", "parent_id")


@query("select l_orderkey, l_suppkey, s_name from (select distinct l_orderkey, l_suppkey from lineitem) left join supplier on s_suppkey = l_suppkey and s_acctbal > 0")
def committee_members(t):
    lists = t("lineitem").groupBy("l_orderkey").agg(F.collect_set("l_suppkey").alias("ids"))
    known = t("supplier").where("s_acctbal > 0").select(c("s_suppkey").alias("l_suppkey"), "s_name")
    return resolve.listed_members(lists, known, ["l_orderkey"], "ids", "l_suppkey").select("l_orderkey", "l_suppkey", "s_name")


@query("""with a as (select l_orderkey, l_linenumber as k, min(l_partkey) as v from lineitem where l_linenumber <= 4 group by all), b as (select l_orderkey, l_linenumber as k, max(l_partkey) as v from lineitem where l_linenumber >= 3 group by all),
 m as (select coalesce(a.l_orderkey, b.l_orderkey) as l_orderkey, coalesce(a.k, b.k) as k, coalesce(b.v, a.v) as v from a full join b on a.l_orderkey = b.l_orderkey and a.k = b.k)
 select l_orderkey, case when l_orderkey % 3 = 0 then ['status'] else [] end as conflict, string_agg(k || ':' || v, ',' order by k) as members from m where l_orderkey in (select l_orderkey from a) and l_orderkey in (select l_orderkey from b) group by 1, 2""")
def committee_merge(t):
    rows = t("lineitem").select("l_orderkey", c("l_linenumber").alias("k"), c("l_partkey").alias("v"))
    side = lambda when, f, status: rows.where(when).groupBy("l_orderkey", "k").agg(f("v").alias("v")).groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("k", "v"))).alias("members")).withColumn("status", status)
    old, new = side("k <= 4", F.min, F.lit("a")), side("k >= 3", F.max, F.when(c("l_orderkey") % 3 == 0, "b").otherwise("a"))
    got = people.merge_committees(old, new, ["l_orderkey"], ["status"], {"members": "k"})
    return got.select("l_orderkey", "conflict", F.array_join(F.transform("members", lambda x: F.concat_ws(":", x["k"], x["v"])), ",").alias("members"))


@query("with a as (select l_orderkey, list_sort(list(distinct l_suppkey)) as x, list_sort(list(distinct case when l_orderkey % 3 = 0 then l_suppkey + 1 else l_suppkey end)) as y from lineitem group by 1) select l_orderkey, x = y as same from a")
def member_set_diff(t):
    other = F.when(c("l_orderkey") % 3 == 0, c("l_suppkey") + 1).otherwise(c("l_suppkey"))
    return t("lineitem").groupBy("l_orderkey").agg(F.collect_list("l_suppkey").alias("x"), F.collect_list(other).alias("y")).select("l_orderkey", people.same_members(c("x"), c("y")).alias("same"))


@query("select id, identifier, regexp_replace(regexp_replace(upper(identifier), '(?s)^(.*?)([A-Z]*)[\\s\\x{a0}]*0*([-0-9]+)(.*)$', '\\1\\2 \\3\\4'), '^[\\s\\x{a0}]+|[\\s\\x{a0}]+$', '', 'g') as fixed from related_bill where not contains(identifier, ' ')")
def abnormal_identifiers(t):
    return resolve.abnormal(t("related_bill"), "identifier", S.fix_bill_id).select("id", "identifier", "fixed")


@query("""with s as (select n_nationkey as d, n_nationkey % 4 + 1 as seats from nation), v as (select s_nationkey as d, count(*) filter (s_acctbal >= 0) as v, count(*) filter (s_acctbal < 0) as e from supplier group by 1)
 select s.d, seats - coalesce(v, 0) as seats, coalesce(e, 0) as n_expired from s left join v using (d)""")
def seats_less_vacancies(t):
    seats = t("nation").select(c("n_nationkey").alias("d"), (c("n_nationkey") % 4 + 1).alias("seats"))
    vacant = t("supplier").select(c("s_nationkey").alias("d"), F.when(c("s_acctbal") >= 0, "2024-01-01").otherwise("2020-01-01").alias("vacant_until"))
    return quality.seats_left(seats, vacant, ["d"], F.lit(TODAY))


@query("""with o as (select office_id, coalesce(voice, '') as v, coalesce(fax, '') as f, coalesce(regexp_replace(regexp_replace(address, '\\s*\\n\\s*', ';', 'g'), '\\s+', ' ', 'g'), '') as a from scrape_office) select office_id, v as voice, f as fax, a as address from o where trim(v) <> '' or trim(f) <> '' or trim(a) <> ''""")
def process_offices(t):
    rows = t("scrape_office").select("office_id", F.array(F.struct(F.coalesce("voice", F.lit("")).alias("voice"), F.coalesce("fax", F.lit("")).alias("fax"), F.coalesce("address", F.lit("")).alias("address"))).alias("o"))
    return rows.select("office_id", F.explode(people.process_offices(c("o"), S.phone, S.address)).alias("o")).select("office_id", "o.*")


@query("select id, i - 1 as order_no, e.option, e.value from (select id, unnest(counts) as e, generate_subscripts(counts, 1) as i from (select distinct on (id) id, counts from vote_event order by id, created_at, len(counts)) )")
def child_rows(t):
    from billforge.sources.readers import with_order

    one = derive.latest(t("vote_event"), ["id"], [c("created_at"), F.size("counts")])
    return with_order(one, "counts", ["id"]).withColumnRenamed("order", "order_no")


# More validation


@query("""with m as (select s_nationkey as k, count(*) filter (s_acctbal > 8000) as n from supplier group by 1), x as (select n_name as name, case when n_nationkey % 3 = 0 then 'subcommittee' else 'committee' end as classification, case when n_nationkey % 2 = 0 then r_name end as parent, coalesce(n, 0) as n from nation join region on r_regionkey = n_regionkey left join m on k = n_nationkey)
 select name, list_filter([case when classification = 'subcommittee' and parent is null then 'parent: missing' end, case when classification = 'committee' and parent is not null then 'parent: of a committee' end, case when n < 1 then 'members: none' end], lambda e: e is not null) as errors from x""")
def lint_committee(t):
    members = t("supplier").groupBy(c("s_nationkey").alias("n_nationkey")).agg(F.count_if(c("s_acctbal") > 8000).alias("n_members"))
    k = c("n_nationkey")
    rows = t("nation").join(t("region"), c("n_regionkey") == c("r_regionkey")).join(members, "n_nationkey", "left")
    rows = rows.select(c("n_name").alias("name"), F.when(k % 3 == 0, "subcommittee").otherwise("committee").alias("classification"), F.when(k % 2 == 0, c("r_name")).alias("parent"), "n_members")
    return validate.check(rows, validate.committee_rules()).select("name", "errors")


@query("""select person_name, jurisdiction_id, field, value, count(*) as n from (select person_name, jurisdiction_id, 'address' as field, address as value from scrape_office union all select person_name, jurisdiction_id, 'name', name from scrape_office)
 where trim(coalesce(value, '')) <> '' group by all having count(*) > 1""")
def repeated_office_values(t):
    return validate.repeated_values(t("scrape_office"), ["person_name", "jurisdiction_id"], ["address", "name"])


@query("select distinct id from bill where jurisdiction_id not in (select jurisdiction_id from jurisdiction_zone where name < 'N')")
def jurisdiction_lint(t):
    return validate.unknown(t("bill"), t("jurisdiction_zone").where("name < 'N'"), "jurisdiction_id").select("id").distinct()


@query("select id, email, coalesce(regexp_matches(email, '^@|://|/'), false) as bad from person_snapshot where email is not null")
def handle_check(t):
    rows = t("person_snapshot").where("email is not null")
    return rows.select("id", "email", validate.handle_rule("email")[1].alias("bad"))
