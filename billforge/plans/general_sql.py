"""The same results as the queries of problems 1 to 3, in SQL that DuckDB runs."""

_BLANKS = r"[\s\x{85}\x{a0}\x{1680}\x{180e}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{feff}]+"


def _fold(x: str) -> str:
    return f"trim(lower(nfc_normalize(regexp_replace(coalesce({x}, ''), '{_BLANKS}', ' ', 'g'))))"


def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^{_BLANKS}|{_BLANKS}$', '', 'g')"


def _session(x: str) -> str:
    return f"lower({_strip(f"coalesce({x}, '')")})"


def _bill(x: str) -> str:
    return f"trim(regexp_replace(upper(coalesce({x}, '')), '[^A-Z]', '', 'g') || ' ' || regexp_replace(regexp_extract(coalesce({x}, ''), '[0-9]+'), '^0+([0-9])', '\\1'))"


def _set(x: str, e: str) -> str:
    return f"array_to_string(list_sort(list_distinct(list_filter(list_transform(coalesce({x}, []), lambda e: {e}), lambda e: replace(e, '|', '') <> ''))), '#')"


_PARTY = "||'|'||".join(_fold(f"e.{f}") for f in ("name", "start_date", "end_date"))
_ROLES = "||'|'||".join(_fold(f"e.{f}") if f != "district" else f"regexp_replace({_fold('e.district')}, '^0+([0-9a-z])', '\\1')" for f in ("type", "jurisdiction", "district", "start_date", "end_date", "end_reason"))
_PERSONS = f"""
with c as (
  select id, snapshot_date, {_set("party", _PARTY)} party, {_set("roles", _ROLES)} roles
  from (select *, row_number() over (partition by id, snapshot_date order by delivered_at desc) k from person_snapshot) where k = 1),
d as (select snapshot_date, row_number() over (order by snapshot_date) n, lead(snapshot_date) over (order by snapshot_date) next_date from (select distinct snapshot_date from person_snapshot)),
s as (select *, lag(n) over w n0, lead(n) over w n1, lag(party) over w party0, lag(roles) over w roles0 from c join d using (snapshot_date) window w as (partition by id order by n))
"""
_BILL_CONTENT = ", ".join([_fold("title"), _fold("from_organization"), _fold("latest_action_description"), _set("classification", _fold("e")), _set("subject", _fold("e"))])

_REFERENCES = f"""
with b as (
  select lower({_strip("id")}) bid, deleted, created_at, lower({_strip("jurisdiction_id")}) j, {_session("legislative_session")} s, {_bill("identifier")} i
  from (select *, row_number() over (partition by id order by updated_at desc) k from bill) where k = 1),
r as (
  select 'vote_event' table_name, 'bill_id' field_name, id row_id, created_at, case when bill_id not like '~%' then lower({_strip("bill_id")}) end rid,
    lower({_strip("jurisdiction_id")}) j, {_session("legislative_session")} s, case when bill_id like '~%' then {_bill("json_extract_string(substr(bill_id, 2), '$.identifier')")} end i
  from vote_event where {_strip("coalesce(bill_id, '')")} <> ''
  union all select 'related_bill', 'related_bill', id, created_at, lower({_strip("related_bill")}), null, null, null from related_bill where {_strip("coalesce(related_bill, '')")} <> ''
  union all select 'related_bill', 'identifier', r.id, r.created_at, null, b.j, {_session("r.legislative_session")}, {_bill("r.identifier")}
  from related_bill r left join b on b.bid = lower({_strip("r.bill_id")}) where {_strip("coalesce(r.identifier, '')")} <> ''),
m as (
  select r.*, case when b.bid is null then 'missing' when b.deleted then 'deleted' when b.created_at > r.created_at then 'late' end reason from r join b on r.rid = b.bid
  union all select r.*, case when b.deleted then 'deleted' when b.created_at > r.created_at then 'late' end from r join b on r.rid is null and r.j = b.j and r.s = b.s and r.i = b.i
  union all select r.*, 'missing' from r where not exists (select 1 from b where r.rid = b.bid) and not exists (select 1 from b where r.rid is null and r.j = b.j and r.s = b.s and r.i = b.i))
"""
_PERIOD = "strftime(created_at at time zone 'UTC', '%Y-%m')"

_SATELLITES = (
    _PERSONS
    + """
, p as (
  select id, 'status' satellite, snapshot_date since, true present, null::varchar as attrs from s where n0 is null or n0 <> n - 1
  union all select id, 'status', next_date, false, null from s where next_date is not null and (n1 is null or n1 <> n + 1)
  union all select id, 'party', snapshot_date, true, party from s where party0 is null or party <> party0
  union all select id, 'roles', snapshot_date, true, roles from s where roles0 is null or roles <> roles0)
select id person_id, satellite, since valid_from, coalesce(lead(since) over (partition by id, satellite order by since), '') valid_to, present, list_sort(list_filter(string_split(attrs, '#'), lambda x: x <> '')) attributes from p"""
)

SQL = {
    "p1_found": _PERSONS
    + """
, r as (select *, sum(case when n0 = n - 1 and party = party0 and roles = roles0 then 0 else 1 end) over (partition by id order by n) run from s)
select id person_id, min(snapshot_date) valid_from, coalesce(arg_max_null(next_date, n), '') valid_to from r group by id, run""",
    "p1_satellites": _SATELLITES,
    "p1_appended": _SATELLITES,
    "p2_found": _REFERENCES + f"select distinct table_name, field_name, row_id, {_PERIOD} period from m where reason is not null",
    "p2_report": _REFERENCES + f"select table_name, field_name, {_PERIOD} period, reason, count(*) n_references from m where reason is not null group by all",
    "p3_found": f"""
with c as (
  select jurisdiction_id j, {_session("legislative_session")} s, {_bill("identifier")} i, snapshot_date d, concat_ws('@', {_BILL_CONTENT}) h, row_number() over (partition by j, s, i, d order by scraped_at desc) k
  from bill_snapshot qualify k = 1),
cal as (select *, lead(d) over (partition by j order by d) e, row_number() over (partition by j order by d) n from (select distinct jurisdiction_id j, snapshot_date d from bill_snapshot))
select c.j jurisdiction_id, c.s legislative_session, c.i identifier, c.d snapshot_date, 'added' change_kind from c join cal using (j, d)
  where n > 1 and not exists (select 1 from c o join cal p on o.j = p.j and o.d = p.d where o.j = c.j and o.s = c.s and o.i = c.i and p.e = c.d)
union all select c.j, c.s, c.i, cal.e, 'removed' from c join cal using (j, d) where cal.e is not null and not exists (select 1 from c o where o.j = c.j and o.s = c.s and o.i = c.i and o.d = cal.e)
union all select c.j, c.s, c.i, cal.e, 'changed' from c join cal using (j, d) join c o on o.j = c.j and o.s = c.s and o.i = c.i and o.d = cal.e where o.h <> c.h""",
}
