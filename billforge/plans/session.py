"""More of the engine's own operators as queries: the report of a session, rosters, references and forms; each beside its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from billforge.functions import scalars as S
from billforge.operators import derive, hierarchy, people, quality, reconcile, resolve, validate
from billforge.plans.reference import PERSONS, TODAY, latest_persons, query
from billforge.sources import readers

c = F.col

# The quality report of a session: orders stand for bills, their lines for actions, sponsorships, versions and ballots.

_REPORT = """with b as (select o_orderkey as bill, year(o_orderdate) as session from orders),
 l as (select l_orderkey as bill, l_returnflag as flag, l_linenumber as n, s_name as name, s_suppkey % 3 = 0 as is_org, s_acctbal < 0 as lost from lineitem join supplier on s_suppkey = l_suppkey),
 v as (select bill as vote, session, bill % 3 as dy, bill % 2 as dn, bill % 7 = 0 as no_yes, bill % 11 = 0 as no_no from b where bill % 4 = 0),
 k as (select bill as vote, count(*) filter (flag = 'A') as y, count(*) filter (flag = 'N') as n, count(*) filter (flag = 'R') as o from l where n > 1 group by 1),
 s as (select session, count(*) as bills, count(*) filter (not exists (select 1 from l where l.bill = b.bill and flag = 'A')) as missing_actions, count(*) filter (not exists (select 1 from l where l.bill = b.bill and n <= 2)) as missing_sponsors, count(*) filter (not exists (select 1 from l where l.bill = b.bill and flag = 'N')) as missing_versions from b group by 1),
 w as (select session, count(*) as votes, count(*) filter (k.vote is null) as missing_voters, count(*) filter (no_yes) as missing_yes, count(*) filter (no_no) as missing_no,
  count(*) filter ((not no_yes and dy <> coalesce(y, 0)) or (not no_no and dn <> coalesce(n, 0)) or coalesce(o, 0) <> 0) as bad_counts from v left join k using (vote) group by 1),
 p as (select session, count(distinct name) filter (n <= 2 and not is_org and lost) as unmatched_people, count(distinct name) filter (n <= 2 and is_org and lost) as unmatched_organizations, count(distinct name) filter (n > 1 and lost and bill % 4 = 0) as unmatched_voters from b join l using (bill) group by 1)
 select s.*, coalesce(votes, 0) as votes, coalesce(missing_voters, 0) as missing_voters, coalesce(missing_yes, 0) as missing_yes, coalesce(missing_no, 0) as missing_no, coalesce(bad_counts, 0) as bad_counts, coalesce(unmatched_people, 0) as unmatched_people, coalesce(unmatched_organizations, 0) as unmatched_organizations, coalesce(unmatched_voters, 0) as unmatched_voters
 from s left join w using (session) left join p using (session)"""


@query(_REPORT)
def session_report(t):
    bills = t("orders").select(c("o_orderkey").alias("bill"), F.year("o_orderdate").alias("session"))
    lines = t("lineitem").join(t("supplier").select(c("s_suppkey").alias("l_suppkey"), c("s_name").alias("name"), (c("s_suppkey") % 3 == 0).alias("is_org"), (c("s_acctbal") < 0).alias("lost")), "l_suppkey")
    lines = lines.select(c("l_orderkey").alias("bill"), "l_returnflag", "l_linenumber", "name", "is_org", "lost")
    declared = lambda kind, n, missing: F.when(~missing, F.struct(F.lit(kind).alias("option"), n.cast("int").alias("value")))
    votes = bills.where(c("bill") % 4 == 0).select(c("bill").alias("vote"), "session", F.array_compact(F.array(declared("yes", c("bill") % 3, c("bill") % 7 == 0), declared("no", c("bill") % 2, c("bill") % 11 == 0))).alias("counts"))
    option = F.when(c("l_returnflag") == "A", "yes").when(c("l_returnflag") == "N", "no").otherwise("other")
    ballots = lines.where("l_linenumber > 1 and bill % 4 = 0").select(c("bill").alias("vote"), option.alias("option"), "name", (~c("lost")).alias("matched"))
    sponsors = lines.where("l_linenumber <= 2").select("bill", "name", F.when(c("is_org"), "organization").otherwise("person").alias("entity_type"), (~c("lost")).alias("matched"))
    children = {"actions": lines.where("l_returnflag = 'A'"), "sponsors": sponsors, "versions": lines.where("l_returnflag = 'N'")}
    return quality.session_report(bills, children, sponsors, votes, ballots, "bill", "vote", "session")


# People


@query(f"select id, name from {PERSONS} where (contains(upper(name), 'AR') or upper(family_name) = 'HOLT') and jurisdiction_id like '%/state:z%'")
def person_search_state(t):
    persons = latest_persons(t)
    found = people.search(persons, F.lit("ar"), state=c("jurisdiction_id").like("%/state:z%"), exact={"family_name": F.lit("Holt")})
    return found.select("id", "name")


@query(f"""with r as (select id, name, r.type, coalesce(r.district, '') as post, coalesce(r.start_date, '') as s, coalesce(r.end_date, '') as e from (select id, name, unnest(roles) as r from {PERSONS}))
 select distinct id as person_id from r where type = 'upper' and post = '5' and (s = '' or s <= '{TODAY}') and (e = '' or e >= '{TODAY}')""")
def member_of_post(t):
    rows = latest_persons(t).select(c("id").alias("person_id"), F.explode("roles").alias("r")).select("person_id", "r.*")
    return people.members_of(rows, c("type") == "upper", F.lit(TODAY), post=c("district") == "5")


@query(f"""with n as (select id, name, coalesce(given_name, '') as g, coalesce(family_name, '') as f, string_split_regex(trim(name), '\\s+') as w from {PERSONS})
 select id, name, case when len(w) = 2 and g = '' then w[1] else g end as given_name, case when len(w) = 2 and f = '' then w[2] else f end as family_name, len(w) = 2 and (g = '' or f = '') as fixed from n""")
def name_fix(t):
    return people.fix_names(latest_persons(t).select("id", "name", "given_name", "family_name")).select("id", "name", "given_name", "family_name", "fixed")


@query(f"""with p as (select id, name, email, given_name, family_name, list_filter(coalesce(roles, []), lambda r: coalesce(r.end_date, '') = '' or r.end_date > '{TODAY}') as a, coalesce(roles, []) as roles from {PERSONS}),
 e as (select id, 'error' as severity, 'roles: none active' as message from p where len(a) = 0 union all select id, 'error', 'roles: several active' from p where len(a) > 1
  union all select id, 'error', 'roles: no district' from p where len(list_filter(roles, lambda r: r.type in ('upper', 'lower') and coalesce(r.district, '') = '')) > 0
  union all select id, 'error', 'roles: executive without end' from p where len(list_filter(roles, lambda r: r.type not in ('upper', 'lower', 'legislature', 'mayor') and coalesce(r.end_date, '') = '')) > 0
  union all select id, 'warning', 'email: empty' from p where coalesce(trim(email), '') = ''
  union all select id, 'warning', 'name: no given or family name' from p where len(string_split_regex(trim(name), '\\s+')) = 2 and (coalesce(given_name, '') = '' or coalesce(family_name, '') = ''))
 select * from e""")
def person_lint_report(t):
    rules = {"error": validate.role_rules(F.lit(TODAY)), "warning": [validate.filled("email"), validate.name_rule()]}
    return validate.report(latest_persons(t), "id", rules)


# References


@query("""with e as (select event_id, jurisdiction_id as j, coalesce(name, '') as name, coalesce(description, '') as d, coalesce(start_date, '') as s, coalesce(end_date, '') as e, nullif(upstream_id, '') as u from scrape_event),
 x as (select j, u, min(event_id) as one, count(distinct event_id) as n from e where u is not null group by all), y as (select j, name, d, s, e, min(event_id) as one, count(distinct event_id) as n from e group by all)
 select distinct e.event_id, case when e.u is not null then 'upstream' else 'fields' end as kind, case when e.u is not null then case when x.n = 1 then x.one end when y.n = 1 then y.one end as resolved from e left join x on x.j = e.j and x.u = e.u left join y on y.j = e.j and y.name = e.name and y.d = e.d and y.s = e.s and y.e = e.e""")
def event_key_lookup(t):
    blank = lambda n: F.coalesce(n, F.lit("")).alias(n)
    fields = ["name", "description", "start_date", "end_date"]
    events = t("scrape_event").select("event_id", "jurisdiction_id", *(blank(f) for f in fields), F.nullif("upstream_id", F.lit("")).alias("upstream_id")).distinct()
    kinds = {"upstream": ["jurisdiction_id", "upstream_id"], "fields": ["jurisdiction_id", *fields]}
    return resolve.resolve_first_kind(events, events, kinds, "event_id", "event_id").select("event_id", "kind", "resolved").distinct()


@query("""with o as (select n_nationkey as org, n_name as name, [lower(n_name) || ' office', r_name] as others, n_regionkey as j from nation join region on r_regionkey = n_regionkey),
 r as (select c_custkey as ref, c_nationkey % 5 as j, case c_custkey % 3 when 0 then lower(n_name) when 1 then lower(n_name) || ' office' else r_name end as name from customer join nation on n_nationkey = c_nationkey join region on r_regionkey = n_regionkey),
 m as (select ref, count(distinct org) as n, min(org) as one from r join o on o.j = r.j and (upper(o.name) = upper(r.name) or list_contains(others, r.name)) group by 1)
 select ref, case when n = 1 then one end as organization from r left join m using (ref)""")
def organization_lookup(t):
    places = t("nation").join(t("region"), c("n_regionkey") == c("r_regionkey"))
    known = places.select(c("n_nationkey").alias("org"), c("n_name").alias("name"), F.array(F.concat(F.lower("n_name"), F.lit(" office")), c("r_name")).alias("others"), c("n_regionkey").alias("j"))
    k = c("c_custkey") % 3
    named = t("customer").join(places, c("c_nationkey") == c("n_nationkey"))
    refs = named.select(c("c_custkey").alias("ref"), (c("c_nationkey") % 5).alias("j"), F.when(k == 0, F.lower("n_name")).when(k == 1, F.concat(F.lower("n_name"), F.lit(" office"))).otherwise(c("r_name")).alias("name"))
    return resolve.resolve_named(refs, known, "ref", ["j"], "name", "others", "org").select("ref", c("resolved").alias("organization"))


@query("""select id, '~{"identifier": "' || replace(coalesce(identifier, ''), '"', '\\"') || '", "legislative_session": "' || coalesce(legislative_session, '') || '"}' as pseudo, identifier as again from related_bill where not regexp_matches(coalesce(identifier, '') || coalesce(legislative_session, ''), '[^ -~]|\\\\')""")
def pseudo_id_round_trip(t):
    rows = t("related_bill").where(~F.concat(F.coalesce("identifier", F.lit("")), F.coalesce("legislative_session", F.lit(""))).rlike(r"[^ -~]|\\"))
    made = S.make_pseudo_id({"legislative_session": F.coalesce("legislative_session", F.lit("")), "identifier": F.coalesce("identifier", F.lit(""))})
    return rows.select("id", made.alias("pseudo"), F.when(c("identifier").isNotNull(), S.pseudo_field(made, "identifier")).alias("again"))


@query("""with p as (select id, case when id like '%0' then organization end as organization, case when id not like '%1' then 'upper' end as classification from vote_event)
 select id, coalesce(organization, '') <> '' and classification is not null as both_given, case when coalesce(organization, '') <> '' and classification is not null then null when coalesce(organization, '') <> '' then organization when classification is not null then '~{"classification": "upper"}' else '~{"classification": "legislature"}' end as organization from p""")
def organization_or_chamber(t):
    rows = t("vote_event").select("id", F.when(c("id").like("%0"), c("organization")).alias("organization"), F.when(~c("id").like("%1"), "upper").alias("classification"))
    both = S.both_given(c("organization"), c("classification"))
    return rows.select("id", both.alias("both_given"), F.when(~both, S.pseudo_organization(c("organization"), c("classification"), F.lit("legislature"))).alias("organization"))


# Orders, hierarchy, forms


@query("select id, row_number() over (partition by jurisdiction_id, legislative_session order by start_date nulls first, id, created_at) as nth from (select distinct on (id) * from vote_event order by id, created_at, start_date)")
def votes_in_order(t):
    one = derive.latest(t("vote_event"), ["id"], [c("created_at"), c("start_date")])
    return derive.numbered(one, ["jurisdiction_id", "legislative_session"], [c("start_date"), c("id"), c("created_at")], "nth").select("id", "nth")


@query("with recursive tree(i, p) as (select p_partkey, case when p_partkey > 1 then p_partkey // 2 end from part), up(i, d) as (select i, 0 from tree where p is null union all select t.i, up.d + 1 from tree t join up on t.p = up.i) select i as id, d as pass from up")
def parents_first(t):
    k = c("p_partkey")
    tree = t("part").select(k.alias("id"), F.when(k > 1, F.floor(k / 2)).alias("parent"))
    return resolve.write_passes(tree, "id", "parent").select("id", "pass")


@query("select office_id, person_name, 'District Office #' || row_number() over (partition by jurisdiction_id, person_name order by office_id) as label from (select distinct office_id, jurisdiction_id, person_name from scrape_office where classification = 'district' and person_name is not null)")
def numbered_offices(t):
    rows = t("scrape_office").where("classification = 'district' and person_name is not null").select("office_id", "jurisdiction_id", "person_name").distinct()
    numbered = derive.numbered(rows, ["jurisdiction_id", "person_name"], [c("office_id")], "n")
    return numbered.select("office_id", "person_name", F.concat(F.lit("District Office #"), "n").alias("label"))


@query("""with s as (select r_name, unnest(case r_regionkey % 3 when 0 then list_transform(generate_series(1, r_regionkey + 2), lambda i: {'d': cast(i as varchar), 's': 1}) when 1 then [{'d': 'East Bay', 's': 1}, {'d': 'Mt. Olm & Fen', 's': 1}] else [{'d': 'A', 's': 2}, {'d': 'B', 's': 3}] end) as x from region)
 select r_name, x.d as district, cast(x.s as int) as seats, trim(regexp_replace(lower(x.d), '[^a-z0-9]+', '-', 'g'), '-') as slug from s""")
def seat_forms(t):
    k = c("r_regionkey") % 3
    rows = t("region").select("r_name", F.when(k == 0, c("r_regionkey") + 2).alias("n"), F.when(k == 1, F.array(F.lit("East Bay"), F.lit("Mt. Olm & Fen"))).alias("names"), F.when(k == 2, F.create_map(F.lit("A"), F.lit(2), F.lit("B"), F.lit(3))).alias("seats"))
    return hierarchy.seat_specs(rows, "n", "names", "seats").select("r_name", "district", "seats", S.slug(c("district")).alias("slug"))


@query(f"""with e as (select n_regionkey as j, 'upper' as chamber, cast(n_nationkey as varchar) as name, n_nationkey % 4 = 0 as legacy from nation), r as (select distinct id, r.type as chamber, coalesce(r.district, '') as district from (select id, unnest(roles) as r from {PERSONS}) where r.type in ('upper', 'lower'))
 select id, chamber, district, case when exists (select 1 from e where e.chamber = r.chamber and e.name = district and not legacy) then 'current' when exists (select 1 from e where e.chamber = r.chamber and e.name = district) then 'legacy' else 'unknown' end as status from r""")
def district_names(t):
    known = t("nation").select(F.lit("upper").alias("chamber"), c("n_nationkey").cast("string").alias("district"), (c("n_nationkey") % 4 == 0).alias("legacy"))
    roles = latest_persons(t).select("id", F.explode("roles").alias("r")).select("id", c("r.type").alias("chamber"), F.coalesce("r.district", F.lit("")).alias("district")).where("chamber in ('upper', 'lower')").distinct()
    return hierarchy.district_status(roles, known.where("not legacy"), known.where("legacy"), ["chamber", "district"])


@query("select distinct source_url, regexp_matches(source_url, '^(https?|ftp)://') as is_url, jurisdiction_id, regexp_matches(jurisdiction_id, '^ocd-jurisdiction/country:us(/(state|territory|district):[a-z]{2})?(/(county|place):[a-z_~-]+)*/(government|legislature)$') as is_place from bill_snapshot")
def link_forms(t):
    return t("bill_snapshot").select("source_url", c("source_url").rlike(S.URL).alias("is_url"), "jurisdiction_id", c("jurisdiction_id").rlike(S.JURISDICTION_ID).alias("is_place")).distinct()


@query("select event_id, regexp_replace(name, '^\\s+|\\s+$', '', 'g') as name, regexp_replace(description, '^\\s+|\\s+$', '', 'g') as description, list_transform([location_name, status], lambda x: regexp_replace(x, '^\\s+|\\s+$', '', 'g')) as both from (select event_id, '  ' || name as name, description || chr(10) as description, chr(9) || location_name as location_name, status from scrape_event)")
def stripped_deep(t):
    rows = t("scrape_event").select("event_id", F.concat(F.lit("  "), "name").alias("name"), F.concat("description", F.lit("\n")).alias("description"), F.array(F.concat(F.lit("\t"), "location_name"), "status").alias("both"))
    return readers.stripped(rows)


@query("select id, upper(regexp_replace(title, '[\\s\\x{a0}]+', ' ', 'g')) as title, left(latest_action_description, 5) as latest_action_description from bill")
def import_transformers(t):
    config = {"title": [S.collapse_whitespace, F.upper], "latest_action_description": lambda x: S.truncate(x, 5)}
    return readers.transformed(t("bill").select("id", "title", "latest_action_description"), config)


@query("select o_orderkey, o_custkey, o_orderstatus, o_totalprice from orders where o_orderstatus = 'P' order by o_orderdate desc, o_orderkey limit 100")
def browse_ordered(t) -> DataFrame:
    """The first hundred lines that a browser of the list shows."""
    return t("orders").where("o_orderstatus = 'P'").orderBy(F.desc("o_orderdate"), "o_orderkey").limit(100).select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")


# Nested records


_TWO = """with a as (select distinct on (id) * from vote_event order by id, created_at desc, dedupe_key desc, len(counts)), b as (select distinct on (id) * from vote_event where id not like '%3' order by id, created_at, dedupe_key, len(counts))"""


def _deliveries(t) -> tuple[DataFrame, DataFrame]:
    """Votes as last delivered, without those whose id ends in 5, and as first delivered, without those that end in 3."""
    k = [c("dedupe_key"), F.size("counts")]
    last = derive.latest(t("vote_event"), ["id"], [F.desc("created_at"), F.desc("dedupe_key"), k[1]])
    first = derive.latest(t("vote_event"), ["id"], [c("created_at"), *k])
    return last.where("id not like '%5'"), first.where("id not like '%3'")


@query(_TWO + """ select coalesce(a.id, b.id) as id, case when b.id is null then 'insert' when a.id is null then 'missing' when a.result is not distinct from b.result and a.motion_text is not distinct from b.motion_text and a.start_date is not distinct from b.start_date and coalesce(list_sort(a.counts), []) = coalesce(list_sort(b.counts), []) and coalesce(a.motion_classification, []) = coalesce(b.motion_classification, []) then 'noop' else 'update' end as action,
 case when a.id is null or b.id is null then [] else list_filter([case when a.result is distinct from b.result then 'result' end, case when a.motion_text is distinct from b.motion_text then 'motion_text' end, case when a.start_date is distinct from b.start_date then 'start_date' end, case when coalesce(list_sort(a.counts), []) <> coalesce(list_sort(b.counts), []) then 'counts' end, case when coalesce(a.motion_classification, []) <> coalesce(b.motion_classification, []) then 'motion_classification' end], lambda x: x is not null) end as changed
 from (select * from a where id not like '%5') a full join b on a.id = b.id""")
def import_votes(t):
    staged, current = _deliveries(t)
    return reconcile.nested_changes(staged, current, ["id"], ["result", "motion_text", "start_date"], {"counts": False, "motion_classification": True})


@query(_TWO + " select a.id, len(coalesce(a.counts, [])) <> len(coalesce(b.counts, [])) or len(list_filter(coalesce(b.counts, []), lambda x: not list_contains(coalesce(a.counts, []), x))) > 0 as recreate from (select * from a where id not like '%5') a join b on a.id = b.id")
def child_sync(t):
    staged, current = _deliveries(t)
    both = staged.select("id", c("counts").alias("n")).join(current.select("id", c("counts").alias("o")), "id")
    return both.select("id", reconcile.must_recreate(c("n"), c("o")).alias("recreate"))


@query(f"""with a as (select id, jurisdiction_id, list_filter(coalesce(roles, []), lambda r: coalesce(r.end_date, '') = '' or r.end_date > '{TODAY}') as r, list_filter(coalesce(party, []), lambda r: coalesce(r.end_date, '') = '' or r.end_date > '{TODAY}') as p from {PERSONS}),
 e as (select distinct id, jurisdiction_id, 'role' as kind, x.type as name, coalesce(x.district, '') as district from (select id, jurisdiction_id, unnest(r) as x from a) union select distinct id, jurisdiction_id, 'party', x.name, '' from (select id, jurisdiction_id, unnest(p) as x from a))
 select jurisdiction_id, kind, name, district, count(distinct id) as n from e group by all""")
def person_roster(t):
    return quality.roster(latest_persons(t), "id", ["jurisdiction_id"], F.lit(TODAY))


@query(f"""with p as (select id, coalesce(party, []) as party, case when id like '%0' then 'Union' when id like '%1' then null else list_last(party).name end as new from {PERSONS})
 select id, list_transform(case when len(party) = 0 then [{{'name': new, 'end': ''}}] when new is null or list_last(party).name is not distinct from new then list_transform(party, lambda x: {{'name': x.name, 'end': x.end_date}})
  else list_append(list_append(list_transform(party[1:len(party) - 1], lambda x: {{'name': x.name, 'end': x.end_date}}), {{'name': list_last(party).name, 'end': '{TODAY}'}}), {{'name': new, 'end': ''}}) end, lambda x: coalesce(x.name, '') || '|' || coalesce(x.end, '')) as parties from p""")
def party_merge(t):
    p = latest_persons(t).select("id", F.coalesce("party", F.array()).alias("party"))
    new = F.when(c("id").like("%0"), "Union").when(~c("id").like("%1"), F.get(F.transform("party", lambda x: x["name"]), F.size("party") - 1))
    merged = people.merge_parties(c("party"), new, F.lit(TODAY))
    return p.select("id", F.transform(merged, lambda x: F.concat(F.coalesce(x["name"], F.lit("")), F.lit("|"), F.coalesce(x["end_date"], F.lit("")))).alias("parties"))
