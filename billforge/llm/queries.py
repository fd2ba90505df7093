"""The queries of problems 5 to 10."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from billforge.llm import address, leak, mixing, neardup, scanned, toxic
from billforge.session import read


def _scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "searchable_bill").select(F.col("sb_id").alias("id"), F.col("raw_text").alias("text"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scanned.line_defects(_scans(spark, sf_dir)).withColumnRenamed("id", "sb_id").distinct()


def p5_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The repaired texts as continuous paragraphs."""
    return scanned.repaired(_scans(spark, sf_dir)).withColumnRenamed("id", "sb_id").distinct()


def _offices(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, dict[str, str]]:
    places = read(spark, sf_dir, "jurisdiction_zone").select("jurisdiction_id", "name").where("name is not null").collect()  # a row per jurisdiction, a fixed table
    regions = {}
    for place, name in places:
        code = place.rsplit(":", 1)[-1].split("/")[0].lower()
        regions |= {code: code, name.lower(): code}
    return read(spark, sf_dir, "scrape_office").select(F.col("office_id").alias("id"), "address"), regions


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return address.same_location(*_offices(spark, sf_dir)).toDF("office_id_1", "office_id_2")


def p6_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each office with an address, its class of equal addresses and its number of links."""
    return address.location_groups(*_offices(spark, sf_dir)).toDF("office_id", "class_id", "n_links")


def _bill_texts(spark: SparkSession, sf_dir: str) -> dict:
    rows = read(spark, sf_dir, "searchable_bill").select("sb_id", "created_at", "all_titles", "raw_text").where("raw_text is not null and raw_text <> ''")
    return {"records": rows, "key": F.col("sb_id"), "made": F.col("created_at"), "text": F.concat_ws(" ", F.coalesce("all_titles", F.lit("")), "raw_text"), "width": 3, "threshold": 0.7}


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.similar_pairs(**_bill_texts(spark, sf_dir)).toDF("sb_id_1", "sb_id_2")


def p7_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each record with its class of copies, its group and its number of links."""
    return neardup.similar_groups(**_bill_texts(spark, sf_dir)).withColumnRenamed("id", "sb_id")


def _leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leak.leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "eval_item"))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _leaks(spark, sf_dir).select("doc_id", "item_id").distinct()


def p8_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaked items by suite: in how many documents, and their longest passage."""
    items = read(spark, sf_dir, "eval_item").select("item_id", "suite")
    found = _leaks(spark, sf_dir).groupBy("item_id").agg(F.countDistinct("doc_id").alias("n_documents"), F.max("n_words").alias("longest"))
    return items.join(found, "item_id").select("item_id", "suite", "n_documents", "longest")


def p9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each document is used."""
    return mixing.mix(read(spark, sf_dir, "documents"), read(spark, sf_dir, "source_target"))


def p9_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target and actual share of each source."""
    return mixing.shares(p9_mix(spark, sf_dir), read(spark, sf_dir, "source_target"))


def p10_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxic.score(read(spark, sf_dir, "documents"), read(spark, sf_dir, "review_sample"))


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p10_scores(spark, sf_dir).where("flagged").select("doc_id").distinct()


def p10_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents flagged and their rate per source."""
    rows = toxic.score(read(spark, sf_dir, "documents"), read(spark, sf_dir, "review_sample"), keep=["source"])
    flagged = F.sum(F.col("flagged").cast("int"))
    return rows.groupBy("source").agg(F.count(F.lit(1)).alias("n_documents"), flagged.alias("n_flagged"), (flagged / F.count(F.lit(1))).alias("rate"))


QUERIES = {"p9_mix": p9_mix, "p9_report": p9_report, "p5_found": p5_found, "p5_paragraphs": p5_paragraphs, "p10_found": p10_found, "p10_scores": p10_scores, "p10_report": p10_report, "p6_found": p6_found, "p6_groups": p6_groups, "p7_found": p7_found, "p7_groups": p7_groups, "p8_found": p8_found, "p8_report": p8_report}
_LETTERS = "regexp_replace(lower(strip_accents(regexp_replace({0}, '<[a-zA-Z/!?][^<>]*>', {1}, 'g'))), '[^a-z0-9]+', {1}, 'g')"

_SHINGLES = """
with recursive r as (select sb_id, arg_max(coalesce(all_titles, '') || ' ' || raw_text, created_at) as t from searchable_bill where raw_text <> '' group by 1),
w as (select sb_id, list_filter(string_split_regex(lower(t), '[^a-z0-9]+'), lambda x: x <> '') as w from r)"""

SQL: dict[str, str] = {
    "p7_groups": _SHINGLES
    + """,
k as (select min(sb_id) as c, w from w group by w),
s as (select distinct c, unnest(list_transform(generate_series(1, len(w) - 2), lambda i: hash(w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))) as x from k),
n as (select c, count(*) as n from s group by 1),
l as (select a.c as i, b.c as j, count(*) as common from s a join s b on a.x = b.x and a.c < b.c group by all),
h as (select i, j from l join n a on a.c = i join n b on b.c = j where 10 * common >= 7 * (a.n + b.n - common)),
e as (select i, j from h union all select j, i from h),
z as (select i, j from e union select z.i, e.j from z join e on e.i = z.j),
g as (select i, least(i, min(j)) as g from z group by 1),
d as (select i, count(*) as n from e group by 1)
select sb_id, k.c as class_id, coalesce(g.g, k.c) as group_id, coalesce(d.n, 0) as n_links from w join k using (w) left join g on g.i = k.c left join d on d.i = k.c""",
    "p7_found": """
with r as (select sb_id, arg_max(coalesce(all_titles, '') || ' ' || raw_text, created_at) as t from searchable_bill where raw_text <> '' group by 1),
w as (select sb_id, list_filter(string_split_regex(lower(t), '[^a-z0-9]+'), lambda x: x <> '') as w from r),
s as (select distinct sb_id, unnest(list_transform(generate_series(1, len(w) - 2), lambda i: hash(w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))) as x from w),
n as (select sb_id, count(*) as n from s group by 1),
c as (select a.sb_id as i, b.sb_id as j, count(*) as common from s a join s b on a.x = b.x and a.sb_id < b.sb_id group by all)
select i as sb_id_1, j as sb_id_2 from c join n a on a.sb_id = i join n b on b.sb_id = j where 10 * common >= 7 * (a.n + b.n - common)""",
    "p8_found": f"""
with d as (select doc_id, {_LETTERS.format("text", "''")} as t from documents),
w as (select item_id, list_filter(list_transform(string_split_regex(text, '\\s+'), lambda x: {_LETTERS.format("x", "''")}), lambda x: x <> '') as w from eval_item),
p as (select item_id, unnest(list_transform(generate_series(1, len(w) - 9), lambda i: array_to_string(w[i : i + 9], ''))) as x from w)
select distinct doc_id, item_id from d join p on contains(d.t, p.x)""",
}
