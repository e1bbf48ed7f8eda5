"""Queries over the shared test tables as they are."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Observation
from pyspark.sql import functions as F

from ..functions import prompts, text, trigram
from ..operators import fold, link, listing, sinks
from ..operators.extract import ordered_text
from ..operators.sinks import rollup
from ..sources import html, pages
from .base import query

NOISE_SQL = "(strlen({0}) < 4 or strlen({0}) > 150 or regexp_matches({0}, '^[0-9]') or contains({0}, 'I beg to move') or lower({0}) in (" + ", ".join(f"'{n}'" for n in text.NOISE_NAMES) + "))"


@query("select conv_id, role, count(*) as n, string_agg(text, chr(10) || chr(10) order by turn) as contributions_text from conversations group by conv_id, role")
def speaker_text(t):
    return t("conversations").groupBy("conv_id", "role").agg(F.count("*").alias("n"), ordered_text(["turn"], "text", "\n\n").alias("contributions_text"))


@query(f"select conv_id, turn, {NOISE_SQL.format('trim(role)')} as noise_role, {NOISE_SQL.format('trim(text)')} as noise_text from conversations")
def noise_filter(t):
    return t("conversations").select("conv_id", "turn", text.is_noise(F.col("role")).alias("noise_role"), text.is_noise(F.col("text")).alias("noise_text"))


def _titles():
    """Bill titles made of part names; built when asked for, as columns need a session."""
    return F.concat(F.element_at(F.array(*[F.lit(x) for x in [*text.STAGE_PREFIXES, ""]]), (F.col("p_partkey") % 20 + 1).cast("int")), F.lit("THE "), F.upper("p_name"), F.lit(" (AMENDMENT) BILL"))


TITLES_SQL = "list_extract([" + ", ".join("'" + p.replace("'", "''") + "'" for p in [*text.STAGE_PREFIXES, ""]) + "], p_partkey % 20 + 1) || 'THE ' || upper(p_name) || ' (AMENDMENT) BILL'"
TITLE_CASE_SQL = "array_to_string(list_transform(string_split({0}, ' '), lambda w: regexp_extract(w, '^[^A-Za-z]*') || upper(substr(w, length(regexp_extract(w, '^[^A-Za-z]*')) + 1, 1)) || lower(substr(w, length(regexp_extract(w, '^[^A-Za-z]*')) + 2))), ' ')"
STAGES_SQL = "case " + " ".join("when " + " or ".join("contains(u, '" + p.replace("'", "''") + "')" for p in parts) + f" then '{s}'" for s, parts in text.TITLE_STAGES) + " end"


@query(f"select p_partkey, {STAGES_SQL} as stage from (select p_partkey, {TITLES_SQL} as u from part)")
def stage_cascade(t):
    return t("part").select("p_partkey", text.stage_from_title(_titles()).alias("stage"))


@query("select conv_id, turn, case regexp_extract(x, '(?i)be read a (First|Second|Third) Time', 1) when '' then null else regexp_extract(x, '(?i)be read a (First|Second|Third) Time', 1) || ' Reading' end as stage from (select *, text || ' be read a ' || list_extract(['First', 'Second', 'Third', 'Next'], turn % 4 + 1) || ' Time' as x from conversations)")
def stage_text(t):
    kind = F.element_at(F.array(*map(F.lit, ["First", "Second", "Third", "Next"])), (F.col("turn") % 4 + 1).cast("int"))
    return t("conversations").select("conv_id", "turn", text.stage_from_text(F.concat("text", F.lit(" be read a "), kind, F.lit(" Time"))).alias("stage"))


@query(f"select p_partkey, {TITLE_CASE_SQL.format('(upper(p_name) || chr(32) || chr(40) || upper(p_type) || chr(41))')} as title from part")
def title_case(t):
    return t("part").select("p_partkey", text.title_case(F.concat(F.upper("p_name"), F.lit(" ("), F.upper("p_type"), F.lit(")"))).alias("title"))


PREFIX_SQL = "|".join(p.replace(".", r"\.").replace("'", "''") for p in text.STAGE_PREFIXES)


@query(f"select p_partkey, case when not contains(u, 'ADJOURNMENT OF DEBATE') then {TITLE_CASE_SQL.format('n')} end as bill from (select p_partkey, u, regexp_replace(regexp_replace(u, '^({PREFIX_SQL})', ''), '^THE ', '') as n from (select p_partkey, {TITLES_SQL} as u from part))")
def bill_name(t):
    return t("part").select("p_partkey", text.bill_name(_titles()).alias("bill"))


@query(r"""select c_custkey, regexp_replace(regexp_extract(said, '(?i)(National Assembly|Senate)\s+Bill\s+No\.?\s*\d+\s+of\s+\d{4}'), '\s+', ' ', 'g') as number, cast(regexp_extract(said, '(?i)Bill\s+No\.?\s*\d+\s+of\s+(\d{4})', 1) as int) as year
    from (select c_custkey, 'the Senate  Bill No. ' || c_custkey || ' of ' || (1990 + c_custkey % 40) || ' by ' || c_name as said from customer)""")
def bill_number(t):
    said = F.concat(F.lit("the Senate  Bill No. "), F.col("c_custkey").cast("string"), F.lit(" of "), (1990 + F.col("c_custkey") % 40).cast("string"), F.lit(" by "), F.col("c_name"))
    return t("customer").select("c_custkey", text.bill_number(said).alias("number"), text.bill_year(said).alias("year"))


def _listing_columns():
    return [F.col("o_orderdate").cast("date").alias("date"), F.concat(F.lit("/o/"), F.col("o_orderkey").cast("string")).alias("url"), F.when(F.col("o_orderkey") % 2 == 0, "Senate").otherwise("National Assembly").alias("house")]


CUT = dt.date(1998, 1, 1)
LISTED_SQL = "(select cast(o_orderdate as date) as date, '/o/' || o_orderkey as url, case when o_orderkey % 2 = 0 then 'Senate' else 'National Assembly' end as house from orders)"


def _listings(t):
    rows = t("orders").select(*_listing_columns())
    return rows.filter(F.col("date") < F.lit(CUT)), rows.filter(F.col("date") >= F.lit(CUT))


@query(f"select * from {LISTED_SQL} where date between date '1997-06-01' and date '1998-06-30' and house = 'Senate'")
def route_union(t):
    return listing.list_sittings(*_listings(t), listing.ListOptions(dt.date(1997, 6, 1), dt.date(1998, 6, 30), "Senate"), CUT)


@query("select event_id, event_type from events where ts between timestamp '2024-01-02' and timestamp '2024-01-20'")
def range_filter(t):
    at = lambda day: F.lit(f"2024-01-{day}").cast("timestamp_ntz")
    return listing.between(t("events"), at("02"), at("20"), "ts").select("event_id", "event_type")


@query("select o_orderkey, o_totalprice from orders order by o_orderdate desc, o_orderkey limit 20 offset 40")
def page_slice(t):
    return listing.ordered_slice(t("orders"), [F.desc("o_orderdate"), F.asc("o_orderkey")], 40, 20).select("o_orderkey", "o_totalprice")


@query("select o_orderkey, o_custkey from orders order by o_orderdate desc, o_orderkey limit 10")
def top_n_recent(t):
    return listing.ordered_slice(t("orders"), [F.desc("o_orderdate"), F.asc("o_orderkey")], None, 10).select("o_orderkey", "o_custkey")


@query("select c_custkey as url, c_name from customer c where not exists (select 1 from orders o where o.o_custkey = c.c_custkey and o_orderstatus = 'F')")
def skip_ingested(t):
    return listing.skip_ingested(t("customer").select(F.col("c_custkey").alias("url"), "c_name"), t("orders").filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("url")))


@query("with x as (select l_orderkey, string_agg(l_returnflag || l_linestatus, '+' order by l_linenumber, l_returnflag || l_linestatus) as said from lineitem group by 1) select o_custkey, string_agg(o_orderkey || ':' || coalesce(said, '-'), ' | ' order by o_orderdate, o_orderkey) as journey from orders left join x on o_orderkey = l_orderkey group by 1")
def journey_agg(t):
    x = t("lineitem").withColumn("f", F.concat("l_returnflag", "l_linestatus")).groupBy("l_orderkey").agg(ordered_text(["l_linenumber"], "f", "+").alias("said"))
    r = t("orders").join(x, F.col("o_orderkey") == F.col("l_orderkey"), "left").withColumn("part", F.concat(F.col("o_orderkey").cast("string"), F.lit(":"), F.coalesce("said", F.lit("-"))))
    return r.groupBy("o_custkey").agg(ordered_text(["o_orderdate", "o_orderkey"], "part", " | ").alias("journey"))


def _events(t):
    return t("events").withColumn("v", F.when(F.col("event_type") != "error", F.col("value")))


@query("select user_id, arg_max(v, (ts, event_id)) filter (v is not null) as v, arg_min(event_type, (ts, event_id)) as event_type from (select *, case when event_type <> 'error' then value end as v from events) group by 1")
def upsert_last_nonnull(t):
    return fold.fold(_events(t), ["user_id"], {"v": "coalesce", "event_type": "keep"}, ["ts", "event_id"])


@query("select user_id, event_type, arg_max(value, (ts, event_id)) as value, arg_max(props, (ts, event_id)) as props from events group by 1, 2")
def upsert_replace(t):
    return fold.fold(_events(t), ["user_id", "event_type"], {"value": "new", "props": "new"}, ["ts", "event_id"])


@query("select user_id, event_type, cast(sum(event_id) as bigint) as n from events group by 1, 2")
def upsert_add(t):
    return fold.fold(t("events").withColumn("n", F.col("event_id")), ["user_id", "event_type"], {"n": "add"}, ["ts", "event_id"])


@query("select speaker_id, count(*) as refs from (select l_suppkey as speaker_id from lineitem union all select s_suppkey from supplier) group by 1")
def ref_counts(t):
    return link.ref_counts(t("lineitem").select(F.col("l_suppkey").alias("speaker_id")), t("supplier").select(F.col("s_suppkey").alias("speaker_id")))


def _speakers(t):
    return t("orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("name"), F.when(F.col("o_custkey") % 3 > 0, F.col("o_custkey").cast("string")).alias("url"))


CANON_SQL = "with s as (select o_orderkey as id, o_orderpriority as name, case when o_custkey % 3 > 0 then cast(o_custkey as varchar) end as url from orders), r as (select l_orderkey as id, count(*) as refs from lineitem group by 1), c as (select s.id, first_value(s.id) over (partition by url is null, coalesce(url, name) order by case when url is not null then -coalesce(refs, 0) else 0 end, s.id) as keep from s left join r on s.id = r.id)"


@query(f"{CANON_SQL} select id, keep from c")
def canonical_speakers(t):
    return link.canonical(_speakers(t), t("lineitem").select(F.col("l_orderkey").alias("speaker_id")))


@query(f"{CANON_SQL} select l_suppkey, keep as speaker_id, cast(sum(l_linenumber) as bigint) as speech_count from lineitem join c on l_orderkey = c.id group by 1, 2")
def merge_dedupe(t):
    rows = t("lineitem").select("l_suppkey", F.col("l_orderkey").alias("speaker_id"), F.col("l_linenumber").cast("long").alias("speech_count"))
    return link.merge_counts(rows, canonical_speakers(t), ["l_suppkey"])


@query("select c_custkey as name, cast(c_custkey as varchar) as url, cast(s_suppkey as varchar) as member_url from customer left join supplier on c_custkey = s_suppkey")
def link_by_key(t):
    s = t("customer").select(F.col("c_custkey").alias("name"), F.col("c_custkey").cast("string").alias("url"), F.lit(None).cast("string").alias("member_url"))
    return link.by_url(s, t("supplier").select(F.col("s_suppkey").cast("string").alias("url")))


TRI_SQL = "list_distinct(flatten(list_transform(list_filter(regexp_split_to_array(lower({0}), '[^a-z0-9]+'), lambda w: w <> ''), lambda w: list_transform(range(1, length(w) + 2), lambda i: substr('  ' || w || ' ', i, 3)))))"


@query(f"with n as (select distinct p_name as a, {TRI_SQL.format('p_name')} as ta from part), m as (select distinct p_name as b, {TRI_SQL.format('p_name')} as tb from part) select a, b, round(len(list_intersect(ta, tb)) / len(list_distinct(list_concat(ta, tb))), 6) as score from n, m where a < b and len(list_intersect(ta, tb)) / len(list_distinct(list_concat(ta, tb))) >= 0.4")
def similarity_pairs(t):
    return trigram.similar_pairs(t("part"), "p_name", 0.4).withColumn("score", F.round("score", 6))


@query(r"""select c_custkey, regexp_replace(regexp_replace(regexp_replace(regexp_replace(said, '(?i)\b(Hon|Sen|Mrs|Mr|Ms|Madam|Mhe)\.?\s*', '', 'g'), '(?i)\(?(Dr|Prof|Eng|Rtd|Ret|SC|EGH|CBS|OGW|MBS|EBS|HSC|OBS|Capt|Maj|Col|Gen|Lt|Cdr)\.?\)?\s*', '', 'g'), '\s*\([^)]*\)\s*$', ''), '[:);,]+\s*$', '') as name
    from (select c_custkey, list_extract(['Hon. (Dr.) Kamau ' || c_custkey || ' (Molo, UDA)', 'Sen. Wanjiru ' || c_custkey || ':', 'Mhe. Eng. Otieno ' || c_custkey || ' EGH', 'Cherono ' || c_custkey], c_custkey % 4 + 1) as said from customer)""")
def clean_name(t):
    key = F.col("c_custkey").cast("string")
    shapes = [F.concat(F.lit("Hon. (Dr.) Kamau "), key, F.lit(" (Molo, UDA)")), F.concat(F.lit("Sen. Wanjiru "), key, F.lit(":")), F.concat(F.lit("Mhe. Eng. Otieno "), key, F.lit(" EGH")), F.concat(F.lit("Cherono "), key)]
    return t("customer").select("c_custkey", text.clean_name(F.element_at(F.array(*shapes), (F.col("c_custkey") % 4 + 1).cast("int"))).alias("name"))


@query("select event_id, cast(json_extract(props, '$.k') as bigint) as k from events where json_extract(props, '$.k') is not null")
def json_props(t):
    return t("events").select("event_id", F.from_json("props", "k long")["k"].alias("k")).filter("k is not null")


def _records(t):
    """The properties of events as a client sends them: some cut off, some of another type, some in lists of two."""
    k = F.col("event_id") % 10
    props = F.when(k == 1, F.substring("props", F.lit(1), F.length("props") - 1)).when(k == 2, '{"k": "many"}').when(k == 3, F.concat(F.lit("["), "props", F.lit(", "), "props", F.lit("]"))).when(k == 4, "7").otherwise(F.col("props"))
    return t("events").select(props.alias("props"))


GOOD = "(select cast(json_extract(props, '$.k') as bigint) as k, unnest(case when event_id % 10 = 3 then [1, 2] else [1] end) as copy from events where event_id % 10 not in (1, 2, 4))"


@query(f"select k, count(*) as n from {GOOD} group by k")
def json_rejects(t):
    """Records of a declared schema; those that have another type, or are none, are dropped."""
    return sinks.frame(_records(t), "props", "k long").groupBy("k").agg(F.count("*").alias("n"))


@query(f"select k, count(*) as n, (select count(*) from {GOOD}) as decoded, (select count(*) from events where event_id % 10 in (1, 2, 4)) as rejected from {GOOD} group by k")
def json_reject_counts(t):
    """The same, with the counts that the one write of the records observes."""
    spark, told = t("events").sparkSession, Observation()
    path = sinks.scratch(spark) + "/records"
    sinks.frame(_records(t), "props", "k long", told).write.parquet(path)
    return spark.read.parquet(path).groupBy("k").agg(F.count("*").alias("n")).withColumns({c: F.lit(told.get[c]).cast("long") for c in ("decoded", "rejected")})


@query("select event_type, sum(cast(json_extract(props, '$.k') as bigint)) as k from events group by event_type")
def json_inferred(t):
    """Records without a declared schema: it is inferred from all of them."""
    rows = t("events").select(F.to_json(F.struct("event_type", F.from_json("props", "k long")["k"].alias("k"))).alias("j"))
    return sinks.frame(rows, "j").groupBy("event_type").agg(F.sum("k").alias("k"))


@query(r"""select o_orderkey, cast(strptime(regexp_replace(regexp_extract(shown, '\d+\w* \w+ \d{4}'), 'th', ''), '%-d %B %Y') as date) as date, regexp_extract(shown, '^\w+') as day_of_week, regexp_extract(shown, ' - (.+)$', 1) as session_type
    from (select o_orderkey, strftime(o_orderdate, '%A, %-dth %B %Y - Afternoon Sitting') as shown from orders)""")
def date_title(t):
    shown = F.concat(F.date_format("o_orderdate", "EEEE, d"), F.lit("th "), F.date_format("o_orderdate", "MMMM yyyy"), F.lit(" - Afternoon Sitting"))
    return t("orders").select("o_orderkey", text.title_date(shown).alias("x")).select("o_orderkey", "x.*")


@query(r"""select o_orderkey, cast(strptime(replace(parts[2], 'th', '') || ' ' || upper(parts[3][1]) || parts[3][2:] || ' ' || parts[4], '%-d %B %Y') as date) as date, array_to_string(list_transform(list_filter(parts[5:], lambda w: not regexp_matches(w, '^\d+$')), lambda w: upper(w[1]) || w[2:]), ' ') as session_type
    from (select o_orderkey, string_split(regexp_extract('/s/' || lower(strftime(o_orderdate, '%A-%-dth-%B-%Y')) || '-morning-sitting-' || o_orderkey || '/', '([^/]+)/$', 1), '-') as parts from orders)""")
def date_slug(t):
    slug = F.concat(F.lit("/s/"), F.lower(F.date_format("o_orderdate", "EEEE-d")), F.lit("th-"), F.lower(F.date_format("o_orderdate", "MMMM-yyyy")), F.lit("-morning-sitting-"), F.col("o_orderkey").cast("string"), F.lit("/"))
    return t("orders").select("o_orderkey", text.slug_date(slug).alias("x")).select("o_orderkey", "x.date", "x.session_type")


@query("select event_id, strftime(date_trunc('minute', ts), '%H:%M:%S') as time from events")
def time_12h(t):
    return t("events").select("event_id", text.time_12h(F.date_format("ts", "h:mm a")).alias("time"))


@query("""select page_id, unnest(regexp_extract_all(html, '<a [^>]*href="([^"]*)"', 1)) as href from pages""")
def html_links(t):
    return pages.parse(t("pages").select(F.col("page_id").cast("string").alias("url"), "html"), html.links, "href string, label string").select(F.col("page_url").cast("long").alias("page_id"), "href")


@query("select page_id, replace(replace(replace(replace(regexp_extract(html, '<title>(.*?)</title>', 1), '&lt;', '<'), '&gt;', '>'), '&quot;', chr(34)), '&amp;', '&') as title from pages")
def html_title(t):
    return pages.parse(t("pages").select(F.col("page_id").cast("string").alias("url"), "html"), html.title, "title string").select(F.col("page_url").cast("long").alias("page_id"), "title")


@query()
def html_paragraphs(t):
    found = pages.parse(t("pages").select(F.col("page_id").cast("string").alias("url"), "html"), lambda h: [{"n": i, "text": p.clean()} for i, p in enumerate(html.tree(h).find("p"))], "n int, text string")
    return found.select(F.col("page_url").cast("long").alias("page_id"), "n", "text")


@query("select page_id, case when ends_with(trim(url), '/') then trim(url) else trim(url) || '/' end as member_url, regexp_replace(url, '/+$', '') as url from pages")
def url_normalise(t):
    return t("pages").select("page_id", text.member_url(F.col("url")).alias("member_url"), text.normal_url(F.col("url")).alias("url"))


@query(r"""select doc_id, nullif(trim(regexp_extract(box, '^Hansard Summary(.*)Sentimental Analysis', 1, 's')), '') as summary, nullif(trim(regexp_extract(box, 'Sentimental Analysis(.*)$', 1, 's')), '') as sentiment
    from (select doc_id, regexp_replace('Hansard Summary  Source ' || source || chr(10) || 'Sentimental Analysis  ' || lang, '\s+', ' ', 'g') as box from documents)""")
def doc_summary_split(t):
    box = F.concat(F.lit("Hansard Summary  Source "), "source", F.lit("\nSentimental Analysis  "), "lang")
    return t("documents").select("doc_id", text.summary_parts(box).alias("x")).select("doc_id", "x.*")


@query("select doc_id, source || ' — 2024-01-01 — ' || lang || chr(10) || chr(10) || coalesce(case when doc_id % 2 = 0 then 'short' end, 'a' || chr(10) || lang) as text from documents")
def sitting_text(t):
    return t("documents").select("doc_id", prompts.sitting_text(F.col("source"), F.lit("2024-01-01"), F.col("lang"), F.when(F.col("doc_id") % 2 == 0, "short"), F.array(F.lit("a"), "lang")).alias("text"))


TRANSCRIPT_SQL = "string_agg('[' || role || ']: ' || trim(text, ' ') || chr(10), '' order by turn) filter (trim(text, ' ') <> '')"


def _sections(t):
    c = F.struct(F.col("role").alias("speaker_name"), F.lit(None).cast("string").alias("speaker_role"), F.lit(None).cast("string").alias("speaker_url"), F.col("text").alias("content"), F.array().cast("array<string>").alias("procedural_notes"))
    rows = t("conversations").groupBy("conv_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("turn", c.alias("c")))), lambda x: x["c"]).alias("c"))
    return rows.select("conv_id", F.array(F.struct(F.lit("STATEMENTS").alias("section_type"), F.array().cast("array<struct<title:string,contributions:array<struct<speaker_name:string,speaker_role:string,speaker_url:string,content:string,procedural_notes:array<string>>>>>").alias("subsections"), F.col("c").alias("contributions"))).alias("sections"))


@query(f"select conv_id, chr(10) || '## STATEMENTS' || chr(10) || coalesce({TRANSCRIPT_SQL}, '') as transcript from conversations group by 1")
def transcript_text(t):
    return _sections(t).select("conv_id", prompts.transcript(F.col("sections")).alias("transcript"))


@query("select conv_id, turn, 'Summarise what this member said.' || chr(10) || 'Member: ' || role || chr(10) || 'Topic: talk' || chr(10) || 'House: Senate' || chr(10) || 'Date: 2024-01-01' || chr(10) || case when turn % 2 = 0 then 'Stage: s' || chr(10) else '' end || chr(10) || text as prompt from conversations")
def prompt_render(t):
    return t("conversations").select("conv_id", "turn", prompts.contribution("Topic", F.col("role"), F.lit("talk"), F.lit("Senate"), F.lit("2024-01-01"), F.when(F.col("turn") % 2 == 0, "s"), F.col("text")).alias("prompt"))


@query("select cast(sum(case when o_orderstatus = 'F' then 1 else 0 end) as bigint) as ingested, cast(sum(case when o_orderstatus = 'O' then 1 else 0 end) as bigint) as failed from orders")
def ingest_stats(t):
    return fold.stats(t("orders").select((F.col("o_orderstatus") == "F").alias("ingested"), (F.col("o_orderstatus") == "O").alias("failed")), ["ingested", "failed"])


@query("select event_type as name, cast(user_id % 5 as varchar) as labels, cast(sum(event_id) filter (event_type <> 'view') as bigint) as counter, arg_max(event_id, (ts, event_id)) filter (event_type = 'view') as gauge from events group by 1, 2")
def metric_rollup(t):
    e = t("events").select(F.col("event_type").alias("name"), (F.col("user_id") % 5).cast("string").alias("labels"), F.when(F.col("event_type") == "view", "gauge").otherwise("counter").alias("kind"), F.col("event_id").alias("value"), F.struct("ts", "event_id").alias("ts"))
    return rollup(e)


@query("select l_orderkey, l_linenumber from lineitem where exists (select 1 from orders where o_orderkey = l_orderkey and o_orderstatus = 'O')")
def cascade_delete(t):
    return fold.cascade(t("lineitem"), t("orders").filter("o_orderstatus = 'O'"), "l_orderkey", "o_orderkey").select("l_orderkey", "l_linenumber")


@query("select o_orderkey, case when exists (select 1 from customer where c_custkey = o_custkey and c_acctbal > 0) then o_custkey end as o_custkey from orders")
def delete_set_null(t):
    return fold.set_null(t("orders").select("o_orderkey", "o_custkey"), t("customer").filter("c_acctbal > 0"), "o_custkey", "c_custkey")


@query("select s_suppkey, coalesce(case when s_suppkey % 2 = 0 then 'new' end, s_name) as s_name from supplier")
def enrich_rows(t):
    new = t("supplier").select("s_suppkey", F.when(F.col("s_suppkey") % 2 == 0, "new").alias("s_name"))
    return fold.enrich(t("supplier").select("s_suppkey", "s_name"), new, "s_suppkey", ["s_name"])
