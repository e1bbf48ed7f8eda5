"""Queries over pages made from the test tables, parsed by the page sources; their SQL reads the same tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..operators import fold, sinks
from ..sources import page_source, pages
from . import ingest
from .model_queries import spoken
from .base import query


def _html(*parts) -> Column:
    """Parts of a page: texts as they stand, columns as text (null: nothing)."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else F.coalesce(p.cast("string"), F.lit("")) for p in parts])


def _joined(order: str, part: Column) -> Column:
    """An aggregate: parts in order, as one text."""
    return F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(order, part.alias("part")))), lambda x: x["part"]), "\n")


def _told_in(items: DataFrame, *keys: str) -> DataFrame:
    """keys, items: the items of each, in order. They are shuffled as they are, and become text where the page is made."""
    return items.groupBy(*keys).agg(F.sort_array(F.collect_list("x")).alias("items"))


def _spread(rows: DataFrame, *keys: str) -> DataFrame:
    """rows over as many tasks as shuffles have: they are few and small before their pages are made, and adaptive execution would
    leave all pages to one task."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def _lines(made, items: str | Column = "items") -> Column:
    """The text of all items, each as made has it."""
    return F.array_join(F.transform(items, made), "\n")


def _day(c: str | Column) -> Column:
    """Thursday, 12th February, 2026."""
    return F.concat(F.date_format(c, "EEEE, d"), F.lit("th "), F.date_format(c, "MMMM, yyyy"))


# Listings: pages for each order priority, both houses on each.
#: Keys of the orders that are on one page of a priority: a page is no larger however many orders there are.
ON_PAGE = 5000
LISTED = "select cast(o_orderkey % 2 as int) as senate, cast(o_orderdate as date) as date, '/s/' || o_orderkey || '/' as url, o_orderpriority as priority from orders"


def _listed(x: Column) -> Column:
    key = x["o_orderkey"]
    return _html("<div class='hansard-document'><h3><a href='/s/", key, "/'>", F.when(key % 11 == 0, "Notice").otherwise(F.concat(_day(x["o_orderdate"]), F.lit(" - Afternoon Sitting"))), "</a></h3></div>")


def _archived(x: Column) -> Column:
    key = x["o_orderkey"]
    house = F.when(key % 2 == 1, "senate").otherwise("national_assembly")
    return _html("<li><a href='/hansard/x/", house, "/", F.date_format(x["o_orderdate"], "yyyy-MM-dd"), "-09-", key % 75, "-00'>Sitting ", key, " 09:00 to ", key % 30, ":05</a></li>")


def listing_pages(t, archive: bool = False) -> DataFrame:
    """All pages of a priority have its URL, and a pager that says the same."""
    rows = t("orders").select("o_orderpriority", F.floor(F.col("o_orderkey") / ON_PAGE).alias("p"), F.struct("o_orderkey", "o_orderdate").alias("x"))
    rows = _spread(_told_in(rows, "o_orderpriority", "p"), "o_orderpriority", "p")
    if archive:
        page = _html("<ul class='listing'>", _lines(_archived), "</ul><a href='/hansard/x/senate/2001-01-01'>no list</a>")
    else:
        of = lambda senate: _html("<div class='split-docs'>", _lines(_listed, F.filter("items", lambda x: x["o_orderkey"] % 2 == senate)), "</div>")
        page = _html("<nav><li class='active active_number_box'><span> 2 </span></li><a class='page_label' href='?page=7'>7</a></nav>", of(0), "\n", of(1))
    return rows.select(F.concat(F.lit("/p/"), "o_orderpriority").alias("url"), page.alias("html"))


@query(f"select case senate when 1 then 'Senate' else 'National Assembly' end as house, date, url, 'Afternoon Sitting' as session_type, 'current' as source from ({LISTED}) where cast(substr(url, 4, length(url) - 4) as bigint) % 11 > 0")
def page_listings(t):
    return pages.current_listings(listing_pages(t)).select("house", "date", "url", "session_type", "source")


@query(f"select 'Senate' as house, date, url from ({LISTED}) where senate = 1 and priority = '1-URGENT' and cast(substr(url, 4, length(url) - 4) as bigint) % 11 > 0")
def page_listing_checked(t):
    """The page asked for is the one that its pager says."""
    return pages.listing_page(listing_pages(t).filter("url = '/p/1-URGENT'"), 2, "Senate").select("house", "date", "url")


@query("select '/p/' || o_orderpriority as page_url, 2 as current, 7 as last from orders group by o_orderpriority")
def page_info_listing(t):
    return pages.page_infos(listing_pages(t)).distinct()


#: Minutes above 59 and hours above 23 are no times.
@query("select case o_orderkey % 2 when 1 then 'Senate' else 'National Assembly' end as house, cast(o_orderdate as date) as date, 'https://info.mzalendo.com/hansard/x/' || case o_orderkey % 2 when 1 then 'senate' else 'national_assembly' end || '/' || strftime(o_orderdate, '%Y-%m-%d') || '-09-' || (o_orderkey % 75) || '-00' as url, '09:' || lpad(cast(o_orderkey % 75 as varchar), 2, '0') || ':00' as start_time, lpad(cast(o_orderkey % 30 as varchar), 2, '0') || ':05:00' as end_time from orders where o_orderkey % 75 < 60 and o_orderkey % 30 < 24")
def page_archive_listings(t):
    return pages.archive_listings(listing_pages(t, True)).select("house", "date", "url", "start_time", "end_time")


# Sittings: a page for each conversation.
def _spoken(t) -> DataFrame:
    c = F.col("c")
    return spoken(t).select("conv_id", "house", "date", "turn", "part", c["speaker_name"].alias("name"), c["speaker_url"].alias("href"), F.replace(c["content"], F.lit("&"), F.lit("&amp;")).alias("said"))


def sitting_pages(t, wrapped: bool = False) -> DataFrame:
    """Old layout, or new (each turn in a wrapper). Turns: a section every fourth, then a heading; a scene after every
    third; a plain paragraph or a list, which go on with what was said; a speaker without a speech."""
    turn = F.col("turn")
    section = F.when(turn % 4 == 0, _html("<h2 class='major-section-header'>SECTION ", turn, "</h2><h2 class='header-section'>ITEM ", turn, "</h2>"))
    link = F.when(F.col("href").isNotNull(), _html("<a href='", F.col("href"), "'>", F.col("name"), "</a>")).otherwise(F.col("name"))
    speech = F.when(turn % 4 == 3, "").otherwise(_html("<div class='speech-content'><p>", F.col("said"), "</p><aside class='procedural-note'>(note ", turn, ")</aside></div>"))
    more = F.when(turn % 4 == 1, "<p>And  so on</p>").when(turn % 4 == 2, "<ol class='content-list'><li>one</li><li>two</li></ol><div class='scene-description'>(Applause)</div>").otherwise("")
    body = _html(section, "<div class='contributor-name'>", link, "</div>", speech, more)
    body = _html("<div class='chunk-wrapper'>", body, "</div>") if wrapped else body
    start = "<div class='hansard-content'>" if wrapped else "<article class='hansard-document'>"
    page = _html("<span class='house'>", F.col("house"), "</span><li class='breadcrumb-item current'>", _day("date"), " - Afternoon Sitting</li><span class='time'>Time: 2:30 PM</span><div class='doc-summary'>Hansard Summary all well Sentimental Analysis calm</div><div class='document-thumbnail'><a href='/x.pdf'>x</a></div>", start, F.col("body"), "</div>" if wrapped else "</article>")
    rows = _spoken(t).groupBy("conv_id", "house", "date").agg(_joined("turn", body).alias("body"))
    return rows.select(F.concat(F.lit("/s/"), F.col("conv_id").cast("string")).alias("url"), page.alias("html"))


FLAT = "regexp_replace(trim(content, ' ' || chr(10)), '\\s+', ' ', 'g')"
SPOKEN = f"""(select url, turn, turn // 4 as section_ord, turn % 4 as contrib_ord, 'SECTION ' || (turn // 4 * 4) as section_type, 'ITEM ' || (turn // 4 * 4) as title, speaker_name, speaker_url,
    case turn % 4 when 3 then '' else {FLAT} end || case turn % 4 when 1 then chr(10) || chr(10) || 'And so on' when 2 then ' one two' else '' end as content,
    case turn % 4 when 3 then '' when 2 then '(note ' || turn || ')(Applause)' else '(note ' || turn || ')' end as notes from {{0}})"""


def _told(sittings: DataFrame) -> DataFrame:
    rows = sittings.select("url", F.posexplode("sections").alias("section_ord", "s")).select("url", F.col("section_ord").cast("long").alias("section_ord"), "s.section_type", F.explode("s.subsections").alias("b"))
    rows = rows.select("url", "section_ord", "section_type", "b.title", F.posexplode("b.contributions").alias("contrib_ord", "c"))
    return rows.select("url", "section_ord", "section_type", "title", F.col("contrib_ord").cast("long").alias("contrib_ord"), "c.speaker_name", "c.speaker_url", "c.content", F.array_join("c.procedural_notes", "").alias("notes"))


def _register_sittings():
    from .model_queries import SAID

    told = f"select url, section_ord, section_type, title, contrib_ord, speaker_name, speaker_url, content, notes from {SPOKEN.format(SAID)}"

    @query(told)
    def page_sitting(t):
        return _told(pages.current_sittings(sitting_pages(t)))

    @query(told)
    def page_sitting_wrapped(t):
        return _told(pages.current_sittings(sitting_pages(t, True)))

    @query(f"select distinct url, house, date, 'Afternoon Sitting' as session_type, 'current' as source, dayname(date) as day_of_week, '14:30:00' as start_time, 'all well' as summary, 'calm' as sentiment, '/x.pdf' as pdf_url, cast(null as varchar) as parliament_number from {SAID}")
    def page_sitting_head(t):
        return pages.current_sittings(sitting_pages(t)).select("url", "house", "date", "session_type", "source", "day_of_week", "start_time", "summary", "sentiment", "pdf_url", "parliament_number")

    n = "conv_id // 300"  # conversations of one day and house are told apart by their time
    stamp = f"lpad(cast({n} // 3600 % 24 as varchar), 2, '0') || '-' || lpad(cast({n} // 60 % 60 as varchar), 2, '0') || '-' || lpad(cast({n} % 60 as varchar), 2, '0')"
    archive = f"(select '/hansard/sitting/' || case house when 'Senate' then 'senate' else 'national_assembly' end || '/' || date || '-' || {stamp} || '/' as u, * from {SAID})"

    @query(f"select u as url, house, date, replace(min({stamp}), '-', ':') as start_time, case when min(conv_id) % 2 = 0 then 'THE TENTH PARLIAMENT' else 'PARLIAMENT OF KENYA' end as parliament_number, case when min(conv_id) % 2 = 0 then 'Third Session' else 'Unknown Session' end as session_number, case when min(conv_id) % 2 = 0 then 'Morning Sitting' else 'Regular Sitting' end as session_type, case when min(conv_id) % 2 = 0 then '[The Speaker in the Chair]' else '[Speaker information not found]' end as speaker_in_chair from {archive} group by all")
    def page_archive_sitting_head(t):
        return pages.archive_sittings(archive_pages(t)).select("url", "house", "date", "start_time", "parliament_number", "session_number", "session_type", "speaker_in_chair")

    # a role that is a name swaps with a name that is a role; a role in the name's parentheses comes out
    @query(f"select u as url, cast(row_number() over (partition by u order by turn) - 1 as bigint) as contrib_ord, case turn % 3 when 0 then speaker_name when 1 then 'Hon. ' || speaker_name else 'Hon. Achieng' end as speaker_name, case turn % 3 when 0 then 'Whip' when 1 then 'The Temporary Speaker' else 'The Speaker' end as speaker_role, case turn % 3 when 0 then coalesce(speaker_url, '/person/other/') end as speaker_url, {FLAT} as content, case when turn % 2 = 1 then '(Laughter)' else '' end as notes from {archive}")
    def page_archive_sitting(t):
        rows = pages.archive_sittings(archive_pages(t)).select("url", F.explode("sections").alias("s")).filter("s.section_type = 'MOTION'").select("url", F.posexplode("s.contributions").alias("contrib_ord", "c"))
        return rows.select("url", F.col("contrib_ord").cast("long").alias("contrib_ord"), "c.speaker_name", "c.speaker_role", "c.speaker_url", "c.content", F.array_join("c.procedural_notes", "").alias("notes"))

    @query(f"select u as url, link as speaker_url, case link when '/m/user/' then 'User Otieno' end as name, case link when '/m/user/' then 'user' end as slug from (select distinct u, case turn % 3 when 0 then coalesce(speaker_url, '/person/other/') end as link from {archive}) where link is not null")
    def page_archive_speakers(t):
        people = pages.people(t("region").limit(1).select(F.lit("/m/user/").alias("url"), F.lit("<h1>User  Otieno</h1>").alias("html")))
        rows = pages.archive_sittings(archive_pages(t), people).select("url", F.explode("speakers").alias("s"))
        return rows.select("url", "s.speaker_url", "s.details.name", "s.details.slug")


def archive_pages(t) -> DataFrame:
    """The archive's layout: a heading of the house, one of the section, speeches and scenes; even ones tell all of a sitting."""
    turn = F.col("turn")
    name = F.when(turn % 3 == 0, _html("<a href='", F.coalesce("href", F.lit("/person/other/")), "'>", F.col("name"), "</a>")).when(turn % 3 == 1, "The Temporary Speaker").otherwise("The Speaker (Hon. Achieng)")
    role = F.when(turn % 3 == 0, " (Whip):").when(turn % 3 == 1, _html(" (Hon. ", F.col("name"), "):")).otherwise(":")
    item = _html("<li class='speech'><strong>", name, "</strong>", role, "<p>", F.col("said"), "</p></li>", F.when(turn % 2 == 1, "<li class='scene'>(Laughter)</li>"))
    rows = _spoken(t).groupBy("conv_id", "house", "date").agg(_joined("turn", item).alias("items"))
    head = F.when(F.col("conv_id") % 2 == 0, "<h2>THE TENTH PARLIAMENT</h2><h2>Third Session</h2><li class='page_number'>1 (Morning Sitting)</li>").otherwise("<h2>Nothing</h2>")
    chair = F.when(F.col("conv_id") % 2 == 0, "<li class='scene'>[The Speaker in the Chair]</li>")
    page = _html(head, "<ul><li class='heading'>NATIONAL ASSEMBLY</li><li class='speech'><strong>Lost</strong><p>x</p></li>", chair, "<li class='heading'> MOTION</li>", F.col("items"), "</ul>")
    url = F.concat(F.lit("/hansard/sitting/"), F.when(F.col("house") == "Senate", "senate").otherwise("national_assembly"), F.lit("/"), F.date_format("date", "yyyy-MM-dd"), F.lit("-"), F.format_string("%02d-%02d-%02d", *[F.floor(F.col("conv_id") / 300 / k) % m for k, m in ((3600, 24), (60, 60), (1, 60))]), F.lit("/"))
    return rows.select(url.alias("url"), page.alias("html"))


_register_sittings()


# Members and people.
def member_pages(t, senate: bool) -> DataFrame:
    """A page of members for each market segment."""
    kind, key = "senators-list" if senate else "members-list", F.col("c_custkey")
    item = _html(f"<a class='{kind}--item' ", F.when(key % 9 > 0, F.concat(F.lit("href='/m/"), key.cast("string"), F.lit("'"))), f"><div class='{kind}--name'>", F.when(key % 8 > 0, F.col("c_name")), "</div>", F.when(key % 5 == 0, "<p class='leader-role'>Whip </p>"), f"<div class='{kind}--representation'>", F.when(key % 3 > 0, F.concat(F.lit("Ward "), (key % 3).cast("string"))), "</div></a>")
    rows = t("customer").filter(f"c_nationkey % 2 = {int(senate)}").groupBy("c_mktsegment").agg(_joined("c_custkey", item).alias("html"))
    return rows.select(F.concat(F.lit("/l/"), "c_mktsegment").alias("url"), F.concat(F.lit("<li class='active active_number_box'><span>1</span></li>"), F.col("html")).alias("html"))


MEMBERS = "select c_name as name, '/m/' || c_custkey || '/' as url, case c_nationkey % 2 when 1 then 'Senate' else 'National Assembly' end as house, '13th-parliament' as parliament, case when c_custkey % 5 = 0 then 'Whip' end as role, case when c_custkey % 3 > 0 then 'Ward ' || (c_custkey % 3) end as constituency from customer where c_custkey % 9 > 0 and c_custkey % 8 > 0"


@query(MEMBERS)
def page_members(t):
    return pages.members_both(member_pages(t, False), member_pages(t, True))


@query(f"{MEMBERS} and c_nationkey % 2 = 1 and c_mktsegment = 'BUILDING'")
def page_member_page(t):
    return pages.member_page(member_pages(t, True).filter("url = '/l/BUILDING'"), "Senate", 1)


@query("select '/person/' || s_suppkey || '/' as page_url, cast(s_suppkey as varchar) as slug, s_name as name, case when s_suppkey % 2 = 0 then 'About ' || s_name end as summary, case when s_suppkey % 3 = 0 then 'Party ' || s_nationkey end as party, case when s_suppkey % 3 = 0 then '/party/' || s_nationkey || '/' end as party_url, 's' || s_suppkey || '@x.org' as email, '+254 ' || s_suppkey as telephone, case when s_suppkey % 4 = 0 then 'Member' end as position, case when s_suppkey % 4 = 0 then 'Molo' end as constituency, case when s_suppkey % 4 = 0 then '/place/molo/' end as constituency_url from supplier where s_suppkey % 7 > 0")
def page_people(t):
    key = F.col("s_suppkey")
    body = _html("<h1> ", F.col("s_name"), "</h1><p>Email: a@b</p><p>Telephone</p><p> </p>", F.when(key % 2 == 0, _html("<p>About ", F.col("s_name"), "</p>")), F.when(key % 3 == 0, _html("<a class='party-membership' href='/party/", F.col("s_nationkey"), "/'>Party ", F.col("s_nationkey"), "</a>")), "<a href='mailto:s", key, "@x.org'>m</a><a href='tel:+254 ", key, "'>t</a><a href='/place/no/'>none</a>", F.when(key % 4 == 0, "<div class='position ongoing'><h4>Member</h4><a href='/place/molo/'>Molo</a></div>"))
    return pages.people(t("supplier").select(_html("/person/", key, "/").alias("url"), F.when(key % 7 > 0, body).otherwise(" ").alias("html")))


# Profiles: a page for each supplier, of its parts.
def _pager(kind: str, parameter: str, current, last) -> Column:
    return _html(f"<nav class='{kind}'><li class='active_number_box'><span>", current, f"</span></li><a href='?q=1&amp;{parameter}=", last, "'>last</a></nav>")


def _profile_items(t) -> DataFrame:
    """l_suppkey, p (the page of three that an item is on), x: what an item is made of, at first (the order of items)."""
    at = F.concat(F.lpad(F.col("l_orderkey").cast("string"), 12, "0"), F.col("l_linenumber").cast("string"), F.lpad(F.col("l_partkey").cast("string"), 12, "0"))
    day = F.date_format("l_shipdate", "yyyy-MM-dd")
    return t("lineitem").select("l_suppkey", (F.col("l_linenumber") % 3 + 1).alias("p"), F.struct(at.alias("at"), F.col("l_partkey").alias("part"), F.col("l_linenumber").alias("line"), day.alias("day")).alias("x"))


def _bill(x: Column) -> Column:
    return _html("<div class='bill-item'><h3 class='bill-name'>Bill ", x["part"], "</h3><span class='bill-year'>", F.substring(x["day"], 1, 4), "</span><div class='bill-stage'>Status: Stage ", x["line"], "</div></div>")


def _vote(x: Column) -> Column:
    part = x["part"]
    return _html("<div class='voting-patterns-row'><div class='voting-cell voting-date'>", x["day"], "</div><div class='voting-cell voting-title'>", F.when(part % 6 > 0, _html("<a href='/v/", part, "'>Vote ", part, "</a>")), "</div><div class='voting-cell voting-decision'>", F.when(part % 2 == 0, "<span class='decision-badge'>Yes</span>"), "</div></div>")


def _group(x: Column) -> Column:
    part = x["part"]
    return _html("<div class='contribution-group'><span class='topic-badge topic-badge-large'>Topic ", part, "</span><span class='group-date'>", x["day"], "</span><div class='conversation-subgroup'><span class='conversation-type-badge'>Motion</span><a class='conversation-title' href='/s/", part, "#top'>Title ", part, "</a><div class='contribution-item'><a class='contribution-text-link' href='/s/", part, "#chunk-1'><p class='contribution-text'>one </p></a></div><div class='contribution-item'><a class='contribution-text-link' href=''><p class='contribution-text'>none</p></a></div></div><div class='conversation-subgroup'><span class='conversation-type-badge'>Question</span><div class='contribution-item'><a class='contribution-text-link' href='/s/", part, "#chunk-2'>two</a></div></div></div>")


def profile_pages(t, items: DataFrame | None = None, parts: int | None = None) -> DataFrame:
    """Profile pages with all items, or those given; parts: how many pages both pagers count."""
    key = F.col("s_suppkey")
    each = _told_in(_profile_items(t) if items is None else items, "l_suppkey")
    s = _spread(t("supplier").join(each, F.col("s_suppkey") == F.col("l_suppkey"), "left"), "s_suppkey")
    bills_pager = F.when(key % 4 == 0, _pager("bills-pagination", "bills_page", "1", key % 5 + 2)) if parts is None else _pager("bills-pagination", "bills_page", "1", str(parts))
    activity_pager = F.when(key % 4 == 1, _pager("contributions-pagination", "contributions_page", "1", key % 6 + 2)) if parts is None else _pager("contributions-pagination", "contributions_page", "1", str(parts))
    page = _html("<h1 class='page-heading'>", F.col("s_name"), "</h1><h2 class='assembly-entry'>Senator</h2><img class='member-list--image' src='/p/", key, ".png'><section class='member-biography'><div class='biography-content'>", F.when(key % 2 == 0, "Born  once"), "</div></section><h2 class='header-two'>CURRENT POSITIONS</h2><div class='position-section'><p>Member ", key, "</p><p> </p></div><p class='elected-post'>Chair</p><h2 class='header-three'>Parties and Coalitions</h2><p>none</p><p class='elected-post'>Party ", F.col("s_nationkey"), "</p><ul><li class='committee-item'>Works</li><li class='committee-item'> </li></ul><div class='activity-section'><p>Has it? ", F.when(key % 3 > 0, _html("He has made ", key, " speeches last year and ", key + 7, " speeches in all")), "</p></div><p class='bills-summary'>She has sponsored ", key % 9, " bills</p>", _lines(_bill), bills_pager, _lines(_vote), _lines(_group), activity_pager)
    return s.select(_html("/mps/", key, "/").alias("url"), page.alias("html"))


LINES = "(select '/mps/' || l_suppkey || '/' as page_url, l_suppkey, l_partkey, l_linenumber, strftime(l_shipdate, '%Y-%m-%d') as day from lineitem where l_suppkey in (select s_suppkey from supplier))"


@query(f"select s_name as name, cast(s_suppkey as varchar) as slug, 'https://mzalendo.com/p/' || s_suppkey || '.png' as photo_url, case when s_suppkey % 2 = 0 then 'Born once' end as biography, 'Senator' as position_type, 'Member ' || s_suppkey || ';Chair' as positions, 'Party ' || s_nationkey as party, 'Works' as committees, cast(case when s_suppkey % 3 > 0 then s_suppkey end as int) as speeches_last_year, cast(case when s_suppkey % 3 > 0 then s_suppkey + 7 end as int) as speeches_total, cast(s_suppkey % 9 as int) as bills_total, cast(case when s_suppkey % 4 = 0 then s_suppkey % 5 + 2 when n > 0 then 1 else 0 end as int) as bills_pages, cast(case when s_suppkey % 4 = 1 then s_suppkey % 6 + 2 when n > 0 then 1 else 0 end as int) as activity_pages, coalesce(n, 0) as n_bills from supplier left join (select l_suppkey, count(*) as n from {LINES} group by 1) on l_suppkey = s_suppkey")
def page_profiles(t):
    p = pages.profiles(profile_pages(t), *fold.DETAILS, "bills", "bills_total", "bills_pages", "activity_pages")
    return p.select("name", "slug", "photo_url", "biography", "position_type", F.array_join("positions", ";").alias("positions"), "party", F.array_join("committees", ";").alias("committees"), "speeches_last_year", "speeches_total", "bills_total", "bills_pages", "activity_pages", F.size("bills").cast("long").alias("n_bills"))


@query(f"select page_url, 'Bill ' || l_partkey as name, substr(day, 1, 4) as year, 'Stage ' || l_linenumber as status from {LINES}")
def page_bills(t):
    return pages.bills(profile_pages(t))


@query(f"select page_url, day as date, 'Vote ' || l_partkey as title, '/v/' || l_partkey as url, case when l_partkey % 2 = 0 then 'Yes' else '' end as decision from {LINES} where l_partkey % 6 > 0")
def page_votes(t):
    return pages.votes(profile_pages(t))


@query(f"select page_url, day as date, 'Topic ' || l_partkey as topic, kind as contribution_type, case kind when 'Motion' then 'Title ' || l_partkey else '' end as section_title, case kind when 'Motion' then '/s/' || l_partkey else '' end as sitting_url, case kind when 'Motion' then 'one' else '' end as text_preview, '/s/' || l_partkey || case kind when 'Motion' then '#chunk-1' else '#chunk-2' end as url from {LINES}, (values ('Motion'), ('Question')) v(kind)")
def page_activity(t):
    return pages.activities(profile_pages(t))


@query("select '/mps/' || s_suppkey || '/' as page_url, kind, 1 as current, cast(case kind when 'bills' then s_suppkey % 5 + 2 else s_suppkey % 6 + 2 end as int) as last from supplier, (values ('bills'), ('activity')) v(kind) where s_suppkey % 4 = case kind when 'bills' then 0 else 1 end")
def page_info_parts(t):
    return pages.page_infos_of(profile_pages(t), "bills", "activity").select("page_url", "kind", "current", "last")


def profile_parts(t) -> tuple[DataFrame, DataFrame]:
    """Profiles in three pages: the first ones, and the further ones of bills and activity. The third ones of every fifth
    profile say that they are the ninth."""
    items = _profile_items(t)
    each = _spread(_told_in(items.filter("p > 1"), "l_suppkey", "p"), "l_suppkey", "p")
    says = F.when((F.col("l_suppkey") % 5 == 0) & (F.col("p") == 3), 9).otherwise(F.col("p"))
    part = lambda made, nav, parameter: F.struct(_html("/mps/", F.col("l_suppkey"), f"/?{parameter}=", F.col("p")).alias("url"), _html(_lines(made), _pager(nav, parameter, says, "3")).alias("html"))
    more = each.select(F.explode(F.array(part(_bill, "bills-pagination", "bills_page"), part(_group, "contributions-pagination", "contributions_page"))).alias("x")).select("x.*")
    return profile_pages(t, items.filter("p = 1"), 3), more


ITEMS = "(select '/mps/' || l_suppkey || '/' as page_url, l_partkey as k, l_linenumber % 3 + 1 as p, lpad(cast(l_orderkey as varchar), 12, '0') || l_linenumber || lpad(cast(l_partkey as varchar), 12, '0') as pos from lineitem where not (l_suppkey % 5 = 0 and l_linenumber % 3 = 2))"


@query(f"""select '/mps/' || s_suppkey || '/' as page_url, s_name as name, coalesce(n, 0) as n_bills, coalesce(2 * n, 0) as n_activity, coalesce(bills, '') as bills, coalesce(activity, '') as activity from supplier left join (
    select page_url, count(*) as n, string_agg('Bill ' || k, ';' order by p, pos) as bills, string_agg('/s/' || k || '#chunk-1;/s/' || k || '#chunk-2', ';' order by p, pos) as activity from {ITEMS} group by page_url) i on i.page_url = '/mps/' || s_suppkey || '/'""")
def page_profiles_in_parts(t):
    """Bills and activity of all pages of a profile, in order, without the pages that are others than asked for."""
    first, more = profile_parts(t)
    p = pages.full_profiles(first, more)
    told = lambda c, k: F.array_join(F.transform(c, lambda x: x[k]), ";").alias(c)
    return p.select("page_url", "name", F.size("bills").cast("long").alias("n_bills"), F.size("activity").cast("long").alias("n_activity"), told("bills", "name"), told("activity", "url"))


# The page source: pages of a list in a folder, of which one is broken and one is another than asked for.
def _list_folder(t) -> str:
    """Seven pages of listings, by the order's key; returns their folder."""
    orders = t("orders")
    spark = orders.sparkSession
    links = orders.select((F.col("o_orderkey") % 7 + 1).cast("int").alias("page"), (F.col("o_orderkey") % 2 * 2 + 2).cast("int").alias("place"), "o_orderkey", _listed(F.struct("o_orderkey", "o_orderdate")).alias("html"))
    says = F.when(F.col("page") == 4, 9).otherwise(F.col("page"))
    nav = _html(F.when(F.col("page") == 6, "<![foo[x]]>"), "<nav><li class='active active_number_box'><span>", says, "</span></li><a class='page_label' href='?page=7'>7</a></nav><div class='split-docs'>")
    around = spark.range(1, 8).select(F.col("id").cast("int").alias("page")).select("page", F.explode(F.array(*[F.struct(F.lit(k).alias("place"), F.lit(0).cast("long").alias("o_orderkey"), part.alias("html")) for k, part in ((1, nav), (3, F.lit("</div><div class='split-docs'>")), (5, F.lit("</div>")))])).alias("x"))
    around = around.select("page", "x.*")
    path = sinks.scratch(spark) + "/list"
    page_source.write_pages(links.unionByName(around), path, "place", "o_orderkey")
    return path


LIST = "(select o_orderkey, cast(o_orderkey % 7 + 1 as int) as page, case o_orderkey % 2 when 1 then 'Senate' else 'National Assembly' end as house, cast(o_orderdate as date) as date from orders where o_orderkey % 11 > 0 and o_orderkey % 7 not in (3, 5))"


@query(f"select page, house, date, '/s/' || o_orderkey || '/' as url, 'Afternoon Sitting' as session_type from {LIST} where house = 'Senate' and date >= date '1995-01-01' and date < date '1997-01-01'")
def page_source_listings(t):
    """All pages of a list, by the count of its pager; house and dates are filtered where pages are read."""
    rows = page_source.all_pages(t("orders").sparkSession, _list_folder(t))
    return rows.filter("house = 'Senate' and date >= date'1995-01-01' and date < date'1997-01-01'").select("page", "house", "date", "url", "session_type")


@query(f"select count(*) as n, 2 as failed, '4,6' as pages from {LIST}")
def page_source_failures(t):
    """Rows of the pages that could be read, and what is told of the others."""
    spark = t("orders").sparkSession
    path = _list_folder(t)
    page_source.all_pages(spark, path, failures=f"{path}-failures").write.parquet(f"{path}-rows")
    failed = page_source.failures(spark, f"{path}-failures").agg(F.count("*").alias("failed"), F.array_join(F.sort_array(F.collect_list("page")), ",").alias("pages"))
    return spark.read.parquet(f"{path}-rows").agg(F.count("*").alias("n")).join(failed)


@query("select cast(c_custkey % 5 + 1 as int) as page, c_name as name, '/m/' || c_custkey as url, case when c_custkey % 3 = 0 then 'Whip' end as role, 'Ward ' || c_nationkey as constituency from customer")
def page_source_members(t):
    """All pages of a members' list."""
    key = F.col("c_custkey")
    item = _html("<a class='members-list--item' href='/m/", key, "'><div class='members-list--name'>", F.col("c_name"), "</div>", F.when(key % 3 == 0, "<p class='leader-role'>Whip</p>"), "<div class='members-list--representation'>Ward ", F.col("c_nationkey"), "</div></a>")
    rows = t("customer").select((key % 5 + 1).cast("int").alias("page"), "c_custkey", item.alias("item")).groupBy("page").agg(_joined("c_custkey", F.col("item")).alias("items"))
    path = sinks.scratch(t("customer").sparkSession) + "/members"
    page_source.write_pages(rows.select("page", _html("<li class='active active_number_box'><span>", F.col("page"), "</span></li><a class='page_label' href='?page=5'>5</a>", F.col("items")).alias("html")), path)
    return page_source.all_pages(t("customer").sparkSession, path, "members")


@query("select '/mps/' || s_suppkey || '/' as url, s_name as name, case when s_suppkey % 2 = 0 then 'Born once' else 'known before' end as biography, 'https://mzalendo.com/p/' || s_suppkey || '.png' as photo_url, 'Senator' as position_type, 'Member ' || s_suppkey || ';Chair' as positions, 'Party ' || s_nationkey as party, 'Works' as committees, cast(case when s_suppkey % 3 > 0 then s_suppkey end as int) as speeches_last_year, cast(case when s_suppkey % 3 > 0 then s_suppkey + 7 else 1 end as int) as speeches_total, 'Whip' as role from supplier")
def enrich_members_stored(t):
    """Stored members with all that their profiles say, and after a listing came once more."""
    store = sinks.Store(t("supplier").sparkSession, sinks.scratch(t("supplier").sparkSession), 4)
    store.migrate()
    listed = t("supplier").select(F.col("s_name").alias("name"), _html("/mps/", F.col("s_suppkey"), "/").alias("url"), F.lit("Senate").alias("house"), F.lit("13th-parliament").alias("parliament"), F.lit("Whip").alias("role"), F.lit(None).cast("string").alias("constituency"))
    store.upsert("members", listed.withColumns({"biography": F.lit("known before"), "speeches_total": F.lit(1)}), ["url"])
    store.write("members", ingest.enrich_members(store.read("members"), pages.profiles(profile_pages(t), *fold.DETAILS)))
    store.upsert("members", listed.withColumn("role", F.lit(None).cast("string")), ["url"])
    rows = store.read("members")
    return rows.select("url", "name", "biography", "photo_url", "position_type", F.array_join("positions", ";").alias("positions"), "party", F.array_join("committees", ";").alias("committees"), "speeches_last_year", "speeches_total", "role")


def _register_sql():
    from .model_queries import SAID

    told = f"select url, section_ord, section_type, title, contrib_ord, speaker_name, speaker_url, content, notes, cast(null as varchar) as error from {SPOKEN.format(SAID)} where turn % 4 < 4"

    @query(f"{told} union all select '/bad/' || n_nationkey, null, null, null, null, null, null, null, null, 'AssertionError' from nation")
    def page_sitting_sql(t):
        """Sitting pages among broken ones, parsed by the table function in SQL; a broken page is a row with its error."""
        spark = t("nation").sparkSession
        page_source.register(spark)
        bad = t("nation").select(F.concat(F.lit("/bad/"), F.col("n_nationkey").cast("string")).alias("url"), F.lit("<p>x</p><![foo[x]]>").alias("html"))
        rows = spark.sql("select p.url, x.sections, x.error from {pages} p, lateral parse_page(p.html, 'sitting') x", pages=sitting_pages(t).unionByName(bad))
        good = _told(rows.filter("error is null")).withColumn("error", F.lit(None).cast("string"))
        none = [F.lit(None).cast(f.dataType).alias(f.name) for f in good.schema if f.name not in ("url", "error")]
        return good.unionByName(rows.filter("error is not null").select("url", *none, F.regexp_extract("error", r"^(\w+)", 1).alias("error")))

    @query(f"select distinct url from {SAID}")
    def page_sitting_among_broken(t):
        """Broken pages stop nothing."""
        bad = t("nation").select(F.concat(F.lit("/bad/"), F.col("n_nationkey").cast("string")).alias("url"), F.lit("<p>x</p><![foo[x]]>").alias("html"))
        return pages.current_sittings(sitting_pages(t).unionByName(bad)).select("url")


_register_sql()


# Expressions that pages need, over columns of their own.
@query("select o_orderkey, lpad(cast(o_orderkey % 24 as varchar), 2, '0') || ':45:00' as end_time, case when o_custkey % 2 = 0 then 'in ' || o_custkey || ' (x)' end as inside from orders")
def archive_texts(t):
    shown = F.concat(F.lit("Sitting of 09:00 to "), (F.col("o_orderkey") % 24).cast("string"), F.lit(":45 (late)"))
    named = F.when(F.col("o_custkey") % 2 == 0, F.concat(F.lit("a ( in "), F.col("o_custkey").cast("string"), F.lit(" (x) ) b"))).otherwise(") none (")
    return t("orders").select("o_orderkey", text.end_time(shown).alias("end_time"), text.parenthesised(named).alias("inside"))


@query("select c_custkey, list_extract([c_name, 'Hon. Kamau', 'Hon. ' || c_name, 'The Speaker'], c_custkey % 4 + 1) as name, list_extract([null, 'Molo, UDA', 'The Speaker', null], c_custkey % 4 + 1) as role from customer")
def name_role_swap(t):
    """A plain name; a role given as the name; a role in the parentheses of a name; a role alone."""
    pick = lambda *x: F.element_at(F.array(*x), (F.col("c_custkey") % 4 + 1).cast("int"))
    none = F.lit(None).cast("string")
    name = pick(F.col("c_name"), F.lit("Molo, UDA"), F.concat(F.lit("The Speaker (Hon. "), F.col("c_name"), F.lit(")")), F.lit("The Speaker"))
    role = pick(none, F.lit("Hon. Kamau"), none, none)
    return t("customer").select("c_custkey", text.fix_name_and_role(name, role).alias("x")).select("c_custkey", "x.*")
