"""Queries over sittings nested from the conversations table: extraction, ingestion, linking, pending work, prompts, stores.

Each sitting has a bills section with a spoken and an empty subsection, a flat section about a bill, a section that
is named like a bill but has a subsection, and statements with a topic; turns go to them in rotation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import prompts, sql, text
from ..operators import extract, fold, link, listing, sinks
from . import ingest, pending
from .base import query

MOVED = "I beg to move that it be read a Second Time; National Assembly Bill No. 20 of 2026. "
SITTINGS = "struct<title:string,contributions:" + extract.SPOKEN + ">"


def spoken(t) -> DataFrame:
    """conv_id, url, house, date, turn, part and the contribution c of every turn."""
    turn = F.col("turn")
    said = F.concat(F.when(turn % 5 == 0, MOVED).when(turn % 7 == 6, MOVED.lower()).otherwise(""), F.col("text"))
    c = F.struct(F.when(F.col("role") == "system", "Hon.").otherwise(F.col("role")).alias("speaker_name"), F.lit(None).cast("string").alias("speaker_role"), F.when(F.col("role") == "user", "/m/user/").alias("speaker_url"), said.alias("content"), F.array().cast("array<string>").alias("procedural_notes"))
    return t("conversations").select("conv_id", F.concat(F.lit("/s/"), F.col("conv_id").cast("string")).alias("url"), F.when(F.col("conv_id") % 2 == 0, "Senate").otherwise("National Assembly").alias("house"), F.date_add(F.lit("2024-01-01").cast("date"), (F.col("conv_id") % 300).cast("int")).alias("date"), "turn", (turn % 4).cast("int").alias("part"), c.alias("c"))


def sittings(t) -> DataFrame:
    """Sittings as the page sources give them."""
    each = F.collect_list(F.struct("turn", "part", "c"))
    rows = spoken(t).groupBy("conv_id", "url", "house", "date").agg(F.sort_array(each).alias("all"))
    of = lambda k: F.transform(F.filter("all", lambda x: x["part"] == k), lambda x: x["c"])
    none = F.array().cast(extract.SPOKEN)
    sub = lambda title, c: F.struct(F.lit(title).alias("title"), c.alias("contributions"))
    section = lambda kind, subs, c: F.struct(F.lit(kind).alias("section_type"), (F.array(*subs) if subs else F.array()).cast(f"array<{SITTINGS}>").alias("subsections"), c.alias("contributions"))
    sections = F.array(
        section("BILLS", [sub("SECOND READING OF THE COUNTY WORKS BILL", of(0)), sub("THE EMPTY HEADS BILL", none)], none),
        section("THE FLAT ROADS BILL", [], of(1)),
        section("THE NESTED WORKS BILL", [sub("STATE OF ROADS", of(2))], none),
        section("STATEMENTS", [sub("UPGRADING OF ROADS", of(3))], none),
    )
    text_or_none = lambda c: F.lit(c).cast("string")
    return rows.select("url", "house", "date", F.lit("Afternoon Sitting").alias("session_type"), F.lit("current").alias("source"), F.when(F.col("conv_id") % 3 == 0, "told").alias("summary"), text_or_none(None).alias("sentiment"), text_or_none(None).alias("pdf_url"), sections.alias("sections"))


SAID = f"""(select conv_id, '/s/' || conv_id as url, case when conv_id % 2 = 0 then 'Senate' else 'National Assembly' end as house, date '2024-01-01' + cast(conv_id % 300 as int) as date,
    turn, turn % 4 as part, case when role = 'system' then 'Hon.' else role end as speaker_name, case when role = 'user' then '/m/user/' end as speaker_url,
    case when turn % 5 = 0 then '{MOVED}' when turn % 7 = 6 then lower('{MOVED}') else '' end || text as content from conversations)"""
#: Parts as they are found: section and subsection, the turns they hold, what they are called.
PARTS = """(select * from (values (0, 0, 0, 'BILLS', 'SECOND READING OF THE COUNTY WORKS BILL', 'County Works Bill'), (0, 1, 9, 'BILLS', 'THE EMPTY HEADS BILL', 'Empty Heads Bill'),
    (1, -1, 1, 'THE FLAT ROADS BILL', 'THE FLAT ROADS BILL', 'Flat Roads Bill'), (2, 0, 2, 'THE NESTED WORKS BILL', 'STATE OF ROADS', null), (3, 0, 3, 'STATEMENTS', 'UPGRADING OF ROADS', null)) v(section_ord, sub_ord, part, section_type, title, bill))"""
HEADS = f"(select distinct url, house, date from {SAID})"
#: Bills of every sitting, empty ones too.
BILLS = f"""(select h.url, h.house, h.date, p.section_ord, p.sub_ord, p.bill as name, p.title as section_title, count(s.turn) as speech_count,
    case when count(s.turn) filter (s.turn % 5 = 0) > 0 then 'National Assembly Bill No. 20 of 2026' when count(s.turn) filter (s.turn % 7 = 6) > 0 then 'national assembly bill no. 20 of 2026' end as bill_number,
    case when count(s.turn) filter (s.turn % 5 = 0 or s.turn % 7 = 6) > 0 then 2026 end as year,
    arg_min(s.speaker_name, s.turn) filter (contains(case when p.sub_ord >= 0 then lower(s.content) else s.content end, case when p.sub_ord >= 0 then 'i beg to move' else 'I beg to move' end)) as sponsor,
    case when p.part = 0 then 'Second Reading' when count(s.turn) filter (s.turn % 5 = 0 or s.turn % 7 = 6) > 0 then 'Second Reading' end as stage
    from {HEADS} h cross join {PARTS} p left join {SAID} s on s.url = h.url and s.part = p.part where p.bill is not null group by h.url, h.house, h.date, p.section_ord, p.sub_ord, p.bill, p.title, p.part)"""


def rows_of(t) -> DataFrame:
    return extract.contributions(sittings(t))


@query(f"select url, speaker_name, speaker_url, count(*) as speech_count from {SAID} where speaker_name <> 'Hon.' group by all")
def speakers_extract(t):
    return extract.speakers(rows_of(t))


@query(f"""select h.url, p.section_ord, p.sub_ord, count(s.turn) as speech_count, coalesce(string_agg(s.content, chr(10) order by s.turn), '') as text from {HEADS} h
    cross join (select section_ord, sub_ord, part from {PARTS} union all values (0, -1, 9), (2, -1, 9), (3, -1, 9)) p left join {SAID} s on s.url = h.url and s.part = p.part group by all""")
def segments_extract(t):
    return extract.segments(rows_of(t)).select("url", "section_ord", "sub_ord", "speech_count", "text")


@query(f"select s.url, p.section_ord, p.sub_ord, s.speaker_name, s.speaker_url, count(*) as speech_count, string_agg(s.content, chr(10) || chr(10) order by s.turn) as contributions_text from {SAID} s join {PARTS} p on s.part = p.part where s.speaker_name <> 'Hon.' group by all")
def contributors_extract(t):
    return extract.contributors(rows_of(t)).select("url", "section_ord", "sub_ord", "speaker_name", "speaker_url", "speech_count", "contributions_text")


@query(f"select url, section_ord, sub_ord, name, bill_number, year, sponsor, stage, section_title, speech_count from {BILLS}")
def bills_extract(t):
    return extract.bills(rows_of(t)).select("url", "section_ord", "sub_ord", "name", "bill_number", "year", "sponsor", "stage", "section_title", "speech_count")


TOPICS = f"(select url as sitting_url, date, 'STATEMENTS' as section_type, 'Upgrading Of Roads' as title, count(*) as speech_count from {SAID} where part = 3 group by all having count(*) filter (speaker_name <> 'Hon.') > 0)"


@query(f"select sitting_url as url, section_type, title, speech_count from {TOPICS}")
def topics_extract(t):
    return extract.topics(rows_of(t)).select("url", "section_type", "title", "speech_count")


@query("select distinct section, upper(section) in ('STATEMENTS', 'QUESTIONS AND STATEMENTS') as topic_section, title, strlen(title) >= 5 and not ends_with(upper(title), 'BILL') and not ends_with(upper(title), ' ACT') and not contains(title, 'Bills No') as topic_title from (select list_extract(['statements', 'Bills', 'QUESTIONS AND STATEMENTS'], p_partkey % 3 + 1) as section, list_extract([p_name, p_name || ' bill', upper(p_name) || ' ACT', 'it', p_name || ' (Senate Bills No. 2 of 2020) now'], p_partkey % 5 + 1) as title from part)")
def topic_predicates(t):
    pick = lambda k, *x: F.element_at(F.array(*x), (F.col("p_partkey") % k + 1).cast("int"))
    name = F.col("p_name")
    rows = t("part").select(pick(3, *map(F.lit, ("statements", "Bills", "QUESTIONS AND STATEMENTS"))).alias("section"), pick(5, name, F.concat(name, F.lit(" bill")), F.concat(F.upper(name), F.lit(" ACT")), F.lit("it"), F.concat(name, F.lit(" (Senate Bills No. 2 of 2020) now"))).alias("title")).distinct()
    return rows.select("section", text.is_topic_section(F.col("section")).alias("topic_section"), "title", text.is_topic_title(F.col("title")).alias("topic_title"))


#: Stores of this process, by session and by the files that their rows come from.
_STORES: dict[tuple, sinks.Store] = {}


def store(t) -> sinks.Store:
    """The sittings ingested into a store, once a session while the table's files stay as they are."""
    rows = t("conversations")
    files = rows.select(F.xxhash64("_metadata.file_path", "_metadata.file_modification_time", "_metadata.file_size").alias("f")).distinct()
    key = (rows.sparkSession.sparkContext.applicationId, *files.agg(F.bit_xor("f"), F.count("*")).first())
    if key not in _STORES:
        made = sinks.Store(rows.sparkSession, sinks.scratch(rows.sparkSession), 8)
        made.migrate()
        ingest.ingest_into(made, sittings(t))
        _STORES[key] = made
    return _STORES[key]


def stored(t, name: str) -> DataFrame:
    return store(t).read(name)


@query(f"select url, house, date, 'Afternoon Sitting' as session_type, case when cast(substr(url, 4) as int) % 3 = 0 then 'told' end as summary from {HEADS}")
def ingest_sittings(t):
    return stored(t, "sittings").select("url", "house", "date", "session_type", "summary")


@query(f"select distinct speaker_name as name, speaker_url as url from {SAID} where speaker_name <> 'Hon.'")
def ingest_speakers(t):
    return stored(t, "speakers").select("name", "url")


@query(f"select url as sitting_url, speaker_name, speaker_url, cast(2 * count(*) as bigint) as speech_count from {SAID} where speaker_name <> 'Hon.' group by all")
def ingest_sitting_speakers(t):
    """Counts add up: the first half of the rows comes once more."""
    one = ingest.tables(sittings(t))["sitting_speakers"]
    return fold.upsert(fold.upsert(None, one, "sitting_speakers", ingest.ORDER), one, "sitting_speakers", ingest.ORDER)


LAST = "arg_max({0}, (date, url, section_ord, sub_ord)) filter ({0} is not null) as {0}"


@query(f"select name, {', '.join(LAST.format(c) for c in ('bill_number', 'year', 'sponsor'))} from {BILLS} group by name")
def ingest_bills(t):
    return stored(t, "bills").select("name", "bill_number", "year", "sponsor")


@query(f"select name as bill, url as sitting_url, stage, house, date, section_title, speech_count from {BILLS}")
def ingest_bill_mentions(t):
    return stored(t, "bill_mentions").drop(*fold.SUMMARIES)


IN_BILL = f"(select b.name as bill, b.url as sitting_url, b.stage, b.house, b.date, s.speaker_name, s.speaker_url, count(*) as speech_count, string_agg(s.content, chr(10) || chr(10) order by s.turn) as contributions_text from {BILLS} b join {PARTS} p on p.bill = b.name join {SAID} s on s.url = b.url and s.part = p.part where s.speaker_name <> 'Hon.' group by all)"
IN_TOPIC = f"(select o.sitting_url, o.section_type, o.title, s.speaker_name, s.speaker_url, count(*) as speech_count, string_agg(s.content, chr(10) || chr(10) order by s.turn) as contributions_text from {TOPICS} o join {SAID} s on s.url = o.sitting_url and s.part = 3 where s.speaker_name <> 'Hon.' group by all)"


@query(f"select * exclude (house, date) from {IN_BILL}")
def ingest_bill_mention_speakers(t):
    return stored(t, "bill_mention_speakers").drop(*fold.SUMMARIES)


@query(f"select sitting_url, section_type, title, speech_count from {TOPICS}")
def ingest_topics(t):
    return stored(t, "topics").drop(*fold.SUMMARIES)


@query(f"select * from {IN_TOPIC}")
def ingest_topic_speakers(t):
    return stored(t, "topic_speakers").drop(*fold.SUMMARIES)


@query("select '/m/' || c_custkey || '/' as url, list_extract(['New ', 'Hon. '], c_custkey % 2 + 1) || c_name as name, 'Senate' as house, case when c_custkey % 4 > 0 then 'Whip ' || (c_custkey % 4) else 'old' end as role, case when c_custkey % 3 = 0 then 'Molo' else 'Kibra' end as constituency from customer")
def ingest_members(t):
    key = F.col("c_custkey")
    shown = lambda prefix: F.concat(F.lit(prefix), F.col("c_name"))
    row = lambda name, house, role, place: t("customer").select(F.concat(F.lit("/m/"), key.cast("string"), F.lit("/")).alias("url"), name.alias("name"), F.lit(house).alias("house"), F.lit("13th-parliament").alias("parliament"), role.alias("role"), place.alias("constituency"))
    old = row(shown("Old "), "Senate", F.lit("old"), F.lit("Kibra"))
    new = row(F.when(key % 2 == 0, shown("New ")).otherwise(shown("Hon. ")), "National Assembly", F.when(key % 4 > 0, F.concat(F.lit("Whip "), (key % 4).cast("string"))), F.when(key % 3 == 0, "Molo"))
    return ingest.ingest_members(new, ingest.ingest_members(old)).select("url", "name", "house", "role", "constituency")


def _members(t) -> DataFrame:
    return t("conversations").select(F.initcap("role").alias("name"), F.concat(F.lit("/m/"), "role", F.lit("/")).alias("url")).distinct().select("name", "url", F.lit("Whip").alias("role"), F.lit("Molo").alias("constituency"))


def _linked(t) -> DataFrame:
    """Stored speakers linked by URL."""
    return link.by_url(stored(t, "speakers"), _members(t))


def _bill_speakers(t) -> DataFrame:
    return pending.bill_speakers(stored(t, "bill_mention_speakers"), stored(t, "bill_mentions"), _linked(t), stored(t, "bills"), _members(t), 60)


MEMBER_OF = "case when speaker_url = '/m/user/' then 'User' end as member_name"
NUMBERS = f"(select name as bill, arg_max(bill_number, (date, url, section_ord, sub_ord)) filter (bill_number is not null) as bill_number from {BILLS} group by name)"
PENDING_BILLS = f"(select i.*, bill_number, {MEMBER_OF} from {IN_BILL} i join {NUMBERS} n using (bill) order by date, bill, sitting_url, stage nulls first, speaker_name, speaker_url nulls first limit 60)"


@query(f"select bill, sitting_url, stage, speaker_name, house, date, bill_number, member_name, contributions_text from {PENDING_BILLS}")
def pending_bill_speakers(t):
    return _bill_speakers(t).select("bill", "sitting_url", "stage", "speaker_name", "house", "date", "bill_number", "member_name", "contributions_text")


PENDING_TOPICS = f"(select i.*, h.house, h.date, {MEMBER_OF} from {IN_TOPIC} i join {HEADS} h on h.url = i.sitting_url order by h.date, sitting_url, section_type, title, speaker_name, speaker_url nulls first limit 40)"


@query(f"select sitting_url, title, speaker_name, house, date, member_name, contributions_text from {PENDING_TOPICS}")
def pending_topic_speakers(t):
    return pending.topic_speakers(stored(t, "topic_speakers"), stored(t, "topics"), stored(t, "sittings"), _linked(t), _members(t), 40).select("sitting_url", "title", "speaker_name", "house", "date", "member_name", "contributions_text")


def _topics(t) -> DataFrame:
    return pending.topics(stored(t, "topics"), stored(t, "sittings").withColumnRenamed("raw", "sections"), 30)


PENDING_OPEN_TOPICS = f"(select t.*, h.house from {TOPICS} t join {HEADS} h on h.url = t.sitting_url order by t.date desc, sitting_url limit 30)"


@query(f"select sitting_url, section_type, title, speech_count, house, date from {PENDING_OPEN_TOPICS}")
def pending_topics(t):
    return _topics(t).select("sitting_url", "section_type", "title", "speech_count", "house", "date")


def _mentions(t) -> DataFrame:
    return pending.mentions(stored(t, "bill_mentions"), stored(t, "bills"), stored(t, "sittings").withColumnRenamed("raw", "sections"), 45)


PENDING_MENTIONS = f"(select name as bill, url as sitting_url, stage, section_title, speech_count, house, date, n.bill_number from {BILLS} b join {NUMBERS} n on n.bill = b.name where speech_count > 0 order by date desc, name, url, stage nulls first limit 45)"


@query(f"select * from {PENDING_MENTIONS}")
def pending_mentions(t):
    return _mentions(t).select("bill", "sitting_url", "stage", "section_title", "speech_count", "house", "date", "bill_number")


def _journeys(t) -> DataFrame:
    mentions = stored(t, "bill_mentions").withColumn("summary", F.when(F.col("sitting_url").endswith("3"), F.concat(F.lit("sum "), F.col("sitting_url"))))
    return pending.journeys(stored(t, "bills"), mentions, stored(t, "bill_mention_speakers"), 9)


SPEAKERS_TEXT = f"(select bill, sitting_url, string_agg(contributions_text, chr(10) || chr(10) order by speaker_name, speaker_url nulls first, contributions_text) as speakers_text from {IN_BILL} group by all)"
JOURNEYS = f"(select m.name, m.date, m.url, m.house, m.stage, m.section_title, case when ends_with(m.url, '3') then 'sum ' || m.url end as summary, x.speakers_text from {BILLS} m left join {SPEAKERS_TEXT} x on x.bill = m.name and x.sitting_url = m.url)"


@query(f"select name, count(*) as n, count(speakers_text) as n_spoken, string_agg(concat_ws('|', date, url, house, coalesce(stage, '-'), section_title, coalesce(summary, '-'), coalesce(speakers_text, '-')), ';' order by date, url) as mentions from {JOURNEYS} group by name")
def journey_pending(t):
    shown = F.transform("mentions", lambda m: F.concat_ws("|", m["date"].cast("string"), m["sitting_url"], m["house"], F.coalesce(m["stage"], F.lit("-")), m["section_title"], F.coalesce(m["summary"], F.lit("-")), F.coalesce(m["speakers_text"], F.lit("-"))))
    return _journeys(t).select("name", F.size("mentions").cast("long").alias("n"), F.size(F.filter("mentions", lambda m: m["speakers_text"].isNotNull())).cast("long").alias("n_spoken"), F.array_join(shown, ";").alias("mentions"))


@query(f"select name, 'Summarise how this bill went through parliament.' || chr(10) || 'Bill: ' || name || chr(10) || coalesce('Bill number: ' || bill_number || chr(10), '') || 'Sittings: ' || n || chr(10) || chr(10) || lines as prompt from (select name, count(*) as n, string_agg(k || '. ' || date || ' | ' || house || ' | ' || coalesce(stage, 'Unknown stage') || chr(10) || '   ' || coalesce(summary, speakers_text, '(no record)') || chr(10), '' order by k) as lines from (select *, row_number() over (partition by name order by date, url) as k from {JOURNEYS}) group by name) join {NUMBERS} on bill = name")
def prompt_journey(t):
    none = F.lit(None).cast("string")
    return _journeys(t).select("name", prompts.journey(F.col("name"), F.col("bill_number"), none, none, F.col("mentions")).alias("prompt"))


APPEARANCE = "'Summarise one part of this sitting.' || chr(10) || 'House: ' || house || chr(10) || 'Date: ' || date || chr(10) || 'Session: Afternoon Sitting' || chr(10)"


@query(f"select sitting_url, {APPEARANCE} || 'Topic: ' || title || chr(10) || chr(10) || speech_count || ' speeches' as prompt from {PENDING_OPEN_TOPICS}")
def prompt_topic_appearance(t):
    none = F.lit(None).cast("string")
    return _topics(t).select("sitting_url", prompts.appearance("Topic", F.col("title"), none, none, F.col("house"), F.col("date"), F.col("session_type"), F.concat(F.col("speech_count").cast("string"), F.lit(" speeches"))).alias("prompt"))


@query(f"select bill, sitting_url, {APPEARANCE} || 'Bill: ' || bill || chr(10) || coalesce('Number: ' || bill_number || chr(10), '') || coalesce('Stage: ' || stage || chr(10), '') || chr(10) || section_title as prompt from {PENDING_MENTIONS}")
def prompt_bill_appearance(t):
    return _mentions(t).select("bill", "sitting_url", prompts.appearance("Bill", F.col("bill"), F.col("bill_number"), F.col("stage"), F.col("house"), F.col("date"), F.col("session_type"), F.col("section_title")).alias("prompt"))


@query(f"select url, 'Summarise this sitting.' || chr(10) || 'House: ' || house || chr(10) || 'Date: ' || date || chr(10) || 'Session: Afternoon Sitting' || chr(10) || case when cast(substr(url, 4) as int) % 3 = 0 then 'Existing summary: told' || chr(10) else '' end || chr(10) || 'said' as prompt from {HEADS} order by date desc, url limit 25")
def prompt_sitting(t):
    rows = pending.sittings(stored(t, "sittings"), 25)
    return rows.select("url", prompts.sitting(F.col("house"), F.col("date"), F.col("session_type"), F.col("summary"), F.lit("said")).alias("prompt"))


@query("select conv_id, trim(arg_max(text, turn) filter (role = 'assistant')) as last from conversations group by conv_id")
def last_message(t):
    out = F.transform(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))), lambda x: F.struct(F.when(x["role"] == "assistant", "message").otherwise("reasoning").alias("type"), x["text"].alias("content")))
    return t("conversations").groupBy("conv_id").agg(out.alias("out")).select("conv_id", prompts.last_message(F.col("out")).alias("last"))


class Upper:
    """A summarizer that shouts, and fails on texts of odd length."""

    def summarize(self, prompt: str) -> str:
        if len(prompt) % 2:
            raise ValueError("odd")
        return prompt.upper()

    def embed(self, said: str) -> list[float]:
        return [float(len(said)), 0.5]


@query(f"select sitting_url, section_type, title, speech_count, case when length(sitting_url) % 2 = 0 then upper(sitting_url) end as summary, case when length(sitting_url) % 2 = 0 then 'loud' end as summary_model from {TOPICS}")
def store_summaries(t):
    topics = stored(t, "topics")
    return pending.store(topics, "topics", pending.answer(topics.withColumn("prompt", F.col("sitting_url")), "prompt", Upper, "loud"))


def _told(name: str, rows: str, key: str) -> str:
    return f"select '{name}' as target, count(*) as n, cast(sum(length({key}) + 11) as bigint) as characters from {rows}"


_BILL_ROWS = f"(select distinct name from {BILLS})"


@query(" union all ".join([_told("sittings", HEADS, "url"), _told("bills", _BILL_ROWS, "name"), _told("bill_mentions", BILLS, "section_title"), _told("bill_mention_speakers", IN_BILL, "contributions_text"), _told("topics", TOPICS, "title"), _told("topic_speakers", IN_TOPIC, "contributions_text")]))
def store_summaries_of_all(t):
    """Every stored table that takes summaries gets them: how many, and of how many characters."""
    prompts_ = {"sittings": "url", "bills": "name", "bill_mentions": "section_title", "bill_mention_speakers": "contributions_text", "topics": "title", "topic_speakers": "contributions_text"}
    out = None
    for name, (_, renamed) in pending.TARGETS.items():
        rows = stored(t, name)
        done = pending.store(rows, name, pending.answer(rows.withColumn("prompt", F.col(prompts_[name])), "prompt", Echo, "echo", pending.calls(name)))
        own = done.select(F.lit(name).alias("target"), F.col(renamed.get("summary", "summary")).alias("s")).groupBy("target").agg(F.count("s").alias("n"), F.sum(F.length("s")).alias("characters"))
        out = own if out is None else out.unionByName(own)
    return out


@query(f"select url, house, cast(strlen(url) as double) as size, case when cast(substr(url, 4) as int) % 3 = 0 then 'told' end as summary from {HEADS}")
def store_embeddings(t):
    rows = stored(t, "sittings")
    out = pending.store(rows, "sittings", pending.embedded(rows.select("url"), "url", Upper), ("embedding",))
    return out.select("url", "house", F.col("embedding")[0].cast("double").alias("size"), "summary")


class Echo:
    """A summarizer that says what it was asked."""

    def summarize(self, prompt: str) -> str:
        return f"{prompt} summarised"


class Counter:
    """A summarizer that says how long a prompt is."""

    def summarize(self, prompt: str) -> str:
        return f"{len(prompt)} characters"


def _reingested(t) -> sinks.Store:
    """A store that was summarised, embedded and linked, and then got all sittings once more as if none were known."""
    made = sinks.Store(t("region").sparkSession, sinks.scratch(t("region").sparkSession), 4)
    made.migrate()
    ingest.ingest_into(made, sittings(t))
    for name, column in (("bill_mention_speakers", "contributions_text"), ("topics", "title"), ("bills", "name")):
        rows = made.read(name)
        made.write(name, pending.store(rows, name, pending.answer(rows.withColumn("prompt", F.col(column)), "prompt", Counter, "count")))
    rows = made.read("sittings")
    made.write("sittings", pending.store(rows, "sittings", pending.embedded(rows.select("url"), "url", Upper), ("embedding",)))
    ingest.link_into(made, _members(t).withColumns({"house": F.lit("Senate"), "parliament": F.lit("13th-parliament")}))
    for name, rows in ingest.tables(sittings(t)).items():
        made.upsert(name, rows, ingest.ORDER)
    return made


@query(f"select bill, sitting_url, stage, speaker_name, speech_count, length(contributions_text) || ' characters' as summary, 'count' as summary_model from {IN_BILL}")
def reingest_keeps_summaries(t):
    return _reingested(t).read("bill_mention_speakers").select("bill", "sitting_url", "stage", "speaker_name", "speech_count", "summary", "summary_model")


@query(f"""select distinct 'speaker' as kind, speaker_name as name, case when speaker_url = '/m/user/' then speaker_url when speaker_name = 'assistant' then '/m/assistant/' end as link from {SAID} where speaker_name <> 'Hon.'
    union all select 'sitting', url, cast(strlen(url) as varchar) from {HEADS} union all select 'bill', name, length(name) || ' characters' from {BILLS} group by name""")
def reingest_keeps_links(t):
    """Links of speakers, embeddings of sittings and summaries of bills after all sittings came again."""
    made = _reingested(t)
    speakers = made.read("speakers").select(F.lit("speaker").alias("kind"), "name", F.col("member_url").alias("link"))
    embedded = made.read("sittings").select(F.lit("sitting").alias("kind"), F.col("url").alias("name"), F.col("embedding")[0].cast("int").cast("string").alias("link"))
    return speakers.unionByName(embedded).unionByName(made.read("bills").select(F.lit("bill").alias("kind"), "name", F.col("summary").alias("link")))


@query(f"select count(*) filter (cast(substr(url, 4) as int) % 3 > 0) as ingested, count(*) filter (cast(substr(url, 4) as int) % 3 = 0) as skipped, 0 as failed, (select count(*) from {SAID} where speaker_name <> 'Hon.') as speeches from {HEADS}")
def ingest_run_stats(t):
    """A third of the sittings is stored, then all come: what the second run says it did, and that no speech counts twice."""
    made = sinks.Store(t("region").sparkSession, sinks.scratch(t("region").sparkSession), 4)
    made.migrate()
    all_ = sittings(t)
    ingest.ingest_into(made, all_.filter("cast(substr(url, 4) as int) % 3 = 0"))
    told = ingest.ingest_into(made, all_)
    return made.read("sitting_speakers").agg(*[F.lit(n).cast("long").alias(k) for k, n in told.items()], F.sum("speech_count").alias("speeches"))


# Linking. Speakers are customers: some known by URL, some by name, some by their office.
def _customers(t) -> DataFrame:
    key = F.col("c_custkey")
    name = F.when(key % 7 == 0, "Hon. Speaker").when(key % 7 == 1, "The Deputy Speaker").otherwise(F.concat(F.lit("Hon. Kamau "), F.element_at(F.array(*map(F.lit, ("Otieno", "Wanjiru", "Cherono"))), (key % 3 + 1).cast("int")), F.lit(" "), F.col("c_mktsegment")))
    return t("customer").select(key.alias("id"), name.alias("name"), F.when(key % 5 == 2, F.concat(F.lit("/m/"), (key % 40).cast("string"), F.lit("/"))).alias("url"), F.lit(None).cast("string").alias("member_url"))


def _seats(t) -> DataFrame:
    key = F.col("n_nationkey")
    surname, segment = (F.element_at(F.array(*map(F.lit, x)), (key % len(x) + 1).cast("int")) for x in (("Otieno", "Wanjiru", "Cherono"), ("BUILDING", "MACHINERY", "HOUSEHOLD", "FURNITURE", "AUTOMOBILE")))
    return t("nation").select(F.concat(F.lit("Kamau "), surname, F.lit(" "), segment).alias("name"), F.concat(F.lit("/m/"), key.cast("string"), F.lit("/")).alias("url"), F.when(key == 3, "Speaker").when(key == 4, "First Deputy Speaker").alias("role"), F.lit("National Assembly").alias("house"), F.lit("13th-parliament").alias("parliament"))


CUSTOMERS = "(select c_custkey as id, case c_custkey % 7 when 0 then 'Hon. Speaker' when 1 then 'The Deputy Speaker' else 'Hon. Kamau ' || list_extract(['Otieno', 'Wanjiru', 'Cherono'], c_custkey % 3 + 1) || ' ' || c_mktsegment end as name, case when c_custkey % 5 = 2 then '/m/' || (c_custkey % 40) || '/' end as url from customer)"
SEATS = "(select 'Kamau ' || list_extract(['Otieno', 'Wanjiru', 'Cherono'], n_nationkey % 3 + 1) || ' ' || list_extract(['BUILDING', 'MACHINERY', 'HOUSEHOLD', 'FURNITURE', 'AUTOMOBILE'], n_nationkey % 5 + 1) as name, '/m/' || n_nationkey || '/' as url from nation)"
TRIGRAMS = "flatten(list_transform(list_filter(regexp_split_to_array(lower({0}), '[^a-z0-9]+'), lambda w: w <> ''), lambda w: list_transform(range(1, length(w) + 2), lambda i: substr('  ' || w || ' ', i, 3))))"
#: The larger of similarity and word similarity: the best extent of b's trigrams that begins and ends with a shared one.
SCORE = """greatest(len(list_intersect(list_distinct(ta), list_distinct(tb))) / len(list_distinct(list_concat(ta, tb))), coalesce(list_max(flatten(list_transform(list_filter(range(1, len(tb) + 1), lambda i: list_contains(ta, tb[i])),
    lambda i: list_transform(list_filter(range(i, len(tb) + 1), lambda j: list_contains(ta, tb[j])), lambda j: len(list_intersect(list_distinct(ta), list_distinct(tb[i:j]))) / len(list_distinct(list_concat(ta, tb[i:j]))))))), 0))"""
CLEAN = "replace({0}, 'Hon. ', '')"
#: Only the offices differ under the cleaning of names; neither has a seat of that name.
OPEN = f"(select distinct name, {TRIGRAMS.format(CLEAN.format('name'))} as ta from {CUSTOMERS} where url is null and name not like '%Speaker')"
BEST = f"(select name, arg_max(url, (score, -rank)) as m from (select n.name, m.url, {SCORE} as score, row_number() over (partition by n.name order by m.url) as rank from {OPEN} n cross join (select *, {TRIGRAMS.format('name')} as tb from {SEATS}) m) where score >= 0.45 group by name)"


@query(f"select id, c.name, c.url, b.m as member_url from {CUSTOMERS} c left join {BEST} b on b.name = c.name and c.url is null")
def link_by_name(t):
    return link.by_name(_customers(t), _seats(t)).select("id", "name", "url", "member_url")


@query(f"select id, name, url, case when id % 14 = 7 then '/m/3/' when id % 14 = 1 then '/m/4/' end as member_url from {CUSTOMERS} where id % 7 < 2")
def link_by_role(t):
    """Presiding officers whose id is odd spoke in the assembly."""
    speakers = _customers(t).filter("id % 7 < 2")
    spoke = speakers.filter("id % 2 = 1").select(F.lit("/s/1").alias("sitting_url"), F.col("name").alias("speaker_name"), F.col("url").alias("speaker_url"))
    sittings_ = t("region").limit(1).select(F.lit("/s/1").alias("url"), F.lit("National Assembly").alias("house"))
    there = link.by_role(speakers.filter("id % 2 = 1"), _seats(t), spoke, sittings_)
    return there.unionByName(link.by_role(speakers.filter("id % 2 = 0"), _seats(t), spoke.limit(0), sittings_)).select("id", "name", "url", "member_url")


@query(f"select id, sponsor, b.m as sponsor_url from (select id, name as sponsor from {CUSTOMERS} where url is null and name not like '%Speaker') left join {BEST} b on b.name = sponsor")
def link_bill_sponsors(t):
    bills = _customers(t).filter("url is null and name not like '%Speaker'").select("id", F.col("name").alias("sponsor"))
    return link.link_sponsors(bills, _seats(t), 0.45).select("id", "sponsor", "sponsor_url")


@query(f"select count(*) as linked from {CUSTOMERS} c join {SEATS} m on c.url = m.url")
def link_counts(t):
    before = _customers(t)
    return link.filled(before, link.by_url(before, _seats(t)), ["id", "name", "url"]).agg(F.count("*").alias("linked"))


@query(f"select n.name, m.name as member_name, m.url as member_url, round(m.score, 6) as score, m.rank from {OPEN} n join (select *, row_number() over (partition by asked order by score desc, url) as rank from (select n.name as asked, m.name, m.url, {SCORE} as score from {OPEN} n cross join (select *, {TRIGRAMS.format('name')} as tb from {SEATS}) m) where score >= 0.3) m on m.asked = n.name where m.rank <= 5")
def match_topk(t):
    names = _customers(t).filter("url is null and name not like '%Speaker'").select("name").distinct()
    return link.match_members(names, _seats(t)).select("name", "member_name", "member_url", F.round("score", 6).alias("score"), F.col("rank").cast("long").alias("rank"))


@query(f"select n.name, m.name as member_name, m.url as member_url, round(m.score, 6) as score from {OPEN} n join (select *, row_number() over (partition by asked order by score desc, url) as rank from (select n.name as asked, m.name, m.url, {SCORE} as score from {OPEN} n cross join (select *, {TRIGRAMS.format('name')} as tb from {SEATS}) m) where score >= 0.45) m on m.asked = n.name where m.rank <= 5")
def match_member_sql(t):
    """The table function beside each name, in SQL."""
    spark = t("nation").sparkSession
    sql.register(spark, _seats(t).withColumn("constituency", F.lit(None).cast("string")))
    names = _customers(t).filter("url is null and name not like '%Speaker'").select("name").distinct()
    return spark.sql("select n.name, m.name as member_name, m.url as member_url, round(m.score, 6) as score from {names} n, lateral match_member(n.name, 0.45D) m", names=names)


@query(f"select distinct name, {CLEAN.format('name')} as clean, name = 'Kamau' as same from {CUSTOMERS} where name not like '%Speaker'")
def clean_name_sql(t):
    spark = t("nation").sparkSession
    sql.register(spark)
    return spark.sql("select distinct name, clean_speaker_name(name) as clean, similarity(name, 'Kamau') = 1 as same from {names} where name not like '%Speaker'", names=_customers(t).select("name"))


@query("select l_orderkey, l_linenumber, l_suppkey from lineitem where l_suppkey not in (select s_suppkey from supplier where s_acctbal < 2000)")
def delete_using(t):
    gone = t("supplier").filter("s_acctbal < 2000").select(F.col("s_suppkey").alias("l_suppkey"))
    return fold.delete(t("lineitem").select("l_orderkey", "l_linenumber", "l_suppkey"), gone, ["l_suppkey"])


# Stores and sinks: written to the shared folder and read again.

@query("select n_nationkey, n_name, cast(n_regionkey as int) as n_regionkey, cast(null as varchar) as none, [n_name, 'x'] as names from nation")
def sink_json(t):
    rows = t("nation").select("*", F.lit(None).cast("string").alias("none"), F.array("n_name", F.lit("x")).alias("names"))
    path = sinks.scratch(rows.sparkSession) + "/json"
    sinks.write_json(rows, path)
    return rows.sparkSession.read.schema(rows.schema).json(path)


@query("""select n_nationkey, n_name, '["' || n_name || '","x"]' as names from nation""")
def sink_csv(t):
    rows = t("nation").select("n_nationkey", "n_name", F.array("n_name", F.lit("x")).alias("names"))
    path = sinks.scratch(rows.sparkSession) + "/csv"
    sinks.write_csv(rows, path)
    return rows.sparkSession.read.csv(path, header=True, schema="n_nationkey int, n_name string, names string", escape='"')


@query("select o_orderkey, o_orderstatus from orders where o_orderstatus = 'F'")
def sink_parquet(t):
    rows = t("orders").select("o_orderkey", "o_orderstatus")
    path = sinks.scratch(rows.sparkSession) + "/parquet"
    sinks.write_parquet(rows, path, ["o_orderstatus"])
    return rows.sparkSession.read.parquet(path).filter("o_orderstatus = 'F'").select("o_orderkey", "o_orderstatus")


@query("select distinct name, url from (select 'N' || n_nationkey as name, '/m/' || (n_nationkey % 10) || '/' as url from nation)")
def store_upsert(t):
    """Two batches into the stored speakers: the second repeats the first."""
    rows = t("nation").select(F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("name"), F.concat(F.lit("/m/"), (F.col("n_nationkey") % 10).cast("string"), F.lit("/")).alias("url"), F.lit(1).alias("n"))
    kept = sinks.Store(rows.sparkSession, sinks.scratch(rows.sparkSession))
    kept.migrate()
    for part in ("n_regionkey < 3", "n_regionkey >= 0"):
        kept.upsert("speakers", rows.join(t("nation").filter(part).select(F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("name")), "name"), ["n"])
    return kept.read("speakers").select("name", "url")


@query("select n_name as name, cast(n_nationkey as bigint) as value, '[' || n_nationkey || ']' as list from nation")
def rows_to_frame(t):
    """Records as the JSON of a client, one object or a list, to a table of a declared schema."""
    said = t("nation").select(F.to_json(F.struct(F.col("n_name").alias("name"), F.col("n_nationkey").alias("value"), F.array("n_nationkey").alias("list"))).alias("j"))
    return sinks.frame(said, "j", "name string, value long, list array<int>").select("name", "value", F.to_json("list").alias("list"))


@query("select c_custkey, case when c_custkey % 3 = 0 then null else date '2024-01-01' + cast(c_custkey % 300 as int) end as start from customer")
def date_arguments(t):
    given = F.when(F.col("c_custkey") % 3 == 0, "1/2/2024").otherwise(F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("c_custkey") % 300).cast("int")), "yyyy-MM-dd"))
    return t("customer").select("c_custkey", text.date_argument(given).alias("start"))


@query("select c_custkey, case c_custkey % 4 when 0 then 'senate' when 1 then 'national-assembly' when 2 then 'national-assembly' end as slug, case c_custkey % 4 when 0 then 'Senate' when 1 then 'National Assembly' when 2 then 'National Assembly' end as name from customer")
def house_forms(t):
    given = F.element_at(F.array(*map(F.lit, ("senate", "national_assembly", "na", "lords"))), (F.col("c_custkey") % 4 + 1).cast("int"))
    return t("customer").select("c_custkey", text.house_slug(given).alias("slug"), text.house_name(given).alias("name"))


@query("select count(*) as count, string_agg(n_nationkey || ':' || n_name, ',' order by n_nationkey) as data from (select * from nation order by n_nationkey limit 10 offset 5)")
def list_envelope(t):
    out = listing.envelope(t("nation").select("n_nationkey", "n_name"), ["n_nationkey"], 5, 10)
    return out.select("count", F.array_join(F.transform("data", lambda x: F.concat_ws(":", x["n_nationkey"].cast("string"), x["n_name"])), ",").alias("data"))
