"""DataFrame sources: saved pages (url, html) to listings, sittings, members and profiles.

Files stand for the network: a page is a row, fetched once, parsed where it lies. A page that cannot be parsed gives no
rows and stops nothing; `parsed` shows it with its error, and an observation counts it in the job that reads the pages.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions import text
from . import html

CONTRIBUTION = "struct<speaker_name:string,speaker_role:string,speaker_url:string,content:string,procedural_notes:array<string>>"
SECTIONS = f"array<struct<section_type:string,subsections:array<struct<title:string,contributions:array<{CONTRIBUTION}>>>,contributions:array<{CONTRIBUTION}>>>"
SITTING = f"house string, breadcrumb string, time string, pdf_url string, summary_box string, sections {SECTIONS}"
ARCHIVE_SITTING = f"parliament_number string, session_number string, session_type string, speaker_in_chair string, sections {SECTIONS}"
BILL = "name string, year string, status string"
VOTE = "date string, title string, url string, decision string"
ACTIVITY = "date string, topic string, contribution_type string, section_title string, sitting_url string, text_preview string, url string"
MEMBER = "name string, url string, role string, constituency string"
PERSON = "name string, summary string, party string, party_url string, email string, telephone string, position string, constituency string, constituency_url string"
#: Rows leave a task when pages of so many characters are parsed.
PAGES_AT_ONCE = 4 << 20


def _struct(fields: str) -> str:
    return "struct<" + ", ".join(f.replace(" ", ":", 1) for f in fields.split(", ")) + ">"


PROFILE_FIELDS = ["name string", "photo_url string", "biography string", "position_type string", "positions array<string>", "party string", "committees array<string>", "speeches_last_year int", "speeches_total int", f"bills array<{_struct(BILL)}>", "bills_total int", "bills_pages int", f"voting_patterns array<{_struct(VOTE)}>", f"activity array<{_struct(ACTIVITY)}>", "activity_pages int"]
PROFILE = ", ".join(PROFILE_FIELDS)


class PageOutOfRange(ValueError):
    """A page beyond the last one was asked for."""


def parsed(pages: DataFrame, function: Callable, schema: str, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_url, the rows (dict, list of dicts or None) that function makes of each page's html, and error: null, or why the
    page cannot be parsed, in a row of its own. Blank pages give none."""
    rows = pages.select(F.col(url_col).alias("page_url"), F.col(html_col).alias("html"))  # a filter here would have pages made twice
    schema = f"{schema}, error string"
    out = pages.sparkSession.createDataFrame([], schema).schema

    def run(batches):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        kinds = to_arrow_schema(out)

        def rows_of(urls, found):
            table = pa.Table.from_pylist(found, schema=kinds)
            return table.add_column(0, "page_url", pa.array(urls, pa.string())).combine_chunks().to_batches()

        for batch in batches:
            urls, found, size = [], [], 0
            for url, text in zip(*batch.columns, strict=True):  # one page of a batch is a Python text at a time
                page = text.as_py()
                if not page or not page.strip(" "):
                    continue
                try:
                    made = function(page)
                except Exception as e:  # noqa: BLE001  whatever a page holds, the others are parsed
                    made = {"error": f"{type(e).__name__}: {e}"[:500]}
                made = made if isinstance(made, list) else [made] if made else []
                urls += [url.as_py()] * len(made)
                found += made
                size += len(page)
                if size > PAGES_AT_ONCE:
                    yield from rows_of(urls, found)
                    urls, found, size = [], [], 0
            yield from rows_of(urls, found)

    return rows.mapInArrow(run, f"page_url string, {schema}")


def parse(pages: DataFrame, function: Callable, schema: str, told: Observation | None = None) -> DataFrame:
    """parsed() without the pages that cannot be; told: counts them (failed)."""
    rows = parsed(pages, function, schema)
    if told:
        rows = rows.observe(told, F.count_if(F.col("error").isNotNull()).alias("failed"))
    return rows.filter("error is null").drop("error")


def current_listings(pages: DataFrame, house: str | None = None) -> DataFrame:
    """house, date, url, title, session_type, start_time, end_time, source; titles without a date are skipped."""
    rows = parse(pages, html.listing_links, "position int, url string, title string").withColumn("at", text.title_date(F.col("title"))).filter("at is not null")
    none = F.lit(None).cast("string")
    out = rows.select(F.when(F.col("position") == 0, "National Assembly").otherwise("Senate").alias("house"), "at.date", "url", "title", "at.session_type", none.alias("start_time"), none.alias("end_time"), F.lit("current").alias("source"))
    return out.filter(F.col("house") == house) if house else out


def archive_listings(pages: DataFrame) -> DataFrame:
    rows = parse(pages, html.archive_links, "url string, title string").filter("url is not null").withColumn("at", text.archive_entry(F.col("url"), F.col("title"))).filter("at is not null")
    return rows.select("at.house", "at.date", F.when(F.col("url").startswith("http"), F.col("url")).otherwise(F.concat(F.lit(text.ARCHIVE_URL), "url")).alias("url"), "title", F.lit(None).cast("string").alias("session_type"), "at.start_time", "at.end_time", F.lit("archive").alias("source"))


def current_sittings(pages: DataFrame, told: Observation | None = None) -> DataFrame:
    rows = parse(pages, html.current_sitting, SITTING, told)
    at = F.coalesce(text.title_date(F.col("breadcrumb")), text.slug_date(F.col("page_url")))
    rows = rows.withColumn("at", at).filter("at is not null").withColumn("box", text.summary_parts(F.coalesce("summary_box", F.lit(""))))
    none = F.lit(None).cast("string")
    return rows.select("house", "at.date", F.col("page_url").alias("url"), "at.session_type", F.lit("current").alias("source"), "at.day_of_week", text.time_12h(F.col("time")).alias("start_time"), none.alias("end_time"), none.alias("parliament_number"), none.alias("session_number"), none.alias("speaker_in_chair"), "box.summary", "box.sentiment", "pdf_url", "sections")


def archive_sittings(pages: DataFrame, people: DataFrame | None = None) -> DataFrame:
    """Sittings of the archive. people (a result of `people`): adds speakers, the details of every page that a sitting's
    speakers link to, each once; speakers without a page stay as they are."""
    rows = parse(pages, html.archive_sitting, ARCHIVE_SITTING).withColumn("at", text.archive_entry(F.col("page_url"), F.lit(""), 2)).filter("at is not null")
    fix = lambda c: c.withField("speaker_name", text.fix_name_and_role(c["speaker_name"], c["speaker_role"])["name"]).withField("speaker_role", text.fix_name_and_role(c["speaker_name"], c["speaker_role"])["role"])
    sections = F.transform("sections", lambda s: s.withField("contributions", F.transform(s["contributions"], fix)))
    none = F.lit(None).cast("string")
    out = rows.select("at.house", "at.date", F.col("page_url").alias("url"), "session_type", F.lit("archive").alias("source"), none.alias("day_of_week"), "at.start_time", none.alias("end_time"), "parliament_number", "session_number", "speaker_in_chair", none.alias("summary"), none.alias("sentiment"), none.alias("pdf_url"), sections.alias("sections"))
    return out if people is None else with_speakers(out, people)


def with_speakers(sittings: DataFrame, people: DataFrame) -> DataFrame:
    """sittings with speakers: array of (speaker_url, details or null) of the distinct links of each, in order of the links."""
    links = sittings.select("url", F.explode(F.array_distinct(F.flatten(F.transform("sections", lambda s: F.transform(s["contributions"], lambda c: c["speaker_url"]))))).alias("speaker_url")).filter("speaker_url is not null")
    details = people.select(F.col("page_url").alias("_p"), F.struct(*[c for c in people.columns if c != "page_url"]).alias("details"))
    found = links.join(details, links.speaker_url == details["_p"], "left")
    found = found.groupBy(F.col("url").alias("_u")).agg(F.sort_array(F.collect_list(F.struct("speaker_url", "details"))).alias("speakers"))
    return sittings.join(found, sittings.url == found["_u"], "left").drop("_u")


def people(pages: DataFrame) -> DataFrame:
    """Person pages by page_url, with slug; blank pages and pages without a heading give none."""
    return parse(pages, html.person, PERSON).withColumn("slug", text.slug(F.col("page_url")))


def members(pages: DataFrame, house: str, parliament: str = "13th-parliament") -> DataFrame:
    """Members of all list pages of a house and parliament."""
    return parse(pages, html.members, MEMBER).select("name", text.member_url(F.col("url")).alias("url"), F.lit(house).alias("house"), F.lit(parliament).alias("parliament"), "role", "constituency")


def member_page(pages: DataFrame, house: str, page: int, parliament: str = "13th-parliament") -> DataFrame:
    """Members of one list page; a page that is another one than asked for is refused."""
    return members(checked(pages, page), house, parliament)


def members_both(assembly: DataFrame, senate: DataFrame, parliament: str = "13th-parliament") -> DataFrame:
    """Members of both houses; a house without pages has none."""
    return members(assembly, "National Assembly", parliament).unionByName(members(senate, "Senate", parliament))


def profiles(pages: DataFrame, *fields: str) -> DataFrame:
    """Profiles by page_url, with slug and absolute photo_url. fields: of the profile, beside its name; pages are read for these alone."""
    kinds = {f.split()[0]: f for f in PROFILE_FIELDS if not fields or f.split()[0] in ("name", *fields)}
    if unknown := set(fields) - kinds.keys():
        raise ValueError(f"profiles have no {', '.join(sorted(unknown))}")
    wanted = frozenset(kinds)
    rows = parse(pages, lambda page: html.profile(page, wanted), ", ".join(kinds.values())).withColumn("slug", text.slug(F.col("page_url")))
    return rows.withColumn("photo_url", text.absolute_photo(F.col("photo_url"))) if "photo_url" in kinds else rows


def full_profiles(pages: DataFrame, parts: DataFrame, told: Observation | None = None) -> DataFrame:
    """Profiles with the bills and the activity of their further pages, in order. parts: pages by the profile's URL and
    `?bills_page=2` or `?contributions_page=2`. Of each profile the pages are taken that its pagers count; one whose own pager
    says that it is another page is refused and counted (told: refused), as if it had not been fetched."""
    first = profiles(pages)
    base = lambda c: F.regexp_replace(c, "/+$", "")
    kinds = {"bills": f"array<{_struct(BILL)}>", "activity": f"array<{_struct(ACTIVITY)}>"}
    kind = F.when(F.col("page_url").contains("?bills_page="), "bills").when(F.col("page_url").contains("?contributions_page="), "activity")
    read = parse(parts.filter("url like '%?bills\\_page=%' or url like '%?contributions\\_page=%'"), html.profile_parts, ", ".join(f"{k}_current int, {k} {t}" for k, t in kinds.items()))
    read = read.select(base(F.regexp_extract("page_url", r"^([^?]*)", 1)).alias("_base"), F.regexp_extract("page_url", r"_page=(\d+)", 1).try_cast("int").alias("page"), kind.alias("kind"), *kinds, *[f"{k}_current" for k in kinds])
    item = lambda k: F.struct("page", (F.col(f"{k}_current").isNull() | (F.col(f"{k}_current") == F.col("page"))).alias("fits"), k)
    more = read.groupBy("_base").agg(*[F.sort_array(F.collect_list(F.when(F.col("kind") == k, item(k)))).alias(f"_{k}") for k in kinds])
    rows = first.withColumn("_at", base(F.col("page_url")))
    rows = rows.join(more, rows["_at"] == more["_base"], "left")
    in_range = lambda k: F.filter(F.coalesce(f"_{k}", F.array()), lambda x: x["page"].between(2, F.col(f"{k}_pages")))  # noqa: E731  pages that the profile's pager counts
    if told:
        rows = rows.observe(told, F.sum(sum(F.size(F.filter(in_range(k), lambda x: ~x["fits"])) for k in kinds)).alias("refused"))
    with_more = lambda k: F.concat(k, F.flatten(F.transform(F.filter(in_range(k), lambda x: x["fits"]), lambda x: x[k])))
    return rows.select(*[with_more(c).alias(c) if c in kinds else F.col(c) for c in first.columns])


def activities(pages: DataFrame, asked: int | None = None) -> DataFrame:
    """page_url and the contributions of a profile's activity pages; asked: of one page, by number."""
    return parse(pages if asked is None else checked(pages, asked, "activity"), html.activity, ACTIVITY)


def bills(pages: DataFrame, asked: int | None = None) -> DataFrame:
    """page_url and the bills of a profile's bill pages; asked: of one page, by number."""
    return parse(pages if asked is None else checked(pages, asked, "bills"), html.bills, BILL)


def votes(pages: DataFrame) -> DataFrame:
    return parse(pages, html.votes, VOTE)


def page_infos(pages: DataFrame, kind: str = "listing") -> DataFrame:
    """page_url, current, last of pages with a pager of the kind (listing, bills, activity)."""
    return parse(pages, lambda page: html.page_info(page, kind), "current int, last int")


def page_infos_of(pages: DataFrame, *kinds: str) -> DataFrame:
    """page_infos of several kinds, with kind, from one reading of the pages."""
    return parse(pages, lambda page: html.page_infos(page, kinds), "kind string, current int, last int")


def checked(pages: DataFrame, asked: int, kind: str = "listing") -> DataFrame:
    """pages (one page, asked for by number, in a row or several), or PageOutOfRange where a pager says it is another. A list
    without a pager is refused; parts of a profile (bills, activity) may have none."""
    infos = page_infos(pages, kind)
    for info in infos.filter(F.col("current") != asked).limit(1).collect():
        check_page(asked, info.current, info.last)
    if kind == "listing" and infos.isEmpty():
        raise PageOutOfRange(f"page {asked} has no pager")
    return pages


def check_page(asked: int, current: int, last: int) -> int:
    if asked != current:
        raise PageOutOfRange(f"page {asked} of {last}")
    return asked


def listing_page(pages: DataFrame, page: int, house: str | None = None) -> DataFrame:
    """Listings of one page, asked for by number."""
    return current_listings(checked(pages, page), house)
