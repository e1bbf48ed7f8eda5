"""Column expressions over transcript text: normalising, titles, bills, stages, names, dates and houses.

All stay in the JVM. Null in, null out unless a docstring says otherwise.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values, which must equal the reference's for equal results: lists, patterns and spellings.
NOISE_NAMES = ["hon", "hon.", "sen", "sen.", "hon. members", "hon members", "hon. member", "hon member", "hon. senators", "hon senators", "hon. senator", "hon senator", "hon. chairman", "hon chairman"]
TOPIC_SECTIONS = ["QUESTIONS AND STATEMENTS", "STATEMENTS", "STATEMENT", "NOTICES OF MOTIONS", "NOTICES OF MOTION", "NOTICE OF MOTION", "COMMUNICATION FROM THE CHAIR", "COMMUNICATIONS FROM THE CHAIR", "ADJOURNMENT"]
TITLE_STAGES = [
    ("First Reading", ["FIRST READING"]),
    ("Second Reading", ["SECOND READING"]),
    ("Third Reading", ["THIRD READING"]),
    ("Committee Stage", ["COMMITTEE OF THE WHOLE HOUSE", "IN THE COMMITTEE"]),
    ("Report Stage", ["CONSIDERATION OF REPORT", "CONSIDERATION OF THE REPORT", "CONSIDERATION OF SENATE AMENDMENTS", "SENATE AMENDMENTS TO THE"]),
    ("Mediation Approval", ["APPROVAL OF MEDIATED VERSION"]),
    ("Presidential Reservations", ["PRESIDENT'S RESERVATIONS", "AMENDMENTS RECOMMENDED BY H. E.", "PRESIDENTIAL MEMORANDA"]),
    ("Publication Period Reduction", ["REDUCTION OF PUBLICATION PERIOD"]),
]
STAGE_PREFIXES = [
    "APPROVAL OF MEDIATED VERSION OF THE ", "CONSIDERATION OF THE REPORT ON THE ", "CONSIDERATION OF REPORT ON SENATE AMENDMENTS TO THE ",
    "CONSIDERATION OF SENATE AMENDMENTS TO THE ", "CONSIDERATION OF REPORT OF THE ", "CONSIDERATION OF REPORT ON THE ",
    "CONSIDERATION OF THE PRESIDENT'S RESERVATIONS ON THE ", "CONSIDERATION OF ", "ADOPTION OF REPORT ON PETITION TO AMEND THE ",
    "ADOPTION OF MEDIATION COMMITTEE REPORT ON THE ", "ADOPTION OF REPORT ON THE ", "SENATE AMENDMENTS TO THE ",
    "AMENDMENTS RECOMMENDED BY H. E. THE PRESIDENT TO THE ", "PROCEDURE FOR DISPOSAL OF PRESIDENTIAL MEMORANDA ON THE ",
    "REDUCTION OF PUBLICATION PERIOD OF THE ", "SECOND READING OF THE ", "THIRD READING OF THE ", "FIRST READING OF THE ", "ADJOURNMENT OF DEBATE ON THE ",
]
NOT_BILLS = ["NG-CDF", "STATUTORY PROVISION", "CONSTITUENCY", "BIENNIAL REPORT", "MESSAGE FROM THE NATIONAL ASSEMBLY", "APPOINTMENT OF MEMBERS TO MEDIATION COMMITTEE", "ADJOURNMENT OF DEBATE"]
BILL_NUMBER = r"(?i)(?U)(National Assembly|Senate)\s+Bill\s+No\.?\s*(\d+)\s+of\s+(\d{4})"
BILL_CITATION = r"(?i)(?U)(Senates?|National Assembly) Bills? No\.?\s*\d+\s+Of\s+\d{4}"
READING = r"(?i)be read a (First|Second|Third) Time"
LISTING_TITLE = r"(?i)(?U)(\w+),\s+(\d+)\w*\s+(\w+),?\s+(\d{4})\s*[-–]\s*(.+)"
NAME_PREFIX = r"(?i)^(Hon\.|Sen\.)\s(Dr\.\s)?"
ROLE_PREFIX = r"(?i)^(The\s)?(Ayes|Noes|Teller|Temporary Speaker|Speaker|Chairperson|Majority Leader|Minority Leader|Majority Whip|Minority Whip)"
PRESIDING = r"(?i)^(The|Hon\.?)\s+(Temporary\s+)?(Deputy\s+)?(Speaker|Chairman|Chairlady|Chairperson|Chair|Deputy\s+Speaker)\s*"
# (Mrs stands before Mr, as Java takes the first alternative that fits.)
HONORIFICS = r"(?i)\b(?=\w)(Hon|Sen|Mrs|Mr|Ms|Madam|Mhe)\.?\s*"
PROFESSIONS = r"(?i)\(?(Dr|Prof|Eng|Rtd|Ret|SC|EGH|CBS|OGW|MBS|EBS|HSC|OBS|Capt|Maj|Col|Gen|Lt|Cdr)\.?\)?\s*"
MOVE = "I beg to move"
HOUSES = {"senate": ("senate", "Senate"), "national_assembly": ("national-assembly", "National Assembly"), "na": ("national-assembly", "National Assembly")}
ARCHIVE_HOST = "info.mzalendo.com"
ARCHIVE_URL, CURRENT_URL = "https://info.mzalendo.com", "https://mzalendo.com"


def squeeze(c: Column) -> Column:
    """Single spaces for runs of Unicode white space, none at the ends."""
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def parenthesised(c: Column) -> Column:
    """What stands between the first ( and the last ), or null."""
    return F.when(c.rlike(r"(?s)\(.*\)"), F.regexp_replace(F.regexp_extract(c, r"(?s)\((.*)\)", 1), r"(?U)^\s+|\s+$", ""))


def title_case(c: Column) -> Column:
    """Each word's first letter upper, what follows lower; what stands before the first letter stays."""
    def word(w: Column) -> Column:
        head = F.regexp_extract(w, r"^(\P{L}*)", 1)
        tail = F.substring(w, F.length(head) + 1, F.length(w))
        return F.concat(head, F.upper(F.substring(tail, 1, 1)), F.lower(F.substring(tail, F.lit(2), F.length(tail))))

    return F.array_join(F.transform(F.filter(F.split(squeeze(c), " "), lambda w: w != ""), word), " ")


def _any(u: Column, parts: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [u.contains(p) for p in parts])


def stage_from_title(c: Column) -> Column:
    u, out = F.upper(c), None
    for stage, parts in TITLE_STAGES:
        out = F.when(_any(u, parts), stage) if out is None else out.when(_any(u, parts), stage)
    return out


def stage_from_text(c: Column) -> Column:
    return F.when(c.rlike(READING), F.concat(F.initcap(F.regexp_extract(c, READING, 1)), F.lit(" Reading"))).when(F.upper(c).contains("COMMITTEE OF THE WHOLE HOUSE"), "Committee Stage")


def bill_name(c: Column) -> Column:
    """The canonical name of the bill a title is about, or null. Prefixes are tried in list order, one goes."""
    u = F.upper(F.regexp_replace(c, r"(?U)^\s+|\s+$", ""))
    prefixes = "|".join(p.replace(".", r"\.") for p in STAGE_PREFIXES)
    name = title_case(F.regexp_replace(F.regexp_replace(u, f"^({prefixes})", ""), "^THE ", ""))
    ok = (u.endswith("BILL") | u.endswith(" ACT")) & ~u.rlike("^[0-9]") & ~_any(u, NOT_BILLS) & name.rlike(r"^\p{L}") & (F.octet_length(name) >= 8)
    tidy = F.replace(F.replace(F.regexp_replace(name, r"No\.(\d)", "No. $1"), F.lit("s' "), F.lit("s ")), F.lit("'s "), F.lit("s "))
    return F.when(ok, tidy)


def bill_number(c: Column) -> Column:
    return F.when(c.rlike(BILL_NUMBER), squeeze(F.regexp_extract(c, BILL_NUMBER, 0)))


def bill_year(c: Column) -> Column:
    return F.regexp_extract(c, BILL_NUMBER, 3).try_cast("int")


def is_noise(c: Column) -> Column:
    """Names that are no speakers: by byte length, leading digit, motion phrase or list."""
    t = F.regexp_replace(c, r"(?U)^\s+|\s+$", "")
    return (F.octet_length(t) < 4) | (F.octet_length(t) > 150) | t.rlike("^[0-9]") | t.contains(MOVE) | F.lower(t).isin(NOISE_NAMES)


def is_topic_section(c: Column) -> Column:
    return F.upper(F.regexp_replace(c, r"(?U)^\s+|\s+$", "")).isin(TOPIC_SECTIONS)


def is_topic_title(c: Column) -> Column:
    u = F.upper(c)
    return (F.octet_length(c) >= 5) & ~u.endswith("BILL") & ~u.endswith(" ACT") & ~c.rlike(BILL_CITATION)


#: What cleaning a name replaces, in this order. Possessive and white space go at the first place only, and titles are taken out
#: of words too, as in the reference.
CLEANING = [
    (PRESIDING, ""),
    (r"(?s)^\s*\((.+)\)\s*$", "$1"),
    (HONORIFICS, ""),
    (PROFESSIONS, ""),
    (r"\s*\([^)]*\)\s*$", ""),
    (r"\s*\([^)]*$", ""),
    (r"[:);,]+\s*$", ""),
    (r"(?s)^(.*?)'s?\s", "$1 "),
    (r"(?s)^(.*?)\s+", "$1 "),
]


def clean_name(c: Column) -> Column:
    """A raw speaker name without roles, honours, titles and trailing parentheses."""
    return reduce(lambda x, step: F.regexp_replace(x, *step), CLEANING, F.trim(c))


def _of_house(c: Column, i: int) -> Column:
    out = None
    for key, forms in HOUSES.items():
        out = F.when(c == key, forms[i]) if out is None else out.when(c == key, forms[i])
    return out


def house_slug(c: Column) -> Column:
    return _of_house(c, 0)


def house_name(c: Column) -> Column:
    """senate, national_assembly or na (case counts) as shown and stored; else null."""
    return _of_house(c, 1)


def title_date(c: Column) -> Column:
    """date, day_of_week, session_type from a listing title; null if it has none."""
    part = lambda k: F.regexp_extract(c, LISTING_TITLE, k)
    date = F.to_date(F.try_to_timestamp(F.concat_ws(" ", part(2), F.initcap(part(3)), part(4)), F.lit("d MMMM yyyy")))
    return F.when(c.rlike(LISTING_TITLE) & date.isNotNull(), F.struct(date.alias("date"), part(1).alias("day_of_week"), F.regexp_replace(part(5), r"(?U)^\s+|\s+$", "").alias("session_type")))


def slug_date(url: Column) -> Column:
    """date, day_of_week, session_type from a slug such as dow-12th-february-2026-afternoon-sitting-2438."""
    slug = F.element_at(F.split(F.regexp_replace(url, "/+$", ""), "/"), -1)
    p = F.split(slug, "-")
    date = F.to_date(F.try_to_timestamp(F.concat_ws(" ", F.regexp_extract(F.get(p, F.lit(1)), r"^(\d+)", 1), F.initcap(F.get(p, F.lit(2))), F.get(p, F.lit(3))), F.lit("d MMMM yyyy")))
    rest = F.slice(p, F.lit(5), F.greatest(F.size(p) - 4, F.lit(0)))
    stop = F.coalesce(F.array_min(F.filter(F.transform(rest, lambda w, i: F.when(w.rlike(r"^\d+$"), i)), lambda i: i.isNotNull())), F.size(rest))
    words = F.transform(F.slice(rest, F.lit(1), stop), lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, F.lit(2), F.length(w))))
    return F.when((F.size(p) >= 5) & date.isNotNull(), F.struct(date.alias("date"), F.get(p, F.lit(0)).alias("day_of_week"), F.array_join(words, " ").alias("session_type")))


def time_12h(c: Column) -> Column:
    """HH:mm:ss of H:MM AM or PM; null if it isn't one."""
    h, m, half = (F.regexp_extract(c, r"^\s*(\d{1,2}):(\d{2})\s*([AaPp][Mm])\s*$", k) for k in (1, 2, 3))
    hour = h.try_cast("int")
    hour = F.when(F.upper(half) == "PM", F.when(hour == 12, 12).otherwise(hour + 12)).when(hour == 12, 0).otherwise(hour)
    return F.when((half != "") & (hour < 24) & (m.try_cast("int") < 60), F.format_string("%02d:%s:00", hour, m))


SHOWN_END = r"\bto\s+(\d{1,2}):(\d{2})\b"


def _clock(*parts: Column) -> Column:
    """HH:mm:ss of hour, minute and second; null if there is no such time."""
    h, m, s = (p.try_cast("int") for p in parts)
    return F.when(h.between(0, 23) & m.between(0, 59) & s.between(0, 59), F.format_string("%02d:%02d:%02d", h, m, s))


def end_time(c: Column) -> Column:
    """HH:mm:ss after "to"; null without one or if there is no such time."""
    return _clock(F.regexp_extract(c, SHOWN_END, 1), F.regexp_extract(c, SHOWN_END, 2), F.lit("0"))


def slug(url: Column) -> Column:
    """The last part of a URL."""
    return F.element_at(F.split(F.regexp_replace(url, "/+$", ""), "/"), -1)


def archive_entry(url: Column, shown: Column, least: int = 4) -> Column:
    """house, date, start_time, end_time of an archive link; null if it has fewer than `least` parts, if the last two are no
    house and date, or if it or the shown text names a time that there is not."""
    parts = F.filter(F.split(url, "/"), lambda x: x != "")
    stamp = F.split(F.get(parts, F.size(parts) - 1), "-")
    house = house_name(F.get(parts, F.size(parts) - 2))
    date = F.to_date(F.try_to_timestamp(F.array_join(F.slice(stamp, 1, 3), "-"), F.lit("yyyy-M-d")))
    start = _clock(*[F.get(stamp, F.lit(k)) for k in (3, 4, 5)])
    ok = (F.size(parts) >= least) & house.isNotNull() & date.isNotNull() & ((F.size(stamp) < 6) | start.isNotNull()) & ((F.regexp_extract(shown, SHOWN_END, 1) == "") | end_time(shown).isNotNull())
    return F.when(ok, F.struct(house.alias("house"), date.alias("date"), F.when(F.size(stamp) >= 6, start).alias("start_time"), end_time(shown).alias("end_time")))


def source_of(url: Column) -> Column:
    return F.when(url.contains(ARCHIVE_HOST) | url.contains("/hansard/sitting/"), "archive").otherwise("current")


def normal_url(url: Column) -> Column:
    """Absolute URLs stay; others get their source's base; current ones end without a slash."""
    rooted = F.when(url.startswith("/"), url).otherwise(F.concat(F.lit("/"), url))
    archive = source_of(url) == "archive"
    full = F.when(url.startswith("http"), url).when(archive, F.concat(F.lit(ARCHIVE_URL), rooted)).otherwise(F.concat(F.lit(CURRENT_URL), rooted))
    return F.when(archive, full).otherwise(F.regexp_replace(full, "/+$", ""))


def member_url(url: Column) -> Column:
    t = F.trim(url)
    return F.when(t.endswith("/"), t).otherwise(F.concat(t, F.lit("/")))


def absolute_photo(url: Column, base: str = CURRENT_URL) -> Column:
    return F.when(url.startswith("http"), url).otherwise(F.concat(F.lit(base), url))


def summary_parts(c: Column) -> Column:
    """summary and sentiment of a summary box; empty parts are null."""
    body = F.trim(F.regexp_replace(squeeze(c), "^Hansard Summary", ""))
    at = F.instr(body, "Sentimental Analysis")
    none = lambda x: F.when(x != "", x)
    return F.struct(none(F.trim(F.when(at > 0, F.substring(body, F.lit(1), at - 1)).otherwise(body))).alias("summary"), none(F.when(at > 0, F.trim(F.substring(body, at + 20, F.length(body)))).otherwise("")).alias("sentiment"))


def fix_name_and_role(name: Column, role: Column) -> Column:
    """name, role, with the three mix-ups of transcripts put right."""
    swap = (role.rlike(NAME_PREFIX)) & ((name.rlike(r"^[^,]+,\s*.+") & ~name.rlike(NAME_PREFIX)) | name.rlike(ROLE_PREFIX))
    inner, outer = F.regexp_extract(name, r"^(.+?)\s*\((.+?)\)$", 2), F.regexp_extract(name, r"^(.+?)\s*\((.+?)\)$", 1)
    split = role.isNull() & inner.rlike(NAME_PREFIX) & outer.rlike(ROLE_PREFIX)
    return F.struct(F.when(swap, role).when(split, F.trim(inner)).otherwise(name).alias("name"), F.when(swap, name).when(split, F.trim(outer)).otherwise(role).alias("role"))


def date_argument(c: Column) -> Column:
    """The date of a yyyy-MM-dd argument; null if it isn't one."""
    return F.when(c.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.to_date(F.try_to_timestamp(c, F.lit("yyyy-MM-dd"))))


def key(*parts: Column) -> Column:
    """A key of natural key parts; null differs from every text."""
    return F.sha2(F.concat_ws("\x1f", *[F.coalesce(F.concat(F.lit("="), p.cast("string")), F.lit("-")) for p in parts]), 256)
