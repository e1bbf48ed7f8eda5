"""Sittings to contributions, speakers, bills and topics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text


SPOKEN = "array<struct<speaker_name:string,speaker_role:string,speaker_url:string,content:string,procedural_notes:array<string>>>"
SECTIONS = f"array<struct<section_type:string,subsections:array<struct<title:string,contributions:{SPOKEN}>>,contributions:{SPOKEN}>>"


def contributions(sittings: DataFrame) -> DataFrame:
    """A row for each contribution, in visiting order: of a section its own ones first (sub_ord -1), then those of its
    subsections; flat: whether the section has no subsection. A part without contributions is a row without
    contrib_ord, so that it still counts as a part."""
    section = F.col("s")
    subs = F.coalesce(section["subsections"], F.array().cast(f"array<struct<title:string,contributions:{SPOKEN}>>"))
    own = F.struct(F.lit(-1).alias("ord"), F.lit(None).cast("string").alias("title"), section["contributions"].alias("c"))
    parts = F.concat(F.array(own), F.transform(subs, lambda x, i: F.struct(i.alias("ord"), x["title"].alias("title"), x["contributions"].alias("c"))))
    head = ["url", "house", "date", "section_ord"]
    rows = sittings.select("url", "house", "date", F.posexplode("sections").alias("section_ord", "s"))
    rows = rows.select(*head, section["section_type"].alias("section_type"), (F.size(subs) == 0).alias("flat"), F.explode(parts).alias("p"))
    rows = rows.select(*head, "section_type", "flat", F.col("p.ord").alias("sub_ord"), F.col("p.title").alias("title"), F.posexplode_outer("p.c").alias("contrib_ord", "x"))
    return rows.select(*head, "sub_ord", "contrib_ord", "section_type", "flat", "title", "x.*")


def ordered_text(order: list[str], value: str, glue: str) -> Column:
    """An aggregate: values joined in order."""
    return F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(*order, value))), lambda x: x[value]), glue)


def speakers(rows: DataFrame) -> DataFrame:
    """url, speaker_name, speaker_url, speech_count of each sitting, noise left out; a null url is a value."""
    return _named(rows).groupBy("url", "speaker_name", "speaker_url").agg(F.count("*").alias("speech_count"))


SEGMENT = ["url", "house", "date", "section_ord", "sub_ord", "section_type", "flat", "title"]


def _named(rows: DataFrame) -> DataFrame:
    return rows.filter("contrib_ord is not null").filter(~text.is_noise(F.col("speaker_name")))


def segments(rows: DataFrame) -> DataFrame:
    """A row for each section's own part (sub_ord -1) and each subsection: speech_count (noise included; 0 for an empty one),
    text (joined by newlines), mover."""
    moves = F.when(F.col("sub_ord") >= 0, F.lower("content").contains(text.MOVE.lower())).otherwise(F.col("content").contains(text.MOVE))
    return rows.groupBy(*SEGMENT).agg(F.count("contrib_ord").alias("speech_count"), ordered_text(["contrib_ord"], "content", "\n").alias("text"), F.min_by(F.when(moves, F.col("speaker_name")), F.when(moves, F.col("contrib_ord"))).alias("mover"))


def contributors(rows: DataFrame) -> DataFrame:
    """Of each segment and speaker: speech_count and contributions_text in document order, noise left out."""
    return _named(rows).groupBy(*SEGMENT, "speaker_name", "speaker_url").agg(F.count("*").alias("speech_count"), ordered_text(["contrib_ord"], "content", "\n\n").alias("contributions_text"))


def bills(rows: DataFrame) -> DataFrame:
    """Subsections, and sections without any, whose heading names a bill: name, bill_number, year, sponsor, stage (of the
    heading, else of the text), section_title, speech_count (0 for an empty one)."""
    return bills_of(segments(rows.filter("sub_ord >= 0 or flat")))


def bills_of(parts: DataFrame) -> DataFrame:
    """bills() of a result of segments()."""
    s = parts.filter("sub_ord >= 0 or flat").withColumn("heading", F.when(F.col("sub_ord") >= 0, F.col("title")).otherwise(F.col("section_type")))
    s = s.withColumn("name", text.bill_name(F.col("heading"))).filter("name is not null")
    return s.select("url", "house", "date", "section_ord", "sub_ord", "name", text.bill_number(F.col("text")).alias("bill_number"), text.bill_year(F.col("text")).alias("year"), F.col("mover").alias("sponsor"), F.coalesce(text.stage_from_title(F.col("heading")), text.stage_from_text(F.col("text"))).alias("stage"), F.col("heading").alias("section_title"), "speech_count")


def topics(rows: DataFrame) -> DataFrame:
    """Subsections of topic sections that are about no bill and have a speaker: section_type, title, speech_count."""
    rows = rows.filter("sub_ord >= 0")
    return topics_of(segments(rows.filter(_topic())), contributors(rows))


def _topic() -> Column:
    return text.is_topic_section(F.col("section_type")) & text.is_topic_title(F.col("title"))


def topics_of(parts: DataFrame, spoken: DataFrame) -> DataFrame:
    """topics() of results of segments() and contributors()."""
    s = parts.filter("sub_ord >= 0").filter(_topic())
    s = s.join(spoken.filter("sub_ord >= 0").select("url", "section_ord", "sub_ord").distinct(), ["url", "section_ord", "sub_ord"], "left_semi")
    return s.select("url", "date", "section_ord", "sub_ord", F.upper(F.trim("section_type")).alias("section_type"), text.title_case(F.col("title")).alias("title"), "speech_count")
