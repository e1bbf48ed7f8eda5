"""Texts for summarisers and embedders, built from columns. The wording is our own; the fields are the reference's."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _line(label: str, c: Column) -> Column:
    return F.coalesce(F.concat(F.lit(f"{label}: "), c.cast("string"), F.lit("\n")), F.lit(""))


def _spoken(c: Column) -> Column:
    return F.transform(F.filter(F.coalesce(c, F.array().cast("array<struct<speaker_name:string,speaker_role:string,speaker_url:string,content:string,procedural_notes:array<string>>>")), lambda x: F.trim(x["content"]) != ""), lambda x: F.concat(F.lit("["), F.coalesce(F.trim(x["speaker_name"]), F.lit("Unknown")), F.lit("]: "), F.trim(x["content"]), F.lit("\n")))


def _head(mark: str, c: Column) -> Column:
    return F.when(F.trim(c) != "", F.concat(F.lit(f"\n{mark} "), F.trim(c), F.lit("\n"))).otherwise("")


def transcript(sections: Column) -> Column:
    """A sitting as text: headings and [speaker]: content lines, sections' own contributions first."""
    sub = lambda x: F.concat(_head("###", x["title"]), F.array_join(_spoken(x["contributions"]), ""))
    return F.array_join(F.transform(sections, lambda s: F.concat(_head("##", s["section_type"]), F.array_join(_spoken(s["contributions"]), ""), F.array_join(F.transform(s["subsections"], sub), ""))), "")


def sitting_text(house: Column, date: Column, session: Column, summary: Column, titles: Column) -> Column:
    """For embedding: a head line, then the summary or else the titles."""
    return F.concat(F.concat_ws(" — ", house, date.cast("string"), session), F.lit("\n\n"), F.coalesce(summary, F.array_join(titles, "\n")))


def contribution(kind: str, member: Column, item: Column, house: Column, date: Column, stage: Column, said: Column) -> Column:
    return F.concat(F.lit("Summarise what this member said.\n"), _line("Member", member), _line(kind, item), _line("House", house), _line("Date", date), _line("Stage", stage), F.lit("\n"), said)


def appearance(kind: str, title: Column, number: Column, stage: Column, house: Column, date: Column, session: Column, text: Column) -> Column:
    return F.concat(F.lit("Summarise one part of this sitting.\n"), _line("House", house), _line("Date", date), _line("Session", session), _line(kind, title), _line("Number", number), _line("Stage", stage), F.lit("\n"), text)


def journey(name: Column, number: Column, year: Column, sponsor: Column, mentions: Column) -> Column:
    line = lambda m, i: F.concat((i + 1).cast("string"), F.lit(". "), F.concat_ws(" | ", m["date"].cast("string"), m["house"], F.coalesce(m["stage"], F.lit("Unknown stage"))), F.lit("\n   "), F.coalesce(m["summary"], m["speakers_text"], F.lit("(no record)")), F.lit("\n"))
    return F.concat(F.lit("Summarise how this bill went through parliament.\n"), _line("Bill", name), _line("Bill number", number), _line("Year", year), _line("Moved by", sponsor), _line("Sittings", F.size(mentions)), F.lit("\n"), F.array_join(F.transform(mentions, line), ""))


def sitting(house: Column, date: Column, session: Column, existing: Column, text: Column) -> Column:
    return F.concat(F.lit("Summarise this sitting.\n"), _line("House", house), _line("Date", date), _line("Session", session), _line("Existing summary", existing), F.lit("\n"), text)


def last_message(output: Column) -> Column:
    """Content of the last element of type message, trimmed."""
    return F.trim(F.get(F.filter(output, lambda x: x["type"] == "message"), F.size(F.filter(output, lambda x: x["type"] == "message")) - 1)["content"])
