"""Sittings to all relational tables.

Sittings are written once to the shared folder, so each page is parsed once however many tables derive from it; their contributions
are exploded once, and what the tables share (parts of a sitting, and who spoke in them) is grouped once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..operators import extract, fold, link
from ..operators.sinks import Store, counted, remove, scratch

ORDER = ["date", "sitting_url", "section_ord", "sub_ord"]


@dataclass(frozen=True)
class Spread:
    """Sittings, and what the tables take from them, as written tables."""

    sittings: DataFrame
    speakers: DataFrame
    segments: DataFrame
    spoken: DataFrame


def _written(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(heads: DataFrame, at: str) -> Spread:
    """Writes under at, of written sittings, their contributions, and these by speaker, by part, by part and speaker."""
    rows = _written(extract.contributions(heads), f"{at}/contributions")
    return Spread(heads, *[_written(make(rows), f"{at}/{name}") for name, make in (("speakers", extract.speakers), ("segments", extract.segments), ("spoken", extract.contributors))])


def tables(sittings: DataFrame, at: str | None = None) -> dict[str, DataFrame]:
    """Incoming rows of every stored table, with the columns that order them; at: where to write what they share."""
    at = at or scratch(sittings.sparkSession)
    return _tables(spread(_written(sittings, f"{at}/sittings"), at))


def _tables(parts: Spread) -> dict[str, DataFrame]:
    own = lambda df: df.withColumnRenamed("url", "sitting_url")
    at_top = [F.lit(0).alias("section_ord"), F.lit(0).alias("sub_ord")]
    heads, spoken = parts.sittings, own(parts.spoken)
    bills, topics = own(extract.bills_of(parts.segments)), own(extract.topics_of(parts.segments, parts.spoken))
    counts = own(parts.speakers).join(heads.select(F.col("url").alias("sitting_url"), "date"), "sitting_url").select("*", *at_top)
    place = ["sitting_url", "section_ord", "sub_ord"]
    in_bill = spoken.drop("section_type", "title", "house", "date").join(bills.select(*place, F.col("name").alias("bill"), "stage", "date"), place)
    in_topic = spoken.drop("section_type", "title", "house", "date").join(topics.select(*place, "section_type", "title", "date"), place)
    out = {
        "sittings": heads.select("url", "house", "date", "session_type", "source", "summary", "sentiment", "pdf_url", F.col("sections").alias("raw"), F.col("url").alias("sitting_url"), *at_top),
        "speakers": counts.select(F.col("speaker_name").alias("name"), F.col("speaker_url").alias("url"), *ORDER),
        "sitting_speakers": counts,
        "bills": bills,
        "bill_mentions": bills.withColumnRenamed("name", "bill"),
        "bill_mention_speakers": in_bill,
        "topics": topics,
        "topic_speakers": in_topic,
    }
    known = lambda name: {*fold.TABLES[name][0], *fold.TABLES[name][1], *ORDER}
    return {name: df.select(*[c for c in df.columns if c in known(name)]) for name, df in out.items()}


def ingest(sittings: DataFrame, stored: dict[str, DataFrame] | None = None, at: str | None = None) -> dict[str, DataFrame]:
    """The stored tables after folding in the sittings not yet stored."""
    stored = stored or {}
    if "sittings" in stored:
        sittings = sittings.join(stored["sittings"].select("url"), "url", "left_anti")
    return {name: fold.upsert(stored.get(name), rows, name, ORDER) for name, rows in tables(sittings, at).items()}


def ingest_into(store: Store, sittings: DataFrame, told: Observation | None = None) -> dict[str, int]:
    """Folds the sittings not yet stored into the store; returns ingested, skipped (stored before) and failed (pages, as
    told by the observation that a page source was given). The counts come with the one write that reads the pages. Sittings are
    stored last: after a broken run they count as new, and what that run has left of them is replaced."""
    seen, at = Observation(), scratch(store.spark)
    all_ = _written(sittings.observe(seen, F.count(F.lit(1)).alias("n")), f"{at}/sittings")
    new = all_.join(store.read("sittings").select("url"), "url", "left_anti")
    incoming = _tables(spread(new, at))
    urls = new.select(F.col("url").alias("sitting_url")).distinct()
    ingested = new.count()
    for name in sorted(incoming, key=lambda name: name == "sittings"):
        left = urls if name != "sittings" and "sitting_url" in fold.TABLES[name][0] else None
        store.upsert(name, incoming[name], ORDER, left)
    remove(store.spark, at)
    return {"ingested": ingested, "skipped": counted(seen).get("n", 0) - ingested, "failed": counted(told).get("failed", 0) if told else 0}


def ingest_members(members: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """The stored members after folding in a listing (name, url, house, parliament, role, constituency)."""
    return fold.upsert(stored, members, "members", ["url"])


def enrich_members(members: DataFrame, profiles: DataFrame) -> DataFrame:
    """Stored members with what their profiles (by page_url) say, where they say anything."""
    new = profiles.select(F.col("page_url").alias("url"), *[F.col(c) for c in fold.DETAILS])
    return fold.enrich(members, new, "url", fold.DETAILS)


def link_all(tables: dict[str, DataFrame], members: DataFrame) -> tuple[dict[str, DataFrame], dict[str, int]]:
    """The stored tables with speakers and sponsors linked to members, and how many rows each link has filled."""
    speakers = tables["speakers"]
    to = link.link_speakers(speakers, members, tables["sitting_speakers"], tables["sittings"])
    bills = link.link_sponsors(tables["bills"], members)
    return tables | {"speakers": to, "bills": bills, "members": members}, {"speakers": link.linked(speakers, to, ["name", "url"]), "bills": link.linked(tables["bills"], bills, ["name"], "sponsor_url")}


def link_into(store: Store, members: DataFrame) -> dict[str, int]:
    """Links the stored speakers and sponsors to members, in the store; returns how many rows each link has filled."""
    kept = {name: store.read(name) for name in ("speakers", "bills", "sitting_speakers", "sittings")}
    linked, counts = link_all(kept, members)
    for name in counts:
        store.write(name, linked[name])
    return counts
