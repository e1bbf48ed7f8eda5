"""Upserts as folds by key over what is stored and what comes in.

Parquet has no row updates; a fold unions both sides and aggregates by key once, whatever mix of policies the columns
have. Policies: new (the last row wins), keep (the first row wins), coalesce (the last value that isn't null
wins), add (sum), stay (the first value that isn't null wins: columns that ingestion does not own, such as links and summaries).
Every column of a stored table has one, so no fold loses a column. Rows are ordered by `order`, which must be total within a
key; a null is a value of the key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .extract import SECTIONS

POLICIES = {
    "new": lambda c, o: F.max_by(F.struct(c), o)[c],
    "keep": lambda c, o: F.min_by(F.struct(c), o)[c],
    "coalesce": lambda c, o: F.max_by(c, F.when(F.col(c).isNotNull(), o)),
    "add": lambda c, o: F.sum(c),
    "stay": lambda c, o: F.min_by(c, F.when(F.col(c).isNotNull(), o)),
}

# Declared schemas of the stored tables.
SCHEMAS = {
    "sittings": f"url string, house string, date date, session_type string, source string, summary string, sentiment string, pdf_url string, raw {SECTIONS}, generated_summary string, summary_model string, embedding array<float>",
    "speakers": "name string, url string, member_url string",
    "sitting_speakers": "sitting_url string, speaker_name string, speaker_url string, speech_count long",
    "bills": "name string, bill_number string, year int, sponsor string, sponsor_url string, summary string, summary_model string",
    "bill_mentions": "bill string, sitting_url string, stage string, house string, date date, section_title string, speech_count long, summary string, summary_model string",
    "bill_mention_speakers": "bill string, sitting_url string, stage string, speaker_name string, speaker_url string, speech_count long, contributions_text string, summary string, summary_model string",
    "topics": "sitting_url string, section_type string, title string, speech_count long, summary string, summary_model string",
    "topic_speakers": "sitting_url string, section_type string, title string, speaker_name string, speaker_url string, speech_count long, contributions_text string, summary string, summary_model string",
    "members": "url string, name string, house string, parliament string, role string, constituency string, biography string, photo_url string, position_type string, positions array<string>, party string, committees array<string>, speeches_last_year int, speeches_total int",
}
_SUMMARY = {"summary": "stay", "summary_model": "stay"}

# Key columns and policies of the stored tables.
TABLES = {
    "sittings": (["url"], {"house": "keep", "date": "keep", "session_type": "keep", "source": "keep", "summary": "coalesce", "sentiment": "coalesce", "pdf_url": "coalesce", "raw": "new", "generated_summary": "stay", "summary_model": "stay", "embedding": "stay"}),
    "speakers": (["name", "url"], {"member_url": "stay"}),
    "sitting_speakers": (["sitting_url", "speaker_name", "speaker_url"], {"speech_count": "add"}),
    "bills": (["name"], {"bill_number": "coalesce", "year": "coalesce", "sponsor": "coalesce", "sponsor_url": "stay", **_SUMMARY}),
    "bill_mentions": (["bill", "sitting_url", "stage"], {"house": "keep", "date": "keep", "section_title": "new", "speech_count": "new", **_SUMMARY}),
    "bill_mention_speakers": (["bill", "sitting_url", "stage", "speaker_name", "speaker_url"], {"speech_count": "new", "contributions_text": "new", **_SUMMARY}),
    "topics": (["sitting_url", "section_type", "title"], {"speech_count": "new", **_SUMMARY}),
    "topic_speakers": (["sitting_url", "section_type", "title", "speaker_name", "speaker_url"], {"speech_count": "new", "contributions_text": "new", **_SUMMARY}),
    "members": (["url"], {"name": "new", "house": "keep", "parliament": "keep", "role": "coalesce", "constituency": "coalesce", "biography": "stay", "photo_url": "stay", "position_type": "stay", "positions": "stay", "party": "stay", "committees": "stay", "speeches_last_year": "stay", "speeches_total": "stay"}),
}
SUMMARIES = ["summary", "summary_model"]
#: What a profile says of a member, beyond the listing.
DETAILS = ["biography", "photo_url", "position_type", "positions", "party", "committees", "speeches_last_year", "speeches_total"]


def fold(rows: DataFrame, keys: list[str], policies: dict[str, str], order: list[str | Column]) -> DataFrame:
    o = F.struct(*order)
    aggs = [POLICIES[p](c, o).alias(c) for c, p in policies.items()]
    return rows.groupBy(*keys).agg(*aggs) if aggs else rows.select(*keys).distinct()


def complete(rows: DataFrame, table: str, also: list[str] = ()) -> list[Column]:
    """Every column of the stored table as rows have it, null where they have not; other columns than these and `also` are refused."""
    fields = StructType.fromDDL(SCHEMAS[table]).fields
    unknown = set(rows.columns) - {f.name for f in fields} - set(also)
    if unknown:
        raise ValueError(f"{table} has no columns {', '.join(sorted(unknown))}")
    return [(F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in fields]


def upsert(existing: DataFrame | None, incoming: DataFrame, table: str, order: list[str]) -> DataFrame:
    """All columns of the stored table after the fold; existing rows come before all incoming ones."""
    keys, policies = TABLES[table]
    rows = incoming.select(*complete(incoming, table, order), F.struct(F.lit(1).alias("batch"), *order).alias("_o"))
    if existing is not None:
        first = F.struct(F.lit(0).alias("batch"), *[F.lit(None).cast(incoming.schema[c].dataType).alias(c) for c in order])
        rows = existing.select(*complete(existing, table), first.alias("_o")).unionByName(rows)
    return fold(rows, keys, policies, ["_o"]).select(*StructType.fromDDL(SCHEMAS[table]).names)


def enrich(base: DataFrame, new: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """base with columns overwritten by new's where new has a value (an empty list is one)."""
    n = new.select(F.col(key).alias("_k"), *[F.col(c).alias(f"_{c}") for c in columns])
    return base.join(n, base[key] == n["_k"], "left").select(*[F.coalesce(f"_{c}", base[c]).alias(c) if c in columns else base[c] for c in base.columns])


def delete(rows: DataFrame, gone: DataFrame, on: list[str]) -> DataFrame:
    return rows.join(gone.select(*on), on, "left_anti")


def cascade(children: DataFrame, parents: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Children whose parent is left."""
    p = parents.select(F.col(parent_key).alias("_p"))
    return children.join(p, children[child_key] == p["_p"], "left_semi")


def set_null(children: DataFrame, parents: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    p = parents.select(F.col(parent_key).alias("_p")).distinct()
    return children.join(p, children[child_key] == p["_p"], "left").withColumn(child_key, F.col("_p")).drop("_p")


def stats(rows: DataFrame, flags: list[str]) -> DataFrame:
    """Sums of counters or flags of a run."""
    return rows.agg(*[F.coalesce(F.sum(F.col(f).cast("long")), F.lit(0)).alias(f) for f in flags])
