"""Entities: speakers to members, sponsors to members, and duplicate speakers to one.

The links go URL, name, role, each for what the ones before left open.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.trigram import match_members


def by_url(speakers: DataFrame, members: DataFrame) -> DataFrame:
    m = members.select(F.col("url").alias("_u"))
    return speakers.join(m, speakers.url == m["_u"], "left").withColumn("member_url", F.coalesce("member_url", "_u")).drop("_u")


def by_name(speakers: DataFrame, members: DataFrame, min_score: float = 0.45) -> DataFrame:
    """Speakers without url and longer than five characters get their best match."""
    open_ = speakers.filter("member_url is null and url is null and length(name) > 5").select("name").distinct()
    best = match_members(open_, members, min_score=min_score, top=1).select(F.col("name").alias("_n"), F.col("member_url").alias("_m"))
    fits = (speakers.name == best["_n"]) & speakers.member_url.isNull() & speakers.url.isNull()
    return speakers.join(best, fits, "left").withColumn("member_url", F.coalesce("member_url", "_m")).drop("_n", "_m")


def by_role(speakers: DataFrame, members: DataFrame, sitting_speakers: DataFrame, sittings: DataFrame, parliament: str = "13th-parliament", house: str = "National Assembly") -> DataFrame:
    """Presiding officers who spoke in a sitting of the house; of several members with the role the least url."""
    m = members.filter((F.col("parliament") == parliament) & (F.col("house") == house)).select(F.when(F.col("role") == "Speaker", "speaker").when(F.col("role").ilike("%deputy speaker%"), "deputy").alias("_r"), "url").groupBy("_r").agg(F.min("url").alias("_m")).filter("_r is not null")
    there = sitting_speakers.join(sittings.filter(F.col("house") == house).select(F.col("url").alias("sitting_url")), "sitting_url", "left_semi").select(F.col("speaker_name").alias("_n"), F.col("speaker_url").alias("_su")).distinct().withColumn("_there", F.lit(True))
    role = F.when(speakers.name.rlike(r"(?i)^hon\.?\s+speaker$"), "speaker").when(speakers.name.rlike(r"(?i)^(the\s+)?deputy\s+speaker$"), "deputy")
    s = speakers.withColumn("_role", role)
    s = s.join(there, s.name.eqNullSafe(there["_n"]) & s.url.eqNullSafe(there["_su"]), "left")
    s = s.join(F.broadcast(m), s["_role"] == m["_r"], "left")  # two rows at most
    return s.withColumn("member_url", F.coalesce("member_url", F.when(F.col("_there"), F.col("_m")))).drop("_role", "_n", "_su", "_there", "_r", "_m")


def link_speakers(speakers: DataFrame, members: DataFrame, sitting_speakers: DataFrame, sittings: DataFrame) -> DataFrame:
    return by_role(by_name(by_url(speakers, members), members), members, sitting_speakers, sittings)


def filled(before: DataFrame, after: DataFrame, keys: list[str], column: str = "member_url") -> DataFrame:
    """Keys of the rows that a link has filled: those (by null-safe keys) with a value after it and none before."""
    was = before.filter(F.col(column).isNotNull()) if column in before.columns else before.limit(0)
    was = was.select(*[F.col(k).alias(f"_{k}") for k in keys])
    now = after.filter(F.col(column).isNotNull()).select(*keys)
    return now.join(was, reduce(lambda x, y: x & y, [now[k].eqNullSafe(was[f"_{k}"]) for k in keys]), "left_anti")


def linked(before: DataFrame, after: DataFrame, keys: list[str], column: str = "member_url") -> int:
    """How many rows a link has filled."""
    return filled(before, after, keys, column).count()


def link_sponsors(bills: DataFrame, members: DataFrame, min_score: float = 0.4) -> DataFrame:
    """bills with sponsor_url; one that is there stays."""
    if "sponsor_url" not in bills.columns:
        bills = bills.withColumn("sponsor_url", F.lit(None).cast("string"))
    best = match_members(bills.filter("sponsor is not null and sponsor_url is null").select(F.col("sponsor").alias("name")).distinct(), members, min_score=min_score, top=1).select(F.col("name").alias("_n"), F.col("member_url").alias("_m"))
    return bills.join(best, bills.sponsor == best["_n"], "left").withColumn("sponsor_url", F.coalesce("sponsor_url", "_m")).drop("_n", "_m")


def canonical(speakers: DataFrame, refs: DataFrame) -> DataFrame:
    """id -> keep: per url the speaker with most references, then least id; without url per name the least id. The least
    of a part is combined before its shuffle, so a name that many share is one row a task."""
    n = refs.groupBy(F.col("speaker_id").alias("id")).agg(F.count("*").alias("refs"))
    by_url = F.col("url").isNotNull()
    part = F.struct(F.when(by_url, "url").otherwise("name").alias("by"), F.when(by_url, F.col("url")).otherwise(F.col("name")).alias("v"))
    s = speakers.join(n, "id", "left").select("id", part.alias("part"), F.when(by_url, -F.coalesce("refs", F.lit(0))).otherwise(0).alias("rank"))
    return s.join(s.groupBy("part").agg(F.min(F.struct("rank", "id"))["id"].alias("keep")), "part").select("id", "keep")


def merge_counts(links: DataFrame, kept: DataFrame, keys: list[str]) -> DataFrame:
    """Link rows moved to the kept speakers, counts added."""
    return links.join(kept, links.speaker_id == kept.id).groupBy(*keys, F.col("keep").alias("speaker_id")).agg(F.sum("speech_count").alias("speech_count"))


def ref_counts(*links: DataFrame) -> DataFrame:
    out = links[0].select("speaker_id")
    for x in links[1:]:
        out = out.unionAll(x.select("speaker_id"))
    return out.groupBy("speaker_id").agg(F.count("*").alias("refs"))
