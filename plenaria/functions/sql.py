"""The library's functions in Spark SQL: names cleaned and compared, and members matched, by temporary SQL functions.

Their bodies are SQL that Catalyst inlines, so a query over them is planned as if it were written out. `match_member` is a table
function for LATERAL: the asked names' trigrams meet those of the members by an equi join; only members that share one are
scored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .text import CLEANING
from .trigram import trigrams


def _text(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _functions() -> dict[str, str]:
    cleaned = reduce(lambda x, step: f"regexp_replace({x}, {_text(step[0])}, {_text(step[1])})", CLEANING, "trim(raw)")
    words = r"filter(split(lower(said), '[^\\p{L}\\p{N}]+'), w -> w <> '')"
    extent = "array_distinct(slice(b, lo + 1, hi - lo + 1))"
    return {
        "clean_speaker_name(raw STRING) RETURNS STRING": cleaned,
        "ordered_trigrams(said STRING) RETURNS ARRAY<STRING>": f"flatten(transform({words}, w -> transform(sequence(1, length(w) + 1), i -> substring(concat('  ', w, ' '), i, 3))))",
        "name_trigrams(said STRING) RETURNS ARRAY<STRING>": "array_distinct(ordered_trigrams(said))",
        "shared_of(a ARRAY<STRING>, b ARRAY<STRING>) RETURNS DOUBLE": "if(size(array_union(a, b)) > 0, size(array_intersect(a, b)) / size(array_union(a, b)), 0.0D)",
        "best_extent(a ARRAY<STRING>, b ARRAY<STRING>) RETURNS DOUBLE": f"coalesce(array_max(flatten(transform(filter(transform(b, (g, i) -> if(array_contains(a, g), i, null)), i -> i is not null), lo -> transform(filter(filter(transform(b, (g, i) -> if(array_contains(a, g), i, null)), i -> i is not null), hi -> hi >= lo), hi -> size(array_intersect(a, {extent})) / size(array_union(a, {extent})))))), 0.0D)",
        "similarity(one STRING, other STRING) RETURNS DOUBLE": "shared_of(name_trigrams(one), name_trigrams(other))",
        "word_similarity(one STRING, other STRING) RETURNS DOUBLE": "best_extent(name_trigrams(one), ordered_trigrams(other))",
    }


def register(spark: SparkSession, members: DataFrame | None = None) -> None:
    """Creates the functions in a session; members (name, url, house, constituency): those that match_member finds."""
    for head, body in _functions().items():
        spark.sql(f"create or replace temporary function {head} return {body}")
    if members is None:
        return
    members.select("name", "url", "house", "constituency").createOrReplaceTempView("members")
    members.select("url", F.explode(trigrams(F.col("name"))).alias("gram")).createOrReplaceTempView("member_trigrams")
    spark.sql("""
        create or replace temporary function match_member(query_name STRING, min_score DOUBLE DEFAULT 0.3D)
        returns table (name STRING, url STRING, house STRING, constituency STRING, score DOUBLE)
        return select m.name, m.url, m.house, m.constituency, greatest(word_similarity(clean_speaker_name(query_name), m.name), similarity(clean_speaker_name(query_name), m.name)) as score
            from (select distinct g.url from (select explode(grams) as gram from (select name_trigrams(clean_speaker_name(query_name)) as grams) z) a join member_trigrams g on g.gram = a.gram) met
            join members m on m.url = met.url
            where greatest(word_similarity(clean_speaker_name(query_name), m.name), similarity(clean_speaker_name(query_name), m.name)) >= min_score
            order by score desc, url limit 5""")
