"""Trigram similarity as column expressions, and matching names to members."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .text import clean_name


def ordered_trigrams(c: Column) -> Column:
    """Trigrams in order, of lower-case words of letters and digits with two blanks before and one after."""
    words = F.filter(F.split(F.lower(c), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    grams = F.transform(words, lambda w: F.transform(F.sequence(F.lit(1), F.length(w) + 1), lambda i: F.substring(F.concat(F.lit("  "), w, F.lit(" ")), i, F.lit(3))))
    return F.flatten(grams)


def trigrams(c: Column) -> Column:
    return F.array_distinct(ordered_trigrams(c))


def set_similarity(a: Column, b: Column) -> Column:
    """Shared over all trigrams of two distinct trigram arrays; 0 without any."""
    n = F.size(F.array_union(a, b))
    return F.when(n > 0, F.size(F.array_intersect(a, b)) / n).otherwise(0.0)


def similarity(a: Column, b: Column) -> Column:
    return set_similarity(trigrams(a), trigrams(b))


def extent_similarity(a: Column, b: Column) -> Column:
    """word_similarity on arrays: a distinct, b ordered. Best over extents of b that begin and end with a shared trigram."""
    shared = F.filter(F.transform(b, lambda g, i: F.when(F.array_contains(a, g), i)), lambda i: i.isNotNull())

    def score(lo: Column, hi: Column) -> Column:
        extent = F.array_distinct(F.slice(b, lo + 1, hi - lo + 1))
        both = F.size(F.array_intersect(a, extent))
        return both / (F.size(a) + F.size(extent) - both)

    return F.coalesce(F.array_max(F.flatten(F.transform(shared, lambda lo: F.transform(F.filter(shared, lambda hi: hi >= lo), lambda hi: score(lo, hi))))), F.lit(0.0))


def word_similarity(a: Column, b: Column) -> Column:
    return extent_similarity(trigrams(a), ordered_trigrams(b))


def _rarest(rows: DataFrame, key: str, grams: str, counts: DataFrame, min_score: float) -> DataFrame:
    """key and _g: of each row the trigrams of which it must share one to share min_score of its own, the rarest in counts (_g, _n)."""
    each = rows.select(key, F.size(grams).alias("_k"), F.explode(grams).alias("_g")).join(counts, "_g", "left")
    ordered = each.groupBy(key, "_k").agg(F.sort_array(F.collect_list(F.struct(F.coalesce("_n", F.lit(0)).alias("_n"), "_g"))).alias("_o"))
    first = F.slice("_o", F.lit(1), F.col("_k") - F.ceil(F.col("_k") * min_score - 1e-9).cast("int") + 1)
    return ordered.select(key, F.explode(first).alias("_x")).select(key, F.col("_x._g").alias("_g"))


def _counts(rows: DataFrame, grams: str) -> DataFrame:
    """How many rows have each trigram; of letters and digits there are few, whatever the number of rows."""
    return rows.select(F.explode(grams).alias("_g")).groupBy("_g").agg(F.count("*").alias("_n"))


def similar_pairs(names: DataFrame, name_col: str = "name", min_score: float = 0.5) -> DataFrame:
    """a, b, score of all distinct names with similarity min_score (above 0) or more, a before b.

    Two sets at that similarity share min_score of either, so they meet under the rarest trigrams of both only, and
    only names travel there; trigrams are made again for the pairs that meet."""
    n = names.select(F.col(name_col).alias("_name")).filter("_name is not null").distinct().withColumn("_t", trigrams(F.col("_name")))
    g = _rarest(n, "_name", "_t", _counts(n, "_t"), min_score)
    met = g.select(F.col("_name").alias("a"), "_g").join(g.select(F.col("_name").alias("b"), "_g"), "_g").filter("a < b").select("a", "b").distinct()
    return met.select("a", "b", similarity(F.col("a"), F.col("b")).alias("score")).filter(F.col("score") >= min_score)


def match_members(names: DataFrame, members: DataFrame, name_col: str = "name", min_score: float = 0.3, top: int = 5) -> DataFrame:
    """names with the best members of each: member_name, member_url, score, rank.

    Either similarity counts what is shared of the asked name's trigrams, so a pair at min_score shares that part of them,
    and one of its rarest (by members): pairs are met by an equi join on those, which is exact and never a cross
    join; a name and a member meet once whatever they share. Ties: by member url."""
    if min_score <= 0:
        raise ValueError("min_score must be above 0")
    asked = names.select(F.col(name_col).alias("_name")).filter("_name is not null").distinct().withColumn("_a", trigrams(clean_name(F.col("_name"))))
    given = members.select(F.col("name").alias("member_name"), F.col("url").alias("member_url")).withColumn("_b", ordered_trigrams(F.col("member_name")))
    its = given.select("member_url", F.array_distinct("_b").alias("_t"))
    met = _rarest(asked, "_name", "_a", _counts(its, "_t"), min_score).join(its.select("member_url", F.explode("_t").alias("_g")), "_g").select("_name", "member_url").distinct()
    score = F.greatest(extent_similarity(F.col("_a"), F.col("_b")), set_similarity(F.col("_a"), F.array_distinct("_b")))
    scored = met.join(asked, "_name").join(given, "member_url").withColumn("score", score).filter(F.col("score") >= min_score)
    best = scored.withColumn("rank", F.row_number().over(W.partitionBy("_name").orderBy(F.desc("score"), "member_url"))).filter(F.col("rank") <= top)
    return names.join(best.select("_name", "member_name", "member_url", "score", "rank"), names[name_col] == best["_name"]).drop("_name")
