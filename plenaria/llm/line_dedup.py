"""Line dedup by site-relative frequency.

The pages (rows) of a host are counted; so is, for each host and each distinct line with a word in it,
the number of its pages that hold the line. A line on more than `ratio` of its host's pages, and on
`min_pages` of them at least, is boilerplate there and is dropped from that host's pages; other hosts
keep it. Lines are compared whole, without white space at their ends.

Scale: texts are not shuffled while the lists of all hosts can be broadcast. Lines go to the count as two independent 64-bit hashes and are summed
before the shuffle, so a line on every page of a hot host is one row a task. A page has on average L
distinct lines, and each boilerplate line uses more than `ratio` of the pages, so a host has under
L / ratio such lines: the list a host needs is bounded whatever its number of pages. Lists of all hosts
are broadcast while there are at most `broadcast_lines` in all; beyond that pages meet their list in a
join on (host, salt), with one salt for every `PAGES` pages of a host (those of hosts with more than that are few, and
broadcast).

Null texts stay null (0 lines dropped, 0 kept); a null host is a host of its own; blank lines always stay; repeated rows count
as pages of their own; an empty table gives an empty result; all other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

RATIO, MIN_PAGES = 0.1, 5
PAGES = 50_000


def _key(line: Column) -> Column:
    return F.struct(F.xxhash64(line).alias("a"), F.xxhash64(line, F.lit("line")).alias("b"))


def _clean(line: Column) -> Column:
    return F.regexp_replace(line, rf"^[{common.SPACE}]+|[{common.SPACE}]+$", "")


def boilerplate(docs: DataFrame, host_col: str = "source", text_col: str = "text", ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """host, key (of a line), n (pages of the host that hold it), pages (of the host)."""
    rows = common.pick(docs, host=host_col, text=text_col)
    pages = rows.groupBy("host").agg(F.count("*").alias("pages"))
    keys = F.array_distinct(F.transform(F.filter(F.split("text", "\n"), lambda x: x.rlike(rf"[^{common.SPACE}]")), lambda x: _key(_clean(x))))
    counts = rows.select("host", F.explode(keys).alias("key")).groupBy("host", "key").agg(F.count("*").alias("n")).filter(F.col("n") >= min_pages)
    return counts.join(pages, counts.host.eqNullSafe(pages.host)).filter(F.col("n") > ratio * F.col("pages")).select(counts.host, "key", "n", "pages")


def drop_lines(docs: DataFrame, host_col: str = "source", text_col: str = "text", ratio: float = RATIO, min_pages: int = MIN_PAGES, broadcast_lines: int = 100_000, pages: int = PAGES) -> DataFrame:
    """docs with each host's boilerplate lines removed from text_col, and _n_dropped (long), which takes the place of a
    column of that name."""
    found = common.cut(boilerplate(docs, host_col, text_col, ratio, min_pages))
    h, keys, salt, mine, of_host, salts = (common.fresh(docs.columns, x) for x in ("host", "keys", "salt", "mine", "of_host", "salts"))
    lists = found.groupBy(F.col("host").alias(h)).agg(F.collect_list("key").alias(keys))
    host, text = docs[f"`{host_col}`"], docs[f"`{text_col}`"]
    if found.limit(broadcast_lines + 1).count() <= broadcast_lines:
        joined = docs.join(F.broadcast(lists), host.eqNullSafe(lists[h]), "left")
    else:
        # a host of P pages has ceil(P / pages) salts; only hosts of several need to be known beside their pages
        of = found.groupBy(F.col("host").alias(of_host)).agg(F.ceil(F.max("pages") / pages).cast("int").alias(salts))
        salted = lists.join(of, lists[h].eqNullSafe(of[of_host])).withColumn(salt, F.explode(F.sequence(F.lit(0), F.col(salts) - 1))).select(h, keys, salt)
        large = common.small(common.cut(of.filter(F.col(salts) > 1)))
        left = docs.join(large, host.eqNullSafe(large[of_host]), "left").withColumn(mine, F.pmod(F.xxhash64(text), F.coalesce(F.col(salts), F.lit(1))).cast("int"))
        joined = left.join(salted, host.eqNullSafe(salted[h]) & (left[mine] == salted[salt]), "left")
    some = F.size(keys) > 0  # null without a list
    kept = common.let(F.col(keys), lambda lines: F.filter(F.split(text, "\n"), lambda x: ~x.rlike(rf"[^{common.SPACE}]") | ~F.array_contains(lines, _key(_clean(x)))))
    new = F.when(some & text.isNotNull(), F.array_join(kept, "\n")).otherwise(text)
    dropped = F.when(some & text.isNotNull(), F.size(F.split(text, "\n")) - F.size(kept)).otherwise(0).cast("long")
    return joined.select(*[(new.alias(c) if c == text_col else docs[f"`{c}`"]) for c in docs.columns if c != "_n_dropped"], dropped.alias("_n_dropped"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op4: doc_id, n_dropped, n_kept (lines) and the sha256 of what is left, for every document; its source is the site."""
    out = drop_lines(common.table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.col("_n_dropped").alias("n_dropped"), F.coalesce(F.size(F.split("text", "\n")), F.lit(0)).cast("long").alias("n_kept"), F.sha2("text", 256).alias("kept_sha256"))


CLEAN_SQL = r"regexp_replace(regexp_replace(l, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', '')"


def texts_sql(docs: str) -> str:
    """DuckDB: a select of doc_id and what line dedup leaves of the text, of a relation docs."""
    return rf"""
        select d.doc_id, d.lines, list_filter(d.lines, lambda l: not regexp_matches(l, '[^\x20\x09-\x0D]') or not list_contains(coalesce(b.bad, []), {CLEAN_SQL})) as kept
        from (select *, string_split(text, chr(10)) as lines from {docs}) d
        left join (
            select source, list(line) as bad from (
                select source, line, count(*) as n from (
                    select source, unnest(list_distinct(list_transform(list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')), lambda l: {CLEAN_SQL}))) as line
                    from {docs}
                ) group by all having count(*) >= {MIN_PAGES}
            ) c join (select source as host, count(*) as pages from {docs} group by all) p on c.source is not distinct from p.host
            where n > {RATIO} * pages group by source
        ) b on d.source is not distinct from b.source"""


SQL = rf"""
    select doc_id, coalesce(len(lines) - len(kept), 0) as n_dropped, cast(case when lines is null then 0 else greatest(len(kept), 1) end as bigint) as n_kept, sha256(array_to_string(kept, chr(10))) as kept_sha256
    from ({texts_sql('documents')})"""
