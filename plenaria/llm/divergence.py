"""Source divergence audit: how far each source's terms are from those of every other source of its language, exactly.

A term is a run of letters (A-Z lower-cased) and characters beyond ASCII. A language keeps the terms that stand in `min_docs`
of its documents at least. A (language, source) group, and the language as a whole, gives a kept term the share
p = 1 + floor(SCALE * (count + 1) / (N + V)), with N its occurrences of kept terms and V the number of these. A term adds
floor((p - q)^2 / q) to the divergence of p from q.

Pairs of sources come from their supports by inclusion and exclusion: the terms of a group are priced as if the other group had
none of them, and the other way round; both prices come from histograms of a group's counts, as terms of equal
count cost the same. Terms that neither has cost a constant each. Where the supports overlap, a join of the two posting lists puts in the
true cost for the two one-sided ones. So nothing is computed for a pair and a term that neither holds.

Scale: texts are counted where they lie, in slices of `SLICE` bytes; a slice gives one row for each source and term of it. Rows meet by
(language, term); what is kept is written to the shared folder, without texts. A term's rows are at most its language's sources. The
posting join makes a row for each pair of sources that share a term, summed before they move, and the result has a row for each pair
of sources of a language. The first ranks of a group are cut in every task before they meet.

Null text, lang and source are read as empty. Repeated rows are documents of their own. A group without kept terms has N = 0; a
language without any gives pairs of value 0. An empty table gives no rows. Only the named columns are read. All arithmetic is
on whole numbers.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import common

SCALE = 1_000_000_000
MIN_DOCS, RANKS = 3, 200
#: Bytes of text that are counted at once in a task.
SLICE = 32 << 20
LETTER = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def counted(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """lang, source, term, n (occurrences), docs (documents that hold it), a row for each slice of texts."""
    common.shared_dir(docs.sparkSession)
    rows = common.pick(docs, lang=lang_col, source=source_col, text=text_col)
    rows = rows.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in rows.columns])

    def slices(batches):
        """Tables of about SLICE bytes of text, or one row."""
        import pyarrow as pa

        held, size = [], 0
        for batch in common.pieces(batches, SLICE):
            n = batch.column("text").nbytes
            if held and size + n > SLICE:
                yield pa.Table.from_batches(held)
                held, size = [], 0
            held.append(batch)
            size += n
        if held:
            yield pa.Table.from_batches(held)

    def run(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        for table in slices(batches):
            keys = pa.StructArray.from_arrays([table.column(c).combine_chunks().cast(pa.string()) for c in ("lang", "source")], names=["lang", "source"])
            names = {}
            group = np.fromiter((names.setdefault((k["lang"], k["source"]), len(names)) for k in keys.to_pylist()), np.int64, len(keys))
            plain = pa.array([t.translate(LETTER) for c in table.column("text").chunks for t in common.encoded(c)], pa.binary())
            # cast without a check: letters and whole sequences are left as they were
            split = pc.ascii_split_whitespace(pa.Array.from_buffers(pa.string(), len(plain), plain.buffers()))
            del table, plain
            lengths = np.diff(split.offsets.to_numpy())
            told = split.flatten().dictionary_encode()
            terms, code = told.dictionary, told.indices.to_numpy().astype(np.int64)
            del split, told
            # each document's distinct terms, then those of each group
            held, n = np.unique(np.repeat(np.arange(len(lengths)), lengths) * len(terms) + code, return_counts=True)
            at, code = np.divmod(held, max(1, len(terms)))
            key = group[at] * len(terms) + code
            order = np.argsort(key, kind="stable")
            key, n = key[order], n[order]
            first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
            at, code = np.divmod(key[first], max(1, len(terms)))
            sums = np.add.reduceat(n, first) if len(first) else n
            docs_ = np.diff(np.concatenate((first, [len(key)])))
            lang, source = (pa.array([k[i] for k in names], pa.string()) for i in (0, 1))
            some = pc.not_equal(pc.binary_length(terms), 0).to_numpy(zero_copy_only=False)[code] if len(code) else np.zeros(0, bool)
            at, code, sums, docs_ = at[some], code[some], sums[some], docs_[some]
            for i in range(0, len(at), 65536):
                part = slice(i, i + 65536)
                a = pa.array(at[part])
                yield pa.RecordBatch.from_arrays([lang.take(a), source.take(a), terms.take(pa.array(code[part])), pa.array(sums[part], pa.int64()), pa.array(docs_[part], pa.int64())], names=["lang", "source", "term", "n", "docs"])

    return rows.mapInArrow(run, "lang string, source string, term string, n long, docs long")


def _share(n: str, m: str) -> Column:
    """1 + floor(SCALE * (n + 1) / m), in decimals, as the product may have more digits than a long."""
    return F.expr(f"1 + (cast({n} + 1 as decimal(19,0)) * {SCALE}BD) div cast({m} as decimal(19,0))")


def _price(p: str, q: str) -> Column:
    """floor((p - q)^2 / q): a share is at most SCALE + 1, so its square is a long."""
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div {q}")


def postings(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text", min_docs: int = MIN_DOCS) -> DataFrame:
    """lang, source, term, n, lang_n (of the whole language), leads (one row of each kept term) of the kept terms."""
    rows = counted(docs, lang_col, source_col, text_col).repartition("lang", "term")
    own = W.partitionBy("lang", "term")
    rows = rows.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    rows = rows.withColumn("lang_n", F.sum("n").over(own)).withColumn("leads", F.col("source") == F.min("source").over(own)).withColumn("docs", F.sum("docs").over(own))
    return rows.filter(F.col("docs") >= min_docs).drop("docs")


#: Groups (two names, four numbers) that may be broadcast: some 30 MB.
GROUPS = 200_000


def groups(docs: DataFrame, posts: DataFrame, lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """lang, source, support (its kept terms), v (the language's), m = N + V, lang_m, p0 (the share of a term it has not; null
    if V = 0) of every group of docs."""
    named = docs.select(*[F.coalesce(docs[f"`{c}`"].cast("string"), F.lit("")).alias(k) for k, c in (("lang", lang_col), ("source", source_col))]).distinct()
    own = posts.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count("*").alias("support"))
    whole = posts.groupBy("lang").agg(F.sum("n").alias("lang_total"), F.count_if("leads").alias("v"))
    out = named.join(own, ["lang", "source"], "left").join(whole, "lang", "left").na.fill(0)
    out = out.select("lang", "source", "support", "v", (F.col("total") + F.col("v")).alias("m"), (F.col("lang_total") + F.col("v")).alias("lang_m"))
    return out.withColumn("p0", F.when(F.col("v") > 0, _share("0L", "greatest(m, 1)")))


def _both_ways(rows: DataFrame, there: str, back: str) -> DataFrame:
    """lang, source, item, value: column `there` of rows (lang, a, b) for a to b, `back` for b to a."""
    way = lambda x, y, value: F.struct(F.col(x).alias("source"), F.col(y).alias("item"), F.col(value).cast("decimal(38,0)").alias("value"))
    return rows.select("lang", F.explode(F.array(way("a", "b", there), way("b", "a", back))).alias("x")).select("lang", "x.*")


def pairs(posts: DataFrame, heads: DataFrame) -> DataFrame:
    """lang, source, item (each other source of the language), value (the divergence of source from item)."""
    near = common.small(heads, GROUPS)
    share = posts.join(near, ["lang", "source"]).select("lang", "term", "source", "n", _share("n", "m").alias("p"), "p0")
    # one-sided: terms of a, as if b had none of them
    priced = share.groupBy("lang", "source", "p").agg(F.count("*").alias("k"))
    other = near.select("lang", F.col("source").alias("b"), F.col("p0").alias("q"))
    one = priced.withColumnRenamed("source", "a").join(other, "lang").filter("a != b").groupBy("lang", "a", "b").agg(F.sum(F.col("k") * _price("p", "q")).alias("there"), F.sum(F.col("k") * _price("q", "p")).alias("back"))
    # terms of neither: all but both supports
    a, b = (near.select("lang", F.col("source").alias(x), F.col("support").alias(f"s_{x}"), F.col("p0").alias(f"p_{x}"), *(["v"] if x == "a" else [])) for x in "ab")
    none = a.join(b, "lang").filter("a != b").select("lang", F.col("a").alias("source"), F.col("b").alias("item"), F.when(F.col("v") > 0, (F.col("v") - F.col("s_a") - F.col("s_b")) * _price("p_a", "p_b")).otherwise(0).cast("decimal(38,0)").alias("value"))
    # terms of both, which the prices above took for terms of one and took away twice
    x, y = share.alias("x"), share.alias("y")
    both = x.join(y, (F.col("x.lang") == F.col("y.lang")) & (F.col("x.term") == F.col("y.term")) & (F.col("x.source") < F.col("y.source")))
    true = lambda p, q: F.sum(_price(f"{p}.p", f"{q}.p") - _price(f"{p}.p", f"{q}.p0") - _price(f"{p}.p0", f"{q}.p") + _price(f"{p}.p0", f"{q}.p0"))
    both = both.groupBy(F.col("x.lang").alias("lang"), F.col("x.source").alias("a"), F.col("y.source").alias("b")).agg(true("x", "y").alias("there"), true("y", "x").alias("back"))
    parts = [none, _both_ways(one, "there", "back"), _both_ways(both, "there", "back")]
    return reduce(DataFrame.unionByName, parts).groupBy("lang", "source", "item").agg(F.sum("value").cast("long").alias("value"))


def terms(posts: DataFrame, heads: DataFrame) -> DataFrame:
    """lang, source, item (a kept term that the source has more of than its language), value."""
    rows = posts.join(common.small(heads, GROUPS), ["lang", "source"]).select("lang", "source", F.col("term").alias("item"), _share("n", "m").alias("p"), _share("lang_n", "lang_m").alias("q"))
    return rows.filter("p > q").select("lang", "source", "item", _price("p", "q").alias("value"))


def audit(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text", min_docs: int = MIN_DOCS, ranks: int = RANKS) -> DataFrame:
    """lang, source, part (pair or term), item, value, rank (by value, then item): all pairs, the first `ranks` terms."""
    posts = common.stored(postings(docs, lang_col, source_col, text_col, min_docs))
    heads = common.cut(groups(docs, posts, lang_col, source_col))
    rank = F.row_number().over(W.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    shown = lambda rows, part: rows.withColumn("rank", rank).select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")
    return shown(pairs(posts, heads), "pair").unionByName(shown(terms(posts, heads), "term").filter(F.col("rank") <= ranks))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op11: how far every source is from the others of its language, and its most telling terms."""
    return audit(common.table(spark, sf_dir, "documents"))


#: DuckDB: the share of every kept term in every group, and sums over them all.
SQL = rf"""
    with d as (select row_number() over () as k, coalesce(lang, '') as lang, coalesce(source, '') as source, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t from documents),
    w as (select k, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term from d),
    c as (select lang, source, term, count(*) as n from w group by all),
    kept as (select lang, term, count(*) as lang_n from w group by all having count(distinct k) >= {MIN_DOCS}),
    v as (select lang, count(*) as v, sum(lang_n)::hugeint as lang_total from kept group by all),
    g as (select distinct lang, source from d),
    counts as (select g.lang, g.source, term, lang_n, coalesce(n, 0)::hugeint as n, sum(coalesce(n, 0)) over (partition by g.lang, g.source)::hugeint as total from g join kept using (lang) left join c using (lang, source, term)),
    p as (select lang, source, term, n, (1 + ({SCALE}::hugeint * (n + 1)) // (total + v))::bigint as p, (1 + ({SCALE}::hugeint * (lang_n + 1)) // (lang_total + v))::bigint as q from counts join v using (lang)),
    s as (select a.lang, a.source, b.source as item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) as value from p a join p b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
    pairs as (select a.lang, a.source, b.source as item, coalesce(value, 0)::bigint as value from g a join g b on a.lang = b.lang and a.source <> b.source left join s on s.lang = a.lang and s.source = a.source and s.item = b.source),
    terms as (select lang, source, term as item, ((p - q) * (p - q)) // q as value from p where n > 0 and p > q)
    select lang, source, 'pair' as part, item, value, row_number() over (partition by lang, source order by value desc, item)::int as rank from pairs
    union all select * from (select lang, source, 'term' as part, item, value, row_number() over (partition by lang, source order by value desc, item)::int as rank from terms) where rank <= {RANKS}"""
