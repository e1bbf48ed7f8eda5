"""Quality rules by distribution divergence, in DataFrame functions only.

A text fails the base rules if it has too few words, or if too many of its words lie in 5-word windows that occur
twice or more in it. Else its verdict comes from divergence: the Jensen-Shannon distance (square root, base 2)
between its histogram of character classes and the reference of its language, and the same for common words
(a few function words of the language, and the rest). References are means over all texts of a language in the
table that pass the base rules and have `min_words`, each text counting once, so long texts don't dominate. A
distance counts only from a minimum length on: `min_chars` for classes, `min_words` for words. Only the languages
with a word list have a reference, and only with `min_texts` texts or more; texts of other languages or of none are
judged by the base rules alone.

Scale: one pass over the texts, narrow counts are kept in the shared folder (by `keep` beside their rows), and the
references (one row for each listed language) are all that is broadcast. No shuffle moves texts; windows come from the JVM's
n-gram transformer, and repeated ones are found by sorting within the row, only in texts that have any.

Null text: no words, so base_failed. Repeated rows are judged alike and count as texts of their own. An empty table
gives no rows. Only the named columns are read by `judge`; `keep` passes all columns through, whatever their names.
"""

from __future__ import annotations

from pyspark.ml.feature import NGram
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

#: Fixed values: frequent function words of each language.
COMMON_WORDS = {
    "de": ["der", "die", "und", "das", "von", "zu", "mit", "für"],
    "en": ["the", "of", "and", "to", "in", "is", "that", "for"],
    "es": ["de", "la", "que", "el", "en", "los", "por", "para"],
    "fr": ["de", "la", "le", "et", "les", "des", "que", "pour"],
}
#: Character classes, taken away one after another.
CLASSES = (r"[a-z\u00df-\u1fff\u2c00-\uffff]+", rf"[{common.SPACE}\u00a0]+", r"[A-Z\u00c0-\u00de]+", r"[0-9]+", r"""[.,;:!?'"()\-]+""")
WINDOW, MIN_WORDS, SHARE = 5, 10, 20
MIN_CHARS, MIN_TEXT_WORDS, MIN_TEXTS = 300, 100, 20
CLASS_DISTANCE, WORD_DISTANCE = 0.3, 0.25


def repeat_words(g: Column) -> Column:
    """How many words lie in windows found twice or more; g: all windows of a text, in order."""
    n = F.size(g)

    def starts(s: Column) -> Column:
        same = lambda j: F.coalesce(F.get(s, j - 1)["x"] == s[j]["x"], F.lit(False)) | F.coalesce(F.get(s, j + 1)["x"] == s[j]["x"], F.lit(False))  # noqa: E731
        return F.sort_array(F.transform(F.filter(F.sequence(F.lit(0), n - 1), same), lambda j: s[j]["i"]))

    def covered(at: Column) -> Column:
        new = F.transform(at, lambda x, j: F.least(F.lit(WINDOW), F.coalesce(F.get(at, j + 1) - x, F.lit(WINDOW))))
        return F.aggregate(new, F.lit(0).cast("long"), lambda a, x: a + x)

    placed = F.sort_array(F.transform(g, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(g)) == n, F.lit(0).cast("long")).otherwise(common.let(placed, lambda s: common.let(starts(s), covered)))


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str | None = "lang", carry: bool = False) -> DataFrame:
    """doc_id, lang, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, classes and common
    (histograms, as counts); carry: and doc, the whole row."""
    lang = F.coalesce(docs[f"`{lang_col}`"].cast("string"), F.lit("")) if lang_col else F.lit("")
    listed = F.when(lang.isin(*COMMON_WORDS), lang).otherwise("")
    text = F.coalesce(docs[f"`{text_col}`"], F.lit(""))
    head = ["doc_id", "lang", *(["doc"] if carry else [])]
    doc = [F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("doc")] if carry else []
    rows = docs.select(docs[f"`{id_col}`"].alias("doc_id"), listed.alias("lang"), text.alias("text"), *doc)
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(rf"[^{common.SPACE}]"))
    lists = F.coalesce(F.create_map(*[y for k, v in COMMON_WORDS.items() for y in (F.lit(k), F.array(*map(F.lit, v)))])[F.col("lang")], F.array().cast("array<string>"))
    rows = rows.select(*head, "text", F.array_remove(F.split("text", rf"[{common.SPACE}]+"), "").alias("w"), lines.alias("lines"), F.regexp_replace("text", CLASSES[0], "").alias("rest0"))
    rows = NGram(n=WINDOW, inputCol="w", outputCol="windows").transform(rows)
    used = F.filter("w", lambda x: x.isin(*sorted({y for v in COMMON_WORDS.values() for y in v})))
    rows = rows.withColumn("used", used)
    rows = rows.select(
        *head,
        F.size("w").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.regexp_replace("text", "[#*$%&|<>]", ""))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeat_words(F.col("windows")).alias("n_repeat_words"),
        F.length("text").cast("long").alias("n_chars"),
        F.length("rest0").cast("long").alias("l0"),
        F.regexp_replace("rest0", CLASSES[1], "").alias("rest1"),
        common.let(lists, lambda known: F.transform(known, lambda k: F.size(F.filter("used", lambda x: x == k)))).alias("common"),
    )  # fmt: skip
    for k in range(2, len(CLASSES) + 1):
        rows = rows.select(*[c for c in rows.columns if c != f"rest{k - 1}"], F.length(f"rest{k - 1}").cast("long").alias(f"l{k - 1}"), *([F.regexp_replace(f"rest{k - 1}", CLASSES[k], "").alias(f"rest{k}")] if k < len(CLASSES) else []))
    ends = ["n_chars"] + [f"l{k}" for k in range(len(CLASSES))]
    classes = F.array(*[F.col(a) - F.col(b) for a, b in zip(ends, ends[1:], strict=False)], F.col(ends[-1]))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > SHARE * F.col("n_words"))
    return rows.select(*head, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), "n_chars", classes.cast("array<long>").alias("classes"), F.concat(F.col("common").cast("array<long>"), F.array(F.col("n_words") - F.aggregate("common", F.lit(0).cast("long"), lambda a, x: a + x))).alias("common"))


def _shares(counts: str, n: int, total: str) -> list[Column]:
    return [F.coalesce(F.col(counts)[k] / F.col(total), F.lit(0.0)) for k in range(n)]


def references(rows: DataFrame, min_words: int = MIN_TEXT_WORDS) -> DataFrame:
    """lang, texts, class_shares, word_shares: mean histograms of the languages over a result of measured()."""
    n, m = len(CLASSES) + 1, max(map(len, COMMON_WORDS.values())) + 1
    mean = lambda shares: F.array(*[F.round(F.avg(x), 9) for x in shares])  # noqa: E731
    good = rows.filter(~F.col("base_failed") & (F.col("n_words") >= min_words) & (F.col("lang") != ""))
    return good.groupBy(F.col("lang").alias("_lang")).agg(F.count("*").alias("texts"), mean(_shares("classes", n, "n_chars")).alias("class_shares"), mean(_shares("common", m, "n_words")).alias("word_shares"))


def distance(counts: str, total: str, reference: str, n: int) -> Column:
    """The Jensen-Shannon distance, base 2, of a histogram of counts and one of shares."""
    out = F.lit(0.0)
    for k, p in enumerate(_shares(counts, n, total)):
        q = F.coalesce(F.col(reference)[k], F.lit(0.0))
        part = lambda x, y: F.when(x > 0, x * F.log2(2 * x / (x + y))).otherwise(0.0)  # noqa: E731
        out = out + part(p, q) / 2 + part(q, p) / 2
    return F.sqrt(F.greatest(out, F.lit(0.0)))


def judged(rows: DataFrame, class_distance: float = CLASS_DISTANCE, word_distance: float = WORD_DISTANCE, min_chars: int = MIN_CHARS, min_words: int = MIN_TEXT_WORDS, min_texts: int = MIN_TEXTS) -> DataFrame:
    """rows (measured, materialised) with class_distance, word_distance (null where none counts) and kept."""
    known = references(rows, min_words).filter(F.col("texts") >= min_texts)
    rows = rows.join(F.broadcast(known), rows.lang == known["_lang"], "left")
    has = F.col("_lang").isNotNull()
    by_class = F.when(has & (F.col("n_chars") >= min_chars), distance("classes", "n_chars", "class_shares", len(CLASSES) + 1))
    by_word = F.when(has & (F.col("n_words") >= min_words), distance("common", "n_words", "word_shares", max(map(len, COMMON_WORDS.values())) + 1))
    rows = rows.withColumn("class_distance", by_class).withColumn("word_distance", by_word)
    diverges = F.coalesce(F.col("class_distance") > class_distance, F.lit(False)) | F.coalesce(F.col("word_distance") > word_distance, F.lit(False))
    return rows.withColumn("kept", ~F.col("base_failed") & ~diverges)


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str | None = "lang", **limits) -> DataFrame:
    """doc_id, the counts of the base rules, base_failed, class_distance, word_distance (null below the minimum length), kept."""
    rows = judged(common.cut(measured(docs, id_col, text_col, lang_col)), **limits)
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "class_distance", "word_distance", "kept")


def keep(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str | None = "lang", **limits) -> DataFrame:
    """The rows of docs that are kept, each judged by itself. Texts are not shuffled: rows lie beside their counts in the
    shared folder until the references are known."""
    rows = common.stored(measured(docs, id_col, text_col, lang_col, carry=True))
    return judged(rows, **limits).filter("kept").select(*[F.col("doc")[c].alias(c) for c in docs.columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op5: the counts and the verdict of every document."""
    return judge(common.table(spark, sf_dir, "documents")).drop("class_distance", "word_distance")


def _sql() -> str:
    space, word = r"[\x20\x09-\x0D]", r"[^\x20\x09-\x0D]+"
    classes = [r"[a-z\x{df}-\x{1fff}\x{2c00}-\x{ffff}]", r"[\x20\x09-\x0D\x{a0}]", r"[A-Z\x{c0}-\x{de}]", "[0-9]", r"""[.,;:!?''"()\-]"""]
    n, m = len(classes) + 1, max(map(len, COMMON_WORDS.values())) + 1
    listed = ", ".join(f"'{k}'" for k in COMMON_WORDS)
    lists = "case lang " + " ".join(f"when '{k}' then [{', '.join(repr(w) for w in v)}]" for k, v in COMMON_WORDS.items()) + " end"
    counts = ", ".join(f"length(t) - length(regexp_replace(t, '{c}', '', 'g')) as c{k}" for k, c in enumerate(classes))
    said = ", ".join(f"coalesce(len(list_filter(w, lambda x: x = known[{k + 1}])), 0) as w{k}" for k in range(m - 1))
    shares = [f"c{k} / n_chars" for k in range(n)] + [f"w{k} / n_words" for k in range(m)]
    names = [f"p{k}" for k in range(n)] + [f"q{k}" for k in range(m)]
    half = lambda x, y: f"case when {x} > 0 then {x} * log2(2 * {x} / ({x} + {y})) else 0 end"  # noqa: E731
    away = lambda names: "sqrt(greatest(0, " + " + ".join(f"({half('s.' + x, 'r.' + x)} + {half('r.' + x, 's.' + x)}) / 2" for x in names) + "))"  # noqa: E731
    return rf"""
        with d as (select row_number() over () as k, doc_id, case when lang in ({listed}) then lang end as lang, coalesce(text, '') as t from documents),
        b as (select *, regexp_extract_all(t, '{word}') as w, length(t) as n_chars, {lists} as known,
            list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^ 	-]')) as lines from d),
        g as (select k, i, array_to_string(w[i:i + {WINDOW - 1}], chr(10)) as x from (select k, w, unnest(range(1, len(w) - {WINDOW - 2})) as i from b)),
        r as (select k, count(distinct pos) as n_repeat_words from (
            select k, unnest(range(i, i + {WINDOW})) as pos from (select *, count(*) over (partition by k, x) as times from g) where times > 1) group by k),
        c as (select b.*, len(w) as n_words, cast(length(array_to_string(w, '')) as bigint) as word_chars,
            length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) as n_symbols, len(lines) - len(list_distinct(lines)) as n_dup_lines,
            coalesce(n_repeat_words, 0) as n_repeat_words, {counts}, {said} from b left join r using (k)),
        f as (select *, n_words < {MIN_WORDS} or 100 * n_repeat_words > {SHARE} * n_words as base_failed,
            n_chars - ({' + '.join(f'c{k}' for k in range(n - 1))}) as c{n - 1}, n_words - ({' + '.join(f'w{k}' for k in range(m - 1))}) as w{m - 1} from c),
        s as (select *, {', '.join(f'coalesce({x}, 0) as {y}' for x, y in zip(shares, names, strict=True))} from f),
        o as (select lang, {', '.join(f'round(avg({y}), 9) as {y}' for y in names)} from s
            where lang is not null and not base_failed and n_words >= {MIN_TEXT_WORDS} group by lang having count(*) >= {MIN_TEXTS})
        select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
            not base_failed and not coalesce(n_chars >= {MIN_CHARS} and {away(names[:n])} > {CLASS_DISTANCE}, false)
            and not coalesce(n_words >= {MIN_TEXT_WORDS} and {away(names[n:])} > {WORD_DISTANCE}, false) as kept
        from s left join o r using (lang)"""


#: DuckDB: the whole query, divergence included.
SQL = _sql()
