"""Nulls in any column, empty and very long texts, repeated rows, empty tables and clashing columns, for every operator; held-out accuracy of the chain."""

import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from plenaria.llm import decontamination, licenses, line_dedup, mixing, near, pii, quality, simhash, suffix_dedup, token_counts, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASH = ("id", "uid", "fp", "size", "block", "body", "key", "host", "word", "_id", "_kept", "_n", "found", "classes", "w", "target", "n_tokens", "_lines", "_salt", "_salt_of", "_host", "keys", "salt", "mine", "host_", "doc", "mark", "nth", "m", "_s", "part", "place", "node", "shingles", "leads", "gone")
LONG = "Very long words and numbers 12345 " * 30_000
ROWS = [(1, "one text of some words", "en", "s", 5), (1, "one text of some words", "en", "s", 5), (None, "no id at all here", None, None, None), (2, None, "de", "s", 0), (3, "", None, None, None), (4, LONG, "xx", "t", 9)]


def items(spark):
    return spark.createDataFrame([(1, "What is the tallest hill of the island? It is the northern hill."), (2, None), (None, "The quiet shore had no name at all. Nobody named the quiet shore.")], "item_id long, text string")


def labels(spark):
    return spark.createDataFrame([(1, 0, 1), (2, 1, 0), (None, 1, 1), (4, None, None)], "doc_id long, quality int, toxic int")


OPERATORS = {
    "suffix_dedup": lambda spark, d: suffix_dedup.dedup(d),
    "mixing": lambda spark, d: mixing.mix(d),
    "simhash": lambda spark, d: simhash.classes(d),
    "line_dedup": lambda spark, d: line_dedup.drop_lines(d),
    "line_dedup_salted": lambda spark, d: line_dedup.drop_lines(d.withColumn("_n_dropped", F.lit(-1)), broadcast_lines=-1),
    "quality": lambda spark, d: quality.judge(d),
    "near": lambda spark, d: near.classes(d),
    "pii": lambda spark, d: pii.spans(d),
    "licenses": lambda spark, d: licenses.scan(d),
    "token_counts": lambda spark, d: token_counts.prefix_counts(d),
    "toxicity": lambda spark, d: toxicity.score(d, toxicity.train(d, labels(spark), toxicity.CATEGORIES)),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_every_row_has_a_result(spark, name):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    for c in CLASH:
        docs = docs.withColumn(c, F.lit("x"))
    out = OPERATORS[name](spark, docs)
    ids = Counter(r.doc_id for r in out.select("doc_id").collect())
    assert ids == Counter(r[0] for r in ROWS)
    assert OPERATORS[name](spark, spark.createDataFrame([], SCHEMA)).collect() == []


def test_decontamination_edges(spark):
    docs = spark.createDataFrame([*ROWS, (9, "He said: " + items(spark).first().text, "en", "s", 1), (10, "The quiet shore had no name at all. Nobody named the quiet shore.", "en", "s", 1)], SCHEMA)
    for c in (*CLASH, "item_id", "score"):
        docs = docs.withColumn(c, F.lit("x"))
    assert [(r.doc_id, r.item_id) for r in decontamination.leaks(docs, items(spark)).orderBy("doc_id").collect()] == [(9, 1), (10, None)]
    assert Counter(r.doc_id for r in decontamination.clean(docs, items(spark)).collect()) == Counter(r[0] for r in ROWS)
    empty = spark.createDataFrame([], SCHEMA)
    assert decontamination.leaks(empty, items(spark)).count() == 0
    assert decontamination.leaks(docs, items(spark).limit(0)).count() == 0


def test_toxicity_on_held_out_documents(spark):
    r = random.Random(11)
    calm, rude = [f"calm{k}{chr(97 + k % 26)}" for k in range(400)], ["idiot", "moron", "scum", "vermin", "filth", "stupid"]
    docs = []
    for i in range(900):
        toxic = i % 3 == 0
        words = [r.choice(calm) for _ in range(60)] + (r.sample(rude, 2) if toxic else [])
        r.shuffle(words)
        docs.append((i, " ".join(words), "en", "s", 0))
    known = spark.createDataFrame([(i, 1 - (i % 3 == 0), int(i % 3 == 0)) for i in range(600)], "doc_id long, quality int, toxic int")
    df = spark.createDataFrame(docs, SCHEMA)
    said = {x.doc_id: x.toxic for x in toxicity.score(df, toxicity.train(df, known, toxicity.CATEGORIES)).collect()}
    assert sum(said[i] == (i % 3 == 0) for i in range(600, 900)) >= 285


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.1"), reason="no test tables")
def test_toxicity_on_held_out_labels(spark):
    """Trained on four fifths of the labelled rows, tried on the rest: recall and precision of 0.85 at least."""
    docs, known = (spark.read.parquet(f"/root/testdata/sf0.1/{name}.parquet") for name in ("documents", "labels"))
    held = F.pmod(F.xxhash64("doc_id"), F.lit(5)) == 0
    docs = docs.join(known.select("doc_id"), "doc_id", "left_semi")
    chain = toxicity.train(docs, known.filter(~held), toxicity.CATEGORIES)
    said = toxicity.score(docs, chain).withColumnRenamed("toxic", "said").join(known.filter(held), "doc_id")
    count = Counter((r.said, r.toxic == 1) for r in said.select("said", "toxic").collect())
    assert count[True, True] >= 0.85 * (count[True, True] + count[False, True])
    assert count[True, True] >= 0.85 * (count[True, True] + count[True, False])
