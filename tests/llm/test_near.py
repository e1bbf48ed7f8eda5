"""Near-duplicate classes against brute force on whole sets."""

import random

from plenaria.llm import common, near
from plenaria.llm.components import components


def shingles(text):
    w = (text or "").lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_classes_are_those_of_all_pairs(spark):
    r = random.Random(2)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(4))
    line = " ".join(word() for _ in range(9))
    texts = [None, "", "two words", "Two  words", "five words are one shingle", "five words are one shingle more"]
    for k in range(25):
        base = [word() for _ in range(r.choice((12, 30, 90, 200)))]
        for _ in range(r.choice((1, 2, 5, 14))):
            copy = list(base)
            for _ in range(r.randrange(1 + len(base) // 20)):
                copy[r.randrange(len(copy))] = word()
            texts.append(" ".join(copy[r.randrange(3) :]) + (" " + line if k % 3 == 0 else ""))
    sets, label = [shingles(t) for t in texts], list(range(len(texts)))
    linked = lambda a, b: a == b or (a and b and len(a & b) * 5 >= 4 * len(a | b))
    pairs = [(a, b) for a in range(len(texts)) for b in range(a) if linked(sets[a], sets[b])]
    for _ in texts:
        for a, b in pairs:
            label[a] = label[b] = min(label[a], label[b])
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {x.doc_id: x.component_id for x in near.classes(docs).collect()}
    assert [got[i] for i in range(len(texts))] == label


def test_pipeline_drops_copies_beyond_two_bits(spark):
    import corpus_pipeline

    r = random.Random(4)
    words = ["".join(r.choice("abcdefgh") for _ in range(5)) for _ in range(200)]
    changed = ["other" if i in (40, 90, 140) else w for i, w in enumerate(words)]
    docs = spark.createDataFrame([(1, " ".join(words), "en", "s", 1), (2, " ".join(changed), "en", "s", 1)], "doc_id long, text string, lang string, source string, n_chars long")
    assert [x.doc_id for x in corpus_pipeline.near_dedup(spark, docs, "").collect()] == [1]


def brute(texts):
    sets, label = [shingles(t) for t in texts], list(range(len(texts)))
    pairs = [(a, b) for a in range(len(texts)) for b in range(a) if sets[a] and len(sets[a] & sets[b]) * 5 >= 4 * len(sets[a] | sets[b])]
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return label


def test_large_group_of_copies_about_as_alike_as_asked(spark):
    """Copies of one text with more and more words changed or cut, and texts with a common passage."""
    r = random.Random(8)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(5))
    base, passage, texts = [word() for _ in range(140)], " ".join(word() for _ in range(30)), []
    for k in range(160):
        copy = list(base)
        for _ in range(r.choice((0, 2, 3, 4, 5, 7))):
            copy[r.randrange(len(copy))] = word()
        texts.append(" ".join(copy[r.choice((0, 0, 0, 12, 25)) :]))
    texts += [" ".join(word() for _ in range(r.randrange(60, 140))) + " " + passage for _ in range(60)]
    r.shuffle(texts)
    want = brute(texts)
    assert 3 < len(set(want)) < len(texts) - 40
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {x.doc_id: x.component_id for x in near.classes(docs).collect()}
    assert [got[i] for i in range(len(texts))] == want


def test_parities_differ_by_no_more_than_the_sets(spark):
    import numpy as np

    r = np.random.default_rng(3)
    for n in (0, 3, 50, 400, 3000):
        a = np.unique(r.integers(0, 1 << 63, n, np.uint64))
        b = np.union1d(a[n // 5 :], r.integers(0, 1 << 63, n // 6, np.uint64))
        apart = sum((x ^ y).bit_count() for x, y in zip((v % (1 << 64) for v in near._parities(a)), (v % (1 << 64) for v in near._parities(b)), strict=True))
        assert apart <= len(np.setxor1d(a, b))


def test_rounds_over_few_edges_need_no_exchange(spark, monkeypatch):
    """At many shuffle partitions a few edges do not cost a task and files for each of them in every round."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.shuffle.partitions", "60")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    sc = spark.sparkContext
    edges = [(i, i + 1) for i in range(40)] + [(i, 100) for i in range(101, 130)]
    try:
        sc.setJobGroup("few-edges", "")
        got = {r.node: r.label for r in components(spark.createDataFrame(edges, "src long, dst long")).collect()}
        tracker = sc.statusTracker()
        stages = {s for j in tracker.getJobIdsForGroup("few-edges") for s in tracker.getJobInfo(j).stageIds}
        tasks = sum(i.numTasks for s in stages if (i := tracker.getStageInfo(s)))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        for k, v in old.items():
            spark.conf.set(k, v)
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 130)}
    assert tasks < 240, tasks


def test_gathered(spark):
    out = common.gathered(spark.range(0, 100, 1, 8), 40)
    assert out.rdd.getNumPartitions() == 3 and out.count() == 100
    assert common.gathered(spark.range(10).filter("id < 0")).count() == 0
