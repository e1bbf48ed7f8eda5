"""Each stage of the pipeline, and the whole, against plain Python on small documents."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from plenaria.llm import decontamination, mixing, quality, simhash

SPACE = " \t\n\v\f\r"
ITEM = "Which river runs through the old town of Basel? The river Rhine runs through it."
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def story(i: int, n: int = 60) -> str:
    r = random.Random(i)
    return " ".join("".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(5)) for _ in range(n))


def sample() -> list[tuple]:
    texts = [(f"site{i % 2}", story(i) + f"\nRead more on site {i % 2}") for i in range(40)]
    texts += [("site0", story(3) + "\nRead more on site 0"), ("site1", story(4)), (None, story(90) + " " + ITEM + " " + story(91)), (None, "too short"), ("site0", None), ("site1", ""), ("site0", "spam again and again " * 30)]
    return [(i, t, "en", s, len(t or "")) for i, (s, t) in enumerate(texts)]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(sample(), SCHEMA).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, ITEM), (2, None)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = rows(corpus_pipeline.quality_rules(spark, docs, folder))
    fail = {d for d, t, *_ in sample() if len((t or "").split()) < 10} | {46}
    assert {r[0] for r in kept} == {r[0] for r in sample()} - fail

    docs = spark.createDataFrame(kept, SCHEMA)
    lines = rows(corpus_pipeline.line_dedup_stage(spark, docs, folder))
    pages, holding = Counter(r[3] for r in kept), Counter((r[3], x) for r in kept for x in {x.strip(SPACE) for x in r[1].split("\n") if x.strip(SPACE)})
    bad = {k for k, n in holding.items() if n >= 5 and n > 0.1 * pages[k[0]]}
    assert bad
    left = {r[0]: "\n".join(x for x in r[1].split("\n") if (r[3], x.strip(SPACE)) not in bad) for r in kept}
    assert {r[0]: (r[1], r[4]) for r in lines} == {d: (t, len(t)) for d, t in left.items()}

    docs = spark.createDataFrame(lines, SCHEMA)
    first = {}
    for d, t in sorted(left.items()):
        first.setdefault(t, d)
    near = rows(corpus_pipeline.near_dedup(spark, docs, folder))
    assert {r[0] for r in near} == set(first.values()) and len(near) == len(first)

    docs = spark.createDataFrame(near, SCHEMA)
    clean = rows(corpus_pipeline.decontaminate(spark, docs, folder))
    assert {r[0] for r in clean} == set(first.values()) - {42}

    mixed = corpus_pipeline.mix(spark, spark.createDataFrame(clean, SCHEMA), folder).collect()
    assert {r.doc_id: r.size for r in mixed} == {r[0]: len(r[1].split()) for r in clean}
    whole = corpus_pipeline.run(spark, folder).collect()
    assert sorted(whole) == sorted(mixed)


def test_null_ids_and_clashing_columns(spark, folder):
    docs = spark.createDataFrame([(None, *r[1:]) for r in sample()[:3]] + sample()[:3] + sample()[:2], SCHEMA)
    for c in ("_n", "_lead", "fp", "id", "key", "KEY_", "number", "gone", "doc", "node", "_lines", "_salt", "_salt_of", "host", "lines"):
        docs = docs.withColumn(c, F.lit(3))
    for stage in (corpus_pipeline.quality_rules, corpus_pipeline.line_dedup_stage, corpus_pipeline.near_dedup, corpus_pipeline.decontaminate):
        assert stage(spark, docs, folder).columns == docs.columns
    out = corpus_pipeline.near_dedup(spark, docs, folder)
    assert Counter(r.doc_id for r in out.collect()) == {None: 3, 0: 1, 1: 1, 2: 1}
    assert Counter(r.doc_id for r in corpus_pipeline.quality_rules(spark, docs, folder).collect()) == {None: 3, 0: 2, 1: 2, 2: 1}
    assert corpus_pipeline.decontaminate(spark, docs, folder).count() == 8


def test_empty_documents(spark, folder):
    docs = spark.createDataFrame([], SCHEMA)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, folder).collect() == []


def test_wand_finds_what_a_scan_finds(spark):
    items = [(i, " ".join(f"t{(i * 13 + k * k * 7) % 97}" for k in range(5 + i % 17))) for i in range(300)]
    index = decontamination.Index(items)
    for k in range(60):
        terms = {f"t{(k * 31 + j * 5) % 97}".encode() for j in range(8 + k)}
        score = defaultdict(float)
        for t in terms:
            for d, x in zip(*index.postings.get(t, ([], [])), strict=True):
                score[d] += x
        for threshold in (0.2, 0.5, 0.7):
            assert dict(index.search(terms, threshold)).keys() == {d for d, s in score.items() if s >= threshold - 1e-9}


def test_ball_links_what_pairs_link(spark):
    r = random.Random(5)
    base = [r.getrandbits(64) for _ in range(6)]
    fps = sorted({b ^ sum(1 << x for x in r.sample(range(64), r.randrange(4))) for b in base for _ in range(30)})
    long = [x - (1 << 64) if x >> 63 else x for x in fps]
    nodes = spark.createDataFrame([(x,) for x in long], "fp long")

    def groups(pairs):
        label = {x: x for x in long}
        changed = True
        while changed:
            changed = False
            for a, b in pairs:
                low = min(label[a], label[b])
                changed |= label[a] != low or label[b] != low
                label[a] = label[b] = low
        return label

    pairs = [(long[a], long[b]) for a in range(len(fps)) for b in range(a) if (fps[a] ^ fps[b]).bit_count() <= 2]
    for pairwise in (1, 8, 1000):
        assert groups(rows(simhash.links(nodes, 2, pairwise))) == groups(pairs)


def test_divergence_rejects_another_alphabet(spark):
    import numpy as np

    words = np.random.default_rng(3)
    plain = [" ".join(words.choice(["the", "of", "and", "river", "town", "house", "garden", "winter", "to", "in", "walks", "quiet", f"n{k}"], 160)) for k in range(40)]
    odd = " ".join(f"{k:05d}" for k in range(160))
    found = {r.doc_id: r.kept for r in quality.judge(spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate([*plain, odd])], SCHEMA)).collect()}
    assert not found[40] and sum(found[i] for i in range(40)) >= 36


def test_targets(spark):
    sizes = [("b", 100), ("a", 10), (None, 1000), ("c", 50), ("d", 0)]
    rows = spark.createDataFrame([(s, n, 1) for s, n in sizes], "source string, size long, m long")
    got = {r.source: r.target for r in mixing.targets(rows.repartition(3)).collect()}
    order = sorted((s for s, _ in sizes if s is not None)) + [None]
    size, weight, fixed = dict(sizes), {s: (1, 2, 3)[i % 3] for i, s in enumerate(order)}, {}
    while True:  # cap, and share out what is left, until none is above
        rest = sum(size.values()) - sum(fixed.values())
        free = [s for s in order if s not in fixed]
        over = [s for s in free if rest * weight[s] / sum(weight[x] for x in free) > 3 * size[s]]
        if not over:
            want = fixed | {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
            break
        fixed |= {s: 3.0 * size[s] for s in over}
    assert got == pytest.approx(want)
