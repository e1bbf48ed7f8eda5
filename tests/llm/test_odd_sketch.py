"""MinHash near-dedup: classes against all pairs, with small and with large buckets; sketches and bands against their estimates."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from plenaria.llm import near, odd_sketch
from tests.llm.test_operators import W

SCHEMA = "doc_id long, text string"


def corpus(seed=8):
    r = random.Random(seed)
    word = lambda: r.choice(["alpha", "Beta", "gamma", "of", "the", "zu"]) + str(r.randrange(900))
    texts = [None, "", " \n", "one", "ONE", "two words", "two  words"]
    for _ in range(4):  # groups around one text, from alike to nearly alike, and a passage that many share
        base = [word() for _ in range(r.choice([40, 150, 400]))]
        for _ in range(45):
            copy = list(base)
            for _ in range(r.choice([0, 1, 1, 2, 3, 5, 9])):
                at = r.randrange(len(copy))
                copy[at : at + r.randrange(2)] = [word()]
            texts.append(" ".join(copy))
        texts += [" ".join([*base[:30], *[word() for _ in range(200)]]) for _ in range(10)]
    return [*texts, *texts[:20]]


def brute(texts):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = []
    for t in texts:
        w = W.findall((t or "").translate(low))
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    label = list(range(len(texts)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and 100 * both >= 85 * (len(a) + len(sets[j]) - both):
                x, y = root(i), root(j)
                label[max(x, y)] = min(x, y)
    return [(i, len(a), root(i), root(i) == i) for i, a in enumerate(sets)]


@pytest.mark.parametrize("pairwise", [32, 1])
def test_classes(spark, tmp_path, monkeypatch, pairwise):
    """pairwise 1: every bucket counts as large."""
    monkeypatch.setattr(odd_sketch, "PAIRWISE", pairwise)
    texts = corpus()
    df = spark.createDataFrame(list(enumerate(texts)), SCHEMA).repartition(3)
    got = sorted(tuple(r) for r in odd_sketch.classes(df, pairwise=pairwise).select("doc_id", "n_shingles", "component_id", (F.col("doc_id") == F.col("component_id"))).collect())
    assert got == brute(texts)


def test_edges(spark, tmp_path):
    rows = [(1, "some text of its own here"), (1, "some text of its own here"), (None, "some text of its own here"), (None, "nobody else says this"), (2, None), (2, ""), (3, "very long " * 60_000)]
    df = spark.createDataFrame(rows, SCHEMA)
    for c in ("id", "key", "node", "n", "sketch", "bands", "band", "part", "label", "k", "a", "b"):
        df = df.withColumn(c, F.lit("x"))
    df.write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted((tuple(r) for r in odd_sketch.query(spark, str(tmp_path)).collect()), key=str)
    assert got == sorted([(1, 2, 1, True), (1, 2, 1, True), (None, 2, 1, False), (None, 1, None, True), (2, 0, 2, True), (2, 0, 2, True), (3, 2, 3, True)], key=str) or [g[1:] for g in got if g[0] == 3] == [(2, 3, True)]
    spark.createDataFrame([], SCHEMA).write.parquet(str(tmp_path / "none/documents.parquet"))
    assert odd_sketch.query(spark, str(tmp_path / "none")).collect() == []


def test_sketches_estimate_what_differs():
    """The population count of the XOR follows the number of differing samples, and similar sets share a band."""
    r, maker = np.random.default_rng(5), odd_sketch.Samples()
    for n in (60, 500, 5000):
        for similarity in (0.85, 0.95):
            shared = round(2 * n * similarity / (1 + similarity))
            own = n - shared
            sets = [np.unique(r.integers(0, 1 << 63, shared + 2 * own, np.uint64)) for _ in range(40)]
            samples = [maker.of([np.sort(np.concatenate((s[: shared + own],))), np.sort(np.concatenate((s[:shared], s[shared + own :])))]) for s in sets]
            bits = [np.bitwise_count((x := maker.sketches(m).view(np.uint64))[0] ^ x[1]).sum() for m in samples]
            differing = [(m[0] != m[1]).sum() for m in samples]
            assert max(bits) <= odd_sketch.MOST
            assert abs(np.mean(bits) - np.mean([odd_sketch._toggled(d) for d in differing])) < 4
            assert abs(np.mean(differing) / odd_sketch.SAMPLES - (1 - similarity)) < 0.04
            assert all((maker.bands(m)[0] == maker.bands(m)[1]).any() for m in samples)


def test_similarity_is_counted_in_whole_numbers():
    s = near.Similarity(17, 20)
    for a in range(1, 60):
        for b in range(a, 60):
            for c in range(a + 1):
                assert s.enough(c, a, b) == (100 * c >= 85 * (a + b - c))
        assert s.first(a) == a - -(-17 * a // 20) + 1
    assert (s.steps, near.AT_0_8.steps) == (4, 5)
