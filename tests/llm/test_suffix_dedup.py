import hashlib
import inspect
import random

import numpy as np
import pyarrow as pa

from plenaria.llm import suffix_dedup
from plenaria.llm.suffix_dedup import dedup


def brute(rows, length=50):
    first = {}
    for i, t in rows:
        b = (t or "").encode()
        for k in range(len(b) - length + 1):
            w = b[k : k + length]
            first[w] = min(first.get(w, i), i)
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = [False] * len(b)
        for k in range(len(b) - length + 1):
            if first[b[k : k + length]] < i:
                gone[k : k + length] = [True] * length
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def corpus(n=60, seed=1):
    r = random.Random(seed)
    say = lambda k: " ".join(r.choice(["the", "of", "élan", "über", "tion", "re", "ing", "zu"]) + str(r.randrange(60)) for _ in range(k))
    shared = [say(r.randrange(8, 40)) for _ in range(6)]
    rows = [(i, "\n".join(r.choice([say(r.randrange(3, 30)), r.choice(shared)]) for _ in range(r.randrange(1, 6)))) for i in range(n)]
    rows += [(n, None), (n + 1, ""), (n + 2, "a" * 400), (n + 3, "b" + "a" * 300), (n + 4, rows[3][1]), (n + 5, rows[3][1]), (n + 6, rows[4][1][:49]), (n + 6, rows[4][1])]
    return rows


def run(spark, rows, **more):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    return sorted(tuple(x) for x in dedup(df, with_text=False, **more).drop("kept").collect())


def test_brute_force(spark):
    rows = corpus()
    assert run(spark, rows) == brute(rows)


def test_hot_anchors_and_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "ANCHOR_BYTES", 4000)
    monkeypatch.setattr(suffix_dedup, "SUFFIX_BYTES", 3000)
    rows = corpus(40, 2)
    assert run(spark, rows, hot=1) == brute(rows)


def test_copies_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "BLOCK", 700)
    monkeypatch.setattr(suffix_dedup, "ANCHOR_BYTES", 4000)
    r = random.Random(6)
    copies = [corpus(30, 3)[k][1] for k in (3, 4, 5)]
    rows = corpus(30, 3) + [(100 + k, r.choice(copies)) for k in range(60)]
    r.shuffle(rows)
    assert run(spark, rows) == brute(rows)


def test_empty(spark):
    assert run(spark, []) == []


def test_text_and_clashing_columns(spark):
    t = "0123456789 " * 3 + "abcdefghijklmnopqrstuvwxyz" * 2
    df = spark.createDataFrame([(1, t, 1, "x"), (2, "new " + t, 2, "y")], "doc_id long, text string, block int, kept string")
    kept = {r.doc_id: bytes(r.kept) for r in dedup(df).collect()}
    assert kept == {1: t.encode(), 2: b"new "}


def test_anchors_hot_by_rows(spark):
    rows = corpus(40, 2)
    assert run(spark, rows, hot_rows=2) == brute(rows)


def test_interleave_starts_from_the_shards(monkeypatch):
    """The order and the common prefixes are those of brute force, and rows that agree to the end are never moved."""
    r = np.random.default_rng(4)
    shards = [np.unique(r.integers(0, 3, (n, 21), np.uint8), axis=0) for n in (700, 1, 400, 90)]
    m = np.concatenate(shards)
    order, prefix = suffix_dedup.interleave(m, 21)
    rows = [bytes(x) for x in m]
    want = sorted(range(len(rows)), key=lambda i: (rows[i], i))
    assert order.tolist() == want
    common = [0] + [next((k for k in range(21) if rows[a][k] != rows[b][k]), 21) for a, b in zip(want, want[1:], strict=False)]
    assert prefix.tolist() == common
    same = np.repeat(np.unique(r.integers(0, 200, (500, 50), np.uint8), axis=0), 2, axis=0)
    moved, lexsort = [], np.lexsort
    monkeypatch.setattr(np, "lexsort", lambda keys: moved.append(len(keys[0])) or lexsort(keys))
    assert suffix_dedup.interleave(same, 50)[0].tolist() == list(range(len(same))) and moved == []
    assert suffix_dedup.interleave(same[:0], 50)[0].tolist() == []


def test_anchor_in_most_blocks_of_a_large_table_stays_whole():
    """As many blocks as 6 GB make: what is in each of them goes to one bucket while its places fit there, not window by window."""
    p = inspect.signature(suffix_dedup.dedup).parameters
    bodies = []
    for _ in range(1700):
        planes = np.array([[7], [0], [0], [0], [0]], np.uint8)
        bodies.append(suffix_dedup._join([suffix_dedup._zip(planes), b"\x00", suffix_dedup._zip(np.array([300], "<u4"))]))
    rows = pa.table({"block": list(range(1700)), "body": pa.array(bodies, pa.binary())})
    says = suffix_dedup._share(p["hot"].default, p["hot_rows"].default)((pa.scalar(0),), rows)
    assert {suffix_dedup._unzip(x, "u1").tolist()[0] for x in says["body"].to_pylist()} == {1}
    assert len(says) == 1700


def test_anchors_are_those_of_all_windows(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PIECE", 37, raising=False)
    data = np.random.default_rng(3).integers(97, 100, 1000).astype(np.uint8)
    for n in (49, 50, 51, 86, 87, 123, 1000):
        part = data[:n]
        h = suffix_dedup._hash_at(part, np.arange(max(0, n - 15)))
        want = {int(p) + w for w in range(n - 49) for p in np.flatnonzero(h[w : w + 35] == h[w : w + 35].min())}
        assert suffix_dedup.anchors(part, 50).tolist() == sorted(want)
