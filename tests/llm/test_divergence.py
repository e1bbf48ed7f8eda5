"""The source divergence audit against sums over every group and term, and against its SQL."""

import random
import re
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from plenaria.llm import divergence

SCHEMA = "doc_id long, text string, lang string, source string"
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def rows_of(seed=2):
    r = random.Random(seed)
    words = ["The", "the", "of", "élan", "ÜBER", "über", "a1b", "x-y", "日本", "Zed", *[f"w{chr(97 + k)}{chr(97 + k % 7)}" for k in range(26)]]
    rows = [(i, r.choice([" ", "\n", ", "]).join(r.choices(words, k=r.randrange(40))), r.choice(["en", "de", None]), r.choice(["a", "b", "c", None, "é", "Z"])) for i in range(150)]
    rows += [(500, None, "en", "silent"), (501, "", "xx", "a"), (502, "only once here", "xx", "b"), (503, "9 9 9", "yy", "q"), (None, None, None, None)]
    return rows + rows[:5] + [(600, "common " * 30_000, "en", "long")] + [(601 + k, "common", "en", "c") for k in range(2)]


def brute(rows, ranks=200):
    count, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for _, text, lang, source in rows:
        g = (lang or "", source or "")
        groups.add(g)
        said = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in TERM.findall(text or "")]
        count[g].update(said)
        docs[g[0]].update(set(said))
    kept = {lang: sorted(w for w, n in c.items() if n >= 3) for lang, c in docs.items()}

    def shares(counts, lang):
        n = {w: counts[w] for w in kept[lang]}
        return {w: 1 + 10**9 * (k + 1) // (sum(n.values()) + len(n)) for w, k in n.items()}

    p = {g: shares(count[g], g[0]) for g in groups}
    q = {lang: shares(sum((count[g] for g in groups if g[0] == lang), Counter()), lang) for lang in kept}
    out = set()
    for lang, source in groups:
        g = (lang, source)
        parts = {"pair": [(o, sum((p[g][w] - p[lang, o][w]) ** 2 // p[lang, o][w] for w in kept[lang])) for x, o in groups if x == lang and o != source]}
        parts["term"] = [(w, (p[g][w] - q[lang][w]) ** 2 // q[lang][w]) for w in kept[lang] if count[g][w] and p[g][w] > q[lang][w]]
        for part, items in parts.items():
            items.sort(key=lambda x: (-x[1], x[0].encode()))
            out |= {(lang, source, part, item, value, k) for k, (item, value) in enumerate(items, 1) if part == "pair" or k <= ranks}
    return out


@pytest.mark.parametrize("slices", [1 << 25, 64])
def test_brute_force(spark, tmp_path, monkeypatch, slices):
    """64: every slice holds a text, so that counts of many slices add up."""
    monkeypatch.setattr(divergence, "SLICE", slices)
    rows = rows_of()
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for c in ("term", "n", "docs", "m", "p", "leads", "item", "value"):
        df = df.withColumn(c, F.lit("x"))
    df.write.parquet(str(tmp_path / "documents.parquet"))
    got = [tuple(r) for r in divergence.query(spark, str(tmp_path)).collect()]
    assert len(got) == len(set(got)) and set(got) == brute(rows)
    db = duckdb.connect()
    db.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    assert set(db.execute(divergence.SQL).fetchall()) == set(got)


def test_first_ranks_ties_and_empty_tables(spark):
    rows = [(i, "alpha beta gamma delta", "en", "ab"[i % 2]) for i in range(8)] + [(9, "omega " * 5, "en", "a"), (10, "omega", "en", "a"), (11, "omega", "en", "a")]
    got = divergence.audit(spark.createDataFrame(rows, SCHEMA), ranks=2).collect()
    assert {tuple(r) for r in got} == brute(rows, 2)
    assert divergence.audit(spark.createDataFrame([], SCHEMA)).collect() == []


def test_shares_beyond_a_long(spark):
    """Products of more than 18 digits are exact."""
    n, m = 9_000_000_000_000_000, 9_000_000_000_000_007
    got = spark.createDataFrame([(n, m)], "n long, m long").select(divergence._share("n", "m").alias("p")).first().p
    assert got == 1 + 10**9 * (n + 1) // m
