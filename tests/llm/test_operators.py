import re
from collections import Counter

import xxhash

from plenaria.llm import decontamination, licenses, line_dedup, mixing, pii, quality, simhash, token_counts

W = re.compile(r"[^\x20\x09-\x0D]+")


def docs(spark, texts, source="s"):
    return spark.createDataFrame([(i, t, "en", source, -1, "x") for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, size long, fp string")


TEXTS = [None, "", " \n", "one", "the cat sat on the mat and the dog ran far away today", "the cat sat on the mat and the dog ran far away today", "a b c d e f a b c d e g h i j", "Café über 10.0.0.1 a@b.co + ' + 5 <|endoftext|> é́ x", "x " * 3000]


def test_token_counts(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = token_counts.prefix_counts(docs(spark, TEXTS)).orderBy("doc_id").collect()
    assert [r.n_tokens for r in rows] == [len(t.encode(x or "", add_special_tokens=False).ids) for x in TEXTS]
    counter = token_counts.PrefixCounter("word_bpe_49k.json")
    text = TEXTS[4]
    assert all(counter.prefix(text, k) == len(t.encode(text[:k], add_special_tokens=False).ids) for k in range(len(text) + 1))


def test_simhash(spark):
    texts = [*TEXTS, *[" ".join(["word%d" % (i % 7)] * (i % 5 + 1)) for i in range(40)]]
    got = {r.doc_id: (r.fp, r.component_id) for r in simhash.classes(docs(spark, texts), pairwise=2).collect()}

    def fp(t):
        w = W.findall("".join(c.lower() if c.isascii() else c for c in t or ""))
        g = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
        h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in g]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    fps = [fp(t) for t in texts]
    assert [got[i][0] % (1 << 64) for i in range(len(texts))] == fps
    label = list(range(len(texts)))
    for _ in texts:
        for a in range(len(texts)):
            for b in range(len(texts)):
                if (fps[a] ^ fps[b]).bit_count() <= 2:
                    label[a] = label[b] = min(label[a], label[b])
    assert [got[i][1] for i in range(len(texts))] == label


def test_quality(spark):
    rows = quality.judge(docs(spark, TEXTS)).orderBy("doc_id").collect()
    for r, t in zip(rows, TEXTS, strict=True):
        w = W.findall(t or "")
        g = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
        n = Counter(g)
        inside = {k for i, x in enumerate(g) if n[x] > 1 for k in range(i, i + 5)}
        assert (r.n_words, r.word_chars, r.n_repeat_words) == (len(w), sum(map(len, w)), len(inside))
        assert r.base_failed == (len(w) < 10 or 100 * len(inside) > 20 * len(w))
    assert quality.judge(docs(spark, [])).count() == 0


def test_mixing(spark):
    df = docs(spark, TEXTS, "a").union(docs(spark, ["w " * k for k in range(1, 300)], "b")).union(docs(spark, ["q " * 40] * 200, None))
    rows = mixing.mix(df, group=50).collect()
    assert len(rows) == df.count()
    by = {}
    for r in rows:
        assert 0 <= r.taken <= 3 * r.size
        s = by.setdefault(r.source, [0, r.target])
        s[0] += r.taken
    assert all(abs(a - b) <= 50 for a, b in by.values())
    assert sorted(map(str, rows)) == sorted(map(str, mixing.mix(df, group=50).collect()))


def test_mixing_of_rows_without_id(spark):
    """Null ids and repeated rows are dealt over groups like others, and layouts of the table do not matter."""
    rows = [(None, "w " * (1 + k % 7), "a") for k in range(900)] + [(1, "q " * 9, "b")] * 400 + [(k, "z", "c") for k in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    layouts = [sorted(map(str, mixing.mix(df.repartition(n), group=40).collect())) for n in (1, 5)]
    assert layouts[0] == layouts[1] and len(layouts[0]) == len(rows)


def test_many_sources(spark):
    sources = spark.range(3000).selectExpr("concat('host', id) as source", "id % 90 as size", "1L as m").repartition(7)
    got = {r.source: (r.source_size, r.target) for r in mixing.targets(sources).collect()}
    order = sorted(got)
    weight = {s: (1, 2, 3)[k % 3] for k, s in enumerate(order)}
    level = max(t / weight[s] for s, (_, t) in got.items())
    assert abs(sum(t for _, t in got.values()) - sum(s for s, _ in got.values())) < 1e-6
    assert all(abs(t - min(3 * size, level * weight[s])) < 1e-9 for s, (size, t) in got.items())


def test_pii(spark):
    t = "mail a.b@c.org or x@y, call +1 (555) 123-4567, 4111 1111 1111 1111 at 10.0.0.255 not 10.0.0.256"
    r = pii.spans(docs(spark, [t, None])).orderBy("doc_id").collect()
    assert (r[0].n_email, r[0].n_phone, r[0].n_card, r[0].n_ip) == (1, 1, 1, 1)
    assert r[1].spans == ""
    shared = [f"agent falcon wrote spy@deep.org today number {i}" for i in range(6)] + ["nobody wrote today"] * 30
    found = pii.spans(docs(spark, shared)).first().spans
    assert ":" in found and "term" in found


def test_line_dedup_leaks_licenses(spark):
    texts = [f"page {i} tells its own tale\nAll rights of this site" for i in range(20)]
    out = line_dedup.drop_lines(docs(spark, [*texts, None])).orderBy("doc_id").collect()
    assert out[0].text == texts[0].split("\n")[0] and out[20].text is None and out[0]._n_dropped == 1
    salted = line_dedup.drop_lines(docs(spark, [*texts, None]), broadcast_lines=0).orderBy("doc_id").collect()
    assert [r.text for r in salted] == [r.text for r in out]
    two = docs(spark, texts, "large").union(docs(spark, texts[:6], "small")).union(docs(spark, texts[:6], None))
    split = line_dedup.drop_lines(two, broadcast_lines=0, pages=7)  # three salts for one host, one for the others
    assert sorted((str(r.source), r.text) for r in split.collect()) == sorted((str(r.source), r.text) for r in line_dedup.drop_lines(two).collect())
    items = spark.createDataFrame([(1, "Which river runs through the old town of Basel? The river Rhine runs through it.")], "item_id long, text string")
    clean = "An old town lies by a river and nobody asked which one it was, " * 9
    leak = clean + items.first().text + " " + clean
    assert [(r.doc_id, r.item_id) for r in decontamination.leaks(docs(spark, [clean, leak, None, ""]), items).collect()] == [(1, 1)]
    found = licenses.scan(docs(spark, ["x\nReleased under the MIT License.\ny", "a driving licence", None])).orderBy("doc_id").collect()
    assert [r.license for r in found] == ["MIT", None, None]
