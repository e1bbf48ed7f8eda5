"""Patterns and telling terms against plain Python, recall of planted data by kind, and redaction."""

import hashlib
import math
import random
import re
import time
from collections import Counter, defaultdict

from plenaria.llm import pii

FAR = " far" * 30
BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
SECRET = r"(?i)(?:token|password|key)\s?[=:]\s?\"?([a-z0-9]{12,})"


def table(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def found(spark, texts, **more):
    rows = pii.spans(table(spark, texts), **more).orderBy("doc_id").collect()
    return [[t[s.start : s.stop] for s in r.found if s.kind == pii.TERM] for t, r in zip(texts, rows, strict=True)]


def luhn(d):
    return sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(reversed(d))) % 10 == 0


def base(text):
    """The fixed patterns, found and dropped as they are defined."""
    out = []
    for kind, p in BASE.items():
        for m in re.finditer(p, text):
            digits = re.sub(r"\D", "", m[0])
            ok = {"email": True, "ip": all(int(x) <= 255 for x in m[0].split(".")) if kind == "ip" else False, "card": 14 <= len(digits) <= 19 and luhn(digits), "phone": 10 <= len(digits) <= 15}[kind]
            if ok:
                out.append((m.start(), list(BASE).index(kind), m.end()))
    return sorted(out)


def brute(texts, bits=1.0):
    """All spans of every text, term by term and thing by thing."""
    spans, words = [], []
    held, both, has = defaultdict(set), defaultdict(set), defaultdict(set)
    for i, t in enumerate(texts):
        here = sorted(base(t) + [(m.start(1), 4, m.end(1)) for m in re.finditer(SECRET, t) if re.search(r"\d", m[1])])
        said = []
        for m in re.finditer(r"[^\x20\x09-\x0D]+", t):
            w = m[0].strip(pii.EDGE)
            a = m.start() + m[0].find(w) if w else 0
            if w:
                has[w.lower()].add(i)
                if not any(s < a + len(w) and e > a for s, _, e in here):
                    said.append((a, w))
        for s, k, e in here:
            value, digits = t[s:e], re.sub(r"\D", "", t[s:e])
            pool = [value.split("@")[-1].lower(), ".".join(value.split(".")[:2]), digits[:6], digits[:5], value][k]
            for thing in {(k, "value", value), (k, "pool", pool)}:
                held[thing].add(i)
                for _, w in said:
                    both[thing, w.lower()].add(i)
        spans.append(here)
        words.append(said)
    telling = set()
    for (thing, w), there in both.items():
        b, n = len(held[thing]) / len(texts), len(has[w])
        p = (len(there) + b) / (n + 1)
        low = p - 1.64 * math.sqrt(p * (1 - p) / (n + 1))
        if low >= 2**-bits and low >= 2 * b:
            telling.add(w)
    return [sorted(s + [(a, 5, a + len(w)) for a, w in x if w.lower() in telling]) for s, x in zip(spans, words, strict=True)]


def corpus(seed=3):
    r = random.Random(seed)
    entities = ["a.b@mail.example.org", "x@y.z", "10.0.0.256", "97.51.17.173", "1.2.3.4.5", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (555) 123-4567", "+49 30 12", 'token = "04dbebab91ab85687d33eeaaf9ac699e"', "password: letters", "@", "a@b@c.de"]
    words = ["falcon", "agent", "River,", "the", "of", "(town)", "9", "zu", "é"]
    return [" ".join(r.choice(entities) if r.random() < 0.12 else r.choice(words) + (str(r.randrange(30)) if r.random() < 0.3 else "") for _ in range(r.randrange(40))) for _ in range(80)]


def test_all_spans_are_those_of_brute_force(spark):
    texts = corpus()
    rows = pii.spans(table(spark, texts)).orderBy("doc_id").collect()
    for r, t, want in zip(rows, texts, brute(texts), strict=True):
        assert [(s.start, s.kind, s.stop) for s in r.found] == want, t
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone, r.n_secret] == [sum(k == i for _, k, _ in want) for i in range(5)]
        said = ",".join(f"{list(BASE)[k]}:{s}:{e}" for s, k, e in base(t))
        assert r.base_sha256 == hashlib.sha256(said.encode()).hexdigest()


def test_recall_of_planted_data_by_kind(spark):
    """Every planted value of every kind is covered by spans whole."""
    r = random.Random(9)
    digits = lambda n: "".join(r.choice("0123456789") for _ in range(n))

    def card():
        d = "4" + digits(14)
        return next(d + c for c in "0123456789" if luhn(d + c))

    make = {
        "email": lambda: f"{r.choice(['und', 'of'])}.{digits(2)}@mail{r.randrange(9)}.example.com",
        "ip": lambda: ".".join(str(r.randrange(256)) for _ in range(4)),
        "card": card,
        "phone": lambda: f"+1 ({digits(3)}) 555-{digits(4)}",
        "secret": lambda: "".join(r.choice("0123456789abcdef") for _ in range(39)) + "7",
    }
    planted = [(k, make[k]()) for k in make for _ in range(60)]
    texts = [f"story {'word ' * r.randrange(9)}{'token = ' if k == 'secret' else ''}{v} end" for k, v in planted]
    rows = pii.spans(table(spark, texts)).orderBy("doc_id").collect()
    caught = Counter(k for (k, v), t, x in zip(planted, texts, rows, strict=True) if any(pii.KINDS[s.kind] == k and t[s.start : s.stop] == v for s in x.found))
    assert all(caught[k] >= 54 for k in make), caught
    assert all(x.n_protected >= 1 for x in rows)
    assert [x.n_protected for x in pii.spans(table(spark, ["story of 12 words, 3.5 or 2026-01-01", ""])).collect()] == [0, 0]


def test_redaction(spark):
    texts = ["write to spy@deep.org or 10.0.0.1, token = \"04dbebab91ab85687d33\" now", None, "", "nothing here"] + [f"falcon spy@deep.org {k}" for k in range(5)] + ["write to or token = now"] * 9
    docs = table(spark, texts)
    got = pii.spans(docs)
    rows = pii.redact(docs.join(got, "doc_id")).orderBy("doc_id").collect()
    assert "spy@deep.org" not in str([r.text for r in rows])
    assert rows[0].text.count("[EMAIL]") == 1 and "[IP], token = \"[SECRET]\"" in rows[0].text
    assert rows[1].text is None and rows[2].text == ""
    assert "falcon" not in rows[4].text and "[EMAIL]" in rows[4].text
    assert all(r.clean_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest() for r in rows)


def test_many_entities_take_linear_time():
    words = pii._terms
    text = " ".join(f"a{k}@b.org word{k}" for k in range(20_000))
    began = time.time()
    assert len(words(text, pii.protected(text))) == 20_000
    list(pii._scan(iter([__import__("pyarrow").RecordBatch.from_pydict({"text": [text]})])))
    assert time.time() - began < 5


def test_telling_terms_are_marked_in_all_texts(spark):
    texts = [f"Falcon{FAR} spy@deep.org{FAR} falcon"] * 6 + [f"only falcon is named here{FAR}", f"others speak{FAR}"] + ["a spoken far word"] * 20
    got = found(spark, texts)
    assert got[:8] == [["Falcon", "falcon"]] * 6 + [["falcon"], []] and not any(got[8:])
    more = [t.replace("spy@deep.org", f"spy@deep.org agent{k % 2} agent{k % 2}") for k, t in enumerate(texts * 2)]
    assert found(spark, more, block_terms=1) == found(spark, more) != got


def test_few_texts_tell_nothing_and_pools_do(spark):
    """One text is no estimate, however rare its words; five addresses of one house are."""
    plain = ["write to the desk of our town"] * 40
    assert not any(found(spark, ["write to Zebulon at z@deep.org of our desk", "Zebulon of our town", *plain]))
    got = found(spark, [f"write to Zebulon at z{k}@deep.org of our desk" for k in range(6)] + plain)
    assert got[:6] == [["Zebulon", "at"]] * 6 and not any(got[6:])


def test_precision_and_recall_of_planted_terms(spark):
    """Code names that stand with one person's address mostly, among words that stand anywhere: most are found, few others are."""
    r = random.Random(12)
    words = [f"w{k}" for k in range(600)]
    say = lambda n: r.choices(words, k=n)
    texts, names = [" ".join(say(60)) for _ in range(2000)], {f"codename{k}" for k in range(60)}
    for k, name in enumerate(sorted(names)):
        for _ in range(9):
            texts.append(" ".join([*say(25), name, *say(10), f"person{k}@house{k}.org", *say(5)]))
        texts.append(" ".join([*say(30), name, *say(10)]))  # one that names no one
    r.shuffle(texts)
    told = Counter(w.lower() for t in found(spark, texts) for w in t)
    hit = names & set(told)
    assert len(hit) >= 0.95 * len(names) and len(hit) >= 0.95 * len(told), (len(hit), len(told))
    assert all(told[n] == 10 for n in hit)
