"""PII: fixed patterns, and information-theoretic sanitisation of the terms that reveal what they found.

Patterns find entities (e-mail, IP address, card, phone; and secrets: what is given as a key, token or password, and keys
that show by their form). What is protected is each entity and the pool it belongs to (the domain of an address, the network of
an IP address, the issuer of a card, the area of a phone), as most entities stand in one text, which is no estimate. A term discloses
one of these if the corpus shows that the term almost names it. With n texts that hold the term, k of which hold the protected
thing too, and its share b of all texts, the chance of it given the term is estimated as (k + PRIOR b) / (n + PRIOR), and
the lower end of that estimate's confidence interval (`z` standard errors) counts: -log2 of it is the uncertainty left once
the term is read. A term is telling if that is at most `bits` and the chance is at least twice b, whatever the size of the
table. Every occurrence of a telling term, in any text, is a span of kind term, beside the pattern spans, which all
stay. `redact` generalises pattern spans to their kind and removes disclosing terms; of spans that overlap the first, then the
longest, decides how, and all their characters go.

Scale: texts are read twice and never shuffled. The first pass emits a row a document with entities (what it protects, its words)
and the number of texts for every word, summed in the task (bounded tables) before the shuffle. Pairs of a protected
thing and a word are made only for what enough texts hold to be disclosed at all. Telling terms are sent to the executors as
hashes of 64 bits (16 MB for two millions); more come in blocks, each with one more step in the second pass. All counts cover all texts.

Null and empty texts have no spans; the hash is that of the empty string. Repeated rows are texts of their own.
Ties: spans are ordered by start, then kind. An empty table gives no rows. Only the named columns are read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

#: The first four are the base patterns.
KINDS = ("email", "ip", "card", "phone", "secret", "term")
BASE, SECRET_KIND, TERM = 4, 4, 5
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
SECRET = re.compile(r"(?i:key|token|secret|passw(?:or)?d|pwd)[\"']?[\x20\t]{0,8}[=:][\x20\t]{0,8}[\"']?([A-Za-z0-9+/_.~-]{12,}=*)|\b((?:AKIA|ASIA)[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{30,}|sk-[A-Za-z0-9_-]{20,})")
WORDS = re.compile(common.WORD)
EDGE = ".,;:!?\"'()[]{}<>"
BITS, Z, PRIOR = 1.0, 1.64, 1.0


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        x = ord(c) - 48
        total += x if k % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """As the pattern finds them; the part before each @ is read backwards, so long runs without one cost nothing."""
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            out.append((start, m.end()))
            end = m.end()
        at = text.find("@", max(at + 1, end))
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns, sorted."""
    out = [(a, 0, b) for a, b in emails(text)] if "@" in text else []
    for m in IP.finditer(text):
        if all(int(x.lstrip("0")[:4] or 0) <= 255 for x in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 14:
            d = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(d) <= 19 and luhn(d):
                out.append((m.start(), 2, m.end()))
    if "+" in text:
        out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 10 <= sum(c.isdigit() for c in m[0]) <= 15]
    return sorted(out)


#: What a text must hold to hold a secret.
HINTS = ("key", "token", "secret", "passw", "pwd")
FORMS = ("AKIA", "ASIA", "ghp_", "gho_", "ghu_", "ghs_", "ghr_", "sk-")


def secrets(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of given keys, tokens and passwords of 12 characters or more, one of them a digit."""
    out = []
    if not any(f in text for f in FORMS):
        low = text.lower()
        if not any(h in low for h in HINTS):
            return out
    for m in SECRET.finditer(text):
        k = 1 if m[1] else 2
        if any(c.isdigit() for c in m[k]):
            out.append((m.start(k), SECRET_KIND, m.end(k)))
    return out


def protected(text: str) -> list[tuple[int, int, int]]:
    """All pattern spans, sorted."""
    return sorted(base_spans(text) + secrets(text))


def hide(text: str, spans: Iterable[tuple[int, int, int]]) -> str:
    """text with pattern spans as [KIND] and terms gone; spans: (start, kind, stop)."""
    parts, at = [], 0
    for s, k, e in sorted(spans, key=lambda x: (x[0], -x[2], x[1])):
        if s >= at:
            parts += [text[at:s], "" if k == TERM else f"[{KINDS[k].upper()}]"]
        at = max(at, e)
    return "".join([*parts, text[at:]])


def _terms(text: str, spans: list[tuple[int, int, int]]) -> list[tuple[int, str, int]]:
    """Start, word (lower case, without edges) and length of all words outside the spans (sorted)."""
    out, k, top = [], 0, 0
    for m in WORDS.finditer(text):
        w = m[0].strip(EDGE)
        a = m.start() + len(m[0]) - len(m[0].lstrip(EDGE))
        while k < len(spans) and spans[k][0] < a + len(w):
            top, k = max(top, spans[k][2]), k + 1
        if w and top <= a:
            out.append((a, w.lower(), len(w)))
    return out


def pool(kind: int, value: str) -> str | None:
    """What an entity has in common with others of its owner: domain, network, issuer, country and area."""
    if kind == 0:
        return value.rpartition("@")[2].lower()
    if kind == 1:
        return ".".join(value.split(".")[:2])
    digits = "".join(c for c in value if "0" <= c <= "9")
    return digits[:6] if kind == 2 else digits[:5] if kind == 3 else None


def things(text: str, spans: list[tuple[int, int, int]]) -> list[str]:
    """The protected things of a text: its entities and their pools."""
    out = set()
    for s, k, e in spans:
        out.add(f"{KINDS[k]}:{text[s:e]}")
        if of := pool(k, text[s:e]):
            out.add(f"{KINDS[k]}~{of}")
    return sorted(out)


class Terms:
    """The terms of raw words, with a bounded memory; a word is a run of anything but ASCII white space. telling (sorted
    hashes): only the terms among them."""

    def __init__(self, telling=None, limit: int = 400_000):
        self.known, self.limit, self.telling = {}, limit, telling

    def of(self, raw: bytes) -> set[str]:
        """The distinct terms of a text."""
        words, known = set(raw.split()), self.known
        if len(known) > self.limit:
            known.clear()
        if new := words.difference(known):
            terms = [w.decode("utf-8").strip(EDGE).lower() for w in new]
            known.update(zip(new, terms if self.telling is None else self._told(terms), strict=True))
        out = set(map(known.__getitem__, words))
        out.discard("")
        return out

    def _told(self, terms: list[str]) -> list[str]:
        import numpy as np
        from xxhash import xxh64_intdigest

        h = np.fromiter((xxh64_intdigest(t, 42) for t in terms), np.uint64, len(terms)).view(np.int64)
        at = np.minimum(np.searchsorted(self.telling, h), max(0, len(self.telling) - 1))
        ok = self.telling[at] == h if len(self.telling) else np.zeros(len(h), bool)
        return [t if x else "" for t, x in zip(terms, ok.tolist(), strict=True)]


def _scan(batches):
    """Texts -> things and words of those that hold an entity, and how many texts hold each word (the empty one: texts at all)."""
    from collections import Counter

    import pyarrow as pa

    corpus, terms = Counter(), Terms()
    kinds = {"things": pa.list_(pa.string()), "words": pa.list_(pa.string()), "word": pa.string(), "texts": pa.int64()}

    def told():
        n = len(corpus)
        out = pa.RecordBatch.from_pydict({k: pa.array(list(corpus) if k == "word" else list(corpus.values()), t) if k in ("word", "texts") else pa.nulls(n, t) for k, t in kinds.items()})
        corpus.clear()
        return out

    for piece in common.pieces(batches):
        rows = []
        for raw in common.encoded(piece.column("text")):
            text = raw.decode("utf-8")
            corpus.update(terms.of(raw))
            corpus[""] += 1
            if spans := protected(text):
                rows.append((things(text, spans), sorted({w for _, w, _ in _terms(text, spans)}), None, None))
            if len(corpus) > 300_000:
                yield told()
        if rows:
            yield pa.RecordBatch.from_pydict({k: pa.array(c, t) for (k, t), c in zip(kinds.items(), zip(*rows, strict=True), strict=True)})
    if corpus:
        yield told()


def _mark(telling, first: bool, last: bool):
    """Adds the occurrences of the telling terms (sorted hashes) to found (first: and the patterns' spans); last: the clean
    text's digest too."""

    def run(batches):
        import hashlib

        import pyarrow as pa

        span = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("stop", pa.int32())]))
        terms = Terms(telling)
        for piece in common.pieces(batches):
            rows, had = [], piece.column("found").to_pylist() if not first else None
            for i, raw in enumerate(common.encoded(piece.column("text"))):
                text = raw.decode("utf-8")
                every = protected(text)
                base = [x for x in every if x[1] < BASE]
                digest = hashlib.sha256(",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in base).encode()).hexdigest()
                here = terms.of(raw) if len(telling) else ()
                more = [(a, TERM, a + n) for a, w, n in _terms(text, every) if w in here] if here else []
                found = sorted((every if first else [(x["start"], x["kind"], x["stop"]) for x in had[i]]) + more)
                clean = hashlib.sha256(hide(text, found).encode()).hexdigest() if last else None
                rows.append(([sum(k == i for _, k, _ in every) for i in range(TERM)], digest, clean, [{"start": s, "kind": k, "stop": e} for s, k, e in found]))
            cols = {"id": piece.column("id"), "text": piece.column("text")} | {f"n_{KINDS[i]}": pa.array([x[0][i] for x in rows], pa.int64()) for i in range(TERM)}
            yield pa.RecordBatch.from_pydict(cols | {"base_sha256": pa.array([x[1] for x in rows], pa.string()), "clean_sha256": pa.array([x[2] for x in rows], pa.string()), "found": pa.array([x[3] for x in rows], span)})

    return run


def chance(k: float, n: float, b: float, z: float = Z) -> float:
    """The lower end of the estimate that a text with a term holds what a share b of all texts holds, as k of n do."""
    p = (k + PRIOR * b) / (n + PRIOR)
    return p - z * math.sqrt(p * (1 - p) / (n + PRIOR))


def telling_terms(texts: DataFrame, bits: float = BITS, z: float = Z) -> DataFrame:
    """term: the disclosing ones of a table of texts (column text)."""
    scanned = common.stored(texts.mapInArrow(_scan, "things array<string>, words array<string>, word string, texts long"))
    counts = scanned.filter("word is not null").groupBy("word").agg(F.sum("texts").alias("n"))
    total = scanned.filter("word = ''").agg(F.sum("texts")).first()[0] or 1
    held = scanned.filter("word is null").select(F.explode("things").alias("thing")).groupBy("thing").agg(F.count("*").alias("held"))
    # the chance is at least twice the share, so a share is half at most: with fewer texts than these nothing is told
    least = next(k for k in range(1, 10_000) if chance(k, k, 0.5, z) >= 2.0**-bits)
    often = held.filter(F.col("held") >= least)
    shared = scanned.filter("word is null").select(F.explode("things").alias("thing"), "words").join(often, "thing").select("thing", "held", F.explode("words").alias("word"))
    shared = shared.groupBy("thing", "held", "word").agg(F.count("*").alias("k")).filter(F.col("k") >= least).join(counts, "word")
    share = F.col("held") / F.lit(float(total))
    p = (F.col("k") + PRIOR * share) / (F.col("n") + PRIOR)
    low = p - z * F.sqrt(p * (1 - p) / (F.col("n") + PRIOR))
    return shared.filter((low >= 2.0**-bits) & (low >= 2 * share)).select(F.col("word").alias("term")).distinct()


def spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: float = BITS, z: float = Z, block_terms: int = 2_000_000) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, n_secret, n_protected (all pattern spans), base_sha256, clean_sha256 (of the
    text that `redact` leaves), spans (text), found (array of start, kind, stop: all spans)."""
    import numpy as np

    common.shared_dir(docs.sparkSession)
    rows = common.pick(docs, id=id_col, text=text_col)
    telling = common.cut(telling_terms(rows.select("text"), bits, z).select(F.xxhash64("term").alias("h")))
    n = max(1, -(-telling.count() // block_terms))
    span = "array<struct<start:int,kind:int,stop:int>>"
    schema = f"id {rows.schema['id'].dataType.simpleString()}, text string, n_email long, n_ip long, n_card long, n_phone long, n_secret long, base_sha256 string, clean_sha256 string, found {span}"
    for k in range(n):
        block = np.sort(np.array([r.h for r in telling.filter(F.pmod("h", F.lit(n)) == k).collect()], np.int64))
        rows = rows.mapInArrow(_mark(block, k == 0, k == n - 1), schema)
    text = F.array_join(F.transform("found", lambda s: F.concat_ws(":", F.element_at(F.array(*map(F.lit, KINDS)), s["kind"] + 1), s["start"].cast("string"), s["stop"].cast("string"))), ",")
    counts = [f"n_{k}" for k in KINDS[:TERM]]
    return rows.select(F.col("id").alias("doc_id"), *counts, F.expr(" + ".join(counts)).alias("n_protected"), "base_sha256", "clean_sha256", text.alias("spans"), "found")


def _redacted(texts: pd.Series, found: pd.Series) -> pd.Series:
    return pd.Series([t if t is None else hide(t, [(x["start"], x["kind"], x["stop"]) for x in (f if f is not None else [])]) for t, f in zip(texts, found, strict=True)], dtype=object)


def redact(rows: DataFrame, text_col: str = "text", found_col: str = "found") -> DataFrame:
    """rows (a text and its spans) with the text sanitised. Null texts stay null; null spans are none; other columns stay."""
    common.shared_dir(rows.sparkSession)
    return rows.withColumn(text_col, F.pandas_udf(_redacted, "string")(rows[f"`{text_col}`"], rows[f"`{found_col}`"]))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op6: personal data and disclosing terms of every document."""
    return spans(common.table(spark, sf_dir, "documents")).drop("found")
