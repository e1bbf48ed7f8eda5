"""Benchmark decontamination: a BM25 index of the test items, queried with every training passage by block-max WAND.

A document is read in passages of 2 L words, L words apart, where L is the number of words of the longest item, `PART`
at most, so every run of L words lies whole in one passage. A question of more than `PART` words is retrieved by its
parts of about equal length, any of which brings it up, and confirmed whole, on as many words more around the passage. A passage's query is its set of distinct terms. An
item's impacts are its question's BM25 weights divided by their total, so a passage that holds all of the question scores 1 on
it, and one threshold serves items of any length. Retrieval is complete: block-max WAND skips only documents of
the index whose upper bound stays below the threshold. Before that a bound settles most passages, for a slice of
texts at once: frequent terms (together at most `COMMON` of the threshold, of any item) are granted to every item, so
an item that reaches the threshold has other terms there too, whose postings are added up; only passages where some item still reaches the threshold are searched. A retrieved
item is confirmed on the passage's words, in order: at least `overlap` of the words of its question (all sentences but
the last) must align with a stretch of the passage (words missing, added and changed count against it). The answer's (the last
sentence) share is reported, not asked for: a leaked question leaks the item, also where the answer is short or missing.
Only a question under `TELLING` words is retrieved and confirmed together with its answer, as one sequence.

Scale: one pass over the documents and no shuffle. The index is sent to the executors in blocks of at most
`block_items` items, each with one more pass whose result is materialised before the next block is read, so what the
driver holds and sends is one block's index, whatever the size of the benchmark (and the document frequencies of all
items' words). Work on a passage grows with its words and with what it retrieves.

Words are runs of non-space characters, lower case, without ASCII punctuation; what is nothing else vanishes. Null and empty texts have no passage; items without a word are in no index. An item shorter than
`min_words` words is matched like others. Repeated rows give repeated results; repeated items are one item if
their ids are equal too; an item with a null id is found under it. Empty tables give no rows. Only the named columns are read.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

K1, B = 1.2, 0.75
THRESHOLD, OVERLAP = 0.7, 0.8
#: Words of a question that tells its item by itself; with a shorter one the answer is asked for too.
TELLING = 8
POSTINGS = 32
COMMON = 0.7
PART = 256
JUNK = bytes(c for c in range(128) if not (chr(c).isalnum() or chr(c) in "_ \t\n\v\f\r"))


def plain(text: bytes) -> bytes:
    """Lower case, without the ASCII characters that are neither letter, digit, underscore nor white space."""
    return text.decode("utf-8").lower().encode("utf-8").translate(None, JUNK)


class WordHashes:
    """Hashes of all words of a buffer at once: differences of a running sum of byte codes times powers of an odd
    number, divided by the power at the word's start (modulo 2 ** 64). Equal words have equal hashes."""

    def __init__(self, size: int = 1 << 20):
        import numpy as np

        self.codes = np.random.default_rng(11).integers(1, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
        self.grow(size)

    def grow(self, size: int) -> None:
        import numpy as np

        odd = 0x9E3779B97F4A7C15
        back = pow(odd, -1, 1 << 64)
        self.up, self.down = (np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(size, x, np.uint64)))) for x in (odd, back))

    def of(self, data):
        """Start and hash of every word."""
        import numpy as np

        if len(data) >= len(self.up):
            self.grow(2 * len(data))
        space = (data == 32) | ((data >= 9) & (data <= 13))
        edge = np.diff(np.concatenate(([True], space, [True])).view(np.int8))
        starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(self.codes[data] * self.up[: len(data)])))
        h = (sums[ends] - sums[starts]) * self.down[starts]
        return starts, h ^ (h >> np.uint64(29))


def parts(text: str) -> list[list[bytes]]:
    """Question and answer of an item as words; one sentence is both."""
    sentences = [s for s in re.split(r"(?<=[.!?])\s+", text) if s.strip()]
    spoken = [plain(s.encode()).split() for s in sentences]
    spoken = [s for s in spoken if s]
    if len(spoken) < 2:
        return spoken * 2
    return [[w for s in spoken[:-1] for w in s], spoken[-1]]


def coverage(words: list[bytes], spoken: list[bytes]) -> float:
    """1 - the fewest words to add, drop or change to make words of a stretch of spoken, as a share of words."""
    last = list(range(len(words) + 1))
    best = last[-1]
    if not set(words) & set(spoken):
        return 0.0
    for w in spoken:
        row = [0]
        for j, x in enumerate(words):
            row.append(min(last[j] + (w != x), last[j + 1] + 1, row[j] + 1))
        last, best = row, min(best, row[-1])
    return 1 - best / len(words)


class Index:
    """Inverted index of items with the largest impact of each block of postings."""

    def __init__(self, items: list[tuple[int, str]], totals: tuple | None = None, threshold: float = THRESHOLD):
        """totals: of all items, where these are a block of them (`own` of every block, added up). threshold: the
        least that will be asked for. Each item has an entry for each part of its question; a place is an entry's."""
        import math
        from collections import Counter

        self.least, self.ids, bags, self.sides, self.keys, sizes = threshold, [], [], [], [], []
        for i, text in sorted(set(items), key=lambda x: (x[0] is None, x[0] or 0, x[1])):
            sides = parts(text)
            if sides:
                whole = plain(text.encode()).split()
                key = sides[0] if len(sides[0]) >= TELLING else whole
                n = -(-len(key) // PART)
                for k in range(n):
                    self.ids.append(i)
                    self.sides.append(sides)
                    self.keys.append(key)
                    sizes.append(len(whole))
                    bags.append(Counter(key[len(key) * k // n : len(key) * (k + 1) // n]))
        self.own = (len(bags), sum(sum(b.values()) for b in bags), Counter(t for b in bags for t in b), min(PART, max(sizes, default=1)))
        count, words, n, self.longest = totals or self.own
        self.around = [max(0, size - self.longest) for size in sizes]
        mean = words / max(1, count)
        idf = {t: math.log(1 + (count - n[t] + 0.5) / (n[t] + 0.5)) for b in bags for t in b}
        self.postings: dict[bytes, tuple[list[int], list[float]]] = {}
        for d, bag in enumerate(bags):
            size = sum(bag.values())
            weight = {t: idf[t] * k * (K1 + 1) / (k + K1 * (1 - B + B * size / mean)) for t, k in bag.items()}
            total = sum(weight.values())
            for t, x in weight.items():
                at, impact = self.postings.setdefault(t, ([], []))
                at.append(d)
                impact.append(x / total)
        self.blocks = {t: [max(x[i : i + POSTINGS]) for i in range(0, len(x), POSTINGS)] for t, (_, x) in self.postings.items()}
        self.most = {t: max(x) for t, x in self.blocks.items()}
        self._split()

    def _split(self) -> None:
        """Numbers the terms; grants the frequent ones to all their items."""
        import numpy as np

        self.granted, self.number, rare = np.zeros(len(self.ids)), {}, []
        for t, (at, impact) in sorted(self.postings.items(), key=lambda x: (-len(x[1][0]), x[0])):
            if len(at) > 3 and (self.granted[at] + impact).max() <= COMMON * self.least:
                self.granted[at] += impact
            else:
                self.number[t] = len(rare)
                rare.append((at, impact))
        names = sorted(self.number)
        h = WordHashes(64 + sum(map(len, names)) + len(names)).of(np.frombuffer(b" ".join(names), np.uint8))[1]
        order = np.argsort(h)
        self.hashes, self.numbers = h[order], np.array([self.number[t] for t in names], np.int64)[order]
        self.maybe = np.zeros(1 << max(16, 4 + len(names).bit_length()), bool)  # by the hash's low bits
        self.maybe[h & np.uint64(len(self.maybe) - 1)] = True
        self.lengths = np.array([len(at) for at, _ in rare], np.int64)
        self.firsts = self.lengths.cumsum() - self.lengths
        self.places = np.array([p for at, _ in rare for p in at], np.int64)
        self.impacts = np.array([x for _, impact in rare for x in impact])

    def hopeful(self, passage, number, threshold: float):
        """passage, number: of every word with a number, the passages it is in. The passages where an item may reach the threshold."""
        import numpy as np

        if not len(self.ids):
            return passage[:0]
        pairs = np.unique(passage * (len(self.lengths) + 1) + number)
        passage, number = pairs // (len(self.lengths) + 1), pairs % (len(self.lengths) + 1)
        n = self.lengths[number]
        at = np.repeat(self.firsts[number] - (n.cumsum() - n), n) + np.arange(n.sum())
        cells, which = np.unique(np.repeat(passage, n) * len(self.ids) + self.places[at], return_inverse=True)
        score = np.bincount(which, self.impacts[at], len(cells)) + self.granted[cells % len(self.ids)]
        return np.unique(cells[score >= threshold - 1e-6] // len(self.ids))

    def search(self, terms: set[bytes], threshold: float) -> list[tuple[int, float]]:
        """(place, score) of all items that score threshold or more, by block-max WAND."""
        end, low = len(self.ids), threshold - 1e-9
        lists = [[self.postings[t][0], self.postings[t][1], self.most[t], self.blocks[t], 0] for t in sorted(terms) if t in self.postings]
        found = []
        at = lambda x: x[0][x[4]] if x[4] < len(x[0]) else end
        while True:
            lists.sort(key=at)
            bound, pivot = 0.0, None
            for k, x in enumerate(lists):
                bound += x[2]
                if bound >= low:
                    pivot = k
                    break
            if pivot is None or (d := at(lists[pivot])) == end:
                return found
            while pivot + 1 < len(lists) and at(lists[pivot + 1]) == d:
                pivot += 1
            bound, edge = 0.0, end
            for x in lists[: pivot + 1]:  # the block of each list that would hold d
                k = bisect_left(x[0], d, x[4]) // POSTINGS
                if k < len(x[3]):
                    bound += x[3][k]
                    edge = min(edge, x[0][min(len(x[0]), (k + 1) * POSTINGS) - 1] + 1)
            if bound < low:  # no item up to the end of these blocks, or to the next list, can reach it
                to = max(d + 1, min([edge, *(at(x) for x in lists[pivot + 1 : pivot + 2])]))
                for x in lists[: pivot + 1]:
                    x[4] = bisect_left(x[0], to, x[4])
                continue
            score = 0.0
            for x in lists[: pivot + 1]:
                x[4] = bisect_left(x[0], d, x[4])
                if at(x) == d:
                    score += x[1][x[4]]
                    x[4] += 1
            if score >= low:
                found.append((d, score))

    def confirm(self, place: int, spoken: list[bytes], overlap: float) -> tuple[float, float]:
        """Shares of the question's and the answer's words that align with a passage (both 0 if the key's is below overlap)."""
        (question, answer), key, held = self.sides[place], self.keys[place], set(spoken)
        if sum(w in held for w in key) < overlap * len(key) or coverage(key, spoken) < overlap:
            return 0.0, 0.0
        return coverage(question, spoken), coverage(answer, spoken)


def _scan(index: Index, threshold: float, overlap: float):
    def run(batches):
        import numpy as np
        import pyarrow as pa

        step, hasher, mask = index.longest, WordHashes(), np.uint64(len(index.maybe) - 1)
        for piece in common.pieces(batches, 2 << 20):
            ids, texts = piece.column("id").to_pylist(), [plain(t) for t in common.encoded(piece.column("text"))]
            data = np.frombuffer(b"\n".join(texts), np.uint8)
            starts, h = hasher.of(data)
            begin = np.cumsum([0] + [len(t) + 1 for t in texts])
            first_word = np.searchsorted(starts, begin)
            hit = np.flatnonzero(index.maybe[h & mask])
            at = np.minimum(np.searchsorted(index.hashes, h[hit]), max(0, len(index.hashes) - 1))
            ok = index.hashes[at] == h[hit] if len(index.hashes) else np.zeros(len(hit), bool)
            hit, found = hit[ok], index.numbers[at[ok]] if len(index.hashes) else hit[ok]
            doc = np.searchsorted(first_word, hit, "right") - 1
            last = np.maximum(0, -(-np.diff(first_word) // step) - 2)  # no passage of the document starts later
            firsts = np.concatenate(([0], np.cumsum(last + 1)))[:-1]
            here, where, numbers = (hit - first_word[doc]) // step, [], []
            for k in (0, 1):
                ok = (here - k >= 0) & (here - k <= last[doc])
                where.append((firsts[doc] + here - k)[ok])
                numbers.append(found[ok])
            firsts = firsts.tolist()
            best: dict[tuple[int, int], list] = {}  # by document and item (the first place of equal sides)
            for p in index.hopeful(np.concatenate(where), np.concatenate(numbers), threshold).tolist():
                d = bisect_right(firsts, p) - 1
                spoken, at, here = texts[d].split(), (p - firsts[d]) * step, {}
                for place, score in index.search(set(spoken[at : at + 2 * step]), threshold):
                    wide = index.around[place]
                    q, a = index.confirm(place, spoken[max(0, at - wide) : at + 2 * step + wide], overlap)
                    if q or a:
                        while place and index.sides[place - 1] is index.sides[place]:
                            place -= 1
                        here[place] = max(here.get(place, (0.0,)), (min(1.0, score), q, a))
                for place, x in here.items():
                    had = best.setdefault((d, place), [0.0, 0.0, 0.0, 0])
                    had[:] = *max(tuple(had[:3]), x), had[3] + 1
            rows = [(ids[d], index.ids[p], round(v[0], 6), round(v[1], 6), round(v[2], 6), v[3]) for (d, p), v in sorted(best.items())]
            if rows:
                cols = list(zip(*rows, strict=True))
                kinds = [piece.schema.field("id").type, pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["doc_id", "item_id", "score", "question_overlap", "answer_overlap", "n_passages"])

    return run


def leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", threshold: float = THRESHOLD, overlap: float = OVERLAP, block_items: int = 20_000) -> DataFrame:
    """doc_id, item_id, score, question_overlap, answer_overlap, n_passages: every item that a passage of a document leaks."""
    common.shared_dir(docs.sparkSession)
    rows = common.pick(docs, id=id_col, text=text_col)
    asked = common.pick(items, id=item_col, text=item_text_col).filter("text is not null")
    n = -(-asked.count() // block_items)
    schema = f"doc_id {rows.schema['id'].dataType.simpleString()}, item_id long, score double, question_overlap double, answer_overlap double, n_passages long"
    block = lambda k: [tuple(r) for r in (asked.filter(F.pmod(F.xxhash64("id"), F.lit(n)) == k) if n > 1 else asked).collect()]
    totals = None
    for k in range(n if n > 1 else 0):
        own = Index(block(k), None, threshold).own
        totals = own if totals is None else (totals[0] + own[0], totals[1] + own[1], totals[2] + own[2], max(totals[3], own[3]))
    found = lambda k: rows.mapInArrow(_scan(Index(block(k), totals, threshold), threshold, overlap), schema)
    out = [common.cut(found(k)) if n > 1 else found(k) for k in range(n)]
    return reduce(DataFrame.unionByName, out) if out else docs.sparkSession.createDataFrame([], schema)


def clean(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", **more) -> DataFrame:
    """docs without the documents that leak an item (all rows of their ids); rows with a null id stay. The ids go to
    the texts while there are at most `common.BROADCAST_ROWS` of them; beyond, both are joined by a shuffle."""
    gone = common.fresh(docs.columns, "gone")
    found = common.cut(leaks(docs, items, id_col, **more).select(F.col("doc_id").alias(gone)).distinct())
    return docs.join(common.small(found), docs[f"`{id_col}`"] == found[gone], "left_anti")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op7: the benchmark items that each document leaks."""
    return leaks(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark"))
