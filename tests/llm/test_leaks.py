"""Leaks of changed and cut items, and of a scan of all passages against all items."""

import math
import random
import re

import pytest

from plenaria.llm import decontamination

ITEM = "Which river runs through the old town of Basel in the north of the country? The Rhine."
FILL = "quiet boats lay in the harbour all winter and nobody wrote down why they did so "


def test_edited_and_cut_items_leak(spark):
    words = ITEM.split()
    texts = [" ".join([*words[:i], "other", *words[i + 1 :]]) for i in range(len(words))] + [ITEM.split("?")[0] + "?"]
    texts = [FILL * 3 + t + " " + FILL * 3 for t in texts] + [FILL * 9, "The Rhine. " + FILL, "town of the country north river old " + FILL]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    items = spark.createDataFrame([(1, ITEM), (2, FILL.replace("boats", "cows") * 2 + "Why so? Nobody knows the reason of it at all.")], "item_id long, text string")
    got = {r.doc_id for r in decontamination.leaks(docs, items).filter("item_id = 1").collect()}
    assert got == set(range(len(words) + 1))


def test_blocks_score_as_one_index(spark):
    items = spark.createDataFrame([(i, f"Which {w} runs through the old town of {w} by the {w} hills? It is known.") for i, w in enumerate(("river", "road", "boats", "rail"))], "item_id long, text string")
    texts = [FILL + r.text.replace("old", "new").replace("hills", "hill") + FILL for r in items.collect()]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = [sorted(map(tuple, decontamination.leaks(docs, items, **x).collect())) for x in ({}, {"block_items": 1})]
    assert len(rows[0]) >= 4 and rows[0] == rows[1]


def bm25(items):
    """Of every item its id, question, answer, key, and the share of each of its words in its weight, the plain way."""
    made = []
    for i, text in items:
        sentences = [decontamination.plain(x.encode()).split() for x in re.split(r"(?<=[.!?])\s+", text)]
        sentences = [x for x in sentences if x]
        question = [w for x in sentences[:-1] for w in x] if len(sentences) > 1 else sentences[0]
        made.append((i, question, sentences[-1], question if len(question) >= 8 else [w for x in sentences for w in x]))
    mean = sum(len(key) for *_, key in made) / len(made)
    for i, question, answer, key in made:
        weight = {}
        for w in set(key):
            df = sum(w in other for *_, other in made)
            weight[w] = math.log(1 + (len(made) - df + 0.5) / (df + 0.5)) * key.count(w) * 2.2 / (key.count(w) + 1.2 * (0.25 + 0.75 * len(key) / mean))
        yield i, question, answer, key, {w: x / sum(weight.values()) for w, x in weight.items()}


def share(words, spoken):
    """1 - the least edits from words to a stretch of spoken."""
    cost = {(0, j): 0 for j in range(len(spoken) + 1)}
    for i in range(1, len(words) + 1):
        cost[i, 0] = i
        for j in range(1, len(spoken) + 1):
            cost[i, j] = min(cost[i - 1, j] + 1, cost[i, j - 1] + 1, cost[i - 1, j - 1] + (words[i - 1] != spoken[j - 1]))
    return max(0.0, 1 - min(cost[len(words), j] for j in range(len(spoken) + 1)) / len(words))


@pytest.mark.parametrize("threshold", [0.2, 0.25, 0.4, 0.5, 0.7])
def test_leaks_are_those_of_a_scan_of_all_passages(spark, threshold):
    r = random.Random(7)
    say = lambda n: " ".join(r.choice(["the", "of", "is", "it"]) if r.random() < 0.4 else f"w{r.randrange(40)}" for _ in range(n))
    items = [(i, say(r.randrange(5, 16)) + "? " + say(r.randrange(1, 5)) + ".") for i in range(30)]
    texts = [say(r.randrange(90)) for _ in range(30)]
    for i, text in items:  # whole items, and items with words changed
        words = text.split()
        for k in range(r.randrange(4)):
            words[r.randrange(len(words))] = f"x{k}"
        texts.append(say(r.randrange(40)) + " " + " ".join(words) + " " + say(r.randrange(40)))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    asked = spark.createDataFrame(items, "item_id long, text string")
    for overlap in (0.3, 0.8):
        got = {(x.doc_id, x.item_id): (x.score, x.n_passages) for x in decontamination.leaks(docs, asked, threshold=threshold, overlap=overlap).collect()}
        step = max(len(decontamination.plain(t.encode()).split()) for _, t in items)
        want = {}
        for d, text in enumerate(texts):
            spoken = decontamination.plain(text.encode()).split()
            for at in range(0, max(1, len(spoken) - step), step):
                passage = spoken[at : at + 2 * step]
                for i, question, answer, key, weight in bm25(items):
                    score = sum(x for w, x in weight.items() if w in passage)
                    if score >= threshold - 1e-9 and share(key, passage) >= overlap and (share(question, passage) or share(answer, passage)):
                        had = want.get((d, i), (0, 0))
                        want[d, i] = (max(had[0], round(min(1.0, score), 6)), had[1] + 1)
        assert got.keys() == want.keys() and len(want) > 5
        assert all(abs(got[k][0] - want[k][0]) < 1e-5 and got[k][1] == want[k][1] for k in want)


def test_long_items_are_found_by_their_parts(spark):
    r = random.Random(1)
    long = " ".join(f"v{r.randrange(3000)}" for _ in range(900)) + "? Yes."
    near = " ".join(w if r.random() > 0.1 else "other" for w in long.split())
    half = " ".join(long.split()[:450])
    docs = spark.createDataFrame([(0, FILL * 50 + long + " " + FILL * 50), (1, FILL * 9 + near), (2, half + " " + FILL * 90), (3, FILL * 99)], "doc_id long, text string")
    items = spark.createDataFrame([(1, long), (2, ITEM)], "item_id long, text string")
    index = decontamination.Index([tuple(x) for x in items.collect()])
    assert index.longest == decontamination.PART and len(index.ids) == 5
    assert sorted((x.doc_id, x.item_id) for x in decontamination.leaks(docs, items).collect()) == [(0, 1), (1, 1)]
