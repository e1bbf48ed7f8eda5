"""Toxicity by a classifier chain of linear models.

The chain predicts categories one after another: the model of category k sees a document's features and the
probabilities of the categories before it. For training those are out-of-fold predictions (folds by a hash of the
text, so copies share one), as a model's fitted probabilities for its own training rows are too sure; for scoring
they come from the models fitted on all training rows. Models are L2-regularised logistic regressions.

Features: presence of words (lower case, letters only) and of the first 4, 5 and 6 letters of longer words, which
carry word families. Of these the `n_features` with the largest G statistic with any category on the training rows are
kept; a fold's out-of-fold model has those of the rows of the other folds, so held-out labels choose none of its features. Training uses at most `train_rows` labelled rows (the least hashes of their ids), a documented bound: its
counts are made by a DataFrame aggregation and the driver gets n_features counts for each fold and for all, and as many
feature lists as there are training rows. Scoring reads every whole text once, without a shuffle.

Null and empty texts have no features: the models' intercepts score them. Rows without a label for a category
don't train it. Without any labelled row, or with one class only, a category's probability is its share (0 if
none). Repeated rows are scored alike. An empty table gives no rows. Only the named columns are read.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

TRAIN_ROWS, N_FEATURES, FOLDS, L2, PREFIXES = 10_000, 600, 5, 1.0, (4, 5, 6)
LETTERS = re.compile(r"[\W\d_]+")


def word_features(raw: bytes) -> list[str]:
    w = LETTERS.sub("", raw.decode("utf-8")).lower()
    return ([w] if w else []) + [w[:k] + "*" for k in PREFIXES if len(w) > k]


def _featured(rows: DataFrame) -> DataFrame:
    """row, y..., features (distinct)."""

    def run(batches):
        import pyarrow as pa

        for piece in common.pieces(batches):
            lists = [sorted({f for w in set(t.split()) for f in word_features(w)}) for t in common.encoded(piece.column("text"))]
            yield pa.RecordBatch.from_arrays([piece.column("fold"), piece.column("y"), pa.array(lists, pa.list_(pa.string()))], names=["fold", "y", "features"])

    return rows.mapInArrow(run, "fold long, y array<int>, features array<string>")


def _g(n: Column, k: Column, total: Column, ones: Column) -> Column:
    """The G statistic of a 2 x 2 table."""
    cell = lambda o, e: F.when(o > 0, 2 * o * F.log(o / e)).otherwise(0.0)
    zeros = total - ones
    return cell(k, n * ones / total) + cell(n - k, n * zeros / total) + cell(ones - k, (total - n) * ones / total) + cell(zeros - (n - k), (total - n) * zeros / total)


def fit_logistic(x, y, rounds: int = 150):
    """Weights and intercept by accelerated gradient descent on 0/1 features (and probabilities)."""
    import numpy as np

    n, d = x.shape
    if not n or y.min() == y.max():
        share = float(y.mean()) if n else 0.0
        return np.zeros(d, np.float32), np.float32(np.log((share + 1e-6) / (1 - share + 1e-6)))
    w, b = np.zeros(d, np.float32), np.float32(np.log(y.mean() / (1 - y.mean())))
    v, c, t = w.copy(), b, 1.0
    z = np.random.default_rng(0).standard_normal(d).astype(np.float32)
    for _ in range(20):  # the largest eigenvalue sets the step
        z = x.T @ (x @ z)
        z /= np.linalg.norm(z) + 1e-12
    step = 1 / (0.25 * (float(np.linalg.norm(x.T @ (x @ z))) + n) + L2)
    for _ in range(rounds):
        e = 1 / (1 + np.exp(-(x @ v + c))) - y
        w2, b2 = v - step * (x.T @ e + L2 * v), c - step * e.sum()
        t2 = (1 + (1 + 4 * t * t) ** 0.5) / 2
        v, c = w2 + (t - 1) / t2 * (w2 - w), b2 + (t - 1) / t2 * (b2 - b)
        w, b, t = w2, b2, t2
    return w.astype(np.float32), np.float32(b)


def sigmoid(x):
    import numpy as np

    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Chain:
    """vocabulary, and for each category (name, weights of the features and of the probabilities before it, intercept, threshold)."""

    def __init__(self, vocabulary: dict[str, int], models: list[tuple]):
        self.vocabulary, self.models = vocabulary, models

    @classmethod
    def fit(cls, names: list[str], vocabulary: list[str], rows: list[list[int]], labels, folds, own: list[list[int]]) -> Chain:
        """labels: a row for each of rows, -1: none. own: of each fold the features that the other folds' rows choose, and
        last those of all rows, which the model keeps."""
        import numpy as np

        x = np.zeros((len(rows), len(vocabulary) + len(names)), np.float32)
        for i, r in enumerate(rows):
            x[i, r] = 1
        models, d = [], len(vocabulary)
        for k, name in enumerate(names):
            y, before = labels[:, k], list(range(d, d + k))
            known = y >= 0
            out = np.zeros(len(rows), np.float32)
            for f in range(FOLDS):
                train = known & (folds % FOLDS != f)
                seen, held = own[f] + before, folds % FOLDS == f
                w, b = fit_logistic(x[np.ix_(train, seen)], y[train].astype(np.float32))
                out[held] = sigmoid(x[np.ix_(held, seen)] @ w + b)
            w, b = fit_logistic(x[np.ix_(known, own[-1] + before)], y[known].astype(np.float32))
            x[:, d + k] = out
            best = max((_f1(out[known] >= t, y[known] == 1), -abs(t - 0.5), t) for t in np.linspace(0.1, 0.9, 33)) if known.any() else (0, 0, 0.5)
            models.append((name, w, b, float(best[2])))
        return cls({vocabulary[j]: i for i, j in enumerate(own[-1])}, models)

    def scores(self, lists: list[list[int]]):
        """Probabilities, a row for each list of features present."""
        import numpy as np

        out, d = np.zeros((len(lists), len(self.models))), len(self.vocabulary)
        for i, r in enumerate(lists):
            for k, (_, w, b, _) in enumerate(self.models):
                out[i, k] = sigmoid(float(w[r].sum()) + float(w[d : d + k] @ out[i, :k]) + float(b))
        return out


def _f1(said, true) -> float:
    hit = float((said & true).sum())
    return 2 * hit / max(1.0, float(said.sum()) + float(true.sum()))


def train(docs: DataFrame, labels: DataFrame, categories: dict[str, str], id_col: str = "doc_id", text_col: str = "text", train_rows: int = TRAIN_ROWS, n_features: int = N_FEATURES) -> Chain:
    """categories: in the chain's order, the name and the SQL condition on labels that makes it true."""
    import numpy as np

    common.shared_dir(docs.sparkSession)
    names = list(categories)
    y = F.array(*[F.coalesce(F.expr(c).cast("int"), F.lit(-1)) for c in categories.values()])
    marked = labels.select(labels[f"`{id_col}`"].alias("_id"), y.alias("y")).filter("_id is not null").orderBy(F.xxhash64("_id"), "_id").limit(train_rows)
    rows = common.pick(docs, id=id_col, text=text_col)
    rows = rows.join(F.broadcast(marked), rows.id == marked["_id"]).select(F.pmod(F.xxhash64("text"), F.lit(1 << 20)).alias("fold"), "y", "text").repartition(4 * docs.sparkSession.sparkContext.defaultParallelism)
    rows = common.cut(_featured(rows))
    vocabularies = _vocabularies(rows, len(names), n_features)
    vocabulary = sorted({f for v in vocabularies for f in v})
    index = {v: i for i, v in enumerate(vocabulary)}
    place = F.array(*[F.lit(v) for v in vocabulary]) if vocabulary else F.array().cast("array<string>")
    got = rows.select("fold", "y", F.array_intersect("features", place).alias("at")).collect()
    got.sort(key=lambda r: (r.fold, r.y, sorted(r["at"])))
    return Chain.fit(names, vocabulary, [[index[f] for f in r["at"]] for r in got], np.array([r.y for r in got]).reshape(len(got), len(names)), np.array([r.fold for r in got], np.int64), [[index[f] for f in v] for v in vocabularies])


def _vocabularies(rows: DataFrame, categories: int, n_features: int) -> list[list[str]]:
    """The n_features best features of the rows outside each fold, and last of all rows, best first."""
    has = lambda k: F.count(F.when(F.col("y")[k] >= 0, 1)).alias(f"n{k}")
    true = lambda k: F.count(F.when(F.col("y")[k] == 1, 1)).alias(f"k{k}")
    both, f = [x(k) for k in range(categories) for x in (has, true)], F.col("fold") % FOLDS
    names = [f"{x}{k}" for k in range(categories) for x in "nk"]
    totals = {r["f"]: r for r in rows.groupBy(f.alias("f")).agg(*both).collect()}  # a row for each fold
    counts = rows.select(f.alias("f"), "y", F.explode("features").alias("word")).groupBy("word", "f").agg(*both)
    counts = common.cut(counts.groupBy("word").agg(*[F.sum(F.when(F.col("f") != fold, F.col(c)).otherwise(0) if fold < FOLDS else F.col(c)).alias(f"{c}_{fold}") for fold in range(FOLDS + 1) for c in names]))
    out = []
    for fold in range(FOLDS + 1):
        at = lambda c, fold=fold: F.col(f"{c}_{fold}")
        total = lambda c, fold=fold: F.lit(float(sum(r[c] for g, r in totals.items() if g != fold)))
        seen = counts.filter(" or ".join(f"n{k}_{fold} >= 3" for k in range(categories)))
        g = F.greatest(F.lit(0.0), *[_g(at(f"n{k}"), at(f"k{k}"), F.greatest(total(f"n{k}"), F.lit(1.0)), total(f"k{k}")) for k in range(categories)])
        out.append([r.word for r in seen.orderBy(g.desc(), "word").limit(n_features).select("word").collect()])
    return out


def score(docs: DataFrame, chain: Chain, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, and for each category p_<name> and <name> (p at or over the category's threshold)."""
    rows = common.pick(docs, id=id_col, text=text_col)

    def run(batches):
        import pyarrow as pa

        known, get = {}, chain.vocabulary.get
        for piece in common.pieces(batches):
            lists = []
            for t in common.encoded(piece.column("text")):
                if len(known) > 400_000:
                    known.clear()
                here = set(t.split())
                for w in here.difference(known):
                    known[w] = tuple(i for f in word_features(w) if (i := get(f)) is not None)
                lists.append(sorted({i for w in here for i in known[w]}))
            p = chain.scores(lists)
            cols = {"doc_id": piece.column("id")}
            for k, (name, _, _, threshold) in enumerate(chain.models):
                cols |= {f"p_{name}": pa.array(p[:, k].round(6)), name: pa.array(p[:, k] >= threshold)}
            yield pa.RecordBatch.from_pydict(cols)

    return rows.mapInArrow(run, f"doc_id {rows.schema['id'].dataType.simpleString()}, " + ", ".join(f"p_{m[0]} double, {m[0]} boolean" for m in chain.models))


#: The labels table has two judgements; the chain takes them in this order.
CATEGORIES = {"low_quality": "quality = 0", "toxic": "toxic = 1"}


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op10: every document's probabilities under the chain, and whether it is toxic."""
    docs, labels = common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels")
    return score(docs, train(docs, labels, CATEGORIES))
