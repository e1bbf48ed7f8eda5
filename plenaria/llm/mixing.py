"""Mixing sources to target weights by cube-method balanced sampling (Deville & Tille; Chauvet & Tille's fast flight).

Every source s has a target T_s, and each of its documents the rate r = T_s / S_s (S_s: its words): floor(r)
whole copies, and one more with inclusion probability r - floor(r). The flight moves three fractional
probabilities at a time along the null space of the constraints (sum of probabilities; sum of probability
times size), so document and token totals stay as they were, until a probability is 0 or 1; what is left
(two a group at most) goes on to the next level, and at the last level is the landing problem: at most two
documents of a source, which are cut to their fraction, so that the token total stays exact to a word each.

Scale: a source is dealt into groups of about `group` documents by a hash of the row, so a hot source is many
groups; each leaves two rows, so the next level is `group`/2 times smaller. Only (id, source, size, hash of the text)
move; texts never do. Rows alike in all of these are counted before they move and numbered after, so they are dealt
like others. Targets come from one row per source, ranked and summed by range partitions, so sources may be as many
as hosts. Draws are seeded by source, group and level and units are ordered by id, size, text hash and number, so
reruns agree.

Null text: size 0. Null source: a source of its own, last in order. Size 0: taken 0. Null and repeated ids, and
repeated rows, are documents of their own. An empty table gives no rows. Only the named columns are read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import common

WEIGHTS = (1, 2, 3)
CAP = 3.0


def ranked(df: DataFrame, order: list[Column], sums: list[str]) -> DataFrame:
    """df with place (from 0, in the order) and for each name in sums before_<name>, the sum over the rows before. Rows
    are sorted by range over many tasks; only one row a task meets in one place."""
    rows = common.cut(df.orderBy(*order))
    rows = rows.withColumn("part", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id())
    parts = rows.groupBy("part").agg(F.count("*").alias("n_"), *[F.sum(x).alias(f"s_{x}") for x in sums])
    ahead = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    parts = parts.select("part", *[F.coalesce(F.sum(x).over(ahead), F.lit(0)).alias(x) for x in parts.columns[1:]])
    inside = W.partitionBy("part").orderBy("at").rowsBetween(W.unboundedPreceding, -1)
    out = rows.select(*rows.columns, F.count("*").over(inside).alias("i_"), *[F.coalesce(F.sum(x).over(inside), F.lit(0)).alias(f"before_{x}") for x in sums]).join(F.broadcast(parts), "part")
    return out.select(*df.columns, (F.col("i_") + F.col("n_")).alias("place"), *[(F.col(f"before_{x}") + F.col(f"s_{x}")).alias(f"before_{x}") for x in sums])


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, cap: float = CAP) -> DataFrame:
    """source, source_size, n, target, of rows source, size, m (how many such documents). Water filling: in order of cap
    over weight, the first source whose cap is not below its share of what the capped ones before it leave fixes the
    level for all after it."""
    by = sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("m")).alias("source_size"), F.sum("m").alias("n"))
    by = ranked(by, [F.col("source").asc_nulls_last()], [])
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    by = common.cut(by.select("source", "source_size", "n", w.alias("w"), (cap * F.col("source_size")).alias("most")))
    everything, weight = by.agg(F.sum("source_size"), F.sum("w")).first()
    fill = ranked(by, [F.col("most") / F.col("w"), F.col("source").asc_nulls_last()], ["most", "w"])
    fill = fill.withColumn("level", (F.lit(float(everything or 0)) - F.col("before_most")) / (F.lit(float(weight or 1)) - F.col("before_w")))
    level = fill.filter(F.col("most") >= F.col("level") * F.col("w")).agg(F.min_by("level", "place")).first()[0]
    share = F.col("most") if level is None else F.lit(level) * F.col("w")
    return by.select("source", "source_size", "n", F.least(F.col("most"), share).alias("target"))


def flight(p: list[float], x: list[float], seed: str, eps: float = 1e-9) -> list[float]:
    """Moves probabilities p of units with sizes x until two fractional ones at most are left."""
    import random

    draw = random.Random(seed).random
    p = list(p)
    live = [i for i in range(len(p)) if eps < p[i] < 1 - eps]
    now, rest = live[:3], iter(live[3:])
    while len(now) == 3:
        a, b, c = now
        u = (x[c] - x[b], x[a] - x[c], x[b] - x[a])
        if not any(u):
            u = (1.0, -1.0, 0.0)
        up = down = float("inf")
        for i, d in zip(now, u, strict=True):
            if d:
                high, low = ((1 - p[i]) / d, p[i] / d) if d > 0 else (-p[i] / d, (p[i] - 1) / d)
                up, down = min(up, high), min(down, low)
        step = up if draw() * (up + down) < down else -down
        for i, d in zip(now, u, strict=True):
            p[i] += step * d
        now = [i for i in now if eps < p[i] < 1 - eps]
        while len(now) < 3 and (i := next(rest, None)) is not None:
            now.append(i)
    for i in live:
        if p[i] <= eps or p[i] >= 1 - eps:
            p[i] = float(round(p[i]))
    return p


def _fly(seed: str):
    def fly(key, units):
        import pyarrow as pa

        units = units.drop_columns("_deal").sort_by([(c, "ascending") for c in ("doc_id", "size", "mark", "nth")])
        p = flight(units["p"].to_pylist(), [float(x) for x in units["size"].to_pylist()], f"{seed}:{key[0].as_py()}:{key[1].as_py()}")
        return units.set_column(units.column_names.index("p"), "p", pa.array(p, pa.float64()))

    return fly


def mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", weights: tuple = WEIGHTS, group: int = 2_000, seed: int = 7) -> DataFrame:
    """doc_id, source, size, source_size, target, taken."""
    rows = common.pick(docs, doc_id=id_col, source=source_col, text=text_col)
    sizes = rows.select("doc_id", "source", F.size(common.words(F.col("text"))).cast("long").alias("size"), F.xxhash64("text").alias("mark"))
    sizes = common.cut(sizes.groupBy("doc_id", "source", "size", "mark").agg(F.count("*").alias("m")))
    to = common.cut(targets(sizes, weights))
    most = to.agg(F.max("n")).first()[0] or 0
    to = to.withColumnRenamed("source", "_s")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    sizes = sizes.withColumn("nth", F.explode(F.sequence(F.lit(1).cast("long"), "m")))
    level = sizes.join(to, sizes.source.eqNullSafe(to["_s"])).withColumn("whole", F.floor(rate)).withColumn("p", F.when(F.col("size") > 0, rate - F.floor(rate)).otherwise(0.0)).drop("_s")
    schema, done, k = f"doc_id {dict(docs.dtypes)[id_col]}, source string, size long, mark long, nth long, source_size long, n long, target double, whole long, p double", [], 0
    level = level.select("doc_id", F.col("source").cast("string"), "size", "mark", "nth", "source_size", "n", "target", "whole", "p")
    while True:
        left = F.greatest(F.lit(1), F.ceil(F.col("n") / F.lit(float(group // 2) ** k)))
        deal = F.pmod(F.xxhash64("doc_id", "size", "mark", "nth", F.lit(k)), F.greatest(F.lit(1), F.ceil(left / group))).cast("long")
        flown = common.cut(level.withColumn("_deal", deal).groupBy("source", "_deal").applyInArrow(_fly(f"{seed}:{k}"), schema))
        if most <= group:
            done.append(flown)
            break
        fractional = (F.col("p") > 0) & (F.col("p") < 1)
        done.append(flown.filter(~fractional))
        level, k, most = flown.filter(fractional), k + 1, -(-most // (group // 2))
    taken = F.col("whole") * F.col("size") + F.round(F.col("p") * F.col("size")).cast("long")
    return reduce(DataFrame.unionByName, done).select("doc_id", "source", "size", "source_size", "target", taken.alias("taken"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op2: how many words of every document the mix takes."""
    return mix(common.table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")
