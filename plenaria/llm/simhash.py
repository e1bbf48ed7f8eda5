"""SimHash near-dedup with pigeonring filtering.

Fingerprints of 64 bits (a bit is 1 if set in over half the hashes of the shingles) link at `radius` or
fewer differing bits. The 64 bits form a ring of m = radius + 1 segments. By the pigeonring principle two
fingerprints within the radius have a segment from which, for every length l of the chain, the first l
segments differ in at most l * radius / m bits together. For l = 1 the budget is below one bit: the
segment is equal, which is the join key; the budgets of longer chains are checked next and prune the
candidates before the full Hamming distance is.

Scale: equal fingerprints are one node (its smallest id), so copies never make pairs. Only fingerprints
that share a segment with another one meet. A bucket of up to `pairwise` fingerprints is joined with
itself. The fingerprints of a larger one are never joined with each other: they link by the words one bit
from them, of which two linked ones share one (`ball`). Both ways are exact. Components come from
alternating large-star and small-star steps, cut by checkpoints.

Null and empty texts have fingerprint zero and are linked like any other. Fewer words than a shingle: the
whole sequence is the shingle. Repeated rows and ids: one row each, one component. An empty table gives no
rows. Only the named columns are read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .components import components

BITS = 64


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """doc_id, fp (the 64 bits as a long)."""
    common.shared_dir(docs.sparkSession)
    rows = common.pick(docs, id=id_col, text=text_col)

    def run(batches):
        import numpy as np
        import pyarrow as pa
        from xxhash import xxh64_intdigest

        def bits(text: bytes) -> int:
            split = text.lower().split()  # bytes: A-Z only, ASCII white space only
            if not split:
                return 0
            line = b" ".join(split)
            ends = np.fromiter(map(len, split), np.int64, len(split)).cumsum() + np.arange(len(split))
            starts = np.concatenate(([0], ends[:-1] + 1))
            if len(split) < shingle:
                pairs = [(0, len(line))]
            else:
                pairs = zip(starts[: len(split) - shingle + 1].tolist(), ends[shingle - 1 :].tolist(), strict=True)
            h = np.fromiter((xxh64_intdigest(line[a:b], 42) for a, b in pairs), np.uint64)
            ones = np.zeros(BITS, np.int64)
            for i in range(0, len(h), 65536):
                ones += np.unpackbits(h[i : i + 65536].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
            return int(np.packbits(ones * 2 > len(h), bitorder="little").view("<i8")[0])

        for piece in common.pieces(batches):
            yield pa.RecordBatch.from_pydict({"doc_id": piece.column("id"), "fp": pa.array([bits(t) for t in common.encoded(piece.column("text"))], pa.int64())})

    return rows.mapInArrow(run, f"doc_id {rows.schema['id'].dataType.simpleString()}, fp long")


def _ring(radius: int) -> list[tuple[int, int]]:
    """(offset, width) of the segments."""
    m = radius + 1
    cuts = [BITS * k // m for k in range(m + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:], strict=False)]


def _segment(x: Column, at: tuple[int, int]) -> Column:
    return F.shiftrightunsigned(x, at[0]).bitwiseAND(F.lit((1 << at[1]) - 1))


def chain_holds(diff: Column, start: int, radius: int) -> Column:
    """Whether, from segment start on, every chain's cumulative differences stay within its share of the budget."""
    ring, out, total = _ring(radius), F.lit(True), F.lit(0)
    for length in range(1, len(ring) + 1):
        total = total + F.bit_count(_segment(diff, ring[(start + length - 1) % len(ring)]))
        out = out & (total <= F.lit(length * radius // len(ring)))
    return out


def links(nodes: DataFrame, radius: int = 2, pairwise: int = 64) -> DataFrame:
    """src, dst: linked fingerprints of nodes (column fp, distinct), enough to connect all that is linked."""
    ring = _ring(radius)
    keys = F.array(*[F.struct(F.lit(s).alias("seg"), _segment(F.col("fp"), r).alias("key")) for s, r in enumerate(ring)])
    rows = nodes.select("fp", F.explode(keys).alias("x")).select("fp", "x.seg", "x.key")
    counts = rows.groupBy("seg", "key").agg(F.count("*").alias("n")).filter("n > 1")
    rows = common.cut(rows.join(counts, ["seg", "key"]))
    small = rows.filter(F.col("n") <= pairwise)
    a, b = small.alias("a"), small.alias("b")
    diff = F.col("a.fp").bitwiseXOR(F.col("b.fp"))
    chain = reduce(lambda x, y: x | y, [(F.col("a.seg") == s) & chain_holds(diff, s, radius) for s in range(len(ring))])
    same = (F.col("a.seg") == F.col("b.seg")) & (F.col("a.key") == F.col("b.key")) & (F.col("a.fp") < F.col("b.fp"))
    near = a.join(b, same & chain & (F.bit_count(diff) <= radius)).select(F.col("a.fp").alias("src"), F.col("b.fp").alias("dst"))
    return near.unionByName(ball(rows.filter(F.col("n") > pairwise).select("fp").distinct(), radius))


def ball(nodes: DataFrame, radius: int = 2) -> DataFrame:
    """Links of nodes without pairs: each fingerprint names the words at most one bit from it. Two linked ones
    share such a word, and all that name one word (65 at most) are linked with each other."""
    if radius not in (1, 2):
        raise ValueError("large buckets are handled for radius 1 and 2")
    around = F.concat(F.array(F.col("fp")), *([F.array(*[F.col("fp").bitwiseXOR(F.lit(x - (1 << BITS) if x >> (BITS - 1) else x)) for x in (1 << i for i in range(BITS))])] if radius == 2 else [F.array(*[F.col("fp").bitwiseAND(F.lit(~x if x < 1 << (BITS - 1) else (1 << (BITS - 1)) - 1)) for x in (1 << i for i in range(BITS))])]))
    named = nodes.select(F.col("fp").alias("dst"), F.explode(F.array_distinct(around)).alias("word"))
    first = named.groupBy("word").agg(F.min("dst").alias("src"), F.count("*").alias("n")).filter("n > 1").drop("n")
    return named.join(first, "word").filter(F.col("src") != F.col("dst")).select("src", "dst").distinct()


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, radius: int = 2, pairwise: int = 64) -> DataFrame:
    """doc_id, fp, component_id (the smallest id reachable over links, the own one included)."""
    fps = common.cut(fingerprints(docs, id_col, text_col, shingle))
    nodes = common.cut(fps.groupBy("fp").agg(F.min("doc_id").alias("least")))
    labels = components(links(nodes.select("fp"), radius, pairwise))
    named = nodes.join(labels.withColumnRenamed("node", "fp"), "fp", "left").withColumn("label", F.coalesce("label", "fp"))
    least = named.groupBy("label").agg(F.min("least").alias("component_id"))
    return fps.join(named.join(least, "label").select("fp", "component_id"), "fp")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op3: every document's fingerprint and component."""
    out = classes(common.table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
