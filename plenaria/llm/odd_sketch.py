"""MinHash near-dedup: banded candidates, verified by odd sketches and confirmed on whole sets of shingles.

A document's set holds its distinct 5-word shingles (as 64-bit hashes), and documents link at a Jaccard similarity of 0.85 or
more. `SAMPLES` MinHash samples of a set make `SAMPLES / BAND` bands of `BAND` samples; sets that agree in a band are
candidates. A pair at the threshold misses all bands with a probability of 6e-11. An odd sketch folds the samples into a
bitmap of `BITS` parities: d differing samples toggle 2 d of them, so the population count of the XOR of two sketches tells how
many samples differ, most precisely at high similarities. Candidates that it puts more than `MARGIN` (over six standard deviations)
below the threshold go, and those that a second bitmap, of the parities of all shingles, proves to differ in more of them than
similar sets can. All others are confirmed on their whole sets. Classes are the components of what is linked.

Scale: equal sets are one node, so copies never make pairs. A node gives one row (two longs) for each band. What a bucket's
nodes have in common is aggregated before its shuffle and joined back. Of a bucket first each node is compared with its central one
(the one in the most crowded buckets: of near copies the text nearest to all). Only buckets whose nodes then lie in several components go
on: those of up to `PAIRWISE` nodes are joined with themselves under both sketches. The nodes of larger ones, copies nearly but not
quite similar enough, meet by the prefix filter of `near` instead, which is exact too: under the rarest shingles, so that the text which
all share makes no pairs. Texts move only for nodes to be confirmed.

Fewer words than a shingle: the whole sequence is the one shingle. Null and empty texts have no shingle and link with nothing. Repeated
rows and ids: one row each, judged by its own text. A null id is larger than all others. An empty table gives
no rows. Only the named columns are read.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, near
from .components import components
from .decontamination import WordHashes

SIMILAR = near.Similarity(17, 20)
SAMPLES, BAND = 128, 4
BITS = 512
MARGIN = 0.225
PAIRWISE = 32


def _toggled(differing: float) -> int:
    """How many bits of two sketches are expected to differ if so many samples do."""
    return math.floor(BITS / 2 * (1 - math.exp(-4 * differing / BITS)))


#: Bits by which the sketches of candidates differ at most.
MOST = _toggled(SAMPLES * (1 - SIMILAR.p / SIMILAR.q + MARGIN))


class Samples:
    """MinHash samples of many sets at once, their bands and odd sketches."""

    def __init__(self):
        import numpy as np

        r = np.random.default_rng(23)
        self.flip, self.times = r.integers(0, 1 << 63, SAMPLES, np.uint64), r.integers(0, 1 << 62, SAMPLES, np.uint64) * np.uint64(2) + np.uint64(1)
        self.fold = r.integers(0, 1 << 62, BAND, np.uint64) * np.uint64(2) + np.uint64(1)

    def of(self, sets: list):
        """A row of samples for each set (none is empty)."""
        import numpy as np

        h, starts = np.concatenate(sets), np.cumsum([0] + [len(s) for s in sets[:-1]])
        out, x = np.empty((len(sets), SAMPLES), np.uint64), np.empty_like(h)
        for k in range(SAMPLES):
            np.bitwise_xor(h, self.flip[k], out=x)
            np.multiply(x, self.times[k], out=x)
            out[:, k] = np.minimum.reduceat(x, starts)
        return out

    def bands(self, samples):
        import numpy as np

        x = (samples.reshape(len(samples), -1, BAND) * self.fold).sum(axis=2, dtype=np.uint64)
        x += np.arange(x.shape[1], dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        return (x ^ (x >> np.uint64(29))).view(np.int64)

    def sketches(self, samples):
        """Parities of the samples, each with its place, as longs."""
        import numpy as np

        x = (samples + np.arange(SAMPLES, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)) * np.uint64(0xC2B2AE3D27D4EB4F)
        x ^= x >> np.uint64(32)
        at = (x * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BITS.bit_length() + 1)
        at = at.astype(np.int64) + (np.arange(len(samples)) * BITS)[:, None]
        odd = np.bincount(at.ravel(), minlength=len(samples) * BITS).reshape(-1, BITS) & 1
        return np.packbits(odd.astype(np.uint8), axis=1, bitorder="little").view("<i8")


def signed(texts: DataFrame) -> DataFrame:
    """Of every row its columns but text, node (equal for equal sets), n (shingles), sketch, parities, bands (none for an empty set)."""

    def run(batches):
        import numpy as np
        import pyarrow as pa
        from xxhash import xxh64_intdigest

        hasher, maker = WordHashes(), Samples()
        for piece in common.pieces(batches, 2 << 20):
            sets = near._sets(common.encoded(piece.column("text")), hasher)
            full = [s for s in sets if len(s)]
            samples = maker.of(full) if full else np.zeros((0, SAMPLES), np.uint64)
            bands, sketches = (iter(x.tolist()) for x in (maker.bands(samples), maker.sketches(samples)))
            longs = pa.list_(pa.int64())
            arrays = [piece.column(c) for c in piece.schema.names if c != "text"]
            keys = np.array([xxh64_intdigest(s.tobytes()) for s in sets], np.uint64).view(np.int64)
            arrays += [pa.array(keys), pa.array([len(s) for s in sets], pa.int32())]
            arrays += [pa.array([next(sketches) if len(s) else [] for s in sets], longs), pa.array([near._parities(s) for s in sets], longs), pa.array([next(bands) if len(s) else [] for s in sets], longs)]
            yield pa.RecordBatch.from_arrays(arrays, names=[c for c in piece.schema.names if c != "text"] + ["node", "n", "sketch", "parities", "bands"])

    names = "".join(f"{c} {t}, " for c, t in texts.dtypes if c != "text")
    return texts.mapInArrow(run, names + "node long, n int, sketch array<long>, parities array<long>, bands array<long>")


def _promising(a: str, b: str):
    """Whether what both sketches tell of the nodes a and b leaves the similarity possible."""
    of = lambda side, c: F.col(f"{side}.{c}")
    n = (of(a, "n"), of(b, "n"))
    differ = near.odd(of(a, "parities"), of(b, "parities"), near.PARITIES // 64)
    return SIMILAR.alike(*n) & (near.odd(of(a, "sketch"), of(b, "sketch"), BITS // 64) <= MOST) & SIMILAR.differ(differ, *n)


def _confirmed(texts: DataFrame, nodes: DataFrame, pairs: DataFrame) -> DataFrame:
    """src, dst: the pairs (a, b) of nodes that are similar; pairs: promising ones, repeated or not."""
    pairs = common.cut(pairs.distinct())
    ends = common.cut(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct())
    return near.confirmed(texts, nodes.join(common.small(ends), "node", "left_semi").select("node", "key"), pairs, SIMILAR)


def _sketched(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The promising ones of pairs (a, b)."""
    told = nodes.select("node", "n", "sketch", "parities")
    pairs = pairs.distinct().alias("p").join(told.alias("x"), F.col("p.a") == F.col("x.node")).join(told.alias("y"), F.col("p.b") == F.col("y.node"))
    return pairs.filter(_promising("x", "y")).select("p.a", "p.b")


def _small_buckets(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """Promising pairs (a, b) of nodes of different components in one bucket, of rows band, node, part."""
    rows = common.cut(rows.join(nodes.select("node", "n", "sketch", "parities"), "node"))
    a, b = rows.alias("a"), rows.alias("b")
    met = a.join(b, (F.col("a.band") == F.col("b.band")) & (F.col("a.node") < F.col("b.node")) & (F.col("a.part") != F.col("b.part")) & _promising("a", "b"))
    return met.select(F.col("a.node").alias("a"), F.col("b.node").alias("b"))


def _large_buckets(texts: DataFrame, nodes: DataFrame, parts: DataFrame) -> DataFrame:
    """Pairs (a, b) of nodes of different components that the prefix filter leaves, of parts: node, part."""
    own = common.cut(nodes.join(parts, "node").select("node", "part", "key", "parities"))
    wanted = common.cut(own.select(F.col("key").alias("_key")).distinct())
    chosen = common.stored(texts.join(common.small(wanted), texts.key == wanted["_key"], "left_semi").dropDuplicates(["key"]).select("text"))
    told = near._rows(chosen, near._frequent(chosen), SIMILAR).select("node", "n", F.explode("shingles").alias("shingle"))
    named = common.cut(told.join(own.select("node", "part"), "node"))
    open_ = named.groupBy("shingle").agg(F.min("part").alias("least"), F.max("part").alias("most")).filter("least != most").select("shingle")
    return near._rest(named.join(open_, "shingle").select("shingle", "node", "n", "part"), own.select("node", "parities"), SIMILAR)


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", pairwise: int = PAIRWISE) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest id of the class, the own one included)."""
    common.shared_dir(docs.sparkSession)
    texts = common.pick(docs, id=id_col, text=text_col).withColumn("key", F.xxhash64("text"))
    all_ = common.cut(signed(texts))
    nodes = common.cut(all_.filter("n > 0").dropDuplicates(["node"]).select("node", "key", "n", "sketch", "parities", "bands"))
    rows = nodes.select("node", "n", F.explode("bands").alias("band"))
    full = common.cut(rows.groupBy("band").agg(F.count("*").alias("k")).filter("k > 1"))
    rows = common.cut(rows.join(common.small(full), "band"))
    rows = common.cut(rows.join(rows.groupBy("node").agg(F.sum("k").alias("c")), "node"))
    central = rows.groupBy("band").agg(F.max(F.struct("c", "node", "n")).alias("core"))
    asked = rows.join(central, "band").filter((F.col("node") != F.col("core.node")) & SIMILAR.alike(F.col("n"), F.col("core.n")))
    links = _confirmed(texts, nodes, _sketched(near._pairs(asked, "node", "core.node"), nodes))

    labels = components(links).withColumnRenamed("label", "part")
    rows = common.cut(rows.join(labels, "node", "left").select("band", "node", F.coalesce("part", "node").alias("part")))
    open_ = rows.groupBy("band").agg(F.min("part").alias("least"), F.max("part").alias("most"), F.count("*").alias("k")).filter("least != most").select("band", "k")
    rows = common.cut(rows.join(open_, "band"))
    found = _small_buckets(rows.filter(F.col("k") <= pairwise).drop("k"), nodes)
    crowded = common.cut(rows.filter(F.col("k") > pairwise).select("node", "part").distinct())
    if not crowded.isEmpty():
        found = found.union(_sketched(_large_buckets(texts, nodes, crowded), nodes))
    links = links.union(_confirmed(texts, nodes, found))

    parts = all_.select("id", "n", "node").join(components(links), "node", "left").withColumn("label", F.coalesce("label", "node"))
    least = parts.filter("n > 0").groupBy("label").agg(F.min("id").alias("least"))
    parts = parts.join(least, "label", "left")
    return parts.select(F.col("id").alias("doc_id"), F.col("n").cast("long").alias("n_shingles"), F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("id")).alias("component_id"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op12: every document's set size and class, and whether it leads its class."""
    out = classes(common.table(spark, sf_dir, "documents"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


#: DuckDB: all pairs of documents that share a shingle, and what can be reached over those that are similar.
SQL = r"""
    with recursive w as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
    s as (select doc_id, unnest(case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')] else list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) end) as x from w),
    n as (select doc_id, count(*) as n from s group by all),
    shared as (select a.doc_id as a, b.doc_id as b, count(*) as c from s a join s b on a.x = b.x and a.doc_id < b.doc_id group by all),
    linked as (select a, b from shared join n x on x.doc_id = a join n y on y.doc_id = b where 100 * c >= 85 * (x.n + y.n - c)),
    ways as (select a, b from linked union all select b, a from linked),
    reached as (select a, b from ways union select r.a, l.b from reached r join ways l on l.a = r.b),
    firsts as (select a, least(a, min(b)) as component_id from reached group by a)
    select w.doc_id, coalesce(n, 0) as n_shingles, coalesce(component_id, w.doc_id) as component_id, coalesce(component_id, w.doc_id) = w.doc_id as kept
    from w left join n on n.doc_id = w.doc_id left join firsts on a = w.doc_id"""
