"""SimHash near-dedup of whole texts at a Jaccard similarity of 0.8 or more of 5-word shingles, exact.

First SimHash fingerprints of the shingles are linked by pigeonring filtering (`simhash.links`); what it links is
verified on the whole sets of shingles. At 0.8 about ten of 64 bits differ, far beyond what segments of a
fingerprint can find, so fingerprints alone lose links. A prefix filter finds the rest: two sets at that similarity
share a shingle among the first n - ceil(0.8 n) + 1 of each, in any order that holds for all sets, so documents that share
none are never compared and no pair is lost. The order is that of the shingles' hashes, with those frequent in
a sample last; the sample decides the cost only. Every candidate that the lengths and the first shingles of both allow
is verified on its whole sets, and classes are the components of what is linked.

Scale: equal sets are one node, so copies never make pairs. Each document gives a row for a fifth of its shingles, which
moves once. Of all nodes under one shingle, first each is compared with the least, then with the one that shares most of its
first shingles with others (of near copies the one nearest to all), and then only those with each other whose components
still differ. Those must share `needed` of their first shingles, which depends on both lengths, so by the prefix
filter once more they meet under the first of the shingles that each shares at all, fewer the more they need (`_rest`): a large
group of near copies, or of documents with a common passage, makes few pairs. A sketch of the parities of `PARITIES` classes
of a set's shingles says of how many at least two sets differ, which leaves out most pairs of up to some 500 shingles that
are not similar enough. Unlinked copies that are nearly similar enough are
still compared with each other: what is compared there is not cut. What the nodes under a shingle have in common is
aggregated before its shuffle and joined back, so a frequent shingle is a key that adaptive execution can split. Whole sets are built only for pairs that the first shingles
allow: with c of them shared, up to the end of the list that ends first, no more than c and what is left of the
shorter rest can be shared in all.

Words are as in op3. Null and empty texts are one class. Fewer words than a shingle: the whole sequence is the
shingle. Repeated rows and ids: one row each; a null id counts as larger than all others. An empty table gives no
rows. Only the named columns are read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import common, simhash
from .components import components
from .decontamination import WordHashes

SHINGLE = 5
SAMPLE, FREQUENT = 20_000, 200_000
#: Bits by which linked fingerprints differ at most.
RADIUS = 2


@dataclass(frozen=True)
class Similarity:
    """Jaccard similarity p / q at least: sets of a and b with c in common have it if (p + q) c >= p (a + b)."""

    p: int = 4
    q: int = 5

    def enough(self, c, a, b):
        return (self.p + self.q) * c >= self.p * (a + b)

    def differ(self, d, a, b):
        """Whether similar sets of a and b can have d members in one only."""
        return (self.p + self.q) * d <= (self.q - self.p) * (a + b)

    def alike(self, a, b):
        """Whether sets of a and b can be similar."""
        return (self.q * a >= self.p * b) & (self.q * b >= self.p * a)

    def first(self, n: int) -> int:
        """How many first members (in one order of all) similar sets share one of, if one set has n."""
        return n - (self.p * n + self.q - 1) // self.q + 1 if n else 0

    def later(self, n):
        """How many members of a set of n are behind its first ones."""
        return F.floor((self.p * n + self.q - 1) / self.q) - 1

    def possible(self, c, a, b):
        """Whether sets of a and b that share c of their first members can share enough in all."""
        return self.enough(c + F.greatest(self.later(a), self.later(b)), a, b)

    def needed(self, short, long):
        """How many of their first members sets of these sizes must share at least, to share enough in all."""
        return F.greatest(F.lit(1), F.ceil(self.p * (short + long) / (self.p + self.q)) - self.later(long))

    @property
    def steps(self) -> int:
        """How many size classes similar sets are apart at most."""
        return math.ceil(math.log(self.q / self.p) / math.log(GROWTH))


#: Sizes of one class differ by less than this factor.
GROWTH = 1.05
AT_0_8 = Similarity(4, 5)


def _sets(texts: list[bytes], hasher: WordHashes) -> list:
    """Sorted distinct hashes of the shingles of every text."""
    import numpy as np

    starts, h = hasher.of(np.frombuffer(b"\n".join(t.lower() for t in texts), np.uint8))
    first = np.searchsorted(starts, np.cumsum([0] + [len(t) + 1 for t in texts]))
    mixed = [h * np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        width = min(SHINGLE, b - a)
        if not width:
            out.append(h[:0])
            continue
        s = np.full(b - a - width + 1, width, np.uint64)
        for k in range(width):
            s += mixed[k][a + k : b - width + 1 + k]
        s = (s ^ (s >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        out.append(np.unique(s ^ (s >> np.uint64(29))))
    return out


PARITIES = 256


def _parities(s) -> list[int]:
    """For each of PARITIES classes whether the set has an odd number of it, as longs. Sets differ by as many members at least as these by bits."""
    import numpy as np

    odd = np.bincount((s >> np.uint64(20)).astype(np.int64) % PARITIES, minlength=PARITIES) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8").tolist()


def _fingerprint(s) -> int:
    """The SimHash of a set of hashes: a bit is 1 if set in over half of them."""
    import numpy as np

    ones = np.zeros(simhash.BITS, np.int64)
    for i in range(0, len(s), 65536):
        ones += np.unpackbits(s[i : i + 65536].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(s), bitorder="little").view("<i8")[0])


def _rows(docs: DataFrame, frequent: list[int] | None, similar: Similarity = AT_0_8):
    """Of every row its key, node, number of shingles and fingerprint, and the first shingles in the order of all (frequent
    is None: whole sets, no fingerprint or parities)."""

    def run(batches):
        import numpy as np
        import pyarrow as pa
        from xxhash import xxh64_intdigest

        hasher, last = WordHashes(), np.sort(np.array(frequent or [], np.int64).view(np.uint64))
        for piece in common.pieces(batches, 2 << 20):
            sets = _sets(common.encoded(piece.column("text")), hasher)
            nodes = np.array([xxh64_intdigest(s.tobytes()) for s in sets], np.uint64).view(np.int64)
            told = sets
            if frequent is not None:
                told = []
                for s in sets:  # as 63-bit numbers in the order of all: those that are not frequent below 0
                    late = last[np.minimum(np.searchsorted(last, s), len(last) - 1)] == s if len(last) else np.zeros(len(s), bool)
                    o = s >> np.uint64(1)
                    told.append(np.concatenate((o[~late] | np.uint64(1 << 63), o[late]))[: similar.first(len(s))])
            offsets = np.cumsum([0] + [len(s) for s in told]).astype(np.int32)
            values = np.concatenate(told).view(np.int64) if told else np.zeros(0, np.int64)
            arrays = [piece.column(c) for c in piece.schema.names if c != "text"]
            arrays += [pa.array(nodes), pa.array([len(s) for s in sets], pa.int32()), pa.array([0 if frequent is None else _fingerprint(s) for s in sets], pa.int64()), pa.array([None if frequent is None else _parities(s) for s in sets], pa.list_(pa.int64())), pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))]
            yield pa.RecordBatch.from_arrays(arrays, names=[c for c in piece.schema.names if c != "text"] + ["node", "n", "fp", "parities", "shingles"])

    names = "".join(f"{c} {t}, " for c, t in docs.dtypes if c != "text")
    return docs.mapInArrow(run, names + "node long, n int, fp long, parities array<long>, shingles array<long>")


def _frequent(docs: DataFrame) -> list[int]:
    """Shingles that several documents of a sample have."""
    few = _rows(docs.select("text").sample(min(1.0, SAMPLE / max(1, docs.count())), 7), None)
    counted = few.select(F.explode("shingles").alias("s")).groupBy("s").agg(F.count("*").alias("n")).filter("n > 2")
    return [r.s for r in counted.orderBy(F.desc("n"), "s").limit(FREQUENT).collect()]


def _at_most(p: str, n: str, q: str, m: str):
    """The most shingles that sets of n and m can share whose first ones are p and q, where p ends first."""
    seen = F.size(F.filter(q, lambda x: x <= F.element_at(p, -1)))
    return F.size(F.array_intersect(p, q)) + F.least(F.col(n) - F.size(p), F.col(m) - seen)


def _beside(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """pairs with n and shingles of both nodes."""
    for side in ("a", "b"):
        pairs = pairs.join(sets.select(F.col("node").alias(side), F.col("n").alias(f"n_{side}"), F.col("shingles").alias(f"s_{side}")), side)
    return pairs


def confirmed(texts: DataFrame, keys: DataFrame, pairs: DataFrame, similar: Similarity) -> DataFrame:
    """src, dst: the pairs (a, b: nodes) whose whole sets are similar; keys: node, key (of a text of it), of all their nodes."""
    wanted = common.gathered(keys.groupBy("node").agg(F.min("key").alias("_key")).select("_key"))
    chosen = texts.join(common.small(wanted), texts.key == wanted["_key"], "left_semi").dropDuplicates(["key"])
    sets = common.cut(_rows(chosen.select("text"), None))
    shared = F.size(F.array_intersect("s_a", "s_b"))
    return common.gathered(_beside(pairs, sets).filter(similar.enough(shared, F.col("n_a"), F.col("n_b"))).select(F.col("a").alias("src"), F.col("b").alias("dst")))


def _verified(texts: DataFrame, signed: DataFrame, pairs: DataFrame, similar: Similarity) -> DataFrame:
    """The pairs (a, b: nodes) at the similarity: what the first shingles allow, verified on whole sets."""
    enough = lambda c: similar.enough(c, F.col("n_a"), F.col("n_b"))
    both = lambda pairs: common.small(common.gathered(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()))
    pairs = common.gathered(pairs.distinct())
    near = _beside(pairs, signed.join(both(pairs), "node", "left_semi").dropDuplicates(["node"]))
    first = F.element_at("s_a", -1) <= F.element_at("s_b", -1)
    pairs = common.gathered(near.filter(enough(F.when(first, _at_most("s_a", "n_a", "s_b", "n_b")).otherwise(_at_most("s_b", "n_b", "s_a", "n_a")))).select("a", "b"))
    return confirmed(texts, signed.join(both(pairs), "node", "left_semi"), pairs, similar)


def odd(a, b, longs: int):
    """How many bits of two bitmaps differ."""
    return sum((F.bit_count(a[k].bitwiseXOR(b[k])) for k in range(longs)), F.lit(0))


def _rest(named: DataFrame, sketches: DataFrame, similar: Similarity) -> DataFrame:
    """Pairs (a, b) of nodes of different components that may be linked, of rows shingle, node, n, part: all of a node's
    first shingles that it can share with one of another component. For each class of the other's size a node needs
    to share `needed` of its c shingles at least, and meets it under the first c - needed + 1, by hash. sketches: node, parities."""
    own = W.partitionBy("node")
    named = named.withColumn("c", F.count("*").over(own)).withColumn("i", F.row_number().over(own.orderBy("shingle"))).withColumn("size", F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(GROWTH))).cast("int"))
    rows = common.cut(named.join(sketches, "node")).withColumn("step", F.explode(F.sequence(F.lit(0), F.lit(similar.steps))))
    n, at = F.col("n").cast("long"), lambda e: F.pow(F.lit(GROWTH), e)
    longest = F.least(F.ceil(at(F.col("size") + F.col("step") + 1)) + 1, F.floor(similar.q * n / similar.p))  # of the class, a bit more by rounding
    shortest = F.greatest(F.floor(at(F.col("size") - F.col("step"))) - 1, F.ceil(similar.p * n / similar.q))
    meets = lambda needed: F.col("i") <= F.col("c") - needed + 1
    a = rows.filter(meets(similar.needed(n, F.greatest(n, longest)))).withColumn("other", F.col("size") + F.col("step")).alias("a")
    b = rows.filter(meets(similar.needed(F.least(n, shortest), n))).withColumn("other", F.col("size") - F.col("step")).alias("b")
    both = (F.col("a.shingle") == F.col("b.shingle")) & (F.col("a.size") == F.col("b.other")) & (F.col("a.other") == F.col("b.size"))
    once = (F.col("a.n") < F.col("b.n")) | ((F.col("a.n") == F.col("b.n")) & (F.col("a.node") < F.col("b.node")))
    met = a.join(b, both & once & (F.col("a.part") != F.col("b.part")) & similar.alike(F.col("a.n"), F.col("b.n")) & similar.differ(odd(F.col("a.parities"), F.col("b.parities"), PARITIES // 64), F.col("a.n"), F.col("b.n")))
    return _pairs(met.select(F.col("a.node").alias("x"), F.col("b.node").alias("y")), "x", "y")


def _pairs(rows: DataFrame, x: str, y: str) -> DataFrame:
    return rows.select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b"))


def _by_fingerprint(nodes: DataFrame, similar: Similarity) -> DataFrame:
    """Pairs of nodes whose fingerprints are equal (each with the first) or linked (the first ones of both)."""
    first = common.cut(nodes.groupBy("fp").agg(F.min(F.struct("node", "n")).alias("low")))
    same = nodes.join(first, "fp").filter((F.col("node") != F.col("low.node")) & similar.alike(F.col("n"), F.col("low.n")))
    linked = simhash.links(first.select("fp"), RADIUS)
    a, b = (first.select(F.col("fp").alias(side), F.col("low").alias(f"{side}_low")) for side in ("src", "dst"))
    linked = linked.join(a, "src").join(b, "dst").filter(similar.alike(F.col("src_low.n"), F.col("dst_low.n")))
    return _pairs(same, "node", "low.node").union(_pairs(linked, "src_low.node", "dst_low.node"))


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similar: Similarity = AT_0_8) -> DataFrame:
    """doc_id, component_id (the smallest id of the class), key (xxhash64 of the text), leads (whether the row has the
    smallest id of its class and, of the texts with that id, the smallest key)."""
    common.shared_dir(docs.sparkSession)
    texts = common.pick(docs, id=id_col, text=text_col).withColumn("key", F.xxhash64("text"))
    signed = common.cut(_rows(texts, _frequent(texts), similar))
    nodes = signed.dropDuplicates(["node"])
    rows = nodes.select("node", "n", F.explode("shingles").alias("shingle"))
    shared = common.cut(rows.groupBy("shingle").agg(F.count("*").alias("k")).filter("k > 1"))
    rows = common.cut(rows.join(common.small(shared), "shingle"))
    low = rows.groupBy("shingle").agg(F.min(F.struct("node", "n")).alias("low"))
    least = _pairs(rows.join(low, "shingle").filter((F.col("node") != F.col("low.node")) & similar.alike(F.col("n"), F.col("low.n"))), "node", "low.node")
    links = _verified(texts, signed, _by_fingerprint(nodes.select("node", "n", "fp"), similar).union(least), similar)
    # pairs alone under a shingle have been compared, so what other pairs share is under shingles of three nodes or more
    rows = rows.filter("k > 2").select("shingle", "node", "n")
    rows = common.cut(rows.join(rows.groupBy("node").agg(F.count("*").alias("c")), "node"))

    def labelled():
        """Rows of the shingles whose nodes are not all in one component, with the component and the node that shares most."""
        labels = components(links).withColumnRenamed("label", "part")
        named = common.cut(rows.join(labels, "node", "left").withColumn("part", F.coalesce("part", "node")))
        of = named.groupBy("shingle").agg(F.min("part").alias("least"), F.max("part").alias("most"), F.max(F.struct("c", "node", "n", "part")).alias("core"))
        return named.join(of.filter("least != most"), "shingle")

    sizes = (F.col("n"), F.col("core.n"))
    asked = labelled().filter((F.col("part") != F.col("core.part")) & similar.alike(*sizes) & similar.possible(F.least("c", "core.c"), *sizes))
    links = common.gathered(links.union(_verified(texts, signed, _pairs(asked, "node", "core.node"), similar)))
    links = links.union(_verified(texts, signed, _rest(labelled().select("shingle", "node", "n", "part"), signed.groupBy("node").agg(F.first("parities").alias("parities")), similar), similar))
    parts = signed.select("id", "key", "node").join(components(links), "node", "left").withColumn("label", F.coalesce("label", "node"))
    least = parts.groupBy("label").agg(F.min(F.when(F.col("id").isNotNull(), F.struct("id", "key"))).alias("least"))
    return parts.join(least, "label").select(F.col("id").alias("doc_id"), F.col("least.id").alias("component_id"), "key", F.coalesce((F.col("id") == F.col("least.id")) & (F.col("key") == F.col("least.key")), F.lit(False)).alias("leads"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with one row of each class: the one with the smallest id, of the texts with that id the one with the
    smallest hash, of rows alike in both any one (the same in every run). Rows with a null id all stay. What goes is told to the texts by id and
    hash, by broadcast while that is at most `common.BROADCAST_ROWS` rows, beyond by a shuffle."""
    found = common.cut(classes(docs, id_col, text_col).filter("doc_id is not null").groupBy("doc_id", "key", "leads").agg(F.count("*").alias("n")))
    i, k, number = (common.fresh(docs.columns, x) for x in ("id", "key", "number"))
    named = lambda df: df.select(F.col("doc_id").alias(i), F.col("key").alias(k))
    gone, again = common.gathered(named(found.filter("not leads or n > 1"))), common.gathered(named(found.filter("leads and n > 1")))
    same = lambda d, x: (d[f"`{id_col}`"] == x[i]) & (F.xxhash64(d[f"`{text_col}`"]) == x[k])
    out = docs.join(common.small(gone), same(docs, gone), "left_anti")
    if again.isEmpty():
        return out
    row = F.row_number().over(W.partitionBy(f"`{id_col}`", F.xxhash64(f"`{text_col}`")).orderBy(F.xxhash64(*[f"`{c}`" for c in docs.columns])))
    return out.unionByName(docs.join(common.small(again), same(docs, again), "left_semi").withColumn(number, row).filter(F.col(number) == 1).drop(number))
