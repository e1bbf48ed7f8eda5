"""Suffix-array dedup: exact repeats of 50 bytes, by merging Burrows-Wheeler transforms of shards.

Which bytes: each one covered by a `length`-byte string that also starts in a document with a smaller id.
Every such string (window) holds a minimizer, the `ANCHOR`-byte string of least hash in it, and equal
windows hold the same one at the same place. So all windows can be compared anchor by anchor:

1. Documents are packed into blocks (the shards, about 6 MiB). A block lists the hashes of its anchors.
2. Hashes that several documents share are found (buckets of the hash range); a block gets two bits an anchor.
   A document whose whole text a smaller document has goes whole, and is left out of what follows.
3. For shared anchors a block makes its shard of the suffix array: the suffixes that start at anchors, sorted
   by what follows, each with the bytes before it (its Burrows-Wheeler columns), its least document and how far
   it reaches; equal ones are kept once. Shards go to buckets by anchor. A bucket starts from the shards' own
   orders, one after the other, and refines that interleave eight bytes at a time: only suffixes that agree so far and whose
   next bytes are out of order move, and where neighbours part gives their common prefix (`interleave`). Then the
   interleave is refined backwards, one
   Burrows-Wheeler column a step, as in merging transforms (Holt & McMillan): a stable pass over the
   preceding byte turns the order of the suffixes that start a bytes before the anchor into that of a + 1. No
   set of suffixes is sorted as a whole after the shards were; neighbours whose preceding bytes were all equal and whose common prefix reaches
   length - a form a repeated interval, whose least document is the window's first owner.
4. A block gets, for each suffix and each a, whether a smaller document owns the window, and marks its texts.

Scale: texts travel as compressed blocks, twice; anchors as 5 bytes each; a text that a block has many times is one
entry. Work in a bucket is linear in its windows, and the number of buckets grows with the bytes of the table, so a
block has a row for each bucket it has an anchor for: at most as many rows as anchors. Tasks are as many as blocks or
buckets, up to `TASKS`; beyond, a task takes them one after the other. An anchor at more than `hot_rows` places (a line in a
third of three million documents, a string that each of a few blocks repeats) is not sent whole: its windows are dealt singly, by their own hash, after
equal ones are merged in the block, so inner windows are one row a block and outer ones spread evenly. That is up to 35 rows a place, so it is for
what does not fit a bucket: `hot`, the blocks that an anchor may be in, is no less than `hot_rows` unless asked for, as any line of a site is in most
blocks of a large table.
Hashes decide only where windows meet; windows are compared byte by byte. Copies of whole texts alone are told by a
128-bit digest.

Ids are whole numbers (text ids raise). Null text: empty, nothing removed. Texts under 50 bytes: nothing removed. Repeated rows with one id never
remove each other (no smaller id). A null id counts as larger than all others. Empty table: no rows.
Only the named columns are read.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

ANCHOR = 16
BLOCK = 6 << 20
#: Bytes of the input to each bucket of anchors (8 bytes an anchor, one in 18 bytes), and of suffixes.
ANCHOR_BYTES, SUFFIX_BYTES = 64 << 20, 12 << 20
TASKS = 50_000
#: Positions whose hashes caches hold; rows that are sorted at once.
PIECE, SLICE = 1 << 15, 1 << 18
#: Places of an anchor whose suffixes (86 bytes each) may meet in one bucket.
HOT_ROWS = 1 << 20
PAD = 255  # never a byte of UTF-8
NO_ID = (1 << 63) - 1


def _mix(x):
    import numpy as np

    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _eights(data):
    """The 8 bytes from every position, as an unsigned number."""
    import numpy as np

    return np.ndarray(len(data) - 7, "<u8", data, 0, (1,))


def _hash_at(data, pos):
    """Hashes of the ANCHOR bytes from pos."""
    if not len(pos):
        return pos.astype("<u8")
    e = _eights(data)
    return _mix(_mix(e[pos]) + e[pos + 8])


def anchors(data, length: int):
    """Positions of minimizers of all windows of data (uint8), the first of equal ones in a window."""
    import numpy as np

    if len(data) < length:
        return np.empty(0, np.int64)
    w, out = length - ANCHOR + 1, []
    ends = len(data) - ANCHOR + 1
    for lo in range(0, ends, PIECE):  # in pieces that caches hold, each with all windows over its positions
        a, b = max(0, lo - w + 1), min(ends, lo + PIECE + w - 1)
        at = _minima(data[a : b + ANCHOR - 1], w) + a
        out.append(at[(at >= lo) & (at < lo + PIECE)])
    return np.concatenate(out)


def _minima(data, w: int):
    """Positions of the least hash of any w neighbours."""
    import numpy as np

    e = _eights(data)
    h = _mix(_mix(e[:-8]) + e[8:])
    low, have = h, 1
    while have < w:  # minimum over have positions, by doubling
        step = min(have, w - have)
        low = np.minimum(low[: len(low) - step], low[step:])
        have += step
    # a position is the minimum of some window if its hash is the largest of the minima of the windows over it
    top, have = np.concatenate((np.zeros(w - 1, np.uint64), low, np.zeros(w - 1, np.uint64))), 1
    while have < w:
        step = min(have, w - have)
        top = np.maximum(top[: len(top) - step], top[step:])
        have += step
    return np.flatnonzero(top == h)


class Block:
    """Documents back to back, PAD after each, with their anchors."""

    def __init__(self, ids, lengths, data, at):
        self.ids, self.lengths, self.data, self.at = ids, lengths, data, at
        self.starts = lengths.cumsum() + range(len(lengths)) - lengths if len(lengths) else lengths

    @classmethod
    def of(cls, ids: list, texts: list[bytes], length: int) -> Block:
        import numpy as np

        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        data = np.frombuffer(b"".join(t + b"\xff" for t in texts), np.uint8)
        at = anchors(data, length)
        after = np.append(np.flatnonzero(data == PAD), len(data))
        at = at[after[np.searchsorted(after, at)] - at >= ANCHOR]  # no anchor holds the end of a document
        return cls(np.array([NO_ID if i is None else i for i in ids], np.int64), lengths, data, at)

    def pack(self) -> bytes:
        import numpy as np
        import zstandard

        steps = np.diff(self.at, prepend=0)
        z = zstandard.ZstdCompressor(level=6)
        return _join([self.ids.tobytes(), self.lengths.tobytes(), z.compress(self.data.tobytes()), z.compress(steps.astype("<u4").tobytes())])

    @classmethod
    def unpack(cls, raw: bytes) -> Block:
        import numpy as np
        import zstandard

        ids, lengths, data, steps = _part(raw)
        z = zstandard.ZstdDecompressor()
        return cls(np.frombuffer(ids, np.int64), np.frombuffer(lengths, np.int64), np.frombuffer(z.decompress(data), np.uint8), np.frombuffer(z.decompress(steps), "<u4").cumsum(dtype=np.int64))

    def owners(self):
        """Index of the document of each anchor."""
        import numpy as np

        return np.searchsorted(self.starts, self.at, "right") - 1

    def digests(self, length: int, buckets: int):
        """The distinct texts of length bytes or more: digests and their buckets, in order of these, and their least ids; the documents that are long enough, and which digest each has."""
        import hashlib

        import numpy as np

        long = np.flatnonzero(self.lengths >= length)
        said = b"".join(hashlib.blake2b(self.data[s : s + n], digest_size=16).digest() for s, n in zip(self.starts[long].tolist(), self.lengths[long].tolist(), strict=True))
        u, which = np.unique(np.frombuffer(said, "V16"), return_inverse=True)
        bucket = (u.view("<u8").reshape(-1, 2)[:, 0] % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        place = np.empty(len(u), np.int64)
        place[order] = np.arange(len(u))
        least = np.full(len(u), NO_ID)
        np.minimum.at(least, place[which], self.ids[long])
        return u[order], bucket[order], least, long, place[which]

    def keys(self, buckets: int):
        """For each anchor its bucket and its key of 40 bits in the bucket; the distinct pairs, sorted; which of these each anchor has."""
        import numpy as np

        h = _hash_at(self.data, self.at)
        both = ((h >> np.uint64(40)) % np.uint64(buckets) << np.uint64(40)) | (h & np.uint64((1 << 40) - 1))
        return (h, *np.unique(both, return_inverse=True))


def _join(parts: list[bytes]) -> bytes:
    return struct.pack(f"<{len(parts)}q", *map(len, parts)) + b"".join(parts)


def _part(raw: bytes, n: int = 4) -> list[bytes]:
    sizes, out, at = struct.unpack_from(f"<{n}q", raw), [], 8 * n
    for k in sizes:
        out.append(raw[at : at + k])
        at += k
    return out


def _runs(bucket) -> Iterator[tuple[int, int, int]]:
    """(bucket, from, to) of sorted bucket numbers."""
    import numpy as np

    cuts = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1]))) if len(bucket) else np.empty(0, np.int64)
    for lo, hi in zip(cuts, [*cuts[1:], len(bucket)], strict=False):
        yield int(bucket[lo]), int(lo), int(hi)


@cache
def _zstd(level: int):
    """A compressor (level 0: a decompressor) for all the small bodies of a worker: making one takes longer than they do."""
    import zstandard

    return zstandard.ZstdCompressor(level=level) if level else zstandard.ZstdDecompressor()


def _zip(array, level: int = 1) -> bytes:
    return _zstd(level).compress(array.tobytes())


def _unzip(raw: bytes, kind: str):
    import numpy as np

    return np.frombuffer(_zstd(0).decompress(raw), kind)


ROWS = "block long, bucket int, kind string, body binary"


def _batch(rows: list[tuple]):
    import pyarrow as pa

    cols = list(zip(*rows, strict=True)) or [()] * 4
    return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.string()), pa.array(cols[3], pa.binary())], names=["block", "bucket", "kind", "body"])


def _pack(length: int, buckets: int):
    """Texts -> blocks (kind text), and for each bucket the block's distinct anchor keys and which of them two of its documents share (kind keys)."""

    def run(batches):
        import numpy as np
        from pyspark import TaskContext

        number, ids, texts, held = TaskContext.get().partitionId() << 32, [], [], 0

        def rows():
            block = Block.of(ids, texts, length)
            _, distinct, which = block.keys(buckets)
            times = np.bincount(which, minlength=len(distinct)).astype("<u4")
            docs = block.ids[block.owners()]
            low, high = np.full(len(distinct), NO_ID), np.full(len(distinct), -NO_ID)
            np.minimum.at(low, which, docs)
            np.maximum.at(high, which, docs)
            out = [(number, -1, "text", block.pack())]
            for b, lo, hi in _runs(distinct >> np.uint64(40)):
                steps = np.diff(distinct[lo:hi] & np.uint64((1 << 40) - 1), prepend=np.uint64(0))
                planes = np.ascontiguousarray(steps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5].T)
                out.append((number, b, "keys", _join([_zip(planes), np.packbits(low[lo:hi] < high[lo:hi]).tobytes(), _zip(times[lo:hi])])))
            u, bucket, least, _, _ = block.digests(length, buckets)
            for b, lo, hi in _runs(bucket):
                out.append((number, b, "docs", _join([u[lo:hi].tobytes(), least[lo:hi].tobytes()])))
            return _batch(out)

        for batch in batches:
            for i, t in zip(batch.column("id").to_pylist(), common.encoded(batch.column("text")), strict=True):
                if texts and held + len(t) > BLOCK:
                    yield rows()
                    number, ids, texts, held = number + 1, [], [], 0
                ids.append(i)
                texts.append(t)
                held += len(t)
        if texts:
            yield rows()

    return run


def _share(hot: int, hot_rows: int):
    """Keys of one bucket from all blocks -> for each block two bits a key: several documents have it; it is too frequent (in more
    than `hot` blocks, or at more than `hot_rows` places)."""

    def run(key, rows):
        import numpy as np
        import pyarrow as pa

        blocks, parts, multi, times, ends = rows["block"].to_pylist(), [], [], [], []
        for body in rows["body"].to_pylist():
            planes, bits, count = _part(body, 3)
            times.append(_unzip(count, "<u4"))
            planes = _unzip(planes, "u1").reshape(5, -1)
            n = planes.shape[1]
            wide = np.zeros((n, 8), np.uint8)
            wide[:, :5] = planes.T
            parts.append(wide.view("<u8").ravel().cumsum(dtype=np.uint64))
            multi.append(np.unpackbits(np.frombuffer(bits, np.uint8), count=n))
            ends.append(n)
        every = np.concatenate(parts)
        order = np.argsort(every, kind="stable")
        runs = every[order]
        first = np.flatnonzero(np.concatenate(([True], runs[1:] != runs[:-1])))
        count = np.diff(np.append(first, len(runs)))
        many = (count > 1) | (np.add.reduceat(np.concatenate(multi)[order].astype(np.int64), first) > 0)
        places = np.add.reduceat(np.concatenate(times)[order].astype(np.int64), first)
        says = np.empty(len(every), np.uint8)
        says[order] = np.repeat(np.where((count > hot) | (places > hot_rows), 2, np.where(many, 1, 0)).astype(np.uint8), count)
        cuts = np.concatenate(([0], np.cumsum(ends)))
        out = [(b, key[0].as_py(), "says", _zip(says[lo:hi])) for b, lo, hi in zip(blocks, cuts, cuts[1:], strict=False) if says[lo:hi].any()]
        return pa.Table.from_batches([_batch(out)])

    return run


def _copies(key, rows):
    """Distinct texts of one bucket from all blocks -> for each block those that have a smaller id elsewhere, and that id."""
    import numpy as np
    import pyarrow as pa

    blocks, ids, digests = rows["block"].to_pylist(), [], []
    for body in rows["body"].to_pylist():
        d, i = _part(body, 2)
        digests.append(np.frombuffer(d, "V16"))
        ids.append(np.frombuffer(i, np.int64))
    u, inverse = np.unique(np.concatenate(digests), return_inverse=True)
    least = np.full(len(u), NO_ID)
    np.minimum.at(least, inverse, np.concatenate(ids))
    least, cuts, out = least[inverse], np.concatenate(([0], np.cumsum([len(i) for i in ids]))), []
    for b, i, lo, hi in zip(blocks, ids, cuts, cuts[1:], strict=False):
        at = np.flatnonzero(least[lo:hi] < i)
        if len(at):
            out.append((b, key[0].as_py(), "copy", _join([at.tobytes(), least[lo:hi][at].tobytes()])))
    return pa.Table.from_batches([_batch(out)])


def _suffixes(block: Block, says: dict[int, bytes], copies, length: int, buckets: int, to: int):
    """The block's shard (without the documents that are copies): rows (bytes before the anchor | bytes from it on), reach before and after, bucket; and of each occurrence its position, document and row."""
    import numpy as np

    before = length - ANCHOR
    h, distinct, which = block.keys(buckets)
    flags = np.zeros(len(distinct), np.uint8)
    for b, lo, hi in _runs(distinct >> np.uint64(40)):
        if b in says:
            flags[lo:hi] = _unzip(says[b], "u1")
    owner = block.owners()
    flag = np.where(copies[owner], 0, flags[which])
    ends = block.starts + block.lengths
    one = np.flatnonzero(flag == 1)
    at, doc, reach = block.at[one], owner[one], np.full(len(one), before)
    bucket = (h[one] >> np.uint64(20)) % np.uint64(to)
    # hot anchors: every window that holds one is a suffix of its own, with nothing before
    two = np.flatnonzero(flag == 2)
    if len(two):
        wide = (block.at[two][:, None] - np.arange(before + 1)).ravel()
        its = np.repeat(owner[two], before + 1)
        ok = (wide >= block.starts[its]) & (wide + length <= ends[its])
        wide, first = np.unique(wide[ok], return_index=True)
        its = its[ok][first]
        data = np.append(block.data, np.full(8, PAD, np.uint8))
        hashed = np.zeros(len(wide), np.uint64)
        for k in (*range(0, length - 7, 8), length - 8):
            hashed = _mix(hashed + data[wide[:, None] + np.arange(k, k + 8)].view("<u8").ravel())
        at, doc, reach, bucket = np.concatenate((at, wide)), np.concatenate((doc, its)), np.concatenate((reach, np.zeros(len(wide), reach.dtype))), np.concatenate((bucket, (hashed >> np.uint64(20)) % np.uint64(to)))
    left, right = np.minimum(at - block.starts[doc], reach), np.minimum(ends[doc] - at, length)
    padded = np.concatenate((np.full(before, PAD, np.uint8), block.data, np.full(length, PAD, np.uint8)))
    around, cols = np.lib.stride_tricks.sliding_window_view(padded, before + length), np.arange(before + length)
    out, kept = np.empty(len(at), np.int64), []
    for lo in range(0, len(at), SLICE):  # equal rows first go in slices, so that memory stays bounded
        s = slice(lo, lo + SLICE)
        m = around[at[s]]
        cut = np.flatnonzero((left[s] < before) | (right[s] < length))
        part = m[cut]
        part[(cols < before - left[s][cut][:, None]) | (cols >= before + right[s][cut][:, None])] = PAD
        m[cut] = part
        m = np.hstack((m[:, before:], m[:, :before], left[s][:, None].astype(np.uint8), right[s][:, None].astype(np.uint8)))
        v = np.ascontiguousarray(m).view(f"V{m.shape[1]}").ravel()
        u, inverse = np.unique(v, return_inverse=True)
        low = np.full(len(u), NO_ID)
        np.minimum.at(low, inverse, block.ids[doc[s]])
        where = np.zeros(len(u), np.int64)
        where[inverse] = bucket[s].astype(np.int64)
        kept.append((u, low, where, lo, inverse))
    if not kept:
        return None
    every = np.concatenate([k[0] for k in kept])
    u, inverse = np.unique(every, return_inverse=True) if len(kept) > 1 else (every, np.arange(len(every)))
    low, where = np.full(len(u), NO_ID), np.zeros(len(u), np.int64)
    np.minimum.at(low, inverse, np.concatenate([k[1] for k in kept]))
    where[inverse] = np.concatenate([k[2] for k in kept])
    base = 0
    for v, _, _, lo, inv in kept:
        out[lo : lo + len(inv)] = inverse[base : base + len(v)][inv]
        base += len(v)
    order = np.argsort(where, kind="stable")  # by bucket, sorted by what follows the anchor inside
    place = np.empty(len(u), np.int64)
    place[order] = np.arange(len(u))
    return u[order], low[order], where[order], at, doc, place[out], left, right


def _of_block(text, said, length: int, buckets: int) -> tuple[Block, object, dict, dict]:
    """The block, which of its documents are copies, what is said of its anchors, and who owns its suffixes."""
    import numpy as np

    text, says, owned = Block.unpack(text["body"][0].as_py()), {}, {}
    _, of, least, long, which = text.digests(length, buckets)
    for bucket, kind, body in zip(said["bucket"].to_pylist(), said["kind"].to_pylist(), said["body"].to_pylist(), strict=True):
        if kind == "copy":
            at, ids = (np.frombuffer(x, np.int64) for x in _part(body, 2))
            least[np.searchsorted(of, bucket) + at] = ids
        else:
            (says if kind == "says" else owned)[bucket] = body
    flags = np.zeros(len(text.ids), bool)
    flags[long] = text.ids[long] > least[which]
    return text, flags, says, owned


def _shard(length: int, buckets: int, to: int):
    def run(key, text, said):
        import pyarrow as pa

        block, copies, says, _ = _of_block(text, said, length, buckets)
        out, made = [], _suffixes(block, says, copies, length, buckets, to) if says else None
        if made:
            u, low, where = made[:3]
            for b, lo, hi in _runs(where):
                out.append((key[0].as_py(), b, "shard", _join([_zip(u[lo:hi], 3), _zip(low[lo:hi], 3)])))
        return pa.Table.from_batches([_batch(out)])

    return run


def interleave(m, length: int):
    """The order of the rows of m (bytes) by their first `length`, and the common prefix of each with the one before it. The rows
    are those of sorted shards, one shard after the other, and so is the first interleave. It is refined eight bytes at a
    time: of the rows that agree so far only the groups whose next bytes are out of order are put right, by a stable merge
    of the shards' runs; where they agree for good, no row moves. A boundary between two rows stands once their bytes differ,
    and the first byte that does is their common prefix."""
    import numpy as np

    n = len(m)
    order, prefix = np.arange(n, dtype=np.int64), np.zeros(n, np.uint8)
    tied = np.ones(n, bool)  # with the row before it, as far as bytes have been read
    tied[:1] = False
    for k in range(0, length, 8):
        width = min(8, length - k)
        at = np.flatnonzero(tied | np.append(tied[1:], False))
        if not len(at):
            break
        eight = np.zeros((len(at), 8), np.uint8)
        eight[:, :width] = m[order[at], k : k + width]
        eight = eight.view(">u8").ravel().astype(np.uint64)
        group = np.cumsum(~tied[at])
        wrong = np.zeros(group[-1] + 1, bool)
        wrong[group[1:][(eight[1:] < eight[:-1]) & tied[at[1:]]]] = True
        some = np.flatnonzero(wrong[group])
        if len(some):
            moved = some[np.lexsort((eight[some], group[some]))]
            order[at[some]], eight[some] = order[at[moved]], eight[moved]
        inside = np.flatnonzero(tied[at])
        differs = eight[inside] ^ eight[inside - 1]
        apart = np.flatnonzero(differs)
        first = differs[apart].astype(">u8").view(np.uint8).reshape(-1, 8).astype(bool).argmax(axis=1)
        prefix[at[inside[apart]]] = k + first
        tied[at[inside[apart]]] = False
    prefix[tied] = length
    return order.astype(np.int32), prefix


def merge_shards(rows, low, length: int):
    """rows: suffixes of all shards, one sorted shard after the other (bytes from the anchor on | bytes before | reach before |
    reach after). low: their least documents. For each suffix and each a: whether a smaller document owns the window that
    starts a before."""
    import numpy as np

    n, before = len(rows), length - ANCHOR
    m = rows.view(np.uint8).reshape(n, -1)
    left, right = m[:, -2].copy(), m[:, -1].copy()
    order, prefix = interleave(m, length)
    rank = np.empty(n, np.int32)
    rank[order] = np.arange(n, dtype=np.int32)
    columns = np.ascontiguousarray(m[:, length : length + before].T)
    c = np.zeros(n, np.int32)  # class of the bytes before, as far as they have been read, in the order of the suffixes
    owned = np.zeros((before + 1, n), bool)
    for a in range(before + 1):
        if a:
            b = columns[before - a][order]
            moved = np.argsort(b, kind="stable")
            order, b, c = order[moved], b[moved], c[moved]
            c = np.concatenate((np.zeros(1, np.int32), np.cumsum((b[1:] != b[:-1]) | (c[1:] != c[:-1]), dtype=np.int32)))
        reach = np.cumsum(prefix < length - a, dtype=np.int32)[rank[order]]  # class of the length - a bytes from the anchor on
        first = np.flatnonzero(np.concatenate(([True], (reach[1:] != reach[:-1]) | (c[1:] != c[:-1]))))
        d = np.where((left >= a) & (right >= length - a), low, NO_ID)[order]
        least = np.repeat(np.minimum.reduceat(d, first), np.diff(np.append(first, n)))
        owned[a, order] = least < d
        owned[a] &= (left >= a) & (right >= length - a)
    return np.ascontiguousarray(owned.T)


def _merge(length: int):
    def run(key, rows):
        import numpy as np
        import pyarrow as pa

        blocks, parts, lows = rows["block"].to_pylist(), [], []
        for body in rows["body"].to_pylist():
            u, low = _part(body, 2)
            parts.append(_unzip(u, f"V{2 * length - ANCHOR + 2}"))
            lows.append(_unzip(low, "<i8"))
        owned = merge_shards(np.concatenate(parts), np.concatenate(lows), length)
        cuts = np.concatenate(([0], np.cumsum([len(p) for p in parts])))
        return pa.Table.from_batches([_batch([(b, key[0].as_py(), "owned", _zip(np.packbits(owned[lo:hi], axis=1))) for b, lo, hi in zip(blocks, cuts, cuts[1:], strict=False)])])

    return run


def _marks(block: Block, says: dict, copies, owned: dict, length: int, buckets: int, to: int):
    """The bytes of the block that go."""
    import numpy as np

    starts = np.zeros(len(block.data) + 1, np.int8)
    made = _suffixes(block, says, copies, length, buckets, to) if says else None
    if made:
        u, low, where, at, doc, row, left, right = made
        width = -(-(length - ANCHOR + 1) // 8)
        bits = np.zeros((length - ANCHOR + 1, len(u)), bool)
        for b, lo, hi in _runs(where):
            bits[:, lo:hi] = np.unpackbits(_unzip(owned[b], "u1").reshape(-1, width), axis=1, count=length - ANCHOR + 1).T
        later = block.ids[doc] > low[row]  # the row's least document is smaller than this one: every window of the row goes
        for a in range(length - ANCHOR + 1):
            go = (left >= a) & (right >= length - a) & (later | bits[a][row])
            starts[at[go] - a] = 1
    first = np.flatnonzero(starts)
    change = np.zeros(len(block.data) + 1, np.int32)
    change[first] += 1
    np.add.at(change, first + length, -1)
    gone = np.cumsum(change)[:-1] > 0
    for i in np.flatnonzero(copies):
        gone[block.starts[i] : block.starts[i] + block.lengths[i]] = True
    return gone


def _finish(length: int, buckets: int, to: int, with_text: bool):
    def run(key, text, said):
        import hashlib

        import numpy as np
        import pyarrow as pa

        block, copies, says, owned = _of_block(text, said, length, buckets)
        gone = _marks(block, says, copies, owned, length, buckets, to)
        out = []
        for i, lo, n in zip(block.ids.tolist(), block.starts.tolist(), block.lengths.tolist(), strict=True):
            g, text = gone[lo : lo + n], block.data[lo : lo + n]
            removed = int(np.count_nonzero(g))
            kept = text[~g].tobytes() if removed else text.tobytes()
            spans = int(g[0]) + int(np.count_nonzero(g[1:] & ~g[:-1])) if removed else 0
            out.append((None if i == NO_ID else i, n, removed, spans, hashlib.sha256(kept).hexdigest(), kept if with_text else None))
        cols = list(zip(*out, strict=True)) or [()] * 6
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    return run


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 50, hot: int = HOT_ROWS, hot_rows: int = HOT_ROWS, with_text: bool = True) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (the remaining bytes, with_text only; else null)."""
    common.shared_dir(docs.sparkSession)
    rows = common.pick(docs, id=id_col, text=text_col).withColumn("id", F.col("id").cast("long"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets, to = total // ANCHOR_BYTES + 1, total // SUFFIX_BYTES + 1
    packed = common.cut(rows.mapInArrow(_pack(length, buckets), ROWS))
    n, m = min(TASKS, total // BLOCK + 1), min(TASKS, to)
    texts = packed.filter("kind = 'text'").repartition(n, "block")
    says = common.cut(packed.filter("kind = 'keys'").groupBy("bucket").applyInArrow(_share(hot, hot_rows), ROWS).unionByName(packed.filter("kind = 'docs'").groupBy("bucket").applyInArrow(_copies, ROWS)))
    # one plan from here on, so that both groupings of the texts share one exchange
    shards = texts.groupBy("block").cogroup(says.repartition(n, "block").groupBy("block")).applyInArrow(_shard(length, buckets, to), ROWS)
    owned = shards.repartition(m, "bucket").groupBy("bucket").applyInArrow(_merge(length), ROWS)
    return texts.groupBy("block").cogroup(says.unionByName(owned).repartition(n, "block").groupBy("block")).applyInArrow(_finish(length, buckets, to, with_text), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op1: what exact repeats of 50 bytes take from every document."""
    return dedup(common.table(spark, sf_dir, "documents"), with_text=False).drop("kept")
