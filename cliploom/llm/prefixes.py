"""Every pair of sets that can be as similar as asked for, by their prefixes.

The shingles of all sets stand in one order, rare ones first. Two sets of Jaccard
similarity s or more share one of the first n - ceil(s * n) + 1 shingles of each (n:
its size), so that sets which meet on no such shingle need no comparison; where they
first meet, enough shingles must follow in both, and their sizes must be near enough.
None of this loses a pair. The order is by the frequency in a sample, then by hash:
the sample decides how much is compared alone, never a result.

Sets known to be in one component are not paired again, so a large family of copies,
once joined, makes no pairs. Postings travel packed, a block for each chunk and shard.

A pair that is named is then held against the bitmaps of both sets: a bit is set where
an odd number of a set's shingles fall, so that two sets differ in at least as many
shingles as their bitmaps differ in bits. What that rules out is not compared further.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, trim
from .fragments import MIX, _stretches, from_planes, to_planes

#: Packed postings per shard, and bytes of one.
SHARD_BYTES, POSTING_BYTES = 4 << 20, 32
#: Most bytes, and share, of texts in the sample; sets in the sample that make a shingle
#: frequent; most frequent shingles that are told to all tasks (8 bytes each).
SAMPLE_BYTES, SAMPLE_SHARE, FREQUENT, MOST_FREQUENT = 1 << 30, 1 / 16, 4, 1 << 20
#: Rows of a posting list compared at once with the rest, comparisons of them at most,
#: and pairs held before they are made distinct.
ROWS, AT_ONCE, HELD = 64, 1 << 19, 1 << 18
COLUMNS = ((np.uint64, 8), (np.int64, 8), (np.int64, 8), (np.int32, 4), (np.int32, 4))


def frequent(docs: DataFrame, total: int, shingles: Callable[[bytes], np.ndarray]) -> np.ndarray:
    """Shingles of many texts in a sample, the rarer ones first."""
    share = min(SAMPLE_SHARE, SAMPLE_BYTES / max(1, total))
    sample = docs.where(F.pmod(F.xxhash64("doc_id", F.lit(78)), F.lit(1 << 30)) < int(share * (1 << 30)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            found = np.concatenate([shingles(t.encode()) for t in batch.column("text").to_pylist()])
            values, n = np.unique(found.view(np.int64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(values), pa.array(n.astype(np.int64))], ["shingle", "n"])

    found = sample.mapInArrow(count, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n")).where(F.col("n") >= FREQUENT)
    rows = found.orderBy(F.desc("n"), "shingle").limit(MOST_FREQUENT).select("shingle").toArrow()
    return rows.column("shingle").to_numpy()[::-1].astype(np.int64).view(np.uint64)


class Order:
    """The order of all shingles: those not frequent by hash, then the frequent ones."""

    def __init__(self, last: np.ndarray):
        self.rank = np.argsort(last)
        self.values = last[self.rank]

    def prefix(self, shingles: np.ndarray, similarity: float) -> np.ndarray:
        """Of distinct shingles; none of none."""
        n = len(shingles)
        if not n:
            return shingles
        place = shingles >> np.uint64(1)
        if len(self.values):
            at = np.minimum(np.searchsorted(self.values, shingles), len(self.values) - 1)
            known = self.values[at] == shingles
            place[known] = np.uint64(1 << 63) + self.rank[at[known]].astype(np.uint64)
        return shingles[np.lexsort((shingles, place))[: n - at_least(similarity * n) + 1]]


def at_least(x):
    """The smallest integer not below x, rounding errors aside."""
    return np.ceil(x - 1e-6).astype(np.int64) if isinstance(x, np.ndarray) else math.ceil(x - 1e-6)


#: Bits of a bitmap for each shingle, about, and the fewest and most of one.
BITS_EACH, FEWEST_BITS, MOST_BITS = 4, 64, 1 << 16


def bitmap(shingles: np.ndarray) -> bytes:
    """Of distinct shingles; as many bits as a power of two, by a shingle's lowest ones."""
    want = min(MOST_BITS, max(FEWEST_BITS, BITS_EACH * len(shingles)))
    bits = 1 << (want - 1).bit_length()
    odd = np.bincount((shingles & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def differing(a: bytes, b: bytes) -> int:
    """Bits in which two bitmaps differ; the longer one is folded to the other's length."""
    x, y = (np.frombuffer(raw, np.uint64) for raw in (a, b))
    while len(x) != len(y):
        if len(x) < len(y):
            x, y = y, x
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


def plausible(pairs: DataFrame, nodes: DataFrame, similarity: float) -> DataFrame:
    """The pairs u, v of nodes (node, size, bitmap) that their bitmaps do not rule out."""
    side = lambda key, n, bits: nodes.select(F.col("node").alias(key), F.col("size").alias(n), F.col("bitmap").alias(bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = batch.column("m").to_numpy().astype(np.int64) + batch.column("n").to_numpy()
            most = both - 2 * at_least(similarity / (1 + similarity) * both)
            far = [differing(a, b) for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True)]
            yield batch.filter(pa.array(np.asarray(far, np.int64) <= most)).select(["u", "v"])

    met = pairs.join(side("u", "m", "a"), "u").join(side("v", "n", "b"), "v")
    return met.select("u", "v", "m", "n", "a", "b").mapInArrow(run, "u long, v long")


def pairs_of(token: np.ndarray, node: np.ndarray, group: np.ndarray, size: np.ndarray, place: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (larger, smaller) nodes of different groups that a token lets be similar."""
    order = np.lexsort((size, token))
    token, node, group, size, place = (x[order] for x in (token, node, group, size, place))
    held, n, done = [], 0, np.zeros((0, 2), np.int64)
    for a, b in _stretches(token):
        if b - a < 2 or (group[a:b] == group[a]).all():
            continue
        step = max(1, min(ROWS, AT_ONCE // (b - a)))
        for i in range(a, b, step):
            rows = slice(i, min(i + step, b))
            upto = a + int(np.searchsorted(similarity * size[a:b], size[rows.stop - 1] + 1e-6, "right"))
            rest = slice(i, upto)
            both = size[rows, None] + size[None, rest]
            most = np.minimum((size - place)[rows, None], (size - place)[None, rest])  # this shingle and those after it
            fit = (group[rows, None] != group[None, rest]) & (similarity * size[None, rest] <= size[rows, None] + 1e-6) & (most >= at_least(similarity / (1 + similarity) * both))
            fit &= np.arange(i, upto)[None, :] > np.arange(rows.start, rows.stop)[:, None]
            x, y = np.nonzero(fit)
            if len(x):
                x, y = node[i + x], node[i + y]
                held.append(np.stack([np.maximum(x, y), np.minimum(x, y)], axis=1))
                n += len(x)
            if n > HELD:
                done, held, n = _distinct([done, *held]), [], 0
    done = _distinct([done, *held])
    return done[:, 0], done[:, 1]


def _distinct(parts: list[np.ndarray]) -> np.ndarray:
    """Distinct rows of two columns, sorted."""
    rows = np.concatenate(parts)
    rows = rows[np.lexsort((rows[:, 1], rows[:, 0]))]
    return rows[np.append(True, (np.diff(rows, axis=0) != 0).any(axis=1))] if len(rows) else rows


def candidates(nodes: DataFrame, similarity: float) -> DataFrame:
    """Distinct u > v: nodes of different groups that may be as similar as asked for.
    `nodes`: node, grouped (longs), size (int) and prefix (64-bit shingles, in order)."""
    postings = nodes.select(F.sum(F.octet_length("prefix")).alias("n")).first()["n"] or 0
    shards = max(8, postings // 8 * POSTING_BYTES // SHARD_BYTES)

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = zstandard.ZstdCompressor(level=3)
        for batch in chunks(batches, "prefix"):
            raws = batch.column("prefix").to_pylist()
            tokens, counts = np.frombuffer(b"".join(raws), np.uint64), np.asarray([len(r) // 8 for r in raws], np.int64)
            of = np.repeat(np.arange(len(raws)), counts)
            place = np.arange(len(tokens)) - np.repeat(np.cumsum(counts) - counts, counts)
            columns = (tokens, *(batch.column(c).to_numpy()[of] for c in ("node", "grouped", "size")), place)
            shard = (((tokens * MIX[0]) >> np.uint64(32)) % np.uint64(shards)).astype(np.int64)
            order = np.argsort(shard, kind="stable")
            packs = []
            for a, b in _stretches(shard[order]):
                at = order[a:b]
                packs.append((int(shard[at[0]]), coder.compress(b"".join([np.int64(b - a).tobytes(), *(to_planes(x[at].astype(kind)) for x, (kind, _) in zip(columns, COLUMNS, strict=True))]))))
            yield pa.RecordBatch.from_arrays([pa.array([s for s, _ in packs], pa.int64()), pa.array([p for _, p in packs], pa.binary())], ["shard", "packed"])

    def meet(key: tuple, found: pa.Table) -> pa.Table:
        decoder, parts = zstandard.ZstdDecompressor(), []
        for pack in found.column("packed").to_pylist():
            raw = decoder.decompress(pack)
            n, at, columns = int(np.frombuffer(raw, np.int64, 1)[0]), 8, []
            for kind, width in COLUMNS:
                columns.append(from_planes(raw, at, n, kind, width))
                at += n * width
            parts.append(columns)
        token, node, group, size, place = (np.concatenate(x) for x in zip(*parts, strict=True))
        # most shingles are in one set only
        order = np.argsort(token, kind="stable")
        edge = np.append(True, np.diff(token[order]) != 0)
        shared = order[~(edge & np.append(edge[1:], True))]
        u, v = pairs_of(token[shared], node[shared], group[shared], size[shared].astype(np.int64), place[shared].astype(np.int64), similarity)
        trim()
        return pa.table([pa.array(u), pa.array(v)], ["u", "v"])

    return nodes.select("node", "grouped", "size", "prefix").mapInArrow(dealt, "shard long, packed binary").groupBy("shard").applyInArrow(meet, "u long, v long").where("u <> v").distinct()
