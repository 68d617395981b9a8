"""SimHash near-dedup with BK-trees.

A fingerprint of 64 bits holds the majority of the XXH64 (seed 42) bits of a
text's word shingles. Distinct fingerprints are dealt to shards: two that differ
in at most 3 bits agree in one of 4 blocks of 16 bits, so each goes to 4 shards,
by the leading bits of each block (as many as the number of fingerprints asks
for, so that a shard stays bounded). Each shard builds a BK-tree, whose children
are keyed by their Hamming distance to the parent, and every fingerprint follows
only the edges within the radius. A shard hands on one edge to its component for
each member, never all pairs; components.py joins those of all shards.

The shard trees travel with their shards, by shuffle: broadcasting every tree to
every fingerprint would compare all pairs of a corpus.

`similar_groups` and `dedup` are the wider form for a given Jaccard similarity of
distinct shingles. Texts with the very same set of shingles are one node; an equal
fingerprint alone makes no two texts one. Fingerprints have 256 bits of the distinct
shingles and link within two standard deviations above the number of differing bits
that the similarity leads to. Such a radius leaves no block equal for sure, so shards
are drawn bits: as many bits as keep a shard small and as many draws as make a pair at
the similarity meet with probability MEET; closer pairs meet sooner. A shard hands on
two candidates a member at most, its nearest code and the smallest of its component
there, and each candidate counts only if the shingles of both texts are as similar as
asked for. This joins most copies without naming all pairs of a large family. What it
leaves out is then found exactly: prefixes.py names every pair of texts not yet joined
that can be as similar as asked for, and all of those are recounted too.

Defined results: null or empty texts have fingerprint zero and link like others;
texts of fewer words than a shingle are one shingle; rows that repeat a doc_id
count as one node; a null doc_id sorts before all others.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_small, chunks, fresh, release, small_batches, trim, written
from .components import components
from .fragments import NO_ID, keyed, total_bytes
from .prefixes import Order, bitmap, candidates, frequent, plausible

RADIUS, BLOCKS, BLOCK_BITS, SEED = 3, 4, 16, 42
#: Fingerprints of a shard that the number of leading bits aims at.
SHARD_SIZE = 2048
LEAF = 24
#: 64-bit words of a wide fingerprint; chance that a pair at the similarity meets.
WIDE, MEET = 4, 0.96


#: Shingles of a text whose places are held as Python integers at once.
AT_ONCE = 1 << 15


def shingle_hashes(raw: bytes, words: int) -> np.ndarray:
    """XXH64 of each shingle of lower-cased words, repeats included."""
    split = raw.lower().split()
    n, digest = len(split), xxhash.xxh64_intdigest
    joined = b" ".join(split)
    if n <= words:
        return np.asarray([digest(joined, SEED)] if n else [], "<u8")
    ends = np.cumsum(np.fromiter(map(len, split), np.int64, n) + 1)
    del split
    starts, ends = np.append(0, ends[: n - words]), ends[words - 1 :] - 1
    out = np.empty(len(starts), "<u8")
    for i in range(0, len(starts), AT_ONCE):
        spans = zip(starts[i : i + AT_ONCE].tolist(), ends[i : i + AT_ONCE].tolist(), strict=True)
        out[i : i + AT_ONCE] = [digest(joined[a:b], SEED) for a, b in spans]
    return out


def majority(hashes: np.ndarray) -> int:
    """The bits set in over half of the hashes; none of no hashes."""
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 14):
        ones += np.unpackbits(hashes[i : i + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprint(raw: bytes, words: int) -> int:
    return majority(shingle_hashes(raw, words))


def remixed(h: np.ndarray, round_: int) -> np.ndarray:
    """A further 64 bits of each hash."""
    h = h + np.uint64(0x9E3779B97F4A7C15 * round_ % (1 << 64))
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def wide_fingerprint(hashes: np.ndarray) -> bytes:
    """Of distinct shingles, as the similarity is: repeats weigh nothing."""
    return b"".join(majority(remixed(hashes, i)).to_bytes(8, "little") for i in range(1, WIDE + 1))


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """key (doc_id, never null) and fp (the unsigned fingerprint's bits as a long)."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            found = np.asarray([fingerprint(t.encode(), words) for t in batch.column("text").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found.view(np.int64))], ["key", "fp"])

    return keyed(docs).mapInArrow(run, "key long, fp long")


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Differing bits of codes held as rows of 64-bit words."""
    return np.bitwise_count(a ^ b).sum(axis=-1, dtype=np.int64)


class BkTree:
    """A BK-tree over distinct codes; nodes with few codes stay leaves."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.root = self._node(np.arange(len(codes)))

    def _node(self, members: np.ndarray):
        """(members, None) of a leaf, or (pivot, [(distance, [child]), ...])."""
        top: list = []
        todo = [(members, top)]
        while todo:
            members, into = todo.pop()
            if len(members) <= LEAF:
                into.append((members, None))
                continue
            pivot, rest = members[0], members[1:]
            far = distances(self.codes[rest], self.codes[pivot])
            children = []
            for d in np.unique(far):
                child: list = []
                children.append((int(d), child))
                todo.append((rest[far == d], child))
            into.append((pivot, children))
        return top[0]

    def near(self, radius: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """An index, those within the radius of it, and their distances: every code
        follows the edges whose distance differs from its own by at most the radius."""
        todo = [(self.root, np.arange(len(self.codes)))]
        while todo:
            (what, children), asking = todo.pop()
            if children is None:
                for i in what.tolist():
                    far = distances(self.codes[asking], self.codes[i])
                    yield i, asking[far <= radius], far[far <= radius]
                continue
            far = distances(self.codes[asking], self.codes[what])
            yield int(what), asking[far <= radius], far[far <= radius]
            for d, child in children:
                on = asking[np.abs(far - d) <= radius]
                if len(on):
                    todo.append((child[0], on))


class Links:
    """Components of codes (rows of words) within a radius, and each one's nearest."""

    def __init__(self, codes: np.ndarray, radius: int):
        n = len(codes)
        self.parent, self.nearest = np.arange(n), np.full(n, -1)
        best = np.full(n, radius + 1)
        for i, hit, far in BkTree(codes).near(radius):
            other = hit != i
            hit, far = hit[other], far[other]
            if not len(hit):
                continue
            both = np.unique(self.roots(np.append(hit, i)))
            self.parent[both] = both[0]
            self.parent[hit] = both[0]
            closer = (far < best[hit]) | ((far == best[hit]) & (i < self.nearest[hit]))
            best[hit[closer]], self.nearest[hit[closer]] = far[closer], i

    def roots(self, of: np.ndarray) -> np.ndarray:
        of = self.parent[of]
        while True:
            up = self.parent[of]
            if np.array_equal(up, of):
                return of
            of = up

    def spanning(self) -> tuple[np.ndarray, np.ndarray]:
        """(member, root) for every code that is not the root of its component."""
        top = self.roots(np.arange(len(self.parent)))
        rest = np.flatnonzero(top != np.arange(len(top)))
        return rest, top[rest]

    def candidates(self) -> tuple[np.ndarray, np.ndarray]:
        """Those and (member, nearest)."""
        low, high = self.spanning()
        near = np.flatnonzero(self.nearest >= 0)
        return np.append(low, near), np.append(high, self.nearest[near])


def link(nodes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Edges u, v that span the components of distinct fingerprints (column fp)."""
    n = nodes.count()
    bits = min(BLOCK_BITS, max(0, int(np.ceil(np.log2(max(1, n) / SHARD_SIZE)))))
    shards = [F.lit(i << BLOCK_BITS) + F.shiftright(F.shiftrightunsigned("fp", BLOCK_BITS * i).bitwiseAND(0xFFFF), BLOCK_BITS - bits) for i in range(BLOCKS)]

    def run(key: tuple, found: pa.Table) -> pa.Table:
        codes = np.unique(found.column("fp").to_numpy().view(np.uint64))
        low, high = Links(codes[:, None], radius).spanning()
        return pa.table([pa.array(codes[low].view(np.int64)), pa.array(codes[high].view(np.int64))], ["u", "v"])

    dealt = nodes.select("fp", F.explode(F.array(*shards)).alias("shard"))
    return dealt.groupBy("shard").applyInArrow(run, "u long, v long")


def near_groups(docs: DataFrame, words: int = 3, radius: int = RADIUS) -> DataFrame:
    """One row per document: doc_id, fingerprint, component_id."""
    if radius >= BLOCKS:
        raise ValueError("blocks find every pair only up to 3 differing bits")
    found = written(fingerprints(docs, words), "fingerprints")
    nodes = written(found.groupBy("fp").agg(F.min("key").alias("least")), "nodes")
    up = components(link(nodes, radius)).select(F.col("u").alias("fp"), F.col("v").alias("top"))
    topped = nodes.join(up, "fp", "left").withColumn("top", F.coalesce("top", "fp"))
    named = written(topped, "tops")
    least = named.groupBy("top").agg(F.min("least").alias("component_id"))
    of_fp = named.join(least, "top").select("fp", "component_id")
    back = lambda c: F.when(F.col(c) != NO_ID, F.col(c)).alias("doc_id" if c == "key" else c)
    return found.join(of_fp, "fp").select(back("key"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), back("component_id"))


def expected_share(similarity: float) -> float:
    """Share of bits in which texts of this Jaccard similarity differ, about."""
    return math.acos(2 * similarity / (1 + similarity)) / math.pi


def draws(n: int, share: float) -> tuple[int, int]:
    """Bits of a drawn shard key, and how many keys a code gets."""
    bits = min(24, max(8, math.ceil(math.log2(max(1, n) / 64))))
    return bits, math.ceil(math.log(1 - MEET) / math.log(1 - (1 - share) ** bits))


def similar_groups(docs: DataFrame, words: int = 5, similarity: float = 0.8) -> DataFrame:
    """least, component_id: for the smallest doc_id of each distinct set of shingles
    the smallest of all it is linked with (keys as in fingerprints(), never null)."""
    small_batches(docs.sparkSession)
    share, width = expected_share(similarity), 64 * WIDE
    radius = int(width * share + 2 * math.sqrt(width * share * (1 - share)))
    nodes = written(_sets(docs, words, similarity), "wide")
    n = nodes.count()
    bits, times = draws(n, share)
    chosen = np.stack([np.random.default_rng([SEED, i]).permutation(width)[:bits] for i in range(times)])
    shards = max(1, n * times // 20_000)

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = np.frombuffer(b"".join(batch.column("fp").to_pylist()), np.uint8).reshape(-1, 8 * WIDE)
            ones = np.unpackbits(codes, axis=1, bitorder="little").astype(np.int64)
            for i, at in enumerate(chosen):
                key = (np.int64(i) << 32) | (ones[:, at] << np.arange(bits)).sum(axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(key), batch.column("node"), batch.column("fp")], ["drawn", "node", "fp"])

    def linked(key: tuple, found: pa.Table) -> pa.Table:
        drawn, node = found.column("drawn").to_numpy(), found.column("node").to_numpy()
        codes = np.frombuffer(b"".join(found.column("fp").to_pylist()), np.uint64).reshape(-1, WIDE)
        order = np.lexsort((node, drawn))
        edges = np.append(np.flatnonzero(np.append(True, np.diff(drawn[order]) != 0)), len(order))
        low, high = [], []
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            if b - a > 1:
                of = order[a:b]
                i, j = Links(codes[of], radius).candidates()
                low.append(node[of[i]])
                high.append(node[of[j]])
        trim()
        return pa.table([pa.array(np.concatenate(x) if x else np.zeros(0, np.int64)) for x in (low, high)], ["u", "v"])

    spread = nodes.select("node", "fp").mapInArrow(dealt, "drawn long, node long, fp binary")
    spread = spread.withColumn("shard", F.pmod(F.xxhash64("drawn"), F.lit(shards)))
    near = spread.groupBy("shard").applyInArrow(linked, "u long, v long").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    pairs = written(plausible(near, nodes, similarity), "pairs")
    sure = written(alike(docs, pairs, words, similarity), "sure")
    grouped = written(_topped(nodes, components(sure)).withColumnRenamed("component_id", "grouped"), "grouped")
    rest = written(plausible(candidates(grouped, similarity), grouped, similarity), "rest")
    more = written(alike(docs, rest, words, similarity), "more")
    out = _topped(nodes.select("node"), components(sure.union(more))).withColumnRenamed("node", "least")
    release(pairs, rest, grouped)
    return out


def _sets(docs: DataFrame, words: int, similarity: float) -> DataFrame:
    """A node for each distinct set of shingles: the smallest doc_id that has it, its
    wide fingerprint, size, prefix and bitmap."""
    own = keyed(docs)
    ordered = Order(frequent(own, total_bytes(own), lambda raw: np.unique(shingle_hashes(raw, words))))

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            sets = [np.unique(shingle_hashes(t.encode(), words)) for t in batch.column("text").to_pylist()]
            columns = [
                pa.array([wide_fingerprint(x) for x in sets], pa.binary()),
                pa.array([xxhash.xxh3_128_digest(x.tobytes()) for x in sets], pa.binary()),
                pa.array([len(x) for x in sets], pa.int32()),
                pa.array([ordered.prefix(x, similarity).tobytes() for x in sets], pa.binary()),
                pa.array([bitmap(x) for x in sets], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["key", "fp", "same", "size", "prefix", "bitmap"])

    found = own.mapInArrow(marked, "key long, fp binary, same binary, size int, prefix binary, bitmap binary")
    firsts = (F.first(c).alias(c) for c in ("size", "prefix", "bitmap"))
    return found.groupBy("fp", "same").agg(F.min("key").alias("node"), *firsts).drop("same")


def _topped(nodes: DataFrame, up: DataFrame) -> DataFrame:
    return nodes.join(up, nodes["node"] == up["u"], "left").withColumn("component_id", F.coalesce("v", "node")).drop("u", "v")


def jaccard(a: bytes, b: bytes, words: int) -> float:
    """Of the distinct shingles; two texts without words are equal."""
    x, y = (set(shingle_hashes(t, words).tolist()) for t in (a, b))
    return len(x & y) / len(x | y) if x or y else 1.0


def alike(docs: DataFrame, pairs: DataFrame, words: int, similarity: float) -> DataFrame:
    """The pairs u, v of doc_ids whose texts have at least this Jaccard similarity.
    Only texts that some pair names are moved, once, and then joined to the pairs."""
    named = broadcast_if_small(pairs.select(F.explode(F.array("u", "v")).alias("id")).distinct())
    own = keyed(docs)
    texts = written(own.join(named, own["doc_id"] == named["id"], "left_semi").groupBy("doc_id").agg(F.min("text").alias("text")), "named")
    left, right = texts.select(F.col("doc_id").alias("u"), F.col("text").alias("a")), texts.select(F.col("doc_id").alias("v"), F.col("text").alias("b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "a"):
            kept = [jaccard(x.encode(), y.encode(), words) >= similarity for x, y in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True)]
            yield batch.filter(pa.array(kept, pa.bool_())).select(["u", "v"])

    return pairs.join(left, "u").join(right, "v").select("u", "v", "a", "b").mapInArrow(run, "u long, v long")


def dedup(docs: DataFrame, words: int = 5, similarity: float = 0.8) -> DataFrame:
    """The documents with the smallest doc_id of each group, unchanged. Few ids go as a
    rule, so they are what is sent to the documents, which then need not move."""
    least = similar_groups(docs, words, similarity).where("least = component_id").select("least")
    name = fresh(docs, "gone")
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))
    ids = docs.select(key.alias("key")).distinct()
    gone = broadcast_if_small(ids.join(least, F.col("key") == F.col("least"), "left_anti").select(F.col("key").alias(name)))
    return docs.join(gone, key == F.col(name), "left_anti")
