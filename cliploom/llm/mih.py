"""Approximate nearest neighbours by multi-index hashing.

Codes: vectors, scaled to length one and centred, are rotated so that the signs
of their coordinates lose least (iterated between signs and rotation, from the
principal directions), one bit a direction, at most 64. The rotation and the
Hamming radius are learned on a sample of at most `FIT_ROWS` vectors; the radius
holds `COVER` of the sample's own true neighbours, which lie farther apart than
those of the whole table.

Index: a shard of codes is split into substrings of about log2(rows) bits, each with
a table from value to rows. Codes within radius r agree within r // m bits on one of
m substrings (pigeonhole), so probing those values finds every one; codes beyond r
are dropped by their distance, and the rest is ranked by the exact cosine in double
precision. The radius of a query grows until it has `k` candidates or all.

One task owns a shard: it gathers the shard's rows, builds the index once, and the
queries stream past it batch by batch, so that a row moves once and a query once for
each shard. Up to `SHARDS` shards hold `SHARD_ROWS` rows or more; larger tables get
larger shards, up to `SHARD_BYTES` of vectors, which keeps the number of times that
queries move small, and only then more of them. Rows are dealt by their number, so
copies of one vector spread over all shards.

Defined results: vectors that are null, zero, of another length than most, or with
null or non-finite components, and rows with a null vec_id, take no part. Every row
is known by its own number: a query finds all rows but itself, also others with its
vec_id or its vector, and rows that repeat a vec_id ask each. Ties go to the smaller
vec_id. Only vec_id and embedding are read, so other columns may have any name.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import small_batches, written

FIT_ROWS, COVER, ASKED = 8192, 0.97, 256
SHARD_ROWS, SHARDS, SHARD_BYTES = 8192, 64, 64 << 20
MOST_BITS = 64
FOUND = "asks long, query_id long, vec_id long, score double"


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and v of the rows whose vector is whole and not zero, of any length."""
    real = isinstance(vectors.schema["embedding"].dataType.elementType, T.FloatType)
    rows = vectors.where("vec_id is not null").select(F.col("vec_id").cast("long"), F.col("embedding").cast(f"array<{'float' if real else 'double'}>").alias("v"))
    whole = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where(F.coalesce(whole & F.exists("v", lambda x: x != 0), F.lit(False)))


def usual_length(rows: DataFrame) -> int:
    """The length that most vectors have, the larger of equals; 0 of no rows."""
    size = rows.groupBy(F.size("v").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    return size["size"] if size else 0


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


class Codes:
    """The learned rotation and radius."""

    def __init__(self, sample: np.ndarray, k: int, rounds: int = 30):
        x = _unit(sample)
        self.mean = x.mean(axis=0)
        bits = min(MOST_BITS, x.shape[1])
        centred = x - self.mean
        _, directions = np.linalg.eigh(centred.T @ centred)
        main = directions[:, ::-1][:, :bits]
        low = centred @ main
        turn = np.linalg.qr(np.random.default_rng(3).normal(size=(bits, bits)))[0]
        for _ in range(rounds):
            u, _, vt = np.linalg.svd(np.where(low @ turn > 0, 1.0, -1.0).T @ low)
            turn = (u @ vt).T
        self.matrix, self.bits = main @ turn, bits
        asked = x[:ASKED]
        near = asked @ x.T
        near[np.arange(len(asked)), np.arange(len(asked))] = -2
        k = min(k, len(x) - 1)
        codes = self.of(sample)
        best = np.argpartition(-near, k - 1, axis=1)[:, :k] if k > 0 else np.zeros((len(asked), 0), np.int64)
        far = np.bitwise_count(codes[:ASKED, None] ^ codes[best])
        self.radius = int(np.quantile(far, COVER)) if far.size else bits

    def of(self, x: np.ndarray) -> np.ndarray:
        positive = (_unit(x) - self.mean) @ self.matrix > 0
        packed = np.packbits(positive, axis=1, bitorder="little")
        return np.pad(packed, ((0, 0), (0, 8 - packed.shape[1]))).copy().view("<u8")[:, 0]


class MultiIndex:
    """Substring tables over the codes of one shard."""

    def __init__(self, codes: np.ndarray, bits: int):
        self.codes, self.bits = codes, bits
        wide = max(1, min(16, round(math.log2(max(2, len(codes))))))
        m = max(1, round(bits / wide))
        edges = [round(i * bits / m) for i in range(m + 1)]
        self.parts = [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]
        self.tables = []
        for at, size in self.parts:
            value = self.sub(codes, at, size)
            first = np.zeros((1 << size) + 1, np.int64)
            np.cumsum(np.bincount(value, minlength=1 << size), out=first[1:])
            self.tables.append((np.argsort(value, kind="stable"), first))
        self.flips: dict[tuple[int, int], np.ndarray] = {}

    @staticmethod
    def sub(codes, at: int, size: int):
        return ((codes >> np.uint64(at)) & np.uint64((1 << size) - 1)).astype(np.int64)

    def masks(self, size: int, most: int) -> np.ndarray:
        if (size, most) not in self.flips:
            if most >= size:
                self.flips[size, most] = np.arange(1 << size)
            else:
                chosen = (on for n in range(most + 1) for on in combinations(range(size), n))
                self.flips[size, most] = np.asarray([sum(1 << i for i in on) for on in chosen], np.int64)
        return self.flips[size, most]

    def within(self, code: np.uint64, radius: int) -> np.ndarray:
        """Rows of every code within the radius."""
        seen = np.zeros(len(self.codes), bool)
        for (at, size), (rows, first) in zip(self.parts, self.tables, strict=True):
            values = self.masks(size, radius // len(self.parts)) ^ int(self.sub(code, at, size))
            low, n = first[values], first[values + 1] - first[values]
            low, n = low[n > 0], n[n > 0]
            spots = np.repeat(low - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
            seen[rows[spots]] = True
        found = np.flatnonzero(seen)
        return found[np.bitwise_count(self.codes[found] ^ code) <= radius]


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), -1).astype(np.float64)


class Shard:
    """The rows of one shard and their index."""

    def __init__(self, parts: list[pa.RecordBatch], model: Codes):
        rows = pa.Table.from_batches(parts)
        self.row, self.vec_id = rows.column("row").to_numpy(), rows.column("vec_id").to_numpy()
        vectors = _matrix(rows.column("v"))
        self.units, self.model = _unit(vectors), model
        self.index = MultiIndex(model.of(vectors), model.bits)

    def nearest(self, row: int, code: np.uint64, own: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """vec_ids and scores of up to k rows that are not the query's own."""
        others = len(self.row) - int((self.row == row).sum())
        radius = self.model.radius
        while True:
            found = self.index.within(code, radius)
            found = found[self.row[found] != row]
            if len(found) >= min(k, others) or radius >= self.model.bits:
                break
            radius += len(self.index.tables)
        score = (self.units[found] * own).sum(axis=1)
        best = np.lexsort((self.vec_id[found], -score))[:k]
        return self.vec_id[found[best]], score[best]


def _shards(n: int, width: int) -> int:
    per = max(SHARD_ROWS, min(math.ceil(n / SHARDS), SHARD_BYTES // (8 * max(1, width))))
    return math.ceil(n / per)


def nearest(vectors: DataFrame, asking: Column, k: int = 5) -> DataFrame:
    """query_id, rank, vec_id, score of the rows for which `asking`, a condition over
    vec_id, holds: the k nearest other rows of each."""
    spark = vectors.sparkSession
    small_batches(spark)
    whole = usable(vectors)
    width = usual_length(whole)
    rows = written(whole.where(F.size("v") == width).withColumn("row", F.monotonically_increasing_id()), "vectors")
    n = rows.count()
    if n < 2:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    draw = F.pmod(F.xxhash64("row"), F.lit(1 << 30))
    thin = rows.where(draw < int(min(1.0, (2 * FIT_ROWS + 100) / n) * (1 << 30)))
    model = Codes(_matrix(thin.orderBy(draw, "row").limit(FIT_ROWS).toArrow().column("v")), k)
    shards = _shards(n, width)
    shard = F.pmod(F.xxhash64("row", F.lit(1)), F.lit(shards))
    index = rows.select(shard.alias("shard"), F.lit(False).alias("asks"), "row", "vec_id", "v")
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long")))
    ask = rows.where(asking).select(every.alias("shard"), F.lit(True).alias("asks"), "row", "vec_id", "v")
    met = index.union(ask).repartition(shards, "shard").sortWithinPartitions("shard", "asks")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of a shard come first, then the queries that ask it."""
        held, at, built = [], None, None
        for whole in batches:
            number, asks = whole.column("shard").to_numpy(), whole.column("asks").to_numpy(zero_copy_only=False)
            kinds = 2 * number + asks
            edges = np.flatnonzero(np.append(True, np.diff(kinds) != 0)).tolist()
            for a, b in zip(edges, [*edges[1:], len(kinds)], strict=True):
                part = whole.slice(a, b - a)
                if number[a] != at:
                    held, at, built = [], number[a], None
                if not asks[a]:
                    held.append(part)
                elif held:
                    built = built or Shard(held, model)
                    yield _answers(part, built, k)

    found = met.mapInArrow(search, FOUND)
    order = Window.partitionBy("asks").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _answers(asking: pa.RecordBatch, shard: Shard, k: int) -> pa.RecordBatch:
    asked = _matrix(asking.column("v"))
    rows, ids = asking.column("row").to_numpy(), asking.column("vec_id").to_numpy()
    got = [shard.nearest(*x, k) for x in zip(rows.tolist(), shard.model.of(asked), _unit(asked), strict=True)]
    sizes = [len(found) for found, _ in got]
    columns = [np.repeat(rows, sizes), np.repeat(ids, sizes), *(np.concatenate([g[i] for g in got]) for i in (0, 1))]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["asks", "query_id", "vec_id", "score"])


def self_search(vectors: DataFrame, every: int = 50, k: int = 5) -> DataFrame:
    """The rows whose vec_id is divisible by `every`, against all rows."""
    return nearest(vectors, F.col("vec_id") % every == 0, k)
