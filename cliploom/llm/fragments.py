"""Repeated windows of texts, found by content-defined fragments.

A window is `k` consecutive symbols of one document. Its minimiser is the
leftmost smallest hash of its `m`-grams. Consecutive windows that share one
occurrence of a minimiser form a fragment; it travels once, packed, to the bucket
of its minimiser. Equal windows have equal minimisers, so they meet in one bucket
whatever the documents around them, and a minimiser that only one fragment holds
proves all its windows unique.

Hot minimisers: a passage in very many documents, in different surroundings, would
fill one bucket with fragments that differ at their ends. A sample of the texts
finds such minimisers beforehand; their windows travel one by one instead, as a
128-bit digest dealt by its own value, so that only equal windows meet and equal
ones are folded before. The sample decides the route alone, never a result.

Pre-aggregation: of equal fragments in one chunk only the first goes on; the
others are known to repeat. Fragments of a chunk are packed per bucket and
compressed. Buckets are numbered by the total size of the input, so that one
stays at about `BUCKET_BYTES` however large the input is.

Order: windows are ordered by (doc_id, start). Rows that repeat a doc_id count as
one document with one start each: a window never repeats itself. A null doc_id
sorts before all others.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, small_batches, texts_of

#: Packed fragments per bucket, before compression.
BUCKET_BYTES = 4 << 20
#: Most bytes, and share, of texts in the sample; bytes that a fragment has, about; a
#: minimiser is hot if its fragments would fill a bucket, HOT_FRAGMENTS different ones
#: in the sample at least; most minimisers that are told to all tasks (8 bytes each).
SAMPLE_BYTES, SAMPLE_SHARE, FRAGMENT_BYTES, HOT_FRAGMENTS, MOST_HOT = 8 << 30, 1 / 16, 150, 32, 1 << 20
NO_ID = -(1 << 63)
MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]
BLOCK = "bucket int, doc_id long, first long, last long, packed binary"


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * MIX[3]
    return h ^ (h >> np.uint64(32))


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Smallest of each `width` neighbours."""
    if len(x) < width:
        return x[:0]
    n, span = len(x) - width + 1, 1
    while span * 2 <= width:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    return np.minimum(x[:n], x[width - span : width - span + n])


#: Bits of a position beside a hash of 40 bits.
PLACE_BITS = 24


def leftmost_least(hashes: np.ndarray, width: int) -> np.ndarray:
    """The smallest 40-bit hash of each `width` neighbours, with the lowest bits of its
    leftmost position. Positions start anew in each block, blocks overlap by a window
    less one, and no block has more positions than the bits can tell apart."""
    step = (1 << PLACE_BITS) - width + 1
    parts = []
    for a in range(0, max(1, len(hashes) - width + 1), step):
        block = hashes[a : a + step + width - 1]
        parts.append(sliding_min((block << np.uint64(24)) | np.arange(len(block), dtype=np.uint64), width))
        if a:  # positions of neighbouring blocks compare as those of the whole
            parts[-1] = (parts[-1] & ~np.uint64(0xFFFFFF)) | (((parts[-1] & np.uint64(0xFFFFFF)) + np.uint64(a)) & np.uint64(0xFFFFFF))
    return np.concatenate(parts) if len(parts) > 1 else parts[0]


def to_planes(x: np.ndarray, width: int | None = None) -> bytes:
    """Integers as one run of bytes for each of their (lowest `width`) places."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize)[:, :width].T).tobytes()


def from_planes(raw: bytes, at: int, n: int, kind: type, width: int) -> np.ndarray:
    out = np.zeros((n, np.dtype(kind).itemsize), np.uint8)
    out[:, :width] = np.frombuffer(raw, np.uint8, n * width, at).reshape(width, n).T
    return out.reshape(-1).view(kind)


#: Columns of a pack and the bytes kept of each: step of doc_id, first window,
#: windows, bytes, minimiser (24 bits beside the bucket tell almost all apart).
COLUMNS = ((np.int64, 8), (np.int32, 4), (np.int32, 4), (np.int32, 4), (np.uint32, 3))


@dataclass
class Texts:
    """Documents of a chunk as symbols: gram hashes at each symbol, the number of
    symbols of each document, and the bytes at which each symbol starts and ends."""

    raw: bytes
    grams: np.ndarray
    lengths: np.ndarray
    starts: np.ndarray | None = None  # None: a symbol is a byte
    ends: np.ndarray | None = None


def fragments_of(texts: Texts, k: int, m: int):
    """(document number, first window in the chunk, in the document, windows,
    minimiser, byte from, byte to) of each fragment, in document order."""
    n = int(texts.lengths.sum())
    if n < k or len(texts.grams) < k - m + 1:
        return None
    least = leftmost_least(mixed(texts.grams) >> np.uint64(24), k - m + 1)[: n - k + 1]
    doc_end = np.cumsum(texts.lengths)
    valid = np.ones(n + 1, bool)
    for a, b in zip(np.maximum(doc_end - k + 1, doc_end - texts.lengths).tolist(), doc_end.tolist(), strict=True):
        valid[a:b] = False
    valid = valid[: len(least)]
    if not valid.any():
        return None
    new = np.ones(len(least), bool)
    new[1:] = (least[1:] != least[:-1]) | ~valid[:-1]
    edges = np.flatnonzero(new | ~valid)
    sizes = np.diff(np.append(edges, len(least)))
    first, sizes = edges[valid[edges]], sizes[valid[edges]]
    doc = np.searchsorted(doc_end, first, "right")
    upto = first + sizes + k - 1
    at = first - (doc_end - texts.lengths)[doc]
    low = texts.starts[first] if texts.starts is not None else first
    high = texts.ends[upto - 1] if texts.ends is not None else upto
    return doc, first, at, sizes, least[first] >> np.uint64(24), low, high


def total_bytes(docs: DataFrame) -> int:
    return docs.select(F.sum(F.octet_length("text"))).first()[0] or 0


def hot_minimisers(docs: DataFrame, total: int, k: int, m: int, read: Callable[[list[bytes]], Texts]) -> np.ndarray:
    """Minimisers with many different fragments in a sample of the documents."""
    share = min(SAMPLE_SHARE, SAMPLE_BYTES / max(1, total))
    sample = docs.where(F.pmod(F.xxhash64("doc_id", F.lit(77)), F.lit(1 << 30)) < int(share * (1 << 30)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            texts = read([t.encode() for t in batch.column("text").to_pylist()])
            if (found := fragments_of(texts, k, m)) is None:
                continue
            _, _, _, _, least, low, high = found
            distinct = {texts.raw[a:b]: v for a, b, v in zip(low.tolist(), high.tolist(), least.tolist(), strict=True)}
            values, n = np.unique(np.asarray(list(distinct.values()), np.int64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(values), pa.array(n.astype(np.int64))], ["least", "n"])

    found = sample.mapInArrow(count, "least long, n long").groupBy("least").agg(F.sum("n").alias("n"))
    found = found.where(F.col("n") >= max(HOT_FRAGMENTS, int(share * BUCKET_BYTES / FRAGMENT_BYTES)))
    rows = found.orderBy(F.desc("n"), "least").limit(MOST_HOT).collect()
    return np.sort(np.asarray([r["least"] for r in rows], np.int64)).astype(np.uint64)


def digests(texts: Texts, first: np.ndarray, sizes: np.ndarray, k: int) -> tuple[np.ndarray, list[bytes]]:
    """Windows of fragments (their first symbols) and a digest of the text of each."""
    windows = np.repeat(first - np.cumsum(sizes) + sizes, sizes) + np.arange(int(sizes.sum()))
    low = texts.starts[windows] if texts.starts is not None else windows
    high = texts.ends[windows + k - 1] if texts.ends is not None else windows + k
    return windows, [xxhash.xxh3_128_digest(texts.raw[a:b]) for a, b in zip(low.tolist(), high.tolist(), strict=True)]


def repeated_windows(docs: DataFrame, total: int, k: int, m: int, read: Callable[[list[bytes]], Texts], compare: Callable) -> DataFrame:
    """Runs of windows that also start earlier: doc_id, first, last (both windows
    included). `docs`: doc_id (never null) and text, `total` bytes of it. `compare`
    gets a bucket's distinct fragments that share a minimiser with another."""
    small_batches(docs.sparkSession)
    buckets = max(8, int(total * (1 + 2 * (k - 1) / (k - m + 2)) / BUCKET_BYTES))
    hot = hot_minimisers(docs, total, k, m, read)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = zstandard.ZstdCompressor(level=5)
        for batch in chunks(batches):
            batch = batch.sort_by("doc_id")
            ids = batch.column("doc_id").to_numpy()
            texts = read([t.encode() for t in batch.column("text").to_pylist()])
            if (found := fragments_of(texts, k, m)) is None:
                continue
            doc, first, at, sizes, least, low, high = found
            alone = np.isin(least, hot)
            spread, lone_runs = _windows_alone(texts, ids, doc[alone], first[alone], at[alone], sizes[alone], k, buckets, coder)
            doc, at, sizes, least, low, high = (x[~alone] for x in (doc, at, sizes, least, low, high))
            raw, seen, mine, again = texts.raw, {}, [], []
            for i, (a, b) in enumerate(zip(low.tolist(), high.tolist(), strict=True)):
                j = seen.setdefault(raw[a:b], i)
                (mine if i == j else again).append(i)
            mine, again = np.asarray(mine, np.int64), np.asarray(again, np.int64)
            bucket = ((least * MIX[0]) >> np.uint64(32)).astype(np.int64) % buckets
            order = mine[np.argsort(bucket[mine], kind="stable")]
            parts = list(seen)
            number = np.empty(len(doc), np.int64)
            number[mine] = np.arange(len(mine))
            packs = []
            for a, b in _stretches(bucket[order]):
                of = order[a:b]
                columns = (np.diff(ids[doc[of]], prepend=0), at[of], sizes[of], (high - low)[of], least[of])
                head = [to_planes(x.astype(kind), width) for x, (kind, width) in zip(columns, COLUMNS, strict=True)]
                packs.append((bucket[of[0]], coder.compress(b"".join([np.int64(b - a).tobytes(), *head, *[parts[i] for i in number[of].tolist()]]))))
            again = again[~_same(ids, doc, at, low, high, raw, seen, again)]
            runs = _runs(*(np.append(x, y) for x, y in zip((ids[doc[again]], at[again], at[again] + sizes[again] - 1), lone_runs, strict=True)))
            packs += spread
            none, salt = [None] * len(packs), zlib.crc32(ids.tobytes()) % buckets
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([b for b, _ in packs] + ((np.arange(len(runs[0])) + salt) % buckets).tolist(), pa.int32()),
                    *(pa.array(none + x.tolist(), pa.int64()) for x in runs),
                    pa.array([p for _, p in packs] + [None] * len(runs[0]), pa.binary()),
                ],
                ["bucket", "doc_id", "first", "last", "packed"],
            )

    def meet(key: tuple, found: pa.Table) -> pa.Table:
        known = found.filter(pc.is_null(found.column("packed")))
        runs = settle([x for x in found.column("packed").to_pylist() if x is not None], compare)
        columns = [np.concatenate([known.column(c).to_numpy(), r]) for c, r in zip(("doc_id", "first", "last"), runs, strict=True)]
        return pa.table([pa.array(c, pa.int64()) for c in columns], ["doc_id", "first", "last"])

    return docs.mapInArrow(cut, BLOCK).groupBy("bucket").applyInArrow(meet, "doc_id long, first long, last long")


def _stretches(x: np.ndarray) -> list[tuple[int, int]]:
    """[from, to) of each stretch of equal values."""
    if not len(x):
        return []
    edges = np.flatnonzero(np.append(True, np.diff(x) != 0))
    return list(zip(edges.tolist(), [*edges[1:].tolist(), len(x)], strict=True))


def _windows_alone(texts: Texts, ids, doc, first, at, sizes, k: int, buckets: int, coder):
    """Packs of single windows (bucket, bytes), and those that a window of the chunk
    already stands for (doc_id, window, window). A pack of windows starts with minus
    their number."""
    windows, found = digests(texts, first, sizes, k)
    if not len(windows):
        return [], (np.zeros(0, np.int64),) * 3
    owner = ids[np.repeat(doc, sizes)]
    place = windows - np.repeat(first - at, sizes)
    keys = np.frombuffer(b"".join(found), "<u8").reshape(-1, 2)
    order = np.lexsort((place, owner, keys[:, 1], keys[:, 0]))
    keys, owner, place = keys[order], owner[order], place[order]
    head = np.append(True, (keys[1:] != keys[:-1]).any(axis=1))
    of = np.cumsum(head) - 1
    later = (owner != owner[head][of]) | (place != place[head][of])
    lone = owner[later], place[later], place[later]
    keys, owner, place = keys[head], owner[head], place[head]
    bucket = (keys[:, 0] >> np.uint64(16)).astype(np.int64) % buckets
    order = np.argsort(bucket, kind="stable")
    packs = []
    for a, b in _stretches(bucket[order]):
        of = order[a:b]
        packs.append((int(bucket[of[0]]), coder.compress(b"".join([np.int64(a - b).tobytes(), keys[of].tobytes(), to_planes(owner[of].astype(np.int64)), to_planes(place[of].astype(np.int64))]))))
    return packs, lone


def _settle_alone(packs: list[bytes]) -> np.ndarray:
    """Single windows that repeat an earlier one: rows of doc_id, window, window."""
    keys, owner, place = [], [], []
    for raw in packs:
        n = -int(np.frombuffer(raw, np.int64, 1)[0])
        keys.append(np.frombuffer(raw, "<u8", 2 * n, 8).reshape(-1, 2))
        owner.append(from_planes(raw, 8 + 16 * n, n, np.int64, 8))
        place.append(from_planes(raw, 8 + 24 * n, n, np.int64, 8))
    if not packs:
        return np.zeros((0, 3), np.int64)
    keys, owner, place = np.concatenate(keys), np.concatenate(owner), np.concatenate(place)
    order = np.lexsort((place, owner, keys[:, 1], keys[:, 0]))
    keys, owner, place = keys[order], owner[order], place[order]
    head = np.append(True, (keys[1:] != keys[:-1]).any(axis=1))
    of = np.cumsum(head) - 1
    later = (owner != owner[head][of]) | (place != place[head][of])
    return np.stack([owner[later], place[later], place[later]], axis=1)


def _same(ids, doc, at, low, high, raw, seen, again) -> np.ndarray:
    """Whether the first of its equals is the very same (doc_id, start), as happens
    where a row is repeated."""
    firsts = np.asarray([seen[raw[a:b]] for a, b in zip(low[again].tolist(), high[again].tolist(), strict=True)], np.int64)
    return (ids[doc[firsts]] == ids[doc[again]]) & (at[firsts] == at[again])


def _runs(doc: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Neighbouring or overlapping runs of windows as one."""
    if not len(doc):
        return (np.zeros(0, np.int64),) * 3
    order = np.lexsort((last, first, doc))
    doc, first, last = doc[order], first[order], last[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (first[1:] > last[:-1] + 1)
    at = np.flatnonzero(new)
    return doc[at], first[at], np.maximum.reduceat(last, at)


def settle(packs: list[bytes], compare: Callable) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of a bucket's windows that repeat an earlier one."""
    decoder = zstandard.ZstdDecompressor()
    heads, bodies, offset, offsets, single = [], [], 0, [], []
    for pack in packs:
        raw = decoder.decompress(pack)
        if np.frombuffer(raw, np.int64, 1)[0] < 0:
            single.append(raw)
            continue
        n = int(np.frombuffer(raw, np.int64, 1)[0])
        at, columns = 8, []
        for kind, width in COLUMNS:
            columns.append(from_planes(raw, at, n, kind, width))
            at += n * width
        columns[0] = np.cumsum(columns[0])
        heads.append(columns)
        bodies.append(raw[at:])
        offsets.append(offset + np.concatenate([[0], np.cumsum(columns[3], dtype=np.int64)[:-1]]))
        offset += len(raw) - at
    lone = _settle_alone(single)
    if not heads:
        return _runs(*lone.T)
    doc, at, sizes, lengths, least = (np.concatenate([h[i] for h in heads]) for i in range(5))
    at = at.astype(np.int64)
    low, body = np.concatenate(offsets), b"".join(bodies)
    order = np.lexsort((at, doc, least))
    edge = np.append(True, np.diff(least[order].astype(np.int64)) != 0)
    shared = ~(edge & np.append(edge[1:], True))  # its minimiser is in another fragment too
    marks, kept = [], []
    texts: dict[bytes, int] = {}
    for i in order[shared].tolist():
        text = body[low[i] : low[i] + lengths[i]]
        j = texts.setdefault(text, i)
        if i == j:
            kept.append(i)
        elif doc[i] != doc[j] or at[i] != at[j]:
            marks.append((doc[i], at[i], at[i] + sizes[i] - 1))
    kept = np.asarray(kept, np.int64)
    if len(kept) > 1:
        edge = np.append(True, np.diff(least[kept].astype(np.int64)) != 0)
        partner = ~(edge & np.append(edge[1:], True))
        group = np.cumsum(edge)[partner]
        parts = list(texts)
        use = np.flatnonzero(partner)
        if len(use):
            found = compare([parts[i] for i in use.tolist()], doc[kept[use]], at[kept[use]], sizes[kept[use]], group)
            marks += list(zip(*(x.tolist() for x in found), strict=True))
    cols = np.concatenate([np.asarray(marks, np.int64).reshape(-1, 3), lone])
    return _runs(cols[:, 0], cols[:, 1], cols[:, 2])


#: Bytes of text whose documents are finished together.
FINISH_BYTES = 16 << 20


def finish(
    docs: DataFrame,
    total: int,
    runs: DataFrame,
    one: Callable[[bytes, list[tuple[int, int]]], tuple],
    k: int,
    schema: list[tuple[str, pa.DataType, str]],
) -> DataFrame:
    """key and one(text, stretches of symbols that repeated windows cover) for every
    document. Texts travel packed and compressed, a block for each group of ids."""
    groups = max(8, total // FINISH_BYTES)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = zstandard.ZstdCompressor(level=3)
        for batch in chunks(batches):
            group, ids, texts = batch.column("group").to_numpy(), batch.column("doc_id").to_numpy(), batch.column("text").to_pylist()
            order = np.argsort(group, kind="stable")
            edges = np.flatnonzero(np.append(True, np.diff(group[order]) != 0))
            packs = []
            for a, b in zip(edges.tolist(), [*edges[1:].tolist(), len(order)], strict=True):
                raws = [texts[i].encode() for i in order[a:b].tolist()]
                head = [np.int64(b - a), ids[order[a:b]], np.asarray([len(r) for r in raws], np.int64)]
                packs.append(coder.compress(b"".join([x.tobytes() for x in head] + raws)))
            yield pa.RecordBatch.from_arrays([pa.array(group[order[edges]]), pa.array(packs, pa.binary())], ["group", "packed"])

    def join(key: tuple, texts: pa.Table, found: pa.Table) -> pa.Table:
        decoder = zstandard.ZstdDecompressor()
        order = np.lexsort((found.column("first").to_numpy(), ids := found.column("doc_id").to_numpy()))
        ids, first, last = ids[order], found.column("first").to_numpy()[order], found.column("last").to_numpy()[order]
        rows: list[tuple] = []
        for pack in texts.column("packed").to_pylist():
            raw = decoder.decompress(pack)
            n = int(np.frombuffer(raw, np.int64, 1)[0])
            keys, sizes = np.frombuffer(raw, np.int64, n, 8), np.frombuffer(raw, np.int64, n, 8 + 8 * n)
            low, high = np.searchsorted(ids, keys, "left").tolist(), np.searchsorted(ids, keys, "right").tolist()
            at = 8 + 16 * n
            for key_of, size, a, b in zip(keys.tolist(), sizes.tolist(), low, high, strict=True):
                rows.append((key_of, *one(raw[at : at + size], covered(first[a:b].tolist(), last[a:b].tolist(), k))))
                at += size
        kinds = [pa.int64(), *(kind for _, kind, _ in schema)]
        return pa.table([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], ["key", *(name for name, _, _ in schema)])

    of = F.pmod(F.xxhash64("doc_id"), F.lit(groups))
    blocks = docs.withColumn("group", of).mapInArrow(packed, "group long, packed binary").groupBy("group")
    ddl = ", ".join(["key long", *(f"{name} {kind}" for name, _, kind in schema)])
    out = blocks.cogroup(runs.withColumn("group", of).groupBy("group")).applyInArrow(join, ddl)
    return out.select(F.when(F.col("key") != NO_ID, F.col("key")).alias("doc_id"), *(name for name, _, _ in schema))


def keyed(docs: DataFrame) -> DataFrame:
    return texts_of(docs).withColumn("doc_id", F.coalesce("doc_id", F.lit(NO_ID)))


def covered(first: list[int], last: list[int], k: int) -> list[tuple[int, int]]:
    """Maximal stretches [from, to) of symbols that runs of windows cover; the runs
    come by their first window."""
    out: list[tuple[int, int]] = []
    for a, b in zip(first, last, strict=True):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b + k))
        else:
            out.append((a, b + k))
    return out
