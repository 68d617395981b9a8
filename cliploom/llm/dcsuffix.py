"""Substring dedup over bytes with difference-cover suffix arrays.

Texts are dealt out by content (fragments.py), so that equal `LENGTH`-byte
strings meet in one bucket whatever surrounds them; the suffixes of a bucket are
then sorted by the difference-cover algorithm modulo 3: triples at positions 1
and 2 modulo 3 are sorted and named, the string of names is solved by recursion
while names repeat, the remaining suffixes are sorted by their first symbol and
the rank of the next sampled suffix, and both are merged. Neighbours in the
suffix array with the same first `LENGTH` bytes are equal strings: the first by
(doc_id, start) stays, and every byte that one of the others covers is removed.
Strings of hot minimisers are not suffix-sorted: they travel singly and are settled by
128-bit digests (fragments.py).

Sorting triples of the whole corpus at once would move over 16 bytes for each
byte of text and level of the recursion; dealt out by content first, a text moves
about three times, compressed.

Defined results: null counts as empty; texts under `LENGTH` bytes lose nothing;
matches never cross documents; a table without rows gives none; repeated rows:
see fragments.py.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .fragments import MIX, Texts, finish, keyed, repeated_windows, total_bytes

LENGTH, GRAM = 100, 16
#: Bytes whose suffixes are sorted together, unless one minimiser has more.
SORTED_BYTES = 1 << 19


def dense(x: np.ndarray) -> np.ndarray:
    """Ranks of values, equal ones alike, from 1."""
    order = np.argsort(x, kind="stable")
    ranks = np.empty(len(x), np.int64)
    ranks[order] = np.cumsum(np.append(True, np.diff(x[order]) != 0))
    return ranks


def pairs(*columns: tuple[np.ndarray, ...]) -> list[np.ndarray]:
    """One integer for each row of columns, ordered as the rows are; the given
    tables (of equally many columns) become comparable with each other."""
    out = [t[0].astype(np.int64) for t in columns]
    for i in range(1, len(columns[0])):
        nexts = [t[i].astype(np.int64) for t in columns]
        high = max((int(x.max()) for x in nexts if len(x)), default=0) + 1
        most = max((int(x.max()) for x in out if len(x)), default=0) + 1
        if most * high >= 1 << 62:
            cuts = np.cumsum([len(x) for x in out])[:-1]
            out = np.split(dense(np.concatenate(out)), cuts)
        out = [a * high + b for a, b in zip(out, nexts, strict=True)]
    return out


def by_symbol(symbols: np.ndarray) -> np.ndarray:
    """A stable order; small symbols are sorted by radix."""
    if len(symbols) and symbols.max() < 1 << 16:
        return np.argsort(symbols.astype(np.uint16), kind="stable")
    return np.argsort(symbols.astype(np.int64) * len(symbols) + np.arange(len(symbols)))


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Starts of the suffixes of s, in order. Values are 1 or more."""
    n = len(s)
    if n < 8:
        return np.asarray(sorted(range(n), key=lambda i: s[i:].tolist()), np.int64)
    t = np.zeros(n + 3, np.int64)
    t[:n] = s
    ones = np.arange(1, n + (n % 3 == 1), 3)
    twos = np.arange(2, n, 3)
    sample = np.concatenate([ones, twos])
    after = t[sample + 1], t[sample + 2]
    (triple,) = pairs((t[sample], *after))
    order = np.argsort(triple)
    fresh = np.append(True, np.diff(triple[order]) != 0)
    if not fresh.all():
        names = np.empty(len(sample), np.int64)
        names[order] = np.cumsum(fresh)
        order = suffix_array(names)
    first_kind = order < len(ones)
    sampled = sample[order]
    rank = np.zeros(n + 4, np.int64)
    rank[sampled] = np.arange(1, len(sampled) + 1)
    first, second = sampled[first_kind], sampled[~first_kind]
    rest = first - 1  # the others, by the rank of what follows
    rest = rest[by_symbol(t[rest])]
    symbol, following = t[rest], t[rest + 1]
    a1, b1 = pairs((symbol, rank[rest + 1]), (t[first], rank[first + 1]))
    a2, b2 = pairs((symbol, following, rank[rest + 2]), (t[second], t[second + 1], rank[second + 2]))
    at = np.arange(len(rest)) + np.searchsorted(b1, a1) + np.searchsorted(b2, a2)
    out = np.empty(len(rest) + len(sampled), np.int64)
    taken = np.zeros(len(out), bool)
    out[at] = rest
    taken[at] = True
    out[~taken] = sampled
    return out[out < n]


def equal_next(raw: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """Whether each start in `order` and the next have the same `length` bytes."""
    words = np.zeros(len(raw), np.uint64)
    padded = np.concatenate([raw, np.zeros(16, np.uint8)]).tobytes()
    for j in range(8):
        part = np.frombuffer(padded, "<u8", (len(raw) - j + 7) // 8 if len(raw) > j else 0, j)
        words[j::8] = part[: len(words[j::8])]
    left = np.arange(len(order) - 1)
    for at in [*range(0, length - 7, 8), length - 8]:
        left = left[words[order[left] + at] == words[order[left + 1] + at]]
    out = np.zeros(max(0, len(order) - 1), bool)
    out[left] = True
    return out


def adjacent_prefixes(parts: list[bytes], doc, at, sizes, group) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows of the fragments that repeat an earlier one (doc, window, window)."""
    lengths = np.asarray([len(p) + 1 for p in parts], np.int64)
    marked = [np.zeros((2, 0), np.int64)]
    starts = np.flatnonzero(np.append(True, np.diff(group) != 0))
    cuts, held = [0], 0
    sums = np.append(np.add.reduceat(lengths, starts), 0)
    for g, size in zip([*starts.tolist(), len(parts)], sums.tolist(), strict=True):
        if held and (held + size > SORTED_BYTES or g == len(parts)):
            cuts.append(g)
            held = 0
        held += size
    for lo, hi in zip(cuts, cuts[1:], strict=False):
        raw = np.frombuffer(b"\0".join(parts[lo:hi]) + b"\0", np.uint8)
        symbols = raw.astype(np.int64) + 2
        low = np.cumsum(lengths[lo:hi]) - lengths[lo:hi]
        symbols[low + lengths[lo:hi] - 1] = 1
        order = suffix_array(symbols)
        whole = np.zeros(len(raw) + 1, np.int64)  # starts with LENGTH bytes of one fragment after them
        whole[low] += 1
        whole[low + lengths[lo:hi] - LENGTH] -= 1
        order = order[np.cumsum(whole)[:-1][order] > 0]
        if len(order) < 2:
            continue
        same = equal_next(raw, order, LENGTH)
        heads = np.flatnonzero(np.append(True, ~same))
        part = np.searchsorted(low, order, "right") - 1
        of, where = doc[lo:hi][part], at[lo:hi][part] + order - low[part]
        run = np.repeat(np.arange(len(heads)), np.diff(np.append(heads, len(order))))
        by = np.lexsort((where, of, run))
        of, where, run = of[by], where[by], run[by]
        first_of, first_where = of[heads][run], where[heads][run]
        later = (of != first_of) | (where != first_where)
        marked.append(np.stack([of[later], where[later]]))
    found = np.concatenate(marked, axis=1)
    return found[0], found[1], found[1]


def read_bytes(raws: list[bytes]) -> Texts:
    raw = b"".join(raws)
    eight = np.empty(max(0, len(raw) - 7), np.uint64)
    for j in range(8):
        slot = eight[j::8]
        slot[:] = np.frombuffer(raw, "<u8", len(slot), j) if len(slot) else 0
    n = max(0, len(raw) - GRAM + 1)
    after = eight[GRAM - 8 : GRAM - 8 + n]
    grams = eight[:n] * MIX[0] + (after ^ (after >> np.uint64(31))) * MIX[1]
    return Texts(raw, grams, np.asarray([len(r) for r in raws], np.int64))


def kept_bytes(docs: DataFrame, texts: bool = False) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, and
    kept (the bytes that stay) if `texts`."""
    found = keyed(docs)
    total = total_bytes(found)

    def one(raw: bytes, stretches: list[tuple[int, int]]) -> tuple:
        parts, at = [], 0
        for a, b in stretches:
            parts.append(raw[at:a])
            at = b
        kept = b"".join([*parts, raw[at:]])
        return (len(raw), len(raw) - len(kept), len(stretches), hashlib.sha256(kept).hexdigest(), *([kept] if texts else ()))

    schema = [("n_bytes", pa.int64(), "long"), ("n_removed", pa.int64(), "long"), ("n_spans", pa.int64(), "long"), ("kept_sha256", pa.string(), "string"), ("kept", pa.binary(), "binary")]
    runs = repeated_windows(found, total, LENGTH, GRAM, read_bytes, adjacent_prefixes)
    return finish(found, total, runs, one, LENGTH, schema if texts else schema[:4])
