"""Substring dedup over words with super-k-mer partitioning.

Consecutive windows of `k` words that share a minimiser travel as one packed
string to its bucket (fragments.py). There the windows of all packed strings are
sorted, so that equal ones are neighbours: the first of them by (doc_id, start)
stays and the others are marked, exactly, by their text. Every word that a marked
window covers is removed. Windows of hot minimisers are not packed or sorted by text:
they travel singly and are settled by 128-bit digests (fragments.py).

Words are runs of bytes other than space and 0x09 to 0x0D, unchanged. Defined
results: null or empty text and texts of fewer than `k` words lose nothing; a
table without rows gives none; repeated rows: see fragments.py.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .fragments import MIX, Texts, finish, keyed, repeated_windows, total_bytes

WORDS, GRAM = 20, 3
_BASE = np.uint64(0x5851F42D4C957F2D)
_INVERSE = np.uint64(pow(0x5851F42D4C957F2D, -1, 1 << 64))
_TABLE = np.random.default_rng(11).integers(0, 1 << 64, 256, np.uint64)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def read_words(raws: list[bytes]) -> Texts:
    split = [r.split() for r in raws]
    raw = b" ".join([b" ".join(words) for words in split if words])
    lengths = np.asarray([len(words) for words in split], np.int64)
    if not raw:
        return Texts(b"", np.zeros(0, np.uint64), lengths)
    letters = np.frombuffer(raw, np.uint8)
    gaps = np.flatnonzero(letters == 32)
    starts, ends = np.append(0, gaps + 1), np.append(gaps, len(raw))
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_TABLE[letters] * _powers(_BASE, len(raw)), dtype=np.uint64, out=sums[1:])
    words = (sums[ends] - sums[starts]) * _powers(_INVERSE, len(raw))[starts]
    words = (words ^ (words >> np.uint64(31))) * MIX[1]
    n = max(0, len(words) - GRAM + 1)
    grams = sum((np.roll(words, -i)[:n] * MIX[i] + (words[i : i + n] >> np.uint64(17)) * MIX[(i + 1) % 4] for i in range(GRAM)), np.zeros(n, np.uint64))
    return Texts(raw, grams, lengths, starts, ends)


def sort_windows(parts: list[bytes], doc, at, sizes, group) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorts the windows of packed strings; those after the first of their equals."""
    windows = []
    for text, d, a, n in zip(parts, doc.tolist(), at.tolist(), sizes.tolist(), strict=True):
        edges = [0]
        for word in text.split(b" "):
            edges.append(edges[-1] + len(word) + 1)
        windows += [(text[edges[i] : edges[i + WORDS] - 1], d, a + i) for i in range(n)]
    windows.sort()
    last, marked = None, []
    for window, d, a in windows:
        if window != last:
            last, first = window, (d, a)
        elif (d, a) != first:
            marked.append((d, a))
    cols = np.asarray(marked, np.int64).reshape(-1, 2)
    return cols[:, 0], cols[:, 1], cols[:, 1]


def kept_words(docs: DataFrame, texts: bool = True) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256, and kept (the
    words that stay) if `texts`."""
    found = keyed(docs)
    total = total_bytes(found)

    def one(raw: bytes, stretches: list[tuple[int, int]]) -> tuple:
        words = raw.split()
        n = len(words)
        for a, b in reversed(stretches):
            del words[a:b]
        kept = b" ".join(words)
        return (n, n - len(words), hashlib.sha256(kept).hexdigest(), *([kept.decode()] if texts else ()))

    schema = [("n_words", pa.int64(), "long"), ("n_removed", pa.int64(), "long"), ("kept_sha256", pa.string(), "string"), ("kept", pa.string(), "string")]
    runs = repeated_windows(found, total, WORDS, GRAM, read_words, sort_windows)
    return finish(found, total, runs, one, WORDS, schema if texts else schema[:3])
