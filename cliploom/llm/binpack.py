"""Bounded-space online packing of token sequences.

Each partition keeps at most `open_windows` windows open. A document's ids are
cut into whole windows first; the rest goes to the open window that it fits with
the least room left. Where none fits and all are open, the fullest is topped up
with the head of the rest and emitted full, and the tail is placed in turn. What
is open at the end of a partition is handed on with its ids, and leftovers of
`MERGED` partitions are merged into full windows; the last ids of each such group
are split at powers of two, lengths that take no padding.

Words are encoded through a bounded table per worker; a text with characters
outside a plain set, for which lower-casing and composing are trivial, goes to
the tokenizers library as a whole.

Defined results: a null or empty text is one piece, its end id alone; no text is
dropped or shortened; an empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .bpedp import byte_alphabet
from .common import chunks, small_batches, texts_of, tokenizer_path, written

#: Partitions whose leftovers one task merges: at most MERGED * open_windows windows.
MERGED = 64
#: Words that a worker remembers before it starts anew.
TABLE_SIZE = 150_000

PLAIN = re.compile(r"[\t\n\r\x20-\x7e\xc0-\xff]*")
WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z\xdf-\xf6\xf8-\xff]+|[0-9]|[^\sa-z\xdf-\xf6\xf8-\xff0-9]+")

PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class WordCoder(dict):
    """word: its ids as little-endian unsigned 32-bit bytes. Of the words learned
    before the newest TABLE_SIZE, those still met are kept."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.tokenize = self.tokenizer.model.tokenize
        self.stand_in = {b: c for c, b in byte_alphabet().items()}
        self.older: dict[str, bytes] = {}

    def ids_of(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def __missing__(self, word: str) -> bytes:
        if (got := self.older.get(word)) is None:
            spelled = word if word.isascii() else word.encode().decode("latin-1").translate(self.stand_in)
            got = array("I", [t.id for t in self.tokenize(spelled)]).tobytes()
        if len(self) >= TABLE_SIZE:
            self.older = dict(self)
            self.clear()
        self[word] = got
        return got

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        get = self.__getitem__
        return [b"".join(map(get, WORDS.findall(t.lower()))) if PLAIN.fullmatch(t) and "<|" not in t else self.ids_of(t) for t in texts]


_coders: dict[str, WordCoder] = {}


def _coder(path: str) -> WordCoder:
    if path not in _coders:
        _coders[path] = WordCoder(path)
    return _coders[path]


class Packer:
    """Best fit over a bounded number of open windows. A piece is (doc_id, start,
    doc_tokens, ids); a window is [filled, pieces]."""

    def __init__(self, size: int, most_open: int, first_id: int):
        self.size, self.most_open, self.next_id = size, most_open, first_id
        self.open: list[list] = []
        self.rows: list[tuple] = []

    def emit(self, pieces: list[tuple]) -> None:
        at = 0
        for doc_id, start, total, ids in pieces:
            self.rows.append((doc_id, start, len(ids) // 4, zlib.crc32(ids), total, self.next_id, at))
            at += len(ids) // 4
        self.next_id += 1

    def put(self, doc_id, start: int, total: int, ids: bytes) -> None:
        size = self.size
        while (n := len(ids) // 4) >= size:
            self.emit([(doc_id, start, total, ids[: 4 * size])])
            start, ids = start + size, ids[4 * size :]
        while n:
            fitting = [w for w in self.open if w[0] + n <= size]
            if fitting:
                window = max(fitting, key=lambda w: w[0])
                window[0] += n
                window[1].append((doc_id, start, total, ids))
                if window[0] == size:
                    self.open.remove(window)
                    self.emit(window[1])
                return
            if len(self.open) < self.most_open:
                self.open.append([n, [(doc_id, start, total, ids)]])
                return
            fullest = max(self.open, key=lambda w: w[0])
            room = size - fullest[0]
            self.open.remove(fullest)
            self.emit([*fullest[1], (doc_id, start, total, ids[: 4 * room])])
            start, ids = start + room, ids[4 * room :]
            n -= room

    def taken(self) -> list[tuple]:
        rows, self.rows = self.rows, []
        return rows


def merge_leftovers(windows: list[list[tuple]], size: int, first_id: int) -> list[tuple]:
    """Leftover windows, the fullest first, cut into full ones; what remains is
    split at powers of two."""
    pieces = [p for w in sorted(windows, key=lambda w: -sum(len(p[3]) for p in w)) for p in w]
    left = sum(len(p[3]) for p in pieces) // 4
    packer, at = Packer(size, 0, first_id), 0
    while left:
        want = size if left >= size else 1 << (left.bit_length() - 1)
        left -= want
        taken = []
        while want:
            doc_id, start, total, ids = pieces[at]
            n = min(want, len(ids) // 4)
            taken.append((doc_id, start, total, ids[: 4 * n]))
            if 4 * n == len(ids):
                at += 1
            else:
                pieces[at] = (doc_id, start + n, total, ids[4 * n :])
            want -= n
        packer.emit(taken)
    return packer.rows


def _batch(rows: list[tuple], left: list[tuple] = ()) -> pa.RecordBatch:
    """left: (group, window, doc_id, start, doc_tokens, ids)."""
    columns = [[r[i] for r in rows] for i in range(7)]
    a, b = len(rows), len(left)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(columns[0] + [x[2] for x in left], pa.int64()),
            pa.array(columns[1] + [x[3] for x in left], pa.int64()),
            pa.array(columns[2] + [len(x[5]) // 4 for x in left], pa.int64()),
            pa.array(columns[3] + [0] * b, pa.int64()),
            pa.array(columns[4] + [x[4] for x in left], pa.int64()),
            pa.array(columns[5] + [x[1] for x in left], pa.int64()),
            pa.array(columns[6] + [0] * b, pa.int64()),
            pa.array([None] * a + [x[0] for x in left], pa.int64()),
            pa.array([None] * a + [x[5] for x in left], pa.binary()),
        ],
        ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "left_of", "ids"],
    )


def pack(docs: DataFrame, vocabulary: str = "word_bpe_49k.json", end_id: int = 2, size: int = 4096, open_windows: int = 8) -> DataFrame:
    """One row per piece; see PIECE for its columns."""
    small_batches(docs.sparkSession)
    end = np.asarray([end_id], dtype="<u4").tobytes()

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        packer, coder = Packer(size, open_windows, part << 32), _coder(tokenizer_path(vocabulary))
        for batch in chunks(batches):
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), coder.encode_batch(batch.column("text").to_pylist()), strict=True):
                ids += end
                packer.put(doc_id, 0, len(ids) // 4, ids)
            yield _batch(packer.taken())
        yield _batch([], [(part // MERGED, (part << 8) + i, *p) for i, w in enumerate(packer.open) for p in w[1]])

    def merge(key: tuple, found: pa.Table) -> pa.Table:
        windows: dict[int, list[tuple]] = {}
        for doc_id, start, total, window, ids in zip(*(found.column(c).to_pylist() for c in ("doc_id", "start", "doc_tokens", "sequence_id", "ids")), strict=True):
            windows.setdefault(window, []).append((doc_id, start, total, ids))
        return pa.Table.from_batches([_batch(merge_leftovers([windows[k] for k in sorted(windows)], size, (1 << 62) + (key[0].as_py() << 32)))]).drop_columns(["left_of", "ids"])

    placed = written(texts_of(docs).mapInArrow(place, PIECE + ", left_of long, ids binary"), "placed")
    merged = placed.where("left_of is not null").groupBy("left_of").applyInArrow(merge, PIECE)
    return placed.where("left_of is null").drop("left_of", "ids").union(merged)
