"""Byte-level BPE by per-prefix dynamic programming.

For a piece of text, every prefix has one last token: the last token of its own
BPE encoding. It is found from the tokens that are suffixes of the prefix (one
automaton over the vocabulary gives them all in linear time) by the only one
that is compatible with the last token of the prefix before it. Two adjacent
tokens are compatible when no merge across their boundary would have come first.
Back-pointers from the whole piece then spell the exact ids.

Texts are cut into pieces by the tokenizer's own pattern, as merges never cross
pieces; encoded pieces are kept in a bounded table per worker, as words repeat.
Decoding looks every id up again and joins the bytes.

Defined results: null and empty texts have no tokens; the digests are then those
of the empty string. A text with a special token's string is cut there first and
the string becomes that token's id, as the tokenizers library does.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import chunks, small_batches, texts_of, tokenizer_path

PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Pieces that a worker remembers before it starts anew.
TABLE_SIZE = 300_000
SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
NEVER = 1 << 60


def byte_alphabet() -> dict[str, int]:
    """The printable stand-ins of byte-level vocabularies: printable Latin-1 bytes
    stand for themselves, the others follow from code point 256 in byte order."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class PrefixCoder:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, path: str):
        import ahocorasick

        with open(path, encoding="utf-8") as f:
            said = json.load(f)
        alphabet = byte_alphabet()
        self.special = {t["content"]: t["id"] for t in said["added_tokens"]}
        self.bytes_of = {i: bytes(alphabet[c] for c in t) for t, i in said["model"]["vocab"].items() if t not in self.special}
        self.bytes_of |= {i: t.encode() for t, i in self.special.items()}
        vocab = said["model"]["vocab"]
        self.rank: dict[tuple[int, int], int] = {}
        self.made: dict[int, tuple[int, int, int]] = {}  # token: rank of the merge that makes it, its two parts
        for rank, pair in enumerate(said["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            token = vocab[a + b]
            self.rank[vocab[a], vocab[b]] = rank
            self.made.setdefault(token, (rank, vocab[a], vocab[b]))
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY)
        for text, i in vocab.items():
            if text not in self.special:
                raw = bytes(alphabet[c] for c in text).decode("latin-1")
                if len(raw) == 1 or self.reachable(i):
                    self.automaton.add_word(raw, (len(raw), i))
        self.automaton.make_automaton()
        self.fits: dict[tuple[int, int], bool] = {}
        self.cut = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None
        self.pieces = regex.compile(PIECES)

    def reachable(self, token: int) -> bool:
        """Whether a token's own bytes encode to it: its parts are themselves
        reachable and compatible with nothing that comes before their merge."""
        if token not in self.made:
            return False
        rank, a, b = self.made[token]
        return self.first_across(a, b) == rank

    def spine(self, token: int, right: bool) -> list[tuple[int, int, int]]:
        """(part, rank at which it exists, rank at which it is merged away) along
        one edge of a token's merge tree, from the token inwards."""
        out, until = [], NEVER
        while True:
            rank, a, b = self.made.get(token, (-1, -1, -1))
            out.append((token, rank, until))
            if rank < 0:
                return out
            token, until = b if right else a, rank

    def first_across(self, a: int, b: int) -> int:
        """Rank of the first merge across the boundary of a and b, else NEVER. At
        equal ranks the leftmost pair merges first."""
        best = NEVER
        for x, born_x, gone_x in self.spine(a, True):
            for y, born_y, gone_y in self.spine(b, False):
                rank = self.rank.get((x, y), NEVER)
                if born_x < rank < gone_x and born_y < rank <= gone_y:
                    best = min(best, rank)
        return best

    def compatible(self, a: int, b: int) -> bool:
        if (known := self.fits.get((a, b))) is None:
            if len(self.fits) > 2 * TABLE_SIZE:
                self.fits.clear()
            known = self.fits[a, b] = self.first_across(a, b) == NEVER
        return known

    def encode_piece(self, piece: bytes) -> list[int]:
        last = [-1] * (len(piece) + 1)
        before = [0] * (len(piece) + 1)
        compatible = self.compatible
        for end, (size, token) in self.automaton.iter(piece.decode("latin-1")):
            end += 1
            start = end - size
            if last[end] < 0 and (start == 0 or last[start] >= 0 and compatible(last[start], token)):
                last[end], before[end] = token, start
        out, at = [], len(piece)
        while at:
            out.append(last[at])
            at = before[at]
        return out[::-1]

    def parts(self, text: str) -> Iterator[str]:
        """Pieces in order; strings of special tokens come as they are."""
        if not self.cut or not self.cut.search(text):
            yield from self.pieces.findall(text)
            return
        at = 0
        for m in self.cut.finditer(text):
            yield from self.pieces.findall(text[at : m.start()])
            yield m[0]
            at = m.end()
        yield from self.pieces.findall(text[at:])

    def encode(self, text: str) -> list[int]:
        return [i for part in self.parts(text) for i in ([self.special[part]] if part in self.special else self.encode_piece(part.encode()))]

    def decode(self, ids: list[int]) -> str:
        return b"".join(self.bytes_of[i] for i in ids).decode("utf-8", "replace")


class Pieces(dict):
    """piece: (its ids in decimals, each followed by a comma; the bytes they decode
    to). Of the pieces met before the newest TABLE_SIZE, those met again are kept."""

    def __init__(self, coder: PrefixCoder):
        super().__init__()
        self.coder = coder
        self.older: dict[str, tuple[bytes, bytes]] = {}

    def __missing__(self, piece: str) -> tuple[bytes, bytes]:
        if (got := self.older.get(piece)) is None:
            ids = [self.coder.special[piece]] if piece in self.coder.special else self.coder.encode_piece(piece.encode())
            got = ("".join(f"{i}," for i in ids).encode(), b"".join(self.coder.bytes_of[i] for i in ids))
        if len(piece) < 64:
            if len(self) >= TABLE_SIZE:
                self.older = dict(self)
                self.clear()
            self[piece] = got
        return got


_coders: dict[str, Pieces] = {}


def _pieces(path: str) -> Pieces:
    if path not in _coders:
        _coders[path] = Pieces(PrefixCoder(path))
    return _coders[path]


def encode_digests(docs: DataFrame, vocabulary: str = "byte_bpe_50k.json") -> DataFrame:
    """One row per document: the number of ids, the digest of the ids, and the
    digest of the text they decode to."""
    small_batches(docs.sparkSession)

    def run(batches):
        table = _pieces(tokenizer_path(vocabulary))
        parts, find = table.coder.parts, table.coder.pieces.findall
        marks = tuple(table.coder.special)
        for batch in chunks(batches):
            counts, ids, decoded = [], [], []
            for text in batch.column("text").to_pylist():
                found = parts(text) if any(m in text for m in marks) else find(text)
                got = [table[p] for p in found]
                said = b"".join([g[0] for g in got])
                counts.append(said.count(b","))
                ids.append(hashlib.sha256(said[:-1]).hexdigest())
                raw = b"".join([g[1] for g in got])
                decoded.append(hashlib.sha256(raw.decode("utf-8", "replace").encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return texts_of(docs).mapInArrow(run, SCHEMA)


def encode_ids(docs: DataFrame, vocabulary: str = "byte_bpe_50k.json") -> DataFrame:
    """doc_id and the ids themselves."""
    small_batches(docs.sparkSession)

    def run(batches):
        coder = _pieces(tokenizer_path(vocabulary)).coder
        for batch in chunks(batches):
            ids = [coder.encode(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return texts_of(docs).mapInArrow(run, "doc_id long, ids array<int>")
