"""Secret scans through a trigram inverted index.

Each rule's pattern is parsed, and a Boolean query over trigrams that every match
must contain is derived from it. A chunk of documents is one index segment: the
trigrams that some query needs are looked up in the whole lower-cased bytes of
its texts, giving a posting list of documents each. A rule's postings are united
and intersected as its query says, and the pattern runs over the whole texts of
the candidates only. A rule without a mandatory trigram scans every text.

Segments need no exchange of rows between tasks, and any can be rebuilt alone.

Defined results: null and empty texts have no spans (the digest is that of the
empty string); matches of different kinds may overlap, those of one kind don't;
spans count code points. Rows that repeat a doc_id, or have none, are scanned each.
Scans read doc_id and text alone; redact() passes all columns on, whatever their name.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, small_batches, texts_of

ANY = ("any",)


@dataclass(frozen=True)
class Rule:
    """pattern, run over code points with ASCII classes; letters match in either
    case if `fold`. A match counts if group `group` has at least `least` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    fold: bool = False

    def compiled(self) -> re.Pattern:
        return re.compile(self.pattern, re.ASCII | (re.IGNORECASE if self.fold else 0))


BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8, True),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", r"[0-9a-f]+", 0, 32),
)
MORE = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("hub_token", r"gh[opsu]_[A-Za-z0-9]{36,}"),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("bearer", r"bearer\x20+[A-Za-z0-9+/_.=-]{16,}", fold=True),
)
RULES = BASE + MORE


def _and(queries: list) -> tuple:
    flat = []
    for q in queries:
        flat += q[1] if q[0] == "and" else [] if q == ANY else [q]
    unique = list(dict.fromkeys(flat))
    return ANY if not unique else unique[0] if len(unique) == 1 else ("and", tuple(unique))


def _or(queries: list) -> tuple:
    if ANY in queries:
        return ANY
    unique = list(dict.fromkeys(queries))
    return unique[0] if len(unique) == 1 else ("or", tuple(unique))


def _trigrams(text: str) -> tuple:
    return _and([("tri", text[i : i + 3]) for i in range(len(text) - 2)])


class Syntax:
    """A pattern as a tree: ("char", its possible characters or None), ("cat", parts),
    ("alt", sides), ("rep", fewest, part). What it doesn't know raises ValueError."""

    def __init__(self, pattern: str):
        self.rest = list(reversed(pattern))
        self.tree = self._sides()
        if self.rest:
            raise ValueError(f"unbalanced: {pattern}")

    def _sides(self) -> tuple:
        sides = [self._parts()]
        while self.rest and self.rest[-1] == "|":
            self.rest.pop()
            sides.append(self._parts())
        return sides[0] if len(sides) == 1 else ("alt", sides)

    def _parts(self) -> tuple:
        parts = []
        while self.rest and self.rest[-1] not in "|)":
            parts.append(self._repeated(self._one()))
        return ("cat", parts)

    def _repeated(self, part: tuple) -> tuple:
        while self.rest and self.rest[-1] in "?*+{":
            sign = self.rest.pop()
            if sign == "{":
                low, _, high = self._until("}").partition(",")
                part = part if low == "1" and high == "" and not _ else ("rep", int(low), part)
            elif sign == "?" and part[0] == "rep":
                continue  # as few as possible: the same strings
            else:
                part = ("opt", part) if sign == "?" else ("rep", int(sign == "+"), part)
        return part

    def _until(self, end: str) -> str:
        out = []
        while (c := self.rest.pop()) != end:
            out.append(c)
        return "".join(out)

    def _escaped(self) -> str | None:
        """A character, or None for a class of many."""
        c = self.rest.pop()
        if c == "x":
            return chr(int(self.rest.pop() + self.rest.pop(), 16))
        return None if c in "dDwWsS" else {"n": "\n", "t": "\t", "r": "\r"}.get(c, c)

    def _one(self) -> tuple:
        c = self.rest.pop()
        if c == "(":
            if self.rest[-1] == "?":
                self.rest.pop()
                if self.rest.pop() != ":":
                    raise ValueError("only plain groups")
            inner = self._sides()
            if not self.rest or self.rest.pop() != ")":
                raise ValueError("unbalanced group")
            return inner
        if c == "[":
            return ("char", self._set())
        if c == "\\":
            if self.rest[-1] in "bBAZ0123456789":
                raise ValueError("no anchors or references")
            found = self._escaped()
            return ("char", None if found is None else {found})
        if c in "^$":
            raise ValueError("no anchors or references")
        return ("char", None if c == "." else {c})

    def _set(self) -> set[str] | None:
        """Characters of a set; None if it is negated or has ranges or classes."""
        many = self.rest[-1] == "^"
        found = set()
        first = True
        while first or self.rest[-1] != "]":
            c = self.rest.pop()
            c = self._escaped() if c == "\\" else c
            many |= c is None or c == "-" and not first and self.rest[-1] != "]"
            found.add(c)
            first = False
        self.rest.pop()
        return None if many else found


#: Most spellings of one stretch that are kept apart; beyond it the stretch ends.
SPELLINGS = 32


def _explored(node: tuple) -> tuple[list[str] | None, tuple]:
    """(all spellings if few, a query that holds in any case)."""
    if node[0] == "char":
        plain = node[1] is not None and all(c.isascii() for c in node[1])
        return (sorted({c.lower() for c in node[1]}), ANY) if plain else (None, ANY)
    if node[0] == "alt":
        sides = [_explored(x) for x in node[1]]
        query = _or([q if s is None else _spelled(s) for s, q in sides])
        few = all(s is not None for s, _ in sides)
        return [x for s, _ in sides for x in s] if few else None, query
    if node[0] == "opt":
        spellings, _ = _explored(node[1])
        return None if spellings is None else ["", *spellings], ANY
    if node[0] == "rep":
        spellings, query = _explored(node[2])
        return None, ANY if not node[1] else query if spellings is None else _spelled(spellings)
    exact, found, whole = [""], [], True
    for part in node[1]:
        spellings, query = _explored(part)
        if spellings is not None and len(exact) * len(spellings) <= SPELLINGS:
            exact = list(dict.fromkeys(a + b for a in exact for b in spellings))
            continue
        whole = False
        found += [_spelled(exact), query]
        exact = spellings if spellings is not None and len(spellings) <= SPELLINGS else [""]
    return (exact, ANY) if whole else (None, _and([*found, _spelled(exact)]))


def _spelled(spellings: list[str]) -> tuple:
    return _or([_trigrams(x) for x in spellings])


def trigram_query(pattern: str) -> tuple:
    """A Boolean query, over lower-cased ASCII trigrams, that every match meets; ANY for
    a pattern with syntax beyond Syntax, whose rule then scans every text."""
    try:
        spellings, query = _explored(Syntax(pattern).tree)
    except (ValueError, IndexError):
        return ANY
    return query if spellings is None else _spelled(spellings)


def needed(query: tuple) -> set[str]:
    return {query[1]} if query[0] == "tri" else set() if query == ANY else set().union(*map(needed, query[1]))


class Segment:
    """Posting lists of the needed trigrams over one chunk of UTF-8 texts."""

    def __init__(self, raw: np.ndarray, ends: np.ndarray, slot_of: np.ndarray, n_slots: int):
        self.n = len(ends)
        low = raw.astype(np.int32)
        low += 32 * ((low >= 65) & (low <= 90))
        codes = (low[:-2] << 16) + (low[1:-1] << 8) + low[2:] if len(low) > 2 else np.zeros(0, np.int32)
        slots = slot_of[codes]
        at = np.flatnonzero(slots)
        first, last = np.searchsorted(ends, at, "right"), np.searchsorted(ends, at + 2, "right")
        at, docs = at[first == last], first[first == last]  # a trigram lies in one text
        both = np.unique(slots[at].astype(np.int64) * (self.n + 1) + docs)
        self.posting = [both[(both // (self.n + 1)) == s] % (self.n + 1) for s in range(1, n_slots + 1)]

    def match(self, query: tuple, slots: dict[str, int]) -> np.ndarray:
        if query == ANY:
            return np.arange(self.n)
        if query[0] == "tri":
            return self.posting[slots[query[1]] - 1]
        lists = [self.match(q, slots) for q in query[1]]
        if query[0] == "or":
            return np.unique(np.concatenate(lists))
        out = lists[0]
        for x in lists[1:]:
            out = np.intersect1d(out, x, assume_unique=True)
        return out


def _scan(batches: Iterator[pa.RecordBatch], rules: tuple[Rule, ...]) -> Iterator[tuple[pa.RecordBatch, list[list[tuple[int, int, int]]]]]:
    """Each chunk with the spans (start, rule number, end) of its texts, sorted."""
    queries = [trigram_query(r.pattern) for r in rules]
    slots = {t: i for i, t in enumerate(sorted(set().union(*map(needed, queries))), 1)}
    slot_of = np.zeros(1 << 24, np.uint8 if len(slots) < 256 else np.uint16)
    for t, i in slots.items():
        slot_of[(ord(t[0]) << 16) + (ord(t[1]) << 8) + ord(t[2])] = i
    compiled = [r.compiled() for r in rules]
    for batch in chunks(batches):
        column = batch.column("text").to_pylist()
        coded = [t.encode() for t in column]
        ends = np.cumsum([len(c) for c in coded])
        segment = Segment(np.frombuffer(b"".join(coded), np.uint8), ends, slot_of, len(slots))
        spans: list[list[tuple[int, int, int]]] = [[] for _ in column]
        for number, (rule, pattern, query) in enumerate(zip(rules, compiled, queries, strict=True)):
            for i in segment.match(query, slots):
                for m in pattern.finditer(column[i]):
                    if m.end(rule.group) - m.start(rule.group) >= rule.least:
                        spans[i].append((m.start(), number, m.end()))
        for found in spans:
            found.sort()
        yield batch, spans


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id and spans: an array of (kind, start, stop) by start, then rule order."""
    small_batches(docs.sparkSession)

    def run(batches):
        for batch, spans in _scan(batches, rules):
            said = pa.array([[{"kind": rules[k].kind, "start": a, "stop": b} for a, k, b in x] for x in spans], pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64())])))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), said], ["doc_id", "spans"])

    return texts_of(docs).mapInArrow(run, "doc_id long, spans array<struct<kind:string,start:bigint,stop:bigint>>")


def secret_digests(docs: DataFrame) -> DataFrame:
    """One row per document: counts of the base kinds, a digest of the base spans,
    and all spans in words."""
    small_batches(docs.sparkSession)

    def run(batches):
        for batch, spans in _scan(batches, RULES):
            base = [[x for x in s if x[1] < len(BASE)] for s in spans]
            words = [[",".join(f"{RULES[k].kind}:{a}:{b}" for a, k, b in x) for x in group] for group in (base, spans)]
            counts = [pa.array([sum(x[1] == k for x in s) for s in base], pa.int64()) for k in range(len(BASE))]
            digests = pa.array([hashlib.sha256(w.encode()).hexdigest() for w in words[0]], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *counts, digests, pa.array(words[1], pa.string())], ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return texts_of(docs).mapInArrow(run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def redact(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """documents with every span of every rule replaced by [kind]; overlapping
    spans become one, named after the first. n_chars follows; a null text stays null."""
    small_batches(docs.sparkSession)
    names = docs.columns
    ready = docs.withColumn("text", F.col("text").cast("string"))

    def run(batches):
        for batch in batches:
            column = batch.column("text")
            filled = batch.set_column(batch.schema.get_field_index("text"), "text", column.fill_null(""))
            done, at = [], 0
            for part, spans in _scan(iter([filled]), rules):
                for text, found in zip(part.column("text").to_pylist(), spans, strict=True):
                    out, upto = [], 0
                    for a, k, b in found:
                        if a >= upto:
                            out += [text[upto:a], f"[{rules[k].kind}]"]
                        upto = max(upto, b)
                    done.append("".join(out) + text[upto:] if column[at].is_valid else None)
                    at += 1
            assert len(done) == batch.num_rows
            yield batch.set_column(batch.schema.get_field_index("text"), "text", pa.array(done, pa.string()))

    out = ready.mapInArrow(run, ready.schema)
    if "n_chars" in names:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return out
