"""Language identification with hyperdimensional profiles.

Every letter has a fixed random vector of +1 and -1 (drawn from its code point).
A trigram of letters is bound as the product of its letters' vectors, rotated by
their place; trigrams of a text, weighted by their counts, are bundled by adding.
A language's prototype is the bundle of its learned texts, each scaled to length
one; the mean of all prototypes, common to all languages, is taken off. A text
gets the language whose prototype has the largest cosine with its own bundle.

The texts that `identify` learns from are a sample of at most `per_language` labelled
documents of each of the MOST_LABELS most frequent languages, by the hash of their id;
everything else sees every document. The stage of the pipeline, `with_language`, learns
from every labelled document of those languages.

A text unlike all learned languages still has a largest cosine: of random bundles it
varies by 1 / sqrt(dimensions) about 0. What rejects is therefore read from the learned
texts, a quarter of the cosine that all but one in a hundred of them reach (a text of two
or three languages has more), and only texts with `ENOUGH` distinct trigrams are judged.

Defined results: a text that is null or has no letter, or a table from which nothing
can be learned, gives `und` with score 0. Ties go to the smaller name. Rows that repeat
a doc_id are told each; a null doc_id is not held out. A table without a column lang
teaches nothing. Extra columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import MOST_LABELS, bounded_sample, broadcast_if_small, chunks, fresh, held_out, release, small_batches, trim, written

UND = "und"
#: Trigram vectors that a worker keeps before it starts anew (a byte a dimension).
TABLE_SIZE = 30_000
#: Distinct trigrams from which on a text can be told to resemble no language.
ENOUGH = 200


class Binder:
    """Bundles of texts."""

    def __init__(self, dimensions: int = 1024, seed: int = 7):
        self.dimensions, self.seed = dimensions, seed
        self.letters: dict[int, np.ndarray] = {}
        self.distinct = 0  # trigrams of the latest text
        self.reset()
        self.is_letter = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)

    def reset(self) -> None:
        self.row_of: dict[int, int] = {}
        self.rows = np.zeros((1024, self.dimensions), np.int8)

    def letter(self, code: int) -> np.ndarray:
        """Code 0 stands for the edge of a word."""
        if code not in self.letters:
            if len(self.letters) > TABLE_SIZE:
                self.letters.clear()
            self.letters[code] = np.random.default_rng([self.seed, code]).integers(0, 2, self.dimensions, np.int8) * 2 - 1
        return self.letters[code]

    def add(self, trigram: int) -> int:
        if len(self.row_of) == len(self.rows):
            self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
        a, b, c = (self.letter(trigram >> shift & 0x1FFFFF) for shift in (42, 21, 0))
        row = self.row_of[trigram] = len(self.row_of)
        self.rows[row] = np.roll(a, 2) * np.roll(b, 1) * c
        return row

    def counts(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Distinct trigrams and how often each occurs; None without a letter."""
        codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        codes = np.where(self.is_letter[codes], codes, 0).astype(np.int64)
        if not codes.any():
            return None
        codes = np.concatenate([[0], codes, [0]])
        codes = codes[np.concatenate([[True], (codes[1:] != 0) | (codes[:-1] != 0)])]  # one edge between words
        return np.unique((codes[:-2] << 42) | (codes[1:-1] << 21) | codes[2:], return_counts=True)

    def bundle(self, text: str) -> np.ndarray | None:
        """The text's bundle, of length one."""
        if (found := self.counts(text)) is None:
            return None
        trigrams, weights = found
        self.distinct = len(trigrams)
        if len(self.row_of) > TABLE_SIZE:
            self.reset()
        row_of = self.row_of
        at = [row_of[t] if t in row_of else self.add(t) for t in trigrams.tolist()]
        out = np.zeros(self.dimensions, np.float32)
        weights = weights.astype(np.float32)
        for i in range(0, len(at), 2048):
            out += weights[i : i + 2048] @ self.rows[at[i : i + 2048]].astype(np.float32)
        size = float(np.linalg.norm(out))
        return out / size if size else None


_binders: dict[tuple[int, int], Binder] = {}


def binder(dimensions: int, seed: int) -> Binder:
    if (dimensions, seed) not in _binders:
        _binders[dimensions, seed] = Binder(dimensions, seed)
    return _binders[dimensions, seed]


@dataclass(frozen=True)
class Profiles:
    """Languages, sorted, and their prototypes."""

    languages: list[str]
    prototypes: np.ndarray
    dimensions: int
    seed: int

    def tell(self, text: str | None) -> tuple[str, float, int]:
        """Language, cosine within 0 and 1, and distinct trigrams of a text."""
        own = binder(self.dimensions, self.seed)
        v = own.bundle(text) if self.languages and text else None
        if v is None:
            return UND, 0.0, 0
        near = self.prototypes @ v
        best = int(np.argmax(near))
        return self.languages[best], float(np.clip(near[best], 0.0, 1.0)), own.distinct


def taught(docs: DataFrame) -> DataFrame:
    """Labelled documents: doc_id, text and lang. No held-out document is among them."""
    own = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.col("lang").cast("string"))
    return own.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))


def labelled(docs: DataFrame) -> DataFrame:
    """All of them, of the MOST_LABELS most frequent languages."""
    if "lang" not in docs.columns:
        return docs.sparkSession.createDataFrame([], "doc_id long, text string, lang string")
    own = taught(docs)
    counted = own.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MOST_LABELS).collect()
    return own.where(F.col("lang").isin([r["lang"] for r in counted]))


def learned(docs: DataFrame, per_language: int = 2000) -> DataFrame:
    """The sample: text and lang. No held-out document is in it."""
    if "lang" not in docs.columns:
        return docs.sparkSession.createDataFrame([], "text string, lang string")
    own = taught(docs)
    chosen = broadcast_if_small(bounded_sample(own.select("doc_id", "lang"), "lang", per_language).distinct())
    return written(own.join(chosen, ["doc_id", "lang"], "left_semi").select("text", "lang"), "learned")


def fit(sample: DataFrame, dimensions: int = 1024, seed: int = 7) -> Profiles:
    """From texts with their lang. The largest thing that reaches the driver is a sum for each
    of at most MOST_LABELS languages and each dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, sums = binder(dimensions, seed), {}
        for batch in chunks(batches):
            for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist(), strict=True):
                if (v := own.bundle(text or "")) is not None:
                    sums[lang] = sums.get(lang, 0) + v.astype(np.float64)
        vectors = pa.array([list(v) for v in sums.values()], pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.string()), vectors], ["lang", "v"])
        _binders.clear()
        trim()

    small_batches(sample.sparkSession)
    partial = sample.mapInArrow(run, "lang string, v array<double>").select("lang", F.posexplode("v"))
    total = partial.groupBy("lang", "pos").agg(F.sum("col").alias("x")).toArrow()
    names, at = total.column("lang").to_pylist(), total.column("pos").to_numpy()
    languages = sorted(set(names))
    assert len(languages) <= MOST_LABELS
    row_of = {lang: i for i, lang in enumerate(languages)}
    prototypes = np.zeros((len(languages), dimensions))
    prototypes[[row_of[n] for n in names], at] = total.column("x").to_numpy()
    return Profiles(languages, centred(prototypes).astype(np.float32), dimensions, seed)


def centred(prototypes: np.ndarray) -> np.ndarray:
    if len(prototypes) > 1:
        prototypes = prototypes / np.linalg.norm(prototypes, axis=1, keepdims=True)
        prototypes = prototypes - prototypes.mean(axis=0)
    return prototypes / np.maximum(np.linalg.norm(prototypes, axis=1, keepdims=True), 1e-12) if len(prototypes) else prototypes


def annotated(docs: DataFrame, model: Profiles, lang: str, score: str, grams: str) -> DataFrame:
    """docs with three more columns of these names, told from every whole text."""
    small_batches(docs.sparkSession)
    ready = docs.withColumn("text", F.col("text").cast("string"))
    more = [T.StructField(lang, T.StringType()), T.StructField(score, T.DoubleType()), T.StructField(grams, T.LongType())]
    schema = T.StructType([*ready.schema.fields, *more])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            told = [model.tell(text) for text in batch.column("text").to_pylist()]
            columns = [pa.array([t[i] for t in told], kind) for i, kind in enumerate((pa.string(), pa.float64(), pa.int64()))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], [*batch.schema.names, lang, score, grams])
        _binders.clear()
        trim()

    return ready.mapInArrow(run, schema)


def identify(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score."""
    sample = learned(docs)
    model = fit(sample)
    release(sample)
    found = annotated(docs.select(F.col("doc_id").cast("long"), "text"), model, "lang_pred", "score", "grams")
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


#: Steps into which the cosines from 0 to 1 are counted to find the usual one.
STEPS = 1 << 16


def usual_score(told: DataFrame, share: float = 0.01) -> float:
    """The score that all but `share` of the rows reach, to a STEPS-th below. Counts of
    STEPS steps at most reach the driver, however many rows there are."""
    step = F.floor(F.col("score") * STEPS).cast("int")
    table = told.groupBy(step.alias("step")).count().orderBy("step").toArrow()
    if not table.num_rows:
        return 0.0
    upto = np.cumsum(table.column("count").to_numpy())
    return int(table.column("step").to_numpy()[np.searchsorted(upto, share * (upto[-1] - 1), side="right")]) / STEPS


def with_language(docs: DataFrame) -> DataFrame:
    """docs without those that have no letter or that resemble no learned language;
    a missing lang gets the predicted one. Model and limit come from every labelled
    document; each is told once, and the table with what was told is written. Where no
    language could be learned only texts without a letter go."""
    model = fit(labelled(docs).select("text", "lang"))
    if not model.languages:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    lang, score, grams, learns = (fresh(docs, f"told_{c}") for c in ("lang", "score", "grams", "learns"))
    known = F.col("lang").cast("string").isin(model.languages) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id").cast("long"))
    told = written(annotated(docs, model, lang, score, grams).where(F.col(lang) != UND).withColumn(learns, F.coalesce(known, F.lit(False))), "told")
    usual = usual_score(told.where(F.col(learns) & (F.col(grams) >= ENOUGH)).select(F.col(score).alias("score")))
    kept = told.where((F.col(grams) < ENOUGH) | (F.col(score) >= usual / 4))
    return kept.withColumn("lang", F.coalesce("lang", lang)).drop(lang, score, grams, learns)
