"""Toxic passages as maximum-scoring segments.

Lexicon: a word, and its leading letters where the word itself is not known,
scores the log-odds of its presence in toxic against other labelled texts, under
a Dirichlet prior spread by how common it is, less two and a half standard errors; what is
not clearly toxic costs a little. One scan in linear time finds all disjoint
maximal segments of a text (Ruzzo and Tompa's method). A segment's score S in a
text of n words follows an extreme-value law: its chance under clean text is
1 - exp(-K n exp(-L S)), L from the clean scores' distribution and K from the
clean texts' best segments. A text's score is a logistic function of its best
chance, its significant segments' sum and its best sum.

Labelled texts are a sample of at most `per_class` of each class, by the hash of
their id. Segments for the calibration are scored with the lexicon of the other
half of the sample, so that no text is judged by itself.

Defined results: null and empty texts score as texts without a segment; without
labels of both classes every score is the share of toxic labels (none: 0). Of labels
that repeat a doc_id, toxic wins; rows that repeat a doc_id are scored each, and equal
texts count once in the fit; a null doc_id is scored but never learned from. Only
doc_id and text are read, so other columns may have any name.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_sample, chunks, held_out, release, small_batches, texts_of, written

WORD = re.compile(r"[^\W\d_]+")
STEMS = (6, 5, 4)
COST, LEAST_SCORE, LEXICON = 0.05, 1.0, 20_000
#: A segment counts as significant below this chance.
CHANCE = 0.01
TABLE_SIZE = 400_000


def tokens(text: str) -> set[str]:
    """Distinct words, and stems marked by a leading ^."""
    words = set(WORD.findall(text.lower()))
    return words | {"^" + w[:n] for w in words for n in STEMS if len(w) >= n}


class Scores(dict):
    """word: its score, from its longest known form."""

    def __init__(self, lexicon: dict[str, float]):
        super().__init__()
        self.lexicon = lexicon

    def __missing__(self, word: str) -> float:
        forms = [word, *("^" + word[:n] for n in STEMS if len(word) >= n)]
        score = next((self.lexicon[f] for f in forms if f in self.lexicon), -COST)
        if len(self) > TABLE_SIZE:
            self.clear()
        self[word] = score
        return score


def maximal_segments(scores: np.ndarray) -> list[tuple[float, int, int]]:
    """All maximal scoring segments: (score, from, to)."""
    sums = np.concatenate([[0.0], np.cumsum(scores, dtype=np.float64)])
    low: list[float] = []
    high: list[float] = []
    spans: list[tuple[int, int]] = []
    link: list[int] = []
    for i in np.flatnonzero(scores > 0).tolist():
        left, right, start = float(sums[i]), float(sums[i + 1]), i
        while True:
            j = len(low) - 1
            while j >= 0 and low[j] >= left:
                j = link[j]
            if j < 0 or high[j] >= right:
                break
            left, start = low[j], spans[j][0]
            del low[j:], high[j:], spans[j:], link[j:]
        low.append(left)
        high.append(right)
        spans.append((start, i + 1))
        link.append(j)
    return [(h - a, *s) for a, h, s in zip(low, high, spans, strict=True)]


class Model:
    """The lexicon, the extreme-value law and the logistic weights."""

    def __init__(self, lexicon: dict[str, float], share: float):
        self.lexicon, self.share = lexicon, share
        self.decay, self.scale = 1.0, 1.0
        self.weights: np.ndarray | None = None

    def calibrate(self, words: int, positive: np.ndarray, times: np.ndarray, best: np.ndarray, sizes: np.ndarray) -> None:
        """From clean texts: their words, their positive word scores and how often each
        occurs, and the best segment and the words of each text."""
        low, high = 1e-3, 20.0
        for _ in range(60):  # the root of the mean of exp(decay * score) = 1 over clean words
            mid = (low + high) / 2
            mean = ((times * np.exp(np.minimum(mid * positive, 500))).sum() + (words - times.sum()) * np.exp(-mid * COST)) / max(1, words)
            low, high = (mid, high) if mean < 1 else (low, mid)
        self.decay = low
        peak = self.decay * best - np.log(np.maximum(1, sizes))
        self.scale = float(np.clip(np.exp(np.mean(peak) - 0.5772), 1e-9, 1.0))

    def chance(self, score: np.ndarray, n: np.ndarray) -> np.ndarray:
        return -np.expm1(-self.scale * np.maximum(n, 1) * np.exp(-self.decay * np.asarray(score)))

    def features(self, found: list[tuple[float, int, int]], n: int) -> tuple[float, float, float]:
        if not found:
            return 0.0, 0.0, 0.0
        sums = np.asarray([s for s, _, _ in found])
        chances = self.chance(sums, np.asarray(n))
        return float(min(30.0, -np.log10(max(chances.min(), 1e-30)))), float(np.log1p(sums[chances < CHANCE].sum())), float(np.log1p(sums.max()))

    def predict(self, features: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(features), self.share)
        return 1 / (1 + np.exp(-np.clip(np.column_stack([np.ones(len(features)), features]) @ self.weights, -40, 40)))


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        grad = x.T @ (weight * (y - p)) - ridge * w
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), grad)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _log_odds(toxic, clean, n_toxic: float, n_clean: float):
    """Column of the score of a token with these counts of texts."""
    prior = F.lit(0.5) + F.lit(10.0) * (toxic + clean) / F.lit(n_toxic + n_clean)
    odds = F.log((toxic + prior) / (F.lit(n_toxic + 1.0) + prior)) - F.log((clean + prior) / (F.lit(n_clean + 1.0) + prior))
    return odds - 2.5 * F.sqrt(1 / (toxic + prior) + 1 / (clean + prior))


def _scored(texts: list[str], tables: list[Scores], which: list[int]) -> Iterator[tuple[np.ndarray, list[tuple[float, int, int]]]]:
    for text, t in zip(texts, which, strict=True):
        words = WORD.findall(text.lower())
        scores = np.fromiter(map(tables[t].__getitem__, words), np.float64, len(words))
        yield scores, maximal_segments(scores)


def fit(docs: DataFrame, labels: DataFrame, per_class: int = 10_000) -> Model:
    small_batches(docs.sparkSession)
    told = labels.where(F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id"))).groupBy(F.col("doc_id").cast("long")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    chosen = bounded_sample(told, "toxic", per_class).select("doc_id", "toxic", F.pmod(F.xxhash64("doc_id", F.lit(9)), F.lit(2)).cast("int").alias("half"))
    told_texts = written(texts_of(docs).join(F.broadcast(chosen), "doc_id"), "labelled")  # at most 2 * per_class ids
    once = told_texts.groupBy(F.xxhash64("text").alias("h"), "toxic").agg(F.min("doc_id").alias("doc_id"))
    sample = told_texts.join(F.broadcast(once.select("doc_id").distinct()), "doc_id", "left_semi")  # a text counts once
    counted = {(r["toxic"], r["half"]): r["count"] for r in sample.groupBy("toxic", "half").count().collect()}
    n = [[counted.get((c, h), 0) for h in (0, 1)] for c in (0, 1)]
    n_clean, n_toxic = sum(n[0]), sum(n[1])
    model = Model({}, n_toxic / max(1, n_clean + n_toxic))
    if not n_clean or not n_toxic:
        release(told_texts)
        return model

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            seen: dict[str, list[int]] = {}
            for text, toxic, half in zip(*(batch.column(c).to_pylist() for c in ("text", "toxic", "half")), strict=True):
                for token in tokens(text):
                    seen.setdefault(token, [0, 0, 0, 0])[2 * toxic + half] += 1
            yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), *(pa.array([v[i] for v in seen.values()], pa.int64()) for i in range(4))], ["token", "c0", "c1", "t0", "t1"])

    summed = sample.mapInArrow(count, "token string, c0 long, c1 long, t0 long, t1 long").groupBy("token").agg(*(F.sum(c).alias(c) for c in ("c0", "c1", "t0", "t1")))
    sides = [_log_odds(F.col("t0") + F.col("t1"), F.col("c0") + F.col("c1"), n_toxic, n_clean)] + [_log_odds(F.col(f"t{h}"), F.col(f"c{h}"), n[1][h], n[0][h]) for h in (0, 1)]
    ranked = summed.where("t0 + t1 >= 2").select("token", *(s.alias(f"s{i}") for i, s in enumerate(sides)))
    rows = ranked.where(F.greatest("s0", "s1", "s2") > LEAST_SCORE).orderBy(F.desc(F.greatest("s0", "s1", "s2")), "token").limit(LEXICON).collect()
    lexicons = [{r["token"]: r[f"s{i}"] for r in rows if r[f"s{i}"] > LEAST_SCORE} for i in range(3)]
    model.lexicon = lexicons[0]

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = [Scores(lexicons[2]), Scores(lexicons[1])]  # each half by the other's
        for batch in chunks(batches):
            sizes, segments, positive = [], [], []
            for scores, found in _scored(batch.column("text").to_pylist(), tables, batch.column("half").to_pylist()):
                sizes.append(len(scores))
                segments.append([s for s, _, _ in found])
                positive.append([float(x) for x in scores[scores > 0]])
            columns = [
                batch.column("toxic"),
                pa.array(sizes, pa.int64()),
                pa.array(segments, pa.list_(pa.float64())),
                pa.array(positive, pa.list_(pa.float64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["toxic", "n", "segments", "positive"])

    seen = written(sample.mapInArrow(judge, "toxic int, n long, segments array<double>, positive array<double>"), "judged")
    clean = seen.where("toxic = 0")
    words = clean.agg(F.sum("n")).first()[0] or 0
    hits = clean.select(F.explode("positive").alias("score")).groupBy("score").count().collect()  # a row a lexicon entry at most
    positive, times = np.asarray([r["score"] for r in hits]), np.asarray([r["count"] for r in hits])
    best = clean.select("n", F.coalesce(F.array_max("segments"), F.lit(0.0)).alias("best")).toArrow()  # per_class rows of two numbers
    model.calibrate(words, positive, times, best.column("best").to_numpy(), best.column("n").to_numpy())

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [model.features([(s, 0, 0) for s in found], n) for found, n in zip(batch.column("segments").to_pylist(), batch.column("n").to_pylist(), strict=True)]
            columns = [pa.array([float(f[i]) for f in x], pa.float64()) for i in range(3)]
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), *columns], ["toxic", "x0", "x1", "x2"])

    told = seen.select("toxic", "n", "segments").mapInArrow(described, "toxic int, x0 double, x1 double, x2 double").toArrow()  # 2 * per_class rows of four numbers
    x = np.column_stack([told.column(f"x{i}").to_numpy() for i in range(3)])
    y = told.column("toxic").to_numpy().astype(np.float64)
    model.weights = _logistic(x, y, np.ones(len(y)))
    release(told_texts, seen)
    return model


def passages(docs: DataFrame, model: Model) -> DataFrame:
    """Every significant passage: doc_id, first and last word (0-based), sum, chance."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = [Scores(model.lexicon)]
        for batch in chunks(batches):
            rows = []
            texts = batch.column("text").to_pylist()
            for doc_id, (scores, found) in zip(batch.column("doc_id").to_pylist(), _scored(texts, tables, [0] * len(texts)), strict=True):
                for s, a, b in found:
                    if (p := float(model.chance(np.asarray(s), np.asarray(len(scores))))) < CHANCE:
                        rows.append((doc_id, a, b - 1, s, p))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], ["doc_id", "first", "last", "sum", "chance"])

    return texts_of(docs).mapInArrow(run, "doc_id long, first long, last long, sum double, chance double")


def score(docs: DataFrame, model: Model, least: float = 0.3) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = [Scores(model.lexicon)]
        for batch in chunks(batches):
            texts = batch.column("text").to_pylist()
            x = np.asarray([model.features(found, len(scores)) for scores, found in _scored(texts, tables, [0] * len(texts))]).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(model.predict(x), pa.float64())], ["doc_id", "score"])

    out = texts_of(docs).mapInArrow(run, "doc_id long, score double")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= least).cast("int").alias("predicted"))
