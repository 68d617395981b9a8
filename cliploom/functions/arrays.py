"""Vectors and signals in array columns, all inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body) -> Column:
    """body(value), with value computed once: lambdas share no subexpressions."""
    return F.element_at(F.transform(F.array(value), body), 1)


def doubles(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("array<double>")


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def unit(a: Column) -> Column:
    """Null where the vector is null, has a null or non-finite component or is next to zero."""
    fine = F.forall(a, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return let(norm(a), lambda n: F.when(F.coalesce(fine, F.lit(False)) & (n >= 1e-8), F.transform(a, lambda x: x / n)))


def cosine(a: Column, b: Column) -> Column:
    """0 where a vector has no length."""
    size = norm(a) * norm(b)
    return F.when(size > 0, dot(a, b) / size).otherwise(0.0)


def euclidean(a: Column, b: Column) -> Column:
    return F.sqrt(F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x))


def mean(a: Column) -> Column:
    return F.when(F.size(a) > 0, F.aggregate(a, F.lit(0.0), lambda s, x: s + x) / F.size(a))


def median(a: Column) -> Column:
    at = lambda o, n: F.element_at(o, F.floor(n / 2).cast("int"))
    return let(F.array_sort(a), lambda o: F.when(F.size(o) > 0, (at(o, F.size(o) + 1) + at(o, F.size(o) + 2)) / 2))


def percentile(a: Column, p: float) -> Column:
    """Linear between ranks."""

    def of(o: Column) -> Column:
        at = F.lit(p) * (F.size(o) - 1)
        low, high = F.element_at(o, F.floor(at).cast("int") + 1), F.element_at(o, F.ceil(at).cast("int") + 1)
        return F.when(F.size(o) > 0, low + (high - low) * (at - F.floor(at)))

    return let(F.array_sort(a), of)


def around(a: Column, i: Column, half: int) -> Column:
    """The 2 * half + 1 values around index i (0-based), the edges repeated."""
    last = F.size(a) - 1
    return F.transform(F.sequence(i - half, i + half), lambda j: F.element_at(a, F.greatest(F.lit(0), F.least(j, last)).cast("int") + 1))


def running_median(a: Column, kernel: int) -> Column:
    half = kernel // 2
    return F.when(F.size(a) > 0, F.transform(F.sequence(F.lit(0), F.size(a) - 1), lambda i: F.element_at(F.array_sort(around(a, i, half)), half + 1))).otherwise(a)


def rolling_mean(a: Column, window: int) -> Column:
    half = window // 2
    return F.when(F.size(a) > 0, F.transform(F.sequence(F.lit(0), F.size(a) - 1), lambda i: mean(around(a, i, half)))).otherwise(a)


def frames(a: Column, size: int, hop: int) -> Column:
    """Whole frames of `size` samples each `hop`."""
    n = F.floor((F.size(a) - size) / hop).cast("int")
    return F.when(F.size(a) >= size, F.transform(F.sequence(F.lit(0), n), lambda i: F.slice(a, i * hop + 1, F.lit(size)))).otherwise(F.array().cast("array<array<double>>"))


def noise_floor(a: Column, rate: int, seconds: float = 0.20, p: float = 0.20, least: float = 1e-6) -> Column:
    """A low percentile of the levels of whole stretches side by side, of those that
    begin before the last whole one could (the first always); `least` where there is none."""
    size = max(1, int(seconds * rate))
    last = F.greatest(F.lit(0), F.ceil(F.greatest(F.lit(1), F.size(a) - size) / size).cast("int") - 1)
    stretches = F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(a, i * size + 1, F.lit(size)))
    levels = F.transform(stretches, rms)
    return F.when(F.size(a) >= size, F.greatest(percentile(levels, p), F.lit(least))).otherwise(F.lit(least))


def rms(a: Column) -> Column:
    return F.sqrt(F.coalesce(mean(F.transform(a, lambda x: x * x)), F.lit(0.0)) + F.lit(1e-12))


def peak(a: Column) -> Column:
    return F.coalesce(F.array_max(F.transform(a, lambda x: F.abs(x))), F.lit(0.0))


def clipping(a: Column, level: float = 0.999) -> Column:
    return F.when(F.size(a) > 0, F.size(F.filter(a, lambda x: F.abs(x) >= level)) / F.size(a)).otherwise(0.0)


def speech_mask(a: Column, rate: int, frame_ms: float, least: float) -> Column:
    """By energy: frames, half a frame apart, whose RMS is at least the 35th
    percentile and `least`; a sample is speech if one of its frames is. Audio
    under a frame is all speech."""
    size = max(1, int(rate * frame_ms / 1000))
    hop = max(1, size // 2)

    def spread(loud: Column) -> Column:
        first = lambda i: F.greatest(F.lit(0), F.ceil((i - size + 1) / hop).cast("int"))
        inside = lambda i: F.exists(F.sequence(first(i), F.greatest(first(i), F.floor(i / hop).cast("int"))), lambda j: F.coalesce(F.get(loud, j), F.lit(False)))
        return F.transform(F.sequence(F.lit(0), F.size(a) - 1), inside)

    marked = lambda levels: let(F.greatest(percentile(levels, 0.35), F.lit(least)), lambda bar: F.transform(levels, lambda x: x >= bar))
    every = let(F.transform(frames(a, size, hop), rms), lambda levels: let(marked(levels), spread))
    return F.when(F.size(a) < size, F.transform(a, lambda x: F.lit(True))).otherwise(every)


def stretch(a: Column, rate: int, start: Column, end: Column) -> Column:
    """The samples between two times, whole samples by truncation; none of an empty span."""
    first = F.greatest(F.lit(0), (start * rate).cast("int"))
    upto = F.least(F.size(a), (end * rate).cast("int"))
    return F.when(upto > first, F.slice(a, first + 1, upto - first)).otherwise(F.slice(a, 1, 0))


def snr_db(a: Column, mask: Column) -> Column:
    """-99 without speech, 30 where all is speech."""
    both = F.zip_with(a, mask, lambda x, m: F.struct(x.alias("x"), m.alias("m")))
    energy = lambda want: mean(F.transform(F.filter(both, lambda z: z["m"] == want), lambda z: z["x"] * z["x"]))
    speech, noise = energy(True), energy(False)
    return F.when(speech.isNull(), -99.0).when(noise.isNull(), 30.0).otherwise(10 * F.log10((speech + 1e-12) / (noise + 1e-12)))
