"""Scalar columns: coercion, names, paths, intervals and boxes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words that switch a manifest row off, and on.
OFF = ("0", "false", "no", "n")
OFF_LOCAL = ("0", "false", "no")
ON = ("1", "true", "yes", "y")


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def word(c: Column | str) -> Column:
    return F.lower(F.trim(_c(c).cast("string")))


def truthy(c: Column | str, off: tuple[str, ...] = OFF) -> Column:
    """Blank and null are true."""
    return ~F.coalesce(word(c), F.lit("")).isin(*off)


def flagged(c: Column | str) -> Column:
    return F.coalesce(word(c), F.lit("")).isin(*ON)


def number(c: Column | str, default: float | None = None) -> Column:
    """A double; text that is none, NaN and null become the default."""
    x = _c(c).try_cast("double")
    return F.coalesce(F.when(~F.isnan(x), x), F.lit(default).cast("double"))


def clip(c: Column, low: float = 0.0, high: float = 1.0) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), c))


def parts(c: Column | str, by: str = ";") -> Column:
    """Trimmed, non-empty parts of a list in one string."""
    return F.filter(F.transform(F.split(_c(c), by), lambda x: F.trim(x)), lambda x: x != "")


def year(c: Column | str) -> Column:
    text = F.trim(_c(c).cast("string"))
    return F.when(text.rlike(r"^\d+$"), text.try_cast("int"))


def spaced(c: Column | str) -> Column:
    """Trimmed, inner white space as one space."""
    return F.regexp_replace(F.trim(_c(c)), r"\s+", " ")


def folded(c: Column | str) -> Column:
    """A key that is equal whatever the case and accents."""
    return F.collate(spaced(c), "UNICODE_CI_AI")


def or_blank(c: Column | str, other: Column | str) -> Column:
    """c unless it is null, blank or 'nan'."""
    text = F.trim(_c(c).cast("string"))
    return F.when((text != "") & (F.lower(text) != "nan"), text).otherwise(_c(other))


def stem(c: Column | str) -> Column:
    return F.regexp_replace(F.regexp_extract(_c(c), r"([^/]*)$", 1), r"\.[^.]*$", "")


def safe_key(c: Column | str) -> Column:
    return F.regexp_replace(_c(c), r"[^\p{L}\p{N}_-]", "_")


def padded(c: Column | str, n: int) -> Column:
    return F.lpad(_c(c).cast("string"), n, "0")


def given(c: Column | str) -> Column:
    """Trimmed text; null where it is blank."""
    text = F.trim(_c(c).cast("string"))
    return F.when(text != "", text)


def canonical_path(speaker: Column | str, video: Column | str, utterance: Column | str, *paths: Column | str) -> Column:
    """wav/speaker/video/utterance.wav; without an utterance the first path that leads
    below a wav folder of dev, cut there; an error where there is none."""
    name = given(utterance)
    own = F.when(name.endswith(".wav"), name).otherwise(F.concat(name, F.lit(".wav")))
    built = F.concat_ws("/", F.lit("wav"), F.trim(_c(speaker).cast("string")), F.trim(_c(video).cast("string")), own)
    cut = []
    for p in paths:
        text = F.replace(given(p), F.lit("\\"), F.lit("/"))
        below = F.concat(F.lit("wav/"), F.regexp_extract(text, r"^.*?/dev/wav/(.*)$", 1))
        cut.append(F.when(text.contains("/dev/wav/"), below).when(text.startswith("dev/wav/"), F.substring(text, 5, 1 << 30)).when(text.startswith("wav/"), text))
    none = F.raise_error(F.lit("no path of an utterance, and none below a wav folder")).cast("string")
    return F.when(name.isNotNull(), built).otherwise(F.coalesce(*cut, none))


def relative_path(path: Column | str, root: str) -> Column:
    """Below `root` without it, elsewhere whole; with forward slashes."""
    whole = F.replace(_c(path), F.lit("\\"), F.lit("/"))
    top = root.rstrip("/") + "/"
    return F.when(whole.startswith(top), F.substring(whole, len(top) + 1, 1 << 30)).otherwise(whole)


def run_tag(now: Column, prefix: str = "coverage") -> Column:
    """A name for what one run makes: prefix and the time to the second."""
    return F.concat_ws("_", F.lit(prefix), F.date_format(now, "yyyyMMddHHmmss"))


def temporal_iou(a0, a1, b0, b1) -> Column:
    """Intersection over the hull, which is the union where they meet."""
    a0, a1, b0, b1 = map(_c, (a0, a1, b0, b1))
    hull = F.greatest(a1, b1) - F.least(a0, b0)
    return F.when(hull > 0, F.greatest(F.lit(0.0), F.least(a1, b1) - F.greatest(a0, b0)) / hull).otherwise(0.0)


def bbox_iou(a: Column, b: Column) -> Column:
    """Of structs x1, y1, x2, y2."""
    side = lambda lo, hi: F.greatest(F.lit(0.0), F.least(a[hi], b[hi]).cast("double") - F.greatest(a[lo], b[lo]).cast("double"))
    area = lambda x: (x["x2"].cast("double") - x["x1"].cast("double")) * (x["y2"].cast("double") - x["y1"].cast("double"))
    both = side("x1", "x2") * side("y1", "y2")
    return both / (area(a) + area(b) - both + F.lit(1e-6))


CORNERS = ("x1", "y1", "x2", "y2")


def box_of(*corners: Column) -> Column:
    return F.struct(*(c.alias(n) for n, c in zip(CORNERS, corners, strict=True)))


def crop_box(box: Column, margin: float, width: float, height: float, least: int = 32) -> Column:
    """A square around the box with a margin, whole pixels (half to even) within the
    frame; null if the box is none or the crop is small."""
    x1, y1, x2, y2 = (box[c].cast("double") for c in CORNERS)
    half = F.greatest(x2 - x1, y2 - y1) * (1 + 2 * margin) / 2
    cx, cy = (x1 + x2) / 2, (y1 + y2) / 2
    whole = lambda c: F.bround(c, 0).cast("int")
    a, b = F.greatest(F.lit(0), whole(cx - half)), F.greatest(F.lit(0), whole(cy - half))
    c, d = F.least(F.lit(int(width)), whole(cx + half)), F.least(F.lit(int(height)), whole(cy + half))
    return F.when((x2 > x1) & (y2 > y1) & (c - a >= least) & (d - b >= least), box_of(a, b, c, d))


def face_crop(box: Column, width: int, height: int, margin: float = 0.3) -> Column:
    """The box with a margin of its width and height, whole pixels within the frame."""
    x1, y1, x2, y2 = (box[c].cast("int") for c in CORNERS)
    mw, mh = ((x2 - x1) * margin).cast("int"), ((y2 - y1) * margin).cast("int")
    a, b = F.greatest(F.lit(0), x1 - mw), F.greatest(F.lit(0), y1 - mh)
    c, d = F.least(F.lit(width), x2 + mw), F.least(F.lit(height), y2 + mh)
    return F.when((c > a) & (d > b), box_of(a, b, c, d))


def mouth_box(box: Column, width: int, height: int, margin: float = 0.35) -> Column:
    """The lower middle of a face: from 0.20 to 0.80 of its width and from 0.55 to 0.92
    of its height, with a margin, whole pixels within the frame; null if it is empty."""
    x1, y1 = (F.greatest(F.lit(0), box[c].cast("int")) for c in ("x1", "y1"))
    x2, y2 = F.least(F.lit(width - 1), box["x2"].cast("int")), F.least(F.lit(height - 1), box["y2"].cast("int"))
    part = lambda share, size: (F.lit(share) * size).cast("int")
    w, h = x2 - x1, y2 - y1
    left, right, top, low = x1 + part(0.20, w), x2 - part(0.20, w), y1 + part(0.55, h), y1 + part(0.92, h)
    mw, mh = part(margin, right - left), part(margin, low - top)
    a, b = F.greatest(F.lit(0), left - mw), F.greatest(F.lit(0), top - mh)
    c, d = F.least(F.lit(width), right + mw), F.least(F.lit(height), low + mh)
    return F.when((x2 > x1) & (y2 > y1) & (c > a) & (d > b), box_of(a, b, c, d))


def corner_box(box: Column) -> Column:
    """x, y, width, height (1 at least) where the second corner lies before the first:
    as corners."""
    x1, y1, x2, y2 = (box[c].cast("double") for c in CORNERS)
    side = lambda c: F.greatest(F.lit(1.0), c)
    repaired = box_of(x1, y1, x1 + side(x2), y1 + side(y2))
    return F.when((x2 <= x1) | (y2 <= y1), repaired).otherwise(box_of(x1, y1, x2, y2))


def centred(start: Column, end: Column, length: float, low: Column, high: Column) -> Column:
    """A window of this length around the middle of [start, end], within [low, high]."""
    at = F.greatest(low, F.least((start + end) / 2 - length / 2, high - length))
    return F.struct(at.alias("start"), F.least(high, at + length).alias("end"))
