"""A sample for human review, and pages and reports from bounded results."""

from __future__ import annotations

import html
from pathlib import Path

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import number

#: What a clip is most at risk by, ascending, as far as it is there.
RISK = ("syncnet_confidence", "face_margin", "snr_db")


def risk_order(df: DataFrame) -> list[Column]:
    """Riskiest first; unknown values last."""
    return [F.asc_nulls_last(number(c)) for c in RISK if c in df.columns]


def boundary_sample(df: DataFrame, k: int, seed: str, key: str, by: str = "speaker_id") -> DataFrame:
    """Of each group its riskiest max(1, k // 2) rows and the others up to k by
    hash: rows with `part` head or draw."""
    head = max(1, k // 2)
    placed = df.withColumn("__at", F.row_number().over(Window.partitionBy(by).orderBy(*risk_order(df), key)))
    rest = F.col("__at") > head
    drawn = F.md5(F.concat_ws("|", F.lit(seed), F.col(key).cast("string")))
    draw = F.row_number().over(Window.partitionBy(by, rest).orderBy(drawn, key))
    chosen = placed.withColumn("__draw", draw).where(~rest | (F.col("__draw") <= k - head))
    return chosen.withColumn("part", F.when(rest, F.lit("draw")).otherwise(F.lit("head"))).drop("__at", "__draw")


#: The columns of the page, each with a number's places, and where it is
#: missing its value.
PAGE = (("speaker_id", None, ""), ("speaker_name", None, ""), ("video_id", None, ""), ("candidate_idx", None, ""), ("time", None, ""), ("rank_score", 3, 0.0), ("snr_db", 1, 0.0), ("vad_ratio", 2, 0.0), ("face_margin", 3, -1.0), ("syncnet_confidence", 3, -1.0), ("sha1", None, ""))


def page_rows(df: DataFrame) -> DataFrame:
    """The page's cells as escaped text, and audio, the path for the player; a missing
    column is empty or its default."""
    there = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")) if c in df.columns else F.lit("")
    told = lambda c, default: number(c, default) if c in df.columns else F.lit(default)
    cells = []
    for name, places, default in PAGE:
        if name == "time":
            value = F.format_string("%.2f-%.2f", told("start", 0.0), told("end", 0.0))
        elif places is not None:
            value = F.format_string(f"%.{places}f", told(name, default))
        else:
            value = there(name)
        cells.append(escaped(value).alias(name))
    return df.select(*cells, escaped(there("candidate_path")).alias("audio"))


def escaped(c: Column) -> Column:
    """As text in HTML, quotes included."""
    for mark, said in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        c = F.replace(c, F.lit(mark), F.lit(said))
    return c


def html_page(df: DataFrame, path: str | Path, title: str = "Review") -> int:
    """Rows streamed to one page, every value escaped; the number of rows."""
    n = 0
    with open(path, "w", encoding="utf-8") as f:
        names = "".join(f"<th>{html.escape(c)}" for c in df.columns)
        f.write(f"<!doctype html><meta charset=utf-8><title>{html.escape(title)}</title><table><tr>{names}\n")
        for row in df.toLocalIterator():
            f.write(f"<tr>{''.join(f'<td>{html.escape(str(v))}' for v in row)}\n")
            n += 1
        f.write("</table>\n")
    return n


def review_page(df: DataFrame, path: str | Path, title: str = "Review of candidates") -> int:
    """The page of candidates with a player for each clip, in the order of df."""
    n, rows = 0, page_rows(df)
    with open(path, "w", encoding="utf-8") as f:
        names = "".join(f"<th>{html.escape(c)}" for c in rows.columns)
        f.write(f"<!doctype html><meta charset=utf-8><title>{html.escape(title)}</title><table><tr>{names}\n")
        for *cells, audio in rows.toLocalIterator():
            f.write(f"<tr>{''.join(f'<td>{c}' for c in cells)}<td><audio controls src=\"{audio}\"></audio>\n")
            n += 1
        f.write("</table>\n")
    return n


def markdown(title: str, summary: DataFrame, rules: DataFrame) -> str:
    """A one-row summary and the expectations; the caller raises after writing it."""
    row = summary.first().asDict()
    told = [f"- {k}: {v}" for k, v in row.items()]
    found = [f"| {r['rule']} | {r['violations']} |" for r in rules.collect()]
    return "\n".join([f"# {title}", "", *told, "", "| rule | violations |", "|-|-|", *found]) + "\n"
