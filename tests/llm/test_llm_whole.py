"""The language stage learns from every labelled document, not from a sample."""

import numpy as np

from cliploom.llm import hdlang

#: Two languages; of the second, texts of two kinds, one of which no small sample has.
A, B, C = "alda almo danu mira solen", "borek kreb tubok grod vekk", "xyzzy quux wyzz jyq zaxu"


def test_language_stage_learns_from_all(spark, monkeypatch):
    rows = [(i, f"{A} {i}", "aa") for i in range(40)] + [(100 + i, f"{B} {i}", "bb") for i in range(40)]
    rows += [(200 + i, f"{C} {C} {i}", "bb") for i in range(40)] + [(900, C, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    seen, fit = [], hdlang.fit
    monkeypatch.setattr(hdlang, "fit", lambda d, *a: (seen.append(d.count()), fit(d, *a))[1])
    # a sample of one text a language where a sample is taken
    monkeypatch.setattr(hdlang.learned, "__defaults__", (1,))
    kept = {r["doc_id"]: r["lang"] for r in hdlang.with_language(docs).collect()}
    assert seen == [hdlang.taught(docs).count()] and seen[0] > 60
    assert kept[900] == "bb" and len(kept) == len(rows)


def test_usual_score_counts_every_row(spark):
    scores = np.random.default_rng(3).random(5000)
    found = hdlang.usual_score(spark.createDataFrame([(float(x),) for x in scores], "score double"))
    exact = float(np.sort(scores)[int(0.01 * (len(scores) - 1))])
    assert exact - 1 / hdlang.STEPS <= found <= exact
    assert hdlang.usual_score(spark.createDataFrame([], "score double")) == 0.0
