"""Awkward rows, very long texts, clashing names, and models recomputed by hand."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from cliploom.llm import binpack, bksimhash, bpedp, common, dcsuffix, exthash, fragments, hdlang, mih, prefixes, secretidx, superkmer, toxseg

rng = random.Random(11)
SAY = {"aa": ["lorem", "ipsum", "dolor", "amet", "velit"], "bb": ["quick", "brown", "jumps", "zwölf", "lazy"]}


def said(lang, n):
    return " ".join(rng.choice(SAY[lang]) for _ in range(n))


def sha(x):
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


@pytest.fixture(scope="module")
def twice(spark):
    """Rows that repeat, a null id, and columns named as the operators might name theirs."""
    rows = [(1, said("aa", 40)), (1, said("aa", 40)), (None, said("bb", 40)), (2, None), (2, None), (3, "")]
    rows = rows + [rows[0]] + [(10 + i, said("ab"[i % 2] * 2, 30)) for i in range(20)]
    names = ("share", "at", "gone", "keep", "told_lang", "told_score", "h", "bucket", "least", "key", "group", "text_", "lang_pred")
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs = docs.withColumn("lang", F.when(F.col("doc_id") >= 10, F.when(F.col("doc_id") % 2 == 0, "aa").otherwise("bb")))
    return docs.withColumns({c: F.lit("clash") for c in names}).withColumn("n_chars", F.length("text").cast("long"))


def test_every_operator_takes_repeated_rows_null_ids_and_clashing_names(twice):
    n = twice.count()
    labels = twice.where("doc_id >= 10").select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic"), F.lit("x").alias("at"))
    for out in (superkmer.kept_words(twice, texts=False), dcsuffix.kept_bytes(twice), hdlang.identify(twice), toxseg.score(twice, toxseg.fit(twice, labels)), bpedp.encode_digests(twice), bksimhash.near_groups(twice), exthash.exact_groups(twice), secretidx.secret_digests(twice)):
        rows = out.collect()
        assert len(rows) == n and sum(r["doc_id"] is None for r in rows) == 1
    packed = binpack.pack(twice).collect()
    assert sum(r["length"] for r in packed) == sum(r["doc_tokens"] for r in packed if r["start"] == 0)
    for out in (hdlang.with_language(twice), exthash.dedup(twice), bksimhash.dedup(twice), secretidx.redact(twice)):
        assert out.columns == twice.columns and out.count() > 0


def test_op9_ids_that_repeat_share_a_verdict(spark):
    rows = [(1, "a"), (2, "a"), (1, "b"), (3, "c"), (None, "c"), (None, "d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r["doc_id"], r["text_sha256"]): (r["keep_id"], r["group_size"], r["kept"]) for r in exthash.exact_groups(docs).collect()}
    assert got == {(1, sha("a")): (2, 2, False), (2, sha("a")): (2, 2, True), (1, sha("b")): (1, 1, True), (3, sha("c")): (3, 2, True), (None, sha("c")): (3, 2, False), (None, sha("d")): (None, 1, True)}
    assert sorted((r["doc_id"] or 0, r["text"]) for r in exthash.dedup(docs).collect()) == [(0, "c"), (0, "d"), (1, "a"), (1, "b"), (2, "a"), (3, "c")]


def test_op9_index_lies_in_its_owners_files_and_follows_the_directory(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), (F.col("id") % 2500).cast("string")).alias("text"))
    keys = exthash.keys_of(docs)
    index, directory = exthash.build_index(docs, keys, 100)
    rows = index.withColumn("file", F.input_file_name()).collect()
    assert len(rows) == 2500 and sum(r["group_size"] for r in rows) == 3000
    files, held = {}, {}
    for r in rows:
        slot = (r["h"] % (1 << 64)) >> (64 - exthash.MAX_DEPTH)
        assert directory.entries[slot][0] == r["bucket"]  # what a probe follows
        files.setdefault(r["bucket"], set()).add(r["file"])
        held[r["bucket"]] = held.get(r["bucket"], 0) + 1
    assert len(held) > 20 and all(len(f) == 1 for f in files.values()) and max(held.values()) <= 100


def test_op9_texts_of_one_hash_are_links_of_one_chain(spark, monkeypatch):
    real = F.xxhash64
    monkeypatch.setattr(exthash.F, "xxhash64", lambda *c: real(F.substring(c[0], 1, 1)) if c == ("text",) else real(*c))
    docs = spark.createDataFrame([(1, "ab"), (2, "ac"), (3, "ab"), (4, "x"), (5, "")], "doc_id long, text string")
    keys = exthash.keys_of(docs)
    index, _ = exthash.build_index(docs, keys)
    chains = {}
    for r in index.collect():
        chains.setdefault(r["h"], []).append(r["link"])
    assert sorted(map(sorted, chains.values())) == [[1], [1], [1, 2]]
    got = {r["doc_id"]: (r["keep_id"], r["group_size"]) for r in exthash.exact_groups(docs).collect()}
    assert got == {1: (3, 2), 2: (2, 1), 3: (3, 2), 4: (4, 1), 5: (5, 1)}


@pytest.mark.parametrize("bound", ["FEW", "FEW_IDS"])
def test_op9_without_broadcasts(spark, sf, monkeypatch, bound):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    plain = sorted(map(tuple, exthash.exact_groups(docs).drop("bucket").collect()))
    monkeypatch.setattr(exthash, bound, -1)
    assert sorted(map(tuple, exthash.exact_groups(docs).drop("bucket").collect())) == plain
    assert exthash.dedup(docs).count() == sum(r[3] for r in plain)


def brute(rows, every, k):
    """Rows are (vec_id, vector); a query finds every row but itself."""
    units = np.asarray([v for _, v in rows])
    units = units / np.linalg.norm(units, axis=1, keepdims=True)
    ids, out = np.asarray([i for i, _ in rows]), []
    for q in np.flatnonzero(ids % every == 0):
        near = units @ units[q]
        near[q] = -9
        out.append((int(ids[q]), [round(float(s), 9) for s in sorted(near, reverse=True)[:k]]))
    return sorted(out)


def test_op1_mixed_lengths_and_repeated_ids(spark):
    g = np.random.default_rng(5)
    rows = [(i % 40, g.normal(size=8).tolist()) for i in range(60)]  # 0 and others ask twice
    rows += [(0, g.normal(size=9).tolist()) for _ in range(3)] + [(20, [1.0])]
    rows.append((100, rows[0][1]))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({"shard": F.lit("clash"), "row": F.lit("clash")})
    got = {}
    for r in mih.self_search(df, 20, 3).orderBy("query_id", "rank").collect():
        got.setdefault((r["query_id"], r["rank"]), []).append(round(r["score"], 9))
    want = {}
    for q, scores in brute([r for r in rows if len(r[1]) == 8], 20, 3):
        for rank, s in enumerate(scores, 1):
            want.setdefault((q, rank), []).append(s)
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    assert got[0, 1] and 1.0 in got[0, 1]  # the copy of vector 0 under another id


def test_op1_shards_change_no_exact_result(spark, monkeypatch):
    g = np.random.default_rng(6)
    rows = [(i, g.normal(size=16).tolist()) for i in range(400)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    monkeypatch.setattr(mih, "COVER", 1.0)
    plain = sorted(map(tuple, mih.self_search(df).collect()))
    monkeypatch.setattr(mih, "SHARD_ROWS", 30)
    monkeypatch.setattr(mih, "SHARDS", 7)
    assert len(plain) == 40 and mih._shards(400, 16) == 7
    cut = sorted(map(tuple, mih.self_search(df).collect()))
    same = len({r[:3] for r in plain} & {r[:3] for r in cut})
    assert same >= 38


def test_op1_shards_grow_before_they_multiply():
    assert [mih._shards(n, 64) for n in (2, 8192, 100_000, 500_000, 1_000_000)] == [1, 1, 13, 62, 64]
    assert mih._shards(100_000_000, 64) == -(-100_000_000 // ((64 << 20) // 512))


def test_op3_against_prototypes_computed_by_hand(spark):
    rows = [(i, said("aa" if i % 2 else "bb", 25), "aa" if i % 2 else "bb") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    d, seed = 1024, 7

    def letter(code):
        return np.random.default_rng([seed, code]).integers(0, 2, d, np.int8) * 2 - 1

    def bundle(text):
        letters = [ord(c) if c.isalpha() else 0 for c in f" {text.lower()} "]
        out = np.zeros(d)
        for a, b, c in zip(letters, letters[1:], letters[2:]):
            out += np.roll(letter(a), 2).astype(float) * np.roll(letter(b), 1) * letter(c)
        return out / np.linalg.norm(out)

    sums = {"aa": np.zeros(d), "bb": np.zeros(d)}
    for i, text, lang in rows:
        if zlib.crc32(str(i).encode()) % 4 != 2:
            sums[lang] += bundle(text)
    sums = {k: v / np.linalg.norm(v) for k, v in sums.items()}
    mean = (sums["aa"] + sums["bb"]) / 2
    prototypes = {k: (v - mean) / np.linalg.norm(v - mean) for k, v in sums.items()}
    got = {r["doc_id"]: r for r in hdlang.identify(docs).collect()}
    for i, text, _ in rows:
        near = {k: float(p @ bundle(text)) for k, p in prototypes.items()}
        best = max(near, key=near.get)
        assert got[i]["lang_pred"] == best and got[i]["score"] == pytest.approx(near[best], abs=1e-4)


def test_language_stage_rejects_only_what_resembles_nothing(spark):
    noise = " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6)) for _ in range(300))
    long = {k: [said(k, 20) + " " + " ".join(w[::-1] + w for w in rng.sample(v, 3)) for _ in range(60)] for k, v in SAY.items()}
    rows = [(i, t, k) for i, (t, k) in enumerate((t, k) for k, v in long.items() for t in v)]
    rows += [(900, noise, None), (901, said("aa", 200), None), (902, "zzz", None), (903, "12 !!", None), (904, None, "aa")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = {r["doc_id"]: r["lang"] for r in hdlang.with_language(docs).collect()}
    assert set(range(120)) <= set(kept) and kept[901] == "aa" and 902 in kept and not {903, 904} & set(kept)
    assert {r["doc_id"] for r in hdlang.with_language(docs.drop("lang")).collect()} >= {900, 901, 902}
    assert "lang" not in hdlang.with_language(docs.drop("lang")).columns
    nothing = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r["doc_id"] for r in hdlang.with_language(nothing).collect()} == {r[0] for r in rows} - {903, 904}


def test_op4_segments_have_the_spans_of_the_definition():
    """All maximal segments, by divide and conquer over exact binary fractions."""
    for _ in range(400):
        x = np.asarray([rng.choice([-1.0, -0.5, -0.25, 0.5, 1.0, 2.0]) for _ in range(rng.randint(0, 24))])

        def spans(lo, hi):
            best = max(((x[i:j].sum(), i - j, -i) for i in range(lo, hi) for j in range(i + 1, hi + 1)), default=(0, 0, 0))
            if best[0] <= 0:
                return []
            i = -best[2]
            j = i - best[1]
            return [*spans(lo, i), (float(best[0]), i, j), *spans(j, hi)]

        mine = toxseg.maximal_segments(x)
        assert sorted(s for s, _, _ in mine) == sorted(s for s, _, _ in spans(0, len(x)))
        for s, a, b in mine:  # no prefix or suffix of a maximal segment sums to 0 or less
            assert s == x[a:b].sum() and all(x[a:k].sum() > 0 for k in range(a + 1, b + 1)) and all(x[k:b].sum() > 0 for k in range(a, b))
        ends = [(a, b) for _, a, b in mine]
        assert ends == sorted(ends) and all(p[1] <= q[0] for p, q in zip(ends, ends[1:]))


def test_op4_chance_and_score_are_the_formulas(spark):
    bad = ["vile", "scummy", "rotten"]
    rows = [(i, said("aa", 30) + (" " + " ".join(rng.choices(bad, k=3)) if i % 3 == 0 else ""), int(i % 3 == 0)) for i in range(200)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    model = toxseg.fit(docs, spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int"))
    scores = toxseg.Scores(model.lexicon)
    found = {r["doc_id"]: r["score"] for r in toxseg.score(docs, model).collect()}
    said_passages = {}
    for r in toxseg.passages(docs, model).collect():
        said_passages.setdefault(r["doc_id"], []).append(r)
    for i, text, _ in rows:
        x = np.asarray([scores[w] for w in re.findall(r"[^\W\d_]+", text.lower())])
        best = [(x[a:b].sum(), a, b) for _, a, b in toxseg.maximal_segments(x)]
        chances = [1 - np.exp(-model.scale * len(x) * np.exp(-model.decay * s)) for s, _, _ in best]
        features = np.zeros(3)
        if best:
            strong = sum(s for (s, _, _), p in zip(best, chances) if p < toxseg.CHANCE)
            features = np.asarray([min(30.0, -np.log10(max(min(chances), 1e-30))), np.log1p(strong), np.log1p(max(s for s, _, _ in best))])
        z = model.weights[0] + model.weights[1:] @ features
        assert found[i] == pytest.approx(1 / (1 + np.exp(-np.clip(z, -40, 40))), rel=1e-6)
        want = {(a, b - 1) for (_, a, b), p in zip(best, chances) if p < toxseg.CHANCE}
        assert {(r["first"], r["last"]) for r in said_passages.get(i, [])} == want


def test_op6_and_op2_passages_behind_very_long_texts(spark):
    g = np.random.default_rng(3)
    passage = bytes(g.integers(97, 123, 400, np.uint8)).decode()
    long = bytes(g.integers(97, 123, (1 << 24) + 4000, np.uint8)).decode() + passage
    docs = spark.createDataFrame([(1, "x" + passage), (2, long), (3, "short")], "doc_id long, text string")
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in dcsuffix.kept_bytes(docs).collect()}
    assert got[2] == (len(long), 400, 1, sha(long[:-400])) and got[1][1] == 0 and got[3] == (5, 0, 0, sha("short"))


def test_op2_minimisers_of_texts_over_2_to_the_24_words():
    g, n = np.random.default_rng(4), (1 << 24) + 500
    letters = g.integers(97, 123, 2 * n, np.uint8)
    letters[1::2] = 32
    letters[-600:] = letters[2000:2600]
    texts = superkmer.read_words([letters.tobytes()])
    _, first, _, sizes, least, _, _ = fragments.fragments_of(texts, 20, 3)
    of = np.repeat(least, sizes)
    assert len(of) == n - 19 and (of[-281:] == of[1000:1281]).all()


def test_op8_bitmaps_rule_out_no_pair():
    g = np.random.default_rng(9)
    for n in (1, 5, 60, 900, 20_000):
        a = np.unique(g.integers(0, 1 << 63, n, np.uint64))
        for changed in (0, 1, max(1, n // 10), n):
            b = np.unique(np.append(a[changed:], g.integers(0, 1 << 63, changed, np.uint64)))
            far = prefixes.differing(prefixes.bitmap(a), prefixes.bitmap(b))
            assert far <= len(np.setxor1d(a, b)) and (changed or not far)
    a, b = g.integers(0, 1 << 63, 300, np.uint64), g.integers(0, 1 << 63, 3000, np.uint64)
    assert prefixes.differing(prefixes.bitmap(a), prefixes.bitmap(b)) == prefixes.differing(prefixes.bitmap(b), prefixes.bitmap(a))
    assert prefixes.differing(prefixes.bitmap(a), prefixes.bitmap(b[:300])) > 100


#: The contract's own patterns, spelled out.
CONTRACT = (
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 8),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 16),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 32),
)


def test_op10_base_spans_are_the_contracts(spark, sf):
    more = [(-1, 'Token="abcd1234" token:x PASSWD = \'0123456789ab\'x' + "f" * 40), (-2, "AKIA" + "Z9" * 8 + "ñ" + "AKIA1"), (-3, None), (-4, "ſecret=abcdefghij secret : abcdefgh")]
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").union(spark.createDataFrame(more, "doc_id long, text string"))
    got = {r["doc_id"]: r for r in secretidx.secret_digests(docs).collect()}
    total = 0
    for r in docs.collect():
        spans = []
        for order, (kind, pattern, group, least) in enumerate(CONTRACT):
            spans += [(m.start(), order, m.end(), kind) for m in pattern.finditer(r["text"] or "") if len(m[group]) >= least]
        spans.sort()
        total += len(spans)
        row = got[r["doc_id"]]
        assert [row["n_assign"], row["n_access"], row["n_hex"]] == [sum(s[1] == k for s in spans) for k in range(3)]
        assert row["base_sha256"] == sha(",".join(f"{kind}:{a}:{b}" for a, _, b, kind in spans))
        base = [x for x in row["spans"].split(",") if x.split(":")[0] in {c[0] for c in CONTRACT}]
        assert base == [f"{kind}:{a}:{b}" for a, _, b, kind in spans]
    assert total >= 5


def test_op10_added_rules_against_plain_scans(spark):
    pieces = ["gh" + "p_" + "a" * 36, "xox" + "b-" + "1a" * 8, "Bearer " + "Zz9" * 9, "-----BEGIN RSA PRIVATE KEY-----", "-----BEGIN KEY-----", "eyJ" + "a" * 9 + "." + "b" * 9 + "." + "c" * 9, "plain words", "bearer of news", "gh" + "p_short"]
    rows = [(i, " ".join(rng.choices(pieces, k=6))) for i in range(60)]
    got = {r["doc_id"]: r["spans"] for r in secretidx.find_secrets(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, text in rows:
        want = []
        for order, rule in enumerate(secretidx.RULES):
            pattern = re.compile(rule.pattern, re.A | (re.I if rule.fold else 0))
            want += [(m.start(), order, m.end()) for m in pattern.finditer(text) if len(m[rule.group]) >= rule.least]
        assert [(s["start"], s["kind"], s["stop"]) for s in got[i]] == [(a, secretidx.RULES[k].kind, b) for a, k, b in sorted(want)]


def test_op10_syntax_that_is_not_known_scans_all():
    for pattern in (r"(?i)abc", r"abc\b", r"^abcd", r"(abc", r"a(?=bcd)"):
        assert secretidx.trigram_query(pattern) == secretidx.ANY
    assert secretidx.trigram_query(r"[^a]bcd") == ("tri", "bcd") and secretidx.trigram_query(r"ab{1}c") == ("tri", "abc")
    assert secretidx.trigram_query(r"(abc|xyz)+") == ("or", (("tri", "abc"), ("tri", "xyz")))


def test_the_shared_folder_must_be_told_on_a_cluster(spark, monkeypatch):
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError):
        common.shared_dir(Session())
    assert common.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_written_tables_are_deleted_when_released(spark):
    mark = common.held()
    a, b = common.written(spark.range(3), "a"), common.written(spark.range(4), "b")
    common.release(a, spark.range(1))
    assert common.held() == mark + 1 and b.count() == 4
    common.release_since(spark, mark)
    assert common.held() == mark
    with pytest.raises(Exception):
        spark.read.parquet(b.folder).count()


def test_sample_of_the_most_frequent_labels(spark, monkeypatch):
    monkeypatch.setattr(common, "MOST_LABELS", 2)
    df = spark.range(900).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 9 == 0, "rare").when(F.col("id") % 2 == 0, "a").otherwise("b").alias("y"))
    assert {r["y"]: r["count"] for r in common.bounded_sample(df, "y", 50).groupBy("y").count().collect()} == {"a": 50, "b": 50}
