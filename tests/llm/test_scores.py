"""Languages, toxicity, quality: held-out accuracy and small cases."""

import math
import os
import random
import re
import zlib

import numpy as np
import pytest
from helpers import odd_rows, rows_of, table
from pyspark.sql import functions as F

from tidemark.llm import fitting, langid, quality, queries, toxicity


def held(doc_id, remainder, of):
    return zlib.crc32(str(doc_id).encode()) % of == remainder


def ranked_above(scores, labels):
    """Share of pairs of a 1 and a 0 in which the 1 scores higher."""
    ones = [s for s, y in zip(scores, labels) if y]
    zeros = [s for s, y in zip(scores, labels) if not y]
    return np.mean([(a > b) + 0.5 * (a == b) for a in ones for b in zeros])


@pytest.fixture
def mid(sf):
    """A table large enough to measure accuracy on."""
    larger = sf.replace("sf0.001", "sf0.01")
    return larger if os.path.isdir(larger) else sf


@pytest.fixture
def large(sf):
    """Labelled rows enough to count the misses."""
    larger = sf.replace("sf0.001", "sf0.1")
    if not os.path.isdir(larger):
        pytest.skip("no large table")
    return larger


# Languages


def test_language_of_held_out_rows(spark, mid):
    sf = mid
    found = queries.op1_language_id(spark, sf).collect()
    truth = dict(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").collect())
    assert len(found) == len(truth)
    assert all(r["held_out"] == held(r["doc_id"], 0, 5) and 0 <= r["score"] <= 1 for r in found)
    out = [r for r in found if r["held_out"] and truth[r["doc_id"]]]
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in out]) > 0.95


def test_language_odd_rows(spark):
    draw = random.Random(2)
    rows = [(100 + i, " ".join(draw.choice(("the", "of", "ing")) for _ in range(20)), "s", "aa") for i in range(20)]
    rows += [(200 + i, " ".join(draw.choice(("der", "und", "ß")) for _ in range(20)), "s", "bb") for i in range(20)]
    rows += [(300, "zzz", "s", None), (301, None, "s", "aa")]
    model = langid.train(table(spark, rows))
    assert model.langs == ("aa", "bb")
    odd = odd_rows() + [(50, "the of the"), (51, "der und ß"), (52, "123 !?"), (53, "ß" * 600_000)]
    got = dict(rows_of(langid.predict(table(spark, [r for r in odd if r[0] != 5]), model), "doc_id", "lang_pred"))
    assert got[50] == "aa" and got[51] == "bb" and got[53] == "bb"
    assert {got[i] for i in (1, 2, 3, 52, 15)} == {"und"}
    assert langid.train(table(spark, [(1, None), (2, "x", "s", None)])) is None
    nothing = langid.predict(table(spark, [(1, "some words")]), None).first()
    assert (nothing["lang_pred"], nothing["score"]) == ("und", 0.0)
    assert langid.predict(table(spark, []), model).count() == 0


def test_counts_do_not_depend_on_chunks(monkeypatch):
    text = "".join(random.Random(1).choice("abcdé ß") for _ in range(3000))
    whole = langid._counts(text, (1, 2, 3), 1 << 10)
    monkeypatch.setattr(langid, "CHUNK", 100)
    assert (langid._counts(text, (1, 2, 3), 1 << 10) == whole).all()
    assert whole.sum() == 3000 + 2999 + 2998


def test_languages_equal_plain(spark, sf):
    """Training and scores by counting n-grams one by one."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang").collect()

    def grams(text):
        codes = np.array([ord(c) for c in text.lower()], np.uint32)
        return [int(b) for n in (1, 2, 3) for i in range(len(codes) - n + 1) for b in langid.buckets(codes[i : i + n], (n,), 1 << 15)]

    few = [r for r in docs if len(r["text"] or "") < 400]
    found = {}
    model = langid.train(spark.createDataFrame(few, "doc_id bigint, text string, lang string"))
    for r in langid.predict(spark.createDataFrame(few, "doc_id bigint, text string, lang string"), model).collect():
        found[r["doc_id"]] = r["lang_pred"], r["score"]
    learn = [r for r in few if r["lang"] is not None and r["text"] is not None]
    langs = sorted({r["lang"] for r in learn})
    counts, seen = {g: {} for g in langs}, dict.fromkeys(langs, 0)
    for r in learn:
        seen[r["lang"]] += 1
        for b in grams(r["text"]):
            counts[r["lang"]][b] = counts[r["lang"]].get(b, 0) + 1
    total = {g: sum(counts[g].values()) + 0.1 * (1 << 15) for g in langs}
    for r in few:
        if not any(map(str.isalpha, r["text"] or "")):
            assert found[r["doc_id"]] == ("und", 0.0)
            continue
        logs = [math.log(seen[g] / len(learn)) for g in langs]
        for b in grams(r["text"]):
            for k, g in enumerate(langs):
                logs[k] += math.log((counts[g].get(b, 0) + 0.1) / total[g])
        best = max(range(len(langs)), key=lambda k: logs[k])
        assert found[r["doc_id"]][0] == langs[best]
        assert found[r["doc_id"]][1] == pytest.approx(1 / sum(math.exp(v - logs[best]) for v in logs), abs=1e-3)


def test_posterior_is_naive_bayes(spark):
    rows = [(i, t, "s", lang) for i, (t, lang) in enumerate([("ab ab", "x"), ("ba", "y"), ("abba", "x")])]
    model = langid.train(table(spark, rows), sizes=(1, 2))
    scores = langid._scores(["ab", "ba"], model)
    for i, text in enumerate(("ab", "ba")):
        n = langid._counts(text, (1, 2), len(model.matrix))
        assert np.allclose(scores[i], model.priors + n @ model.matrix)
    assert np.allclose(np.exp(model.matrix).sum(axis=0), 1, atol=1e-3)


# Toxicity


def test_toxicity_of_held_out_rows(spark, large):
    sf = large
    found = {r["doc_id"]: r for r in queries.op8_toxicity(spark, sf).collect()}
    labels = dict(spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic").collect())
    assert all(r["held_out"] == held(i, 2, 4) and r["predicted"] == (r["score"] >= 0.3) for i, r in found.items())
    out = [i for i in labels if held(i, 2, 4)]
    toxic = {i for i in out if labels[i]}
    said = {i for i in out if found[i]["predicted"]}
    assert len(toxic) > 30 and len(said & toxic) >= 0.97 * len(said)
    assert len(said & toxic) >= 0.91 * len(toxic)


def plain_toxicity(rows, labels):
    """Scores by counting, weighing and matching word by word, without automata or tables."""
    texts = {}
    for i, t in rows:
        if labels.get(i) is not None and not held(i, 2, 4):
            texts[i] = t or ""
    forms = lambda t: {f for f in (toxicity.fold(t), toxicity.bare(toxicity.fold(t)))}
    counts, sizes = ({}, {}), [0, 0]
    for i, t in texts.items():
        sizes[labels[i]] += 1
        for s in {w[:k] for f in [toxicity.fold(t)] for w in re.findall(r"[^\W\d_]+", f) for k in range(3, min(12, len(w)) + 1)}:
            counts[labels[i]][s] = counts[labels[i]].get(s, 0) + 1
    often = {s: n for s, n in counts[1].items() if n >= 4}
    stems = dict(toxicity.choose_stems(often, counts[0], sizes[1], sizes[0]))

    def feature(text):
        folded, total, both = toxicity.fold(text), 0.0, forms(text)
        hidden, seeds = set(), list(map(toxicity.fold, toxicity.SEED))
        for phrase in map(toxicity.fold, toxicity.EXCEPTIONS):
            for f in both:
                for m in re.finditer(rf"(?<![^\W\d_]){re.escape(phrase)}(?![^\W\d_])", f):
                    hidden.update(range(*m.span()))
        starts = [k for k in range(len(folded)) if folded[k].isalpha() and not (k and folded[k - 1].isalpha())]
        for k in starts:
            hits = [f[k : k + n] for f in both for n in range(1, 13) if f[k : k + n] in stems and len(f) >= k + n]
            hits = [h for h in hits if folded.startswith(h, k) or any(h.startswith(z) or z.startswith(h) for z in seeds)]
            if hits and not set(range(k, k + max(map(len, hits)))) <= hidden:
                total += stems[max(hits, key=len)]
        return math.log1p(max(0.0, total) / math.sqrt(len(text.split()) + 1))

    x = np.array([feature(t) for t in texts.values()])
    beta = fitting.logistic(x[:, None], np.array([labels[i] for i in texts], float))
    return {i: float(fitting.probability(np.array([[feature(t or "")]]), beta)[0]) for i, t in rows}


def test_toxicity_equals_plain(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    rows = [(r["doc_id"], r["text"]) for r in docs]
    labels = dict(spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic").collect())
    want = plain_toxicity(rows, labels)
    for r in queries.op8_toxicity(spark, sf).collect():
        assert r["score"] == pytest.approx(want[r["doc_id"]], abs=1e-9)


def toxic_rows():
    draw = random.Random(3)
    calm = [f"{a}{b}" for a in "bdgklmnprt" for b in ("am", "el", "ir", "on")]
    rows, labels = [], []
    for i in range(400):
        words = [draw.choice(calm) for _ in range(30)]
        toxic = int(i % 8 == 0)
        if toxic:
            for _ in range(3):
                words[draw.randrange(30)] = draw.choice(("zorgen", "zorgs", "vexil"))
        rows.append((i, " ".join(words)))
        labels.append((i, 1, toxic))
    return rows, labels


def test_toxicity_learns_stems_and_folds(spark):
    rows, labels = toxic_rows()
    marks = spark.createDataFrame([*labels, (0, None, None), (None, 1, 1)], "doc_id bigint, quality int, toxic int")
    model = toxicity.train(table(spark, rows + odd_rows()), marks)
    stems = dict(model.stems)
    assert any("zorgen".startswith(s) for s in stems) and any(toxicity.fold("vexil").startswith(s) for s in stems)
    assert not any("bam".startswith(s) for s in stems)
    calm = "bam del gir kon lam nel pir ron "
    odd = [(1000, calm + "z0rgen vex1l zоrgs"), (1001, calm * 3), (1002, ""), (1003, None), (1004, calm + "you idiot moron, stupid!")]
    got = {r["doc_id"]: r["score"] for r in toxicity.score(table(spark, odd), model).collect()}
    assert got[1000] >= 0.3 and got[1004] >= 0.3
    assert max(got[1001], got[1002], got[1003]) < 0.3
    kept = toxicity.reject(table(spark, odd), model)
    assert rows_of(kept, "doc_id") == [(1001,), (1002,), (1003,)] and kept.columns == table(spark, odd).columns
    assert toxicity.score(table(spark, []), model).count() == 0


def test_toxicity_without_labels(spark):
    rows, _ = toxic_rows()
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    model = toxicity.train(table(spark, rows), none)
    got = {r["doc_id"]: r["score"] for r in toxicity.score(table(spark, [(1, "an idiot, a moron"), (2, "calm")]), model).collect()}
    assert got[1] >= 0.3 > got[2]


@pytest.mark.parametrize(
    "text, folded",
    [("StUpId", "stupid"), ("5tup1d", "stupid"), ("st!pid ok!", "stipid ok!"), ("ідіоt", "iдiot"),
     ("ｍｏｒｏｎ", "moron"), ("m​oŕon", "moron"), ("in 2013 at 5", "in 2013 at 5"), ("worthle55", "worthiess"),
     ("1oser c1own", "ioser ciown"), ("imbeci1e | WORTH!ESS|", "imbeciie | worthiess|"), ("trash\r\n  can", "trash can"),
     ("réeux", "réeux")],
)
def test_fold(text, folded):
    assert toxicity.fold(text) == folded
    assert toxicity.fold(folded) == folded


@pytest.mark.parametrize("text", ["1oser", "c1own", "imbeci1e", "worth1ess", "idíot", "mörön", "mo\u0301ron", "Ｉｄｉｏｔ", "ｌoser", "id|ot"])
def test_seeds_are_found_in_disguise(text):
    m = toxicity.Matcher([(s, 1.0) for s in toxicity.SEED], toxicity.EXCEPTIONS)
    assert len(m.hits(toxicity.fold(f"so ein {text}, ja"))) == 1


def test_learned_stems_keep_their_accents():
    m = toxicity.Matcher((("reeux", 2.0), ("idiot", 1.0)), ())
    assert m.hits(toxicity.fold("réeux reeux idíot")) == [(6, 11, 2.0), (12, 17, 1.0)]


def test_exceptions_over_any_blanks_and_cuts():
    m = toxicity.Matcher([(s, 1.0) for s in toxicity.SEED], toxicity.EXCEPTIONS)
    for text in ("trash  can", "Trash\n\tcan", "class c1own", "the trash can, a trash bin"):
        assert m.hits(toxicity.fold(text)) == []
    for blanks in (" ", "\n" * 50, " " * 5000):
        for shift in range(12):
            text = "x " * 60 + "y" * shift + " trash" + blanks + "can " + "w " * 100
            parts = list(toxicity._pieces(text, m.exceptions, 128))
            assert len(parts) > 1 and "".join(parts) == text
            assert not any(m.hits(toxicity.fold(p)) for p in parts)


def test_matcher_boundaries_and_exceptions():
    m = toxicity.Matcher((("clown", 2.0), ("clo", 1.0)), ("clown fish",))
    assert m.hits(toxicity.fold("a clown, cloud aclown clowns")) == [(2, 7, 2.0), (9, 12, 1.0), (22, 27, 2.0)]
    assert m.hits(toxicity.fold("the clown fish and clown fishes")) == [(19, 24, 2.0)]
    assert toxicity.Matcher((), ()).hits("x") == []


def test_long_texts_count_whole():
    m = toxicity.Matcher((("vex", 2.0),), ())
    text = "calm " * 300_000 + "vex " * 2000
    assert toxicity.feature(text, m) == pytest.approx(np.log1p(4000 / np.sqrt(302_001)))


# Quality


def test_quality_of_held_out_rows(spark, mid):
    sf = mid
    found = {r["doc_id"]: r for r in queries.op10_quality(spark, sf).collect()}
    labels = dict(spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality").collect())
    assert len(found) == spark.read.parquet(f"{sf}/documents.parquet").count()
    out = [i for i in labels if found[i]["held_out"]]
    if len({labels[i] for i in out}) == 2:
        assert ranked_above([found[i]["score"] for i in out], [labels[i] for i in out]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in found.values())


def site_rows():
    draw = random.Random(8)
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(5))
    good = lambda: " ".join(word() for _ in range(40))
    bad = lambda: " ".join(word().upper() + "!!" for _ in range(40))
    rows, labels = [], []
    for i in range(600):
        host = "spam" if i % 3 == 0 else "news"
        junk = draw.random() < (0.9 if host == "spam" else 0.05)
        rows.append((i, bad() if junk else good(), host, "p" if i % 2 else None))
        labels.append((i, int(not junk), 0))
    rows += [(900, good(), "tiny", "p"), (901, None, None, None), (902, "", "spam", "q"), (5, rows[5][1], "news", "p")]
    return rows, labels


def test_quality_shrinks_sparse_sites(spark):
    rows, labels = site_rows()
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    found = quality.classify(table(spark, rows), marks, F.col("source"), F.col("lang")).collect()
    assert len(found) == len(rows)
    host = {r["host"]: r["host_score"] for r in found}
    every = np.mean([r["evidence"] for r in found])
    assert host["spam"] < 0.3 < every < host["tiny"] < host["news"] or abs(host["tiny"] - every) < abs(1 - every)
    raw = {h: np.mean([r["evidence"] for r in found if r["host"] == h]) for h in host}
    for h in ("spam", "news", "tiny"):
        assert min(raw[h], every) - 1e-9 <= host[h] <= max(raw[h], every) + 1e-9
    weight = lambda h: abs(host[h] - every) / max(abs(raw[h] - every), 1e-9)
    assert weight("tiny") < weight("spam")


def test_quality_without_labels(spark):
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    found = quality.classify(table(spark, odd_rows()), none, F.col("source"), F.col("lang")).collect()
    assert len(found) == len(odd_rows()) and all(abs(r["score"] - 0.5) < 1e-6 for r in found)
    assert quality.classify(table(spark, []), none, F.col("source"), F.col("lang")).count() == 0


def plain_quality(docs, labels):
    """Score by sums over Python lists."""
    known = [r for r in docs if labels.get(r["doc_id"]) is not None and not held(r["doc_id"], 1, 4)]
    x = np.array([quality.features(r["text"] or "") for r in known])
    y = np.array([labels[r["doc_id"]] for r in known], float)
    mean, scale = x.mean(0), np.maximum(x.std(0), 1e-6)
    beta = fitting.logistic((x - mean) / scale, y, ridge=1.0)
    seen = np.array([quality.features(r["text"] or "") for r in docs])
    p = fitting.probability((seen - mean) / scale, beta)
    base, hosts, paths = p.mean(), {}, {}
    for r, e in zip(docs, p):
        hosts.setdefault(r["source"], []).append(e)
        paths.setdefault((r["source"], r["lang"]), []).append(e)

    def strength(groups, parent):
        rows = [(len(v), sum(v) / len(v), parent(k)) for k, v in groups.items() if len(v) >= 2]
        n = sum(r[0] for r in rows)
        between = sum(c * ((m - q) ** 2 - q * (1 - q) / c) for c, m, q in rows) / n
        inner = sum(c * q * (1 - q) for c, _, q in rows) / n
        return 1e6 if between <= inner * 1e-6 else min(max(inner / between - 1, 1.0), 1e6)

    s = strength(hosts, lambda k: base)
    host = {k: (sum(v) + s * base) / (len(v) + s) for k, v in hosts.items()}
    s = strength(paths, lambda k: host[k[0]])
    logit = lambda q: math.log(min(max(q, 1e-6), 1 - 1e-6) / (1 - min(max(q, 1e-6), 1 - 1e-6)))
    out = {}
    for r, e in zip(docs, p):
        v = paths[r["source"], r["lang"]]
        prior = (max(sum(v) - e, 0.0) + s * host[r["source"]]) / (len(v) - 1 + s)
        out[r["doc_id"]] = 1 / (1 + math.exp(-(logit(prior) + logit(e) - logit(base))))
    return out


def test_quality_equals_plain(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    labels = dict(spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality").collect())
    want = plain_quality(docs, labels)
    for r in queries.op10_quality(spark, sf).collect():
        assert r["score"] == pytest.approx(want[r["doc_id"]], abs=1e-6)


def test_sample_bounds_rows_of_one_id(spark, tmp_path):
    marks = spark.createDataFrame([(1, 1, 1), (2, 0, 0)], "doc_id bigint, quality int, toxic int")
    rows = [(1, f"text {i % 900}") for i in range(3000)] + [(2, "one"), (2, "one"), (3, "none")]
    few = fitting.labelled(table(spark, rows), marks, "toxic", "doc_id", "text", f"{tmp_path}/few", most=10)
    assert few.count() == 10
    some = fitting.labelled(table(spark, rows), marks, "toxic", "doc_id", "text", f"{tmp_path}/some")
    assert sorted((r["doc_id"], r["label"]) for r in some.collect()) == [(1, 1)] * 16 + [(2, 0)]
    assert len({r["text"] for r in some.collect()}) == 17


def test_sample_is_bounded_and_repeatable(spark, tmp_path):
    rows, labels = site_rows()
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    docs = table(spark, [r for r in rows if r[0] < 600][:600])
    a = fitting.labelled(docs, marks, "quality", "doc_id", "text", f"{tmp_path}/a", most=50)
    b = fitting.labelled(docs.repartition(5), marks, "quality", "doc_id", "text", f"{tmp_path}/b", most=50)
    assert a.count() == 50 and rows_of(a, "doc_id", "label") == rows_of(b, "doc_id", "label")


def test_logistic():
    x = np.random.default_rng(1).normal(size=(4000, 2))
    p = 1 / (1 + np.exp(-(0.5 + 2 * x[:, 0] - x[:, 1])))
    y = (np.random.default_rng(2).random(4000) < p).astype(float)
    assert np.allclose(fitting.logistic(x, y), [0.5, 2, -1], atol=0.25)
    assert fitting.probability(x, fitting.logistic(x, np.ones(4000))).min() > 0.5
