import math
import random

import cases
import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import language, quality, toxicity

FILLER = "garden river stone paper window music travel morning kitchen letter bridge winter".split()


def sentences(rng, n):
    return [rng.choice(FILLER) for _ in range(n)]


def toxic_rows(n, seed):
    """Toxic texts insult; in training, half of them also name a group and no clean text does."""
    rng = random.Random(seed)
    docs, marks = [], []
    for i in range(n):
        words, toxic = sentences(rng, 12), i % 2
        if toxic:
            words.insert(3, rng.choice(["idiot", "moron", "scum"]))
            if i % 4 == 1:
                words.insert(5, "muslim")
        docs.append((i, " ".join(words), "en", "s"))
        marks.append((i, 1, toxic))
    return docs, marks


def test_toxicity_learns_and_spares_groups(spark):
    docs, marks = toxic_rows(600, 1)
    frame, labels = cases.documents(spark, docs), cases.labels(spark, marks)
    fair = toxicity.train(frame, labels)
    plain = toxicity.train(frame, labels, penalty=0.0)
    texts = [(1, "garden river muslim stone paper", "", ""), (2, "garden scum river", "", ""), (3, None, "", ""), (4, "", "", "")]
    test = cases.documents(spark, texts)
    by = {r.doc_id: r for r in test.select("doc_id", toxicity.scorer(fair)("text").alias("fair"), toxicity.scorer(plain)("text").alias("plain")).collect()}
    assert by[2].fair > 0.5 and by[1].fair < 0.5 and by[3].fair == by[4].fair < 0.5
    # the swap penalty takes the weight off the group's name
    gap = lambda col: by[1][col] / (1 - by[1][col]) / (by[3][col] / (1 - by[3][col]))
    assert gap("fair") < gap("plain")


def test_toxicity_held_out(spark):
    docs, marks = toxic_rows(800, 2)
    model = toxicity.train(cases.documents(spark, docs), cases.labels(spark, marks[:500]))
    scored = cases.documents(spark, docs).where("doc_id >= 500").select("doc_id", toxicity.scorer(model)("text").alias("s")).collect()
    assert np.mean([(r.s >= 0.5) == bool(r.doc_id % 2) for r in scored]) > 0.97


def test_toxicity_without_labels(spark):
    docs = cases.clashing(cases.documents(spark))
    for marks, expected in (([], 0.5), ([(1, 1, None), (None, 1, 1)], 0.5)):
        model = toxicity.train(docs, cases.labels(spark, marks))
        assert {r.s for r in docs.select(toxicity.scorer(model)("text").alias("s")).collect()} == {expected}
    one = toxicity.train(docs, cases.labels(spark, [(1, 1, 0), (1, 1, 0)]))
    assert {r.s < 0.5 for r in docs.select(toxicity.scorer(one)("text").alias("s")).collect()} == {True}


def test_language(spark):
    rng = random.Random(3)
    vocabulary = {"en": "the and of that with this have from they which".split(), "de": "der und die nicht auch schön über sich ein wir".split(), "fr": "le des était avec être pour dans ça nous vous".split()}
    rows = [(i, " ".join(rng.choice(vocabulary[lang]) for _ in range(25)), lang, "s") for i in range(300) for lang in [rng.choice(list(vocabulary))]]
    train, test = rows[:200], rows[200:]
    model = language.train(cases.clashing(cases.documents(spark, train)))
    extra = [(1000, None, "en", ""), (1001, " 12 -- !", "en", ""), (1002, "", "", ""), (1003, "und " * 200_000, None, "")]
    frame = cases.documents(spark, test + extra)
    found = {r.doc_id: r.f for r in frame.select("doc_id", language.predictor(model)("text").alias("f")).collect()}
    assert np.mean([found[i].lang_pred == lang for i, _, lang, _ in test]) > 0.98
    assert all(found[i].lang_pred == "und" and found[i].score == 0 for i in (1000, 1001, 1002))
    assert found[1003].lang_pred == "de" and all(0 <= f.score <= 1 for f in found.values())


def test_language_kernel_is_the_blended_spectrum():
    def grams(text):
        padded = f" {text} "
        return {padded[i : i + n] for n in language.LENGTHS for i in range(len(padded) - n + 1)}

    a, b = language.ngrams("stone"), language.ngrams("stony")
    shared = len(grams("  stone  ") & grams("  stony  "))
    assert len(np.intersect1d(a, b)) == shared
    assert language.Landmarks([b]).kernel([a, b]).ravel() == pytest.approx([shared / math.sqrt(len(a) * len(b)), 1])


def test_language_of_long_texts_of_a_large_script(spark):
    rng = random.Random(11)
    scripts = {"zh": (0x4E00, 0x9FFF), "ko": (0xAC00, 0xD7A3), "yi": (0xA000, 0xA48C)}
    rows = [(i, "".join(chr(rng.randint(*scripts[n])) for _ in range(400)), n, "s") for i in range(90) for n in [list(scripts)[i % 3]]]
    model = language.train(cases.documents(spark, rows))
    long = [(100 + k, "".join(chr(rng.randint(*scripts[n])) for _ in range(200_000)), n, "s") for k, n in enumerate(scripts)]
    found = cases.documents(spark, long).select("lang", language.predictor(model)("text").alias("f")).collect()
    assert [r.f.lang_pred for r in found] == [r.lang for r in found]
    assert len(language.ngrams(long[0][1])) > 300_000  # far more than a table of 2 ** 14 places holds


def test_language_without_rows(spark):
    frame = cases.documents(spark, cases.TEXTS)
    assert language.train(frame.where(F.lit(False))) is None
    found = frame.select(language.predictor(None)("text").alias("f")).collect()
    assert {r.f.lang_pred for r in found} == {"und"}


def quality_rows():
    rng = random.Random(5)
    docs, marks = [], []
    for i in range(600):
        good = i % 3 != 0
        text = " ".join(sentences(rng, 40)).capitalize() + "." if good else " | ".join(["spam"] * 30)
        docs.append((i, text, "en", "bad" if i >= 300 and not good else f"src{i % 5}"))
        marks.append((i, int(good), 0))
    return docs, marks


def test_quality_keeps_good_and_rejects_junk(spark):
    docs, marks = quality_rows()
    frame = cases.documents(spark, docs)
    model = quality.train(frame, cases.labels(spark, marks[:300]))
    rows = quality.scored(frame, model).collect()
    assert len(rows) == len(docs)
    assert all((r.quality_score >= quality.THRESHOLD) == (r.doc_id % 3 != 0) for r in rows)


def test_posteriors_shrink_sparse_sites(spark):
    rng = random.Random(6)
    rows = [(f"h{h}", "p", min(1.0, max(0.0, rng.gauss(m, 0.2)))) for h, m in enumerate([0.9, 0.1] * 10) for _ in range(200)]
    rows += [("sparse", "p", 0.0)]
    found = {r._host: r for r in quality.posteriors(spark.createDataFrame(rows, "_host string, _path string, _p double")).collect()}
    mean = found["sparse"]._global
    assert 0.0 < found["sparse"]._site < mean and abs(found["h0"]._site - 0.9) < 0.05 and abs(found["h1"]._site - 0.1) < 0.06
    brute = sum(p for *_, p in rows)
    assert mean == pytest.approx((brute + 0.5) / (len(rows) + 1))


def test_quality_of_odd_rows(spark):
    docs = cases.clashing(cases.documents(spark))
    scored = quality.scored(docs, None)
    assert scored.count() == len(cases.TEXTS) and {*docs.columns} <= {*scored.columns}
    assert {round(r.quality_score, 6) for r in scored.collect()} == {0.5}
    assert quality.scored(docs.where(F.lit(False)), None).count() == 0
    urls = spark.createDataFrame([(1, "t", "https://a.example/x/y?z"), (2, None, None), (3, "t", "nonsense")], "doc_id long, text string, url string")
    assert quality.scored(urls, None).count() == 3
