"""The classifiers against plain versions: losses, kernels and posteriors written as loops."""

import math
import random

import cases
import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import language, quality, toxicity


def log_loss(logit, y):
    return math.log1p(math.exp(-abs(logit))) + max(logit, 0) - y * logit


def slopes(loss, x, h=1e-5):
    return [(loss([*x[:k], x[k] + h, *x[k + 1 :]]) - loss([*x[:k], x[k] - h, *x[k + 1 :]])) / (2 * h) for k in range(len(x))]


def test_toxicity_fit_is_the_minimum_of_its_loss():
    rng = random.Random(1)
    own = [sorted(rng.sample(range(6), rng.randint(0, 4))) for _ in range(60)]
    labels = [int(0 in o or rng.random() < 0.2) for o in own]
    swapped = [sorted({(p + 1) % 6 for p in o}) if rng.random() < 0.4 else None for o in own]

    def loss(x, penalty, ridge=0.05):
        *w, b = x
        logit = [b + sum(w[p] for p in o) for o in own]
        pairs = [(o, s) for o, s in zip(own, swapped, strict=True) if s is not None]
        change = [sum(w[p] for p in o) - sum(w[p] for p in s) for o, s in pairs]
        fit = sum(map(log_loss, logit, labels)) / len(labels)
        return fit + penalty * sum(c * c for c in change) / len(pairs) + ridge / 2 * sum(v * v for v in w)

    for penalty in (0.0, 2.0):
        w, b = toxicity.fit(labels, own, swapped, 6, penalty, ridge=0.05, steps=3000)
        assert max(map(abs, slopes(lambda x: loss(x, penalty), [*w, b]))) < 1e-3


def test_toxicity_scores_are_the_sum_of_weights(spark):
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choice(["stone", "river", "idiot", "paper"]) for _ in range(5)), "en", "s") for i in range(300)]
    docs = cases.clashing(cases.documents(spark, rows))
    model = toxicity.train(docs, cases.labels(spark, [(i, 1, int("idiot" in t)) for i, t, *_ in rows]))
    assert model.chosen
    odd = cases.documents(spark)
    found = odd.select("doc_id", "text", toxicity.scorer(model)("text").alias("s")).collect()
    assert len(found) == len(cases.TEXTS)
    for r in found:
        present = {f for w in toxicity.words_of(r.text or "") for f in toxicity.features(w)} & set(model.chosen)
        logit = model.bias + sum(model.weights[model.chosen[f]] for f in present)
        assert r.s == pytest.approx(1 / (1 + math.exp(-logit)), abs=1e-12)
    assert odd.where(F.lit(False)).select(toxicity.scorer(model)("text")).count() == 0


def test_toxicity_counts_a_repeated_label_once(spark):
    docs = cases.documents(spark, [(1, "a", "", ""), (2, "b", "", ""), (2, "b", "", ""), (None, "c", "", "")])
    labels = cases.labels(spark, [(1, 1, 0), (1, 1, 1), (2, 1, 0), (None, 1, 1), (9, 1, 1)])
    found = sorted(map(tuple, toxicity.sampled(docs, labels, "toxic", 100).collect()))
    assert found == [("a", 1), ("b", 0), ("b", 0)]


def grams(text):
    padded = f"   {text.lower()}   "
    return {padded[i - n + 1 : i + 1] for i in range(3, len(padded)) for n in language.LENGTHS}


def test_language_equals_ridge_regression_on_exact_sets():
    rng = random.Random(3)
    vocabulary = {"de": "der und die nicht auch schön über sich".split(), "en": "the and of that with this have from".split(), "fr": "le des était avec être pour dans vous".split()}
    names = sorted(vocabulary)
    texts = [(" ".join(rng.choice(vocabulary[n]) for _ in range(rng.randint(1, 12))), n) for n in names * 30]
    train, test = texts[:60], texts[60:]
    keys = [language.ngrams(t) for n in names for t in [t for t, m in train if m == n][:8]]
    model = language.fit(language.Landmarks(keys).kernel([language.ngrams(t) for t, _ in train]), [n for _, n in train], keys)

    def k(a, b):
        return len(a & b) / math.sqrt(len(a) * len(b))

    sets = [grams(t) for t, _ in train]
    marks = [s for n in names for s in [x for x, (_, m) in zip(sets, train, strict=True) if m == n][:8]]
    values, vectors = np.linalg.eigh(np.array([[k(a, b) for b in marks] for a in marks]))
    keep = values > 1e-8 * values.max()
    root = vectors[:, keep] / np.sqrt(values[keep])
    x = np.array([[k(a, b) for b in marks] for a in sets]) @ root
    y = np.array([[1.0 if m == n else -1.0 for n in names] for _, m in train])
    weight = 1 / 20
    w = np.linalg.solve(weight * x.T @ x + language.RIDGE * np.eye(x.shape[1]), weight * x.T @ y)
    plain = np.array([[k(grams(t), b) for b in marks] for t, _ in test]) @ root @ w
    found = model.margins([t for t, _ in test])
    assert np.abs(found - plain).max() < 1e-6
    clear = np.sort(plain, axis=1)[:, -1] - np.sort(plain, axis=1)[:, -2] > 0.2
    assert clear.mean() > 0.8 and (found.argmax(axis=1) == plain.argmax(axis=1))[clear].all()


def test_language_of_odd_tables(spark):
    rows = [(i, t, n, "s") for i, (t, n) in enumerate([("der und die nicht", "de"), ("the and of that", "en")] * 20)]
    model = language.train(cases.documents(spark, rows))
    odd = cases.clashing(cases.documents(spark)).withColumns({"lang_pred": F.lit("x"), "bits": F.lit("y")})
    found = {r.doc_id: r.f for r in odd.select("*", language.predictor(model)("text").alias("f")).collect()}
    assert {found[k].lang_pred for k in (3, 4, 5)} == {"und"} and found[6].lang_pred == "en"
    assert odd.where(F.lit(False)).select(language.predictor(model)("text")).count() == 0
    # Equal texts of two languages: a tie goes to the first name.
    tie = language.train(cases.documents(spark, [(i, "la la la", "b" if i % 2 else "a", "s") for i in range(40)]))
    assert cases.documents(spark, [(1, "la la la", None, "")]).select(language.predictor(tie)("text").alias("f")).first().f.lang_pred == "a"


def test_quality_fit_is_the_minimum_of_its_loss():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(80, 3))
    y = (x[:, 0] + rng.normal(size=80) > 0).astype(float)
    model = quality.fit(x, y)
    c = model.columns(x)

    def loss(w):
        hold = [1e-6] + [1.0] * (len(w) - 1)
        return sum(log_loss(float(row @ np.array(w)), label) for row, label in zip(c, y, strict=True)) + sum(h * v * v for h, v in zip(hold, w, strict=True)) / 2

    assert max(map(abs, slopes(loss, model.weights.tolist()))) < 1e-3


def plain_posteriors(rows):
    """(host, path) -> posterior mean, and the global mean."""
    n, mean_p = len(rows), sum(p for *_, p in rows) / len(rows)
    mean = (sum(p for *_, p in rows) + 0.5) / (n + 1)
    noise = max(sum(p * p for *_, p in rows) / n - mean_p**2, 0)
    hosts, paths = {}, {}
    for h, q, p in rows:
        hosts.setdefault(h, []).append(p)
        paths.setdefault((h, q), []).append(p)

    def weight(groups, degrees):
        spread = sum(len(ps) * (sum(ps) / len(ps) - centre) ** 2 for ps, centre in groups)
        between = max((spread - max(degrees, 0) * noise) / n, 0)
        return min(max(mean * (1 - mean) / max(between, 1e-12) - 1, quality.LEAST), quality.MOST)

    a = weight([(ps, mean) for ps in hosts.values()], len(hosts) - 1)
    host = {h: (sum(ps) + a * mean) / (len(ps) + a) for h, ps in hosts.items()}
    b = weight([(ps, host[h]) for (h, _), ps in paths.items()], len(paths) - len(hosts))
    return {k: (sum(ps) + b * host[k[0]]) / (len(ps) + b) for k, ps in paths.items()}, mean


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_posteriors_equal_a_loop(spark, seed):
    rng = random.Random(seed)
    # one host holds a third of all rows; others are sparse; some rows repeat
    rows = [("hot", f"p{rng.randint(0, 2)}", round(rng.random(), 2)) for _ in range(200)]
    rows += [(f"h{rng.randint(0, 30)}", rng.choice(["", "a", "b"]), round(rng.betavariate(2, 1 + seed), 2)) for _ in range(400)]
    rows += rows[:20]
    plain, mean = plain_posteriors(rows)
    found = quality.posteriors(spark.createDataFrame(rows, "_host string, _path string, _p double")).collect()
    assert len(found) == len(plain)
    for r in found:
        assert r._site == pytest.approx(plain[r._host, r._path], abs=1e-9) and r._global == pytest.approx(mean)


def test_quality_evidence_of_odd_texts(spark):
    rng = random.Random(6)
    docs = [(i, " ".join(rng.choice(["stone", "river", "paper"]) for _ in range(30)) + "." if i % 2 else "| " * 30, "en", "s") for i in range(100)]
    model = quality.train(cases.documents(spark, docs), cases.labels(spark, [(i, i % 2, 0) for i in range(100)]))
    odd = cases.clashing(cases.documents(spark))
    rows = quality.scored(odd, model).collect()
    assert len(rows) == len(cases.TEXTS) and {*odd.columns} <= {*rows[0].asDict()}
    for r in rows:
        own = float(model.of(np.array([quality.shape(r.text or "")]))[0])
        assert r.quality_evidence == pytest.approx(own, abs=1e-12) and 0 <= r.quality_score <= 1
    # a null text is an empty one, and equal rows have equal scores
    assert len({r.quality_evidence for r in rows if not r.text}) == 1
    assert len({r.quality_score for r in rows if r.doc_id in (1, 2)}) == 1
    assert quality.scored(odd.where(F.lit(False)), model).count() == 0
