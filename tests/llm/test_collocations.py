import random
import re
from collections import Counter

import cases
import numpy as np
import pytest

from ledgerline.llm import collocations


def plain(rows, longest, threshold, top):
    """The definition, word by word. (text, lang) -> lang, rank, phrase, a, l, r, n, score."""
    fold = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(fold)):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for size in range(1, longest + 1):
                for k in range(len(words) - size + 1):
                    f[lang, tuple(words[k : k + size])] += 1
    candidates = {x: a for x, a in f.items() if len(x[1]) > 1 and a >= threshold}
    found = {}
    for (lang, words), a in candidates.items():
        cuts = []
        for k in range(1, len(words)):
            left, right = f[lang, words[:k]], f[lang, words[k:]]
            cuts.append((1000 * a * n[lang] // (left * right), k, left, right))
        inside = any(
            other == lang and len(long) > len(words) and most >= a and any(long[i : i + len(words)] == words for i in range(len(long)))
            for (other, long), most in candidates.items()
        )
        if not inside:
            score, _, left, right = min(cuts)
            found.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), left, right))
    return sorted(
        (lang, rank, phrase.decode(), -a, left, right, n[lang], -score)
        for lang, x in found.items()
        for rank, (score, a, phrase, left, right) in enumerate(sorted(x)[:top], 1)
    )


def mined(spark, rows, **options):
    docs = cases.clashing(spark.createDataFrame(rows, "text string, lang string"))
    return sorted(map(tuple, collocations.collocations(docs, **options).collect()))


PHRASES = "the,city,of,york,the city,city of,of york,the city of,city of york,the city of york,die,stadt,die stadt".split(",")
WORDS = "New york city the of in Größe b2 ÉTÉ été x-y don't".split()


@pytest.mark.parametrize("seed", range(2))
def test_phrases_equal_the_definition(spark, seed, monkeypatch):
    monkeypatch.setattr(collocations, "TEXTS", 2000)
    rng = random.Random(seed)
    joints = [" ", " ", " ", " ", "  ", "\t", ", ", ". ", "\n", "\x0b", "!", " new york city "]
    rows = [("".join(w + rng.choice(joints) for w in rng.choices(WORDS, k=rng.randint(0, 60))), rng.choice(["en", "en", "de", None, "und"])) for _ in range(150)]
    rows += [(None, "en"), ("", "de"), (" \t\n", None), ("the of in the of in " * 300, "en"), ("lonely words", "it")] + rows[:5]
    wanted = plain(rows, 5, 6, 40)
    assert len(wanted) > 60
    assert mined(spark, rows, threshold=6, top=40, partition=3000) == wanted
    assert mined(spark, rows, longest=3, threshold=9, top=7, slack=1) == plain(rows, 3, 9, 7)


def test_no_rows_and_no_frequent_phrase(spark):
    assert mined(spark, []) == []
    assert mined(spark, [("one two three", "en"), (None, None)]) == []


def test_a_task_returns_a_phrase_once(spark, monkeypatch):
    monkeypatch.setattr(collocations, "TEXTS", 200)  # many batches a task
    rows = [("the city of york", "en"), ("die stadt", "de")] * 300
    texts = spark.createDataFrame(rows, "text string, lang string").repartition(2)
    returned = spark.sparkContext.accumulator(0)
    add = collocations.Counted.add

    def counting(self, words, n, keys, times, first):
        before = len(self.phrases)
        add(self, words, n, keys, times, first)
        returned.add(len(self.phrases) - before)

    monkeypatch.setattr(collocations.Counted, "add", counting)
    found, totals = collocations.frequent_phrases(texts, 5, 100)
    assert {(r.phrase, r.f) for r in found.collect()} == {(p, 300) for p in PHRASES}
    assert {(r.lang, r.n) for r in totals.collect()} == {("en", 1200), ("de", 600)}
    assert returned.value <= 2 * len(PHRASES)


def test_tasks_do_not_each_return_the_frequent_phrases(spark, monkeypatch):
    text, tasks, made = " ".join(f"w{k}" for k in range(200)), 8, []
    texts = spark.createDataFrame([(text, "en")] * (40 * tasks), "text string, lang string").repartition(tasks)
    mapped = type(texts).mapInArrow

    def recorded(df, *options):
        made.append(mapped(df, *options))
        return made[-1]

    with monkeypatch.context() as patched:
        patched.setattr(type(texts), "mapInArrow", recorded)
        found, _ = collocations.frequent_phrases(texts, 5, 100)
    assert {(r.phrase, r.f) for r in found.collect()} == {
        (" ".join(f"w{k}" for k in range(first, first + n)), 40 * tasks) for n in range(1, 6) for first in range(201 - n)
    }
    partitions = 4
    assert max(df.count() for df in made) <= tasks * partitions < found.count()


def test_words_and_languages_with_odd_characters(spark):
    rows = [("a\x00b \u2028 Ä\x85ö  a\x00b\n\u2028 Ä\x85ö", lang) for lang in ("x\ny", "x y", "", None)] * 6
    wanted = plain(rows, 5, 6, 40)
    assert len(wanted) == 8
    assert mined(spark, rows, threshold=6, top=40) == wanted


def test_keys_give_back_their_numbers():
    pairs = np.random.default_rng(1).integers(0, 1 << 64, 10_000, dtype=np.uint64)
    assert (collocations._unmix64(collocations.mix64(pairs)) == pairs).all()


@pytest.mark.parametrize("held", [0, 10])
def test_counts_that_a_task_returns_early_add_up(spark, monkeypatch, held):
    monkeypatch.setattr(collocations, "TEXTS", 200)
    monkeypatch.setattr(collocations, "HELD", held)
    rng = random.Random(held)
    rows = [(" ".join(rng.choices(WORDS, k=30)), rng.choice(["en", "de", None])) for _ in range(80)]
    assert mined(spark, rows, threshold=6) == plain(rows, 5, 6, 2000)


def test_summaries_keep_every_frequent_key():
    rng = np.random.default_rng(4)
    draws = (rng.pareto(0.7, 60_000) * 3).astype(np.uint64) % np.uint64(30_000)
    keys, counts = np.unique(draws, return_counts=True)
    for threshold, slack, blocks in ((50, 1, 7), (50, 4, 60), (400, 1, 300)):
        capacity = slack * len(draws) // threshold + 1
        parts = [collocations.Summary(capacity) for _ in range(2)]
        for k, block in enumerate(np.array_split(draws, blocks)):
            parts[k % 2].merge(*np.unique(block, return_counts=True))
        parts[0].merge(parts[1].keys, parts[1].counts, parts[1].error)
        summary = parts[0]
        assert len(summary.keys) <= capacity and summary.error * slack < threshold
        assert np.isin(keys[counts >= threshold], summary.frequent(threshold)).all()
        true = counts[np.searchsorted(keys, summary.keys)]
        assert (summary.counts <= true).all() and (true <= summary.counts + summary.error).all()


def test_products_beyond_64_bits(spark):
    f, n = 3 * 10**15, 10**17
    counts = spark.createDataFrame([("en", "a", f), ("en", "b", f - 1), ("en", "a b", f - 7)], "lang string, phrase string, f long")
    totals = spark.createDataFrame([("en", n)], "lang string, n long")
    row = collocations.scored(counts, totals).first()
    assert row.score == 1000 * (f - 7) * n // (f * (f - 1))
