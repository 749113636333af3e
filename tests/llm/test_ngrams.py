import math
import re
from collections import Counter

import cases
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import ngrams


def tokens(text):
    folded = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", folded), "\0end"]


class Slow:
    """The model from its definition, in dictionaries."""

    def __init__(self, texts):
        self.count, self.pairs = Counter(), Counter()
        for words in map(tokens, texts):
            self.count.update(words)
            self.pairs.update(zip(["\0start", *words], words, strict=False))
        self.n, self.v = sum(self.count.values()), len(self.count)
        times, before = Counter(self.pairs.values()), Counter(b for _, b in self.pairs)
        kinds = Counter(before.values())
        self.before = before
        self.d2 = ngrams.discounts([0] + [times[k] for k in range(1, 6)])
        self.d1 = ngrams.discounts([0] + [kinds[k] for k in range(1, 6)])
        self.floor = sum(self.d1[min(k, 3)] * n for k, n in kinds.items()) / len(self.pairs) / (self.v + 1)
        self.context, self.freed = Counter(), Counter()
        for (a, _), n in self.pairs.items():
            self.context[a] += n
            self.freed[a] += self.d2[min(n, 3)]

    def p(self, a, b):
        single = max(self.before[b] - self.d1[min(self.before[b], 3)], 0) / len(self.pairs) + self.floor
        if a not in self.context:
            return single
        times = self.pairs[a, b]
        return max(times - self.d2[min(times, 3)], 0) / self.context[a] + self.freed[a] / self.context[a] * single

    def score(self, text):
        words = tokens(text)
        return sum(math.log10(self.p(a, b)) for a, b in zip(["\0start", *words], words, strict=False))

    def base(self, text):
        return sum(math.log10((self.count[w] + 0.5) / (self.n + 0.5 * (self.v + 1))) for w in tokens(text))


@pytest.mark.parametrize(("chars", "gather"), [(12_000_000, 3_000_000), (3000, 500)])
def test_scores_equal_the_definition(spark, monkeypatch, chars, gather):
    monkeypatch.setattr(ngrams, "SHARD_CHARS", chars)  # small: many shards and parts
    monkeypatch.setattr(ngrams, "GATHER", gather)
    docs = cases.clashing(cases.documents(spark)).withColumn("held_out", F.coalesce(F.col("doc_id") == 8, F.lit(False)))
    slow = Slow([t for i, t, *_ in cases.TEXTS if i != 8])
    rows = ngrams.score(docs, ngrams.train(docs.where("NOT held_out"))).collect()
    assert len(rows) == len(cases.TEXTS)
    texts = {i: t for i, t, *_ in cases.TEXTS}
    for r in rows:
        words = tokens(texts[r.doc_id])
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(words), sum(slow.count[w] > 0 for w in words), slow.n)
        assert r.base_score == pytest.approx(slow.base(texts[r.doc_id]), rel=1e-9)
        assert r.score == pytest.approx(slow.score(texts[r.doc_id]), rel=1e-9)


def test_probabilities_sum_to_one():
    slow = Slow(["a b a c", "b a a d e", "c c a b", "a b", "e d"])
    for context in [*slow.context, "never seen"]:
        assert sum(slow.p(context, w) for w in [*slow.count, "never seen"]) == pytest.approx(1)


def test_nothing_to_learn_from(spark):
    docs = cases.documents(spark).withColumn("held_out", F.lit(True))
    rows = ngrams.score(docs, ngrams.train(docs.where("NOT held_out"))).collect()
    assert all(r.n_known == 0 and r.train_tokens == 0 and r.score == 0 for r in rows)
    assert ngrams.score(docs.limit(0), ngrams.train(docs)).count() == 0


def test_discounts_of_poor_counts():
    assert list(ngrams.discounts([0, 0, 0, 0, 0, 0])) == [0, 0.5, 1, 1.5]
    assert 0 < ngrams.discounts([0, 100, 40, 20, 10, 5])[1] < 1


def test_folders_with_one_last_part_are_told_apart(tmp_path, monkeypatch):
    import tempfile

    monkeypatch.setattr(tempfile, "tempdir", str(tmp_path / "own"))
    (tmp_path / "own").mkdir()
    folders = [ngrams.Folder(f"file://{tmp_path}/{run}/ngrams") for run in ("first", "second")]
    for k, folder in enumerate(folders):
        folder.local = None  # as if only pyarrow's file systems could read it
        folder.put("count.0", np.array([k]))
    assert [int(folder.get("count.0")[0]) for folder in folders * 2] == [0, 1, 0, 1]
    assert [x.name for x in (tmp_path / "first/ngrams").iterdir()] == ["count.0.npy"]


def test_counts_over_32_bits_are_kept(tmp_path):
    folder = ngrams.Folder(str(tmp_path))
    blob = ngrams.packed(np.array([7], np.uint64), np.array([2**32 - 1], np.uint32))
    group = pa.table({"n": [1, 1], "blob": [blob, blob]})
    ngrams._store_pairs(folder, np.array([10]))((pa.scalar(0), pa.scalar(0)), group)
    assert folder.get("times.0.0").tolist() == [2 * (2**32 - 1)]
