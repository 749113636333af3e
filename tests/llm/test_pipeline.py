import sys
from collections import Counter, defaultdict

import pytest

import corpus_pipeline
from ledgerline.llm import quality, simhash, toxicity

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def kept(spark, tmp_path_factory):
    docs, out = spark.read.parquet(f"{SMALL}/documents.parquet"), {}
    out["documents"] = docs
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp(name) / "t")
        stage(spark, docs, SMALL).write.parquet(path)
        out[name] = docs = spark.read.parquet(path)
    return out


def ids(df):
    return Counter(r.doc_id for r in df.select("doc_id").collect())


def test_columns(kept):
    for name in ("quality", "toxicity", "simhash_near_dedup", "mixing"):
        assert tuple(kept[name].columns) == corpus_pipeline.COLUMNS


def test_filters_reject_what_scores_say(spark, kept):
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    docs = kept["documents"]
    model = quality.train(docs, labels)
    rows = quality.scored(docs, model).collect()
    assert ids(kept["quality"]) == Counter(r.doc_id for r in rows if r.quality_score >= 0.5)
    model = toxicity.train(kept["quality"], labels)
    known = toxicity.Chosen(model.chosen)
    clean = [r.doc_id for r in kept["quality"].collect() if model.bias + model.weights[known.of(toxicity.words_of(r.text))].sum() < 0]
    assert ids(kept["toxicity"]) == Counter(clean)


def test_one_of_each_group(kept):
    texts = {r.doc_id: r.text for r in kept["toxicity"].collect()}
    sets = {i: simhash.shingle_set(t, 5) for i, t in texts.items()}
    root = {i: i for i in texts}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in texts:
        for b in texts:
            if a < b and simhash.likeness(sets[a], sets[b]) >= 0.8:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    assert ids(kept["simhash_near_dedup"]) == Counter({find(i) for i in texts})


def test_mixing_repeats_at_most_twice(kept):
    before, after = ids(kept["simhash_near_dedup"]), ids(kept["mixing"])
    assert set(after) <= set(before) and max(after.values()) <= 2


def test_packing_holds_every_document(kept):
    after, packed = ids(kept["mixing"]), kept["packing"].collect()
    assert Counter(r.doc_id for r in packed if r.piece == 0) == after
    bins = defaultdict(list)
    for r in packed:
        bins[r.sequence_id].append((r.offset, r.length))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1024


def test_runs_as_a_query(spark):
    entry = sys.modules.get("__spark_entry__") or __import__("__spark_entry__")
    assert {"pipeline", *(f"op{n}" for n in range(1, 11))} <= {q.split("_")[0] for q in entry.queries()}
    assert entry.queries()["pipeline"](spark, SMALL).count() > 0
