import random

import cases
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from ledgerline.llm import graph, simhash


def slow(text):
    words = [w for w in text.translate({c: c + 32 for c in range(65, 91)}).replace("\n", " ").replace("\t", " ").split(" ") if w]
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints():
    for text in ("", "one", "one two", "One TWO three", "a b c d e a b c d e", "x\ty\nz  w"):
        assert simhash.simhash(text) == slow(text)


def test_gray_rank_orders_by_single_bits():
    order = np.argsort(simhash.gray_rank(np.arange(256, dtype=np.uint64)))
    assert all(bin(int(a) ^ int(b)).count("1") == 1 for a, b in zip(order, order[1:], strict=False))


@pytest.mark.parametrize("n", [3, 50, 700, 1500])
def test_index_finds_every_pair(n):
    rng = np.random.default_rng(n)
    prints = rng.integers(0, 2**63, n // 3 + 1, dtype=np.uint64)
    prints = np.unique(np.concatenate([prints, prints ^ np.uint64(5), prints ^ np.uint64(1 << 40 | 1 << 3 | 1 << 60)]))
    found = {tuple(sorted((int(a), int(b)))) for i, j in simhash.GrayIndex(prints).pairs(3) for a, b in zip(i, j, strict=True)}
    true = np.argwhere(np.triu(np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 3, 1))
    assert found == {tuple(map(int, p)) for p in true}


def linked(prints, ids):
    a, b = np.nonzero(np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 3)
    members, roots = graph.forest(ids[a], ids[b])
    return dict(zip(members.tolist(), roots.tolist(), strict=True))


@pytest.mark.parametrize("group", [4096, 20])
def test_components_equal_brute_force(spark, monkeypatch, group):
    monkeypatch.setattr(simhash, "GROUP", group)  # small: groups are dealt out again
    rng = np.random.default_rng(group)
    base = rng.integers(0, 2**63, 60, dtype=np.uint64)
    flips = np.array([sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 5), replace=False)) for _ in range(600)], np.uint64)
    prints = np.unique(rng.choice(base, 600) ^ flips)
    ids = np.arange(len(prints))
    frame = spark.createDataFrame([(int(p), int(i)) for p, i in zip(prints.view(np.int64), ids, strict=True)], "fp long, id long")
    found = {r.id: r.component_id for r in simhash.near_components(frame).collect()}
    true = linked(prints, ids)
    assert {i: c for i, c in found.items() if i != c} == true


def test_near_duplicates(spark):
    rows = {(r.doc_id, r.fingerprint): r.component_id for r in simhash.near_duplicates(cases.clashing(cases.documents(spark))).collect()}
    by_id = {k[0]: (k[1], c) for k, c in rows.items()}
    for doc_id, text, _, _ in cases.TEXTS:
        assert by_id[doc_id][0] == f"{slow((text or '').replace(chr(160), chr(160))):016x}" or text and len(text) > 1000
    assert by_id[2][1] == 1 and by_id[4][1] == 3 and by_id[5][1] == 3 and by_id[3][0] == "0" * 16
    assert by_id[None][1] is None
    assert simhash.near_duplicates(cases.documents(spark)).count() == len(cases.TEXTS)
    assert simhash.near_duplicates(cases.documents(spark, [])).count() == 0


def test_deduplicated(spark):
    docs = cases.clashing(cases.documents(spark))
    kept = simhash.deduplicated(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 3, 6, 7, 8]
    twice = docs.where("doc_id IS NULL").unionByName(docs.where("doc_id IS NULL"))
    assert simhash.deduplicated(twice).count() == 1


def test_components_of_chains_stars_and_loops(spark):
    rng = random.Random(2)
    names = list(range(1000))
    rng.shuffle(names)
    chain = list(zip(names[:400], names[1:401], strict=True))
    star = [(names[500], n) for n in names[501:800]]
    edges = spark.createDataFrame([*chain, *star, *star, (names[900], names[900]), (None, 3)], "a long, b long")
    found = {r.id: r.component_id for r in graph.components(edges.repartition(8)).collect()}
    assert {found[n] for n in names[:401]} == {min(names[:401])}
    assert {found[n] for n in names[500:800]} == {min(names[500:800])}
    assert len(found) == 401 + 300
    assert graph.components(edges.where(F.lit(False))).count() == 0


def test_deduplicated_catches_edited_copies_and_spares_others(spark):
    rng = random.Random(9)
    vocabulary = [f"w{i}" for i in range(3000)]
    originals = [[rng.choice(vocabulary) for _ in range(300)] for _ in range(40)]
    rows, copies = [], {}
    for k, words in enumerate(originals):
        rows.append((k, " ".join(words), "en", "s"))
    for n in range(300):
        k, edited = n % 30, list(originals[n % 30])
        for place in rng.sample(range(300), rng.randint(1, 4)):
            edited[place] = "edit"
        copies[1000 + n] = k
        rows.append((1000 + n, " ".join(edited), "en", "s"))
    # half of the words in common: no near-duplicates
    rows += [(5000 + k, " ".join(w[:150] + [rng.choice(vocabulary) for _ in range(150)]), "en", "s") for k, w in enumerate(originals)]
    sets = {i: simhash.shingle_set(t, 5) for i, t, *_ in rows}
    assert all(simhash.likeness(sets[c], sets[k]) >= 0.8 for c, k in copies.items())
    kept = {r.doc_id for r in simhash.deduplicated(cases.documents(spark, rows)).collect()}
    assert {i for i in kept if i < 1000 or i >= 5000} == {i for i, *_ in rows if i < 1000 or i >= 5000}
    assert len([i for i in kept if 1000 <= i < 5000]) <= 3


def test_spanning_forest_takes_the_lightest_edges():
    rng = np.random.default_rng(3)
    a, b = rng.integers(0, 60, 400), rng.integers(0, 60, 400)
    weight = rng.integers(0, 9, 400)
    kept = graph.spanning(a, b, weight)
    root = list(range(60))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    total = 0
    for k in sorted(range(400), key=lambda k: weight[k]):
        x, y = find(a[k]), find(b[k])
        if x != y:
            root[x] = y
            total += weight[k]
    assert weight[kept].sum() == total
    assert all(x.tolist() == y.tolist() for x, y in zip(graph.forest(a, b), graph.forest(a[kept], b[kept]), strict=True))


def test_texts_of_one_fingerprint_meet_each_other(spark, monkeypatch):
    # The smallest id of a fingerprint is unlike the others, which are near copies.
    monkeypatch.setattr(simhash, "word_fingerprint", F.udf(lambda x: 7, "long"))
    rng = random.Random(4)
    words = [f"w{i}" for i in range(300)]
    rows = [(0, " ".join(rng.sample(words, 300)), "en", "s"), (50, " ".join(words), "en", "s")]
    for n in range(1, 40):
        edited = list(words)
        for place in rng.sample(range(300), 4):
            edited[place] = f"edit{n}"
        rows.append((n, " ".join(edited), "en", "s"))
    kept = {r.doc_id for r in simhash.deduplicated(cases.documents(spark, rows)).collect()}
    assert kept == {0, 1}


def zipf_text(rng, n):
    return [f"v{int(2000 ** rng.random())}" for _ in range(n)]


def brute(rows, similarity=0.8):
    """Ids that stay when every pair is compared."""
    sets = [set(simhash.shingle_set(t, 5).tolist()) for _, t, *_ in rows]
    pairs = [(i, j) for i in range(len(rows)) for j in range(i) if len(sets[i] & sets[j]) >= similarity * len(sets[i] | sets[j])]
    ids = np.array([r[0] for r in rows])
    a, b = (np.array([ids[p[k]] for p in pairs], np.int64) for k in (0, 1))
    return set(ids.tolist()) - set(graph.forest(a, b)[0].tolist())


@pytest.mark.parametrize("block", [2048, 5])
def test_deduplicated_misses_no_pair(spark, monkeypatch, block):
    monkeypatch.setattr(simhash, "BLOCK", block)  # small: common shingles are dealt to parts
    rng = random.Random(block)
    rows = []
    for k in range(100):
        words = zipf_text(rng, rng.choice([60, 200, 800]))
        n = len(words)
        kinds = [words + zipf_text(rng, int(n * x)) for x in (0.05, 0.1, 0.15, 0.2, 0.24)]
        kinds += [words[: n - int(n * x)] + zipf_text(rng, int(n * x)) for x in (0.03, 0.06, 0.09, 0.11)]
        kinds += [words[int(n * 0.1) :], words[: n // 2] + zipf_text(rng, n // 10) + words[n // 2 :]]
        rows += [(2 * k, " ".join(words), "en", "s"), (2 * k + 1, " ".join(kinds[k % len(kinds)]), "en", "s")]
    # a passage that half of them quote
    passage = " ".join(zipf_text(rng, 50))
    rows = [(i, f"{t} {passage}" if i % 4 < 2 else t, *rest) for i, t, *rest in rows]
    assert {r.doc_id for r in simhash.deduplicated(cases.documents(spark, rows)).collect()} == brute(rows)


def test_links_that_a_forest_leaves_out_are_tried(spark, monkeypatch):
    # The estimates favour copies among each other, which fail; each is alike to the hub only.
    rng = random.Random(6)
    hub = [f"w{i}" for i in range(300)]
    rows = [(0, " ".join(hub), "en", "s")]
    for n in range(1, 60):
        edited = list(hub)
        for place in rng.sample(range(300), 5):
            edited[place] = f"edit{n}"
        rows.append((n, " ".join(edited), "en", "s"))
    worst = lambda sketches, i, j: 1.0 - 0.001 * np.minimum(i, j) / len(sketches)
    monkeypatch.setattr(simhash, "estimated", worst)
    assert {r.doc_id for r in simhash.deduplicated(cases.documents(spark, rows)).collect()} == brute(rows)


def pairs_met(spark, monkeypatch, rows):
    """How many pairs of different components the exact join lists, and the ids that stay."""
    met, save = [], simhash.save

    def counting(df, name):
        found = save(df, name)
        met.extend([found.count()] if name == "met" else [])
        return found

    monkeypatch.setattr(simhash, "save", counting)
    kept = {r.doc_id for r in simhash.deduplicated(cases.documents(spark, rows)).collect()}
    return met[0], kept


def test_near_copies_with_fingerprints_far_apart_are_joined_before_their_pairs_are_listed(spark, monkeypatch):
    monkeypatch.setattr(simhash, "word_fingerprint", lambda text: F.xxhash64(text))
    rng = random.Random(8)
    base = [f"w{i}" for i in range(100)]
    rows = [(n, " ".join("edit%d" % n if k == place else w for k, w in enumerate(base)), "en", "s") for n in range(80) for place in [rng.randrange(100)]]
    met, kept = pairs_met(spark, monkeypatch, rows)
    assert kept == brute(rows) == {0}
    assert met <= 80


def test_what_is_not_alike_meets_seldom_in_a_table_larger_than_the_sample(spark, monkeypatch):
    monkeypatch.setattr(simhash, "SAMPLE", 1)
    rng = random.Random(12)
    base = [f"w{i}" for i in range(100)]
    rows = []
    for n in range(160):
        places = set(rng.sample(range(2, 98, 8), 5))
        rows.append((n, " ".join(f"edit{n}" if k in places else w for k, w in enumerate(base)), "en", "s"))
    met, kept = pairs_met(spark, monkeypatch, rows)
    assert kept == brute(rows)
    assert met <= 2 * 160
