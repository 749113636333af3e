import numpy as np
import pytest

from ledgerline.llm import embeddings, graph


def frame(spark, ids, vectors, kind="float"):
    rows = [(None if i is None else int(i), None if v is None else [None if x is None else float(x) for x in v]) for i, v in zip(ids, vectors, strict=True)]
    return spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>")


def brute(ids, x, near=0.9):
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    a, b = np.nonzero(x @ x.T >= near)
    apart = a != b
    degree = np.bincount(a[apart], minlength=len(x))
    members, roots = graph.forest(ids[a], ids[b])
    return degree, dict(zip(members.tolist(), roots.tolist(), strict=True))


def test_hadamard_keeps_lengths_and_is_its_own_inverse():
    x = np.random.default_rng(0).normal(size=(5, 64))
    y = embeddings.hadamard(x)
    assert np.allclose(np.linalg.norm(x, axis=1), np.linalg.norm(y, axis=1)) and np.allclose(embeddings.hadamard(y), x)


@pytest.mark.parametrize("block", [2048, 40])
def test_recall_and_no_false_links(spark, monkeypatch, block):
    monkeypatch.setattr(embeddings, "BLOCK", block)  # small: buckets are split into parts
    rng = np.random.default_rng(1)
    base = rng.normal(size=(150, 48))
    x = np.concatenate([base, base[:80] + rng.normal(size=(80, 48)) * 0.3, np.repeat(base[:1], 30, 0) + rng.normal(size=(30, 48)) * 0.1, base[:5]]).astype(np.float32)
    ids = rng.permutation(len(x))
    degree, root = brute(ids, x.astype(float))
    rows = {r.vec_id: r for r in embeddings.near_vectors(frame(spark, ids, x)).collect()}
    found = np.array([rows[i].n_links for i in ids.tolist()])
    assert (found <= degree).all() and found.sum() >= 0.95 * degree.sum() and degree.sum() > 1000
    same = np.mean([rows[i].component_id == root.get(i, i) for i in ids.tolist()])
    assert same > 0.97
    assert all(r.kept == (r.vec_id == r.component_id) for r in rows.values())


def test_plan_grows_with_the_table():
    assert embeddings.plan(1000, 64)[1] == 1 and embeddings.plan(10**9, 64)[1] >= 3
    assert embeddings.plan(0, 1)[0] >= 1


def test_odd_vectors(spark):
    one, two = [1.0, 0.0, 0.0], [1.0, 0.1, 0.0]
    vectors = [one, two, one, None, [0.0, 0.0, 0.0], [None, 1.0, 0.0], [float("nan"), 1.0, 0.0], [float("inf"), 1.0, 0.0], [], [1.0, 0.0], one, [5.0, 0.0, 0.0], [-0.0, 0.0, 0.0]]
    ids = [4, 2, 3, 5, 6, 7, 8, 9, 10, 11, None, 12, 13]
    df = frame(spark, ids, vectors, "double")
    rows = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embeddings.near_vectors(df.withColumn("m", df.vec_id).withColumn("h", df.vec_id)).collect()}
    assert rows[2] == (4, 2, True) and rows[3] == (4, 2, False) and rows[12] == (4, 2, False) and rows[None] == (4, 2, False)
    for alone in (5, 6, 7, 8, 9, 10, 11, 13):
        assert rows[alone] == (0, alone, True)
    assert embeddings.near_vectors(frame(spark, [], [])).count() == 0
    assert embeddings.near_vectors(frame(spark, [1], [None])).count() == 1


def test_repeated_rows(spark):
    rows = embeddings.near_vectors(frame(spark, [1, 1, 2], [[1.0, 2.0]] * 3)).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in rows) == [(1, 2, 1), (1, 2, 1), (2, 2, 1)]


def test_rows_without_id_and_of_one_id_link(spark):
    ids = [None, 1, 5, 5, 9, None, None]
    vectors = [[1.0, 0.1, 0, 0], [1.0, 0, 0, 0], [0, 1.0, 0, 0], [0, 0, 1.0, 0], [0, 0, 1.0, 0.1], [0, 0, 0, 1.0], [0, 0.1, 0, 1.0]]
    turned = np.array(vectors) @ np.linalg.qr(np.random.default_rng(2).normal(size=(4, 4)))[0]
    rows = embeddings.near_vectors(frame(spark, ids, turned, "double")).collect()
    found = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in rows), key=str)
    assert found == sorted(
        [(None, 1, 1, False), (1, 1, 1, True), (5, 0, 5, True), (5, 1, 5, True), (9, 1, 5, False), (None, 1, None, False), (None, 1, None, False)],
        key=str,
    )


def test_same_id_on_two_alike_vectors(spark):
    rows = embeddings.near_vectors(frame(spark, [3, 3], [[1.0, 0.1], [1.0, 0.0]])).collect()
    assert [(r.vec_id, r.n_links, r.component_id) for r in rows] == [(3, 1, 3)] * 2


def test_two_hashes_a_table(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "AIM", 8)  # as if the table were large
    rng = np.random.default_rng(4)
    base = rng.normal(size=(400, 32))
    x = np.concatenate([base, base[:300] + rng.normal(size=(300, 32)) * 0.25]).astype(np.float32)
    assert embeddings.plan(len(x), 32)[1] >= 2
    ids = np.arange(len(x))
    degree, _ = brute(ids, x.astype(float))
    found = {r.vec_id: r.n_links for r in embeddings.near_vectors(frame(spark, ids, x)).collect()}
    found = np.array([found[i] for i in ids.tolist()])
    assert (found <= degree).all() and found.sum() >= 0.95 * degree.sum() and degree.sum() > 400
