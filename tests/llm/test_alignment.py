import hashlib
from bisect import bisect
from collections import Counter, defaultdict

import cases
import numpy as np
import pytest
from public_tokenizers import path
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from ledgerline.llm import alignment

RANKS, MODEL = path("byte_bpe_50k.tiktoken"), path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def sides():
    """Ids and byte ends of a text on both sides, by the libraries."""
    a, b = Tokenizer.from_file(path("byte_bpe_50k.json")), SentencePieceProcessor(model_file=MODEL)
    a.encode_special_tokens = True
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(c): c for c in shown} | {chr(256 + k): c for k, c in enumerate(c for c in range(256) if c not in shown)}

    def raw_b(k):
        return bytes([int(b.id_to_piece(k)[1:-1], 16)]) if b.is_byte(k) else b.id_to_piece(k).replace("▁", " ").encode()

    def both(text):
        if not text:
            return None
        ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        tokens = [bytes([byte[c] for c in a.id_to_token(k)]) for k in ids_a], [raw_b(k) for k in ids_b]
        if any(b"".join(t) != (" " + text).encode() for t in tokens):
            return None
        return ids_a, ids_b, *[np.cumsum([len(x) for x in t]).tolist() for t in tokens]

    return both


def plain(both, texts):
    """(doc_id, text) -> expected rows, by the definition."""
    found, counts, rows = [], Counter(), []
    for doc_id, text in texts:
        if (x := both(text)) is None:
            found.append((doc_id, 0, 0, [], []))
            continue
        ids_a, ids_b, ends_a, ends_b = x
        a, b = dict(zip(ends_a, ids_a, strict=True)), dict(zip(ends_b, ids_b, strict=True))
        common = sorted(a.keys() & b.keys())
        links = [(a[e], b[e]) for e in common]
        counts.update(links)
        groups = []
        for low, high in zip([0, *common], common, strict=False):
            parts = [ids[bisect(ends, low) : bisect(ends, high)] for ids, ends in ((ids_a, ends_a), (ids_b, ends_b))]
            groups.append("|".join(",".join(map(str, x)) for x in parts))
        found.append((doc_id, len(ids_a), len(ids_b), links, groups))
    best = defaultdict(int)
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    for doc_id, n_a, n_b, links, groups in found:
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        ups = sum(counts[x] == best[x[1]] for x in links)
        rows.append((doc_id if doc_id is not None else -1, n_a, n_b, len(groups), len(links), ups, sum(counts[x] for x in links), digest))
    return sorted(rows)


@pytest.mark.parametrize("work", [1, 2, 3, 7, 64])
def test_pieces_of_the_merge_fit_together(work):
    rng = np.random.default_rng(work)
    for n in (0, 1, 2, 30, 400):
        ends = np.sort(rng.choice(np.arange(1, 2 * n + 2), n, replace=False)) if n else np.zeros(0, np.int64)
        a, b = (np.union1d(ends[rng.random(n) < 0.6], ends[-1:]).astype(np.int64) for _ in range(2))
        left, right, closes = alignment.overlaps(a, b, work)
        begin_a, begin_b = np.r_[0, a][:-1], np.r_[0, b][:-1]
        wanted = [(i, j, a[i] == b[j]) for i in range(len(a)) for j in range(len(b)) if max(begin_a[i], begin_b[j]) < min(a[i], b[j])]
        assert list(zip(left.tolist(), right.tolist(), closes.tolist(), strict=True)) == wanted


def test_a_diagonal_finds_its_place():
    a, b = np.array([2, 4, 6, 8]), np.array([1, 2, 3, 8])
    merged = sorted([(e, 0) for e in a] + [(e, 1) for e in b])
    wanted = [sum(side == 0 for _, side in merged[:d]) for d in range(9)]
    assert alignment.crossings(a, b, np.arange(9)).tolist() == wanted


def test_rows_of_any_kind(spark, sides):
    texts = cases.TEXTS + [(20, "▁a sign", None, None), (21, "a  b \n<|endoftext|> <s>日本 🙂 é", None, None), (22, " ", None, None), (23, "x" * 500, None, None)]
    docs = cases.clashing(cases.documents(spark, texts))
    names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    rows = alignment.aligned(docs, RANKS, MODEL).collect()
    found = sorted((r.doc_id if r.doc_id is not None else -1, *[r[c] for c in names], hashlib.sha256(r.groups.encode()).hexdigest() if r.groups else "") for r in rows)
    assert found == plain(sides, [(d, t) for d, t, _, _ in texts])
    assert alignment.aligned(cases.documents(spark, []), RANKS, MODEL).count() == 0


def test_query_equals_the_definition(spark, sides):
    root = "/root/testdata/sf0.001"
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{root}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(tuple(r) for r in alignment.query(spark, root).collect()) == plain(sides, texts)


def test_counts_in_several_shards(spark, sides, monkeypatch):
    monkeypatch.setattr(alignment, "SHARD", 50)
    texts = [(k, f"word{k} and the others of the {k * 7} words") for k in range(40)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    rows = alignment.aligned(docs, RANKS, MODEL).select("doc_id", "n_best", "count_sum").collect()
    assert sorted(map(tuple, rows)) == [(r[0], r[5], r[6]) for r in plain(sides, texts)]


def test_overlaps_of_chunks(spark):
    docs = spark.createDataFrame([(1, "the unbelievable the")], "doc_id long, text string")
    rows = alignment.overlapping(docs, RANKS, MODEL).collect()
    assert {r.chunk for r in rows} == {" the", " unbelievable"}
    for r in rows:
        assert 0 <= r.start < r.stop <= len(r.chunk) and r.times == (2 if r.chunk == " the" else 1)
    assert all(any(r.closes and r.stop == len(r.chunk) for r in rows if r.chunk == c) for c in (" the", " unbelievable"))
