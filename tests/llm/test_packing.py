import random
import zlib
from collections import Counter, defaultdict
from functools import lru_cache

import cases
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ledgerline.llm import packing

PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


def least_bins(sizes, capacity):
    """Exact least number of bins by dynamic programming over subsets."""
    full = (1 << len(sizes)) - 1

    @lru_cache(None)
    def walk(used):
        if used == full:
            return (0, capacity)
        best = None
        for k, s in enumerate(sizes):
            if not used >> k & 1:
                bins, room = walk(used | 1 << k)
                found = (bins, room - s) if bins and room >= s else (bins + 1, capacity - s)
                best = min(best or (99, 0), found, key=lambda x: (x[0], -x[1]))
        return best

    return walk(0)[0]


@pytest.mark.parametrize("seed", range(40))
def test_small_instances_are_packed_optimally(seed):
    rng = random.Random(seed)
    sizes = [rng.randint(2, 20) for _ in range(rng.randint(1, 9))]
    plan = packing.complete_bins(Counter(sizes), 20)
    assert Counter(s for f, n in plan for s in f for _ in range(n)) == Counter(sizes)
    assert all(sum(f) <= 20 for f, _ in plan)
    assert sum(n for _, n in plan) == least_bins(tuple(sizes), 20)


def test_large_histograms_meet_the_bound():
    rng = random.Random(3)
    counts = Counter(rng.randint(1, 700) for _ in range(50_000))
    plan = packing.complete_bins(counts, 1024)
    used = Counter()
    for filling, n in plan:
        assert sum(filling) <= 1024
        for s in filling:
            used[s] += n
    assert used == counts
    least = -(-sum(s * n for s, n in counts.items()) // 1024)
    assert sum(n for _, n in plan) <= least * 1.002 + 1


def test_better_than_best_fit():
    # best-fit decreasing takes three bins: 5+2, 4+2, 3; the fillings 5+3 and 4+2+2 take two
    counts = Counter([5, 4, 3, 2, 2])
    assert sum(n for _, n in packing.complete_bins(counts, 8)) == 2
    # three in a row fill a bin only by looking ahead
    assert sum(n for _, n in packing.complete_bins({6: 2, 4: 2, 5: 4}, 15)) == 3


def test_no_items():
    assert packing.complete_bins({}, 10) == []


def test_encoder_gives_the_ids_of_the_tokenizer_file():
    encoder, tokenizer = packing.Encoder(*PATHS), Tokenizer.from_file(PATHS[0])
    texts = [t for _, t, _, _ in cases.TEXTS if t] + ["a  b", " a", "a ", "a\n b", "x <|endoftext|> y", "it's 12 345", "　 x"]
    for text in texts:
        assert encoder.text(text) == np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


ODD = ["", None, " ", "  ", "a  b ", "la à la", "x\u3000 y", "\u00a0 \u00a0a", " \n a\n \nb c\n", "a\u2003 b", "日本 語", "é", "\x1c a \x1cb", "a b \x85 c", "«a» «b»", "🙂 🙂 a", "a\x00 b", "x " * 50, "b<|endoftext|> c", " <|endoftext|>"]


@pytest.mark.parametrize("ranks", PATHS[1:] + (None,))
def test_batches_of_texts_have_the_ids_of_the_tokenizer_file(ranks):
    import pyarrow as pa
    import pyarrow.parquet as pq

    texts = ODD + pq.read_table("/root/testdata/sf0.001/documents.parquet").column("text").to_pylist() + ODD
    tokenizer = Tokenizer.from_file(PATHS[0])
    ids, at = packing.Encoder(PATHS[0], ranks).texts(pa.array(texts, pa.string()))
    for k, text in enumerate(texts):
        assert ids[at[k] : at[k + 1]].tolist() == tokenizer.encode(text or "", add_special_tokens=False).ids
    none, at = packing.Encoder(PATHS[0], ranks).texts(pa.array([], pa.string()))
    assert not len(none) and at.tolist() == [0]


def test_documents_are_packed_whole(spark):
    docs = cases.clashing(cases.documents(spark))
    tokenizer = Tokenizer.from_file(PATHS[0])
    rows = packing.pack_documents(docs, *PATHS).collect()
    bins, by_doc = defaultdict(list), defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
        by_doc[r.doc_id].append(r)
        assert len(r.ids) == 4 * r.length and zlib.crc32(r.ids) == r.ids_crc32
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1024
    for doc_id, text, _, _ in cases.TEXTS:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, packing.END]
        parts = sorted(by_doc[doc_id], key=lambda r: r.start)
        copies = sum(x[0] == doc_id for x in cases.TEXTS)
        assert b"".join(r.ids for r in parts) == np.repeat(np.array([ids], "<u4"), copies, 0).tobytes() or copies > 1
        assert sum(r.length for r in parts) == copies * len(ids)
        assert all(r.length == 1024 for r in parts if r.piece > 0)


def test_empty_table(spark):
    assert packing.pack_documents(cases.documents(spark, []), *PATHS).count() == 0


def test_a_cut_off_enumeration_still_fills():
    rng = random.Random(5)
    for _ in range(200):
        room = rng.randint(5, 60)
        left = Counter(rng.choices(range(3, 40), k=rng.randint(1, 12)))
        sizes = sorted(left, reverse=True)
        sums = {0}
        for s in left.elements():
            sums |= {x + s for x in sums}
        most = max(x for x in sums if x <= room)
        chosen = packing.fullest(sizes, left, room)
        assert sum(chosen) == most and not Counter(chosen) - left
    # a stop after few visits, before the only filling without waste
    sizes = [*range(500, 400, -2), 101]
    left = Counter({s: 3 for s in sizes})
    found = packing.fillings(sizes, left, 1003, 0, tries=5)
    assert found and all(sum(f) == 1003 for f in found)
    # every bin can be full; best fit and a search that drops the branch use one more
    counts = {2: 1, 21: 1, 28: 1, 29: 1, 30: 1, 37: 1, 58: 1, 64: 1, 72: 1, 76: 1, 77: 1, 100: 1, 106: 1, 116: 1, 119: 1, 138: 1, 151: 1, 153: 1, 159: 1, 176: 2, 177: 1, 188: 1, 195: 1, 198: 1, 230: 1, 245: 1, 270: 1, 278: 1, 300: 1, 333: 1, 334: 1, 335: 1, 362: 1, 378: 1, 380: 1, 387: 1, 388: 1, 426: 1, 449: 1, 476: 1, 484: 1, 496: 1, 528: 1, 548: 1, 575: 1, 616: 2, 636: 1, 691: 2, 695: 1, 720: 1, 871: 1}
    assert sum(n for _, n in packing.complete_bins(counts, 1024, nodes=300, tries=20)) == -(-sum(s * n for s, n in counts.items()) // 1024)
