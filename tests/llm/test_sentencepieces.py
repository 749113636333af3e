import hashlib
import random

import cases
import pyarrow as pa
import pyarrow.parquet as pq
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from ledgerline.llm import sentencepieces

PATH = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", None, " ", "  ", "   ", "a", " a", "  a  b ", "▁x ▁ y", "\t a\nb", "日本語 ほげ", "<s> </s> <unk> <0x41>", "a\x00b", "🙂 é é", "x" * 300, " " * 37 + "a", " " * 1000, "a" + " " * 15 + "b", "�", "Ａﬁ x", "1234 56 7890"]


@pytest.fixture(scope="module")
def library():
    return SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def coders():
    return sentencepieces.Encoder(PATH), sentencepieces.Decoder(PATH)


def same(coders, library, texts):
    encoder, decoder = coders
    ids, at = encoder.texts(pa.array(texts, pa.string()))
    wanted = [library.encode(x or "") for x in texts]
    assert [ids[a:b].tolist() for a, b in zip(at, at[1:], strict=False)] == wanted
    assert decoder.texts(ids, at).to_pylist() == [library.decode(x) for x in wanted]


def test_ids_and_texts_of_the_library(coders, library):
    same(coders, library, ODD)
    same(coders, library, [])
    same(coders, library, pq.read_table("/root/testdata/sf0.01/documents.parquet").column("text").to_pylist())


@pytest.mark.parametrize("alphabet", ["ab theer in  on1é▁\n日𝔘", "aehrt ", " ", "  \t.-_", "the of and ing er "])
def test_random_texts(coders, library, alphabet):
    rng = random.Random(1)
    same(coders, library, ["".join(rng.choices(alphabet, k=rng.randint(0, 120))) for _ in range(1500)])


def test_chunks_together_and_alone_have_one_table(coders, library, monkeypatch):
    texts = ["the quick brown " + "abcdefghij" * k for k in range(8)]
    same(coders, library, texts)
    monkeypatch.setattr(sentencepieces, "TOGETHER", 3)
    same(coders, library, texts + ODD)


def test_pairs_of_tokens_are_compatible_if_merging_gives_them(coders, library):
    encoder = coders[0]
    rng = random.Random(2)
    tokens = [k for k, t in encoder.vocabulary.text.items() if encoder.valid[k] and len(t) < 8]
    import numpy as np

    a, b = (np.array([rng.choice(tokens) for _ in range(4000)]) for _ in range(2))
    found = encoder.unlike(a, b)
    score, text = encoder.vocabulary.score, encoder.vocabulary.text
    for x, y, fits in zip(a.tolist(), b.tolist(), found.tolist(), strict=True):
        parts = list(text[x] + text[y])
        while len(parts) > 1:
            s = [score.get(p + q, float("-inf")) for p, q in zip(parts, parts[1:], strict=False)]
            if max(s) == float("-inf"):
                break
            k = s.index(max(s))
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        assert fits == (parts == [text[x], text[y]])


def test_any_ids_are_decoded(coders, library):
    import numpy as np

    rng = random.Random(3)
    pool = [0, 1, 2, 3, 4, 30, 68, 100, 200, 226, 130, 131, 229, 259, 261, 262, 300, 31990]
    lists = [[rng.choice(pool) for _ in range(rng.randint(0, 8))] for _ in range(500)]
    assert [coders[1].text(x) for x in lists] == [library.decode(x) for x in lists]
    at = np.r_[0, np.cumsum([len(x) for x in lists])]
    assert coders[1].texts(np.array(sum(lists, []), np.int32), at).to_pylist() == [library.decode(x) for x in lists]


def test_rows_of_any_kind(spark, library):
    docs = cases.clashing(cases.documents(spark))
    rows = sentencepieces.encoded(docs, PATH).collect()
    wanted = sorted((d or -1, library.encode(t or "")) for d, t, _, _ in cases.TEXTS)
    assert sorted((r.doc_id or -1, list(r.ids)) for r in rows) == wanted
    assert sentencepieces.encoded(cases.documents(spark, []), PATH).count() == 0


def test_query_digests(spark, library):
    root = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{root}/documents.parquet").select("doc_id", F.col("text")).collect()}
    rows = sentencepieces.query(spark, root).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode(texts[r.doc_id] or "")
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
