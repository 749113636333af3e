import hashlib
import random

import cases
import xxhash

from ledgerline.llm import chunks


def slow_boundaries(data):
    """The definition, byte by byte."""
    ends, start = [], 0
    while start < len(data):
        end = min(start + chunks.LONGEST, len(data))
        for i in range(start + chunks.WINDOW - 1, end):
            h = 0
            for b in data[max(0, i - chunks.WINDOW + 1) : i + 1]:
                h = (h << 1) + int(chunks.GEAR[b]) & 0xFFFFFFFF
            mask = int(chunks.STRICT if i + 1 <= start + chunks.NORMAL else chunks.LOOSE)
            # a boundary of the loose mask counts from the normal size on
            if not h & mask or (i + 1 == start + chunks.NORMAL and not h & int(chunks.LOOSE)):
                end = i + 1
                break
        ends.append(end)
        start = end
    return ends


def test_boundaries_follow_the_definition():
    rng = random.Random(5)
    for n in (0, 1, 31, 32, 33, 64, 500, 4000):
        data = bytes(rng.choice(b"abcdefgh ") for _ in range(n))
        assert chunks.boundaries(data) == slow_boundaries(data)
    assert chunks.boundaries(b"a" * 2000)[-1] == 2000


def test_insertion_moves_boundaries_along():
    rng = random.Random(6)
    text = "".join(rng.choice("abcdefghijkl ") for _ in range(6000))
    a, b = chunks.fingerprint(text), chunks.fingerprint("inserted " + text)
    assert chunks.containment(a, b) > 0.9


def test_containment_edges():
    one = chunks.fingerprint("some text")
    assert chunks.containment({}, {}) == 1 and chunks.containment({}, one) == 0 and chunks.containment(one, {}) == 0
    assert chunks.containment(one, one) == 1


def tie(text):
    found = xxhash.xxh64_intdigest((text or "").encode(), 42)
    return found - (found >> 63 << 64)


def brute(rows):
    order = sorted(rows, key=lambda r: (-(r[0] if r[0] is not None else -(2**63)), tie(r[1])))
    out = []
    for k, (doc_id, text, *_) in enumerate(order):
        text, after = text or "", order[(k + 1) % len(order)][1] or ""
        n = len(text)
        edited = text[: n - n // 3] + after[: n // 3]
        own, new = chunks.fingerprint(text), chunks.fingerprint(edited)
        out.append(
            (doc_id, n, hashlib.sha256(edited.encode()).hexdigest(), chunks.written(own), chunks.written(new),
             chunks.containment(own, new), chunks.containment(own, chunks.fingerprint(after)))
        )
    return sorted(out, key=str)


def test_edited_equals_brute_force(spark):
    docs = cases.clashing(cases.documents(spark))
    assert sorted(map(tuple, chunks.edited(docs).collect()), key=str) == brute(cases.TEXTS)


def test_edited_over_many_ranges(spark):
    rng = random.Random(8)
    rows = [(i * 7 % 5000, " ".join(rng.choice(["one", "two", "three"]) for _ in range(i % 40)), "en", "s") for i in range(5000)]
    assert len({r["_range"] for r in chunks.in_ranges(cases.documents(spark, rows)).select("_range").distinct().collect()}) > 3
    assert sorted(map(tuple, chunks.edited(cases.documents(spark, rows)).collect()), key=str) == brute(rows)


def test_rows_without_id_and_of_one_id_are_cut_into_ranges(spark):
    rng = random.Random(9)
    ids = [None] * 3000 + [7] * 1500 + list(range(1500))
    rows = [(i, " ".join(rng.choice(["red", "green", "blue", ""]) for _ in range(9)), "en", "s") for i in ids]
    docs = cases.documents(spark, rows)
    sizes = {(r["_range"], r["_guest"]): r["count"] for r in chunks.in_ranges(docs).groupBy("_range", "_guest").count().collect()}
    own = [n for (_, guest), n in sizes.items() if not guest]
    assert sum(own) == len(rows) and max(own) < 2 * 1000
    assert [n for (_, guest), n in sizes.items() if guest] == [1] * len(own)
    assert sorted(map(tuple, chunks.edited(docs).collect()), key=str) == brute(rows)


def test_equal_rows_have_one_guest(spark):
    rows = [(None, "", None, None)] * 2500 + [(i, f"text {i}", "en", "s") for i in range(2500)]
    docs = cases.documents(spark, rows)
    assert chunks.in_ranges(docs).where("_guest").groupBy("_range").count().where("count > 1").count() == 0
    assert sorted(map(tuple, chunks.edited(docs).collect()), key=str) == brute(rows)


def test_the_smallest_id_is_an_id(spark):
    rows = [(-(2**63), "last of all", "en", "s"), (2**63 - 1, "first of all", "en", "s"), (None, "none", None, None)]
    docs = cases.documents(spark, rows)
    assert sorted((r.doc_id for r in chunks.edited(docs).collect()), key=str) == sorted((r[0] for r in rows), key=str)


def test_single_and_no_document(spark):
    row = chunks.edited(cases.documents(spark, cases.TEXTS[:1])).collect()[0]
    assert row.near_next == 1.0
    assert chunks.edited(cases.documents(spark, [])).count() == 0


def test_fingerprints_of_equal_texts_are_equal(spark):
    rows = chunks.fingerprints(cases.clashing(cases.documents(spark))).collect()
    assert len(rows) == len(cases.TEXTS)
    assert len({r.fingerprint for r in rows if r.doc_id in (1, 2)}) == 1
    assert {r.fingerprint for r in rows if r.doc_id in (3, 4)} == {""}
