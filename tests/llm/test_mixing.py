import hashlib
from collections import defaultdict

import cases
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import mixing


def fill(given, children):
    """Water filling by repetition: children are (name, weight, capacity)."""
    out, left = {}, sorted(children)
    while left:
        weights = sum(w for _, w, _ in left)
        full = [c for c in left if c[1] and c[2] * weights <= c[1] * given]
        if not full:
            return out | {n: w * given // weights if w else 0 for n, w, _ in left}
        for c in full[:]:
            out[c[0]] = c[2]
            given -= c[2]
            left.remove(c)
            break
    return out


def brute(rows, weights, budget, epochs, seed=mixing.SEED):
    leaves = defaultdict(list)
    for doc_id, text, lang, source in rows:
        number = (source or "")[-1:]
        domain = f"domain{int(number) % 4 if number.isdigit() else 0}"
        leaves[domain, lang or "", source or ""].append(("" if doc_id is None else str(doc_id), len((text or "").split())))
    supply = {k: sum(t for _, t in v) for k, v in leaves.items()}
    shares = {(): int(sum(supply.values()) * budget)}
    for depth, level in enumerate(mixing.LEVELS):
        new = {}
        for node, given in shares.items():
            children = defaultdict(int)
            for k, s in supply.items():
                if k[:depth] == node:
                    children[k[depth]] += s * epochs
            found = fill(given, [(n, weights.get(level, {}).get(n, 1), c) for n, c in children.items()])
            new |= {(*node, n): v for n, v in found.items()}
        shares = new
    out = []
    for k, docs in leaves.items():
        whole = min(shares[k] // supply[k], epochs) if supply[k] else 1
        rest = shares[k] - whole * supply[k] if supply[k] else 0
        place = lambda d: hashlib.md5(f"{seed}:{whole}:{d}".encode()).hexdigest()  # noqa: E731, B023
        for d, _ in docs:
            upto = sum(t for e, t in docs if place(e) <= place(d))
            out += [(d, e) for e in range(whole + (rest > 0 and upto <= rest))]
    return sorted(out)


ROWS = [(i, "w " * (1 + i * 37 % 90), ["en", "de", None][i % 3], f"src{i * i % 11}") for i in range(900)]


@pytest.mark.parametrize(("budget", "epochs", "size"), [(0.4, 1, 1000), (1.0, 4, 1000), (2.5, 2, 5), (10.0, 3, 20), (0.0, 1, 20)])
def test_equals_brute_force(spark, monkeypatch, budget, epochs, size):
    monkeypatch.setattr(mixing, "RANGE", size)  # small: several hash ranges per leaf
    rows = ROWS + cases.TEXTS
    weights = {**mixing.WEIGHTS, "_source": {"src0": 5, "src3": 0}}
    docs = cases.clashing(cases.documents(spark, rows))
    narrow = mixing.keyed(docs).select(*mixing.LEVELS, "_id", mixing.tokens_of().alias("tokens"))
    plan = mixing.planned(narrow, budget, weights, epochs)
    found = sorted((r._id, r.epoch) for r in mixing.taken(narrow, plan).collect())
    assert found == brute(rows, weights, budget, epochs)
    mixed = mixing.mixed(docs, budget, weights, epochs)
    assert mixed.columns == docs.columns and mixed.count() == len(found)


def test_shortage_goes_to_siblings_first(spark):
    rows = [(i, "w " * 10, "en", "src0") for i in range(10)] + [(100 + i, "w " * 10, "de", "src4") for i in range(90)] + [(200 + i, "w " * 10, "en", "src1") for i in range(100)]
    leaves = mixing.keyed(cases.documents(spark, rows)).select(*mixing.LEVELS, mixing.tokens_of().alias("t")).groupBy(*mixing.LEVELS).agg(F.sum("t").alias("supply"), F.count("t").alias("docs"))
    share = {r._source: r.share for r in mixing.budgets(leaves, 0.8, {}, 1).collect()}
    # domain0 is to give 800 tokens, en and de 400 each; en has 100, de takes the rest
    assert share == {"src0": 100, "src4": 700, "src1": 800}


def test_empty_table(spark):
    assert mixing.mixed(cases.documents(spark, [])).count() == 0
