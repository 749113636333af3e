import random
import re

import cases
import pytest

from ledgerline.llm import licenses

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


@pytest.mark.parametrize(
    ("text", "polish", "freedom"),
    [
        ("mit", "mit", 1.0),
        ("mit or gpl-2.0-only and cc-by-nc-4.0", "mit gpl-2.0-only cc-by-nc-4.0 and or", 1.0),
        ("(mit or gpl-3.0+) and cc-by-nc-4.0", "mit gpl-3.0+ or cc-by-nc-4.0 and", 0.1),
        ("gpl-2.0 with classpath-exception-2.0", "gpl-2.0 classpath-exception-2.0 with", 0.5),
        ("mit. the rest of the line", "mit", 1.0),
        ("mystery-1.0\nmit", "mystery-1.0", 0.3),
    ],
)
def test_expressions(text, polish, freedom):
    found = licenses.evaluate(text)
    assert (found[0], found[2]) == (polish, freedom)


@pytest.mark.parametrize("text", ["", "and mit", "(mit", "mit or", ") mit", "\nmit"])
def test_malformed_expressions(text):
    with pytest.raises(ValueError):
        licenses.evaluate(text)


def brute(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text))
    places, labels = [], set()
    for phrase, label in licenses.BASE.items():
        parts = phrase.split()
        for k in range(len(words) - len(parts) + 1):
            if words[k : k + len(parts)] == parts:
                places.append(k)
                labels.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def test_base_findings_equal_brute_force(spark):
    rng = random.Random(4)
    vocabulary = "under the mit license apache version 2 cc by nc CC Under ünder the, (mit) x".split()
    rows = [(i, rng.choice([" ", "-", "\n"]).join(rng.choice(vocabulary) for _ in range(rng.randint(0, 400))), "en", "s") for i in range(60)]
    rows += [(100, "cc by nc cc by nc by nc under the mit license", "en", "s"), *cases.TEXTS]
    found = licenses.license_scan(cases.clashing(cases.documents(spark, rows))).collect()
    assert len(found) == len(rows)
    by_text = {r.text: r for r in found}
    for _, text, _, _ in rows:
        r = by_text[text]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute(text or "")
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1


def test_tags_and_notices():
    scan = dict(zip(licenses.FOUND.names, licenses.Scanner().scan("// SPDX-License-Identifier: MIT OR Apache-2.0\nAll rights reserved."), strict=True))
    assert scan["labels"] == "apache-2,mit,proprietary" and scan["score"] == 1.0 and scan["base_labels"] == ""
    assert scan["expressions"] == "mit apache-2.0 or" and scan["freedom"] == 0.0
    odd = licenses.Scanner().scan("SPDX-License-Identifier: (MIT")
    assert odd[licenses.FOUND.names.index("score")] == 0.5


def test_empty_table(spark):
    assert licenses.license_scan(cases.documents(spark, [])).count() == 0
