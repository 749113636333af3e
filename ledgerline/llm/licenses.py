"""Licence scan: Aho-Corasick over tags and notice phrases, licence expressions evaluated.

Two automata read a text once each. One runs over its words (joined by single blanks, so
that a phrase is found whatever stands between its words) and finds notice phrases; the
other runs over the raw lower-cased text and finds identifier tags such as
``spdx-license-identifier:``. What follows a tag is a licence expression; it goes through a
shunting-yard parser with the precedences of its grammar: WITH before AND before OR.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import documents

# Phrases of the contract and their labels.
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
# Further notices, as words.
NOTICES = {
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "redistribution and use in source and binary forms": "bsd",
    "licensed under the apache license": "apache-2",
    "gnu general public license": "gpl",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "creative commons attribution noncommercial": "cc-by-nc",
    "creative commons attribution sharealike": "cc-by-sa",
    "creative commons attribution": "cc-by",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "all rights reserved": "proprietary",
}
# Identifier tags, and licence families with the freedom they leave (0 to 1).
TAGS = ("spdx-license-identifier:", "license-expression:")
FREEDOM = {
    "mit": 1.0, "apache-2": 1.0, "bsd": 1.0, "isc": 1.0, "unlicense": 1.0, "cc0": 1.0, "cc-by": 0.9, "mpl": 0.6,
    "cc-by-sa": 0.5, "lgpl": 0.5, "gpl": 0.2, "agpl": 0.1, "cc-by-nc": 0.1, "proprietary": 0.0,
}
UNKNOWN, EXCEPTION = 0.3, 0.5
# How sure a finding is that the text carries a licence.
SURE = {"tag": 1.0, "base": 0.9, "notice": 0.8, "odd": 0.5}

#: Byte table: A-Z to a-z; everything that belongs to no word to a blank.
WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256))
PRIORITY = {"or": 1, "and": 2, "with": 3}
TOKEN = re.compile(r"[()]|[a-z0-9][a-z0-9.+\-:]*", re.ASCII)
BETWEEN = re.compile(r"[ \t]*")

FOUND = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_base", T.LongType()),
        T.StructField("first_word", T.LongType()),
        T.StructField("last_word", T.LongType()),
        T.StructField("base_labels", T.StringType()),
        T.StructField("labels", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("expressions", T.StringType()),
        T.StructField("freedom", T.DoubleType()),
    ]
)


def family(name: str) -> str:
    """Licence identifier to its label: the longest family that starts it, else itself."""
    for known in sorted(FREEDOM, key=len, reverse=True):
        if name == known or name.startswith((f"{known}-", f"{known}.", f"{known}+")):
            return known
    return name


def evaluate(expression: str, at: int = 0) -> tuple[str, list[str], float]:
    """Licence expression in a lower-cased line from ``at``, as far as it is well formed.

    Returns it in reverse Polish form, its labels and the freedom it leaves: OR is the
    choice of the better, AND the worse of both, WITH lifts a licence to at least a half.
    Raises ValueError if no expression starts there or its parentheses do not match.
    """
    out: list[str] = []
    stack: list[str] = []
    operand_next = True
    while match := TOKEN.match(expression, BETWEEN.match(expression, at).end()):
        token = match[0]
        if operand_next:
            if token == "(":
                stack.append(token)
            elif token == ")" or token in PRIORITY:
                break
            else:
                out.append(token.rstrip(".:"))
                operand_next = False
        elif token in PRIORITY:
            while stack and stack[-1] != "(" and PRIORITY[stack[-1]] >= PRIORITY[token]:
                out.append(stack.pop())
            stack.append(token)
            operand_next = True
        elif token == ")" and "(" in stack:
            while (top := stack.pop()) != "(":
                out.append(top)
        else:
            break
        at = match.end()
    if operand_next or not out:
        raise ValueError("no operand where one is needed")
    while stack:
        if (top := stack.pop()) == "(":
            raise ValueError("a parenthesis stays open")
        out.append(top)
    values: list[float] = []
    labels: list[str] = []
    for k, token in enumerate(out):
        if token in PRIORITY:
            b, a = values.pop(), values.pop()
            values.append(max(a, b) if token == "or" else min(a, b) if token == "and" else max(a, EXCEPTION))
        elif out[k + 1 : k + 2] == ["with"]:
            values.append(UNKNOWN)  # an exception, no licence of its own
        else:
            labels.append(family(token))
            values.append(FREEDOM.get(labels[-1], UNKNOWN))
    return " ".join(out), labels, values[0]


class Scanner:
    def __init__(self):
        import ahocorasick

        self.phrases = ahocorasick.Automaton()
        for phrase in {**NOTICES, **BASE}:
            self.phrases.add_word(f" {phrase} ", phrase)
        self.tags = ahocorasick.Automaton()
        for tag in TAGS:
            self.tags.add_word(tag, tag)
        self.phrases.make_automaton()
        self.tags.make_automaton()

    def scan(self, text: str) -> tuple:
        raw = text.encode("utf-8", "surrogatepass")
        words = raw.translate(WORDS).split()
        joined = f" {b' '.join(words).decode('utf-8', 'surrogatepass')} "
        starts: list[int] = []
        base, labels, sure, freedom, expressions = set(), set(), [], [], []
        counted, word = 0, 0
        for end, phrase in self.phrases.iter(joined):
            at = end - len(phrase) - 1  # the blank before the phrase
            if phrase in BASE:
                # overlapping findings end in order, but need not start in it
                word = word + joined.count(" ", counted, at) if at >= counted else word - joined.count(" ", at, counted)
                counted = at
                starts.append(word)
                base.add(BASE[phrase])
                sure.append(SURE["base"])
            else:
                labels.add(NOTICES[phrase])
                sure.append(SURE["notice"])
            freedom.append(FREEDOM[BASE.get(phrase) or NOTICES[phrase]])
        lower = text.lower()
        for end, _ in self.tags.iter(lower):
            try:
                polish, names, free = evaluate(lower, end + 1)
            except ValueError:
                sure.append(SURE["odd"])
                continue
            labels.update(names)
            expressions.append(polish)
            freedom.append(free)
            sure.append(SURE["tag"])
        return (
            len(words),
            len(starts),
            min(starts, default=None),
            max(starts, default=None),
            ",".join(sorted(base)),
            ",".join(sorted(base | labels)),
            max(sure, default=0.0),
            "; ".join(expressions),
            min(freedom, default=None),
        )


def _scan(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    scanner = Scanner()
    kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.string(), pa.float64()]
    for part in texts:
        columns = zip(*[scanner.scan(x.as_py() or "") for x in part], strict=True) if len(part) else [[]] * len(kinds)
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
        yield pa.StructArray.from_arrays(arrays, names=FOUND.names)


#: Text column -> struct ``FOUND``.
scan = F.arrow_udf(_scan, FOUND)


def license_scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds the columns of ``FOUND``, replacing those of the same names. Rows stay as they are.

    A null or empty text has no words and no findings: labels are '', the score 0, places
    and freedom null. ``labels`` holds the base labels and those of notices and expressions;
    the score is that of the surest finding, ``freedom`` that of the strictest.
    """
    kept = [c for c in docs.columns if c not in FOUND.names]
    found = "_".join(["_found", *kept])  # a name that no column has
    return docs.select(*kept, scan(F.col(text).cast("string")).alias(found)).select(*kept, f"`{found}`.*")


def query(spark, sf_dir: str) -> DataFrame:
    return license_scan(documents(spark, sf_dir, "doc_id", "text")).drop("text")
