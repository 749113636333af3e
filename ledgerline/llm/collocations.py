"""Phrase collocations mined with mergeable Misra-Gries summaries.

Passes over the texts:

1. Words go, by hash, to a partition, each once a task with its spelling and count. A partition
   merges the summaries of all tasks (a task's exact counts are a summary that has lost nothing)
   and, whenever more counters are left than its capacity, takes the largest surplus counter's
   value off all. What has been taken off is the summary's error. The capacity is a multiple of
   the partition's mass divided by the threshold, so the error stays below the threshold and every
   frequent word survives. The survivors are then counted exactly in what the tasks have sent.
   The frequent ones get numbers; their spellings are returned once, by their partition.
2. For 2, 3, ... words: a phrase can only be frequent if the one without its last word and the one
   without its first word are. Its key is the number of the one and the number of the last word,
   which no other phrase shares. Keys are counted like words.

So no task returns phrases: they are spelled by joins, from the number of the phrase that is
shorter by a word and that of the last word. What the tasks send grows with the words that they
read, not with the phrases that are frequent in all texts. Scores, cuts and the containment rule
are joins and aggregates over the frequent phrases.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import batches_of, documents, mix64, save, span_hashes, tidy
from ledgerline.llm.ngrams import BLOB, Folder, _blobs, _ranges, packed, shard_of, summed, unpacked
from ledgerline.sources.layers import scratch_path

#: Words of the longest phrase, least count of a phrase, rows per language.
LONGEST, THRESHOLD, TOP = 5, 100, 2000
#: Bytes of texts that are looked at together, hashes that are gathered before they are sent,
#: words that a task holds before it sends them and bytes of these, bytes of text per partition,
#: and how many times mass / threshold a summary's capacity is: its error is below
#: threshold / SLACK.
TEXTS, GATHER, HELD, HELD_BYTES, PARTITION, SLACK = 2 << 20, 4_000_000, 500_000, 32 << 20, 12_000_000, 4
#: What a task sends of words: per partition their hashes, counts and languages, and spellings.
SPELLED = "shard long, n long, blob binary, langs array<string>, words binary"
#: Languages up to which their totals are broadcast.
FEW = 10_000
#: Byte table: A-Z to a-z, blank and tab to a blank, what ends a piece to a line feed.
_ENDS = b".,;:!?\n\x0b\x0c\r"
_FOLD = bytes(10 if b in _ENDS else 32 if b in b" \t" else b + 32 if 65 <= b <= 90 else b for b in range(256))


class Words:
    """The words of a batch of texts, in order."""

    def __init__(self, texts: list[str], langs: list[str]):
        raw = [x.encode("utf-8", "surrogatepass") for x in texts]
        self.text = (b"\n".join(raw) + b"\n").translate(_FOLD)
        data = np.frombuffer(self.text, np.uint8)
        end = data == 10
        edges = np.diff((~end & (data != 32)).astype(np.int8), prepend=np.int8(0))
        self.starts, self.stops = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        self.piece = np.cumsum(end, dtype=np.int32)[self.starts]
        begins = np.cumsum([0, *[len(x) + 1 for x in raw[:-1]]])
        self.langs = sorted(set(langs))
        code = {x: k for k, x in enumerate(self.langs)}
        self.lang = np.array([code[x] for x in langs], np.int64)[np.searchsorted(begins, self.starts, "right") - 1] if raw else np.zeros(0, np.int64)
        seeds = np.array([xxhash.xxh64_intdigest(x.encode("utf-8", "surrogatepass")) for x in self.langs], np.uint64)
        hashes = span_hashes(data, self.starts, self.stops)
        #: A word of one language is not that of another.
        self.hash = mix64(hashes ^ seeds[self.lang]) if len(hashes) else hashes

    def phrase(self, first: int, n: int) -> bytes:
        spans = zip(self.starts[first : first + n].tolist(), self.stops[first : first + n].tolist(), strict=True)
        return b" ".join([self.text[a:b] for a, b in spans])


class Summary:
    """Misra-Gries counters: each is below a key's true count by ``error`` at most."""

    def __init__(self, capacity: int):
        self.capacity, self.error = capacity, 0
        self.keys, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def merge(self, keys: np.ndarray, counts: np.ndarray, error: int = 0) -> None:
        """Adds another summary with distinct keys."""
        self.keys, self.counts = summed(np.r_[self.keys, keys], np.r_[self.counts, counts])
        self.error += error
        if len(self.keys) > self.capacity:
            surplus = len(self.keys) - self.capacity - 1
            off = np.partition(self.counts, surplus)[surplus]
            left = self.counts > off
            self.keys, self.counts = self.keys[left], self.counts[left] - off
            self.error += int(off)

    def frequent(self, threshold: int) -> np.ndarray:
        """All keys that can have been seen ``threshold`` times, sorted."""
        return self.keys[self.counts + self.error >= threshold]


class Counted:
    """Phrases of one length in many batches of texts: hashes, counts, and each phrase written once."""

    def __init__(self):
        self.keys, self.place = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.langs, self.phrases, self.counts, self.size = [], [], np.zeros(0, np.int64), 0

    def add(self, words: Words, n: int, keys: np.ndarray, times: np.ndarray, first: np.ndarray) -> None:
        """Adds ``times`` to sorted distinct keys, whose phrases of ``n`` words begin at ``first``."""
        at = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), bool)
        inside = at < len(self.keys)
        known[inside] = self.keys[at[inside]] == keys[inside]
        self.counts[self.place[at[known]]] += times[known]
        new = ~known
        self.keys = np.insert(self.keys, at[new], keys[new])
        self.place = np.insert(self.place, at[new], len(self.phrases) + np.arange(new.sum()))
        self.counts = np.r_[self.counts, times[new]]
        self.langs += [words.langs[k] for k in words.lang[first[new]].tolist()]
        self.phrases += [words.phrase(k, n) for k in first[new].tolist()]
        self.size += int((words.stops[first[new] + n - 1] - words.starts[first[new]]).sum())

    def sent(self, parts: int) -> pa.RecordBatch:
        """A row per partition."""
        rows = []
        for part, r in _ranges(shard_of(self.keys, parts)):
            place = self.place[r]
            langs = sorted({self.langs[k] for k in place.tolist()})
            code = {x: k for k, x in enumerate(langs)}
            codes = np.array([code[self.langs[k]] for k in place.tolist()], np.uint32)
            spelled = zstandard.ZstdCompressor(level=1).compress(b"\n".join([self.phrases[k] for k in place.tolist()]))
            rows.append((part, len(place), packed(self.keys[r], self.counts[place].astype(np.uint32), codes), langs, spelled))
        kinds = [pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.string()), pa.binary()]
        columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
        return pa.RecordBatch.from_arrays(columns, names=["shard", "n", "blob", "langs", "words"])


class Numbers:
    """Numbers of sorted keys by partition in a shared folder, mapped on first use."""

    def __init__(self, folder: Folder, name: str, parts: int):
        self.folder, self.name, self.parts = folder, name, parts
        self.mapped: dict[int, np.ndarray] = {}

    def put(self, part: int, keys: np.ndarray) -> np.ndarray:
        """Stores a partition's keys. The numbers of a partition are its own modulo ``parts``."""
        if len(keys) * self.parts >= 1 << 32:
            raise OverflowError("a phrase's number has to fit into 32 bits")
        self.folder.put(f"{self.name}.{part}", keys)
        return np.arange(len(keys)) * self.parts + part

    def of(self, keys: np.ndarray) -> np.ndarray:
        """Of keys in any order; -1 where there is none."""
        distinct, place = np.unique(keys, return_inverse=True)
        out = np.full(len(distinct), -1, np.int64)
        for part, r in _ranges(shard_of(distinct, self.parts)):
            if part not in self.mapped:
                try:
                    self.mapped[part] = self.folder.get(f"{self.name}.{part}")
                except FileNotFoundError:  # nothing was dealt there
                    self.mapped[part] = np.zeros(0, np.uint64)
            at, known = _found(self.mapped[part], distinct[r])
            out[r] = np.where(known, at * self.parts + part, -1)
        return out[place]


def _found(sorted_keys: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of keys, and whether they are there."""
    if not len(sorted_keys):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
    return at, sorted_keys[at] == keys


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[Words]:
    for batch in batches:
        for part in batches_of(batch, TEXTS):
            yield Words(part.column(0).to_pylist(), part.column(1).to_pylist())


def _keys(words: Words, levels: list[Numbers]) -> np.ndarray:
    """Keys of all phrases, longer by a word than the last of ``levels``, that can be frequent."""
    last = numbers = levels[0].of(words.hash)
    at = np.flatnonzero(numbers >= 0)
    for n in range(2, len(levels) + 2):
        at = at[at + n - 1 < len(last)]
        at = at[(numbers[at + 1] >= 0) & (words.piece[at + n - 1] == words.piece[at])]
        keys = mix64((numbers[at].astype(np.uint64) << np.uint64(32)) | last[at + n - 1].astype(np.uint64))
        if n <= len(levels):
            found = levels[n - 1].of(keys)
            numbers = np.full(len(last), -1, np.int64)
            numbers[at] = found
            at = at[found >= 0]
    return keys


def _unmix64(x: np.ndarray) -> np.ndarray:
    """What ``mix64`` made these of."""
    x = x ^ (x >> np.uint64(31)) ^ (x >> np.uint64(62))
    x = x * np.uint64(pow(0x94D049BB133111EB, -1, 1 << 64))
    x = x ^ (x >> np.uint64(27)) ^ (x >> np.uint64(54))
    x = x * np.uint64(pow(0xBF58476D1CE4E5B9, -1, 1 << 64))
    return x ^ (x >> np.uint64(30)) ^ (x >> np.uint64(60))


def _sent(found: Iterator[np.ndarray], parts: int, gather: int = GATHER) -> Iterator[pa.RecordBatch]:
    """Counts of hashes, gathered from many batches: a compressed row per partition."""
    held, size = [], 0

    def flush() -> pa.RecordBatch:
        keys, counts = np.unique(np.concatenate(held), return_counts=True)
        return _blobs([(p, 0, 0, r.stop - r.start, packed(keys[r], counts[r].astype(np.uint32))) for p, r in _ranges(shard_of(keys, parts))])

    for hashes in found:
        held.append(hashes)
        size += len(hashes)
        if size > gather:
            yield flush()
            held, size = [], 0
    if size:
        yield flush()


def _counted(sent: Callable, threshold: int, slack: int) -> tuple[np.ndarray, np.ndarray]:
    """All keys that were sent ``threshold`` times, and how often. ``sent()`` goes over keys and counts."""
    mass = sum(int(counts.sum(dtype=np.int64)) for _, counts in sent())
    summary = Summary(slack * mass // threshold + 1)
    for keys, counts in sent():
        summary.merge(keys, counts.astype(np.int64))
    found = summary.frequent(threshold)
    times = np.zeros(len(found), np.int64)
    for keys, counts in sent():
        at, known = _found(found, keys)
        times[at[known]] += counts[known]
    return found[times >= threshold], times[times >= threshold]


def _kept_words(numbers: Numbers, threshold: int, slack: int):
    def run(key: tuple, group: pa.Table) -> pa.Table:
        """Numbers a partition's frequent words, and counts all of a language."""
        sizes, blobs, spelled = group.column("n").to_pylist(), group.column("blob"), group.column("words")
        langs = group.column("langs").to_pylist()

        def sent() -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
            for n, blob in zip(sizes, blobs, strict=True):
                yield unpacked(blob.as_py(), n, np.uint64, np.uint32, np.uint32)

        found, times = _counted(lambda: ((keys, counts) for keys, counts, _ in sent()), threshold, slack)
        words, of, totals = [None] * len(found), [None] * len(found), Counter()
        for (keys, counts, codes), names, blob in zip(sent(), langs, spelled, strict=True):
            for code, n in enumerate(np.bincount(codes, counts, len(names)).tolist()):
                totals[names[code]] += int(n)
            at, known = _found(found, keys)
            spellings = None
            for k in np.flatnonzero(known).tolist():
                if words[at[k]] is None:
                    spellings = spellings or zstandard.ZstdDecompressor().decompress(blob.as_py()).split(b"\n")
                    words[at[k]], of[at[k]] = spellings[k].decode("utf-8", "surrogatepass"), names[codes[k]]
        ids = numbers.put(key[0].as_py(), found).tolist()
        return pa.table(
            {
                "id": pa.array(ids + [None] * len(totals), pa.int64()),
                "lang": pa.array(of + list(totals), pa.string()),
                "phrase": pa.array(words + [None] * len(totals), pa.string()),
                "f": pa.array(times.tolist() + list(totals.values()), pa.int64()),
            }
        )

    return run


def _kept(numbers: Numbers, threshold: int, slack: int):
    def run(key: tuple, group: pa.Table) -> pa.Table:
        """Numbers a partition's frequent phrases."""
        sizes, blobs = group.column("n").to_pylist(), group.column("blob")
        found, times = _counted(
            lambda: (unpacked(b.as_py(), n, np.uint64, np.uint32) for n, b in zip(sizes, blobs, strict=True)), threshold, slack
        )
        ids, pair = numbers.put(key[0].as_py(), found), _unmix64(found)
        return pa.table({"id": ids, "first": (pair >> np.uint64(32)).astype(np.int64), "last": (pair & np.uint64(0xFFFFFFFF)).astype(np.int64), "f": times})

    return run


def frequent_phrases(texts: DataFrame, longest: int, threshold: int, slack: int = SLACK, partition: int = PARTITION) -> tuple[DataFrame, DataFrame]:
    """(text, lang) -> (lang, phrase, f) of all phrases of 1 to ``longest`` words with f >= threshold,
    and (lang, n): all words.

    The numbered phrases lie in the shared folder; nothing is collected.
    """
    spark = texts.sparkSession
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(4, -(-size // partition))
    folder = Folder(scratch_path(spark, "collocations"))
    levels = [Numbers(folder, f"phrase{n}", parts) for n in range(1, longest + 1)]

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Counted()
        for x in _words(batches):
            distinct, first, times = np.unique(x.hash, return_index=True, return_counts=True)
            held.add(x, 1, distinct, times, first)
            if len(held.phrases) > HELD or held.size > HELD_BYTES:
                yield held.sent(parts)
                held = Counted()
        if held.phrases:
            yield held.sent(parts)

    def count(known: list[Numbers]):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            return _sent((_keys(x, known) for x in _words(batches)), parts)

        return run

    kept = texts.mapInArrow(tidy(spell), SPELLED).groupBy("shard")
    kept = save(kept.applyInArrow(_kept_words(levels[0], threshold, slack), "id long, lang string, phrase string, f long"), "words")
    words, totals = kept.where("id IS NOT NULL"), kept.where("id IS NULL").groupBy("lang").agg(F.sum("f").alias("n"))
    ends = words.select(F.col("id").alias("last"), F.col("phrase").alias("_word"))
    shorter, found = words, words.drop("id")
    for n in range(2, longest + 1):
        kept = texts.mapInArrow(tidy(count(levels[: n - 1])), BLOB).groupBy("shard")
        kept = save(kept.applyInArrow(_kept(levels[n - 1], threshold, slack), "id long, first long, last long, f long"), "phrases")
        begins = shorter.select(F.col("id").alias("first"), "lang", F.col("phrase").alias("_begin"))
        shorter = kept.join(begins, "first").join(ends, "last").select("id", "lang", F.concat_ws(" ", "_begin", "_word").alias("phrase"), "f")
        shorter = save(shorter, "phrases")
        found = found.unionByName(shorter.drop("id"))
    return found, totals


def _part(words, first, n):
    return F.array_join(F.slice(words, first, n), " ")


def scored(counts: DataFrame, totals: DataFrame) -> DataFrame:
    """(lang, phrase, f), (lang, n) -> lang, phrase, a, l, r, n, score at the lowest-scoring cut.

    Decimals hold the products: 10^3 a n and l r have at most 38 digits up to 10^17 words.
    """
    words = F.split("phrase", " ")
    candidates = counts.select("lang", "phrase", F.col("f").alias("a"), words.alias("w")).where(F.size("w") > 1)
    cuts = candidates.select("*", F.explode(F.sequence(F.lit(1), F.size("w") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", _part("w", F.lit(1), F.col("k")).alias("x"), _part("w", F.col("k") + 1, F.size("w")).alias("y"))
    for name, side in (("l", "x"), ("r", "y")):
        cuts = cuts.join(counts.select("lang", F.col("phrase").alias(side), F.col("f").alias(name)), ["lang", side])
    few = totals.limit(FEW + 1).count() <= FEW
    cuts = cuts.join(F.broadcast(totals) if few else totals, "lang")
    big = {c: F.col(c).cast("decimal(18,0)") for c in ("a", "n", "l", "r")}
    exact = cuts.withColumns({f"_{c}": x for c, x in big.items()})
    score = F.expr("(CAST(1000 AS DECIMAL(4,0)) * _a * _n) div (_l * _r)").cast("long")
    best = F.min(F.struct(score.alias("score"), "k", "l", "r", "n")).alias("b")
    return exact.groupBy("lang", "phrase", "a").agg(best).select("lang", "phrase", "a", "b.l", "b.r", "b.n", "b.score")


def uncovered(rows: DataFrame) -> DataFrame:
    """(lang, phrase, a, ...) without phrases that a longer one contains which is seen as often."""
    words = F.split("phrase", " ")
    longer = rows.select("lang", F.col("a").alias("_most"), words.alias("w")).where(F.size("w") > 2)
    longer = longer.select("lang", "_most", "w", F.explode(F.sequence(F.lit(2), F.size("w") - 1)).alias("n"))
    longer = longer.select("lang", "_most", "w", "n", F.explode(F.sequence(F.lit(1), F.size("w") - F.col("n") + 1)).alias("i"))
    inner = longer.groupBy("lang", _part("w", F.col("i"), F.col("n")).alias("phrase")).agg(F.max("_most").alias("_most"))
    return rows.join(inner, ["lang", "phrase"], "left").where("_most IS NULL OR 100 * _most < 100 * a").drop("_most")


def collocations(
    docs: DataFrame,
    longest: int = LONGEST,
    threshold: int = THRESHOLD,
    top: int = TOP,
    slack: int = SLACK,
    partition: int = PARTITION,
) -> DataFrame:
    """(text, lang) -> lang, rank, phrase, a, l, r, n, score: the best phrases of each language.

    Null and empty texts have no words; a null lang is ``und``. Repeated rows count as often
    as they come. Ties are ranked by count, then phrase. An empty table, or one without
    frequent phrases, gives none. Words are told apart by 64-bit hashes, phrases exactly
    by their words.
    """
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang")
    texts = docs.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), lang)
    rows = uncovered(scored(*frequent_phrases(texts, longest, threshold, slack, partition)))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def query(spark, sf_dir: str) -> DataFrame:
    return collocations(documents(spark, sf_dir, "text", "lang"))


def oracle() -> str:
    return f"""WITH d AS (
      SELECT coalesce(lang, 'und') AS lang,
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
    p AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\\n\\x0B\\f\\r]')) AS piece FROM d),
    w AS (SELECT lang, regexp_extract_all(piece, '[^ \\t]+') AS ws FROM p),
    k AS (SELECT lang, ws, unnest(range(1, {LONGEST + 1})) AS k FROM w),
    i AS (SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM k WHERE len(ws) >= k),
    f AS (SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase, count(*) AS f FROM i GROUP BY ALL),
    n AS (SELECT lang, sum(f)::HUGEINT AS n FROM f WHERE k = 1 GROUP BY lang),
    c AS (SELECT lang, phrase, k, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE k > 1 AND f >= {THRESHOLD}),
    j AS (SELECT *, unnest(range(1, k)) AS j FROM c),
    s AS (SELECT j.lang, j.phrase, j.k, j.a, j.j, l.f AS l, r.f AS r, n.n,
        (1000::HUGEINT * j.a * n.n) // (l.f::HUGEINT * r.f) AS score
      FROM j JOIN n ON n.lang = j.lang
      JOIN f l ON l.lang = j.lang AND l.phrase = array_to_string(j.ws[1:j.j], ' ')
      JOIN f r ON r.lang = j.lang AND r.phrase = array_to_string(j.ws[j.j + 1:], ' ')),
    b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
    m AS (SELECT lang, a AS most, ws, k, unnest(range(2, k)) AS size FROM c WHERE k > 2),
    o AS (SELECT lang, most, ws, size, unnest(range(1, k - size + 2)) AS i FROM m),
    u AS (SELECT lang, array_to_string(ws[i:i + size - 1], ' ') AS phrase, max(most) AS most FROM o GROUP BY ALL),
    x AS (SELECT b.* FROM b LEFT JOIN u ON u.lang = b.lang AND u.phrase = b.phrase
      WHERE u.most IS NULL OR 100 * u.most < 100 * b.a)
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase,
      a, l, r, n::BIGINT AS n, score::BIGINT AS score FROM x
    QUALIFY row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) <= {TOP}"""
