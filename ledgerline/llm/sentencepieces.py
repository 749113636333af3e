"""SentencePiece BPE by a merge-type prefix table.

Merging always takes the best pair of neighbours there is, the leftmost of equal ones. So the
ids of a text's prefix end in one token that depends on the prefix alone, and two neighbours
of an encoding are an encoding of their own. A table over the places of a text therefore
stores for each prefix its last token: of the pieces that an automaton finds to end there, it
is the one that is compatible with the last token of the prefix before it. The tokens of the
whole text are read from the table backwards. No merge queue is run over the text.

Two tokens are compatible if merging their characters together gives these two again: if at
no time a merge across their border is better than what either would merge next on its own.
The merges of each piece on its own are worked out once, with the vocabulary.

The tables of many texts are filled at once, place by place.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import batches_of, documents
from ledgerline.llm.vocab import TEXTS, Chunks, before_words, bytes_of, column_of

#: The sign that stands for a blank in pieces.
SPACE = "▁"
#: What an unknown id is decoded to; a byte that is no part of a character.
UNKNOWN, NO_CHARACTER = " ⁇ ", "�"
#: Pairs of tokens whose compatibility a task remembers (a power of two).
PAIRS = 1 << 21
#: Characters up to which the tables of many chunks are filled together; longer chunks have a table each.
TOGETHER = 48


class Vocabulary:
    """Pieces of a BPE model file, with blanks as blanks."""

    def __init__(self, model_path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=model_path)
        #: Text of each normal piece, value of each byte piece, ids that stand for nothing.
        self.text: dict[int, str] = {}
        self.byte: dict[int, int] = {}
        self.control: set[int] = set()
        self.unknown, self.size = model.unk_id(), model.get_piece_size()
        for k in range(self.size):
            piece = model.id_to_piece(k)
            if model.is_byte(k):
                self.byte[k] = int(piece[1:-1], 16)
            elif model.is_control(k) or model.is_unused(k):
                self.control.add(k)
            elif k != self.unknown:
                self.text[k] = piece.replace(SPACE, " ")
        self.score = {t: model.get_score(k) for k, t in self.text.items()}
        probe = " AÄ  Ａﬁ x "
        if model.decode(model.encode(probe)) != probe or len(self.byte) != 256:
            raise ValueError("a BPE model with byte pieces that leaves texts as they are is needed")
        #: Whether a blank always begins a piece: then texts may be cut before blanks.
        self.cut = all(" " not in t.lstrip(" ") for t in self.score)


class Lookup:
    """Numbers from 0 on to small numbers, -1 for others: a hash table whose gets take arrays."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.mask = (1 << max(4, int(len(keys) * 2 - 1).bit_length())) - 1
        self.keys, self.values = np.full(self.mask + 1, -1, np.int64), np.full(self.mask + 1, -1, np.int32)
        at = self.slot(keys)
        while len(keys):
            free = self.keys[at] < 0
            self.keys[at[free]] = keys[free]  # of several keys for a slot one gets it
            mine = self.keys[at] == keys
            self.values[at[mine]] = values[mine]
            keys, values, at = keys[~mine], values[~mine], at[~mine] + 1 & self.mask

    def slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(24)).astype(np.int64) & self.mask

    def get(self, keys: np.ndarray) -> np.ndarray:
        at = self.slot(keys)
        found = self.keys[at]
        out = np.where(found == keys, self.values[at], np.int32(-1))
        left = np.flatnonzero((found != keys) & (found >= 0))
        while len(left):
            at[left] = at[left] + 1 & self.mask
            found = self.keys[at[left]]
            hit = found == keys[left]
            out[left[hit]] = self.values[at[left[hit]]]
            left = left[~hit & (found >= 0)]
        return out


class Encoder:
    """Ids of texts by prefix tables; see the module. Its size is that of the vocabulary.

    Tokens are the pieces' ids, then characters that pieces consist of but that are no piece,
    then ``other`` for all characters that no piece has.
    """

    def __init__(self, model_path: str):
        self.vocabulary = v = Vocabulary(model_path)
        inside = sorted({c for t in v.score for c in t})
        texts = dict(v.text)
        texts |= {v.size + k: c for k, c in enumerate(c for c in inside if c not in v.score)}
        self.other = max(texts) + 1
        tokens = {t: k for k, t in texts.items()}
        ranks = {s: k for k, s in enumerate(sorted(set(v.score.values())))}
        rank = {t: ranks[s] for t, s in v.score.items()}
        self.byte_id = np.zeros(256, np.int32)
        self.byte_id[list(v.byte.values())] = list(v.byte)
        #: Class of each character, 0 for characters that no piece has.
        self.kind = np.zeros(0x110000, np.int32)
        self.kind[[ord(c) for c in inside]] = np.arange(1, len(inside) + 1)
        self.width = np.ones(self.other + 1, np.int64)
        self.width[list(texts)] = [len(t) for t in texts.values()]
        self._merges(texts, tokens, rank)
        self._automaton(texts, inside)
        self.memo: tuple[np.ndarray, np.ndarray] | None = None
        #: What ``table`` remembers: steps of the automaton, and compatible pairs.
        self.edges: dict[int, int] = {}
        self.seen: dict[tuple[int, int], bool] = {}

    def _merges(self, texts: dict[int, str], tokens: dict[str, int], rank: dict[str, int]) -> None:
        """For each token the merges it comes from, in order: last and first part before each, and
        the rank of each (-1 after the last). Whether its characters merge to it at all."""
        steps = int(self.width.max())
        n = self.other + 1
        self.last, self.first = np.full((n, steps), self.other, np.int32), np.full((n, steps), self.other, np.int32)
        self.next = np.full((n, steps), -1, np.int32)
        self.valid = np.zeros(n, bool)
        self.valid[self.other] = True
        keys, values = [], []
        for token, text in texts.items():
            for k in range(1, len(text)):
                left, right = tokens.get(text[:k]), tokens.get(text[k:])
                if left is not None and right is not None:
                    keys.append(left * n + right)
                    values.append(rank[text])
            parts, k = list(text), 0
            while True:
                self.last[token, k], self.first[token, k] = tokens[parts[-1]], tokens[parts[0]]
                found = [rank.get(a + b, -1) for a, b in zip(parts, parts[1:], strict=False)]
                best = max(found, default=-1)
                if best < 0:
                    break
                at = found.index(best)
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
                self.next[token, k] = best
                k += 1
            self.valid[token] = len(parts) == 1
        self.joined = Lookup(np.array(keys, np.int64), np.array(values, np.int32))

    def _automaton(self, texts: dict[int, str], inside: list[str]) -> None:
        """Aho-Corasick over all tokens: edges, where to go on without one, next match to report."""
        children: list[dict[int, int]] = [{}]
        token = [-1]
        for k, text in texts.items():
            node = 0
            for c in text:
                kind = int(self.kind[ord(c)])
                if kind not in children[node]:
                    children[node][kind] = len(children)
                    children.append({})
                    token.append(-1)
                node = children[node][kind]
            token[node] = k
        back, report = [0] * len(children), [0] * len(children)
        queue = deque(children[0].values())
        while queue:
            node = queue.popleft()
            for kind, child in children[node].items():
                to = back[node]
                while to and kind not in children[to]:
                    to = back[to]
                back[child] = children[to].get(kind, 0)
                queue.append(child)
            report[node] = back[node] if token[back[node]] >= 0 else report[back[node]]
        self.kinds = len(inside) + 1
        keys = [node * self.kinds + kind for node, edges in enumerate(children) for kind in edges]
        self.edge = Lookup(np.array(keys, np.int64), np.array([c for edges in children for c in edges.values()], np.int32))
        self.back, self.report, self.token = (np.array(x, np.int32) for x in (back, report, token))

    def step(self, node: np.ndarray, kind: np.ndarray) -> np.ndarray:
        out = self.edge.get(node.astype(np.int64) * self.kinds + kind)
        left = np.flatnonzero((out < 0) & (node > 0))
        node = node[left]
        while len(left):
            node = self.back[node]
            found = self.edge.get(node.astype(np.int64) * self.kinds + kind[left])
            out[left] = found
            on = (found < 0) & (node > 0)
            left, node = left[on], node[on]
        return np.maximum(out, 0)

    def unlike(self, before: np.ndarray, token: np.ndarray) -> np.ndarray:
        """Compatibility of valid tokens by their merges: the border holds if, at each time, no
        merge across it is better than the next one on its left and as good as the one on its right."""
        out = np.ones(len(before), bool)
        i, j = np.zeros(len(before), np.int64), np.zeros(len(before), np.int64)
        left = np.arange(len(before))
        while len(left):
            a, b = before[left], token[left]
            across = self.joined.get(self.last[a, i[left]].astype(np.int64) * (self.other + 1) + self.first[b, j[left]])
            mine, theirs = self.next[a, i[left]], self.next[b, j[left]]
            broken = (across > mine) & (across >= theirs) & (across >= 0)
            out[left[broken]] = False
            on = ~broken & ((mine >= 0) | (theirs >= 0))
            first = (mine >= theirs)[on]
            left = left[on]
            i[left[first]] += 1
            j[left[~first]] += 1
        return out

    def compatible(self, before: np.ndarray, token: np.ndarray) -> np.ndarray:
        """Whether ``token`` may follow ``before`` (a token that is in a table, or -1 at the beginning)."""
        if self.memo is None:
            self.memo = np.full(PAIRS, -1, np.int64), np.zeros(PAIRS, bool)
        out = self.valid[token]
        check = np.flatnonzero(out & (before >= 0))
        keys = before[check].astype(np.int64) * (self.other + 1) + token[check]
        slot = ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(24)).astype(np.int64) & (PAIRS - 1)
        known, value = self.memo
        fits = value[slot]
        missed = np.flatnonzero(known[slot] != keys)
        if len(missed):
            new, place = np.unique(keys[missed], return_inverse=True)
            found = self.unlike(new // (self.other + 1), new % (self.other + 1))
            fits[missed] = found[place]
            known[slot[missed]], value[slot[missed]] = keys[missed], fits[missed]
        out[check] = fits
        return out

    def tables(self, codes: np.ndarray, starts: np.ndarray, lengths: np.ndarray, last: np.ndarray) -> None:
        """Fills the tables of chunks (by falling length): ``last`` at start + place, from place 1 on."""
        node = np.zeros(len(starts), np.int32)
        for place in range(1, int(lengths[0]) + 1 if len(lengths) else 1):
            n = int(np.searchsorted(-lengths, -place, "right"))
            starts, node = starts[:n], node[:n]
            node = self.step(node, self.kind[codes[starts + place]])
            match = np.where(self.token[node] >= 0, node, self.report[node])
            open_ = np.arange(n)
            while len(open_):
                token = self.token[match]
                none = match == 0
                last[starts[open_[none]] + place] = self.other
                open_, match, token = open_[~none], match[~none], token[~none]
                back = place - self.width[token]
                fits = self.compatible(last[starts[open_] + back], token)
                last[starts[open_[fits]] + place] = token[fits]
                open_, match = open_[~fits], self.report[match[~fits]]

    def table(self, codes: np.ndarray, last: np.ndarray) -> None:
        """The same for one chunk, place by place; codes and ``last`` are its own, from place 1 on."""
        if len(self.edges) + len(self.seen) > PAIRS:
            self.edges.clear()
            self.seen.clear()
        node, edges, seen = 0, self.edges, self.seen
        kinds, report, tokens, width = self.kind[codes].tolist(), self.report, self.token, self.width
        held = [-1] + [self.other] * (len(codes) - 1)
        for place in range(1, len(codes)):
            key = node * self.kinds + kinds[place]
            if key not in edges:
                edges[key] = int(self.step(np.array([node], np.int32), np.array([kinds[place]]))[0])
            node = edges[key]
            match = node if tokens[node] >= 0 else int(report[node])
            while match:
                token = int(tokens[match])
                pair = held[place - int(width[token])], token
                if pair not in seen:
                    seen[pair] = bool(self.compatible(np.array([pair[0]]), np.array([token]))[0])
                if seen[pair]:
                    held[place] = token
                    break
                match = int(report[match])
        last[1:] = held[1:]

    def of_chunks(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all chunks, one after another, and how many each has."""
        data, at = bytes_of(chunks)
        heads = np.r_[0, np.cumsum((data & 0xC0) != 0x80)]
        begins = heads[at] + np.arange(len(at))  # a place before each chunk's first character
        codes = np.zeros(begins[-1], np.uint32)
        lengths = np.diff(begins) - 1
        codes[np.delete(np.arange(len(codes)), begins[:-1])] = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
        last = np.full(len(codes), -1, np.int32)
        order = np.argsort(-lengths, kind="stable")
        order = order[lengths[order] <= TOGETHER]
        self.tables(codes, begins[:-1][order], lengths[order], last)
        for k in np.flatnonzero(lengths > TOGETHER):
            own = slice(begins[k], begins[k + 1])
            self.table(codes[own], last[own])
        # Backwards: the places at which tokens end.
        ends = np.zeros(len(codes), bool)
        place, floor = begins[1:] - 1, begins[:-1]
        place, floor = place[place > floor], floor[place > floor]
        while len(place):
            ends[place] = True
            place = place - self.width[last[place]]
            on = place > floor
            place, floor = place[on], floor[on]
        return self.spelled(codes, last, ends, begins)

    def spelled(self, codes: np.ndarray, last: np.ndarray, ends: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Tokens at ``ends``, those beyond the vocabulary as the ids of their bytes."""
        where = np.flatnonzero(ends)
        tokens = last[where]
        beyond = np.flatnonzero(tokens >= self.vocabulary.size)
        raw = [chr(c).encode() for c in codes[where[beyond]].tolist()]
        count = np.ones(len(tokens), np.int64)
        count[beyond] = [len(x) for x in raw]
        ids = np.repeat(tokens, count)
        if len(beyond):
            spots = np.cumsum(count) - count
            for k in range(4):
                long = [r for r, x in enumerate(raw) if len(x) > k]
                ids[spots[beyond[long]] + k] = self.byte_id[[raw[r][k] for r in long]]
        sums = np.r_[0, np.cumsum(count)][np.searchsorted(where, begins)]
        return ids, np.diff(sums)

    def chunked(self, texts: pa.Array) -> Chunks:
        """Texts with null as empty, a blank before each that is not empty, cut before words."""
        texts = pc.replace_substring(column_of(texts), SPACE, " ")
        texts = pc.if_else(pc.equal(texts, ""), texts, column_of(texts, " "))
        return Chunks(texts, before_words if self.vocabulary.cut else (lambda data: np.zeros(0, np.int64)))

    def texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after another, and where each text's begin (and the last one's end)."""
        chunks = self.chunked(texts)
        return chunks.gather(*self.of_chunks(chunks.distinct))


class Decoder:
    """Texts of ids: pieces put together, without the blank before the first one."""

    def __init__(self, model_path: str):
        v = Vocabulary(model_path)
        raw = {k: t.encode() for k, t in v.text.items()} | {k: b"" for k in v.control} | {v.unknown: UNKNOWN.encode()}
        raw |= {k: bytes([b]) for k, b in v.byte.items()}
        self.raw = [raw[k] for k in range(v.size)]
        self.byte, self.control = v.byte, v.control
        #: Ids that begin with a blank which is left out at the beginning of a text.
        self.blank = {k for k, t in v.text.items() if t[:1] == " "}

    def text(self, ids: list[int]) -> str:
        skip = next((k for k in ids if k not in self.control), None) in self.blank
        try:
            return b"".join([self.raw[k] for k in ids])[skip:].decode()
        except UnicodeDecodeError:
            return self._mended(ids)[skip:]

    def _mended(self, ids: list[int]) -> str:
        """Runs of byte ids that are no characters: each byte that begins none stands for itself."""
        out, run = [], b""
        for k in [*ids, None]:
            if k in self.byte:
                run += self.raw[k]
                continue
            while run:
                width = next((w for w in (1, 2, 3, 4) if _is_text(run[:w])), 0)
                out.append(run[:width].decode() if width else NO_CHARACTER)
                run = run[width or 1 :]
            if k is not None:
                out.append(self.raw[k].decode())
        return "".join(out)

    def texts(self, ids: np.ndarray, at: np.ndarray) -> pa.Array:
        """Texts of ids that lie one after another, from ``at`` on each."""
        pieces = pa.array(self.raw, pa.binary()).take(pa.array(ids))
        data, places = bytes_of(pieces)
        begins = at[:-1][np.diff(at) > 0]
        skip = np.zeros(len(data), bool)
        skip[places[begins[np.isin(ids[begins], list(self.blank))]]] = True
        bounds = places[at] - np.r_[0, np.cumsum(skip)][places[at]]
        whole = pa.Array.from_buffers(pa.binary(), len(at) - 1, [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(data[~skip].tobytes())])
        plain = not len(ids) or not np.isin(ids[begins], list(self.control)).any()
        try:
            if plain:
                return whole.cast(pa.string())
        except pa.ArrowInvalid:
            pass
        return pa.array([self.text(ids[a:b].tolist()) for a, b in zip(at[:-1], at[1:], strict=True)], pa.string())


def _is_text(data: bytes) -> bool:
    try:
        return len(data.decode()) == 1
    except UnicodeDecodeError:
        return False


def encoded(docs: DataFrame, model_path: str) -> DataFrame:
    """(doc_id, text) -> doc_id, ids, text: the ids of each whole text, and the text decoded from them.

    A null text is empty; an empty one has no ids. Null and repeated doc_ids and repeated
    rows are rows of their own; other columns are not returned. An empty table gives none.
    A blank and U+2581 are the same to the model: both are decoded as a blank.
    """
    encoder, decoder = Encoder(model_path), Decoder(model_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in batches_of(batch, TEXTS):
                ids, at = encoder.texts(part.column(1))
                lists = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([part.column(0), lists, decoder.texts(ids, at)], names=["doc_id", "ids", "text"])

    picked = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return picked.mapInArrow(run, "doc_id long, ids array<int>, text string")


def digests(rows: DataFrame) -> DataFrame:
    """(doc_id, ids, text) -> number of ids and digests of ids and text."""
    ids = F.concat_ws(",", F.col("ids").cast("array<string>"))
    return rows.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(ids.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )


def query(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return digests(encoded(documents(spark, sf_dir, "doc_id", "text"), public_tokenizers.path("piece_bpe_32k.model")))
