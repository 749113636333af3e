"""Texts as sequences of distinct chunks, which tokenizers see once per batch.

A tokenizer that never joins two words need not read a word as often as a text has it. A
batch of texts is cut where no token can reach across; the chunks are dictionary-encoded;
only distinct ones are tokenized; ids of texts are gathered by place.
"""

from __future__ import annotations

import base64
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of texts that are cut at a time: bounds the working arrays of a task.
TEXTS = 16 << 20
#: By byte: white space of one byte.
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 28, 29, 30, 31, 32]] = True
#: By byte: first bytes of characters among which there is white space (no-break space and so on).
_LEAD = np.zeros(256, bool)
_LEAD[[0xC2, 0xE1, 0xE2, 0xE3]] = True


def column_of(texts: pa.Array, prefix: str = "") -> pa.Array:
    """Strings with null as empty, each after ``prefix``."""
    texts = pc.fill_null(texts.cast(pa.string()), "")
    return pc.binary_join_element_wise(pa.scalar(prefix), texts, pa.scalar("")) if prefix else texts


def bytes_of(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all strings one after another, and where each begins (and the last ends)."""
    _, offsets, data = array.buffers()
    at = np.frombuffer(offsets, np.int32, len(array) + 1, 4 * array.offset).astype(np.int64)
    held = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return held, at - at[0]


def _shown_at(data: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Whether the character that begins there is visible. One that may be white space of several
    bytes counts as such, here and below: fewer cuts, all right."""
    return ~(_BLANK[data[places]] | _LEAD[data[places]])


def _shown_before(data: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Whether the character that ends there is visible."""
    last = data[places - 1]
    two, three = data[np.maximum(places - 2, 0)], data[np.maximum(places - 3, 0)]
    return ~_BLANK[last] & ~((last >= 128) & ((two == 0xC2) | ((three >= 0xE1) & (three <= 0xE3))))


def between_words(data: np.ndarray) -> np.ndarray:
    """Places of single blanks between two visible characters."""
    blank = np.flatnonzero(data[1:-1] == 32) + 1
    return blank[_shown_at(data, blank + 1) & _shown_before(data, blank)]


def before_words(data: np.ndarray) -> np.ndarray:
    """Places of blanks that follow another character."""
    return np.flatnonzero((data[1:] == 32) & (data[:-1] != 32)) + 1


class Chunks:
    """Texts cut into chunks: the distinct ones, and which ones each text consists of."""

    def __init__(self, texts: pa.Array, cuts: Callable[[np.ndarray], np.ndarray]):
        data, at = bytes_of(texts)
        begun = np.zeros(len(data), bool)
        begun[cuts(data)] = True
        begun[at[:-1][at[1:] > at[:-1]]] = True
        starts = np.flatnonzero(begun)
        offsets = np.r_[starts, len(data)].astype(np.int32)
        # A copy of the bytes: Arrow needs a buffer that it may keep.
        pieces = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data.tobytes())])
        coded = pieces.dictionary_encode()
        #: Distinct chunks as bytes; the chunk at each place; the first place of each text, and the end.
        self.distinct: pa.Array = coded.dictionary
        self.places = coded.indices.to_numpy()
        self.first = np.searchsorted(starts, at)

    def per_text(self, values: np.ndarray) -> np.ndarray:
        """Sums over the places of each text of a value per distinct chunk."""
        sums = np.r_[0, np.cumsum(values[self.places], dtype=np.int64)]
        return sums[self.first[1:]] - sums[self.first[:-1]]

    def gather(self, ids: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct chunks, one after another, to ids of the texts and where each begins."""
        starts = np.r_[0, np.cumsum(lengths)[:-1]] if len(lengths) else np.zeros(0, np.int64)
        n = lengths[self.places]
        ends = np.cumsum(n)
        at = np.repeat(starts[self.places] - ends + n, n) + np.arange(int(ends[-1]) if len(ends) else 0)
        return ids[at], np.r_[0, ends][self.first]


def ranks_of(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


class ByteBpe:
    """A byte-level vocabulary given as ranks."""

    def __init__(self, ranks_path: str):
        import public_tokenizers
        import tiktoken

        ranks = ranks_of(ranks_path)
        self.coding = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        #: Bytes of each id.
        self.width = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, id_ in ranks.items():
            self.width[id_] = len(token)

    def of_chunks(self, chunks: pa.Array, other: Callable[[str], list[int]] | None = None, odd: np.ndarray | None = None):
        """Ids of all chunks (``between_words``, valid UTF-8), and how many each has.

        Chunks that begin with a blank before, and end with, a visible character stay apart if
        they are put one after another: they are tokenized as one text and parted by the bytes
        of the tokens. Others, beginnings and ends of texts, are tokenized one by one, and so
        are those marked ``odd``, by ``other``.
        """
        data, at = bytes_of(chunks)
        plain = np.diff(at) > 1
        starts, ends = at[:-1][plain], at[1:][plain]
        plain[plain] = (data[starts] == 32) & _shown_at(data, starts + 1) & _shown_before(data, ends)
        if odd is not None:
            plain &= ~odd
        text, bounds = bytes_of(chunks.filter(pa.array(plain)))
        ids = self.coding.encode_to_numpy(text.tobytes().decode(), disallowed_special=()).astype(np.uint32)
        reached = np.cumsum(self.width[ids])
        last = np.searchsorted(reached, bounds[1:])
        if not np.array_equal(reached[last], bounds[1:]):
            raise ValueError("a token reaches over a cut")
        lengths = np.zeros(len(chunks), np.int64)
        lengths[plain] = np.diff(last, prepend=-1)
        rest = {}
        for k in np.flatnonzero(~plain).tolist():
            coder = other if odd is not None and odd[k] else self.coding.encode_ordinary
            rest[k] = np.array(coder(chunks[k].as_py().decode()), np.uint32)
            lengths[k] = len(rest[k])
        out = np.zeros(int(lengths.sum()), np.uint32)
        out[np.repeat(plain, lengths)] = ids
        begins = np.cumsum(lengths) - lengths
        for k, x in rest.items():
            out[begins[k] : begins[k] + len(x)] = x
        return out, lengths
