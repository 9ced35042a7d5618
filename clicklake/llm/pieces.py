"""Texts as rows of pieces that tokenizers encode independently of each other, each distinct piece encoded once.

A text is cut in front of a blank between two characters that are not white space. The pattern of the byte-level tokenizer
starts a word there, and no entry of the other vocabulary goes across it, so the ids of a text are those of its pieces
one after the other. Texts that hold white space beyond ASCII's usual six are not cut, nor are those a caller names.

Cutting, looking pieces up and putting results together work on whole batches, as arrays; what is Python's own work is the
learning of new pieces. A table of pieces belongs to one task and starts anew beyond ``LIMIT`` pieces or ``BYTES`` of them.
"""

from __future__ import annotations

import os
from collections.abc import Sequence
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from clicklake.llm.common import text_bytes, text_column, worker_cache

LIMIT = 300_000
BYTES = 1 << 24
#: Texts of about this many bytes are given to a tokenizer at once.
CHUNK = 1 << 16

_BLANKS = np.zeros(256, bool)
_BLANKS[[9, 10, 11, 12, 13, 32]] = True
_LETTERS, _MARKS = np.zeros(256, bool), np.zeros(256, bool)
_LETTERS[[*range(65, 91), *range(97, 123)]] = True
MARKS = ".,;:!?|%&*#$"
_MARKS[list(MARKS.encode())] = True
#: First bytes of the sequences in ``_ODD``.
_LEADS = np.zeros(256, bool)
_LEADS[[0x1C, 0x1D, 0x1E, 0x1F, 0xC2, 0xE1, 0xE2, 0xE3]] = True
_ODD = [chr(c).encode() for c in range(0x3001) if chr(c).isspace() and c not in (9, 10, 11, 12, 13, 32)]


def odd_places(data: np.ndarray) -> np.ndarray:
    """Places of white space other than blank, tab and line ends."""
    found = [np.zeros(0, np.int64)]
    places = np.flatnonzero(_LEADS[data])
    padded = np.append(data, np.zeros(2, np.uint8))
    for odd in _ODD:
        same = padded[places] == odd[0]
        for i, byte in enumerate(odd[1:], 1):
            same &= padded[places + i] == byte
        found.append(places[same])
    return np.concatenate(found)


def cut(data: np.ndarray, offsets: np.ndarray, whole: np.ndarray, marks: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Where pieces begin, and each text's first piece (and the end). Texts flagged ``whole`` are one piece.

    With ``marks``, a mark after an ASCII letter begins a piece too, and a line end after either, as they begin words of the
    byte-level pattern.
    """
    begins = np.zeros(len(data), bool)
    if len(data) > 2:
        blank = _BLANKS[data]
        begins[1:-1] = (data[1:-1] == 32) & ~blank[:-2] & ~blank[2:]
        if marks:
            letter = _LETTERS[data[:-2]]
            begins[1:-1] |= _MARKS[data[1:-1]] & letter | (data[1:-1] == 10) & (letter | _MARKS[data[:-2]])
    # a blank at the end of a text begins nothing
    filled = np.flatnonzero(np.diff(offsets))
    begins[offsets[filled + 1] - 1] &= data[offsets[filled + 1] - 1] != 32
    flagged = whole.copy()
    if len(odd := odd_places(data)):
        flagged[np.searchsorted(offsets, odd, "right") - 1] = True
    for i in np.flatnonzero(flagged):
        begins[offsets[i] : offsets[i + 1]] = False
    begins[offsets[filled]] = True
    starts = np.flatnonzero(begins)
    return starts, np.searchsorted(starts, offsets)


class PieceTable:
    """Numbers distinct pieces; ``learn`` is told of new ones, in order of their number."""

    marks = False

    def __init__(self):
        self.reset()

    def reset(self) -> None:
        self.known: dict[str, int] = {}
        self.size = 0

    def learn(self, pieces: pa.Array) -> None:
        raise NotImplementedError

    @property
    def full(self) -> bool:
        return len(self.known) > LIMIT or self.size > BYTES

    def numbers(self, data: np.ndarray, offsets: np.ndarray, whole: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The number of each piece of the texts, and each text's first piece (and the end). A full table starts anew."""
        if self.full:
            self.reset()
        starts, first = cut(data, offsets, np.zeros(len(offsets) - 1, bool) if whole is None else whole, self.marks)
        if not len(starts):
            return starts, first
        coded = text_column(data, np.append(starts, len(data))).dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        table = np.fromiter(map(self.known.get, distinct, repeat(-1)), np.int64, len(distinct))
        new = np.flatnonzero(table < 0)
        if len(new):
            table[new] = np.arange(len(self.known), len(self.known) + len(new))
            self.known.update(zip([distinct[i] for i in new], table[new].tolist()))
            pieces = coded.dictionary.take(pa.array(new))
            self.size += len(text_bytes(pieces)[0])
            self.learn(pieces)
        return table[coded.indices.to_numpy()], first


def spread(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places first[i] .. first[i] + size[i] - 1 of every i, one after the other."""
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - (ends - size), size)


def joinable(pieces: pa.Array) -> np.ndarray:
    """Pieces that begin with a blank and have no white space after it or at their end, nor any but the usual six."""
    data, offsets = text_bytes(pieces)
    out = np.diff(offsets) > 1
    first, last = offsets[:-1][out], offsets[1:][out] - 1
    out[out] = (data[first] == 32) & ~_BLANKS[data[first + 1]] & ~_BLANKS[data[last]]
    out[np.searchsorted(offsets, odd_places(data), "right") - 1] = False
    return out


def holds(texts: pa.Array, parts: Sequence[str]) -> np.ndarray:
    """Whether each text holds one of the parts."""
    out = np.zeros(len(texts), bool)
    for part in parts:
        out |= pc.fill_null(pc.match_substring(texts, part), False).to_numpy(zero_copy_only=False)
    return out


def byte_tokenizer(path: str, plain_specials: bool = False):
    """The tokenizer, loaded once in a worker; the number of bytes of each id's token; the strings of its special tokens."""
    cache = worker_cache("tokenizers")
    if (path, plain_specials) not in cache:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        if plain_specials:
            tokenizer.encode_special_tokens = True
        tokens = tokenizer.get_vocab()
        size = np.zeros(max(tokens.values()) + 1, np.int64)
        # one letter of a token stands for one byte
        size[list(tokens.values())] = [len(t) for t in tokens]
        added = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
        cache[path, plain_specials] = tokenizer, size, added
    return cache[path, plain_specials]


def encode_joined(pieces: pa.Array, joined: np.ndarray, encode, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the pieces one after the other, and how many each has.

    ``encode`` gives the ids of each of some texts. Pieces flagged ``joined`` are encoded in texts of about ``CHUNK`` bytes, and the
    bytes of their tokens (``size``) tell where a piece ends; where that does not come out even, each is encoded by itself.
    """
    ids: list[np.ndarray] = [np.zeros(0, np.int64)]
    counts = np.zeros(len(pieces), np.int64)
    rank = np.flatnonzero(joined)
    data, offsets = text_bytes(pieces.filter(pa.array(joined)))
    cuts = np.unique(np.searchsorted(offsets, np.arange(0, len(data) + CHUNK, CHUNK)).clip(max=len(rank)))
    order, alone = [rank[:0]], [np.flatnonzero(~joined)]
    texts = [data[offsets[a] : offsets[b]].tobytes().decode() for a, b in zip(cuts, cuts[1:])]
    for a, b, found in zip(cuts, cuts[1:], encode(texts)):
        ends = np.cumsum(size[found])
        bounds = offsets[a + 1 : b + 1] - offsets[a]
        upto = np.searchsorted(ends, bounds)
        if len(ends) and upto[-1] == len(ends) - 1 and np.array_equal(ends[upto], bounds):
            counts[rank[a:b]] = np.diff(upto, prepend=-1)
            order.append(rank[a:b])
            ids.append(found)
        else:
            alone.append(rank[a:b])
    rest = np.concatenate(alone)
    for i, found in zip(rest, encode([pieces[int(i)].as_py() for i in rest])):
        counts[i] = len(found)
        ids.append(found)
    order = np.concatenate([*order, rest])
    flat = np.concatenate(ids)
    first = np.zeros(len(pieces), np.int64)
    first[order] = np.cumsum(counts[order]) - counts[order]
    return flat[spread(first, counts)], counts


class PieceIds(PieceTable):
    """Texts to ids. The strings of special tokens are what the library makes of them; texts that hold one stay whole."""

    marks = True

    def __init__(self, path: str):
        self.tokenizer, self.bytes, self.added = byte_tokenizer(path)
        super().__init__()

    def reset(self) -> None:
        super().reset()
        self.ids, self.first, self.count = (np.zeros(0, np.int64) for _ in range(3))

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, np.int64) for e in found]

    def learn(self, pieces: pa.Array) -> None:
        joined = joinable(pieces) & ~holds(pieces, self.added)
        ids, counts = encode_joined(pieces, joined, self._encode, self.bytes)
        self.first = np.append(self.first, len(self.ids) + np.cumsum(counts) - counts)
        self.count = np.append(self.count, counts)
        self.ids = np.append(self.ids, ids)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, and how many each has."""
        numbers, first = self.numbers(*text_bytes(texts), holds(texts, self.added))
        counts = self.count[numbers]
        total = np.concatenate([[0], np.cumsum(counts)])
        return self.ids[spread(self.first[numbers], counts)], np.diff(total[first])
