"""Token ids of many texts with `tokenizers`, by way of the distinct words in them.

A text is split into units that are encoded alike alone and in place. The distinct
units of a slice are looked up among those known so far; only the unknown ones are
encoded. What is known is held as Arrow strings beside one array of ids, up to a
bound in bytes, and begun anew beyond it, so a worker's memory does not grow with
the number of distinct words of a corpus.
"""

from __future__ import annotations

import os
import sys
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

KNOWN_BYTES = 16 << 20         # of units and ids that a worker keeps
SLICE = 1 << 21                # bytes of text that are worked on together


def load(path: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def text_slices(texts: pa.Array) -> Iterator[tuple[int, pa.LargeStringArray]]:
    """(place of the first, texts) of runs of about ``SLICE`` bytes, or of one longer text; nulls are empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    sizes = np.cumsum(pc.binary_length(texts).to_numpy())
    at = 0
    while at < len(texts):
        end = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + SLICE)))
        yield at, texts[at:end]
        at = end


class Known:
    """Units and their ids."""

    def __init__(self, most: int = KNOWN_BYTES):
        self.most = most
        self.begin()

    def begin(self) -> None:
        self.units = pa.array([], pa.large_string())
        self.ids, self.sizes = np.zeros(0, np.uint32), np.zeros(0, np.int32)

    def find(self, units: pa.Array, learn: Callable[[list[str]], list[np.ndarray]]) -> np.ndarray:
        """The places of distinct ``units`` among those known, after learning the others."""
        if self.units.nbytes + self.ids.nbytes + self.sizes.nbytes > self.most:
            self.begin()
        at = pc.index_in(units, value_set=self.units)
        new = units.filter(at.is_null())
        if len(new):
            old = len(self.units)
            ids = learn(new.to_pylist())
            self.units = pa.concat_arrays([self.units, new])
            self.ids = np.concatenate([self.ids, *ids])
            self.sizes = np.append(self.sizes, np.array([len(x) for x in ids], np.int32))
            at = at.to_numpy(zero_copy_only=False)
            at[np.isnan(at)] = old + np.arange(len(new))
        return np.asarray(at, np.int64)

    def gather(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the units at ``places`` one after the other, and where each one's begin (and the end)."""
        starts = np.cumsum(self.sizes, dtype=np.int64) - self.sizes
        each = self.sizes[places]
        bounds = np.append(0, np.cumsum(each, dtype=np.int64))
        shift = (starts[places] - bounds[:-1]).astype(np.int32 if len(self.ids) < 1 << 30 else np.int64)
        return self.ids[np.repeat(shift, each) + np.arange(bounds[-1], dtype=shift.dtype)], bounds


def _is_letter(byte: np.ndarray) -> np.ndarray:
    low = byte | 32
    return (low >= 97) & (low <= 122) & (byte >= 65)


def split_units(texts: pa.LargeStringArray, keep_blanks: bool = False) -> tuple[pa.LargeStringArray, np.ndarray]:
    """The units of all texts, and how many each has.

    Units end at ASCII white space, and between a letter and an ASCII character that is
    neither letter nor white space, but not between an apostrophe and a letter (it may begin
    a contraction). Letters here are those of ASCII and U+00C0 to U+00FF. No normal form,
    lower case or word pattern of such vocabularies reaches across these places. White space
    is dropped and units of ASCII alone are lower-cased; with ``keep_blanks`` all stays as it
    is, and a run of white space begins the unit of what follows it, where the character
    before it is of ASCII or a letter (else it may belong to a longer run).
    """
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
    offsets = offsets - offsets[0]
    if not len(data):
        return pa.array([], pa.large_string()), np.zeros(len(texts), np.int64)
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    letter, high = _is_letter(data), data >= 128
    mark = ~(letter | high | blank)
    before = np.concatenate([[0], data[:-1]])
    after = np.concatenate([data[1:], [0]])
    ends_letter = letter | (high & (before == 0xC3) & (data != 0x97) & (data != 0xB7))
    begins_letter = letter | ((data == 0xC3) & (after != 0x97) & (after != 0xB7))
    changes = (mark[1:] & ends_letter[:-1]) | (begins_letter[1:] & mark[:-1] & (data[:-1] != 39))
    edges = offsets[:-1][offsets[:-1] < len(data)]      # a unit ends with its text
    if keep_blanks:
        first = np.ones(len(data), bool)
        first[1:] = changes | (blank[1:] & ~blank[:-1] & (~high[:-1] | ends_letter[:-1]))
        first[edges] = True
        starts = np.flatnonzero(first)
        bounds = np.append(starts, len(data)).astype(np.int64)
        units = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(bounds.tobytes()), pa.py_buffer(data.tobytes()))
        return units, np.diff(np.searchsorted(starts, offsets))
    first = ~blank
    first[1:] &= blank[:-1] | changes
    first[edges] = ~blank[edges]
    starts = np.flatnonzero(first)
    kept = np.cumsum(~blank)
    bounds = np.append(kept[starts] - 1, kept[-1]).astype(np.int64)
    left = data[~blank]
    wide = np.append(0, np.cumsum(left >= 128))[bounds]
    lower = _is_letter(left) & np.repeat(np.diff(wide) == 0, np.diff(bounds))
    units = pa.LargeStringArray.from_buffers(
        len(starts), pa.py_buffer(bounds.tobytes()), pa.py_buffer((left | (lower * np.uint8(32))).tobytes()))
    return units, np.diff(np.searchsorted(starts, offsets))


class _Encoder:
    """Texts to ids by way of their units. A text that holds a special token's string is encoded whole."""

    END, KEEP_BLANKS, ANY_CASE = "", True, False

    def __init__(self, path: str, most: int = KNOWN_BYTES):
        self.model, self.known = load(path), Known(most)
        vocabulary = self.model.get_vocab()
        self.special = [t.content for t in self.model.get_added_tokens_decoder().values()]
        self.bytes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, i in vocabulary.items():             # a character of a byte-level token is a byte
            self.bytes[i] = len(token.removesuffix(self.END))

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.model.encode(text, add_special_tokens=False).ids, np.uint32)

    def together(self, units: list[str], between: str, sizes: list[int]) -> list[np.ndarray]:
        """The ids of units that are encoded in one string and told apart by the bytes of their tokens.

        ``sizes`` are the bytes of each unit's tokens. What stands between units is white space
        that is dropped or a token of its own.
        """
        out: list[np.ndarray] = []
        for at in range(0, len(units), 1000):
            some = units[at:at + 1000]
            ids = np.array(self.model.encode_batch_fast([between.join(some)], add_special_tokens=False)[0].ids, np.uint32)
            gap = len(between) if self.KEEP_BLANKS else 0
            wanted = np.cumsum(np.array(sizes[at:at + 1000]) + gap) - gap
            ends = np.append(0, np.cumsum(self.bytes[ids]))
            cuts = np.searchsorted(ends, wanted, side="right" if not gap else "left")
            cuts = cuts - 1 if not gap else cuts
            if len(ids) and ends[-1] == wanted[-1] and (ends[cuts] == wanted).all():
                starts = np.append(0, cuts[:-1] + bool(gap))
                out += [ids[a:b] for a, b in zip(starts, cuts)]
            else:
                out += self.apart(some)
        return out

    def apart(self, units: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.model.encode_batch_fast(units, add_special_tokens=False)]

    def encode(self, texts: pa.LargeStringArray) -> list[np.ndarray]:
        """The ids of each text of a slice (none of them null)."""
        units, n = split_units(texts, self.KEEP_BLANKS)
        coded = units.dictionary_encode()
        flat, bounds = self.known.gather(self.known.find(coded.dictionary, self.learn)[coded.indices.to_numpy()])
        bounds = bounds[np.append(0, np.cumsum(n))]
        out = [flat[a:b] for a, b in zip(bounds, bounds[1:])]
        for token in self.special:
            for i in np.flatnonzero(pc.match_substring(texts, token, ignore_case=self.ANY_CASE).to_numpy(zero_copy_only=False)):
                out[i] = self.whole(texts[int(i)].as_py())
        return out

    def slices(self, texts: pa.Array) -> Iterator[tuple[int, list[np.ndarray]]]:
        """(place of the first, ids of each) of texts in slices of bounded size."""
        for at, some in text_slices(texts):
            yield at, self.encode(some)


class WordEncoder(_Encoder):
    """For vocabularies that lower-case, drop white space and split words at other than letters."""

    END, KEEP_BLANKS, ANY_CASE = "</w>", False, True

    def learn(self, units: list[str]) -> list[np.ndarray]:
        return self.together(units, " ", [
            len(u) if u.isascii() else len(unicodedata.normalize("NFC", u).lower().encode()) for u in units])


class ByteEncoder(_Encoder):
    """For byte-level vocabularies, where a blank belongs to the word after it."""

    def learn(self, units: list[str]) -> list[np.ndarray]:
        kinds: tuple[list[int], ...] = [], [], []
        for i, u in enumerate(units):
            body = u[1:] if u[0] == " " else u
            kinds[2 if not body or any(c.isspace() for c in body) else u[0] == " "].append(i)
        out: list[np.ndarray] = [None] * len(units)
        bare, led, other = ([units[i] for i in some] for some in kinds)
        size = lambda some: [len(u.encode()) for u in some]
        for some, found in zip(kinds, (self.together(bare, "\n", size(bare)), self.together(led, "", size(led)), self.apart(other))):
            for i, ids in zip(some, found):
                out[i] = ids
        return out


def held(kind: type, path: str):
    """One encoder per worker process, kind and path."""
    kept = sys.__dict__.setdefault("_tidemark_encoders", {})
    key = (kind.__name__, path)
    if key not in kept:
        kept[key] = kind(path)
    return kept[key]
