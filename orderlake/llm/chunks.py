"""Encoding with the tokenizers library, each distinct piece of text once.

Texts are cut where the tokenizer's own splitting never joins what is on both sides, so
the ids of the pieces, in order, are the ids of the whole text. Arrow finds the distinct
pieces of a block, the library encodes those not yet known, and numpy lays out the ids.
"""

from __future__ import annotations

import os
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from tokenizers import Tokenizer

CACHED = 500_000  # words remembered by a process; the memory is emptied beyond
CACHED_LED = 150_000  # and pieces that may be led by a space, which are longer
# Letters, perhaps behind a space, and signs after them are always split from each other.
_TAILED = regex.compile(r"( ?[A-Za-z]+)([.,;:!?]+)")
_ENDS = r"([a-z])([.,;:!?]+(?:[\x09-\x0d ]|$))"
_LETTERS = regex.compile(r" ?[A-Za-z]+")
# Small letters of Latin-1 are one composed character each, which lower-casing leaves as it is.
_SMALL = regex.compile("[a-z\u00df-\u00f6\u00f8-\u00ff]+")
_SPACE_FIRST, _SPACE_LAST = regex.compile(r"^\s"), regex.compile(r"\s$")


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in byte-level BPE."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table, extra = {b: chr(b) for b in shown}, 256
    for b in range(256):
        if b not in table:
            table[b] = chr(extra)
            extra += 1
    return [table[b] for b in range(256)]


_CHARACTERS = byte_characters()
_SHOWN = {c: "".join(_CHARACTERS[b] for b in chr(c).encode()) for c in range(0xDF, 0x100)}


def expand(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices start, start + 1, ... of each stretch, one after another."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - ends + lengths, lengths) + np.arange(ends[-1] if len(ends) else 0)


def binaries(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Binary values from the bytes of ``data`` between byte offsets."""
    return pa.Array.from_buffers(
        pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int32).tobytes()), pa.py_buffer(data.tobytes())]
    )


class PieceEncoder:
    """``keep_space``: cut before a single space between two non-spaces, which then leads
    its piece (byte-level splitting); else the tokenizer lower-cases and pieces are cut at
    ASCII white space, which is dropped, and between letters and signs at a word's end.

    Letters that the tokenizer's normalizing and splitting leave unchanged go to its model
    at once: ASCII ones, and in small letters those of Latin-1 in the model's byte characters.
    """

    def __init__(self, tokenizer: Tokenizer, keep_space: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer, self.keep_space = tokenizer, keep_space
        self.model = Tokenizer(tokenizer.model)
        self.known: dict[str, bytes] = {}

    def _ids(self, pieces: list[str]) -> list[bytes]:
        missing = [p for p in pieces if p not in self.known]
        if len(self.known) + len(missing) > (CACHED_LED if self.keep_space else CACHED):
            self.known.clear()
            missing = pieces
        if self.keep_space:
            self._learn_led(missing)
        else:
            self._learn_words(missing)
        return [self.known[p] for p in pieces]

    def _learn_words(self, missing: list[str]) -> None:
        """Words in ASCII small letters and whatever else."""
        plain, shown, others = [], [], []
        for word in missing:
            if _SMALL.fullmatch(word):
                plain.append(word)
                shown.append(word if word.isascii() else word.translate(_SHOWN))
            else:
                others.append(word)
        self._encode(self.model, plain, shown)
        self._encode(self.tokenizer, others, others)

    def _learn_led(self, missing: list[str]) -> None:
        """Pieces that may be led by a space."""
        tailed = {p: m.groups() for p in missing if (m := _TAILED.fullmatch(p))}
        parts = [a for p in missing for a in tailed.get(p, (p,))]
        new = [a for a in dict.fromkeys(parts) if a not in self.known]
        letters = [a for a in new if _LETTERS.fullmatch(a)]
        plain = set(letters)
        self._encode(self.model, letters, [a.replace(" ", "\u0120") for a in letters])
        others = [a for a in new if a not in plain]
        self._encode(self.tokenizer, others, others)
        for piece, (core, tail) in tailed.items():
            self.known[piece] = self.known[core] + self.known[tail]

    def _encode(self, tokenizer: Tokenizer, pieces: list[str], shown: list[str]) -> None:
        for start in range(0, len(pieces), 20_000):
            stop = start + 20_000
            for piece, found in zip(pieces[start:stop], tokenizer.encode_batch_fast(shown[start:stop], add_special_tokens=False)):
                self.known[piece] = array("I", found.ids).tobytes()

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and the place where each text starts, plus the end. Null is empty."""
        texts = pc.fill_null(texts.cast(pa.string()), "")
        if self.keep_space:
            lists = pc.split_pattern(texts, " ")
        else:
            # fewer distinct pieces: no capitals, no signs behind letters
            lists = pc.ascii_split_whitespace(pc.replace_substring_regex(pc.ascii_lower(texts), _ENDS, r"\1 \2"))
        bounds = lists.offsets.to_numpy().astype(np.int64)
        coded = lists.flatten().dictionary_encode()
        codes, words = coded.indices.to_numpy().astype(np.int64), coded.dictionary.to_pylist()
        if self.keep_space:
            codes, words, bounds = self._led(codes, words, bounds)
        seen = np.zeros(len(words), bool)
        seen[codes] = True
        used = np.flatnonzero(seen)
        local = np.zeros(len(words), np.int64)
        local[used] = np.arange(len(used))
        encoded = self._ids([words[i] for i in used])
        lengths = np.fromiter(map(len, encoded), np.int64, len(encoded)) // 4
        flat = np.frombuffer(b"".join(encoded), "<u4")
        starts, at = np.cumsum(lengths) - lengths, local[codes]
        ids = flat[expand(starts[at], lengths[at])]
        ends = np.concatenate(([0], np.cumsum(lengths[at])))
        return ids, ends[bounds]

    def _led(self, codes: np.ndarray, words: list[str], bounds: np.ndarray) -> tuple[np.ndarray, list[str], np.ndarray]:
        """Pieces with their leading space; where a cut is not safe, pieces are joined again."""
        empty = np.array([not w for w in words], bool)
        before = empty | np.array([bool(_SPACE_LAST.search(w)) for w in words], bool)
        after = empty | np.array([bool(_SPACE_FIRST.search(w)) for w in words], bool)
        first = np.zeros(len(codes), bool)
        first[bounds[:-1]] = True
        unsafe = np.zeros(len(codes), bool)
        # an empty piece at a text's start stands for a text that starts with a space
        unsafe[1:] = (before[codes[:-1]] & ~(first[:-1] & empty[codes[:-1]])) | after[codes[1:]]
        unsafe &= ~first
        n = len(words)
        led = codes + n * ~first
        listed = [*words, *(" " + w for w in words)]
        if not unsafe.any():
            return led, listed, bounds
        starts = np.flatnonzero(~unsafe)
        joined, many = led[starts], np.diff(np.append(starts, len(codes))) > 1
        stops = np.append(starts, len(codes))[1:]
        more: dict[str, int] = {}
        for k in np.flatnonzero(many):
            piece = "".join(listed[c] for c in led[starts[k] : stops[k]])
            joined[k] = more.setdefault(piece, 2 * n + len(more))
        return joined, [*listed, *more], np.searchsorted(starts, bounds)


