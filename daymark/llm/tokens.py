"""Token ids of many texts by the tokenizers library, each distinct word encoded once.

Byte-pair merges never cross the border between a visible character and a
following white-space character, so a text can be cut before such spaces.
Tasks cut texts at single spaces, look distinct pieces up among those encoded
before and hand only new ones to the library. A text with a space
right after other white space is encoded as a whole, and so is one that holds an added token.

Plain pieces, of letters, a few signs and line ends, fall into the same words under the
library's own rules whatever surrounds them. Such words go straight to its byte-pair model, which saves
most of the time that a call for a whole text takes; all other pieces take that call.
"""

from __future__ import annotations

import os
import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

from daymark.llm.text import string_hashes, text_offsets

# What a worker remembers, in bytes of its arrays; when full, it starts anew. While they grow, arrays take twice that.
MAX_KNOWN_BYTES = 80 << 20
BYTES_PER_PIECE = 40  # two hashes, a place, a start, and room for some ids
SLICE_BYTES = 4 << 20
UNSAFE = r"[\s\x0B\x1C-\x1F\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}] "
PLAIN = regex.compile(r" ?\p{L}+| ?[.,!|]+|\n")


def _byte_letters() -> dict[int, str]:
    """The visible letter that byte-level models write for each byte: itself, or one from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


BYTE_LETTERS = _byte_letters()


class Encoder:
    """Ids of whole texts; ``spaced`` says that a space belongs to the word after it.

    ``added_as_text`` takes the added tokens of the file ("<|endoftext|>") as plain text where a text holds them. Without
    it they get their own ids, as the library does by default.
    """

    def __init__(self, path: str, added_as_text: bool = True):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = added_as_text
        added = self.library.get_added_tokens_decoder().values()
        # Texts with one of these are encoded as a whole.
        self.added = [(t.content, t.normalized) for t in added if t.content and not added_as_text]
        self.spaced = len(self._whole([" "])[0]) > 0
        self.lowers = self._whole(["A"]) == self._whole(["a"])
        self._forget()

    def _forget(self) -> None:
        self.count = 0
        # Both hashes of each known piece, in the order of the first, and where it stands in ``starts``.
        self.first, self.second = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        self.place = np.zeros(0, np.int64)
        self.ids = np.zeros(1 << 16, dtype=np.uint16 if self.library.get_vocab_size() <= 1 << 16 else np.uint32)
        self.starts = np.zeros(1 << 12, dtype=np.int64)
        self.used = 0

    def _held(self) -> int:
        return self.count * (BYTES_PER_PIECE - 8) + self.used * self.ids.itemsize

    def _whole(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _words(self, piece: str) -> list[str] | None:
        """The words of a plain piece."""
        if self.lowers:
            if not unicodedata.is_normalized("NFC", piece) or "\u03a3" in piece:
                return None
            piece = piece.lower()
        words = PLAIN.findall(piece)
        if "".join(words) != piece or "\n\n" in piece:
            return None
        return words if self.spaced else [w for w in words if w != "\n"]

    def _word_ids(self, word: str) -> list[int]:
        shown = word.encode().decode("latin-1").translate(BYTE_LETTERS)
        return [t.id for t in self.library.model.tokenize(shown)]

    def _add(self, pieces: pa.Array, lengths: np.ndarray, flat: np.ndarray) -> None:
        """Remember the ids of distinct pieces that aren't known."""
        while self.used + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while self.count + len(pieces) + 1 > len(self.starts):
            self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
        self.ids[self.used : self.used + len(flat)] = flat
        n = self.count
        self.starts[n + 1 : n + 1 + len(pieces)] = self.used + np.cumsum(lengths)
        first, second = string_hashes(pieces)
        order = np.argsort(first)
        into = np.searchsorted(self.first, first[order])
        self.first = np.insert(self.first, into, first[order])
        self.second = np.insert(self.second, into, second[order])
        self.place = np.insert(self.place, into, n + order)
        self.count += len(pieces)
        self.used += len(flat)

    def _add_lists(self, pieces: list[str], encoded: list[list[int]]) -> None:
        lengths = np.fromiter(map(len, encoded), np.int64, len(pieces))
        flat = np.fromiter((i for x in encoded for i in x), self.ids.dtype, int(lengths.sum()))
        self._add(pa.array(pieces, pa.string()), lengths, flat)

    def _find(self, pieces: pa.Array) -> np.ndarray:
        """Where each piece stands among the known ones, -1 if it doesn't."""
        first, second = string_hashes(pieces)
        if not self.count:
            return np.full(len(pieces), -1)
        order = np.argsort(first)
        at = np.empty(len(pieces), dtype=np.int64)
        at[order] = np.minimum(np.searchsorted(self.first, first[order]), self.count - 1)
        same = (self.first[at] == first) & (self.second[at] == second)
        return np.where(same, self.place[at], -1)

    def _gather(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of known pieces one after the other, and how many each has."""
        begin, length = self.starts[at], self.starts[at + 1] - self.starts[at]
        to = np.cumsum(length)
        places = np.repeat(begin - to + length, length) + np.arange(to[-1] if len(to) else 0)
        return self.ids[places], length

    def _learn(self, pieces: list[str]) -> None:
        """Add distinct pieces that aren't known."""
        split = [self._words(piece) for piece in pieces]
        other = [p for p, own in zip(pieces, split, strict=True) if own is None]
        plain = [(p, own) for p, own in zip(pieces, split, strict=True) if own is not None]
        words = pa.array([w for _, own in plain for w in own], pa.string()).dictionary_encode()
        new = words.dictionary.filter(pa.array(self._find(words.dictionary) < 0)).to_pylist()
        self._add_lists(new, [self._word_ids(w) for w in new])
        for low in range(0, len(other), 10_000):
            self._add_lists(other[low : low + 10_000], self._whole(other[low : low + 10_000]))
        at = self._find(words.dictionary)[words.indices.to_numpy()]
        counts = np.array([len(own) for _, own in plain], dtype=np.int64)
        # A piece that is one word is known by now.
        made = self._find(pa.array([p for p, _ in plain], pa.string())) < 0
        flat, lengths = self._gather(at[np.repeat(made, counts)])
        ends = np.concatenate([[0], np.cumsum(lengths)])[np.concatenate([[0], np.cumsum(counts[made])])]
        left = [p for (p, _), m in zip(plain, made, strict=True) if m]
        self._add(pa.array(left, pa.string()), np.diff(ends), flat)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and the offsets at which the texts' ids begin (one more than texts); null is empty."""
        if not len(texts):
            return self.ids[:0], np.zeros(1, dtype=np.int64)
        texts = pc.fill_null(texts, "")
        apart = pc.match_substring_regex(texts, UNSAFE) if self.spaced else None
        for content, normalized in self.added:
            held = pc.match_substring(texts, content, ignore_case=normalized and self.lowers)
            apart = held if apart is None else pc.or_(apart, held)
        whole = np.flatnonzero(apart.to_numpy(zero_copy_only=False)) if apart is not None else []
        cut = pc.if_else(apart, "", texts) if len(whole) else texts
        pieces = pc.split_pattern(cut, " ")
        flat = pieces.flatten()
        ends = np.cumsum(pc.list_value_length(pieces).to_numpy())
        heads = np.concatenate([[0], ends[:-1]])
        if self.spaced:
            # The first piece of a text has no space before it.
            first = np.zeros(len(flat), dtype=bool)
            first[heads] = True
            flat = pc.if_else(pa.array(first), flat, pc.binary_join_element_wise(" ", flat, ""))
        coded = flat.dictionary_encode()
        missing = self._find(coded.dictionary) < 0
        if self._held() + BYTES_PER_PIECE * int(missing.sum()) > MAX_KNOWN_BYTES:
            self._forget()
            missing[:] = True
        self._learn(coded.dictionary.filter(pa.array(missing)).to_pylist())
        at = self._find(coded.dictionary)[coded.indices.to_numpy()]
        ids, length = self._gather(at)
        offsets = np.concatenate([[0], np.cumsum(length)[ends - 1]])
        if not len(whole):
            return ids, offsets
        parts = np.split(ids, offsets[1:-1])
        for i, x in zip(whole.tolist(), self._whole([texts[i].as_py() for i in whole.tolist()]), strict=True):
            parts[i] = np.array(x, dtype=ids.dtype)
        return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder for a tokenizer file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path, added_as_text=False)
    return _encoders[path]


def with_end(ids: np.ndarray, offsets: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The same with the id ``end`` after each text."""
    n = len(offsets) - 1
    return np.insert(ids, offsets[1:], np.full(n, end, ids.dtype)), offsets + np.arange(n + 1)


def total_bytes(texts: pa.Array) -> int:
    offsets = text_offsets(texts)
    return int(offsets[-1] - offsets[0])
