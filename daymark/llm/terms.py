"""Words of Arrow text columns as dictionary codes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from daymark.llm.text import LOWER, find_words, text_offsets


def text_bytes(texts: pa.Array) -> np.ndarray:
    """The UTF-8 bytes of all texts, one after the other."""
    offsets = text_offsets(texts)
    if offsets[-1] == offsets[0]:
        return np.zeros(0, dtype=np.uint8)
    return np.frombuffer(texts.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]]


def encoded_words(
    texts: pa.Array, kept: np.ndarray, lower: bool = False
) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """(codes, words, first): text ``d`` has the words ``words[codes[first[d]:first[d + 1]]]``.

    Words are maximal runs of the bytes that ``kept`` marks; ``lower`` turns
    A-Z to a-z. Codes number the distinct words of these texts.
    """
    words = find_words(texts, kept)
    lengths = words.ends - words.starts
    offsets = np.zeros(len(words) + 1, dtype=np.int32)
    np.cumsum(lengths, out=offsets[1:])
    data = words.data[kept[words.data]]
    if lower:
        data = LOWER[data]
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))]
    coded = pa.Array.from_buffers(pa.binary(), len(words), buffers).dictionary_encode()
    return coded.indices.to_numpy().astype(np.int64), coded.dictionary, words.first
