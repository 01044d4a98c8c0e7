"""Words of a block of texts, cut on their UTF-8 bytes, as a dictionary and codes."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from tidemark.llm.common import ship, span_hash

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def byte_set(characters: str) -> np.ndarray:
    """Which bytes are one of these ASCII characters."""
    out = np.zeros(256, bool)
    out[list(characters.encode("ascii"))] = True
    return out


@dataclass
class WordBlock:
    """Words of all texts in order, A-Z in lower case.

    ``words`` holds each different word once, ``codes`` the place of every occurrence in it, ``text`` and ``piece`` the
    text and the piece that an occurrence is in; pieces are numbered over the block, and none spans two texts.
    """

    words: pa.StringArray
    codes: np.ndarray
    text: np.ndarray
    piece: np.ndarray


def word_block(texts: pa.Array | pa.ChunkedArray, spaces: np.ndarray, ends: np.ndarray | None = None) -> WordBlock:
    """Cut texts at the bytes of ``spaces`` into words, and at those of ``ends`` into pieces too. Null is empty."""
    texts = texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.chunk(0) if texts.num_chunks else pa.array([], pa.string())
    texts = texts.cast(pa.string()).fill_null("")
    _, at, held = texts.buffers()
    offsets = np.frombuffer(at, np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64) if at else np.zeros(1, np.int64)
    data = np.frombuffer(held, np.uint8)[offsets[0]:offsets[-1]] if held is not None else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    gap = spaces[data] if ends is None else (spaces | ends)[data]
    starts_text = np.zeros(len(data) + 1, bool)
    starts_text[offsets] = True
    starts_text = starts_text[:-1]
    begin = ~gap
    begin[1:] &= gap[:-1] | starts_text[1:]
    first = np.flatnonzero(begin)
    # Without the gaps, words stand one behind the other, as Arrow keeps strings.
    place = np.cumsum(~gap)
    total = int(place[-1]) if len(place) else 0
    bounds = np.concatenate([place[first] - 1, [total]]).astype(np.int32)
    packed = np.ascontiguousarray(_LOWER[data[~gap]])
    words = pa.StringArray.from_buffers(len(first), pa.py_buffer(bounds.tobytes()), pa.py_buffer(packed.tobytes()))
    coded = words.dictionary_encode()
    text = np.searchsorted(offsets, first, side="right") - 1
    if ends is None:
        piece = text
    else:
        piece = np.cumsum(ends[data] | starts_text)[first]
    return WordBlock(coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), text, piece)


def word_hashes(words: pa.Array) -> np.ndarray:
    """A 64-bit hash for each string, the same in every task."""
    words = words.cast(pa.string())
    _, at, held = words.buffers()
    if not len(words):
        return np.zeros(0, np.uint64)
    offsets = np.frombuffer(at, np.int32)[words.offset:words.offset + len(words) + 1].astype(np.int64)
    data = np.frombuffer(held, np.uint8)[offsets[0]:offsets[-1]] if held is not None else np.zeros(0, np.uint8)
    return span_hash(data, offsets[:-1] - offsets[0], offsets[1:] - offsets[0])


ship(__name__)
