"""Words of a batch of texts as numpy arrays over its UTF-8 bytes.

A word is a maximal run of kept bytes. Both word classes used here keep every byte
from 0x80 on, so a run of kept bytes is a run of kept characters. A-Z are lowered,
no other letter is.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of text taken at once; one longer text is taken alone.
BLOCK_BYTES = 8_000_000


def byte_table(digits: bool) -> np.ndarray:
    """By byte: 0 for a separator, else the byte in lower case. Letters and all
    bytes from 0x80 on are kept, ASCII digits if ``digits``."""
    table = np.zeros(256, np.uint8)
    table[0x80:] = np.arange(0x80, 0x100)
    for first in "Aa":
        table[ord(first) : ord(first) + 26] = np.arange(ord("a"), ord("z") + 1)
    if digits:
        table[ord("0") : ord("9") + 1] = np.arange(ord("0"), ord("9") + 1)
    return table


@dataclass
class Words:
    """``data`` holds the words' bytes without separators, word i from
    ``starts[i]`` to ``starts[i + 1]``; ``doc`` is each word's row of the block."""

    data: np.ndarray
    starts: np.ndarray
    doc: np.ndarray
    rows: int

    def __len__(self) -> int:
        return len(self.doc)

    def encoded(self) -> tuple[np.ndarray, pa.Array]:
        """Each word's number, and the distinct words by number."""
        offsets = pa.py_buffer(self.starts.astype(np.int64))
        column = pa.Array.from_buffers(pa.large_binary(), len(self), [None, offsets, pa.py_buffer(self.data)])
        coded = column.dictionary_encode()
        return coded.indices.to_numpy().astype(np.int64), coded.dictionary


def blocks(text: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets from 0) of consecutive rows
    with about ``limit`` bytes. NULL counts as empty."""
    full = text.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(full.buffers()[1], np.int64, len(full) + 1 + full.offset)[full.offset :] if len(full) else np.zeros(1, np.int64)
    values = full.buffers()[2] if len(full) else None
    data = np.frombuffer(values, np.uint8) if values is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(full):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        yield first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def words_of(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> Words:
    """The words of a block; none goes on into the next row."""
    lowered = table[data]
    kept = lowered != 0
    fresh = kept.copy()  # a kept byte after a separator or at a row's start
    fresh[1:] &= ~kept[:-1]
    heads = offsets[:-1][offsets[:-1] < len(data)]
    fresh[heads] = kept[heads]
    at = np.flatnonzero(fresh)
    before = np.cumsum(kept)  # kept bytes up to and with this one
    starts = np.append(before[at] - 1, before[-1] if len(before) else 0)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(np.searchsorted(at, offsets)))
    return Words(lowered[kept], starts, doc, len(offsets) - 1)
