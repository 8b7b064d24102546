"""Words of Arrow batches of texts, found and numbered without a Python loop over words.

A batch of texts is one byte buffer. Separator bytes are looked up in a table of 256 entries, the
borders of words follow from it, and Arrow numbers the different words of the batch. Work on a word
is then done once per different word, and what a document needs is gathered by number. Texts are
UTF-8, so a table that holds ASCII separators only never cuts a character.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at once in a task; a longer single text is a slice of its own.
SLICE_BYTES = 4 << 20

#: White space, as the bytes 0x20 and 0x09 to 0x0D.
SPACES = bytes([0x20, *range(0x09, 0x0E)])
#: Every ASCII byte that is neither a digit nor a lower-case letter (after lower-casing).
NOT_WORD = bytes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def separator_table(separators: bytes) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[list(separators)] = True
    return table


@dataclass
class Words:
    """The words of a slice: ``codes`` number them, document ``i`` has those from ``bounds[i]`` to ``bounds[i + 1]``."""

    codes: np.ndarray
    unique: pa.Array
    bounds: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    offsets: np.ndarray
    data_as_given: np.ndarray

    def count(self) -> np.ndarray:
        return np.diff(self.bounds)


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``limit`` bytes of text each."""
    if batch.num_rows == 0:
        return
    length = pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(length, dtype=np.int64) // limit
    cuts = np.flatnonzero(np.diff(part)) + 1
    for start, end in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
        yield batch.slice(start, end - start)


def buffer_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts in one array, and where each begins and the last one ends; null is empty."""
    texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if texts.buffers()[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    data = np.frombuffer(texts.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]] if len(texts) else np.zeros(0, np.uint8)
    return data, offsets - (offsets[0] if len(offsets) else 0)


def words_of(texts: pa.Array, separators: np.ndarray, lower: bool = False) -> Words:
    """Cut every text at its separator bytes and number the different words."""
    given, offsets = buffer_of(texts)
    data = _LOWER[given] if lower else given
    inside = ~separators[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    begins = offsets[:-1][offsets[:-1] < len(data)]
    first[begins] |= inside[begins]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    tails = offsets[1:][offsets[1:] > 0] - 1
    last[tails] |= inside[tails]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    lengths = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    array = pa.Array.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(lengths), pa.py_buffer(np.ascontiguousarray(data[inside]))])
    coded = array.dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False) if len(starts) else np.zeros(0, np.int32)
    return Words(codes, coded.dictionary, np.searchsorted(starts, offsets), starts, ends, offsets, given)
