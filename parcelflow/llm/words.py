"""Words of byte columns: stretches without the six ASCII white space characters, as columns."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from parcelflow.llm.common import byte_column

_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def split(texts: pa.Array, lower: bool = False) -> tuple[pa.Array, np.ndarray]:
    """(words, offsets of each row's words) of a string or binary column; null counts as empty. lower maps A-Z only."""
    data, offsets = byte_column(texts)
    solid = ~_WHITE[data]
    before = np.zeros(len(data), bool)
    before[1:] = solid[:-1]
    before[offsets[:-1][offsets[:-1] < len(data)]] = False
    first = solid & ~before
    kept = data[solid]
    starts = np.flatnonzero(first[solid])
    counted = np.searchsorted(np.flatnonzero(first), offsets)  # words that begin before each row
    ends = np.append(starts, len(kept)).astype(np.int64)
    if lower:
        kept = _LOWER[kept]
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(kept))])
    return words, counted


def numbered(words: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """(number of each word, distinct words): equal words have equal numbers."""
    coded = words.dictionary_encode()
    return coded.indices.to_numpy().astype(np.int64), coded.dictionary


def gathered(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Places of all members of stretches, one stretch after another."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - ends + lengths, lengths) + np.arange(ends[-1] if len(ends) else 0)
