"""Words of many texts at once as 64-bit hashes. A word is a run without ASCII white space."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"


def mixed(x: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of the 64-bit value."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(texts: list[str], lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts in order, and where each text's words begin (one more entry than texts).

    `lower` folds A-Z.
    """
    parts = [t.encode() for t in texts]
    data = b" ".join(parts) + b" " + bytes(8)
    if lower:
        data = data.lower()
    raw = np.frombuffer(data, np.uint8)[:-8]
    is_space = np.zeros(256, bool)
    is_space[list(SPACES)] = True
    space = is_space[raw]
    before = np.concatenate([[True], space[:-1]])
    starts = np.flatnonzero(~space & before)
    lengths = np.flatnonzero(space & ~before) - starts
    offsets = np.cumsum([0] + [len(p) + 1 for p in parts])
    eights = np.ndarray(len(raw) + 1, "<u8", data, strides=(1,))  # the eight bytes from each position on
    keep = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
    h = mixed(lengths.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    left, at = np.arange(len(starts)), 0
    while len(left):
        rest = lengths[left] - at
        h[left] = mixed(h[left] ^ (eights[starts[left] + at] & keep[np.minimum(rest, 8)]))
        left, at = left[rest > 8], at + 8
    return h, np.searchsorted(starts, offsets)


def shingles(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the runs of n words of one text; of the whole sequence, if it is shorter; none without words."""
    width = min(n, len(words))
    if not width:
        return words
    count = len(words) - width + 1
    out = words[:count]
    for k in range(1, width):
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + words[k:k + count])
    return out if width == n else mixed(out ^ np.uint64(width))


def runs(batches: Iterator[pa.RecordBatch], column: int, most: int) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of batches of about `most` characters with their texts, null as empty; a longer text is alone."""
    for batch in batches:
        texts = [t or "" for t in batch.column(column).to_pylist()]
        start = held = 0
        for i, t in enumerate(texts):
            held += len(t)
            if held >= most or i + 1 == len(texts):
                yield batch.slice(start, i + 1 - start), texts[start:i + 1]
                start, held = i + 1, 0
