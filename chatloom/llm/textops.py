"""Vectorized word and shingle hashes over Arrow text columns, for use inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text worked on at once; a longer text is worked on alone.
CHUNK_BYTES = 2 << 20
_P = np.uint64(0x9E3779B97F4A7C15)
_P_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Bytes between plain words: ASCII but its letters and digits.
_PLAIN = np.arange(256) < 0x80
_PLAIN[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = False


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Powers:
    """Powers of the hash base and of its inverse, grown on demand."""

    up = np.ones(1, dtype=np.uint64)
    down = np.ones(1, dtype=np.uint64)

    @classmethod
    def to(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            for name, base in (("up", _P), ("down", _P_INV)):
                a = np.full(n, base, dtype=np.uint64)
                a[0] = 1
                setattr(cls, name, np.multiply.accumulate(a))
        return cls.up[:n], cls.down[:n]


def chunks(batch: pa.RecordBatch, column: str, lower: bool = True) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of batch with the UTF-8 bytes of the column and each row's byte offsets (one more than rows); null counts as empty."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    start, n = 0, len(sizes)
    ends = np.cumsum(sizes)
    while start < n:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + CHUNK_BYTES, "right")))
        part = batch.slice(start, stop - start)
        text = pc.fill_null(part.column(column).cast(pa.large_string()), "")
        text = pc.utf8_lower(text) if lower else text
        text = text.combine_chunks() if isinstance(text, pa.ChunkedArray) else text
        offsets = np.frombuffer(text.buffers()[1], dtype=np.int64)[text.offset : text.offset + len(text) + 1]
        data = np.frombuffer(text.buffers()[2] or b"", dtype=np.uint8)[offsets[0] : offsets[-1]]
        yield part, data, offsets - offsets[0]
        start = stop


def word_spans(data: np.ndarray, offsets: np.ndarray, between: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first): byte spans of the words, and for each row the index of its first word (one more than rows)."""
    if not len(data):
        none = np.zeros(0, dtype=np.int64)
        return none, none, np.zeros(len(offsets), dtype=np.int64)
    space = between[data]
    cut = np.zeros(len(data) + 1, dtype=bool)
    cut[offsets] = True
    before = np.empty(len(data), dtype=bool)
    before[0] = True
    before[1:] = space[:-1]
    after = np.empty(len(data), dtype=bool)
    after[-1] = True
    after[:-1] = space[1:]
    starts = np.flatnonzero(~space & (before | cut[:-1]))
    ends = np.flatnonzero(~space & (after | cut[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets, "left")


def plain_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The bytes with A-Z lower-cased, and as word_spans the runs of letters, digits and characters beyond ASCII."""
    low = np.where((data >= 0x41) & (data <= 0x5A), data + np.uint8(0x20), data).astype(np.uint8)
    return low, *word_spans(low, offsets, _PLAIN)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans."""
    up, down = _Powers.to(len(data) + 1)
    sums = np.empty(len(data) + 1, dtype=np.uint64)
    sums[0] = 0
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def shingle_hashes(hashes: np.ndarray, first: np.ndarray, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each k-word shingle, offsets by row); a row of 1 to k - 1 words has one shingle of all of them."""
    counts = np.diff(first)
    n = np.where(counts >= k, counts - k + 1, (counts > 0).astype(np.int64))
    at = np.concatenate([[0], np.cumsum(n)]).astype(np.int64)
    out = np.zeros(at[-1], dtype=np.uint64)
    if not len(out):
        return out, at
    row = np.repeat(np.arange(len(counts)), n)
    pos = first[row] + np.arange(len(out)) - at[row]
    padded = np.concatenate([hashes, np.zeros(k, dtype=np.uint64)])
    for j in range(k):
        word = padded[pos + j]
        word = np.where(j < counts[row], word, np.uint64(0)) if (counts < k).any() else word
        out = mix(out * np.uint64(0xD6E8FEB86659FD93) + word + np.uint64(j + 1))
    return out, at
