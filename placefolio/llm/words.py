"""Words of many texts at once as numpy arrays: the texts stay in one byte buffer, words are 64-bit hashes."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_S = np.uint64(29)
BLANK = np.zeros(256, bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True


def mix(a: np.ndarray, b: np.ndarray | np.uint64, seed: int = 0) -> np.ndarray:
    """Ordered hash of two 64-bit arrays."""
    x = (a ^ (a >> _S)) * _M1 + np.asarray(b, np.uint64) * _M2 + np.uint64((seed * 0x632BE59BD9B4E019 + 1) % 2**64)
    x ^= x >> np.uint64(32)
    x *= _M1
    x ^= x >> _S
    return x


@dataclass
class Words:
    """Words of a slice of documents. ``first[d]`` is the number of the first word of document ``d``."""

    buffer: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def document(self) -> np.ndarray:
        """Number of the document of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def hashes(self) -> np.ndarray:
        """64-bit hash of each word, eight bytes at a time."""
        padded = np.concatenate([self.buffer, np.zeros(8, np.uint8)])
        eight = np.ndarray(len(padded) - 7, np.uint64, padded, strides=(1,))
        length = (self.end - self.start).astype(np.int64)
        out = length.astype(np.uint64) * _M2
        live, at = np.arange(len(length)), self.start.astype(np.int64)
        left = length
        while len(live):
            part = eight[at]
            bits = (np.minimum(left, 8) * 8).astype(np.uint64)
            part = np.where(bits == 64, part, part & ((np.uint64(1) << (bits % np.uint64(64))) - np.uint64(1)))
            out[live] = mix(out[live], part)
            more = left > 8
            live, at, left = live[more], at[more] + 8, left[more] - 8
        return out


def words(texts: pa.Array, lower: bool = False) -> Words:
    """Words of each text; null texts have none. ``lower`` lower-cases A-Z."""
    texts = texts.cast(pa.large_binary()) if not pa.types.is_large_binary(texts.type) else texts
    texts = texts.fill_null(b"")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    if lower:
        raw = raw + ((raw >= 65) & (raw <= 90)).astype(np.uint8) * np.uint8(32)
    inside = ~BLANK[raw]
    # A word also ends where its document ends.
    before = np.concatenate([[False], inside[:-1]]) if len(inside) else inside
    starts_doc = np.zeros(len(inside) + 1, bool)
    starts_doc[offsets] = True
    start = np.flatnonzero(inside & (~before | starts_doc[:-1]))
    after = np.concatenate([inside[1:], [False]]) if len(inside) else inside
    end = np.flatnonzero(inside & (~after | starts_doc[1:])) + 1
    return Words(raw, start, end, np.searchsorted(start, offsets))


def slices(batch: pa.RecordBatch | pa.Table, text: str, most_bytes: int) -> Iterator[pa.Table]:
    """The rows in slices of at most ``most_bytes`` of text (or one longer text), so memory stays bounded."""
    whole = pa.Table.from_batches([batch]) if isinstance(batch, pa.RecordBatch) else batch
    import pyarrow.compute as pc
    size = np.cumsum(pc.fill_null(pc.binary_length(whole[text]), 0).to_numpy().astype(np.int64))
    low = 0
    while low < whole.num_rows:
        done = size[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(size, done + most_bytes, "right")))
        yield whole.slice(low, high - low)
        low = high


def one_array(column: pa.ChunkedArray | pa.Array) -> pa.Array:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def windows(hashes: np.ndarray, length: int, seed: int = 0) -> np.ndarray:
    """Hash of the ``length`` words from each word on, built by doubling. The last ``length - 1`` are not valid."""
    done, out = 1, hashes if not seed else mix(hashes, np.uint64(seed))
    while done < length:
        step = min(done, length - done)
        shifted = np.concatenate([out[step:], np.zeros(min(step, len(out)), np.uint64)])
        out = mix(out, shifted, seed + done)
        done += step
    return out


def inside_document(w: Words, length: int) -> np.ndarray:
    """Whether the ``length`` words from each word on lie in its document."""
    last = np.repeat(w.first[1:], w.counts)
    return np.arange(len(w.start)) + length <= last


def sketch_hash(values: np.ndarray) -> np.ndarray:
    return mix(values, np.uint64(0x2545F4914F6CDD1D), 7)
