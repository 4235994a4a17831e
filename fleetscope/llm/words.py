"""Words of whole texts as 64-bit hashes, for many documents at a time and in bounded memory.

A word is a maximal run of word bytes of the UTF-8 text; A-Z count as a-z. The hash of a word is a
polynomial over its bytes, read from running sums, so that a batch costs a few passes over its bytes
and no Python step per word.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash

BLOCK_BYTES = 1 << 20
LONG_WORD = 256
#: Bytes of text that one Arrow batch should hold, and the setting for it.
BATCH_BYTES = 4 << 20

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: a bijection on 64-bit values that spreads every input bit."""
    x = x.astype(_U, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE_VALUE = mix(np.arange(1, 257, dtype=_U) * _U(_BASE))[_LOWER]

#: Word bytes of `[^\x20\x09-\x0D]+`.
SPACED = np.ones(256, dtype=bool)
SPACED[[9, 10, 11, 12, 13, 32]] = False
#: Word bytes of `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` after A-Z became a-z.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[128:] = ALNUM[48:58] = ALNUM[97:123] = ALNUM[65:91] = True


def _powers(base: int) -> np.ndarray:
    out = np.full(BLOCK_BYTES + LONG_WORD + 1, base, dtype=_U)
    out[0] = 1
    return np.cumprod(out, dtype=_U)


_POWERS: list[np.ndarray] = []


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts one after another, and where each begins (one more than texts). Null: empty."""
    texts = pa.array(texts).cast(pa.large_binary()) if not isinstance(texts, pa.Array) else texts.cast(pa.large_binary())
    texts = texts.fill_null(b"") if texts.null_count else texts
    _, offsets, data = texts.buffers()
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    bounds = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[bounds[0] : bounds[-1]], bounds - bounds[0]


@dataclass
class Words:
    """Words of a batch: one entry per word, and per document where its words begin."""

    starts: np.ndarray  # first byte, in the batch's bytes
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray  # index of each document's first word, one more than documents

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def documents(self) -> np.ndarray:
        """The document's index of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def _hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    if not _POWERS:
        _POWERS.extend((_powers(_BASE), _powers(_INVERSE)))
    up, down = _POWERS
    out = np.zeros(len(starts), dtype=_U)
    at = 0
    while at < len(starts):
        base = starts[at]
        stop = max(at + 1, int(np.searchsorted(starts, base + BLOCK_BYTES)))
        s, e = starts[at:stop] - base, ends[at:stop] - base
        e = np.minimum(e, s + LONG_WORD)
        block = _BYTE_VALUE[data[base : base + e[-1]]]
        block *= up[: len(block)]
        sums = np.concatenate((np.zeros(1, _U), np.cumsum(block, dtype=_U)))
        out[at:stop] = (sums[e] - sums[s]) * down[s]
        at = stop
    for i in np.flatnonzero(ends - starts > LONG_WORD):
        word = _LOWER[data[starts[i] : ends[i]]]
        out[i] = xxhash.xxh3_64_intdigest(word.tobytes())
    return mix(out)


def words(texts: pa.Array, kind: np.ndarray = SPACED) -> Words:
    """Words of every whole text of an Arrow string or binary array."""
    data, bounds = text_bytes(texts)
    inside = kind[data]
    begins, closes = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    edges = bounds[(bounds > 0) & (bounds < len(data))]
    begins[edges] = inside[edges]
    closes[edges - 1] = inside[edges - 1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(closes) + 1
    return Words(starts, ends, _hash(data, starts, ends), np.searchsorted(starts, bounds))


def shingles(found: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all k words in a row within a document, and where each document's begin.

    A document with fewer than k words, but with words, has one: all its words.
    """
    n = found.counts
    firsts = found.first
    kept = np.where(n >= k, n - k + 1, (n > 0).astype(np.int64))
    bounds = np.concatenate((np.zeros(1, np.int64), np.cumsum(kept)))
    at = np.repeat(firsts[:-1] - bounds[:-1], kept) + np.arange(bounds[-1])
    size = np.repeat(np.minimum(n, k), kept)
    out = np.zeros(len(at), dtype=_U)
    for j in range(k):
        there = size > j
        step = found.hashes[np.minimum(at + j, max(len(found.hashes) - 1, 0))] if len(at) else out
        out = np.where(there, (out * _U(_BASE)) + mix(step + _U(j + 1)), out)
    return mix(out + size.astype(_U)), bounds


def use_batches(spark) -> None:
    """Let Arrow batches follow the size of the texts, so that workers need little memory."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")


def slices(batch: pa.RecordBatch, column: str, limit: int = BATCH_BYTES):
    """Parts of a batch of about ``limit`` bytes of text each, but never less than a row."""
    at, size = 0, 0
    lengths = np.diff(text_bytes(batch.column(column))[1])
    for i, n in enumerate(lengths):
        if i > at and size + n > limit:
            yield batch.slice(at, i - at)
            at, size = i, 0
        size += int(n)
    if at < batch.num_rows:
        yield batch.slice(at)


def list_of(values: np.ndarray, bounds: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """An Arrow list column from flat values and where each row's begin."""
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values, kind))
