"""Word and byte hashes of whole Arrow batches in numpy, a chunk of documents at a time."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_U = np.uint64
#: An odd multiplier and its inverse modulo 2 ** 64.
_M = _U(0x9E3779B97F4A7C15)
_M_INVERSE = _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


BYTE_VALUES = mix(np.arange(1, 257, dtype=_U) * _M)


def chunks(batch: pa.RecordBatch, column: int, most: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """First row, bytes and row offsets of runs of rows with about ``most`` bytes (a long text is whole)."""
    texts = batch.column(column)
    kind = np.int64 if pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type) else np.int32
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(ends, ends[first] + most, "right")) - 1)
        yield first, raw[ends[first] : ends[last]], ends[first : last + 1] - ends[first]
        first = last


def word_hashes(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Document and 64-bit hash of every run of other bytes than ASCII white space, in order."""
    if not len(raw):
        return np.zeros(0, np.int64), np.zeros(0, _U)
    word = ~SPACE[raw]
    before = np.empty(len(raw) + 1, bool)
    before[0], before[1:] = False, word
    cut = np.zeros(len(raw) + 1, bool)
    cut[offsets] = True
    starts = np.flatnonzero(word & (~before[:-1] | cut[:-1]))
    after = np.append(word[1:], False)
    ends = np.flatnonzero(word & (~after | cut[1:])) + 1
    powers = np.full(len(raw), _M)
    powers[0] = 1
    np.cumprod(powers, out=powers)
    sums = np.zeros(len(raw) + 1, _U)
    np.cumsum(BYTE_VALUES[raw] * powers, out=sums[1:])
    back = np.full(len(raw), _M_INVERSE)
    back[0] = 1
    np.cumprod(back, out=back)
    hashes = mix((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(_U))
    return np.searchsorted(offsets, starts, "right") - 1, hashes


def shingle_hashes(doc: np.ndarray, words: np.ndarray, n_docs: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Document and hash of every ``width`` words in a row; a shorter text is one shingle of all its words."""
    counts = np.bincount(doc, minlength=n_docs)
    first = np.concatenate([[0], np.cumsum(counts)])[:-1]
    place = np.arange(len(doc)) - first[doc]
    size = np.minimum(counts, width)[doc]
    begin = np.flatnonzero(place + size <= counts[doc])
    begin = begin[(counts[doc[begin]] >= width) | (place[begin] == 0)]
    total = np.zeros(len(begin), _U)
    for j in range(width):
        here = j < size[begin]
        at = np.minimum(begin + j, max(len(words) - 1, 0))
        total = total * _U(0xD6E8FEB86659FD93) + np.where(here, words[at] if len(words) else 0, 0).astype(_U)
        total = mix(total + _U(j + 1))
    return doc[begin], total
