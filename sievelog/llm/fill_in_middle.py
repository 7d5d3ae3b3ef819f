"""Fill-in-the-middle: a text cut in three, its middle moved to the end.

The bytes of a run of documents become a sequence of character classes, kept as a wavelet
matrix: one bit vector a level with counts of ones before every 64 bits. The rank of a
class before a place takes a few look-ups; ranks of several classes add up to the number
of units (code points, words or lines) before it, and both cuts of every document are
found by bisection on these counts.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievelog.llm.common import whole
from sievelog.llm.text_arrays import SPACE, chunks

#: What stands before prefix, suffix and middle.
MARKERS = ("<P>", "<S>", "<M>")
#: Classes of bytes: continues a character, white space, line end, in a word, begins a word.
CONTINUES, BLANK, NEWLINE, INSIDE, BEGINS = range(5)
BITS = 3
#: The classes that make a unit, and whether they stand at its beginning or its end.
UNITS = {"char": ((BLANK, NEWLINE, INSIDE, BEGINS), "begin"), "word": ((BEGINS,), "begin"), "line": ((NEWLINE,), "end")}
#: Bytes that are worked on together; a longer text stands alone, at about 12 bytes a byte.
CHUNK = 1 << 20

_OUT = "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"


def classes(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The class of every byte of texts that lie one after another."""
    space = SPACE[raw]
    free = np.empty(len(raw), bool)
    free[1:] = space[:-1]
    free[offsets[:-1][offsets[:-1] < len(raw)]] = True
    out = np.where(free, np.uint8(BEGINS), np.uint8(INSIDE))
    out[(raw & 0xC0) == 0x80] = CONTINUES
    out[space] = BLANK
    out[raw == 10] = NEWLINE
    return out


class WaveletMatrix:
    """Ranks of small numbers, for many places at once."""

    def __init__(self, symbols: np.ndarray, bits: int = BITS):
        self.n, self.levels = len(symbols), []
        for bit in reversed(range(bits)):
            one = (symbols >> bit & 1).astype(bool)
            packed = np.packbits(one, bitorder="little")
            words = np.zeros(self.n // 64 + 1, np.uint64)
            words.view(np.uint8)[: len(packed)] = packed
            before = np.zeros(len(words) + 1, np.int64)
            np.cumsum(np.bitwise_count(words), out=before[1:])
            self.levels.append((bit, words, before, self.n - int(before[-1])))
            symbols = np.concatenate([symbols[~one], symbols[one]])

    def rank(self, symbol: int, at: np.ndarray) -> np.ndarray:
        """How often ``symbol`` stands before each place."""
        low, high = np.zeros(1, np.int64), np.asarray(at, np.int64)
        for bit, words, before, zeros in self.levels:
            low, high = (self._ones(words, before, x) for x in (low, high)) if symbol >> bit & 1 else (
                x - self._ones(words, before, x) for x in (low, high)
            )
            if symbol >> bit & 1:
                low, high = low + zeros, high + zeros
        return high - low

    @staticmethod
    def _ones(words, before, at):
        rest = words[at >> 6] & ((np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1))
        return before[at >> 6] + np.bitwise_count(rest)

    def count(self, kinds: tuple[int, ...], at: np.ndarray) -> np.ndarray:
        """How many symbols of ``kinds`` stand before each place: ranks, added up."""
        others = [c for c in range(BEGINS + 1) if c not in kinds]
        if len(others) < len(kinds):
            return at - sum(self.rank(c, at) for c in others)
        return sum(self.rank(c, at) for c in kinds)


class Units:
    """Units of texts that lie one after another, and the places after so many of them."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, unit: str):
        self.kinds, self.side = UNITS[unit]
        self.matrix = WaveletMatrix(classes(raw, offsets))
        self.first, self.last = offsets[:-1], offsets[1:]
        self.before = self.matrix.count(self.kinds, self.first)
        self.n = self.matrix.count(self.kinds, self.last) - self.before
        if self.side == "end" and len(raw):  # a last line without an end
            self.n = self.n + ((self.last > self.first) & (raw[np.maximum(self.last - 1, 0)] != 10))

    def place_after(self, k: np.ndarray) -> np.ndarray:
        """Byte place behind the first ``k`` units of each text, by bisection on the counts."""
        want = self.before + k + (self.side == "begin")
        low, high = self.first.copy(), self.last + 1  # the least place with ``want`` before it
        while (open_ := low < high).any():
            mid = (low + high) >> 1
            enough = self.matrix.count(self.kinds, np.minimum(mid, self.last)) >= want
            enough |= mid > self.last
            low, high = np.where(open_ & ~enough, mid + 1, low), np.where(open_ & enough, mid, high)
        place = low - (self.side == "begin")
        return np.where(k >= self.n, self.last, np.clip(place, self.first, self.last))

    def chars(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Code points between two places."""
        whole_ = UNITS["char"][0]
        return self.matrix.count(whole_, end) - self.matrix.count(whole_, start)


def draws(doc_id: Column, seed: str = "1") -> list[Column]:
    """Four numbers of a document: groups of eight hexadecimal digits of a SHA-256."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)]


def _check(markers: tuple[str, ...], unit: str) -> None:
    if unit not in UNITS:
        raise ValueError(f"unit must be one of {sorted(UNITS)}")
    tails = {m[i:] for m in markers for i in range(1, len(m))}
    if len(set(markers)) < 3 or not all(markers) or any(m.startswith(t) for m in markers for t in tails):
        raise ValueError("the three markers must differ and not overlap, or texts could not be told apart again")


def strings(parts: list[bytes], null: list[bool] | None = None) -> pa.Array:
    """UTF-8 bytes as a string column, unchecked as they came."""
    offsets = np.zeros(len(parts) + 1, np.int64)
    np.cumsum([len(p) for p in parts], out=offsets[1:])
    if offsets[-1] >= 1 << 31:
        raise ValueError("the texts of one batch exceed 2 GB")
    return pa.StringArray.from_buffers(len(parts), pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(b"".join(parts)))


def fill_in_middle(docs: DataFrame, id_col="doc_id", text_col="text", unit="char", fim_percent=90, spm_percent=20,
                   seed="1", markers=MARKERS) -> DataFrame:
    """A row per row of ``docs``: doc_id, n, form, prefix_chars, middle_chars, output.

    ``n`` counts the units of the text: code points (``char``), words, which white space
    ends, or lines; what stands before the first unit belongs to the prefix. The prefix
    ends after the smaller of two drawn numbers of units, the middle after the larger. A
    text that is empty, holds a marker, or is drawn to stay whole has form ``plain`` and no
    cuts; the others are ``psm`` (prefix, suffix, middle) or ``spm``. The draws hang on seed
    and id alone: rows that repeat an id are cut by the same numbers, and reruns agree. Null
    text counts as empty, a null id is drawn as an empty one. Empty in, empty out; other
    columns of ``docs``, whatever their names, are not read. Texts may be of any length that
    fits a row.
    """
    _check(markers, unit)
    marks = [m.encode() for m in markers]
    pre, suf, mid = marks

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, raw, offsets in chunks(batch, 1, CHUNK):
                rows = len(offsets) - 1
                h1, h2, h3, h4 = (np.asarray(batch.column(2 + i).slice(first, rows)) for i in range(4))
                units = Units(raw, offsets, unit)
                a, b = np.sort([h1 % (units.n + 1), h2 % (units.n + 1)], axis=0)
                cuts = [units.first, units.place_after(a), units.place_after(b), units.last]
                n_prefix, n_middle = (units.chars(cuts[i], cuts[i + 1]).tolist() for i in range(2))
                data, forms, outs = raw.tobytes(), [], []
                for i, (s, x, y, e) in enumerate(zip(*(c.tolist() for c in cuts), strict=True)):
                    text = data[s:e]
                    if not text or h3[i] % 100 >= fim_percent or any(m in text for m in marks):
                        forms.append("plain")
                        outs.append(text)
                        n_prefix[i] = n_middle[i] = None
                    elif h4[i] % 100 < spm_percent:
                        forms.append("spm")
                        outs.append(b"".join((suf, data[y:e], pre, data[s:x], mid, data[x:y])))
                    else:
                        forms.append("psm")
                        outs.append(b"".join((pre, data[s:x], suf, data[y:e], mid, data[x:y])))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, rows), pa.array(units.n, pa.int64()), pa.array(forms),
                     pa.array(n_prefix, pa.int64()), pa.array(n_middle, pa.int64()), strings(outs)],
                    names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
                )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole(text_col).alias("text"), *draws(F.col(id_col), seed))
    return rows.mapInArrow(run, _OUT)


def restored_text(output: Column, form: Column, markers=MARKERS) -> Column:
    """The text again, from output and form; a null output gives null.

    A marker stands nowhere in the text, so each is found at its only place.
    """
    pre, suf, mid = markers

    def after(text, mark):
        return F.substr(text, F.locate(mark, text) + F.lit(len(mark)))

    def until(text, mark):
        return F.substr(text, F.lit(1), F.locate(mark, text) - F.lit(1))

    middle = after(output, mid)
    psm = F.concat(until(after(output, pre), suf), middle, until(after(output, suf), mid))
    spm = F.concat(until(after(output, pre), mid), middle, until(after(output, suf), pre))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
