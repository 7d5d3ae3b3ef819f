"""Byte-level BPE encoding and decoding with the vocabulary of a public tokenizer.

A text is parted at the tokenizer's special strings, then into words by its pattern. The
bytes of a word are symbols in a doubly linked list; a priority queue holds the merge ranks
of neighbours, lowest rank first, then leftmost. An entry whose pair is no longer there is
stale and skipped. Words met before are remembered. Decoding puts the byte strings of the
vocabulary one after another.
"""

import json
import re
import unicodedata
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from heapq import heapify, heappop, heappush
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievelog.llm.common import whole

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"
#: Words a worker remembers, and the longest word it remembers, in characters.
REMEMBERED = 500_000
REMEMBERED_CHARS = 48
#: Texts beyond so many characters are parted into words piece by piece.
LONG_TEXT = 1 << 20
WORDS_AT_ONCE = 1 << 16
#: Rows that are turned into one Arrow batch.
ROWS = 256

#: Fixed value: the pattern of the tokenizer, with the sets of letters and numbers left open.
_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?{letter}+| ?{number}+| ?[^\s{other}]+|\s+(?!\S)|\s+"
#: The same for texts of common letters, as the standard library's pattern language has it: there numbers that are
#: no digits count as letters and some control characters as white space, which are left to the pattern above.
_COMMON = re.compile(r"'(?:[stmd]|re|ve|ll)| ?[^\W\d_]++| ?[0-9]++| ?(?:[^\s\w]|_)++|\s+(?!\S)|\s+")
_UNCOMMON = re.compile("[\x1c-\x1f\xb2\xb3\xb9\xbc-\xbe\u0250-\U0010ffff]")

@dataclass(frozen=True)
class Vocabulary:
    """The tokenizer file, and the characters which the library takes for no letter or number.

    Those are letters and numbers of a newer Unicode than the library's own.
    """

    data: bytes
    newer: str = ""


def load_vocabulary(spark: SparkSession, path: str = VOCABULARY) -> Vocabulary:
    """Read on the driver, where the path is a parameter of the job; the vocabulary travels with the tasks."""
    with open(path, "rb") as f:
        return Vocabulary(f.read(), newer_characters())


@lru_cache(maxsize=1)
def newer_characters() -> str:
    """Letters and numbers of Python's tables that the library's own pre-tokenizer parts from others of their kind."""
    from tokenizers.pre_tokenizers import ByteLevel

    ask = ByteLevel(add_prefix_space=False, use_regex=True).pre_tokenize_str
    every, found = "".join(map(chr, [*range(128, 0xD800), *range(0xE000, 0x110000)])), []
    for kind, chars in (("a", regex.findall(r"\p{L}", every)), ("1", regex.findall(r"\p{N}", every))):
        for at in range(0, len(chars), 1000):
            some = chars[at : at + 1000]
            # A piece that starts at the character itself parts it from the one before.
            starts = {a for _, (a, _) in ask(" ".join(kind + c for c in some))}
            found += [c for i, c in enumerate(some) if 3 * i + 1 in starts]
    return "".join(sorted(found))


def _ranges(chars: str) -> str:
    """A set of characters as ranges for a pattern."""
    out, start, last = [], None, None
    for c in [*map(ord, sorted(chars)), None]:
        if last is not None and c == last + 1:
            last = c
            continue
        if start is not None:
            out.append(f"\\U{start:08X}-\\U{last:08X}")
        start = last = c
    return "".join(out)


def byte_letters() -> dict[int, str]:
    """The printable character that stands for each byte in the vocabulary.

    Bytes that print in Latin-1 stand for themselves, the others, in order, for the
    characters from U+0100 on.
    """
    own = [b for b in range(256) if unicodedata.category(chr(b)) not in ("Cc", "Cf", "Zs")]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


class _Paths(dict):
    """Ids of a word as bytes of 32-bit numbers, worked out where they are asked for first."""

    def __init__(self, encode):
        super().__init__()
        self.encode, self.older = encode, {}

    def __missing__(self, word: str) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            ids = array("i", self.encode(word.encode())).tobytes()
        if len(word) <= REMEMBERED_CHARS:
            if len(self) >= REMEMBERED // 2:  # words not asked for since the last turn go
                self.older = dict(self)
                self.clear()
            self[word] = ids
        return ids


class Codec:
    """Encoder and decoder of one vocabulary."""

    def __init__(self, vocabulary: Vocabulary):
        spec = json.loads(vocabulary.data)
        model, pre = spec["model"], spec["pre_tokenizer"]
        plain = pre["type"] == "ByteLevel" and pre["use_regex"] and not pre["add_prefix_space"] and not spec["normalizer"]
        if model["type"] != "BPE" or not plain or model.get("ignore_merges") or model.get("byte_fallback"):
            raise ValueError("not a byte-level BPE vocabulary of the kind this codec follows")
        letter = byte_letters()
        byte = {c: b for b, c in letter.items()}
        self.special = {a["content"]: a["id"] for a in spec["added_tokens"]}
        if any(a["lstrip"] or a["rstrip"] or a["single_word"] for a in spec["added_tokens"]):
            raise ValueError("special strings that reach beyond themselves are not supported")
        ids = model["vocab"]
        self.raw = [b""] * (1 + max([*ids.values(), *self.special.values()]))
        for text, i in (ids | self.special).items():
            self.raw[i] = bytes(byte[c] for c in text) if all(c in byte for c in text) else text.encode()
        self.start = [ids[letter[b]] for b in range(256)]
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        #: For each id, asks for the rank of its pair with the id on its right; what each rank makes.
        near, self.made = {}, []
        for rank, (a, b) in enumerate(pairs):
            near.setdefault(ids[a], {})[ids[b]] = rank
            self.made.append(ids[a + b])
        none = {}.get
        self.rank_after = [near[i].get if i in near else none for i in range(len(self.raw))]
        longest = sorted(self.special, key=len, reverse=True)
        self.parted = re.compile("(" + "|".join(map(re.escape, longest)) + ")") if longest else None
        self.words = regex.compile(_WORDS.format(letter=r"\p{L}", number=r"\p{N}", other=r"\p{L}\p{N}"))
        self.newer = re.compile(f"[{_ranges(vocabulary.newer)}]") if vocabulary.newer else None
        if self.newer:
            new = _ranges(vocabulary.newer)
            letters, numbers = (rf"[\p{{{k}}}--[{new}]]" for k in "LN")
            other = rf"(?: ?[[^\s\p{{L}}\p{{N}}]||[{new}]]+)"
            exact = _WORDS.format(letter=letters, number=numbers, other="@").replace(r" ?[^\s@]+", other)
            self.exact_words = regex.compile(exact, regex.V1)
        self.paths = _Paths(self.merge)

    def merge(self, word: bytes) -> list[int]:
        """The ids of one word."""
        start, after_id, made = self.start, self.rank_after, self.made
        ids = [start[b] for b in word]
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        shift = n.bit_length()
        places = (1 << shift) - 1
        queue, entry_of = [], [-1] * n  # the entry of the pair that starts at a symbol, -1 if it has none
        for left in range(n - 1):
            rank = after_id[ids[left]](ids[left + 1])
            if rank is not None:
                entry_of[left] = entry = rank << shift | left
                queue.append(entry)
        heapify(queue)
        while queue:
            entry = heappop(queue)
            left = entry & places
            if entry_of[left] != entry:
                continue  # stale: one of the two was merged meanwhile
            right = after[left]
            own = ids[left] = made[entry >> shift]
            ids[right] = entry_of[right] = entry_of[left] = -1
            last = after[left] = after[right]
            if last < n:
                before[last] = left
                rank = after_id[own](ids[last])
                if rank is not None:
                    entry_of[left] = entry = rank << shift | left
                    heappush(queue, entry)
            first = before[left]
            if first >= 0:
                rank = after_id[ids[first]](own)
                if rank is None:
                    entry_of[first] = -1
                else:
                    entry_of[first] = entry = rank << shift | first
                    heappush(queue, entry)
        return [i for i in ids if i >= 0]

    def encode(self, text: str) -> bytes:
        """The ids of a text, as bytes of 32-bit numbers."""
        if self.parted is None or not self.parted.search(text):
            return self._plain(text)
        parts = self.parted.split(text)
        return b"".join(
            np.int32(self.special[p]).tobytes() if i % 2 else self._plain(p) for i, p in enumerate(parts)
        )

    def _plain(self, text: str) -> bytes:
        if not _UNCOMMON.search(text):
            words = _COMMON
        else:
            words = self.exact_words if self.newer and self.newer.search(text) else self.words
        ids = self.paths.__getitem__
        if len(text) <= LONG_TEXT:
            return b"".join(map(ids, words.findall(text)))
        found, out = words.finditer(text), []
        while part := [ids(m[0]) for m in islice(found, WORDS_AT_ONCE)]:
            out.append(b"".join(part))
        return b"".join(out)

    def decode(self, ids) -> str:
        """The vocabulary's strings of the ids, one after another."""
        return b"".join(map(self.raw.__getitem__, ids)).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def codec_of(vocabulary: Vocabulary) -> Codec:
    """The codec of a vocabulary, once per worker process, with the words it remembers."""
    return Codec(vocabulary)


def encode_documents(docs: DataFrame, vocabulary: Vocabulary, id_col="doc_id", text_col="text") -> DataFrame:
    """A row per row of ``docs``: doc_id, ids, n_tokens.

    Null text is encoded as empty, to no ids; repeated rows are encoded each. A special
    string inside a text is encoded as its special id, as the public library does. Empty in,
    empty out; other columns of ``docs``, whatever their names, are not read. Texts may be of
    any length; only a single word without a boundary (a run of one kind of character) is
    held whole, at about 100 bytes a byte.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(vocabulary)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                coded = [codec.encode(t) for t in part.column(1).to_pylist()]
                sizes = np.array([len(c) // 4 for c in coded], np.int64)
                offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                ids = pa.array(np.frombuffer(b"".join(coded), np.int32))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.ListArray.from_arrays(pa.array(offsets), ids), pa.array(sizes)],
                    names=["doc_id", "ids", "n_tokens"],
                )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, ids array<int>, n_tokens bigint")


def _lists(column: pa.Array) -> Iterator[list[int]]:
    """The lists of a column, empty where they are null; the numbers become Python's at once and not one by one."""
    numbers = column.flatten()
    if numbers.null_count:
        raise ValueError("a null is no id")
    numbers, start = numbers.to_numpy().tolist(), 0
    for size in column.value_lengths().fill_null(0).to_pylist():
        yield numbers[start : start + size]
        start += size


def decode_documents(coded: DataFrame, vocabulary: Vocabulary, ids_col="ids", text_col="text") -> DataFrame:
    """``coded`` with the decoded text in place of its ids.

    Special ids become their strings; null ids give an empty text, bytes that are no UTF-8
    become U+FFFD. Ids that the vocabulary lacks raise. All other columns stay; one named
    like ``text_col`` is replaced. Rows, ties and repeats stay as they are.
    """
    kept = [c for c in coded.columns if c.lower() not in (ids_col.lower(), text_col.lower())]
    rows = coded.select(F.col(f"`{ids_col}`").alias(ids_col), *[F.col(f"`{c}`") for c in kept])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(vocabulary)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                texts = [codec.decode(ids) for ids in _lists(part.column(0))]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[1:], pa.array(texts, pa.string())], names=[*part.schema.names[1:], text_col]
                )

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields[1:], T.StructField(text_col, T.StringType())]))
