"""SentencePiece encoding and decoding: Unigram Viterbi over a double-array trie of pieces.

The pieces come from a public SentencePiece model file, read here as far as needed. Where
the file holds merge ranks instead of log probabilities (a BPE model), the log score of a
piece follows Zipf's law over its rank. Where no piece crosses the start of a run of
whitespace markers, a character that is in no piece, or the step from letters to other
characters, the best path over a text is made of the best paths over the parts between;
those of parts met before are remembered.
"""

import math
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievelog.llm.common import whole

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
#: Paths of parts a task remembers, and the longest part it remembers, in characters.
REMEMBERED = 400_000
REMEMBERED_CHARS = 40
#: What an unknown character costs below the lowest piece.
UNKNOWN_PENALTY = 10.0
#: Rows that are turned into one Arrow batch.
ROWS = 256

#: Fixed values of the model file: kinds of pieces, and the kind of model with log scores.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM = 1


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Number and value of each field of a protocol buffer message."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = number()
        if key & 7 == 0:
            yield key >> 3, number()
        else:
            size = {1: 8, 5: 4}.get(key & 7) or number()
            yield key >> 3, data[at : at + size]
            at += size


@dataclass(frozen=True)
class Pieces:
    """A vocabulary: texts, log scores and kinds by id, and how text is prepared."""

    texts: tuple[str, ...]
    scores: tuple[float, ...]
    kinds: tuple[int, ...]
    dummy_prefix: bool = True
    squeeze: bool = False


def read_model(data: bytes) -> Pieces:
    texts, scores, kinds, dummy, squeeze, model = [], [], [], True, True, UNIGRAM
    for tag, value in _fields(data):
        if tag == 1:
            piece = dict(_fields(value))
            texts.append(piece[1].decode())
            scores.append(float(np.frombuffer(piece.get(2, b"\0\0\0\0"), "<f4")[0]))
            kinds.append(piece.get(3, NORMAL))
        elif tag == 2:
            model = dict(_fields(value)).get(3, UNIGRAM)
        elif tag == 3:
            norm = dict(_fields(value))
            if norm.get(2):
                raise ValueError("models that rewrite characters are not supported")
            dummy, squeeze = bool(norm.get(3, 1)), bool(norm.get(4, 1))
    if model != UNIGRAM:
        scores = zipf_scores(scores, kinds)
    return Pieces(tuple(texts), tuple(scores), tuple(kinds), dummy, squeeze)


def zipf_scores(scores: list[float], kinds: list[int]) -> list[float]:
    """Log scores from ranks: the n-th best piece has a share in proportion to 1 / n."""
    order = sorted((i for i, k in enumerate(kinds) if k in (NORMAL, USER)), key=lambda i: (-scores[i], i))
    total = math.log(sum(1 / n for n in range(1, len(order) + 1))) if order else 0.0
    out = [0.0] * len(scores)
    for n, i in enumerate(order, 1):
        out[i] = float(np.float32(-math.log(n) - total))
    return out


def load_model(spark: SparkSession, path: str = MODEL) -> Pieces:
    """Read on the driver, where the path is a parameter of the job; the pieces travel with the tasks."""
    with open(path, "rb") as f:
        return read_model(f.read())


class DoubleArray:
    """A trie over bytes: the child of state s by byte b is t = base[s] + b + 1 if check[t] == s.

    A state's own place holds its piece in ``value``, -1 if none ends there.
    """

    def __init__(self, pieces: dict[bytes, int]):
        children: list[dict[int, int]] = [{}]
        ends = [-1]
        for text, number in pieces.items():
            node = 0
            for b in text:
                if b not in children[node]:
                    children[node][b] = len(children)
                    children.append({})
                    ends.append(-1)
                node = children[node][b]
            ends[node] = number
        self._place(children, ends)

    def _place(self, children: list[dict[int, int]], ends: list[int]) -> None:
        """Gives each state with children a base whose places are free, the widest first."""
        size = 2 * len(children) + 1024
        taken = np.zeros(size, bool)
        taken[0] = True
        bases, begin = np.zeros(len(children), np.int32), {}
        for node in sorted((n for n, e in enumerate(children) if e), key=lambda n: -len(children[n])):
            steps = np.array(sorted(children[node]), np.int64) + 1
            low = begin.get(len(steps), int(steps[0]))  # what states as wide have passed is full for this one too
            low = max(low, int(steps[0]))
            while True:
                starts = np.flatnonzero(~taken[low : low + 512]) + low - steps[0]
                if len(taken) < low + 1024:
                    taken = np.append(taken, np.zeros(len(taken), bool))
                for step in steps[1:]:
                    starts = starts[~taken[starts + step]]
                if len(starts):
                    break
                low += 512
            bases[node], begin[len(steps)] = starts[0], low
            taken[starts[0] + steps] = True
        place = np.zeros(len(children), np.int32)
        base, check, value = (np.full(len(taken) + 256, v, np.int32) for v in (0, -1, -1))  # any byte stays inside
        check[0], value[0] = 0, ends[0]
        for node, edges in enumerate(children):  # parents come before children
            here = place[node]
            base[here] = bases[node]
            for b, child in edges.items():
                t = bases[node] + b + 1
                check[t], value[t], place[child] = here, ends[child], t
        self.base, self.check, self.value = (array("i", x.tobytes()) for x in (base, check, value))

    def prefixes(self, data: bytes, at: int) -> Iterator[tuple[int, int]]:
        """End and piece of every piece that starts at ``at``, shortest first."""
        state, base, check, value = 0, self.base, self.check, self.value
        for end in range(at, len(data)):
            t = base[state] + data[end] + 1
            if check[t] != state:  # the root's own place is 0, and t is never 0
                return
            state = t
            if value[t] >= 0:
                yield end + 1, value[t]


class Codec:
    """Encodes and decodes texts with one vocabulary."""

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self.ids = {t.encode(): i for i, (t, k) in enumerate(zip(pieces.texts, pieces.kinds, strict=True)) if k in (NORMAL, USER)}
        self.trie = DoubleArray(self.ids)
        self.steps = [list(x) for x in (self.trie.base, self.trie.check, self.trie.value)]
        normal = [s for s, k in zip(pieces.scores, pieces.kinds, strict=True) if k == NORMAL]
        self.unknown_score = min(normal, default=0.0) - UNKNOWN_PENALTY
        best = max(normal, default=0.0)
        self.scores = [
            len(t) * best - 0.1 if k == USER else s for t, s, k in zip(pieces.texts, pieces.scores, pieces.kinds, strict=True)
        ]
        self.unknown = next((i for i, k in enumerate(pieces.kinds) if k == UNKNOWN), 0)
        self.bytes = {int(t[1:-1], 16): i for i, (t, k) in enumerate(zip(pieces.texts, pieces.kinds, strict=True)) if k == BYTE}
        self.fallback = len(self.bytes) == 256
        self.raw = [b"" if k in (CONTROL, UNKNOWN) else bytes([int(t[1:-1], 16)]) if k == BYTE else t.encode() for t, k in zip(pieces.texts, pieces.kinds, strict=True)]
        known = {c for t in self.ids for c in t.decode()}
        inner = any(MARK in t.decode().lstrip(MARK) for t in self.ids)
        self.parts = re.compile(self._part(known), re.S) if known and not inner else re.compile(r".+", re.S)
        self.met: dict[str, tuple[int, ...]] = {}

    def _part(self, known: set[str]) -> str:
        """A pattern of the parts between which no piece reaches."""
        def set_of(chars):
            return "[" + re.escape("".join(sorted(chars))) + "]+" if chars else "(?!)"

        letters = {c for c in known - {MARK} if c.isalpha()}
        others = known - {MARK} - letters
        mixed = any(
            x.isalpha() != y.isalpha() for t in self.ids for x, y in pairwise(t.decode()) if MARK not in (x, y)
        )
        runs = [set_of(letters | others)] if mixed else [set_of(letters), set_of(others)]
        return "|".join([f"{MARK}*{r}" for r in runs] + [f"{MARK}+", "."])

    def _path(self, part: str) -> tuple[int, ...]:
        """The pieces of the best path; of equal ones, that with the longer last piece."""
        data = part.encode("utf-8", "surrogatepass")
        n = len(data)
        best, came, used = [-math.inf] * (n + 1), [0] * (n + 1), [-1] * (n + 1)
        best[0] = 0.0
        base, check, value, scores, unknown = *self.steps, self.scores, self.unknown_score
        for at in range(n):
            here = best[at]
            if here == -math.inf:
                continue
            byte = data[at]
            single = at + (1 if byte < 0x80 else 2 if byte < 0xE0 else 3 if byte < 0xF0 else 4)
            state, end, known = 0, at, False
            while end < n:  # the walk of DoubleArray.prefixes, shortest piece first
                t = base[state] + data[end] + 1
                if check[t] != state:
                    break
                state = t
                end += 1
                piece = value[t]
                if piece >= 0:
                    score = here + scores[piece]
                    if score > best[end]:
                        best[end] = score
                        came[end] = at
                        used[end] = piece
                    if end == single:
                        known = True
            if not known and here + unknown > best[single]:
                best[single], came[single], used[single] = here + unknown, at, -1
        out, at = [], n
        while at:
            start, piece = came[at], used[at]
            if piece >= 0:
                out.append(piece)
            elif self.fallback:
                out.extend(self.bytes[b] for b in reversed(data[start:at]))
            else:
                out.append(self.unknown)
            at = start
        return tuple(reversed(out))

    def prepared(self, text: str) -> str:
        if self.pieces.squeeze:
            text = re.sub(" +", " ", text).strip(" ")
        return (" " + text if self.pieces.dummy_prefix and text else text).replace(" ", MARK)

    def encode(self, text: str) -> array:
        met, ids = self.met, array("i")
        for part in self.parts.findall(self.prepared(text)):
            path = met.get(part)
            if path is None:
                path = self._path(part)
                if len(part) <= REMEMBERED_CHARS:
                    if len(met) >= REMEMBERED:
                        met.clear()
                    met[part] = path
            ids.extend(path)
        return ids

    def decode(self, ids) -> str:
        raw = self.raw
        text = b"".join([raw[i] for i in ids]).decode("utf-8", "replace").replace(MARK, " ")
        return text[1:] if self.pieces.dummy_prefix and text[:1] == " " else text


@lru_cache(maxsize=2)
def codec_of(pieces: Pieces) -> Codec:
    """The codec of a vocabulary, once per worker process, with the paths it remembers."""
    return Codec(pieces)


def encode_documents(docs: DataFrame, pieces: Pieces, id_col="doc_id", text_col="text") -> DataFrame:
    """A row per row of ``docs``: doc_id, ids, n_pieces, n_byte_pieces, round_trip.

    Null text is encoded as empty, to no pieces. ``round_trip`` tells whether decoding the
    ids gives the text back; a text that holds the whitespace marker itself does not.
    """
    low = min((i for i, k in enumerate(pieces.kinds) if k == BYTE), default=0)
    high = max((i for i, k in enumerate(pieces.kinds) if k == BYTE), default=-1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(pieces)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                texts = part.column(1).to_pylist()
                coded = [np.frombuffer(codec.encode(t), np.int32) for t in texts]
                offsets = np.zeros(len(coded) + 1, np.int32)
                np.cumsum([len(c) for c in coded], out=offsets[1:])
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(coded))),
                        pa.array([len(c) for c in coded], pa.int64()),
                        pa.array([int(((c >= low) & (c <= high)).sum()) for c in coded], pa.int64()),
                        pa.array([codec.decode(c.tolist()) == t for c, t in zip(coded, texts, strict=True)]),
                    ],
                    names=["doc_id", "ids", "n_pieces", "n_byte_pieces", "round_trip"],
                )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, ids array<int>, n_pieces bigint, n_byte_pieces bigint, round_trip boolean")


def decode_documents(coded: DataFrame, pieces: Pieces) -> DataFrame:
    """doc_id and text of rows with doc_id and ids; null ids give an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(pieces)
        for batch in batches:
            texts = [codec.decode(ids or []) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return coded.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, text string")
