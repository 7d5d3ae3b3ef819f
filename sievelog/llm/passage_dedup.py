"""Removal of repeated passages: every byte of a 100-byte string that also starts earlier.

A run-compressed Burrows-Wheeler transform of the corpus is not built; README.md gives the
figures. Instead the strings are found by content. Of every 61 neighbouring 40-byte grams
the one with the least hash is an anchor, so equal 100-byte strings share an anchor at the
same place. An anchor's context is all the bytes that some 100-byte string around it can
hold. Three steps decide every string, none of them on a sample:

1. Owners of anchors: occurrences with equal contexts repeat the earliest one. The earliest
   ones of an anchor with several contexts are open.
2. Owners of documents cut the open contexts that still hold undecided strings.
3. Owners of open anchors compare all 100-byte strings of their contexts; anchors with very
   many contexts are compared by string instead, so that no owner holds them all.

Positions travel in packed blobs, a few per task, and occurrences that repeat an earlier one
of the same batch stay where they are.
"""

import hashlib
from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievelog.llm.common import whole
from sievelog.llm.text_arrays import BYTE_VALUES, chunks, mix

LENGTH, GRAM = 100, 40
#: Places of a string relative to an anchor in it, and the bytes around an anchor.
SHIFTS, AROUND = LENGTH - GRAM, 2 * LENGTH - GRAM
#: Contexts of an anchor, in one batch or at its owner, above which it is compared by string.
HOT_BATCH, HOT = 32, 2_000
#: Bytes of text per chunk, per owner of anchors and per owner of documents.
CHUNK, ANCHOR_BYTES, DOCUMENT_BYTES = 500_000, 12_000_000, 6_000_000

_U = np.uint64
_SEPARATOR = mix(np.array([1 << 40], _U))[0]
_MULTIPLIER = 0x9E3779B97F4A7C15
_NOWHERE = 0xFFFFFFFF
#: What a blob may hold. MARK: strings that start in [a, b) repeat; OPEN, BUSY: an open anchor at a.
MARK, OPEN, BUSY = 0, 1, 2
HIT = np.dtype([("gram", "<u8"), ("context", "<u8"), ("doc", "<u2"), ("at", "<u4")])
NOTE = np.dtype([("id", "<i8"), ("hash", "<i8"), ("a", "<i4"), ("b", "<i4"), ("kind", "u1"), ("gram", "<u8")])
CUT = np.dtype([("gram", "<u8"), ("id", "<i8"), ("hash", "<i8"), ("at", "<i4"), ("low", "u1"), ("high", "u1"), ("text", "u1", AROUND)])
STRING = np.dtype([("string", "<u8"), ("id", "<i8"), ("hash", "<i8"), ("at", "<i4")])


class Hashes:
    """Hashes of any stretch of a chunk whose documents stand ``LENGTH`` separators apart."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray):
        n = len(offsets) - 1
        self.sizes = np.diff(offsets)
        self.starts = offsets[:-1] + LENGTH * np.arange(1, n + 1)
        values = np.full(len(raw) + LENGTH * (n + 1), _SEPARATOR)
        values[np.arange(len(raw)) + LENGTH * np.repeat(np.arange(1, n + 1), self.sizes)] = BYTE_VALUES[raw]
        self.levels, size, factor = [(1, values)], 1, _MULTIPLIER
        while size < 64:
            last = self.levels[-1][1]
            self.levels.append((2 * size, last[:-size] * _U(factor) + last[size:]))
            size, factor = 2 * size, factor * factor % (1 << 64)

    def at(self, places: np.ndarray, length: int) -> np.ndarray:
        out, done = np.zeros(len(places), _U), 0
        for size, level in reversed(self.levels):
            while length - done >= size:
                out = mix(out + level[places + done])
                done += size
        return out

    def grams(self) -> np.ndarray:
        """The hash of the gram at every place."""
        n, done = len(self.levels[0][1]) - GRAM + 1, 0
        out = np.zeros(n, _U)
        for size, level in reversed(self.levels):
            while GRAM - done >= size:
                out = out * _U(0xD6E8FEB86659FD93) + level[done : done + n]
                done += size
        return mix(out)


def anchors(raw: np.ndarray, offsets: np.ndarray):
    """Document, place, gram hash and context hash of the anchors of a chunk."""
    h = Hashes(raw, offsets)
    grams = h.grams()
    inside = np.zeros(len(grams) + 1, np.int32)
    np.add.at(inside, np.minimum(h.starts, len(grams)), 1)
    np.add.at(inside, np.minimum(np.maximum(h.starts, h.starts + h.sizes - GRAM + 1), len(grams)), -1)
    low = _U(max(1, int(len(grams)).bit_length()))
    tail = _U((1 << int(low)) - 1)
    keys = (grams & ~tail) | (tail - np.arange(len(grams), dtype=_U))  # of equal hashes the last place is least
    keys[np.cumsum(inside)[:-1] == 0] = _U((1 << 64) - 1)
    least, span, width = keys, 1, SHIFTS + 1
    while span * 2 <= width:
        least, span = np.minimum(least[:-span], least[span:]), span * 2
    if width > span:
        least = np.minimum(least[: len(least) - (width - span)], least[width - span :])
    places = np.unique((tail - (least[least != _U((1 << 64) - 1)] & tail)).astype(np.int64))
    doc = np.searchsorted(h.starts, places, "right") - 1
    return doc, places - h.starts[doc], grams[places], h.at(places - SHIFTS, AROUND)


def _ranks(ids: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Place of each document in the order of id, then text hash; equal ones share it."""
    order = np.lexsort((hashes, ids))
    new = np.ones(len(order), np.int64)
    new[1:] = (ids[order][1:] != ids[order][:-1]) | (hashes[order][1:] != hashes[order][:-1])
    out = np.zeros(len(order), np.int64)
    out[order] = np.cumsum(new) - 1
    return out


def _changes(*sorted_keys: np.ndarray) -> np.ndarray:
    """True where a run of equal keys begins."""
    new = np.zeros(len(sorted_keys[0]), bool)
    new[:1] = True
    for key in sorted_keys:
        new[1:] |= key[1:] != key[:-1]
    return new


def _decide(gram, context, rank, at):
    """Order, and by it: which occurrence repeats the earliest of its context; contexts of its gram; first of its context."""
    order = np.lexsort((at, rank, context, gram))
    g, c, r, a = gram[order], context[order], rank[order], at[order]
    begin = _changes(g, c)
    first = np.maximum.accumulate(np.where(begin, np.arange(len(order)), 0))
    repeats = (r != r[first]) | (a != a[first])
    per_gram = np.cumsum(_changes(g)) - 1
    contexts = np.bincount(per_gram, weights=begin, minlength=1)[per_gram].astype(np.int64) if len(order) else np.zeros(0, np.int64)
    return order, repeats, contexts, begin


def _notes(ids, hashes, a, b, kind, gram=0) -> np.ndarray:
    out = np.zeros(len(ids), NOTE)
    out["id"], out["hash"], out["a"], out["b"], out["kind"], out["gram"] = ids, hashes, a, b, kind, gram
    return out


def _marks(ids, hashes, rank, at) -> np.ndarray:
    """Notes of the strings around repeated anchors, joined where they overlap."""
    order = np.lexsort((at, rank))
    r, low, high = rank[order], np.maximum(0, at[order].astype(np.int64) - SHIFTS), at[order].astype(np.int64) + 1
    begin = _changes(r)
    begin[1:] |= low[1:] > high[:-1]
    starts = np.flatnonzero(begin)
    ends = np.append(starts[1:], len(order)) - 1 if len(order) else starts
    return _notes(ids[order][starts], hashes[order][starts], low[starts], high[ends], MARK)


def _document_bucket(ids: np.ndarray, hashes: np.ndarray, n: int) -> np.ndarray:
    return (mix(mix(ids.view(_U) if ids.dtype == np.int64 else ids.astype(np.int64).view(_U)) + hashes.astype(np.int64).view(_U)) % _U(n)).astype(np.int32)


def _note_rows(notes: np.ndarray, n: int) -> tuple[list[int], list[bytes]]:
    """Notes as one blob per document bucket."""
    if not len(notes):
        return [], []
    bucket = _document_bucket(notes["id"].copy(), notes["hash"].copy(), n)
    order = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(_changes(bucket[order]))
    return bucket[order][cuts].tolist(), [p.tobytes() for p in np.split(notes[order], cuts[1:])]


_OCCURRENCES = "bucket int, docs binary, hits binary, notes binary"


def _find(n_anchor: int):
    """Step 0, on documents (doc_id, text_hash, text): occurrences per anchor bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, hashes = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            found = [(d + first, at, g, c) for first, raw, offsets in chunks(batch, 2, CHUNK) for d, at, g, c in [anchors(raw, offsets)]]
            if not found:
                continue
            doc, at, gram, context = (np.concatenate(x) for x in zip(*found, strict=True))
            rank = _ranks(ids, hashes)
            order, repeats, contexts, begin = _decide(gram, context, rank[doc], at)
            gone = order[repeats]
            notes = [_marks(ids[doc[gone]], hashes[doc[gone]], rank[doc[gone]], at[gone])]
            hot = begin & (contexts > HOT_BATCH)
            busy = order[hot]
            notes.append(_notes(ids[doc[busy]], hashes[doc[busy]], at[busy], 0, BUSY, gram[busy]))
            sent = order[begin & ~hot]
            hits = np.zeros(len(sent), HIT)
            hits["gram"], hits["context"], hits["at"] = gram[sent], context[sent], at[sent]
            tokens = np.zeros(len(np.unique(gram[busy])), HIT)
            tokens["gram"], tokens["at"] = np.unique(gram[busy]), _NOWHERE
            owner = np.append(doc[sent], np.zeros(len(tokens), np.int64))
            yield from _pack(np.append(hits, tokens), owner, ids, hashes, np.concatenate(notes), n_anchor)

    return run


def _pack(hits, owner, ids, hashes, notes, n_anchor):
    bucket = (hits["gram"] % _U(n_anchor)).astype(np.int32)
    order = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(_changes(bucket[order]))
    rows: list[list] = [[], [], [], []]
    for part in np.split(order, cuts[1:]) if len(order) else []:
        for piece in np.array_split(part, max(1, ceil(len(np.unique(owner[part])) / 60_000))):  # 16-bit numbers of documents
            used, number = np.unique(owner[piece], return_inverse=True)
            if len(used) > 65_535:
                raise ValueError("a batch holds too many documents")
            own = hits[piece]
            own["doc"] = number
            for column, value in zip(rows, (int(bucket[piece[0]]), np.stack([ids[used], hashes[used]]).tobytes(), own.tobytes(), b""), strict=True):
                column.append(value)
    if len(notes):
        for column, value in zip(rows, (int(notes["hash"][0] % n_anchor), b"", b"", notes.tobytes()), strict=True):
            column.append(value)
    yield pa.RecordBatch.from_arrays(
        [pa.array(rows[0], pa.int32()), *(pa.array(r, pa.binary()) for r in rows[1:])], names=["bucket", "docs", "hits", "notes"]
    )


_NOTED = "place int, blob binary"


def _noted(notes: np.ndarray, n_docs: int) -> pa.Table:
    place, blobs = _note_rows(notes, n_docs)
    return pa.table([pa.array(place, pa.int32()), pa.array(blobs, pa.binary())], names=["place", "blob"])


def _own_anchors(n_docs: int):
    """Step 1, on all occurrences of a bucket of anchors."""

    def run(table: pa.Table) -> pa.Table:
        ids, hashes, hits, base = [], [], [], 0
        notes = [np.frombuffer(b, NOTE) for b in table.column("notes").to_pylist()]
        owner = []
        for docs, blob in zip(table.column("docs").to_pylist(), table.column("hits").to_pylist(), strict=True):
            pairs, part = np.frombuffer(docs, np.int64).reshape(2, -1), np.frombuffer(blob, HIT)
            ids.append(pairs[0])
            hashes.append(pairs[1])
            hits.append(part)
            owner.append(part["doc"].astype(np.int64) + base)
            base += pairs.shape[1]
        ids, hashes, hits, owner = (np.concatenate(x) for x in (ids, hashes, hits, owner))
        token = hits["at"] == _NOWHERE
        busy_grams = np.unique(hits["gram"][token])
        hits, owner = hits[~token], owner[~token]
        rank = _ranks(ids, hashes)[owner]
        order, repeats, contexts, begin = _decide(hits["gram"], hits["context"], rank, hits["at"])
        gone = order[repeats]
        notes.append(_marks(ids[owner[gone]], hashes[owner[gone]], rank[gone], hits["at"][gone]))
        gram = hits["gram"][order]
        busy = np.isin(gram, busy_grams) | (contexts > HOT)
        for kind, chosen in ((OPEN, begin & ~busy & (contexts > 1)), (BUSY, begin & busy)):
            x = order[chosen]
            notes.append(_notes(ids[owner[x]], hashes[owner[x]], hits["at"][x], 0, kind, hits["gram"][x]))
        return _noted(np.concatenate(notes), n_docs)

    return run


class _Group:
    """The documents of one place, side by side, with the notes about them."""

    def __init__(self, docs: pa.Table, noted: pa.Table):
        docs = docs.combine_chunks()
        self.table = docs
        self.ids, self.hashes = (docs.column(c).to_numpy() for c in ("doc_id", "text_hash"))
        texts = docs.column("text")
        texts = texts.chunk(0) if texts.num_chunks else pa.array([], pa.binary())
        self.raw, self.offsets = np.zeros(0, np.uint8), np.zeros(1, np.int64)
        if len(texts):
            _, offsets, data = texts.buffers()
            kind = np.int64 if pa.types.is_large_binary(texts.type) else np.int32
            ends = np.frombuffer(offsets, kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
            if ends[-1] > ends[0]:
                self.raw = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]]
            self.offsets = ends - ends[0]
        notes = np.concatenate([np.zeros(0, NOTE), *(np.frombuffer(b, NOTE) for b in noted.column("blob").to_pylist())])
        rows = np.lexsort((self.hashes, self.ids))
        keys = np.stack([self.ids[rows], self.hashes[rows]])
        wanted = np.lexsort((notes["hash"], notes["id"]))
        notes = notes[wanted]
        both_ids, both_hashes = np.append(keys[0], notes["id"]), np.append(keys[1], notes["hash"])
        rank = _ranks(both_ids, both_hashes)
        own, theirs = rank[: len(rows)], rank[len(rows) :]
        low, high = np.searchsorted(own, theirs, "left"), np.searchsorted(own, theirs, "right")
        times = high - low  # rows that repeat id and text all get the notes
        self.notes = np.repeat(notes, times)
        step = np.arange(len(self.notes)) - np.repeat(np.cumsum(times) - times, times)
        self.row = rows[np.repeat(low, times) + step] if len(self.notes) else np.zeros(0, np.int64)

    def starts(self, chosen: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """For every byte, whether a string that starts there is among the given ones."""
        row = self.row[chosen]
        last = np.maximum(0, np.diff(self.offsets)[row] - LENGTH + 1)
        low, high = np.minimum(np.maximum(low, 0), last), np.minimum(high, last)
        ok = high > low
        step = np.zeros(len(self.raw) + 1, np.int32)
        np.add.at(step, self.offsets[row[ok]] + low[ok], 1)
        np.add.at(step, self.offsets[row[ok]] + high[ok], -1)
        return np.cumsum(step)[:-1] > 0

    def marked(self) -> np.ndarray:
        mark = self.notes["kind"] == MARK
        return self.starts(mark, self.notes["a"][mark], self.notes["b"][mark])

    def mark_notes(self, marked: np.ndarray) -> np.ndarray:
        """The marked starts as one note per run."""
        edge = np.flatnonzero(np.diff(np.concatenate([[0], marked.astype(np.int8), [0]])))
        begin, end = edge[::2], edge[1::2]
        row = np.searchsorted(self.offsets, begin, "right") - 1
        return _notes(self.ids[row], self.hashes[row], begin - self.offsets[row], end - self.offsets[row], MARK)


_CUTS = "bucket int, kind int, blob binary"


def _cut(n_anchor: int):
    """Step 2, on the documents of a place and their notes: what the open anchors still leave undecided."""

    def run(docs: pa.Table, noted: pa.Table) -> pa.Table:
        group, squeeze = _Group(docs, noted), zstandard.ZstdCompressor(level=1)
        marked, kinds = group.marked(), group.notes["kind"]
        rows: list[tuple[int, int, bytes]] = []
        padded = np.concatenate([np.zeros(LENGTH, np.uint8), group.raw, np.zeros(LENGTH, np.uint8)])
        at = group.notes["a"].astype(np.int64)
        size = np.diff(group.offsets)[group.row] if len(group.row) else np.zeros(0, np.int64)
        low, high = np.maximum(0, at - SHIFTS), np.minimum(at, size - LENGTH) + 1
        free = np.concatenate([[0], np.cumsum(~marked)])
        base = group.offsets[group.row] if len(group.row) else low
        some = (kinds != MARK) & (high > low)
        some[some] = free[(base + high)[some]] > free[(base + low)[some]]
        open_ = np.flatnonzero(some & (kinds == OPEN))
        if len(open_):
            cuts = np.zeros(len(open_), CUT)
            cuts["gram"], cuts["id"], cuts["hash"], cuts["at"] = (group.notes[k][open_] for k in ("gram", "id", "hash", "a"))
            shift = (at - SHIFTS)[open_]
            cuts["low"], cuts["high"] = low[open_] - shift, high[open_] - shift
            cuts["text"] = padded[(base[open_] + shift + LENGTH)[:, None] + np.arange(AROUND)]
            bucket = (cuts["gram"] % _U(n_anchor)).astype(np.int64)
            order = np.lexsort((cuts["gram"], bucket))
            for part in np.split(order, np.flatnonzero(_changes(bucket[order]))[1:]):
                rows.append((int(bucket[part[0]]), OPEN, squeeze.compress(cuts[part].tobytes())))
        extra, busy = np.zeros(0, NOTE), some & (kinds == BUSY)
        if busy.any():
            starts = np.flatnonzero(group.starts(busy, low[busy], high[busy]) & ~marked)
            row = np.searchsorted(group.offsets, starts, "right") - 1
            used, number = np.unique(row, return_inverse=True)
            texts = np.concatenate([group.raw[group.offsets[r] : group.offsets[r + 1]] for r in used])
            sizes = np.diff(group.offsets)[used]
            strings = np.zeros(len(starts), STRING)
            strings["id"], strings["hash"], strings["at"] = group.ids[row], group.hashes[row], starts - group.offsets[row]
            strings["string"] = _string_hashes(texts, sizes, number, strings["at"])
            strings, again = _earliest(strings)
            extra = _notes(again["id"], again["hash"], again["at"], again["at"].astype(np.int64) + 1, MARK)
            bucket = (mix(strings["string"].copy()) % _U(n_anchor)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            for part in np.split(order, np.flatnonzero(_changes(bucket[order]))[1:]):
                rows.append((int(bucket[part[0]]), BUSY, strings[part].tobytes()))
        notes = np.concatenate([group.mark_notes(marked), extra])
        if len(notes):
            rows.append((int(notes["hash"][0] % n_anchor), MARK, notes.tobytes()))
        columns = list(zip(*rows, strict=True)) if rows else [[], [], []]
        kinds_ = (pa.int32(), pa.int32(), pa.binary())
        return pa.table([pa.array(list(c), k) for c, k in zip(columns, kinds_, strict=True)], names=["bucket", "kind", "blob"])

    return run


def _string_hashes(raw, sizes, number, at) -> np.ndarray:
    """Hash of the string at place ``at`` of text ``number``, a few texts at a time."""
    offsets, out = np.concatenate([[0], np.cumsum(sizes)]), np.zeros(len(at), _U)
    first = 0
    while first < len(sizes):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + CHUNK, "right")) - 1)
        h = Hashes(raw[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
        mine = (number >= first) & (number < last)
        out[mine] = h.at(h.starts[number[mine] - first] + at[mine], LENGTH)
        first = last
    return out


def _earliest(strings: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The earliest occurrence of each string, and the later ones."""
    order = np.lexsort((strings["at"], strings["hash"], strings["id"], strings["string"]))
    s = strings[order]
    begin = _changes(s["string"])
    first = s[np.maximum.accumulate(np.where(begin, np.arange(len(s)), 0))]
    later = (s["id"] != first["id"]) | (s["hash"] != first["hash"]) | (s["at"] != first["at"])
    return s[begin], s[later]


def _compare(n_docs: int):
    """Step 3, on the contexts and strings of a bucket: which of their strings start earlier elsewhere."""

    def run(table: pa.Table) -> pa.Table:
        kinds, blobs = table.column("kind").to_pylist(), table.column("blob").to_pylist()
        opened = zstandard.ZstdDecompressor()
        notes = [np.zeros(0, NOTE), *(np.frombuffer(b, NOTE) for k, b in zip(kinds, blobs, strict=True) if k == MARK)]
        strings = [np.frombuffer(b, STRING) for k, b in zip(kinds, blobs, strict=True) if k == BUSY]
        if strings:
            _, again = _earliest(np.concatenate(strings))
            notes.append(_notes(again["id"], again["hash"], again["at"], again["at"].astype(np.int64) + 1, MARK))
        cuts = [np.frombuffer(opened.decompress(b), CUT) for k, b in zip(kinds, blobs, strict=True) if k == OPEN]
        if cuts:
            cuts = np.concatenate(cuts)
            cuts = cuts[np.argsort(cuts["gram"], kind="stable")]
            begins = np.append(np.flatnonzero(_changes(cuts["gram"])), len(cuts))
            first = 0
            while first < len(cuts):  # whole grams, some thousand contexts at a time
                last = int(begins[max(np.searchsorted(begins, first + 5_000, "right") - 1, np.searchsorted(begins, first, "right"))])
                notes.append(_compare_contexts(cuts[first:last]))
                first = last
        return _noted(np.concatenate(notes), n_docs)

    return run


def _compare_contexts(cuts: np.ndarray) -> np.ndarray:
    values, size, factor, levels = BYTE_VALUES[cuts["text"]], 1, _MULTIPLIER, []
    levels.append((1, values))
    while size < 64:
        last = levels[-1][1]
        levels.append((2 * size, last[:, :-size] * _U(factor) + last[:, size:]))
        size, factor = 2 * size, factor * factor % (1 << 64)
    hashes, done = np.zeros((len(cuts), SHIFTS + 1), _U), 0
    for size, level in reversed(levels):
        while LENGTH - done >= size:
            hashes = mix(hashes + level[:, done : done + SHIFTS + 1])
            done += size
    hashes = mix(hashes + cuts["gram"][:, None])
    shift = np.arange(SHIFTS + 1)
    valid = (shift >= cuts["low"][:, None]) & (shift < cuts["high"][:, None])
    context, column = np.nonzero(valid)
    rank = _ranks(cuts["id"].copy(), cuts["hash"].copy())[context]
    start = cuts["at"][context].astype(np.int64) - SHIFTS + column
    key = hashes[valid]
    order = np.lexsort((start, rank, key))
    k, r, s = key[order], rank[order], start[order]
    head = np.maximum.accumulate(np.where(_changes(k), np.arange(len(k)), 0))
    again = np.zeros(valid.shape, np.int8)
    later = order[(r != r[head]) | (s != s[head])]
    again[context[later], column[later]] = 1
    edges = np.diff(np.pad(again, ((0, 0), (1, 1))), axis=1)
    row, begin = np.nonzero(edges == 1)
    _, end = np.nonzero(edges == -1)
    at = cuts["at"][row].astype(np.int64) - SHIFTS
    return _notes(cuts["id"][row], cuts["hash"][row], at + begin, at + end, MARK)


_RESULT = "doc_id bigint, null_id boolean, text_hash bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary"


def _remove(keep_text: bool):
    """Last step: the bytes that no marked string covers."""

    def run(docs: pa.Table, noted: pa.Table) -> pa.Table:
        group = _Group(docs, noted)
        edge = group.mark_notes(group.marked())
        n = len(group.ids)
        step = np.zeros(len(group.raw) + 1, np.int32)
        mark = group.notes["kind"] == MARK
        row = group.row[mark]
        last = np.maximum(0, np.diff(group.offsets)[row] - LENGTH + 1) if len(row) else row
        low, high = np.minimum(group.notes["a"][mark], last), np.minimum(group.notes["b"][mark], last)
        ok = high > low
        np.add.at(step, group.offsets[row[ok]] + low[ok], 1)
        np.add.at(step, group.offsets[row[ok]] + high[ok] + LENGTH - 1, -1)
        gone = np.cumsum(step)[:-1] > 0
        begin = gone & ~np.append(False, gone[:-1])
        begin[group.offsets[:-1][group.offsets[:-1] < len(gone)]] = gone[group.offsets[:-1][group.offsets[:-1] < len(gone)]]
        removed, spans = (np.concatenate([[0], np.cumsum(x)])[group.offsets] for x in (gone, begin))
        kept = [group.raw[a:b][~gone[a:b]].tobytes() for a, b in zip(group.offsets[:-1], group.offsets[1:], strict=True)]
        return pa.table(
            [group.table.column("doc_id"), group.table.column("null_id"), group.table.column("text_hash"),
             pa.array(np.diff(group.offsets), pa.int64()), pa.array(np.diff(removed), pa.int64()), pa.array(np.diff(spans), pa.int64()),
             pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()),
             pa.array(kept if keep_text else [None] * n, pa.binary())],
            names=["doc_id", "null_id", "text_hash", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"],
        )

    return run


def remove_repeats(docs: DataFrame, id_col="doc_id", text_col="text", keep_text=True) -> DataFrame:
    """A row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (remaining bytes).

    Earlier means a smaller id, then a smaller text hash, then an earlier start; null ids
    come last. Rows that repeat id and text are one document, reported each. Null text is
    empty; texts under 100 bytes lose nothing. Empty in, empty out.
    """
    rows = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit((1 << 63) - 1)).alias("doc_id"), F.col(id_col).isNull().alias("null_id"),
        F.xxhash64(whole(text_col)).alias("text_hash"), whole(text_col).cast("binary").alias("text"),
    )
    size = docs.agg(F.coalesce(F.sum(F.octet_length(text_col).cast("long")), F.lit(0))).first()[0]
    n_anchor, n_docs = max(1, ceil(size / ANCHOR_BYTES)), max(1, ceil(size / DOCUMENT_BYTES))
    hits = rows.select("doc_id", "text_hash", "text").mapInArrow(_find(n_anchor), _OCCURRENCES)
    noted = hits.groupBy("bucket").applyInArrow(_own_anchors(n_docs), _NOTED)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = _document_bucket(*(b.column(i).to_numpy(zero_copy_only=False) for i in (0, 2)), n_docs)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(at)], names=["doc_id", "null_id", "text_hash", "text", "place"])

    placed = rows.mapInArrow(place, "doc_id bigint, null_id boolean, text_hash bigint, text binary, place int").groupBy("place")
    cuts = placed.cogroup(noted.groupBy("place")).applyInArrow(_cut(n_anchor), _CUTS)
    final = cuts.groupBy("bucket").applyInArrow(_compare(n_docs), _NOTED)
    out = placed.cogroup(final.groupBy("place")).applyInArrow(_remove(keep_text), _RESULT)
    return out.withColumn("doc_id", F.when(~F.col("null_id"), F.col("doc_id"))).drop("null_id", "text_hash")
