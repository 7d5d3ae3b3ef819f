"""Exact deduplication by an extendible-hash index of texts on shared files.

One scan writes a narrow entry per document: its key (leading bits of the SHA-256 of the
normalised text), and the number of the text it equals. The first copy of a text that a task
meets brings its compressed bytes; a later one, found equal to the first of its key by bytes,
only bears the same number. The directory starts at one depth for all keys and doubles where
a bucket holds more distinct keys than its capacity; a bucket stops splitting once it fits or
the key bits end. Owner tasks take whole buckets, walk each key's texts in order, compare
bytes and chain texts that collide: bucket, key and place in the chain are the group of a
document. A text that a third of all rows repeat costs an owner one payload per scanning task.
"""

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sievelog.llm.common import SPACES, materialise, packed, row_tasks, unpacked, whole

#: Key bits the directory may use: at most 65,536 cells, small enough to broadcast.
DIRECTORY_BITS = 16
#: Distinct keys a bucket may hold before it splits.
BUCKET_CAPACITY = 50_000
#: Compressed bytes of texts that a scanning task remembers, to send a text once.
SEEN_BYTES = 8 << 20
#: Rows that a task holds as Python objects at once.
ROWS = 512

_ENTRY = "doc_id bigint, key bigint, text_no bigint, sha binary, n_bytes bigint, payload binary"
_LINK = "bucket string, key bigint, text_no bigint, chain int"


def normalised(text: str) -> bytes:
    """UTF-8 bytes with every run of ASCII white space made one space."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    if not words:
        return b" " if raw else b""
    edge = b" \t\n\r\x0b\x0c"
    return (b" " if raw[0] in edge else b"") + b" ".join(words) + (b" " if raw[-1] in edge else b"")


def text_digest(body: bytes) -> bytes:
    return hashlib.sha256(body).digest()


def build_entries(docs: DataFrame, id_col="doc_id", text_col="text", key_bits=64, digest=text_digest) -> DataFrame:
    """A row per document: doc_id, key, text_no, sha, n_bytes, payload (null for copies met before).

    A ``text_no`` stands for one text as one task met it; numbers differ between tasks. Store
    the rows before they are used twice.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze, seen, held = zstandard.ZstdCompressor(level=1), {}, 0
        number = TaskContext.get().partitionId() << 40
        for batch in (b.slice(at, ROWS) for b in batches for at in range(0, b.num_rows, ROWS)):
            keys, numbers, shas, sizes, payloads = [], [], [], [], []
            for text in batch.column(1).to_pylist():
                body = normalised(text)
                sha = digest(body)
                key = int.from_bytes(sha[:8], "big") >> (64 - key_bits) << (64 - key_bits)
                # Compression is a function of the text: equal bytes here are equal texts.
                payload = squeeze.compress(body)
                first = seen.get(key)
                if first and first[0] == payload:
                    numbers.append(first[1])
                    payloads.append(None)
                else:
                    number += 1
                    numbers.append(number)
                    payloads.append(payload)
                    if not first:
                        if held > SEEN_BYTES:
                            seen.clear()
                            held = 0
                        seen[key] = payload, number
                        held += len(payload)
                keys.append(key - (1 << 64) if key >> 63 else key)
                shas.append(sha)
                sizes.append(len(body))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(keys, pa.int64()), pa.array(numbers, pa.int64()), pa.array(shas, pa.binary()),
                 pa.array(sizes, pa.int64()), pa.array(payloads, pa.binary())],
                names=["doc_id", "key", "text_no", "sha", "n_bytes", "payload"],
            )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole(text_col).alias("text"))
    return rows.mapInArrow(scan, _ENTRY)


def _cell(key="key"):
    return F.shiftrightunsigned(F.col(key), 64 - DIRECTORY_BITS)


def build_directory(entries: DataFrame, capacity=BUCKET_CAPACITY) -> DataFrame:
    """A row per non-empty cell: cell, bucket (its key prefix in binary), depth.

    Buckets are found by doubling: at each depth a prefix with more distinct keys than
    ``capacity`` is split by the next bit. A cell's bucket is its shortest prefix that fits.
    """
    counts = entries.select("key").distinct().groupBy(_cell().alias("cell")).count()
    counts = materialise(counts, "directory")
    bits = F.lpad(F.bin(F.col("cell")), DIRECTORY_BITS, "0")
    open_, depth = counts.withColumn("bits", bits), F.lit(None).cast("int")
    for d in range(DIRECTORY_BITS + 1):
        prefix = F.substring("bits", 1, d) if d else F.lit("")
        held = F.sum("count").over(Window.partitionBy(prefix))
        fits = (held <= capacity) | F.lit(d == DIRECTORY_BITS)
        open_ = open_.withColumn(f"fits_{d}", fits)
        depth = F.coalesce(depth, F.when(F.col(f"fits_{d}"), d))
    return materialise(
        open_.withColumn("depth", depth).select(
            "cell", F.expr("substring(bits, 1, depth)").alias("bucket"), "depth"
        ),
        "directory",
    )


def _own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Buckets sorted by key: the place of every text in the chain of its key, by comparing bytes."""
    opened, at, chain = zstandard.ZstdDecompressor(), None, []
    for batch in (b.slice(at, ROWS) for b in batches for at in range(0, b.num_rows, ROWS)):
        rows = []
        for bucket, key, text_no, payload in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            body = opened.decompress(payload)
            if key != at:
                at, chain = key, []
            if body not in chain:
                chain.append(body)
            rows.append((bucket, key, text_no, chain.index(body)))
        columns = [list(c) for c in zip(*rows, strict=True)] if rows else [[]] * 4
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int64()),
             pa.array(columns[2], pa.int64()), pa.array(columns[3], pa.int32())],
            names=["bucket", "key", "text_no", "chain"],
        )


def build_index(entries: DataFrame, capacity=BUCKET_CAPACITY) -> DataFrame:
    """A row per text number, on shared files: bucket, key, text_no, chain.

    Numbers of equal texts have the same bucket, key and chain; different texts never do.
    """
    directory = build_directory(entries, capacity)
    texts = (
        entries.where(F.col("payload").isNotNull())
        .withColumn("cell", _cell())
        .join(F.broadcast(directory), "cell")  # 2 ** DIRECTORY_BITS rows at most
    )
    owned = (
        texts.select("bucket", "key", "text_no", "payload")
        .repartition(row_tasks(entries.sparkSession), "bucket")
        .sortWithinPartitions("bucket", "key", "text_no")
    )
    return materialise(owned.mapInArrow(_own, _LINK), "text-index")


def exact_duplicates(docs: DataFrame, id_col="doc_id", text_col="text", capacity=BUCKET_CAPACITY,
                     key_bits=64, digest=text_digest) -> DataFrame:
    """A row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256, n_bytes, bucket, chain.

    Groups are those of the index: texts are equal where bucket, key and chain are, whatever
    their digests. Null text counts as empty. The smallest id of equal texts stays; a null id
    comes last. Where rows repeat both id and text, one of them is kept. An empty table gives
    an empty table; other columns of ``docs``, whatever their names, are not read. A text is
    held whole by the task that reads it and by its owner.
    """
    entries = materialise(build_entries(docs, id_col, text_col, key_bits, digest), "text-entries")
    index = build_index(entries, capacity)
    # Copies of a text in one task have one number, so no number is hot and only numbers meet groups.
    ids = F.min(F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id").alias("keep_id"))).alias("least")
    numbers = entries.groupBy("text_no").agg(ids, F.count("*").alias("n")).join(index, "text_no")
    numbers = materialise(numbers, "text-numbers")
    groups = numbers.groupBy("bucket", "key", "chain").agg(
        F.min(F.struct("least", "text_no")).alias("keep"), F.sum("n").alias("group_size")
    )
    found = materialise(
        numbers.select("bucket", "key", "chain", "text_no").join(groups, ["bucket", "key", "chain"]).select(
            "text_no", "bucket", "chain", "group_size", F.col("keep.least.keep_id").alias("keep_id"),
            (F.col("text_no") == F.col("keep.text_no")).alias("keeps"),
        ),
        "text-groups",
    )
    same = entries.groupBy("doc_id", "text_no", "sha", "n_bytes").count()
    return (
        same.join(found, "text_no")
        .withColumn("nth", F.explode(F.sequence(F.lit(1).cast("long"), F.col("count"))))
        .select(
            "doc_id", "keep_id", "group_size",
            (F.col("keeps") & F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("nth") == 1)).alias("kept"),
            F.lower(F.hex("sha")).alias("text_sha256"),
            "n_bytes", "bucket", "chain",
        )
    )


def drop_exact_duplicates(docs: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
    """The rows of ``docs`` that stay, with their own columns; see :func:`exact_duplicates`.

    The index says which texts stay; a row is found again by its id and the SHA-256 of its
    text. Odd rows, ties, repeats, long texts and clashing names are handled as there: of rows
    that repeat id and text one stays, and all columns, whatever their names, come through.
    """
    stay = exact_duplicates(docs, id_col, text_col).where("kept").select("doc_id", F.unhex("text_sha256").alias("sha"))
    norm = F.regexp_replace(whole(text_col), SPACES, " ")
    rows = docs.select(
        packed(docs), F.col(id_col).cast("long").alias("id"),
        F.unhex(F.sha2(norm.cast("binary"), 256)).alias("text_sha"),
    )
    matched = rows.join(stay, (rows.text_sha == stay.sha) & F.col("id").eqNullSafe(stay.doc_id), "left_semi")
    return matched.dropDuplicates(["text_sha", "id"]).select(*unpacked(docs))
