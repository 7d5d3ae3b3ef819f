"""Which batches a table has, who wrote them, and the highest id so far.

Next to the batch folders a table keeps small marks in ``_batches``, a folder that readers
skip: ``id-<batch>`` holds the source that claimed the batch, ``stream-<number>`` the stream
that owns a range of batches, and ``top-<batch>-<id>`` says by its name the highest id
stored. They are listed, not read as data, so nothing here grows with the rows.
"""

import os
import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Batches of streams are number * _RANGE + micro-batch; those of single calls are below it.
_RANGE = 1 << 32
_MARKS = "_batches"


def _open(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = _open(spark, path)
    return fs.exists(at)


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder; none if there is no folder."""
    fs, at = _open(spark, folder)
    return [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []


def write_mark(spark: SparkSession, folder: str, name: str, text: str = "") -> bool:
    """Create a small file with all its text at once; False if another call was first.

    The text is written under a name of its own, which then becomes the mark's if that is
    free: by a hard link on a local disk, else by a rename that replaces nothing. The latter
    is atomic on HDFS and on stores whose rename is; on others give a table one writer at a
    time. A crash in between leaves a file that nobody reads, never an empty mark.
    """
    fs, at = _open(spark, f"{folder}/{name}")
    if fs.exists(at):
        return False
    _, own = _open(spark, f"{folder}/.{name}-{uuid.uuid4().hex}")
    out = fs.create(own, False)
    out.write(bytearray(text.encode()))
    out.close()
    jvm = spark.sparkContext._jvm
    if fs.getUri().getScheme() == "file":
        try:
            os.link(own.toUri().getPath(), at.toUri().getPath())
            return True
        except FileExistsError:
            return False
        finally:
            fs.delete(own, False)
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
    try:
        files.rename(own, at, options)
        return True
    except Exception:
        if fs.exists(at):
            fs.delete(own, False)
            return False
        raise


def read_mark(spark: SparkSession, folder: str, name: str) -> str:
    fs, at = _open(spark, f"{folder}/{name}")
    file = fs.open(at)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(file, "UTF-8")
    finally:
        file.close()


def digest_of(rows: DataFrame) -> str:
    """Row count and sum of row hashes: tells whether a named batch is run again with the same rows."""
    fields = F.struct(*[F.col(f"`{c}`") for c in rows.columns], *[F.isnull(f"`{c}`") for c in rows.columns])
    n, total = rows.agg(F.count("*"), F.sum(F.xxhash64(fields).cast("decimal(38,0)"))).first()
    return f"{n} rows, hash {total or 0}"


def _folder(table: str) -> str:
    return f"{table.rstrip('/')}/{_MARKS}"


def _numbers(found: list[str], pattern: str) -> list[int]:
    return [int(m[1]) for m in (re.fullmatch(pattern, n) for n in found) if m]


def claim(spark: SparkSession, table: str, source: str, batch_id: int | None = None) -> int:
    """The batch to write: the next free one, or ``batch_id`` if it is free or of the same source.

    Anything else would replace rows of another source, so it raises.
    """
    folder = _folder(table)
    if batch_id is not None:
        if write_mark(spark, folder, f"id-{batch_id}", source):
            if not exists(spark, f"{table.rstrip('/')}/batch_id={batch_id}"):
                return batch_id
            holder = "an earlier version"
        else:
            holder = read_mark(spark, folder, f"id-{batch_id}")
        if holder != source:
            raise ValueError(f"batch {batch_id} of {table} holds {holder!r}; give another batch or none")
        return batch_id
    taken = _numbers(names(spark, folder), r"id-(\d+)") + _numbers(names(spark, table), r"batch_id=(\d+)")
    batch = max((b for b in taken if b < _RANGE), default=-1) + 1
    while not write_mark(spark, folder, f"id-{batch}", source):
        batch += 1
    return batch


def stream_batch(spark: SparkSession, table: str, stream_id: str, micro_batch: int) -> int:
    """The batch of a micro-batch, in a range that only this stream writes.

    A stream is known by the id that Spark keeps in its checkpoint, so a repeated
    micro-batch finds its folder again and a new checkpoint never meets it.
    """
    folder = _folder(table)
    own = _numbers(names(spark, folder), r"stream-(\d+)")
    for number in own:
        if read_mark(spark, folder, f"stream-{number}") == stream_id:
            return number * _RANGE + micro_batch
    number = max(own, default=0) + 1
    while not write_mark(spark, folder, f"stream-{number}", stream_id):
        number += 1
    return number * _RANGE + micro_batch


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id of the stream that a checkpoint belongs to."""
    return read_mark(spark, checkpoint.rstrip("/"), "metadata")


def record_top(spark: SparkSession, table: str, batch_id: int, top: int | None) -> None:
    """Note the highest id of a batch that was just written.

    A batch that is run again may leave several notes; the highest counts. Nothing is listed.
    """
    write_mark(spark, _folder(table), f"top-{batch_id}-{'none' if top is None else top}")


def highest_id(spark: SparkSession, table: str, skip: int | None = None) -> tuple[int | None, list[int]]:
    """The highest id noted, and the batches without a note; ``skip`` is about to be rewritten."""
    notes = [m for m in (re.fullmatch(r"top-(\d+)-(none|-?\d+)", n) for n in names(spark, _folder(table))) if m]
    tops = [int(m[2]) for m in notes if m[2] != "none" and int(m[1]) != skip]
    noted = {int(m[1]) for m in notes} | {skip}
    stored = _numbers(names(spark, table), r"batch_id=(\d+)")
    return max(tops, default=None), [b for b in stored if b not in noted]
