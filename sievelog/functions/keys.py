"""Placement and identity of rows."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from sievelog.schema import DEFAULT_SHARDS


def shard_id(log_id: Column, shards: int = DEFAULT_SHARDS) -> Column:
    """Shard of a row: both halves of the id folded to a signed 32-bit number, modulo.

    Done in 64 bits, since a narrowing cast raises under ANSI mode.
    """
    if shards <= 0:
        raise ValueError("shards must be positive")
    folded = log_id.bitwiseXOR(F.shiftrightunsigned(log_id, 32)).bitwiseAND(F.lit(0xFFFFFFFF))
    signed = F.when(folded >= F.lit(2**31), folded - F.lit(2**32)).otherwise(folded)
    return F.pmod(signed, F.lit(shards).cast("bigint"))


def row_key() -> Column:
    """Hash of the row's text fields; with id and time it tells rows of one id apart.

    The hash skips nulls, so which fields are null is hashed too. Two rows are mistaken
    for each other only if id, millisecond and 64-bit hash agree.
    """
    fields = ("timestamp", "level", "service", "message")
    return F.xxhash64(*fields, *[F.isnull(c) for c in fields])


def stretch(rows: int) -> Column:
    """Number of the stretch of ``rows`` rows a row lies in within its input partition.

    Copies of one row compress so well that a single file split can hold most of them.
    As a further key of a shuffle this takes them apart; splits of ordinary length are
    one stretch. The rows must come from files, where their order is the same on a retry.
    """
    in_partition = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return F.floor(in_partition / F.lit(rows))
