"""Language identification by compression with a dictionary of each language.

A language is a zstandard raw-content dictionary: the text of a bounded sample of its
labelled documents, in lower case and with one space for all that is no letter, filled up in
front to the length of the longest. A document
is made plain in the same way and cut into blocks, every block is compressed with every
dictionary, and the language with the fewest bytes over all blocks wins. Its lead over the
second is the margin; a narrow one rejects the document.
"""

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievelog.llm.common import free_name

#: Documents of a language, characters of each and bytes of all that a dictionary may take.
SAMPLE_ROWS = 400
SAMPLE_CHARS = 1_000
DICTIONARY_BYTES = 110_000
#: Bytes that are compressed at once, and what is put after them: zstandard stores a block
#: as it is where it gains almost nothing, and then all dictionaries would tie.
BLOCK = 4_096
CARRIER = b"0" * 64
LEVEL = 6
#: Stands before the text of a language that has less than the others; no plain text holds it.
FILLER = b"\0"
#: Bytes below which zstandard takes no dictionary.
LEAST = 8
#: A lead below this share of the second size rejects; 0.002 is two bytes in a thousand.
MARGIN = 0.002
UNKNOWN = "und"


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    dictionaries: tuple[bytes, ...]


_OTHER = re.compile(r"[\W\d_]+")


def _has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def plain_letters(text: str) -> bytes:
    return f" {_OTHER.sub(' ', text.lower()).strip()} ".encode("utf-8", "replace")


def fit(labelled: DataFrame, text_col="text", lang_col="lang") -> LanguageModel:
    """Dictionaries from ``SAMPLE_ROWS`` documents of each language, chosen by a hash of the text.

    Rows without text or language are left out. The share of rows looked at follows from
    the counts, so no more than a few times the sample is ever sorted.
    """
    rows = labelled.where(F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}"))
    counts = labelled.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).groupBy(lang_col).count()
    share = counts.select(F.col(lang_col).alias("l"), (4.0 * SAMPLE_ROWS / F.col("count")).alias("share"))
    draw = F.pmod(F.xxhash64(text_col, F.lit(1)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    near = rows.join(F.broadcast(share), F.col(lang_col) == F.col("l")).where(draw < F.col("share"))  # a row per language
    order = Window.partitionBy("lang").orderBy("draw", "text")
    sample = (
        near.select(F.col(lang_col).cast("string").alias("lang"), F.substring(text_col, 1, SAMPLE_CHARS).alias("text"), draw.alias("draw"))
        .distinct()
        .withColumn("n", F.row_number().over(order))
        .where(F.col("n") <= SAMPLE_ROWS)
    )
    texts: dict[str, list[tuple[int, str]]] = {}
    for row in sample.collect():  # SAMPLE_ROWS short texts of each language
        texts.setdefault(row["lang"], []).append((row["n"], row["text"]))
    languages = tuple(sorted(texts))
    bodies = [b"".join(plain_letters(t) for _, t in sorted(texts[x])) for x in languages]
    size = min(DICTIONARY_BYTES, max([LEAST, *map(len, bodies)]))  # alike, so that none wins by its size
    return LanguageModel(languages, tuple(b[:size].rjust(size, FILLER) for b in bodies))


class Classifier:
    """Sizes of a text under every dictionary of a model."""

    def __init__(self, model: LanguageModel):
        plain = {"level": LEVEL, "write_checksum": False, "write_content_size": False, "write_dict_id": False}
        self.languages = model.languages
        self.coders = []
        for body in model.dictionaries:
            if len(body) < LEAST:
                self.coders.append(zstandard.ZstdCompressor(**plain))
                continue
            kept = zstandard.ZstdCompressionDict(body, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            kept.precompute_compress(level=LEVEL)
            self.coders.append(zstandard.ZstdCompressor(dict_data=kept, **plain))
        self.bare = zstandard.ZstdCompressor(**plain)

    def sizes(self, coders, raw: bytes) -> list[int]:
        blocks = [raw[i : i + BLOCK] + CARRIER for i in range(0, len(raw), BLOCK)]
        return [sum(len(c.compress(b)) for b in blocks) for c in coders]

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, lead over the second as a share of its size, accepted."""
        if not text or not self.languages or not _has_letter(text):
            return UNKNOWN, 0.0, False
        raw = plain_letters(text)
        sizes = self.sizes(self.coders, raw)
        order = sorted(range(len(sizes)), key=lambda i: (sizes[i], self.languages[i]))
        best = order[0]
        second = sizes[order[1]] if len(order) > 1 else max(self.sizes([self.bare], raw)[0], sizes[best])
        lead = (second - sizes[best]) / second
        return self.languages[best], lead, lead >= MARGIN


def identify(docs: DataFrame, model: LanguageModel, text_col="text", names=("lang_pred", "score", "accepted")) -> DataFrame:
    """``docs`` with three columns more, called ``names``; reads nothing but the text.

    Null, empty and letterless texts are ``und`` with score 0 and rejected, as is every
    text if no language was learned; equal leads go to the first name. Texts of any length
    are read whole, repeated rows are told each, an empty table gives an empty one. A column
    of ``docs`` that is named like one of the three is replaced; the text cannot be.
    """
    taken = {n.lower() for n in names}
    if text_col.lower() in taken:
        raise ValueError(f"give other names than {text_col!r} for what is told")
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in taken])
    columns = docs.columns
    at = columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Classifier(model)
        for batch in batches:
            found = [judge.predict(t) for t in batch.column(at).to_pylist()]
            lang, score, accepted = ([x[i] for x in found] for i in range(3))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(accepted, pa.bool_())],
                names=[*columns, *names],
            )

    more = [T.StructField(n, t) for n, t in zip(names, (T.StringType(), T.DoubleType(), T.BooleanType()), strict=True)]
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *more]))


def accepted_rows(docs: DataFrame, learnable: Column, text_col="text", lang_col="lang") -> DataFrame:
    """The rows of ``docs`` whose language is told with a margin; learns from ``learnable`` rows."""
    model = fit(docs.where(learnable), text_col, lang_col)
    names = [free_name(docs, n) for n in ("_lang_pred", "_score", "_accepted")]
    told = identify(docs, model, text_col, names).where(F.col(names[-1]))
    return told.select(*[F.col(f"`{c}`") for c in docs.columns])
