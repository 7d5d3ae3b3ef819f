"""Documents with everything that could go wrong, and a fixture that makes tables of such rows."""

import pytest
from pyspark.sql import functions as F

DOCUMENTS = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars INT"


@pytest.fixture(scope="session")
def documents(spark):
    """Makes documents of (doc_id, text, lang, source), with further columns whose names clash."""

    def make(rows, extra=True):
        df = spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], DOCUMENTS).repartition(3)
        if extra:
            more = ("row", "id", "at", "key", "kept", "score", "lang_pred", "_accepted", "size", "target", "node", "place", "sha")
            for name in more:
                df = df.withColumn(name, F.lit(7))
        return df

    return make


#: Nulls, empty and blank texts, ties, repeated rows, a long text, odd characters.
ODD = [
    (1, None, None, None),
    (2, "", "en", "a"),
    (3, " \t\n ", "en", "a"),
    (4, "one two three four five six seven", "en", None),
    (5, "one two three four five six seven", "fr", "b"),
    (5, "one two three four five six seven", "fr", "b"),
    (None, "one  two three\nfour five six seven", None, "b"),
    (None, "no id at all, and nothing like it", "de", "c"),
    (6, "Ünïcödé \U0001f600 ▁ mark \x00 nul <|im_end|>", "de", "c"),
    (7, "word " * 30_000, "en", "a"),
    (8, "!!! 123 ###", "en", "a"),
]
