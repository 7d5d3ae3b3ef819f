"""Every operator on nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns."""

import pytest
from odd_documents import ODD, documents  # noqa: F401
from pyspark.sql import functions as F

import corpus_pipeline
from sievelog.llm import (
    chat_format,
    exact_dedup,
    language_id,
    minhash_dedup,
    mixing,
    passage_dedup,
    quality_rules,
    secret_scan,
    sentencepiece_codec,
    toxicity,
)


@pytest.fixture(scope="module")
def pieces(spark):
    return sentencepiece_codec.load_model(spark)


def operators(spark, pieces):
    def language(d):
        return language_id.identify(d.select("doc_id", "text"), language_id.fit(d))

    def toxic(d):
        labels = d.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic"))
        return toxicity.score(d, *toxicity.fit(toxicity.training_rows(d, labels)))

    return {
        "language": language,
        "mixing": mixing.mix_sources,
        "pieces": lambda d: sentencepiece_codec.encode_documents(d, pieces),
        "toxicity": toxic,
        "exact": exact_dedup.exact_duplicates,
        "passages": passage_dedup.remove_repeats,
        "near": minhash_dedup.near_duplicates,
        "near_counts": lambda d: minhash_dedup.near_duplicates(d, weights="count"),
        "secrets": secret_scan.secret_spans,
        "quality": quality_rules.quality_rules,
    }


NAMES = ["language", "mixing", "pieces", "toxicity", "exact", "passages", "near", "near_counts", "secrets", "quality"]


@pytest.mark.parametrize("name", NAMES)
def test_odd_rows_each_get_a_row(spark, documents, pieces, name):
    out = operators(spark, pieces)[name](documents(ODD)).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in out) == sorted((r[0] is None, r[0] or 0) for r in ODD)


@pytest.mark.parametrize("name", NAMES)
def test_empty_tables(spark, documents, pieces, name):
    assert operators(spark, pieces)[name](documents(ODD).where("false")).count() == 0


def test_stages_keep_the_columns(spark, documents):
    docs = documents(ODD)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, "")
        assert out.columns == docs.columns, name
        out.collect()
        assert stage(spark, docs.where("false"), "").count() == 0, name


def test_exact_ties(documents):
    rows = exact_dedup.exact_duplicates(documents(ODD)).collect()
    same = [r for r in rows if r.group_size == 4]
    assert len(same) == 4 and {r.keep_id for r in same} == {4} and sum(r.kept for r in same) == 1
    assert sum(r.kept for r in rows) == len({r.text_sha256 for r in rows})
    empty = {r.doc_id: r.keep_id for r in rows if r.doc_id in (1, 2, 3)}
    assert empty == {1: 1, 2: 1, 3: 3}  # null is empty; blanks are one space


def test_near_ties(documents):
    rows = minhash_dedup.near_duplicates(documents(ODD)).collect()
    same = [r for r in rows if r.class_size == 4]
    assert len(same) == 4 and {r.class_id for r in same} == {4} and sum(r.kept for r in same) == 1
    assert all(r.kept and r.class_id == r.doc_id for r in rows if r.doc_id in (1, 2, 3))


def test_chat_odd_rows(spark):
    rows = [(1, 0, None, None), (1, None, "user", "x"), (None, 1, "assistant", "y"), (2, 0, "a\nb", ""), (2, 0, "a\nb", "")]
    talk = spark.createDataFrame(rows, "conv_id BIGINT, turn BIGINT, role STRING, text STRING")
    out = {r.conv_id: r for r in chat_format.read_back(chat_format.chat_windows(talk)).collect()}
    assert {k: r.n_turns for k, r in out.items()} == {1: 2, None: 1, 2: 2}
    assert out[None].loss_chars == 1
    assert chat_format.read_back(chat_format.chat_windows(talk.where("false"))).count() == 0
