"""Fill-in-the-middle, byte-level BPE and the filter audit against plain Python and the public library."""

import hashlib
import random
import re
import time
from itertools import permutations

import numpy as np
import pyarrow as pa
import pytest
from odd_documents import ODD, documents  # noqa: F401
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sievelog.llm import bpe_codec, exact_dedup, fill_in_middle, filter_audit, language_id, quality_rules, queries, toxicity

SF = "/root/testdata/sf0.001"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
MARKED = [(20 + i, f"some text {m} with a marker\nand a line\n\n  end ", "en", "a") for i, m in enumerate(("<P>", "<S>", "<M>", "<P", "<|endoftext|>"))]


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


# ---- fill in the middle -----------------------------------------------------------


@pytest.mark.parametrize("n", [0, 1, 63, 64, 65, 1000])
def test_ranks_of_a_wavelet_matrix(n):
    symbols = np.random.default_rng(n).integers(0, 8, n).astype(np.uint8)
    matrix = fill_in_middle.WaveletMatrix(symbols)
    for c in range(8):
        want = [int((symbols[:i] == c).sum()) for i in range(n + 1)]
        assert matrix.rank(c, np.arange(n + 1)).tolist() == want


def pieces(text: str, unit: str) -> list[str]:
    """The units of a text, what stands before the first one apart, so that all joined is the text."""
    if unit == "char":
        return ["", *text]
    if unit == "line":
        return ["", *re.findall(r"[^\n]*\n|[^\n]+\Z", text)]
    starts = [m.start() for m in WORDS.finditer(text)]
    if not starts:
        return [text]
    return [text[: starts[0]]] + [text[a:b] for a, b in zip(starts, [*starts[1:], len(text)], strict=True)]


def expected_cut(doc_id, text, unit):
    h = [int(hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()[8 * i : 8 * i + 8], 16) for i in range(4)]
    parts = pieces(text, unit)
    n = len(parts) - 1
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    ends = ["".join(parts[: k + 1]) if k or unit == "word" else "" for k in (a, b)]
    if unit == "word" and n == 0:
        ends = [text, text]
    prefix, middle = ends[0], ends[1][len(ends[0]) :]
    suffix = text[len(ends[1]) :]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    if h[3] % 100 < 20:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


@pytest.mark.parametrize("unit", ["char", "word", "line"])
def test_cuts_equal_brute_force(spark, documents, unit, monkeypatch):  # noqa: F811
    monkeypatch.setattr(fill_in_middle, "CHUNK", 5_000)
    rng = random.Random(3)
    alphabet = "ab \n\t<é漢😀"
    more = [(100 + i, "".join(rng.choices(alphabet, k=rng.randint(0, 40))), "en", "a") for i in range(200)]
    rows = ODD + MARKED + more
    cut = fill_in_middle.fill_in_middle(documents(rows), unit=unit)
    got = cut.withColumn("again", fill_in_middle.restored_text(F.col("output"), F.col("form"))).collect()
    assert len(got) == len(rows)
    want = sorted(((r[0], r[1] or ""), expected_cut(r[0], r[1] or "", unit)) for r in rows if r[0] is not None)
    have = sorted(((r.doc_id, r.again), (r.n, r.form, r.prefix_chars, r.middle_chars, r.output)) for r in got if r.doc_id is not None)
    assert have == want
    assert sorted(r.again for r in got if r.doc_id is None) == sorted(r[1] for r in rows if r[0] is None)
    assert {r.form for r in got} == {"plain", "psm", "spm"}


def test_parameters_of_cuts(spark, documents):  # noqa: F811
    docs = documents(ODD + MARKED)
    assert {r.form for r in fill_in_middle.fill_in_middle(docs, fim_percent=0).collect()} == {"plain"}
    assert {r.form for r in fill_in_middle.fill_in_middle(docs, fim_percent=100, spm_percent=100).collect()} == {"plain", "spm"}
    assert fill_in_middle.fill_in_middle(docs.where("false")).count() == 0
    own = ("[pre]", "[suf]", "[mid]")
    cut = fill_in_middle.fill_in_middle(docs, markers=own, seed="x")
    again = cut.select("doc_id", fill_in_middle.restored_text(F.col("output"), F.col("form"), own).alias("t")).collect()
    assert sorted(r.t for r in again) == sorted(r[1] or "" for r in ODD + MARKED)
    for bad in (("<P>", "<P>", "<M>"), ("aba", "<S>", "<M>"), ("ab", "bc", "x"), ("", "<S>", "<M>")):
        with pytest.raises(ValueError, match="markers"):
            fill_in_middle.fill_in_middle(docs, markers=bad)
    with pytest.raises(ValueError, match="unit"):
        fill_in_middle.fill_in_middle(docs, unit="page")


# ---- byte-level BPE ---------------------------------------------------------------


@pytest.fixture(scope="module")
def vocabulary(spark):
    return bpe_codec.load_vocabulary(spark)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(bpe_codec.VOCABULARY)


def ids_of(codec, text):
    return np.frombuffer(codec.encode(text), np.int32).tolist()


def test_tokens_equal_the_library(vocabulary, library, monkeypatch):
    monkeypatch.setattr(bpe_codec, "REMEMBERED", 50)
    codec, rng = bpe_codec.Codec(vocabulary), random.Random(5)
    newer = vocabulary.newer
    alphabet = [*"abcXYZ 019'_.,!\n\t\r\x0b\x1c\x00", "'s", "'ll", "  ", "é", "ß", "²", "¾", "ª", "\x85", "\xa0", " ", "ʼ", "漢", "😀", "́", "٣", "Ⅷ",
                "<|endoftext|>", "<|endof", newer[0], newer[len(newer) // 2], newer[-1]]
    texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 30))) for _ in range(4000)]
    texts += ["a" * 5000, "ab" * 3000, "<|endoftext|>" * 3, " <|endoftext|> ", "x" + " " * 3000 + "y", "é" * 999, "!?" * 800]
    for text in texts:
        want = library.encode(text, add_special_tokens=False).ids
        assert ids_of(codec, text) == want, text
        assert codec.decode(want) == library.decode(want, skip_special_tokens=False) == text


def test_every_character_is_parted_as_the_library_parts_it(vocabulary, library):
    codec = bpe_codec.Codec(vocabulary)
    chars = [chr(c) for c in range(1, 0x30000, 1) if not 0xD800 <= c < 0xE000]
    for at in range(0, len(chars), 64):
        text = " ".join(f"a{c}b1{c}2.{c}," for c in chars[at : at + 64])
        assert ids_of(codec, text) == library.encode(text, add_special_tokens=False).ids, at


def test_long_texts_are_parted_piece_by_piece(vocabulary, monkeypatch):
    codec = bpe_codec.Codec(vocabulary)
    text = "some words 12, and\n\n  more é of them " * 300
    whole = codec.encode(text)
    monkeypatch.setattr(bpe_codec, "LONG_TEXT", 100)
    monkeypatch.setattr(bpe_codec, "WORDS_AT_ONCE", 7)
    assert codec.encode(text) == whole


def test_coded_documents(spark, documents, vocabulary, library):  # noqa: F811
    rows = ODD + MARKED
    docs = documents(rows)
    coded = bpe_codec.encode_documents(docs, vocabulary)
    back = bpe_codec.decode_documents(coded.withColumn("text", F.lit(1)), vocabulary)
    assert back.columns == ["doc_id", "n_tokens", "text"]
    want = sorted((r[0] is None, r[0] or 0, len(library.encode(r[1] or "", add_special_tokens=False).ids), r[1] or "") for r in rows)
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens, r.text) for r in back.collect()) == want
    assert bpe_codec.encode_documents(docs.where("false"), vocabulary).count() == 0
    odd = spark.createDataFrame([(None, "x"), ([], "x"), ([50256, 128, 64], "x")], "ids array<int>, `a b` string")
    got = [(r["a b"], r.text) for r in bpe_codec.decode_documents(odd, vocabulary).collect()]
    assert sorted(got) == sorted(("x", t) for t in ("", "", library.decode([50256, 128, 64], skip_special_tokens=False)))


def test_lists_of_ids_are_not_taken_apart_one_by_one():
    rng = np.random.default_rng(3)
    rows = [None, [], [7], None, *(rng.integers(0, 50257, rng.integers(0, 2000)).tolist() for _ in range(500)), [], None]
    for kind in (pa.list_(pa.int32()), pa.list_(pa.int64()), pa.large_list(pa.int32())):
        column = pa.array(rows, kind)
        for at, size in ((0, len(rows)), (0, 1), (1, 4), (3, 300), (len(rows), 1)):
            assert list(bpe_codec._lists(column.slice(at, size))) == [ids or [] for ids in column.slice(at, size).to_pylist()]

    def seconds(work):
        start = time.process_time()
        work()
        return time.process_time() - start

    # Numbers made one by one took most of the time of decoding, many times what they take at once.
    assert 3 * min(seconds(lambda: list(bpe_codec._lists(column))) for _ in range(3)) < min(seconds(column.to_pylist) for _ in range(3))
    with pytest.raises(ValueError, match="null"):
        list(bpe_codec._lists(pa.array([[1], [2, None]])))


def test_bpe_query(spark, library):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    out = queries.op12_bpe(spark, SF).collect()
    assert len(out) == len(texts)
    for r in out:
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256) == (len(ids), sha(",".join(map(str, ids))))
        assert r.decoded_sha256 == sha(library.decode(ids, skip_special_tokens=False))


# ---- filter audit -----------------------------------------------------------------


def expected_failures(rows, labels):
    out = []
    for doc_id, text, _, part in rows:
        text = text or ""
        words = WORDS.findall(text)
        smaller = any(r[0] is not None and doc_id is not None and r[0] < doc_id and (r[1] or "") == text for r in rows)
        fails = {
            "A": len(words) < 50, "B": 100 * len(set(words)) < 65 * len(words),
            "C": 100 * sum("A" <= c <= "Z" for c in text) > 5 * len(text), "D": any(c in "#$%&*|" for c in text), "E": smaller,
        }
        known = [x for x in labels if x[0] == doc_id and doc_id is not None]
        out.append((doc_id, part or "", any(x[1] == 1 for x in known), any(x[2] == 1 for x in known), frozenset(k for k, v in fails.items() if v)))
    return out


def expected_audit(failed):
    out = {}
    for part in {r[1] for r in failed}:
        own, total = [r for r in failed if r[1] == part], {}
        for order in map("".join, permutations("ABCDE")):
            left = own
            for step, letter in enumerate(order, 1):
                gone = [r for r in left if letter in r[4]]
                fail = [r for r in own if letter in r[4]]
                left = [r for r in left if letter not in r[4]]
                total[letter] = total.get(letter, 0) + len(gone)
                out[part, order, step] = [len(left), len(gone), len(fail) - len(gone), sum(r[4] == {letter} for r in own), sum(r[2] for r in gone), sum(r[3] for r in gone)]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(total[order[step - 1]])
    return {k: tuple(v) for k, v in out.items()}


def audit_rows():
    rng = random.Random(11)
    words = ["fine", "Words", "stand", "HERE", "money$", "of", "a", "b", "c"] + [f"w{i}" for i in range(80)]
    texts = [" ".join(rng.choices(words, k=rng.randint(0, 90))) for _ in range(25)] + ["", None]
    rows = [(rng.choice([None, *range(1, 60)]), rng.choice(texts), "en", rng.choice(["a", "b", "", None])) for _ in range(150)]
    labels = [(rng.choice([None, *range(1, 70)]), rng.choice([0, 1, None]), rng.choice([0, 1, None])) for _ in range(60)]
    return ODD + rows + [(i, "copied text", "en", "hot") for i in range(80)], labels


HASHES = {"xxhash64": F.xxhash64, "constant": lambda t: F.lit(1), "length": lambda t: F.length(t) % 7}


@pytest.mark.parametrize("name", HASHES)
def test_failures_and_audit_equal_brute_force(spark, documents, name):  # noqa: F811
    rows, marks = audit_rows()
    labels = spark.createDataFrame(marks, "doc_id BIGINT, quality INT, toxic INT").withColumn("part", F.lit(9))
    failed = filter_audit.failures(documents(rows), labels, text_hash=HASHES[name])
    want = expected_failures(rows, marks)
    got = [(r.doc_id, r.part, r.good, r.toxic, frozenset(k for k, b in filter_audit.BIT.items() if r.bits & b)) for r in failed.collect()]
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2], r[3], sorted(r[4]))
    assert sorted(got, key=key) == sorted(want, key=key)
    if name == "xxhash64":
        out = filter_audit.audit(failed).collect()
        have = {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in out}
        assert len(out) == len(have) and have == expected_audit(want)


def test_audit_of_an_empty_table(spark, documents):  # noqa: F811
    labels = spark.createDataFrame([], "doc_id BIGINT, quality INT, toxic INT")
    assert filter_audit.filter_audit(documents(ODD).where("false"), labels).count() == 0
    assert filter_audit.filter_audit(documents(ODD), labels).agg(F.sum("good_lost") + F.sum("toxic_lost")).first()[0] == 0


# ---- exact duplicates: groups are those of the index ------------------------------


def expected_groups(rows):
    out = {}
    for doc_id, text, *_ in rows:
        out.setdefault(exact_dedup.normalised(text or ""), []).append(doc_id)
    return {doc_id: (min((i for i in ids if i is not None), default=None), len(ids)) for ids in out.values() for doc_id in ids if doc_id is not None}


@pytest.mark.parametrize("seen", [0, 64 << 20])
def test_colliding_digests_keep_texts_apart(spark, documents, monkeypatch, seen):  # noqa: F811
    monkeypatch.setattr(exact_dedup, "SEEN_BYTES", seen)
    rows = ODD + [(100 + i, f"text {i % 9}", "en", "a") for i in range(60)]
    digest = lambda body: hashlib.sha256(body[:1]).digest()
    out = exact_dedup.exact_duplicates(documents(rows), digest=digest).collect()
    assert len(out) == len(rows) and max(r.chain for r in out) >= 8
    assert {r.doc_id: (r.keep_id, r.group_size) for r in out if r.doc_id is not None} == expected_groups(rows)
    assert sum(r.kept for r in out) == len({exact_dedup.normalised(r[1] or "") for r in rows})


def test_the_index_decides(spark, documents, monkeypatch):  # noqa: F811
    rows = [(i, f"text {i % 3}", "en", "a") for i in range(12)]
    plain = exact_dedup.build_index
    monkeypatch.setattr(exact_dedup, "build_index", lambda *a, **k: plain(*a, **k).withColumns({"bucket": F.lit(""), "key": F.lit(0), "chain": F.lit(0)}))
    out = exact_dedup.exact_duplicates(documents(rows)).collect()
    assert {(r.keep_id, r.group_size) for r in out} == {(0, 12)}


# ---- toxicity: pairs of mentions --------------------------------------------------


def test_neutral_mentions_move_no_score(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    sample = toxicity.training_rows(docs, labels)
    weights, bias, pairs = toxicity.fit_with_pairs(sample)
    assert pairs >= sample.count() > 0 and toxicity.fit(sample) == (weights, bias)
    mentions = [t for group in toxicity.IDENTITY_TERMS for t in group]
    scores = lambda add: {r.doc_id: r.score for r in toxicity.score(
        docs.withColumn("text", F.concat("text", F.lit(f" {add}"))), weights, bias).collect()}
    plain = scores("")
    for term in (*mentions[::9], " ".join(mentions[:6])):
        moved = scores(term)
        assert max(abs(moved[i] - plain[i]) for i in plain) < toxicity.MENTION_BOUND, term
    assert all(0.25 * sum(weights.get(f, 0.0) for f in toxicity.features({t})) < toxicity.MENTION_BOUND for t in mentions)


# ---- language: clashing names -----------------------------------------------------


def test_columns_named_like_what_is_told_are_replaced(spark, documents):  # noqa: F811
    docs = documents(ODD).withColumn("accepted", F.lit("x"))  # score and lang_pred are there, too
    model = language_id.fit(docs)
    out = language_id.identify(docs, model)
    assert len({c.lower() for c in out.columns}) == len(out.columns) == len(docs.columns)
    rows = out.select("doc_id", "lang_pred", "score", "accepted").collect()
    assert len(rows) == len(ODD) and {type(r.accepted) for r in rows} == {bool}
    with pytest.raises(ValueError, match="other names"):
        language_id.identify(docs, model, names=("text", "score", "accepted"))


# ---- quality of domains -----------------------------------------------------------


def test_domains_of_urls(spark):
    urls = [("http://A.b.Example.com/x?y", "example.com"), ("https://u:p@m.site.org:80#t", "site.org"), ("no url", ""), (None, None), ("ftp://host", "host")]
    rows = spark.createDataFrame(urls, "url string, want string").select(quality_rules.domain_of(F.col("url")).alias("got"), "want").collect()
    assert all(r.got == r.want for r in rows)


def test_some_domains_fail(spark):
    out = queries.quality_rules_by_domain(spark, "/root/testdata/sf0.01").collect()
    lost = [r for r in out if r.host_failed and not r.base_failed]
    assert lost and not any(r.kept for r in lost) and sum(r.kept for r in out) > len(out) / 2
