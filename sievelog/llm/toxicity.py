"""Toxicity by a logistic model over words that is regularised with counterfactuals.

The model is fitted on a bounded sample of labelled documents. Each gives counterfactual
pairs. Where it names a group, every identity term is swapped for another of its group;
where it names none, a term is put in at a place chosen by a hash, and that text is paired
with the one that has another term there and with the text as it was. Besides the usual
loss the fit pays for the square of the difference between the scores of a pair, so a
neutral mention of a group moves no score, whether or not the labelled texts name groups.
"""

import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievelog.llm.common import materialise

#: Terms that may stand for each other in a counterfactual.
IDENTITY_TERMS = (
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino", "arab", "african"),
    ("gay", "straight", "lesbian", "bisexual", "transgender", "queer"),
    ("woman", "man"), ("women", "men"), ("female", "male"), ("girl", "boy"),
    ("deaf", "blind", "disabled"), ("old", "young"), ("immigrant", "foreigner", "refugee"),
    ("frau", "mann"), ("frauen", "männer"), ("jude", "christ", "muslim"),
    ("femme", "homme"), ("femmes", "hommes"), ("juif", "chrétien", "musulman"),
    ("mujer", "hombre"), ("mujeres", "hombres"), ("judío", "cristiano", "musulmán"),
)
SWAP = {t: [o for o in group if o != t] for group in reversed(IDENTITY_TERMS) for t in group}
#: Labelled rows the model may learn from, and words it may know: the bound of the fit.
TRAIN_ROWS = 12_000
VOCABULARY = 60_000
#: Beginnings of words that are features too, by their length.
STEMS = (4, 6)
#: A feature must stand in this share of the sampled documents, and in three of them.
LEAST_SHARE = 0.0015
RIDGE = 4.0
FAIRNESS = 50.0
#: What one mention of a group, added to any text, may move its score by, at most.
MENTION_BOUND = 0.01
STEPS = 120
#: Times a toxic document counts in the fit.
TOXIC_WEIGHT = 6.0

_TERMS = sorted(SWAP)
_WORD = re.compile(r"\w+")


def words_of(text: str | None) -> set[str]:
    return set(_WORD.findall(text.lower())) if text else set()


def features(words: set[str]) -> set[str]:
    """The words and, marked by a hyphen, the beginnings of the longer ones."""
    return words.union(*({w[:k] + "-" for w in words if len(w) > k} for k in STEMS))


def twin(words: set[str], pick: int) -> set[str]:
    """The words with each identity term swapped for another of its group."""
    return {SWAP[w][pick % len(SWAP[w])] if w in SWAP else w for w in words}


def pairs_of(words: set[str]) -> list[tuple[set[str], set[str]]]:
    """The counterfactual pairs of a text: two sets of words each.

    A model over sets of words does not see at which place a term is put in, so only the
    term is drawn, by a hash of the text's words.
    """
    if not SWAP.keys().isdisjoint(words):
        return [(words, twin(words, len(words)))]
    draw = crc32(" ".join(sorted(words)).encode())
    term = _TERMS[draw % len(_TERMS)]
    other = SWAP[term][draw // len(_TERMS) % len(SWAP[term])]
    return [(words | {term}, words | {other}), (words | {term}, words)]


def training_rows(docs: DataFrame, labels: DataFrame, id_col="doc_id", text_col="text", label_col="toxic",
                  rows=TRAIN_ROWS) -> DataFrame:
    """label and words of at most about ``rows`` labelled documents, chosen by a hash of the id.

    An id with several labels counts as toxic if one of them says so.
    """
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
    known = known.groupBy(F.col(id_col).alias("l_id")).agg(F.max(label_col).cast("int").alias("label"))
    known = materialise(known, "toxicity-labels")
    share = rows / max(known.count(), 1)
    draw = F.pmod(F.xxhash64("l_id", F.lit(7)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = known.where(draw < share)  # about ``rows`` rows of two numbers
    found = docs.join(F.broadcast(sample), F.col(id_col) == F.col("l_id")).select("label", F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([sorted(words_of(t)) for t in batch.column(1).to_pylist()], pa.list_(pa.string()))],
                names=["label", "words"],
            )

    return materialise(found.mapInArrow(run, "label int, words array<string>"), "toxicity-sample")


def fit(sample: DataFrame) -> tuple[dict[str, float], float]:
    """Weight of each known word, and the intercept; an empty or one-sided sample scores by its share."""
    return fit_with_pairs(sample)[:2]


def fit_with_pairs(sample: DataFrame) -> tuple[dict[str, float], float, int]:
    """:func:`fit`, and the number of counterfactual pairs that held the fit down."""
    n_pos, n = sample.agg(F.coalesce(F.sum("label"), F.lit(0)), F.count("*")).first()
    if n_pos in (0, n):
        return {}, float(np.log((n_pos + 0.5) / (n - n_pos + 0.5))), 0
    marked = F.concat("words", *[F.array_distinct(F.transform(F.filter("words", _longer(k)), _stem(k))) for k in STEMS])
    held = sample.select(F.explode(marked).alias("word")).groupBy("word").count()
    held = held.where(F.col("count") >= max(3, n * LEAST_SHARE)).orderBy(F.desc("count"), "word").limit(VOCABULARY)
    # Up to VOCABULARY words, and the terms with their beginnings.
    vocabulary = list(dict.fromkeys([r["word"] for r in held.collect()] + sorted(features(set(SWAP)))))
    at = {w: i for i, w in enumerate(vocabulary)}

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [set(r) for r in batch.column(1).to_pylist()]
            # Of a pair only the features that differ count.
            apart = [[numbers(x - y) for a, b in pairs_of(r) for x, y in _both(features(a), features(b))] for r in rows]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([numbers(features(r)) for r in rows], pa.binary()), pa.array(apart, pa.list_(pa.binary()))],
                names=["label", "own", "apart"],
            )

    def numbers(found: set[str]) -> bytes:
        return np.array(sorted(at[w] for w in found if w in at), dtype=np.int32).tobytes()

    # TRAIN_ROWS rows of word numbers
    rows = sample.mapInArrow(index, "label int, own binary, apart array<binary>").collect()
    rows.sort(key=lambda r: (bytes(r["own"]), r["label"]))
    y = np.array([r["label"] for r in rows], dtype=float)
    own = [np.frombuffer(r["own"], np.int32) for r in rows]
    apart = [np.frombuffer(x, np.int32) for r in rows for x in r["apart"]]
    weights, bias = _descend(own, y, apart[::2], apart[1::2], len(vocabulary))
    return {w: float(weights[i]) for w, i in at.items() if weights[i]}, float(bias), len(apart) // 2


def _both(a, b):
    return (a, b), (b, a)


def _longer(k: int):
    return lambda w: F.length(w) > k


def _stem(k: int):
    return lambda w: F.concat(F.substring(w, 1, k), F.lit("-"))


class _Rows:
    """Sparse rows of ones."""

    def __init__(self, rows: list[np.ndarray]):
        self.columns = np.concatenate(rows or [np.zeros(0, np.int32)])
        self.row = np.repeat(np.arange(len(rows), dtype=np.int32), [len(r) for r in rows])
        self.n = len(rows)

    def times(self, w):
        return np.bincount(self.row, weights=w[self.columns], minlength=self.n)

    def back(self, r, width):
        return np.bincount(self.columns, weights=r[self.row], minlength=width)


def _descend(own, y, left, right, width):
    """Logistic loss + ridge + FAIRNESS * squared difference of each pair, by Adam on all rows.

    ``left`` and ``right`` hold the features that only one side of a pair has. No weight is
    below zero: in a long text no number of harmless words excuses an insult.
    """
    x, a, b_ = _Rows(own), _Rows(left), _Rows(right)
    weight = np.where(y > 0, TOXIC_WEIGHT, 1.0)
    w, b = np.zeros(width), float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5)))
    m, v = np.zeros(width + 1), np.zeros(width + 1)
    for step in range(1, STEPS + 1):
        z = x.times(w) + b
        r = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) * weight
        gap = FAIRNESS * 2 * (a.times(w) - b_.times(w))
        g = x.back(r, width) + a.back(gap, width) - b_.back(gap, width)
        g = np.append(g + RIDGE * w, r.sum())
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        move = 0.1 * min(1, 4 * (1 - step / STEPS) + 0.02) * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        w, b = np.maximum(w - move[:-1], 0), b - move[-1]
    return w, b


def score(docs: DataFrame, weights: dict[str, float], bias: float, id_col="doc_id", text_col="text") -> DataFrame:
    """doc_id and score (0 to 1) of every row; null and empty texts get the score of no words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = weights.get
        for batch in batches:
            z = np.array([bias + sum(sorted(known(w, 0.0) for w in features(words_of(t)))) for t in batch.column(1).to_pylist()], dtype=float)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(1 / (1 + np.exp(-np.clip(z, -500, 500))))], names=["doc_id", "score"]
            )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, score double")
