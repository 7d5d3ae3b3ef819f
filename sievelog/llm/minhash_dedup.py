"""Near-duplicate documents by ProbMinHash, banding and exact verification.

Every element of a text's weighted shingle set starts a Poisson process whose rate is its
weight; each arrival goes to a random component, a component keeps its earliest arrival,
and an element stops as soon as its next arrival is later than the latest component. Two
sets agree in a component with probability equal to their probability Jaccard similarity,
which for equal weights is the Jaccard similarity.

Texts with the same set become one node. Nodes that agree in all components of a band
share a bucket. First each node is paired with the most central pivot of its buckets, so hot
buckets cost their size; a node is the more central the more others its buckets hold. The
pairs are verified on the sets and linked nodes form components. Members of the largest
component of a bucket need no pairs among each other: those outside it are then compared
with all members of other components. Where few are outside, the pairs are written out;
else their sets are dealt to salted blocks, which compare all pairs and return no more
links than join their components. So every pair that shares a bucket is either verified
or already in one component.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievelog.llm.common import materialise, packed, unpacked, whole
from sievelog.llm.text_arrays import chunks, mix, shingle_hashes, word_hashes

WORDS = 5
SIMILARITY = 0.8
#: 24 bands of 5 components miss a pair of similarity 0.8 with probability 7e-5.
BANDS, ROWS = 24, 5
#: Members outside the largest component up to which a bucket writes its pairs out.
OUTSIDE = 8
#: Members and elements of one side of a block, on average, and cells of its table at once.
MEMBERS, ELEMENTS, CELLS = 256, 1_000_000, 4_000_000
#: Bytes of text worked on at once.
CHUNK = 2_000_000
#: Texts a task remembers, to send a set once.
SEEN = 200_000
_U = np.uint64
_LATE = np.iinfo(np.uint64).max


def weighted_sets(doc: np.ndarray, shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, 32-bit element and count of the distinct shingles, sorted by both."""
    keys, counts = np.unique((doc.astype(_U) << _U(32)) | (shingles >> _U(32)), return_counts=True)
    return (keys >> _U(32)).astype(np.int64), (keys & _U(0xFFFFFFFF)).astype(np.uint32), counts


def prob_minhash(doc: np.ndarray, element: np.ndarray, weight: np.ndarray, n_docs: int, size: int) -> np.ndarray:
    """Signatures (n_docs x size): the element with the earliest arrival of each component.

    A cell of the work table packs arrival time and element into one number, so that one
    minimum keeps both. Documents without elements keep the largest number.
    """
    table = np.full(n_docs * size, _LATE, _U)
    at, key, w = doc, element.astype(_U), weight.astype(np.float64)
    time, arrivals, burst = np.zeros(len(at)), 0, 1
    while len(at):
        for _ in range(burst):
            arrivals += 1
            r = mix(key * _U(0x9E3779B97F4A7C15) + _U(arrivals * 0xD1342543DE82EF95 % (1 << 64)))
            time = time - np.log(((r >> _U(11)).astype(np.float64) + 1) / (1 << 53)) / w
            component = (mix(r + _U(1)) >> _U(32)) * _U(size) >> _U(32)
            early = (time.astype(np.float32).view(np.uint32).astype(_U) << _U(32)) | key
            np.minimum.at(table, at * size + component.astype(np.int64), early)
        docs = np.unique(at)
        last = np.zeros(n_docs, np.float32)
        last[docs] = (table.reshape(n_docs, size)[docs].max(axis=1) >> _U(32)).astype(np.uint32).view(np.float32)
        limit = last[at]
        go = np.isnan(limit) | (time < limit)  # an empty component reads as not a number
        at, key, w, time = at[go], key[go], w[go], time[go]
        burst = min(2 * burst, 32)
    return (table & _U(0xFFFFFFFF)).reshape(n_docs, size)


def band_keys(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    keys = np.repeat(np.arange(1, bands + 1, dtype=_U)[None, :], len(signatures), 0)
    cells = signatures.reshape(len(signatures), bands, rows)
    for j in range(rows):
        keys = mix(keys * _U(0xD6E8FEB86659FD93) + cells[:, :, j])
    return keys.view(np.int64)


def _sets(batch: pa.RecordBatch, column: int, words: int):
    """First row, number of documents, and the weighted sets of each chunk."""
    for first, raw, offsets in chunks(batch, column, CHUNK):
        n = len(offsets) - 1
        yield first, n, *weighted_sets(*shingle_hashes(*word_hashes(raw, offsets), n, words))


def _fingerprints(doc, element, weight, n):
    """128 bits of each set and its counts."""
    terms = element.astype(_U) + (weight.astype(_U) << _U(32))
    for salt in (1, 2):
        out = np.zeros(n, _U)
        np.add.at(out, doc, mix(mix(terms + _U(1)) + _U(salt)))
        yield mix(out).view(np.int64)


def signatures(docs: DataFrame, id_col="doc_id", text_col="text", weights="set", bands=BANDS, rows=ROWS, words=WORDS) -> DataFrame:
    """doc_id, text_hash, f1, f2 (fingerprint of the set), n (its size), bands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, n, doc, element, count in _sets(batch, 2, words):
                weight = count if weights == "count" else np.ones(len(doc))
                f1, f2 = _fingerprints(doc, element, count if weights == "count" else np.ones(len(doc), int), n)
                keys = band_keys(prob_minhash(doc, element, weight, n, bands * rows), bands, rows)
                sizes = np.bincount(doc, minlength=n)
                keys[sizes == 0] = 0
                part = batch.slice(first, n)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(f1), pa.array(f2), pa.array(sizes),
                     pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * bands), pa.array(keys.ravel()))],
                    names=["doc_id", "text_hash", "f1", "f2", "n", "bands"],
                )

    rows_ = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(whole(text_col)).alias("text_hash"), whole(text_col).alias("text"))
    return rows_.mapInArrow(run, "doc_id bigint, text_hash bigint, f1 bigint, f2 bigint, n bigint, bands array<bigint>")


def _all_sets(docs: DataFrame, text_col: str, weights: str, words: int) -> DataFrame:
    """f1, f2, items (elements, then counts, as bytes) of every set, once per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            for _, n, doc, element, count in _sets(batch, 0, words):
                count = count if weights == "count" else np.ones(len(doc), int)
                f1, f2 = _fingerprints(doc, element, count, n)
                ends = np.cumsum(np.bincount(doc, minlength=n))
                out: list[list] = [[], [], []]
                for i, (a, b, end) in enumerate(zip(f1.tolist(), f2.tolist(), ends.tolist(), strict=True)):
                    begin = int(ends[i - 1]) if i else 0
                    if begin == end or (a, b) in seen:
                        continue
                    if len(seen) >= SEEN:
                        seen.clear()
                    seen.add((a, b))
                    items = element[begin:end].tobytes()
                    if weights == "count":
                        items += count[begin:end].astype(np.uint32).tobytes()
                    for column, value in zip(out, (a, b, items), strict=True):
                        column.append(value)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.binary())], names=["f1", "f2", "items"]
                )

    return docs.select(whole(text_col).alias("text")).mapInArrow(run, "f1 bigint, f2 bigint, items binary")


def probability_jaccard(a: np.ndarray, p: np.ndarray, b: np.ndarray, q: np.ndarray) -> float:
    """Of two sorted sets with weights; with equal weights, the Jaccard similarity."""
    _, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    if (p == 1).all() and (q == 1).all():
        return len(i) / max(len(a) + len(b) - len(i), 1)
    p, q = p / p.sum(), q / q.sum()
    alone_a, alone_b = np.ones(len(a), bool), np.ones(len(b), bool)
    alone_a[i], alone_b[j] = False, False
    rest_p, rest_q, total = p[alone_a].sum(), q[alone_b].sum(), 0.0
    order = np.argsort(p[i] / q[j])  # sum over y of max(p_y / p_x, q_y / q_x), by running sums in order of p / q
    x, y = p[i][order], q[j][order]
    below, above = np.cumsum(y), x[::-1].cumsum()[::-1]
    for k in range(len(x)):
        total += 1 / ((rest_p + (above[k + 1] if k + 1 < len(x) else 0)) / x[k] + (rest_q + below[k]) / y[k])
    return float(total)


def _split(raw: bytes, weights: str) -> tuple[np.ndarray, np.ndarray]:
    """Elements and weights of a set from its bytes."""
    items = np.frombuffer(raw, np.uint32)
    if weights == "count":
        return items[: len(items) // 2], items[len(items) // 2 :].astype(float)
    return items, np.ones(len(items))


def _verified(edges: DataFrame, sets: DataFrame, weights: str, similarity: float) -> DataFrame:
    """The edges (a, b) whose sets are as similar as asked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (batch.column(k).to_pylist() for k in (2, 3))
            good = [probability_jaccard(*_split(p, weights), *_split(q, weights)) >= similarity for p, q in zip(x, y, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(good, pa.bool_()))

    left = sets.select(F.col("node").alias("a"), F.col("items").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("items").alias("y"))
    both = edges.join(left, "a").join(right, "b").select("a", "b", "x", "y")
    return materialise(both.mapInArrow(run, "a bigint, b bigint"), "near-links")


def components(links: DataFrame) -> DataFrame:
    """node and label (the smallest node it is linked with, over any number of links)."""
    both = materialise(links.unionByName(links.select(F.col("a").alias("b"), F.col("b").alias("a"))).distinct(), "near-both")
    labels = materialise(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "near-labels")
    while True:
        at = labels.select(F.col("node").alias("b"), F.col("label").alias("other"))
        near = both.join(at, "b").groupBy(F.col("a").alias("node")).agg(F.min("other").alias("near"))
        low = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("low"))
        jump = labels.select(F.col("node").alias("low"), F.col("label").alias("far"))
        step = low.join(jump, "low", "left").select("node", F.least("low", F.coalesce("far", "low")).alias("label"), "old")
        step = materialise(step, "near-labels")
        labels = step.select("node", "label")
        if step.where("label <> old").isEmpty():
            return labels


def _near_in_size(pairs: DataFrame, weights: str, similarity: float) -> DataFrame:
    """Sets whose sizes n and m are further apart cannot be as similar."""
    return pairs.where(F.least("n", "m") >= F.greatest("n", "m") * F.lit(similarity)) if weights == "set" else pairs


def _across(met: DataFrame, labels: DataFrame, sets: DataFrame, weights: str, similarity: float) -> DataFrame:
    """Links (a, b) between members of a bucket that are of different components, enough to join all that are similar."""
    members = met.select("bucket", "node", "n").join(labels.select("node", "label"), "node", "left")
    members = materialise(members.withColumn("label", F.coalesce("label", "node")), "near-members")
    mixed = _outside(members)
    pairs = materialise(_paired(members, mixed.where(F.col("outside") <= OUTSIDE), weights, similarity), "near-pairs")
    few = _verified(pairs, sets, weights, similarity)
    return few.unionByName(_in_blocks(members, mixed.where(F.col("outside") > OUTSIDE), sets, weights, similarity))


def _outside(members: DataFrame) -> DataFrame:
    """Buckets with more than one component: the label of the largest, how many members are outside it, blocks of these and of all."""
    parts = members.groupBy("bucket", "label").agg(F.count("*").alias("held"), F.sum("n").alias("size"))
    most = parts.groupBy("bucket").agg(
        F.max(F.struct("held", "label", "size")).alias("most"), F.sum("held").alias("members"), F.sum("size").alias("size")
    )
    outside, size = F.col("members") - F.col("most.held"), F.col("size") - F.col("most.size")
    blocks = lambda n, of: F.ceil(F.greatest(n / F.lit(MEMBERS), of / F.lit(ELEMENTS))).cast("int")
    most = most.select(
        "bucket", F.col("most.label").alias("largest"), outside.alias("outside"),
        blocks(outside, size).alias("outer_blocks"), blocks(F.col("members"), F.col("size")).alias("all_blocks"),
    )
    return materialise(most.where("outside > 0"), "near-buckets")


def _paired(members: DataFrame, buckets: DataFrame, weights: str, similarity: float) -> DataFrame:
    """Each of the few members outside the largest component of a bucket with those of other components."""
    inside = members.join(buckets.select("bucket", "largest"), "bucket")
    outer = inside.where("label <> largest").select("bucket", F.col("node").alias("a"), "n", F.col("label").alias("a_label"))
    inner = inside.select("bucket", F.col("node").alias("b"), F.col("n").alias("m"), "label", "largest")
    pairs = outer.join(inner, "bucket").where("a_label <> label AND (label = largest OR a < b)")
    return _ordered(_near_in_size(pairs, weights, similarity))


def _in_blocks(members: DataFrame, buckets: DataFrame, sets: DataFrame, weights: str, similarity: float) -> DataFrame:
    """Links of the members outside the largest component of a bucket with those of other components.

    Members of either side are dealt to blocks by a hash, and each pair of blocks is one
    group. A group counts what its sets share in one table and returns a link for each two
    components that it joins.
    """

    def run(group: pa.Table) -> pa.Table:
        outer = np.asarray(group["outer"].to_pylist(), bool)
        node, label = (np.asarray(group[c].to_pylist(), np.int64) for c in ("node", "label"))
        held = [_split(raw, weights) for raw in group["items"].to_pylist()]
        rows, columns = np.flatnonzero(outer), np.flatnonzero(~outer)
        shared = _shared([held[i][0] for i in rows], [held[i][0] for i in columns])
        new = (label[rows][:, None] != label[columns][None, :]) & (shared > 0)
        if weights == "set":
            sizes = np.asarray([len(x) for x, _ in held], float)
            new &= shared / np.maximum(sizes[rows][:, None] + sizes[columns][None, :] - shared, 1) >= similarity
        top: dict[int, int] = {}

        def find(x: int) -> int:
            while top.get(x, x) != x:
                top[x] = x = top.get(top[x], top[x])
            return x

        out: list[tuple[int, int]] = []
        for r, c in zip(*np.nonzero(new), strict=True):
            i, j = rows[r], columns[c]
            x, y = find(int(label[i])), find(int(label[j]))
            if x != y and (weights == "set" or probability_jaccard(*held[i], *held[j]) >= similarity):
                top[x] = y
                out.append((int(node[i]), int(node[j])))
        return pa.table({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([y for _, y in out], pa.int64())})

    inside = members.join(buckets, "bucket")
    salt = F.xxhash64("node", "bucket")
    outer_at, at = F.pmod(salt, "outer_blocks").cast("int"), F.pmod(salt, "all_blocks").cast("int")
    upto = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    cells = F.concat(
        F.when(F.col("label") != F.col("largest"), F.transform(upto("all_blocks"), lambda k: F.struct(F.lit(True).alias("outer"), outer_at.alias("i"), k.alias("j"))))
        .otherwise(F.array()),
        F.transform(upto("outer_blocks"), lambda k: F.struct(F.lit(False).alias("outer"), k.alias("i"), at.alias("j"))),
    )
    dealt = inside.select("bucket", "node", "label", cells.alias("cells")).join(sets, "node")
    dealt = dealt.select("bucket", "node", "label", "items", F.explode("cells").alias("cell"))
    dealt = dealt.select("bucket", "cell.i", "cell.j", "cell.outer", "node", "label", "items")
    return materialise(dealt.groupBy("bucket", "i", "j").applyInArrow(run, "a bigint, b bigint"), "near-links")


def _shared(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many elements each set on the left has in common with each on the right."""
    counts = np.zeros((len(left), len(right)))
    if not left or not right:
        return counts
    x, y = np.concatenate(left), np.concatenate(right)
    both = np.intersect1d(x, y)
    sides = []
    for items, held in ((x, left), (y, right)):
        row, at = np.repeat(np.arange(len(held)), [len(h) for h in held]), np.searchsorted(both, items)
        known = at < len(both)
        known[known] = both[at[known]] == items[known]
        order = np.argsort(at[known], kind="stable")
        sides.append((row[known][order], at[known][order], len(held)))
    step = max(CELLS // (len(left) + len(right)), 1)
    for low in range(0, len(both), step):
        tables = []
        for row, at, n in sides:
            a, b = np.searchsorted(at, (low, low + step))
            tables.append(np.zeros((n, min(step, len(both) - low)), np.float32))
            tables[-1][row[a:b], at[a:b] - low] = 1
        counts += tables[0] @ tables[1].T
    return counts


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def near_duplicates(docs: DataFrame, id_col="doc_id", text_col="text", weights="set", similarity=SIMILARITY,
                    bands=BANDS, rows=ROWS, words=WORDS) -> DataFrame:
    """A row per row of ``docs``: doc_id, text_hash, class_id, class_size, n_links, kept.

    ``class_id`` is the smallest id of the class, null ids last. ``n_links`` counts the
    verified links of the row's distinct set that built the class, not all sets as similar
    as asked: members of one component are not paired. Texts without words, null ones too, stand
    alone; texts of fewer than ``words`` words have one shingle. Rows that repeat an id and
    a text are in one class; of a class, one row (id and text) is kept, however often it
    is repeated. Empty in, empty out.
    """
    known = materialise(signatures(docs, id_col, text_col, weights, bands, rows, words), "near-signatures")
    nodes = known.where("n > 0").groupBy("f1", "f2", "n").agg(F.first("bands").alias("bands"))
    nodes = materialise(nodes.withColumn("node", F.monotonically_increasing_id()), "near-nodes")  # fixed once written
    entries = nodes.select("node", "n", F.explode("bands").alias("bucket"))
    held = entries.groupBy("bucket").agg(F.count("*").alias("held")).where("held > 1")
    met = materialise(entries.join(held, "bucket"), "near-met")
    central = met.groupBy("node").agg(F.sum("held").alias("meets"))
    pivots = met.select("bucket", "node", "n").join(central, "node")
    pivots = materialise(pivots.groupBy("bucket").agg(F.max(F.struct("meets", "node", "n")).alias("pivot")), "near-buckets")
    stars = met.join(pivots, "bucket").where("node <> pivot.node").select("node", "n", "pivot", F.col("pivot.n").alias("m"))
    stars = _near_in_size(stars, weights, similarity).groupBy("node").agg(F.max("pivot").alias("pivot"))
    one = materialise(stars.select(F.col("node").alias("a"), F.col("pivot.node").alias("b")), "near-pairs")
    asked = met.select("node").distinct().join(nodes.select("node", "f1", "f2"), "node")
    sets = _all_sets(docs, text_col, weights, words).join(asked, ["f1", "f2"]).dropDuplicates(["node"])
    sets = materialise(sets.select("node", "items"), "near-sets")
    links = _verified(one, sets, weights, similarity)
    links = links.unionByName(_across(met, components(links), sets, weights, similarity)).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    labels = components(links)
    degrees = links.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count("*").alias("n_links"))
    classes = (
        nodes.select("node", "f1", "f2").join(labels, "node", "left").join(degrees, "node", "left")
        .select("f1", "f2", F.coalesce("label", "node").alias("label"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
    )
    placed = known.select("doc_id", "text_hash", "f1", "f2", "n").join(materialise(classes, "near-classes"), ["f1", "f2"], "left")
    placed = materialise(placed.select("doc_id", "text_hash", "label", F.coalesce("n_links", F.lit(0)).alias("n_links")), "near-placed")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("first")
    heads = placed.where("label is not null").groupBy("label").agg(first, F.count("*").alias("class_size"))
    own = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    return placed.join(materialise(heads, "near-heads"), "label", "left").select(
        "doc_id", "text_hash", F.when(F.col("label").isNull(), F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("class_id"),
        F.coalesce("class_size", F.lit(1)).alias("class_size"), "n_links",
        (F.col("label").isNull() | own.eqNullSafe(F.col("first"))).alias("kept"),
    )


def drop_near_duplicates(docs: DataFrame, id_col="doc_id", text_col="text", **how) -> DataFrame:
    """The rows of ``docs`` that stay, one of each class, with their own columns."""
    stay = near_duplicates(docs, id_col, text_col, **how).where("kept")
    stay = stay.select(F.col("doc_id").alias("k_id"), F.col("text_hash").alias("k_hash"))
    rows = docs.select(packed(docs), F.col(id_col).cast("long").alias("id"), F.xxhash64(whole(text_col)).alias("at"))
    matched = rows.join(stay, (F.col("at") == F.col("k_hash")) & F.col("id").eqNullSafe(F.col("k_id")), "left_semi")
    return matched.dropDuplicates(["at", "id"]).select(*unpacked(docs))
