"""N-gram Jaccard join with Bayesian candidate pruning.

Documents are sets of five-word shingles; a link joins two documents whose sets have a Jaccard
similarity of at least 0.8. Documents with equal sets form one class and go on as one node, so copies
cost one hash each.

1. Every node has `HASHES` MinHash values. Bands of `ROWS` values make candidates: two nodes that
   agree in a band are in one cluster (connected through the smallest node of the band, never as
   pairs). At similarity 0.8 a pair is missed with a probability of (1 - 0.8^5)^32 = 3e-6, at 0.9 of
   1e-12.
2. Clusters are dealt in blocks, and two blocks at a time meet in one task. There the MinHash values
   of all pairs are compared `STEP` at a time; a pair is dropped as soon as the posterior probability
   that its similarity reaches the threshold, given the agreements so far and a uniform prior, is
   below `TOLERANCE`.
3. Pairs that are left are verified exactly on their shingle sets.

No pair leaves a task: it returns per node the number of linked documents and the smallest node it
was linked with; components of these links are the classes. A cluster of any size is compared in full,
block against block.

Defined results: words are runs without ASCII white space, compared as they are; a text of one to four
words is one shingle; null and empty texts have no shingle, link to nothing, and each is a class of
its own under its doc_id; repeated rows and rows sharing a doc_id are documents of their own (with
equal sets they link to each other); a null doc_id is the smallest; the class id is the smallest
doc_id of the component (null if that one is null); an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import Scope
from . import common
from .registry import query

SHINGLE, THRESHOLD = 5, 0.8
BANDS, ROWS = 32, 5
HASHES = BANDS * ROWS
STEP, TOLERANCE = 16, 1e-6
BLOCK = 1024  # nodes of a block; a task holds two
BIN = 4000  # nodes of small clusters that share a task
COLUMNS = 4096  # shingles of one matrix product
NULL_ID = -1 << 63


def shingles(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each row, sorted, and the row starts."""
    n = len(offsets) - 1
    starts, ends, rows = common.word_spans(buf, offsets)
    words = common.range_hash(common.prefix_hash(buf), starts, ends)
    count = np.bincount(rows, minlength=n)
    windows = common.window_hashes(words, SHINGLE)
    inside = np.flatnonzero(rows[: len(windows)] == rows[SHINGLE - 1:]) if len(windows) else np.zeros(0, np.int64)
    owner, values = rows[inside], windows[inside]
    first = np.cumsum(count) - count
    for row in np.flatnonzero((count > 0) & (count < SHINGLE)).tolist():  # short texts: all their words
        short = words[first[row]: first[row] + count[row]]
        value = common.mix(np.array([int(common.window_hashes(short, len(short))[0]) ^ len(short)], np.uint64))
        owner, values = np.append(owner, row), np.append(values, value)
    order = np.lexsort((values, owner))
    owner, values = owner[order], values[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    return values[new], np.concatenate([[0], np.cumsum(np.bincount(owner[new], minlength=n))]).astype(np.int64)


_TIMES = np.random.default_rng(808).integers(1, 1 << 62, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLUS = np.random.default_rng(809).integers(0, 1 << 63, HASHES, dtype=np.uint64)


def signatures(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """MinHash values (rows, HASHES) of rows that all have shingles."""
    out = np.empty((len(starts) - 1, HASHES), np.uint32)
    room = np.empty(len(values), np.uint64)
    for k in range(HASHES):
        np.multiply(values, _TIMES[k], out=room)
        room += _PLUS[k]
        out[:, k] = np.minimum.reduceat(room, starts[:-1]) >> np.uint64(32)
    return out


def bands(signature: np.ndarray) -> np.ndarray:
    """Key of each band, (rows, BANDS) as signed integers."""
    odd = np.random.default_rng(5).integers(1, 1 << 62, ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    total = np.zeros((len(signature), BANDS), np.uint64)
    for k in range(ROWS):
        total += (signature[:, k::ROWS].astype(np.uint64) + np.uint64(1)) * odd[k]
    return common.mix(total + np.arange(BANDS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)


def least_agreements(threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> list[int]:
    """After each STEP of compared values, the least number that must agree.

    With m of n values agreeing and a uniform prior the similarity is Beta(m + 1, n - m + 1), and
    P(s >= t) = P(Binomial(n + 1, t) <= m), a finite sum.
    """
    least = []
    for n in range(STEP, HASHES + 1, STEP):
        total, m = 0.0, -1
        while True:
            m += 1
            total += math.comb(n + 1, m) * threshold ** m * (1 - threshold) ** (n + 1 - m)
            if total >= tolerance:
                break
        least.append(m)
    return least


_LEAST = least_agreements()


def surviving(left: np.ndarray, right: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """Which of `pairs` (i, j) the pruning lets through, comparing STEP values at a time."""
    live = np.arange(len(pairs))
    agreed = np.zeros(len(pairs), np.int32)
    for k, least in enumerate(_LEAST):
        part = slice(k * STEP, (k + 1) * STEP)
        for a in range(0, len(live), 1 << 17):  # bounded memory
            some = live[a: a + (1 << 17)]
            agreed[some] += (left[pairs[some, 0], part] == right[pairs[some, 1], part]).sum(axis=1, dtype=np.int32)
        live = live[agreed[live] >= least]
        if not len(live):
            break
    return live


def overlaps(left: list[np.ndarray], right: list[np.ndarray], pairs: np.ndarray) -> np.ndarray:
    """Exact size of the intersection of each pair of sets, by products of membership matrices."""
    a, b = np.unique(pairs[:, 0]), np.unique(pairs[:, 1])
    at_a, at_b = np.searchsorted(a, pairs[:, 0]), np.searchsorted(b, pairs[:, 1])
    values_a, values_b = np.concatenate([left[i] for i in a]), np.concatenate([right[j] for j in b])
    common_ = np.intersect1d(values_a, values_b)
    if len(pairs) * 64 < len(a) * len(b):  # few pairs of many nodes: one by one
        return np.array([len(np.intersect1d(left[i], right[j], assume_unique=True)) for i, j in pairs.tolist()], np.int64)
    rows_a, rows_b = np.repeat(np.arange(len(a)), [len(left[i]) for i in a]), np.repeat(np.arange(len(b)), [len(right[j]) for j in b])
    column_a, column_b = np.searchsorted(common_, values_a), np.searchsorted(common_, values_b)
    in_a = (column_a < len(common_)) & (common_[np.minimum(column_a, max(len(common_) - 1, 0))] == values_a) if len(common_) else np.zeros(len(values_a), bool)
    in_b = (column_b < len(common_)) & (common_[np.minimum(column_b, max(len(common_) - 1, 0))] == values_b) if len(common_) else np.zeros(len(values_b), bool)
    rows_a, column_a, rows_b, column_b = rows_a[in_a], column_a[in_a], rows_b[in_b], column_b[in_b]
    total = np.zeros((len(a), len(b)), np.float32)
    for k in range(0, len(common_), COLUMNS):
        width = min(COLUMNS, len(common_) - k)
        x, y = np.zeros((len(a), width), np.float32), np.zeros((len(b), width), np.float32)
        here = (column_a >= k) & (column_a < k + width)
        x[rows_a[here], column_a[here] - k] = 1
        here = (column_b >= k) & (column_b < k + width)
        y[rows_b[here], column_b[here] - k] = 1
        total += x @ y.T
    return total[at_a, at_b].astype(np.int64)


def compare(left: list[np.ndarray], right: list[np.ndarray], left_sig: np.ndarray, right_sig: np.ndarray,
            same: bool) -> np.ndarray:
    """All linked pairs (i, j) between two blocks, or within one (`same`, i < j)."""
    found = []
    sizes_a, sizes_b = np.array([len(x) for x in left]), np.array([len(x) for x in right])
    for i0 in range(0, len(left), 128):
        i, j = np.meshgrid(np.arange(i0, min(i0 + 128, len(left))), np.arange(len(right)), indexing="ij")
        pairs = np.stack([i.ravel(), j.ravel()], axis=1)
        if same:
            pairs = pairs[pairs[:, 0] < pairs[:, 1]]
        # No pair of sets can be more similar than the smaller is large against the larger.
        a, b = sizes_a[pairs[:, 0]], sizes_b[pairs[:, 1]]
        pairs = pairs[np.minimum(a, b) >= THRESHOLD * np.maximum(a, b)]
        pairs = pairs[surviving(left_sig, right_sig, pairs)]
        if len(pairs):
            shared = overlaps(left, right, pairs)
            a, b = sizes_a[pairs[:, 0]], sizes_b[pairs[:, 1]]
            # 10 * shared >= 8 * union, in whole numbers
            found.append(pairs[10 * shared >= 8 * (a + b - shared)])
    return np.concatenate(found) if found else np.zeros((0, 2), np.int64)


def _nodes(docs: DataFrame) -> DataFrame:
    """key, text_hash, node (digest of the shingle set) and sig for each row; the last two are null
    without shingles."""
    def run(batches):
        import hashlib
        for batch in batches:
            buf, offsets = common.text_buffer(batch.column(2))
            nodes, sigs = [], []
            for i, j in common.row_slices(offsets):
                values, starts = shingles(buf[offsets[i]: offsets[j]], offsets[i: j + 1] - offsets[i])
                full = np.flatnonzero(np.diff(starts) > 0)
                made = signatures(values, np.concatenate([starts[full], starts[-1:]])) if len(full) else None
                at = dict(zip(full.tolist(), range(len(full))))
                for row in range(j - i):
                    if row in at:
                        nodes.append(hashlib.blake2b(values[starts[row]: starts[row + 1]].tobytes(), digest_size=16).digest())
                        sigs.append(made[at[row]].tobytes())
                    else:
                        nodes.append(None), sigs.append(None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(nodes, pa.binary()), pa.array(sigs, pa.binary())],
                names=["key", "text_hash", "node", "sig"])

    return docs.select(*_identity(), "text").mapInArrow(run, "key long, text_hash long, node binary, sig binary")


def _identity() -> list:
    return [F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("key"), F.xxhash64("text").alias("text_hash")]


def _band_rows(nodes: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            sig = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint32).reshape(-1, HASHES)
            yield pa.RecordBatch.from_arrays([
                pa.array(bands(sig).ravel()), batch.column(0).take(pa.array(np.repeat(np.arange(len(sig)), BANDS)))],
                names=["band", "node"])

    return nodes.select("node", "sig").mapInArrow(run, "band long, node binary")


def _meetings(clusters: DataFrame, sizes: DataFrame) -> DataFrame:
    """(node, meeting, cluster, block, first, second): where each clustered node goes.

    A cluster of one block meets in a bin with others; the blocks of a larger one meet two by two.
    """
    sized = clusters.join(sizes, "cluster").withColumn("blocks", F.ceil(F.col("members") / BLOCK).cast("int"))
    dealt = sized.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    total = sizes.agg(F.sum("members")).first()[0] or 0
    bins = int(total // BIN + 1)
    small = dealt.where("blocks = 1").select(
        "node", "cluster", "block", F.lit(0).alias("first"), F.lit(0).alias("second"),
        F.concat(F.lit("b"), F.pmod(F.xxhash64("cluster"), F.lit(bins))).alias("meeting"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    large = dealt.where("blocks > 1").select("node", "cluster", "block", other.alias("other")).select(
        "node", "cluster", "block", F.least("block", "other").alias("first"), F.greatest("block", "other").alias("second"),
        F.concat_ws("-", F.hex("cluster"), F.least("block", "other"), F.greatest("block", "other")).alias("meeting"))
    return small.unionByName(large)


def _meet(pdf: pd.DataFrame) -> pd.DataFrame:
    """Compare the clusters of one meeting; returns (node, links, linked)."""
    out = []
    for _, part in pdf.groupby(["cluster", "first", "second"], sort=True):
        first, second = part["first"].iloc[0], part["second"].iloc[0]
        a = part[part["block"] == first].reset_index(drop=True)
        b = a if first == second else part[part["block"] == second].reset_index(drop=True)
        sets = [[np.frombuffer(x, np.uint64) for x in side["shingles"]] for side in (a, b)]
        sigs = [np.frombuffer(b"".join(side["sig"]), np.uint32).reshape(-1, HASHES) for side in (a, b)]
        pairs = compare(*sets, *sigs, first == second)
        if not len(pairs):
            continue
        i, j = pairs[:, 0], pairs[:, 1]
        nodes_a, nodes_b = a["node"].to_numpy(), b["node"].to_numpy()
        copies_a, copies_b = a["copies"].to_numpy(np.int64), b["copies"].to_numpy(np.int64)
        links = {}
        for x, y, mine, theirs, copies in ((i, j, nodes_a, nodes_b, copies_b), (j, i, nodes_b, nodes_a, copies_a)):
            order = np.lexsort((_ranks(theirs)[y], x))
            x, y = x[order], y[order]
            head = np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]]))
            total = np.add.reduceat(copies[y], head)
            for k, n in zip(head, total):
                known = links.get(mine[x[k]])
                least = theirs[y[k]]
                links[mine[x[k]]] = (n + (known[0] if known else 0), min(least, known[1]) if known else least)
        out += [(node, int(n), least) for node, (n, least) in links.items()]
        # The smallest partner alone may not connect what is linked: add a spanning set of links.
        out += [(x, 0, y) for x, y in _spanning(nodes_a, nodes_b, pairs)]
    return pd.DataFrame(out, columns=["node", "links", "linked"])


def _ranks(values: np.ndarray) -> np.ndarray:
    order = sorted(range(len(values)), key=lambda k: values[k])
    ranks = np.empty(len(values), np.int64)
    ranks[order] = np.arange(len(values))
    return ranks


def _spanning(nodes_a, nodes_b, pairs) -> list[tuple[bytes, bytes]]:
    """Links that join everything the pairs join: at most one less than there are nodes."""
    parent: dict[bytes, bytes] = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    edges = []
    # numpy unions labels round by round, so that only few links reach the loop
    size = len(nodes_a) + len(nodes_b)
    i, j = pairs[:, 0], pairs[:, 1] + (0 if nodes_a is nodes_b else len(nodes_a))
    names = nodes_a if nodes_a is nodes_b else np.concatenate([nodes_a, nodes_b])
    label = np.arange(size)
    while True:
        before = label.copy()
        np.minimum.at(label, i, label[j])
        np.minimum.at(label, j, label[i])
        label = label[label]
        if (label == before).all():
            break
    used = np.unique(np.concatenate([i, j]))
    for k in used.tolist():
        if label[k] != k and root(names[k]) != root(names[label[k]]):
            parent[root(names[k])] = root(names[label[k]])
            edges.append((names[k], names[label[k]]))
    return edges


def link(docs: DataFrame, scope: Scope) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, links, classes): rows (key, node) of all documents; per linked node its number of
    linked documents of other nodes; per linked node the smallest key of its component."""
    rows = scope.table(_nodes(docs), "rows")
    nodes = scope.table(rows.where("node is not null").groupBy("node").agg(
        F.min("key").alias("least"), F.count(F.lit(1)).alias("copies"), F.first("sig").alias("sig")), "nodes")
    banded = scope.table(_band_rows(nodes), "bands")
    shared = banded.groupBy("band").agg(F.min("node").alias("hub"), F.count(F.lit(1)).alias("n")).where("n > 1").select(
        F.col("band").alias("band_"), "hub")
    edges = banded.join(shared, banded.band == shared.band_).where("node <> hub").select(
        F.col("node").alias("a"), F.col("hub").alias("b")).distinct()
    found = common.connected_components(scope, edges)
    roots = found.select(F.col("component").alias("node"), F.col("component")).distinct()
    clusters = scope.table(found.unionByName(roots).distinct().withColumnRenamed("component", "cluster"), "clusters")
    scope.drop(banded)
    sizes = scope.table(clusters.groupBy("cluster").agg(F.count(F.lit(1)).alias("members")), "sizes")
    wanted = clusters.join(nodes, "node")
    # Shingles are made again for the one row of each clustered node.
    texts = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("key"), "text")
    picked = wanted.select(F.col("least").alias("key")).distinct()
    sets = _sets(texts.join(picked, "key", "left_semi")).dropDuplicates(["node"])
    going = _meetings(clusters, sizes).join(nodes.select("node", "copies", "sig"), "node").join(sets, "node")
    met = scope.table(going.groupBy("meeting").applyInPandas(_meet, "node binary, links long, linked binary"), "met")
    links = met.groupBy("node").agg(F.sum("links").alias("links"))
    joined = common.connected_components(scope, met.select(F.col("node").alias("a"), F.col("linked").alias("b")))
    both = joined.unionByName(joined.select(F.col("component").alias("node"), "component").distinct())
    least = both.join(nodes.select("node", "least"), "node").groupBy("component").agg(F.min("least").alias("class_key"))
    classes = scope.table(both.join(least, "component").select("node", "class_key", "component"), "classes")
    return rows, links, classes


def _sets(texts: DataFrame) -> DataFrame:
    """node and its shingle hashes as bytes."""
    def run(batches):
        import hashlib
        for batch in batches:
            buf, offsets = common.text_buffer(batch.column(0))
            out = []
            for i, j in common.row_slices(offsets):
                values, starts = shingles(buf[offsets[i]: offsets[j]], offsets[i: j + 1] - offsets[i])
                out += [values[starts[k]: starts[k + 1]].tobytes() for k in range(j - i)]
            kept = [x for x in out if x]
            yield pa.RecordBatch.from_arrays([
                pa.array([hashlib.blake2b(x, digest_size=16).digest() for x in kept], pa.binary()), pa.array(kept, pa.binary())],
                names=["node", "shingles"])

    return texts.select("text").mapInArrow(run, "node binary, shingles binary")


def classify(docs: DataFrame, scope: Scope) -> DataFrame:
    """key, text_hash, class_key, n_links, node and class_node of every row: the class is the component of its links, n_links the
    number of other documents with a similarity of at least the threshold (copies included)."""
    rows, links, classes = link(docs, scope)
    copies = rows.where("node is not null").groupBy("node").agg(
        F.count(F.lit(1)).alias("copies"), F.min("key").alias("least"))
    # Written, so that both sides of the last join have an exchange of their own and Spark can split
    # the partition of a large group of copies.
    node = scope.table(copies.join(links, "node", "left").join(classes, "node", "left").select(
        F.col("node").alias("node_"), (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.coalesce("class_key", "least").alias("class_key"), F.coalesce("component", "node").alias("class_node")), "by_node")
    return rows.join(node, rows.node == node.node_, "left").select(
        "key", "text_hash", F.coalesce("class_key", "key").alias("class_key"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        "node", "class_node")


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of `docs`, all columns unchanged, of which one per class stays: that of the smallest
    doc_id. Rows that share doc_id and text are one document; rows without words all stay."""
    with Scope(docs.sparkSession, "links") as scope:
        named = scope.table(classify(docs, scope).where("node is not null"), "named")
        own = named.where("key = class_key").select("key", "class_node", "text_hash")
        # Different texts of one class under the doc_id that names it: the smallest text hash stays.
        least = own.groupBy("key", "class_node").agg(
            F.min("text_hash").alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1")
        others = own.join(least, ["key", "class_node"]).where("text_hash <> least").select("key", "text_hash")
        gone = scope.keep(named.where("key <> class_key").select("key", "text_hash").unionByName(others).distinct(), "gone")
        again = scope.keep(own.groupBy("key", "text_hash").count().where("count > 1").select("key", "text_hash"), "again")
    identity = common.free_names(docs, "key", "text_hash")
    marked = docs.withColumns(dict(zip(identity, _identity())))
    left = marked.join(gone.toDF(*identity), identity, "left_anti")
    if not again.isEmpty():
        again = again.toDF(*identity)
        once = left.join(again, identity, "left_semi").dropDuplicates(identity)
        left = left.join(again, identity, "left_anti").unionByName(once)
    return left.drop(*identity).select(*docs.columns)


@query("op8_ngram_jaccard_join")
def op8_ngram_jaccard_join(spark, sf_dir):
    common.small_batches(spark)
    known = F.when(F.col("class_key") != NULL_ID, F.col("class_key")).alias("class_id")
    with Scope(spark, "links") as scope:
        return scope.keep(classify(common.table(spark, sf_dir, "documents"), scope).select(
            F.when(F.col("key") != NULL_ID, F.col("key")).alias("doc_id"), known, "n_links"))
