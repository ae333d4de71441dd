"""Target-distribution importance resampling with ranks from parallel sorting by regular sampling.

Every run of 1 to n consecutive words is a feature, and crc32 of its bytes names its bucket. A bucket's
gain is the log ratio of its share in the target texts to its share in the documents; gains are an
array, so scoring a document is one gather and one sum. A score adds seeded Gumbel noise to the
weight, which makes the highest scores a draw without replacement.

Exact ranks come from sorting in parallel: tasks sort bounded runs of packed keys, every run gives
samples at regular places, quantiles of all samples split the key range, runs are cut at the
splitters and their segments exchanged, segments of one part are merged, and the counts of the parts
before give each part its first rank. Equal keys travel as one key with a count, so no group of
repeated rows can fill a part.

Defined results: a null or empty text has no words, no features and weight 0; documents with fewer
words than `least_words` are scored and never drawn; a null doc_id draws its noise from "<seed>:" and
comes before all others in ties; rows that agree in score and doc_id are ranked by n_features,
repeated rows get consecutive ranks; without target texts all gains come from smoothing alone; an
empty table gives an empty result; columns other than doc_id and text are not read.
"""

from __future__ import annotations

import hashlib
import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import Scope
from . import common
from .registry import query

BUCKETS = 10_000
NGRAMS = 1
SEED = "2024"
LEAST_WORDS = 20
SHARE = 10  # percent of the eligible documents that are drawn
RUN = 1 << 18  # rows of one sorted run
PART = 1 << 19  # rows meant for one part after the exchange
SAMPLES = 64  # regular samples a run gives
SPLIT_FROM = 1 << 16  # samples the driver reads at most; more are thinned by another round of runs
LONG_WORD = 48  # bytes; what a word has beyond goes through zlib

_SEPARATOR = np.ones(256, bool)
_SEPARATOR[list(b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")] = False
_SEPARATOR[128:] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def _crc_table() -> np.ndarray:
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & np.uint32(1), (c >> np.uint32(1)) ^ np.uint32(0xEDB88320), c >> np.uint32(1))
    return c


_CRC = _crc_table()


def crc_on(state: np.ndarray, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """crc32 of what `state` has read followed by each range of bytes."""
    sizes = ends - starts
    order = np.argsort(-np.minimum(sizes, LONG_WORD + 1), kind="stable")
    crc, begin, size = ~state[order], starts[order], sizes[order]
    longest = int(size.max(initial=0))
    for k in range(min(longest, LONG_WORD)):
        n = int(np.searchsorted(-np.minimum(size, LONG_WORD + 1), -k, side="left"))  # ranges longer than k
        x = crc[:n]
        crc[:n] = _CRC[(x ^ buf[begin[:n] + k]) & np.uint32(255)] ^ (x >> np.uint32(8))
    crc = ~crc
    for i in np.flatnonzero(size > LONG_WORD):
        crc[i] = zlib.crc32(buf[begin[i] + LONG_WORD: begin[i] + size[i]].tobytes(), int(crc[i]))
    out = np.empty_like(crc)
    out[order] = crc
    return out


def features(buf: np.ndarray, offsets: np.ndarray, ngrams: int = NGRAMS, buckets: int = BUCKETS):
    """(rows, buckets, words per row): one entry for each run of 1 to `ngrams` words of each row."""
    buf = _LOWER[buf]
    starts, ends, rows = common.word_spans(buf, offsets, _SEPARATOR)
    state = crc_on(np.zeros(len(starts), np.uint32), buf, starts, ends)
    blank, at, n = np.full(1, 32, np.uint8), np.arange(len(starts)), len(starts)
    found_rows, found = [rows], [state % np.uint32(buckets)]
    for k in range(1, ngrams):
        on = np.minimum(at + k, max(n - 1, 0))
        inside = (at + k < n) & (rows[on] == rows[at])
        at, state, on = at[inside], state[inside], on[inside]
        zero = np.zeros(len(at), np.int64)
        state = crc_on(crc_on(state, blank, zero, zero + 1), buf, starts[on], ends[on])
        found_rows.append(rows[at])
        found.append(state % np.uint32(buckets))
    return np.concatenate(found_rows), np.concatenate(found), np.bincount(rows, minlength=len(offsets) - 1)


def bucket_counts(docs: DataFrame, ngrams: int = NGRAMS, buckets: int = BUCKETS) -> np.ndarray:
    """Features of all texts per bucket: one partial array a task, summed by Spark; `buckets` numbers come back."""
    def run(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            buf, offsets = common.text_buffer(batch.column(0))
            for i, j in common.row_slices(offsets):
                _, found, _ = features(buf[offsets[i]: offsets[j]], offsets[i: j + 1] - offsets[i], ngrams, buckets)
                total += np.bincount(found, minlength=buckets)
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(there, pa.int32()), pa.array(total[there])], names=["bucket", "n"])

    sums = np.zeros(buckets, np.int64)
    for r in docs.select("text").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        sums[r.bucket] = r.n
    return sums


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of the ratio of smoothed shares, per bucket."""
    k = float(len(source))
    s_all, t_all = float(source.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1.0) * (s_all + k) / ((s + 1.0) * (t_all + k))))
                     for s, t in zip(source.tolist(), target.tolist())], np.int64)


def noise(seed: str, key) -> int:
    h = int(hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def weigh(docs: DataFrame, gain: np.ndarray, ngrams: int = NGRAMS, seed: str = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight, score of every row of `docs`."""
    def run(batches):
        for batch in batches:
            buf, offsets = common.text_buffer(batch.column(1))
            words, count, weight = (np.zeros(len(offsets) - 1, np.int64) for _ in range(3))
            for i, j in common.row_slices(offsets):
                rows, found, n = features(buf[offsets[i]: offsets[j]], offsets[i: j + 1] - offsets[i], ngrams, len(gain))
                words[i:j], count[i:j] = n, np.bincount(rows, minlength=j - i)
                np.add.at(weight[i:j], rows, gain[found])
            keys = batch.column(0).to_pylist()
            score = weight + np.array([noise(seed, k) for k in keys], np.int64).reshape(len(keys))
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, (words, count, weight, score))],
                                             names=["doc_id", "n_words", "n_features", "weight", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, n_words long, n_features long, weight long, score long")


# Packed keys: bytes whose order is score falling, doc_id (null first), n_features, weight.

_KEY = np.dtype([("score", ">u8"), ("there", "u1"), ("doc_id", ">u8"), ("n_features", ">u8"), ("weight", ">u8")])
_TEXT = f"S{_KEY.itemsize}"  # the same bytes as numpy compares them
_TOP = np.uint64(1 << 63)


def pack(batch: pa.RecordBatch) -> np.ndarray:
    keys = np.zeros(batch.num_rows, _KEY)

    def column(name):
        return batch.column(name).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64) ^ _TOP
    keys["score"], keys["doc_id"] = ~column("score"), column("doc_id")
    keys["there"] = batch.column("doc_id").is_valid().to_numpy(zero_copy_only=False)
    keys["n_features"], keys["weight"] = column("n_features"), column("weight")
    return keys.view(_TEXT)


def unpack(keys: np.ndarray, rank: np.ndarray | None) -> pa.RecordBatch:
    keys = keys.view(_KEY)

    def column(x):
        return (x.astype(np.uint64) ^ _TOP).view(np.int64)
    n = len(keys)
    return pa.RecordBatch.from_arrays(
        [pa.array(column(keys["doc_id"]), mask=keys["there"] == 0), pa.array(column(keys["n_features"])),
         pa.array(column(keys["weight"])), pa.array(column(~keys["score"].astype(np.uint64))),
         pa.nulls(n, pa.int64()) if rank is None else pa.array(rank)], names=RESULT)


RESULT = ["doc_id", "n_features", "weight", "score", "rank"]
_RANKED = "doc_id long, n_features long, weight long, score long, rank long"


def sort_runs(rows: DataFrame) -> DataFrame:
    """Sorted runs of at most `RUN` rows: distinct packed keys and how often each occurs."""
    def runs(batches):
        held, n = [], 0

        def run():
            keys, counts = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_pydict({"keys": [keys.tobytes()], "counts": [counts.astype(np.int64).tobytes()]})
        for batch in batches:
            keys = pack(batch)
            for at in range(0, len(keys), RUN):
                held.append(keys[at: at + RUN])
                n += len(held[-1])
                if n >= RUN:
                    yield run()
                    held, n = [], 0
        if n:
            yield run()

    return rows.select("doc_id", "n_features", "weight", "score").mapInArrow(runs, "keys binary, counts binary")


def regular(keys: np.ndarray, weights: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """At most `n` of the sorted keys at regular places of their weight, and the weight each stands for."""
    total = np.cumsum(weights)
    places = (np.arange(n) + 0.5) * (total[-1] / n)
    at, times = np.unique(np.minimum(np.searchsorted(total, places), len(keys) - 1), return_counts=True)
    return keys[at], times * (total[-1] / n)


def splitters(scope: Scope, runs: DataFrame, parts: int) -> np.ndarray:
    """Sorted keys that cut the rows into about equal parts, from regular samples of the runs.

    Samples beyond `SPLIT_FROM` are sorted and sampled in runs of their own until so many are left.
    """
    def sample(batches):
        for batch in batches:
            for blob, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                keys, weights = regular(np.frombuffer(blob, _TEXT), np.frombuffer(counts, np.int64), SAMPLES)
                yield pa.RecordBatch.from_arrays([pa.array(_blobs(keys), pa.binary()), pa.array(weights)], names=["key", "weight"])

    def thin(batches):
        held, n = [], 0

        def run():
            table = pa.Table.from_batches(held)
            keys, weights = _samples(table["key"].to_pylist(), table["weight"].to_pylist())
            keys, weights = regular(keys, weights, SAMPLES)
            return pa.RecordBatch.from_arrays([pa.array(_blobs(keys), pa.binary()), pa.array(weights)], names=["key", "weight"])
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= SPLIT_FROM:
                yield run()
                held, n = [], 0
        if n:
            yield run()

    found = scope.table(runs.mapInArrow(sample, "key binary, weight double"), "samples")
    while (n := found.count()) > SPLIT_FROM:
        files = max(1, n // SPLIT_FROM)
        found = scope.table(found.repartition(files, F.xxhash64("key")).mapInArrow(thin, "key binary, weight double"), "samples")
    rows = found.collect()
    if not rows or parts < 2:
        return np.zeros(0, _TEXT)
    keys, weights = _samples([bytes(r.key) for r in rows], [r.weight for r in rows])
    total = np.cumsum(weights)
    return np.unique(keys[np.minimum(np.searchsorted(total, np.arange(1, parts) * (total[-1] / parts)), len(keys) - 1)])


def _samples(blobs: list[bytes], weights: list[float]) -> tuple[np.ndarray, np.ndarray]:
    keys = np.frombuffer(b"".join(blobs), _TEXT)
    order = np.argsort(keys, kind="stable")
    return keys[order], np.array(weights)[order]


def _blobs(keys: np.ndarray) -> list[bytes]:
    data, size = keys.tobytes(), _KEY.itemsize
    return [data[i: i + size] for i in range(0, len(data), size)]


def merge_two(a, b):
    """Two sorted runs of distinct keys with counts as one; equal keys add up their counts."""
    keys = np.empty(len(a[0]) + len(b[0]), _TEXT)
    counts = np.empty(len(keys), np.int64)
    for (x, n), other, side in ((a, b, "left"), (b, a, "right")):
        at = np.arange(len(x)) + np.searchsorted(other[0], x, side=side)
        keys[at], counts[at] = x, n
    first = np.ones(len(keys), bool)
    first[1:] = keys[1:] != keys[:-1]
    return keys[first], np.add.reduceat(counts, np.flatnonzero(first)) if len(keys) else counts


def merge(runs: list) -> tuple[np.ndarray, np.ndarray]:
    """All runs as one, merged in pairs."""
    while len(runs) > 1:
        runs = [merge_two(*runs[i: i + 2]) if i + 1 < len(runs) else runs[i] for i in range(0, len(runs), 2)]
    return runs[0]


def expand(keys: np.ndarray, counts: np.ndarray, first_rank: int | None, drawn: int = 0, step: int = 1 << 16):
    """Rows of (key, count) in order, in batches; ranks count from `first_rank` and end with `drawn`."""
    ends = np.cumsum(counts)
    for lo in range(0, int(ends[-1]) if len(ends) else 0, step):
        place = np.arange(lo, min(lo + step, int(ends[-1])))
        rows = keys[np.searchsorted(ends, place, side="right")]
        rank = None
        if first_rank is not None:
            rank = place + first_rank
            rank = np.ma.masked_greater(rank, drawn)
        yield unpack(rows, rank)


def rank(scope: Scope, rows: DataFrame, share: int = SHARE) -> DataFrame:
    """`rows` (doc_id, n_features, weight, score) with the rank of the `share` percent highest scores."""
    runs = scope.table(sort_runs(rows), "runs")
    total = rows.count()
    drawn = share * total // 100
    cuts = splitters(scope, runs, -(-total // PART))

    def cut(batches):
        for batch in batches:
            for blob, count in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                keys, counts = np.frombuffer(blob, _TEXT), np.frombuffer(count, np.int64)
                edges = [0, *np.searchsorted(keys, cuts, side="left").tolist(), len(keys)]
                pieces = [(p, keys[i:j].tobytes(), counts[i:j].tobytes(), int(counts[i:j].sum()))
                          for p, (i, j) in enumerate(zip(edges, edges[1:])) if j > i]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*pieces), (pa.int32(), pa.binary(), pa.binary(), pa.int64()))],
                    names=["part", "keys", "counts", "n"])

    segments = scope.table(runs.mapInArrow(cut, "part int, keys binary, counts binary, n long"), "segments")
    sizes = np.zeros(len(cuts) + 1, np.int64)
    for r in segments.groupBy("part").agg(F.sum("n").alias("n")).collect():
        sizes[r.part] = r.n
    before = np.cumsum(sizes) - sizes  # prefix counts: rows in the parts before
    ranked = int(np.searchsorted(before, drawn, side="left"))  # parts from here on begin after the last drawn row

    def merged(batches):
        part, held = None, []
        for batch in batches:
            for p, blob, count in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if p != part and held:
                    yield from expand(*merge(held), int(before[part]) + 1, drawn)
                    held = []
                part = p
                held.append((np.frombuffer(blob, _TEXT), np.frombuffer(count, np.int64)))
        if held:
            yield from expand(*merge(held), int(before[part]) + 1, drawn)

    def undrawn(batches):
        for batch in batches:
            for blob, count in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                yield from expand(np.frombuffer(blob, _TEXT), np.frombuffer(count, np.int64), None)

    inside = segments.where(F.col("part") < ranked).select("part", "keys", "counts").repartition("part").sortWithinPartitions("part")
    outside = segments.where(F.col("part") >= ranked).select("part", "keys", "counts")
    return inside.mapInArrow(merged, _RANKED).unionByName(outside.mapInArrow(undrawn, _RANKED))


def resample(scope: Scope, docs: DataFrame, target: DataFrame, ngrams: int = NGRAMS, buckets: int = BUCKETS,
             seed: str = SEED, least_words: int = LEAST_WORDS, share: int = SHARE) -> DataFrame:
    """doc_id, n_features, weight, score and rank (null where not drawn) of every row of `docs`."""
    gain = gains(bucket_counts(docs, ngrams, buckets), bucket_counts(target, ngrams, buckets))
    scored = scope.table(weigh(docs, gain, ngrams, seed), "scored")
    enough = scored.where(F.col("n_words") >= least_words)
    short = scored.where(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long"))
    return rank(scope, enough, share).unionByName(short.select(*RESULT))


@query("op11_importance_resampling")
def op11_importance_resampling(spark, sf_dir):
    common.small_batches(spark)
    with Scope(spark, "resampling") as scope:
        return scope.keep(resample(scope, common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark")))
