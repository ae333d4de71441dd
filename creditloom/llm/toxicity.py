"""Toxicity by a bidirectional gated recurrent network with attention pooling.

A text is read in overlapping windows of words. A word enters as two inputs: its word vector (how its
occurrences in labelled rows lean, how often it occurs there, and a hashed embedding) and its
character vector (how its beginnings of several lengths lean, and the mean of hashed embeddings of
its character trigrams). Two gated recurrent layers
read a window in both directions, attention weighs their states, and a logit comes out. The score of
a document is that of its worst window, calibrated.

Training runs in numpy on the driver over a bounded sample of labelled rows (`SAMPLE`), never over
rows that are held out. A training text sees word statistics of the other folds of the sample only,
so a word that occurs once does not give its own label away. In a toxic document any window
may be the toxic one: the window that looks worst so far is taken as its positive example.

Defined results: a text without words has score 0; rows with a null doc_id are scored and count as
not held out, and are never learned from; repeated rows get the same score; several labels of one
document count as toxic if one says so; without any label of both kinds all scores are 0.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .registry import query

SAMPLE = {1: 1000, 0: 2000}  # labelled rows taken at most of each label, the first by a hash of doc_id
WINDOW, STRIDE = 24, 12
HIDDEN, WORD_DIM, CHAR_DIM, ATTENTION = 8, 4, 4, 8
ROWS = 1 << 14  # rows of the hashed embeddings
FOLDS = 4
STEPS, BATCH, RATE = 800, 128, 0.01
DRAWN = 20_000  # windows of clean texts looked at when the worst ones are chosen anew
KEEP, EMBEDDING_RATE, DECAY = 0.5, 0.1, 0.1  # against learning single words of the sample by heart
THRESHOLD = 0.3
LEAST_SEEN = 2  # rows of the sample in which a word must occur to have statistics

_SEPARATOR = np.ones(256, bool)
_SEPARATOR[list(b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")] = False
_SEPARATOR[128:] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


@dataclass
class Words:
    """The words of a slice of texts: distinct words with their bytes, and the text as their numbers."""
    hashes: np.ndarray
    keys: np.ndarray  # per distinct word: its hash and those of its beginnings, 0 where it is shorter
    sequence: np.ndarray
    rows: np.ndarray
    grams: np.ndarray  # embedding rows of the character trigrams, flat
    gram_starts: np.ndarray
    n: int


def read_words(buf: np.ndarray, offsets: np.ndarray) -> Words:
    buf = _LOWER[buf]
    starts, ends, rows = common.word_spans(buf, offsets, _SEPARATOR)
    sums = common.prefix_hash(buf)
    hashes = common.range_hash(sums, starts, ends)
    distinct, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
    begin, size = starts[first], (ends - starts)[first]
    keys = [distinct] + [np.where(size >= k, common.range_hash(sums, begin, np.minimum(begin + k, begin + size))
                                  + np.uint64(k), 0) for k in BEGINNINGS]
    # Trigrams of bytes over the word with one border byte on each side: as many as it has bytes.
    counts = size
    flat = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
    at = np.repeat(begin, counts) + flat
    last = flat == np.repeat(counts, counts) - 1
    wide = buf.astype(np.uint64)
    left = np.where(flat > 0, wide[np.maximum(at - 1, 0)], 1) if len(at) else wide[:0]
    right = np.where(last, 2, wide[np.minimum(at + 1, max(len(buf) - 1, 0))]) if len(at) else wide[:0]
    grams = common.mix((left << np.uint64(16)) | (wide[at] << np.uint64(8)) | right) % np.uint64(ROWS)
    return Words(distinct, np.stack(keys, axis=1).astype(np.uint64), inverse.astype(np.int32), rows, grams.astype(np.int32),
                 np.concatenate([[0], np.cumsum(counts)]), len(offsets) - 1)


def read_all(texts: list[str]) -> Words:
    """`read_words` of many texts, slice by slice."""
    buf, offsets = common.text_buffer(pa.array(texts, pa.large_string()))
    parts = [read_words(buf[offsets[i]: offsets[j]], offsets[i: j + 1] - offsets[i]) for i, j in common.row_slices(offsets)]
    if not parts:
        return read_words(buf, offsets)
    base = np.cumsum([0] + [len(p.hashes) for p in parts])
    hashes, first, inverse = np.unique(np.concatenate([p.hashes for p in parts]), return_index=True, return_inverse=True)
    rows = np.cumsum([0] + [p.n for p in parts])
    flat = np.concatenate([p.grams for p in parts])
    counts = np.concatenate([np.diff(p.gram_starts) for p in parts])
    every = Words(hashes, None, None, None, flat, np.concatenate([[0], np.cumsum(counts)]), rows[-1])
    grams, starts = _gram_rows(every, first)
    return Words(hashes, np.concatenate([p.keys for p in parts])[first],
                 np.concatenate([inverse[base[k] + p.sequence] for k, p in enumerate(parts)]).astype(np.int32),
                 np.concatenate([p.rows + rows[k] for k, p in enumerate(parts)]).astype(np.int32), grams, starts, int(rows[-1]))


def windows(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, first word, words) of every overlapping window; the last one ends with the text."""
    count = np.bincount(words.rows, minlength=words.n)
    begin = np.cumsum(count) - count
    extra = np.maximum(count - WINDOW, 0)
    number = np.where(count > 0, 1 + -(-extra // STRIDE), 0)
    row = np.repeat(np.arange(words.n), number)
    k = np.arange(int(number.sum())) - np.repeat(np.cumsum(number) - number, number)
    start = begin[row] + np.minimum(k * STRIDE, extra[row])
    return row, start, np.minimum(count[row], WINDOW)


class Statistics:
    """How words lean: z-scores of the log odds between toxic and other rows of a sample."""

    def __init__(self, hashes: np.ndarray, lean: np.ndarray, seen: np.ndarray):
        self.hashes, self.lean, self.seen = hashes, lean, seen

    @classmethod
    def folds(cls, documents: list[np.ndarray], labels: np.ndarray, fold: np.ndarray) -> list[Statistics]:
        """Statistics of all rows, then those without fold 0, 1, ...; `documents` holds the distinct
        keys of each row."""
        flat = np.concatenate(documents)
        flat.sort()
        # Values that occur LEAST_SEEN times are equal to the one LEAST_SEEN - 1 places before.
        hashes = np.unique(flat[LEAST_SEEN - 1:][flat[LEAST_SEEN - 1:] == flat[: len(flat) - LEAST_SEEN + 1]])
        del flat
        all_, ones = np.zeros((FOLDS, len(hashes))), np.zeros((FOLDS, len(hashes)))
        for row, keys in enumerate(documents):
            at = np.searchsorted(hashes, keys)
            at = at[at < len(hashes)] if len(hashes) else at[:0]
            at = at[np.isin(hashes[at], keys, assume_unique=True)]
            all_[fold[row], at] += 1
            ones[fold[row], at] += labels[row]
        out = []
        for f in range(-1, FOLDS):
            rows = fold != f
            n1 = max(1.0, labels[rows].sum())
            n0 = max(1.0, rows.sum() - labels[rows].sum())
            seen, toxic = all_.sum(axis=0), ones.sum(axis=0)
            if f >= 0:
                seen, toxic = seen - all_[f], toxic - ones[f]
            a1, a0 = n1 / (n1 + n0), n0 / (n1 + n0)
            odds = np.log((toxic + a1) / (n1 + 2 * a1)) - np.log((seen - toxic + a0) / (n0 + 2 * a0))
            z = np.clip(odds / np.sqrt(1 / (toxic + a1) + 1 / (seen - toxic + a0)), -4, 8) / 4
            known = seen >= LEAST_SEEN
            out.append(cls(hashes, np.where(known, z, 0).astype(np.float32),
                           np.where(known, np.log1p(seen) / 4, 0).astype(np.float32)))
        return out

    def features(self, keys: np.ndarray) -> np.ndarray:
        """Lean of the word and of its beginnings, how often the word was seen, and whether it was."""
        out = np.zeros((len(keys), STATS), np.float32)
        if len(self.hashes):
            at = np.minimum(np.searchsorted(self.hashes, keys), len(self.hashes) - 1)
            hit = (self.hashes[at] == keys) & (keys != 0)
            out[:, :-2] = np.where(hit, self.lean[at], 0)
            out[:, -2] = np.where(hit[:, 0], self.seen[at[:, 0]], 0)
            out[:, -1] = out[:, -2] > 0
        return out


BEGINNINGS = (4, 5, 6, 8)  # bytes
STATS = 3 + len(BEGINNINGS)
INPUT = STATS + WORD_DIM + CHAR_DIM


def _gate(x):
    return np.clip(0.25 * x + 0.5, 0, 1)


def _limit(x):
    return np.clip(x, -1, 1)


class Network:
    def __init__(self, seed: int = 11):
        r = np.random.default_rng(seed)

        def draw(*shape, scale=0.3):
            return (r.standard_normal(shape) * scale).astype(np.float32)

        self.p = {"word": draw(ROWS, WORD_DIM, scale=0.05), "char": draw(ROWS, CHAR_DIM, scale=0.05),
                  "A": draw(2 * HIDDEN, ATTENTION), "v": draw(ATTENTION), "u": draw(2 * HIDDEN), "b": np.zeros(1, np.float32)}
        for d in "fb":
            self.p |= {f"W{d}": draw(INPUT, 3 * HIDDEN), f"c{d}": np.zeros(3 * HIDDEN, np.float32),
                       f"U{d}": draw(HIDDEN, 2 * HIDDEN), f"R{d}": draw(HIDDEN, HIDDEN)}
        self.calibration = (1.0, 0.0)

    def inputs(self, words: Words, stats: Statistics) -> np.ndarray:
        """Input vector of each distinct word."""
        return np.concatenate([stats.features(words.keys), self.embeddings(words)], axis=1)

    def embeddings(self, words: Words) -> np.ndarray:
        """Hashed embeddings of each distinct word and of its characters."""
        chars = np.zeros((len(words.hashes), CHAR_DIM), np.float32)
        if len(words.grams):
            sums = np.add.reduceat(self.p["char"][words.grams], words.gram_starts[:-1], axis=0)
            chars = sums / np.diff(words.gram_starts)[:, None].astype(np.float32)
        rows = (words.hashes % np.uint64(ROWS)).astype(np.int64)
        return np.concatenate([self.p["word"][rows], chars], axis=1)

    def forward(self, x: np.ndarray, index: np.ndarray, length: np.ndarray, trace: list | None = None) -> np.ndarray:
        """Logit of each window: `index` (windows, WINDOW) points into the word inputs `x`."""
        n = len(index)
        states = np.empty((WINDOW, n, 2 * HIDDEN), np.float32)
        for part, d in enumerate("fb"):
            projected = x @ self.p[f"W{d}"] + self.p[f"c{d}"]
            h = np.zeros((n, HIDDEN), np.float32)
            for t in range(WINDOW) if d == "f" else range(WINDOW - 1, -1, -1):
                into = projected[index[:, t]]
                live = (t < length)[:, None]
                gates = _gate(into[:, : 2 * HIDDEN] + h @ self.p[f"U{d}"])
                z, r = gates[:, :HIDDEN] * live, gates[:, HIDDEN:]
                raw = into[:, 2 * HIDDEN:] + (r * h) @ self.p[f"R{d}"]
                c = _limit(raw)
                new = h + z * (c - h)
                if trace is not None:
                    trace.append((d, t, h, gates, z, r, raw, c, live))
                h = new
                states[t, :, part * HIDDEN: (part + 1) * HIDDEN] = h
        hidden = _limit(states @ self.p["A"])
        energy = hidden @ self.p["v"]
        energy[np.arange(WINDOW)[:, None] >= length[None, :]] = -1e9
        weight = np.exp(energy - energy.max(axis=0))
        weight /= weight.sum(axis=0)
        pooled = np.einsum("tn,tnh->nh", weight, states)
        logit = pooled @ self.p["u"] + self.p["b"][0]
        if trace is not None:
            trace.append((states, hidden, weight, pooled))
        return logit

    def gradients(self, x: np.ndarray, index: np.ndarray, length: np.ndarray, target: np.ndarray):
        """Loss gradients of all weights, and of the word inputs."""
        trace: list = []
        logit = self.forward(x, index, length, trace)
        states, hidden, weight, pooled = trace.pop()
        n = len(index)
        g = {k: np.zeros_like(v) for k, v in self.p.items() if k not in ("word", "char")}
        dlogit = ((1 / (1 + np.exp(-logit)) - target) / n).astype(np.float32)
        g["u"], g["b"][0] = pooled.T @ dlogit, dlogit.sum()
        dpooled = dlogit[:, None] * self.p["u"]
        dstates = weight[:, :, None] * dpooled[None]
        dweight = np.einsum("tnh,nh->tn", states, dpooled)
        denergy = weight * (dweight - (weight * dweight).sum(axis=0))
        g["v"] = np.einsum("tna,tn->a", hidden, denergy)
        draw = denergy[:, :, None] * self.p["v"] * (np.abs(hidden) < 1)
        g["A"] = np.einsum("tnh,tna->ha", states, draw)
        dstates += draw @ self.p["A"].T
        dx = np.zeros_like(x)
        carry = {"f": np.zeros((n, HIDDEN), np.float32), "b": np.zeros((n, HIDDEN), np.float32)}
        for d, t, h, gates, z, r, raw, c, live in reversed(trace):
            part = 0 if d == "f" else HIDDEN
            dh = carry[d] + dstates[t, :, part: part + HIDDEN]
            dz = dh * (c - h) * live
            draw_ = dh * z * (np.abs(raw) < 1)
            drh = draw_ @ self.p[f"R{d}"].T
            g[f"R{d}"] += (r * h).T @ draw_
            dgates = np.concatenate([dz, drh * h], axis=1) * 0.25 * ((gates > 0) & (gates < 1))
            g[f"U{d}"] += h.T @ dgates
            into = np.concatenate([dgates, draw_], axis=1)
            g[f"c{d}"] += into.sum(axis=0)
            g[f"W{d}"] += x[index[:, t]].T @ into
            np.add.at(dx, index[:, t], into @ self.p[f"W{d}"].T)
            carry[d] = dh * (1 - z) + drh * r + dgates @ self.p[f"U{d}"].T
        return g, dx

    def scores(self, words: Words, stats: Statistics) -> np.ndarray:
        """Largest logit over the windows of each row; rows without words have minus infinity."""
        best = np.full(words.n, -np.inf, np.float32)
        row, start, length = windows(words)
        x = self.inputs(words, stats)
        for k in range(0, len(row), 8192):
            index = self._index(words, start[k: k + 8192], length[k: k + 8192])
            np.maximum.at(best, row[k: k + 8192], self.forward(x, index, length[k: k + 8192]))
        return best

    @staticmethod
    def _index(words: Words, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        steps = np.minimum(np.arange(WINDOW)[None, :], length[:, None] - 1)
        return words.sequence[start[:, None] + steps]

    def probability(self, logits: np.ndarray) -> np.ndarray:
        a, b = self.calibration
        return np.where(np.isneginf(logits), 0.0, 1 / (1 + np.exp(-np.clip(a * logits.astype(np.float64) + b, -40, 40))))


def fit(texts: list[str], labels: np.ndarray, weight: float = 1.0) -> tuple[Network, Statistics]:
    """Train on labelled texts; their order decides which fold each belongs to. `weight` says how
    many labelled rows that are not toxic one of the sample stands for, against a toxic one.

    Word statistics that a text is trained with come from the other folds only, those the result
    scores with from all of them.
    """
    words = read_all(texts)
    n, size = len(texts), len(words.hashes)
    fold = np.zeros(n, np.int64)
    for label in (0, 1):  # every fold has its share of both labels
        some = np.flatnonzero(labels == label)
        fold[some] = np.arange(len(some)) % FOLDS
    pairs = np.unique(words.rows.astype(np.int64) * (size + 1) + words.sequence)
    owner, word = pairs // (size + 1), pairs % (size + 1)
    cut = np.searchsorted(owner, np.arange(n + 1))
    distinct = [np.unique(words.keys[word[cut[i]: cut[i + 1]]]) for i in range(n)]
    stats, *others = Statistics.folds(distinct, labels.astype(float), fold)
    features = np.concatenate([other.features(words.keys) for other in others])
    network = Network()
    row, start, length = windows(words)
    if not len(row):
        return network, stats
    # Row f * size + w of the inputs is word w as fold f sees it.
    index = (Network._index(words, start, length) + (fold[row] * size)[:, None]).astype(np.int32)
    positive = labels[row] == 1
    word_rows = (words.hashes % np.uint64(ROWS)).astype(np.int64)

    def logits(chosen):
        embeddings, out = network.embeddings(words), []
        for k in np.array_split(chosen, len(chosen) // 8192 + 1):
            used, local = np.unique(index[k], return_inverse=True)
            x = np.concatenate([features[used], embeddings[used % size]], axis=1)
            out.append(network.forward(x, local.reshape(len(k), WINDOW), length[k]))
        return np.concatenate(out)

    rng = np.random.default_rng(3)
    view = features[:, :-2].max(axis=1)[index].max(axis=1)  # until the network knows better
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in network.p.items()}
    for step in range(STEPS):
        if step % 100 == 0:
            if step:
                # all windows of toxic texts, and a new draw of the others
                looked = np.union1d(np.flatnonzero(positive), rng.choice(np.flatnonzero(~positive), DRAWN))
                view = np.full(len(row), -np.inf, np.float32)
                view[looked] = logits(looked)
            order = np.lexsort((-view, row))
            first = np.concatenate([[True], row[order][1:] != row[order][:-1]])
            worst = order[first]
            ones = worst[positive[worst]]
            zeros, hard = np.flatnonzero(~positive), worst[~positive[worst] & (view[worst] > -np.inf)]
            if not len(ones) or not len(zeros):
                return network, stats
        pick = np.concatenate([rng.choice(ones, BATCH // 2), rng.choice(zeros, BATCH // 4), rng.choice(hard, BATCH // 4)])
        used, local = np.unique(index[pick], return_inverse=True)
        local = local.reshape(len(pick), WINDOW)
        word = used % size
        part = Words(words.hashes[word], words.keys[word], None, None, *_gram_rows(words, word), len(used))
        # Embeddings are left out for half of the words, so the statistics must carry the decision.
        mask = np.ones((len(used), INPUT), np.float32)
        mask[:, STATS:] = rng.random((len(used), 1)) < KEEP
        g, dx = network.gradients(
            np.concatenate([features[used], network.embeddings(part)], axis=1) * mask, local, length[pick], positive[pick].astype(np.float32))
        dx *= mask
        g["word"], g["char"] = np.zeros_like(network.p["word"]), np.zeros_like(network.p["char"])
        np.add.at(g["word"], word_rows[word], dx[:, STATS: STATS + WORD_DIM])
        sizes = np.diff(part.gram_starts)
        np.add.at(g["char"], part.grams, np.repeat(dx[:, STATS + WORD_DIM:] / sizes[:, None], sizes, axis=0))
        for k, v in network.p.items():
            m, s = moments[k]
            m += 0.1 * (g[k] - m)
            s += 0.01 * (g[k] ** 2 - s)
            spread = np.sqrt(s / (1 - 0.99 ** (step + 1))) + 1e-6
            rate = RATE * (1 - 0.7 * step / STEPS) * (EMBEDDING_RATE if k in ("word", "char") else 1)
            v -= rate * ((m / (1 - 0.9 ** (step + 1))) / spread + DECAY * v)
    best = np.full(n, -np.inf, np.float32)
    np.maximum.at(best, row, logits(np.arange(len(row))))
    some = np.isfinite(best)
    network.calibration = _calibrate(best[some], labels[some], np.where(labels[some] == 1, 1.0, weight))
    return network, stats


def _gram_rows(words: Words, used: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    counts = np.diff(words.gram_starts)[used]
    starts = np.concatenate([[0], np.cumsum(counts)])
    at = np.arange(int(counts.sum())) + np.repeat(words.gram_starts[used] - starts[:-1], counts)
    return words.grams[at], starts


def _calibrate(logits: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of a logistic curve over document logits, the slope lightly held."""
    middle, spread = float(np.mean(logits)), float(np.std(logits)) + 1e-6
    x, y = (logits.astype(float) - middle) / spread, labels.astype(float)
    w = np.array([0.0, np.log((y.sum() + 1) / (len(y) - y.sum() + 1))])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(w[0] * x + w[1], -30, 30)))
        away = weights * (p - y)
        grad = np.array([(away * x).sum() + 0.1 * w[0], away.sum()])
        s = weights * p * (1 - p)
        hess = np.array([[(s * x * x).sum() + 0.1, (s * x).sum()], [(s * x).sum(), s.sum() + 1e-3]])
        w -= np.clip(np.linalg.solve(hess, grad), -1, 1)
    slope = max(0.01, float(w[0])) / spread
    return slope, float(w[1]) - slope * middle


def held_out(key) -> bool:
    return key is not None and zlib.crc32(str(key).encode()) % 4 == 2


def sample(docs: DataFrame, labels: DataFrame, bound: dict[int, int] = SAMPLE) -> tuple[list[str], np.ndarray, float]:
    """Texts and labels of a bounded number of labelled rows that are not held out, and how many
    times fewer of the clean rows than of the toxic rows were taken."""
    spread = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    one = labels.where("doc_id is not null and toxic is not null").groupBy(
        F.col("doc_id").alias("id_")).agg(F.max("toxic").alias("toxic_"))
    open_ = one.where(F.crc32(F.col("id_").cast("string").cast("binary")) % 4 != 2)
    ids = None
    for label, n in bound.items():
        part = open_.where(F.col("toxic_") == label).orderBy(F.xxhash64("id_"), "id_").limit(n)
        ids = part if ids is None else ids.unionByName(part)
    # At most sum(bound) small rows, whatever the size of the tables.
    rows = docs.select("doc_id", "text").join(F.broadcast(ids), F.col("doc_id") == F.col("id_")).orderBy(
        spread, "doc_id").select("doc_id", "text", "toxic_").dropDuplicates(["doc_id"]).collect()
    rows = sorted(rows, key=lambda r: (r.toxic_, zlib.crc32(str(r.doc_id).encode()), r.doc_id))
    there = {r[0]: r[1] for r in open_.groupBy("toxic_").count().collect()}
    rate = {k: max(1.0, there.get(k, 0) / n) for k, n in bound.items()}
    return [r.text or "" for r in rows], np.array([r.toxic_ for r in rows], np.int64), rate[0] / rate[1]


def score(docs: DataFrame, network: Network, stats: Statistics, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted for each row of `docs`; all its windows are read."""
    def run(batches):
        for batch in batches:
            buf, offsets = common.text_buffer(batch.column(1))
            parts = [network.probability(network.scores(read_words(
                buf[offsets[i]: offsets[j]], offsets[i: j + 1] - offsets[i]), stats))
                for i, j in common.row_slices(offsets)]
            p = np.concatenate(parts) if parts else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([held_out(k) for k in batch.column(0).to_pylist()], pa.bool_()),
                 pa.array(p, pa.float64()), pa.array((p >= threshold).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"])

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, held_out boolean, score double, predicted int")


@query("op10_toxicity")
def op10_toxicity(spark, sf_dir):
    common.small_batches(spark)
    docs = common.table(spark, sf_dir, "documents")
    texts, labels, weight = sample(docs, common.table(spark, sf_dir, "labels"))
    if len(set(labels.tolist())) < 2:
        return docs.select("doc_id", F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2,
                           F.lit(False)).alias("held_out"), F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
    return score(docs, *fit(texts, labels, weight))
