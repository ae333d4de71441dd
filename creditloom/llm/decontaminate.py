"""Benchmark decontamination by the q-gram lemma.

An occurrence of a benchmark item of m characters with at most k edits shares at least
m - q + 1 - k * q of its q-grams with the document, all on diagonals (document position minus item
position) that differ by at most k. Diagonals are cut into bands of 2 * (k + 1) that overlap by half, so
some band holds them all: bands with fewer shared q-grams are left out without loss. What remains
is aligned exactly inside its band.

Texts are compared in lower case with every run of characters other than letters and digits as one
blank; positions returned are those of the original text, in characters. The edit budget is a tenth
of the item, less for short items so that the lemma still asks for `LEAST` common q-grams, and none
for items under 19 characters. An item that is shorter than a q-gram is found where it stands as whole
words.

The benchmark is cut into parts by hash, which tasks write to the shared folder. A task reads its
documents once and holds one part of the benchmark at a time; the driver holds none of it.

Defined results: null and empty texts match nothing; of equally good places of one item in one row the first is
returned; repeated rows match each on its own; with an empty table on either side nothing is found.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import kept_folder
from . import common
from .registry import query

Q = 8
LEAST = 4
BUDGET = 10  # one edit in so many characters
BLOCK_CHARS = 8 << 20  # benchmark text that a task holds at a time
PROBE_BITS = 22
_STEP = np.int64(1) << np.int64(32)


def budget(m: int, q: int = Q) -> int:
    """Edits allowed in an item of m characters."""
    return max(0, min(m // BUDGET, (m - q + 1 - LEAST) // q))


FOLDED = 0x3100  # scripts and punctuation below are folded, code points from here on stay as they are


def _make_folded() -> np.ndarray:
    """Per code point its lower-case letter or digit, or a blank."""
    table = np.full(FOLDED, 32, np.uint32)
    for c in range(FOLDED):
        if chr(c).isalnum():
            low = chr(c).lower()
            table[c] = ord(low) if len(low) == 1 else c
    return table


_FOLDED = _make_folded()


def normal(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Folded characters and their positions in `text`."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    folded = np.where(points < FOLDED, _FOLDED[np.minimum(points, FOLDED - 1)], points)
    keep = folded != 32
    keep[1:] |= folded[:-1] != 32
    if len(keep):
        keep[0] = folded[0] != 32
    at = np.flatnonzero(keep)
    if len(at) and folded[at[-1]] == 32:
        at = at[:-1]
    return folded[at], at


def grams(chars: np.ndarray, q: int = Q) -> np.ndarray:
    """Hash of each q-gram."""
    n = len(chars) - q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    if q & (q - 1):
        raise ValueError("q must be a power of two")
    total, width, base = chars.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15), 1, 0x2545F4914F6CDD1D
    while width < q:
        total = total[:-width] * np.uint64(pow(base, width, 1 << 64)) + total[width:]
        width *= 2
    return (total ^ (total >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


class Index:
    """The q-grams of all items: a probe table of bits, sorted hashes and their postings."""

    def __init__(self, items: list[tuple[int, str]]):
        self.ids, self.chars = [], []
        self.words: dict[bytes, list[int]] = {}  # items shorter than a q-gram
        hashes, item, place = [], [], []
        for key, text in items:
            chars, _ = normal(text or "")
            if len(chars) < Q:
                if len(chars):
                    self.words.setdefault(chars.tobytes(), []).append(key)
                continue
            g = grams(chars)
            hashes.append(g)
            item.append(np.full(len(g), len(self.ids)))
            place.append(np.arange(len(g)))
            self.ids.append(key)
            self.chars.append(chars)
        self.length = np.array([len(c) for c in self.chars], np.int64)
        self.edits = np.array([budget(int(m)) for m in self.length], np.int64)
        self.least = self.length - Q + 1 - self.edits * Q
        self.width = self.edits + 1
        flat = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        order = np.argsort(flat, kind="stable")
        self.item = (np.concatenate(item) if item else np.zeros(0, np.int64))[order]
        self.place = (np.concatenate(place) if place else np.zeros(0, np.int64))[order]
        self.hashes, first, self.counts = np.unique(flat[order], return_index=True, return_counts=True)
        self.starts = first
        self.probe = np.zeros(1 << PROBE_BITS, bool)
        self.probe[self._slot(self.hashes)] = True

    @staticmethod
    def _slot(hashes: np.ndarray) -> np.ndarray:
        return (hashes >> np.uint64(64 - PROBE_BITS)).astype(np.int64)

    def whole_words(self, chars: np.ndarray) -> list[tuple[int, int, int, int]]:
        """(item id, first start, end, places) of the shortest items that stand as whole words in one text."""
        if not self.words or not len(chars):
            return []
        blank = np.concatenate([[-1], np.flatnonzero(chars == 32), [len(chars)]])
        first, ends = blank[:-1] + 1, set(blank.tolist())
        found: dict[bytes, list[int]] = {}
        for size in {len(w) // 4 for w in self.words}:
            for at in first[first + size <= len(chars)].tolist():
                if at + size in ends and (piece := chars[at: at + size].tobytes()) in self.words:
                    found.setdefault(piece, []).append(at)
        return [(key, min(at), min(at) + len(w) // 4, len(at)) for w, at in found.items() for key in self.words[w]]

    def regions(self, chars: np.ndarray, bounds: np.ndarray) -> list[tuple[int, int, int, int]]:
        """(row, item, band, common q-grams) of every band that meets the bound; `bounds` are the
        borders of the rows in `chars`."""
        g = grams(chars)
        at = np.flatnonzero(self.probe[self._slot(g)])
        if not len(at) or not len(self.hashes):
            return []
        row = np.searchsorted(bounds, at, side="right") - 1
        inside = at + Q <= bounds[row + 1]
        at, row = at[inside], row[inside]
        found = np.minimum(np.searchsorted(self.hashes, g[at]), len(self.hashes) - 1)
        real = self.hashes[found] == g[at]
        at, row, found = at[real], row[real], found[real]
        counts = self.counts[found]
        post = np.arange(int(counts.sum())) + np.repeat(
            self.starts[found] - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts)
        at, row, item = np.repeat(at, counts), np.repeat(row, counts), self.item[post]
        # A row and item that share too few q-grams in all cannot share enough in a band.
        pair = row * len(self.ids) + item
        pairs, back, total = np.unique(pair, return_inverse=True, return_counts=True)
        enough = (total >= self.least[pairs % len(self.ids)])[back]
        at, pair, item, row, post = at[enough], pair[enough], item[enough], row[enough], post[enough]
        diagonal = at - bounds[row] - self.place[post]
        band = diagonal // self.width[item]
        bands = int(len(chars)) + 4
        lowest = int(self.length.max())
        keys = np.concatenate([pair * (bands + lowest) + band + lowest, pair * (bands + lowest) + band - 1 + lowest])
        keys, counts = np.unique(keys, return_counts=True)
        pair, band = keys // (bands + lowest), keys % (bands + lowest) - lowest
        row, item = pair // len(self.ids), pair % len(self.ids)
        kept = counts >= self.least[item]
        return list(zip(row[kept].tolist(), item[kept].tolist(), band[kept].tolist(), counts[kept].tolist()))


def align(item: np.ndarray, texts: list[np.ndarray], lows: list[int], width: int) -> np.ndarray:
    """Fewest edits, start and end of `item` in each text, on diagonals low <= d < low + width.

    All texts advance together, one item character a step. A cell holds edits * 2^32 + start, so the
    minimum carries the start along; the step inside a row is a running minimum.
    """
    n, m = len(texts), len(item)
    span = width + m
    window = np.zeros((n, span), np.uint32)
    valid = np.zeros((n, span + 1), bool)
    for k, (text, low) in enumerate(zip(texts, lows)):
        first, last = max(0, low), min(len(text), low + span)
        if last > first:
            window[k, first - low: last - low] = text[first:last]
        valid[k, max(0, -low): max(0, min(span, len(text) - low) + 1)] = True
    big = np.int64(1) << np.int64(50)
    columns = np.arange(width, dtype=np.int64)
    cost = np.where(valid[:, :width], columns[None, :], big)
    rise = columns * _STEP
    for i in range(m):
        differs = window[:, i: i + width] != item[i]
        here = cost + np.where(differs, _STEP, 0)
        here[:, :-1] = np.minimum(here[:, :-1], cost[:, 1:] + _STEP)
        cost = np.minimum.accumulate(here - rise, axis=1) + rise
        cost = np.where(valid[:, i + 1: i + 1 + width], cost, big)
    best = np.argmin(cost, axis=1)
    value = cost[np.arange(n), best]
    low = np.asarray(lows, np.int64)
    return np.stack([value >> np.int64(32), (value & (_STEP - 1)) + low, best + m + low], axis=1)


def matches(index: Index, texts: list[str]) -> list[tuple[int, int, int, int, int, int]]:
    """(row, item_id, start, end, edits, regions): the best place of each item found in each row."""
    folded = [normal(t) for t in texts]
    bounds = np.concatenate([[0], np.cumsum([len(c) for c, _ in folded])]).astype(np.int64)
    chars = np.concatenate([c for c, _ in folded]) if folded else np.zeros(0, np.uint32)
    by_item: dict[int, list] = {}
    for row, item, band, _ in index.regions(chars, bounds):
        by_item.setdefault(item, []).append((row, band))
    best: dict[tuple[int, int], tuple] = {}
    for item, places in by_item.items():
        width = int(index.width[item])
        for k in range(0, len(places), 256):
            part = places[k: k + 256]
            found = align(index.chars[item], [folded[r][0] for r, _ in part], [b * width for _, b in part], 2 * width)
            for (row, _), (edits, start, end) in zip(part, found.tolist()):
                if edits <= index.edits[item]:
                    known = best.get((row, item))
                    ends = known[3] | {end} if known else {end}
                    place = min((edits, start, end), known[:3]) if known else (edits, start, end)
                    best[row, item] = (*place, ends)
    out = []
    for (row, item), (edits, start, end, ends) in sorted(best.items()):
        at = folded[row][1]
        out.append((row, index.ids[item], int(at[start]), int(at[end - 1]) + 1, edits, len(ends)))
    for row, (chars_, at) in enumerate(folded):
        out += [(row, key, int(at[start]), int(at[end - 1]) + 1, 0, n) for key, start, end, n in index.whole_words(chars_)]
    return out


def write_parts(benchmark: DataFrame) -> tuple[str, list[int]]:
    """(folder, parts): the benchmark in files of about `BLOCK_CHARS` characters, written by tasks. The
    folder goes when the Python process ends."""
    spark = benchmark.sparkSession
    total = int(benchmark.agg(F.sum(F.length("text").cast("long"))).first()[0] or 0)
    n = total // BLOCK_CHARS + 1
    folder = kept_folder(spark, "benchmark")

    def write(batches):
        held: dict[int, list] = {}
        for batch in batches:
            for part, key, text in zip(*(c.to_pylist() for c in batch.columns)):
                held.setdefault(part, []).append((key, text))
        for part, items in held.items():
            items.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1] or ""))
            common.write_file(f"{folder}/{part}", json.dumps(items).encode())
            yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32())})

    dealt = benchmark.select(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)).cast("int").alias("part"),
                             F.col("item_id").cast("long").alias("item_id"), "text")
    parts = dealt.repartition(n, "part").mapInArrow(write, "part int")
    return folder, sorted(r[0] for r in parts.collect())


class Parts:
    """The parts of a benchmark in a task, of which the last one used is kept."""

    def __init__(self, folder: str, parts: list[int]):
        self.folder, self.parts, self.held = folder, parts, (None, None)

    def __iter__(self):
        for part in self.parts:
            if self.held[0] != part:
                self.held = part, Index(json.loads(common.read_file(f"{self.folder}/{part}")))
            yield self.held[1]


def _groups(batch: pa.RecordBatch, column: int):
    """(first row, texts) of slices of a batch."""
    texts = batch.column(column)
    offsets = np.concatenate([[0], np.cumsum([len(t) if t else 0 for t in texts.to_pylist()])])
    for i, j in common.row_slices(offsets, 1 << 20):
        yield i, [t or "" for t in texts.slice(i, j - i).to_pylist()]


def find(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, start, end, edits, regions for every item found in a row of `docs`."""
    folder, parts = write_parts(benchmark)
    names = ["doc_id", "item_id", "start", "end", "edits", "regions"]

    def run(batches):
        indexes = Parts(folder, parts)
        for batch in batches:
            keys = batch.column(0)
            for index in indexes:
                rows = [(keys[i + row].as_py(), *rest) for i, texts in _groups(batch, 1)
                        for row, *rest in matches(index, texts)]
                columns = list(zip(*rows)) or [[]] * 6
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    return docs.select("doc_id", "text").mapInArrow(run, ", ".join(f"{c} long" for c in names))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of `docs` in which no item is found, all columns unchanged: no shuffle."""
    text = docs.columns.index("text")
    folder, parts = write_parts(benchmark)

    def run(batches):
        indexes = Parts(folder, parts)
        for batch in batches:
            keep = np.ones(batch.num_rows, bool)
            for index in indexes:
                for i, texts in _groups(batch, text):
                    for row, *_ in matches(index, texts):
                        keep[i + row] = False
            yield batch.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)


@query("op7_decontamination")
def op7_decontamination(spark, sf_dir):
    common.small_batches(spark)
    return find(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark"))
