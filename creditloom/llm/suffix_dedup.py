"""Removal of repeated byte strings by a common-prefix-aware distributed merge sort of suffixes.

Every byte covered by a `SPAN`-byte string that also starts earlier (in a smaller doc_id, or before in
the same document) is removed. All strings are judged on the input.

1. Anchors. Each `SPAN`-byte string is assigned to the `GRAM`-byte gram in it that has the least hash, so
   equal strings have equal grams at the same place in them, and about one position in 35 is an
   anchor. Anchors whose gram occurs once in the corpus cannot lie in a repeated string.
2. Runs. Around each other anchor stands the stretch of text its strings cover: the suffix from the
   anchor on, then what lies before it, backwards. A task sorts these, settles equal ones among
   themselves, cuts the sorted list at the splitters of the parts, and sends each part a front-coded
   run: common prefix with the line before, and the rest.
3. Merge. A part combines its runs with a loser tree that keeps for every loser the prefix it has in
   common with the winner. Two lines with different known prefixes need no comparison, others are
   compared behind it. The output carries the common prefix of neighbours, which gives the classes of
   equal grams and of equal stretches.
4. In a class with one stretch all but the first occurrence are repeated in full; in other classes the
   single strings are grouped by hash, within a part.

Anchors whose gram occurs more than `HOT` times skip the runs: their strings become rows that are
grouped by Spark with map-side minima, so no class is gathered in one task whatever its size.

Defined results: a null or empty text has 0 bytes and the digest of nothing; texts under `SPAN` bytes are
kept whole; a null doc_id counts as the smallest; rows that share doc_id and text are one document
(equal results), rows that share only the doc_id are ordered by text hash; an empty table gives none.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import Scope
from . import common
from .registry import query

SPAN, GRAM = 100, 32
WIDE = SPAN - GRAM + 1  # grams of one string
HOT = 20_000
PART_BYTES = 2 << 20  # text per part; only some of its anchors are sent
RANGES = 1024  # splitters at most; beyond that a range is cut further by gram hash
RUN_LINES = 60_000
SAMPLE_DOCS = 1500  # documents whose grams place the splitters; they only balance the parts
LINE = SPAN + WIDE + 2
PIECE = 8 << 20
SLICE = 256 << 10  # text handled at once: the arrays of `anchors` take about a hundred bytes for each of its bytes
NULL_ID = -1 << 63


# Anchors.

def anchors(buf: np.ndarray, offsets: np.ndarray):
    """(row, anchor, first, last, gram hash): anchors of each text, and the first and last start of
    the strings assigned to each, all relative to the text."""
    n = len(buf)
    none = np.zeros(0, np.int64)
    if n < SPAN:
        return none, none, none, none, none.view(np.uint64)
    chosen = np.empty(n - SPAN + 1, np.int64)
    hashes = np.empty(n - GRAM + 1, np.uint64)
    for a in range(0, n - SPAN + 1, PIECE):
        part = buf[a: min(n, a + PIECE + SPAN - 1)]
        sums = common.prefix_hash(part)
        _, down = common.powers(len(sums))
        g = (sums[GRAM:] - sums[:-GRAM]) * down[: len(part) - GRAM + 1]
        g ^= g >> np.uint64(32)
        g *= np.uint64(0xD6E8FEB86659FD93)
        g ^= g >> np.uint64(29)
        hashes[a: a + len(g)] = g
        low = (g & ~np.uint64(0xFFFFFF)) | np.arange(len(g), dtype=np.uint64)
        width = 1
        while width * 2 <= WIDE:
            low = np.minimum(low[:-width], low[width:])
            width *= 2
        least = np.minimum(low[: len(g) - WIDE + 1], low[WIDE - width:])
        chosen[a: a + len(least)] = (least & np.uint64(0xFFFFFF)).astype(np.int64) + a
    start = np.arange(n - SPAN + 1)
    row = np.searchsorted(offsets, start, side="right") - 1
    inside = start + SPAN <= offsets[row + 1]
    start, row, chosen = start[inside], row[inside], chosen[inside]
    if not len(start):
        return none, none, none, none, none.view(np.uint64)
    head = np.flatnonzero(np.concatenate([[True], (chosen[1:] != chosen[:-1]) | (row[1:] != row[:-1])]))
    tail = np.concatenate([head[1:], [len(start)]]) - 1
    base = offsets[row[head]]
    return row[head], chosen[head] - base, start[head] - base, start[tail] - base, hashes[chosen[head]]


# Lines and runs.

def lines(buf: np.ndarray, at: np.ndarray, before: np.ndarray, behind: np.ndarray) -> np.ndarray:
    """One line per anchor, as rows of bytes: `behind` bytes from the anchor on, `before` bytes before it
    backwards, the two lengths (plus one, so no line ends with a zero), and zeros."""
    column = np.arange(LINE)[None, :]
    right = column < behind[:, None]
    left = ~right & (column < (behind + before)[:, None])
    index = np.where(right, at[:, None] + column, at[:, None] - 1 - (column - behind[:, None]))
    out = np.where(right | left, buf[np.clip(index, 0, len(buf) - 1)], 0).astype(np.uint8)
    rows = np.arange(len(at))
    out[rows, behind + before] = SPAN - behind + 1
    out[rows, behind + before + 1] = before + 1
    return out


def sort_lines(matrix: np.ndarray, *ties: np.ndarray) -> np.ndarray:
    """Order of lines, equal ones by `ties` (most important first)."""
    order = np.lexsort(ties[::-1])
    return order[np.argsort(matrix[order].view(f"S{LINE}").ravel(), kind="stable")]


def prefixes(matrix: np.ndarray) -> np.ndarray:
    """Common prefix of each line with the one before; LINE where they are equal, 0 for the first."""
    out = np.zeros(len(matrix), np.int64)
    if len(matrix) > 1:
        differs = matrix[1:] != matrix[:-1]
        first = differs.argmax(axis=1)
        out[1:] = np.where(differs[np.arange(len(first)), first], first, LINE)
    return out


def pack(matrix: np.ndarray, ids: np.ndarray, hashes: np.ndarray, at: np.ndarray) -> bytes:
    """A front-coded run of sorted, different lines."""
    shared = prefixes(matrix)
    size = LINE - (matrix[:, ::-1] != 0).argmax(axis=1)
    rest = matrix[(np.arange(LINE)[None, :] >= shared[:, None]) & (np.arange(LINE)[None, :] < size[:, None])]
    return b"".join([
        np.array([len(matrix)], "<u4").tobytes(), shared.astype(np.uint8).tobytes(), size.astype(np.uint8).tobytes(),
        ids.astype("<i8").tobytes(), hashes.astype("<i8").tobytes(), at.astype("<i4").tobytes(), rest.tobytes()])


def unpack(blob: bytes):
    """(lines, prefixes, ids, hashes, anchors) of a run."""
    n = int(np.frombuffer(blob, "<u4", 1)[0])
    shared = np.frombuffer(blob, np.uint8, n, 4)
    size = np.frombuffer(blob, np.uint8, n, 4 + n)
    at = 4 + 2 * n
    ids, hashes = np.frombuffer(blob, "<i8", n, at), np.frombuffer(blob, "<i8", n, at + 8 * n)
    places = np.frombuffer(blob, "<i4", n, at + 16 * n)
    at, line, out = at + 20 * n, b"", []
    for k, m in zip(shared.tolist(), size.tolist()):
        line = line[:k] + blob[at: at + m - k]
        at += m - k
        out.append(line)
    return out, shared.tolist(), ids, hashes, places


def merge(runs: list[tuple[list[bytes], list[int]]]) -> tuple[list[int], list[int], list[int]]:
    """Merged order of sorted runs as (run, place in it), and each line's common prefix with the line
    before it. Known prefixes are never compared again."""
    k = 1
    while k < len(runs):
        k *= 2
    lists = [r[0] for r in runs] + [[]] * (k - len(runs))
    known = [r[1] for r in runs]
    place, have = [0] * k, [0] * k  # `have`: prefix in common with the line put out last
    current = [x[0] if x else None for x in lists]
    tree = [0] * k

    def play(a: int, b: int) -> tuple[int, int]:
        x, y = current[a], current[b]
        if y is None:
            return a, b
        if x is None:
            return b, a
        p, q = have[a], have[b]
        if p > q:
            return a, b
        if q > p:
            return b, a
        n = min(len(x), len(y))
        while p + 16 <= n and x[p: p + 16] == y[p: p + 16]:
            p += 16
        while p < n and x[p] == y[p]:
            p += 1
        if p == n:
            first = len(x) < len(y) or (len(x) == len(y) and a < b)
        else:
            first = x[p] < y[p]
        if first:
            have[b] = p
            return a, b
        have[a] = p
        return b, a

    def build(node: int) -> int:
        if node >= k:
            return node - k
        winner, tree[node] = play(build(2 * node), build(2 * node + 1))
        return winner

    winner = build(1) if k > 1 else 0
    run, at, prefix = [], [], []
    while current[winner] is not None:
        run.append(winner), at.append(place[winner]), prefix.append(have[winner])
        nxt = place[winner] = place[winner] + 1
        if nxt < len(lists[winner]):
            current[winner], have[winner] = lists[winner][nxt], known[winner][nxt]
        else:
            current[winner] = None
        node = (winner + k) >> 1
        while node:
            winner, tree[node] = play(winner, tree[node])
            node >>= 1
    return run, at, prefix


# Strings of one class.

def repeated_windows(stretches: list[bytes], classes: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(stretch, string) of every string that an earlier stretch of the class has at the same place.

    Stretches come in document order; string t of a stretch starts at its byte t, and its place is
    the distance to the anchor, before - t.
    """
    flat = np.frombuffer(b"".join(stretches), np.uint8)
    size = np.array([len(s) for s in stretches], np.int64)
    count = size - SPAN + 1
    owner = np.repeat(np.arange(len(stretches)), count)
    t = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
    start = (np.cumsum(size) - size)[owner] + t
    value = common.range_hash(common.prefix_hash(flat), start, start + SPAN)
    place = (classes[owner] * 256 + before[owner] - t).astype(np.uint64)
    _, first = np.unique(common.mix(value + common.mix(place)), return_index=True)
    again = np.ones(len(owner), bool)
    again[first] = False
    return owner[again], t[again]


def intervals(owner: np.ndarray, t: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of consecutive t of one owner as (owner, first, last)."""
    if not len(owner):
        none = np.zeros(0, np.int64)
        return none, none, none
    head = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (t[1:] != t[:-1] + 1)]))
    tail = np.concatenate([head[1:], [len(t)]]) - 1
    return owner[head], t[head], t[tail]


RUN, SETTLED, STRING = 0, 1, 2
SENT = ("part int, kind int, key long, hash long, first int, last int, value long, place long, run binary")
SENT_SCHEMA = pa.schema([("part", pa.int32()), ("kind", pa.int32()), ("key", pa.int64()), ("hash", pa.int64()),
                         ("first", pa.int32()), ("last", pa.int32()), ("value", pa.int64()), ("place", pa.int64()),
                         ("run", pa.binary())])


def _rows(n: int, **columns) -> pa.RecordBatch:
    """A batch to send; numbers that a kind does not have are 0, because pandas reads a column with
    nulls as floating point."""
    arrays = []
    for f in SENT_SCHEMA:
        if f.name in columns:
            values = columns[f.name]
            arrays.append(pa.array(values, f.type) if isinstance(values, list) else pa.array(values).cast(f.type))
        else:
            arrays.append(pa.nulls(n, f.type) if f.name == "run" else pa.array(np.zeros(n, np.int64)).cast(f.type))
    return pa.RecordBatch.from_arrays(arrays, schema=SENT_SCHEMA)


def _settle(order: np.ndarray, new: np.ndarray, ids, hashes, at) -> tuple[np.ndarray, np.ndarray]:
    """Of sorted lines with group heads `new`: which are heads, and which are repeated in full (not
    those that are the head itself once more)."""
    head = np.flatnonzero(new)
    of = head[np.cumsum(new) - 1]
    a, b = order, order[of]
    same = (ids[a] == ids[b]) & (hashes[a] == hashes[b]) & (at[a] == at[b])
    return head, np.flatnonzero(~new & ~same)


class _Runs:
    """Collects the lines of a task and turns them into runs, settled rows and string rows."""

    def __init__(self, splitters: list[bytes], subs: int):
        self.splitters = np.array(splitters, f"S{GRAM}")
        self.subs = subs
        self.held, self.n = [], 0

    def add(self, buf, offsets, keys, hashes, wanted: tuple, hot: tuple):
        """Take the wanted anchors of a slice; `wanted` and `hot` are (row, anchor) arrays."""
        row, at, first, last, gram = anchors(buf, offsets)
        width = len(buf) + 1
        place = row * width + at
        pick = np.flatnonzero(np.isin(place, wanted[0] * width + wanted[1]))
        if not len(pick):
            return
        is_hot = np.isin(place[pick], hot[0] * width + hot[1])
        matrix = lines(buf, offsets[row[pick]] + at[pick], at[pick] - first[pick], last[pick] + SPAN - at[pick])
        self.held.append((matrix, keys[row[pick]], hashes[row[pick]], at[pick], first[pick], last[pick], gram[pick], is_hot))
        self.n += len(pick)

    def flush(self):
        if not self.n:
            return
        matrix, ids, hashes, at, first, last, gram, hot = (np.concatenate(x) for x in zip(*self.held))
        self.held, self.n = [], 0
        order = sort_lines(matrix, ids, hashes, at)
        new = prefixes(matrix[order]) < LINE
        head, again = _settle(order, new, ids, hashes, at)
        yield self._settled(ids, hashes, first, last, order[again])
        keep = order[head]
        warm = keep[~hot[keep]]
        if len(warm):
            grams = np.ascontiguousarray(matrix[warm][:, :GRAM]).view(f"S{GRAM}").ravel()
            part = np.searchsorted(self.splitters, grams, side="right") * self.subs + (gram[warm] % np.uint64(self.subs)).astype(np.int64)
            by = np.argsort(part, kind="stable")
            warm, part = warm[by], part[by]
            cut = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1], [True]]))
            blobs = [pack(matrix[warm[i:j]], ids[warm[i:j]], hashes[warm[i:j]], at[warm[i:j]]) for i, j in zip(cut[:-1], cut[1:])]
            yield _rows(len(blobs), part=part[cut[:-1]], kind=np.full(len(blobs), RUN), run=blobs)
        burning = np.sort(keep[hot[keep]])
        if len(burning):
            yield from self._strings(matrix, ids, hashes, at, first, last, gram, burning)

    @staticmethod
    def _settled(ids, hashes, first, last, which) -> pa.RecordBatch:
        """Rows of repeated runs; runs of one document that touch become one."""
        which = which[np.lexsort((first[which], hashes[which], ids[which]))]
        key, hash_, lo, hi = ids[which], hashes[which], first[which], last[which]
        new = np.ones(len(which), bool)
        new[1:] = (key[1:] != key[:-1]) | (hash_[1:] != hash_[:-1]) | (lo[1:] > hi[:-1] + 1)
        head = np.flatnonzero(new)
        if len(head):
            hi = np.maximum.reduceat(hi, head)
        return _rows(len(head), part=(key[head] % 997).astype(np.int32), kind=np.full(len(head), SETTLED),
                     key=key[head], hash=hash_[head], first=lo[head], last=hi)

    def _strings(self, matrix, ids, hashes, at, first, last, gram, which):
        """Rows of the single strings of hot anchors; those the task has before are settled here."""
        which = which[np.lexsort((at[which], hashes[which], ids[which]))]
        for k in range(0, len(which), 4000):
            some = which[k: k + 4000]
            stretches = [_stretch(matrix[i].tobytes(), int(last[i]) + SPAN - int(at[i]), int(at[i] - first[i])) for i in some]
            size = np.array([len(s) for s in stretches], np.int64)
            count = size - SPAN + 1
            owner = np.repeat(np.arange(len(some)), count)
            t = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
            start = (np.cumsum(size) - size)[owner] + t
            value = common.range_hash(common.prefix_hash(np.frombuffer(b"".join(stretches), np.uint8)), start, start + SPAN)
            place = common.mix(gram[some][owner] + (at[some] - first[some])[owner].astype(np.uint64) - t.astype(np.uint64))
            _, fresh = np.unique(value ^ common.mix(place), return_index=True)
            again = np.ones(len(owner), bool)
            again[fresh] = False
            # A repeated row of the same document is no repetition.
            who, lo, hi = intervals(owner[again], t[again])
            i = some[who]
            doubled = np.zeros(len(some), bool)
            doubled[1:] = (ids[some[1:]] == ids[some[:-1]]) & (hashes[some[1:]] == hashes[some[:-1]]) & (at[some[1:]] == at[some[:-1]])
            real = ~doubled[who]
            i, lo, hi = i[real], lo[real], hi[real]
            yield _rows(len(i), part=(ids[i] % 997).astype(np.int32), kind=np.full(len(i), SETTLED), key=ids[i],
                        hash=hashes[i], first=first[i] + lo, last=first[i] + hi)
            i = some[owner[fresh]]
            s = first[i] + t[fresh]
            yield _rows(len(i), part=(ids[i] % 997).astype(np.int32), kind=np.full(len(i), STRING), key=ids[i], hash=hashes[i],
                        first=s, last=s, value=value[fresh].view(np.int64), place=place[fresh].view(np.int64))


def _stretch(line: bytes, behind: int, before: int) -> bytes:
    """The text of a line in its own direction."""
    return line[behind: behind + before][::-1] + line[:behind]


OUT = "kind int, key long, hash long, first int, last int, value long, place long"
OUT_COLUMNS = [c.split()[0] for c in OUT.split(", ")]


def _combine(pdf: pd.DataFrame) -> pd.DataFrame:
    """Merge the runs of one part; rows of the other kinds go through."""
    through = pdf.loc[pdf["kind"] != RUN, OUT_COLUMNS]
    runs = [unpack(b) for b in pdf.loc[pdf["kind"] == RUN, "run"]]
    if not runs:
        return through
    run, place, prefix = merge([(r[0], r[1]) for r in runs])
    base = np.concatenate([[0], np.cumsum([len(r[0]) for r in runs])])
    ids, hashes, at = (np.concatenate([r[k] for r in runs]).astype(np.int64) for k in (2, 3, 4))
    text = [x for r in runs for x in r[0]]
    order = base[np.array(run, np.int64)] + np.array(place, np.int64)
    prefix = np.array(prefix, np.int64)
    size = np.array([len(x) for x in text], np.int64)[order]
    equal = np.concatenate([[False], (prefix[1:] == size[1:]) & (size[1:] == size[:-1])])
    behind = np.array([SPAN - x[-2] + 1 for x in text], np.int64)
    before = np.array([x[-1] - 1 for x in text], np.int64)
    first, last = at - before, at + behind - SPAN
    stretch_class = np.cumsum(prefix < GRAM)
    group = np.cumsum(~equal)
    order = order[np.lexsort((at[order], hashes[order], ids[order], group))]  # groups stay where they are
    head, again = _settle(order, ~equal, ids, hashes, at)
    out = [(ids[order[again]], hashes[order[again]], first[order[again]], last[order[again]])]
    # Classes with several stretches: the first occurrence of each goes on.
    classes = stretch_class[head]
    several = np.bincount(classes, minlength=classes.max() + 1)[classes] > 1
    keep, classes = order[head[several]], classes[several]
    cut = np.concatenate([[0], np.flatnonzero(classes[1:] != classes[:-1]) + 1, [len(classes)]]) if len(classes) else np.array([0])
    k = 0
    while k < len(cut) - 1:
        j = max(k + 1, int(np.searchsorted(cut, cut[k] + 5000, side="right")) - 1)
        some, theirs = keep[cut[k]: cut[j]], classes[cut[k]: cut[j]]
        by = np.lexsort((at[some], hashes[some], ids[some]))
        some, theirs = some[by], theirs[by]
        owner, t = repeated_windows([_stretch(text[i], int(behind[i]), int(before[i])) for i in some], theirs, before[some])
        who, lo, hi = intervals(owner, t)
        i = some[who]
        out.append((ids[i], hashes[i], first[i] + lo, first[i] + hi))
        k = j
    key, hash_, lo, hi = (np.concatenate(x) for x in zip(*out))
    made = pd.DataFrame({"kind": SETTLED, "key": key, "hash": hash_, "first": lo, "last": hi, "value": 0, "place": 0})
    return pd.concat([through, made], ignore_index=True)[OUT_COLUMNS]


# The job.

def _flat(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, value) of all items of a list column."""
    offsets = lists.offsets.to_numpy().astype(np.int64)
    return np.repeat(np.arange(len(lists)), np.diff(offsets)), lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)


def _between(items: tuple[np.ndarray, np.ndarray], i: int, j: int) -> tuple[np.ndarray, np.ndarray]:
    a, b = np.searchsorted(items[0], [i, j])
    return items[0][a:b] - i, items[1][a:b]


def _identity() -> list:
    return [F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("key"), F.xxhash64("text").alias("hash")]


def _anchor_rows(texts: DataFrame) -> DataFrame:
    """(gram, key, at) of every anchor."""
    def run(batches):
        for batch in batches:
            buf, offsets = common.text_buffer(batch.column(1))
            keys = batch.column(0).to_numpy()
            for i, j in common.row_slices(offsets, SLICE):
                row, at, _, _, gram = anchors(buf[offsets[i]: offsets[j]], offsets[i: j + 1] - offsets[i])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(gram.view(np.int64)), pa.array(keys[i + row]), pa.array(at.astype(np.int32))],
                    names=["gram", "key", "at"])

    return texts.select("key", "text").mapInArrow(run, "gram long, key long, at int")


def _splitters(texts: DataFrame, ranges: int, rows: int) -> list[bytes]:
    """Grams that cut the anchors of sampled documents into about equal ranges."""
    if ranges < 2:
        return []
    every = max(1, rows // SAMPLE_DOCS)

    def run(batches):
        for batch in batches:
            buf, offsets = common.text_buffer(batch.column(0))
            out = []
            for i, j in common.row_slices(offsets, SLICE):
                part, borders = buf[offsets[i]: offsets[j]], offsets[i: j + 1] - offsets[i]
                row, at, *_ = anchors(part, borders)
                out += [part[p: p + GRAM].tobytes() for p in (borders[row] + at)[::16].tolist()]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["gram"])

    sampled = texts.where(F.pmod(F.xxhash64("key"), F.lit(every)) == 0).select("text").mapInArrow(run, "gram binary")
    # Quantiles of at most a few thousand documents' grams, drawn again to a fixed number.
    grams = sorted(r[0] for r in sampled.orderBy(F.xxhash64("gram")).limit(20_000).collect())
    return sorted({grams[len(grams) * k // ranges] for k in range(1, ranges)}) if grams else []


def repeated(docs: DataFrame, scope: Scope, hot: int = HOT) -> DataFrame:
    """(key, hash, firsts, lasts) per document with repetitions: first and last start of its runs of
    repeated strings."""
    texts = docs.select(*_identity(), "text")
    size, rows = texts.agg(F.sum(F.octet_length("text").cast("long")), F.count(F.lit(1))).first()
    parts = int((size or 0) // PART_BYTES + 1)
    splitters = _splitters(texts, min(parts, RANGES), rows)
    subs = -(-parts // (len(splitters) + 1))
    found = _anchor_rows(texts)
    # Written, so that both sides of the join have an exchange of their own and Spark can split the
    # partition of a frequent gram.
    shared = scope.table(found.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(
        F.col("gram").alias("gram_"), (F.col("n") > hot).alias("hot")), "shared")
    places = scope.table(found.join(shared, found.gram == shared.gram_).groupBy("key").agg(
        F.collect_list("at").alias("wanted"), F.collect_list(F.when(F.col("hot"), F.col("at"))).alias("burning")), "anchors")

    def run(batches):
        runs = _Runs(splitters, subs)
        for batch in batches:
            buf, offsets = common.text_buffer(batch.column(2))
            keys, hashes = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            wanted, burning = _flat(batch.column(3)), _flat(batch.column(4))
            for i, j in common.row_slices(offsets, SLICE):
                runs.add(buf[offsets[i]: offsets[j]], offsets[i: j + 1] - offsets[i], keys[i:j], hashes[i:j],
                         _between(wanted, i, j), _between(burning, i, j))
                if runs.n > RUN_LINES:
                    yield from runs.flush()
        yield from runs.flush()

    sent = texts.join(places, "key").select("key", "hash", "text", "wanted", "burning").mapInArrow(run, SENT)
    settled = scope.table(sent.groupBy("part").applyInPandas(_combine, OUT), "settled")
    strings = settled.where(F.col("kind") == STRING)
    first = strings.groupBy("value", "place").agg(F.min(F.struct("key", "hash", "first")).alias("f"), F.count(F.lit(1)).alias("n")).where(
        "n > 1").select(F.col("value").alias("value_"), F.col("place").alias("place_"), "f")
    later = strings.join(first, [F.col("value") == F.col("value_"), F.col("place") == F.col("place_")]).where(
        F.struct("key", "hash", "first") > F.col("f")).select("key", "hash", "first", "last")
    both = settled.where(F.col("kind") == SETTLED).select("key", "hash", "first", "last").unionByName(later)
    return both.groupBy("key", "hash").agg(F.collect_list(F.struct("first", "last")).alias("runs"))


def _removed(length: int, runs) -> np.ndarray:
    """Mask of the bytes covered by the repeated strings that start within the runs."""
    step = np.zeros(length + 1, np.int32)
    if runs:
        pairs = np.array([(r["first"], r["last"]) for r in runs], np.int64)
        np.add.at(step, pairs[:, 0], 1)
        np.add.at(step, np.minimum(pairs[:, 1] + SPAN, length), -1)
    return np.cumsum(step[:-1]) > 0


def digest(docs: DataFrame, runs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of each row of `docs`."""
    joined = docs.select(*_identity(), "doc_id", "text").join(runs, ["key", "hash"], "left").select("doc_id", "text", "runs")

    def run(batches):
        for batch in batches:
            buf, offsets = common.text_buffer(batch.column(1))
            out = []
            for k, found in enumerate(batch.column(2).to_pylist()):
                text = buf[offsets[k]: offsets[k + 1]]
                if found:
                    mask = _removed(len(text), found)
                    spans = int(mask[0]) + int((mask[1:] & ~mask[:-1]).sum())
                    out.append((len(text), int(mask.sum()), spans, hashlib.sha256(text[~mask].tobytes()).hexdigest()))
                else:
                    out.append((len(text), 0, 0, hashlib.sha256(text.tobytes()).hexdigest()))
            columns = list(zip(*out)) or [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], pa.string())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return joined.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def remove(docs: DataFrame) -> DataFrame:
    """`cut` with the repetitions of `docs` itself."""
    with Scope(docs.sparkSession, "suffixes") as scope:
        runs = scope.keep(repeated(docs, scope), "runs")
    return cut(docs, runs)


def cut(docs: DataFrame, runs: DataFrame) -> DataFrame:
    """The rows of `docs` without their repetitions: `text` is what is left (a character goes only if
    all its bytes are repeated), `n_chars` its length. A text that loses everything loses its row."""
    names = docs.columns
    *identity, found_runs = common.free_names(docs, "key", "hash", "runs")
    joined = docs.withColumns(dict(zip(identity, _identity()))).join(
        runs.toDF(*identity, found_runs), identity, "left").select(*names, found_runs)
    text, chars = names.index("text"), names.index("n_chars") if "n_chars" in names else None

    def run(batches):
        for batch in batches:
            texts, lengths, keep = batch.column(text).to_pylist(), None, []
            found = batch.column(len(names)).to_pylist()
            for k, runs_ in enumerate(found):
                if runs_:
                    data = np.frombuffer(texts[k].encode(), np.uint8)
                    mask = _removed(len(data), runs_)
                    head = np.flatnonzero((data & 0xC0) != 0x80)
                    whole = np.minimum.reduceat(mask, head)
                    data = data[~np.repeat(whole, np.diff(np.concatenate([head, [len(data)]])))]
                    texts[k] = data.tobytes().decode()
                keep.append(not runs_ or bool(texts[k].strip()))
            columns = list(batch.columns[: len(names)])
            columns[text] = pa.array(texts, columns[text].type)
            if chars is not None:
                old = columns[chars].to_pylist()
                columns[chars] = pa.array([len(t) if r else o for t, r, o in zip(texts, found, old)], columns[chars].type)
            yield pa.RecordBatch.from_arrays(columns, names=names).filter(pa.array(keep, pa.bool_()))

    return joined.mapInArrow(run, docs.schema)


@query("op3_suffix_array_dedup")
def op3_suffix_array_dedup(spark, sf_dir):
    common.small_batches(spark)
    docs = common.table(spark, sf_dir, "documents")
    with Scope(spark, "suffixes") as scope:
        return scope.keep(digest(docs, repeated(docs, scope)))
