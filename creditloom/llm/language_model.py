"""Scores of texts under a hierarchical Pitman-Yor language model of word pairs.

Every word (and the beginning of a text) is a context with a restaurant of its own, whose customers
are the training tokens that follow it. Tables of all contexts send one customer each to the one
restaurant they share, whose own parent is the uniform distribution over the known words and one
unknown. Seating is sampled by Gibbs: a customer leaves its table and sits down anew, at a table in
proportion to its size less the discount, or at a new one in proportion to the parent's probability.
The probability of a pair is the average over several samples of the seating.

Contexts are dealt over blocks by hash, so a restaurant stands whole in one task; contexts that take
more than a quarter of a block's share of all tokens are spread over all blocks by the following word
and read their restaurant's number of tables from the pass before. A pass seats all blocks, then sends
the tables per word to the tasks of the shared restaurant, which send back what the blocks need for
their own words. No word list passes through the driver; it sees sums and the spread contexts, which
are at most four times as many as blocks. Scoring sends every text's pairs, grouped by pair, to the
blocks and sums the logarithms that come back per text. What a block keeps between passes is a file
in the shared folder, which a repeated task replaces by the same bytes.

The seating begins by one customer at a time; from the 64th of a word in one context on, customers
enter in groups of an eighth of those seated, and Gibbs sweeps follow. A sweep makes as many moves in
every pair as it has customers: a random one leaves and sits down anew. Pairs of 64 and more move a
32nd of their customers together. Discounts come from the numbers of pairs seen once and twice.

Defined results: a null or empty text has one token, its end; a null doc_id is neither held out nor
learned from; repeated rows are learned as often as they occur and get equal scores; without training
texts every word is unknown; an empty table gives an empty result; words are told apart by 64-bit
hashes of their bytes, pairs of one block by 56 bits; columns other than doc_id and text are not read.
"""

from __future__ import annotations

import io
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import Scope
from . import common
from .registry import query

FOLDS, HELD_OUT = 7, 2
STRENGTH = 1.0  # of every restaurant
PASSES = 1  # passes over all restaurants before the one that is averaged
STEPS = 4  # least moves of a pair in the sweep before each sample
SAMPLES = 4  # samples of the seating whose probabilities are averaged
ONE_BY_ONE = 64
TOGETHER = 32  # parts in which the customers of larger pairs move
SEED = 13
BLOCK = 1_500_000  # tokens meant for one block of contexts
WORD_PART = 4_000_000  # tokens behind the words meant for one task of the shared restaurant
SLICE = 6 << 20  # bytes of text whose pairs are grouped before they are sent
READ = 1 << 20  # bytes of text hashed at once
SHOWN = 4096  # a task tells of contexts that take at least such a part of its tokens

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_BEGIN, _END = common.mix(np.array([101, 102], np.uint64))
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_U32 = np.uint64(32)


def held_out(key) -> bool:
    return key is not None and zlib.crc32(str(key).encode()) % FOLDS == HELD_OUT


def learned(key) -> bool:
    return key is not None and not held_out(key)


def read(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(context, word, row) of every token of every row, in order, as 64-bit hashes."""
    parts = [(*_read(buf[offsets[i]: offsets[j]], offsets[i: j + 1] - offsets[i]), i) for i, j in common.row_slices(offsets, READ)]
    if not parts:
        return _read(buf, offsets)
    contexts, words, rows, first = zip(*parts)
    return np.concatenate(contexts), np.concatenate(words), np.concatenate([r + i for r, i in zip(rows, first)])


def _read(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    buf = _LOWER[buf]
    starts, ends, rows = common.word_spans(buf, offsets)
    n = len(offsets) - 1
    length = np.bincount(rows, minlength=n) + 1
    words = np.full(len(starts) + n, _END, np.uint64)
    words[np.arange(len(starts)) + rows] = common.range_hash(common.prefix_hash(buf), starts, ends)
    contexts = np.empty_like(words)
    contexts[1:] = words[:-1]
    contexts[np.cumsum(length) - length] = _BEGIN
    return contexts, words, np.repeat(np.arange(n), length)


def pair_key(contexts: np.ndarray, words: np.ndarray) -> np.ndarray:
    return common.mix(contexts * _A + words * _B)


def places(contexts: np.ndarray, words: np.ndarray, spread: np.ndarray) -> np.ndarray:
    """A hash whose top 32 bits deal pairs over blocks: that of the context, of the pair where it is spread."""
    place = common.mix(contexts * _B)
    if len(spread):
        hot = spread[np.minimum(np.searchsorted(spread, contexts), len(spread) - 1)] == contexts
        place[hot] = common.mix(pair_key(contexts[hot], words[hot]) + np.uint64(5))
    return place


def dealt(hashes: np.ndarray, parts: int) -> np.ndarray:
    return (((hashes >> _U32) * np.uint64(parts)) >> _U32).astype(np.int64)


def to_bytes(*arrays: np.ndarray) -> bytes:
    """Arrays one after the other; whole numbers in the smallest type that holds them."""
    out = io.BytesIO()
    for x in arrays:
        if x.dtype == np.int64:
            x = x.astype(np.min_scalar_type(int(x.max(initial=0))))
        np.save(out, x, allow_pickle=False)
    return out.getvalue()


def from_bytes(data: bytes, n: int) -> list[np.ndarray]:
    file = io.BytesIO(data)
    return [np.load(file) for _ in range(n)]


def short(keys: np.ndarray) -> bytes:
    """The upper 56 bits of each key."""
    return keys.view(np.uint8).reshape(-1, 8)[:, 1:].tobytes()


def from_short(data: bytes) -> np.ndarray:
    wide = np.zeros((len(data) // 7, 8), np.uint8)
    wide[:, 1:] = np.frombuffer(data, np.uint8).reshape(-1, 7)
    return wide.view(np.uint64).ravel()


def _new(x: np.ndarray, *more: np.ndarray) -> np.ndarray:
    """Indices at which a run of equal values begins."""
    first = np.ones(len(x), bool)
    first[1:] = x[1:] != x[:-1]
    for y in more:
        first[1:] |= y[1:] != y[:-1]
    return np.flatnonzero(first)


def _sizes(first: np.ndarray, n: int) -> np.ndarray:
    return np.diff(np.append(first, n))


def slices_of(column, width: int = SLICE):
    """(first row, end row, buffer, offsets) of the slices of one batch."""
    buf, offsets = common.text_buffer(column)
    for i, j in common.row_slices(offsets, width):
        yield i, j, buf[offsets[i]: offsets[j]], offsets[i: j + 1] - offsets[i]


def often(scope: Scope, docs: DataFrame) -> tuple[int, dict[int, int]]:
    """The number of tokens of all texts, and the contexts that are frequent in some task with their counts there."""
    def run(batches):
        total, held = 0, []

        def fold():
            k, n = (np.concatenate(x) for x in zip(*held))
            keys, inverse = np.unique(k, return_inverse=True)
            n = np.bincount(inverse, weights=n).astype(np.int64)
            keep = n * SHOWN >= total
            held[:] = [(keys[keep], n[keep])]
        for batch in batches:
            for _, _, buf, offsets in slices_of(batch.column(0)):
                contexts, _, _ = read(buf, offsets)
                total += len(contexts)
                keys, n = np.unique(contexts, return_counts=True)
                keep = n * 4 * SHOWN >= len(contexts)
                held.append((keys[keep], n[keep]))
                if len(held) >= 16:
                    fold()
        if total:
            fold()
            keys, n = held[0]
            yield pa.RecordBatch.from_arrays([pa.array(np.append(keys.view(np.int64), 0)), pa.array(np.append(n, total)),
                                              pa.array(np.append(np.zeros(len(keys), bool), True))], names=["word", "n", "all"])

    sums = scope.table(docs.select("text").mapInArrow(run, "word long, n long, all boolean").groupBy("word", "all").agg(
        F.sum("n").alias("n")), "often")
    total = sums.where("all").first()
    total = 0 if total is None else total.n
    # Fewer than 4 x blocks contexts can reach the bound.
    bound = max(1, total // (4 * blocks(total)))
    hot = sums.where(~F.col("all") & (F.col("n") > bound)).collect() if blocks(total) > 1 else []
    return total, {r.word: r.n for r in hot}


def blocks(tokens: int) -> int:
    return max(1, -(-tokens // BLOCK))


# Seating.

def seatings(n: np.ndarray, context: np.ndarray, parent: np.ndarray, discount: float, strength: float,
             tables: np.ndarray, fixed: np.ndarray, rng: np.random.Generator, steps: int, samples: int):
    """Yields `samples` times the number of tables of every pair and of every restaurant.

    n: customers of each pair; context: its restaurant's number; parent: the parent's probability of
    its word; tables: how many tables each restaurant has if every pair has one; fixed: restaurants
    whose number of tables is not counted here, but stays as given. Before each sample every pair makes as
    many moves as it has customers, and at least `steps`.
    """
    t = np.minimum(n, 1).astype(np.int64)
    groups = []
    moving = ~fixed
    for k in range(1, int(n.max(initial=0)).bit_length()):
        at = np.flatnonzero((n >> k) == 1)
        if len(at):
            at = at[np.argsort(-n[at], kind="stable")]
            groups.append(Group(at, n[at], context[at], parent[at], discount, strength, rng))
    for g in groups:
        g.fill(tables, moving)
    for _ in range(samples):
        _sweep([g for g in reversed(groups) if g.n[0] < ONE_BY_ONE], tables, moving, steps)
        _sweep([g for g in groups if g.n[0] >= ONE_BY_ONE], tables, moving, steps)
        for g in groups:
            t[g.at] = g.tables
        yield t, tables


def _columns(sizes: np.ndarray, width: int) -> np.ndarray:
    """The first columns; those beyond the ones there are empty."""
    return np.pad(sizes[:, :width], ((0, 0), (0, max(0, width - sizes.shape[1]))))


def _sweep(groups: list[Group], tables: np.ndarray, moving: np.ndarray, least: int) -> None:
    """A sweep over all pairs of the groups, given by falling n where customers move one by one. Pairs with
    about as many tables move together, so that few with many tables do not widen the rows of all."""
    widths = [(np.frexp(g.tables)[1] + 1) // 2 * 2 for g in groups]
    for width in np.unique(np.concatenate(widths)) if groups else ():
        rows = [np.flatnonzero(w == width) for w in widths]
        part = Group.joined(groups, rows, 1 << int(width))
        part.sweep(tables, moving, least)
        ends = np.cumsum([len(r) for r in rows])
        for g, r, end in zip(groups, rows, ends):
            g.put(r, part.sizes[end - len(r): end], part.tables[end - len(r): end])


class Group:
    """Pairs with about as many customers: a row per pair, the sizes of its tables in the columns."""

    def __init__(self, at, n, context, parent, discount, strength, rng):
        self.at, self.n, self.context, self.parent = at, n, context, parent
        self.d, self.strength, self.rng = discount, strength, rng
        self.sizes = np.zeros((len(at), 4), np.int32 if n.max(initial=0) < 1 << 31 else np.int64)
        self.sizes[:, 0] = 1
        self.tables = np.ones(len(at), np.int64)

    def _widen(self, width: int) -> None:
        if width > self.sizes.shape[1]:
            grown = np.zeros((len(self.at), max(width, self.sizes.shape[1] * 3 // 2)), self.sizes.dtype)
            grown[:, : self.sizes.shape[1]] = self.sizes
            self.sizes = grown

    def _new_share(self, rows: int, seated, tables) -> np.ndarray:
        opened = (self.strength + self.d * tables[self.context[:rows]]) * self.parent[:rows]
        return opened / (opened + seated - self.d * self.tables[:rows])

    def _tell(self, rows, change, tables, moving) -> None:
        """Count opened and closed tables in their restaurants, except in those that stay as given."""
        at = self.context[rows]
        keep = (change != 0) & moving[at]
        np.add.at(tables, at[keep], change[keep])

    def _sit(self, rows: int, seated, tables, moving) -> None:
        """One more customer for each of the first `rows` pairs."""
        opens = self.rng.random(rows) < self._new_share(rows, seated, tables)
        self._widen(int(self.tables[:rows].max(initial=0)) + 1)
        several = self.tables[:rows] > 1
        self.sizes[np.flatnonzero(~opens & ~several), 0] += 1  # there is one table only
        there = np.flatnonzero(~opens & several)
        if len(there):
            weight = self.sizes[there]
            weight = np.cumsum(weight - self.d * (weight > 0), axis=1)
            place = (weight <= (self.rng.random(len(there)) * weight[:, -1])[:, None]).sum(axis=1)
            self.sizes[there, np.minimum(place, self.tables[there] - 1)] += 1
        fresh = np.flatnonzero(opens)
        self.sizes[fresh, self.tables[fresh]] = 1
        self.tables[fresh] += 1
        self._tell(slice(0, rows), opens.astype(np.int64), tables, moving)

    def fill(self, tables, moving) -> None:
        """Seat all customers; the first of each pair has its table already."""
        most = int(self.n[0])
        for seated in range(1, min(most, ONE_BY_ONE)):
            self._sit(int(np.searchsorted(-self.n, -seated, side="left")), seated, tables, moving)
        seated = np.minimum(self.n, ONE_BY_ONE)
        while (rows := int(np.count_nonzero(seated < self.n))):
            # rows are sorted by n and grow alike, so those that are not full come first
            group = np.minimum(seated[:rows] // 8, self.n[:rows] - seated[:rows])
            self._sit_together(group, seated[:rows], tables, moving)
            seated[:rows] += group

    def _sit_together(self, group, seated, tables, moving) -> None:
        """`group` more customers for each of the first pairs, who choose among the tables as they are."""
        rows = len(group)
        opens = self.rng.binomial(group, np.clip(self._new_share(rows, seated, tables), 0, 1))
        weight = self.sizes[:rows] - self.d * (self.sizes[:rows] > 0)
        self.sizes[:rows] += self._shares(weight, group - opens)
        self._widen(int((self.tables[:rows] + opens).max()))
        column = np.arange(self.sizes.shape[1])
        self.sizes[:rows][(column >= self.tables[:rows, None]) & (column < (self.tables[:rows] + opens)[:, None])] = 1
        self.tables[:rows] += opens
        self._tell(slice(0, rows), opens, tables, moving)

    def _shares(self, weight, group) -> np.ndarray:
        """`group` customers of each row dealt over its tables in proportion to `weight`: rounded at a random
        offset, so that the expected share of a table is exact."""
        ends = np.cumsum(weight, axis=1)
        offset = 1e-9 + (1 - 2e-9) * self.rng.random(len(group))  # so that rounding leaves no customer to empty columns
        upto = (ends * (group / ends[:, -1])[:, None] + offset[:, None]).astype(self.sizes.dtype)
        upto[:, 1:] -= upto[:, :-1].copy()
        return upto

    @classmethod
    def joined(cls, groups: list[Group], rows: list[np.ndarray], width: int) -> Group:
        """Some rows of some groups, all with at most `width` tables."""
        of = lambda name: np.concatenate([getattr(g, name)[r] for g, r in zip(groups, rows)])
        first = groups[0]
        out = cls(of("at"), of("n"), of("context"), of("parent"), first.d, first.strength, first.rng)
        out.tables = of("tables")
        out.sizes = np.concatenate([_columns(g.sizes[r], width) for g, r in zip(groups, rows)])
        return out

    def put(self, rows, sizes, tables) -> None:
        """Take back rows that were joined with others."""
        self._widen(int(tables.max(initial=0)))
        self.sizes[rows] = _columns(sizes, self.sizes.shape[1])
        self.tables[rows] = tables

    def sweep(self, tables, moving, least: int) -> None:
        """As many moves as each pair has customers, but at least `least`."""
        if self.n[-1] >= ONE_BY_ONE:
            for _ in range(TOGETHER):
                self._move_together(-(-self.n // TOGETHER), tables, moving)
            return
        for done in range(max(int(self.n[0]), least)):
            self.step(len(self.at) if done < least else int(np.searchsorted(-self.n, -done, side="left")), tables, moving)

    def _move_together(self, group, tables, moving) -> None:
        """`group` random customers of each pair leave and sit down anew."""
        left = self._shares(self.sizes, group)
        self.sizes -= left
        there = self.sizes > 0
        gone = self.tables - there.sum(axis=1)
        closing = np.flatnonzero(gone)
        # tables that are left move up to the first columns
        order = np.argsort(~there[closing], axis=1, kind="stable")
        self.sizes[closing] = np.take_along_axis(self.sizes[closing], order, axis=1)
        self.tables -= gone
        self._tell(slice(0, len(gone)), -gone, tables, moving)
        self._sit_together(group, self.n - 1, tables, moving)

    def step(self, count: int, tables, moving) -> None:
        """A random customer of each of the first `count` pairs leaves and sits down anew."""
        several = self.tables[:count] > 1
        self.sizes[np.flatnonzero(~several), 0] -= 1  # others stay at the only table
        rows = np.flatnonzero(several)
        if len(rows):
            weight = np.cumsum(self.sizes[rows], axis=1)
            place = (weight <= np.floor(self.rng.random(len(rows)) * self.n[rows])[:, None]).sum(axis=1)
            self.sizes[rows, place] -= 1
            closed = self.sizes[rows, place] == 0
            empty, place = rows[closed], place[closed]
            last = self.tables[empty] - 1  # an empty table's place goes to the last one
            self.sizes[empty, place] = self.sizes[empty, last]
            self.sizes[empty, last] = 0
            self.tables[empty] -= 1
            self._tell(empty, np.full(len(empty), -1), tables, moving)
        self._sit(count, self.n[:count] - 1, tables, moving)


def discount_of(once: int, twice: int) -> float:
    return once / (once + 2 * twice) if once and twice else 0.5


def pairs(docs: DataFrame, parts: int, spread: np.ndarray) -> DataFrame:
    """block, contexts, runs, words, n: the pairs of all texts, per slice of text and block; n counts
    training tokens only and is 0 for pairs that only held-out texts have."""
    def run(batches):
        for batch in batches:
            learn = np.array([learned(k) for k in batch.column(0).to_pylist()], bool)
            for i, j, buf, offsets in slices_of(batch.column(1)):
                contexts, words, rows = read(buf, offsets)
                place = places(contexts, words, spread)
                # Equal pairs have equal values here; different ones that share a value stay apart.
                order = np.argsort((place >> _U32 << _U32) | (pair_key(contexts, words) >> _U32))
                contexts, words, place = contexts[order], words[order], place[order]
                first = _new(contexts, words)
                n = np.add.reduceat(learn[i:j][rows[order]].astype(np.int32), first, dtype=np.int32)
                contexts, words, block = contexts[first], words[first], dealt(place[first], parts)
                at = _new(block)
                pieces = []
                for lo, hi in zip(at, np.append(at[1:], len(block))):
                    new = _new(contexts[lo:hi])
                    pieces.append((int(block[lo]), contexts[lo:hi][new].tobytes(), _sizes(new, hi - lo).astype(np.int32).tobytes(),
                                   words[lo:hi].tobytes(), n[lo:hi].tobytes()))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*pieces), [pa.int32()] + [pa.binary()] * 4)],
                                                 names=["block", "contexts", "runs", "words", "n"])

    return docs.select("doc_id", "text").mapInArrow(run, "block int, contexts binary, runs binary, words binary, n binary")


_REQUEST = pa.schema([("part", pa.int32()), ("block", pa.int32()), ("words", pa.binary()), ("tables", pa.binary()), ("n", pa.binary()),
                      ("once", pa.int64()), ("twice", pa.int64()),
                      ("spread", pa.list_(pa.struct([("context", pa.int64()), ("customers", pa.int64()), ("tables", pa.int64())])))])
_REQUEST_DDL = ("part int, block int, words binary, tables binary, n binary, once long, twice long, "
                "spread array<struct<context: long, customers: long, tables: long>>")


class Block:
    """The pairs of one block in memory, those of one context together."""

    def __init__(self, contexts: np.ndarray, sizes: np.ndarray, words: np.ndarray, n: np.ndarray):
        self.heads, self.sizes, self.words, self.n = contexts, sizes.astype(np.int64), words, n.astype(np.int64)
        self.context = np.repeat(np.arange(len(contexts)), self.sizes)
        self.distinct, self.word = np.unique(words, return_inverse=True)

    @classmethod
    def of(cls, contexts: np.ndarray, words: np.ndarray, n: np.ndarray) -> Block:
        """From pairs in any order, the same one several times too."""
        key = pair_key(contexts, words)
        order = np.argsort(key)
        first = _new(key[order])
        n = np.add.reduceat(n[order], first)
        contexts, words = contexts[order[first]], words[order[first]]
        # Equal keys are one pair, and the order below follows the keys: repeated tasks agree.
        order = np.argsort(contexts, kind="stable")
        contexts, words, n = contexts[order], words[order], n[order]
        new = _new(contexts)
        return cls(contexts[new], _sizes(new, len(n)), words, n)

    @classmethod
    def load(cls, folder: str, number: int) -> Block:
        return cls(*from_bytes(common.read_file(f"{folder}/{number}"), 4))

    def save(self, folder: str, number: int) -> None:
        common.write_file(f"{folder}/{number}", to_bytes(self.heads, self.sizes, self.words, self.n))

    def counts(self) -> tuple[np.ndarray, np.ndarray]:
        """Customers and pairs with customers of each context."""
        starts = np.cumsum(self.sizes) - self.sizes
        return np.add.reduceat(self.n, starts), np.add.reduceat((self.n > 0).astype(np.int64), starts)

    def spread(self, contexts: np.ndarray, tables: np.ndarray) -> list[dict]:
        """Customers and tables that this block has of the spread contexts."""
        hot = np.flatnonzero(np.isin(self.heads.view(np.int64), contexts))
        starts = np.cumsum(self.sizes) - self.sizes
        customers, tables = np.add.reduceat(self.n, starts), np.add.reduceat(tables, starts)
        return [{"context": int(self.heads[i].view(np.int64)), "customers": int(customers[i]), "tables": int(tables[i])} for i in hot]

    def requests(self, number: int, parts: int, tables: np.ndarray, contexts: np.ndarray) -> pa.RecordBatch:
        """What the shared restaurant's tasks are told and asked: words, tables and tokens of this block, and
        in the first row what it has of the spread `contexts`."""
        t, n = (np.bincount(self.word, weights=x, minlength=len(self.distinct)).astype(np.int64) for x in (tables, self.n))
        at = np.searchsorted(dealt(self.distinct, parts), np.arange(parts + 1))
        rows = [{"part": p, "block": number, "words": self.distinct[i:j].tobytes(), "tables": to_bytes(t[i:j]), "n": to_bytes(n[i:j])}
                for p, (i, j) in enumerate(zip(at, at[1:])) if j > i]
        rows[0]["spread"] = self.spread(contexts, tables)
        return pa.RecordBatch.from_pylist(rows, _REQUEST)

    def seat(self, parent: np.ndarray, discount: float, spread: dict[int, tuple[int, int]], seed, steps: int, samples: int):
        """Yields (tables of each pair, probability of each pair) of each sample."""
        customers, tables = self.counts()
        fixed = np.zeros(len(self.heads), bool)
        for i in np.flatnonzero(np.isin(self.heads.view(np.int64), np.array(list(spread), np.int64))):
            customers[i], tables[i] = spread[int(self.heads[i].view(np.int64))]
            fixed[i] = True
        p = parent[self.word]
        rng = np.random.default_rng(seed)
        for t, tables in seatings(self.n, self.context, p, discount, STRENGTH, tables, fixed, rng, steps, samples):
            up = (STRENGTH + discount * tables)[self.context] * p
            yield t, (self.n - discount * t + up) / (STRENGTH + customers)[self.context]


def collected(found: DataFrame, parts: int, word_parts: int, spread: np.ndarray, folder: str) -> DataFrame:
    """Writes a file per block with its distinct pairs; returns its requests, in which every pair has one
    table, and per block a row of part -1 with its counts of pairs."""
    spread = spread.view(np.int64)

    def done(number, held):
        contexts = np.concatenate([np.repeat(np.frombuffer(c, np.uint64), np.frombuffer(r, np.int32)) for c, r, _, _ in held])
        words = np.concatenate([np.frombuffer(w, np.uint64) for _, _, w, _ in held])
        block = Block.of(contexts, words, np.concatenate([np.frombuffer(x, np.int32) for _, _, _, x in held]).astype(np.int64))
        block.save(folder, number)
        yield pa.RecordBatch.from_pylist([{
            "part": -1, "block": number, "once": int((block.n == 1).sum()), "twice": int((block.n == 2).sum())}], _REQUEST)
        yield block.requests(number, word_parts, (block.n > 0).astype(np.int64), spread)

    def run(batches):
        block, held = None, []
        for batch in batches:
            for b, *piece in zip(*(c.to_pylist() for c in batch.columns)):
                if b != block and held:
                    yield from done(block, held)
                    held = []
                block = b
                held.append(piece)
        if held:
            yield from done(block, held)

    return found.repartition(parts, "block").sortWithinPartitions("block").mapInArrow(run, _REQUEST_DDL)


_ANSWER = pa.schema([("block", pa.int32()), ("part", pa.int32()), ("customers", pa.binary()), ("tables", pa.binary()), ("n", pa.binary()),
                     *((s, pa.float64()) for s in ("all_customers", "all_tables")), *((s, pa.int64()) for s in ("tokens", "known", "once", "twice")), _REQUEST.field("spread")])
_ANSWER_DDL = ("block int, part int, customers binary, tables binary, n binary, all_customers double, all_tables double, "
               "tokens long, known long, once long, twice long, spread array<struct<context: long, customers: long, tables: long>>")


def shared_restaurant(requests: DataFrame, parts: int, before: dict | None) -> DataFrame:
    """Per block and part what its words have in the shared restaurant (customers, mean tables) and in the
    training texts (n); and per part one row with block -1 that has the sums, also of the spread contexts."""
    def answer(part, held):
        words = np.concatenate([np.frombuffer(w, np.uint64) for _, w, _, _, _ in held])
        distinct, inverse = np.unique(words, return_inverse=True)

        def total(k):
            values = np.concatenate([from_bytes(h[k], 1)[0] for h in held])
            out = np.zeros(len(distinct), np.int64)
            np.add.at(out, inverse, values)
            return out
        customers, n = total(2), total(3)
        once, twice, known = int((customers == 1).sum()), int((customers == 2).sum()), int((n > 0).sum())
        words_all = before["known"] if before else known * parts
        tables_all = int(before["all_tables"]) if before else known * parts
        discount = discount_of(before["once"], before["twice"]) if before else discount_of(once, twice)
        rng = np.random.default_rng([SEED, part, 1 if before else 0])
        one = np.zeros(len(distinct), np.int64)
        mean = np.zeros(len(distinct))
        for t, _ in seatings(customers, one, np.full(len(distinct), 1 / (words_all + 1)), discount, STRENGTH,
                             np.array([tables_all]), np.ones(1, bool), rng, STEPS, SAMPLES):
            mean += t / SAMPLES
        rows, at = [], 0
        spread = {}
        for block, w, _, _, told in held:
            for c in told or ():
                before_, tables_ = spread.get(c["context"], (0, 0))
                spread[c["context"]] = before_ + c["customers"], tables_ + c["tables"]
            k = inverse[at: at + len(w) // 8]
            at += len(k)
            rows.append({"block": block, "part": part, "customers": to_bytes(customers[k]),
                         "tables": mean[k].astype(np.float32).tobytes(), "n": to_bytes(n[k])})
        rows.append({"block": -1, "part": part, "all_customers": float(customers.sum()), "all_tables": float(mean.sum()),
                     "tokens": int(n.sum()), "known": known, "once": once, "twice": twice,
                     "spread": [{"context": c, "customers": x, "tables": y} for c, (x, y) in spread.items()]})
        return pa.RecordBatch.from_pylist(rows, _ANSWER)

    def run(batches):
        part, held = None, []
        for batch in batches:
            for p, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if p != part and held:
                    yield answer(part, held)
                    held = []
                part = p
                held.append(row)
        if held:
            yield answer(part, held)

    return requests.select("part", "block", "words", "tables", "n", "spread").repartition(parts, "part").sortWithinPartitions("part", "block").mapInArrow(run, _ANSWER_DDL)


def sums_of(answers: DataFrame) -> dict:
    names = ["all_customers", "all_tables", "tokens", "known", "once", "twice"]
    row = answers.where("block < 0").agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in names)).first()
    return row.asDict()


def spread_of(answers: DataFrame) -> dict[int, tuple[int, int]]:
    """Customers and tables of each spread context; there are at most 4 x blocks."""
    rows = answers.where("block < 0").select(F.explode("spread").alias("s")).select("s.*")
    return {r.context: (r.customers, r.tables) for r in rows.groupBy("context").agg(
        F.sum("customers").alias("customers"), F.sum("tables").alias("tables")).collect()}


def parent_of(customers: np.ndarray, tables: np.ndarray, sums: dict) -> np.ndarray:
    """Probability of each word in the shared restaurant."""
    d = discount_of(sums["once"], sums["twice"])
    new = (STRENGTH + d * sums["all_tables"]) / (sums["known"] + 1)
    return (customers - d * tables + new) / (STRENGTH + sums["all_customers"])


def over_blocks(answers: DataFrame, parts: int, folder: str, work, ddl: str) -> DataFrame:
    """`work(block number, Block, customers, tables, n)` yields batches, for each block with the answers for its words."""
    def run(batches):
        number, told = None, []

        def done():
            customers, n = (np.concatenate([from_bytes(x[k], 1)[0] for x in told]).astype(np.int64) for k in (0, 2))
            tables = np.concatenate([np.frombuffer(x[1], np.float32) for x in told])
            yield from work(number, Block.load(folder, number), customers, tables, n)
        for batch in batches:
            for b, _, *answer in zip(*(c.to_pylist() for c in batch.columns)):
                if b != number and told:
                    yield from done()
                    told = []
                number = b
                told.append(answer)
        if told:
            yield from done()

    return answers.where("block >= 0").select("block", "part", "customers", "tables", "n").repartition(
        parts, "block").sortWithinPartitions("block", "part").mapInArrow(run, ddl)


class Model:
    """A fitted model: a folder with a file per block (keys, log10 probabilities and training tokens of
    its pairs), and the sums behind the base score."""

    def __init__(self, folder: str, parts: int, spread: np.ndarray, tokens: int, known: int):
        self.folder, self.parts, self.spread, self.tokens, self.known = folder, parts, spread, tokens, known

    def block(self, number: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        keys, logs, counts, which = from_bytes(common.read_file(f"{self.folder}/{number}"), 4)
        return from_short(keys.tobytes()), logs.astype(float), counts.astype(np.int64)[which]


def fit(scope: Scope, docs: DataFrame) -> Model:
    """Learns from the texts of `docs` that are not held out; the model has all pairs of `docs`. Its files
    go with the scope."""
    total, hot = often(scope, docs)
    parts, word_parts = blocks(total), max(1, -(-total // WORD_PART))
    spread = np.sort(np.array(list(hot), np.int64).view(np.uint64))
    folder, fitted = scope.path("pairs"), scope.path("model")
    requests = scope.table(collected(pairs(docs, parts, spread), parts, word_parts, spread, folder), "requests")
    seen = requests.where("part < 0")
    sums = seen.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("once", "twice"))).first()
    discount = discount_of(sums.once, sums.twice)
    answers = scope.table(shared_restaurant(requests.where("part >= 0"), word_parts, None), "answers")
    scope.drop(requests)
    sums, wide = sums_of(answers), spread_of(answers)
    for step in range(PASSES):
        def again(number, block, customers, tables, n, sums=sums, wide=wide, step=step):
            for t, _ in block.seat(parent_of(customers, tables, sums), discount, wide, [SEED, number, step], STEPS, 1):
                yield block.requests(number, word_parts, t, np.array(list(wide), np.int64))

        following = scope.table(shared_restaurant(over_blocks(answers, parts, folder, again, _REQUEST_DDL), word_parts, sums), "answers")
        scope.drop(answers)
        answers, sums, wide = following, sums_of(following), spread_of(following)

    def last(number, block, customers, tables, n):
        p = np.zeros(len(block.n))
        for _, sample in block.seat(parent_of(customers, tables, sums), discount, wide, [SEED, number, PASSES], STEPS, SAMPLES):
            p += sample / SAMPLES
        keys = pair_key(block.heads[block.context], block.words)
        order = np.argsort(keys)
        # There are few different counts: a pair has the number of its word's count among them.
        counts, which = np.unique(n, return_inverse=True)
        common.write_file(f"{fitted}/{number}", to_bytes(
            np.frombuffer(short(keys[order]), np.uint8), np.log10(p[order]).astype(np.float32),
            counts, which[block.word][order].astype(np.int64)))
        yield pa.RecordBatch.from_pydict({"block": pa.array([number], pa.int32())})

    scope.table(over_blocks(answers, parts, folder, last, "block int"), "written")
    scope.drop(answers)
    scope.forget(folder)
    return Model(fitted, parts, spread, int(sums["tokens"]), int(sums["known"]))


_SENT = pa.schema([("block", pa.int32()), ("kind", pa.int32()), ("start", pa.int64()), ("keys", pa.binary()), ("times", pa.binary()),
                   ("rows", pa.binary()), ("ids", pa.list_(pa.int64())), ("n_tokens", pa.list_(pa.int64()))])
_SENT_DDL = "block int, kind int, start long, keys binary, times binary, rows binary, ids array<long>, n_tokens array<long>"
_SUMS = pa.schema([("start", pa.int64()), ("kind", pa.int32()), ("sums", pa.binary()), ("ids", pa.list_(pa.int64())), ("n_tokens", pa.list_(pa.int64()))])
_SUMS_DDL = "start long, kind int, sums binary, ids array<long>, n_tokens array<long>"
_RESULT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row of the `docs`
    the model was fitted with."""
    parts, spread, tokens = model.parts, model.spread, model.tokens
    base = float(model.tokens + model.known + 1)

    def send(batches):
        for batch in batches:
            ids, starts = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            for i, j, buf, offsets in slices_of(batch.column(1)):
                contexts, words, rows = read(buf, offsets)
                place, key = places(contexts, words, spread), pair_key(contexts, words)
                # In the order of the block's keys, in which they are found faster.
                block = dealt(place, parts)
                order = np.argsort((block.astype(np.uint64) << np.uint64(40)) | (key >> np.uint64(24)))
                block, key = block[order], key[order]
                rows = rows[order].astype(np.uint16 if j - i < 1 << 16 else np.uint32)
                at = _new(block)
                out = []
                for lo, hi in zip(at, np.append(at[1:], len(block))):
                    new = _new(key[lo:hi])
                    out.append({"block": int(block[lo]), "kind": 1, "start": starts[i], "keys": short(key[lo:hi][new]),
                                "times": to_bytes(_sizes(new, hi - lo)), "rows": rows[lo:hi].tobytes()})
                out.append({"block": starts[i] % parts, "kind": 2, "start": starts[i], "ids": ids[i:j],
                            "n_tokens": np.bincount(rows, minlength=j - i).tolist()})
                yield pa.RecordBatch.from_pylist(out, _SENT)

    def look_up(batches):
        number = keys = logs = counts = None
        for batch in batches:
            out = []
            for b, kind, start, asked, times, rows, ids, n in zip(*(x.to_pylist() for x in batch.columns)):
                if kind == 2:
                    out.append({"start": start, "kind": 0, "ids": ids, "n_tokens": n})
                    continue
                if b != number:
                    number, (keys, logs, counts) = b, model.block(b)
                times, = from_bytes(times, 1)
                rows = np.frombuffer(rows, np.uint16 if len(rows) == 2 * int(times.sum()) else np.uint32)
                at = np.repeat(np.searchsorted(keys, from_short(asked)), times)
                there = np.flatnonzero(np.bincount(rows))
                seen = counts[at]
                base_sum, score_sum = (np.bincount(rows, weights=x)[there] for x in (np.log10((seen + 1) / base), logs[at]))
                known = np.bincount(rows, weights=seen > 0).astype(np.int64)[there]
                out.append({"start": start, "kind": 1, "sums": to_bytes(there.astype(np.int64), known, base_sum, score_sum.astype(np.float32))})
            if out:
                yield pa.RecordBatch.from_pylist(out, _SUMS)

    def add_up(batches):
        held = None

        def done():
            ids, n, known_, base_, score_ = held
            return pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array([held_out(k) for k in ids], pa.bool_()), pa.array(n, pa.int64()), pa.array(known_),
                 pa.array(np.full(len(ids), tokens, np.int64)), pa.array(base_), pa.array(score_)],
                names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])
        for batch in batches:
            for _, kind, sums, ids, n in zip(*(x.to_pylist() for x in batch.columns)):
                if kind == 0:
                    if held:
                        yield done()
                    held = ids, n, np.zeros(len(ids), np.int64), np.zeros(len(ids)), np.zeros(len(ids))
                else:
                    at, *parts_ = from_bytes(sums, 4)
                    for total, part in zip(held[2:], parts_):
                        total[at] += part
        if held:
            yield done()

    numbered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.monotonically_increasing_id().alias("start"))
    found = numbered.mapInArrow(send, _SENT_DDL).repartition(parts, "block").sortWithinPartitions(
        "block", "kind", "start").mapInArrow(look_up, _SUMS_DDL)
    return found.repartition("start").sortWithinPartitions("start", "kind").mapInArrow(add_up, _RESULT)


def perplexity(scores: DataFrame) -> DataFrame:
    """held_out, texts, and perplexity per token under the model and under the base."""
    def of(column):
        return F.pow(F.lit(10.0), -F.sum(column) / F.sum("n_tokens"))
    return scores.groupBy("held_out").agg(F.count(F.lit(1)).alias("texts"), of("score").alias("perplexity"),
                                          of("base_score").alias("base_perplexity"))


@query("op13_pitman_yor_scores")
def op13_pitman_yor_scores(spark, sf_dir):
    common.small_batches(spark)
    docs = common.table(spark, sf_dir, "documents")
    with Scope(spark, "language_model") as scope:
        return scope.keep(score(docs, fit(scope, docs)))
