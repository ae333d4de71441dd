"""SentencePiece encoding with seeded merge-dropout, and decoding.

A text is cut where no piece of the vocabulary can span: before each run of blanks and around line
breaks. In a unit the agenda holds all neighbouring pairs that form a piece; the best one (highest
score, then leftmost) is taken first. A candidate, known by where it starts, joins and ends, is
skipped when a hash keyed by seed, document, unit and place of the unit falls below the dropout rate;
a skipped candidate never comes back. So every occurrence of a word draws on its own. Everything is a
function of seed, doc_id and text, so a repeated task gives the same ids.

Equal units of a slice share an agenda only where their coins agree: the agenda of one of them notes
each candidate it came to and the coin; all others whose own coins are the same there have the same
pieces, and those that differ first at the same candidate form a group with an agenda of its own.

The agenda is run for many units at once: every round takes the best candidate of every unit. Units
longer than `LONG` characters go through a heap one by one; the result is the same.

Characters without a piece become byte tokens, and so does U+2581 itself, which the vocabulary uses
for the blank; so decoding gives back every text exactly.

Defined results: a null or empty text has no ids and decodes to the empty text; ties go to the left;
repeated rows get equal ids; a null doc_id is a key like any other; an empty table gives none.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from . import common
from .registry import query

MODEL = "piece_bpe_32k.model"
DROPOUT, SEED = 0.1, 7
LONG = 64
SLICE_BYTES = 2 << 20  # text of which equal units may share agendas
COINS = 1 << 18  # coins compared at once
BLANK = "▁"
PAIR_BITS = 19
_NONE = np.int32(1 << 30)


@dataclass
class Vocabulary:
    chars: np.ndarray  # piece of each code point of the basic plane, -1 without one
    others: dict[int, int]  # the same for code points above
    pair_keys: np.ndarray  # hash table of left * pieces + right, -1 where free
    pair_ids: np.ndarray
    probes: int  # places to look at from a key's slot on
    rank: np.ndarray  # place of each piece in the order of merging
    byte_ids: np.ndarray
    piece_bytes: np.ndarray  # what the pieces decode to, flat
    piece_starts: np.ndarray
    breaks: bool  # whether no piece holds a line break
    size: int

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.vocab_size()
        pieces = [model.id_to_piece(i) for i in range(size)]
        byte_ids, normal = np.zeros(256, np.int32), {}
        decoded = []
        for i, piece in enumerate(pieces):
            if model.is_byte(i):
                byte_ids[int(piece[3:5], 16)] = i
                decoded.append(bytes([int(piece[3:5], 16)]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                decoded.append(b"")
            else:
                normal[piece] = i
                decoded.append(piece.replace(BLANK, " ").encode())
        order = sorted(normal.values(), key=lambda i: -model.get_score(i))
        rank = np.full(size, _NONE, np.int32)
        rank[order] = np.arange(len(order))
        keys, ids = [], []
        for piece, i in normal.items():
            for cut in range(1, len(piece)):
                left, right = normal.get(piece[:cut]), normal.get(piece[cut:])
                if left is not None and right is not None:
                    keys.append(left * size + right)
                    ids.append(i)
        slots = _slot(np.array(keys, np.int64)).tolist()
        table, made, probes = np.full(1 << PAIR_BITS, -1, np.int64), np.full(1 << PAIR_BITS, -1, np.int32), 1
        for slot, key, i in zip(slots, keys, ids):
            at = slot
            while table[at % len(table)] >= 0:
                at += 1
            table[at % len(table)], made[at % len(table)] = key, i
            probes = max(probes, at - slot + 1)
        chars, others = np.full(1 << 16, -1, np.int32), {}
        for p, i in normal.items():
            if len(p) == 1 and p != BLANK:
                if ord(p) < len(chars):
                    chars[ord(p)] = i
                else:
                    others[ord(p)] = i
        # A blank is shown to the vocabulary as U+2581; the mark itself has no piece here.
        chars[32] = normal.get(BLANK, -1)
        return cls(chars, others, table, made, probes, rank, byte_ids, np.frombuffer(b"".join(decoded), np.uint8),
                   np.concatenate([[0], np.cumsum([len(d) for d in decoded])]),
                   not any("\n" in p for p in normal), size)

    def symbols(self, points: np.ndarray) -> np.ndarray:
        out = self.chars[np.minimum(points, len(self.chars) - 1)]
        for at in np.flatnonzero(points >= len(self.chars)).tolist():
            out[at] = self.others.get(int(points[at]), -1)
        return out

    def join(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Piece made by each pair, or -1."""
        keys = left.astype(np.int64) * self.size + right
        keys[(left < 0) | (right < 0)] = -2
        slot = _slot(keys)
        there = self.pair_keys[slot]
        out = np.where(there == keys, self.pair_ids[slot], -1)
        open_ = np.flatnonzero((there != keys) & (there >= 0) & (keys >= 0))
        for step in range(1, self.probes):
            if not len(open_):
                break
            slot = (_slot(keys[open_]) + step) % len(self.pair_keys)
            there = self.pair_keys[slot]
            hit = there == keys[open_]
            out[open_[hit]] = self.pair_ids[slot[hit]]
            open_ = open_[~hit & (there >= 0)]
        return out


def _slot(keys: np.ndarray) -> np.ndarray:
    return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - PAIR_BITS)).astype(np.int64)


def skipped(key: np.ndarray, start, middle, end, limit: np.uint64) -> np.ndarray:
    """The keyed coin of candidates: True where one is left out."""
    place = (np.asarray(start).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
             + np.asarray(middle).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
             + np.asarray(end).astype(np.uint64) * np.uint64(0x165667B19E3779F9))
    return common.mix(common.mix(np.asarray(key) ^ place)) < limit


def _limit(dropout: float) -> np.uint64:
    return np.uint64(min(int(dropout * 2.0 ** 64), (1 << 64) - 1))


def _one(v: Vocabulary, symbols: list[int], key: int, limit: np.uint64, log: list | None = None) -> list[tuple[int, int, int]]:
    """(symbol, start, end) left of one unit after its agenda, by a heap and linked symbols.

    `log` gets (start, middle, end, skipped) of each candidate in the order of the agenda.
    """
    n = len(symbols)
    ids, ends = list(symbols), list(range(1, n + 1))
    before, after, alive = list(range(-1, n - 1)), list(range(1, n + 1)), [True] * n
    heap: list[tuple] = []

    def offer(lefts: list[int]) -> None:
        lefts = [i for i in lefts if i >= 0 and after[i] < n]
        if not lefts:
            return
        rights = [after[i] for i in lefts]
        made = v.join(np.array([ids[i] for i in lefts]), np.array([ids[j] for j in rights]))
        out = skipped(np.full(len(lefts), key, np.uint64), lefts, rights, [ends[j] for j in rights], limit)
        for i, j, m, no in zip(lefts, rights, made.tolist(), out.tolist()):
            if m >= 0 and (log is not None or not no):
                heapq.heappush(heap, (int(v.rank[m]), i, j, ends[j], ends[i], m, no))

    offer(list(range(n)))
    while heap:
        _, i, j, end, middle, m, no = heapq.heappop(heap)
        if not (alive[i] and j < n and alive[j] and after[i] == j and ends[j] == end and ends[i] == middle):
            continue
        if log is not None:
            log.append((i, j, end, no))
        if no:
            continue
        ids[i], ends[i], alive[j], after[i] = m, end, False, after[j]
        if after[i] < n:
            before[after[i]] = i
        offer([before[i], i])
    return [(ids[i], i, ends[i]) for i in range(n) if alive[i]]


def _many(v: Vocabulary, symbols: np.ndarray, units: np.ndarray, places: np.ndarray, lengths: np.ndarray,
          keys: np.ndarray, limit: np.uint64, log: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(unit, symbol, start) left of all units, sorted; every round takes one candidate of a unit.

    `log` gets (unit, start, middle, end, skipped) of the candidates of each round, as arrays.
    """
    if not len(symbols):
        return units, symbols, places
    done = []
    symbols, units, places = (x.astype(np.int32) for x in (symbols, units, places))
    ends = np.concatenate([places[1:], [0]]).astype(np.int32)
    last = np.concatenate([units[1:] != units[:-1], [True]])
    ends[last] = lengths[units[last]]

    def ranks(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and piece of the pairs that start at symbol numbers `at`."""
        nxt = np.minimum(at + 1, len(symbols) - 1)
        made = np.where((at + 1 < len(symbols)) & (units[nxt] == units[at]), v.join(symbols[at], symbols[nxt]), -1)
        return np.where(made >= 0, v.rank[made], _NONE), made

    rank, made = ranks(np.arange(len(symbols)))
    while len(symbols):
        first = np.flatnonzero(np.concatenate([[True], units[1:] != units[:-1]]))
        best = np.minimum.reduceat(rank, first)
        sizes = np.diff(np.concatenate([first, [len(symbols)]]))
        ended = np.repeat(best == _NONE, sizes)
        if ended.any():
            done.append((units[ended], symbols[ended], places[ended]))
            go = ~ended
            symbols, units, places, ends, rank, made = (x[go] for x in (symbols, units, places, ends, rank, made))
            if not len(symbols):
                break
            keep = best != _NONE
            sizes, best = sizes[keep], best[keep]
        hits = np.flatnonzero(rank == np.repeat(best, sizes))
        hits = hits[np.concatenate([[True], units[hits][1:] != units[hits][:-1]])]  # leftmost of a unit
        no = skipped(keys[units[hits]], places[hits], places[hits + 1], ends[hits + 1], limit)
        log.append((units[hits], places[hits], places[hits + 1], ends[hits + 1], no))
        rank[hits[no]] = _NONE
        hits = hits[~no]
        if not len(hits):
            continue
        symbols[hits], ends[hits] = made[hits], ends[hits + 1]
        stay = np.ones(len(symbols), bool)
        stay[hits + 1] = False
        shift = np.cumsum(~stay)
        hits = hits - shift[hits]
        symbols, units, places, ends, rank, made = (x[stay] for x in (symbols, units, places, ends, rank, made))
        touched = np.concatenate([hits, hits[hits > 0] - 1])
        rank[touched], made[touched] = ranks(touched)
    unit, symbol, place = (np.concatenate(x) for x in zip(*done))
    order = np.argsort(unit, kind="stable")
    return unit[order], symbol[order], place[order]


def segment(v: Vocabulary, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, opens: np.ndarray,
            keys: np.ndarray, limit: np.uint64) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Token ids of all units, flat, the count of each, and the agendas by unit: unit, start, middle,
    end and coin of every candidate; `opens` marks those that open a text."""
    sizes = ends - starts + opens
    begin = np.cumsum(sizes) - sizes
    data = buf[np.minimum(np.arange(int(sizes.sum())) + np.repeat(starts - opens - begin, sizes), len(buf) - 1)]
    data[begin[opens]] = 32
    points = np.frombuffer(data.tobytes().decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"), np.uint32)
    heads = np.flatnonzero((data & 0xC0) != 0x80)  # byte at which each character starts
    first = np.searchsorted(heads, np.concatenate([begin, [len(data)]]))
    lengths, first = np.diff(first), first[:-1]
    symbols = v.symbols(points)
    units = np.repeat(np.arange(len(starts)), lengths)
    places = np.arange(len(points)) - np.repeat(first, lengths)
    long = lengths > LONG
    short = ~long[units]
    number = np.cumsum(~long) - 1
    log: list[tuple] = []
    unit, symbol, place = _many(v, symbols[short], number[units[short]], places[short], lengths[~long], keys[~long], limit, log)
    shorts = np.flatnonzero(~long)
    log = [(shorts[x[0]], *x[1:]) for x in log]
    parts = [(shorts[unit], symbol, place)]
    for k in np.flatnonzero(long).tolist():
        own: list[tuple] = []
        left = np.array(_one(v, symbols[first[k]: first[k] + lengths[k]].tolist(), int(keys[k]), limit, own), np.int64)
        parts.append((np.full(len(left), k), left[:, 0], left[:, 1]))
        if own:
            log.append((np.full(len(own), k), *(np.array(x) for x in zip(*own))))
    unit, symbol, place = (np.concatenate(x) for x in zip(*parts))
    agenda = [np.concatenate(x) for x in zip(*log)] if log else [np.zeros(0, np.int64)] * 4 + [np.zeros(0, bool)]
    order = np.argsort(agenda[0], kind="stable")
    agenda = [x[order] for x in agenda]
    order = np.argsort(unit, kind="stable")
    unit, symbol, place = unit[order], symbol[order], place[order]
    # Characters without a piece become the tokens of their bytes.
    at = first[unit] + place
    width = np.where(symbol >= 0, 1, np.concatenate([heads, [len(data)]])[at + 1] - heads[at])
    k = np.arange(int(width.sum())) - np.repeat(np.cumsum(width) - width, width)
    tokens = np.repeat(symbol, width)
    rough = np.flatnonzero(tokens < 0)
    tokens[rough] = v.byte_ids[data[np.repeat(heads[at], width)[rough] + k[rough]]]
    return tokens.astype(np.int32), np.bincount(unit, width, len(starts)).astype(np.int64), agenda


class Encoder:
    def __init__(self, path: str, dropout: float = DROPOUT, seed: int = SEED):
        self.v = Vocabulary.load(path)
        self.limit, self.seed = _limit(dropout), np.uint64(seed)

    def units(self, buf: np.ndarray, offsets: np.ndarray):
        """Starts, ends and rows of the units, and whether each opens its text."""
        n = len(buf)
        blank = buf == 32
        cut = np.zeros(n + 1, bool)
        cut[1:n] = blank[1:] & ~blank[:-1]
        if self.v.breaks:
            line = buf == 10
            cut[:n] |= line
            cut[1:] |= line
        cut[offsets] = True
        starts = np.flatnonzero(cut[:n])
        ends = np.concatenate([starts[1:], [n]]) if n else starts
        rows = np.searchsorted(offsets, starts, side="right") - 1
        return starts, ends, rows, starts == offsets[rows]

    def encode(self, buf: np.ndarray, offsets: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All token ids of a slice of texts and the count of each text; `ids` are their doc_ids."""
        n = len(offsets) - 1
        if not len(buf):
            return np.zeros(0, np.int32), np.zeros(n, np.int64)
        starts, ends, rows, opens = self.units(buf, offsets)
        first = np.searchsorted(rows, np.arange(n))
        ordinal = np.arange(len(rows)) - first[rows]
        unit = common.range_hash(common.prefix_hash(buf), starts, ends) + opens.astype(np.uint64)
        chosen = common.mix(common.mix(ids.astype(np.int64).view(np.uint64) ^ self.seed)[rows] + ordinal.astype(np.uint64))
        keys = common.mix(unit ^ common.mix(chosen * np.uint64(0x9E3779B97F4A7C15) + self.seed))
        place = np.zeros(len(rows), np.int64)  # agenda of each unit
        runs, pending, group = [], np.arange(len(rows)), unit
        while len(pending):
            _, where, inverse = np.unique(group, return_index=True, return_inverse=True)
            one = pending[where]
            *run, agenda = segment(self.v, buf, starts[one], ends[one], opens[one], keys[one], self.limit)
            place[pending] = inverse + sum(len(r[1]) for r in runs)
            runs.append(run)
            other = np.ones(len(pending), bool)
            other[where] = False
            other = np.flatnonzero(other)
            differs, at = self.disagree(keys[pending[other]], inverse[other], agenda, len(one))
            pending, group = pending[other[differs]], at
        flat, sizes = (np.concatenate(x) for x in zip(*runs))
        counts = sizes[place]
        total = np.cumsum(counts)
        tokens = flat[np.arange(int(total[-1])) + np.repeat((np.cumsum(sizes) - sizes)[place] - total + counts, counts)]
        return tokens, np.bincount(rows, counts, n).astype(np.int64)


    def disagree(self, keys: np.ndarray, runs: np.ndarray, agenda: list[np.ndarray], n: int) -> tuple[np.ndarray, np.ndarray]:
        """Which `keys` have another coin somewhere in the agenda of their run (of `n`), and the first such place."""
        run, start, middle, end, coin = agenda
        sizes = np.bincount(run, minlength=n)
        begin = (np.cumsum(sizes) - sizes)[runs]
        sizes = sizes[runs]
        total = np.concatenate([[0], np.cumsum(sizes)])
        who, where, i = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0
        while i < len(keys):
            j = max(i + 1, int(np.searchsorted(total, total[i] + COINS, side="right")) - 1)
            key = np.repeat(np.arange(i, j), sizes[i:j])
            at = np.arange(total[j] - total[i]) + np.repeat(begin[i:j] - total[i:j] + total[i], sizes[i:j])
            wrong = np.flatnonzero(skipped(keys[key], start[at], middle[at], end[at], self.limit) != coin[at])
            wrong = wrong[np.concatenate([[True], key[wrong][1:] != key[wrong][:-1]])[: len(wrong)]]
            who.append(key[wrong]), where.append(at[wrong])
            i = j
        return np.concatenate(who), np.concatenate(where)


def decode_rows(v: Vocabulary, tokens: np.ndarray, counts: np.ndarray) -> list[bytes]:
    """The bytes of each row; the blank put in front by encoding is taken off."""
    sizes = v.piece_starts[tokens + 1] - v.piece_starts[tokens]
    total = np.concatenate([[0], np.cumsum(sizes)])
    flat = v.piece_bytes[np.arange(int(total[-1])) + np.repeat(v.piece_starts[tokens] - total[:-1], sizes)]
    data, borders = flat.tobytes(), total[np.concatenate([[0], np.cumsum(counts)])]
    return [data[i + 1: j] for i, j in zip(borders[:-1].tolist(), borders[1:].tolist())]


def encode(docs: DataFrame, model: str | None = None, dropout: float = DROPOUT, seed: int = SEED) -> DataFrame:
    """doc_id, text and ids (array of int) for each row of `docs`."""
    import public_tokenizers
    path = model or public_tokenizers.path(MODEL)

    def run(batches):
        encoder = Encoder(path, dropout, seed)
        for batch in batches:
            buf, offsets = common.text_buffer(batch.column(1))
            keys = batch.column(0).fill_null(-1 << 63).to_numpy(zero_copy_only=False)
            parts = [encoder.encode(buf[offsets[i]: offsets[j]], offsets[i: j + 1] - offsets[i], keys[i:j])
                     for i, j in common.row_slices(offsets, SLICE_BYTES)]
            ids = np.concatenate([p[0] for p in parts]) if parts else np.zeros(0, np.int32)
            counts = np.concatenate([p[1] for p in parts]) if parts else np.zeros(0, np.int64)
            lists = pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), pa.array(ids, pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists], names=["doc_id", "text", "ids"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, text string, ids array<int>")


def decode(encoded: DataFrame, model: str | None = None) -> DataFrame:
    """All columns of `encoded` and `decoded`, the text of its column ids."""
    import public_tokenizers
    path = model or public_tokenizers.path(MODEL)
    at = encoded.columns.index("ids")
    schema = StructType([*encoded.schema.fields, StructField("decoded", StringType())])

    def run(batches):
        v = Vocabulary.load(path)
        for batch in batches:
            lists = batch.column(at)
            if isinstance(lists, pa.ChunkedArray):
                lists = lists.combine_chunks()
            counts = np.diff(lists.offsets.to_numpy())
            rows = decode_rows(v, lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64), counts)
            texts = pa.array(rows, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], names=[*batch.schema.names, "decoded"])

    return encoded.mapInArrow(run, schema)


@query("op5_sentencepiece_dropout")
def op5_sentencepiece_dropout(spark, sf_dir):
    common.small_batches(spark, 500)
    both = decode(encode(common.table(spark, sf_dir, "documents")))
    return both.select("doc_id", "ids", F.size("ids").alias("n_tokens"),
                       (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("lossless"))
