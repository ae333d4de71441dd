"""Importance resampling, conversation repair and the language model against brute force."""

from __future__ import annotations

import collections
import hashlib
import math
import os
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from creditloom.llm import common, conversation_repair, language_model, resampling
from creditloom.session import Scope

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
TURNS = "conv_id long, turn long, role string, text string"
given = pytest.mark.skipif(not os.path.isdir(SF), reason="given tables are not here")


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def prose(seed: int, words: int) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice("aeiou") + r.choice("bcdfglmnrst") for _ in range(r.randint(1, 4))) for _ in range(words))


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and very long texts, ties, repeated rows and clashing columns."""
    common.small_batches(spark)
    rows = [(1, prose(1, 120)), (2, prose(1, 120)), (3, None), (4, ""), (5, "one two"), (6, "é中👍 \x00 ▁ " * 9), (7, prose(2, 30_000)),
            (None, prose(3, 40)), (None, prose(3, 40)), (8, prose(4, 50)), (8, prose(4, 50)), (8, prose(5, 60)), (9, "x" * 5000 + " " + prose(6, 30))]
    frame = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], DOCS)
    return frame.withColumns({c: F.lit("clash") for c in ("key", "rank", "score", "word", "start", "block", "part", "n")}), rows


# Importance resampling.

def resampled(docs, target, ngrams=1, buckets=10_000, least=20, share=10):
    """(doc_id, n_features, weight, score, rank) by brute force; docs are (doc_id, text)."""
    def read(text):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))
        return len(w), [zlib.crc32(" ".join(w[i:i + k]).encode()) % buckets for k in range(1, ngrams + 1) for i in range(len(w) - k + 1)]
    s, t = collections.Counter(), collections.Counter()
    for _, text in docs:
        s.update(read(text)[1])
    for text in target:
        t.update(read(text)[1])
    n_s, n_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (n_s + buckets) / ((s[b] + 1) * (n_t + buckets)))) for b in range(buckets)]
    out = []
    for key, text in docs:
        words, found = read(text)
        weight = sum(gain[b] for b in found)
        h = int(hashlib.sha256(f"2024:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        out.append([words, key, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    enough = sorted((r for r in out if r[0] >= least), key=lambda r: (-r[4], r[1] is not None, r[1] or 0, r[2]))
    for k, r in enumerate(enough):
        r.append(k + 1 if k < share * len(enough) // 100 else None)
    return sorted((tuple(r[1:] if len(r) == 6 else (*r[1:], None)) for r in out), key=str)


@given
def test_resampling_brute(spark, monkeypatch):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    target = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    want = resampled(docs, target)
    assert sorted(map(tuple, resampling.op11_importance_resampling(spark, SF).collect()), key=str) == want
    # Many runs, parts and rounds of samples give the same ranks.
    for name, value in (("RUN", 16), ("PART", 20), ("SAMPLES", 6), ("SPLIT_FROM", 12)):
        monkeypatch.setattr(resampling, name, value)
    assert sorted(map(tuple, resampling.op11_importance_resampling(spark, SF).collect()), key=str) == want


def test_resampling_odd(spark, odd):
    frame, rows = odd
    target = frame.limit(0).unionByName(spark.createDataFrame([(1, prose(3, 30), None, None, None), (2, None, None, None, None)], DOCS).withColumns(
        {c: F.lit("x") for c in frame.columns[5:]}))
    with Scope(spark, "test") as scope:
        for ngrams in (1, 3):
            got = resampling.resample(scope, frame, target, ngrams, 97, share=50).collect()
            assert sorted(map(tuple, got), key=str) == resampled(rows, [prose(3, 30)], ngrams, 97, share=50)
        assert resampling.resample(scope, frame.limit(0), target).count() == 0
        assert {r.weight for r in resampling.resample(scope, frame, target.limit(0)).collect() if r.doc_id in (3, 4)} == {0}


def test_crc_of_long_words():
    r = random.Random(3)
    words = [bytes(r.choices(range(256), k=r.choice([0, 1, 5, 47, 48, 49, 200]))) for _ in range(300)]
    buf = np.frombuffer(b"".join(words), np.uint8)
    ends = np.cumsum([len(w) for w in words])
    got = resampling.crc_on(np.zeros(len(words), np.uint32), buf, ends - [len(w) for w in words], ends)
    assert got.tolist() == [zlib.crc32(w) for w in words]


def test_repeated_rows_share_no_part(spark, monkeypatch):
    """A key with most of the rows gets consecutive ranks, and travels as one entry a run."""
    monkeypatch.setattr(resampling, "PART", 40)
    monkeypatch.setattr(resampling, "RUN", 50)
    rows = [(7, 3, 5, 900)] * 300 + [(k, 3, 5, 800 + k) for k in range(200)]
    frame = spark.createDataFrame(rows, "doc_id long, n_features long, weight long, score long").repartition(4)
    with Scope(spark, "test") as scope:
        got = resampling.rank(scope, frame, 100).collect()
        assert sum(len(r["keys"]) for r in resampling.sort_runs(frame).collect()) < 300 * resampling._KEY.itemsize
    assert sorted(r["rank"] for r in got) == list(range(1, 501))
    assert [r.doc_id for r in sorted(got, key=lambda r: r["rank"])] == [r[0] for r in sorted(rows, key=lambda r: (-r[3], r[0]))]


# Conversation repair.

def cheapest(initials, faults):
    """The cheapest audit, least in ASCII order, by dynamic programming from the end."""
    step = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}
    best = {0: (0, ""), 1: (6, "II"), 2: (3, "I"), 3: (0, "")}
    for initial, fault in reversed(list(zip(initials, faults))):
        row = {}
        for q in range(4):
            options, m = [(4 + best[q][0], "D" + best[q][1])], 3 if q == 2 else 2
            if fault not in "bd":
                extra = 3 if fault == "c" else 0
                if (q, initial) in step:
                    options.append((extra + best[step[q, initial]][0], "K" + best[step[q, initial]][1]))
                options.append((3 + extra + best[m][0], "R" + best[m][1]))
            row[q] = min(options)
        for _ in range(4):
            for q in range(4):
                m = 3 if q == 2 else 2
                row[q] = min(row[q], (3 + row[m][0], "I" + row[m][1]))
        best = row
    return best[0]


def damaged(rows):
    """Conversations after damage: conv_id -> sorted (turn, role, text)."""
    out = {}
    for conv, turn, role, text in rows:
        held = out.setdefault(conv, [])
        fate = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if fate:
            text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
            held += [(turn, "user" if fate == 4 else role, text)] * (2 if fate == 3 else 1)
    for held in out.values():
        held.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2][:64], hashlib.sha256(r[2].encode()).hexdigest()))
    return out


def expected(rows):
    """What the contract returns, per conversation."""
    out = {}
    for conv, held in damaged(rows).items():
        faults, seen = "", set()
        for _, role, text in held:
            left = text.rstrip(" \t\n\x0b\x0c\r")
            faults += "b" if not left else "d" if (role, text) in seen else "c" if left[-1] not in ".!?" else "f"
            seen.add((role, text))
        initials = [role[:1] or " " for _, role, _ in held]
        turns = [t for t, _, _ in held if t is not None]
        cost, audit = cheapest(initials, faults)
        lines, at, state = [], iter(held), 0
        for edit in audit:
            made, name = (3, "assistant") if state == 2 else (2, "user")
            _, role, text = (None, name, "") if edit == "I" else next(at)
            if edit != "D":
                lines.append(f"{role if edit == 'K' else name}:{text}")
                state = {"s": 1, "u": 2, "a": 3}[role[0]] if edit == "K" else made
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count("b"), faults.count("d"), faults.count("c"),
                     sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
                     hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


@given
def test_repair_brute(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = {r.conv_id: tuple(r)[1:] for r in conversation_repair.op12_conversation_repair(spark, SF).collect()}
    assert got == expected(rows)


def odd_turns():
    r, rows = random.Random(5), []
    for k in range(900):
        conv = r.choice([None, 1, 1, 1, *range(2, 60)])  # one conversation with many rows
        rows.append((conv, r.choice([None, *range(12)]) if conv != 1 else k, r.choice(["system", "user", "user", "assistant", "tool", "", None]),
                     r.choice([None, "", "  \n", "same.", "Yes!", "cut", "cut. \t", prose(k, 5) + ".", "é中?", prose(k, 40) + " end"])))
    return rows + rows[::9] + [(70, None, None, None), (71, 3, "user", "x" * 300_000 + ".")]


def test_repair_odd(spark, monkeypatch):
    """Conversations that reach over several tasks and stretches, with nulls, ties and repeated rows."""
    rows = odd_turns()
    frame = spark.createDataFrame(rows, TURNS).repartition(3).withColumns({c: F.lit(1.5) for c in ("kind", "copies", "digest", "head", "moves")})
    want = expected(rows)
    monkeypatch.setattr(conversation_repair, "STRETCH", 5)
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        with Scope(spark, "test") as scope:
            ready = conversation_repair.damage(frame)
            assert conversation_repair.pieces(conversation_repair.judged(conversation_repair.prepared(ready, "copies"))).where("not whole").count() > 4
            assert {r.conv_id: tuple(r)[1:] for r in conversation_repair.digest(conversation_repair.repair(scope, ready, "copies")).collect()} == want
            turns = conversation_repair.repaired(scope, frame).collect()
            assert conversation_repair.digest(conversation_repair.repair(scope, frame.limit(0))).count() == 0
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    made = collections.defaultdict(list)
    for r in sorted(turns, key=lambda r: r.place):
        made[r.conv_id].append(r.role[:1])
    assert all(re.fullmatch("(s?(ua)+)?", "".join(x)) for x in made.values())


def test_search_equals_dynamic_programming():
    r = random.Random(2)
    for _ in range(400):
        n = r.randint(1, 12)
        initials, faults = [r.choice("suaut ") for _ in range(n)], [r.choice("ffffbdc") for _ in range(n)]
        assert conversation_repair.Search(initials, "".join(faults), conversation_repair.ACCEPTED).run(0) == cheapest(initials, faults)


# The language model.

@given
def test_language_model_base_and_probabilities(spark, monkeypatch):
    docs = {r.doc_id: re.findall(r"[^\x20\x09-\x0D]+", lower(r.text)) + [None] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    c = collections.Counter(w for k, t in docs.items() if zlib.crc32(str(k).encode()) % 7 != 2 for w in t)
    n, v = sum(c.values()), len(c)
    found = {}
    for block in (language_model.BLOCK, 9_000):
        monkeypatch.setattr(language_model, "BLOCK", block)
        monkeypatch.setattr(language_model, "SLICE", 1 << 17)
        rows = language_model.op13_pitman_yor_scores(spark, SF)
        found[block] = {r.doc_id: r.score for r in rows.collect()}
        for r in rows.collect():
            t = docs[r.doc_id]
            assert (r.n_tokens, r.n_known, r.train_tokens) == (len(t), sum(c[w] > 0 for w in t), n)
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 7 == 2)
            assert abs(r.base_score - sum(math.log10((c[w] + 1) / (n + v + 1)) for w in t)) < 1e-6 * abs(r.base_score)
        by = {r.held_out: r for r in language_model.perplexity(rows).collect()}
        assert all(r.perplexity < 0.7 * r.base_perplexity for r in by.values())
    one, many = (np.array([found[b][k] for k in sorted(docs)]) for b in found)
    assert np.abs(one - many).sum() < 0.02 * np.abs(one).sum()  # spread contexts read their tables from the start


def test_probabilities_of_a_context_add_up(spark):
    """Over all known words and one unknown, the probabilities after each context sum to one."""
    r = random.Random(1)
    texts = [" ".join(r.choice("abcdef") for _ in range(r.randint(1, 12))) for _ in range(80)]
    words = ["a", "b", "c", "d", "e", "f", "zz"]
    probes = [f"{x} {y}" for x in [*words, "q"] for y in words]
    rows = [(k * 7, t) for k, t in enumerate(texts)]
    out = [(10_000 + k, t) for k, t in enumerate(probes)]
    ids = [i for i in range(10_000, 30_000) if language_model.held_out(i)][: len(probes) + 8]
    out = [(i, t) for i, (_, t) in zip(ids, out)]
    single = [(i, t) for i, t in zip(ids[len(out):], [*words, "q"])]
    frame = spark.createDataFrame([(i, t, None, None, None) for i, t in rows + out + single], DOCS)
    with Scope(spark, "test") as scope:
        got = {r.doc_id: r.score for r in language_model.score(frame, language_model.fit(scope, frame)).collect()}
        table = language_model.fit(scope, frame)
        key = {}
        for number in range(table.parts):
            keys, logs, _ = table.block(number)
            key |= dict(zip((keys >> np.uint64(8)).tolist(), logs.tolist()))
    assert len(got) == len(frame.collect())

    def hashed(w):
        _, h, _ = language_model.read(*common.text_buffer(pa.array([w])))
        return h[:1]
    for x in words[:6]:
        after = [10 ** key[int(language_model.pair_key(hashed(x), hashed(y))[0]) >> 8] for y in words]
        after.append(10 ** key[int(language_model.pair_key(hashed(x), np.array([language_model._END], np.uint64))[0]) >> 8])
        assert abs(sum(after) - 1) < 1e-5


def test_seating_keeps_its_counts():
    rng = np.random.default_rng(4)
    n = np.concatenate([rng.integers(0, 9, 300), [70, 500, 20_000]])
    context = rng.integers(0, 20, len(n))
    parent = rng.random(len(n)) / 30
    start = np.bincount(context, weights=n > 0, minlength=20).astype(np.int64)
    for t, tables in language_model.seatings(n, context, parent, 0.6, 1.0, start, np.zeros(20, bool), rng, 3, 4):
        assert (t[n > 0] >= 1).all() and (t <= n).all() and (t[n == 1] == 1).all()
        assert (np.bincount(context, weights=t, minlength=20) == tables).all()


def test_gibbs_reaches_the_distribution():
    """Tables of one pair of three customers, whose exact distribution is short to write down."""
    p, d, s = 0.4, 0.5, 1.0
    weight = collections.Counter()
    for sizes, ways in (([3], 1), ([2, 1], 3), ([1, 1, 1], 1)):
        k = len(sizes)
        w = np.prod([s + d * j for j in range(k)]) * p ** k * np.prod([np.prod([i - d for i in range(1, c)]) for c in sizes])
        weight[k] += ways * w
    rows = 20_000
    n = np.full(rows, 3)
    (t, _), = language_model.seatings(n, np.arange(rows), np.full(rows, p), d, s, np.ones(rows, np.int64), np.zeros(rows, bool),
                                      np.random.default_rng(3), 12, 1)
    for k in (1, 2, 3):
        assert abs((t == k).mean() - weight[k] / sum(weight.values())) < 0.015


def test_a_sweep_moves_every_customer(monkeypatch):
    """As many customers sit down anew before each sample as there are, and not a few of each pair."""
    moved, rng = collections.Counter(), np.random.default_rng(8)
    one, together = language_model.Group._sit, language_model.Group._sit_together
    monkeypatch.setattr(language_model.Group, "_sit", lambda self, rows, *a: (
        [moved.update({int(i): 1}) for i in self.at[:rows]], one(self, rows, *a)))
    monkeypatch.setattr(language_model.Group, "_sit_together", lambda self, group, *a: (
        moved.update(dict(zip(self.at.tolist(), np.asarray(group).tolist()))), together(self, group, *a)))
    n = np.concatenate([rng.integers(1, 60, 50), [63, 64, 70, 500, 20_000]])
    context = rng.integers(0, 5, len(n))
    start = np.bincount(context, minlength=5).astype(np.int64)
    seated = None
    for _ in language_model.seatings(n, context, rng.random(len(n)) / 9, 0.6, 1.0, start, np.zeros(5, bool), rng, 1, 3):
        if seated:
            assert all(moved[i] - seated[i] >= k for i, k in enumerate(n) if k > 1)
        seated = collections.Counter(moved)


def test_customers_that_move_together_reach_the_same_tables():
    """Long runs of single moves and of sweeps have the same mean number of tables."""
    rows, n, p, d = 600, 200, 0.2, 0.6
    start, at = np.ones(rows, np.int64), np.arange(rows)
    args = np.full(rows, n), at, np.full(rows, p), d, 1.0
    group, tables, all_ = language_model.Group(at, args[0], at, args[2], d, 1.0, np.random.default_rng(2)), start.copy(), np.ones(rows, bool)
    group.fill(tables, all_)
    single = []
    for k in range(16 * n):
        group.step(rows, tables, all_)
        if k >= 8 * n:
            single.append(group.tables.mean())
    sweeps = [t.mean() for t, _ in language_model.seatings(*args, start.copy(), ~all_, np.random.default_rng(3), 0, 16)]
    assert abs(np.mean(sweeps[8:]) / np.mean(single) - 1) < 0.1


def test_blocks_tell_the_tables_of_spread_contexts():
    contexts, words = np.array([5, 5, 5, 9, 9], np.uint64), np.array([1, 2, 3, 1, 2], np.uint64)
    block = language_model.Block.of(contexts, words, np.array([4, 1, 7, 2, 2]))
    t = np.where(block.words[:] == 3, 5, 1)
    told = [r["spread"] for r in block.requests(0, 3, t, np.array([5], np.int64)).to_pylist() if r["spread"]]
    assert told == [[{"context": 5, "customers": 12, "tables": 7}]]


def test_language_model_odd(spark, odd):
    frame, rows = odd
    with Scope(spark, "test") as scope:
        got = language_model.score(frame, language_model.fit(scope, frame)).collect()
        empty = frame.limit(0)
        assert language_model.score(empty, language_model.fit(scope, empty)).count() == 0
        none = frame.where("doc_id is null")  # nothing to learn from: every word is unknown
        assert {(r.n_known, r.train_tokens, r.held_out) for r in language_model.score(none, language_model.fit(scope, none)).collect()} == {(0, 0, False)}
    assert len(got) == len(rows)
    assert {r.n_tokens for r in got if r.doc_id in (3, 4)} == {1}
    assert len({r.score for r in got if r.doc_id is None}) == 1
    assert all(math.isfinite(r.score) and r.score <= 0 for r in got)
