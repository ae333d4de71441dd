"""Searches against exhaustive ones, queries against brute force, and the pipeline on odd tables."""

from __future__ import annotations

import base64
import collections
import hashlib
import heapq
import os
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from creditloom.llm import common, decontaminate, licenses, near_duplicates, quality, sharding, suffix_dedup, warc
from creditloom.session import Scope

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
given = pytest.mark.skipif(not os.path.isdir(SF), reason="given tables are not here")


def prose(seed: int, words: int) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice("aeiou") + r.choice("bcdfglmnrst") for _ in range(r.randint(1, 4))) for _ in range(words))


def documents(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]


@given
def test_license_query_equals_brute_force(spark):
    got = {r.doc_id: r for r in licenses.op6_license_scan(spark, SF).collect()}
    phrases = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
    for key, text in documents(spark):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
        at = [(i, label) for p, label in phrases.items() for i in range(len(words)) if words[i: i + len(p.split())] == p.split()]
        r = got[key]
        assert (r.n_words, r.n_base, r.base_labels) == (len(words), len(at), ",".join(sorted({x for _, x in at})))
        assert (r.first_word, r.last_word) == (min(at)[0] if at else None, max(at)[0] if at else None)
        assert set(r.base_labels.split(",")) <= set(r.labels.split(",")) | {""} and 0 <= r.score <= 1


def test_no_start_with_enough_anchors_is_missed():
    """The looked-up rare words propose every start that an exhaustive search of all starts finds."""
    index, r = licenses.Index(), random.Random(7)
    vocabulary = sorted({w for _, _, words in index.templates for w in words})
    for _ in range(60):
        words = r.choices(vocabulary + [b"x"] * 40, k=r.randint(0, 120))
        for _, _, template in r.sample(index.templates, 3):
            part = [w for w in template if r.random() > 0.15]
            at = r.randint(0, len(words))
            words[at:at] = part
        want = {}
        for t, anchors in enumerate(index.anchors):
            found = []
            exact = {d - p for w, at in anchors for p in at for d, x in enumerate(words) if x == w}
            for s in sorted(exact):
                n = sum(any(0 <= s + p + k < len(words) and words[s + p + k] == w for p in at for k in range(-licenses.SLACK, licenses.SLACK + 1))
                        for w, at in anchors)
                if n / len(anchors) >= licenses.AGREE - 1e-9:
                    found.append((s, n / len(anchors)))
            if found:
                want[t] = found
        assert index.starts(words) == want


def test_whole_licences_are_named():
    index = licenses.Index()
    for label, _, text in licenses.TEMPLATES:
        noisy = f"{prose(1, 50)}\n/* {text.upper()} */\n{prose(2, 50)}"
        assert label in licenses.scan_text(noisy.encode(), index)[5].split(",")


def exhaustive(item: np.ndarray, text: np.ndarray) -> int:
    """Fewest edits of `item` against any part of `text`."""
    cost = np.zeros(len(text) + 1, int)
    for i, c in enumerate(item):
        new = np.empty_like(cost)
        new[0] = i + 1
        for j in range(1, len(text) + 1):
            new[j] = min(cost[j - 1] + (c != text[j - 1]), cost[j] + 1, new[j - 1] + 1)
        cost = new
    return int(cost.min())


def test_the_filter_loses_nothing():
    """Documents with edited items of all lengths: found where, and only where, an exhaustive alignment
    meets the budget."""
    r, hits = random.Random(6), 0
    for _ in range(25):
        items = [(k, "".join(r.choices("abcd ", k=r.randint(8, 90)))) for k in range(6)]
        texts = []
        for _ in range(6):
            text = list("".join(r.choices("abcd ", k=r.randint(0, 40))))
            for _, item in r.sample(items, 2):
                edited = list(item)
                for _ in range(r.randint(0, 1 + len(item) // 9)):
                    at = r.randrange(len(edited))
                    edited[at: at + r.randint(0, 2)] = r.choices("abcd", k=r.randint(0, 2))
                text += edited + list("".join(r.choices("abcd ", k=r.randint(0, 20))))
            texts.append("".join(text))
        found = {(row, key): edits for row, key, _, _, edits, _ in decontaminate.matches(decontaminate.Index(items), texts)}
        for row, text in enumerate(texts):
            chars, _ = decontaminate.normal(text)
            for key, item in items:
                folded, _ = decontaminate.normal(item)
                if len(folded) < decontaminate.Q:
                    continue
                least = exhaustive(folded, chars)
                assert found.get((row, key)) == (least if least <= decontaminate.budget(len(folded)) else None)
                hits += (row, key) in found
    assert hits > 100


def test_short_items_and_parts(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "He asked: what is 7 times 8? Nobody knew."), (2, "yes, no"), (3, "yesterday"), (4, None), (5, "QED")],
                                 "doc_id long, text string")
    items = spark.createDataFrame([(10, "What is 7 times 8?"), (11, "Yes"), (12, "q.e.d"), (13, ""), (14, None), (15, "qed"), (11, "Yes")],
                                  "item_id long, text string")
    want = {(1, 10), (2, 11), (5, 15)}
    for size in (decontaminate.BLOCK_CHARS, 4):  # one part, and many
        monkeypatch.setattr(decontaminate, "BLOCK_CHARS", size)
        assert {(r.doc_id, r.item_id) for r in decontaminate.find(docs, items).collect()} == want
        assert {r.doc_id for r in decontaminate.clean(docs, items).collect()} == {3, 4}


@given
def test_decontamination_query_finds_all_literal_items(spark):
    fold = lambda t: "".join(map(chr, decontaminate.normal(t or "")[0]))
    items = {r.item_id: fold(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    got = collections.defaultdict(dict)
    for r in decontaminate.op7_decontamination(spark, SF).collect():
        got[r.doc_id][r.item_id] = r.edits
    for key, text in documents(spark):
        folded = fold(text)
        assert {i for i, t in items.items() if t in folded} == {i for i, e in got[key].items() if e == 0}


@given
def test_sharding_query_equals_a_heap(spark):
    rows = sharding.op2_lpt_sharding(spark, SF).collect()
    texts = dict(documents(spark))
    groups = collections.Counter()
    for r in rows:
        data = (texts[r.doc_id] or "").encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(data) + 8, zlib.crc32(data), "bytes", None)
        groups[data] += len(data) + 8
    heap = [(0, i) for i in range(24)]
    for size in sorted(groups.values(), reverse=True):
        load, i = heapq.heappop(heap)
        heapq.heappush(heap, (load + size, i))
    loads, where = collections.Counter(), collections.defaultdict(set)
    for r in rows:
        loads[r.shard] += r["size"]
        where[texts[r.doc_id]].add(r.shard)
    assert [loads[i] for i in range(24)] == [load for load, _ in sorted(heap, key=lambda x: x[1])]
    assert all(len(s) == 1 for s in where.values())
    for shard in range(24):
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(sum(r.shard == shard for r in rows)))


@given
def test_warc_query_equals_brute_force(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").collect()
    first = {}
    for p in sorted(pages, key=lambda p: p.page_id):
        first.setdefault(p.html or "", p.page_id)
    got = {r.page_id: tuple(r)[1:] for r in warc.op4_warc(spark, SF).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()}
    for p in pages:
        data, own = (p.html or "").encode(), first[p.html or ""]
        assert got[p.page_id] == (len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(),
                                  "response" if own == p.page_id else "revisit", None if own == p.page_id else own)


def test_junk_that_the_bands_reject(spark):
    r = random.Random(3)
    letters = " ".join("".join(r.choices("bcdfghjklmnpqrstvwxz", k=r.randint(4, 12))) for _ in range(200))
    lines = " ".join(base64.b64encode(r.randbytes(45)).decode() for _ in range(60))
    capitals = " ".join("".join(r.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZ", k=r.randint(4, 12))) for _ in range(200))
    english = ("The committee read the report on Tuesday and asked why the harbour had been closed for so long, because nobody "
               "who lived near the water could remember a storm of that kind in the last thirty years. ") * 1
    rows = [(1, letters, "en"), (2, lines, "en"), (3, lines, None), (4, capitals, "en"), (5, english, "en"), (6, english, None)]
    frame = spark.createDataFrame([(i, t, lang, None, None) for i, t, lang in rows], SCHEMA)
    assert {x.doc_id for x in quality.keep_good(frame).collect()} == {5, 6}


CLASHES = ("key", "hash", "key_", "hash_", "text_hash", "runs", "runs_", "node", "_bucket", "class_key", "at", "gram")


@pytest.fixture(scope="module")
def odd(spark):
    base = prose(1, 130)
    rows = [(1, base), (2, base), (3, base.replace("a", "á", 2)), (4, None), (5, ""), (6, "one two"), (None, prose(3, 40)), (7, prose(2, 9000)),
            (8, prose(4, 60)), (8, prose(4, 60)), (9, prose(5, 60) + " " + base), (9, prose(6, 60)), (10, "é中👍 \x00 " * 30)]
    frame = spark.createDataFrame([(i, t, "en" if k % 2 else None, None, None) for k, (i, t) in enumerate(rows)], SCHEMA)
    return frame.withColumns({c: F.concat(F.lit(f"mine {c} "), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))) for c in CLASHES}
                             ).withColumn("RUNS__", F.lit(0.5))


def test_stages_keep_columns_of_any_name(spark, odd):
    """Values of other columns stay as they are, in any order of the stages, and empty tables pass."""
    common.small_batches(spark)
    items = spark.createDataFrame([(1, prose(6, 40))], "item_id long, text string")
    stages = {"near": near_duplicates.keep_one, "suffix": suffix_dedup.remove, "quality": quality.keep_good,
              "items": lambda d: decontaminate.clean(d, items)}
    values = {r.doc_id: tuple(r[c] for c in (*CLASHES, "RUNS__")) for r in odd.collect()}
    for order in (["near", "suffix", "items"], ["items", "quality", "suffix", "near"]):
        docs, none = odd, odd.limit(0)
        for name in order:
            docs, none = stages[name](docs), stages[name](none)
            assert docs.columns == odd.columns == none.columns
        rows = docs.collect()
        assert none.count() == 0 and rows
        assert all(tuple(r[c] for c in (*CLASHES, "RUNS__")) == values[r.doc_id] for r in rows)
        ids = [r.doc_id for r in rows]
        assert 1 in ids and 2 not in ids and ids.count(9) <= 1


def test_pipeline_stages_on_odd_and_empty_tables(spark, odd, tmp_path):
    folder = str(tmp_path)
    spark.createDataFrame([(1, prose(6, 40)), (2, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    for name, frame in (("all", odd), ("none", odd.limit(0))):
        docs = frame
        with Scope(spark, "test") as scope:
            for stage, function in corpus_pipeline.STAGES[:-1]:
                docs = scope.table(function(spark, docs, folder), stage)
                assert docs.columns == odd.columns
            out = corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect()
        assert (len(out) > 0) == (name == "all")


def test_components_count_their_rounds_while_writing(spark, monkeypatch):
    """Random graphs, a chain, a hub and no edges at all; no round reads its edges again to compare them."""
    rng = random.Random(4)
    chain = [(i, i + 1) for i in range(100, 140)]
    hub = [(200, i) for i in range(201, 230)]
    loose = [(rng.randrange(300, 360), rng.randrange(300, 360)) for _ in range(45)]
    edges = chain + hub + loose + [(7, 7)]
    rng.shuffle(edges)
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        low, high = sorted((root(a), root(b)))
        parent[high] = low
    frame = spark.createDataFrame(edges, "a long, b long")
    monkeypatch.setattr(type(frame), "first", lambda self: pytest.fail("the edges are read again"))
    with Scope(spark, "components") as scope:
        got = {r["node"]: r["component"] for r in common.connected_components(scope, frame).collect()}
        assert got == {x: root(x) for x in parent if root(x) != x}
        assert common.connected_components(scope, frame.limit(0)).count() == 0
        assert common.connected_components(scope, frame.where("a = b")).count() == 0


def test_components_of_stars_take_one_round(spark, monkeypatch):
    """Edges that are stars already, in either direction and repeated, are written as they come and once more."""
    edges = [(i, 1) for i in range(2, 9)] + [(20, i) for i in range(21, 25)] + [(2, 1), (1, 2)]
    with Scope(spark, "components") as scope:
        tables, table = [], scope.table
        monkeypatch.setattr(scope, "table", lambda df, name="stage": tables.append(name) or table(df, name))
        got = {r["node"]: r["component"] for r in common.connected_components(
            scope, spark.createDataFrame(edges, "a long, b long")).collect()}
        assert got == {**{i: 1 for i in range(2, 9)}, **{i: 20 for i in range(21, 25)}}
        assert len(tables) == 2


def test_anchors_hold_little_at_once():
    """The arrays made for one slice of texts stay small, and slices give the anchors of the whole."""
    import tracemalloc
    rng = np.random.default_rng(3)
    buf, offsets = rng.integers(97, 123, 4 << 20).astype(np.uint8), np.arange(0, (4 << 20) + 1, 1 << 15)
    common.powers(1)
    suffix_dedup.anchors(buf[:1000], np.array([0, 1000]))
    tracemalloc.start()
    made = 0
    for i, j in common.row_slices(offsets, suffix_dedup.SLICE):
        made += len(suffix_dedup.anchors(buf[offsets[i]: offsets[j]], offsets[i: j + 1] - offsets[i])[0])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 64 << 20
    assert made == len(suffix_dedup.anchors(buf, offsets)[0])
