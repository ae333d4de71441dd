"""The operators of the subpackage against brute force, exact round trips and edge cases."""

from __future__ import annotations

import base64
import collections
import hashlib
import os
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from creditloom.llm import (common, decontaminate, licenses, near_duplicates, quality, sentencepiece_dropout,
                            sharding, suffix_dedup, token_store, toxicity, warc)
from creditloom.session import Scope

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
given = pytest.mark.skipif(not os.path.isdir(SF), reason="given tables are not here")


def prose(seed: int, words: int) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice("aeiou") + r.choice("bcdfglmnrst") for _ in range(r.randint(1, 4))) for _ in range(words))


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and very long texts, ties, repeated rows, shared ids, and an extra clashing column."""
    common.small_batches(spark)
    base = prose(1, 120)
    rows = [(1, base), (2, base), (3, base.replace("a", "á", 3)), (4, None), (5, ""), (6, "one two"), (7, "é中👍 \x00 ▁"),
            (8, prose(2, 30_000)), (9, "ab " * 300), (None, prose(3, 40)), (10, prose(4, 50)), (10, prose(4, 50)),
            (11, prose(5, 60) + " " + base), (11, prose(6, 60)), (12, "x\n" * 40)]
    frame = spark.createDataFrame([(i, t, None if k % 3 else "en", None, None) for k, (i, t) in enumerate(rows)], SCHEMA)
    return frame.withColumn("key", F.lit("clash")).withColumn("hash", F.lit(0.5)), rows


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@given
def test_quality_base(spark):
    rows = {r.doc_id: r for r in quality.op1_quality_rules(spark, SF).collect()}
    for d in spark.read.parquet(f"{SF}/documents.parquet").collect():
        words = re.findall(r"[^\x20\x09-\x0D]+", d.text or "")
        at = collections.defaultdict(list)
        for i in range(len(words) - 7):
            at[tuple(words[i:i + 8])].append(i)
        again = {j for x in at.values() if len(x) > 1 for i in x for j in range(i, i + 8)}
        lines = [x for x in (d.text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        r = rows[d.doc_id]
        assert (r.n_words, r.word_chars, r.n_repeat_words) == (len(words), sum(map(len, words)), len(again))
        assert (r.n_symbols, r.n_dup_lines) == (len(re.findall(r"[#*$%&|<>]", d.text or "")), len(lines) - len(set(lines)))
        assert r.base_failed == (len(words) < 20 or 100 * len(again) > 30 * len(words))
        assert not (r.base_failed and r.kept)


def test_quality_odd(spark, odd):
    frame, rows = odd
    out = quality.rate(frame).collect()
    assert len(out) == len(rows)
    assert all(r.base_failed for r in out if r.doc_id in (4, 5, 6, 9, 12))
    assert quality.keep_good(frame).columns == frame.columns
    assert quality.rate(empty(spark)).count() == 0
    junk = spark.createDataFrame([(1, " ".join("\x01\x02\x03\x04" for _ in range(60)) + " a b c", "en", None, None)], SCHEMA)
    assert quality.keep_good(junk).count() == 0


def test_deal_equals_heap():
    import heapq
    r = random.Random(3)
    for _ in range(200):
        sizes = [(s, r.randint(1, 60)) for s in r.sample(range(1, 400), r.randint(1, 8))]
        load, heap = [0] * 5, [(0, i) for i in range(5)]
        for size, n in sorted(sizes, reverse=True):
            for _ in range(n):
                x, i = heapq.heappop(heap)
                load[i] += size
                heapq.heappush(heap, (x + size, i))
        plan = list(sharding.deal(sorted(sizes, reverse=True), 5))
        assert [sum(s * taken[i] for s, taken in plan) for i in range(5)] == load


def test_sharding_odd(spark, odd):
    frame, rows = odd
    out = sharding.shard(spark, frame, 4).collect()
    assert len(out) == len(rows)
    for s in range(4):
        assert sorted(r.slot for r in out if r.shard == s) == list(range(sum(r.shard == s for r in out)))
    where = collections.defaultdict(set)
    for r in out:
        where[r.text_crc32, r["size"]].add(r.shard)
    assert all(len(x) == 1 for x in where.values())
    assert sharding.shard(spark, empty(spark)).count() == 0


def test_suffixes_odd(spark, odd):
    frame, rows = odd
    for hot in (suffix_dedup.HOT, 1):
        with Scope(spark, "test") as scope:
            out = suffix_dedup.digest(frame, suffix_dedup.repeated(frame, scope, hot)).collect()
            assert suffix_dedup.digest(empty(spark), suffix_dedup.repeated(empty(spark), scope)).count() == 0
        assert len(out) == len(rows)
        first = {r.doc_id: r for r in out if r.doc_id not in (10, 11)}
        assert first[1].n_removed == 0 and first[2].n_removed == first[2].n_bytes and first[2].n_spans == 1
        assert first[4].n_bytes == 0 and first[4].kept_sha256 == hashlib.sha256(b"").hexdigest()
        assert first[9].n_removed > 0 and all(r.n_removed == 0 for r in out if r.doc_id == 10)


@given
def test_suffixes_brute(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    seen, want = set(), {}
    for d in sorted(docs.collect(), key=lambda r: r.doc_id):
        data = (d.text or "").encode()
        mask = np.zeros(len(data), bool)
        for i in range(len(data) - 99):
            if data[i:i + 100] in seen:
                mask[i:i + 100] = True
            seen.add(data[i:i + 100])
        want[d.doc_id] = int(mask.sum()), hashlib.sha256(np.frombuffer(data, np.uint8)[~mask].tobytes()).hexdigest()
    got = suffix_dedup.op3_suffix_array_dedup(spark, SF).collect()
    assert {r.doc_id: (r.n_removed, r.kept_sha256) for r in got} == want


def test_merge_equals_sort():
    r = random.Random(1)
    for _ in range(100):
        runs = [sorted({bytes(r.choices(b"ab", k=r.randint(1, 30))) for _ in range(r.randint(0, 12))}) for _ in range(r.randint(1, 7))]

        def shared(x, y):
            return len(os.path.commonprefix([x, y]))
        coded = [(x, [0] + [shared(a, b) for a, b in zip(x, x[1:])]) for x in runs]
        run, at, prefix = suffix_dedup.merge(coded)
        merged = [runs[i][k] for i, k in zip(run, at)]
        assert merged == sorted(x for y in runs for x in y)
        assert prefix[1:] == [shared(a, b) for a, b in zip(merged, merged[1:])]


def test_warc_with_magic_in_payloads(spark, tmp_path):
    fake = warc.record(99, "http://x", b"inner", warc.digest_of(b"inner"), None, False).decode()
    rows = [(1, "http://a", "x" + fake * 3), (2, None, None), (3, "http://b", ""), (4, "u", "x" + fake * 3), (4, "u", "x" + fake * 3),
            (5, "big", fake + "y" * 3000 + fake), (6, "é", "é中")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("size", F.lit(1))
    for block in (700, 1 << 20):
        with Scope(spark, "test") as scope:
            folder = scope.path("warc")
            warc.write(scope, pages, folder).collect()
            out = warc.read(scope, folder, block).collect()
        assert sorted(r.page_id for r in out) == [1, 2, 3, 4, 4, 5, 6]
        by = {r.page_id: r for r in out}
        text = ("x" + fake * 3).encode()
        digest = base64.b32encode(hashlib.sha1(text).digest()).decode()
        assert by[4].record_type == "revisit" and by[4].refers_to == 1 and by[4].payload_digest == digest and by[4].payload_bytes == len(text)
        assert by[3].refers_to == 2 and by[1].payload == text and by[6].payload.decode() == "é中"
    with Scope(spark, "test") as scope:
        assert warc.write(scope, pages.limit(0), scope.path("none")).count() == 0


def test_warc_long_headers(spark):
    """Urls longer than a read or a block, with line ends and magic in payloads."""
    fake = warc.record(99, "v" * 150_000, b"inner", warc.digest_of(b"inner"), None, False).decode()
    rows = [(1, "http://a", "x"), (2, "data:" + "u" * 200_000, "long"), (3, "http://b/WARC/1.1", "y" * 900),
            (4, "w" * 70_000, fake + "WARC/1.1\r\na:" * 300), (5, "http://c", "x"), (6, "z" * 200_000, "end")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(1)
    for block in (700, 1 << 16, 1 << 20):
        with Scope(spark, "test") as scope:
            folder = scope.path("warc")
            written = scope.table(warc.write(scope, pages, folder), "written")
            records = scope.table(warc.read(scope, folder, block), "records")
            warc.check_counts(written, records)
            assert {r.page_id: r.url for r in records.collect()} == {r[0]: r[1] for r in rows}
            with pytest.raises(ValueError, match="differ"):
                warc.check_counts(written, records.where("page_id <> 6"))
            with pytest.raises(ValueError, match="differ"):
                warc.check_counts(written, records.limit(0))


def test_dropout_round_trip(spark, odd):
    frame, rows = odd
    plain = sentencepiece_dropout.encode(frame, dropout=0.0).collect()
    import sentencepiece
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    for r in plain:
        if "▁" not in (r.text or ""):
            assert r.ids == library.encode(r.text or "")
    for r in sentencepiece_dropout.decode(sentencepiece_dropout.encode(frame, dropout=0.4)).collect():
        assert r.decoded == (r.text or "")
    one, two = (sentencepiece_dropout.encode(frame, dropout=0.4, seed=s).where("doc_id = 8").first().ids for s in (1, 2))
    assert one != two
    assert sentencepiece_dropout.encode(empty(spark)).count() == 0


def test_dropout_agenda_brute():
    v = sentencepiece_dropout.Vocabulary.load(public_tokenizers.path("piece_bpe_32k.model"))
    r, limit = random.Random(2), sentencepiece_dropout._limit(0.3)
    for _ in range(150):
        symbols = v.symbols(np.array([ord(c) for c in " " + prose(r.randint(0, 999), 2)], np.uint32)).tolist()
        key = r.getrandbits(63)
        parts = [(s, i, i + 1) for i, s in enumerate(symbols)]
        while True:
            best = None
            for k in range(len(parts) - 1):
                made = int(v.join(np.array([parts[k][0]]), np.array([parts[k + 1][0]]))[0])
                place = parts[k][1], parts[k + 1][1], parts[k + 1][2]
                if made >= 0 and not sentencepiece_dropout.skipped(np.array([key], np.uint64), *([x] for x in place), limit)[0]:
                    best = min(best or (1 << 60,), (int(v.rank[made]), k, made))
            if best is None:
                break
            _, k, made = best
            parts[k:k + 2] = [(made, parts[k][1], parts[k + 1][2])]
        assert sentencepiece_dropout._one(v, symbols, key, limit) == parts


def test_dropout_draws_for_each_occurrence(monkeypatch):
    """Every occurrence has the pieces of an agenda of its own key, and frequent words keep the rate."""
    path = public_tokenizers.path("piece_bpe_32k.model")
    v = sentencepiece_dropout.Vocabulary.load(path)
    monkeypatch.setattr(sentencepiece_dropout, "COINS", 500)
    text = " ".join(["of the information"] * 1500 + ["x" * 90, "日本語" * 30, prose(1, 200)] * 3)
    buf, offsets = np.frombuffer(text.encode(), np.uint8), np.array([0, len(text.encode())])
    for dropout in (0.1, 0.5):
        e = sentencepiece_dropout.Encoder(path, dropout)
        tokens, counts = e.encode(buf, offsets, np.array([3]))
        starts, ends, rows, opens = e.units(buf, offsets)
        unit = common.range_hash(common.prefix_hash(buf), starts, ends) + opens.astype(np.uint64)
        chosen = common.mix(common.mix(np.array([3], np.uint64) ^ np.uint64(7))[rows] + np.arange(len(rows), dtype=np.uint64))
        keys = common.mix(unit ^ common.mix(chosen * np.uint64(0x9E3779B97F4A7C15) + np.uint64(7)))
        alone, found = [], collections.defaultdict(list)
        for i, j, first, key in zip(starts, ends, opens, keys):
            word = (" " if first else "") + buf[i:j].tobytes().decode()
            parts = sentencepiece_dropout._one(v, v.symbols(np.array([ord(c) for c in word], np.uint32)).tolist(), int(key), e.limit)
            ids = [t for s, a, b in parts for t in ([s] if s >= 0 else [int(v.byte_ids[x]) for x in word[a:b].encode()])]
            found[word].append(tuple(ids))
            alone += ids
        assert tokens.tolist() == alone and counts.tolist() == [len(alone)]
        if dropout == 0.1:
            assert len(set(found[" information"])) > 8
            for word in (" of", " the", " information"):
                symbols, r = v.symbols(np.array([ord(c) for c in word], np.uint32)).tolist(), random.Random(5)
                drawn = [len(sentencepiece_dropout._one(v, symbols, r.getrandbits(63), e.limit)) == 1 for _ in range(1500)]
                whole = [len(x) == 1 for x in found[word]]
                assert 0 < sum(whole) < len(whole) and abs(sum(whole) / len(whole) - sum(drawn) / 1500) < 0.05


def test_licenses():
    index = licenses.Index()
    cases = {"This work is licensed under the GNU General Public License, version 3.": ("gpl", "gpl,gpl-line", 1, 6),
             "a b Released under the MIT License. MIT  license": ("mit", "mit,mit-line", 2, 5),
             "Licensed under CC BY-NC 4.0.": ("cc-by", "cc-by,cc-by-nc-4.0", 1, 2), "permission software license": ("", "", 0, None)}
    for text, (base, labels, n, first) in cases.items():
        out = licenses.scan_text(text.encode(), index)
        assert (out[4], out[5], out[1], out[2]) == (base, labels, n, first) and 0 <= out[6] <= 1


def test_licenses_after_all_others():
    """Each notice is found at the end of a long text that holds all other notices."""
    index = licenses.Index()
    vocabulary = sorted({w.decode() for _, _, words in index.templates for w in words})
    random.Random(9).shuffle(vocabulary)
    for label, _, text in licenses.TEMPLATES:
        others = " ".join(t for name, _, t in licenses.TEMPLATES if text.rstrip(".") not in t)
        long = " ".join([others, prose(11, 3000), *vocabulary, prose(12, 3000)])
        assert label not in licenses.scan_text(long.encode(), index)[5].split(",")
        assert label in licenses.scan_text(f"{long} {text}".encode(), index)[5].split(",")
        assert licenses.scan_text(" ".join(t for _, _, t in licenses.TEMPLATES).encode(), index)[5].count(",") >= len(licenses.TEMPLATES) - 1


def test_licenses_odd(spark, odd):
    frame, rows = odd
    out = {r.doc_id: r for r in licenses.scan(frame).collect()}
    assert out[4].n_words == 0 and out[4].labels == "" and out[4].score == 0.0 and out[6].n_words == 2
    assert licenses.scan(empty(spark)).count() == 0


def test_decontamination(spark, odd):
    frame, rows = odd
    items = spark.createDataFrame([(1, prose(1, 30)), (2, prose(77, 30)), (3, "one two"), (4, None), (1, prose(1, 30))], "item_id long, text string")
    edited = list(prose(77, 30))
    for k in range(5, len(edited), 25):
        edited[k] = "Z"
    extra = spark.createDataFrame([(20, "head. " + "".join(edited).upper() + " tail", "en", None, None, "c", 0.1)], frame.schema)
    out = decontaminate.find(frame.unionByName(extra), items).collect()
    assert {(r.doc_id, r.item_id) for r in out} == {(1, 1), (2, 1), (3, 1), (11, 1), (20, 2), (6, 3)}
    place = next(r for r in out if r.doc_id == 20)
    assert place.start == 6 and place.edits == len(range(5, len(edited), 25))
    assert {r.doc_id for r in decontaminate.clean(frame, items).collect()} == {4, 5, 7, 8, 9, None, 10, 11, 12}
    assert decontaminate.find(empty(spark), items).count() == 0 and decontaminate.find(frame, items.limit(0)).count() == 0


def test_alignment_brute():
    r = random.Random(4)
    for _ in range(60):
        item = np.array([r.choice([1, 2, 3]) for _ in range(30)], np.uint32)
        text = np.array([r.choice([1, 2, 3]) for _ in range(r.randint(20, 60))], np.uint32)
        cost = np.zeros((31, len(text) + 1), int)
        cost[:, 0] = np.arange(31)
        for i in range(1, 31):
            for j in range(1, len(text) + 1):
                cost[i, j] = min(cost[i - 1, j - 1] + (item[i - 1] != text[j - 1]), cost[i - 1, j] + 1, cost[i, j - 1] + 1)
        found = decontaminate.align(item, [text], [-40], 120)[0]
        assert found[0] == cost[30].min()


@given
def test_links_brute(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    sets = {}
    for d in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", d.text or "")
        sets[d.doc_id] = {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    for r in near_duplicates.op8_ngram_jaccard_join(spark, SF).collect():
        a = sets[r.doc_id]
        assert r.n_links == sum(1 for k, b in sets.items() if k != r.doc_id and a and 10 * len(a & b) >= 8 * len(a | b))


def test_links_odd(spark, odd):
    frame, rows = odd
    with Scope(spark, "test") as scope:
        out = near_duplicates.classify(frame, scope).collect()
        assert near_duplicates.classify(empty(spark), scope).count() == 0
    assert len(out) == len(rows)
    assert {r.class_key for r in out if r.key in (1, 2, 3)} == {1}
    assert all(r.n_links == 0 for r in out if r.key in (4, 5, 6))
    kept = near_duplicates.keep_one(frame)
    assert kept.columns == frame.columns
    ids = [r.doc_id for r in kept.collect()]
    assert 1 in ids and 2 not in ids and ids.count(10) == 1 and ids.count(11) == 2


def test_blocks_meet(spark, monkeypatch):
    """Clusters of many blocks give the links that one block gives."""
    base = prose(9, 100).split()
    rows = []
    for k in range(40):
        words = list(base)
        words[k * 2] = f"w{k}"
        rows.append((k, " ".join(words), None, None, None))
    frame = spark.createDataFrame(rows, SCHEMA)
    results = []
    for block in (1024, 7):
        monkeypatch.setattr(near_duplicates, "BLOCK", block)
        with Scope(spark, "test") as scope:
            results.append(sorted(tuple(r) for r in near_duplicates.classify(frame, scope).select("key", "class_key", "n_links").collect()))
    assert results[0] == results[1] and {r[1] for r in results[0]} == {0}


@given
def test_token_store(spark):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got, at = {r.doc_id: r for r in token_store.op9_token_store(spark, SF).collect()}, 0
    for d in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect():
        ids = [*tokenizer.encode(d.text or "", add_special_tokens=False).ids, 2]
        r = got[d.doc_id]
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)


def test_token_store_odd(spark, odd):
    frame, rows = odd
    with Scope(spark, "test") as scope:
        folder = scope.path("store")
        catalogue, buckets = token_store.write(scope, frame, folder)
        found = token_store.find(catalogue, folder)
        assert found.where("shard is null").count() == 0
        out = token_store.digest(scope, scope.table(found, "found"), folder).collect()
        unknown = spark.range(1000, 1200).select(F.col("id").alias("key"), F.lit(0).alias("repeat"), F.lit(0).alias("bucket"))
        assert token_store.find(unknown, folder).where("shard is not null").count() == 0
    assert len(out) == len(rows) and {r.n_tokens for r in out if r.doc_id in (4, 5)} == {1}


def test_token_cuts():
    encoder = token_store.Encoder(public_tokenizers.path("word_bpe_49k.json"))
    r = random.Random(5)
    letters = [*"abzABZ'.,!<>|&%09 \n\t éÉİıßñ中文́Σς👍\x00\x1c²", "<|endoftext|>", "<|ENDOFTEXT|>", "don't", "'LL"]
    for _ in range(300):
        texts = ["".join(r.choices(letters, k=r.randint(0, 25))) for _ in range(3)]
        ids, _ = encoder.encode(*common.text_buffer(pa.array(texts)))
        assert ids.tolist() == [i for t in texts for i in encoder.tokenizer.encode(t, add_special_tokens=False).ids]


def test_toxicity_learns_and_holds_out(spark):
    r, texts, labels = random.Random(8), [], []
    for k in range(240):
        words = prose(1000 + k, r.randint(20, 150)).split()
        if k % 4 == 0:
            for _ in range(6):
                words.insert(r.randrange(len(words)), r.choice(["vilewort", "foulwort", "basewort"]))
        texts.append(" ".join(words))
        labels.append(int(k % 4 == 0))
    network, stats = toxicity.fit(texts[:200], np.array(labels[:200]))
    buf, offsets = common.text_buffer(pa.array([*texts[200:], "", None]))
    p = network.probability(network.scores(toxicity.read_words(buf, offsets), stats))
    assert p[-1] == p[-2] == 0.0
    hits = (p[:40] >= 0.3) == (np.array(labels[200:]) == 1)
    assert hits.mean() >= 0.9
    frame = spark.createDataFrame([(k, None if k == 1 else texts[k], None, None, None) for k in range(8)] + [(None, "a b", None, None, None)], SCHEMA)
    out = toxicity.score(frame, network, stats).collect()
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in out)
    assert toxicity.score(empty(spark), network, stats).count() == 0


def test_network_gradient():
    network, r = toxicity.Network(), np.random.default_rng(1)
    x, index = r.standard_normal((9, toxicity.INPUT)).astype(np.float32), r.integers(0, 9, (5, toxicity.WINDOW))
    length, target = np.array([24, 3, 1, 24, 10]), np.array([1, 0, 1, 0, 1], np.float32)

    def loss():
        z = network.forward(x, index, length).astype(float)
        return float(np.mean(np.log1p(np.exp(z)) - target * z))
    g, _ = network.gradients(x, index, length, target)
    for name, at in (("u", 3), ("v", 2), ("Uf", (1, 4)), ("Rb", (2, 3)), ("Wf", (0, 20)), ("A", (4, 1))):
        keep, step = network.p[name][at], 2e-3
        network.p[name][at] = keep + step
        up = loss()
        network.p[name][at] = keep - step
        down = loss()
        network.p[name][at] = keep
        assert abs((up - down) / (2 * step) - g[name][at]) < 5e-3


@given
def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bench = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "ids", "n_tokens"]
    kept = {r.doc_id: r.ids for r in out.collect()}
    leaked = {d.doc_id for d in docs.collect() if any(b in d.text for b in bench)}
    links = {r.doc_id: r.class_id for r in near_duplicates.op8_ngram_jaccard_join(spark, SF).collect()}
    good = {r.doc_id for r in quality.op1_quality_rules(spark, SF).where("kept").collect()}
    assert not leaked & set(kept) and set(kept) <= good
    assert all(links[k] == k or links[k] not in kept for k in kept)
    assert [len(corpus_pipeline.STAGES), corpus_pipeline.ORACLE_SQL] == [5, None]
