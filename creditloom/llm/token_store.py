"""Token-id output with a minimal perfect hash index.

Layout of a store:

* `format.json`: the width of an id, 2 bytes where the vocabulary allows it and else 4;
* `ids/part-NNNNN.bin`: the ids of the documents of one doc_id range, little-endian unsigned integers,
  nothing between documents;
* `index/part-NNNNN.mph`: one index part per key bucket (keys go to buckets by hash). A part holds a
  minimal perfect hash of its keys in levels: a key's place is the first level whose bit at
  hash(level, key) is set, its slot the number of set bits before that. Per slot follow fingerprint,
  shard, offset in the shard and length. A lookup costs a few bit tests and one read of width * length
  bytes, whatever the size of the store; the fingerprint turns keys that are not in the store away.

Rows that repeat a doc_id are stored each, in ascending order of text digest; the key is (doc_id, how
many rows of that doc_id came before). A null doc_id counts as the smallest id and is stored under
null. Null and empty texts have the end id only. An empty table gives a store without files.
"""

from __future__ import annotations

import json
import os
import struct
import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import Scope
from . import common
from .registry import query

MODEL = "word_bpe_49k.json"
END_ID = 2
SHARD_BYTES = 96 << 20  # text per shard of ids
BUCKET_KEYS = 1 << 16
CACHE_WORDS = 1_000_000
GAMMA = 2.0
NULL_ID = -1 << 63


_KIND = np.zeros(256, np.uint8)  # 1 letter, 2 digit, 3 mark, 4 apostrophe; 0 anything else
_KIND[list(b"abcdefghijklmnopqrstuvwxyz")] = 1
_KIND[list(b"0123456789")] = 2
_KIND[list(b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~")] = 3
_KIND[ord("'")] = 4
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def _cuts(buf: np.ndarray) -> np.ndarray:
    """Bytes at which a pre-token must start: between ASCII letters and marks, around digits, at an
    apostrophe behind a letter. (What follows an apostrophe depends on it and is not cut.)"""
    kind = _KIND[buf]
    before, here = kind[:-1], kind[1:]
    cuts = np.zeros(len(buf), bool)
    cuts[1:] = ((before == 1) & (here >= 3)) | ((before == 3) & (here == 1)) | (here == 2) | (before == 2)
    return cuts


class Encoder:
    """Ids of whole texts. Tokens never span blanks or line breaks, so each distinct piece between
    them is encoded by the library once per task (and again after the cache was emptied)."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.ends = np.zeros(size, bool)
        for token, i in self.tokenizer.get_vocab().items():
            self.ends[i] = token.endswith("</w>")
        self.special = [t.encode() for t in (x.content for x in self.tokenizer.get_added_tokens_decoder().values())]
        self.split = np.zeros(256, bool)
        self.split[[10, 32]] = True
        self.reset()

    def reset(self) -> None:
        self.place: dict[int, int] = {}
        self.counts: list[np.ndarray] = [np.zeros(0, np.int64)]
        self.ids: list[np.ndarray] = [np.zeros(0, np.uint32)]
        self.rows, self.starts, self.flat = 0, np.zeros(1, np.int64), np.zeros(0, np.uint32)

    def _add(self, hashes: list[int], words: list[bytes]) -> None:
        # Words of letters only are one pre-token each: encode them as one text and cut behind the
        # tokens that end a word. All others are encoded one by one, and so are all words if the
        # number of cuts is not that of the words (a letter may become letter and mark in lower case).
        texts = [w.decode("utf-8", "replace") for w in words]
        plain = [i for i, w in enumerate(texts) if w.isalpha()]
        other = [i for i, w in enumerate(texts) if not w.isalpha()]
        if plain:
            letters = [texts[i] for i in plain]
            runs = self.tokenizer.encode_batch_fast(
                [" ".join(letters[k: k + 200]) for k in range(0, len(letters), 200)], add_special_tokens=False)
            ids = np.fromiter(chain.from_iterable(e.ids for e in runs), np.uint32)
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) != len(plain):
                other = list(range(len(words)))
            else:
                self._store([hashes[i] for i in plain], np.diff(np.concatenate([[0], cuts])), ids)
        if other:
            lists = [e.ids for e in self.tokenizer.encode_batch_fast(
                [texts[i] for i in other], add_special_tokens=False)]
            self._store([hashes[i] for i in other], np.fromiter(map(len, lists), np.int64, len(lists)),
                        np.concatenate([np.asarray(x, np.uint32) for x in lists]))
        counts = np.concatenate(self.counts)
        self.counts, self.ids = [counts], [np.concatenate(self.ids)]
        self.flat = self.ids[0]
        self.starts = np.concatenate([[0], np.cumsum(counts)])

    def _store(self, hashes, counts, ids) -> None:
        self.place.update(zip(hashes, range(self.rows, self.rows + len(hashes))))
        self.rows += len(hashes)
        self.counts.append(np.asarray(counts, np.int64))
        self.ids.append(ids)

    def encode(self, buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts of a slice, and how many each text has; no end ids."""
        n = len(offsets) - 1
        # The vocabulary has lower case only. Where a special token's text occurs, nothing is
        # changed or cut, because the library looks for it first.
        lower = _LOWER[buf]
        data, cuts = lower.tobytes(), None
        if not any(t in data for t in self.special):
            buf, cuts = lower, _cuts(lower) if len(buf) else None
        starts, ends, rows = common.word_spans(buf, offsets, self.split, cuts)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(n, np.int64)
        hashes = common.range_hash(common.prefix_hash(buf), starts, ends)
        distinct, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.place) > CACHE_WORDS:
            self.reset()
        keys = distinct.tolist()
        new = [i for i, h in enumerate(keys) if h not in self.place]
        if new:
            self._add([keys[i] for i in new], common.strings(buf, starts[first[new]], ends[first[new]]))
        place = np.fromiter(map(self.place.__getitem__, keys), np.int64, len(keys))[inverse]
        counts = self.starts[place + 1] - self.starts[place]
        shift = np.repeat(self.starts[place] - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts)
        ids = self.flat[np.arange(int(counts.sum())) + shift]
        return ids, np.bincount(rows, counts, n).astype(np.int64)


# The minimal perfect hash.

def _level_hash(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    return (common.mix(keys ^ np.uint64((level + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) % np.uint64(size)).astype(np.int64)


def key_hash(ids: np.ndarray, repeats: np.ndarray) -> np.ndarray:
    """64-bit hash of a (doc_id, repeat) key; distinct for distinct doc_ids without repeats."""
    return common.mix(common.mix(ids.astype(np.int64).view(np.uint64)) + repeats.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def build_part(hashes: np.ndarray, shard: np.ndarray, offset: np.ndarray, length: np.ndarray) -> bytes:
    """An index part. Every level keeps the keys that are alone at their bit; the rest goes on."""
    levels, left = [], np.arange(len(hashes))
    while len(left):
        size = max(64, int(GAMMA * len(left) + 63) // 64 * 64)
        at = _level_hash(hashes[left], len(levels), size)
        alone = np.bincount(at, minlength=size) == 1
        levels.append(alone)
        left = left[~alone[at]]
        if len(levels) > 200:
            raise ValueError("two keys of a bucket have one hash")
    bits = np.concatenate(levels) if levels else np.zeros(0, bool)
    slots = _slots(hashes, [len(x) for x in levels], bits, np.concatenate([[0], np.cumsum(bits)]))
    order = np.empty(len(hashes), np.int64)
    order[slots] = np.arange(len(hashes))
    head = struct.pack("<4sII", b"MPH1", len(hashes), len(levels)) + np.array([len(x) for x in levels], "<u4").tobytes()
    return b"".join([
        head, np.packbits(bits, bitorder="little").tobytes(), (hashes[order] >> np.uint64(32)).astype("<u4").tobytes(),
        shard[order].astype("<u4").tobytes(), offset[order].astype("<u8").tobytes(), length[order].astype("<u4").tobytes()])


def _slots(hashes, sizes, bits, ranks) -> np.ndarray:
    slots, left, base = np.full(len(hashes), -1, np.int64), np.arange(len(hashes)), 0
    for level, size in enumerate(sizes):
        at = base + _level_hash(hashes[left], level, size)
        hit = bits[at]
        slots[left[hit]] = ranks[at[hit]]
        left, base = left[~hit], base + size
    return slots


class Part:
    """A loaded index part."""

    def __init__(self, data: bytes):
        magic, self.n, levels = struct.unpack_from("<4sII", data)
        if magic != b"MPH1":
            raise ValueError("not an index part")
        self.sizes = np.frombuffer(data, "<u4", levels, 12).tolist()
        at, total = 12 + 4 * levels, sum(self.sizes)
        self.bits = np.unpackbits(np.frombuffer(data, np.uint8, total // 8, at), bitorder="little").astype(bool)
        self.ranks = np.concatenate([[0], np.cumsum(self.bits)])
        at += total // 8
        fields = []
        for kind in ("<u4", "<u4", "<u8", "<u4"):
            fields.append(np.frombuffer(data, kind, self.n, at))
            at += self.n * int(kind[2])
        self.fingerprint, self.shard, self.offset, self.length = fields

    def find(self, hashes: np.ndarray):
        """(found, shard, offset, length) per key."""
        slots = _slots(hashes, self.sizes, self.bits, self.ranks)
        safe = np.maximum(slots, 0)
        if not self.n:
            return np.zeros(len(hashes), bool), *(np.zeros(len(hashes), np.int64) for _ in range(3))
        found = (slots >= 0) & (self.fingerprint[safe] == (hashes >> np.uint64(32)).astype(np.uint32))
        return found, self.shard[safe].astype(np.int64), self.offset[safe].astype(np.int64), self.length[safe].astype(np.int64)


def shard_file(folder: str, shard: int) -> str:
    return f"{folder}/ids/part-{shard:05d}.bin"


def index_file(folder: str, bucket: int) -> str:
    return f"{folder}/index/part-{bucket:05d}.mph"


def write(scope: Scope, docs: DataFrame, folder: str, model: str | None = None) -> tuple[DataFrame, int]:
    """Write the store; returns its catalogue (doc_id, repeat, bucket) and the number of buckets."""
    import public_tokenizers
    path = model or public_tokenizers.path(MODEL)
    from tokenizers import Tokenizer
    width = 2 if Tokenizer.from_file(path).get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4
    common.write_file(f"{folder}/format.json", json.dumps({"width": width}).encode())
    shards = max(1, common.input_bytes(docs) // SHARD_BYTES + 1)

    def run(batches):
        from pyspark import TaskContext
        shard, encoder, offset = TaskContext.get().partitionId(), Encoder(path), 0
        last, repeat, out = None, 0, common.Output(shard_file(folder, shard))
        for batch in batches:
            buf, offsets = common.text_buffer(batch.column(1))
            lengths = []
            for i, j in common.row_slices(offsets):
                ids, counts = encoder.encode(buf[offsets[i]: offsets[j]], offsets[i: j + 1] - offsets[i])
                after = np.cumsum(counts)
                out.write(np.insert(ids, after, END_ID).astype(f"<u{width}").tobytes())
                lengths.append(counts + 1)
            length = np.concatenate(lengths) if lengths else np.zeros(0, np.int64)
            before = offset + np.cumsum(length) - length
            offset += int(length.sum())
            repeats = []
            for key in batch.column(0).to_pylist():
                repeat = repeat + 1 if key == last else 0
                last = key
                repeats.append(repeat)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(repeats, pa.int32()), pa.array(np.full(len(length), shard), pa.int32()),
                 pa.array(before), pa.array(length)], names=["key", "repeat", "shard", "at", "length"])
        out.close()

    key = F.coalesce("doc_id", F.lit(NULL_ID))
    # Range partitions keep all rows of an id together, so repeats are counted inside one task.
    rows = docs.select(key.alias("key"), "text").repartitionByRange(shards, "key").sortWithinPartitions(
        "key", F.sha2(F.coalesce("text", F.lit("")), 256))
    listed = scope.table(rows.mapInArrow(
        run, "key long, repeat int, shard int, at long, length long"), "listed")
    total = listed.count()
    buckets = max(1, total // BUCKET_KEYS + 1)
    keyed = listed.withColumn("bucket", F.pmod(F.xxhash64("key", "repeat"), F.lit(buckets)).cast("int"))

    def build(pdf):
        hashes = key_hash(pdf["key"].to_numpy(), pdf["repeat"].to_numpy())
        bucket = int(pdf["bucket"].iloc[0])
        common.write_file(index_file(folder, bucket), build_part(
            hashes, pdf["shard"].to_numpy(), pdf["at"].to_numpy(), pdf["length"].to_numpy()))
        return pdf.head(1)[["bucket"]].assign(keys=len(pdf))

    scope.table(keyed.groupBy("bucket").applyInPandas(build, "bucket int, keys long"), "built")
    catalogue = keyed.select("key", "repeat", "bucket")
    return catalogue, buckets


def find(keys: DataFrame, folder: str) -> DataFrame:
    """Look up keys (key, repeat, bucket): adds shard, at and length; unknown keys have nulls."""
    def run(pdf):
        try:
            part = Part(common.read_file(index_file(folder, int(pdf["bucket"].iloc[0]))))
        except FileNotFoundError:  # a bucket without keys has no part
            part = Part(build_part(*(np.zeros(0, k) for k in ("u8", "i8", "i8", "i8"))))
        found, shard, at, length = part.find(key_hash(pdf["key"].to_numpy(), pdf["repeat"].to_numpy()))
        out = pdf[["key", "repeat"]].assign(shard=shard, at=at, length=length).astype(
            {"shard": "Int64", "at": "Int64", "length": "Int64"})
        out.loc[~found, ["shard", "at", "length"]] = None
        return out

    return keys.groupBy("bucket").applyInPandas(run, "key long, repeat int, shard long, at long, length long")


def digest(scope: Scope, places: DataFrame, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 read from the id files; one task reads one shard whole."""
    width = json.loads(common.read_file(f"{folder}/format.json"))["width"]

    def run(pdf):
        shard = int(pdf["shard"].iloc[0])
        ids = np.frombuffer(common.read_file(shard_file(folder, shard)), f"<u{width}")
        crc = [zlib.crc32(ids[a: a + n].astype("<u4").tobytes()) for a, n in zip(pdf["at"], pdf["length"])]
        return pdf[["key", "shard", "at", "length"]].assign(ids_crc32=crc)

    # The files' lengths say where each shard starts; one small row per shard.
    spark = places.sparkSession
    files = spark.read.format("binaryFile").load(f"{folder}/ids").select(
        F.regexp_extract("path", r"part-(\d+)\.bin", 1).cast("long").alias("shard_"), (F.col("length") / width).cast("long").alias("ids"))
    before = Window.orderBy("shard_").rowsBetween(Window.unboundedPreceding, -1)
    bases = files.select("shard_", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("base"))
    read = places.groupBy("shard").applyInPandas(run, "key long, shard long, at long, length long, ids_crc32 long")
    return read.join(scope.table(bases, "bases"), F.col("shard") == F.col("shard_")).select(
        F.when(F.col("key") != NULL_ID, F.col("key")).alias("doc_id"), (F.col("base") + F.col("at")).alias("start"),
        F.col("length").alias("n_tokens"), "ids_crc32")


@query("op9_token_store")
def op9_token_store(spark, sf_dir):
    common.small_batches(spark)
    with Scope(spark, "tokens") as scope:
        folder = scope.path("store")
        catalogue, _ = write(scope, common.table(spark, sf_dir, "documents"), folder)
        places = scope.table(find(catalogue, folder), "places")
        return scope.keep(digest(scope, places, folder))
