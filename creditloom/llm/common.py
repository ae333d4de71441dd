"""Shared helpers: reading columns as Arrow, files in the shared folder, word hashing in numpy."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

SLICE_BYTES = 2 << 20  # text handled by one round of numpy calls; a longer text is its own slice


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Hand rows to Python in batches of `rows` or 32 MB: texts are long, and a batch is held at once."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(32 << 20))


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """The wanted column names, each followed by as many underscores as it takes to be new in `df`."""
    taken, free = {c.lower() for c in df.columns}, []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        free.append(name)
    return free


def input_bytes(df: DataFrame, column: str = "text") -> int:
    """UTF-8 bytes of a column, from one pass of sums."""
    return int(df.agg(F.sum(F.octet_length(column).cast("long"))).first()[0] or 0)


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string or binary column and the offset of each row; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        empty = "" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b""
        column = column.fill_null(empty)
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    kind = np.int64 if wide else np.int32
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, kind)[column.offset: column.offset + len(column) + 1].astype(np.int64)
    if data is None or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), offsets - offsets[0]
    return np.frombuffer(data, np.uint8)[offsets[0]: offsets[-1]], offsets - offsets[0]


def row_slices(offsets: np.ndarray, limit: int = SLICE_BYTES):
    """(first row, end row) of consecutive slices of about `limit` bytes; every row is in one."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_POWERS: dict[str, np.ndarray] = {}


def byte_values() -> np.ndarray:
    """A fixed random 64-bit value per byte."""
    return np.random.default_rng(20240501).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """B^i and B^-i modulo 2^64 for i < n."""
    if len(_POWERS.get("up", ())) < n:
        size = max(n, SLICE_BYTES + 1024)
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        for key, base in (("up", _BASE), ("down", inverse)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[key] = np.cumprod(steps, dtype=np.uint64)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def prefix_hash(buf: np.ndarray) -> np.ndarray:
    """S with S[j] - S[i] = the hash sum of bytes i..j-1, to be multiplied by B^-i."""
    up, _ = powers(len(buf) + 1)
    sums = np.zeros(len(buf) + 1, np.uint64)
    if "values" not in _POWERS:
        _POWERS["values"] = byte_values()
    np.cumsum(_POWERS["values"][buf] * up[:-1], out=sums[1:])
    return sums


def range_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes of each range; equal bytes have equal hashes."""
    _, down = powers(len(sums))
    lengths = (ends - starts).astype(np.uint64)
    return mix((sums[ends] - sums[starts]) * down[starts] + lengths)


def word_spans(buf: np.ndarray, offsets: np.ndarray, space: np.ndarray = _SPACE, cuts: np.ndarray | None = None):
    """Starts, ends and rows of the words: maximal runs without `space` bytes inside one row.

    `cuts` marks bytes at which a new word starts even inside a run.
    """
    n = len(buf)
    if not n:
        none = np.zeros(0, np.int64)
        return none, none, none
    inside = ~space[buf]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    if cuts is not None:
        edge[:n] |= cuts
    first = inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:n]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | edge[1:n]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    rows = np.searchsorted(offsets, starts, side="right") - 1
    return starts, ends, rows


def strings(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[bytes]:
    """The bytes of each range."""
    data = buf.tobytes()
    return [data[i:j] for i, j in zip(starts.tolist(), ends.tolist())]


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of each window of `size` consecutive word hashes, len(words) - size + 1 of them."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    odd = np.random.default_rng(77).integers(1, 1 << 62, size, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    total = np.zeros(n, np.uint64)
    for j in range(size):
        total += words[j: j + n] * odd[j]
    return mix(total)


# Files in the shared folder, from tasks and from the driver.

def open_fs(uri: str):
    """(file system, path) of a folder named by a URI or by a plain path."""
    from pyarrow import fs
    if "://" in uri or uri.startswith("file:"):
        return fs.FileSystem.from_uri(uri if "://" in uri else "file://" + uri[5:])
    return fs.LocalFileSystem(), uri


class Output:
    """A file written piece by piece and named at the end: a task that is repeated replaces the file
    by the same bytes in one rename, one that dies leaves only an unnamed part. Without any piece no
    file is made."""

    def __init__(self, uri: str):
        self.filesystem, self.path = open_fs(uri)
        self.part, self.out = f"{self.path}.{uuid.uuid4().hex}.part", None

    def write(self, data: bytes) -> None:
        if self.out is None:
            self.filesystem.create_dir(self.path.rpartition("/")[0], recursive=True)
            self.out = self.filesystem.open_output_stream(self.part)
        self.out.write(data)

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            try:
                self.filesystem.move(self.part, self.path)
            except OSError:  # some file systems do not rename onto the file an earlier attempt left
                self.filesystem.delete_file(self.path)
                self.filesystem.move(self.part, self.path)


def write_file(uri: str, data: bytes) -> None:
    out = Output(uri)
    out.write(data)
    out.close()


def read_range(uri: str, start: int, length: int) -> bytes:
    filesystem, path = open_fs(uri)
    with filesystem.open_input_file(path) as f:
        return f.read_at(length, start)


def read_file(uri: str) -> bytes:
    filesystem, path = open_fs(uri)
    with filesystem.open_input_file(path) as f:
        return f.read()


def connected_components(scope, edges: DataFrame) -> DataFrame:
    """Smallest node of each node's component, from edges (a, b); nodes are any orderable type.

    Alternates large-star and small-star steps until the edges no longer change. Each step groups
    by one end and joins the minimum back, so no node's neighbours are held anywhere; the first has a
    map-side minimum, as one end can be a hub of all. Each round is a written table, so lineage stays short.
    """
    def written(edges):
        """A table of the edges with their number and hash sum, counted while they are written."""
        seen = Observation()
        table = scope.table(edges.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(
            F.xxhash64("a", "b").cast("decimal(38,0)")).alias("hashes")), "edges")
        return table, (seen.get["n"], seen.get["hashes"])

    # From the larger to the smaller node, as a round leaves them: edges that are stars take one round.
    current, before = written(edges.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while before[0]:
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(
            F.col("a").alias("u"), F.least("a", "m").alias("m"))
        # large-star: every edge now points from the larger to the smaller node. Dealt once by the larger
        # one, for the minimum and the join alike; an edge gives one row, so repeats can stay until the end.
        large = both.join(least, both.a == least.u).where("b > a").select(
            F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").repartition("a")
        least = large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "u")
        small = large.join(least, large.a == least.u).select(
            F.explode(F.array(F.struct(F.col("a"), F.col("m").alias("b")),
                              F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")
        ).select("e.*").where("a <> b").distinct()
        following, state = written(small)  # a round is one job
        scope.drop(current)
        current = following
        if state == before:
            break
        before = state
    return current.groupBy("a").agg(F.min("b").alias("component")).withColumnRenamed("a", "node")
