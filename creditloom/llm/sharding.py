"""Longest-processing-time sharding (law `bytes`).

Documents of equal text form a group that stays together. Groups, largest first, go to the least
loaded shard through a heap. Loads depend only on how many groups there are of each size, so the
heap runs over the histogram of sizes: a run of equal groups is dealt in one step. One task streams
through the histogram from the largest size down and holds nothing but the loads; neither it nor the
driver holds the plan. The histogram is provably small: k distinct sizes need at least k^2 / 2 bytes of
input, so 100 TB has at most 14 million of them and 1 GB 45 thousand.

Defined results: a null text counts as empty; empty texts are one group of size 8 a row; equal loads
go to the lower shard, groups of one size to shards in the order of their text digest; repeated rows
are separate members of their group with slots of their own; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import Scope
from . import common
from .registry import query

SHARDS = 24
ROWS_A_BUCKET = 50_000


def deal_one(load: list[int], size: int, n: int) -> list[int]:
    """How many of n equal groups each shard gets at these loads: exactly the heap's choices.

    Dealing n equal groups takes the n smallest of all load + k * size; all but the last few follow
    from the level they stay below, the rest are popped one by one.
    """
    low, high = min(load), max(load) + size * (n // len(load) + 1)
    while low < high:  # the largest level with at most n places below it
        level = (low + high + 1) // 2
        if sum(max(0, -(-(level - x) // size)) for x in load) <= n:
            low = level
        else:
            high = level - 1
    taken = [max(0, -(-(low - x) // size)) for x in load]
    heap = [(x + taken[i] * size, i) for i, x in enumerate(load)]
    heapq.heapify(heap)
    for _ in range(n - sum(taken)):
        x, i = heap[0]
        heapq.heapreplace(heap, (x + size, i))
        taken[i] += 1
    return taken


def deal(sizes: Iterable[tuple[int, int]], shards: int) -> Iterator[tuple[int, list[int]]]:
    """(size, groups each shard gets) for (size, groups) that come with falling size."""
    load = [0] * shards
    for size, n in sizes:
        taken = deal_one(load, size, n)
        load = [x + k * size for x, k in zip(load, taken)]
        yield size, taken


def plan(histogram: DataFrame, shards: int) -> DataFrame:
    """size_, shard, low, high: which ranks among the groups of a size go to which shard."""
    names = ["size_", "shard", "low", "high"]

    def run(batches):
        sizes = (row for batch in batches for row in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
        out = []
        for size, taken in deal(sizes, shards):
            ends = list(accumulate(taken))
            out += [(size, i, end - k, end) for i, (k, end) in enumerate(zip(taken, ends)) if k]
            if len(out) >= 1 << 14:
                yield batch_of(out)
                out = []
        if out:
            yield batch_of(out)

    def batch_of(rows):
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*rows), (pa.int64(), pa.int32(), pa.int64(), pa.int64()))], names=names)

    return histogram.select("group_size", "n").repartition(1).sortWithinPartitions(F.desc("group_size")).mapInArrow(
        run, "size_ long, shard int, low long, high long")


def gapless(df: DataFrame, by: str, order: list[str], name: str, rows: int) -> DataFrame:
    """`df` with a number from 0 without gaps in each `by`: buckets are counted, then numbered.

    Buckets are hashes of the order columns, so a hot `by` value is spread over many tasks.
    """
    buckets = max(1, rows // ROWS_A_BUCKET + 1) * 16
    df = df.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    counts = df.groupBy(by, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    inside = Window.partitionBy(by, "_bucket").orderBy(*order)
    before = Window.partitionBy(by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.withColumn("_first", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    numbered = df.withColumn("_k", F.row_number().over(inside) - 1)
    return numbered.join(first.withColumnRenamed(by, "_by"), [
        F.col(by) == F.col("_by"), numbered._bucket == first._bucket]).select(
        *[c for c in df.columns if c != "_bucket"], (F.col("_first") + F.col("_k")).cast("long").alias(name))


def shard(spark: SparkSession, docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for each row of `docs`."""
    text = F.coalesce("text", F.lit(""))
    with Scope(spark, "shard") as scope:
        rows = scope.table(docs.select(
            "doc_id", (F.octet_length(text) + 8).cast("long").alias("size"),
            F.crc32(text.cast("binary")).cast("long").alias("text_crc32"),
            F.unhex(F.sha2(text, 256)).alias("digest")), "rows")
        n = rows.count()
        groups = rows.groupBy("digest").agg(F.sum("size").alias("group_size"))
        groups = scope.table(groups, "groups")
        sizes = scope.table(groups.groupBy("group_size").agg(F.count(F.lit(1)).alias("n")), "sizes")
        steps = scope.table(plan(sizes, shards), "plan")
        ranked = gapless(groups, "group_size", ["digest"], "rank", n)
        placed = ranked.join(steps, [
            ranked.group_size == steps.size_, ranked["rank"] >= steps.low, ranked["rank"] < steps.high]).select(
            F.col("digest").alias("digest_"), "shard")
        members = scope.table(rows.join(placed, rows.digest == placed.digest_).select(
            "doc_id", "size", "text_crc32", "shard"), "members")
        slots = gapless(members.withColumn("id_", F.coalesce("doc_id", F.lit(-1 << 63))),
                        "shard", ["id_", "text_crc32"], "slot", n)
        return scope.keep(slots.select(
            "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
            F.lit(None).cast("int").alias("grown_shard")))


@query("op2_lpt_sharding")
def op2_lpt_sharding(spark, sf_dir):
    return shard(spark, common.table(spark, sf_dir, "documents"))
