"""WARC archives: writing response and revisit records, and reading them back by boundary chains.

Reading is split inside files. A task scans one block for the version line of a record and emits
every candidate with the offset where its record ends, i.e. where its successor must start. Payloads
may hold the same bytes, so candidates are only claims: from offset 0 of each file, pointer jumping
over the claims finds the records that really follow one another. A header may be of any length. Inside a block the chain of each
candidate is followed at once, so the jumping works on block entries: its rounds are the logarithm
of the blocks of a file, not of its records.

Defined results: a null payload is empty and its record has Content-Length 0; rows that repeat a
page_id are records of their own (the smallest page_id of equal payloads is the response, one row of
it, the others revisit it); a null page_id sorts first; an empty table writes no file.
"""

from __future__ import annotations

import base64
import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import Scope
from . import common
from .registry import query

BLOCK_BYTES = 8 << 20
FILE_BYTES = 64 << 20
READ_ON = 1 << 16  # read past a block for the header of its last record; doubled while the header goes on
MAGIC = b"WARC/1.1\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
STAMP = "2024-01-01T00:00:00Z"
_UNSAFE = re.compile(r"[\x00-\x20\x7f]")


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id, url, payload: bytes, digest: str, refers_to, revisit: bool) -> bytes:
    """One record. A revisit keeps the HTTP header, whose Content-Length is that of the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    lines = [f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{page_id}>",
             f"WARC-Target-URI: {_UNSAFE.sub('_', url or '')}", f"WARC-Date: {STAMP}",
             f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response"]
    if revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    lines.append(f"Content-Length: {len(block)}")
    return MAGIC + "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def write(scope: Scope, pages: DataFrame, folder: str) -> DataFrame:
    """Write all pages (page_id, url, html) as `folder`/*.warc, one file a task; returns (file, records).

    Which of equal payloads is the response is found on digests alone.
    """
    data = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    keyed = pages.select("page_id", "url", data.alias("payload"), F.sha1(data).alias("sha"))
    first = keyed.groupBy("sha").agg(
        F.min(F.struct(F.col("page_id").isNotNull().alias("known"), "page_id")).alias("f"),
        F.count(F.lit(1)).alias("copies")).where("copies > 1").select(
            F.col("sha").alias("sha_"), F.col("f.page_id").alias("refers_to"))
    # Only pages with a copy go on, without their payloads; written, so that Spark knows the size and
    # moves the payloads for the last join only where this table is too large to broadcast.
    marked = keyed.select("page_id", "sha").join(first, F.col("sha") == F.col("sha_")).groupBy(
        F.col("page_id").alias("page_"), F.col("sha_"), "refers_to").agg(F.count(F.lit(1)).alias("twins"))
    marked = scope.table(marked, "copies")
    joined = keyed.join(marked, (keyed.sha == marked.sha_) & keyed.page_id.eqNullSafe(marked.page_), "left")
    candidate = joined.withColumn("is_first", F.col("sha_").isNull() | F.col("page_id").eqNullSafe(F.col("refers_to")))
    if not marked.where("twins > 1").isEmpty():
        # Rows that repeat a page meet in one task, so exactly one of them is the response.
        files = max(1, common.input_bytes(pages, "html") // FILE_BYTES + 1)
        candidate = candidate.repartition(files, "page_id").sortWithinPartitions("page_id")

    def run(batches):
        from pyspark import TaskContext
        name = f"{folder}/part-{TaskContext.get().partitionId():06d}.warc"
        out, count, seen = common.Output(name), 0, set()
        for batch in batches:
            for page, url, payload, target, is_first, copied in zip(*(batch.column(k).to_pylist() for k in range(6))):
                digest = digest_of(payload)
                revisit = not is_first or digest in seen
                if is_first and copied:
                    seen.add(digest)
                out.write(record(page, url, payload, digest, target, revisit))
                count += 1
        out.close()
        if count:
            yield pa.RecordBatch.from_pydict({"file": [name], "records": [count]})

    return candidate.select("page_id", "url", "payload", "refers_to", "is_first", F.col("sha_").isNotNull().alias("copied")).mapInArrow(
        run, "file string, records long")


def blocks(spark: SparkSession, folder: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(file, size, start) of every block of every archive, from the files' lengths alone."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc").load(folder).select("path", "length")
    return files.select(
        F.col("path").alias("file"), F.col("length").alias("size"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("length") - 1, F.lit(0)),
                             F.lit(block_bytes).cast("long"))).alias("start")
    ).where("size > 0")


def _fields(data: bytes, start: int, end: int):
    """The header lines in data[start:end] by name, or None where one is no header line."""
    fields = {}
    for line in data[start:end].split(b"\r\n"):
        key, colon, value = line.partition(b":")
        if not colon:
            return None
        fields[key.strip().lower()] = value.strip()
    return fields


def candidates(data: bytes, start: int, block_bytes: int, size: int, more=None) -> list[tuple[int, int]]:
    """(offset, successor) of every claim that starts in the block; offsets are those of the file.

    A header may be of any length: `more(have, n)` gives n bytes that follow the first `have`, and is
    asked until the header ends or a line shows that it is none. Claims that share their blank line
    are suffixes of one another, so their lines are read once, from the last claim to the first.
    """
    places, at = [], data.find(MAGIC)
    while 0 <= at < block_bytes:
        places.append(at)
        at = data.find(MAGIC, at + 1)
    found, k, step = [], 0, READ_ON
    while k < len(places):
        end = data.find(b"\r\n\r\n", places[k])
        checked = places[-1] + len(MAGIC)
        while end < 0 and more is not None and start + len(data) < size:
            # All claims left hold the lines after the last one of them.
            whole = data.rfind(b"\r\n", checked)
            if whole >= 0:
                if _fields(data, checked, whole) is None:
                    break
                checked = whole + 2
            have = len(data)
            data += more(have, min(step, size - start - have))
            step *= 2
            end = data.find(b"\r\n\r\n", max(places[-1], have - 3))
        if end < 0:
            break
        group = k
        while k < len(places) and places[k] <= end:
            k += 1
        fields, upto, claims = {}, end, []
        for at in reversed(places[group:k]):
            lines = _fields(data, at + len(MAGIC), upto)
            if lines is None:
                break
            fields, upto = lines | fields, at + len(MAGIC) - 2
            length = fields.get(b"content-length", b"")
            after = start + end + 4 + int(length) + 4 if length.isdigit() else None
            if after is not None and b"warc-type" in fields and after <= size:
                claims.append((start + at, after))
        found += reversed(claims)
    return found


def exits(found: list[tuple[int, int]], end: int) -> dict[int, int]:
    """For each claim, the first offset outside the block that its chain reaches; claims whose
    chain breaks inside the block are left out."""
    out: dict[int, int] = {}
    for offset, after in reversed(found):
        if after >= end:
            out[offset] = after
        elif after in out:
            out[offset] = out[after]
    return out


def entries(scope: Scope, folder: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(file, size, start, entry): the first true record of every block that has one."""
    spark = scope.spark

    def scan(batches):
        for batch in batches:
            rows = {"file": [], "size": [], "at": [], "exit": []}
            for file, size, start in zip(*(batch.column(k).to_pylist() for k in range(3))):
                data = common.read_range(file, start, min(block_bytes + READ_ON, size - start))
                found = candidates(data, start, block_bytes, size,
                                   lambda have, n: common.read_range(file, start + have, n))
                for at, out in exits(found, min(start + block_bytes, size)).items():
                    rows["file"].append(file), rows["size"].append(size)
                    rows["at"].append(at), rows["exit"].append(out)
            yield pa.RecordBatch.from_pydict(rows, pa.schema([
                ("file", pa.string()), ("size", pa.int64()), ("at", pa.int64()), ("exit", pa.int64())]))

    listed = scope.table(blocks(spark, folder, block_bytes), "blocks")
    n = max(1, min(MOST_TASKS, listed.count()))  # several blocks a task in a large archive
    claims = scope.table(listed.repartition(n).mapInArrow(
        scan, "file string, size long, at long, exit long"), "claims")
    reached = scope.table(claims.where("at = 0").select("file", "at"), "reached")
    jumps = scope.table(claims.where("exit < size").select("file", "at", "exit"), "jumps")
    before = 0
    while (count := reached.count()) != before:
        before = count
        # Offsets compress far better on disk than in memory, so their size there says little: merge.
        ahead = reached.join(jumps.hint("merge"), ["file", "at"]).select("file", F.col("exit").alias("at"))
        wider = scope.table(reached.unionByName(ahead).distinct(), "reached")
        hop = jumps.select("file", F.col("at").alias("exit"), F.col("exit").alias("further"))
        longer = scope.table(jumps.join(hop.hint("merge"), ["file", "exit"]).select(
            "file", "at", F.col("further").alias("exit")), "jumps")
        scope.drop(reached), scope.drop(jumps)
        reached, jumps = wider, longer
    return reached.join(claims.select("file", "at", "size").hint("merge"), ["file", "at"]).select(
        "file", "size", (F.col("at") - F.col("at") % block_bytes).alias("start"), F.col("at").alias("entry"))


MOST_TASKS = 20_000
RECORD = ("file string, offset long, page_id long, url string, record_type string, payload_digest string, "
          "payload_bytes long, refers_to long, payload binary")


def read(scope: Scope, folder: str, block_bytes: int = BLOCK_BYTES, payload: bool = True) -> DataFrame:
    """Every true record of the archives, blocks dealt over tasks; the digest of a response is computed
    from the payload read. Without `payload` that column is null."""
    names = [c.split()[0] for c in RECORD.split(", ")]
    schema = pa.schema(list(zip(names, [
        pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.binary()])))

    def number(field: bytes):
        value = field.partition(b"<urn:page:")[2].rstrip(b">")
        return int(value) if value.lstrip(b"-").isdigit() else None

    def parse(batches):
        for batch in batches:
            for file, size, start, entry in zip(*(batch.column(k).to_pylist() for k in range(4))):
                limit = min(start + block_bytes, size)
                data = common.read_range(file, entry, min(limit - entry + READ_ON, size - entry))
                at, rows = entry, []
                while at < limit:
                    step = READ_ON
                    while (end := data.find(b"\r\n\r\n", at - entry)) < 0:  # the header reaches over what was read
                        if entry + len(data) >= size:
                            raise ValueError(f"{file}: the header at {at} has no end")
                        data += common.read_range(file, entry + len(data), min(step, size - entry - len(data)))
                        step *= 2
                    fields, body = _fields(data, at - entry + len(MAGIC), end), end + 4
                    after = body + int(fields[b"content-length"]) + 4
                    if after > len(data):  # the last record reaches over the block
                        data += common.read_range(file, entry + len(data), after - len(data))
                    block = data[body: after - 4]
                    http, _, content = block.partition(b"\r\n\r\n")
                    kind = fields[b"warc-type"].decode()
                    claimed = re.search(rb"Content-Length: (\d+)", http)
                    rows.append((
                        file, at, number(fields[b"warc-record-id"]), fields.get(b"warc-target-uri", b"").decode(), kind,
                        digest_of(content) if kind == "response" else fields[b"warc-payload-digest"].decode().removeprefix("sha1:"),
                        len(content) if kind == "response" else int(claimed[1]),
                        number(fields.get(b"warc-refers-to", b"")), content if payload and kind == "response" else None))
                    at = entry + after
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t.type) for c, t in zip(zip(*rows), schema)], schema=schema)

    starts = scope.table(entries(scope, folder, block_bytes), "entries")
    return starts.repartition(max(1, min(MOST_TASKS, starts.count()))).mapInArrow(parse, RECORD)


def check_counts(written: DataFrame, records: DataFrame) -> None:
    """Raises unless as many records were read of every file as were written to it."""
    name = F.element_at(F.split("file", "/"), -1).alias("name")
    counts = written.groupBy(name).agg(F.sum("records").alias("written")).join(
        records.groupBy(name).agg(F.count(F.lit(1)).alias("read")), "name", "full")
    wrong = counts.where("not (written <=> read)").orderBy("name").limit(5).collect()
    if wrong:
        raise ValueError("records written and read differ: " + "; ".join(
            f"{r['name']} {r['written'] or 0} and {r['read'] or 0}" for r in wrong))


@query("op4_warc")
def op4_warc(spark, sf_dir):
    common.small_batches(spark)
    with Scope(spark, "warc") as scope:
        folder = scope.path("archive")
        written = scope.table(write(scope, common.table(spark, sf_dir, "pages"), folder), "written")
        records = scope.table(read(scope, folder, payload=False).select(
            "file", "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"), "records")
        check_counts(written, records)
        return scope.keep(records.drop("file"))
