"""Session defaults and the shared folder used for intermediate tables."""

from __future__ import annotations

import atexit
import functools
import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# Tables are stored with this codec: about half the size of the default one.
CODEC = "zstd"
# Text files are gzip at its fastest level: a third of the time for about a seventh more bytes of bronze.
TEXT = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}

# Rows one sort task is meant to hold; larger tables are cut into slices (see functions/ranks.py).
SINGLE_TASK_ROWS = 1_000_000


def get_spark(app_name: str = "creditloom", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the library is tuned for; `conf` overrides them.

    Left to Spark: shuffle partition count (AQE coalesces), join strategies, skew splits.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.ui.enabled": "false",
        # Call sites of column expressions are only used in error messages, and cost time for
        # every expression built.
        "spark.sql.dataFrameQueryContext.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach, named by `spark.checkpoint.dir`.

    Only a local session may fall back to a temporary folder; a cluster session without the
    setting is an error, because a machine-local folder would be lost with its machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="creditloom-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused folder below the shared root."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"


def kept_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the shared root that is deleted when the Python process ends."""
    path = scratch_path(spark, name)
    _delete_at_exit(spark, path)
    return path


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"
OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"
_changed: dict[tuple[SparkSession, str], list] = {}
_changed_lock = threading.Lock()


@contextmanager
def _setting(spark: SparkSession, key: str, value: str, default: str):
    """The setting has `value` inside. Several threads may share it; the last one to end puts it back."""
    with _changed_lock:
        state = _changed.setdefault((spark, key), [0, default])
        if not state[0]:
            state[1] = spark.conf.get(key, default)
            spark.conf.set(key, value)
        state[0] += 1
    try:
        yield
    finally:
        with _changed_lock:
            state[0] -= 1
            if not state[0]:
                spark.conf.set(key, state[1])
                del _changed[spark, key]


def freed_shuffles(spark: SparkSession):
    """Shuffle files of the writes inside go when each write is done, not when the driver next collects
    garbage."""
    return _setting(spark, CLEANUP, "true", "false")


@contextmanager
def writing(spark: SparkSession):
    """For writes of wide tables: shuffle files freed, and code that the JVM can compile. It interprets
    methods of more than 8,000 bytes, which a stage of dozens of text columns has; Spark's other way splits them."""
    with freed_shuffles(spark), _setting(spark, METHOD_LIMIT, "8000", "65535"):
        yield


def open_files(spark: SparkSession):
    """A task that writes text keeps a file open per partition value, up to 200, so that its rows are not
    sorted first."""
    return _setting(spark, OPEN_FILES, "200", "0")


def stage(df: DataFrame, name: str = "stage") -> tuple[DataFrame, int]:
    """Write `df` to the shared folder and read it back; also return its row count.

    Three things follow: the lineage is cut by a table that survives executor loss, several
    readers share one computation, and Catalyst knows the table's true size, so a later join
    broadcasts it only when it is below `spark.sql.autoBroadcastJoinThreshold` and shuffles
    (with AQE skew splitting) when it is not.

    The table goes when the `job` it was staged in ends, outside a job when the Python process ends.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    if _jobs:
        _jobs[-1].append((spark, path))
    else:
        _delete_at_exit(spark, path)
    seen = Observation()
    with writing(spark):
        df.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(path, compression=CODEC)
    return spark.read.schema(df.schema).parquet(path), seen.get["rows"]


_jobs: list[list[tuple[SparkSession, str]]] = []


def job(run):
    """Decorates a job that returns written tables: what it staged on the way is deleted when it
    ends, also when it fails. One job runs at a time in a driver process."""
    @functools.wraps(run)
    def wrapper(*args, **kwargs):
        staged: list[tuple[SparkSession, str]] = []
        _jobs.append(staged)
        try:
            return run(*args, **kwargs)
        finally:
            _jobs.pop()
            for spark, path in staged:
                delete_path(spark, path)
    return wrapper


def _file(spark: SparkSession, path: str):
    """The folder and its file system, through Hadoop, so any store works."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def size_of(spark: SparkSession, path: str) -> int:
    """Bytes of all files of a folder, as stored."""
    files, target = _file(spark, path)
    return files.getContentSummary(target).getLength()


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a folder of the shared file system."""
    files, target = _file(spark, path)
    files.delete(target, True)


def _delete_at_exit(spark: SparkSession, path: str) -> None:
    """The file system is looked up now: when the process ends, the session has often been stopped."""
    atexit.register(_forget, *_file(spark, path))


class Scope:
    """Intermediate tables of one job: gone when the `with` block ends, also when it fails.

    `table` stages a frame inside the scope, `drop` deletes one early, `keep` stages a result that
    outlives the scope; what was kept is deleted when the Python process ends. While a table is
    written, Spark is asked to delete the shuffle files of that write as soon as it is done.
    """

    def __init__(self, spark: SparkSession, name: str = "scope"):
        self.spark, self.name, self.paths = spark, name, {}

    def __enter__(self) -> Scope:
        return self

    def __exit__(self, *_) -> None:
        for path in self.paths.values():
            delete_path(self.spark, path)
        self.paths = {}

    def path(self, name: str) -> str:
        """A new folder that belongs to this scope."""
        path = scratch_path(self.spark, f"{self.name}-{name}")
        self.paths[name + path[-8:]] = path
        return path

    def forget(self, path: str) -> None:
        """Delete a folder of this scope before the scope ends."""
        delete_path(self.spark, path)
        self.paths = {k: p for k, p in self.paths.items() if p != path}

    def _write(self, df: DataFrame, path: str) -> DataFrame:
        with freed_shuffles(self.spark):
            df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def table(self, df: DataFrame, name: str = "stage") -> DataFrame:
        path = self.path(name)
        table = self._write(df, path)
        table.scope_path = path
        return table

    def drop(self, table: DataFrame) -> None:
        """Delete a table of this scope before the scope ends."""
        self.forget(table.scope_path)

    def keep(self, df: DataFrame, name: str = "result") -> DataFrame:
        path = scratch_path(self.spark, f"{self.name}-{name}")
        table = self._write(df, path)
        _delete_at_exit(self.spark, path)
        return table


def _forget(files, target) -> None:
    try:
        files.delete(target, True)
    except Exception:  # the driver's JVM is already gone; the folder is then the cluster's to clean
        pass
