"""Change-driven backfill: only the months whose inputs changed are made again.

A month of a raw source has a fingerprint that does not depend on the order of its rows. Fingerprints
of the last finished backfill are stored; the months in which they differ, with all that reads them,
are the plan of the next one. Which table reads which months of which other is stated once, in `READS`.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditloom import session
from creditloom.functions.fingerprint import fingerprints
from creditloom.plans import gold, ingest, operate
from creditloom.sources import tables
from creditloom.sources.calendar import OFFSET_MONTHS
from creditloom.sources.registry import SOURCES, read_raw_csv, source


@dataclass(frozen=True)
class Reach:
    """Which months of a table read month m of another: m + `offset`, or all from there on."""

    onwards: bool = False
    offset: int = 0

    def then(self, other: Reach) -> Reach:
        return Reach(self.onwards or other.onwards, self.offset + other.offset)


SAME, ONWARDS, LATER, EARLIER = Reach(), Reach(True), Reach(False, OFFSET_MONTHS), Reach(False, -OFFSET_MONTHS)

# (table, table it reads, reach), in the order in which tables are made.
READS = [
    *((f"silver/{name}", f"bronze/{name}", SAME) for name in SOURCES),
    ("silver/loan_type", "bronze/financials", SAME),
    ("gold/label_store", "silver/lms", SAME),
    ("gold/feature_store", "silver/lms", SAME),
    # The latest row up to the application, and medians of everything so far.
    *(("gold/feature_store", f"silver/{name}", ONWARDS)
      for name in ("financials", "attributes", "loan_type", "clickstream")),
    ("gold/model_predictions", "gold/feature_store", LATER),
    ("gold/model_monitoring", "gold/model_predictions", SAME),
    # Outcomes of the same month, or of some months later.
    ("gold/model_monitoring", "gold/label_store", SAME),
    ("gold/model_monitoring", "gold/label_store", EARLIER),
]
# Every month is measured against the first month of these.
BASELINES = [("gold/model_monitoring", "gold/model_predictions")]
FINGERPRINT = "source string, snapshot_date date, fingerprint string"


def raw_fingerprints(spark: SparkSession, raw_dir: str) -> DataFrame:
    """source, snapshot_date, fingerprint of everything delivered, one pass per raw file."""
    out = None
    for name, src in SOURCES.items():
        raw = read_raw_csv(spark, f"{raw_dir}/{src.file_name}", src.schema)
        part = fingerprints(raw, "snapshot_date").select(
            F.lit(name).alias("source"), F.col("snapshot_date").try_cast("date").alias("snapshot_date"), "fingerprint")
        out = part if out is None else out.unionByName(part)
    return out


def changed(current: DataFrame, stored: DataFrame) -> DataFrame:
    """source, snapshot_date, change (new, changed or removed) of the months that differ."""
    before = stored.select("source", "snapshot_date", F.col("fingerprint").alias("before"))
    both = current.join(before, ["source", "snapshot_date"], "full")
    change = (F.when(F.col("before").isNull(), "new").when(F.col("fingerprint").isNull(), "removed")
              .when(F.col("before") != F.col("fingerprint"), "changed"))
    return both.select("source", "snapshot_date", change.alias("change")).where("change is not null")


def reach_of(reads: Sequence[tuple[str, str, Reach]] = tuple(READS)) -> list[tuple[str, str, Reach]]:
    """(raw table, table, reach) of everything that reads a raw table, however indirectly."""
    reached: dict[str, set[tuple[str, Reach]]] = {}
    for table, read, reach in reads:
        before = reached.get(read, {(read, SAME)})
        reached.setdefault(table, set()).update((raw, r.then(reach)) for raw, r in before)
    found = [(f"bronze/{name}", f"bronze/{name}", SAME) for name in SOURCES]
    return found + [(raw, table, r) for table, paths in reached.items()
                    for raw, r in sorted(paths, key=lambda p: (p[0], p[1].onwards, p[1].offset))]


def plan(changes: DataFrame, calendars: DataFrame) -> DataFrame:
    """table, snapshot_date of every month to make again.

    `changes` has (source, snapshot_date); `calendars` the months each table can have (table,
    snapshot_date), with the removed months of raw tables among them. One join with the closure of
    `READS`, a few dozen rows, and one with the calendars.
    """
    spark = changes.sparkSession
    reach = spark.createDataFrame(
        [(raw.removeprefix("bronze/"), table, r.onwards, r.offset) for raw, table, r in reach_of()],
        "source string, table string, onwards boolean, offset int")
    last = calendars.groupBy("table").agg(
        F.max("snapshot_date").alias("last"), F.min("snapshot_date").alias("first"))
    start = F.add_months("snapshot_date", F.col("offset"))
    months = F.when(F.col("onwards") & (start <= F.col("last")), F.sequence(start, "last", F.expr("interval 1 month"))
                    ).when(~F.col("onwards"), F.array(start))
    wanted = (changes.select("source", "snapshot_date").join(reach, "source").join(last, "table")
              .select("table", F.explode(months).alias("snapshot_date")).distinct()
              .join(calendars, ["table", "snapshot_date"], "left_semi"))
    for table, baseline in BASELINES:
        moved = (wanted.where(F.col("table") == baseline)
                 .join(last.where(F.col("table") == baseline).select(F.col("first").alias("snapshot_date")),
                       "snapshot_date", "left_semi").select(F.lit(table).alias("table")))
        wanted = wanted.unionByName(calendars.join(moved, "table", "left_semi")).distinct()
    return wanted


def month_calendars(bronze: DataFrame, lms: DataFrame) -> DataFrame:
    """table, snapshot_date: the months every table can have, from the months of the raw tables
    (source, snapshot_date) and the cleaned loans."""
    def named(df, *names):
        return df.select(F.explode(F.array(*map(F.lit, names))).alias("table"), "snapshot_date").distinct()
    raw = bronze.select(F.explode(F.array(
        F.concat(F.lit("bronze/"), "source"), F.concat(F.lit("silver/"), "source"))).alias("table"), "snapshot_date")
    applied = lms.where("mob = 0").select("snapshot_date").distinct()
    scored = applied.select(F.add_months("snapshot_date", OFFSET_MONTHS).alias("snapshot_date"))
    return (raw.unionByName(named(bronze.where("source = 'financials'"), "silver/loan_type"))
            .unionByName(named(lms.where("mob = 6"), "gold/label_store"))
            .unionByName(named(applied, "gold/feature_store"))
            .unionByName(named(scored, "gold/model_predictions", "gold/model_monitoring")))


def _rewrite(spark: SparkSession, root: str, table: str, months: Sequence[str], present: set[str], make) -> None:
    """Run `make(months)` for the months that still have input, and drop the partitions of the others."""
    layer, name = table.split("/")
    gone = [m for m in months if m not in present]
    if gone:
        tables.drop_months(spark, tables.table_path(root, layer, name), gone)
    left = [m for m in months if m in present]
    if left:
        make(left)


@session.job
def backfill(spark: SparkSession, raw_dir: str, root: str, model_versions: Sequence[str] = ()) -> DataFrame:
    """Brings all tables up to date with the raw files and returns the plan that was carried out.

    Fingerprints are stored last: a run that stops on the way leaves the old ones, and the next
    run does the whole plan again. Every step rewrites whole partitions, so that does no harm.
    The vocabularies of the first run stay.
    """
    current, _ = session.stage(raw_fingerprints(spark, raw_dir), "fingerprints")
    stored = tables.read_or_empty(spark, tables.table_path(root, "ops", "fingerprints"), FINGERPRINT)
    changes, n = session.stage(changed(current, stored), "changes")
    if not n:
        return spark.createDataFrame([], "table string, snapshot_date date")

    known = current.select("source", "snapshot_date").unionByName(changes.select("source", "snapshot_date")).distinct()
    todo: dict[str, list[str]] = {}
    raw_months = _months_by(current.select(F.col("source").alias("table"), "snapshot_date"))
    # Raw and clean tables first: the months of the others follow from the cleaned loans.
    for r in changes.orderBy("snapshot_date").collect():
        todo.setdefault(r["source"], []).append(str(r["snapshot_date"]))
    first_run = tables.read_table(spark, tables.table_path(root, "silver", "loan_type_vocabulary")) is None
    for name in SOURCES:
        if name not in todo:
            continue
        present = raw_months.get(name, set())
        _rewrite(spark, root, f"bronze/{name}", todo[name], present, lambda m, n=name: ingest.bronze(spark, raw_dir, root, n, m))
        _rewrite(spark, root, f"silver/{name}", todo[name], present,
                 lambda m, n=name: ingest.silver(spark, root, n, None if first_run else m))
        if name == "financials":
            tables.drop_months(spark, tables.table_path(root, "silver", "loan_type"), [m for m in todo[name] if m not in present])

    lms = tables.read_table(spark, tables.table_path(root, "silver", "lms"))
    calendars, _ = session.stage(month_calendars(known, lms), "calendars")
    gone = _written_months(spark, root)  # months that only the old data had must be dropped too
    both = calendars.unionByName(gone).distinct()
    done, _ = session.stage(plan(changes, both), "plan")
    wanted, present = _months_by(done), _months_by(calendars)

    def step(table, make):
        if table in wanted:
            _rewrite(spark, root, table, sorted(wanted[table]), present.get(table, set()), make)

    step("gold/label_store", lambda m: gold.label_store(spark, root, months=m))
    step("gold/feature_store", lambda m: gold.feature_store(spark, root, months=m))
    for version in model_versions:
        step("gold/model_predictions", lambda m, v=version: operate.score_months(spark, root, v, m))
        if "gold/model_monitoring" in wanted:
            operate.monitor(spark, root, version, months=sorted(wanted["gold/model_monitoring"]))
    tables.overwrite_table(current.coalesce(1), tables.table_path(root, "ops", "fingerprints"))
    return spark.createDataFrame(done.collect(), "table string, snapshot_date date")


def _months_by(df: DataFrame) -> dict[str, set[str]]:
    """Months per table; tables times calendar months, a few thousand rows at most."""
    out: dict[str, set[str]] = {}
    for r in df.collect():
        out.setdefault(r["table"], set()).add(str(r["snapshot_date"]))
    return out


def _written_months(spark: SparkSession, root: str) -> DataFrame:
    """table, snapshot_date of the partitions that exist in the tables by month."""
    rows = [(f"gold/{name}", month) for name in ("label_store", "feature_store")
            for month in tables.months(spark, tables.table_path(root, "gold", name))]
    return spark.createDataFrame(rows, "table string, month string").select(
        "table", F.col("month").cast("date").alias("snapshot_date"))
