"""Report inputs as one object, staged once per session.

``load_tables`` derives the staged tables (``fixtures``) and writes them as
Parquet under the shared scratch folder (``spark.checkpoint.dir``), the way
the warehouse holds them: payments and margin partitioned by capture month so
capture-date ranges prune whole folders, the rest as plain tables.  Each table
is written when it is first read, so a query over merchants moves no facts.  Later
jobs read those files, so every report starts from a short lineage that
survives executor loss.  ``materialize=False`` keeps everything lazy.
"""

from __future__ import annotations

import copy
import dataclasses
import datetime as dt
import hashlib
import threading
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import app_id, scratch_path
from . import fixtures

FACT_TABLES = ("payments", "margin")
DIM_TABLES = ("merchants", "opportunities", "country_codes", "team_role", "upsells")
CURVE_TABLES = ("backlog_curve", "pipeline_curve")
MONTH_COL = "capture_month"
SLICE_ROWS = 1_000_000  # fact rows that one task sorts and writes
LEAST_ROWS = 1 << 15  # rows of a task that are worth one
# derived tables that no uploaded list goes into
LIST_FREE = ("daily_payments/by-month", "daily_margin/by-month", "special_dates", "first_contact", "opportunity_totals")


class Later:
    """A table that is staged when it is first read, once for all ``Tables`` that hold it."""

    def __init__(self, stage):
        self._stage, self._lock, self._df = stage, threading.Lock(), None

    def get(self) -> DataFrame:
        with self._lock:
            if self._df is None:
                self._df = self._stage()
            return self._df


@dataclasses.dataclass
class Tables:
    payments: DataFrame
    margin: DataFrame
    merchants: DataFrame
    opportunities: DataFrame
    country_codes: DataFrame
    team_role: DataFrame
    upsells: DataFrame
    backlog_curve: DataFrame
    pipeline_curve: DataFrame
    source_dir: str = ""
    materialized: bool = False
    # names a set of lists that differs from the staged ones: tables derived from them are stored apart
    lists: str = ""
    _derived: dict = dataclasses.field(default_factory=dict, repr=False, compare=False)
    _building: dict = dataclasses.field(default_factory=dict, repr=False, compare=False)
    _values: dict = dataclasses.field(default_factory=dict, repr=False, compare=False)

    def __getattribute__(self, name: str):
        value = object.__getattribute__(self, name)
        return value.get() if isinstance(value, Later) else value

    def as_dict(self) -> dict[str, DataFrame]:
        """All tables by name; those not staged yet are, by concurrent Spark jobs."""
        names = [f.name for f in dataclasses.fields(self)
                 if f.name not in ("source_dir", "materialized", "lists", "_derived", "_building", "_values")]
        with ThreadPoolExecutor(max_workers=len(names)) as pool:
            return dict(zip(names, pool.map(lambda name: getattr(self, name), names)))

    @property
    def spark(self) -> SparkSession:
        return self.backlog_curve.sparkSession  # staged with nothing to read

    def raw(self, name: str) -> DataFrame:
        """A table of the source folder (the driver's parquet files)."""
        return fixtures.read_raw(self.spark, self.source_dir, name)

    def derived(self, name: str, build, write: bool = True) -> DataFrame:
        """A table derived from these inputs by ``build(self)``, written once and then read.

        Used for tables several reports share: the CRM rollups (special dates,
        first contact, deal totals) and the daily fact sums, so each input is
        aggregated once per dataset, not once per report.
        """
        with _LOCK:
            if name in self._derived:
                return self._derived[name]
            lock = self._building.setdefault(name, threading.Lock())
        with lock:  # one writer per table; concurrent callers wait for it
            with _LOCK:
                if name in self._derived:
                    return self._derived[name]
            df = build(self)
            if write and self.source_dir and self.materialized:
                path = self.output_path("derived", name)
                df.write.mode("overwrite").parquet(path)
                df = self.spark.read.parquet(path)
            with _LOCK:
                self._derived[name] = df
            return df

    def derived_by_month(self, name: str, build) -> DataFrame:
        """Like ``derived``, for a table of daily rows: stored in one folder per capture month.

        ``build(facts filter)`` gets the months to compute.  A month whose input
        files are those of the last run is kept as it is; only the others are
        computed and rewritten.
        """
        if not (self.source_dir and self.materialized):
            return self.derived(name, lambda x: build(x, None))
        return self.derived(f"{name}/by-month", lambda x: refresh_months(x, name, build), write=False)

    def memo(self, key, compute):
        """A small value computed once per inputs and key (e.g. a scan bound); ``compute()`` runs on a miss."""
        with _LOCK:
            if key in self._values:
                return self._values[key]
        value = compute()
        with _LOCK:
            return self._values.setdefault(key, value)

    def with_lists(self, name: str, **lists: DataFrame) -> "Tables":
        """The same facts and deals with other lists (``country_codes``, ``team_role``, ``upsells``, curves).

        What is derived from facts and deals alone is shared; what the lists
        go into is derived anew and stored under ``name``.
        """
        with _LOCK:
            shared = {k: v for k, v in self._derived.items() if k in LIST_FREE}
        out = copy.copy(self)  # tables not staged yet stay so
        for field, value in {**lists, "lists": name, "_derived": shared, "_building": {}, "_values": {}}.items():
            setattr(out, field, value)
        return out

    def output_path(self, *parts: str) -> str:
        """Per-dataset folder under the shared scratch folder for written outputs."""
        named = self.source_dir.rstrip("/") + (f"#{self.lists}" if self.lists else "")
        tag = hashlib.sha1(named.encode()).hexdigest()[:16]
        return scratch_path(self.spark, "outputs", tag, *parts)


def capture_range(df: DataFrame, start=None, end=None, start_inclusive: bool = True) -> DataFrame:
    """Filter ``capture_date`` to [start, end) and prune capture-month partitions.

    The month predicate is implied by the date predicate; stating it lets the
    scan skip folders of a month-partitioned table.
    """
    cond = F.lit(True)
    if start is not None:
        cond = cond & ((F.col("capture_date") >= F.lit(start)) if start_inclusive else (F.col("capture_date") > F.lit(start)))
        if MONTH_COL in df.columns:
            cond = cond & (F.col(MONTH_COL) >= F.trunc(F.lit(start), "month"))
    if end is not None:
        cond = cond & (F.col("capture_date") < F.lit(end))
        if MONTH_COL in df.columns:
            cond = cond & (F.col(MONTH_COL) <= F.trunc(F.lit(end), "month"))
    return df.filter(cond)


def with_month(facts: DataFrame) -> DataFrame:
    """``facts`` with their capture month, if they are not stored by it."""
    return facts if MONTH_COL in facts.columns else facts.withColumn(MONTH_COL, F.trunc("capture_date", "month"))


def in_months(facts: DataFrame, months) -> DataFrame:
    """Rows of the given capture months; all rows for None."""
    return facts if months is None else with_month(facts).where(F.col(MONTH_COL).isin(*months))


def listed_months(facts: DataFrame) -> dict[dt.date, str] | None:
    """A fingerprint of each capture month's files (names, sizes, times) from the listing of its folder.

    Reads no data and starts no job.  None where the facts are not stored by
    capture month, or hold files outside the folders of months.
    """
    spark, root = facts.sparkSession, f"/{MONTH_COL}="
    files = facts.inputFiles()
    if MONTH_COL not in facts.columns or not files or any(root not in f for f in files):
        return None
    months: dict[dt.date, list[str]] = {}
    for folder in sorted({f.rsplit("/", 1)[0] for f in files}):
        name = folder.split(root, 1)[1].split("/", 1)[0]
        try:
            month = dt.date.fromisoformat(name)
        except ValueError:  # the folder of NULL dates: no report reads it
            continue
        path = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(folder))
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        months.setdefault(month, []).extend(
            f"{s.getPath().getName()} {s.getLen()} {s.getModificationTime()}" for s in fs.listStatus(path)
            if s.isFile() and not s.getPath().getName().startswith(("_", ".")))
    return {m: hashlib.sha1("\n".join(sorted(names)).encode()).hexdigest() for m, names in months.items()}


def month_inputs(facts: DataFrame) -> dict[dt.date, str]:
    """A fingerprint of the input files of each capture month: from the folders' listing where facts are stored
    by month, otherwise from the file each row lies in (no column is read)."""
    listed = listed_months(facts)
    if listed is not None:
        return listed
    files = with_month(facts).select(MONTH_COL, "_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time").distinct()
    sums = files.groupBy(MONTH_COL).agg(F.sum(F.xxhash64("file_path", "file_size", "file_modification_time").cast("decimal(38,0)"))
                                        .cast("string").alias("inputs"))
    return {r[MONTH_COL]: r["inputs"] for r in sums.collect() if r[MONTH_COL] is not None}


def refresh_months(t: Tables, name: str, build, facts: str | None = None) -> DataFrame:
    """Bring a stored daily table up to date and return it: rewrites the months whose input files changed.

    The months' fingerprints are stored beside the table after it is written,
    so a run that fails half way is repeated.  A month that has left the input
    makes the whole table be written anew.
    """
    spark, path = t.spark, t.output_path("daily", name)
    source = getattr(t, facts or name.split("_", 1)[1])
    now = month_inputs(source)
    try:
        before = {r[MONTH_COL]: r["inputs"] for r in spark.read.schema(f"{MONTH_COL} date, inputs string").parquet(f"{path}-months").collect()}
    except AnalysisException:  # no such path: the first run
        before = {}
    whole = not before or bool(before.keys() - now.keys())
    changed = sorted(now) if whole else sorted(m for m in now if now[m] != before.get(m))
    if changed or whole:
        months = None if whole else changed
        (by_days(build(t, months), in_months(source, months).select("capture_date")).write.mode("overwrite")
         .option("partitionOverwriteMode", "static" if whole else "dynamic").option("compression", "zstd").partitionBy(MONTH_COL).parquet(path))
        spark.createDataFrame(sorted(now.items()), f"{MONTH_COL} date, inputs string").coalesce(1).write.mode("overwrite").parquet(f"{path}-months")
    return spark.read.parquet(path)


def stage_tables(spark: SparkSession, sf_dir: str) -> Tables:
    """Lazy staged tables straight from the raw parquet files."""
    nsup = fixtures.supplier_count(spark, sf_dir)
    merchants = fixtures.merchants(spark, sf_dir, nsup)
    return Tables(
        payments=fixtures.payments(spark, sf_dir),
        margin=fixtures.margin(spark, sf_dir),
        merchants=merchants,
        opportunities=fixtures.opportunities(spark, sf_dir, nsup),
        country_codes=fixtures.country_codes(spark, sf_dir),
        team_role=fixtures.team_role(spark, sf_dir),
        upsells=fixtures.upsells(merchants),
        backlog_curve=fixtures.backlog_curve(spark),
        pipeline_curve=fixtures.pipeline_curve(spark),
        source_dir=sf_dir,
    )


_CACHE: dict[tuple[str, ...], Tables] = {}
_LOCK = threading.Lock()


def partitions_for(spark: SparkSession, rows: int, most: int) -> int:
    """Partitions for ``rows`` rows: ``most`` rows of a task at most; the session's parallelism, if tasks are not tiny then."""
    return max(1, -(-rows // most), min(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // LEAST_ROWS)))


def by_days(df: DataFrame, days: DataFrame, most: int = SLICE_ROWS) -> DataFrame:
    """``df`` in contiguous slices of capture days, sorted by day, ready to be written by capture month.

    ``days`` has a row per row of ``df``, or more, and is only counted per day
    (a calendar of counts, which the driver deals into slices of some ``most`` rows),
    so ``df`` itself is computed and shuffled once; a range partitioning would
    compute it twice.  A day with more rows than a slice
    has is spread over several by a hash of the whole row, as are rows without a date.
    """
    spark = df.sparkSession
    counts = sorted(r for r in days.groupBy("capture_date").count().collect() if r["capture_date"] is not None)
    total = sum(n for _, n in counts)
    parts = partitions_for(spark, total, most)
    dealt, before = [], 0
    for day, n in counts:
        first = before * parts // total
        before += n
        dealt.append((day, first, (before - 1) * parts // total - first + 1))
    slots = F.broadcast(spark.createDataFrame(dealt, "_day date, _first int, _wide int"))
    row = F.xxhash64(*df.columns)
    slot = F.coalesce(F.col("_first") + F.pmod(row, F.col("_wide")), F.pmod(row, F.lit(parts))).cast("int")
    return (df.join(slots, F.col("capture_date") == F.col("_day"), "left").select(*df.columns, slot.alias("_slot"))
            .repartitionById(parts, F.col("_slot")).drop("_slot")
            .withColumn(MONTH_COL, F.trunc("capture_date", "month")).sortWithinPartitions(MONTH_COL, "capture_date"))


def _write(df: DataFrame, path: str, days: DataFrame | None = None) -> None:
    """Write a staged table; with ``days`` (see ``by_days``) in one folder per capture month.

    Each task writes a contiguous slice of days into one or two month folders:
    a busy month spreads over many tasks, and even a day (or merchant-day)
    holding a large share of all rows is split.  Files are sorted by date, so
    row-group statistics skip days.
    """
    if days is None:
        df.write.mode("overwrite").parquet(path)
        return
    by_days(df, days).write.mode("overwrite").option("compression", "zstd").partitionBy(MONTH_COL).parquet(path)


def input_state(spark: SparkSession, sf_dir: str) -> str:
    """A fingerprint of the source tables' files, from their listing: changed files make tables be staged anew."""
    found = []
    for name in fixtures.RAW_TABLES:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/{name}.parquet")
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        for s in fs.listStatus(path):  # a file, or the files of a folder
            found.append(f"{s.getPath()} {s.getLen()} {s.getModificationTime()}")
    return hashlib.sha1("\n".join(sorted(found)).encode()).hexdigest()


def load_tables(spark: SparkSession, sf_dir: str, materialize: bool = True) -> Tables:
    """Staged tables for ``sf_dir``; written once per session when ``materialize``."""
    if not materialize:
        return stage_tables(spark, sf_dir)
    root = scratch_path(spark, "staged", hashlib.sha1(sf_dir.rstrip("/").encode()).hexdigest()[:16])
    key = (app_id(spark), root, sf_dir, input_state(spark, sf_dir))
    with _LOCK:
        if key in _CACHE:
            return _CACHE[key]
        lazy = stage_tables(spark, sf_dir).as_dict()
        out = {name: lazy[name] for name in CURVE_TABLES}  # generated from a range, nothing to read

        def written(name: str, df: DataFrame, days: DataFrame | None = None) -> DataFrame:
            path = f"{root}/{name}"
            _write(df, path, days)
            return spark.read.parquet(path)

        out["margin"] = Later(lambda: written("margin", lazy["margin"], fixtures.capture_days(spark, sf_dir)))
        for name in ("merchants", "opportunities", "country_codes", "team_role"):
            out[name] = Later(lambda name=name: written(name, lazy[name]))
        # upsells derive from the written merchants; payments are a projection of margin
        # (same rows and npv), so they are not written twice
        out["upsells"] = Later(lambda: written("upsells", fixtures.upsells(out["merchants"].get())))
        out["payments"] = Later(lambda: out["margin"].get().select(
            "capture_date", "sales_merchant_id", F.col("npv").alias("npv_usd_fixed"), MONTH_COL))
        tables = Tables(**out, source_dir=sf_dir, materialized=True)
        _CACHE[key] = tables
        return tables


def stage_table(df: DataFrame, t: Tables, name: str) -> DataFrame:
    """Write ``df`` once under the shared scratch folder and read it back.

    Used where one intermediate feeds several branches of a job: the inputs
    are scanned once, the consumers read compact Parquet, and the lineage is
    cut at a durable copy (executor loss does not trigger recomputation from
    the fact tables).
    """
    path = t.output_path("stage", f"{name}-{uuid.uuid4().hex}")
    df.write.mode("overwrite").parquet(path)
    return t.spark.read.parquet(path)
