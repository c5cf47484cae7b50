"""Layer store: schema bootstrap, versioned appends, reads, compaction, export.

A store is a folder (on a cluster: under the shared ``spark.checkpoint.dir``
or any shared warehouse path) holding one table per layer: ``<root>/<layer>/<table>``,
whose live files are listed by its commit log (``plans.commits``).  Writes are
appends with a ``_version`` (epoch microseconds) and the ``_run_id``; readers apply
DED-1 to those files that another commit's keys may be in, so re-runs and late
repairs replace rows without in-place updates.  Compaction replaces such files by
files with the newest versions, in one commit.
"""

from __future__ import annotations

import time
import uuid
import zlib
from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick import schemas
from candlewick.functions.exprs import parse_utc, time_range
from candlewick.operators.dataset import dataset_select
from candlewick.operators.dedupe import latest_version
from candlewick.plans.commits import Log, overlapping, stamp

RAW_TABLES = {
    "trades": "raw.trades",
    "book": "raw.book_topk_raw",
    "liquidations": "raw.liquidations",
    "funding": "raw.funding",
    "open_interest": "raw.open_interest",
}
# Fixed value: book snapshots are kept for 90 days.
BOOK_RETENTION_DAYS = 90


@dataclass(frozen=True)
class Store:
    root: str

    def path(self, name: str) -> str:
        layer, table = name.split(".")
        return f"{self.root.rstrip('/')}/{layer}/{table}"


def log_of(spark: SparkSession, store: Store, name: str) -> Log:
    return Log(spark, store.path(name))


def bootstrap(spark: SparkSession, store: Store) -> list[str]:
    """SNK-4: create every layer table (without rows) if missing; idempotent."""
    created = []
    for name in schemas.LAYERS:
        log = log_of(spark, store, name)
        if not log.exists():
            log.create()
            created.append(name)
    return created


def _with_partitions(df: DataFrame, name: str) -> DataFrame:
    parts = schemas.LAYERS[name][1]
    if "dt" in parts and "dt" not in df.columns:
        df = df.withColumn("dt", F.to_date("timestamp"))
    if "ym" in parts and "ym" not in df.columns:
        df = df.withColumn("ym", F.date_format("bar_time", "yyyyMM"))
    return df


def _read_schema(name: str) -> T.StructType:
    schema, parts = schemas.LAYERS[name]
    names = {f.name for f in schema.fields}
    extra = [T.StructField(p, T.DateType() if p == "dt" else T.StringType(), True) for p in parts if p not in names]
    return T.StructType([*schema.fields, *extra, T.StructField("commit", T.StringType(), True)])


def new_version(run_id: str = "") -> int:
    """Microseconds, with ten bits of the run's id below them, so that concurrent runs differ."""
    return time.time_ns() // 1000 << 10 | zlib.crc32(run_id.encode()) & 1023


# The time column of a table, and the columns whose range is kept for each file.
_CLOCKS = {"meta.pipeline_runs": "event_ts", "meta.symbols": "updated_at", "sample.last_closes": "bar_time"}
_KEYS = {"meta.pipeline_runs": ["run_id"]}


def _clock(name: str) -> str:
    return _CLOCKS.get(name) or ("timestamp" if name.startswith("raw.") else "bar_time")


def _key(name: str):
    return F.concat_ws("|", *_KEYS.get(name, ["exchange", "symbol"]))


def _read_files(spark: SparkSession, store: Store, name: str, paths: list[str]) -> DataFrame:
    """The rows of some files, with the declared schema (columns that a file lacks are NULL) and the layout columns."""
    schema = _read_schema(name)
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", f"{store.path(name)}/data").parquet(*[f"{store.path(name)}/{p}" for p in paths])


def _described(spark: SparkSession, store: Store, name: str, folder: str, rewrite: bool) -> list[dict]:
    """The log entries of the files of a write, from their key and time columns: one for each file."""
    parts = schemas.LAYERS[name][1]
    rows = spark.read.schema(_read_schema(name)).option("basePath", f"{store.path(name)}/data").parquet(f"{store.path(name)}/{folder}")
    clock = F.col(_clock(name))
    stats = rows.groupBy(F.col("_metadata.file_path").alias("file"), *parts).agg(
        F.count(F.lit(1)).alias("n"), F.min(clock).alias("t0"), F.max(clock).alias("t1"), F.min(_key(name)).alias("low"), F.max(_key(name)).alias("high")
    )
    return [
        {
            "path": f"{folder}{r['file'].split(folder, 1)[1]}", "parts": {p: str(r[p]) for p in parts}, "n_rows": r["n"],
            "first_time": stamp(r["t0"]), "last_time": stamp(r["t1"]), "low": r["low"], "high": r["high"], "rewrite": rewrite,
        }
        for r in stats.collect()
    ]


def _put_files(out: DataFrame, store: Store, name: str, rewrite: bool = False) -> tuple[str, list[dict]]:
    """Write rows as files of a new folder that no reader knows yet; returns its id and the files' log entries."""
    spark, parts = out.sparkSession, schemas.LAYERS[name][1]
    ident = uuid.uuid4().hex
    # partition columns first (what the partitioned writer needs anyway), then the
    # series key and time: row groups then carry tight min/max for key and time pruning
    order = [c for c in (*parts, "exchange", "symbol", "bar_interval_sec", _clock(name)) if c in out.columns]
    writer = out.sortWithinPartitions(*dict.fromkeys(order)).write
    folder = f"data/commit={ident}"
    (writer.partitionBy(*parts) if parts else writer).parquet(f"{store.path(name)}/{folder}")
    return ident, _described(spark, store, name, folder, rewrite)


def write_layer(df: DataFrame, store: Store, name: str, run_id: str | None = None, version: int | None = None, tag: str | None = None) -> int:
    """SNK-1: conform, stamp ``_version`` / ``_run_id``, append partitioned in one commit; returns rows written.

    With a ``tag`` (a stream's query and batch) the commit happens once: a repeated one adds nothing.
    """
    schema, _ = schemas.LAYERS[name]
    versioned = any(f.name == "_version" for f in schema.fields)
    run_id = run_id or uuid.uuid4().hex
    defaults = {"_version": F.lit(version or new_version(run_id)).cast("long"), "_run_id": F.lit(run_id)} if versioned else {}
    out = _with_partitions(schemas.conform(df, schema, defaults=defaults), name)
    log = log_of(df.sparkSession, store, name)
    log.create()
    if tag is not None and log.tagged(tag):
        return 0
    ident, added = _put_files(out, store, name)
    if added or tag is not None:
        if log.commit([{**e, "commit": ident} for e in added], tag=tag) is None:
            return 0
        if name == BARS:
            write_closes(df.sparkSession, store, ident, added)
    return sum(e["n_rows"] for e in added)


def _partition_range(parts: list[str], start, end, value) -> list:
    """Conditions on layout columns (``value`` of their name) that a time range implies."""
    forms = {"dt": lambda t: t.date().isoformat(), "ym": lambda t: t.strftime("%Y%m")}
    out = []
    for p in parts:
        if p in forms and start:
            out.append(value(p) >= F.lit(forms[p](parse_utc(start))))
        if p in forms and end:
            out.append(value(p) <= F.lit(forms[p](parse_utc(end))))
    return out


def _wanted_files(files: DataFrame, name: str, start, end, interval_sec: int | None, key: str | None) -> DataFrame:
    """The entries whose layout values, times and keys may match."""
    parts = schemas.LAYERS[name][1]
    conditions = _partition_range(parts, start, end, lambda p: F.col("parts")[p])
    conditions += [F.col("last_time") >= F.lit(parse_utc(start))] if start else []
    conditions += [F.col("first_time") < F.lit(parse_utc(end))] if end else []
    conditions += [F.col("parts")["bar_interval_sec"] == str(int(interval_sec))] if interval_sec is not None else []
    conditions += [(F.col("low") <= key) & (F.col("high") >= key)] if key is not None else []
    for condition in conditions:
        files = files.where(condition)
    return files


def read_layer(spark: SparkSession, store: Store, name: str, latest: bool = True, start=None, end=None, interval_sec: int | None = None, key: str | None = None) -> DataFrame:
    """Read the newest state of a layer table with its declared schema; newest versions only, without their version columns.

    ``start`` / ``end`` (half-open, on the layer's time column), ``interval_sec`` and
    ``key`` choose the files from the log, and reach the scan as partition filters on the
    layout columns and as pushed filters on the time column.  With ``latest`` the rows of
    files that share key ranges with other commits are de-duplicated, here and nowhere
    else; all other files pass through.  ``latest=False`` gives all versions.
    """
    schema, parts = schemas.LAYERS[name]
    versioned = latest and any(f.name == "_version" for f in schema.fields)
    files = _wanted_files(log_of(spark, store, name).files(), name, start, end, interval_sec, key)
    files = overlapping(files) if versioned else files.withColumn("mixed", F.lit(False))
    found = files.select("path", "mixed").collect()  # names of files, as any reader lists them
    clock = time_range(_clock(name), start, end)

    def rows(mixed: bool) -> DataFrame:
        df = _read_files(spark, store, name, sorted(r["path"] for r in found if r["mixed"] == mixed))
        conditions = _partition_range(parts, start, end, F.col) + ([clock] if clock is not None else [])
        conditions += [F.col("bar_interval_sec") == int(interval_sec)] if interval_sec is not None else []
        conditions += [_key(name) == key] if key is not None else []
        for condition in conditions:
            df = df.filter(condition)
        # layout columns (dt, ym) are dropped; real columns stay
        return schemas.conform(df, schema, bare=schemas.ALWAYS_STORED)

    if not versioned:
        return rows(False)
    df = rows(False)
    if any(r["mixed"] for r in found):
        again = latest_version(rows(True), schemas.layer_keys(name))
        df = df.unionByName(again) if any(not r["mixed"] for r in found) else again
    return df.drop("_version", "_run_id")


def newest_times(spark: SparkSession, store: Store, name: str) -> DataFrame:
    """(bar_interval_sec, newest) of a bar table, from the log alone: no data file is opened."""
    files = log_of(spark, store, name).files()
    return files.groupBy(F.col("parts")["bar_interval_sec"].cast("int").alias("bar_interval_sec")).agg(F.max("last_time").alias("newest"))


def compact_layer(spark: SparkSession, store: Store, name: str, interval_sec: int | None = None) -> int:
    """Replace the files that share keys with other commits by files with their newest versions, in one commit.

    Rows that another run appends meanwhile are in other files and stay; a crash before
    the commit leaves the table as it was.  The replaced files stay on disk for readers
    that have begun, until ``vacuum``.  Returns how many files were replaced.
    """
    log = log_of(spark, store, name)
    seen = log.newest()
    files = overlapping(_wanted_files(log.files().where(F.col("seq") <= seen), name, None, None, interval_sec, None))
    old = [r[0] for r in files.where("mixed").select("path").collect()]  # file names only
    if not old:
        return 0
    newest = latest_version(_read_files(spark, store, name, sorted(old)), schemas.layer_keys(name)).drop("commit")
    ident, added = _put_files(newest, store, name, rewrite=True)
    log.commit([{**e, "commit": ident} for e in added], removed=old, seen=seen)
    if name == BARS:
        write_closes(spark, store, ident, added)
    return len(old)


def vacuum(spark: SparkSession, store: Store, name: str, keep_hours: float = 24.0) -> int:
    """Delete files that no commit holds any more (replaced, expired, or of a write that stopped) and that are older than ``keep_hours``."""
    log = log_of(spark, store, name)
    live = {r[0] for r in log.files().select("path").collect()}  # names of files
    found = log._fs().listFiles(log._hadoop(log.path("data")), True)
    limit, gone = (time.time() - 3600 * keep_hours) * 1000, []
    while found.hasNext():
        status = found.next()
        path = "data/" + status.getPath().toString().split("/data/", 1)[1]
        if path.endswith(".parquet") and path not in live and status.getModificationTime() <= limit:
            gone.append(log.path(path))
    _delete_files(spark, gone)
    return len(gone)


def _delete_files(spark: SparkSession, paths: Iterable[str]) -> None:
    """Delete files through the Hadoop FileSystem of their paths.  Needs a classic session."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(conf).delete(path, False)


# ------------------------------------------------------------------ last closes

BARS, CLOSES = "sample.bars_time", "sample.last_closes"


def write_closes(spark: SparkSession, store: Store, ident: str, added: list[dict]) -> None:
    """The last close of each symbol and month in the base bars of a commit, as rows that carry its id."""
    base = [e["path"] for e in added if e["parts"]["bar_interval_sec"] == str(schemas.BASE_INTERVAL)]
    if base:
        bars = _read_files(spark, store, BARS, base)
        last = bars.groupBy("exchange", "symbol", "ym").agg(F.max(F.struct("bar_time", "_version", "close")).alias("last"))
        rows = last.select("exchange", "symbol", "ym", "last.bar_time", "last.close", F.col("last._version").alias("_version"), F.lit(ident).alias("_run_id"))
        write_layer(rows, store, CLOSES, run_id=ident)


def last_closes(spark: SparkSession, store: Store, before) -> DataFrame:
    """(exchange, symbol, close) of each symbol's newest stored base bar before a time: one row per symbol.

    Months before that of ``before`` come from the table of last closes, its own month
    from the bars.  Months with a commit whose closes were not written (it stopped between
    the two) are read from the bars as well.
    """
    moment = parse_utc(before)
    month = moment.strftime("%Y%m")
    closes = read_layer(spark, store, CLOSES, latest=False).where(F.col("ym") < month)
    files = log_of(spark, store, BARS).files().where(F.col("parts")["bar_interval_sec"] == str(schemas.BASE_INTERVAL))
    months = files.select(F.col("parts")["ym"].alias("m"), "commit").where(F.col("m") < month).distinct()
    have = closes.select(F.col("ym").alias("m"), F.col("_run_id").alias("commit")).distinct()
    open_months = [r[0] for r in months.join(have, ["m", "commit"], "left_anti").select("m").distinct().collect()]
    paths = [r[0] for r in files.where((F.col("parts")["ym"].isin([month, *open_months])) & (F.col("first_time") < F.lit(moment))).select("path").collect()]
    bars = _read_files(spark, store, BARS, sorted(paths)).where(F.col("bar_time") < F.lit(moment))
    columns = ["exchange", "symbol", "bar_time", "_version", "close"]
    rows = closes.select(*columns).unionByName(bars.select(*columns))
    # the newest bar, in its newest version
    newest = rows.groupBy("exchange", "symbol").agg(F.max_by("close", F.struct("bar_time", "_version")).alias("close"))
    return newest.select("exchange", "symbol", "close")


def export_csv(ds: DataFrame, path: str, training_ready_only: bool = True, label_valid_only: bool = True, column_set: str = "train") -> None:
    """SNK-2: distributed CSV export of dataset rows with a header (written even for an empty result).

    By default only training-ready rows with valid labels, in the ``train`` columns.
    """
    ds = dataset_select(ds, training_ready_only, label_valid_only, column_set)
    ds.write.mode("overwrite").option("header", True).csv(path)


def retention_filter(book: DataFrame, now=None, days: int = BOOK_RETENTION_DAYS) -> DataFrame:
    """SNK-3: book snapshots younger than ``days`` relative to ``now`` (default: current time)."""
    ref = F.current_timestamp() if now is None else F.lit(now).cast("timestamp")
    return book.filter(F.col("timestamp") >= ref - F.expr(f"INTERVAL {int(days)} DAYS"))


def drop_expired_partitions(spark: SparkSession, store: Store, name: str = "raw.book_topk_raw", now=None, days: int = BOOK_RETENTION_DAYS) -> list[str]:
    """SNK-3 at scale: drop whole days older than ``now - days`` in one commit, then their files.

    Retention never rewrites data.  Returns the dropped days.
    """
    ref = (now if isinstance(now, datetime) else datetime.fromisoformat(str(now).replace("Z", "+00:00"))) if now else datetime.now(timezone.utc)
    cutoff: date = (ref - timedelta(days=days)).date()
    log = log_of(spark, store, name)
    seen = log.newest()
    old = log.files().where(F.col("seq") <= seen).where(F.col("parts")["dt"] < cutoff.isoformat()).select("path", F.col("parts")["dt"].alias("dt")).collect()
    if old:
        log.commit(removed=[r["path"] for r in old], seen=seen)
        _delete_files(spark, [log.path(r["path"]) for r in old])
    return sorted({r["dt"] for r in old})


def land_raw(frames: dict[str, DataFrame], store: Store) -> dict[str, int]:
    """Append raw frames to the raw layer, partitioned by event day."""
    return {channel: write_layer(df, store, RAW_TABLES[channel]) for channel, df in frames.items()}
