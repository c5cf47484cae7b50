"""Row-frame windows over long bar series without one task per series.

Features look back up to 61 rows and labels up to 60 rows back and 60 ahead.
A plain ``Window.partitionBy(exchange, symbol, interval)`` puts a whole series
into one task: a symbol holding a third of all bars becomes a third of the
job on one core.  ``halo_chunks`` splits every series into chunks of
``chunk_rows`` consecutive bars and copies the ``back`` rows before and the
``fwd`` rows after each chunk into it (the halo).  Windows then partition by
(series, chunk); rows are kept only in their own chunk, so every ROWS frame
within the halo sees exactly what it would see in the global window.

The row index of a bar inside its series is computed without a global sort:
bars are first grouped into time slices (``chunk_rows`` intervals wide, so a
slice never holds more than ``chunk_rows`` bars), the small per-slice count
table yields each slice's starting offset through a window over slices, and
``row_number`` inside the slice adds the local position.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_CHUNK_ROWS = 2048


@dataclass(frozen=True)
class SeriesLayout:
    """Partition columns for series windows (global or chunked)."""

    partition: tuple[str, ...]
    chunked: bool

    def window(self, order: str = "bar_time"):
        return Window.partitionBy(*self.partition).orderBy(order)


def global_layout(keys: list[str]) -> SeriesLayout:
    return SeriesLayout(tuple(keys), False)


def row_index(df: DataFrame, keys: list[str], chunk_rows: int, order: str = "bar_time", interval_col: str = "bar_interval_sec") -> DataFrame:
    """Add ``_g``: 0-based position of each bar inside its series."""
    slice_id = F.floor(F.unix_seconds(F.col(order)) / (F.col(interval_col).cast("long") * F.lit(int(chunk_rows)))).cast("long")
    sliced = df.withColumn("_ts", slice_id)
    counts = sliced.groupBy(*keys, "_ts").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_ts").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*keys, "_ts", F.coalesce(F.sum("_n").over(before), F.lit(0).cast("long")).alias("_off"))
    local = Window.partitionBy(*keys, "_ts").orderBy(order)
    return (
        sliced.hint("merge").join(offsets, [*keys, "_ts"], "inner")
        .withColumn("_g", F.col("_off") + F.row_number().over(local) - 1)
        .drop("_ts", "_off")
    )


def halo_chunks(df: DataFrame, keys: list[str], chunk_rows: int, back: int, fwd: int, order: str = "bar_time") -> tuple[DataFrame, SeriesLayout]:
    """Expand ``df`` so that windows over (keys, ``_part``) equal global windows.

    Rows get ``_own`` (True in their home chunk); callers filter on it after
    the windows.  Requires ``chunk_rows > back + fwd``.
    """
    if chunk_rows <= back + fwd:
        raise ValueError("chunk_rows must exceed the halo (back + fwd)")
    indexed = row_index(df, keys, chunk_rows, order)
    chunk = F.floor(F.col("_g") / F.lit(int(chunk_rows))).cast("long")
    pos = F.col("_g") - chunk * F.lit(int(chunk_rows))
    home = F.struct(chunk.alias("_part"), F.lit(True).alias("_own"))
    copies = [home]
    if back > 0:
        # the last ``back`` rows of a chunk are the look-back of the next chunk
        copies.append(F.when(pos >= chunk_rows - back, F.struct((chunk + 1).alias("_part"), F.lit(False).alias("_own"))))
    if fwd > 0:
        # the first ``fwd`` rows of a chunk are the look-ahead of the previous one
        copies.append(F.when((pos < fwd) & (chunk > 0), F.struct((chunk - 1).alias("_part"), F.lit(False).alias("_own"))))
    expanded = indexed.select("*", F.explode(F.filter(F.array(*copies), lambda x: x.isNotNull())).alias("_copy"))
    expanded = expanded.select(*[c for c in indexed.columns if c != "_g"], F.col("_copy._part").alias("_part"), F.col("_copy._own").alias("_own"))
    return expanded, SeriesLayout((*keys, "_part"), True)


def own_rows(df: DataFrame, layout: SeriesLayout) -> DataFrame:
    if not layout.chunked:
        return df
    return df.filter(F.col("_own")).drop("_part", "_own")


def series_frame(df: DataFrame, keys: list[str], chunk_rows: int | None, back: int, fwd: int) -> tuple[DataFrame, SeriesLayout]:
    """Global layout when ``chunk_rows`` is None, else the halo-chunked one."""
    if not chunk_rows:
        return df, global_layout(keys)
    return halo_chunks(df, keys, chunk_rows, back, fwd)
