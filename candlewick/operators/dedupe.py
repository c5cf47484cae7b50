"""DED-1: newest version per key (read-time replacement of versioned rows).

Layers are appended, never updated in place: a re-run writes the same keys
again with a higher ``_version``.  Rows are dealt by key once and the newest of
each key is kept; Spark cuts each task's rows to one per key before that
exchange.  ``plans.sinks.read_layer`` sends only those files through it whose
ranges meet files of other commits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_version(df: DataFrame, keys: list[str], version: str = "_version") -> DataFrame:
    """Keep one row with the greatest ``version`` of each key (equal versions of a key are copies of one row)."""
    newest = Window.partitionBy(*keys).orderBy(F.col(version).desc())
    return df.withColumn("__place", F.row_number().over(newest)).where(F.col("__place") == 1).drop("__place")


def latest_symbols(symbols: DataFrame) -> DataFrame:
    """``meta.symbols`` reference rows: newest ``updated_at`` per (exchange, symbol)."""
    return latest_version(symbols, ["exchange", "symbol"], version="updated_at")
