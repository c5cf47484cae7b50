"""Small helpers that the training-data operators share."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.session import configure, shared_path

# ASCII white space as the contracts state it: the space and \t \n \v \f \r.
SPACES = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


_SHIPPED: set[str] = set()


def prepare(spark: SparkSession) -> None:
    """Session settings, and the package for the Python workers of executors that lack it."""
    configure(spark)
    # Joins of these operators grow with the corpus: only small measured sides are broadcast,
    # so that many joins don't fill the driver.
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "8MB")
    # Rows of whole texts: batches for Python are bounded by their bytes.
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "4m")
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    # Spark copies the archive from the driver to every executor.
    archive = os.path.join(tempfile.mkdtemp(prefix="package-"), "package.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for top, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(top, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(package)))
    context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z, all else unchanged; ``lower`` does the same on pure ASCII and is faster."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def folder(spark: SparkSession, tag: str) -> str:
    """A new folder under the shared checkpoint folder."""
    return shared_path(spark, "llm", tag, unique=True)


def stored(frame: DataFrame, tag: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: cuts the lineage, survives lost executors."""
    spark = frame.sparkSession
    path = folder(spark, tag)
    frame.write.option("compression", "zstd").parquet(path)
    kept = spark.read.schema(frame.schema).parquet(path)
    kept.folder = path
    return kept


def discard(*frames: DataFrame) -> None:
    """Delete the folders of ``stored`` tables that nothing reads any more."""
    for frame in frames:
        context = frame.sparkSession.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(frame.folder)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Inside, an action's shuffle files go when it ends, not when the driver happens to collect its garbage; what is read again must be ``stored``."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


# Ids that a broadcast may hold (16 MB); more go through a shuffle.
BROADCAST_IDS = 1_000_000


def texts_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, text) of the documents whose id is in ``ids`` (a stored table with the column id).

    The ids are counted first: few are broadcast, so that the texts of all other
    documents stay out of a shuffle; otherwise both sides are shuffled.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), "text")
    few = ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    return texts.join(F.broadcast(ids) if few else ids, "id", "left_semi")


def node_texts(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, text) for ``nodes`` (stored: node, doc_id, text_hash), each one text of its document."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    few = nodes.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    return texts.join(F.broadcast(nodes) if few else nodes, ["doc_id", "text_hash"]).dropDuplicates(["node"]).select("node", "text")
