"""Importance resampling towards a target distribution, by prefix CRCs (operator 12).

Features of a text are its runs of 1 to 3 words, hashed into ``BUCKETS`` by the
CRC-32 of their bytes.  A text is normalised (words, one space between two) and
scanned once for its running CRCs; the CRC of any run of words comes from the
registers at its two ends (``running_crc``), so no feature is ever put together.

A bucket's gain is the floored log ratio (in thousandths) of its share in the
target and in the corpus, with one added to each count.  A document's weight is the
sum over its features, its score adds Gumbel noise from a hash of its id, and the
greatest scores are drawn: that is sampling without replacement in proportion to
exp(weight / 1000).

Scale: both passes over the corpus are map-only; a task sends its counts of the
buckets, and only the 10,000 gains go through the driver.  Ranks come from a range
partition of (score, id): the driver sees one count per partition, and partitions
beyond the draw are not sorted.

Edge cases: a null or empty text has no feature and weight 0.  A null ``doc_id`` has
no noise: its score is null, it is never drawn and doesn't count in N.  Rows that
repeat a ``doc_id`` are judged each by its own text (equal scores of one id: any order).
An empty corpus gives no rows; an empty target gives gains from its added ones alone.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewick.llm.common import shuffle_partitions, stored
from candlewick.llm.running_crc import RunningCrc
from candlewick.llm.shingles import text_batches

BUCKETS = 10_000
RUN = 3
PERCENT, LEAST_WORDS = 5, 20
SEED = "42:"
_TABLE: list = []


def _letters():
    """What each byte is in a normalised text: 0 where it separates words."""
    import numpy as np

    if not _TABLE:
        table = np.arange(256, dtype=np.uint8)
        table[65:91] += 32
        for first, last in ((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F)):
            table[first : last + 1] = 0
        _TABLE.append(table)
    return _TABLE[0]


def feature_buckets(texts: list[bytes], buckets: int = BUCKETS, run: int = RUN) -> tuple:
    """(words of each text, and for each feature of all texts its text's index and its bucket)."""
    import numpy as np

    joined = _letters()[np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)]
    word = joined > 0
    edge = np.diff(np.concatenate((np.zeros(1, bool), word)).view(np.int8))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    offset = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=offset[1:])
    first = np.searchsorted(start, offset)
    # the words with one space after each
    keep = word.copy()
    keep[end] = True
    normal = joined[keep]
    normal[normal == 0] = 32
    length = end - start
    before = np.cumsum(length + 1) - (length + 1)
    crc = RunningCrc(normal)
    at_start, at_end = crc.at(before), crc.at(before + length)
    of = np.repeat(np.arange(len(texts)), np.diff(first))
    found = []
    for k in range(min(run, len(start))):
        n = len(start) - k
        same = np.flatnonzero(of[:n] == of[k:])
        size = before[same + k] + length[same + k] - before[same]
        found.append((of[same], crc.between(at_start[same], at_end[same + k], size) % np.uint32(buckets)))
    owner = np.concatenate([f[0] for f in found]) if found else np.zeros(0, np.int64)
    bucket = np.concatenate([f[1] for f in found]) if found else np.zeros(0, np.uint32)
    return np.diff(first), owner, bucket


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS, run: int = RUN) -> DataFrame:
    """(bucket, n): how many features of all texts (column ``text``) fall into each bucket that has any."""

    def count(batches) -> Iterator:
        import numpy as np
        import pyarrow as pa

        total = np.zeros(buckets, np.int64)
        for (part,) in text_batches(batches, "text"):
            total += np.bincount(feature_buckets(part, buckets, run)[2], minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], names=["bucket", "n"])

    return texts.select("text").mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> list[int]:
    """The gain of every bucket, from two frames (bucket, n): at most ``buckets`` rows each."""
    import numpy as np

    s, t = np.zeros(buckets), np.zeros(buckets)
    for counts, frame in ((s, corpus), (t, target)):
        for r in frame.collect():
            counts[r["bucket"]] = r["n"]
    ratio = ((t + 1) * (s.sum() + buckets)) / ((s + 1) * (t.sum() + buckets))
    return np.floor(1000 * np.log(ratio)).astype(np.int64).tolist()


def weigh(docs: DataFrame, gains: list[int], run: int = RUN) -> DataFrame:
    """(doc_id, text_hash, n_words, n_features, weight) of every row of ``docs`` (doc_id, text)."""

    def run_batches(batches) -> Iterator:
        import numpy as np
        import pyarrow as pa

        gain = np.array(gains, np.float64)  # sums of whole numbers below 2^53 are exact
        for texts, ids, hashes in text_batches(batches, "text", "doc_id", "text_hash"):
            words, owner, bucket = feature_buckets(texts, len(gain), run)
            n = np.bincount(owner, minlength=len(texts))
            weight = np.bincount(owner, weights=gain[bucket], minlength=len(texts)).astype(np.int64)
            columns = [pa.array(ids, pa.int64()), pa.array(hashes, pa.int64()), pa.array(words.astype(np.int64)), pa.array(n), pa.array(weight)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "text_hash", "n_words", "n_features", "weight"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    return rows.mapInArrow(run_batches, "doc_id long, text_hash long, n_words long, n_features long, weight long")


def gumbel(doc_id: Column, seed: str = SEED) -> Column:
    """Floored Gumbel noise in thousandths, from the first 32 bits of the SHA-256 of seed and id."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(seed), doc_id.cast("string")).cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def ranked(rows: DataFrame, able: Column, percent: int) -> DataFrame:
    """``rows`` (doc_id, score, ...) with ``rank``: 1, 2, ... for the greatest scores of the able rows, null for those not drawn."""
    spark = rows.sparkSession
    dealt = rows.where(able).repartitionByRange(shuffle_partitions(spark), F.col("score").desc(), F.col("doc_id"))
    dealt = stored(dealt.withColumn("__part", F.spark_partition_id()), "ranges")
    sizes = dict(dealt.groupBy("__part").agg(F.count("*").alias("n")).collect())  # a row for each partition
    left = draw = percent * sum(sizes.values()) // 100
    before, offsets, last = 0, [0] * (max(sizes, default=0) + 1), -1
    for part in sorted(sizes):
        if left <= 0:
            break
        offsets[part], last = before, part
        before, left = before + sizes[part], left - sizes[part]
    drawn, first_of = dealt.where(F.col("__part") <= last), F.get(F.lit(offsets), F.col("__part"))
    place = F.row_number().over(Window.partitionBy("__part").orderBy(F.col("score").desc(), F.col("doc_id"))) + first_of
    drawn = drawn.withColumn("rank", F.when(place <= draw, place).cast("long")).select(*rows.columns, "rank")
    others = dealt.where(F.col("__part") > last).select(*rows.columns).unionByName(rows.where(~F.coalesce(able, F.lit(False))))
    return drawn.unionByName(others.withColumn("rank", F.lit(None).cast("long")))


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: str = SEED) -> DataFrame:
    """(doc_id, text_hash, n_words, n_features, weight, score, rank) of every row of ``docs``; ``target``: a frame with the column ``text``."""
    gains = bucket_gains(bucket_counts(docs), bucket_counts(target))
    rows = weigh(docs, gains).withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed))
    return ranked(stored(rows, "importance_scores"), (F.col("n_words") >= least_words) & F.col("doc_id").isNotNull(), percent)


def importance_resampling(docs: DataFrame, target: DataFrame, **parameters) -> DataFrame:
    """The drawn documents, with all their columns."""
    # id and text name a row; equal rows stay or go together
    drawn = resample(docs, target, **parameters).where(F.col("rank").isNotNull())
    drawn = drawn.select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")).distinct()
    return docs.join(drawn, (F.col("doc_id").cast("long") == F.col("__id")) & (F.xxhash64("text") == F.col("__hash")), "left_semi")
