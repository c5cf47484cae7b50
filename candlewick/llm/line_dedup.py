"""Line de-duplication (operator 3), with DataFrame functions only.

1. Each document's text is split into lines; keys of at least ``min_chars``
   become occurrences (128-bit key hash, document, position).
2. Occurrences are range-partitioned by (hash, slice of the document) and
   sorted by document (descending) and position.  One pass over the sorted rows
   marks the first occurrence in each document; the first of all belongs to the
   largest document.  A slice is a hash of the document, so that a line which
   a third of the corpus shares spreads over all tasks.
3. The slices' counts are added up; the keys found in ``min_docs`` documents
   go back to their occurrences by (hash, slice).  Dropped positions become a
   compressed bitmap for each document: only its non-zero 64-bit words.  The
   text never enters a shuffle before the last step, where the bitmaps meet it.

Edge cases: a null or empty text is one empty line and stays as it is.  Rows
with a null ``doc_id`` count as one document, below all others.  Rows that
share a ``doc_id`` are one document: they count once for a key, and the rows
of the largest id keep it.  All other columns pass through unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewick.llm.common import SPACES, lower_ascii, shuffle_partitions, stored

MIN_CHARS = 40
MIN_DOCS = 5
NO_ID = -(2**63)
# Columns that the operator adds while it works; the tables' own names can't clash with them.
_DOC, _HASH, _WORDS, _LINES, _TEXT, _GONE = (f"__ld_{c}" for c in ("doc", "text_hash", "words", "lines", "text", "gone"))


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return lower_ascii(F.trim(line, F.lit(SPACES)))


def occurrences(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(h1, h2, doc, text_hash, pos) for every line whose key has ``min_chars`` code points."""
    rows = docs.select(
        F.coalesce(F.col("doc_id"), F.lit(NO_ID)).alias("doc"),
        F.xxhash64("text").alias("text_hash"),
        F.posexplode(lines_of(F.col("text"))).alias("pos", "line"),
    )
    # Leading and trailing blanks only shorten a line, so a short line needs no key.
    key = line_key(F.col("line"))
    rows = rows.where(F.length("line") >= min_chars).select("doc", "text_hash", "pos", key.alias("key"))
    rows = rows.where(F.length("key") >= min_chars)
    return rows.select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), F.col("key")).alias("h2"), "doc", "text_hash", "pos")


def dropped_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """Compressed bitmaps (doc, text_hash, words map<word index, 64 bits>) of the lines to drop."""
    n = shuffle_partitions(docs.sparkSession)
    slices = 4 * n
    occ = occurrences(docs, min_chars).withColumn("slice", F.pmod(F.xxhash64("doc"), F.lit(slices)).cast("int"))
    occ = stored(occ, "line_occurrences")  # the texts are read and cut once, not for each use
    occ = occ.repartitionByRange(n, "h1", "h2", "slice")
    stream = Window.partitionBy("h1", "h2", "slice").orderBy(F.col("doc").desc(), "pos")
    marked = occ.withColumn("first", F.coalesce(F.lag("doc").over(stream) != F.col("doc"), F.lit(True)))
    by_slice = marked.groupBy("h1", "h2", "slice").agg(F.sum(F.col("first").cast("long")).alias("docs"), F.max("doc").alias("top"))
    total = by_slice.groupBy("h1", "h2").agg(F.sum("docs").alias("docs"), F.max("top").alias("keeper"))
    total = total.where(F.col("docs") >= min_docs).drop("docs")
    targets = by_slice.select("h1", "h2", "slice").join(total, ["h1", "h2"])
    gone = occ.join(targets, ["h1", "h2", "slice"]).where(F.col("doc") != F.col("keeper"))
    word = (F.col("pos") / 64).cast("int")
    gone = gone.select("doc", "text_hash", word.alias("word"), F.expr("shiftleft(1L, pos % 64)").alias("bit"))
    words = gone.groupBy("doc", "text_hash", "word").agg(F.bit_or("bit").alias("bits"))
    return words.groupBy("doc", "text_hash").agg(F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias("words"))


def _kept(docs: DataFrame, min_chars: int, min_docs: int) -> DataFrame:
    """``docs`` plus the lines, the kept text and the number of dropped lines."""
    gone = dropped_lines(docs, min_chars, min_docs)
    gone = gone.select(F.col("doc").alias(_DOC), F.col("text_hash").alias(_HASH), F.col("words").alias(_WORDS))
    left = docs.withColumns({_DOC: F.coalesce(F.col("doc_id"), F.lit(NO_ID)), _HASH: F.xxhash64("text")})
    rows = left.join(gone, [_DOC, _HASH], "left").withColumn(_LINES, lines_of(F.col("text")))
    # The bitmap as an array: a line's bit is found by its index.
    last = F.array_max(F.map_keys(_WORDS))
    dense = F.transform(F.sequence(F.lit(0), last), lambda w: F.coalesce(F.try_element_at(F.col(_WORDS), w), F.lit(0).cast("long")))
    rows = rows.withColumn(_WORDS, F.when(F.col(_WORDS).isNotNull(), dense))

    def stays(_line: Column, i: Column) -> Column:
        bits = F.get(F.col(_WORDS), (i / 64).cast("int"))
        return F.coalesce(F.getbit(bits, (i % 64).cast("int")), F.lit(0)) == 0

    kept = F.filter(F.col(_LINES), stays)
    return rows.withColumns(
        {
            _TEXT: F.when(F.col(_WORDS).isNull(), F.coalesce(F.col("text"), F.lit(""))).otherwise(F.array_join(kept, "\n")),
            _GONE: F.coalesce(F.aggregate(F.col(_WORDS), F.lit(0).cast("long"), lambda a, w: a + F.bit_count(w)), F.lit(0).cast("long")),
        }
    )


def kept_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept_text) for every row."""
    rows = _kept(docs.select("doc_id", "text"), min_chars, min_docs)
    return rows.select("doc_id", F.size(_LINES).cast("long").alias("n_lines"), F.col(_GONE).alias("n_dropped"), F.col(_TEXT).alias("kept_text"))


def line_dedup(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """The documents without their repeated lines; n_chars, where it exists, follows the new text.

    A text that loses no line stays as it is, null included.
    """
    rows = _kept(docs, min_chars, min_docs)
    new = {"text": F.when(F.col(_GONE) > 0, F.col(_TEXT)).otherwise(F.col("text"))}
    if "n_chars" in docs.columns:
        length = F.length(_TEXT).cast(docs.schema["n_chars"].dataType)
        new["n_chars"] = F.when(F.col(_GONE) > 0, length).otherwise(F.col("n_chars"))
    return rows.withColumns(new).select(*docs.columns)
