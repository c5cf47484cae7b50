"""Near-duplicate documents by fast similarity sketches (operator 2).

Sketch: a document's set is its distinct 5-word shingles.  In round i every
element takes a hashed bin and a hashed value; a bin keeps the least value of
the first round that reaches it.  Rounds t .. 2t - 1 put all elements into bin
i - t, so every coordinate fills; the coordinates agree with probability equal
to the similarity, with concentration bounds.

Candidates: ``BANDS`` bands of ``ROWS`` coordinates.  A pair at similarity 0.75
shares no band with probability (1 - 0.75^4)^32 = 5e-6.  Candidates are
confirmed on the full shingle sets.

Skew: documents with equal sets are one class from the start.  In a bucket each
member is compared with the bucket's smallest one first.  Buckets whose members
then lie in one component need no more; in the others the members outside the
largest component are compared with all of other components, in blocks of
bounded size inside the tasks.  So a large group of copies costs pairs in
proportion to its size, pairs are never rows, and a link is only skipped when
its ends are connected already.

Edge cases: a text without words (null, empty, blank) has an empty set and links
with nothing; one with fewer than five words is one shingle.  A null ``doc_id``
links with nothing and gets a null component; it is kept.  Rows that repeat a
``doc_id`` are judged each by its own text: a vertex is a class of equal sets, and the
removal goes by id and text.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm.common import node_texts, shuffle_partitions, stored
from candlewick.llm.components import components, lowest_ids, with_nodes
from candlewick.llm.shingles import WORDS, mix, shingle_sets, text_batches
from candlewick.llm.tokens import rows_of

BANDS, ROWS = 32, 4
PERCENT = 75
BLOCK = 512
SKETCH = "doc_id long, text_hash long, n_shingles long, s1 long, s2 long, bands array<long>"


def sketches(sets: list, t: int):
    """The sketch of each non-empty set of hashes, as a matrix with ``t`` columns."""
    import numpy as np

    out = np.zeros((len(sets), t), np.uint64)
    empty = np.ones((len(sets), t), bool)
    of = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    items = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    least = np.empty(len(sets) * t, np.uint64)
    for i in range(2 * t):
        h = mix(items ^ mix(np.array([i + 1], np.uint64)))
        bins = (((h >> np.uint64(32)) * np.uint64(t)) >> np.uint64(32)).astype(np.int64) if i < t else np.full(len(items), i - t)
        cell = of * t + bins
        free = empty.ravel()[cell]
        cell, h = cell[free], mix(h[free])
        least[cell] = np.uint64(2**64 - 1)
        np.minimum.at(least, cell, h)
        out.ravel()[cell] = least[cell]
        empty.ravel()[cell] = False
        open_ = empty.any(axis=1)
        left = open_[of]
        of, items = of[left], items[left]
        if not len(items):
            break
    return out


def band_keys(sketch, bands: int, rows: int):
    """One 64-bit key for each band: its number and its coordinates."""
    import numpy as np

    part = sketch.reshape(len(sketch), bands, rows)
    h = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), (len(sketch), bands))
    for r in range(rows):
        h = mix((h ^ part[:, :, r]) * np.uint64(0x9E3779B97F4A7C15))
    return h.view(np.int64)


def sketch_documents(docs: DataFrame, bands: int = BANDS, rows: int = ROWS, words: int = WORDS) -> DataFrame:
    """One row per document: set size, 128-bit hash of the set, band keys (``SKETCH``)."""

    def run(batches) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for texts, ids, text_hashes in text_batches(batches, "text", "doc_id", "text_hash"):
            sets = list(shingle_sets(texts, words))
            full = [s for s in sets if len(s)]
            keys = band_keys(sketches(full, bands * rows), bands, rows) if full else np.zeros((0, bands), np.int64)
            n = np.array([len(s) for s in sets], np.int64)
            s1, s2 = (np.array([int(np.add.reduce(mix(s ^ np.uint64(seed)))) if len(s) else 0 for s in sets], np.uint64).view(np.int64) for seed in (0, 0x5851F42D4C957F2D))
            offsets = np.concatenate((np.zeros(1, np.int32), np.cumsum(np.where(n > 0, bands, 0)))).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys.ravel()))
            columns = [pa.array(ids, pa.int64()), pa.array(text_hashes, pa.int64()), pa.array(n), pa.array(s1), pa.array(s2), lists]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "text_hash", "n_shingles", "s1", "s2", "bands"])

    rows_in = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    return stored(rows_in.mapInArrow(run, SKETCH), "minhash_sketches")


def confirm(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, percent: int = PERCENT, words: int = WORDS) -> DataFrame:
    """The pairs (a, b) of ``nodes`` (node, doc_id, text_hash) whose full shingle sets are similar enough."""
    wanted = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    texts = stored(node_texts(docs, stored(nodes.join(wanted, "node"), "pair_nodes")), "pair_texts")
    rows = pairs.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
    rows = rows.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")

    def run(batches) -> Iterator:
        import numpy as np
        import pyarrow as pa

        last: tuple = (None, None)
        for text_b, text_a, a, b in text_batches(batches, "text_b", "text_a", "a", "b", size=1_000_000):
            good = []
            for k, other in enumerate(shingle_sets(text_b, words)):
                if last[0] != text_a[k]:  # the join brings equal texts one after another
                    last = (text_a[k], next(shingle_sets([(text_a[k] or "").encode()], words)))
                own = last[1]
                if not len(own) or not len(other) or 100 * min(len(own), len(other)) < percent * max(len(own), len(other)):
                    good.append(False)
                    continue
                both = np.sort(np.concatenate((own, other)))
                shared = int((both[1:] == both[:-1]).sum())
                good.append(100 * shared >= percent * (len(own) + len(other) - shared))
            keep = pa.array(good)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()).filter(keep), pa.array(b, pa.int64()).filter(keep)], names=["a", "b"])

    return stored(rows.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long").distinct(), "links")


def across_components(members: DataFrame, roots: DataFrame, leaders: DataFrame, docs: DataFrame, percent: int, words: int, block: int) -> DataFrame:
    """Links (a, b) between members of one bucket that lie in different components.

    Only the members outside a bucket's largest component are compared with the
    others; a block holds up to ``block`` of them and as many others.
    """
    spark = docs.sparkSession
    labelled = members.join(roots, F.col("id") == F.col("vertex"), "left").select("key", "id", F.coalesce("root", "id").alias("root"))
    by_root = labelled.groupBy("key", "root").agg(F.count("*").alias("c"))
    mains = by_root.groupBy("key").agg(F.max_by("root", "c").alias("main"), F.max("c").alias("most"), F.sum("c").alias("size"), F.count("*").alias("kinds"))
    mains = mains.where(F.col("kinds") > 1).withColumn("outer", F.ceil((F.col("size") - F.col("most")) / block)).withColumn("inner", F.ceil(F.col("size") / block))
    mixed = labelled.join(mains, "key").withColumn("out", F.col("root") != F.col("main"))
    number = lambda of: F.explode(F.sequence(F.lit(0).cast("long"), F.col(of) - 1))
    here = mixed.select("key", "id", "root", "out", F.lit(0).alias("side"), number("outer").alias("o"), F.pmod(F.xxhash64("id"), F.col("inner")).alias("i"))
    there = mixed.where("out").select("key", "id", "root", "out", F.lit(1).alias("side"), F.pmod(F.xxhash64("id"), F.col("outer")).alias("o"), number("inner").alias("i"))
    places = stored(here.unionByName(there), "mixed_buckets")
    mixed_nodes = leaders.join(places.select(F.col("id").alias("node")).distinct(), "node")
    texts = node_texts(docs, stored(mixed_nodes.select("node", "doc_id", "text_hash"), "mixed_nodes"))
    texts = texts.join(mixed_nodes.select("node", "bands"), "node").withColumnRenamed("node", "id")
    rows = places.join(texts, "id")
    rows = rows.repartition(shuffle_partitions(spark), "key", "o", "i").sortWithinPartitions("key", "o", "i", "side", "id")

    def run(batches) -> Iterator:
        import pyarrow as pa

        found: list[tuple[int, int]] = []
        held, at = [], None

        def batch_of():
            a, b = zip(*found, strict=True) if found else ((), ())
            made = pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])
            found.clear()
            return made

        for key, o, i, *row in rows_of(batches, "key", "o", "i", "side", "id", "root", "out", "bands", "text"):
            if (key, o, i) != at:
                if held:
                    found.extend(links_of_block(held, at[0], percent, words))
                held, at = [], (key, o, i)
            held.append(row)
        if held:
            found.extend(links_of_block(held, at[0], percent, words))
        yield batch_of()

    return stored(rows.select("key", "o", "i", "side", "id", "root", "out", "bands", "text").mapInArrow(run, "a long, b long").distinct(), "links")


def links_of_block(rows: list, key: int, percent: int, words: int) -> list[tuple[int, int]]:
    """Links that connect different components, between the rows of side 1 and those of side 0; pairs that share an earlier band are left to it."""
    import numpy as np

    here = [r for r in rows if r[0] == 0]
    ids, bands = np.array([r[1] for r in here], np.int64), np.array([r[4] for r in here], np.int64)
    out = np.array([r[3] for r in here], bool)
    sets = list(shingle_sets([(r[5] or "").encode() for r in here], words))
    sizes = np.array([len(s) for s in sets], np.int64)
    every, start = np.concatenate(sets) if sets else np.zeros(0, np.uint64), np.cumsum(sizes) - sizes
    label = {r[2]: r[2] for r in rows}

    def find(x):
        while label[x] != x:
            label[x] = x = label[label[x]]
        return x

    found = []
    for side, own, root, _, keys, text in rows:
        if not side or not here:
            continue
        mine = next(shingle_sets([(text or "").encode()], words))
        n = len(mine)
        keys = np.array(keys, np.int64)
        band = int(np.flatnonzero(keys == key)[0])
        open_ = (ids != own) & ~(out & (ids < own)) & (100 * np.minimum(n, sizes) >= percent * np.maximum(n, sizes))
        open_ &= ~(bands[:, :band] == keys[:band]).any(axis=1)
        now = find(root)
        open_ &= np.array([find(r[2]) != now for r in here], bool)
        near = np.flatnonzero(open_)
        if not len(near):
            continue
        items = every if len(near) == len(here) else np.concatenate([sets[k] for k in near])
        first = start if len(near) == len(here) else np.cumsum(sizes[near]) - sizes[near]
        place = np.minimum(np.searchsorted(mine, items), n - 1)
        shared = np.add.reduceat((mine[place] == items).astype(np.int64), first)
        for k in near[100 * shared >= percent * (n + sizes[near] - shared)]:
            if find(here[k][2]) != find(root):
                label[find(here[k][2])] = find(root)
                found.append((own, int(ids[k])))
    return found


def near_duplicates(docs: DataFrame, bands: int = BANDS, rows: int = ROWS, percent: int = PERCENT, words: int = WORDS, block: int = BLOCK) -> DataFrame:
    """(doc_id, text_hash, n_shingles, class_id, component_id, kept) for every row of ``docs`` (doc_id, text)."""
    sketch = sketch_documents(docs, bands, rows, words)
    able = sketch.where((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    keys = ["s1", "s2", "n_shingles"]
    # A class: equal sets; its smallest document, and one text of that document with this set.
    classes = able.groupBy(*keys).agg(F.min("doc_id").alias("class_id"), F.min_by("text_hash", "doc_id").alias("text_hash"))
    classes, renamed = with_nodes(stored(classes, "minhash_classes"), keys, "class_id")
    # One sketch for each class: that of its smallest document.
    chosen = classes.select(*keys, F.col("class_id").alias("doc_id"), "text_hash", "node")
    leaders = stored(able.join(chosen, [*keys, "doc_id", "text_hash"]).dropDuplicates(["node"]), "minhash_leaders")
    members = leaders.select(F.col("node").alias("id"), F.col("n_shingles").alias("n"), F.explode("bands").alias("key"))
    sizes = members.groupBy("key").agg(F.count("*").alias("size"), F.min("id").alias("top"))
    members = members.join(sizes.where(F.col("size") > 1).drop("size"), "key")
    members = stored(members, "minhash_buckets")

    tops = leaders.select(F.col("node").alias("top"), F.col("n_shingles").alias("n_top"))
    close = 100 * F.least("n", "n_top") >= percent * F.greatest("n", "n_top")
    pairs = members.where(F.col("id") != F.col("top")).select("top", "id", "n").distinct().join(tops, "top").where(close)
    nodes = leaders.select("node", "doc_id", "text_hash")
    links = confirm(stored(pairs.select(F.col("top").alias("a"), F.col("id").alias("b")), "pairs"), nodes, docs, percent, words)
    near = components(links)
    more = across_components(members, near, leaders, docs, percent, words, block)
    # the stars found so far stand for their links
    roots = components(near.select(F.col("vertex").alias("a"), F.col("root").alias("b")).unionByName(more))

    found = lowest_ids(classes, roots, "class_id", renamed).select(*keys, "class_id", F.col("lowest").alias("component_id"))
    named = sketch.select("doc_id", "text_hash", *keys).join(found, keys, "left")
    for name in ("class_id", "component_id"):  # sets without words stand alone
        named = named.withColumn(name, F.when(F.col("doc_id").isNotNull(), F.coalesce(name, "doc_id")))
    return named.select("doc_id", "text_hash", "n_shingles", "class_id", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def minhash_dedup(docs: DataFrame, **parameters) -> DataFrame:
    """The documents that stay: one of each group, with all columns.  Rows are judged and removed by id and text."""
    gone = near_duplicates(docs.select("doc_id", "text"), **parameters).where(~F.col("kept"))
    gone = gone.select(F.col("doc_id").alias("__gone"), F.col("text_hash").alias("__hash")).distinct()
    return docs.join(gone, (F.col("doc_id").cast("long") == F.col("__gone")) & (F.xxhash64("text") == F.col("__hash")), "left_anti")
