"""Benchmark decontamination (operator 5).

Words are runs of letters and digits (ASCII punctuation and white space
separate them, A-Z in lower case); shingles are five words with their counts.

For every document, windows of an item's size that hold a shingle of an item of
that size are fingerprinted: a 64-bit SimHash from prefix sums over the shingles.
Items of the size within ``RADIUS`` bits are found by a multi-index: the fingerprint
is cut into ``BLOCKS`` blocks, and two fingerprints within the radius differ by at most
RADIUS / BLOCKS bits in one of them, so looking up each block with its near
values finds all of them.  The exact weighted similarity of the shingle counts
(sum of minima over sum of maxima) decides; the best window of each document
and item is returned, the first of equally good ones.  A window without any item's
shingle has similarity zero, so it needs no fingerprint.

At similarity 0.75 the fingerprints of two equally long windows differ by 11
bits on average with a deviation of 3, so a radius of 23 is four deviations wide;
``tests/llm`` measures the share of similar windows within it by item length (none of
12,000 was missed, from 7 to 400 words).  At such a radius the blocks select
little; item sizes and the shingle test in front of them do.

Memory: fingerprints come in slices of ``SLICE`` windows, from sums that are kept at
the windows' ends alone; the shared counts of an item's windows come from one pass
over the positions of its shingles.  Both are linear in text and item.

Scale: the documents stay where they are read (no shuffle).  The benchmark is the query
set: blocks of at most ``MAX_BYTES`` of text (or one longer item) are written to the
shared folder, and each passes over the documents, read by the tasks; about 14 bytes
of a worker's memory for each byte of a block.  The driver sees their number alone.

Edge cases: a text without words leaks nothing, and an item without words is
never found; items of fewer than five words are one shingle of their length;
repeated items and documents are each reported; a null id is reported as null.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm.common import folder
from candlewick.llm.shared_files import list_files, open_input
from candlewick.llm.shingles import WORDS, HashArray, mix, ngram_hashes, text_batches, word_hashes

SIMILARITY = 0.75
BITS, BLOCKS, RADIUS = 64, 8, 23
MAX_BYTES, SLICE = 8_000_000, 20_000
LEAK = "doc_id long, item_id long, start_word long, n_words long, similarity double"


def fingerprints(hashes, start, stop):
    """SimHash of the shingles ``start[i]`` .. ``stop[i] - 1`` for each i."""
    import numpy as np

    places, which = np.unique(np.concatenate((start, stop)), return_inverse=True)
    sums, total, done = np.empty((len(places), BITS), np.int32), np.zeros(BITS, np.int32), 0
    low = int(places[0]) if len(places) else 0
    for first in range(low, int(places[-1]) + 1 if len(places) else 0, SLICE):
        last = min(first + SLICE, int(places[-1]) + 1)
        # running sums before each shingle of the slice, and after its last one
        bits = np.unpackbits(mix(hashes[first:last]).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        running = np.zeros((last - first + 1, BITS), np.int32)
        np.cumsum(bits.astype(np.int8) * np.int8(2) - np.int8(1), axis=0, dtype=np.int32, out=running[1 : len(bits) + 1])
        here = int(np.searchsorted(places, last))
        sums[done:here] = running[places[done:here] - first] + total
        total, done = total + running[len(bits)], here
    positive = sums[which[len(start) :]] - sums[which[: len(start)]] > 0
    return np.packbits(positive, axis=1, bitorder="little").view(np.uint64).ravel()


class MultiIndex:
    """All fingerprints within a radius, by blocks."""

    def __init__(self, prints, radius: int = RADIUS, blocks: int = BLOCKS):
        import numpy as np

        self.prints, self.radius, self.blocks, self.width = prints, radius, blocks, BITS // blocks
        self.near = np.array([v for v in range(1 << self.width) if v.bit_count() <= radius // blocks], np.int64)
        self.tables = []
        for b in range(blocks):
            value = self._block(prints, b)
            order = np.argsort(value, kind="stable")
            first = np.searchsorted(value[order], np.arange((1 << self.width) + 1))
            self.tables.append((order, first))

    def _block(self, prints, b: int):
        import numpy as np

        return ((prints >> np.uint64(b * self.width)) & np.uint64((1 << self.width) - 1)).astype(np.int64)

    def search(self, wanted):
        """(index into wanted, index into the fingerprints) of every pair within the radius."""
        import numpy as np

        found = []
        for b, (order, first) in enumerate(self.tables):
            value = (self._block(wanted, b)[:, None] ^ self.near).ravel()
            of = np.repeat(np.arange(len(wanted)), len(self.near))
            count = first[value + 1] - first[value]
            at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first[value], count)
            rows, items = np.repeat(of, count), order[at]
            good = np.bitwise_count(wanted[rows] ^ self.prints[items]) <= self.radius
            found.append(rows[good] * len(self.prints) + items[good])
        pairs = np.unique(np.concatenate(found))
        return pairs // len(self.prints), pairs % len(self.prints)


class Benchmark:
    """The items of one shingle length, ready for search in a task."""

    def __init__(self, ids: list, lists: list, words: int):
        import numpy as np

        self.ids, self.words = ids, words
        self.sizes = np.array([len(x) for x in lists], np.int64)  # in shingles
        every, ends = np.concatenate(lists), np.cumsum(self.sizes)
        self.first = ends - self.sizes
        prints = fingerprints(every, self.first, ends)
        # an index of the items of each size
        self.items = {int(m): np.flatnonzero(self.sizes == m) for m in np.unique(self.sizes)}
        self.index = {m: MultiIndex(prints[k]) for m, k in self.items.items()}
        self.shingles, which = np.unique(every, return_inverse=True)
        self.which = which.astype(np.int32)
        self.by_shingle = HashArray(self.shingles)
        # the sizes of the items that hold each shingle
        wide = int(self.sizes.max()) + 1
        pairs = np.unique(which.astype(np.int64) * wide + np.repeat(self.sizes, self.sizes))
        self.held_sizes = pairs % wide
        self.held_first = np.searchsorted(pairs // wide, np.arange(len(self.shingles) + 1))

    def windows(self, found) -> Iterator[tuple]:
        """(item size, starts of the windows of that size that hold a shingle of such an item)."""
        import numpy as np

        at = np.flatnonzero(found >= 0)
        held, inverse = np.unique(found[at], return_inverse=True)
        count = self.held_first[held + 1] - self.held_first[held]
        of = np.repeat(np.arange(len(held)), count)
        sizes = self.held_sizes[np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(self.held_first[held], count)]
        for m in np.unique(sizes).tolist():
            mine = np.zeros(len(held), bool)
            mine[of[sizes == m]] = True
            p = at[mine[inverse]]
            edge = np.zeros(len(found) + 1, np.int64)
            np.add.at(edge, np.maximum(p - m + 1, 0), 1)
            np.add.at(edge, p + 1, -1)
            yield m, np.flatnonzero(np.cumsum(edge[:-1]) > 0)

    def shared(self, k: int, found, start):
        """For each start, the sum of minima of the counts of item ``k`` and of its window of the document."""
        import numpy as np

        m = int(self.sizes[k])
        own, count = np.unique(self.which[self.first[k] : self.first[k] + m], return_counts=True)
        at = np.flatnonzero(found >= 0)
        slot = np.minimum(np.searchsorted(own, found[at]), len(own) - 1)
        good = own[slot] == found[at]
        at, slot = at[good], slot[good]
        # an occurrence counts in windows that hold fewer than the item's count of the ones before it
        order = np.argsort(slot, kind="stable")
        p, c = at[order], count[slot[order]]
        rank = np.arange(len(p)) - np.searchsorted(slot[order], slot[order])
        earlier = np.where(rank >= c, p[np.maximum(np.arange(len(p)) - c, 0)], -1)
        edge = np.zeros(len(found) + 1, np.int64)
        np.add.at(edge, np.maximum(earlier + 1, p - m + 1), 1)
        np.add.at(edge, p + 1, -1)
        return np.cumsum(edge)[start]

    def search(self, hashes, found) -> Iterator[tuple]:
        """(item, start, words, similarity): the best window of each leaked item in a document's shingles."""
        import numpy as np

        best: dict[int, tuple] = {}
        for m, starts in self.windows(found):
            group = starts // SLICE
            for g in np.unique(group):
                start = starts[group == g]
                stop = np.minimum(start + m, len(hashes))
                rows, near = self.index[m].search(fingerprints(hashes, start, stop))
                for j in np.unique(near).tolist():
                    k, mine = int(self.items[m][j]), rows[near == j]
                    shared = self.shared(k, found, start[mine])
                    size = stop[mine] - start[mine]
                    similarity = shared / (m + size - shared)
                    top = int(similarity.argmax())
                    if similarity[top] >= SIMILARITY and (k not in best or similarity[top] > best[k][2]):
                        best[k] = (int(start[mine[top]]), int(size[top]) + self.words - 1, float(similarity[top]))
        for k, (a, n, similarity) in sorted(best.items()):
            yield self.ids[k], a, n, similarity


def prepare_items(rows: list[tuple]) -> list[Benchmark]:
    """One ``Benchmark`` for each shingle length that occurs."""
    words, first, _, _ = word_hashes([(t or "").encode() for _, t in rows], plain=True)
    by_length: dict[int, tuple[list, list]] = {}
    for k, (item, _) in enumerate(rows):
        own = words[first[k] : first[k + 1]]
        if len(own):
            ids, lists = by_length.setdefault(min(WORDS, len(own)), ([], []))
            ids.append(item)
            lists.append(ngram_hashes(own, min(WORDS, len(own))))
    return [Benchmark(ids, lists, k) for k, (ids, lists) in sorted(by_length.items())]


def find_leaks(texts: list[bytes], items: list[Benchmark]) -> Iterator[tuple]:
    """(text's number, item, start word, words, similarity) for the texts of one batch."""
    import numpy as np

    words, first, _, _ = word_hashes(texts, plain=True)
    for group in items:
        runs = ngram_hashes(words, group.words)
        found = group.by_shingle.find(runs)
        at = np.flatnonzero(found >= 0)
        text = np.searchsorted(first, at, "right") - 1
        inside = at + group.words <= first[text + 1]  # not across two texts
        for k in np.unique(text[inside]).tolist():
            own = slice(int(first[k]), int(first[k + 1]) - group.words + 1)
            for leak in group.search(runs[own], found[own]):
                yield (k, *leak)


def item_blocks(benchmark: DataFrame, max_bytes: int = MAX_BYTES) -> list[str]:
    """Folders with the benchmark's blocks, written by tasks; only their names come to the driver."""
    spark = benchmark.sparkSession
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = 1 + size // max_bytes
    path = folder(spark, "benchmark")
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)).alias("block")
    rows.select("item_id", "text", part).repartition("block").write.partitionBy("block").parquet(path)
    return [f"{path}/block={k}" for k in range(blocks)]


def read_block(path: str) -> list[tuple]:
    import pyarrow.parquet as pq

    rows = []
    for file in list_files(path):
        if file.endswith(".parquet"):
            with open_input(file) as source:
                found = pq.read_table(source)
                rows += zip(found["item_id"].to_pylist(), found["text"].to_pylist(), strict=True)
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))


def leaks(docs: DataFrame, benchmark: DataFrame, max_bytes: int = MAX_BYTES) -> DataFrame:
    """One row per document and item that it holds (``LEAK``)."""

    def over(block: str):
        def run(batches) -> Iterator:
            import pyarrow as pa

            items = prepare_items(read_block(block))
            for texts, ids in text_batches(batches, "text", "doc_id"):
                rows = [(ids[k], *leak) for k, *leak in find_leaks(texts, items)]
                columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
                types = [pa.int64()] * 4 + [pa.float64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=[c.split()[0] for c in LEAK.split(", ")])

        return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, LEAK)

    return reduce(DataFrame.unionByName, [over(block) for block in item_blocks(benchmark, max_bytes)])


def decontaminate(docs: DataFrame, benchmark: DataFrame, max_bytes: int = MAX_BYTES) -> DataFrame:
    """The documents that hold no benchmark item, with their columns unchanged."""
    schema = docs.schema

    def without(block: str):
        def run(batches) -> Iterator:
            import pyarrow as pa

            items = prepare_items(read_block(block))
            for batch in batches:
                start = 0
                for (texts,) in text_batches([batch], "text"):
                    found = {k for k, *_ in find_leaks(texts, items)}
                    part = batch.slice(start, len(texts))
                    start += len(texts)
                    yield part.filter(pa.array([k not in found for k in range(len(texts))]))

        return run

    for block in item_blocks(benchmark, max_bytes):
        docs = docs.mapInArrow(without(block), schema)
    return docs
