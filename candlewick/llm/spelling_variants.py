"""Spelling variants by k-d trees over letter counts (operator 11).

Words are points: the counts of their letters.  One edit moves a point by an L1
distance of 1 (a letter more or less) or 2 (a letter replaced: one count falls, one
rises), so near words are found by range searches in k-d trees, one search for each
pair of lengths: words of the same length, and words one letter longer.

A point is stored as bits "letter x occurs at least c times" for c up to ``LEVELS``;
a split of a tree asks for one bit, and the AND and the OR of a subtree's points are
its box.  A box is pruned when more than one bit would have to be added, or more than
one removed (none, for the longer words).  Cut-off counts only weaken the bound; every
candidate's letter order is verified, so the result is exact.

Scale: a length with many words is split into cells by the upper levels of its tree,
fitted on a bounded sample of words; each word goes to its own cell as a point, and as
a query to those cells that its box search reaches.  A task holds one cell's points.
Links leave a task as counts and best partners, never as pairs.  Words with the same
letter counts (anagrams) can't be split, but are never near each other.

Forms point to words with at least twice the occurrences, so the chains of a root are
no longer than log2 of the largest count; pointer doubling follows them.

Edge cases: a null or empty text has no words.  A null ``doc_id`` deletes no letter.
Rows that repeat a ``doc_id`` all count.  Ties: the form is the smallest near word in
code-point order among those with the most occurrences.  Words of any length are whole.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm.common import shuffle_partitions, stored
from candlewick.llm.tokens import rows_of

LETTERS = "A-Za-zÀ-ÿ"
DELETE_EVERY = 97
LEAST_LENGTH, LEAST_COUNT = 5, 3
# Points of a cell, words of the sample that the upper levels are fitted on, points of a leaf,
# queries searched at once, distinct words that a task holds before it hands on its counts.
CELL, SAMPLE, LEAF, QUERIES, HELD = 16_384, 200_000, 8, 2_048, 400_000
LEVELS = 2
_UPPER = {c: c + 32 for c in range(65, 91)}


# ------------------------------------------------------------------ words


def word_counts(docs: DataFrame, delete_every: int = DELETE_EVERY, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n): the runs of letters of all texts, lower-cased, some with one letter deleted, and their occurrences."""

    def run(batches) -> Iterator:
        import pyarrow as pa

        find = re.compile(f"[{LETTERS}]+").findall
        held: Counter = Counter()

        def out():
            words = list(held)
            made = pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])
            held.clear()
            return made

        for doc_id, text in rows_of(batches, "doc_id", "text"):
            runs = Counter(find((text or "").translate(_UPPER)))
            if doc_id is not None:
                head = zlib.crc32(f"{doc_id}:".encode())
                hashes = [(w, zlib.crc32(w.encode(), head)) for w in runs]
                for w, h in [x for x in hashes if x[1] % delete_every == 0]:
                    cut = h % len(w)
                    n = runs.pop(w)
                    if len(w) > 1:
                        held[w[:cut] + w[cut + 1 :]] += n
            for w, n in runs.items():
                held[w] += n
            if len(held) > HELD:
                yield out()
        yield out()

    counted = docs.select("doc_id", "text").mapInArrow(run, "word string, n long")
    counted = counted.where(F.length("word") >= least_length).groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= least_count)


# ------------------------------------------------------------------ points and trees


def points(words: list[str], length: int):
    """(code points, n x length; bits of the letter counts, n x 2) of words of one length."""
    import numpy as np

    codes = np.frombuffer("".join(words).encode("utf-16-le"), np.uint16).reshape(len(words), length)
    bits = np.zeros((len(words), 2), np.uint64)
    # a-z in word 0 (two counts each), the letters from U+00C0 on in word 1 (one each)
    for c in range(97, 123):
        times = (codes == c).sum(axis=1)
        for level in range(LEVELS):
            bits[:, 0] |= (times > level).astype(np.uint64) << np.uint64(2 * (c - 97) + level)
    for c in np.unique(codes[codes >= 0xC0]).tolist():
        bits[:, 1] |= (codes == c).any(axis=1).astype(np.uint64) << np.uint64(c - 0xC0)
    return codes, bits


def popcount(bits):
    import numpy as np

    return np.bitwise_count(bits[:, 0]) + np.bitwise_count(bits[:, 1])


def best_split(bits) -> tuple[int, int]:
    """The bit (word, place) that halves the points best."""
    import numpy as np

    best = (-1, 0, 0)
    for w in (0, 1):
        every = int(np.bitwise_or.reduce(bits[:, w])) & ~int(np.bitwise_and.reduce(bits[:, w]))
        for place in (p for p in range(64) if every >> p & 1):
            on = int((bits[:, w] >> np.uint64(place) & np.uint64(1)).sum())
            best = max(best, (min(on, len(bits) - on), -w, -place))
    return (-best[1], -best[2]) if best[0] > 0 else (-1, 0)


class Tree:
    """Nodes as arrays: box (low, high), children, range of points (in the order ``order``)."""

    def __init__(self, bits, leaf: int):
        import numpy as np

        self.order = np.arange(len(bits))
        low, high, child, span = [], [], [], []
        todo = [(0, len(bits), -1)]
        while todo:
            first, last, parent = todo.pop()
            here = bits[self.order[first:last]]
            if parent >= 0:
                child[parent].append(len(low))
            low.append(np.bitwise_and.reduce(here, axis=0))
            high.append(np.bitwise_or.reduce(here, axis=0))
            child.append([])
            span.append((first, last))
            w, place = best_split(here) if last - first > leaf else (-1, 0)
            if w < 0:
                continue
            on = (here[:, w] >> np.uint64(place) & np.uint64(1)).astype(bool)
            self.order[first:last] = np.concatenate((self.order[first:last][~on], self.order[first:last][on]))
            middle = first + int((~on).sum())
            todo += [(first, middle, len(low) - 1), (middle, last, len(low) - 1)]
        self.low, self.high = np.array(low), np.array(high)
        self.left = np.array([c[0] if c else -1 for c in child])
        self.right = np.array([c[1] if c else -1 for c in child])
        self.span = np.array(span)

    def search(self, queries, removed: int, after=None) -> tuple:
        """(query, point in order) pairs that the boxes leave; ``after``: only points at later places than each query's."""
        import numpy as np

        q, node = np.arange(len(queries)), np.zeros(len(queries), np.int64)
        found_q, found_node = [], []
        while len(q):
            near = (popcount(self.low[node] & ~queries[q]) <= 1) & (popcount(queries[q] & ~self.high[node]) <= removed)
            if after is not None:
                near &= self.span[node, 1] - 1 > after[q]
            q, node = q[near], node[near]
            leaf = self.left[node] < 0
            found_q.append(q[leaf])
            found_node.append(node[leaf])
            q, node = q[~leaf], node[~leaf]
            q, node = np.concatenate((q, q)), np.concatenate((self.left[node], self.right[node]))
        q, node = np.concatenate(found_q), np.concatenate(found_node)
        size = self.span[node, 1] - self.span[node, 0]
        q = np.repeat(q, size)
        place = np.repeat(self.span[node, 0] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        if after is not None:
            later = place > after[q]
            q, place = q[later], place[later]
        return q, place


def one_edit(short, long) -> object:
    """Which rows differ by exactly one edit: n x L against n x L (replaced) or n x (L + 1) (inserted)."""
    import numpy as np

    if short.shape == long.shape:
        return (short != long).sum(axis=1) == 1
    size = short.shape[1]
    ahead = np.logical_and.accumulate(short == long[:, :-1], axis=1).sum(axis=1)
    behind = np.logical_and.accumulate((short == long[:, 1:])[:, ::-1], axis=1).sum(axis=1)
    return ahead + behind >= size


class Cell:
    """The points of one cell, searched by its own words and by others."""

    def __init__(self, length: int, words: list[str], counts: list[int]):
        import numpy as np

        codes, bits = points(words, length)
        self.length, self.tree = length, Tree(bits, LEAF)
        order = self.tree.order
        self.codes, self.bits = codes[order], bits[order]
        self.words, self.counts = [words[i] for i in order], np.array(counts, np.int64)[order]

    def links(self, length: int, words: list[str], counts, own: int | None = None) -> Iterator:
        """Blocks (query indices, places) of near pairs; ``own``: the queries are this cell's points from that place on."""
        import numpy as np

        if own is None:
            codes, bits = points(words, length)
        else:
            codes, bits = self.codes[own : own + len(words)], self.bits[own : own + len(words)]
        after = None if own is None else np.arange(own, own + len(words))
        q, place = self.tree.search(bits, removed=int(length == self.length), after=after)
        near = (popcount(self.bits[place] & ~bits[q]) <= 1) & (popcount(bits[q] & ~self.bits[place]) <= int(length == self.length))
        q, place = q[near], place[near]
        block = max(1, 4_000_000 // self.length)
        for first in range(0, len(q), block):
            a, b = q[first : first + block], place[first : first + block]
            good = one_edit(codes[a], self.codes[b])
            yield a[good], b[good]


# ------------------------------------------------------------------ cells over the cluster


def upper_trees(words: DataFrame, cell: int = CELL, sample: int = SAMPLE) -> dict[int, tuple[int, list]]:
    """For each length (first cell number, nodes): a node is (word, place, left, right) or (-1, cell, 0, 0).

    The lengths of words are few.  Lengths with more than ``cell`` words are split on a sample of
    at most about ``sample`` words of all.
    """
    sizes = sorted(words.groupBy(F.length("word").alias("size")).agg(F.count("*").alias("n")).collect())
    total = sum(r["n"] for r in sizes)
    large = {r["size"]: r["n"] for r in sizes if r["n"] > cell}
    drawn: dict[int, list[str]] = {size: [] for size in large}
    if large:
        share = min(1.0, sample / total)
        some = words.where(F.length("word").isin(list(large))).where(F.pmod(F.xxhash64("word"), F.lit(1 << 30)) < int(share * (1 << 30)))
        for r in some.select("word").collect():  # about ``sample`` words at most
            drawn[len(r["word"])].append(r["word"])
    trees, number = {}, 0
    for size, n in sizes:
        nodes: list = []
        bits = points(drawn[size], size)[1] if drawn.get(size) else None
        todo = [(bits, n, None, 0)]
        first = number
        while todo:
            here, expected, parent, side = todo.pop()
            if parent is not None:
                nodes[parent][2 + side] = len(nodes)
            w, place = best_split(here) if here is not None and expected > cell and len(here) > 1 else (-1, 0)
            if w < 0:
                nodes.append([-1, number, 0, 0])
                number += 1
                continue
            on = (here[:, w] >> place & 1).astype(bool)
            nodes.append([w, place, 0, 0])
            for k, part in enumerate((here[~on], here[on])):
                todo.append((part, expected * len(part) / len(here), len(nodes) - 1, k))
        trees[size] = (first, nodes)
    return trees


def reach(nodes: list, bits, removed: int | None) -> tuple:
    """(point, cell) pairs: each point's own cell, or with ``removed`` every cell that a near point could be in."""
    import numpy as np

    kind, at, left, right = (np.array(c, np.int64) for c in zip(*nodes, strict=True))
    q, node = np.arange(len(bits)), np.zeros(len(bits), np.int64)
    added, taken = np.zeros(len(bits), np.int64), np.zeros(len(bits), np.int64)
    out_q, out_cell = [], []
    while len(q):
        leaf = kind[node] < 0
        out_q.append(q[leaf])
        out_cell.append(at[node[leaf]])
        q, node, added, taken = (x[~leaf] for x in (q, node, added, taken))
        on = (bits[q, kind[node]] >> at[node].astype(np.uint64) & np.uint64(1)).astype(bool)
        if removed is None:
            node = np.where(on, right[node], left[node])
            continue
        # the other side of a split costs one bit, added or removed
        over = np.where(on, taken < removed, added < 1)
        q, added, taken = np.concatenate((q, q[over])), np.concatenate((added, (added + ~on)[over])), np.concatenate((taken, (taken + on)[over]))
        node = np.concatenate((np.where(on, right[node], left[node]), np.where(on, left[node], right[node])[over]))
    return np.concatenate(out_q), np.concatenate(out_cell)


def route(words: DataFrame, trees: dict[int, tuple[int, list]]) -> DataFrame:
    """(cell, side, length, word, n): side 0 a point of the cell, side 1 a query of it."""

    def run(batches) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            found, counts = batch.column(0).to_pylist(), np.array(batch.column(1).to_pylist(), np.int64)
            by_size: dict[int, list[int]] = {}
            for i, w in enumerate(found):
                by_size.setdefault(len(w), []).append(i)
            for size, rows in by_size.items():
                ids, here = np.array(rows), [found[i] for i in rows]
                bits = points(here, size)[1]
                places = [(0, *reach(trees[size][1], bits, None))]
                own = np.empty(len(here), np.int64)
                own[places[0][1]] = places[0][2]
                q, cell = reach(trees[size][1], bits, 1)
                places.append((1, q[cell > own[q]], cell[cell > own[q]]))
                if size + 1 in trees:
                    places.append((1, *reach(trees[size + 1][1], bits, 0)))
                for side, q, cell in places:
                    for first in range(0, len(q), 50_000):
                        part = ids[q[first : first + 50_000]]
                        columns = [pa.array(cell[first : first + 50_000]), pa.array(np.full(len(part), side, np.int32)), pa.array(np.full(len(part), size, np.int32))]
                        columns += [pa.array([found[i] for i in part], pa.string()), pa.array(counts[part])]
                        yield pa.RecordBatch.from_arrays(columns, names=["cell", "side", "length", "word", "n"])

    return words.select("word", "n").mapInArrow(run, "cell long, side int, length int, word string, n long")


def near_counts(routed: DataFrame) -> DataFrame:
    """(word, near, best_n, best): from each cell, how many near words a word has there and the one with the most occurrences."""
    rows = routed.repartition(shuffle_partitions(routed.sparkSession), "cell").sortWithinPartitions("cell", "side", "length")

    def run(batches) -> Iterator:
        import numpy as np
        import pyarrow as pa

        def out(words, counts, cell, pairs):
            """Both ends of the pairs of a block of queries."""
            q, p = (np.concatenate(x) for x in zip(*pairs, strict=True)) if pairs else (np.zeros(0, np.int64),) * 2
            rows = []
            for me, my, other, its, its_n in ((q, words, p, cell.words, cell.counts), (p, cell.words, q, words, counts)):
                for i, j, n in zip(me.tolist(), other.tolist(), its_n[other].tolist(), strict=True):
                    rows.append((my[i], n, its[j]))
            best: dict = {}
            for w, n, other in rows:
                k, m, b = best.get(w, (0, 0, ""))
                best[w] = (k + 1, n, other) if n > m or (n == m and other < b) else (k + 1, m, b)
            columns = [pa.array(list(best), pa.string()), *(pa.array([v[k] for v in best.values()], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.string())))]
            return pa.RecordBatch.from_arrays(columns, names=["word", "near", "best_n", "best"])

        def ask(cell, held):
            size, words, counts = held[0][0], [r[1] for r in held], np.array([r[2] for r in held], np.int64)
            return out(words, counts, cell, list(cell.links(size, words, counts)))

        def own_links(cell):
            for first in range(0, len(cell.words), QUERIES):
                words = cell.words[first : first + QUERIES]
                yield out(words, cell.counts[first : first + QUERIES], cell, list(cell.links(cell.length, words, None, own=first)))

        number, cell, held, filling = None, None, [], []
        for c, side, size, word, n in rows_of(batches, "cell", "side", "length", "word", "n"):
            if c != number:
                if filling:
                    cell = Cell(filling[0][0], [r[1] for r in filling], [r[2] for r in filling])
                    yield from own_links(cell)
                if held:
                    yield ask(cell, held)
                number, cell, held, filling = c, None, [], []
            if side == 0:
                filling.append((size, word, n))
                continue
            if filling:
                cell = Cell(filling[0][0], [r[1] for r in filling], [r[2] for r in filling])
                yield from own_links(cell)
                filling = []
            if cell is None:  # the sample gave a cell without words
                continue
            if held and (len(held) >= QUERIES or held[0][0] != size):
                yield ask(cell, held)
                held = []
            held.append((size, word, n))
        if filling:
            cell = Cell(filling[0][0], [r[1] for r in filling], [r[2] for r in filling])
            yield from own_links(cell)
        if held:
            yield ask(cell, held)

    return rows.mapInArrow(run, "word string, near long, best_n long, best string")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for the words of ``forms`` (word, form): where the chain of forms ends; by pointer doubling."""
    state = stored(forms.select("word", F.col("form").alias("root")), "form_roots")
    while True:
        further = state.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = stored(state.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "form_roots")
        state = step.select("word", "root")
        if step.where("moved").isEmpty():
            return state


def spelling_variants(docs: DataFrame, cell: int = CELL, sample: int = SAMPLE, **words) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word of ``docs`` (doc_id, text)."""
    counted = stored(word_counts(docs, **words), "words")
    routed = route(counted, upper_trees(counted, cell, sample))
    near = near_counts(routed).groupBy("word").agg(F.sum("near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("less"), "best")).alias("top"))
    near = near.select(F.col("word").alias("__word"), "n_near", (-F.col("top.less")).alias("form_n"), F.col("top.best").alias("form"))
    rows = counted.join(near, F.col("word") == F.col("__word"), "left")
    is_form = F.col("form_n") >= 2 * F.col("n")
    rows = stored(rows.select("word", F.when(is_form, F.col("form")).alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(is_form, F.col("form_n")).alias("form_n")), "near_words")
    ends = roots(rows.where(F.col("form").isNotNull())).withColumnRenamed("word", "__word")
    rows = rows.join(ends, F.col("word") == F.col("__word"), "left")
    return rows.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
