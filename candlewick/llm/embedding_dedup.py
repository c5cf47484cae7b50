"""Near-duplicate embeddings by spherical-cap filters (operator 7).

Filters: a random rotation (sign flips and Hadamard transforms) parts a vector
into two halves; each half has a random code of K directions, and every pair of
them is one of K^2 filter directions.  A vector is decoded to all filters whose
inner product exceeds the cap's bound, found from the sorted products of one
half, and to its best ``LEAST`` ones if fewer do.  K grows with the square root of
the number of vectors, so a filter's expected share of unrelated vectors stays the
same.  A pair shares a filter of one rotation less often as K grows; that chance is
estimated for the length and K from random pairs at the cosine exactly, and as many
independent rotations are taken as make a missed pair rarer than ``MISS``.

Verification: the vectors of a filter are compared by block products in double
precision.  A pair that several filters hold is counted in the first of them
only.  A block gives counts and a spanning forest of its links, never the pairs
themselves, so the output stays in proportion to the input.  A filter with more
than ``BLOCK`` vectors is split into chunks, and each pair of chunks is a block
of its own.  Equal vectors are one class with a weight from the start.

Edge cases: a vector that is null, empty or zero, or holds a null or non-finite
component, links with nothing; so does one with a null ``vec_id``, whose
component is null.  Vectors of different lengths never link.  Rows that repeat
a ``vec_id`` are judged each by its own vector.
"""

from __future__ import annotations

from collections.abc import Iterator
from statistics import NormalDist

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from candlewick.llm.common import shuffle_partitions, stored
from candlewick.llm.components import components, lowest_ids, with_nodes
from candlewick.llm.tokens import rows_of

COSINE = 0.95
ROTATIONS, EXPECTED, LEAST = 4, 8, 4  # rotations: at least so many
MISS, PAIRS = 1e-4, 250
MAX_CODE = 4096
BLOCK = 1024
SEED = 71
_CODES: dict = {}
_ROTATIONS: dict = {}


def hadamard(x):
    """The orthonormal Hadamard transform of each row (a power of two long)."""
    import numpy as np

    n, width = x.shape[1], 1
    while width < n:
        x = x.reshape(len(x), -1, 2, width)
        x = np.concatenate((x[:, :, :1] + x[:, :, 1:], x[:, :, :1] - x[:, :, 1:]), axis=2).reshape(-1, n)
        width *= 2
    return x / np.sqrt(n)


def code(dimension: int, k: int, rotation: int):
    """(signs of the three flips, two code books) of one rotation; alike in every task."""
    import numpy as np

    at = (dimension, k, rotation)
    if at not in _CODES:
        size = max(2, 1 << (dimension - 1).bit_length())
        random = np.random.Generator(np.random.PCG64([SEED, dimension, rotation]))
        signs = random.choice([-1.0, 1.0], (3, size))
        books = random.standard_normal((2, k, size // 2))
        books /= np.linalg.norm(books, axis=2, keepdims=True) * np.sqrt(2)
        _CODES[at] = signs, books
    return _CODES[at]


def rotations_for(dimension: int, k: int, cosine: float) -> int:
    """Rotations that miss a pair at ``cosine`` with a probability of at most ``MISS``; alike in every task."""
    import numpy as np

    at = (dimension, k, cosine)
    if at not in _ROTATIONS:
        random = np.random.Generator(np.random.PCG64([SEED, dimension, k]))
        one, two = unit(random.standard_normal((PAIRS, dimension))), random.standard_normal((PAIRS, dimension))
        two = two - (one * two).sum(axis=1, keepdims=True) * one
        two = unit(two) * np.sqrt(max(0.0, 1 - cosine**2)) + cosine * one if dimension > 1 else one
        keys = filters(np.concatenate((one, two)), k)
        space = MAX_CODE**2
        shared = sum(len(np.unique(np.intersect1d(a, b) // space)) for a, b in zip(keys[:PAIRS], keys[PAIRS:], strict=True))
        n = PAIRS * ROTATIONS
        p = shared / n
        p -= 3 * np.sqrt(max(p * (1 - p), 1 / n) / n)  # three deviations of the estimate
        if p <= 0:
            raise ValueError(f"pairs at cosine {cosine} share no filters of {k} directions")
        _ROTATIONS[at] = max(ROTATIONS, int(np.ceil(np.log(MISS) / np.log1p(-p))))
    return _ROTATIONS[at]


def filters(x, k: int, rotations: int = ROTATIONS) -> list:
    """For each row of unit vectors its sorted filter keys."""
    import numpy as np

    dimension = x.shape[1]
    size = max(2, 1 << (dimension - 1).bit_length())
    bound = NormalDist().inv_cdf(1 - min(0.5, EXPECTED / k**2)) / np.sqrt(size)
    out: list[list] = [[] for _ in x]
    for rotation in range(rotations):
        signs, books = code(dimension, k, rotation)
        y = np.zeros((len(x), size))
        y[:, :dimension] = x
        for s in signs:
            y = hadamard(y * s)
        one, two = y[:, : size // 2] @ books[0].T, y[:, size // 2 :] @ books[1].T
        order = np.argsort(-two, axis=1)
        two = np.take_along_axis(two, order, axis=1)
        base = ((dimension << 12) + rotation) * MAX_CODE**2
        for v in range(len(x)):
            near = np.flatnonzero(one[v] + two[v, 0] >= bound)
            count = np.searchsorted(-two[v], one[v, near] - bound, "right")
            if count.sum() >= LEAST:
                i = np.repeat(near, count)
                j = np.arange(len(i)) - np.repeat(np.cumsum(count) - count, count)
            else:  # the best sums lie among the best of both halves
                few = min(LEAST, k)
                top = np.argsort(-one[v])[:few]
                sums = (one[v, top][:, None] + two[v, :few]).ravel()
                best = np.argsort(-sums)[:LEAST]
                i, j = top[best // few], best % few
            out[v].append(base + i * MAX_CODE + order[v, j])
    return [np.sort(np.concatenate(p)) for p in out]


def links_in_block(x, left, right, weight, keys: list, key: int, cosine: float):
    """(links of each row by weight, smallest connected row of each) over the pairs left x right whose first common filter is ``key``.

    ``left`` and ``right`` are row masks: equal for one chunk, disjoint for two.
    """
    import numpy as np

    linked = (x @ x.T >= cosine) & ((left[:, None] & right) | (right[:, None] & left))
    np.fill_diagonal(linked, False)
    rows = np.flatnonzero(linked.any(axis=1))
    count, label = np.zeros(len(x), np.int64), np.arange(len(x))
    if not len(rows):
        return count, label
    linked = linked[np.ix_(rows, rows)]
    early = [keys[r][: np.searchsorted(keys[r], key)] for r in rows]
    if any(len(e) for e in early):
        _, column = np.unique(np.concatenate(early), return_inverse=True)
        held = np.zeros((len(rows), column.max() + 1), np.float32)
        held[np.repeat(np.arange(len(rows)), [len(e) for e in early]), column] = 1
        linked &= held @ held.T == 0
    count[rows] = linked @ weight[rows]
    own = np.arange(len(rows))
    while True:  # the smallest row that links reach
        least = np.where(linked, own, len(rows)).min(axis=1)
        new = np.minimum(own, least)
        new = new[new]
        if (new == own).all():
            break
        own = new
    label[rows] = rows[own]
    return count, label


def can_link() -> Column:
    """Whether a row's vector and id allow links; never null."""
    x = F.col("embedding")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    good = x.isNotNull() & ~bad & F.exists(x, lambda v: v != 0) & F.col("vec_id").isNotNull()
    return F.coalesce(good, F.lit(False))


def embedding_classes(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The valid rows (vec_id, h1, h2, embedding) and the classes of equal vectors (h1, h2, rep, weight)."""
    x = F.col("embedding")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").where(can_link())
    plain = F.transform(x, lambda v: F.when(v == 0, F.abs(v)).otherwise(v))  # -0.0 equals 0.0
    rows = rows.withColumns({"h1": F.xxhash64(plain), "h2": F.xxhash64(F.lit(1), plain)})
    classes = rows.groupBy("h1", "h2").agg(F.min("vec_id").alias("rep"), F.count("*").alias("weight"))
    return rows, stored(classes, "embedding_classes")


def near_embeddings(vectors: DataFrame, cosine: float = COSINE, block: int = BLOCK) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vectors`` (vec_id, embedding)."""
    spark = vectors.sparkSession
    rows, classes = embedding_classes(vectors)
    classes, renamed = with_nodes(classes, ["h1", "h2"], "rep")
    total = classes.count()
    k = min(MAX_CODE, max(16, int(total**0.5) + 1))
    kind = "<f8" if vectors.schema["embedding"].dataType.elementType == DoubleType() else "<f4"
    heads = classes.withColumnRenamed("rep", "vec_id").join(rows, ["h1", "h2", "vec_id"]).dropDuplicates(["h1", "h2"])
    # from here on "rep" is a class's node: its smallest id, or a number of its own where classes share that

    def decode(batches) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512).to_pydict()
                found: list = [None] * len(part["h1"])
                raw = [np.array(v, kind) for v in part["embedding"]]
                lengths = np.array([len(v) for v in raw])
                for d in np.unique(lengths):
                    at = np.flatnonzero(lengths == d)
                    for r, keys in zip(at, filters(unit(np.stack([raw[r] for r in at])), k, rotations_for(int(d), k, cosine)), strict=True):
                        found[r] = keys
                yield pa.RecordBatch.from_pydict(
                    {n: part[n] for n in ("h1", "h2", "rep", "weight")} | {"vector": [v.tobytes() for v in raw], "keys": [f.astype("<i8") for f in found]},
                    pa.schema([(n, pa.int64()) for n in ("h1", "h2", "rep", "weight")] + [("vector", pa.binary()), ("keys", pa.list_(pa.int64()))]),
                )

    coded = heads.select("h1", "h2", F.col("node").alias("rep"), "weight", "embedding")
    coded = stored(coded.mapInArrow(decode, "h1 long, h2 long, rep long, weight long, vector binary, keys array<long>"), "embedding_filters")

    places = coded.select("h1", "h2", F.explode("keys").alias("key"))
    sizes = places.groupBy("key").agg(F.count("*").alias("size")).where(F.col("size") > 1)
    places = places.join(sizes, "key").withColumn("chunks", F.ceil(F.col("size") / block).cast("int"))
    places = places.withColumn("chunk", F.pmod(F.xxhash64("h1", "h2"), F.col("chunks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other")
    places = places.select("h1", "h2", "key", "chunk", other)
    places = places.select("h1", "h2", "key", "chunk", F.least("chunk", "other").alias("p"), F.greatest("chunk", "other").alias("q"))
    blocks = places.join(coded, ["h1", "h2"]).select("key", "p", "q", "chunk", "rep", "weight", "vector", "keys")
    blocks = blocks.repartition(shuffle_partitions(spark), "key", "p", "q").sortWithinPartitions("key", "p", "q", "rep")

    def compare(batches) -> Iterator:
        import numpy as np
        import pyarrow as pa

        out: dict = {"a": [], "b": [], "n": []}

        def close(group, at):
            x = unit(np.frombuffer(b"".join(r[2] for r in group), kind).reshape(len(group), -1))
            chunk = np.array([r[0] for r in group])
            rep, weight = np.array([r[1] for r in group]), np.array([r[3] for r in group])
            count, label = links_in_block(x, chunk == at[1], chunk == at[2], weight, [np.array(r[4]) for r in group], at[0], cosine)
            for r in np.flatnonzero(count):
                out["a"].append(int(rep[r]))
                out["b"].append(int(rep[label[r]]))
                out["n"].append(int(count[r]))

        def batch_of():
            schema = pa.schema([(c, pa.int64()) for c in out])
            made = pa.RecordBatch.from_pydict(out, schema)
            for c in out.values():
                c.clear()
            return made

        group, at = [], None
        for key, p, q, *row in rows_of(batches, "key", "p", "q", "chunk", "rep", "vector", "weight", "keys"):
            if (key, p, q) != at:
                if len(group) > 1:
                    close(group, at)
                group, at = [], (key, p, q)
                if len(out["a"]) > 20_000:
                    yield batch_of()
            group.append(row)
        if len(group) > 1:
            close(group, at)
        yield batch_of()

    found = stored(blocks.mapInArrow(compare, "a long, b long, n long"), "embedding_links")
    counts = found.groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
    by_class = lowest_ids(classes, components(found.select("a", "b")), "rep", renamed).join(counts, "node", "left")
    by_class = by_class.select("h1", "h2", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"), "lowest")
    linked = rows.select("vec_id", "h1", "h2").join(by_class, ["h1", "h2"]).select("vec_id", "n_links", F.col("lowest").alias("component_id"))
    lone = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").where(~can_link())
    lone = lone.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(lone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def unit(x):
    """Rows in double precision, scaled to length one without overflow."""
    import numpy as np

    x = np.asarray(x, np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))
