"""Connected components of a link table, by alternating large and small stars.

Each step replaces the links of a vertex by links to its smallest neighbour
and keeps the components; the links become stars around the smallest vertex of
each component after a logarithmic number of steps.  Before the first step each
task reduces its own links to stars of what it has seen (``local_stars``), so that
large groups are small before any shuffle.  A vertex with very many links is
pre-aggregated in the minima and split by adaptive skew handling in the joins.
Every step is written to the shared folder.

Vertices are numbers.  Where a table repeats an id with other contents, one class of
equal contents keeps the id as its vertex and the others take numbers of their own
(``with_nodes``); ``lowest_ids`` turns roots back to the smallest id of a component.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm.common import stored

MAX_STEPS = 60
HELD = 200_000  # links that a task reduces at once


def _star(links: DataFrame, both_ways: bool) -> DataFrame:
    """links (a > b).  Large star: each larger neighbour moves to the smallest one; small star: the smaller ones and the vertex itself."""
    swapped = links.select(F.col("b").alias("a"), F.col("a").alias("b"))
    around = links.unionByName(swapped) if both_ways else links
    least = around.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    if both_ways:
        moved = around.join(least, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        moved = around.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
    return moved.where(F.col("a") != F.col("b")).distinct()


def _is_done(links: DataFrame) -> bool:
    """Whether the links are stars: no vertex has two links up, or one up and one down."""
    ends = links.select(F.col("a").alias("v"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    ends = ends.unionByName(links.select(F.col("b").alias("v"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    bad = ends.groupBy("v").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where(F.col("up") + F.col("down") > 1)
    return bad.where(F.col("up") > 0).isEmpty()


def local_stars(links: DataFrame) -> DataFrame:
    """Links (a > b) with the same components: each ``HELD`` links of a task as stars around their smallest vertices."""

    def run(batches) -> Iterator:
        import pyarrow as pa

        top: dict[int, int] = {}

        def find(x: int) -> int:
            while (up := top.setdefault(x, x)) != x:
                top[x] = top[up]
                x = top[x]
            return x

        def out():
            pairs = [(x, find(x)) for x in list(top)]
            pairs = [p for p in pairs if p[0] != p[1]]
            top.clear()
            columns = zip(*pairs, strict=True) if pairs else ((), ())
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["a", "b"])

        seen = 0
        for batch in batches:
            for x, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                x, y = find(x), find(y)
                if x != y:
                    top[max(x, y)] = min(x, y)
            seen += batch.num_rows
            if seen >= HELD:
                yield out()
                seen = 0
        yield out()

    return links.select("a", "b").mapInArrow(run, "a long, b long")


def with_nodes(classes: DataFrame, keys: list[str], id_column: str) -> tuple[DataFrame, bool]:
    """``classes`` (stored, unique in ``keys``) with a unique number ``node``, and whether any differs from the id."""
    repeated = classes.groupBy(id_column).agg(F.min(F.struct(*keys)).alias("__first"), F.count("*").alias("__n")).where(F.col("__n") > 1)
    spare = classes.join(repeated, id_column).where(F.struct(*keys) != F.col("__first")).select(*keys)
    spare = stored(spare.withColumn("__k", F.monotonically_increasing_id()), "spare_nodes")
    if spare.isEmpty():
        return classes.withColumn("node", F.col(id_column)), False
    low, high = classes.agg(F.min(id_column), F.max(id_column)).first()
    number = F.lit(high + 1) + F.col("__k") if high < 1 << 62 else F.lit(low - 1) - F.col("__k")
    named = classes.join(spare.select(*keys, number.alias("__node")), keys, "left")
    return named.withColumn("node", F.coalesce("__node", F.col(id_column))).drop("__node"), True


def lowest_ids(classes: DataFrame, roots: DataFrame, id_column: str, renamed: bool) -> DataFrame:
    """``classes`` (with ``node``) with ``lowest``: the smallest id of the class's component."""
    named = classes.join(roots, F.col("node") == F.col("vertex"), "left").withColumn("root", F.coalesce("root", "node")).drop("vertex")
    if not renamed:  # nodes are ids, roots the smallest ones
        return named.withColumnRenamed("root", "lowest")
    least = named.groupBy("root").agg(F.min(id_column).alias("lowest"))
    return named.join(least, "root").drop("root")


def components(links: DataFrame) -> DataFrame:
    """(vertex, root) for every vertex of ``links`` (a, b) that isn't the smallest of its component."""
    state = stored(local_stars(links).distinct(), "links")
    for _ in range(MAX_STEPS):
        if _is_done(state):
            return state.select(F.col("a").alias("vertex"), F.col("b").alias("root"))
        state = stored(_star(_star(state, True), False), "links")
    raise RuntimeError(f"links are no stars after {MAX_STEPS} steps")
