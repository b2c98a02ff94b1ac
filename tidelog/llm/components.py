"""Connected components of a graph, as DataFrame joins.

Edges are rewritten by the two star steps (each node's larger neighbours move to
its smallest neighbour; each node and its smaller neighbours move to the smallest
of them) until they no longer change: then every node has one edge, to the
smallest node of its component.  The rounds grow with the logarithm of the
component sizes, every step is a grouping and a join by node, and each round is
stored in the shared folder, so a lost executor repeats one round at most.  Number and
hash of a round's edges are observed while they are written.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tidelog.llm.common import stored


def large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("b", "a")).toDF("u", "v")
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))


def small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u > v")
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").filter("v > m").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("u", "m")).distinct()


def contracted(edges: DataFrame) -> DataFrame:
    """Edges that connect the same nodes: each partition's own components, as stars."""

    def contract(batches):
        parent: dict[int, int] = {}

        def find(x: int) -> int:
            while parent.setdefault(x, x) != x:
                parent[x] = x = parent[parent[x]]
            return x

        for batch in batches:
            for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
                a, b = find(a), find(b)
                parent[max(a, b)] = min(a, b)
        stars = [(x, find(x)) for x in list(parent)]
        stars = [s for s in stars if s[0] != s[1]]
        if stars:
            a, b = zip(*stars)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return edges.mapInArrow(contract, "a long, b long")


def components(edges: DataFrame, native: bool = True) -> DataFrame:
    """From edges (a, b) of longs: (node, component) with the smallest node of each
    component; nodes alone in theirs are in no edge and in no row.  Unless ``native``,
    each partition first contracts its own edges, which saves rounds."""
    edges = edges.select("a", "b").filter("a <> b").distinct()
    if not native:
        edges = contracted(edges)
    edges, after = measured(edges)
    before = None
    while after != before:
        before = after
        edges, after = measured(small_star(large_star(edges)))
    pairs = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return pairs.union(roots)


def measured(edges: DataFrame) -> tuple[DataFrame, tuple[int, int]]:
    """The edges, stored, and their number and hash."""
    seen = Observation()
    edges = stored(edges.observe(seen, F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")), "components")
    return edges, (seen.get["n"], seen.get["x"])
