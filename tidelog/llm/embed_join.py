"""Embedding near-duplicates by a PCA-ordered tiled comparison (operator 13).

Vectors link when their cosine, in double precision, reaches a threshold.

1. Equal vectors form one class with its number of copies; only classes are compared.
2. The second moments of the unit vectors of all classes, summed per task first, give
   the principal axes.  On them, the leading coordinates hold most of every product.
3. A tree of median splits along the axes of largest spread, fitted on a bounded sample
   (``SAMPLE`` classes), numbers places; every class is sent to its place.  Tiles are
   stretches of places of at most ``TILE`` classes (a place with more is dealt to
   several tiles by hash), so that alike vectors lie together.  Per tile and leading
   axis the bounds of all its coordinates are kept.
4. Two tiles are compared unless their bounds keep all their vectors further apart than
   the threshold allows.  Each such pair of tiles is one group of rows.
5. In a group, blocks of rows are compared.  The angles of a block's rows to its middle
   may tell that all pairs of two blocks link, or none.  Otherwise the products of the
   first ``LEAD`` coordinates come first; product plus the product of the suffix norms
   (the lengths of what is not multiplied yet) bounds the cosine from above, pairs that
   cannot reach the threshold stop there, and the others go on for ``STEP`` coordinates
   at a time.  What is left is decided by the cosine of the vectors as given.
6. A group returns, for each class, how many vectors it links with in the other tile,
   and edges that connect what the group's links connect (a star for each component),
   not the links.  Components come from these edges.

A lost task is computed again from the stored classes.  Bounds are loosened by
``SLACK`` against rounding, which costs some comparisons and loses no link.

Defined cases: a vector that is null, empty or zero, or holds null or non-finite
components, links with nothing (0 links, its own component), and so do vectors of
different lengths; vectors are scaled by their largest component first, so that no
square overflows; copies link with each other (their cosine is 1); rows with a null id
count as links of others, and their component is the smallest id there is in it, or
null; ``kept`` is false for them; repeated rows are vectors of their own; an empty table
gives an empty one; other input columns are ignored.  Classes are compared by 64-bit
hashes of the vectors.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import stored
from tidelog.llm.components import components

SAMPLE = 1 << 14  # classes that the tree is fitted on, at most
PLACES = 1 << 10  # leaves of the tree, at most
TILE, TILE_VALUES = 1 << 14, 1 << 22  # classes of a tile and their components, at most
BLOCK = 512  # rows of a tile that are compared with as many of another at a time
BOUNDED = 16  # leading axes whose bounds a tile keeps
LEAD, STEP = 16, 16
SLACK = 1e-9


# --- vectors ---------------------------------------------------------------------------

def matrix(column: pa.Array, width: int) -> np.ndarray:
    """The vectors of a column of lists as rows, shorter ones filled up with zeros."""
    lengths = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(zero_copy_only=False).astype(float)
    out = np.zeros((len(lengths), width))
    out[np.arange(width) < lengths[:, None]] = values
    return out


def unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def valid(vector: str):
    """A vector that can link: finite numbers only, not all of them zero."""
    x = F.col(vector)
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.coalesce(finite & F.exists(x, lambda v: v != 0), F.lit(False))


def arrow_rows(rows: list, names: list[str], types: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)


def principal_axes(classes: DataFrame, width: int) -> np.ndarray:
    """Axes as columns, by falling second moment of the unit vectors of all classes."""

    def moments(batches):
        total = np.zeros((width, width))
        for batch in batches:
            x = unit(matrix(batch.column("v"), width))
            total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width)), pa.array(list(total))], ["i", "row"])

    parts = classes.select("v").mapInArrow(moments, "i long, row array<double>")
    cells = parts.select("i", F.posexplode("row").alias("j", "x")).groupBy("i", "j").agg(F.sum("x").alias("x"))
    total = np.zeros((width, width))
    for row in cells.toPandas().itertuples():  # width x width cells, whatever the number of vectors
        total[row.i, row.j] = row.x
    return np.linalg.eigh(total)[1][:, ::-1].copy()


# --- places ------------------------------------------------------------------------------

def median_tree(points: np.ndarray, places: int) -> list[tuple[int, float]]:
    """(axis, cut) of the splits of a complete binary tree with ``places`` leaves, level
    by level: each node is cut at the median of its axis of largest spread."""
    nodes, splits = [points], []
    while len(nodes) < places:
        halves = []
        for node in nodes:
            axis = int(node.var(axis=0).argmax()) if len(node) else 0
            cut = float(np.median(node[:, axis])) if len(node) else 0.0
            splits.append((axis, cut))
            halves += [node[node[:, axis] <= cut], node[node[:, axis] > cut]]
        nodes = halves
    return splits


def place_of(points: np.ndarray, splits: list[tuple[int, float]]) -> np.ndarray:
    axes, cuts = np.array([a for a, _ in splits], int), np.array([c for _, c in splits])
    node = np.zeros(len(points), int)
    while len(splits) and len(node) and node[0] < len(splits):
        right = points[np.arange(len(points)), axes[node]] > cuts[node]
        node = 2 * node + 1 + right
    return node - len(splits)


def placed(classes: DataFrame, axes: np.ndarray, splits: list) -> DataFrame:
    """The classes with their place and their leading coordinates."""
    width = len(axes)
    own = classes.sparkSession.sparkContext.broadcast((axes, splits))

    def place(batches):
        axes, splits = own.value
        for batch in batches:
            points = unit(matrix(batch.column("v"), width)) @ axes
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("copies"), batch.column("v"),
                 pa.array(place_of(points, splits)), pa.array(list(points[:, :BOUNDED]), pa.list_(pa.float64()))],
                ["key", "copies", "v", "place", "lead"])

    v_type = classes.schema["v"].dataType.simpleString()
    return classes.select("key", "copies", "v").mapInArrow(
        place, f"key long, copies long, v {v_type}, place long, lead array<double>")


def tiles_of(counts: list[tuple[int, int]], size: int) -> list[tuple[int, int, int]]:
    """(place, first tile, number of tiles): places in order share tiles of up to about
    ``size`` classes; a larger place has tiles of its own."""
    out, tile, held = [], 0, 0
    for place, n in sorted(counts):
        if held and held + n > size:
            tile, held = tile + 1, 0
        several = -(-n // size)
        out.append((place, tile, several))
        if several > 1:
            tile += several
        else:
            held += n
    return out


def tile_size(n: int, width: int, cores: int) -> int:
    """At most TILE classes and TILE_VALUES components (but a block of rows), and tiles
    enough that their pairs keep the cores busy."""
    return max(BLOCK, min(TILE, TILE_VALUES // width, -(-n // math.ceil(math.sqrt(4 * cores)))))


def near_tiles(bounds: DataFrame, threshold: float) -> DataFrame:
    """(i, j), i <= j: pairs of tiles whose bounds allow a link.  The bounds of all tiles
    (one row for every ``TILE`` classes) are sent to every task."""
    spark = bounds.sparkSession
    rows = bounds.orderBy("tile").toPandas()
    names = rows["tile"].to_numpy()
    low, high = (np.stack(rows[c].to_numpy()) if len(rows) else np.zeros((0, 1)) for c in ("low", "high"))
    own = spark.sparkContext.broadcast((names, low, high))
    apart = 2 - 2 * threshold + SLACK  # square of the largest distance of unit vectors that link

    def pairs(batches):
        names, low, high = own.value
        for batch in batches:
            found = []
            for at in batch.column("id").to_pylist():
                gap = np.maximum(0, np.maximum(low[at:] - high[at], low[at] - high[at:]))
                near = at + np.flatnonzero((gap * gap).sum(axis=1) <= apart)
                found += [(int(names[at]), int(j)) for j in names[near]]
            if found:
                yield arrow_rows(found, ["i", "j"], [pa.int64()] * 2)

    return spark.range(len(names)).mapInArrow(pairs, "i long, j long")


# --- comparison --------------------------------------------------------------------------

class Tile:
    """Rows of a tile in order of their leading coordinates, and what bounds them."""

    def __init__(self, table: pa.Table, axes: np.ndarray):
        column = table.column("v").combine_chunks()
        width = len(axes)
        self.keys = table.column("key").to_numpy()
        self.copies = table.column("copies").to_numpy()
        self.lengths = np.diff(column.offsets.to_numpy())
        vectors = matrix(column, width)
        points = unit(vectors) @ axes
        order = np.lexsort((self.keys, table.column("place").to_numpy()))
        self.keys, self.copies, self.lengths = self.keys[order], self.copies[order], self.lengths[order]
        self.vectors, self.points = vectors[order], points[order]
        squares = np.cumsum(self.points[:, ::-1] ** 2, axis=1)[:, ::-1]
        self.ends = list(range(LEAD, width, STEP)) + [width]
        self.ends = sorted({min(e, width) for e in self.ends})
        self.rest = {e: np.sqrt(squares[:, e]) if e < width else np.zeros(len(order)) for e in self.ends}
        self.blocks = [self.block(a, min(a + BLOCK, len(order))) for a in range(0, len(order), BLOCK)]

    def block(self, a: int, b: int):
        """(first row, last row, middle, largest angle to it, are the vectors of one length)"""
        points = self.points[a:b]
        middle = points.mean(axis=0)
        size = np.sqrt(middle @ middle)
        if size < SLACK:
            return a, b, points[0], math.pi, False
        middle = middle / size
        wide = float(np.arccos(np.clip(points @ middle, -1, 1)).max())
        return a, b, middle, wide, bool((self.lengths[a:b] == self.lengths[a]).all())


def all_or_none(x, y, one: Tile, other: Tile, limit: float) -> bool | None:
    """Do all pairs of two blocks link, or none, by the angles to their middles?"""
    between = math.acos(max(-1.0, min(1.0, float(x[2] @ y[2]))))
    loose = 1e-6  # of an angle: rounding near 1 costs half of the digits of a cosine
    if between + x[3] + y[3] <= limit - loose and x[4] and y[4] and one.lengths[x[0]] == other.lengths[y[0]]:
        return True
    return False if between - x[3] - y[3] > limit + loose else None


def linked(x, y, one: Tile, other: Tile, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """(row, row) of the pairs of two blocks that link."""
    a, b, c, d = *x[:2], *y[:2]
    low = threshold - SLACK
    first = one.ends[0]
    product = one.points[a:b, :first] @ other.points[c:d, :first].T
    open_ = product + one.rest[first][a:b, None] * other.rest[first][None, c:d] >= low
    i, j = np.nonzero(open_)
    product = product[i, j]
    i, j = i + a, j + c
    for start, end in zip(one.ends, one.ends[1:]):
        product = product + np.einsum("nd,nd->n", one.points[i, start:end], other.points[j, start:end])
        go_on = product + one.rest[end][i] * other.rest[end][j] >= low
        i, j, product = i[go_on], j[go_on], product[go_on]
    same = one.lengths[i] == other.lengths[j]
    i, j = i[same], j[same]
    v, w = one.vectors[i], other.vectors[j]
    v, w = v / np.abs(v).max(axis=1, keepdims=True), w / np.abs(w).max(axis=1, keepdims=True)
    cosine = np.einsum("nd,nd->n", v, w) / np.sqrt(np.einsum("nd,nd->n", v, v) * np.einsum("nd,nd->n", w, w))
    good = cosine >= threshold
    return i[good], j[good]


def joined(labels: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Give connected nodes one label, the smallest of their nodes."""
    while True:
        least = np.minimum(labels[i], labels[j])
        if (labels[i] == least).all() and (labels[j] == least).all():
            return
        for nodes in (labels[i], labels[j], i, j):  # the roots first, then the nodes
            np.minimum.at(labels, nodes, least)
        while (labels[labels] != labels).any():
            labels[:] = labels[labels]


def compared(one: Tile, other: Tile | None, threshold: float):
    """(keys, links by class, keys linked to a smaller row, that row's keys) of the pairs
    between two tiles, or within one."""
    limit = math.acos(threshold)
    second = one if other is None else other
    shift = 0 if other is None else len(one.keys)
    n = shift + len(second.keys)
    links, labels = np.zeros(n, np.int64), np.arange(n)
    for p, x in enumerate(one.blocks):
        for y in second.blocks[p if other is None else 0 :]:
            same = other is None and x[0] == y[0]
            whole = all_or_none(x, y, one, second, limit)
            if whole is False:
                continue
            rows, columns = np.arange(x[0], x[1]), np.arange(y[0], y[1])
            if whole:
                # sums of copies instead of pairs; within a block, not of the row itself
                links[rows] += second.copies[columns].sum() - (one.copies[rows] if same else 0)
                if not same:
                    links[columns + shift] += one.copies[rows].sum()
                joined(labels, np.full(len(rows), rows[0]), rows)
                joined(labels, np.full(len(columns), rows[0]), columns + shift)
                continue
            i, j = linked(x, y, one, second, threshold)
            if same:
                i, j = i[i < j], j[i < j]
            np.add.at(links, i, second.copies[j])
            np.add.at(links, j + shift, one.copies[i])
            joined(labels, i, j + shift)
    keys = one.keys if other is None else np.concatenate([one.keys, other.keys])
    return keys, links, labels


def tile_links(tiled: DataFrame, pairs: DataFrame, axes: np.ndarray, threshold: float) -> DataFrame:
    """(key, links, other): how many vectors of a tile each class links with, and a class
    that links connect it with (its own key if there is none)."""
    spark = tiled.sparkSession
    group = F.concat_ws("-", "i", "j")
    ends = pairs.select(group.alias("group"), F.col("i").alias("tile"), F.lit(0).alias("side")).union(
        pairs.filter("i < j").select(group.alias("group"), F.col("j").alias("tile"), F.lit(1).alias("side")))
    rows = tiled.join(ends, "tile").select("group", "side", "key", "copies", "v", "place")
    own = spark.sparkContext.broadcast(axes)

    def compare(table: pa.Table) -> pa.Table:
        side = table.column("side").to_numpy()
        one, other = (Tile(table.filter(pa.array(side == s)), own.value) if (side == s).any() else None
                      for s in (0, 1))
        keys, links, labels = compared(one, other, threshold)
        some = np.flatnonzero(links)
        return pa.table({"key": keys[some], "links": links[some], "other": keys[labels[some]]})

    return rows.groupBy("group").applyInArrow(compare, "key long, links long, other long")


# --- operator ------------------------------------------------------------------------------

def embedding_links(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                    threshold: float = 0.9) -> DataFrame:
    """Per row of ``rows``: id, ``n_links`` (other vectors whose cosine with it is at least
    the threshold), ``component_id`` (smallest id reachable by links) and ``kept`` (it is
    that row itself)."""
    spark = rows.sparkSession
    v = F.col(vector_col)
    given = rows.select(F.col(id_col).alias("id"), F.when(valid(vector_col), v).alias("v"))
    # minus zero and zero are one number, but hash apart
    given = given.withColumn("v", F.transform("v", lambda x: F.when(x == 0, F.abs(x)).otherwise(x)))
    given = given.withColumn("key", F.when(F.col("v").isNotNull(), F.xxhash64("v")))
    classes = given.filter("key IS NOT NULL").groupBy("key").agg(
        F.min("id").alias("id"), F.count("*").alias("copies"), F.first("v").alias("v"))
    classes = stored(classes, "embedding-classes")
    known = classes.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("width")).first()
    n, width = known["n"], known["width"] or 1
    axes = principal_axes(classes, width)

    fraction = min(1.0, SAMPLE / max(n, 1))
    drawn = classes.filter(F.pmod(F.xxhash64("key"), F.lit(1 << 20)) < int(fraction * (1 << 20))).limit(2 * SAMPLE)
    points = np.concatenate([np.zeros((0, width)), *(
        unit(matrix(batch.column("v"), width)) @ axes for batch in drawn.select("v").toArrow().to_batches()
        if batch.num_rows)])
    size = tile_size(n, width, spark.sparkContext.defaultParallelism)
    leaves = 1 << max(0, min(PLACES.bit_length() - 1, (max(n // BLOCK, 1)).bit_length()))
    place_rows = stored(placed(classes, axes, median_tree(points, leaves)), "embedding-places")
    counts = [(r["place"], r["count"]) for r in place_rows.groupBy("place").count().collect()]  # at most PLACES
    starts = spark.createDataFrame(tiles_of(counts, size), "place long, first long, several long")
    tiled = place_rows.join(F.broadcast(starts), "place").withColumn(
        "tile", F.col("first") + F.pmod(F.xxhash64("key", F.lit(1)), F.col("several")))
    axis = range(min(width, BOUNDED))
    bounds = tiled.groupBy("tile").agg(*[f(F.col("lead")[k]).alias(f"{f.__name__}{k}")
                                         for k in axis for f in (F.min, F.max)])
    bounds = bounds.select("tile", F.array(*[f"min{k}" for k in axis]).alias("low"),
                           F.array(*[f"max{k}" for k in axis]).alias("high"))
    pairs = stored(near_tiles(bounds, threshold), "embedding-tiles")  # so that Spark knows their size
    found = stored(tile_links(tiled, pairs, axes, threshold), "embedding-links")

    parts = components(found.select(F.col("key").alias("a"), F.col("other").alias("b")), native=False)
    named = classes.join(parts, F.col("key") == F.col("node"), "left").select(
        "key", "id", "copies", F.coalesce("component", "key").alias("part"))
    least = named.groupBy("part").agg(F.min("id").alias("component_id"))
    links = found.groupBy("key").agg(F.sum("links").alias("links"))
    named = named.join(least, "part").join(links, "key", "left").select(
        "key", "component_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    out = given.select("id", "key").join(named, "key", "left")
    component = F.when(F.col("key").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"))


ORACLE = """
    WITH RECURSIVE v AS (
        SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
        WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
            AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
    u AS (SELECT vec_id, e, sqrt(list_inner_product(e, e)) AS size FROM v),
    links AS (SELECT a.vec_id AS x, b.vec_id AS y FROM u a JOIN u b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
              WHERE list_inner_product(a.e, b.e) / (a.size * b.size) >= 0.9),
    reach AS (SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x),
    c AS (SELECT x, min(y) AS least FROM reach GROUP BY x),
    n AS (SELECT x, count(*) AS n_links FROM links GROUP BY x)
    SELECT vec_id, coalesce(n_links, 0)::BIGINT AS n_links, least(vec_id, coalesce(c.least, vec_id))::BIGINT AS component_id,
        vec_id = least(vec_id, coalesce(c.least, vec_id)) AS kept
    FROM embeddings LEFT JOIN n ON n.x = vec_id LEFT JOIN c ON c.x = vec_id
"""
