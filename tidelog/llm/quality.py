"""Quality classifier (operator 8): random Fourier features over document statistics,
ridge scores from partition-summed normal equations, isotonic calibration.

``document_statistics`` gives each whole text a vector of statistics (shares of
kinds of characters, word and line lengths, repetition).  A fixed random draw of
``FEATURES`` cosines of the standardised statistics approximates a Gaussian
kernel.  Each partition of the labelled rows sums its part of the normal
equations; Spark adds the parts by matrix cell, and the driver solves the fixed
``FEATURES + 1`` unknowns.  Raw scores of labelled rows that were left out of the
fit are counted in bins of fixed width, and pooling adjacent violators over those
bins gives the calibration.  Nothing that reaches the driver grows with the input.

Folds: crc32 of the id as text modulo 5.  Remainder 0 is held out (never learned
from), remainder 4 calibrates, the others fit.  The text is read once, for the
statistics; those are stored and both learning and scoring read them.

Defined cases: null text reads as empty and gets the score of its statistics;
labels with a null id or label are no labels, of several labels of one id the
mean counts; rows with a null id are scored, not held out, and never learned
from; repeated rows get equal scores; without any labels to fit every score is
0.5; without any to calibrate the raw score is cut to 0..1; an empty table gives
an empty one; other input columns are ignored unless named in ``keep``.
"""

from __future__ import annotations

from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.llm.common import stored, whole_text

FEATURES = 256
BANDWIDTH = 3.0  # in standard deviations of a statistic
RIDGE = 1e-3  # per labelled row
CLIP = 4.0
SEED = 20240201
FOLDS = 5
BIN = 0.001
LOW, HIGH = -1.0, 2.0

STATISTICS = ("bytes", "letters", "upper", "digits", "space", "high", "stops", "quotes", "symbols", "bars", "bangs",
              "other", "words", "word_bytes", "distinct", "repeats", "lines", "line_bytes", "same_lines", "symbol_words",
              "entropy")


def byte_class() -> np.ndarray:
    """The kind of each byte value, as a column of the statistics."""
    kind = np.full(256, STATISTICS.index("other"))
    for name, members in (("letters", range(0x61, 0x7B)), ("upper", range(0x41, 0x5B)), ("digits", range(0x30, 0x3A)),
                          ("space", (9, 10, 11, 12, 13, 32)), ("high", range(0x80, 0x100)), ("stops", b".,;:?"),
                          ("quotes", b"'\"()-"), ("symbols", b"#$%&*@~^+=<>{}[]\\/_`"), ("bars", b"|"),
                          ("bangs", b"!")):
        kind[list(members)] = STATISTICS.index(name)
    return kind


KIND = byte_class()


def statistics(data: bytes) -> np.ndarray:
    """The statistics of one text (UTF-8)."""
    out = np.zeros(len(STATISTICS))
    n = len(data)
    if not n:
        return out
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    out += np.bincount(KIND, counts, minlength=len(STATISTICS)) / n
    share = counts[counts > 0] / n
    words, lines = data.split(), data.split(b"\n")
    k = max(1, len(words))
    solid = n - int(counts[[9, 10, 11, 12, 13, 32]].sum())
    at = STATISTICS.index
    out[at("bytes")] = np.log1p(n)
    out[at("words")] = np.log1p(len(words))
    out[at("word_bytes")] = np.log1p(solid / k)
    out[at("distinct")] = len(set(words)) / k
    out[at("repeats")] = sum(map(eq, words, words[1:])) / k
    out[at("lines")] = np.log1p(len(lines))
    out[at("line_bytes")] = np.log1p(n / len(lines))
    out[at("same_lines")] = 1 - len(set(lines)) / len(lines)
    out[at("symbol_words")] = int(counts[list(b"#$%&*!|")].sum()) / k
    out[at("entropy")] = float(-(share * np.log2(share)).sum())
    return out


def document_statistics(df: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Per row: the ``keep`` columns and ``stats`` (array of float, in the order of STATISTICS)."""
    inner = [f"k{i}" for i in range(len(keep))]
    rows = df.select(*(F.col(k).alias(a) for k, a in zip(keep, inner)),
                     F.encode(whole_text(text_col), "UTF-8").alias("t"))
    fields = [T.StructField(a, rows.schema[a].dataType) for a in inner]
    fields.append(T.StructField("stats", T.ArrayType(T.FloatType())))

    def run(batches):
        for batch in batches:
            stats = [statistics(v.as_py()).astype(np.float32) for v in batch.column("t")]
            yield pa.RecordBatch.from_arrays([*(batch.column(a) for a in inner),
                                              pa.array(stats, pa.list_(pa.float32()))], [*inner, "stats"])

    out = rows.mapInArrow(run, T.StructType(fields))
    return out.select(*(F.col(a).alias(k) for k, a in zip(keep, inner)), "stats")


def matrix(column: pa.Array) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(-1, len(STATISTICS))


class Cosines:
    """Random Fourier features of standardised statistics, and a column of ones."""

    def __init__(self, mean: np.ndarray, deviation: np.ndarray):
        rng = np.random.default_rng(SEED)
        self.mean, self.deviation = mean, np.where(deviation > 1e-9, deviation, 1.0)
        self.w = rng.normal(0.0, 1.0 / BANDWIDTH, (len(STATISTICS), FEATURES))
        self.b = rng.uniform(0.0, 2 * np.pi, FEATURES)

    def __call__(self, stats: np.ndarray) -> np.ndarray:
        x = np.clip((stats - self.mean) / self.deviation, -CLIP, CLIP)
        z = np.cos(x @ self.w + self.b) * np.sqrt(2.0 / FEATURES)
        return np.column_stack([z, np.ones(len(z))])


def fold(id_col: str) -> Column:
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(FOLDS))


def pooled(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The nondecreasing fit to values (pooling adjacent violators)."""
    blocks: list[list[float]] = []
    for v, w in zip(values, weights):
        blocks.append([v, w, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            v2, w2, n2 = blocks.pop()
            v1, w1, n1 = blocks.pop()
            blocks.append([(v1 * w1 + v2 * w2) / (w1 + w2), w1 + w2, n1 + n2])
    return np.concatenate([np.full(int(n), v) for v, _, n in blocks]) if blocks else np.empty(0)


class QualityModel:
    """Weights of the cosines and the calibration of raw scores."""

    def __init__(self, cosines: Cosines, weights: np.ndarray | None, at: np.ndarray, value: np.ndarray):
        self.cosines, self.weights, self.at, self.value = cosines, weights, at, value

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return np.clip(self.cosines(stats) @ self.weights, LOW, HIGH)

    def score(self, stats: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(stats), 0.5)
        raw = self.raw(stats)
        return np.clip(np.interp(raw, self.at, self.value) if len(self.at) else raw, 0.0, 1.0)


def fit(stats: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality") -> QualityModel:
    """Learn from statistics (id, ``stats``) and labels (id, 0/1)."""
    each = [F.col("stats")[i].cast("double") for i in range(len(STATISTICS))]
    row = stats.agg(*(F.avg(c).alias(f"m{i}") for i, c in enumerate(each)),
                    *(F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(each))).first()
    d = len(STATISTICS)
    cosines = Cosines(np.array([x or 0.0 for x in row[:d]]), np.array([x or 0.0 for x in row[d:]]))

    labels = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("double").alias("y"))
              .filter("id IS NOT NULL AND y IS NOT NULL").filter(fold("id") != 0)
              .groupBy("id").agg(F.avg("y").alias("y")))
    rows = (stats.select(F.col(id_col).alias("id"), "stats").join(labels, "id")
            .select("stats", "y", fold("id").cast("int").alias("fold")))
    size = FEATURES + 1

    def sums(batches):
        a, b, n = np.zeros((size, size)), np.zeros(size), 0
        for batch in batches:
            z, y = cosines(matrix(batch.column("stats"))), batch.column("y").to_numpy(zero_copy_only=False)
            a += z.T @ z
            b += z.T @ y
            n += len(y)
        if n:
            upper = np.triu_indices(size)
            cell = np.concatenate([upper[0] * size + upper[1], size * size + np.arange(size), [size * (size + 1)]])
            value = np.concatenate([a[upper], b, [float(n)]])
            yield pa.RecordBatch.from_arrays([pa.array(cell, pa.int32()), pa.array(value)], ["cell", "value"])

    parts = rows.filter(F.col("fold") != FOLDS - 1).mapInArrow(sums, "cell int, value double")
    cells = parts.groupBy("cell").agg(F.sum("value").alias("value")).toPandas()
    if cells.empty:
        return QualityModel(cosines, None, np.empty(0), np.empty(0))
    flat = np.zeros(size * (size + 1) + 1)
    flat[cells["cell"].to_numpy()] = cells["value"].to_numpy()
    a = flat[: size * size].reshape(size, size)
    a = a + np.triu(a, 1).T
    n = flat[-1]
    penalty = np.full(size, RIDGE * n)
    penalty[-1] = 0.0  # the ones carry the mean
    weights = np.linalg.solve(a + np.diag(penalty + 1e-9), flat[size * size : -1])
    model = QualityModel(cosines, weights, np.empty(0), np.empty(0))

    def bins(batches):
        for batch in batches:
            raw = model.raw(matrix(batch.column("stats")))
            yield pa.RecordBatch.from_arrays([pa.array(np.round(raw / BIN), pa.float64()).cast(pa.int32()),
                                              batch.column("y")], ["bin", "y"])

    found = (rows.filter(F.col("fold") == FOLDS - 1).mapInArrow(bins, "bin int, y double")
             .groupBy("bin").agg(F.avg("y").alias("y"), F.count("*").alias("n")).toPandas().sort_values("bin"))
    if not found.empty:
        model.at = found["bin"].to_numpy() * BIN
        model.value = pooled(found["y"].to_numpy(), found["n"].to_numpy().astype(float))
    return model


def score(stats: DataFrame, model: QualityModel, id_col: str = "doc_id") -> DataFrame:
    """Per row of the statistics: id, ``held_out``, ``score``."""
    rows = stats.select(F.col(id_col).alias("id"), "stats",
                        F.coalesce(fold(id_col) == 0, F.lit(False)).alias("held_out"))
    schema = T.StructType([rows.schema["id"], T.StructField("held_out", T.BooleanType()),
                           T.StructField("score", T.DoubleType())])

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("held_out"),
                                              pa.array(model.score(matrix(batch.column("stats"))))],
                                             ["id", "held_out", "score"])

    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   label_col: str = "quality") -> DataFrame:
    """Per row of ``docs``: id, ``held_out``, ``score`` (0 to 1; higher: label 1 likelier)."""
    stats = stored(document_statistics(docs, text_col, (id_col,)), "quality-statistics")
    return score(stats, fit(stats, labels, id_col, label_col), id_col)


def keep_quality(docs: DataFrame, labels: DataFrame, cut: float, id_col: str = "doc_id", text_col: str = "text",
                 label_col: str = "quality") -> DataFrame:
    """The rows of ``docs`` whose score is at least ``cut``, as they are.  The texts are
    read again and scored where they lie, row by row: nothing but the model moves."""
    model = fit(stored(document_statistics(docs, text_col, (id_col,)), "quality-statistics"), labels, id_col, label_col)

    def run(batches):
        for batch in batches:
            texts = batch.column(text_col).cast(pa.large_binary())
            if batch.num_rows:
                stats = np.array([statistics(v.as_py() or b"").astype(np.float32) for v in texts], dtype=np.float64)
                yield batch.filter(pa.array(model.score(stats) >= cut))

    return docs.mapInArrow(run, docs.schema)
