"""Document fingerprints (operator 4): SpotSigs.

A signature is an anchor and the chain of the ``CHAIN`` content words that follow
it.  Anchors are common words of English, German, French and Spanish (fixed
lists); content words are all others.  So that texts without common words have
signatures too, one content word in eight, chosen by its hash, is an anchor as
well.  A chain that the end of the text cuts short counts as it is, and a text
with words but without a signature has one of its whole sequence.  The
fingerprint of a text is the set of its signatures (32-bit hashes in ascending
order, as hexadecimal text); equal texts have equal fingerprints.

The likeness of two fingerprints is the Jaccard similarity of their sets.
``near_pairs`` finds all pairs of different fingerprints of at least a threshold:
sets are partitioned by their size, such that a pair can only lie in one partition
or two neighbouring ones, meet there by a signature of their prefixes, and are
compared with sizes and positions pruning what cannot reach the threshold.

``with_next`` gives each row the text of the next one in ascending order of ids
(after the last: the first).  Ids are cut into ranges at their quantiles; each
range is one task's, sorted, and holds the first row of the following range as a
look-ahead, so texts move once and no task sees more than its range.

Defined cases: null text reads as empty; texts without words have the empty
fingerprint, and two empty ones have the likeness 1; rows tied on the id are
ordered by text; null ids come first; a single row is its own next; an empty
table gives an empty one; other input columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.llm.common import whole_text
from tidelog.llm.texthash import BASE, U, letter_words, mix, sequence_hash, word_hashes

CHAIN = 2
# fixed values: common words of four languages
COMMON_WORDS = """
a an and are as at be by for from in is it of on or that the this to was were will with he she they we you not but
der die das und ist in den von zu mit sich des auf für nicht ein eine einer als auch es an er sie wird bei aus dem
le la les un une des du de et est en que qui dans pour par sur avec au aux il elle ne pas ce se plus ou
el los las del y es por con una su para como más al lo se no que en un esta son
""".split()
FOLD = letter_words()
COMMON = np.unique(word_hashes([w.encode() for w in COMMON_WORDS], FOLD)[0])
CHUNK = 1 << 20


def signature_sets(texts: list[bytes]) -> list[np.ndarray]:
    """The sorted distinct signatures of each text."""
    words, offsets = word_hashes(texts, FOLD)
    whole = sequence_hash(words, offsets)
    place = np.minimum(np.searchsorted(COMMON, words), len(COMMON) - 1)
    common = COMMON[place] == words
    anchors = np.flatnonzero(common | ((words & U(7)) == 0))
    content = np.flatnonzero(~common)
    text_of = np.searchsorted(offsets, anchors, "right") - 1
    ends = offsets[1:][text_of] if len(anchors) else anchors
    chain = words[anchors]
    follower = np.searchsorted(content, anchors, "right")
    some = np.zeros(len(anchors), bool)
    for i in range(CHAIN):
        at = content[np.minimum(follower + i, len(content) - 1)] if len(content) else anchors
        there = (follower + i < len(content)) & (at < ends)
        chain = chain * BASE + np.where(there, words[at], U(1))
        some |= there
    signs = (mix(chain) >> U(32)).astype(np.uint32)[some]
    cuts = np.searchsorted(anchors[some], offsets)
    out = []
    for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
        if b > a:
            out.append(np.unique(signs[a:b]))
        else:
            lone = (whole[i : i + 1] >> U(32)).astype(np.uint32)
            out.append(lone if offsets[i + 1] > offsets[i] else lone[:0])
    return out


def in_chunks(texts: list[bytes]) -> list[np.ndarray]:
    out, chunk, size = [], [], 0
    for text in texts:
        if chunk and size + len(text) > CHUNK:
            out += signature_sets(chunk)
            chunk, size = [], 0
        chunk.append(text)
        size += len(text)
    return out + (signature_sets(chunk) if chunk else [])


def fingerprint(signs: np.ndarray) -> str:
    return signs.astype(">u4").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two sorted sets."""
    if not len(a) or not len(b):
        return 1.0 if len(a) == len(b) else 0.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def fingerprints(df: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Per row: the ``keep`` columns and ``fingerprint``."""
    inner = [f"k{i}" for i in range(len(keep))]
    rows = df.select(*(F.col(k).alias(a) for k, a in zip(keep, inner)),
                     F.encode(whole_text(text_col), "UTF-8").alias("t"))
    fields = [T.StructField(a, rows.schema[a].dataType) for a in inner] + [T.StructField("f", T.StringType())]

    def run(batches):
        for batch in batches:
            found = [fingerprint(s) for s in in_chunks(batch.column("t").to_pylist())]
            yield pa.RecordBatch.from_arrays([*(batch.column(a) for a in inner), pa.array(found, pa.string())],
                                             [*inner, "f"])

    out = rows.mapInArrow(run, T.StructType(fields))
    return out.select(*(F.col(a).alias(k) for k, a in zip(keep, inner)), F.col("f").alias("fingerprint"))


# --- the next document ---------------------------------------------------------------

def in_ranges(rows: DataFrame) -> DataFrame:
    """Rows (id, t) with ``range`` and ``own``, dealt by range and sorted; the first rows
    of a range are also in the one before it (the first of all: in the last), not own."""
    spark = rows.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = rows.agg(F.percentile_approx("id", [i / n for i in range(1, n)], 100 * n).alias("c")).first()["c"] if n > 1 else []
    cuts = np.unique(np.array(cuts or [], np.int64))

    def ranges(ids: pd.Series) -> np.ndarray:
        known = ids.notna().to_numpy()
        out = np.zeros(len(ids), np.int64)
        out[known] = np.searchsorted(cuts, ids[known].to_numpy(np.int64), "left")
        return out

    range_of = F.pandas_udf(lambda ids: pd.Series(ranges(ids)), "int")
    # one row a range
    heads = rows.select("id", range_of("id").alias("r")).groupBy("r").agg(
        F.min("id").alias("id"), F.max(F.col("id").isNull().cast("int")).alias("nulls")).orderBy("r").toPandas()
    used = heads["r"].to_numpy()
    before = dict(zip(used, np.roll(used, 1)))
    first = {r: (None if nulls else int(i)) for r, i, nulls in zip(used, heads["id"], heads["nulls"])}

    def targets(ids: pd.Series) -> pd.Series:
        own = ranges(ids)
        return pd.Series([[int(r)] if (None if pd.isna(i) else int(i)) != first[r] else [int(r), -1 - int(before[r])]
                          for i, r in zip(ids, own)])

    targets_of = F.pandas_udf(targets, "array<int>")
    dealt = rows.select("id", "t", F.explode(targets_of("id")).alias("x"))
    dealt = dealt.select("id", "t", (F.col("x") >= 0).alias("own"),
                         F.when(F.col("x") >= 0, F.col("x")).otherwise(-1 - F.col("x")).alias("r"))
    wrap = ~F.col("own") & (F.col("r") == int(used[-1]) if len(used) else F.lit(False))
    return (dealt.repartitionById(max(1, len(cuts) + 1), F.col("r"))
            .sortWithinPartitions("r", wrap, "id", "own", "t"))


def next_likeness(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ``n_chars``, ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``,
    ``near_edited``, ``near_next``.  The edited text has its last quarter (rounded down,
    in code points) replaced by as many first code points of the next text."""
    rows = df.select(F.col(id_col).cast("long").alias("id"), whole_text(text_col).alias("t"))
    schema = ("id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
              "near_edited double, near_next double")

    def run(batches):
        # a pending row waits for the one behind it; the rows behind a range's end are not its own
        pending = None
        for batch in batches:
            ids, texts = batch.column("id").to_pylist(), batch.column("t").to_pylist()
            own, part = batch.column("own").to_pylist(), batch.column("r").to_pylist()
            for start in range(0, len(ids), 256):
                end = min(start + 256, len(ids))
                signs = in_chunks([t.encode() for t in texts[start:end]])
                rows = list(zip(ids[start:end], texts[start:end], own[start:end], part[start:end], signs))
                if pending is not None:
                    rows.insert(0, pending)
                out, edited = [], []
                for this, behind in zip(rows, rows[1:]):
                    if this[2] and this[3] == behind[3]:
                        n = len(this[1])
                        edited.append((this[1][: n - n // 4] + behind[1][: n // 4]).encode())
                        out.append((this, behind))
                pending = rows[-1]
                if out:
                    yield answer(out, edited)

    def answer(pairs, edited):
        changed = in_chunks(edited)
        columns = zip(*((this[0], len(this[1]), hashlib.sha256(e).hexdigest(), fingerprint(this[4]), fingerprint(s),
                         likeness(this[4], s), likeness(this[4], behind[4]))
                        for (this, behind), e, s in zip(pairs, edited, changed)))
        types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)],
                                          [c.split()[0] for c in schema.split(", ")])

    return in_ranges(rows).mapInArrow(run, schema).withColumnRenamed("id", id_col)


# --- pairs of near fingerprints ------------------------------------------------------------

def near_pairs(prints: DataFrame, threshold: float = 0.8, id_col: str = "doc_id") -> DataFrame:
    """From (id, ``fingerprint``): pairs (a, b, likeness) of the smallest ids of different
    fingerprints whose likeness is at least ``threshold``."""
    classes = prints.filter("fingerprint <> ''").groupBy("fingerprint").agg(F.min(id_col).alias("id"))
    n = F.length("fingerprint") / 8
    signs = F.transform(F.sequence(F.lit(0), n.cast("int") - 1),
                        lambda i: F.substring("fingerprint", i * 8 + 1, F.lit(8)))
    # sizes of sets that reach the threshold lie in one of these parts or in two that touch
    part = F.floor(F.log(n) / F.log(F.lit(1 / threshold)) + 1e-9).cast("int")
    sets = classes.select("id", signs.alias("signs"), n.cast("int").alias("n"), part.alias("part"))
    prefix = F.slice("signs", F.lit(1), F.col("n") - F.ceil(F.col("n") * threshold - 1e-9).cast("int") + 1)
    index = sets.select("id", "n", "part", F.posexplode(prefix).alias("at", "sign"))
    a, b = index.alias("a"), index.withColumn("meets", F.explode(F.array("part", F.col("part") - 1))).alias("b")
    least = F.ceil((F.col("a.n") + F.col("b.n")) * (threshold / (1 + threshold)) - 1e-9)
    left = F.least(F.col("a.n") - F.col("a.at"), F.col("b.n") - F.col("b.at"))
    met = ((F.col("a.sign") == F.col("b.sign")) & (F.col("a.part") == F.col("b.meets"))
           & ((F.col("a.part") < F.col("b.part")) | (F.col("a.id") < F.col("b.id")))
           & (F.least("a.n", "b.n") >= F.greatest("a.n", "b.n") * threshold - 1e-9)
           # signs before the first that both hold are not shared; those behind bound the rest
           & (left + F.least("a.at", "b.at") >= least))
    pairs = a.join(b, met).select(F.col("a.id").alias("x"), F.col("b.id").alias("y")).distinct()
    one, two = sets.select(F.col("id").alias("x"), F.col("signs").alias("sx")), sets.select(
        F.col("id").alias("y"), F.col("signs").alias("sy"))
    both = F.size(F.array_intersect("sx", "sy"))
    alike = both / (F.size("sx") + F.size("sy") - both)
    out = pairs.join(one, "x").join(two, "y").withColumn("likeness", alike).filter(F.col("likeness") >= threshold)
    return out.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), "likeness")
