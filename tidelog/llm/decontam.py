"""Benchmark decontamination (operator 10): spaced-seed hashing.

Texts become words (runs of letters and digits in lower case).  A window of
``WINDOW`` words of a document is an overlap with a benchmark item when at least
``MATCHES`` of its words equal the item's words at the same places: substituted
words are tolerated.  Items of fewer words than a window (but at least a seed's)
have to occur as a whole, word by word; still shorter ones are no evidence.

Hits come from seeds that look at six words and ignore what lies between them.
The masks, over words in blocks of three, are ``##``, ``#.#`` and ``#..#``.  Of the
four blocks of a window, at most two hold a substituted word, and any two blocks
left whole are one of these masks at some offset: no overlap is lost.  Seeds of
the documents meet those of the benchmark in a hash join; around every hit the
whole diagonal (item laid along the document) is compared word by word.

Everything is DataFrame functions.  The benchmark's seeds are broadcast in parts
of about ``PART_POSITIONS`` positions, whose number is counted first; a larger
benchmark takes more passes over the documents, never a larger broadcast.

Result: a row per document and item with an overlap.  Defined cases: null text
reads as empty; repeated documents (same id, same text) give one row an item;
null ids match as one id; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import stored, whole_text

BLOCK = 3  # words to a block of a mask
GAPS = (1, 2, 3)  # blocks from the first to the second that a mask looks at
SEED = 2 * BLOCK  # words that a seed looks at
WINDOW = 4 * BLOCK
MATCHES = 10
PART_POSITIONS = 200_000


def word_codes(text: Column) -> Column:
    """The hashes of a text's words, in order."""
    words = F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), 0)
    return F.transform(words, lambda w: F.xxhash64(w))


def rest(array: Column, first: int) -> Column:
    """An array from its element ``first`` (from 0) on."""
    return F.slice(array, F.lit(first + 1), F.greatest(F.size(array) - first, F.lit(0)))


def pairwise(a: Column, b: Column, join) -> Column:
    return F.slice(F.zip_with(a, b, join), F.lit(1), F.least(F.size(a), F.size(b)))


def positions(rows: DataFrame, id_col: str) -> DataFrame:
    """From (id, ``codes``): a row per position with a whole block, with the hash of the
    block there (``b0``) and of those 1, 2 and 3 blocks on (null where there is none)."""
    two = pairwise(F.col("codes"), rest(F.col("codes"), 1), lambda a, b: F.xxhash64(a, b))
    rows = rows.select(id_col, two.alias("two"), rest(F.col("codes"), 2).alias("third"))
    rows = rows.select(id_col, pairwise(F.col("two"), F.col("third"), lambda a, b: F.xxhash64(a, b)).alias("b0"))
    zipped = F.arrays_zip("b0", *(rest(F.col("b0"), BLOCK * g).alias(f"b{g}") for g in GAPS))
    out = rows.select(id_col, F.posexplode(zipped).alias("pos", "b"))
    return out.select(id_col, "pos", "b.*")


def seeds(rows: DataFrame, *cols: str) -> DataFrame:
    """A row per seed: (gap, hash)."""
    each = F.array(*(F.struct(F.lit(g).alias("gap"), F.col(f"b{g}").alias("second")) for g in GAPS))
    out = rows.select(*cols, "pos", "b0", F.explode(each).alias("s")).filter("s.second IS NOT NULL")
    return out.select(*cols, "pos", F.xxhash64("s.gap", "b0", "s.second").alias("seed"))


def diagonals(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Distinct (doc, item, diagonal) on which a seed of both meets, from (doc, ``codes``)
    and (item, ``codes``)."""
    own = stored(positions(items, "item"), "decontamination-seeds")
    parts = max(1, -(-own.count() // PART_POSITIONS))
    found = []
    for part in range(parts):
        some = own.filter(F.pmod(F.xxhash64("item", "pos"), F.lit(parts)) == part)
        # about PART_POSITIONS rows, three seeds each
        here = positions(docs, "doc").join(F.broadcast(some.select("b0").distinct()), "b0", "left_semi")
        theirs = seeds(some, "item").withColumnRenamed("pos", "q")
        hits = seeds(here, "doc").join(F.broadcast(theirs), "seed")
        found.append(hits.select("doc", "item", (F.col("pos") - F.col("q")).alias("diagonal")).distinct())
    return reduce(DataFrame.union, found).distinct()


def overlaps(docs: DataFrame, benchmark: DataFrame, doc_col: str = "doc_id", text_col: str = "text",
             item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """A row per document and benchmark item that overlap: their ids, ``matched`` (most
    equal words of a window), ``item_words``, and the overlap's words in the document
    (``first_word``, ``end_word``: from the first to the end of the last such window)."""
    texts = docs.select(F.col(doc_col).alias("doc"), whole_text(text_col).alias("t"))
    items = benchmark.select(F.col(item_col).alias("item"), word_codes(whole_text(item_text_col)).alias("codes"))
    lines = diagonals(texts.select("doc", word_codes(F.col("t")).alias("codes")), items)

    theirs = items.dropDuplicates().select(F.col("item").alias("item_id_"), F.col("codes").alias("item_codes"))
    lines = lines.join(theirs, F.col("item").eqNullSafe(F.col("item_id_"))).drop("item_id_")
    rows = lines.join(texts.withColumnRenamed("doc", "doc_"), F.col("doc").eqNullSafe(F.col("doc_"))).drop("doc_")
    rows = rows.withColumn("codes", word_codes(F.col("t"))).drop("t")
    # words of the item that lie on the document
    first = F.greatest(F.lit(0), -F.col("diagonal"))
    end = F.least(F.size("item_codes"), F.size("codes") - F.col("diagonal"))
    rows = rows.withColumns({"first": first, "n": end - first, "item_words": F.size("item_codes")})
    same = F.zip_with(F.slice("item_codes", F.col("first") + 1, F.col("n")),
                      F.slice("codes", F.col("first") + F.col("diagonal") + 1, F.col("n")),
                      lambda a, b: (a == b).cast("int"))
    width = F.least(F.lit(WINDOW), F.col("item_words"))
    need = F.when(F.col("item_words") < WINDOW, F.col("item_words")).otherwise(F.lit(MATCHES))
    rows = rows.select("doc", "item", "diagonal", "first", "n", "item_words", same.alias("same"),
                       width.alias("width"), need.alias("need")).filter("n >= width")

    def in_window(i):
        return F.aggregate(F.slice("same", i + 1, F.col("width")), F.lit(0), lambda s, x: s + x)

    rows = rows.withColumn("sums", F.transform(F.sequence(F.lit(0), F.col("n") - F.col("width")), in_window))
    rows = rows.filter(F.array_max("sums") >= F.col("need"))
    at = F.filter(F.sequence(F.lit(0), F.col("n") - F.col("width")),
                  lambda i: F.element_at("sums", i + 1) >= F.col("need"))
    start = F.col("first") + F.col("diagonal")
    rows = rows.select("doc", "item", "item_words", F.array_max("sums").alias("matched"),
                       (start + F.array_min(at)).alias("first_word"),
                       (start + F.array_max(at) + F.col("width")).alias("end_word"))
    out = rows.groupBy("doc", "item").agg(F.max("matched").alias("matched"), F.max("item_words").alias("item_words"),
                                          F.min("first_word").alias("first_word"), F.max("end_word").alias("end_word"))
    return out.select(F.col("doc").alias(doc_col), F.col("item").alias(item_col),
                      *(F.col(c).cast("long").alias(c) for c in ("matched", "item_words", "first_word", "end_word")))


def decontaminated(docs: DataFrame, benchmark: DataFrame, doc_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that overlap with no benchmark item, as they are."""
    hit = overlaps(docs, benchmark, doc_col, text_col).select(F.col(doc_col).alias("hit_")).distinct()
    return docs.join(hit, F.col(doc_col).eqNullSafe(F.col("hit_")), "left_anti")


ORACLE = r"""
    WITH d AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w FROM documents),
    b AS (SELECT item_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w FROM benchmark),
    dw AS (SELECT doc_id, len(w) AS n, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS p FROM d),
    bw AS (SELECT item_id, len(w) AS m, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS q FROM b),
    e AS (SELECT doc_id, item_id, p - q AS diagonal, q, m, n FROM dw JOIN bw USING (word) WHERE m >= 6),
    s AS (SELECT *, count(*) OVER (PARTITION BY doc_id, item_id, diagonal ORDER BY q
            RANGE BETWEEN CURRENT ROW AND 11 FOLLOWING) AS k0 FROM e),
    -- windows may also start at a word that differs
    c AS (SELECT doc_id, item_id, diagonal, m, n, unnest(range(greatest(0, q - 2), q + 1)) AS start
          FROM s WHERE k0 >= least(m, 10)),
    u AS (SELECT DISTINCT doc_id, item_id, diagonal, m, n, start, least(m, 12) AS width FROM c
          WHERE start + least(m, 12) <= m AND start + diagonal >= 0 AND start + diagonal + least(m, 12) <= n),
    v AS (SELECT u.doc_id, u.item_id, u.diagonal, u.m, u.start, u.width, count(*) AS k
          FROM u JOIN e ON e.doc_id = u.doc_id AND e.item_id = u.item_id AND e.diagonal = u.diagonal
              AND e.q >= u.start AND e.q < u.start + u.width
          GROUP BY ALL)
    SELECT doc_id, item_id, max(k) AS matched, max(m) AS item_words, min(start + diagonal) AS first_word,
        max(start + diagonal + width) AS end_word
    FROM v WHERE k >= CASE WHEN m < 12 THEN m ELSE 10 END GROUP BY doc_id, item_id
"""
