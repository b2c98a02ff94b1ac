"""Periodic runs of words, by an online diagonal DP over sparse lags (operator 11).

A run is a stretch of words with smallest period q (words q apart are identical) of
at least ``LEAST`` words and ``TIMES`` periods, that no neighbouring word extends.
The lag q is a diagonal of the text against itself; a run of length L is a stretch of
L - q matches on it.  The words are read in order.  At each word, lags of its earlier
occurrences increment the match lengths of their diagonals; a diagonal that is active
and not incremented has ended, and is emitted at once if it is long enough.

Taking all earlier occurrences would be quadratic for frequent words, so a lag must
also be that of a context.  For lags of (G/2, G], G a power of two, the context is the
G words that end at the word, and the lag that of their nearest earlier occurrence, if
it lies in these bounds: at most one lag a scale.  Nothing is lost.  Where the G words
and the q before them lie in a run of smallest period q <= G, an occurrence at a nearer
lag d would give a stretch of G + d >= q + d words the periods q and d, hence that of
their greatest common divisor, against q being smallest.  So each such word
increments lag q, and since a run has at least TIMES >= 3 periods, some do.  For the
same reason a diagonal that ends long enough has q as smallest period, and begins and
ends where the run does.

Contexts are numbered exactly, by pairs of the numbers of their halves; only contexts
that occur twice go on to the next scale, which leaves few words of ordinary prose.

A text is handled alone, where it lies: no shuffle; memory is a few integers for each
word of a block of texts.  Defined cases: null and empty texts have no words and no
runs; a run may overlap others of other periods; a null id stays null; repeated rows
give equal rows; an empty table gives an empty one; other input columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import byte_chunks, whole_text

LEAST, TIMES = 6, 4
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def context(lag: int) -> int:
    """Words of the context that tells a lag: the least power of two not below it."""
    return 1 << (lag - 1).bit_length()


def sparse_lags(ids: np.ndarray, doc: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """(position, lag) of all lags up to ``longest`` that contexts give, in order of
    position; ``ids`` number the words of several texts, ``doc`` the texts."""
    at = np.arange(len(ids))
    key = doc * (int(ids.max()) + 1) + ids if len(ids) else ids
    found, size = [], 1
    while len(at) and size // 2 < longest:
        order = np.argsort(key, kind="stable")
        at, key = at[order], key[order]
        same = key[1:] == key[:-1]
        lag = at[1:] - at[:-1]
        hit = same & (lag > size // 2) & (lag <= min(size, longest))
        found.append((at[1:][hit], lag[hit]))
        twice = np.append(False, same) | np.append(same, False)
        number = np.full(len(ids), -1)
        number[at[twice]] = np.cumsum(np.append(False, ~same))[twice]
        end = np.sort(at[twice])
        end = end[end >= size]
        at = end[(number[end - size] >= 0) & (doc[end - size] == doc[end])]
        key = number[at - size] * (len(ids) + 1) + number[at]
        size *= 2
    if not found:
        return np.empty(0, int), np.empty(0, int)
    position, lag = (np.concatenate(c) for c in zip(*found))
    order = np.lexsort((lag, position))
    return position[order], lag[order]


def runs(ids: np.ndarray, doc: np.ndarray, longest: int, least: int = LEAST, times: int = TIMES):
    """(start, length, period) of all runs as their diagonals end, in positions of ``ids``."""
    active: dict[int, int] = {}  # lag -> words that match so far
    before = -1

    def ended(diagonals, end):
        for lag, matched in diagonals.items():
            length = matched + lag
            if length >= max(least, times * lag):
                yield end - length, length, lag

    position, lag = sparse_lags(ids, doc, longest)
    cuts = np.flatnonzero(np.diff(position)) + 1
    for at, lags in zip(position[np.append(0, cuts)].tolist() if len(position) else [],
                        np.split(lag, cuts)):
        if at != before + 1:
            yield from ended(active, before + 1)
            active = {}
        longer = {}
        for q in lags.tolist():
            matched = active.pop(q, None)
            longer[q] = context(q) if matched is None else matched + 1
        yield from ended(active, at)
        active, before = longer, at
    yield from ended(active, before + 1)


def collapsed(words: list[bytes], found: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those that a run holds behind its first period."""
    kept, at = [], 0
    for start, end in sorted((start + period, start + length) for start, length, period in found):
        if start > at:
            kept += words[at:start]
        at = max(at, end)
    return kept + words[at:] if at else words


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST,
                  times: int = TIMES) -> DataFrame:
    """Per row of ``docs``: id, ``n_words``, the ``runs`` (start, length, period) by start
    and period, and ``collapsed``: the words joined by one space, each run cut to its
    first period.  ``times`` is at least 3."""
    if times < 3:
        raise ValueError("a run has at least three periods")

    def detect(batches):
        for batch in batches:
            counts, lists, texts = [], [], []
            for _, chunk in byte_chunks(batch.column("t")):
                split = [text.split() for text in chunk]  # bytes: white space is 09 to 0D and 20
                numbers: dict[bytes, int] = {}
                ids = np.array([numbers.setdefault(w, len(numbers)) for words in split for w in words], np.int64)
                lengths = [len(words) for words in split]
                starts = np.cumsum([0, *lengths])
                doc = np.repeat(np.arange(len(split)), lengths)
                own: list[list] = [[] for _ in split]
                for start, length, period in runs(ids, doc, max(lengths) // times, least, times):
                    d = int(doc[start])
                    own[d].append((start - int(starts[d]), length, period))
                for words, found in zip(split, own):
                    found.sort(key=lambda r: (r[0], r[2]))
                    counts.append(len(words))
                    lists.append([{"start": s, "length": n, "period": q} for s, n, q in found])
                    texts.append(b" ".join(collapsed(words, found)))
            run = pa.struct([(c, pa.int64()) for c in ("start", "length", "period")])
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(counts, pa.int64()), pa.array(lists, pa.list_(run)),
                 pa.array(texts, pa.binary())], ["id", "n_words", "runs", "collapsed"])

    rows = docs.select(F.col(id_col).alias("id"), F.encode(whole_text(text_col), "UTF-8").alias("t"))
    id_type = rows.schema["id"].dataType.simpleString()
    out = rows.mapInArrow(detect, f"id {id_type}, n_words long, runs {RUNS}, collapsed binary")
    return out.withColumn("collapsed", F.decode("collapsed", "UTF-8")).withColumnRenamed("id", id_col)


def looped(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id and text; with h the CRC-32 of the decimal id, one text in ten
    (h % 10 = 0) repeats a stretch of its words to its end.  Null ids stay as they are."""
    h = F.crc32(F.encode(F.col(id_col).cast("string"), "UTF-8"))
    g = F.floor(h / 10)
    words = F.filter(F.split(whole_text(text_col), "[\\x20\\x09-\\x0D]+", -1), lambda w: w != "")
    n = F.size("words_").cast("long")
    rows = docs.select(F.col(id_col), whole_text(text_col).alias(text_col), g.alias("g_"),
                       F.when(h % 10 == 0, words).alias("words_"))
    a = F.col("g_") % n
    p = 1 + F.floor((n - a) / (3 + F.col("g_") % 8))
    again = F.array_join(F.transform("words_", lambda w, i: F.when(i < a, w).otherwise(
        F.get("words_", (a + (i - a) % p).cast("int")))), " ")
    return rows.select(id_col, F.when(n > 0, again).otherwise(F.col(text_col)).alias(text_col))


def longest_run(found: str = "runs"):
    """The run of greatest length (ties: smallest start, then period), or null."""
    ranked = F.transform(found, lambda r: F.struct((-r["length"]).alias("l"), r["start"].alias("start"),
                                                   r["period"].alias("period")))
    first = F.array_min(ranked)
    return F.struct(first["start"].alias("start"), (-first["l"]).alias("length"), first["period"].alias("period"))


def run_lines(found: str = "runs"):
    """Every run as ``start,length,period`` and a line feed."""
    return F.array_join(F.transform(found, lambda r: F.concat(
        r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"),
        F.lit("\n"))), "")


# --- the same in SQL: all pairs of equal words up to a quarter of the text apart ------------------

ORACLE = r"""
    WITH d AS (
        SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
            xor(list_reduce(flatten(list_transform(
                list_prepend(4294967295, list_transform(range(1, length(doc_id::VARCHAR) + 1),
                    lambda i: ascii(substr(doc_id::VARCHAR, i, 1))::BIGINT)),
                lambda b: CASE WHEN b > 255 THEN [b] ELSE [b, -1, -1, -1, -1, -1, -1, -1, -1] END)),
                lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END),
                4294967295) AS h
        FROM documents),
    g AS (SELECT *, len(w)::BIGINT AS n, h // 10 AS g FROM d),
    a AS (SELECT *, CASE WHEN n > 0 THEN g % n END AS a FROM g),
    l AS (SELECT doc_id, n, w, CASE WHEN h % 10 = 0 AND n > 0 THEN a ELSE n END AS a,
              CASE WHEN h % 10 = 0 AND n > 0 THEN 1 + (n - a) // (3 + g % 8) ELSE 1 END AS p FROM a),
    e AS (SELECT doc_id, n, i, w[(CASE WHEN i < a THEN i ELSE a + (i - a) % p END) + 1] AS word
          FROM (SELECT *, unnest(range(n)) AS i FROM l)),
    pairs AS (SELECT y.doc_id, y.i, y.i - x.i AS q FROM e x JOIN e y ON x.doc_id = y.doc_id AND x.word = y.word
              AND x.i < y.i AND 4 * (y.i - x.i) <= y.n),
    diagonals AS (SELECT doc_id, q, min(i) - q AS start, count(*) + q AS length
                  FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM pairs)
                  GROUP BY doc_id, q, island),
    r AS (SELECT doc_id, start, length, min(q) AS period FROM diagonals
          WHERE length >= 6 AND length >= 4 * q GROUP BY doc_id, start, length),
    t AS (SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), ''
              ORDER BY start, period) AS lines FROM r GROUP BY doc_id),
    top AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY length DESC, start, period) = 1),
    dropped AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM r),
    k AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS words FROM e ANTI JOIN dropped USING (doc_id, i)
          GROUP BY doc_id)
    SELECT l.doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period,
        1000 * length // period AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256,
        sha256(coalesce(words, '')) AS collapsed_sha256
    FROM l LEFT JOIN t USING (doc_id) LEFT JOIN top USING (doc_id) LEFT JOIN k USING (doc_id)
"""
