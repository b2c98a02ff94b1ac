"""Fill-in-middle transformation by in-place block rotation (operator 12).

A text is a sequence of units, each a word with the white space before it (white
space at the end is a unit of its own).  Two cuts between units, drawn from a hash
of seed and id, make it prefix, middle and suffix.  The bytes of the text lie in one
bytearray: the cuts are found by one scan, the three sentinels are inserted where the
segments begin, and neighbouring segments are exchanged by a rotation, which is three
reversals in place:

* ``psm``: prefix, suffix, middle (middle and suffix change places);
* ``spm``: suffix, prefix, middle (the suffix goes before the other two).

The inverse rotation and the removal of the sentinels give back the text, byte for
byte, from the output and its form alone.

Both steps are narrow: a text is handled alone, where it lies, without a shuffle, and
besides the text a task holds one buffer of fixed size for the reversals.

Defined cases: null text reads as empty; an empty text, one that holds a sentinel, and
one that the draw leaves out stay ``plain``; a text of white space only is one unit;
cuts at the same place or at the ends give empty segments, whose sentinels stay; a
null id draws as the empty id; equal ids and texts give equal rows; an empty table
gives an empty one; other input columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import whole_text

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
SWAPPED = 1 << 16  # bytes that a reversal exchanges at a time


# --- rotations ------------------------------------------------------------------------

def reverse(data: np.ndarray, lo: int, hi: int) -> None:
    """Reverse data[lo:hi] in place, from both ends towards the middle."""
    while hi - lo > 1:
        n = min(SWAPPED, (hi - lo) // 2)
        left = data[lo : lo + n].copy()
        data[lo : lo + n] = data[hi - n : hi][::-1]
        data[hi - n : hi] = left[::-1]
        lo, hi = lo + n, hi - n


def rotate(buffer: bytearray, lo: int, mid: int, hi: int) -> None:
    """Exchange buffer[lo:mid] and buffer[mid:hi] in place."""
    data = np.frombuffer(buffer, np.uint8)
    reverse(data, lo, mid)
    reverse(data, mid, hi)
    reverse(data, lo, hi)


def arrange(buffer: bytearray, a: int, b: int, form: str) -> None:
    """From prefix buffer[:a], middle buffer[a:b] and suffix to the output of the form."""
    buffer[b:b] = SUFFIX
    buffer[a:a] = MIDDLE
    buffer[0:0] = PREFIX
    a, b = a + len(PREFIX), b + len(PREFIX) + len(MIDDLE)
    rotate(buffer, a if form == PSM else 0, b, len(buffer))


def restore(buffer: bytearray, form: str) -> None:
    """From the output of the form back to the text."""
    n = len(buffer)
    if form == PSM:
        b = buffer.find(SUFFIX)
        a = buffer.find(MIDDLE, b)
        rotate(buffer, b, a, n)
        a, b = b, b + n - a
    else:
        b = buffer.find(PREFIX)
        rotate(buffer, 0, b, n)
        a, b = buffer.find(MIDDLE), n - b
    del buffer[b : b + len(SUFFIX)]
    del buffer[a : a + len(MIDDLE)]
    del buffer[: len(PREFIX)]


# --- cuts -------------------------------------------------------------------------------

def unit_ends(text: bytes) -> np.ndarray:
    """The byte behind each unit."""
    data = np.frombuffer(text, np.uint8)
    word = np.append((data != 32) & ((data < 9) | (data > 13)), False)
    ends = np.flatnonzero(word[:-1] & ~word[1:]) + 1
    return np.append(ends, len(data)) if len(data) and not word[len(data) - 1] else ends


def code_points(text: bytes) -> int:
    return int(np.count_nonzero((np.frombuffer(text, np.uint8) & 0xC0) != 0x80))


def draws(seed: int, name: str) -> tuple[int, int, int, int]:
    digest = hashlib.sha256(f"{seed}:{name}".encode()).hexdigest()
    return tuple(int(digest[i : i + 8], 16) for i in (0, 8, 16, 24))


def form_of(text: bytes, h3: int, h4: int, rate: int, spm_rate: int) -> str:
    if not text or h3 % 100 >= rate or any(s in text for s in (PREFIX, SUFFIX, MIDDLE)):
        return PLAIN
    return SPM if h4 % 100 < spm_rate else PSM


# --- operators -----------------------------------------------------------------------------

def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 42, rate: int = 50,
                   spm_rate: int = 80) -> DataFrame:
    """Per row of ``docs``: id, ``n`` units, ``form``, ``prefix_chars`` and
    ``middle_chars`` (null if plain) and the ``output``.  ``rate`` percent of the texts
    are transformed, ``spm_rate`` percent of those to ``spm``."""

    def transform(batches):
        for batch in batches:
            rows = []
            for name, value in zip(batch.column("name").to_pylist(), batch.column("t")):
                text = value.as_py()
                ends = unit_ends(text)
                n = len(ends)
                h1, h2, h3, h4 = draws(seed, name)
                form = form_of(text, h3, h4, rate, spm_rate)
                if form == PLAIN:
                    rows.append((n, form, None, None, text))
                    continue
                cuts = np.append(0, ends)[sorted((h1 % (n + 1), h2 % (n + 1)))]
                a, b = map(int, cuts)
                buffer = bytearray(text)
                arrange(buffer, a, b, form)
                rows.append((n, form, code_points(text[:a]), code_points(text[a:b]), bytes(buffer)))
            n, form, prefix, middle, output = zip(*rows) if rows else ((),) * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(n, pa.int64()), pa.array(form, pa.string()),
                 pa.array(prefix, pa.int64()), pa.array(middle, pa.int64()), pa.array(output, pa.binary())],
                ["id", "n", "form", "prefix_chars", "middle_chars", "output"])

    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("name"),
                       F.encode(whole_text(text_col), "UTF-8").alias("t"))
    id_type = rows.schema["id"].dataType.simpleString()
    out = rows.mapInArrow(transform, f"id {id_type}, n long, form string, prefix_chars long, middle_chars long, "
                                     "output binary")
    return out.withColumn("output", F.decode("output", "UTF-8")).withColumnRenamed("id", id_col)


def with_restored(formed: DataFrame) -> DataFrame:
    """``formed`` with the text ``restored`` from each ``output`` and its ``form``."""

    def undo(batches):
        for batch in batches:
            texts = []
            for form, value in zip(batch.column("form").to_pylist(), batch.column("output_")):
                buffer = bytearray(value.as_py())
                if form != PLAIN:
                    restore(buffer, form)
                texts.append(bytes(buffer))
            columns = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.binary())],
                                             [*batch.schema.names[:-1], "restored"])

    rows = formed.withColumn("output_", F.encode("output", "UTF-8"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in formed.schema)
    out = rows.mapInArrow(undo, f"{schema}, restored binary")
    return out.withColumn("restored", F.decode("restored", "UTF-8"))


# --- the same in SQL: units as a list, segments as its slices ----------------------------------

def _draw(i: int) -> str:
    return f"('0x' || substr(h, {8 * i + 1}, 8))::BIGINT"


ORACLE = rf"""
    WITH d AS (
        SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h,
            regexp_extract_all(coalesce(text, ''),
                '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u
        FROM documents),
    c AS (
        SELECT *, len(u)::BIGINT AS n, {_draw(0)} % (len(u) + 1) AS c1, {_draw(1)} % (len(u) + 1) AS c2,
            CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
                    OR {_draw(2)} % 100 >= 50 THEN 'plain'
                 WHEN {_draw(3)} % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
        FROM d),
    s AS (
        SELECT doc_id, t, n, form, array_to_string(u[1:least(c1, c2)], '') AS prefix,
            array_to_string(u[least(c1, c2) + 1:greatest(c1, c2)], '') AS middle,
            array_to_string(u[greatest(c1, c2) + 1:], '') AS suffix
        FROM c)
    SELECT doc_id, n, form,
        CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
        CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
        sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
            ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
        sha256(t) AS restored_sha256
    FROM s
"""
