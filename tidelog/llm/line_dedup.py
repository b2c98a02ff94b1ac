"""Line deduplication (operator 3): a segment-partition edit join.

Lines (between line breaks) of at least ``MIN_CHARS`` code points count as equal
when they are the same or within ``max_edits`` insertions, deletions and
substitutions of each other, directly or through other lines.  Of equal lines the
first one (smallest document id, then hash of the document, then line number) stays;
the others leave their documents.  Shorter lines always stay.

1. The same lines form one class; classes meet by hash, counted before they move.
2. A line is split into ``max_edits + 1`` segments of nearly equal length.  Of two
   lines within ``max_edits`` edits, one segment of the shorter one is untouched,
   so it is found in the longer one, at an offset that their lengths bound.  Every
   line puts its segments into an index, by length and segment number, and probes
   it with the substrings that can match a segment of a line up to ``max_edits``
   shorter.  The untouched index entry and the probe are rows with an equal key.
3. Rows that meet also carry how often the line holds each of a few letters: an edit
   changes two of these counts by one at most, so lines whose counts differ by more
   than ``2 * max_edits`` are no candidates, however many share a segment.
4. Candidates are verified with a banded edit distance behind their common start and
   before their common end: for each number of edits a few bits hold the diagonals
   that are reached, and one step for each character moves all of them at once.
5. Verified pairs are joined to components, and the lines that are not the first of
   their component are taken out of their documents.

Everything is DataFrame functions.  Defined cases: null text stays null; rows with
equal ids and texts are one document, rows with equal ids and other texts are documents
of their own; a null id is an id, before all others; documents that
lose all their lines keep an empty text; an empty table gives an empty one; extra
columns are returned as they are, and those named like the added ones (``n_lines``,
``n_removed``) are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import stored
from tidelog.llm.components import components

MIN_CHARS = 20
MAX_EDITS = 1
LETTERS = "aeit"
LONGEST_COMMON = 1 << 12  # so much of a common start or end is left out at most
FIRST_CHARS = 32  # most pairs that are not near are told from so many characters
ADDED = ("n_lines", "n_removed")


# --- segments ------------------------------------------------------------------------

def segment(length: Column, i: int, parts: int) -> tuple[Column, Column]:
    """(start from 0, length) of segment ``i``: the last ``length % parts`` ones are one longer."""
    base, longer = F.floor(length / parts).cast("int"), length % parts
    start = base * i + F.greatest(longer - (parts - i), F.lit(0))
    return start, base + (longer >= parts - i).cast("int")


def offsets(i: int, shorter: int, max_edits: int) -> range:
    """Where, from its own start on, segment ``i`` of a line can lie in one that is
    ``shorter`` characters longer, if no edit before it and behind it needs more than
    the segments there leave."""
    return range(max(-i, shorter - (max_edits - i)), min(i, shorter + (max_edits - i)) + 1)


def postings(line: Column, length: Column, max_edits: int) -> list[Column]:
    """The index entries and probes of a line, as structs (key, probe); a probe that
    would lie outside of the line has a null key."""
    parts, rows = max_edits + 1, []
    for shorter in range(parts):
        for i in range(parts):
            start, size = segment(length - shorter, i, parts)
            for offset in offsets(i, shorter, max_edits):
                at = start + offset
                own = shorter == 0 and offset == 0  # an entry is also the probe for lines of its length
                key = F.xxhash64(length - shorter, F.lit(i), F.substring(line, at + 1, size))
                inside = (at >= 0) & (at + size <= length)
                rows.append(F.struct((key if own else F.when(inside, key)).alias("key"), F.lit(not own).alias("probe")))
    return rows


def letter_counts(line: Column) -> Column:
    """How often a line holds each of LETTERS, modulo 256, in a byte each."""
    out = F.lit(0).cast("long")
    for i, letter in enumerate(LETTERS):
        n = F.octet_length(line) - F.octet_length(F.replace(line, F.lit(letter), F.lit("")))
        out = out.bitwiseOR(F.shiftleft(F.pmod(n, F.lit(256)).cast("long"), 8 * i))
    return out


def counts_apart(a: Column, b: Column) -> Column:
    """The sum of the differences of two ``letter_counts`` (modulo 256: at most the true one)."""
    apart = F.lit(0)
    for i in range(len(LETTERS)):
        x, y = (F.shiftright(c, 8 * i).bitwiseAND(F.lit(255)) for c in (a, b))
        d = F.abs(x - y)
        apart = apart + F.least(d, 256 - d)
    return apart


# --- edit distance -----------------------------------------------------------------------

def common_start(a: str, b: str) -> Column:
    """How many first characters two columns have in common (at most twice
    LONGEST_COMMON), from the equality of ever shorter stretches."""
    steps = F.array(*(F.lit(1 << i) for i in reversed(range(LONGEST_COMMON.bit_length()))))

    def longer(n, step):
        x, y = (F.substring(c, n + 1, step) for c in (a, b))
        return F.when((x == y) & (F.length(x) == step), n + step).otherwise(n)

    return F.aggregate(steps, F.lit(0), longer)


def reached(a: Column, b: Column, max_edits: int) -> Column:
    """The diagonals reached behind all characters of ``a`` (array) with ``max_edits``
    edits.  Bit ``d + max_edits`` of the number for ``e`` edits says that the first
    ``i`` characters of ``a`` can become the first ``i + d`` of ``b`` with at most
    ``e`` edits; only diagonals that near matter."""
    band = range(-max_edits, max_edits + 1)
    whole = (1 << len(band)) - 1

    def state(levels, i):
        return F.struct(*(level.alias(f"e{e}") for e, level in enumerate(levels)), i.alias("i"))

    start = [F.lit(sum(1 << (d + max_edits) for d in range(e + 1))) for e in range(max_edits + 1)]

    def step(s, c):
        same = F.lit(0)
        for d in band:
            fits = F.coalesce(F.get(b, s["i"] + d) == c, F.lit(False))
            same = same + F.when(fits, F.lit(1 << (d + max_edits))).otherwise(F.lit(0))
        levels = []
        for e in range(max_edits + 1):
            level = s[f"e{e}"].bitwiseAND(same)
            if e:
                before = s[f"e{e - 1}"]
                level = (level.bitwiseOR(before)  # substitution
                         .bitwiseOR(F.shiftright(before, 1))  # character of a only
                         .bitwiseOR(F.shiftleft(levels[-1], 1)))  # character of b only
            levels.append(level.bitwiseAND(F.lit(whole)))
        return state(levels, s["i"] + 1)

    return F.aggregate(a, state(start, F.lit(0)), step, lambda s: s[f"e{max_edits}"])


def within(rows: DataFrame, a: str, b: str, max_edits: int) -> DataFrame:
    """The rows whose two lines are within so many edits."""
    rows = rows.filter(F.abs(F.length(a) - F.length(b)) <= max_edits)
    # what is behind the common start, backwards, and the same again
    for _ in range(2):
        behind = common_start(a, b) + 1
        rows = rows.withColumns({x: F.reverse(F.substring(x, behind, F.length(x))) for x in (a, b)})
        rows = stored(rows, "line-rests")
    # the empty text is one empty character to split()
    rows = rows.withColumns({x: F.filter(F.split(x, ""), lambda c: c != "") for x in (a, b)})
    d = F.size(b) - F.size(a)
    rows = rows.filter(reached(F.slice(a, 1, FIRST_CHARS), F.col(b), max_edits) != 0)
    last = F.call_function("shiftright", reached(F.col(a), F.col(b), max_edits), d + max_edits)
    return rows.filter(last.bitwiseAND(F.lit(1)) == 1)


# --- lines -----------------------------------------------------------------------------------

def lines_of(docs: DataFrame, min_chars: int) -> DataFrame:
    """The lines that count: (doc, of, no, line), ``of`` the hash of the document's text."""
    out = docs.select("doc", "of", F.posexplode(F.split("t", "\n")).alias("no", "line"))
    return out.filter(F.length("line") >= min_chars)


def candidates(lines: DataFrame, max_edits: int) -> DataFrame:
    """Pairs of different lines (hashes a, b) that share a segment and may be near."""
    size = F.length("line")
    rows = lines.select(F.xxhash64("line").alias("id"), letter_counts(F.col("line")).alias("counts"),
                        F.explode(F.array(*postings(F.col("line"), size, max_edits))).alias("p"))
    rows = rows.filter("p.key IS NOT NULL")
    # an entry is also the probe for lines of its length
    rows = rows.groupBy("p.key", "id").agg(F.first("counts").alias("counts"), F.min("p.probe").alias("probe"))
    a, b = rows.alias("a"), rows.alias("b")
    near = counts_apart(F.col("a.counts"), F.col("b.counts")) <= 2 * max_edits
    met = ((F.col("a.key") == F.col("b.key")) & ~F.col("a.probe") & (F.col("a.id") != F.col("b.id"))
           & (F.col("b.probe") | (F.col("a.id") < F.col("b.id"))) & near)
    pairs = a.join(b, met).select(F.least("a.id", "b.id").alias("a"), F.greatest("a.id", "b.id").alias("b"))
    return pairs.distinct()


def near_lines(lines: DataFrame, max_edits: int) -> DataFrame:
    """Pairs (a, b) of hashes of lines within ``max_edits`` edits."""
    pairs = stored(candidates(lines, max_edits), "line-candidates")
    names = pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct()
    # stored, so that Spark knows their size: few are sent to the lines, many are shuffled
    names = stored(names, "line-names")
    texts = lines.select(F.xxhash64("line").alias("id"), "line").join(names, "id", "left_semi").dropDuplicates(["id"])
    texts = stored(texts, "line-texts")
    left = texts.select(F.col("id").alias("a"), F.col("line").alias("x"))
    right = texts.select(F.col("id").alias("b"), F.col("line").alias("y"))
    rows = pairs.join(left, "a").join(right, "b")
    # few bytes but much work: not left to as few tasks as the bytes need
    rows = rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return stored(within(rows, "x", "y", max_edits).select("a", "b"), "line-links")


def repeated_lines(lines: DataFrame, max_edits: int) -> DataFrame:
    """The lines to take out: (doc, of, no)."""
    classes = lines.groupBy(F.xxhash64("line").alias("id")).agg(
        F.min(F.struct("doc", "of", "no")).alias("first"), F.count("*").alias("n"))
    parts = components(near_lines(lines, max_edits)) if max_edits else None
    if parts is not None:
        classes = classes.join(parts, F.col("id") == F.col("node"), "left")
        classes = classes.select("id", "first", "n", "component").filter("n > 1 OR component IS NOT NULL")
        classes = stored(classes, "line-classes")
        least = classes.filter("component IS NOT NULL").groupBy("component").agg(F.min("first").alias("least"))
        classes = classes.join(least, "component", "left").select(
            "id", F.coalesce("least", "first").alias("first"))
    else:
        classes = stored(classes.filter("n > 1").select("id", "first"), "line-classes")
    rows = lines.select(F.xxhash64("line").alias("id"), F.struct("doc", "of", "no").alias("at")).join(classes, "id")
    return rows.filter(~F.col("at").eqNullSafe(F.col("first"))).select("at.doc", "at.of", "at.no")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS,
                max_edits: int = MAX_EDITS) -> DataFrame:
    """The rows of ``docs`` without repeated lines, with ``n_lines`` (before) and ``n_removed``."""
    text = F.col(text_col).cast("string")
    named = [F.col(id_col).alias("doc"), F.xxhash64(text).alias("of"), text.alias("t")]
    lines = lines_of(docs.select(*named), min_chars)
    removed = (repeated_lines(lines, max_edits).distinct()
               .groupBy("doc", "of").agg(F.collect_list("no").alias("removed")).toDF("doc_", "of_", "removed"))
    kept = [c for c in docs.columns if c.lower() not in ADDED]
    inner = docs.select(*(F.col(c).alias(f"c{i}") for i, c in enumerate(kept)), *named)
    rows = inner.join(removed, F.col("doc").eqNullSafe(F.col("doc_")) & (F.col("of") == F.col("of_")), "left")
    lines_left = F.filter(F.split("t", "\n"), lambda line, i: ~F.array_contains("removed", i))
    text = F.when(F.col("removed").isNull(), F.col("t")).otherwise(F.array_join(lines_left, "\n"))
    columns = [(text if c == text_col else F.col(f"c{i}")).alias(c) for i, c in enumerate(kept)]
    return rows.select(*columns, F.coalesce(F.size(F.split("t", "\n")), F.lit(0)).cast("long").alias("n_lines"),
                       F.when(F.col("removed").isNull(), F.lit(0)).otherwise(F.size("removed"))
                       .cast("long").alias("n_removed"))


ORACLE = f"""
    WITH RECURSIVE d AS (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents),
    o AS (SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) - 1 AS no FROM d),
    e AS (SELECT * FROM o WHERE length(line) >= {MIN_CHARS}),
    c AS MATERIALIZED (SELECT line, min((doc_id, no)) AS first, length(line) AS n FROM e GROUP BY line),
    -- one edit leaves the first or the last characters of a line as they are
    p AS MATERIALIZED (
        SELECT DISTINCT x.line AS a, y.line AS b FROM c x JOIN c y
        ON left(x.line, 9) = left(y.line, 9) AND abs(x.n - y.n) <= {MAX_EDITS} AND x.line <> y.line
        WHERE levenshtein(x.line, y.line) <= {MAX_EDITS}
        UNION SELECT x.line, y.line FROM c x JOIN c y
        ON right(x.line, 9) = right(y.line, 9) AND abs(x.n - y.n) <= {MAX_EDITS} AND x.line <> y.line
        WHERE levenshtein(x.line, y.line) <= {MAX_EDITS}),
    r AS (SELECT line AS a, line AS b FROM c UNION SELECT r.a, p.b FROM r JOIN p ON r.b = p.a),
    f AS (SELECT r.a AS line, min(c.first) AS first FROM r JOIN c ON r.b = c.line GROUP BY r.a),
    k AS (SELECT o.doc_id, o.line, o.no, coalesce(f.first = (o.doc_id, o.no), true) AS keep
          FROM o LEFT JOIN f ON o.line = f.line AND length(o.line) >= {MIN_CHARS})
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE NOT keep) AS n_removed,
        coalesce(string_agg(line, chr(10) ORDER BY no) FILTER (WHERE keep), '') AS text
    FROM k GROUP BY doc_id
"""
