"""Mixing sources to target weights (operator 9): iterative proportional fitting.

Documents fall into cells (source, language, topic).  The token weights of the
cells are raked: the weight of each cell is multiplied in turn by the factor that
brings its source, its language and its topic to their target share of the tokens
to keep, where a weight above 1 counts as the probability 1 but is not cut, until
no probability changes by more than ``TOLERANCE``.  A target above the tokens that
its category has is bounded by them, and the other categories share the rest in
proportion to their targets.  Targets that no probabilities can meet together are
met as far as the rounds bring them; the weights are then scaled until the kept
tokens are ``rate`` of all, so the rate is met wherever categories with a target
above 0 have so many tokens.  ``marginals`` gives wanted and reached shares.

Each document is then kept with the calibrated probability of its cell, by a hash
of its id, so the same documents are kept on every run and on every retry.

Targets are shares per category.  ``tempered`` makes them from the data: the
token share of each category to the power ``TEMPERATURE``, which lifts small
sources and lowers hot ones.  Categories without a target of their own share the
one of ``OTHER``; targets that give no category of the table a share are an error.
All categories are raked, however many.  Up to ``DRIVER_CELLS`` cells are raked on
the driver; more of them by the same steps as DataFrames, one grouped sum for each
dimension and round, with each round stored.

Only token counts per cell are shuffled; texts stay where they are (the cell's
probability is joined back, by a broadcast if the driver raked them).

Defined cases: null source, language or text read as empty; a text without words
weighs nothing and is kept with the probability of its cell; a cell whose weight
is 0 has the probability ``rate``; a null id hashes as the empty text; repeated
rows are kept or dropped together; an empty table gives an empty one; extra
columns are returned as they are, and columns named like those added
(``ADDED``) are replaced.
"""

from __future__ import annotations

import sys

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import stored, whole_text

RATE = 0.7  # share of all tokens to keep
TEMPERATURE = 0.5
TOLERANCE = 1e-6
MOST_ROUNDS = 1000  # of the rake to convergence
HEAVIEST = 1e9  # weights grow no further where targets cannot be met together
DRIVER_CELLS = 100_000
OTHER = "(other)"
DIMENSIONS = ("source", "lang", "topic")
ADDED = ("topic", "n_words", "keep_probability", "kept")
HASH_DIGITS = 12

# a topic stands for what marks its texts: (name, mark, least marks per 1000 characters)
TOPICS = (("table", "|", 10), ("symbols", "###", 3), ("shouting", "!!", 20), ("numbers", "0", 2), ("names", "@", 1))
DEFAULT_TOPIC = "prose"


def text_topic(text: Column) -> Column:
    """The first topic whose mark the whole text holds often enough."""
    out = F.lit(DEFAULT_TOPIC)
    for name, mark, least in reversed(TOPICS):
        marks = (F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))) / len(mark)
        out = F.when((F.length(text) > 0) & (marks * 1000 >= F.length(text) * least), F.lit(name)).otherwise(out)
    return out


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def unit_hash(id_col: Column) -> Column:
    """A number in [0, 1) from an id: the first hexadecimal digits of its md5."""
    digits = F.substring(F.md5(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")), 1, HASH_DIGITS)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(16 ** HASH_DIGITS))


def tempered(shares: dict[str, float], temperature: float = TEMPERATURE) -> dict[str, float]:
    lifted = {k: v ** temperature for k, v in shares.items() if v > 0}
    total = sum(lifted.values())
    return {k: v / total for k, v in lifted.items()}


def bounded_goals(target: np.ndarray, tokens: np.ndarray, want: float) -> np.ndarray:
    """Tokens to keep of each category: its target share of ``want``, at most its
    tokens; what bounded ones leave goes to the others in proportion to their targets."""
    full = np.zeros(len(target), dtype=bool)
    while True:
        open_share = target[~full].sum()
        left = max(want - tokens[full].sum(), 0.0)
        goals = np.where(full, tokens, target * (left / open_share if open_share > 0 else 0.0))
        over = ~full & (goals > tokens)
        if not over.any():
            return goals
        full |= over


def rake(tokens: np.ndarray, members: list[np.ndarray], targets: list[np.ndarray], rate: float = RATE) -> np.ndarray:
    """Keep probabilities of the cells that meet the bounded targets and the rate:
    ``members[d]`` is each cell's category in dimension d, ``targets[d]`` the target
    shares of its categories."""
    want = rate * tokens.sum()
    goals = [bounded_goals(target, np.bincount(own, tokens, minlength=len(target)), want)
             for own, target in zip(members, targets)]
    weight = np.full(len(tokens), rate)
    for _ in range(MOST_ROUNDS):
        before = np.minimum(1.0, weight)
        for own, goal in zip(members, goals):
            now = np.bincount(own, tokens * np.minimum(1.0, weight), minlength=len(goal))
            factor = np.divide(goal, now, out=np.ones(len(goal)), where=now > 0)
            weight = np.minimum(HEAVIEST, weight * factor[own])
        if np.abs(np.minimum(1.0, weight) - before).max(initial=0.0) <= TOLERANCE:
            break
    for _ in range(MOST_ROUNDS):
        now = (tokens * np.minimum(1.0, weight)).sum()
        if now <= 0 or abs(now - want) <= TOLERANCE * want:
            break
        weight = np.minimum(HEAVIEST, weight * (want / now))
    return np.minimum(1.0, weight)


def no_share(dimension: str) -> ValueError:
    return ValueError(f"the targets for {dimension} give no category of the table a share")


def rake_on_driver(rows: list, targets: dict[str, dict[str, float]], rate: float) -> np.ndarray:
    """Keep probabilities of the cells, rows (k_source, k_lang, k_topic, n)."""
    tokens = np.array([r["n"] for r in rows])
    members, shares = [], []
    for d in DIMENSIONS:
        present = sorted({r[f"k_{d}"] for r in rows})
        index = {k: i for i, k in enumerate(present)}
        own = np.array([index[r[f"k_{d}"]] for r in rows], dtype=int)
        if d in targets:
            wanted = {k: targets[d].get(k, 0.0) for k in present}
            total = sum(wanted.values())
            if total <= 0 and tokens.sum() > 0:
                raise no_share(d)
            wanted = {k: v / (total or 1.0) for k, v in wanted.items()}
        else:
            sums = np.bincount(own, tokens, minlength=len(present))
            wanted = tempered({k: s / (tokens.sum() or 1.0) for k, s in zip(present, sums)})
        members.append(own)
        shares.append(np.array([wanted.get(k, 0.0) for k in present]))
    return rake(tokens, members, shares, rate)


def goal_table(cells: DataFrame, dimension: str, targets: dict[str, dict[str, float]], want: float,
               total: float) -> DataFrame:
    """(k_dimension, goal_dimension): the tokens to keep of each category."""
    key = f"k_{dimension}"
    sums = cells.groupBy(key).agg(F.sum("n").alias("of"))
    if dimension in targets:
        given = cells.sparkSession.createDataFrame([(k, float(v)) for k, v in targets[dimension].items()],
                                                   f"{key} string, share double")
        sums = sums.join(given, key, "left").withColumn("share", F.coalesce("share", F.lit(0.0)))
    else:
        sums = sums.withColumn("share", F.when(F.col("of") > 0, F.pow(F.col("of") / total, F.lit(TEMPERATURE)))
                               .otherwise(0.0))
    sums = stored(sums, "mixing-shares")
    all_shares = sums.agg(F.sum("share")).first()[0]
    if all_shares <= 0:
        raise no_share(dimension)
    scale, before = want / all_shares, None
    while scale != before:  # bounded targets leave more to the others
        full = F.col("share") * scale > F.col("of")
        row = sums.agg(F.sum(F.when(full, F.col("of")).otherwise(0.0)).alias("full"),
                       F.sum(F.when(full, 0.0).otherwise(F.col("share"))).alias("open")).first()
        before = scale
        if row["open"] > 0:
            scale = max(scale, max(want - row["full"], 0.0) / row["open"])
        else:
            scale = before = sys.float_info.max
    return sums.select(key, F.least(F.col("share") * scale, "of").alias(f"goal_{dimension}"))


def rake_as_tables(cells: DataFrame, targets: dict[str, dict[str, float]], rate: float) -> DataFrame:
    """``cells`` with ``cell_probability``; the steps of ``rake``."""
    total = cells.agg(F.sum("n")).first()[0]
    if not total:
        return cells.withColumn("cell_probability", F.lit(rate))
    want = rate * total
    state = cells.withColumn("w", F.lit(float(rate)))
    for d in DIMENSIONS:
        state = state.join(goal_table(cells, d, targets, want, total), f"k_{d}")
    state = stored(state, "mixing-round")
    probability = F.least(F.lit(1.0), F.col("w"))
    for _ in range(MOST_ROUNDS):
        state = state.withColumn("before", probability)
        for d in DIMENSIONS:
            now = state.groupBy(f"k_{d}").agg(F.sum(F.col("n") * probability).alias("now"))
            factor = F.when(F.col("now") > 0, F.col(f"goal_{d}") / F.col("now")).otherwise(1.0)
            state = state.join(now, f"k_{d}").withColumn("w", F.least(F.lit(HEAVIEST), F.col("w") * factor)).drop("now")
        state = stored(state, "mixing-round")
        if state.agg(F.max(F.abs(probability - F.col("before")))).first()[0] <= TOLERANCE:
            break
        state = state.drop("before")
    scale = 1.0
    for _ in range(MOST_ROUNDS):
        scaled = F.least(F.lit(HEAVIEST), F.col("w") * scale)
        now = state.agg(F.sum(F.col("n") * F.least(F.lit(1.0), scaled))).first()[0]
        if now <= 0 or abs(now - want) <= TOLERANCE * want:
            break
        scale *= want / now
    return state.withColumn("cell_probability", F.least(F.lit(1.0), F.col("w") * scale))


def cell_probabilities(cells: DataFrame, targets: dict[str, dict[str, float]] | None = None,
                       rate: float = RATE) -> DataFrame:
    """(source, lang, topic, cell_probability) of each cell, from rows (source, lang, topic,
    n_words).  ``targets`` has shares by dimension; dimensions without get tempered ones."""
    targets = targets or {}
    keys = {d: F.col(d) for d in DIMENSIONS}
    for d, given in targets.items():
        keys[d] = F.when(F.col(d).isin(*given), F.col(d)).otherwise(F.lit(OTHER)) if given else F.lit(OTHER)
    rows = stored(cells.select(*DIMENSIONS, *(keys[d].alias(f"k_{d}") for d in DIMENSIONS),
                               F.col("n_words").cast("double").alias("n")), "mixing-cells")
    if rows.count() > DRIVER_CELLS:
        return rake_as_tables(rows, targets, rate).select(*DIMENSIONS, "cell_probability")
    found = rows.orderBy(*DIMENSIONS).collect()
    p = rake_on_driver(found, targets, rate) if found else []
    return F.broadcast(rows.sparkSession.createDataFrame(
        [(*(r[d] for d in DIMENSIONS), float(x)) for r, x in zip(found, p)],
        "source string, lang string, topic string, cell_probability double"))


def mix(df: DataFrame, targets: dict[str, dict[str, float]] | None = None, id_col: str = "doc_id",
        text_col: str = "text", source_col: str = "source", lang_col: str = "lang",
        rate: float = RATE) -> DataFrame:
    """Every row with ``topic``, ``n_words``, ``keep_probability`` and ``kept``."""
    text = whole_text(text_col)
    inner = {"source": F.coalesce(F.col(source_col).cast("string"), F.lit("")),
             "lang": F.coalesce(F.col(lang_col).cast("string"), F.lit("")), "topic": text_topic(text)}
    cells = (df.select(*(c.alias(d) for d, c in inner.items()), word_count(text).alias("n_words"))
             .groupBy(*DIMENSIONS).agg(F.sum("n_words").alias("n_words")))
    found = cell_probabilities(cells, targets, rate)
    found = found.select(*(F.col(d).alias(f"{d}__") for d in DIMENSIONS), "cell_probability")
    kept = [c for c in df.columns if c.lower() not in ADDED]
    rows = df.select(*(F.col(c).alias(f"c{i}") for i, c in enumerate(kept)),
                     *(inner[d].alias(f"{d}_") for d in DIMENSIONS), word_count(text).alias("n_words"),
                     unit_hash(F.col(id_col)).alias("u"))
    out = rows.join(found, [F.col(f"{d}_") == F.col(f"{d}__") for d in DIMENSIONS], "left")
    p = F.coalesce("cell_probability", F.lit(rate))
    return out.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(kept)), F.col("topic_").alias("topic"), "n_words",
                      p.alias("keep_probability"), (F.col("u") < p).alias("kept"))


def marginals(mixed: DataFrame, dimension: str) -> DataFrame:
    """Of the rows of ``mix``: each category's share of all tokens, the share that the
    default targets want, and the share it has of the tokens kept (as expected)."""
    rows = mixed.groupBy(F.coalesce(F.col(dimension).cast("string"), F.lit("")).alias("category")).agg(
        F.sum("n_words").alias("n"), F.sum(F.col("n_words") * F.col("keep_probability")).alias("kept"))
    total = rows.agg(F.sum("n").alias("n"), F.sum("kept").alias("kept"))
    total = total.select(F.col("n").alias("all_n"), F.col("kept").alias("all_kept"))
    rows = rows.crossJoin(F.broadcast(total)).withColumn("share", F.col("n") / F.nullif(F.col("all_n"), F.lit(0)))
    lifted = rows.withColumn("lifted", F.pow("share", F.lit(TEMPERATURE)))
    sums = F.broadcast(lifted.agg(F.sum("lifted").alias("all_lifted")))
    return lifted.crossJoin(sums).select("category", "share", (F.col("lifted") / F.col("all_lifted")).alias("wanted"),
                                         (F.col("kept") / F.nullif(F.col("all_kept"), F.lit(0.0))).alias("reached"))
