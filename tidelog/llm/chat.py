"""Chat formatting (operator 7): a finite-state machine over roles, text segments
with loss flags, and the way back.

A ``ChatTemplate`` declares the states, the roles that lead from one to the next,
the marks around a turn and the roles whose text is learned.  ``format_chats``
turns the rows of each conversation (in turn order) into segments (text, loss):
the mark that opens the turn, the text, the mark that closes it.  Only texts of
learned roles carry the loss flag.  Joined, the segments are the formatted
conversation.

Texts cannot imitate control strings: in each string that the template guards, a
backslash is put behind its first character (one more where some stand there
already), which ``unescaped`` takes out again.  A formatted conversation holds
the bare strings only where the template put them, so ``read_turns`` finds the
turns again and gives back roles and texts unchanged.

Conversations that break the turn order are formatted all the same; ``valid`` and
``first_bad_turn`` (position from 0, null where none) say so.

All of it is DataFrame functions.  Defined cases: null text and null role read as
empty; null turns come first; rows that tie on the turn are ordered by role, then
text; repeated rows are repeated turns; rows with a null conversation id are one
conversation; an empty table gives an empty one; other input columns are ignored.
A conversation is one row of the output, so it has to fit into memory.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# strings of this template and of bracketed instruction templates
GUARDED = r"([<\[])(\\*)(\||/?s>|/?INST\]|</?SYS>>)"
ESCAPED = r"([<\[])\\(\\*)(\||/?s>|/?INST\]|</?SYS>>)"
BROKEN = "broken"


@dataclass(frozen=True)
class ChatTemplate:
    """Marks, learned roles and turn order of a chat format."""

    open: str = "<|im_start|>"
    role_end: str = "\n"
    close: str = "<|im_end|>\n"
    learned: tuple[str, ...] = ("assistant",)
    start: str = "start"
    accepting: tuple[str, ...] = ("assistant",)
    # (state, role) -> state; anything else breaks the conversation
    order: dict[tuple[str, str], str] = field(default_factory=lambda: {
        ("start", "system"): "system", ("start", "user"): "user", ("system", "user"): "user",
        ("user", "assistant"): "assistant", ("assistant", "user"): "user",
        ("assistant", "tool"): "tool", ("tool", "assistant"): "assistant",
    })


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, GUARDED, r"$1\\$2$3")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, "$1$2$3")


def role_mark(role: Column) -> Column:
    """A role on one line: backslash as ``\\b``, line break as ``\\n``."""
    return escaped(F.replace(F.replace(role, F.lit("\\"), F.lit("\\b")), F.lit("\n"), F.lit("\\n")))


def role_of(mark: Column) -> Column:
    return F.replace(F.replace(unescaped(mark), F.lit("\\n"), F.lit("\n")), F.lit("\\b"), F.lit("\\"))


def step(template: ChatTemplate, state: Column, role: Column) -> Column:
    """The state behind a turn."""
    moves = F.create_map(*(F.lit(x) for (s, r), to in template.order.items() for x in (f"{s}\n{r}", to)))
    return F.coalesce(F.try_element_at(moves, F.concat(state, F.lit("\n"), role)), F.lit(BROKEN))


def segments_of(template: ChatTemplate, turns: Column) -> Column:
    def of(turn):
        loss = turn["role"].isin(*template.learned)
        return F.array(
            F.struct(F.concat(F.lit(template.open), role_mark(turn["role"]), F.lit(template.role_end)).alias("text"),
                     F.lit(False).alias("loss")),
            F.struct(escaped(turn["text"]).alias("text"), loss.alias("loss")),
            F.struct(F.lit(template.close).alias("text"), F.lit(False).alias("loss")),
        )

    return F.flatten(F.transform(turns, of))


def format_chats(df: DataFrame, template: ChatTemplate | None = None, conv_col: str = "conv_id",
                 turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Per conversation: its id, ``segments`` (text, loss), ``formatted``, ``valid``, ``first_bad_turn``."""
    template = template or ChatTemplate()
    turn = F.struct(F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"),
                    F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    turns = (df.select(F.col(conv_col).alias("c"), turn.alias("t")).groupBy("c")
             .agg(F.sort_array(F.collect_list("t")).alias("turns")))
    state = F.struct(F.lit(template.start).alias("state"), F.lit(0).alias("n"), F.lit(None).cast("int").alias("bad"))

    def move(acc, t):
        to = step(template, acc["state"], t["role"])
        bad = F.when(acc["bad"].isNull() & (to == BROKEN), acc["n"]).otherwise(acc["bad"])
        return F.struct(to.alias("state"), (acc["n"] + 1).alias("n"), bad.alias("bad"))

    return (turns.withColumn("end", F.aggregate("turns", state, move))
            .withColumn("segments", segments_of(template, F.col("turns")))
            .select(F.col("c").alias(conv_col), "segments",
                    F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
                    F.col("end.state").isin(*template.accepting).alias("valid"),
                    F.col("end.bad").alias("first_bad_turn")))


def read_turns(formatted: Column, template: ChatTemplate | None = None) -> Column:
    """The (role, text) of each turn, read from formatted text."""
    template = template or ChatTemplate()
    parts = F.split(formatted, "\\Q" + template.close + "\\E")
    parts = F.slice(parts, F.lit(1), F.size(parts) - 1)  # nothing stands behind the last mark

    def of(part):
        body = F.substring(part, F.lit(len(template.open) + 1), F.length(part))
        mark = F.substring_index(body, template.role_end, 1)
        text = F.substring(body, F.length(mark) + len(template.role_end) + 1, F.length(body))
        return F.struct(role_of(mark).alias("role"), unescaped(text).alias("text"))

    return F.transform(parts, of)


def learned_text(segments: Column) -> Column:
    """The text under the loss flags, control strings put back."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescaped(s["text"])), "")
