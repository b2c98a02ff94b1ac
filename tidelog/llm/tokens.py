"""Token counts by prefix dynamic programming (operator 5).

The encoding that byte-pair merges give a word ends in exactly one token, and
that token together with the encoding of the remaining prefix is the whole
encoding: a sequence of tokens is what the merges produce if and only if every
neighbouring pair re-encodes to itself.  So one left-to-right pass stores, for
every prefix, its last token and its exact token count; truncation and budget
questions then read the stored counts and never encode again.

``PrefixCounter`` holds the tables of one ``tokenizers`` file (lower-casing BPE
with word ends).  ``prefixes(text).counts()[i]`` is the number of tokens the library
gives for the first ``i`` code points of the text (without begin, end or added
special tokens; special strings inside texts count as the library's default
counts them, one token).  Where lower-casing or composing changes the number of
code points, positions are those of the normalised text, white space kept.

Defined cases: null text reads as empty (0 tokens); repeated rows give repeated
results; an empty table gives an empty one; extra input columns are ignored
unless named in ``keep``.  A text of any length is one pass; memory is a few
bytes per code point of the longest text plus a word cache of fixed size.
"""

from __future__ import annotations

import json
import re
import unicodedata
from array import array
from collections.abc import Sequence
from functools import lru_cache
from operator import itemgetter

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.llm.common import whole_text

CACHE_WORDS = 1 << 19
CACHE_PREFIXES = 1 << 19
CACHE_BORDERS = 1 << 20
LONGEST_CACHED = 64  # bytes of a prefix that is stored: its counts fit into a byte each
ONE_BYTE = [bytes((i,)) for i in range(LONGEST_CACHED + 1)]
NEVER = 1 << 60
# white space as the library's pattern engine has it
SPACES = "".join(map(chr, [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
                           0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
# a code point beyond those that lower-casing and composing keep in place
ODD = re.compile(r"[İɐ-\U0010FFFF]")
PIECES = regex.compile(f"[{SPACES}]+|'s|'t|'re|'ve|'m|'ll|'d|\\p{{L}}+|\\p{{N}}|[^{SPACES}\\p{{L}}\\p{{N}}]+")


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in vocabulary files of byte-level BPE:
    printable Latin-1 bytes stand for themselves, the rest follow from U+0100."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(0x100 + i): b for i, b in enumerate(rest)}


def packed(counts: Sequence[int]) -> bytes | array:
    """Counts as bytes if all are below 256."""
    try:
        return bytes(counts)
    except ValueError:
        return array("i", counts)


class Words(dict):
    """Word -> (tokens, counts of its prefixes), filled on demand, of bounded size."""

    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, word: str) -> tuple[int, Sequence[int]]:
        found = self.make(word)
        if len(word) <= LONGEST_CACHED:
            if len(self) >= CACHE_WORDS:
                self.clear()
            self[word] = found
        return found


class PrefixCounter:
    """Exact token counts of every prefix of a text, for one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as fh:
            spec = json.load(fh)
        model = spec["model"]
        end = model.get("end_of_word_suffix") or ""
        special = sorted((t["content"] for t in spec.get("added_tokens", [])), key=len, reverse=True)
        self.split_special = regex.compile("|".join(map(regex.escape, special))) if special else None
        letters = byte_letters()
        # a token is its bytes (as Latin-1 text) with "\n" behind it where it ends a word
        name = {}
        for token in model["vocab"]:
            if token not in special:
                ends = bool(end) and token.endswith(end)
                body = "".join(chr(letters[c]) for c in (token[: -len(end)] if ends else token))
                name[token] = body + "\n" if ends else body
        self.rank = {}
        for i, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            self.rank.setdefault((name[left], name[right]), i)
        # the same by the left symbol
        self.follow: dict[str, dict[str, int]] = {}
        for (left, right), i in self.rank.items():
            self.follow.setdefault(left, {})[right] = i
        # tokens by their letters from the last to the first:
        # {letter: [token inside a word, token that ends one, {...}]}
        self.endings: dict = {}
        for token in name.values():
            at = [None, None, self.endings]
            for letter in reversed(token.rstrip("\n")):
                at = at[2].setdefault(letter, [None, None, {}])
            at[token.endswith("\n")] = token
        self.right_edges: dict[str, list[tuple[str, int, int]]] = {}
        self.left_edges: dict[str, list[tuple[str, int, int]]] = {}
        # last token -> {next token: do the merges keep the border?}
        self.borders: dict[str, dict[str, bool]] = {}
        self.n_borders = 0
        self.known: dict[str, tuple[str, dict[str, bool], int, bytes]] = {}
        self.forget()
        self.words = Words(self.chunk)

    # --- merges on a pair of tokens -----------------------------------------

    def merged(self, parts: list[str], least: int = 1) -> list[str]:
        """The merges applied to a few symbols, lowest rank first, leftmost first, until
        none is left or no more than ``least`` symbols are."""
        while len(parts) > least:
            ranks = [self.rank.get(p, -1) for p in zip(parts, parts[1:])]
            live = [r for r in ranks if r >= 0]
            if not live:
                break
            best, out, i = min(live), [], 0
            while i < len(parts):
                if i < len(ranks) and ranks[i] == best:
                    out.append(parts[i] + parts[i + 1])
                    i += 2
                else:
                    out.append(parts[i])
                    i += 1
            parts = out
        return parts

    def edge(self, token: str, right: bool) -> list[tuple[str, int, int]]:
        """The symbols at the right (or left) edge of a token while its bytes merge:
        (symbol, rank that made it, rank that used it up)."""
        edges = self.right_edges if right else self.left_edges
        found = edges.get(token)
        if found is None:
            found, used = [], NEVER
            while True:
                split = self.split(token)
                made = self.rank[split] if split else -1
                found.append((token, made, used))
                if not split:
                    break
                token, used = split[1] if right else split[0], made
            edges[found[0][0]] = found
        return found

    def split(self, token: str) -> tuple[str, str] | None:
        """The two symbols of the last merge that makes a token (None: a single symbol)."""
        parts = [*token[:-2], token[-2:]] if token.endswith("\n") else [*token]
        return tuple(self.merged(parts, 2)) if len(parts) > 1 else None

    def stable(self, left: str, right: str) -> bool:
        """Do the merges keep the border between these two tokens?  (No left one: do they
        give the right one at all?)"""
        good = self.meet(left, right) if left else self.reachable(right)
        self.borders.setdefault(left, {})[right] = good
        self.n_borders += 1
        return good

    def meet(self, left: str, right: str) -> bool:
        """They keep a border unless two symbols that meet at it at the same time have a
        merge of their own that comes before the merges that use them up."""
        after = self.left_edges.get(right) or self.edge(right, False)
        for a, made_a, used_a in self.right_edges.get(left) or self.edge(left, True):
            ranks = self.follow.get(a)
            if ranks is None:
                continue
            for b, made_b, used_b in after:
                # equal ranks are equal pairs, of which the left one merges first
                if b in ranks and made_a < ranks[b] > made_b and ranks[b] < used_a and ranks[b] <= used_b:
                    return False
        return True

    def reachable(self, token: str) -> bool:
        parts = [*token[:-2], token[-2:]] if token.endswith("\n") else [*token]
        return self.merged(parts) == [token]

    # --- prefixes of a word -----------------------------------------------------

    def forget(self) -> None:
        """Only the empty prefix is stored."""
        self.known = {"": ("", self.borders.setdefault("", {}), 0, b"")}

    def step(self, data: str, i: int, path: list) -> tuple[str, int, int]:
        """Of the first ``i`` bytes, from what the shorter prefixes store: the last token
        and the token count inside a word, and the count as a whole word."""
        last, count, whole, j, below = None, 0, 0, i, self.endings
        while j:
            j -= 1
            at = below.get(data[j])
            if at is None:
                break
            inner, final, below = at
            shorter = path[j]
            if shorter is None:
                shorter = path[j] = self.known[data[:j]]
            borders = shorter[1]
            if inner is not None and last is None:
                good = borders.get(inner)
                if good is None:
                    good = self.stable(shorter[0], inner)
                if good:
                    last, count = inner, shorter[2] + 1
                    if whole:
                        return last, count, whole
            if final is not None and not whole:
                good = borders.get(final)
                if good is None:
                    good = self.stable(shorter[0], final)
                if good:
                    whole = shorter[2] + 1
                    if last is not None:
                        return last, count, whole
        raise ValueError(f"no encoding for {data!r}")

    def word(self, text: str) -> bytes | list[int]:
        """Token counts of the prefixes of one word, each taken as a whole word.  What a
        prefix gives depends on that prefix alone, so words share stored prefixes: by
        its letters, a prefix's last token, that token's known borders, its tokens inside
        a word, and the counts of its own prefixes (a byte each) as whole words."""
        data = text if text.isascii() else text.encode().decode("latin-1")
        n = len(data)
        keep = n <= LONGEST_CACHED
        if keep and len(self.known) > CACHE_PREFIXES:
            if self.n_borders >= CACHE_BORDERS:
                self.borders, self.n_borders = {}, 0
            self.forget()
        known = self.known
        # what is stored for a prefix is stored for all shorter ones
        i = n if keep else LONGEST_CACHED
        key, new = data[:i], []
        prefix = known.get(key)
        while prefix is None:
            new.append(key)
            i -= 1
            key = data[:i]
            prefix = known.get(key)
        ends = prefix[3] if keep else [*prefix[3]]
        if i < n:
            path = [None] * i
            path.append(prefix)
            borders = self.borders
            while i < n:
                i += 1
                last, count, whole = self.step(data, i, path)
                below = borders.get(last)
                if below is None:
                    below = borders[last] = {}
                if keep:
                    ends += ONE_BYTE[whole]
                    prefix = known[new.pop()] = (last, below, count, ends)
                else:
                    ends.append(whole)
                    prefix = (last, below, count, b"")
                path.append(prefix)
        if text is data:
            return ends
        # keep the bytes that end a code point
        return [c for c, b in zip(ends, data[1:] + "a") if ord(b) & 0xC0 != 0x80]

    def chunk(self, text: str) -> tuple[int, Sequence[int]]:
        """(tokens, counts of all prefixes: a byte each if they fit)."""
        if text.isalpha():
            own = self.word(text)
            return own[-1], packed(own)
        if text[:-1].isalpha() and text[-1] in ".,":
            pieces = [text[:-1], text[-1]]
        else:
            pieces = PIECES.findall(text)
        total, counts = 0, []
        for piece in pieces:
            if piece[0] in SPACES:
                counts += [total] * len(piece)
                continue
            own = self.word(piece)
            if piece[0] == "'" and len(piece) == 3 and piece[1:].isalpha():
                # a cut inside this ending leaves a quote and a letter
                own = [own[0], own[0] + self.word(piece[1])[-1], own[2]]
            counts += [c + total for c in own] if total else own
            total += own[-1]
        return total, packed(counts)

    # --- prefixes of a text --------------------------------------------------------

    def plain(self, text: str) -> list[tuple[int, Sequence[int]]]:
        """What is stored for each run between single spaces of a normalised text
        without special strings."""
        return list(map(self.words.__getitem__, text.replace("\n", " ").split(" ")))

    @staticmethod
    def normal(text: str) -> str:
        if text.isascii() or not ODD.search(text):
            return text.lower()
        return "".join(c.lower() for c in unicodedata.normalize("NFC", text))

    def prefixes(self, text: str) -> Prefixes:
        """The counts of all prefixes of a text."""
        if not (self.split_special and "<" in text and self.split_special.search(text)):
            return Prefixes(self.plain(self.normal(text)))
        runs, at = [], 0
        for m in self.split_special.finditer(text):
            before = self.plain(self.normal(text[at : m.start()]))
            total = sum(map(itemgetter(0), before)) + 1
            # a cut inside the special string leaves ordinary text
            cut = Prefixes(self.plain(self.normal(text[at : m.end() - 1]))).counts()[1:]
            runs.append((total, packed(cut.tolist())))
            at = m.end()
        return Prefixes(runs + self.plain(self.normal(text[at:])))


class Prefixes:
    """Exact token counts of all prefixes of one text: per run of text (all but the last
    have a space behind them), its tokens and the counts of its own prefixes."""

    def __init__(self, runs: list[tuple[int, Sequence[int]]]):
        self.runs = runs
        self.ends = np.cumsum(np.fromiter(map(itemgetter(0), runs), np.int64, len(runs)))
        self.total = int(self.ends[-1])

    def counts(self) -> np.ndarray:
        """``counts()[i]`` = tokens of the first ``i`` code points."""
        own = [r[1] for r in self.runs]
        if all(type(c) is bytes for c in own):
            inside = np.frombuffer(b"".join(own), np.uint8)
        else:
            inside = np.concatenate([np.frombuffer(c, np.uint8 if type(c) is bytes else np.int32) for c in own])
        lengths = np.fromiter(map(len, own), np.int64, len(own))
        before = self.ends - np.fromiter(map(itemgetter(0), self.runs), np.int64, len(own))
        counts = inside + np.repeat(before, lengths)
        # the empty prefix, and the space behind each run but the last
        return np.insert(counts, np.append(0, np.cumsum(lengths)[:-1]), np.append(0, self.ends[:-1])).astype(np.int32)

    def longest_within(self, budget: int) -> int | None:
        """The longest prefix (code points) of at most ``budget`` tokens; None: all of it."""
        if self.total <= budget:
            return None
        # runs that end within the budget, and the one that goes beyond it
        whole = int(np.searchsorted(self.ends, budget, "right"))
        length = sum(len(r[1]) + 1 for r in self.runs[:whole])
        before = int(self.ends[whole - 1]) if whole else 0
        inside = np.array([*self.runs[whole][1]]) + before
        fits = np.flatnonzero(inside <= budget)
        return length + (int(fits[-1]) + 1 if len(fits) else 0)


@lru_cache(maxsize=4)
def counter(path: str) -> PrefixCounter:
    return PrefixCounter(path)


def token_prefixes(df: DataFrame, tokenizer: str, budget: int, text_col: str = "text",
                   keep: tuple[str, ...] = ("doc_id",), store_counts: bool = False) -> DataFrame:
    """Per row: the ``keep`` columns, ``n_bytes``, ``n_tokens``, ``budget_chars`` (the
    longest prefix of at most ``budget`` tokens) and, with ``store_counts``, the
    counts of all prefixes as ``prefix_tokens`` (array of int)."""
    inner = [f"k{i}" for i in range(len(keep))]  # own names: no clash with input columns
    rows = df.select(*(F.col(k).alias(a) for k, a in zip(keep, inner)), whole_text(text_col).alias("t"))
    fields = [T.StructField(a, rows.schema[a].dataType) for a in inner]
    fields += [T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType()),
               T.StructField("budget_chars", T.LongType())]
    if store_counts:
        fields.append(T.StructField("prefix_tokens", T.ArrayType(T.IntegerType())))

    def run(batches):
        own = counter(tokenizer)
        for batch in batches:
            size, tokens, cut, stored = [], [], [], []
            for value in batch.column("t"):
                text = value.as_py()
                counts = own.prefixes(text)
                size.append(len(text.encode()))
                tokens.append(counts.total)
                fits = counts.longest_within(budget)
                cut.append(len(text) if fits is None else fits)
                if store_counts:
                    stored.append(counts.counts())
            columns = [batch.column(a) for a in inner]
            columns += [pa.array(x, pa.int64()) for x in (size, tokens, cut)]
            if store_counts:
                columns.append(pa.array(stored, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, [f.name for f in fields])

    out = rows.mapInArrow(run, T.StructType(fields))
    return out.select(*(F.col(a).alias(k) for k, a in zip(keep, inner)), *[f.name for f in fields[len(inner):]])
