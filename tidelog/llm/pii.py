"""Personal data (operator 2): patterns propose spans, checksums confirm them,
context words nearby adjust the score.

Kinds.  The four base kinds are found as the leftmost non-overlapping matches of
their pattern over the whole text, and a match that fails its test is dropped
without another try:

* ``email``: no further test,
* ``ip``: each of the four parts at most 255,
* ``card``: 16 to 19 digits with a valid Luhn checksum,
* ``phone``: ``+`` and 8 to 15 digits.

The method adds ``iban`` (country, check digits, mod-97 remainder 1) and ``ssn``
(three groups of digits with an issued area, group and serial, kept only where a
context word within ``CONTEXT_CHARS`` raises its score to ``KEEP_SCORE``).

Every span has a score: what its kind is worth as a pattern, more where a
checksum confirms it, more where a context word of its kind stands nearby.
Scores decide about the added kinds; the base kinds are always reported.

Positions are code points, end exclusive.  Defined cases: null text reads as
empty (no spans); repeated rows give repeated results; an empty table gives an
empty one; extra input columns pass by unless named in ``keep``.  Every pattern
is matched in time linear in the text, however long its runs of letters or digits.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.llm.common import whole_text

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "ssn")
CONTEXT_CHARS = 40
KEEP_SCORE = 0.5
# score of a bare pattern, and of one that a checksum or range test confirms
PATTERN_SCORE = {"email": 0.7, "ip": 0.5, "card": 0.2, "phone": 0.6, "iban": 0.2, "ssn": 0.2}
TESTED_SCORE = {"email": 0.7, "ip": 0.6, "card": 0.8, "phone": 0.7, "iban": 0.9, "ssn": 0.4}
CONTEXT_SCORE = 0.2
CONTEXT = {
    "email": ("mail", "contact", "write", "courriel", "correo"),
    "ip": ("ip", "host", "server", "address", "adresse"),
    "card": ("card", "visa", "mastercard", "credit", "carte", "karte", "tarjeta"),
    "phone": ("phone", "tel", "call", "mobile", "fax", "telefon"),
    "iban": ("iban", "bank", "account", "konto", "compte", "cuenta"),
    "ssn": ("ssn", "social security", "social insurance", "taxpayer"),
}
CONTEXT_PATTERN = {k: re.compile(r"(?<![A-Za-z])(?:" + "|".join(v) + ")", re.IGNORECASE) for k, v in CONTEXT.items()}

LOCAL_PART = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a number starts a match only where no digit stands before it: a match that
# fails from the first digit of a run fails from all of them
IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
NO_DIGIT = re.compile("[^0-9]+")


def luhn(digits: str) -> bool:
    """Does the last digit fit the others (every second digit doubled, from the right)?"""
    total = sum(map(int, digits[-1::-2]))
    total += sum(d - 9 if d > 9 else d for d in (2 * int(c) for c in digits[-2::-2]))
    return total % 10 == 0


def mod97(iban: str) -> bool:
    """Is the number that the letters and digits stand for 1 modulo 97?"""
    whole = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in whole)) % 97 == 1


def emails(text: str):
    """The matches of the email pattern, found from each ``@`` (the local part holds none)."""
    at, done = text.find("@"), 0
    while at >= 0:
        domain = DOMAIN.match(text, at)
        start = at
        if domain:
            while start > done and text[start - 1] in LOCAL_PART:
                start -= 1
        if domain and start < at:
            done = domain.end()
            yield start, done
            at = text.find("@", done)
        else:
            at = text.find("@", at + 1)


def ip_parts_fit(match: str) -> bool:
    return all(len(p) <= 3 and int(p or "0") <= 255 for p in (x.lstrip("0") for x in match.split(".")))


def card_fits(match: str) -> bool:
    digits = match.replace(" ", "").replace("-", "")
    return 16 <= len(digits) <= 19 and luhn(digits)


def ssn_fits(match: str) -> bool:
    area, group, serial = match.split("-")
    return area not in ("000", "666") and area < "900" and group != "00" and serial != "0000"


def proposals(text: str):
    """(kind, start, end) that pass their tests, by kind as listed, then start."""
    for start, end in emails(text):
        yield "email", start, end
    for m in IP.finditer(text):
        if ip_parts_fit(m[0]):
            yield "ip", *m.span()
    for m in CARD.finditer(text):
        if card_fits(m[0]):
            yield "card", *m.span()
    if "+" in text:
        for m in PHONE.finditer(text):
            if 8 <= len(NO_DIGIT.sub("", m[0])) <= 15:
                yield "phone", *m.span()
    for m in IBAN.finditer(text):
        if mod97(m[0].replace(" ", "")):
            yield "iban", *m.span()
    if "-" in text:
        for m in SSN.finditer(text):
            if ssn_fits(m[0]):
                yield "ssn", *m.span()


def find_spans(text: str) -> list[tuple[str, int, int, float]]:
    """(kind, start, end, score) of every reported span."""
    found = []
    for kind, start, end in proposals(text):
        score = TESTED_SCORE[kind]
        around = text[max(0, start - CONTEXT_CHARS) : start] + "\n" + text[end : end + CONTEXT_CHARS]
        if CONTEXT_PATTERN[kind].search(around):
            score = min(1.0, score + CONTEXT_SCORE)
        if kind in BASE_KINDS or score >= KEEP_SCORE:
            found.append((kind, start, end, round(score, 3)))
    return found


SPAN = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
                     T.StructField("end", T.LongType()), T.StructField("score", T.DoubleType())])
ARROW_SPAN = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                                 ("score", pa.float64())]))


def pii_spans(df: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Per row: the ``keep`` columns and ``spans``, an array of (kind, start, end, score)."""
    inner = [f"k{i}" for i in range(len(keep))]
    rows = df.select(*(F.col(k).alias(a) for k, a in zip(keep, inner)), whole_text(text_col).alias("t"))
    fields = [T.StructField(a, rows.schema[a].dataType) for a in inner] + [T.StructField("spans", T.ArrayType(SPAN))]

    def run(batches):
        for batch in batches:
            spans = [[dict(zip(("kind", "start", "end", "score"), s)) for s in find_spans(v.as_py())]
                     for v in batch.column("t")]
            yield pa.RecordBatch.from_arrays([*(batch.column(a) for a in inner), pa.array(spans, ARROW_SPAN)],
                                             [*inner, "spans"])

    out = rows.mapInArrow(run, T.StructType(fields))
    return out.select(*(F.col(a).alias(k) for k, a in zip(keep, inner)), "spans")


def span_text(spans, kinds: tuple[str, ...]):
    """``kind:start:end`` of the spans of some kinds, comma-joined."""
    wanted = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.concat_ws(",", F.transform(wanted, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))


def masked(text, spans):
    """The text with each span replaced by ``[KIND]`` (overlapping spans by the first)."""
    start = F.struct(F.lit("").alias("done"), F.lit(0).cast("long").alias("at"))
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"], s["end"], s["kind"])))

    def put(acc, s):
        behind = F.concat(acc["done"], F.substring(text, (acc["at"] + 1).cast("int"),
                                                   (s["start"] - acc["at"]).cast("int")),
                          F.lit("["), F.upper(s["kind"]), F.lit("]"))
        return F.when(s["start"] < acc["at"], acc).otherwise(F.struct(behind.alias("done"), s["end"].alias("at")))

    return F.aggregate(ordered, start, put,
                       lambda acc: F.concat(acc["done"], F.substring(text, (acc["at"] + 1).cast("int"),
                                                                     F.length(text))))
