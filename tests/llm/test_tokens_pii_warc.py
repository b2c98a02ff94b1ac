"""Token counts, personal data and archives: exact counts, brute force and round trips."""

import base64
import hashlib
import random
import re

import public_tokenizers
import pytest
import tokenizers

from tidelog.llm import tokens
from tidelog.llm.pii import BASE_KINDS, find_spans, luhn, masked, mod97, pii_spans
from tidelog.llm.queries import QUERIES, TOKENIZER
from tidelog.llm.tokens import PrefixCounter, token_prefixes
from tidelog.llm.warc import check_counts, read_warc, records_in, write_warc
from tidelog.session import scratch_path

PATH = public_tokenizers.path(TOKENIZER)


@pytest.fixture(scope="module")
def library():
    own = tokenizers.Tokenizer.from_file(PATH)
    return lambda text: len(own.encode(text, add_special_tokens=False).ids)


@pytest.fixture(scope="module")
def counter():
    return PrefixCounter(PATH)


@pytest.mark.parametrize("text", [
    "", "  ", "it's we'll they've don't 'tis '' '''s x", "abc<|endoftext|>def <|endoftext|>", "!!<|endoftext|>!!",
    "<|ENDOFTEXT|>", "a" * 70, "tokenization1234 x\x1c\x85y​z", "ß straße ÀÉ çÇ", "'ll 'l l'l ''ll", "日本語 text ١٢٣ ½",
])
def test_every_prefix_has_the_count_of_the_library(counter, library, text):
    assert list(counter.prefixes(text).counts()) == [library(text[:i]) for i in range(len(text) + 1)]


def test_counts_of_changed_lengths_and_all_letters(counter, library):
    for text in ("İstanbul", "école ﬁ", "Ǆ ΣΑΣ"):
        assert counter.prefixes(text).total == library(text)
    for code in range(0, 0x2100):
        text = f"a{chr(code)}b'{chr(code)}"
        assert counter.prefixes(text).total == library(text), hex(code)


def test_budgets_are_answered_from_stored_counts(counter):
    rng = random.Random(4)
    for _ in range(50):
        text = "".join(rng.choice("ab 'the.1\né<|endoftext|>") for _ in range(rng.randint(0, 60)))
        counts = counter.prefixes(text).counts()
        for budget in (0, 1, 5, 1000):
            fits = counter.prefixes(text).longest_within(budget)
            assert (len(text) if fits is None else fits) == max(i for i, c in enumerate(counts) if c <= budget)


def test_a_stored_prefix_is_never_worked_out_again():
    own, steps = PrefixCounter(PATH), []
    step = own.step
    own.step = lambda data, i, *more: (steps.append(data[:i]), step(data, i, *more))[1]
    for text in ("token", "tokens,", "tokens", "token.", "tokenized"):
        own.prefixes(text)
    # one step a prefix, for its tokens inside a word and as a whole word together
    assert steps == ["t", "to", "tok", "toke", "token", "tokens", ",", ".", "tokeni", "tokeniz", "tokenize", "tokenized"]


def test_counts_do_not_depend_on_what_is_stored(monkeypatch, library):
    monkeypatch.setattr(tokens, "CACHE_PREFIXES", 40)
    monkeypatch.setattr(tokens, "CACHE_BORDERS", 60)
    monkeypatch.setattr(tokens, "CACHE_WORDS", 5)
    own, rng = PrefixCounter(PATH), random.Random(6)
    letters = ["th", "on", "ing", "é", "日", "x", "Q", "7", "'s"]
    texts = [" ".join("".join(rng.choices(letters, k=rng.choice([1, 3, 9, 60]))) for _ in range(6)) for _ in range(8)]
    # a word of more than 255 tokens, once more behind one that shares its beginning
    texts += ["日本語" * 150 + " a", "th" * 31 + "on", "th" * 200, "a,<|endoftext|>" + "éx" * 33 + ".,"]
    for text in texts:
        cuts = sorted({0, 1, len(text), *(rng.randint(0, len(text)) for _ in range(150))})
        counts = own.prefixes(text).counts()
        assert len(counts) == len(text) + 1
        assert [counts[i] for i in cuts] == [library(text[:i]) for i in cuts], text
        for budget in (1, 20, 260, len(text)):
            fits = own.prefixes(text).longest_within(budget)
            assert (len(text) if fits is None else fits) == max(i for i, c in enumerate(counts) if c <= budget)


def test_token_query_over_whole_table(spark, sf_dir, library):
    texts = dict(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect())
    rows = QUERIES["op5_token_counts"](spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        n = library(texts[r.doc_id] or "")
        assert (r.n_tokens, r.over_limit, r.n_bytes) == (n, n > 2048, len((texts[r.doc_id] or "").encode()))


def test_tokens_of_odd_tables(odd_docs, no_docs, library):
    rows = token_prefixes(odd_docs, PATH, 10, keep=("doc_id", "t"), store_counts=True).collect()
    assert len(rows) == odd_docs.count() and all(len(r.prefix_tokens) >= 1 for r in rows)
    assert {r.doc_id: r.n_tokens for r in rows}[2] == 0
    assert token_prefixes(no_docs, PATH, 10).collect() == []


# --- personal data ---------------------------------------------------------------------

def base_spans(text):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
            if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
            if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return out


def test_base_spans_are_those_of_the_patterns():
    rng, found = random.Random(3), 0
    pieces = ["1.2.3", "255", ".", "4111 1111-1111 1111", "a@b.c", "@", "+49 ", "(0) 123 4567", " ", "é", "256", "-", "a"]
    for _ in range(5000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 12)))
        spans = [s[:3] for s in find_spans(text) if s[0] in BASE_KINDS]
        assert spans == base_spans(text), text
        found += len(spans)
    assert found > 1000


def test_checksums_and_context():
    assert luhn("4111111111111111") and not luhn("4111111111111112")
    assert mod97("GB82WEST12345698765432") and not mod97("GB83WEST12345698765432")
    kinds = [(k, s) for k, _, _, s in find_spans("my IBAN is GB82 WEST 1234 5698 7654 32; 123-45-6789")]
    assert kinds == [("iban", 1.0)]
    assert [k for k, *_ in find_spans("social security 123-45-6789")] == ["ssn"]


def test_long_runs_take_linear_time():
    for text in ("a" * 300000, "1" * 300000, "1 " * 150000, "+1" * 100000, "a@" * 100000):
        find_spans(text)


def test_pii_of_odd_tables_and_masking(spark, odd_docs, no_docs):
    assert pii_spans(no_docs).collect() == []
    assert pii_spans(odd_docs, keep=("doc_id", "id")).count() == odd_docs.count()
    df = spark.createDataFrame([(1, "é a@b.co and 1.2.3.4!")], "doc_id long, text string")
    out = pii_spans(df, keep=("doc_id", "text"))
    assert out.select(masked(out["text"], out["spans"])).first()[0] == "é [EMAIL] and [IP]!"


def test_pii_query_is_brute_force(spark, sf_dir):
    texts = dict(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect())
    for r in QUERIES["op2_pii"](spark, sf_dir).collect():
        spans = base_spans(texts[r.doc_id] or "")
        said = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert r.base_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(s[0] == k for s in spans) for k in BASE_KINDS)
        assert set(said.split(",")) <= {*r.spans.split(","), ""}


# --- archives --------------------------------------------------------------------------

PAGES = "page_id long, url string, html string, path string, bytes int"


def test_warc_round_trip_with_odd_rows_and_any_range(spark):
    rows = [(3, "http://a", "same", "p", 1), (1, None, "same", "p", 1), (2, "http://b\r\nX: y", None, "p", 1),
            (9, "u", "", "p", 1), (None, "v", "same", "p", 1), (7, "w", "\x1f\x8b\x08 WARC/1.1 é" * 9, "p", 1),
            (8, "x", "long " * 100000, "p", 1), (1, None, "same", "p", 1)]
    df = spark.createDataFrame(rows, PAGES)
    manifest = write_warc(df, scratch_path(spark, "warc"), "page_id", "url", "html")
    results = []
    for split in (37, 1 << 20):
        out = read_warc(spark, manifest, split, with_payload=True).collect()
        results.append(sorted((str(r.record_id), r.record_type, r.refers_to, r.payload_bytes, r.payload_digest) for r in out))
        assert len(out) == len(rows) and all(r.digest_ok for r in out)
        for r in out:
            if r.record_type == "response":
                assert r.payload_digest == base64.b32encode(hashlib.sha1(r.payload).digest()).decode()
    assert results[0] == results[1]
    types = {(r[0], r[1], r[2]) for r in results[0]}
    assert types == {("1", "response", None), ("3", "revisit", "1"), ("None", "response", None), ("2", "response", None),
                     ("9", "revisit", "2"), ("7", "response", None), ("8", "response", None)}


def test_small_payloads_are_not_revisited(spark):
    df = spark.createDataFrame([(1, "a", "xy", "", 0), (2, "a", "xy", "", 0)], PAGES)
    manifest = write_warc(df, scratch_path(spark, "warc"), "page_id", "url", "html", dedup_min_bytes=3)
    assert [r.record_type for r in read_warc(spark, manifest).collect()] == ["response"] * 2
    empty = write_warc(df.filter("false"), scratch_path(spark, "warc"), "page_id", "url", "html")
    assert read_warc(spark, empty).collect() == []


def test_embedded_magic_is_no_record():
    import gzip
    import io
    data = gzip.compress(b"not a record") + gzip.compress(b"WARC/1.1\r\nX: y\r\n\r\n")
    assert list(records_in(io.BytesIO(data), len(data), 0, len(data))) == []


def test_headers_of_any_length_are_read(spark, tmp_path):
    rng = random.Random(4)
    long = "data:," + "".join(rng.choice("0123456789abcdef") for _ in range(3_000_000))
    pages = [(1, long[:70_000], "one"), (2, "http://x/", "two"), (3, long, "three"), (4, "http://y/", "four")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").coalesce(1)
    manifest = write_warc(df, f"file://{tmp_path}", "page_id", "url", "html")
    for split in (1 << 24, 50_000):
        records = read_warc(spark, manifest, split_bytes=split)
        assert {(int(r.record_id), r.target_uri) for r in records.collect()} == {p[:2] for p in pages}
        check_counts(records, manifest)
    with pytest.raises(ValueError, match="3 records read, 4 written"):
        check_counts(records.filter("record_id <> '3'"), manifest)
