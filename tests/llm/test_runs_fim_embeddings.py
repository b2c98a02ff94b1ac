"""Operators 11 to 13 against brute force, round trips and odd tables."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import tidelog.llm.embed_join as EJ
from tidelog.llm import fim, periodic

SPACE = re.compile(r"[^\x20\x09-\x0D]+")


# --- periodic runs ----------------------------------------------------------------------

def plain_runs(words, least=6, times=4):
    """From the definition: maximal stretches of every period, the smallest period of each."""
    n, found = len(words), {}
    for q in range(1, n // times + 1):
        at = 0
        while at + q < n:
            end = at
            while end + q < n and words[end] == words[end + q]:
                end += 1
            if end + q - at >= max(least, times * q):
                found.setdefault((at, end + q), q)
            at = max(end, at) + 1
    return sorted((s, e - s, q) for (s, e), q in found.items())


def found_runs(texts):
    ids = np.array([hash(w) % 1000003 for words in texts for w in words], np.int64)
    numbers = {v: i for i, v in enumerate(dict.fromkeys(ids.tolist()))}
    ids = np.array([numbers[v] for v in ids.tolist()], np.int64)
    lengths = [len(t) for t in texts]
    starts = np.cumsum([0, *lengths])
    doc = np.repeat(np.arange(len(texts)), lengths)
    own = [[] for _ in texts]
    for s, n, q in periodic.runs(ids, doc, max([0, *lengths]) // 4):
        own[doc[s]].append((s - int(starts[doc[s]]), n, q))
    return [sorted(o) for o in own]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.integers(0, 3), max_size=80), max_size=5))
def test_runs_of_few_words(texts):
    assert found_runs(texts) == [plain_runs(t) for t in texts]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=12), st.integers(1, 7)), max_size=8))
def test_runs_of_repeated_blocks(blocks):
    words = [w for block, times in blocks for w in block * times]
    assert found_runs([words, words[3:], words]) == [plain_runs(words), plain_runs(words[3:]), plain_runs(words)]


def test_frequent_words_give_few_lags():
    rng = random.Random(4)
    ids = np.array([0 if rng.random() < 0.4 else rng.randint(1, 300) for _ in range(200000)], np.int64)
    position, lag = periodic.sparse_lags(ids, np.zeros(len(ids), np.int64), len(ids) // 4)
    assert len(position) < 2 * len(ids)
    same = np.zeros(60000, np.int64)
    assert list(periodic.runs(same, same, len(same) // 4)) == [(0, 60000, 1)]


def plain_looped(doc_id, text):
    words = SPACE.findall(text or "")
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
    return words


def test_op11_rows_and_odd_tables(spark, odd_docs, no_docs, sf_dir):
    looped_id = next(i for i in range(1000, 2000) if zlib.crc32(str(i).encode()) % 10 == 0)
    more = spark.createDataFrame(
        [(looped_id, " ".join("abcdefghij"[i % 10] for i in range(90))), (looped_id, "x"), (77, "la " * 9 + "end"),
         (78, " a  \x00 \x00 \x00 \x00 \x00 \x00 \x00"), (79, "a\x0bb\x0ca\rb\na\tb a b")],
        "doc_id long, text string")
    docs = odd_docs.unionByName(more, allowMissingColumns=True)
    out = periodic.periodic_runs(periodic.looped(docs)).collect()
    want = [(r["doc_id"], plain_looped(r["doc_id"], r["text"])) for r in docs.collect()]
    assert len(out) == len(want)
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    got = sorted(((r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in out), key=key)
    plain = []
    for doc_id, words in want:
        runs = plain_runs(words) if len(words) < 1000 else []
        gone = {i for s, n, q in runs for i in range(s + q, s + n)}
        plain.append((doc_id, len(words), runs, " ".join(w for i, w in enumerate(words) if i not in gone)))
    assert got == sorted(plain, key=key)
    assert any(r[0] == 77 and r[2] == [(0, 9, 1)] for r in got)
    assert periodic.periodic_runs(periodic.looped(no_docs)).count() == 0
    assert periodic.periodic_runs(odd_docs.select(F.col("id").alias("doc_id"), "text")).count() == odd_docs.count()


def test_op11_ties_of_the_longest_run(spark):
    text = "a a a a a a x b b b b b b y c d c d c d c d"
    row = periodic.periodic_runs(spark.createDataFrame([(1, text)], "doc_id long, text string")).select(
        "runs", periodic.longest_run().alias("top"), periodic.run_lines().alias("lines")).first()
    assert row["lines"] == "0,6,1\n7,6,1\n14,8,2\n"
    assert tuple(row["top"]) == (14, 8, 2)
    row = periodic.periodic_runs(spark.createDataFrame([(1, "z " + text[:27])], "doc_id long, text string")).select(
        periodic.longest_run().alias("top")).first()
    assert tuple(row["top"]) == (1, 6, 1)


# --- fill in middle ------------------------------------------------------------------------

def plain_fim(doc_id, text):
    text = text or ""
    units = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i : 8 * i + 8], 16) for i in range(4))
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return len(units), "plain", None, None, text, text
    if h4 % 100 < 80:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}", text
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}", text


def test_op12_rows_and_odd_tables(spark, odd_docs, no_docs):
    texts = ["<P> a b", "a <S>", "x<M>", "<P", ">", "P> <S <M", "  lead", "trail \n", " ", "\t\n", "é ü 😀 <", "M> <P"]
    many = [(1000 + i, texts[i % len(texts)] if i % 3 else "one  two\tthree four five six " + "é" * (i % 7))
            for i in range(300)]
    docs = odd_docs.unionByName(spark.createDataFrame(many, "doc_id long, text string"), allowMissingColumns=True)
    out = fim.with_restored(fim.fill_in_middle(docs)).collect()
    key = lambda r: tuple((v is None, v if v is not None else 0) for v in r)
    got = sorted((tuple(r) for r in out), key=key)
    assert got == sorted(((r["doc_id"], *plain_fim(r["doc_id"], r["text"])) for r in docs.collect()), key=key)
    assert {r["form"] for r in out} == {"plain", "psm", "spm"}
    assert fim.with_restored(fim.fill_in_middle(no_docs)).count() == 0
    named = fim.fill_in_middle(odd_docs, id_col="key", seed=7, rate=100, spm_rate=0)
    assert {r["form"] for r in named.collect()} == {"plain", "psm"} and named.columns[0] == "key"


@settings(max_examples=200, deadline=None)
@given(st.binary(max_size=60).filter(lambda t: b"<" not in t), st.integers(0, 60), st.integers(0, 60),
       st.sampled_from([fim.PSM, fim.SPM]))
def test_rotations_restore_any_cuts(text, a, b, form):
    a, b = sorted((min(a, len(text)), min(b, len(text))))
    buffer = bytearray(text)
    fim.arrange(buffer, a, b, form)
    p, m, s = text[:a], text[a:b], text[b:]
    assert bytes(buffer) == (b"<P>" + p + b"<S>" + s + b"<M>" + m if form == fim.PSM
                             else b"<S>" + s + b"<P>" + p + b"<M>" + m)
    fim.restore(buffer, form)
    assert bytes(buffer) == text


def test_rotation_of_long_segments():
    text = bytes(np.random.default_rng(1).integers(65, 90, 500001, dtype=np.uint8))
    buffer = bytearray(text)
    fim.rotate(buffer, 10, 200003, 500001)
    assert bytes(buffer) == text[:10] + text[200003:] + text[10:200003]


# --- embeddings --------------------------------------------------------------------------------

def plain_links(rows, threshold=0.9):
    """(id, n_links, component, kept) from all pairs."""
    ok = [v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v)
          for _, v in rows]
    unit = [np.array(v, float) / max(map(abs, v)) if good else None for (_, v), good in zip(rows, ok)]
    unit = [u / np.sqrt(u @ u) if u is not None else None for u in unit]
    n, links, part = len(rows), [0] * len(rows), list(range(len(rows)))

    def find(x):
        while part[x] != x:
            x = part[x]
        return x

    for i in range(n):
        for j in range(i):
            if ok[i] and ok[j] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= threshold:
                links[i] += 1
                links[j] += 1
                part[find(i)] = find(j)
    out = []
    for i in range(n):
        least = min((rows[j][0] for j in range(n) if find(j) == find(i) and rows[j][0] is not None), default=None)
        out.append((rows[i][0], links[i], least, rows[i][0] is not None and rows[i][0] == least))
    return sorted(out, key=str)


VECTORS = "vec_id long, embedding array<float>, label int, key string, id long, place int, copies int"


def links_of(spark, rows, **kw):
    frame = spark.createDataFrame([(i, v, 1, "k", 5, 2, 3) for i, v in rows], VECTORS)
    return sorted((tuple(r) for r in EJ.embedding_links(frame, **kw).collect()), key=str)


def floats(v):
    return [float(np.float32(x)) for x in v]


def test_op13_equals_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(EJ, "BLOCK", 16)
    rng = np.random.default_rng(5)
    rows, at = [], 0
    for spread, n in ((0, 30), (0.02, 60), (0.05, 60), (0.06, 60), (0.3, 20)):
        middle = rng.normal(size=40)
        middle /= np.linalg.norm(middle)
        for _ in range(n):
            rows.append((at, floats((middle + spread * rng.normal(size=40)) * rng.uniform(0.1, 9))))
            at += 1
    rows += [(at + i, floats(rng.normal(size=40))) for i in range(60)]
    chain = [[math.cos(0.4 * k), math.sin(0.4 * k)] + [0.0] * 38 for k in range(15)]  # each links with the next only
    rows += [(1000 - k, floats(v)) for k, v in enumerate(chain)]
    assert links_of(spark, rows) == plain_links(rows)


def test_op13_odd_vectors(spark):
    v = floats([0.5, -0.25, 1.0])
    rows = [(1, v), (2, v), (2, v), (None, v), (3, [x * 2 for x in v]), (4, [x * 1e30 for x in v]), (5, None), (6, []),
            (7, [0.0, 0.0, 0.0]), (8, [float("nan"), 1.0, 1.0]), (9, [float("inf"), 1.0, 1.0]), (10, [None, 1.0, 1.0]),
            (11, v[:2]), (12, v + [0.0]), (13, [0.0, 1.0, 0.0]), (14, [-0.0, 1.0, -0.0]), (None, None),
            (15, [-x for x in v]), (16, [x * 1e-30 for x in v]), (None, [9.0, 9.0, -9.0])]
    assert links_of(spark, rows) == plain_links(rows)
    assert links_of(spark, []) == []
    assert links_of(spark, [(1, None), (2, [0.0])]) == [(1, 0, 1, True), (2, 0, 2, True)]
    doubles = spark.createDataFrame([(1, [1e200, 1e200]), (2, [1e-200, 1.1e-200])], "vec_id long, embedding array<double>")
    assert [r["n_links"] for r in EJ.embedding_links(doubles).collect()] == [1, 1]


def test_op13_large_group(spark):
    rng = np.random.default_rng(6)
    middle = rng.normal(size=16)
    rows = [(i, floats(middle + 0.01 * rng.normal(size=16))) for i in range(6000)]
    rows += [(6000 + i, floats(rng.normal(size=16))) for i in range(3000)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = {r["vec_id"]: r for r in EJ.embedding_links(frame).collect()}
    x = np.array([v for _, v in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    degrees = ((x @ x.T) >= 0.9).sum(1) - 1
    assert [got[i]["n_links"] for i in range(9000)] == degrees.tolist()
    assert all(got[i]["component_id"] == 0 for i in range(6000))


@pytest.mark.parametrize("threshold", [0.5, 0.7, 0.99])
def test_op13_blocks_equal_plain_cosines(threshold):
    rng = np.random.default_rng(7)
    base = np.repeat(rng.normal(size=(40, 50)), 5, axis=0)
    x = (base + 0.3 * rng.normal(size=base.shape)).astype(np.float32)
    table = pa.table({"key": np.arange(200), "copies": rng.integers(1, 4, 200), "place": np.zeros(200, int),
                      "v": pa.array(list(x), pa.list_(pa.float32()))})
    axes = np.linalg.eigh(x.T @ x)[1][:, ::-1].astype(float)
    one, other = EJ.Tile(table.slice(0, 120), axes), EJ.Tile(table.slice(120), axes)
    keys, links, labels = EJ.compared(one, other, threshold)
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    near = (u[:120] @ u[120:].T) >= threshold
    copies = table["copies"].to_numpy()
    want = np.concatenate([near @ copies[120:], near.T @ copies[:120]])
    assert dict(zip(keys.tolist(), links.tolist())) == dict(enumerate(want.tolist()))
