"""N-gram join, line dedup and decontamination against brute force."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from tidelog.llm import ngram_join
from tidelog.llm.common import stored_by, stored_for
from tidelog.llm.components import components
from tidelog.llm.decontam import decontaminated, overlaps
from tidelog.llm.line_dedup import dedup_lines, near_lines
from tidelog.llm.ngram_join import ngram_components
from tidelog.llm.queries import ORACLES, QUERIES
from tidelog.session import remove

from .conftest import prose


def least_members(nodes, edges):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(100, 160)] + [(5000, x) for x in range(5001, 5030)]
    edges += [(rng.randint(1000, 1100), rng.randint(1000, 1100)) for _ in range(60)] + [(7, 7)]
    want = least_members({x for a, b in edges if a != b for x in (a, b)}, [e for e in edges if e[0] != e[1]])
    for native in (True, False):
        got = components(spark.createDataFrame(edges, "a long, b long"), native).collect()
        assert {r.node: r.component for r in got} == want
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def shingles(text, size):
    words = (text or "").encode().lower().split()
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def brute_components(texts, size, num, den):
    sets = {i: shingles(t, size) for i, t in texts.items()}
    edges = [(a, b) for a, b in itertools.combinations(sets, 2)
             if sets[a] and sets[b] and den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b])]
    return least_members(sets, edges), {i: len(s) for i, s in sets.items()}


def drifting_copies(n, words, seed):
    """Copies of copies, a few words changed each time: similarities of all degrees."""
    rng = random.Random(seed)
    texts = [prose(words, seed).split()]
    while len(texts) < n:
        own = list(rng.choice(texts))
        for _ in range(rng.randint(0, 3)):
            own[rng.randrange(len(own))] = prose(1, rng.random())
        texts.append(own)
    return [" ".join(t) for t in texts]


@pytest.mark.parametrize("size,threshold", [(4, (85, 100)), (5, (4, 5))])
def test_components_of_drifting_copies_are_exact(spark, monkeypatch, size, threshold):
    if size == 4:  # groups of many blocks
        monkeypatch.setattr(ngram_join, "SENT", 16)
    shared = prose(60, 77)  # a passage that many documents share
    texts = drifting_copies(120, 80, 5) + drifting_copies(30, 6, 6) + ["one two", "ONE two", "", "a b c", "a b c"]
    texts += [f"{prose(50, 100 + i)} {shared}" for i in range(40)]
    texts = dict(enumerate(texts))
    df = spark.createDataFrame([(i, t) for i, t in texts.items()], "doc_id long, text string").repartition(5)
    got = ngram_components(df, size=size, threshold=threshold).collect()
    want, sizes = brute_components(texts, size, *threshold)
    assert {r.doc_id: r.component_id for r in got} == want
    assert {r.doc_id: r.n_shingles for r in got} == sizes
    assert 1 < len({want[i] for i in range(120)}) < 120


def test_join_of_odd_tables(odd_docs, no_docs):
    rows = ngram_components(odd_docs).collect()
    found = {r.doc_id: r.component_id for r in rows}
    assert len(rows) == odd_docs.count()
    assert found[1] == found[4] == found[8] == 1 and found[5] == 5 and found[None] is None
    assert (found[2], found[3], found[6]) == (2, 3, 6)
    assert ngram_components(no_docs).collect() == []


def test_join_query_is_brute_force(spark, sf_dir):
    texts = dict(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect())
    want, sizes = brute_components(texts, 4, 85, 100)
    rows = QUERIES["op6_ngram_join"](spark, sf_dir).collect()
    assert {r.doc_id: (r.component_id, r.n_shingles) for r in rows} == {i: (want[i], sizes[i]) for i in texts}


# --- lines ---------------------------------------------------------------------------------

def edits(a, b):
    before = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
        before = row
    return before[-1]


@pytest.mark.parametrize("most", [1, 2, 3])
def test_edit_join_is_exact(spark, most):
    rng = random.Random(5)
    lines = {"".join(rng.choice("ab é") for _ in range(rng.randint(4, 14))) for _ in range(40)}
    for x in sorted(lines):
        for _ in range(3):
            y = list(x)
            for _ in range(rng.randint(1, 4)):
                k = rng.randrange(len(y) + 1)
                y[k : k + rng.randint(0, 1)] = rng.choice(["", "a", "é", "😀", " "])
            if len(y) >= 4:
                lines.add("".join(y))
    lines = sorted(lines)
    df = spark.createDataFrame([(i, 0, x) for i, x in enumerate(lines)], "doc long, no int, line string")
    name = {r.id: r.line for r in df.select(F.xxhash64("line").alias("id"), "line").collect()}
    got = {tuple(sorted((name[r.a], name[r.b]))) for r in near_lines(df, most).collect()}
    want = {(a, b) for a, b in itertools.combinations(lines, 2)
            if abs(len(a) - len(b)) <= most and edits(a, b) <= most}
    assert got == want and want


def test_first_of_near_lines_stays(spark, odd_docs, no_docs):
    a, b = "the quick brown fox jumps over", "a wholly different line of text"
    rows = [(2, f"{a}\nshort\n{b}"), (1, f"short\n{a}!\n{a}!"), (3, b.upper()), (4, None), (5, ""), (None, a)]
    out = dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    got = {r.doc_id: (r.text, r.n_lines, r.n_removed) for r in out}
    assert got == {None: (a, 1, 0), 1: ("short", 3, 2), 2: (f"short\n{b}", 3, 1), 3: (b.upper(), 1, 0),
                   4: (None, 0, 0), 5: ("", 1, 0)}
    assert dedup_lines(odd_docs).count() == odd_docs.count()
    assert set(odd_docs.columns) < set(dedup_lines(odd_docs).columns)
    assert dedup_lines(no_docs).collect() == []


# --- benchmark overlaps ------------------------------------------------------------------------

def test_overlaps_tolerate_substitutions(spark, odd_docs, no_docs):
    item = [f"word{i}" for i in range(30)]
    short = "six words make one whole item".split()

    def changed(*places):
        return " ".join("X" if i in places else w for i, w in enumerate(item))

    docs = [(1, "before " + " ".join(item)), (2, changed(*range(0, 30, 3))), (3, changed(*range(2, 30, 6))),
            (4, " ".join(item[5:17])), (5, " ".join(item[5:16])), (6, "x " + " ".join(short).upper() + " y"),
            (7, " ".join(short[:5])), (8, None), (9, changed(10, 16)), (None, " ".join(item)), (1, "before " + " ".join(item))]
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    items = spark.createDataFrame([(0, " ".join(item)), (1, " ".join(short)), (2, None), (3, "too short")],
                                  "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.matched, r.first_word, r.end_word) for r in overlaps(docs, items).collect()}
    assert got == {(1, 0): (12, 1, 31), (3, 0): (10, 0, 30), (4, 0): (12, 0, 12), (6, 1): (6, 1, 7),
                   (9, 0): (12, 0, 30), (None, 0): (12, 0, 30)}
    assert sorted(r.doc_id for r in decontaminated(docs, items).collect()) == [2, 5, 7, 8]
    assert overlaps(no_docs, items).collect() == [] and overlaps(docs, items.limit(0)).collect() == []
    assert decontaminated(odd_docs, items).count() == odd_docs.count()


@pytest.mark.parametrize("name", ["op3_line_dedup", "op10_decontamination"])
def test_queries_equal_their_sql(spark, sf_dir, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    want = con.sql(ORACLES[name])
    got = QUERIES[name](spark, sf_dir).select(*want.columns).collect()
    assert sorted(map(tuple, got)) == sorted(want.fetchall())


def test_lines_of_texts_with_equal_ids_are_their_own(spark):
    shared = "this line is in both of the texts"
    rows = [(None, f"the first line of one text\n{shared}"), (None, f"{shared}\nanother line of the other text"),
            (4, f"{shared}\nthe fourth has this line too"), (4, f"a line before the shared one\n{shared}"), (4, None)]
    out = dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    lines = [line for r in out if r.text is not None for line in r.text.split("\n")]
    assert sorted(lines) == sorted({line for _, t in rows if t for line in t.split("\n")})


def test_buckets_of_the_same_members_are_one(spark):
    """Ten shingles of the same two classes give one bucket; lists that differ stay apart,
    rows that repeat count once, a shingle of one class gives none."""
    rows = [(t, k) for t in range(10) for k in (7, -3)] + [(20, 7), (20, -3), (20, 5), (30, 7), (0, 7), (0, 7)]
    got = ngram_join.member_lists(spark.createDataFrame(rows, "token int, key long")).collect()
    lists = {}
    for r in got:
        lists.setdefault(r.token, []).append(r.key)
    assert sorted(map(sorted, lists.values())) == [[-3, 5, 7], [-3, 7]]
    assert ngram_join.member_lists(spark.createDataFrame([], "token int, key long")).count() == 0


def shuffles_by_key(spark, df):
    """Shuffles by key of a join with ``df``, if Spark broadcasts neither side."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        both = spark.createDataFrame([(1, 2)], "key long, other long").join(df, "key")
        return both._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning(key")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_sets_are_dealt_by_class_once(spark, monkeypatch):
    """Both rounds get one set a class, from a store that a join by class does not
    shuffle again; the index is gone by then."""
    given, verified = [], ngram_join.verified

    def seen(pairs, sets, *rest):
        keys = [r.key for r in sets.select("key").collect()]
        given.append((len(keys), len(set(keys)), shuffles_by_key(spark, sets)))
        return verified(pairs, sets, *rest)

    folders = []
    monkeypatch.setattr(ngram_join, "verified", seen)
    monkeypatch.setattr("tidelog.llm.common.remove", lambda s, path: (folders.append(path), remove(s, path)))
    rows = [(i, t) for i, t in enumerate(drifting_copies(30, 60, 9) * 3)]  # classes in several tasks
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.component_id for r in ngram_components(df, size=4, threshold=(85, 100)).collect()}
    assert got == brute_components(dict(rows), 4, 85, 100)[0]
    (rows_a, keys_a, first), (rows_b, keys_b, second) = given
    assert rows_a == keys_a == rows_b == keys_b > 1 and first == second == 1
    assert len(folders) == 1 and "/jaccard-index-" in folders[0]


def test_stored_rows_have_one_row_a_key_and_no_table(spark):
    tables = len(spark.catalog.listTables())
    rows = spark.createDataFrame([(1, [1, 2]), (1, [1, 2]), (2, [3]), (None, None), (None, None)],
                                 "key long, shingles array<long>")
    out = stored_by(rows, "key", "by_key")
    assert sorted(map(str, out.collect())) == sorted(map(str, rows.distinct().collect()))
    assert shuffles_by_key(spark, out) == 1
    assert stored_by(rows.limit(0), "key", "by_key").collect() == []
    assert len(spark.catalog.listTables()) == tables
    with pytest.raises(ZeroDivisionError), stored_for(rows, "for_a_while") as held:
        assert held.count() == 5
        path = held.inputFiles()[0].rsplit("/", 1)[0]
        1 / 0
    with pytest.raises(Exception):
        spark.read.parquet(path).count()
