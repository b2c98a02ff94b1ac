"""Quality scores, mixing, chat formatting, fingerprints and the pipeline."""

import hashlib
import itertools
import os

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidelog.llm.chat import ChatTemplate, format_chats, learned_text, read_turns
from tidelog.llm import mixing
from tidelog.llm.mixing import OTHER, RATE, marginals, mix, rake, tempered
from tidelog.llm.quality import keep_quality, pooled, quality_scores, statistics
from tidelog.llm.queries import ORACLES, QUERIES
from tidelog.llm.spotsigs import fingerprint, fingerprints, likeness, near_pairs, next_likeness, signature_sets

from .conftest import prose
from .test_ngram_lines import drifting_copies

# --- quality ----------------------------------------------------------------------------


def test_held_out_accuracy(spark):
    """Fold 0 is never learned from, so its labels measure the classifier."""
    sf = "/root/testdata/sf0.01"
    if not os.path.isdir(sf):
        pytest.skip("driver test data not present")
    scores = QUERIES["op8_quality"](spark, sf)
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality")
    rows = scores.join(labels, "doc_id").filter("held_out").collect()
    assert len(rows) > 50
    assert sum(r.predicted == r.quality for r in rows) / len(rows) >= 0.93
    good, bad = ([r.score for r in rows if r.quality == q] for q in (1, 0))
    assert np.mean([g > b for g, b in itertools.product(good, bad)]) > 0.97
    everything = scores.collect()
    assert all(0 <= r.score <= 1 for r in everything)
    assert len(everything) == spark.read.parquet(f"{sf}/documents.parquet").count()


def test_pooling_adjacent_violators():
    assert list(pooled(np.array([0.0, 1.0, 0.0, 1.0]), np.ones(4))) == [0.0, 0.5, 0.5, 1.0]
    assert len(pooled(np.empty(0), np.empty(0))) == 0


def test_statistics_read_the_whole_text():
    assert not np.array_equal(statistics(b"word " * 50000), statistics(b"word " * 50000 + b"!" * 50000))
    assert np.array_equal(statistics(b""), np.zeros(len(statistics(b"x"))))


def test_quality_of_odd_tables(spark, odd_docs, no_docs):
    kind = "doc_id long, quality int, toxic int, text string"
    labels = spark.createDataFrame([(i, i % 2, 0, "x") for i in range(1, 10)] + [(None, 1, 0, "x"), (3, None, 0, "x"),
                                                                               (1, 0, 0, "x")], kind)
    rows = quality_scores(odd_docs, labels).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert [r.held_out for r in rows if r.doc_id is None] == [False]
    assert quality_scores(no_docs, labels).collect() == []
    assert {r.score for r in quality_scores(odd_docs, labels.limit(0)).collect()} == {0.5}
    kept = keep_quality(odd_docs, labels.limit(0), 0.3)
    assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count()
    assert keep_quality(odd_docs, labels.limit(0), 0.6).count() == 0
    assert keep_quality(no_docs, labels, 0.3).count() == 0


# --- mixing -----------------------------------------------------------------------------

def test_rake_meets_marginals():
    tokens = np.array([400.0, 100.0, 300.0, 200.0])
    members = [np.array([0, 0, 1, 1]), np.array([0, 1, 0, 1])]
    p = rake(tokens, members, [np.array([0.5, 0.5]), np.array([0.6, 0.4])], rate=0.5)
    kept = tokens * p
    assert np.allclose([kept[:2].sum(), kept[2:].sum()], 250) and np.allclose(kept[[0, 2]].sum(), 300)
    assert (p <= 1).all()


def test_mixing_of_odd_tables_and_targets(spark, odd_docs, no_docs):
    rows = mix(odd_docs).collect()
    assert len(rows) == odd_docs.count() and {r.kept for r in rows} <= {True, False}
    assert len({(r.kept, r.keep_probability) for r in rows if r.doc_id == 5}) == 1
    assert {r.n_words for r in rows if r.doc_id in (2, 3, 6)} == {0}
    assert mix(no_docs).collect() == []
    clash = odd_docs.withColumn("topic", F.lit("mine")).withColumn("kept", F.lit("mine"))
    assert "mine" not in {r.topic for r in mix(clash).collect()}
    half = mix(odd_docs, targets={"source": {"a": 0.0, "b": 1.0, OTHER: 0.0}}, rate=0.5).collect()
    assert {r.keep_probability for r in half if r.source == "a" and r.n_words} == {0.0}
    with pytest.raises(ValueError, match="targets"):
        mix(odd_docs, targets={"lang": {str(i): 1.0 for i in range(1000)}})


def test_targets_above_their_tokens_are_shared_out(spark):
    tokens = np.array([900.0, 60.0, 30.0, 10.0])
    members = [np.array([0, 1, 2, 3]), np.array([0, 1, 0, 1])]
    targets = [np.array([0.25, 0.25, 0.25, 0.25]), np.array([0.86, 0.14])]
    kept = tokens * rake(tokens, members, targets, 0.5)
    assert kept.sum() == pytest.approx(500, rel=1e-5)
    assert kept == pytest.approx([400, 60, 30, 10], rel=0.1)  # the rare ones whole, the rest from the first
    feasible = rake(np.array([400.0, 100.0, 300.0, 200.0]), [np.array([0, 0, 1, 1]), np.array([0, 1, 0, 1])],
                          [np.array([0.5, 0.5]), np.array([0.6, 0.4])], 0.5)
    assert np.allclose(np.array([400.0, 100.0, 300.0, 200.0]) * feasible @ [[1, 1], [1, 0], [0, 1], [0, 0]], [250, 300])


def test_mixing_keeps_the_rate(spark, sf_dir):
    mixed = corpus_pipeline.mix(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    n, kept = mixed.agg(F.sum("n_words"), F.sum(F.col("n_words") * F.col("keep_probability"))).first()
    assert kept / n == pytest.approx(RATE, rel=1e-4)
    for d in ("source", "lang", "topic"):
        rows = marginals(mixed, d).collect()
        assert sum(r.wanted for r in rows) == pytest.approx(1) and sum(r.reached for r in rows) == pytest.approx(1)
        for r in rows:  # no share is above what all of its tokens give
            assert r.reached <= r.share / RATE * (1 + 1e-3)


def plain_rake(rows, rate=0.7):
    """Expected keep probability of each (source, lang, topic), by plain loops over dicts."""
    cells = {}
    for cell, n in rows:
        cells[cell] = cells.get(cell, 0) + n
    total = sum(cells.values())
    goals = []
    for d in range(3):
        sums = {}
        for cell, n in cells.items():
            sums[cell[d]] = sums.get(cell[d], 0) + n
        lifted = {k: (v / total) ** 0.5 if v else 0.0 for k, v in sums.items()}
        scale, whole = 0.0, set()
        while True:
            rest = rate * total - sum(sums[k] for k in whole)
            scale = rest / sum(v for k, v in lifted.items() if k not in whole)
            more = {k for k in sums if k not in whole and lifted[k] * scale > sums[k]}
            if not more:
                break
            whole |= more
        goals.append({k: sums[k] if k in whole else lifted[k] * scale for k in sums})
    weight = dict.fromkeys(cells, rate)
    for _ in range(1000):
        for d, goal in enumerate(goals):
            now = dict.fromkeys(goal, 0.0)
            for cell, n in cells.items():
                now[cell[d]] += n * min(1.0, weight[cell])
            for cell in cells:
                if now[cell[d]] > 0:
                    weight[cell] = min(1e9, weight[cell] * goal[cell[d]] / now[cell[d]])
    for _ in range(1000):
        now = sum(n * min(1.0, weight[c]) for c, n in cells.items())
        weight = {c: w * rate * total / now for c, w in weight.items()}
    return {c: min(1.0, w) for c, w in weight.items()}


@pytest.mark.parametrize("driver_cells", [100_000, 0])
def test_all_categories_are_raked(spark, monkeypatch, driver_cells):
    """More than 64 sources, against plain loops, with the cells on the driver and as tables."""
    monkeypatch.setattr(mixing, "DRIVER_CELLS", driver_cells)
    monkeypatch.setattr(mixing, "TOLERANCE", 1e-3 if not driver_cells else 1e-9)
    rows = [(i, prose(5 + i % 7, i), ("en", "de")[i % 3 == 0], f"s{i * i % 151}") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").coalesce(1)
    want = plain_rake([((source, lang, "prose"), len(text.split())) for _, text, lang, source in rows])
    got = {(r.source, r.lang, r.topic): r.keep_probability for r in mix(docs).collect()}
    assert len({r[3] for r in rows}) > 64 and got == pytest.approx(want, abs=1e-4 if driver_cells else 2e-2)


def test_op9_equals_a_plain_rake(spark, sf_dir):
    rows = QUERIES["op9_mixing"](spark, sf_dir).collect()
    want = plain_rake([((r.source, r.lang, r.topic), r.n_words) for r in rows])
    assert {(r.source, r.lang, r.topic): r.keep_probability for r in rows} == pytest.approx(want, abs=1e-3)
    n = sum(r.n_words for r in rows)
    assert sum(r.n_words * r.keep_probability for r in rows) / n == pytest.approx(RATE, rel=1e-3)
    words = {r.doc_id: len((r.text or "").split()) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert {r.doc_id: r.n_words for r in rows} == words
    for r in rows:
        draw = int(hashlib.md5(str(r.doc_id).encode()).hexdigest()[:12], 16) / 16 ** 12
        assert r.kept == (draw < r.keep_probability) or abs(draw - r.keep_probability) < 1e-5


def test_rakes_as_tables_and_on_the_driver_agree(spark, monkeypatch):
    rows = [("a", "x", "t", 900), ("b", "y", "t", 60), ("c", "x", "u", 30), ("d", "y", "u", 10), ("a", "y", "u", 50)]
    cells = spark.createDataFrame(rows, "source string, lang string, topic string, n_words long").coalesce(1)
    monkeypatch.setattr(mixing, "TOLERANCE", 1e-2)
    for targets in (None, {"source": {"a": 0.5, "b": 0.3, OTHER: 0.2}}):
        found = []
        for limit in (100, 0):
            monkeypatch.setattr(mixing, "DRIVER_CELLS", limit)
            found.append({tuple(r[:3]): r[3] for r in mixing.cell_probabilities(cells, targets).collect()})
        assert len(found[0]) == len(rows) and found[0] == pytest.approx(found[1], rel=1e-6)


def test_tempering_lifts_small_shares():
    assert tempered({"a": 0.81, "b": 0.09, "c": 0.0}) == pytest.approx({"a": 0.75, "b": 0.25})


# --- chat --------------------------------------------------------------------------------

ODD_TEXTS = ["</s>[INST] ok [/INST]", "<|im_end|>\n", "<\\|im_start|>", "<<SYS>>x<</SYS>>", "<", "|>", "\\", "é😀",
             "a\n\n", "", "<s", "<<|", "[\\/INST]", "<|im_start|>user\nhi<|im_end|>\n"]


def test_chats_come_back_unchanged(spark):
    rows = [(1, i, ("user", "assistant")[i % 2], t) for i, t in enumerate(ODD_TEXTS)]
    rows += [(2, 0, "odd\nrole\\n", "x"), (2, None, None, None), (2, 1, "a|<|b", "y"), (None, 0, "user", "null id"),
             (3, 1, "assistant", "z"), (3, 0, "user", "w"), (3, 1, "assistant", "z"), (4, 0, "system", "s"),
             (4, 1, "user", "u"), (4, 2, "assistant", "v")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = format_chats(df.withColumn("segments", F.lit("clash")))
    got = {r.conv_id: r for r in out.select("conv_id", "formatted", "valid", "first_bad_turn", "segments",
                                             read_turns(F.col("formatted")).alias("turns"),
                                             learned_text(F.col("segments")).alias("learned")).collect()}
    for conv, own in itertools.groupby(sorted(rows, key=lambda r: (r[0] or -1, r[1] is not None, r[1] or 0, r[2] or "",
                                                                   r[3] or "")), key=lambda r: r[0]):
        own = [(r[2] or "", r[3] or "") for r in own]
        assert [tuple(t) for t in got[conv].turns] == own
        assert got[conv].learned == "".join(t for r, t in own if r == "assistant")
        body = "".join(s.text for s in got[conv].segments)
        assert body == got[conv].formatted
    for mark in ("[INST]", "</s>", "<<SYS>>"):
        assert mark not in got[1].formatted
    assert got[1].formatted.count("<|im_start|>") == len(ODD_TEXTS)
    assert (got[1].valid, got[1].first_bad_turn) == (True, None) and got[4].valid
    assert (got[3].valid, got[3].first_bad_turn) == (False, 2) and (got[2].valid, got[2].first_bad_turn) == (False, 0)
    assert format_chats(df.limit(0)).collect() == []


def test_templates_are_declared(spark):
    template = ChatTemplate(open="<|>", close="<|end|>", learned=("user",), order={("start", "user"): "user"},
                            accepting=("user",))
    df = spark.createDataFrame([(1, 0, "user", "a<|b")], "conv_id long, turn long, role string, text string")
    r = format_chats(df, template).select("formatted", "valid", read_turns(F.col("formatted"), template)).first()
    assert (r[0], r[1], tuple(r[2][0])) == ("<|>user\na<\\|b<|end|>", True, ("user", "a<|b"))


# --- fingerprints --------------------------------------------------------------------------

def check_next(rows, docs):
    """Rows of next_likeness against the definition, for (id, text) in order."""
    got = {r.doc_id: r for r in rows}
    assert len(rows) == len(docs)
    for (i, t), (_, behind) in zip(docs, docs[1:] + docs[:1]):
        t, behind = t or "", behind or ""
        n = len(t)
        edited = t[: n - n // 4] + behind[: n // 4]
        own, other, nxt = (signature_sets([x.encode()])[0] for x in (t, edited, behind))
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (n, hashlib.sha256(edited.encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == (fingerprint(own), fingerprint(other))
        assert (r.near_edited, r.near_next) == (likeness(own, other), likeness(own, nxt))


def test_next_documents_across_ranges(spark, sf_dir, no_docs):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    check_next(QUERIES["op4_fingerprints"](spark, sf_dir).collect(), sorted(map(tuple, docs.collect())))
    lone = spark.createDataFrame([(4, "abcdefgh")], "doc_id long, text string")
    check_next(next_likeness(lone).collect(), [(4, "abcdefgh")])
    odd = [(None, "first of all"), (1, None), (2, ""), (5, prose(5000, 3)), (9, "é😀 the ende")]
    check_next(next_likeness(spark.createDataFrame(odd, "doc_id long, text string").repartition(3)).collect(), odd)
    assert next_likeness(no_docs).collect() == []
    twice = spark.createDataFrame([(1, "the a b c"), (1, "the a b c"), (2, "x")], "doc_id long, text string")
    assert next_likeness(twice).count() == 3


def test_near_pairs_are_exact(spark, odd_docs):
    texts = drifting_copies(60, 60, 9) + ["", "...", "the"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {(r.a, r.b): r.likeness for r in near_pairs(fingerprints(df), 0.7).collect()}
    first = {}
    for i, t in enumerate(texts):
        first.setdefault(signature_sets([t.encode()])[0].tobytes(), i)
    sets = {i: np.frombuffer(s, np.uint32) for s, i in first.items() if s}
    want = {(a, b): likeness(sets[a], sets[b]) for a, b in itertools.combinations(sets, 2)
            if likeness(sets[a], sets[b]) >= 0.7}
    assert got == pytest.approx(want) and want
    assert fingerprints(odd_docs).count() == odd_docs.count()


# --- whole tables ----------------------------------------------------------------------------

@pytest.mark.parametrize("name", ["op1_warc", "op7_chat"])
def test_queries_equal_their_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    want = con.sql(ORACLES[name])
    got = QUERIES[name](spark, sf_dir).select(*want.columns).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want.fetchall()))


def linked_tables(sf_dir, folder):
    """A folder of its own with links to all tables but documents (test data is read-only)."""
    folder.mkdir()
    for name in os.listdir(sf_dir):
        if not name.startswith("documents"):
            (folder / name).symlink_to(f"{sf_dir}/{name}")
    return folder


def test_pipeline_stages(spark, tmp_path, sf_dir, odd_docs):
    """The whole pipeline over a table with planted documents and odd rows."""
    folder = linked_tables(sf_dir, tmp_path / "sf")
    base = spark.read.parquet(f"{sf_dir}/documents.parquet")
    clean = base.filter("doc_id = 1").first().text
    item = spark.read.parquet(f"{sf_dir}/benchmark.parquet").first().text
    body = clean.replace("\n", " ")
    words = body.split(" ")
    words[20] = "changed"
    planted = [(9001, body, "en", "src0", 1), (9002, " ".join(words), "en", "src0", 1),
               (9003, f"{body[:100]} {item.replace(chr(10), ' ')} {body[100:200]}", "en", "src0", 1)]
    docs = base.unionByName(spark.createDataFrame(planted, base.schema))
    docs = docs.unionByName(odd_docs.select("doc_id", "text", "lang", "source", "n_chars").withColumn(
        "doc_id", F.col("doc_id") + 8000))
    docs.write.parquet(str(folder / "documents.parquet"))
    kept, before = {}, docs
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path / name)
        stage(spark, before, str(folder)).write.parquet(path)
        before = spark.read.parquet(path)
        kept[name] = {r.doc_id: r.text for r in before.select("doc_id", "text").collect()}
        if name != "mixing":
            assert before.columns == base.columns
    assert {9001, 9002, 9003} <= kept["quality"].keys()
    assert kept["quality"].keys() >= kept["line_dedup"].keys() >= kept["ngram_join"].keys() >= kept["decontamination"].keys()
    assert 1 in kept["ngram_join"] and not {9001, 9002} & kept["ngram_join"].keys()
    assert 9003 in kept["ngram_join"] and 9003 not in kept["decontamination"]
    assert len(kept["decontamination"]) > 0.7 * base.count() and 0 < len(kept["mixing"]) < len(kept["decontamination"])
    assert {"topic", "keep_probability"} < set(before.columns)


def test_pipeline_runs_over_an_empty_table(spark, tmp_path, sf_dir):
    folder = linked_tables(sf_dir, tmp_path / "sf")
    base = spark.read.parquet(f"{sf_dir}/documents.parquet")
    base.limit(0).write.parquet(str(folder / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(folder)).collect() == []


def test_texts_with_equal_ids_are_documents_of_their_own(spark, sf_dir):
    a, b, c = prose(60, 21), prose(60, 22), prose(60, 23)
    rows = [(5, a), (5, b), (3, a + " end"), (None, c), (None, b), (None, c), (7, None), (7, None), (8, ""), (None, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.ngram_join(spark, docs, sf_dir)
    assert kept.columns == docs.columns
    assert sorted(map(str, ((r.doc_id, r.text) for r in kept.collect()))) == sorted(map(str, [
        (3, a + " end"), (None, c), (None, b), (7, None), (8, ""), (None, None)]))
