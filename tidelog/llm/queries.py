"""One query per operator of this subpackage, over the operator's whole table.

The column contracts are the driver's; each query derives them from what its
operator returns.  ``TOKENIZER`` names a file of the public tokenizers, looked
up where that package is installed.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidelog.llm.chat import format_chats, learned_text, read_turns
from tidelog.llm.common import stored, table
from tidelog.llm.decontam import ORACLE as OVERLAPS_SQL
from tidelog.llm.decontam import overlaps
from tidelog.llm.embed_join import ORACLE as EMBEDDINGS_SQL
from tidelog.llm.embed_join import embedding_links
from tidelog.llm.fim import ORACLE as FIM_SQL
from tidelog.llm.fim import fill_in_middle, with_restored
from tidelog.llm.line_dedup import ORACLE as LINES_SQL
from tidelog.llm.line_dedup import dedup_lines
from tidelog.llm.mixing import mix
from tidelog.llm.ngram_join import ngram_components
from tidelog.llm.periodic import ORACLE as RUNS_SQL
from tidelog.llm.periodic import longest_run, looped, periodic_runs, run_lines
from tidelog.llm.pii import BASE_KINDS, KINDS, pii_spans, span_text
from tidelog.llm.quality import quality_scores
from tidelog.llm.spotsigs import next_likeness
from tidelog.llm.tokens import token_prefixes
from tidelog.llm.warc import check_counts, read_warc, write_warc
from tidelog.session import scratch_path

TOKENIZER = "word_bpe_49k.json"
TOKEN_LIMIT = 2048
QUALITY_CUT = 0.3
# a conversation that says what other formats take for control strings
CONTROL_TEXT = "</s>[INST] ok [/INST]"


def op1_warc(spark, sf_dir):
    """Every page as a WARC record, read back from the archives."""
    manifest = write_warc(table(spark, sf_dir, "pages"), scratch_path(spark, "warc"), "page_id", "url", "html")
    records = stored(read_warc(spark, manifest), "warc-records")
    check_counts(records, manifest)
    return records.select(F.col("record_id").cast("long").alias("page_id"), "payload_bytes", "payload_digest",
                          "record_type", F.col("refers_to").cast("long").alias("refers_to"))


def op2_pii(spark, sf_dir):
    """Personal data in every whole text: counts and digest of the base kinds, all spans."""
    found = pii_spans(table(spark, sf_dir, "documents"))
    kinds = F.transform("spans", lambda s: s["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in BASE_KINDS]
    return found.select("doc_id", *counts,
                        F.sha2(span_text("spans", BASE_KINDS), 256).alias("base_sha256"),
                        span_text("spans", KINDS).alias("spans"),
                        F.transform("spans", lambda s: s["score"]).alias("scores"))


def op3_line_dedup(spark, sf_dir):
    """Every document without the lines that repeat earlier ones, one edit tolerated."""
    return dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op4_fingerprints(spark, sf_dir):
    """Fingerprints of every whole text and of its edited text, and their likeness."""
    return next_likeness(table(spark, sf_dir, "documents"))


def op5_token_counts(spark, sf_dir):
    """Tokens of every whole text, and the longest prefix within the limit."""
    import public_tokenizers

    out = token_prefixes(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), TOKEN_LIMIT)
    return out.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op6_ngram_join(spark, sf_dir):
    """Components of documents whose sets of four-word shingles have a Jaccard similarity of 0.85 or more."""
    return ngram_components(table(spark, sf_dir, "documents"), size=4, threshold=(85, 100))


def op7_chat(spark, sf_dir):
    """Every conversation formatted, and what can be read back from the output."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                  F.lit(CONTROL_TEXT).alias("text"))
    out = format_chats(rows.unionByName(extra))
    out = out.select("conv_id", "formatted", read_turns(F.col("formatted")).alias("turns"),
                     learned_text(F.col("segments")).alias("learned"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
                      F.length("learned").cast("long").alias("loss_chars"), F.sha2("learned", 256).alias("loss_sha256"),
                      F.length("formatted").cast("long").alias("formatted_chars"))


def op8_quality(spark, sf_dir):
    """Quality scores of every whole text, learned from the labels outside the held-out fold."""
    scores = quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scores.withColumn("predicted", (F.col("score") >= QUALITY_CUT).cast("int"))


def op9_mixing(spark, sf_dir):
    """Keep probabilities of all documents, raked to source, language and topic shares."""
    out = mix(table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"))
    return out.select("doc_id", F.coalesce("source", F.lit("")).alias("source"),
                      F.coalesce("lang", F.lit("")).alias("lang"), "topic", "n_words",
                      F.round("keep_probability", 6).alias("keep_probability"), "kept")


def op10_decontamination(spark, sf_dir):
    """Documents that overlap with benchmark items, word substitutions tolerated."""
    return overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_periodic_runs(spark, sf_dir):
    """Periodic runs of words in all texts, a tenth of which repeat a stretch to their end."""
    found = periodic_runs(looped(table(spark, sf_dir, "documents")))
    out = found.withColumn("top", F.when(F.size("runs") > 0, longest_run("runs")))
    return out.select("doc_id", F.size("runs").cast("long").alias("n_runs"), "top.start", "top.length", "top.period",
                      F.floor(1000 * F.col("top.length") / F.col("top.period")).alias("exponent_milli"),
                      F.sha2(run_lines("runs"), 256).alias("runs_sha256"),
                      F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op12_fill_in_middle(spark, sf_dir):
    """Every whole text arranged for filling in its middle, and restored from that."""
    out = with_restored(fill_in_middle(table(spark, sf_dir, "documents")))
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                      F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"))


def op13_embedding_join(spark, sf_dir):
    """Links and components of all vectors with a cosine of 0.9 or more."""
    return embedding_links(table(spark, sf_dir, "embeddings"), threshold=0.9)


def pipeline(spark, sf_dir):
    """All stages of the corpus pipeline over ``documents``."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_warc": op1_warc,
    "op2_pii": op2_pii,
    "op3_line_dedup": op3_line_dedup,
    "op4_fingerprints": op4_fingerprints,
    "op5_token_counts": op5_token_counts,
    "op6_ngram_join": op6_ngram_join,
    "op7_chat": op7_chat,
    "op8_quality": op8_quality,
    "op9_mixing": op9_mixing,
    "op10_decontamination": op10_decontamination,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_embedding_join": op13_embedding_join,
    "pipeline": pipeline,
}
# base32 of the 40 hexadecimal digits: five of them are four letters
ORACLES: dict[str, str] = {
    "op1_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
        d AS (SELECT page_id, strlen(h) AS payload_bytes, sha1(h) AS x FROM p),
        f AS (SELECT x, min(page_id) AS first_id FROM d GROUP BY x)
        SELECT page_id, payload_bytes,
            array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                ((('0x' || substr(d.x, (i // 4) * 5 + 1, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::INT + 1, 1)), '')
                AS payload_digest,
            CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
            CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to
        FROM d JOIN f USING (x)
    """,
    "op3_line_dedup": LINES_SQL,
    "op10_decontamination": OVERLAPS_SQL,
    "op11_periodic_runs": RUNS_SQL,
    "op12_fill_in_middle": FIM_SQL,
    "op13_embedding_join": EMBEDDINGS_SQL,
    "op7_chat": r"""
        WITH c AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
            UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
        e AS (SELECT *,
                regexp_replace(text, '([<\[])(\\*)(\||/?s>|/?INST\]|</?SYS>>)', '\1\\\2\3', 'g') AS body,
                regexp_replace(replace(replace(role, '\', '\b'), chr(10), '\n'),
                    '([<\[])(\\*)(\||/?s>|/?INST\]|</?SYS>>)', '\1\\\2\3', 'g') AS mark
              FROM c)
        SELECT conv_id, count(*) AS n_turns,
            sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text))
                AS turns_sha256,
            coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
            sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text)
                FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
            sum(length('<|im_start|>') + length(mark) + 1 + length(body) + length('<|im_end|>') + 1)::BIGINT
                AS formatted_chars
        FROM e GROUP BY conv_id
    """,
}
