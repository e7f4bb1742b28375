"""One query per operator, each over its whole table with production parameters."""

from pyspark.sql import functions as F

from . import (
    decontaminate, line_dedup, lm_score, mixing, ngram_join, pii, quality, ranked_search, suffix_dedup, token_align, token_counts, url_filter,
    warc,
)

URL_RULES = """
SELECT * FROM VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'),
  ('org', '/fr/', 'allow') AS rules(host, path, action)"""

#: For the checks only: what is drawn with it can be drawn again by anyone who has it.
SURROGATE_KEY = b"key of the checks"
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
TOKENIZER_A, TOKENIZER_B = "/opt/tokenizers/byte_bpe_50k.json", "/opt/tokenizers/piece_bpe_32k.model"


def _table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_url_filters(spark, sf_dir):
    return url_filter.judge(_table(spark, sf_dir, "pages"), spark.sql(URL_RULES))


def op2_line_dedup(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    rows = line_dedup.without_frequent(docs, line_dedup.built(docs))
    return rows.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op3_ngram_join(spark, sf_dir):
    rows = ngram_join.memberships(ngram_join.joined(_table(spark, sf_dir, "documents")))
    return rows.select(F.col("id").alias("doc_id"), "class_id", "n_links")


def op4_warc(spark, sf_dir):
    archives = warc.write(_table(spark, sf_dir, "pages"))
    records = warc.read(archives, warc.index_of(spark, archives), with_payload=False)
    return warc.resolved(records).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "intact")


def op5_decontamination(spark, sf_dir):
    found = decontaminate.scanned(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    found = decontaminate.hits(found)
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op6_pii(spark, sf_dir):
    rows = pii.replaced(_table(spark, sf_dir, "documents"), SURROGATE_KEY)
    return rows.select("doc_id", F.size("entities").cast("long").alias("n_entities"), "text", "entities")


def op7_mixing(spark, sf_dir):
    rows = mixing.mixed(_table(spark, sf_dir, "documents"))
    return rows.select(F.col("row.doc_id").alias("doc_id"), "source", "size", "source_size", "target", "taken")


def op8_quality_rules(spark, sf_dir):
    entries = quality.ledger(_table(spark, sf_dir, "documents"))
    return entries.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "failed",
        (~quality.passes(quality.BASE)).alias("base_failed"), quality.passes(quality.CURRENT).alias("kept"))


def op9_token_counts(spark, sf_dir):
    length = token_counts.length_of(spark, VOCABULARY)
    return token_counts.answers(token_counts.histogram(_table(spark, sf_dir, "documents"), length))


def op10_suffix_dedup(spark, sf_dir):
    rows = suffix_dedup.without_repeats(_table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op11_ranked_search(spark, sf_dir):
    return ranked_search.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_token_align(spark, sf_dir):
    a, b = token_align.byte_level_coder(TOKENIZER_A), token_align.piece_coder(TOKENIZER_B)
    return token_align.compared(_table(spark, sf_dir, "documents"), a, b)


def op13_lm_score(spark, sf_dir):
    return lm_score.scored(_table(spark, sf_dir, "documents")).withColumnRenamed("own_id", "doc_id")


QUERIES = {
    query.__name__: query
    for query in (
        op1_url_filters, op2_line_dedup, op3_ngram_join, op4_warc, op5_decontamination, op6_pii, op7_mixing, op8_quality_rules,
        op9_token_counts, op10_suffix_dedup, op11_ranked_search, op12_token_align,
        op13_lm_score,
    )
}
