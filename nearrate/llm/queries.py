"""The queries of this subpackage and the DuckDB SQL that gives the same rows."""

from __future__ import annotations

from nearrate.llm import alignment, decontam, fim, jaccard, language, licenses, lm, mixing, repeats, tokens_out, topk, toxicity, vptree
from nearrate.llm.common import table


def op1_mixing(spark, sf_dir):
    return mixing.mixed(table(spark, sf_dir, "documents"))


def op2_topk(spark, sf_dir):
    return topk.search(table(spark, sf_dir, "embeddings"))


def op3_decontamination(spark, sf_dir):
    return decontam.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("key")


def op4_substrings(spark, sf_dir):
    return repeats.deduplicate(table(spark, sf_dir, "documents"), texts=False)


def op5_language(spark, sf_dir):
    return language.identify(table(spark, sf_dir, "documents"))


def op6_toxicity(spark, sf_dir):
    return toxicity.detect(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op7_token_output(spark, sf_dir):
    return tokens_out.round_trip(table(spark, sf_dir, "documents"), tokenizer_path())


def op8_jaccard(spark, sf_dir):
    return jaccard.join(table(spark, sf_dir, "documents")).drop("key")


def op9_licenses(spark, sf_dir):
    return licenses.scan(table(spark, sf_dir, "documents"))


def op10_lm_scoring(spark, sf_dir):
    return lm.score(table(spark, sf_dir, "documents"), tokenizer_path())


def op11_nearest(spark, sf_dir):
    return vptree.search(table(spark, sf_dir, "embeddings"))


def op12_alignment(spark, sf_dir):
    return alignment.report(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))


def op13_fill_in_middle(spark, sf_dir):
    return fim.report(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_mixing, op2_topk, op3_decontamination, op4_substrings, op5_language, op6_toxicity, op7_token_output, op8_jaccard, op9_licenses, op10_lm_scoring, op11_nearest, op12_alignment, op13_fill_in_middle)}
ORACLES = {
    "op2_topk": """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_inner_product(q.v, c.v)::BIGINT AS score FROM v q, v c WHERE q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, rank::INT AS rank, vec_id, score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5""",
    "op3_decontamination": decontam.SQL,
    "op4_substrings": repeats.SQL,
    "op8_jaccard": jaccard.SQL,
    "op13_fill_in_middle": fim.SQL,
}
