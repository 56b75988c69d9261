"""The corpus pipeline: raw documents to mixed, tokenised training files.

Each stage takes (spark, docs, sf_dir) and works on all documents that the stage
before it kept; its result is written as Parquet and read again by the next. All
stages but the last return the columns of documents, extra ones included, whatever
their names. Empty tables give empty results.
"""

from __future__ import annotations

from nearrate.llm import decontam, jaccard, language, mixing, tokens_out
from nearrate.llm.common import fresh_path, table
from nearrate.llm.queries import tokenizer_path


def identify_language(spark, docs, sf_dir):
    """Documents in an identified language; those without letters, null and empty
    texts among them, go. Equal texts get equal decisions."""
    return language.keep_identified(docs)


def drop_near_copies(spark, docs, sf_dir):
    """One document of each group of near copies: those that share at least 80%
    of their shingles of five words (op8_jaccard has values of its own): the one
    with the smallest id, a null id last. Equal rows are copies like any other;
    documents without words all stay."""
    return jaccard.keep_one(docs, k=5, percent=80)


def drop_contaminated(spark, docs, sf_dir):
    """Documents without a passage of a benchmark item. Null and empty texts and
    items have no words; equal rows stay or go together."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark, docs, sf_dir):
    """The mix of sources: whole copies and cut copies of documents. A null source
    is one of its own, documents without words are not taken, and equal rows are
    all taken like the first of them."""
    return mixing.mix_texts(docs)


def write_tokens(spark, docs, sf_dir):
    """Token files of the mix, and what a reader finds in them: in the order of
    doc_id, nulls first; a null text is written as an empty one."""
    return tokens_out.round_trip(docs, tokenizer_path())


STAGES = [
    ("language", identify_language),
    ("near_copies", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("token_files", write_tokens),
]
#: The language stage is a trained network, which SQL cannot express.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = fresh_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
