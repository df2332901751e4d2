"""The corpus pipeline: documents are filtered, deduplicated and packed into training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read again as
the next stage's docs. All stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quillwork.llm import langid, ngram_join, packing, toxicity
from quillwork.llm.common import Scratch, table
from quillwork.llm.queries import tokenizer_path

#: Trained models, tokenizers and the packing search have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Toxicity: documents that it rejects go. Null and empty texts stay, as do repeated rows and null ids; without labels of both kinds only the seed words judge."""
    return toxicity.keep_clean(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_unidentified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: documents in no known language go, and those whose text is null or has no letter. Without any labelled row nothing can be told and all stay."""
    return langid.keep_identified(docs, langid.fit(docs))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join: one document of each group stays, the one with the smallest id. Rows with a null id or without words stay."""
    return ngram_join.keep_one(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Best-fit packing of what is left into sequences of 4,096 tokens; one row a piece. A null text is empty; an empty table gives no rows."""
    return packing.pack_documents(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("language_id", drop_unidentified),
    ("ngram_join", drop_near_copies),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder before the next reads it; what no stage reads any more is removed."""
    scratch = Scratch(spark)
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        before, docs = docs, scratch.write(stage(spark, docs, sf_dir))
        if k:
            scratch.drop(before)
    return docs
