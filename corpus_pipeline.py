"""From raw documents to token ids: language, near copies, personal data, mix, encoding.

Each stage reads what the one before kept. A document without a known language goes; of
each group of near copies one stays; personal data is replaced in the text; documents are
taken as often as the mix wants them; texts become token ids.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from busgrid.llm import bpe, jaccard, langid, mixing, pii
from busgrid.llm.common import bound_batches, quoted, table, written


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    return langid.accepted(docs, langid.fit(docs))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    return jaccard.one_of_each(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    length = F.length("text").cast("long").alias("n_chars")
    columns = [length if c == "n_chars" else F.col(quoted(c)) for c in docs.columns]
    return pii.sanitise(docs).select(*columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    ids = bpe.encode(docs, public_tokenizers.path(bpe.VOCABULARY))
    return ids.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("language", language),
    ("near_copies", near_copies),
    ("personal_data", personal_data),
    ("mix", mix),
    ("encode", encode),
]

#: SQL expresses neither the language network nor the encoding.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; every stage's rows are written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
