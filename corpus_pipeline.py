"""From raw documents to packed training sequences: five stages over all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from modelvigil.llm import language, mixing, packing, secrets, simhash
from modelvigil.llm.common import table
from modelvigil.llm.tokens import default_path
from modelvigil.session import scratch_path


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a determined language stay; those without a letter or with an unsure language go.

    Null and empty texts go. Repeated rows are judged alike, null ids and labels change nothing; where no language
    could be learnt, all texts with a letter stay. No rows give no rows. Columns keep names, types and values.
    """
    return language.identified(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents with linked fingerprints, the one with the smallest id stays.

    Null and empty texts are documents like any other (fingerprint zero). Of repeated rows one stays; rows without an
    id all stay; rows that share an id but no link all stay. Columns keep names, types and values.
    """
    return simhash.keep_first(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced in the text; every document stays.

    Null and empty texts, repeated rows and null ids come as they are; ``n_chars`` follows a changed text. Other
    columns keep names, types and values.
    """
    return secrets.mask_secrets(docs, default_path("byte_bpe_50k.tiktoken"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of small sources are repeated up to the repetition limit; every document appears, in mixed order.

    A null source is a source of its own, a null text counts as one word, a null id is replaced by the text in draws;
    repeated rows are rows of their own. No rows give no rows. Columns keep names, types and values.
    """
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences; a document that the mix repeats is packed as often.

    Null and empty texts are a piece of one token, the end; a null id stays null. No rows give no pieces. Only the
    columns of the pieces come out, whatever others there are.
    """
    return packing.packed(docs)


STAGES = [
    ("language", identify_language),
    ("simhash", drop_near_duplicates),
    ("secrets", mask_secrets),
    ("mixing", mix_sources),
    ("packing", pack),
]

#: Trained models, XXH64 and a tokenizer are beyond SQL; tests compare each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents. Each stage but the last is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        target = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(target)
        docs = spark.read.parquet(target)
    return STAGES[-1][1](spark, docs, sf_dir)
