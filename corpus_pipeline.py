"""From raw documents to packed training sequences, in five stages.

Every stage works on all that the one before it kept, written as Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkrank.llm.common import table
from linkrank.llm.mixing import replicated
from linkrank.llm.packing import pack
from linkrank.llm.quality_classifier import good_documents
from linkrank.llm.queries import tokenizer_path
from linkrank.llm.secrets import redacted
from linkrank.llm.simhash import without_near_duplicates
from linkrank.plans import Scratch


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go.

    Rows with null or empty texts are scored like any other, long texts as a whole; repeated rows share
    their fate. An empty table stays empty.
    """
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return good_documents(docs, labels)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays, the one with the smallest id.

    Fingerprints over shingles of three words link at 3 or fewer differing bits. Documents without words, with null
    or empty texts among them, are one group; of repeated rows one stays. An empty table stays empty.
    """
    return without_near_duplicates(docs, shingle=3, bits=3)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the texts, and ``n_chars`` follows; every document stays.

    Null and empty texts are left as they are, long ones are scanned whole, repeated rows stay repeated. An
    empty table stays empty.
    """
    return redacted(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated so that sources count with the root of their size, and shuffled.

    A null source is one of its own, texts are only carried along. Rows of one id, null ones too, are repeated
    equally often. An empty table stays empty.
    """
    return replicated(docs).select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences of 1024 tokens.

    A null or empty text is the one token that ends it, a long one is cut into pieces, repeated rows are
    packed once each. An empty table has no pieces.
    """
    return pack(
        docs.select("doc_id", "source", "text"),
        tokenizer_path(),
        carry={"ids_crc32": F.crc32("ids")},
    )


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("secrets", secrets),
    ("mix", mix),
    ("packing", packing),
]

# The classifier, XXH64 fingerprints and the tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    scratch = Scratch(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = scratch.write(stage(spark, docs, sf_dir), name)
    return docs
