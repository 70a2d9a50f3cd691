"""A corpus made ready for training: each stage is one operator over all that the one before kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saldo.llm.bpe import round_trip
from saldo.llm.common import documents, set_aside, stored
from saldo.llm.jaccard import without_near_duplicates
from saldo.llm.mixing import mixed
from saldo.llm.pii import pseudonymise
from saldo.llm.quality import NAMES, learn, quality

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
#: Stands in for the secret key of a real run.
DEMO_KEY = "saldo demonstration key"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression bands and the base rules keep; the bands are learnt from docs."""
    bands = learn(docs)
    return set_aside(docs, NAMES, lambda rows: quality(rows, bands=bands).where("kept"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies, the one with the smallest id."""
    return without_near_duplicates(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal numbers replaced by pseudonyms."""
    masked = set_aside(docs, ["n_replaced"], lambda rows: pseudonymise(rows, DEMO_KEY))
    if "n_chars" not in masked.columns:
        return masked
    return masked.withColumn("n_chars", F.length("text").cast("long"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's budget takes them."""
    return mixed(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their token ids; decoded tells that the ids spell the text again."""
    coded = round_trip(docs, BYTE_BPE)
    same = F.col("decoded") == F.coalesce(F.col("text"), F.lit(""))
    return coded.withColumn("round_trip", same).drop("decoded")


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_copies),
    ("PII", personal_data),
    ("mixing sources to target weights", mixing),
    ("BPE encoding and decoding", encoding),
]

#: SQL has no zstandard compression, so the rows of run() are tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STAGES applied to documents, each on the stored result of the one before."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), "pipeline")
    return docs
