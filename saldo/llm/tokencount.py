"""Token counts with a digest cache.

Counts are kept in a table keyed by the digest of the normalised text and the digest of the
tokenizer. A run looks its texts up there, encodes each distinct text that is missing once, appends
the new counts and joins the table to the documents.
"""

from __future__ import annotations

import hashlib
import os
from importlib.metadata import version

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saldo.llm.bpe import Splitter
from saldo.llm.common import held, map_columns

#: Pieces of text remembered per Python worker before the memory is emptied.
REMEMBERED = 400_000
SCHEMA = "tokenizer_digest string, content_digest binary, n_tokens bigint"


class LibraryCounts(dict):
    """Token numbers as the tokenizer's own library gives them.

    A plain byte-level tokenizer works on each piece of a text by itself, so the library is asked
    once per piece; as a dict this maps pieces to numbers. All other tokenizers get whole texts.
    """

    def __init__(self, path: str):
        super().__init__()
        self.added: list[str] = []
        self.splitter = None
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self.whole = lambda text: len(model.encode(text, num_threads=1))
            return
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import json

        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        self.whole = lambda text: len(tokenizer.encode(text, add_special_tokens=False).ids)
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        cut = data["pre_tokenizer"] or {}
        plain = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
        if data["normalizer"] is None and all(cut.get(k) == v for k, v in plain.items()):
            self.added = [t["content"] for t in data["added_tokens"]]
            self.splitter = Splitter()

    def __missing__(self, piece: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        made = self[piece] = self.whole(piece)
        return made

    def count(self, text: str) -> int:
        if self.splitter is None or any(a in text for a in self.added):
            return self.whole(text)
        return sum(map(self.__getitem__, self.splitter.pieces(text)))


def _loaded(path: str) -> LibraryCounts:
    return held(f"counts {path}", lambda: LibraryCounts(path))


def encode_counts(texts: DataFrame, path: str, text: str = "text") -> DataFrame:
    """texts with n_tokens, counted without any cache."""

    def make(column: pa.Array) -> dict[str, pa.Array]:
        counter = _loaded(path)
        counts = [counter.count(t) if t else 0 for t in column.to_pylist()]
        return {"n_tokens": pa.array(counts, pa.int64())}

    return map_columns(texts, [text], make, "n_tokens bigint")


def tokenizer_digest(path: str) -> str:
    """Of the vocabulary file and the version of the library that reads it."""
    library = "sentencepiece" if path.endswith(".model") else "tokenizers"
    with open(path, "rb") as file:
        return hashlib.sha256(file.read() + f"{library} {version(library)}".encode()).hexdigest()


def cached(spark: SparkSession, cache: str, digest: str) -> DataFrame:
    """Stored counts of one tokenizer; none if the cache folder does not exist yet."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(cache)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return spark.createDataFrame([], SCHEMA).drop("tokenizer_digest")
    stored = spark.read.schema(SCHEMA).parquet(cache)
    # Two runs that met the same new text at the same time may both have stored it.
    return (
        stored.where(F.col("tokenizer_digest") == digest)
        .groupBy("content_digest").agg(F.max("n_tokens").alias("n_tokens"))
    )


def token_counts(docs: DataFrame, path: str, cache: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, n_bytes, n_tokens; new counts are appended to the cache.

    The tokenizers served here have no normal form of their own that keeps counts, so normalising
    means null -> empty; an empty text has 0 tokens. Repeated rows and equal texts are encoded once
    and appear once per row of docs; a null id is kept. Other columns of docs are not read.
    """
    spark, digest = docs.sparkSession, tokenizer_digest(path)
    content = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"), content.alias("text"),
        F.octet_length(content).cast("long").alias("n_bytes"),
        F.unhex(F.sha2(content, 256)).alias("content_digest"),
        F.xxhash64(F.col(f"`{doc_id}`")).alias("teller"),
    )
    # One teller per distinct missing text sends the text; equal rows of it count as one below.
    missing = (
        rows.groupBy("content_digest").agg(F.min("teller").alias("teller"))
        .join(cached(spark, cache, digest), "content_digest", "left_anti")
    )
    texts = rows.select("content_digest", "teller", "text").join(
        missing.hint("shuffle_hash"), ["content_digest", "teller"], "left_semi"
    )
    (
        encode_counts(texts, path).groupBy("content_digest").agg(F.max("n_tokens").alias("n_tokens"))
        .select(F.lit(digest).alias("tokenizer_digest"), "content_digest", "n_tokens")
        .write.mode("append").parquet(cache)
    )
    counts = spark.read.schema(SCHEMA).parquet(cache).where(F.col("tokenizer_digest") == digest)
    if _written_twice(counts):
        counts = cached(spark, cache, digest)
    return (
        rows.select("doc_id", "n_bytes", "content_digest")
        .join(counts.drop("tokenizer_digest"), "content_digest")
        .select("doc_id", "n_bytes", "n_tokens")
    )


def _written_twice(counts: DataFrame) -> bool:
    return not counts.groupBy("content_digest").count().where("count > 1").isEmpty()
