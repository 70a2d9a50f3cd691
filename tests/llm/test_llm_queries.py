"""The registered queries and the pipeline."""

import hashlib
import os
import sys

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), "..", "..", "tools"))

import __spark_entry__ as contract
import corpus_pipeline
from compare import database, difference
from saldo.llm.catalog import BYTE_BPE, ORACLE, QUERIES
from saldo.llm.quality import NAMES, Compression, learn, word_counts


def test_all_are_registered():
    numbers = sorted(int(n[2:].split("_")[0]) for n in QUERIES if n != "pipeline")
    assert numbers == list(range(1, 14)) and set(QUERIES) <= set(contract.queries())
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality rules", "n-gram Jaccard join", "PII", "mixing sources to target weights", "BPE encoding and decoding"
    ]


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_as_duckdb(spark, tables, name):
    assert difference(spark, database(tables), name, tables) is None


def test_codec_query_equals_library(spark, tables):
    library = Tokenizer.from_file(BYTE_BPE)
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{tables}/documents.parquet").collect()}
    found = QUERIES["op10_backtracking_bpe"](spark, tables).collect()
    counts = {r.doc_id: (r.n_tokens, r.over_limit) for r in QUERIES["op3_digest_cache"](spark, tables).collect()}
    assert len(found) == len(texts) == len(counts)
    for r in found:
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        spelled = library.decode(ids, skip_special_tokens=False)
        assert r.n_tokens == len(ids) and counts[r.doc_id] == (len(ids), len(ids) > 1024)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(spelled.encode()).hexdigest()


def test_stages_take_effect(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    columns, kept = docs.columns, docs
    results = []
    for name, stage in corpus_pipeline.STAGES:
        kept = corpus_pipeline.stored(stage(spark, kept, tables), "test")
        results.append(kept.collect())
        if name != "BPE encoding and decoding":
            assert kept.columns == columns
    judged, single, masked, mixed, coded = results
    compression = Compression(learn(docs))

    def good(text):
        counts = word_counts(text)
        return counts[0] >= 50 and 100 * counts[4] <= 50 * counts[0] and compression.judge(text)[2]

    assert sorted(r.doc_id for r in judged) == sorted(r.doc_id for r in docs.collect() if good(r.text))
    from test_llm_corpus import brute_classes

    rows = [(r.doc_id, r.text) for r in judged]
    assert sorted(r.doc_id for r in single) == sorted({c for c, _ in brute_classes(rows)})
    assert sorted(r.doc_id for r in masked) == sorted(r.doc_id for r in single)
    assert any(a != b for a, b in zip(sorted(r.text for r in masked), sorted(r.text for r in single)))
    words = sum(len(r.text.split()) for r in masked)
    assert abs(sum(len(r.text.split()) for r in mixed) - 1.5 * words) <= 20
    assert len(coded) == len(mixed) and all(r.round_trip and r.token_ids for r in coded)
    assert all(r.n_chars == len(r.text) for r in coded)


def test_stages_keep_columns_of_any_name(spark, tables):
    """Columns named like results of an operator go through as they are; nulls and empty tables too."""
    docs = spark.read.parquet(f"{tables}/documents.parquet").limit(60)
    more = {n: F.lit(f"own {n}") for n in [*NAMES, "n_replaced", "Stay_Id"]}
    frame = docs.drop("n_chars").withColumns(more).unionByName(
        spark.createDataFrame([(None, None, None, None)], "doc_id long, text string, lang string, source string")
        .withColumns(more)
    )
    for rows in (frame, frame.limit(0)):
        kept = rows
        for name, stage in corpus_pipeline.STAGES[:-1]:
            kept = corpus_pipeline.stored(stage(spark, kept, tables), "clash")
            assert kept.columns == frame.columns, name
        found = kept.collect()
        assert bool(found) == (rows is frame)
        assert all(r[n] == f"own {n}" for r in found for n in more)
    coded = corpus_pipeline.STAGES[-1][1](spark, kept, tables)
    assert coded.count() == 0 and set(frame.columns) <= set(coded.columns)
