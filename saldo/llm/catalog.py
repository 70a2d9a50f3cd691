"""The queries of this subpackage and their SQL for DuckDB, where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from saldo.llm import langid, lmscore
from saldo.llm.bpe import round_trip
from saldo.llm.common import documents
from saldo.llm.hardneg import hard_negatives
from saldo.llm.jaccard import near_duplicates
from saldo.llm.mihash import top_k, with_code
from saldo.llm.mixing import mix
from saldo.llm.pii import pseudonymise
from saldo.llm.quality import learn, quality
from saldo.llm.repeats import without_repeats
from saldo.llm.tokencount import token_counts
from saldo.llm.urlfilter import ALLOW, BLOCK, SOFT, STRICT, judge_urls
from saldo.llm.whitening import finite, whitened_components
from saldo.session import scratch_path

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


@query
def op1_compression_bands(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder).select("doc_id", "text")
    return quality(docs, bands=learn(docs)).drop("text")


@query
def op2_multi_index_hashing(spark: SparkSession, folder: str) -> DataFrame:
    """The 10 nearest sign codes of every hundredth vector among all vectors."""
    vectors = with_code(spark.read.parquet(f"{folder}/embeddings.parquet"), "embedding")
    base = vectors.select(F.col("vec_id").alias("id"), "code")
    return top_k(base, base.where("id % 100 = 0"), k=10)


ORACLE["op2_multi_index_hashing"] = """
WITH bits AS (
  SELECT vec_id, generate_subscripts(embedding, 1) - 1 AS i, unnest(embedding) AS x FROM embeddings
), codes AS (
  SELECT vec_id,
         CAST(sum(CASE WHEN x > 0 AND i < 32 THEN 1::BIGINT << i ELSE 0 END) AS BIGINT) AS low,
         CAST(sum(CASE WHEN x > 0 AND i >= 32 THEN 1::BIGINT << (i - 32) ELSE 0 END) AS BIGINT) AS high
  FROM bits GROUP BY vec_id
), pairs AS (
  SELECT q.vec_id AS query_id, b.vec_id AS neighbour_id,
         CAST(bit_count(xor(q.low, b.low)) + bit_count(xor(q.high, b.high)) AS BIGINT) AS distance
  FROM codes q, codes b WHERE q.vec_id % 100 = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbour_id) AS rank FROM pairs
)
SELECT query_id, rank, neighbour_id, distance FROM ranked WHERE rank <= 10
"""


@query
def op3_digest_cache(spark: SparkSession, folder: str) -> DataFrame:
    """The cache starts empty, so that every distinct text is encoded."""
    counts = token_counts(documents(spark, folder), BYTE_BPE, scratch_path(spark, "token-cache"))
    return counts.withColumn("over_limit", F.col("n_tokens") > 1024)


@query
def op4_lsh_forest(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(documents(spark, folder)).select("doc_id", "class_id", "n_links")


@query
def op5_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    plan = mix(documents(spark, folder).select("doc_id", "source", "text"))
    taken = F.aggregate("parts", F.lit(0).cast("long"), lambda total, part: total + part)
    return plan.select("doc_id", "size", "source_size", "target", taken.alias("taken"))


ORACLE["op5_source_mixing"] = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
         CAST('0x' || substr(md5('mix|' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS key
  FROM documents
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         row_number() OVER (ORDER BY source NULLS LAST) AS place
  FROM sized GROUP BY source
), weighted AS (
  SELECT *, 2 * source_size AS cap, [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][(place - 1) % 3 + 1] AS weight
  FROM sources
), levels AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER before, 0)::DOUBLE)
            / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
  FROM weighted
  WINDOW before AS (ORDER BY cap / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), targets AS (
  SELECT source, source_size, least(cap::DOUBLE, (max(level) OVER ()) * weight) AS target FROM levels
), starts AS (
  SELECT s.doc_id, s.size, t.source_size, t.target, CAST(round(t.target) AS BIGINT) AS budget,
         CAST(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.key, s.doc_id, s.size
                                ROWS UNBOUNDED PRECEDING) AS BIGINT) - s.size AS start
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(least(size, greatest(0, budget - start))
            + least(size, greatest(0, budget - source_size - start)) AS BIGINT) AS taken
FROM starts
"""


@query
def op6_prefix_free_parsing(spark: SparkSession, folder: str) -> DataFrame:
    return without_repeats(documents(spark, folder)).select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )


@query
def op7_feistel_pseudonyms(spark: SparkSession, folder: str) -> DataFrame:
    """The key is a stand-in; a real run takes its key from the keeper of secrets."""
    return pseudonymise(documents(spark, folder).select("doc_id", "text"), key=corpus_pipeline.DEMO_KEY)


@query
def op8_cross_entropy_difference(spark: SparkSession, folder: str) -> DataFrame:
    """Target: the documents labelled as good; background: all documents."""
    docs = documents(spark, folder).select("doc_id", "text")
    good = spark.read.parquet(f"{folder}/labels.parquet").where("quality = 1").select("doc_id")
    target = docs.join(good.distinct().hint("shuffle_hash"), "doc_id", "left_semi")
    return lmscore.score(docs, lmscore.losses(docs, target)).drop("text")


@query
def op9_language_mixture(spark: SparkSession, folder: str) -> DataFrame:
    """Learns from the documents that are not held out; a null id counts as the empty text."""
    remainder = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 4
    docs = documents(spark, folder).withColumn("held_out", remainder == 2)
    model = langid.fit(docs.where(~F.col("held_out")).select("lang", "text"))
    return langid.predict(docs.select("doc_id", "held_out", "text"), model).drop("text")


@query
def op10_backtracking_bpe(spark: SparkSession, folder: str) -> DataFrame:
    coded = round_trip(documents(spark, folder).select("doc_id", "text"), BYTE_BPE)
    return coded.select(
        "doc_id", F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("token_ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )


URL_RULES = [
    (ALLOW, "org/"), (BLOCK, "example.org/es/"), (BLOCK, "example.org/en/1"), (ALLOW, "com/fr/"), (BLOCK, "com/de/"),
]


@query
def op11_weighted_url_vocabulary(spark: SparkSession, folder: str) -> DataFrame:
    pages = spark.read.parquet(f"{folder}/pages.parquet").select("page_id", "url")
    return judge_urls(pages, URL_RULES).select(
        "page_id", "host", "path", "rule", "verdict", F.size("strict_terms").cast("long").alias("n_strict"),
        F.size("soft_terms").cast("long").alias("n_soft"),
    )


def _count_terms(spellings: dict[str, list[str]], distinct: bool) -> str:
    """SQL for how many terms a text has, or how often; no letter may stand beside one."""
    found = []
    for spelled in spellings.values():
        pattern = r"(^|[^\pL])(" + "|".join(spelled) + r")($|[^\pL])"
        if distinct:
            found.append(f"regexp_matches(text, '{pattern}')::BIGINT")
        else:  # the letters beside a term are doubled, so that neighbours can share them
            found.append(f"len(regexp_extract_all(doubled, '{pattern}'))")
    return " + ".join(found)


ORACLE["op11_weighted_url_vocabulary"] = rf"""
WITH parts AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path
  FROM pages
), judged AS (
  SELECT *, CASE
    WHEN ('.' || host) LIKE '%.example.org' AND starts_with(path, '/en/1') THEN 'example.org/en/1'
    WHEN ('.' || host) LIKE '%.example.org' AND starts_with(path, '/es/') THEN 'example.org/es/'
    WHEN ('.' || host) LIKE '%.com' AND starts_with(path, '/fr/') THEN 'com/fr/'
    WHEN ('.' || host) LIKE '%.com' AND starts_with(path, '/de/') THEN 'com/de/'
    WHEN ('.' || host) LIKE '%.org' AND starts_with(path, '/') THEN 'org/' END AS rule,
    lower(url_decode(host || path)) AS text
  FROM parts
), counted AS (
  SELECT *, regexp_replace(text, '([^\pL])', '\1\1', 'g') AS doubled FROM judged
), hits AS (
  SELECT *, CAST({_count_terms({s: [s] for s in STRICT}, False)} AS BIGINT) AS n_strict,
         CAST({_count_terms(SOFT, True)} AS BIGINT) AS n_soft
  FROM counted
)
SELECT page_id, host, path, rule, n_strict, n_soft,
       CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
            WHEN n_strict > 0 OR n_soft >= 2 THEN 'block' ELSE 'allow' END AS verdict
FROM hits
"""


@query
def op12_qdwh_whitening(spark: SparkSession, folder: str) -> DataFrame:
    sound = finite(spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding"), "embedding")
    whole = sound.selectExpr("vec_id", "transform(embedding, c -> floor(1024D * c) + 100000L) AS x")
    return whitened_components(whole, "x").drop("x")


@query
def op13_maximus_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    sound = finite(spark.read.parquet(f"{folder}/embeddings.parquet"), "embedding").selectExpr(
        "vec_id AS id", "if(vec_id % 7 = 0, (label + 1) % 10, label) AS label",
        "transform(embedding, x -> floor(256D * x)) AS vector",
    )
    return hard_negatives(sound, "id % 100 = 0")


ORACLE["op13_maximus_hard_negatives"] = """
WITH entries AS (
  SELECT vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS INTEGER) AS label,
         [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scores AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
         CAST(list_dot_product(CAST(a.v AS DOUBLE[]), CAST(b.v AS DOUBLE[])) AS BIGINT) AS score
  FROM entries a JOIN entries b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT * FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT p.anchor_id, p.other_id AS positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.other_id ORDER BY n.score DESC, n.other_id) AS INTEGER) AS rank,
       n.other_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN scores n ON n.anchor_id = p.anchor_id AND NOT n.same
 AND 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.other_id ORDER BY n.score DESC, n.other_id) <= 5
"""


@query
def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    return corpus_pipeline.run(spark, folder)


if corpus_pipeline.ORACLE_SQL is not None:
    ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL
