"""Registered queries of the numbered operators, each over its whole table."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from terrapix.llm import op1_token_file as op1
from terrapix.llm import op2_jaccard_join, op3_toxicity, op4_sentencepiece, op5_line_dedup, op6_decontaminate, op7_quality, op8_token_counts, op9_sharding, op10_secrets, op11_whitening, op12_quality_cnn, op13_runs

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@query
def op3_toxicity_mil(spark: SparkSession, sf_dir: str) -> DataFrame:
    """3: noisy-or toxicity score of every document."""
    docs = table(spark, sf_dir, "documents")
    return op3_toxicity.score(docs, op3_toxicity.fit(docs, table(spark, sf_dir, "labels")))


@query
def op7_quality_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """7: rule statistics and the isolation forest's verdict of every document."""
    out = op7_quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", *op7_quality.BASE, "base_failed", "kept", F.round("score", 6).alias("score"))


@query
def op8_token_counts_two_tier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """8: SentencePiece token count of every document."""
    return op8_token_counts.token_counts(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


@query
def op1_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """1: ids of every document written as range-coded blocks and read back."""
    return op1.token_table(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), end_id=2)


_FOLD = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


@query
def op5_line_dedup_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """5: documents without the lines found in ten documents or more."""
    docs, (lines, dropped) = op5_line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), at_least=10, min_chars=1)
    return docs.select("doc_id", F.col(lines).alias("n_lines"), F.col(dropped).alias("n_dropped"), F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


ORACLE["op5_line_dedup_runs"] = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT rid, doc_id, i, lines[i] AS line,
             translate(trim(lines[i], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), {_FOLD}) AS key
      FROM (SELECT *, unnest(range(1, len(lines) + 1)) AS i FROM d)),
f AS (SELECT key FROM l WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT rid) >= 10),
m AS (SELECT l.*, f.key IS NOT NULL AS gone FROM l LEFT JOIN f USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY rid, doc_id
"""


@query
def op6_decontaminate_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    """6: words of every document inside 10-word windows of benchmark items."""
    out = op6_decontaminate.scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10)
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


_WORDS6 = f"regexp_extract_all(translate(coalesce(text, ''), {_FOLD}), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
ORACLE["op6_decontaminate_automaton"] = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS6} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS6} AS w FROM benchmark),
iw AS (SELECT DISTINCT item, least(len(w), 10) AS k, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS win
       FROM (SELECT *, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
ks AS (SELECT DISTINCT k FROM iw),
dw AS (SELECT rid, k, i, array_to_string(w[i:i + k - 1], ' ') AS win
       FROM (SELECT rid, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, ks WHERE len(w) >= k)),
h AS (SELECT DISTINCT rid, k, i, item FROM dw JOIN iw USING (k, win)),
hits AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + k)) AS p FROM h) GROUP BY rid),
items AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT rid, item FROM h) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hits USING (rid) LEFT JOIN items USING (rid)
"""


@query
def op2_jaccard_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """2: components of documents whose 5-word shingles are 80 % alike."""
    return op2_jaccard_join.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


_SPACE = "[\\x20\\x09-\\x0D]"
ORACLE["op2_jaccard_components"] = f"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), {_FOLD}), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT rid, array_to_string(w[i:i + 4], ' ') AS g
      FROM (SELECT *, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT rid, count(*) AS n FROM s GROUP BY rid),
j AS (SELECT x.rid AS a, y.rid AS b, count(*) AS k FROM s x JOIN s y USING (g) WHERE x.rid < y.rid GROUP BY ALL),
e AS (SELECT a, b FROM j JOIN n na ON na.rid = a JOIN n nb ON nb.rid = b WHERE 100 * k >= 80 * (na.n + nb.n - k)),
u AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r AS (SELECT rid AS node, rid AS reach FROM d UNION SELECT r.node, u.b FROM r JOIN u ON r.reach = u.a)
SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(t.doc_id) AS component_id
FROM d LEFT JOIN n USING (rid) JOIN r ON r.node = d.rid JOIN d t ON t.rid = r.reach GROUP BY d.rid, d.doc_id
"""


@query
def op9_sharding_hypergeometric(spark: SparkSession, sf_dir: str) -> DataFrame:
    """9: every document's shard and slot in a uniform shuffle, `rows` law."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("long").alias("size"),
        F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).cast("long").alias("text_crc32"))
    out, shard, slot = op9_sharding.shuffle_into_shards(docs, 40)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col(shard).alias("shard"), F.col(slot).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


@query
def op4_sentencepiece_fst(spark: SparkSession, sf_dir: str) -> DataFrame:
    """4: ids by the compiled transducer, as count and crc32, and the round trip."""
    docs, (ids, decoded) = op4_sentencepiece.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_path("piece_bpe_32k.model"), with_decoded=True)
    return docs.select("doc_id", (F.octet_length(ids) / 4).cast("long").alias("n_tokens"), F.crc32(ids).alias("ids_crc32"),
                       (F.col(decoded) == F.coalesce("text", F.lit(""))).alias("round_trip"))


@query
def op10_secret_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """10: secrets found in the documents, false positives removed by a forest."""
    found = op10_secrets.scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "start", "end", F.sha2(F.col("value").cast("binary"), 256).alias("secret_sha256"), F.round("score", 6).alias("score"))


@query
def op11_whitening_chebyshev(spark: SparkSession, sf_dir: str) -> DataFrame:
    """11: whitened embeddings on the leading components of the distinct vectors."""
    return op11_whitening.whiten(table(spark, sf_dir, "embeddings"))


@query
def op12_quality_cnn_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """12: quality score of every document by the byte-level network."""
    docs = table(spark, sf_dir, "documents")
    return op12_quality_cnn.score(docs, op12_quality_cnn.fit(docs, table(spark, sf_dir, "labels")))


def plant_period(doc_id, text: bytes) -> bytes:
    """The text whose words the query reads: where crc32(doc_id) % 10 is 0, words
    from a on repeat the first p words after a."""
    if doc_id is None:
        return text
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return text
    words = text.split()
    n, g = len(words), h // 10
    if not n:
        return text
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return b" ".join(words[:a] + [words[a + k % p] for k in range(n - a)])


@query
def op13_runs_difference_cover(spark: SparkSession, sf_dir: str) -> DataFrame:
    """13: periodic runs of words of every document, and the text without repeats."""
    out = op13_runs.summary(table(spark, sf_dir, "documents"), rewrite=plant_period)
    return out.select("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def _pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five stages of corpus_pipeline over all documents."""
    return corpus_pipeline.run(spark, sf_dir)


QUERIES["pipeline"] = _pipeline
if corpus_pipeline.ORACLE_SQL:
    ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL
