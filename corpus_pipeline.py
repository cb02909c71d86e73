"""From raw documents to token ids: five stages over whole tables.

Each stage takes (spark, docs, sf_dir) and returns a frame that is written as
Parquet and read again as the next stage's documents.  All but the last return
the columns of documents; ``n_chars`` follows the text.

1. quality rules: documents failing the base rule or the isolation forest go;
2. line dedup: of a line that is not blank (``LINE_CHARS`` code points) and found
   in ``LINE_DOCUMENTS`` documents or more, only the copy in the document with
   the smallest id stays; documents left without text by that go;
3. n-gram Jaccard join: one document of each group of near duplicates stays;
4. decontamination: words inside benchmark windows go, and documents consisting
   of them for more than ``MAX_COVERAGE``;
5. SentencePiece: ids of every text, as little-endian 32-bit numbers.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrapix.llm import op2_jaccard_join, op4_sentencepiece, op5_line_dedup, op6_decontaminate, op7_quality
from terrapix.llm.store import written

LINE_DOCUMENTS, LINE_CHARS, MAX_COVERAGE = 10, 1, 0.5


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op7_quality.filter_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out, (_, dropped) = op5_line_dedup.dedup_lines(docs, LINE_DOCUMENTS, LINE_CHARS, keep_first=True)
    blank = F.btrim("text", F.lit(" \t\n\x0b\x0c\r")) == ""
    return out.filter(~((F.col(dropped) > 0) & blank)).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op2_jaccard_join.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = op6_decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), max_coverage=MAX_COVERAGE)
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def sentencepiece_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    out, (ids,) = op4_sentencepiece.encode(docs.select("doc_id", "lang", "source", "text"), public_tokenizers.path("piece_bpe_32k.model"))
    return out.select("doc_id", "lang", "source", (F.octet_length(ids) / 4).cast("long").alias("n_tokens"), F.col(ids).alias("ids"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("sentencepiece_ids", sentencepiece_ids),
]
#: merging pieces and growing a forest are beyond SQL: tested stage by stage
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
