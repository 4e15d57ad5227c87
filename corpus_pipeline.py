"""Corpus pipeline: the stages that turn ``documents`` into token ids."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridcat.llm import chunk_bpe, decision_list, decontaminate, simhash, toxicity
from gridcat.llm.common import stored, table, tokenizer_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the toxicity threshold."""
    network = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.drop_toxic(docs.select(*COLUMNS), network)


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rules nor a learned rule reject."""
    rules = decision_list.learned(docs, table(spark, sf_dir, "labels"))
    return decision_list.keep_good(docs, rules).select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays, that of the least doc_id."""
    return simhash.keep_first(docs).select(*COLUMNS)


def drop_leaked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.clean(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of what was kept, with the digest of their decoding."""
    done = chunk_bpe.encode_decode(docs, tokenizer_path(), keep=("lang", "source"))
    return done.select("doc_id", "lang", "source", F.size("ids").cast("bigint").alias("n_tokens"), "ids",
                       F.sha2(F.array_join(F.col("ids"), ","), 256).alias("ids_sha256"),
                       F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("quality rules", drop_poor),
    ("simhash near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_leaked),
    ("bpe encoding and decoding", encode),
]

# models, automata and the tokenizer have no SQL form; the stages are tested against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents").select(*COLUMNS)
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(docs, name.replace(" ", "-"))
    return docs
