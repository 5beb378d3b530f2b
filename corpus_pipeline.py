"""The corpus pipeline: quality, exact dedup, near dedup, mixing and tokens, one stage after the other.

Each stage takes (spark, docs, sf_dir), works on all rows that its predecessor kept, and returns a DataFrame; ``run`` writes
each result as Parquet in the shared folder and reads it again, so that a lost executor costs a stage at most; the tables that a
stage writes for itself are deleted then. All but the last return the columns of ``documents``.

Defined results: null texts count as empty; empty texts are judged like all others and form one group of copies; of
repeated rows, and of copies in general, one stays (the first by the rules of its stage), which the mixture may then take
several times; documents that the mixture takes so are encoded each; very long texts pass whole; extra columns pass
through all stages but the last, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenspan.llm import exact_dedup, minhash, mixing, piece_codec, quality_fm
from lumenspan.llm._common import discard, scratch, table, written
from lumenspan.llm.queries import KEEP_AT, tokenizer


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorisation machine, fitted on the labelled ones, does not reject."""
    machine = quality_fm.learn(docs, table(spark, sf_dir, "labels"))
    columns = [docs[f"`{c}`"].alias(c) for c in docs.columns]
    return quality_fm.score(docs, machine, columns).filter(F.col("score") >= KEEP_AT).select("row.*")


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.exact_dedup(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    return minhash.near_dedup(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture at the target weights: documents as often as they are taken."""
    return mixing.mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang and source with the ids of every text, their number, and the digest of the text that they decode to."""
    columns = ["doc_id", "lang", "source"]
    encoded = piece_codec.encode(docs.select(*columns, "text"), tokenizer("piece_bpe_32k.model"), keep=columns, spans=False, decoded="decoded")
    return encoded.select(*columns, "ids", F.size("ids").cast("long").alias("n_tokens"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("quality", quality), ("exact", exact), ("near", near), ("mixed", mixed), ("tokens", tokens)]

#: The quality, near and token stages have no SQL form; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES[:-1]:
        with scratch(spark) as kept:
            docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
            kept.append(docs)
        discard(*before)
        before = [docs]
    return STAGES[-1][1](spark, docs, sf_dir)
