"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenspan.llm import conversations, exact_dedup, langid, licenses, lm, minhash, mixing, piece_codec, quality_fm, quality_rules, suffix_dedup, toxicity, vector_codes
from lumenspan.llm._common import fold, table


#: Score from which a document counts as good.
KEEP_AT = 0.3
#: Share of good texts that the lenient rules may reject.
LENIENT = 0.25


def tokenizer(name: str) -> bytes:
    """A public tokenizer's file, read on the driver and sent to the tasks."""
    import public_tokenizers

    return piece_codec.model_bytes(public_tokenizers.path(name))


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_classes(table(spark, sf_dir, "documents"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = fold("doc_id", 4) == 2
    return langid.predict(docs, langid.learn(docs.filter(~held_out)), held_out)


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_codec.digests(table(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"))


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"), fold("doc_id", 7) == 2)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = fold("doc_id", 5) == 0
    voters = toxicity.learn(docs.filter(~held_out), table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, voters, [docs["doc_id"], held_out.alias("held_out")])
    return scored.select("row.*", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "evidence")


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_classes(table(spark, sf_dir, "documents"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(table(spark, sf_dir, "documents"))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = fold("doc_id", 5) == 0
    machine = quality_fm.learn(docs.filter(~held_out), table(spark, sf_dir, "labels"))
    scored = quality_fm.score(docs, machine, [docs["doc_id"], held_out.alias("held_out")])
    return scored.select("row.*", "score", (F.col("score") >= KEEP_AT).cast("int").alias("predicted"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.apply_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair(conversations.damaged(table(spark, sf_dir, "conversations")))


def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.removed(table(spark, sf_dir, "documents"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.codes(table(spark, sf_dir, "embeddings"))


def quality_rules_lenient(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op10 at a risk that small tables have labels enough for."""
    return quality_rules.apply_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), alpha=LENIENT)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_minhash,
        op2_language_id,
        op3_sentencepiece,
        op4_lm_scoring,
        op5_toxicity,
        op6_exact_dedup,
        op7_license_scan,
        op8_source_mixing,
        op9_quality_classifier,
        op10_quality_rules,
        op11_conversation_repair,
        op12_suffix_dedup,
        op13_vector_codes,
        quality_rules_lenient,
    )
}

ORACLES: dict[str, str] = {
    "op6_exact_dedup": exact_dedup.CLASSES_SQL,
    "op7_license_scan": licenses.scan_sql(),
    "op8_source_mixing": mixing.REPORT_SQL,
    "op10_quality_rules": quality_rules.RULES_SQL,
    "quality_rules_lenient": quality_rules.rules_sql(alpha=LENIENT),
}
