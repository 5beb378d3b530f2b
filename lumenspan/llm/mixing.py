"""Mixing sources to target weights.

Tokens are summed by source, water-filling turns weights and caps into targets, and each document is taken
floor(rate) times plus once more if its own hash-seeded coin, whose chance is the fraction, says so. No document is
shuffled for that: only the sums by source meet, and the small table of rates comes back to the documents.

Water-filling looks along all sources in order, one row each, in one task: sources may be many thousands, but not as many as
documents.

Defined results: null text has size 0; null source is a source of its own, last in order; a source without tokens
has target 0 and its documents are not taken; sources with equal ratios of cap and weight fill in the order of their names; rows with
the same id toss the same coin, so reruns agree and repeated rows are taken alike; very long texts are read whole; an empty table
gives an empty result; extra columns pass through ``mix`` untouched, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumenspan.llm._common import WORD, join_small, packed_row, whole, written

WEIGHTS = (5, 2, 1)
SHARE = 1.5
CAP = 2
SEED = "mix-1"


def n_tokens(text_col: str) -> Column:
    return F.regexp_count(whole(text_col), F.lit(WORD)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, cap: int = CAP) -> DataFrame:
    """(source, source_size, target) from rows of (source, size).

    Sources in order of code points, null last, take the weights in turn. Walking up cap/weight, a source is held at its
    cap while the level that the rest would share lies above it; the first that is not sets the level of all the others.
    That is where resharing the excess by weight comes to rest. The windows see one row per source, pre-aggregated.
    """
    sums = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (place % len(weights) + 1).cast("int"))
    limit = F.col("source_size") * cap
    by_ratio = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    before, after = by_ratio.rowsBetween(Window.unboundedPreceding, -1), by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    all_rows = Window.partitionBy()
    level = (F.sum("source_size").over(all_rows) * F.lit(share) - F.coalesce(F.sum("limit").over(before), F.lit(0))) / F.sum("weight").over(after)
    return (
        sums.withColumn("weight", weight)
        .withColumn("limit", limit)
        .withColumn("level", level)
        .withColumn("rest", F.max(F.when(F.col("level") * F.col("weight") < F.col("limit"), F.col("level"))).over(all_rows))
        .select(
            "source",
            "source_size",
            F.when(F.col("level") * F.col("weight") < F.col("limit"), F.col("rest") * F.col("weight")).otherwise(F.col("limit").cast("double")).alias("target"),
        )
    )


def coin(id_col: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) that depends on the seed and the id only."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit("null")))
    return F.conv(F.substring(F.sha2(key, 256), 1, 12), 16, 10).cast("long") / F.lit(float(1 << 48))


def with_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``row`` (the input's columns), size, source_size, target and copies of each document."""
    rows = docs.select(packed_row(docs, docs.columns), docs[source_col].alias("of"), docs[id_col].alias("id"), n_tokens(text_col).alias("size"))
    targets = written(source_targets(rows.select(F.col("of").alias("source"), "size")), "mix-targets")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    copies = F.floor("rate") + (coin(F.col("id")) < F.col("rate") - F.floor("rate")).cast("long")
    return join_small(rows, targets, rows["of"].eqNullSafe(targets["source"])).withColumn("rate", rate).withColumn("copies", copies)


def mix_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per document: id, size, source_size, target, taken."""
    narrow = docs.select(id_col, text_col, source_col)
    return with_copies(narrow, id_col, text_col, source_col).select(F.col("id").alias(id_col), "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mixture: each document as often as it is taken, with the columns of ``docs``."""
    copied = with_copies(docs, id_col, text_col, source_col).filter("copies > 0")
    return copied.select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")


def mix_sql(documents: str = "documents") -> str:
    """Targets and taken words in DuckDB's SQL."""
    return rf"""
WITH d AS (
  SELECT *, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM {documents}),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (
  SELECT *, 2 * source_size AS cap,
         [5, 2, 1][1 + (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3] AS weight
  FROM s),
l AS (
  SELECT *, ((SELECT sum(source_size) FROM s)::DOUBLE * 1.5::DOUBLE - coalesce(sum(cap) OVER (ORDER BY cap::DOUBLE / weight, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
         / (sum(weight) OVER (ORDER BY cap::DOUBLE / weight, source ASC NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level
  FROM w),
t AS (
  SELECT source, source_size,
         CASE WHEN level * weight < cap THEN (max(CASE WHEN level * weight < cap THEN level END) OVER ()) * weight ELSE cap::DOUBLE END AS target
  FROM l),
r AS (
  SELECT d.*, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0::DOUBLE END AS rate,
         ('0x' || substr(sha256('mix-1:' || coalesce(doc_id::VARCHAR, 'null')), 1, 12))::BIGINT / 281474976710656.0::DOUBLE AS coin
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
c AS (SELECT *, floor(rate)::BIGINT + (coin < rate - floor(rate))::BIGINT AS copies FROM r)
"""


REPORT_SQL = mix_sql() + "SELECT doc_id, size, source_size, target, (size * copies)::BIGINT AS taken FROM c"
