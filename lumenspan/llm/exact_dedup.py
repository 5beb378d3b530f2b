"""Exact dedup: a tree merge of sorted digest runs.

Every input partition reduces its rows to a run: one entry per text, by its keys, with the row that would stay and
the number of rows. Runs then meet in binomial rounds. In each, ``2**BITS`` neighbouring runs become one, and each run is cut by
the leading bits of its keys into ``2**BITS`` times as many parts as before: a partition receives one part of its
neighbours' runs, sorts it and merges equal entries in order. So the number of parts stays that of the runs at the start and no
part grows, until one run remains. At every level an entry is only merged with one whose digest, second hash and
length all agree, so that two texts are taken as equal on independent evidence, and the least row is kept. A text with
very many copies has one entry a run from the first level on.

Defined results: null text counts as empty; all empty texts are one group; texts of any length are read whole and only
their digests travel; of equal texts the row with the most code points stays, then the smallest id (null ids last); of repeated rows
exactly one stays; an empty table gives an empty result; extra columns pass through ``exact_dedup`` untouched, whatever their names.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenspan.llm._common import SPACE, packed_row, whole, written

#: Names of the working columns, in the order of a run; none can clash with a column of the input, which is nested under ``row``.
KEYS = ["hash2", "digest", "n_bytes"]
BITS = 4


def _fingerprints(docs: DataFrame, id_col: str, text_col: str, payload: list[str]) -> DataFrame:
    text = whole(docs[text_col])
    return (
        docs.select(packed_row(docs, payload), docs[id_col].alias("id"), F.char_length(text).alias("n_points"), F.regexp_replace(text, SPACE, "").alias("norm"))
        .select(
            "row",
            "id",
            "n_points",
            F.unhex(F.sha2("norm", 256)).alias("digest"),
            F.xxhash64("norm").alias("hash2"),
            F.octet_length("norm").alias("n_bytes"),
            F.monotonically_increasing_id().alias("uid"),
        )
    )


def merge_runs(fingerprints: DataFrame, bits: int = BITS) -> DataFrame:
    """One entry per distinct text: keys, ``best`` (the row that stays) and ``n`` (rows).

    There is a run for each partition of ``fingerprints`` and a round for each ``bits`` bits of their number.
    """
    partitions = (fingerprints.select(F.spark_partition_id().alias("run")).agg(F.max("run")).first()[0] or 0) + 1
    rounds = max(1, math.ceil(math.log2(partitions) / bits))
    best = F.struct((-F.col("n_points")).alias("shorter"), F.col("id").isNull().alias("no_id"), "id", "uid").alias("best")
    least, rows = F.min("best").alias("best"), F.sum("n").alias("n")
    run = F.spark_partition_id() % (1 << bits * rounds)
    runs = fingerprints.select(*KEYS, run.alias("run"), best).groupBy("run", *KEYS).agg(least, F.count("*").alias("n"))
    for level in range(1, rounds + 1):
        part = F.shiftrightunsigned("hash2", 64 - bits * level)
        met = runs.select(*KEYS, F.shiftright("run", bits).alias("run"), part.alias("part"), "best", "n")
        merged = met.repartition("run", "part").sortWithinPartitions("run", "part", *KEYS)
        runs = merged.groupBy("run", "part", *KEYS).agg(least, rows).drop("part")
    return runs.drop("run")


def _with_groups(docs: DataFrame, id_col: str, text_col: str, payload: list[str]) -> DataFrame:
    rows = written(_fingerprints(docs, id_col, text_col, payload), "exact-fingerprints")
    groups = merge_runs(rows).filter("n > 1")
    return rows.join(groups, KEYS, "left")


def exact_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept and text_sha256."""
    rows = _with_groups(docs, id_col, text_col, [id_col])
    return rows.select(
        F.col("id").alias(id_col),
        F.when(F.col("n").isNull(), F.col("id")).otherwise(F.col("best.id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col("best.uid") == F.col("uid"), F.lit(True)).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with all columns of ``docs``."""
    rows = _with_groups(docs, id_col, text_col, docs.columns)
    return rows.filter(F.coalesce(F.col("best.uid") == F.col("uid"), F.lit(True))).select("row.*")


CLASSES_SQL = r"""
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS n_points,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER w = 1 AS kept,
       text_sha256
FROM n
WINDOW w AS (PARTITION BY text_sha256 ORDER BY n_points DESC, doc_id ASC NULLS LAST)
"""
