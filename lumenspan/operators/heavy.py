"""The most frequent values, exactly, without shuffling every value.

A sketch of bounded size names candidates and bounds how often any other value can occur; the few candidates are counted again exactly.
Where the last place does not clear the bound, or stays empty, all values are counted, by digests.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenspan.functions.stats import digest

TRACKED = 65_536  # values that a sketch holds at most
SPARE = 4  # candidates for each place
ERROR = 8.0  # a value that the sketch does not name occurs at most this often, times rows over TRACKED


def top(df: DataFrame, columns: list[str], k: int, tracked: int = TRACKED) -> DataFrame:
    """The ``k`` most frequent combinations of ``columns``, null being a value, with ``n`` and ``share``; ties go to the lesser values,
    null first. Nothing comes from an empty table. The sketch is asked when the query is built.
    """
    rows = df.select(*columns, F.hex(digest(*map(F.col, columns))).alias("_value"))
    asked = min(SPARE * k, tracked)
    found = rows.agg(F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k(_value, {asked}, {tracked})").alias("top")).first()
    named = found["top"] or []
    best = _best(rows.filter(F.col("_value").isin([x["item"] for x in named])), columns, k)
    places = [r["n"] for r in best.select("n").collect()]
    # values beyond those asked for occur no more often than the last of these, by the sketch's upper bounds
    unseen = max(ERROR * found["n"] / tracked, named[-1]["count"] if len(named) == asked else 0)
    if len(places) < k or places[-1] <= unseen:
        best = _best(rows, columns, k)
    return best.withColumn("share", F.col("n") / F.lit(max(found["n"], 1)))


def _best(rows: DataFrame, columns: list[str], k: int) -> DataFrame:
    counts = rows.groupBy("_value").agg(F.count(F.lit(1)).alias("n"), *[F.min(c).alias(c) for c in columns])
    return counts.orderBy(F.desc("n"), *[F.col(c).asc_nulls_first() for c in columns]).limit(k).select(*columns, "n")
