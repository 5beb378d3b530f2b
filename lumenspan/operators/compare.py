"""Comparing two tables row by row, without order: equality in one scan of each, then only the rows that differ."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PLACES, BUCKETS = 5, 4096


def row_key(df: DataFrame, places: int = PLACES) -> Column:
    """Two hashes of a row as one binary; fractions are rounded first, and null is a value of its own."""
    plain = [F.round(F.col(f"`{c}`").cast("double"), places) + F.lit(0.0) if kind in ("double", "float") else F.col(f"`{c}`") for c, kind in df.dtypes]
    row = [x for c in plain for x in (c.isNull(), c)]
    return F.struct(F.xxhash64(F.lit(1), *row).alias("one"), F.xxhash64(F.lit(2), *row).alias("two"))


def _settled(df: DataFrame) -> DataFrame:
    """``df`` with its columns computed once: what uses them several times below does not repeat their expressions."""
    return df.select(F.explode(F.array(F.struct(*[F.col(f"`{c}`") for c in df.columns]))).alias("row")).select("row.*")


def fingerprint(df: DataFrame, places: int = PLACES) -> DataFrame:
    """One row: the number of rows and sums of their hashes, alike for tables of the same rows in any order."""
    df = _settled(df)
    key = row_key(df, places)
    parts = [F.coalesce(F.sum(F.pmod(key[n], F.lit(1 << 31))), F.lit(0)).alias(n) for n in ("one", "two")]
    return df.agg(F.count(F.lit(1)).alias("n"), *parts, F.coalesce(F.bit_xor(key["one"]), F.lit(0)).alias("mixed"))


def equal(left: DataFrame, right: DataFrame, places: int = PLACES) -> bool:
    return left.columns == right.columns and fingerprint(left, places).first() == fingerprint(right, places).first()


def differences(left: DataFrame, right: DataFrame, places: int = PLACES) -> DataFrame:
    """The rows that one side has more often than the other: ``side``, ``times`` and the columns.

    Buckets of rows whose fingerprints agree are left out before any row is shuffled; the table of buckets has a fixed size.
    Columns are gathered one by one, so that those that nobody reads are not shuffled.
    """
    sides = [("left", _settled(left)), ("right", _settled(right))]
    both = [side.select(F.lit(name).alias("side"), row_key(side, places).alias("key"), F.struct(*[F.col(f"`{c}`") for c in side.columns]).alias("row")) for name, side in sides]
    each = _settled(both[0].unionByName(both[1])).withColumn("bucket", F.pmod(F.col("key.one"), F.lit(BUCKETS)))
    sign = F.when(F.col("side") == "left", 1).otherwise(-1)
    sums = [F.sum(sign).alias("n"), *[F.sum(sign * F.pmod(F.col(f"key.{k}"), F.lit(1 << 31))).alias(k) for k in ("one", "two")]]
    apart = each.groupBy("bucket").agg(*sums).filter("n <> 0 OR one <> 0 OR two <> 0").select("bucket")
    counts = each.join(F.broadcast(apart), "bucket", "left_semi").groupBy("key").agg(F.sum(sign).alias("more"), *[F.min(F.col("row")[c]).alias(f"c{i}") for i, c in enumerate(left.columns)])
    found = counts.filter("more <> 0")
    columns = [F.col(f"c{i}").alias(c) for i, c in enumerate(left.columns)]
    return found.select(F.when(F.col("more") > 0, "left").otherwise("right").alias("side"), F.abs("more").alias("times"), *columns)
