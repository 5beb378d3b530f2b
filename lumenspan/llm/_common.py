"""Helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A word is a run of characters outside ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]"

#: Rows and bytes up to which a table of one row per source, language or label is broadcast.
BROADCAST_ROWS, BROADCAST_BYTES = 20_000, 16 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share: ``spark.checkpoint.dir``.

    Only a local master gets a temporary folder of its own when none is set.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if spark.sparkContext.master.split("[")[0] != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    made = tempfile.mkdtemp(prefix="lumenspan-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


#: Folders of the tables that were written and not discarded.
_PATHS: list[str] = []


def written(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """Write ``df`` as a table in the shared folder, with a folder for each value of ``by``, and read it again.

    Cuts the lineage: what follows survives the loss of any executor and never repeats the work.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(by) if by else writer).parquet(path)
    schema = T.StructType([f for f in df.schema if f.name != by] + [f for f in df.schema if f.name == by])
    table = spark.read.schema(schema).parquet(path)
    table.written_to = path
    _PATHS.append(path)
    return table


def _delete(spark: SparkSession, path: str) -> None:
    context = spark.sparkContext
    folder = context._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)
    if path in _PATHS:
        _PATHS.remove(path)


def discard(*tables: DataFrame) -> None:
    """Delete written tables that nothing will read again."""
    for table in tables:
        _delete(table.sparkSession, table.written_to)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[list[DataFrame]]:
    """Tables that are written meanwhile are deleted in the end, but for those that the body puts into the list."""
    before, kept = set(_PATHS), []
    try:
        yield kept
    finally:
        for path in set(_PATHS) - before - {t.written_to for t in kept}:
            _delete(spark, path)


def whole(text: str | Column) -> Column:
    """The text, with null as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def packed_row(df: DataFrame, names: list[str]) -> Column:
    """The named columns of ``df`` as one struct, so that none can clash with a working column."""
    return F.struct(*[df[f"`{c}`"].alias(c) for c in names]).alias("row")


def row_schema(rows: DataFrame, *names: str, more: str) -> T.StructType:
    """The schema of the named columns of ``rows``, followed by the columns of a DDL string."""
    return T.StructType([*(rows.schema[n] for n in names), *T.StructType.fromDDL(more).fields])


def fold(doc_id: str, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod``; a null id counts as the text ``null``."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("null"))) % mod


def join_small(big: DataFrame, small: DataFrame, on: Column, how: str = "left") -> DataFrame:
    """Join with a small table: broadcast once its counted rows and bytes are under the bounds.

    Beyond the bounds Spark's own join runs, where adaptive execution splits skewed keys of ``big``.
    ``small`` should be a written table, so that counting costs next to nothing.
    """
    size = F.sum(F.octet_length(F.to_json(F.struct(*small.columns))))
    rows, held = small.limit(BROADCAST_ROWS + 1).agg(F.count("*"), size).first()
    if rows <= BROADCAST_ROWS and (held or 0) <= BROADCAST_BYTES:
        small = F.broadcast(small)
    return big.join(small, on, how)
