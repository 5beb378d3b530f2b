"""Group keys: a name and the expression behind it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenspan.functions.stats import bucket


@dataclass(frozen=True)
class Dim:
    name: str
    expr: Column | None = None

    @property
    def key(self) -> Column:
        return (F.col(self.name) if self.expr is None else self.expr).alias(self.name)


def _version(pattern: str) -> Column:
    return F.nullif(F.regexp_extract("nexus_distrib_ver", pattern, 1), F.lit(""))


def trace() -> Dim:
    return Dim("trace_id")


def agent() -> Dim:
    return Dim("agent_id")


def session() -> Dim:
    return Dim("session_id")


def version(part: str = "patch") -> Dim:
    """The version's ``major`` or ``major.minor`` part, null where it does not start so, or all of it (``patch``)."""
    if part == "patch":
        return Dim("ver_patch", F.col("nexus_distrib_ver"))
    return Dim(f"ver_{part}", _version({"major": r"^(\d+)", "minor": r"^(\d+\.\d+)"}[part]))


def time(grain: str) -> Dim:
    return Dim("ts", bucket(F.col("start_time_ns"), grain))


def aggregate(df: DataFrame, dims: tuple[Dim, ...], *columns: Column) -> DataFrame:
    """One row per key, or one row for all where there is no key."""
    return df.groupBy(*[d.key for d in dims]).agg(*columns) if dims else df.agg(*columns)
