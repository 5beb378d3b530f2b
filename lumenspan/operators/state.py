"""What is known of every trace so far, stored and merged with new spans.

All parts of a state are mergeable: least and greatest values, sums, and flags that stay once they are set. The table is bucketed by
``KEY``, so that merging a day shuffles that day alone; a generation is written beside the one that it reads.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenspan.operators import flags
from lumenspan.plans.spec import INVARIANTS

KEY = "trace_key"  # stands for the trace, null being one, so that a plain equality joins
BUCKETS = 200


def trace_state(spans: DataFrame) -> DataFrame:
    """One row per trace, null being one."""
    return spans.groupBy(F.coalesce(F.concat(F.lit("="), "trace_id"), F.lit("")).alias(KEY)).agg(
        F.min("trace_id").alias("trace_id"),
        F.count(F.lit(1)).alias("spans"),
        F.min("start_time_ns").alias("start_ns"),
        F.max("end_time_ns").alias("end_ns"),
        F.coalesce(F.max(flags.is_dialog()), F.lit(False)).alias("dialog"),
        F.max(flags.blocking()).alias("rejected"),
        *[f(F.col(c)).alias(f"{name}__{c}") for c in INVARIANTS for name, f in (("least", F.min), ("greatest", F.max))],
        *[F.count_if(F.col(c).isNull()).alias(f"nulls__{c}") for c in INVARIANTS],
    )


def merged(stored: DataFrame, new: DataFrame) -> DataFrame:
    """The state of all spans from the states of two parts of them."""

    def both(name: str) -> str:
        if name == "trace_id":
            return "coalesce(a.trace_id, b.trace_id) AS trace_id"
        if name == "spans" or name.startswith("nulls__"):
            return f"coalesce(a.{name}, 0L) + coalesce(b.{name}, 0L) AS {name}"
        return f"{'least' if name == 'start_ns' or name.startswith('least__') else 'greatest'}(a.{name}, b.{name}) AS {name}"

    names = [c for c in stored.columns if c != KEY]
    return stored.alias("a").join(new.alias("b"), KEY, "full").selectExpr(KEY, *map(both, names))


def _write(state: DataFrame, table: str, buckets: int) -> DataFrame:
    state.write.bucketBy(buckets, KEY).sortBy(KEY).saveAsTable(table)
    return state.sparkSession.table(table)


def begin(spans: DataFrame, table: str, buckets: int = BUCKETS) -> DataFrame:
    """The first generation, written as ``table``."""
    return _write(trace_state(spans).repartition(buckets, KEY), table, buckets)


def advance(stored: DataFrame, spans: DataFrame, table: str, buckets: int = BUCKETS) -> DataFrame:
    """The next generation, written as ``table``: tasks hold whole buckets already, so that nothing stored is shuffled."""
    return _write(merged(stored, trace_state(spans)), table, buckets)


def rolled(state: DataFrame) -> DataFrame:
    """The state as ``quality.rollup`` gives it."""
    varies = [f"coalesce(least__{c} <> greatest__{c}, false) OR (nulls__{c} > 0 AND nulls__{c} < spans) AS varies__{c}" for c in INVARIANTS]
    return state.selectExpr("trace_id", "spans", "start_ns", "end_ns", "dialog", "rejected", *varies)
