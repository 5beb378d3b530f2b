"""Running figures along traces, by a segmented scan.

A trace of more than ``BLOCK`` spans is cut into blocks by time, so that no task holds a trace whole. The time of such a trace is divided into
``64 n / BLOCK`` equal slots for its ``n`` spans; the spans of every slot are counted, and running counts put whole slots together into
blocks. Each block is scanned by itself. What it takes over from the blocks before it (counts, sums and the last values) comes from a
second pass over one row per block, and is added to the spans of the block. Spans of a trace in one slot stay together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumenspan.functions.stats import same
from lumenspan.operators import flags
from lumenspan.plans.spec import SPEC

BLOCK = 1_000_000
SLOTS = 64
SIGNALS = ("missing", "invalid", "duration", "error")

def long_traces(spans: DataFrame, size: int = BLOCK) -> DataFrame:
    """Traces of more than ``size`` spans with the start and the width of their slots."""
    each = spans.groupBy("trace_id").agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.min("start_time_ns"), F.lit(0)).alias("_from"), F.coalesce(F.max("start_time_ns"), F.lit(0)).alias("to"))
    width = F.ceil((F.col("to") - F.col("_from") + 1) * size / (F.col("n") * SLOTS)).cast("long")
    return each.filter(F.col("n") > size).select("trace_id", "_from", F.greatest(F.lit(1), width).alias("_width"))


def blocks(spans: DataFrame, long: DataFrame, size: int = BLOCK) -> DataFrame:
    """The spans with ``_block``: the number of the block in time, null in traces that are not long."""
    slot = F.when(F.col("_width").isNotNull(), F.coalesce(F.expr("(start_time_ns - _from) DIV _width"), F.lit(-1)))
    slotted = same(spans, long, ["trace_id"]).withColumn("_slot", slot).drop("_from", "_width")
    counted = slotted.filter("_slot IS NOT NULL").groupBy("trace_id", "_slot").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("trace_id").orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return same(slotted, counted.select("trace_id", "_slot", F.floor(before / size).cast("long").alias("_block")), ["trace_id", "_slot"]).drop("_slot")


def dynamics(spans: DataFrame, window: int = 10, size: int = BLOCK) -> DataFrame:
    """The spans with their place in the trace and, for four signals, the value, running sum, running mean and rolling mean.

    Whether any trace is long is asked at once, so that spans are not joined with nothing.
    """
    valued = spans.withColumns(
        {
            "missing": flags.across(flags.missing, SPEC),
            "invalid": flags.across(flags.violation, SPEC),
            "duration": F.col("end_time_ns") - F.col("start_time_ns"),
            "error": flags.is_error().cast("long"),
        }
    )
    long = long_traces(spans, size)
    keys = ["trace_id"] if long.isEmpty() else ["trace_id", "_block"]
    placed = valued if keys == ["trace_id"] else blocks(valued, long, size)
    own = Window.partitionBy(*keys).orderBy(F.col("start_time_ns").asc_nulls_first(), F.col("span_id").asc_nulls_first())
    so_far, last = own.rowsBetween(Window.unboundedPreceding, 0), own.rowsBetween(1 - window, 0)
    cum = {f"_{s}_cum": F.sum(s).over(so_far) for s in SIGNALS} | {"_seq_own": F.count("span_id").over(so_far)}
    if len(keys) == 1:
        scanned = placed.withColumns(cum | {f"_{s}_roll": F.avg(s).over(last) for s in SIGNALS})
        out = {"span_seq": F.col("_seq_own")} | {f"{s}__cum": F.when(F.col(s).isNotNull(), F.col(f"_{s}_cum")) for s in SIGNALS} | {f"{s}__roll{window}": F.col(f"_{s}_roll") for s in SIGNALS}
    else:
        local = cum | {"_nth": F.row_number().over(own)} | {f"_{s}_sum": F.sum(s).over(last) for s in SIGNALS} | {f"_{s}_n": F.count(s).over(last) for s in SIGNALS}
        scanned, out = same(placed.withColumns(local), carried(placed, window), keys), _with_carried(window)
    found = scanned.withColumns(out)
    kept = [*spans.columns, *SIGNALS, *out]
    return found.select(*[F.col(f"`{c}`") for c in kept]).withColumns({f"{s}__mean": F.try_divide(F.col(f"{s}__cum"), F.col("span_seq")) for s in SIGNALS})


def _with_carried(window: int) -> dict[str, Column]:
    """The figures of a span from those of its block and what the block takes over."""
    # the span of place k in its block takes in the last window - k values before it
    want = F.least(F.size("_tail"), F.greatest(F.lit(0), window - F.col("_nth")))
    tail = F.slice("_tail", F.size("_tail") - want + 1, want)
    plus = lambda c, more: F.when(more.isNull(), c).otherwise(F.coalesce(c, F.lit(0)) + more)
    out = {"span_seq": F.col("_seq_own") + F.coalesce("_seq", F.lit(0))}
    for s in SIGNALS:
        values = F.filter(tail.getField(s), lambda v: v.isNotNull())
        taken = F.when(F.col("_tail").isNotNull(), F.aggregate(values, F.lit(0).cast("long"), lambda a, v: a + v))
        n = F.col(f"_{s}_n") + F.when(F.col("_tail").isNotNull(), F.size(values)).otherwise(0)
        out[f"{s}__cum"] = F.when(F.col(s).isNotNull(), plus(F.col(f"_{s}_cum"), F.col(f"_{s}")))
        out[f"{s}__roll{window}"] = F.try_divide(plus(F.col(f"_{s}_sum"), taken), n)
    return out


def carried(placed: DataFrame, window: int) -> DataFrame:
    """For every block of a long trace what the blocks before it hand over: count ``_seq``, sums ``_<signal>`` and ``_tail``, the last values."""
    narrow = placed.filter("_block IS NOT NULL").select("trace_id", "_block", "start_time_ns", "span_id", *SIGNALS)
    sums = narrow.groupBy("trace_id", "_block").agg(F.count("span_id").alias("seq"), *[F.sum(s).alias(s) for s in SIGNALS])
    backwards = Window.partitionBy("trace_id", "_block").orderBy(F.col("start_time_ns").desc_nulls_last(), F.col("span_id").desc_nulls_last())
    ends = narrow.withColumn("back", F.row_number().over(backwards)).filter(F.col("back") < window)
    tails = ends.groupBy("trace_id", "_block").agg(F.array_sort(F.collect_list(F.struct((-F.col("back")).alias("at"), *SIGNALS))).alias("tail"))
    each = same(sums, tails, ["trace_id", "_block"])
    ordered = Window.partitionBy("trace_id").orderBy("_block")
    before, near = ordered.rowsBetween(Window.unboundedPreceding, -1), ordered.rowsBetween(1 - window, -1)
    tail = F.flatten(F.collect_list("tail").over(near))
    return each.select("trace_id", "_block", F.sum("seq").over(before).alias("_seq"), *[F.sum(s).over(before).alias(f"_{s}") for s in SIGNALS], F.when(F.size(tail) > 0, F.slice(tail, F.greatest(F.lit(1), F.size(tail) - window + 2), F.lit(window - 1))).alias("_tail"))
