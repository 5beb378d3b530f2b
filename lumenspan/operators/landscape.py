"""What the telemetry consists of: size, shape of traces, kinds, repeated content, coverage and traffic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumenspan.functions import dims as by
from lumenspan.functions.stats import digest, distinct, quantiles, rate, sketched, total
from lumenspan.operators import flags
from lumenspan.operators.quality import rollup
from lumenspan.plans.spec import KINDS

TOP = 8


def kind_place() -> Column:
    """Order of kinds by category; unknown ones last, null first."""
    place = F.array_position(F.lit(list(KINDS)), F.col("aef_kind"))
    return F.when(F.col("aef_kind").isNull(), -1).when(place == 0, len(KINDS) + 1).otherwise(place)


def sums() -> list[Column]:
    """What one pass over the spans gives besides the counts of cells: size, time span, errors and coverage."""
    return [
        F.count(F.lit(1)).alias("spans"),
        F.min("agent_id").alias("agent"),
        F.min("nexus_distrib_ver").alias("version"),
        F.min("start_time_ns").alias("t0_ns"),
        F.max("end_time_ns").alias("t1_ns"),
        rate(flags.is_error()).alias("error_rate"),
        total(flags.is_http()).alias("http_spans"),
        total(flags.is_http() & (F.col("http_method") == "NONE")).alias("http_gap"),
        total(flags.is_llm()).alias("llm_spans"),
        total(flags.is_llm() & (F.col("llm_model") == "")).alias("llm_no_model"),
        total(flags.is_llm() & (F.col("llm_total_tokens") == -1)).alias("llm_no_tokens"),
    ]


def overview(spans: DataFrame) -> DataFrame:
    """One row: spans, traces, sessions, agents and versions, distinct records, time span and rate of errors."""
    return overview_of(spans.agg(*sums()), spans)


def overview_of(found: DataFrame, spans: DataFrame) -> DataFrame:
    """``overview`` from the sums. Values are counted distinct among the few combinations of each trace, records by digests."""
    combinations = spans.groupBy("trace_id", "session_id", "agent_id", "nexus_distrib_ver").agg(F.count(F.lit(1)).alias("n"))
    names = {"trace_id": "traces", "session_id": "sessions", "agent_id": "agents", "nexus_distrib_ver": "versions"}
    values = combinations.agg(*[distinct(F.col(c)).alias(n) for c, n in names.items()])
    records = spans.select(digest(*map(F.col, ("aef_kind", "span_name", "input_text", "output_text"))).alias("record")).distinct().agg(F.count(F.lit(1)).alias("unique_records"))
    # three frames of one row each
    one = found.crossJoin(values).crossJoin(records)
    return one.select("spans", "traces", "sessions", "agents", "agent", "versions", "version", "unique_records", "t0_ns", "t1_ns", "error_rate")


def bounds(spans: DataFrame) -> DataFrame:
    return spans.agg(F.min("start_time_ns").alias("t0_ns"), F.max("end_time_ns").alias("t1_ns"))


def trace_shape(spans: DataFrame, exact: bool = True) -> DataFrame:
    """One row on traces: number, single spans, dialogs, spans and durations. The 95th percentile is the value at the
    nearest place; ``exact=False`` keeps bounded sketches instead."""
    return shape_of(rollup(spans), exact)


def shape_of(traces: DataFrame, exact: bool = True) -> DataFrame:
    per = traces.select("spans", "dialog", ((F.col("end_ns") - F.col("start_ns")) / F.lit(1_000_000)).alias("dur_ms"))
    counts = per.agg(
        F.count(F.lit(1)).alias("traces"),
        total(F.col("spans") == 1).alias("singles"),
        rate(F.col("spans") == 1).alias("single_share"),
        F.max("spans").alias("spans_max"),
        rate(F.col("dialog")).alias("dialog_share"),
        total(F.col("dialog")).alias("dialog_traces"),
    )
    signals = {"spans": F.col("spans"), "dur": F.col("dur_ms")}
    levels = (0.5, 0.95)
    # one row each
    one = counts.crossJoin(quantiles(per, [], signals, levels, nearest=(0.95,)) if exact else sketched(per, [], signals, levels))
    return one.select(
        "traces", "singles", "single_share", F.col("spans__q50").alias("spans_median"), "spans_max", "dialog_share", "dialog_traces", F.col("dur__q50").alias("dur_ms_median"), F.col("dur__q95").alias("dur_ms_p95")
    )


def composition(spans: DataFrame) -> DataFrame:
    """Number and share of spans by kind, most frequent first."""
    counts = spans.groupBy("aef_kind").agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy())).orderBy(F.desc("n"), kind_place())


def degeneracy(spans: DataFrame) -> DataFrame:
    """One row: spans and share of the most frequent pair of input and output, and the number of pairs, which digests stand for."""
    pairs = spans.groupBy(digest(F.col("input_text"), F.col("output_text")).alias("pair")).agg(F.count(F.lit(1)).alias("n"))
    return pairs.agg(F.max("n").alias("dominant_n"), F.try_divide(F.max("n"), F.sum("n")).alias("dominant_share"), F.count(F.lit(1)).alias("unique_pairs"))


def repeats(spans: DataFrame, top: int = TOP) -> DataFrame:
    """The most frequent pairs of kind and name with their distinct inputs and outputs, which digests stand for."""
    texts = spans.select("aef_kind", "span_name", *[F.when(F.col(c).isNotNull(), digest(F.col(c))).alias(c) for c in ("input_text", "output_text")])
    groups = texts.groupBy("aef_kind", "span_name").agg(F.count(F.lit(1)).alias("n"), distinct(F.col("input_text")).alias("uniq_in"), distinct(F.col("output_text")).alias("uniq_out"))
    return groups.orderBy(F.desc("n"), kind_place(), F.col("span_name").asc_nulls_first()).limit(top)


def coverage(spans: DataFrame) -> DataFrame:
    """One row: HTTP spans without method, and model spans without model or tokens."""
    return coverage_of(spans.agg(*sums()))


def coverage_of(found: DataFrame) -> DataFrame:
    return found.select("http_spans", "http_gap", "llm_spans", "llm_no_model", "llm_no_tokens")


def traffic(spans: DataFrame, grain: str) -> DataFrame:
    """By time bucket: spans of dialogs, other spans, and rate of errors.

    Spans are counted by trace and bucket first, so that the flag of a trace meets counts and not spans.
    """
    cells = spans.groupBy("trace_id", by.time(grain).key).agg(
        F.count(F.lit(1)).alias("n"), F.max(flags.is_dialog()).alias("here"), F.sum(flags.is_error().cast("long")).alias("errors"), F.count("status_code").alias("known")
    )
    dialog = F.coalesce(F.max("here").over(Window.partitionBy("trace_id")), F.lit(False))
    return (
        cells.withColumn("dialog", dialog)
        .groupBy("ts")
        .agg(
            F.coalesce(F.sum(F.when(F.col("dialog"), F.col("n"))), F.lit(0)).alias("dialog_spans"),
            F.coalesce(F.sum(F.when(~F.col("dialog"), F.col("n"))), F.lit(0)).alias("tech_spans"),
            F.try_divide(F.sum("errors"), F.sum("known")).alias("error_rate"),
        )
        .orderBy(F.col("ts").asc_nulls_first())
    )


def dialog_share(traffic: DataFrame) -> DataFrame:
    """Share of dialog spans in each bucket of ``traffic``."""
    return traffic.select("ts", (F.col("dialog_spans") / F.greatest(F.col("dialog_spans") + F.col("tech_spans"), F.lit(1))).alias("dialog_share"))


def mix(traffic: DataFrame) -> DataFrame:
    """``traffic`` in long form: a row for each bucket and kind of trace, with its spans ``n``."""
    return traffic.withColumnsRenamed({"dialog_spans": "dialog", "tech_spans": "other"}).unpivot("ts", ["dialog", "other"], "traces", "n")
