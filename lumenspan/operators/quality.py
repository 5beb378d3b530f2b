"""Quality of spans: profiles by attribute, the global verdict, rejection of traces and their consistency."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumenspan.functions import dims as by
from lumenspan.functions.dims import Dim, aggregate
from lumenspan.functions.stats import distinct, quantiles, rate, same, sketched, total, varies
from lumenspan.operators import flags
from lumenspan.plans.spec import INVARIANTS, MANDATORY, NUMERIC, OPTIONAL, SPEC, Attr

LEVELS = (0.25, 0.50, 0.75, 0.90, 0.95)


def profile(spans: DataFrame, flag: flags.Flag, agg: Callable[[Column], Column], *dims: Dim, grain: str | None = None) -> DataFrame:
    """``n`` and one figure per attribute, by keys; an attribute that is itself a key is left out."""
    keys = dims + ((by.time(grain),) if grain else ())
    names = {d.name for d in keys}
    return aggregate(spans, keys, F.count(F.lit(1)).alias("n"), *[agg(flag(a)).alias(a.name) for a in SPEC if a.name not in names])


def profiles(spans: DataFrame, flag: flags.Flag, *sets: tuple[Dim, ...]) -> DataFrame:
    """Rates of a flag under several sets of keys from one scan: ``by`` names the set of a row; keys outside it are null.

    Spans are summed up in cells, one for each combination of all keys; the sets group the cells, whose sums are mergeable.
    Attributes that are keys are left out; without spans there is no row.
    """
    keys = {d.name: d for dims in sets for d in dims}
    attrs = [a.name for a in SPEC if a.name not in keys]
    sums = [x for a in SPEC if a.name in attrs for x in (total(flag(a)).alias(f"hits__{a.name}"), F.count(flag(a)).alias(f"known__{a.name}"))]
    cells = aggregate(spans, tuple(keys.values()), F.count(F.lit(1)).alias("n"), *sums)
    rates = [F.expr(f"try_divide(sum(hits__{a}), sum(known__{a}))").alias(a) for a in attrs]
    grouped = cells.groupingSets([[F.col(d.name) for d in dims] for dims in sets], *[F.col(k) for k in keys])
    name = F.lit(None)
    for dims in sets:
        held = {d.name for d in dims}
        code = sum((k not in held) << i for i, k in enumerate(reversed(keys)))  # a bit is set for a key outside the set
        name = F.when(F.col("_set") == code, F.lit(",".join(k for k in keys if k in held))).otherwise(name)
    found = grouped.agg(F.grouping_id().alias("_set"), F.sum("n").alias("n"), *rates)
    return found.select(name.alias("by"), *keys, "n", *attrs)


def completeness(spans: DataFrame, *dims: Dim, grain: str | None = None, agg: Callable[[Column], Column] = rate) -> DataFrame:
    """Rate of missing cells."""
    return profile(spans, flags.missing, agg, *dims, grain=grain)


def correctness(spans: DataFrame, *dims: Dim, grain: str | None = None, agg: Callable[[Column], Column] = rate) -> DataFrame:
    """Rate of violated rules."""
    return profile(spans, flags.violation, agg, *dims, grain=grain)


def contamination(spans: DataFrame, *dims: Dim, grain: str | None = None, agg: Callable[[Column], Column] = rate) -> DataFrame:
    """Rate of trash among cells that are not null."""
    return profile(spans, flags.trash, agg, *dims, grain=grain)


def nulls(spans: DataFrame, *dims: Dim, grain: str | None = None, agg: Callable[[Column], Column] = total) -> DataFrame:
    """Number of null cells."""
    return profile(spans, flags.null, agg, *dims, grain=grain)


def distribution(spans: DataFrame, *dims: Dim, grain: str | None = None, levels: tuple[float, ...] = LEVELS, exact: bool = True) -> DataFrame:
    """Quantiles of the numeric attributes, without empty values, and of the duration: columns ``name__qNN``."""
    keys = [d.key for d in dims + ((by.time(grain),) if grain else ())]
    signals = {a.name: F.col(a.name) if a.empty is None else F.when(F.col(a.name) != F.lit(a.empty), F.col(a.name)) for a in NUMERIC}
    signals["duration_ns"] = F.col("end_time_ns") - F.col("start_time_ns")
    values = (quantiles if exact else sketched)(spans, keys, signals, levels)
    counts = aggregate(spans, dims + ((by.time(grain),) if grain else ()), F.count(F.lit(1)).alias("n"))
    return same(counts, values, [c for c in counts.columns if c != "n"])


def consistency(spans: DataFrame, *columns: str) -> DataFrame:
    """Per trace: its spans and the number of values, null among them, of every invariant."""
    return spans.groupBy("trace_id").agg(F.count(F.lit(1)).alias("spans"), *[distinct(F.col(c)).alias(c) for c in columns or INVARIANTS])


def rollup(spans: DataFrame) -> DataFrame:
    """One row per trace, null being one, with all that is asked of whole traces. Unused columns are pruned."""
    return spans.groupBy("trace_id").agg(
        F.count(F.lit(1)).alias("spans"),
        F.min("start_time_ns").alias("start_ns"),
        F.max("end_time_ns").alias("end_ns"),
        F.coalesce(F.max(flags.is_dialog()), F.lit(False)).alias("dialog"),
        F.max(flags.blocking()).alias("rejected"),
        *[varies(F.col(c)).alias(f"varies__{c}") for c in INVARIANTS],
    )


def broken() -> Column:
    """Over ``rollup``: whether any invariant changes."""
    return reduce(or_, [F.col(f"varies__{c}") for c in INVARIANTS])


def trace_consistency(spans: DataFrame) -> DataFrame:
    """For every invariant the number of traces in which it changes."""
    return consistency_of(rollup(spans))


def consistency_of(traces: DataFrame) -> DataFrame:
    return traces.agg(*[total(F.col(f"varies__{c}")).alias(c) for c in INVARIANTS])


def breaks(spans: DataFrame) -> DataFrame:
    """Per trace whether any invariant changes."""
    return rollup(spans).select("trace_id", broken().alias("broken"))


def facts(spans: DataFrame, *more: Column) -> DataFrame:
    """One row from one pass: spans ``n``, ``trash_cells``, the missing, violated, trash and null cells of every attribute, and ``more``."""
    kinds = {"missing": flags.missing, "violation": flags.violation, "trash": flags.trash, "null": flags.null}
    return spans.agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum(flags.across(flags.trash, SPEC)), F.lit(0)).alias("trash_cells"),
        *[F.expr(f"coalesce(sum(cast({flag.sql(a)} AS bigint)), 0L) AS {kind}__{a.name}") for kind, flag in kinds.items() for a in SPEC],
        *more,
    )


def rates_of(found: DataFrame, kind: str) -> DataFrame:
    """``completeness`` (missing), ``correctness`` (violation) or ``contamination`` (trash) from ``facts``."""

    def share(a: Attr) -> str:
        of = f"n - null__{a.name}" if kind == "trash" and a.trash is not None else "n"
        return f"try_divide({kind}__{a.name}, {of}) AS {a.name}"

    return found.selectExpr("n", *[share(a) for a in SPEC])


def sums_of(found: DataFrame, kind: str) -> DataFrame:
    return found.selectExpr("n", *[f"{kind}__{a.name} AS {a.name}" for a in SPEC])


def verdict(spans: DataFrame, max_nulls: int = 0, max_rules: int = 0, max_dups: int = 0, max_breaks: int = 0) -> DataFrame:
    """One row: counts of all defects, and whether those with a limit keep it.

    Blocking violations are those of the worst mandatory attribute. One pass gives the cell counts, one rollup by trace
    the breaks, one by key the duplicates.
    """
    limits = {"null_violations": max_nulls, "blocking_rule_violations": max_rules, "duplicate_keys": max_dups, "trace_breaks": max_breaks}
    return verdict_of(facts(spans), rollup(spans), spans, limits)


def verdict_of(found: DataFrame, traces: DataFrame, spans: DataFrame, limits: dict[str, int] | None = None) -> DataFrame:
    limits = limits or dict.fromkeys(("null_violations", "blocking_rule_violations", "duplicate_keys", "trace_breaks"), 0)
    summed = lambda kind, attrs: F.expr(" + ".join(f"{kind}__{a.name}" for a in attrs))
    cells = found.select(
        summed("null", MANDATORY).alias("null_violations"),
        summed("missing", SPEC).alias("missing"),
        "trash_cells",
        summed("violation", SPEC).alias("rule_violations"),
        F.greatest(*[F.col(f"violation__{a.name}") for a in MANDATORY]).alias("blocking_rule_violations"),
        summed("violation", OPTIONAL).alias("advisory_rule_violations"),
    )
    keys = spans.groupBy("trace_id", "span_id").agg((F.count(F.lit(1)) - 1).alias("again")).agg(F.coalesce(F.sum("again"), F.lit(0)).alias("duplicate_keys"))
    changed = traces.agg(total(broken()).alias("trace_breaks"))
    # three frames of one row each
    one = cells.crossJoin(keys).crossJoin(changed)
    return one.withColumn("valid", reduce(and_, [F.col(c) <= n for c, n in limits.items()]))


def is_valid(spans: DataFrame, **limits: int) -> bool:
    return verdict(spans, **limits).first()["valid"]


def tagged(spans: DataFrame, over: Dim | None = None) -> DataFrame:
    """The spans with ``rejected``: whether their trace has a span that violates a mandatory rule; null is one trace.

    The flag comes from a rollup by trace and is joined, so that adaptive execution can split the spans of a long trace.
    """
    over = over or by.trace()
    flag = spans.groupBy(over.key.alias("_over")).agg(F.max(flags.blocking()).alias("rejected"))
    if "rejected" in spans.columns:
        spans = spans.drop("rejected")
    return spans.withColumn("_over", over.key).transform(lambda s: same(s, flag, ["_over"])).drop("_over")


def rejection(spans: DataFrame, *dims: Dim, grain: str | None = None, over: Dim | None = None, agg: Callable[[Column], Column] = rate) -> DataFrame:
    """Traces by keys, how many of them are dropped and kept, and ``agg`` of the flag; a trace under two keys counts in each.

    ``over`` is the key that spans are rejected together by. The flag comes from a rollup by it and is joined to the few keys of
    each trace, not to its spans.
    """
    keys, over = dims + ((by.time(grain),) if grain else ()), over or by.trace()
    if not keys and over == by.trace():
        return rejection_of(rollup(spans), agg=agg)
    cells = spans.groupBy(over.key.alias("_over"), *[d.key for d in keys]).agg(F.max(flags.blocking()).alias("bad"))
    traces = cells.withColumn("rejected", F.max("bad").over(Window.partitionBy("_over")))
    return rejection_of(traces, *[d.name for d in keys], agg=agg)


def rejection_of(traces: DataFrame, *names: str, agg: Callable[[Column], Column] = rate) -> DataFrame:
    rejected = F.col("rejected")
    return traces.groupBy(*names).agg(F.count(F.lit(1)).alias("n"), agg(rejected).alias("dropped_rate"), total(rejected).alias("dropped"), total(~rejected).alias("kept"))


def trace_status(spans: DataFrame) -> DataFrame:
    """Per trace: session and version of its first span, spans, and whether it is rejected or consistent."""
    order = F.struct("start_time_ns", "span_id")
    return spans.groupBy("trace_id").agg(
        F.min_by("session_id", order).alias("session_id"),
        F.min_by("nexus_distrib_ver", order).alias("nexus_distrib_ver"),
        F.count(F.lit(1)).alias("spans"),
        F.max(flags.blocking()).alias("rejected"),
        (~reduce(or_, [varies(F.col(c)) for c in INVARIANTS])).alias("consistent"),
    )


def flow(spans: DataFrame, grain: str) -> DataFrame:
    """By time bucket: traces, validity of mandatory rules and rate of all violations."""
    return (
        spans.groupBy(by.time(grain).key)
        .agg(distinct(F.col("trace_id")).alias("traces"), (1 - F.avg(flags.share(flags.violation, MANDATORY))).alias("validity"), F.avg(flags.share(flags.violation, SPEC)).alias("defect"))
        .orderBy(F.col("ts").asc_nulls_first())
    )
