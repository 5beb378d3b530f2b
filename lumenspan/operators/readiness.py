"""Readiness for monitoring: components, dynamics, blame and the assessment by keys."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lumenspan.functions.dims import Dim
from lumenspan.functions import dims as by
from lumenspan.functions import scores
from lumenspan.functions.scores import Params
from lumenspan.functions.stats import DAY_NS, correlation, same, total
from lumenspan.operators import flags
from lumenspan.operators.quality import correctness
from lumenspan.plans.spec import MANDATORY, SPEC

ASSESSED = (
    "traces eff_traces loss_rate worst_rule_rate worst_rule_attr validity presence retention volume_score quality_score rate trend stability accel_score readiness verdict reason"
).split()


def last_start(spans: DataFrame) -> int | None:
    return spans.agg(F.max("start_time_ns")).first()[0]


def recent(spans: DataFrame, window_days: int) -> DataFrame:
    """The spans that start within the last days of the data. The bound is a literal, so that a scan can skip what is older."""
    last = last_start(spans)
    return spans.filter(F.lit(False) if last is None else F.col("start_time_ns") >= last - window_days * DAY_NS)


def windowed(spans: DataFrame, window_days: int) -> DataFrame:
    """The recent spans, tagged over the whole data."""
    flag = rejected_traces(spans)
    return same(recent(spans.drop("rejected"), window_days).withColumn("_over", F.col("trace_id")), flag, ["_over"]).drop("_over")


def rejected_traces(spans: DataFrame) -> DataFrame:
    return spans.groupBy(F.col("trace_id").alias("_over")).agg(F.max(flags.blocking()).alias("rejected"))


def cells(spans: DataFrame, window_days: int, *dims: Dim, grain: str = "1d") -> DataFrame:
    """Of the recent spans one row per trace, keys and time bucket: spans, sums of violated and null shares, violations by mandatory
    attribute, whether the trace is rejected, and whether the cell is its trace's first under the keys.

    The flag of a trace, which covers all its spans, meets cells only.
    """
    sums = [F.expr(f"sum(cast({flags.violation.sql(a)} AS bigint)) AS _viol__{a.name}") for a in MANDATORY]
    found = recent(spans, window_days).groupBy(F.col("trace_id").alias("_over"), *[d.key for d in dims], by.time(grain).key)
    counted = found.agg(F.count(F.lit(1)).alias("spans"), F.sum(flags.share(flags.violation, MANDATORY)).alias("violated"), F.sum(flags.share(flags.null, MANDATORY)).alias("absent"), *sums)
    first = F.min("ts").over(Window.partitionBy("_over", *[d.name for d in dims])) == F.col("ts")
    return same(counted, rejected_traces(spans), ["_over"]).withColumn("first", first)


def buckets(parts: DataFrame, *names: str) -> DataFrame:
    """``cells`` summed up by keys and time bucket: its traces, those that it has first, and all sums."""
    kept = F.expr("NOT rejected")
    return parts.groupBy(*names, "ts").agg(
        F.count(F.lit(1)).alias("b_traces"),
        total(F.col("first")).alias("traces"),
        total(F.col("first") & kept).alias("eff_traces"),
        F.sum("spans").alias("spans"),
        F.coalesce(F.sum(F.when(kept, F.col("spans"))), F.lit(0)).alias("kept"),
        *[F.sum(c).alias(c) for c in ("violated", "absent", *(f"_viol__{a.name}" for a in MANDATORY))],
    )


def components(per: DataFrame, policy: Params, *names: str) -> DataFrame:
    """``buckets`` by keys: traces, those kept, spans, validity, presence, retention by spans and the violation rate of mandatory rules; mean
    traces a bucket, their trend in time, the stability of validity, and the score of the three."""
    share = lambda c: F.try_divide(F.sum(c), F.sum("spans"))
    body = [
        F.coalesce(F.sum("traces"), F.lit(0)).alias("traces"),
        F.coalesce(F.sum("eff_traces"), F.lit(0)).alias("eff_traces"),
        F.coalesce(F.sum("spans"), F.lit(0)).alias("spans"),
        (1 - share("violated")).alias("validity"),
        (1 - share("absent")).alias("presence"),
        share("kept").alias("retention"),
        *[share(f"_viol__{a.name}").alias(f"_viol__{a.name}") for a in MANDATORY],
        F.avg("b_traces").alias("rate"),
        correlation(F.unix_seconds("ts").cast("double"), F.col("b_traces").cast("double")).alias("trend"),
        F.stddev_samp(1 - F.try_divide(F.col("violated"), F.col("spans"))).alias("_spread"),
    ]
    found = per.groupBy(*names).agg(*body) if names else per.agg(*body)
    steady = F.coalesce(1 - F.nanvl("_spread", F.lit(None)) / policy["stability_tol"], F.lit(1.0))
    found = (
        found.withColumn("stability", F.greatest(F.least(steady, F.lit(1.0)), F.lit(0.0)))
        .withColumn("trend", F.coalesce(F.nanvl("trend", F.lit(None)), F.lit(0.0)))
        .withColumn("accel_score", scores.accel_score(policy, F.col("trend"), F.col("stability"), F.col("rate")))
        .drop("_spread")
    )
    known = reduce(and_, [F.col(n).isNotNull() for n in names], F.lit(True))
    return found.withColumns({c: F.when(known, F.col(c)) for c in ("rate", "trend", "stability", "accel_score")})


def scored(parts: DataFrame, policy: Params) -> DataFrame:
    """Components with loss, the worst rule, volume and quality. Of rules alike the last in the specification's order counts."""
    rates = [F.coalesce(f"_viol__{a.name}", F.lit(0.0)) for a in MANDATORY]
    worst = F.greatest(*rates)
    name = F.lit("—")
    for attr, r in zip(MANDATORY, rates):
        name = F.when((r == worst) & (worst > 0), attr.name).otherwise(name)
    return parts.withColumns(
        {
            "loss_rate": 1 - F.try_divide(F.col("eff_traces"), F.col("traces")),
            "worst_rule_rate": worst,
            "worst_rule_attr": name,
            "volume_score": scores.volume_score(policy, F.col("eff_traces")),
            "quality_score": scores.weighted(policy, validity=F.col("validity"), presence=F.col("presence"), retention=F.col("retention")),
        }
    ).drop(*[c for c in parts.columns if c.startswith("_viol__")])


def assess(spans: DataFrame, policy: Params, *dims: Dim, grain: str = "1d") -> DataFrame:
    """The 17 figures of readiness by keys, most ready first; a null score, as of a null key, comes before all."""
    names = [d.name for d in dims]
    per = buckets(cells(spans, policy["window_days"], *dims, grain=grain), *names)
    both = scored(components(per, policy, *names), policy)
    out = both.withColumn("readiness", scores.weighted(policy, volume=F.col("volume_score"), quality=F.col("quality_score"), accel=F.col("accel_score")))
    out = out.withColumn("verdict", scores.verdict(policy)).withColumn("reason", scores.reason(policy))
    return out.select(*names, *ASSESSED).orderBy(F.col("readiness").desc_nulls_first())


def blame(spans: DataFrame, *dims: Dim) -> DataFrame:
    """Attributes by their violation rate over the whole data, worst first."""
    return blame_of(correctness(spans, *dims), *[d.name for d in dims])


def blame_of(rates: DataFrame, *names: str) -> DataFrame:
    long = rates.unpivot(list(names), [a.name for a in SPEC if a.name not in names], "attr", "violation_rate")
    return long.filter("violation_rate > 0").orderBy(F.desc("violation_rate"), "attr")


def worst_rows(blamed: DataFrame, at: float = 0.5) -> DataFrame:
    """Mandatory attributes that are violated in at least ``at`` of the spans."""
    return blamed.filter(F.col("attr").isin(*[a.name for a in MANDATORY]) & (F.col("violation_rate") >= at)).orderBy(F.desc("violation_rate"), "attr")


def inflow_trend(flow: DataFrame) -> DataFrame:
    """Correlation of the traces of a time bucket with its place in time."""
    placed = flow.withColumn("i", F.row_number().over(Window.orderBy(F.col("ts").asc_nulls_first())) - 1)
    return placed.agg(correlation(F.col("i").cast("double"), F.col("traces").cast("double")).alias("trend"), F.count(F.lit(1)).alias("buckets"))
