"""The registered span queries: every operator over spans seen through ``events``."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenspan.functions import dims as by
from lumenspan.functions.scores import parameters
from lumenspan.functions.stats import DAY_NS, total
from lumenspan.functions.rules import PATTERNS
from lumenspan.operators import compare, flags, heavy, landscape, quality, readiness, running, state
from lumenspan.operators.recast import recast
from lumenspan.plans.engine import criteria_frame, problems_frame, status_frame
from lumenspan.sources.spans import event_spans


def _spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recast(event_spans(spark, sf_dir))


def _rounded(df: DataFrame, places: int = 9) -> DataFrame:
    return df.selectExpr(*[f"round(`{c}`, {places}) AS `{c}`" if kind == "double" else f"`{c}`" for c, kind in df.dtypes])


def _dynamics(spans: DataFrame, size: int = running.BLOCK) -> DataFrame:
    found = running.dynamics(spans, size=size)
    signals = ("missing", "invalid", "duration", "error")
    per = [F.sum(f"{s}__cum").alias(f"{s}__cum") for s in signals] + [F.max(f"{s}__{k}").alias(f"{s}__{k}") for s in signals for k in ("mean", "roll10")]
    return found.groupBy("trace_id").agg(F.max("span_seq").alias("span_seq"), F.count(F.lit(1)).alias("n"), *per)


def _differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where the strict recast of the spans differs from plain casts."""
    raw = event_spans(spark, sf_dir)
    found = compare.differences(recast(raw), recast(raw, strict=False))
    return found.groupBy("side", "trace_id", "span_id").agg(F.sum("times").alias("times"))


def _states(spans: DataFrame) -> DataFrame:
    """Traces from the merged states of three parts of the days."""
    first, *more = [state.trace_state(spans.filter(F.coalesce(F.pmod(F.expr(f"start_time_ns div {DAY_NS}"), F.lit(3)), F.lit(0)) == i)) for i in range(3)]
    return state.rolled(reduce(state.merged, more, first))


def _json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shape and strict JSON of the properties of events, of which some are cut, trailed or nested, and their number ``k``."""
    props = F.when(F.col("event_id") % 7 == 1, F.expr("left(props, char_length(props) - 1)")).when(F.col("event_id") % 7 == 2, F.concat("props", F.lit("}"))).when(F.col("event_id") % 7 == 3, F.concat(F.lit("["), "props", F.lit(", null]"))).otherwise(F.col("props"))
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", props.alias("text"))
    value = flags.json_value(F.col("text"))
    return rows.select("event_id", F.col("text").rlike(PATTERNS["json"]).alias("shaped"), flags.is_json(F.col("text")).alias("strict"), F.try_variant_get(value, "$.k", "bigint").alias("k"))


_E = parameters("E")

#: name: (operator over conformed spans, places to which its fractions are rounded)
_OVER_SPANS: dict[str, tuple[Callable[[DataFrame], DataFrame], int]] = {
    "span_completeness": (quality.completeness, 9),
    "span_completeness_by_agent": (lambda s: quality.completeness(s, by.agent()), 9),
    "span_correctness": (quality.correctness, 9),
    "span_correctness_by_day": (lambda s: quality.correctness(s, grain="1d"), 9),
    "span_violations_by_version": (lambda s: quality.correctness(s, by.version("minor"), agg=total), 9),
    "span_profiles": (lambda s: quality.profiles(s, flags.violation, (by.trace(),), (by.agent(),), (by.version("minor"),), (by.time("1d"),), (by.agent(), by.time("1d")), ()), 9),
    "span_state": (_states, 9),
    "span_contamination": (quality.contamination, 9),
    "span_nulls": (quality.nulls, 9),
    "span_distribution": (quality.distribution, 6),
    "span_verdict": (quality.verdict, 9),
    "span_consistency": (quality.consistency, 9),
    "span_trace_consistency": (quality.trace_consistency, 9),
    "span_tagged": (lambda s: quality.tagged(s).groupBy("trace_id", "span_id", "rejected").agg(F.count(F.lit(1)).alias("n")), 9),
    "span_rejection": (quality.rejection, 9),
    "span_rejection_by_agent": (lambda s: quality.rejection(s, by.agent()), 9),
    "span_rejection_by_agent_day": (lambda s: quality.rejection(s, by.agent(), grain="1d"), 9),
    "span_trace_status": (quality.trace_status, 9),
    "span_flow": (lambda s: quality.flow(s, "4h"), 9),
    "span_assess": (lambda s: readiness.assess(s, _E), 9),
    "span_assess_by_agent": (lambda s: readiness.assess(s, _E, by.agent()), 9),
    "span_blame": (readiness.blame, 9),
    "span_overview": (landscape.overview, 9),
    "span_bounds": (landscape.bounds, 9),
    "span_trace_shape": (landscape.trace_shape, 6),
    "span_composition": (landscape.composition, 9),
    "span_degeneracy": (landscape.degeneracy, 9),
    "span_repeats": (landscape.repeats, 9),
    "span_heavy": (lambda s: heavy.top(s, ["agent_id", "aef_kind", "status_code"], 5), 9),
    "span_coverage": (landscape.coverage, 9),
    "span_traffic": (lambda s: landscape.traffic(s, "4h"), 9),
    "span_mix": (lambda s: landscape.mix(landscape.traffic(s, "4h")), 9),
    "span_dialog_share": (lambda s: landscape.dialog_share(landscape.traffic(s, "4h")), 9),
    "span_dynamics": (_dynamics, 6),
    # blocks so small that the traces of events are cut
    "span_dynamics_in_blocks": (lambda s: _dynamics(s, 2), 6),
    "span_inflow_trend": (lambda s: readiness.inflow_trend(quality.flow(s, "1d")), 9),
}


def _query(operator: Callable[[DataFrame], DataFrame], places: int) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: _rounded(operator(_spans(spark, sf_dir)), places)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "span_criteria": lambda spark, sf_dir: criteria_frame(_spans(spark, sf_dir)),
    "span_problems": lambda spark, sf_dir: problems_frame(spark, event_spans(spark, sf_dir), "E"),
    "span_status": lambda spark, sf_dir: status_frame(spark, event_spans(spark, sf_dir), "E"),
    "span_recast": _spans,
    "span_differences": _differences,
    "event_json": _json,
    "span_cast_only": lambda spark, sf_dir: recast(event_spans(spark, sf_dir), strict=False),
} | {name: _query(*spec) for name, spec in _OVER_SPANS.items()}
