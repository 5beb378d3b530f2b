"""The engine: source, schema gate, conform, measure, decide, render."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenspan.functions import dims as by
from lumenspan.functions.scores import LEVELS, Params, parameters
from lumenspan.functions.stats import DAY_NS, distinct, pick_grain
from lumenspan.operators import landscape, quality, readiness
from lumenspan.operators.recast import recast, schema_diff
from lumenspan.plans import gates as tolerances
from lumenspan.plans import report, triage
from lumenspan.plans.spec import SPEC
from lumenspan.sources.spans import open_spans

log = logging.getLogger(__name__)

SCOPES = ("full", "quality")


def first_pass(spans: DataFrame) -> tuple[DataFrame, dict[str, Any]]:
    """All counts and sums as a local row, and its values: whether there are spans and when, so that no job asks for that alone.

    They are aggregates like the others, not metrics noticed on the way, which count twice what runs twice.
    """
    facts = quality.facts(spans, *landscape.sums())
    began = time.monotonic()
    row = facts.first()
    log.info("facts: %d spans in %.2f s", row["spans"], time.monotonic() - began)
    return spans.sparkSession.createDataFrame([row], facts.schema), row.asDict()


def measure(spans: DataFrame, facts: DataFrame, policy: Params, grain: str, limits: dict[str, int] | None = None) -> tuple[dict[str, DataFrame], list[DataFrame]]:
    """Every table that the decision needs, all small whatever the spans; and what is kept while they are collected.

    ``facts`` of the first pass gives the counts of all attributes and all sums, and one rollup all that concerns traces, which
    is kept for the tables that share it.
    """
    traces = quality.rollup(spans).persist()
    correctness = quality.rates_of(facts, "violation")
    flow = quality.flow(spans, grain).persist()
    tables = {
        "verdict": quality.verdict_of(facts, traces, spans, limits),
        "rejection": quality.rejection_of(traces),
        "assess": readiness.assess(spans, policy, by.agent()),
        "blame": readiness.blame_of(correctness),
        "overview": landscape.overview_of(facts, spans),
        "trace_shape": landscape.shape_of(traces),
        "composition": landscape.composition(spans),
        "degeneracy": landscape.degeneracy(spans),
        "repeats": landscape.repeats(spans),
        "coverage": landscape.coverage_of(facts),
        "completeness": quality.rates_of(facts, "missing"),
        "correctness": correctness,
        "violations": quality.sums_of(facts, "violation"),
        "contamination": quality.rates_of(facts, "trash"),
        "nulls": quality.sums_of(facts, "null"),
        "distribution": quality.distribution(spans),
        "trace_consistency": quality.consistency_of(traces),
        "flow": flow,
        "traffic": (traffic := landscape.traffic(spans, grain).persist()),
        "mix": landscape.mix(traffic),
        "dialog_share": landscape.dialog_share(traffic),
        "inflow": readiness.inflow_trend(flow),
    }
    return tables, [traces, flow, traffic]


def collect(frames: dict[str, DataFrame]) -> dict[str, list[dict]]:
    out = {}
    for name, frame in frames.items():
        began = time.monotonic()
        out[name] = [r.asDict(recursive=True) for r in frame.collect()]
        log.info("%s: %d rows in %.2f s", name, len(out[name]), time.monotonic() - began)
    return out


def gathered(spans: DataFrame, policy: Params, first: tuple[DataFrame, dict[str, Any]]) -> tuple[dict[str, list[dict]], str]:
    """The rows of all tables after the first pass, and the grain of those over time; nothing stays in memory on the executors."""
    facts, seen = first
    grain = pick_grain(((seen["t1_ns"] or 0) - (seen["t0_ns"] or 0)) / DAY_NS)
    tables, kept = measure(spans, facts, policy, grain)
    try:
        return collect(tables), grain
    finally:
        for frame in kept:
            frame.unpersist()


def evidence(policy: Params, limits: dict[str, int], diff: dict, tables: dict[str, list[dict]]) -> triage.Evidence:
    one = {name: rows[0] for name, rows in tables.items() if len(rows) == 1}
    return triage.Evidence(
        verdict=one["verdict"] | {"valid": triage.within(one["verdict"], limits)},
        shape=one["trace_shape"],
        content=one["degeneracy"],
        coverage=one["coverage"],
        overview=one["overview"],
        rejection=one["rejection"],
        inflow=one["inflow"],
        kinds={r["aef_kind"]: r["n"] for r in tables["composition"]},
        blame=tables["blame"],
        diff=diff,
        policy=policy,
        limits=limits,
    )


def finalize(level: str, scope: str, policy: Params, gates: dict[str, tolerances.Tolerance], diff: dict, tables: dict[str, list[dict]], grain: str) -> dict[str, Any]:
    """The result from the small tables alone, so that tables rolled up elsewhere can be decided on as well."""
    one = {name: rows[0] for name, rows in tables.items() if len(rows) == 1}
    limits = tolerances.resolve(gates, one["overview"]["spans"], one["trace_shape"]["traces"])
    e = evidence(policy, limits, diff, tables)
    ready = [r["verdict"] for r in tables["assess"]]
    problems = triage.problems(e)
    spans, dialogs = e.overview["spans"], e.shape["dialog_traces"] or 0
    states = {r["attr"]: r["state"] for r in diff["rows"]}
    found = {
        "schema": diff,
        "quality": e.verdict,
        "criteria": triage.explained(triage.criteria(e, ready, problems), level, policy, limits),
        "readiness": tables["assess"],
        "metrics": {
            "overview": e.overview,
            "trace_structure": e.shape,
            "content_repetition": e.content,
            "coverage": e.coverage,
            "rejection": e.rejection,
            "trace_consistency": one["trace_consistency"],
            "policy": {"level": level, "scope": scope, "grain": grain} | dict(policy),
            "gates": limits,
            "gates_spec": {k: str(v) for k, v in gates.items()},
            "diagnostic_thresholds": triage.THRESHOLDS,
        },
        "span_distribution": [
            {"aef_kind": k, "priority": severity, "n": (n := e.kinds.get(k, 0)), "share": triage.ratio(n, spans), "present": n > 0, "state": triage.kind_state(k, n, dialogs), "impact": triage.KIND_LOSS.get(k, "")}
            for k, severity in triage.KIND_PRIORITY.items()
        ],
        "attribute_quality": [
            {
                "attr": a.name, "mandatory": a.mandatory, "schema": states[a.name], "missing": one["completeness"][a.name], "violated": one["correctness"][a.name],
                "violations": one["violations"][a.name], "trash": one["contamination"][a.name], "nulls": one["nulls"][a.name], "null_rate": triage.ratio(one["nulls"][a.name], spans),
            }
            for a in SPEC
            if a.name not in ("service_name", "service_version")
        ],
        "problems": triage.as_dicts(problems),
    }
    value = triage.light(scope, e, ready, problems)
    status = {"value": value, "title": triage.title(scope, value, e.verdict["valid"])}
    return {"status": status, "verdict": found, "report_html": report.document(status, found, tables)}


def _stopped(title: str, detail: str) -> dict[str, Any]:
    return {"status": {"value": "red", "title": title}, "verdict": {"error": detail}, "report_html": report.stopped(title, detail)}


def _broken_schema(raw: DataFrame, diff: dict, level: str, policy: Params) -> dict[str, Any]:
    """The result where mandatory columns are absent or of a type that cannot be cast: K1 alone is decided."""
    agent = F.col("agent_id").cast("string") if "agent_id" in raw.columns else F.lit(None).cast("string")
    meta = raw.agg(F.count(F.lit(1)).alias("rows"), F.min(agent).alias("agent"), distinct(agent).alias("agents")).first().asDict()
    title = "schema check failed"
    detail = ", ".join(r["attr"] for r in diff["rows"] if r["mandatory"] and r["state"] in ("absent", "incompatible"))
    found = {"schema": diff, "quality": None, "criteria": triage.explained(triage.only_schema(), level, policy, {}), "readiness": [], "meta": meta}
    return {"status": {"value": "red", "title": title}, "verdict": found, "report_html": report.stopped(title, f"mandatory attributes: {detail}", found)}


def run(spark: SparkSession, spans: Any = None, source_path: str | None = None, significance: str = "C", verdict_scope: str = "full", recast_values: bool | str = True, **given: Any) -> dict[str, Any]:
    """Check a table of spans and decide on it: ``{status: {value, title}, verdict, report_html}``.

    Bad parameters, a missing source, a broken schema and an empty table give a red result that says so; nothing is raised
    for them.
    """
    try:
        level, scope = str(significance).strip().upper(), str(verdict_scope or "full").strip().lower()
        if level not in LEVELS:
            raise ValueError(f"unknown significance level {significance!r}")
        if scope not in SCOPES:
            raise ValueError(f"unknown verdict scope {verdict_scope!r}")
        policy = parameters(level, **tolerances.overrides(given))
        gates = tolerances.parse_gates(given)
        raw = open_spans(spark, spans, source_path)
    except Exception as e:  # noqa: BLE001  the caller gets the reason as a result
        return _stopped("the check could not start", str(e))
    diff = schema_diff(raw, policy["ceiling_penalty"])
    if not diff["critical_ok"]:
        return _broken_schema(raw, diff, level, policy)
    conformed = recast(raw, strict=str(recast_values).strip().lower() in ("true", "1", "yes", "on"))
    first = first_pass(conformed)
    if not first[1]["spans"]:
        return _stopped("there are no spans", "the table is empty")
    return finalize(level, scope, policy, gates, diff, *gathered(conformed, policy, first))


def judged(raw: DataFrame, level: str) -> Callable[[dict[str, object]], tuple[triage.Evidence, list[str]]]:
    """Measures raw spans once; gives the evidence and the verdicts of readiness under any tolerances."""
    policy, diff, conformed = parameters(level), schema_diff(raw), recast(raw)
    tables, _ = gathered(conformed, policy, first_pass(conformed))

    def under(gates: dict[str, object]) -> tuple[triage.Evidence, list[str]]:
        limits = tolerances.resolve(tolerances.parse_gates(gates), tables["overview"][0]["spans"], tables["trace_shape"][0]["traces"])
        return evidence(policy, limits, diff, tables), [r["verdict"] for r in tables["assess"]]

    return under


def problems_frame(spark: SparkSession, raw: DataFrame, level: str, **gates: object) -> DataFrame:
    """The problems of raw spans: name, severity, criteria and whether they affect the verdict."""
    found = triage.problems(judged(raw, level)(gates)[0])
    return spark.createDataFrame([(p.name, p.severity, ",".join(p.criteria), p.affects_verdict) for p in found], "name string, severity string, criteria string, affects_verdict boolean")


def status_frame(spark: SparkSession, raw: DataFrame, level: str, shares: tuple[str, ...] = ("0%", "100%")) -> DataFrame:
    """The light of raw spans in every scope, under each tolerance for all gates."""
    under, rows = judged(raw, level), []
    for share in shares:
        e, ready = under(dict.fromkeys(tolerances.GATES, share))
        found = triage.problems(e)
        for scope in SCOPES:
            value = triage.light(scope, e, ready, found)
            rows.append((share, scope, value, triage.title(scope, value, e.verdict["valid"])))
    return spark.createDataFrame(rows, "tolerance string, scope string, value string, title string")


def criteria_frame(spans: DataFrame, level: str = "E") -> DataFrame:
    """K2 to K6 as rows (code, count, tone) without tolerances, from one plan."""
    policy = parameters(level)
    facts = quality.verdict(spans).crossJoin(quality.rejection(spans).select("dropped", "n"))
    tone = lambda bad, warn: F.when(bad, "bad").when(warn, "warn").otherwise("good")
    none = F.lit(False)
    lines = [
        ("K2", F.col("blocking_rule_violations"), tone(F.col("blocking_rule_violations") > 0, F.col("advisory_rule_violations") > 0)),
        ("K3", F.col("trace_breaks"), tone(F.col("trace_breaks") > 0, none)),
        ("K4", F.col("duplicate_keys"), tone(F.col("duplicate_keys") > 0, none)),
        ("K5", F.col("dropped"), tone(F.col("dropped") / F.col("n") > policy["max_loss"], none)),
        ("K6", F.col("null_violations"), tone(~F.col("valid"), none)),
    ]
    return facts.select(F.explode(F.array(*[F.struct(F.lit(c).alias("code"), n.cast("long").alias("count"), t.alias("tone")) for c, n, t in lines])).alias("x")).select("x.*")


__all__ = ["collect", "criteria_frame", "finalize", "first_pass", "gathered", "measure", "problems_frame", "run", "status_frame"]
