"""Operators on hand-built spans: nulls, edges, types and the invariants that must hold."""

import html
import random
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumenspan.functions import dims as by
from lumenspan.functions.rules import PATTERNS
from lumenspan.functions import scores, stats
from lumenspan.functions.scores import parameters
from lumenspan.functions.stats import GRAINS, bucket, correlation, pick_grain, total, varies
from lumenspan.operators import compare, flags, landscape, quality, readiness, running
from lumenspan.operators.recast import recast, schema_diff
from lumenspan.plans import engine, triage
from lumenspan.plans.gates import Tolerance, overrides
from lumenspan.plans.spec import BY_NAME, INVARIANTS, KINDS, MANDATORY, SPEC, TYPES
from lumenspan.sources.archive import build_archive, encode_archive
from lumenspan.sources.spans import event_spans, open_spans, scan

DAY = 86_400_000_000_000
SCHEMA = T.StructType([T.StructField(a.name, TYPES[a.type]) for a in SPEC])

CLEAN = {
    "trace_id": "T1", "span_id": "S1", "parent_span_id": "root", "origin_span_id": "outside", "agent_id": "CI1", "session_id": "s",
    "start_time_ns": 5 * DAY, "end_time_ns": 5 * DAY + 9, "status_code": "STATUS_CODE_OK", "status_message": "", "aef_kind": "input_request",
    "span_name": "n", "input_text": "{}", "output_text": "", "llm_model": "", "llm_prompt_tokens": -1, "llm_completion_tokens": -1, "llm_total_tokens": -1,
    "llm_precached_prompt_tokens": -1, "llm_temperature": -1.0, "llm_top_p": -1.0, "llm_max_tokens": -1, "llm_repetition_penalty": -1.0,
    "llm_profanity_check": False, "llm_stream": False, "http_method": "GET", "http_path": "/", "http_status_code": 200, "request_headers": "{}",
    "response_headers": "{}", "kafka_topic": "", "kafka_cluster": "", "kafka_consumer_group": "", "kafka_bootstrap_servers": "", "meta_langgraph_step": 0,
    "meta_langgraph_node": "", "meta_langgraph_triggers": "", "meta_langgraph_path": "", "meta_checkpoint_ns": "", "meta_tags": "", "meta_extra": "",
    "service_name": "a", "service_version": "1", "session_id_derived": False, "session_id_generated": True, "nexus_distrib_ver": "1.2.?",
}


def frame(spark, *rows):
    return spark.createDataFrame([Row(**(CLEAN | r)) for r in rows] if rows else [], SCHEMA)


def test_clean_spans_have_no_defect(spark):
    got = quality.verdict(frame(spark, {}, {"span_id": "S2"})).first()
    assert got["valid"] and got["rule_violations"] == 0 and got["null_violations"] == 0
    assert quality.is_valid(frame(spark, {}))


def test_specification_is_complete():
    assert len(SPEC) == 46 and len(MANDATORY) == 13 and set(INVARIANTS) <= set(BY_NAME)
    assert set(triage.KIND_PRIORITY) == set(KINDS)


@pytest.mark.parametrize(
    ("name", "text", "ok"),
    [
        ("base64", "YWJj", True), ("base64", "YWJj\n", False), ("base64", "", False), ("base64", "a===", False),
        ("one_line", "x", True), ("one_line", "x\n", False), ("one_line", "a\rb", True), ("one_line", "", False),
        ("element", "CI12", True), ("element", "CE7", True), ("element", "CX7", False),
        ("version", "1.?.3", True), ("version", "١.2.3", True), ("version", "1.2", False),
        ("json_strings", '["a"]', True), ("json_strings", '[ "a" , "b\\"c" ]', True), ("json_strings", '["a",]', False), ("json_strings", "[]", False),
        ("json", " {x} ", True), ("json", "[1\n2]", True), ("json", "{", False), ("json", "", False),
    ],
)
def test_patterns(spark, name, text, ok):
    assert spark.createDataFrame([(text,)], "t string").select(F.col("t").rlike(PATTERNS[name])).first()[0] is ok


def test_long_json_array_does_not_overflow(spark):
    long = '["' + "x" * 200_000 + '", "y"]'
    assert spark.createDataFrame([(long,)], "t string").select(F.col("t").rlike(PATTERNS["json_strings"])).first()[0]


def test_recast_of_strings_nulls_nested_and_absent(spark):
    raw = spark.createDataFrame(
        [("T", "12.5", " 12 ", "Yes", "maybe", "WEIRD", [1], None), (None, None, None, None, None, None, None, "9")],
        "trace_id string, llm_prompt_tokens string, llm_max_tokens string, llm_stream string, session_id_derived string, status_code string, llm_model array<int>, llm_temperature string",
    )
    one, two = recast(raw).collect()
    assert (one.trace_id, one.llm_prompt_tokens, one.llm_max_tokens, one.llm_stream, one.session_id_derived) == ("T", -2, 12, True, None)
    assert (one.status_code, one.llm_model, one.llm_temperature) == ("TRASH", "", -1.0)
    assert (two.trace_id, two.llm_prompt_tokens, two.status_code, two.llm_temperature, two.parent_span_id) == (None, -1, "STATUS_CODE_UNSET", 9.0, "root")
    assert recast(raw, strict=False).collect()[1].llm_prompt_tokens is None
    assert recast(raw).columns == [a.name for a in SPEC]


def test_recast_is_idempotent(spark, sf):
    once = recast(event_spans(spark, sf))
    assert once.exceptAll(recast(once)).isEmpty()


def test_recast_takes_timestamps_as_nanoseconds(spark):
    raw = spark.sql("SELECT timestamp'1970-01-02' AS start_time_ns")
    assert recast(raw).first().start_time_ns == DAY


def test_schema_states(spark):
    diff = schema_diff(spark.createDataFrame([], "trace_id string, start_time_ns string, llm_model array<string>, other int"))
    states = {r["attr"]: r["state"] for r in diff["rows"]}
    assert (states["trace_id"], states["start_time_ns"], states["llm_model"], states["span_id"]) == ("ok", "converted", "incompatible", "absent")
    assert diff["extra"] == ["other"] and not diff["critical_ok"] and diff["ceiling"] == 0.0
    clean = schema_diff(spark.createDataFrame([], SCHEMA))
    assert clean["counts"] == {"expected": 46, "present": 46, "mandatory": 13, "mandatory_defects": 0, "optional_defects": 0, "extra": 0, "ceiling_percent": 100}
    assert clean["critical_ok"] and not clean["degraded"] and clean["extra"] == []


def test_null_trace_is_one_trace_and_counts_add_up(spark):
    spans = frame(spark, {"trace_id": None}, {"trace_id": None, "agent_id": "x"}, {"trace_id": "T2"})
    got = quality.rejection(spans).first()
    assert (got.n, got.dropped, got.kept) == (2, 1, 1)
    assert [r.rejected for r in quality.tagged(spans).filter("trace_id is null").collect()] == [True, True]


def test_a_trace_with_two_agents_counts_in_each(spark):
    got = quality.rejection(frame(spark, {}, {"span_id": "S2", "agent_id": "CI2", "start_time_ns": -1}), by.agent())
    assert sorted((r.agent_id, r.n, r.dropped) for r in got.collect()) == [("CI1", 1, 1), ("CI2", 1, 1)]


def test_breaks_count_null_as_a_value(spark):
    spans = frame(spark, {}, {"span_id": "S2", "session_id": None}, {"trace_id": "T2", "service_name": None}, {"trace_id": "T2", "span_id": "S2", "service_name": None})
    assert [r.broken for r in quality.breaks(spans).orderBy("trace_id").collect()] == [True, False]
    assert quality.trace_consistency(spans).first().asDict() == {"agent_id": 0, "session_id": 1, "service_name": 0, "service_version": 0, "nexus_distrib_ver": 0}


def test_varies_on_all_null(spark):
    assert spark.createDataFrame([(None,), (None,)], "a int").agg(varies(F.col("a"))).first()[0] is False


def test_duplicate_keys_count_null_parts(spark):
    assert quality.verdict(frame(spark, {"span_id": None}, {"span_id": None}, {})).first().duplicate_keys == 1


def test_trash_sum_skips_rows_with_a_null(spark):
    got = quality.verdict(frame(spark, {"llm_max_tokens": -2}, {"llm_max_tokens": -2, "span_name": None})).first()
    assert got.trash_cells == 1


def test_boolean_in_float_columns_and_nan(spark):
    got = quality.correctness(frame(spark, {"aef_kind": "llm", "llm_model": "m", "llm_temperature": float("nan"), "llm_top_p": float("nan")})).first()
    assert (got.llm_temperature, got.llm_top_p) == (0.0, 1.0)


@pytest.mark.parametrize(("ns", "day"), [(0, 0), (DAY - 1, 0), (DAY, 1), (-2, -1), (1_700_006_399_999_999_999, 19675)])
def test_buckets_at_their_edges(spark, ns, day):
    got = spark.range(1).select(F.unix_seconds(bucket(F.lit(ns).cast("long"), "1d"))).first()[0]
    assert got == day * 86_400


def test_grain_needs_at_most_72_buckets():
    assert [pick_grain(d) for d in (0, 0.05, 0.06, 1, 3, 12, 30, 900)] == ["1m", "1m", "5m", "1h", "1h", "4h", "1d", "1d"]
    assert list(GRAINS.values()) == sorted(GRAINS.values())


def test_correlation_of_a_constant_is_null(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0)], "x double, y double")
    assert df.agg(correlation(F.col("x"), F.col("y"))).first()[0] is None
    assert abs(spark.createDataFrame([(1.0, 5.0), (2.0, 7.0)], "x double, y double").agg(correlation(F.col("x"), F.col("y"))).first()[0] - 1) < 1e-12


def test_assess_with_one_bucket_has_neutral_dynamics(spark):
    got = readiness.assess(frame(spark, {}, {"trace_id": "T2"}), parameters("E")).first()
    assert (got.trend, got.stability, got.worst_rule_attr, got.verdict, got.reason) == (0.0, 1.0, "—", "not_ready", "too few traces")


def test_last_of_equally_bad_rules_is_named(spark):
    got = readiness.assess(frame(spark, {"trace_id": "bad!", "agent_id": "x"}), parameters("E")).first()
    assert (got.worst_rule_attr, got.worst_rule_rate) == ("agent_id", 1.0)


def test_worst_rows_are_mandatory_attributes_of_half_the_spans(spark):
    spans = frame(spark, {"agent_id": "x", "llm_model": "m"}, {"span_id": "S2", "session_id": None, "llm_model": "m"}, {"span_id": "S3", "agent_id": "x", "llm_model": "m"})
    assert [r.attr for r in readiness.worst_rows(readiness.blame(spans)).collect()] == ["agent_id"]


def test_null_agent_comes_first(spark):
    got = readiness.assess(frame(spark, {}, {"trace_id": "T2", "agent_id": None}), parameters("E"), by.agent()).collect()
    assert [r.agent_id for r in got] == [None, "CI1"] and got[0].readiness is None


def test_window_keeps_the_last_days(spark):
    spans = frame(spark, {"start_time_ns": 40 * DAY}, {"start_time_ns": 10 * DAY}, {"start_time_ns": 10 * DAY - 1})
    assert readiness.windowed(spans, 30).count() == 2


def test_version_dims(spark):
    spans = frame(spark, {"nexus_distrib_ver": "2.10.1"}, {"nexus_distrib_ver": "dev"})
    found = {d: sorted((r[0] or "") for r in quality.nulls(spans, by.version(d)).select(f"ver_{d}").collect()) for d in ("major", "minor", "patch")}
    assert found == {"major": ["", "2"], "minor": ["", "2.10"], "patch": ["2.10.1", "dev"]}


def test_profile_leaves_out_its_key(spark):
    assert quality.completeness(frame(spark, {}), by.agent()).columns.count("agent_id") == 1


def test_dynamics_windows(spark):
    spans = frame(spark, *[{"span_id": f"S{i}", "start_time_ns": i, "end_time_ns": i + i} for i in range(12)])
    rows = running.dynamics(spans).orderBy("start_time_ns").collect()
    assert [r.span_seq for r in rows] == list(range(1, 13))
    assert rows[11].duration__cum == 66 and rows[11].duration__mean == 5.5 and rows[11].duration__roll10 == 6.5


def _running(spans, window):
    """What dynamics gives, span by span in plain Python."""
    out, traces = [], {}
    for r in spans.collect():
        traces.setdefault(r.trace_id, []).append(r)
    for rows in traces.values():
        rows.sort(key=lambda r: (r.start_time_ns is not None, r.start_time_ns or 0, r.span_id is not None, r.span_id or ""))
        values = [None if r.start_time_ns is None or r.end_time_ns is None else r.end_time_ns - r.start_time_ns for r in rows]
        for i, (r, v) in enumerate(zip(rows, values)):
            near = [x for x in values[max(0, i + 1 - window) : i + 1] if x is not None]
            out.append((r.trace_id, r.span_id, sum(x.span_id is not None for x in rows[: i + 1]), None if v is None else sum(x for x in values[: i + 1] if x is not None), round(sum(near) / len(near), 6) if near else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize(("window", "size"), [(10, 1_000_000), (10, 40), (4, 7), (3, 1)])
def test_long_traces_are_scanned_in_blocks(spark, window, size):
    rng = random.Random(size)
    rows = [{"trace_id": rng.choice(["T", "T", "T", "U", None]), "span_id": f"S{i:03d}", "start_time_ns": rng.choice([i * i, i * i, 5]), "end_time_ns": rng.choice([i * i + rng.randint(0, 9), i * i, None])} for i in range(300)]
    rows += [{"trace_id": f"V{i // 3}", "span_id": f"S{i}", "start_time_ns": i, "end_time_ns": 2 * i} for i in range(90)]
    rows += [{"trace_id": "T", "span_id": f"X{i}", "start_time_ns": None} for i in range(3)]
    spans = frame(spark, *rows).cache()
    got = running.dynamics(spans, window, size).select("trace_id", "span_id", "span_seq", "duration__cum", F.round(f"duration__roll{window}", 6)).collect()
    assert sorted(map(tuple, got), key=repr) == _running(spans, window)


def test_no_task_of_a_scan_holds_a_long_trace(spark):
    spans = frame(spark, *[{"trace_id": "T" if i % 3 == 0 else f"V{i % 40}", "span_id": f"S{i}", "start_time_ns": 7 * i, "end_time_ns": 8 * i} for i in range(1200)])
    placed = running.blocks(spans, running.long_traces(spans, 50), 50)
    held = {r.trace_id: r for r in placed.groupBy("trace_id", "_block").count().groupBy("trace_id").agg(F.count("*").alias("blocks"), F.max("count").alias("most")).collect()}
    assert held["T"].blocks >= 8 and held["T"].most <= 50 + 400 / running.SLOTS + 1 and all(r.blocks == 1 and r.most <= 50 for t, r in held.items() if t != "T")
    plan = _plan(running.dynamics(spans, size=50))
    windows = [line for line in plan.splitlines() if "Window " in line and "start_time_ns" in line]
    assert windows and all("_block" in line for line in windows)


def test_readiness_meets_cells_and_skips_old_spans(spark, sf, tmp_path):
    spans = recast(event_spans(spark, sf))
    path = str(tmp_path / "spans")
    spans.write.parquet(path)
    plan = _plan(readiness.assess(spark.read.parquet(path), parameters("E"), by.agent()))
    assert "Expand" not in plan and "GreaterThanOrEqual(start_time_ns" in plan
    joins = [line for line in plan.splitlines() if "Join" in line]
    assert len(joins) == 1 and "_over" in joins[0]


def test_unknown_kind_is_last_and_null_first(spark):
    got = landscape.composition(frame(spark, {"aef_kind": "TRASH"}, {"aef_kind": None}, {"aef_kind": "guard"}, {"aef_kind": "llm"})).collect()
    assert [r.aef_kind for r in got] == [None, "llm", "guard", "TRASH"] and sum(r.share for r in got) == 1.0


def test_operators_on_no_spans(spark):
    none = frame(spark)
    assert quality.verdict(none).first()["valid"] and landscape.overview(none).first().spans == 0
    assert landscape.trace_shape(none).first().traces == 0 and quality.flow(none, "1d").isEmpty() and readiness.blame(none).isEmpty()


@pytest.mark.parametrize(("given", "rows", "count"), [(None, 9, 0), ("5", 9, 5), ("0.1%", 1001, 2), ("0.1 %", 1000, 1), ("100%", 7, 7), (3, 9, 3)])
def test_tolerances(given, rows, count):
    assert Tolerance.parse(given).count(rows) == count


@pytest.mark.parametrize("given", ["0.1", "101%", "-1", "x"])
def test_bad_tolerances(given):
    with pytest.raises(ValueError):
        Tolerance.parse(given)


def test_policy_levels_and_overrides():
    assert parameters("A")["min_eff_traces"] == 1e6 and parameters("E", **overrides({"max_loss": "0.1", "ready_at": ""}))["max_loss"] == 0.1
    with pytest.raises(ValueError):
        parameters("Z")
    with pytest.raises(ValueError):
        parameters("A", nothing=1)


def test_scores_stay_in_their_range(spark):
    policy = parameters("C")
    df = spark.createDataFrame([(0.0, 0.0, -1.0), (1e12, 1.0, 1.0)], "n double, q double, t double")
    low, high = df.select(scores.volume_score(policy, F.col("n")), scores.accel_score(policy, F.col("t"), F.col("q"), F.col("n")), scores.quality_product(policy, validity=F.col("q"), presence=F.col("q"), retention=F.col("q"))).collect()
    assert all(0 <= x <= 1 for r in (low, high) for x in r) and high[0] > 0.99 and low[0] < 0.01


def test_engine_results(spark, tmp_path):
    spans = frame(spark, *[{"trace_id": f"T{i}", "start_time_ns": i * DAY // 4, "end_time_ns": i * DAY // 4 + 1} for i in range(8)])
    path = str(tmp_path / "spans")
    spans.write.parquet(path)
    got = engine.run(spark, source_path=path, significance=" e ", verdict_scope="Quality")
    assert got["verdict"]["quality"]["valid"] and set(got["verdict"]["criteria"]) == set(triage.CRITERIA)
    assert len(got["verdict"]["attribute_quality"]) == 44 and len(got["verdict"]["span_distribution"]) == 11
    assert got["status"] == {"value": "green", "title": "quality is confirmed"} and "<svg" in got["report_html"]
    assert {p["name"] for p in got["verdict"]["problems"]} >= {"single_spans", "dominant_pair", "no_llm", "no_guard"} and not any(p["affects_verdict"] for p in got["verdict"]["problems"])
    for text in ("Share of dialog spans", "No mandatory attribute is violated", 'id="criterion-k8"', 'href="#criterion-k8"', triage.KIND_LOSS["llm"]):
        assert text in got["report_html"]
    assert all(v["breach"] and v["source"] and v["breach"] in html.unescape(got["report_html"]) for v in got["verdict"]["criteria"].values())
    for title in ("Traces", "Validity and defects", "Spans of dialogs and of other traces", "Share of dialog spans", "Rate of errors"):
        assert f"<h3>{title}</h3><svg" in got["report_html"]
    assert got["report_html"].count("<rect") == 8 and 'class="mean"' in got["report_html"] and "correlation with time" in got["report_html"]
    assert scan(spark, path).count() == 8
    strict = engine.run(spark, spans.withColumn("agent_id", F.lit("x")), significance="E", max_rules="100%")
    assert strict["verdict"]["criteria"]["K2"]["tone"] == "warn" and strict["status"] == {"value": "red", "title": "not ready for monitoring"}
    assert "agent_id: 8 of 8 spans (100.0%)" in strict["report_html"] and 'href="#rule-agent_id"' in strict["report_html"]


def test_no_job_asks_for_bounds_or_emptiness_alone(spark, monkeypatch):
    monkeypatch.setattr(landscape, "bounds", None)
    monkeypatch.setattr(engine.DataFrame, "isEmpty", None)
    spans = frame(spark, {}, {"end_time_ns": 6 * DAY})
    facts, seen = engine.first_pass(spans)
    assert (seen["spans"], seen["t0_ns"], seen["t1_ns"]) == (2, 5 * DAY, 6 * DAY) and "Aggregate" not in _plan(quality.rates_of(facts, "missing"))
    assert engine.run(spark, spans)["verdict"]["metrics"]["policy"]["grain"] == pick_grain(1.0)
    assert engine.run(spark, spans.limit(0))["status"]["title"] == "there are no spans"


def test_mix_and_share_of_traffic(spark):
    traffic = landscape.traffic(frame(spark, {}, {"trace_id": "T2", "aef_kind": "llm"}, {"trace_id": "T2", "aef_kind": "tool"}, {"trace_id": "T3", "aef_kind": "llm", "start_time_ns": None}), "1d")
    got = sorted((r.ts is None, r.traces, r.n) for r in landscape.mix(traffic).collect())
    assert got == [(False, "dialog", 1), (False, "other", 2), (True, "dialog", 0), (True, "other", 1)]
    assert sorted(r.dialog_share for r in landscape.dialog_share(traffic).collect()) == [0.0, pytest.approx(1 / 3)]
    assert landscape.mix(traffic.limit(0)).isEmpty() and landscape.dialog_share(traffic.limit(0)).isEmpty()


def test_engine_never_raises_for_bad_input(spark):
    assert engine.run(spark)["status"] == {"value": "red", "title": "the check could not start"}
    empty = engine.run(spark, frame(spark))
    assert empty["status"]["title"] == "there are no spans" and empty["verdict"] == {"error": "the table is empty"}
    broken = engine.run(spark, frame(spark, {}, {"agent_id": None}).drop("trace_id"))
    assert broken["verdict"]["meta"] == {"rows": 2, "agent": "CI1", "agents": 2} and broken["verdict"]["quality"] is None
    assert [v["result"] for v in broken["verdict"]["criteria"].values()] == ["violated"] + ["not computed"] * 7
    assert engine.run(spark, frame(spark, {}).drop("agent_id"))["verdict"]["meta"]["agents"] == 1
    assert engine.run(spark, frame(spark, {}), max_nulls="0.5")["status"]["value"] == "red"
    assert engine.run(spark, frame(spark, {}), verdict_scope="none")["status"]["value"] == "red"


def evidence(**changes):
    """Evidence without any problem, with some of its rows changed."""
    rows = {
        "verdict": {"null_violations": 0, "blocking_rule_violations": 0, "duplicate_keys": 0, "trace_breaks": 0, "advisory_rule_violations": 0, "valid": True},
        "shape": {"traces": 100, "singles": 0, "single_share": 0.0, "dialog_share": 1.0, "dialog_traces": 100},
        "content": {"dominant_n": 1, "dominant_share": 0.001},
        "coverage": {"http_spans": 100, "http_gap": 0, "llm_spans": 100, "llm_no_model": 0, "llm_no_tokens": 0},
        "overview": {"spans": 1000, "unique_records": 1000},
        "rejection": {"dropped": 0, "kept": 100},
        "inflow": {"buckets": 10, "trend": 0.0},
        "kinds": dict.fromkeys(KINDS, 100),
        "diff": {"critical_ok": True, "degraded": False, "counts": {"optional_defects": 0, "extra": 0}},
    }
    policy, limits, blame = parameters("E"), dict.fromkeys(("max_nulls", "max_rules", "max_dups", "max_breaks"), 0) | changes.pop("limits", {}), changes.pop("blame", [])
    return triage.Evidence(**{k: v | changes.get(k, {}) for k, v in rows.items()}, blame=blame, policy=policy, limits=limits)


BLAMED = [{"attr": "span_id", "violation_rate": 0.5}, {"attr": "trace_id", "violation_rate": 0.5}, {"attr": "llm_model", "violation_rate": 0.9}, {"attr": "agent_id", "violation_rate": 0.1}]


@pytest.mark.parametrize(
    ("changes", "name", "severity", "criteria"),
    [
        ({"shape": {"single_share": 0.9, "singles": 90}}, "single_spans", "critical", "K8"),
        ({"shape": {"dialog_share": 0.049, "dialog_traces": 4}}, "few_dialogs", "critical", "K8"),
        ({"content": {"dominant_share": 0.5, "dominant_n": 500}}, "dominant_pair", "critical", "K8"),
        *(({"kinds": {k: 0}}, f"no_{k}", triage.KIND_PRIORITY[k], "K8") for k in KINDS if k != "input_request"),
        ({"kinds": {"llm": 99}}, "few_llm", "important", "K8"),
        ({"coverage": {"http_gap": 50}}, "http_gap", "moderate", "K2"),
        ({"coverage": {"llm_no_model": 50}}, "llm_gap", "moderate", "K2"),
        ({"rejection": {"dropped": 61, "kept": 39}}, "rejection", "critical", "K5"),
        ({"blame": BLAMED}, "worst_attributes", "important", "K2"),
        ({"blame": BLAMED[2:], "verdict": {"blocking_rule_violations": 100}}, "blocking", "important", "K2"),
        ({"verdict": {"duplicate_keys": 1}, "limits": {"max_dups": 9}}, "duplicates", "important", "K4"),
        ({"verdict": {"trace_breaks": 1}, "limits": {"max_breaks": 9}}, "breaks", "important", "K3"),
        ({"verdict": {"null_violations": 1}}, "nulls", "important", "K6"),
        ({"diff": {"degraded": True, "counts": {"optional_defects": 2, "extra": 1}}}, "schema", "moderate", "K1"),
        ({"inflow": {"trend": -0.31}}, "inflow", "moderate", "K7"),
    ],
)
def test_each_rule_finds_its_problem_alone(changes, name, severity, criteria):
    (found,) = triage.problems(evidence(**changes))
    assert (found.name, found.severity, found.criteria, found.affects_verdict) == (name, severity, (criteria,), criteria != "K8")
    assert found.detail and found.impact and found.action


@pytest.mark.parametrize(
    "changes",
    [
        {}, {"kinds": {"input_request": 0}}, {"shape": {"single_share": 0.89}}, {"coverage": {"http_gap": 49, "llm_no_model": 49, "llm_no_tokens": 100}}, {"rejection": {"dropped": 60, "kept": 40}},
        {"verdict": {"null_violations": 5, "blocking_rule_violations": 5, "advisory_rule_violations": 70}, "blame": BLAMED[2:], "limits": {"max_nulls": 5, "max_rules": 5}},
        {"inflow": {"trend": None}}, {"inflow": {"trend": -0.9, "buckets": 4}}, {"kinds": {"llm": 100, "TRASH": 4}},
    ],
)
def test_no_rule_finds_what_is_in_order(changes):
    assert triage.problems(evidence(**changes)) == []


def test_worst_attributes_are_one_problem_in_order():
    (found,) = triage.problems(evidence(blame=BLAMED))
    assert found.attributes == ("span_id", "trace_id") and found.detail == "span_id: 500 of 1,000 spans (50.0%); trace_id: 500 of 1,000 spans (50.0%)"
    assert [p.name for p in triage.problems(evidence(blame=BLAMED, kinds={"llm": 0, "guard": 0}, rejection={"dropped": 90, "kept": 10}))] == ["rejection", "no_llm", "worst_attributes", "no_guard"]


@pytest.mark.parametrize(
    ("changes", "readiness", "full", "quality"),
    [
        ({}, ["ready"], "green", "green"),
        ({}, ["ready", "pilot"], "amber", "green"),
        ({}, ["not_ready"], "red", "green"),
        ({}, [], "red", "green"),
        ({"kinds": {"llm": 0, "start_agent": 0}}, ["ready"], "green", "green"),
        ({"coverage": {"http_gap": 50}}, ["ready"], "amber", "amber"),
        ({"inflow": {"trend": -0.5}}, ["ready"], "amber", "green"),
        ({"diff": {"degraded": True}}, ["ready"], "amber", "amber"),
        ({"verdict": {"advisory_rule_violations": 1}}, ["ready"], "amber", "amber"),
        ({"verdict": {"blocking_rule_violations": 60}, "limits": {"max_rules": 100}, "blame": [{"attr": "agent_id", "violation_rate": 0.6}]}, ["ready"], "amber", "amber"),
        ({"verdict": {"blocking_rule_violations": 101}, "limits": {"max_rules": 100}}, ["ready"], "red", "red"),
        ({"verdict": {"trace_breaks": 1}}, ["ready"], "red", "red"),
        ({"rejection": {"dropped": 70, "kept": 30}}, ["ready"], "red", "red"),
    ],
)
def test_light(changes, readiness, full, quality):
    e = evidence(**changes)
    assert [triage.light(scope, e, readiness, triage.problems(e)) for scope in ("full", "quality")] == [full, quality]


def test_titles_and_tones():
    assert [triage.title("full", v, valid) for v, valid in (("green", True), ("amber", True), ("red", True), ("red", False))] == ["ready for monitoring", "ready with remarks", "not ready for monitoring", "quality checks failed"]
    e = evidence(verdict={"blocking_rule_violations": 3, "duplicate_keys": 1}, limits={"max_rules": 5}, kinds={"guard": 0})
    tones = {k: v["tone"] for k, v in triage.criteria(e, ["pilot"], triage.problems(e)).items()}
    assert tones == {"K1": "good", "K2": "warn", "K3": "good", "K4": "bad", "K5": "good", "K6": "bad", "K7": "warn", "K8": "muted"}


def test_rejection_over_a_computed_key_and_with_another_aggregate(spark):
    spans = frame(spark, {"trace_id": "T1", "session_id": "a1"}, {"trace_id": "T2", "session_id": "a2", "agent_id": "x"}, {"trace_id": "T3", "session_id": "b1"})
    family = by.Dim("family", F.substring("session_id", 1, 1))
    got = quality.rejection(spans, over=family, agg=total).first()
    assert (got.n, got.dropped_rate, got.dropped, got.kept) == (2, 1, 1, 1)
    assert sorted((r.trace_id, r.rejected) for r in quality.tagged(spans, family).collect()) == [("T1", True), ("T2", True), ("T3", False)]


@pytest.mark.parametrize(("margin", "sketch"), [(0.0027, 8192), (0.05, 200), (0.0, 8)])
def test_quantiles_equal_the_exact_aggregate(spark, monkeypatch, margin, sketch):
    monkeypatch.setattr(stats, "MARGIN", margin)  # the last pair spoils the sketch, so that brackets miss their places
    monkeypatch.setattr(stats, "SKETCH", sketch)
    df = spark.range(20_000).select((F.col("id") % 3).alias("k"), F.when(F.col("id") % 7 > 0, F.pow(F.rand(1) * 10, F.lit(3)).cast("long")).alias("a"), (F.rand(2) * 1e15).cast("long").alias("b"), F.lit(None).cast("long").alias("none"))
    df = df.withColumn("k", F.nullif("k", F.lit(2))).cache()
    levels, signals = (0.0, 0.25, 0.5, 0.95, 1.0), {c: F.col(c) for c in ("a", "b", "none")}
    for keys in ([], [F.col("k")]):
        got = sorted((r.asDict() for r in stats.quantiles(df, keys, signals, levels).collect()), key=lambda r: (r.get("k") is None, r.get("k")))
        want = df.groupBy(*keys).agg(*[F.percentile(c, F.array(*map(F.lit, levels))).alias(c) for c in signals]).collect()
        for g, w in zip(got, sorted(want, key=lambda r: (r.asDict().get("k") is None, r.asDict().get("k")))):
            assert [g[f"{c}__q{round(q * 100):02d}"] for c in ("a", "b") for q in levels] == pytest.approx([*w.a, *w.b], rel=1e-12) and g["none__q50"] is None
    assert stats.quantiles(df.limit(0), [], signals, levels).first().a__q50 is None


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans_hold_no_map_of_values_and_ship_no_texts(spark, sf):
    spans = recast(event_spans(spark, sf))
    assert "percentile(" not in _plan(quality.distribution(spans)) + _plan(landscape.trace_shape(spans))
    assert "Window" not in _plan(quality.tagged(spans))
    for found in (landscape.overview(spans), landscape.degeneracy(spans), landscape.repeats(spans)):
        moved = [line for line in _plan(found).splitlines() if "Exchange" in line]
        assert moved and not any("input_text" in line and "distinct" not in line for line in moved if "hashpartitioning(aef_kind" not in line)


def test_digests_tell_nulls_and_boundaries_apart(spark):
    rows = [("a", None), (None, "a"), ("a", ""), ("", "a"), ("ab", "c"), ("a", "bc"), (None, None), ("a", None)]
    assert spark.createDataFrame(rows, "x string, y string").select(stats.digest(F.col("x"), F.col("y"))).distinct().count() == 7


def test_handed_over_spans_win_over_a_path(spark):
    assert open_spans(spark, frame(spark, {}), "/nowhere").count() == 1
    assert open_spans(spark, frame(spark, {}).toPandas().iloc[:, :3]).count() == 1


def test_archive_depends_on_contents_only(tmp_path):
    for d in ("a", "b"):
        (tmp_path / d).mkdir()
        (tmp_path / d / "x.py").write_text("1")
    one, two = build_archive(tmp_path / "a"), build_archive(tmp_path / "b")
    assert one == two and len(encode_archive(one)["sha256"]) == 64


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["T1", "T2", None]), st.sampled_from(["CI1", "x", None]), st.sampled_from([*KINDS[:4], "TRASH", None])), min_size=1, max_size=8))
def test_counts_add_up(spark, rows):
    spans = frame(spark, *[{"trace_id": t, "agent_id": a, "aef_kind": k, "span_id": f"S{i}"} for i, (t, a, k) in enumerate(rows)])
    got, rejected = quality.verdict(spans).first(), quality.rejection(spans).first()
    assert rejected.n == rejected.dropped + rejected.kept == landscape.overview(spans).first().traces
    assert landscape.composition(spans).agg(F.sum("n")).first()[0] == len(rows) >= got.blocking_rule_violations
    assert got.trace_breaks <= rejected.n


def test_tables_are_compared_without_order_and_with_counts(spark):
    rows = [(1, "a", 0.1), (1, "a", 0.1), (2, None, None), (3, "", float("nan"))]
    left = spark.createDataFrame(rows, "x int, y string, z double")
    assert compare.equal(left, left.orderBy(F.desc("x")).withColumn("z", F.col("z") + 1e-9))
    assert compare.differences(left, left.orderBy("y")).isEmpty()
    right = spark.createDataFrame([(1, "a", 0.1), (2, "", None), (3, "", float("nan")), (4, "b", 2.0), (4, "b", 2.0)], left.schema)
    assert not compare.equal(left, right) and not compare.equal(left, right.select("y", "x", "z"))
    got = {(r.side, r.times, r.x, r.y) for r in compare.differences(left, right).collect()}
    assert got == {("left", 1, 1, "a"), ("left", 1, 2, None), ("right", 1, 2, ""), ("right", 2, 4, "b")}
    assert compare.equal(left.limit(0), right.limit(0)) and compare.differences(left.limit(0), right.limit(0)).isEmpty()


def test_strict_json(spark):
    texts = ['{"k": 1}', " [1, null] ", '{"k": }', "{]", "[1,]", "", "null", "1", None, "{}}", "1, 2", "1] , [2", '1}, {"x": 2', '1, "y": 2']
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(flags.is_json(F.col("t"))).collect()
    assert [r[0] for r in got] == [True, True, False, False, False, False, True, True, None, *[False] * 5]


def test_columns_that_nobody_reads_of_differences_are_not_gathered(spark):
    left = spark.createDataFrame([(1, "a", 0.5), (1, "a", 0.5), (2, None, 1.5)], "x int, wide string, z double")
    found = compare.differences(left, left.filter("x = 2")).groupBy("side", "x").agg(F.sum("times").alias("times"))
    gathered = re.findall(r"min\((\w+)", found._jdf.queryExecution().optimizedPlan().toString())
    assert gathered and all("x" in c for c in gathered)
    assert [tuple(r) for r in found.collect()] == [("left", 1, 2)]
