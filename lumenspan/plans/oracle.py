"""The span queries in DuckDB's SQL, written apart from the operators; only the attributes and their rules are shared."""

from __future__ import annotations

from lumenspan.functions.rules import DUCKDB
from lumenspan.plans.spec import SPEC
from lumenspan.sources.spans import EVENT_SPANS

_LONG, _TEXT = "BIGINT", "VARCHAR"
_TYPES = {"string": _TEXT, "long": _LONG, "float": "FLOAT", "boolean": "BOOLEAN"}

#: name: (type or categories, empty literal or None, mandatory, rule); the rules are the specification's trees
COLUMNS = {a.name: (a.domain or _TYPES[a.type], None if a.empty is None else DUCKDB.value(a.empty), a.mandatory, a.rule.sql(a.name, DUCKDB)) for a in SPEC}
NAMES = list(COLUMNS)
MANDATORY = [n for n, (_, _, m, _) in COLUMNS.items() if m]
_ENUM_TRASH = {_TEXT: "'TRASH'", _LONG: "-2", "FLOAT": "-2.0"}


def _type(kind: object) -> str:
    return _TEXT if isinstance(kind, tuple) else str(kind)


def _cast(name: str, kind: object) -> str:
    if isinstance(kind, tuple):
        return f"CASE WHEN {name} IN ({', '.join(f"'{v}'" for v in kind)}) THEN {name} END"
    if kind == "BOOLEAN":
        token = f"lower(trim({name}::VARCHAR))"
        return f"CASE WHEN {token} IN ('true', 't', '1', 'yes', 'y') THEN true WHEN {token} IN ('false', 'f', '0', 'no', 'n') THEN false END"
    if kind == _LONG:  # a string with a fraction is no whole number
        return f"CASE WHEN regexp_matches(trim({name}::VARCHAR), '^[-+]?[0-9]+$') THEN TRY_CAST(trim({name}::VARCHAR) AS BIGINT) END"
    return f"TRY_CAST({name} AS {kind})"


def _conformed(strict: bool) -> str:
    out = []
    for name, (kind, empty, _, _) in COLUMNS.items():
        lit = f"CAST({empty or 'NULL'} AS {_type(kind)})"
        if name not in EVENT_SPANS:
            out.append(f"{lit} AS {name}")
        elif strict:
            bad = _ENUM_TRASH.get(_type(kind), lit)
            out.append(f"CASE WHEN {name} IS NOT NULL AND ({_cast(name, kind)}) IS NULL THEN CAST({bad} AS {_type(kind)}) ELSE coalesce({_cast(name, kind)}, {lit}) END AS {name}")
        else:
            out.append(f"{_cast(name, kind)} AS {name}")
    return f"SELECT {', '.join(out)} FROM raw"


def _spans(strict: bool = True) -> str:
    raw = ", ".join(f"{e.format(us='epoch_us(ts)').replace('AS string', 'AS VARCHAR')} AS {name}" for name, e in EVENT_SPANS.items())
    return f"raw AS (SELECT {raw} FROM events), s AS ({_conformed(strict)})"


def violated(name: str) -> str:
    return f"coalesce(NOT ({name} IS NOT NULL AND ({COLUMNS[name][3]})), true)"


def missing(name: str) -> str:
    empty = COLUMNS[name][1]
    return f"({name} IS NULL" + (f" OR {name} = {empty})" if empty else ")")


def trash(name: str) -> str:
    kind = _type(COLUMNS[name][0])
    return "false" if kind == "BOOLEAN" else f"{name} = {_ENUM_TRASH[kind]}"


def _sum(flag, names: list[str]) -> str:
    return " + ".join(f"({flag(n)})::INT" for n in names)


BLOCKING = " OR ".join(f"({violated(n)})" for n in MANDATORY)
#: Spans with the rejection of their trace, sums of flags, and time buckets.
WITH = f"""WITH {_spans()},
f AS (
  SELECT s.*, bool_or({BLOCKING}) OVER (PARTITION BY trace_id) AS rejected,
         (bool_or(aef_kind = 'input_request') OVER (PARTITION BY trace_id)) IS TRUE AS dialog,
         ({_sum(violated, MANDATORY)})::DOUBLE / {len(MANDATORY)} AS v_share, ({_sum(violated, NAMES)})::DOUBLE / {len(NAMES)} AS a_share,
         ({_sum(lambda n: f"{n} IS NULL", MANDATORY)})::DOUBLE / {len(MANDATORY)} AS n_share,
         make_timestamp((start_time_ns - (start_time_ns % 86400000000000)) // 1000)::TIMESTAMP AS day,
         make_timestamp((start_time_ns - (start_time_ns % 14400000000000)) // 1000)::TIMESTAMP AS four
  FROM s)
"""


def profile(flag, agg: str, keys: str = "", skip: tuple[str, ...] = ()) -> str:
    cells = ", ".join(f"{agg.format(f'({flag(n)})')} AS {n}" for n in NAMES if n not in skip)
    return f"{WITH} SELECT {keys + ', ' if keys else ''}count(*) AS n, {cells} FROM f{' GROUP BY ALL' if keys else ''}"


MEAN, SUM = "round(avg(({})::INT::DOUBLE), 9)", "coalesce(sum(({})::INT), 0)::BIGINT"
DISTINCT = "(count(DISTINCT {0}) + max(({0} IS NULL)::INT))::BIGINT"
_INVARIANTS = ("agent_id", "session_id", "service_name", "service_version", "nexus_distrib_ver")


def _broken() -> str:
    return f"SELECT trace_id, count(*) AS spans, {', '.join(f'{DISTINCT.format(c)} AS {c}' for c in _INVARIANTS)} FROM f GROUP BY trace_id"


def _assess(key: str) -> str:
    keyed = f"{key}, " if key else ""
    by = f"GROUP BY {key}" if key else ""
    rates = [f"avg(({violated(n)})::INT::DOUBLE)" for n in MANDATORY]
    pairs = ", ".join(f"{{'n': '{n}', 'v': {r}, 'i': {i}}}" for i, (n, r) in enumerate(zip(MANDATORY, rates)))
    join = f"LEFT JOIN a USING ({key})" if key else ", a"
    return f"""
{WITH},
w AS (SELECT * FROM f WHERE start_time_ns >= (SELECT max(start_time_ns) FROM f) - 30 * 86400000000000),
c AS (
  SELECT {keyed}{DISTINCT.format('trace_id')} AS traces,
         (count(DISTINCT CASE WHEN NOT rejected THEN trace_id END) + max((NOT rejected AND trace_id IS NULL)::INT))::BIGINT AS eff_traces,
         1 - avg(v_share) AS validity, 1 - avg(n_share) AS presence, avg((NOT rejected)::INT::DOUBLE) AS retention,
         list_reduce([{pairs}], lambda x, y: CASE WHEN y.v >= x.v THEN y ELSE x END) AS worst
  FROM w {by}),
b AS (SELECT {keyed}day, {DISTINCT.format('trace_id')} AS b_traces, 1 - avg(v_share) AS b_validity FROM w GROUP BY ALL),
a AS (
  SELECT {keyed}avg(b_traces) AS rate,
         CASE WHEN count(DISTINCT b_traces) > 1 AND count(DISTINCT day) > 1 THEN corr(epoch(day), b_traces) ELSE 0 END AS trend,
         greatest(least(coalesce(1 - stddev_samp(b_validity) / 0.25, 1), 1), 0) AS stability
  FROM b {by}),
m AS (
  SELECT {keyed}traces, eff_traces, 1 - eff_traces / traces AS loss_rate, worst.v AS worst_rule_rate, CASE WHEN worst.v > 0 THEN worst.n ELSE '—' END AS worst_rule_attr,
         validity, presence, retention, 1 / (1 + exp(-1.5 * (log10(eff_traces + 1) - 3))) AS volume_score, 0.4 * validity + 0.2 * presence + 0.4 * retention AS quality_score,
         rate, trend, stability, 0.4 / (1 + exp(-2 * trend)) + 0.4 * stability + 0.2 * (1 - exp(-rate / 10)) AS accel_score
  FROM c {join}),
r AS (SELECT *, 0.4 * volume_score + 0.4 * quality_score + 0.2 * accel_score AS readiness FROM m),
g AS (SELECT *, eff_traces >= 100 AND loss_rate <= 0.6 AND quality_score >= 0.5 AS gated FROM r)
SELECT {keyed}traces, eff_traces, {', '.join(f'round({x}, 9) AS {x}' for x in ('loss_rate', 'worst_rule_rate'))}, worst_rule_attr,
       {', '.join(f'round({x}, 9) AS {x}' for x in 'validity presence retention volume_score quality_score rate trend stability accel_score readiness'.split())},
       CASE WHEN gated AND readiness >= 0.4 THEN 'ready' WHEN gated AND readiness >= 0.25 THEN 'pilot' ELSE 'not_ready' END AS verdict,
       CASE WHEN eff_traces < 100 THEN 'too few traces' WHEN loss_rate > 0.6 THEN 'rejection above the limit; most violated: ' || worst_rule_attr
            WHEN quality_score < 0.5 THEN 'quality below the limit; most violated: ' || worst_rule_attr WHEN trend < 0 THEN 'inflow is falling'
            WHEN readiness >= 0.4 THEN 'ready for monitoring' WHEN readiness >= 0.25 THEN 'candidate for a pilot' ELSE 'still gathering data' END AS reason
FROM g"""


def _rejection(keys: str) -> str:
    comma = f", {keys}" if keys else ""
    return f"""{WITH}, t AS (SELECT trace_id{comma}, bool_or(rejected) AS rejected FROM f GROUP BY ALL)
SELECT {keys + ', ' if keys else ''}count(*) AS n, round(avg(rejected::INT::DOUBLE), 9) AS dropped_rate, sum(rejected::INT)::BIGINT AS dropped, sum((NOT rejected)::INT)::BIGINT AS kept FROM t{' GROUP BY ALL' if keys else ''}"""


_QUANTILES = {n: (f"CASE WHEN {n} <> {e} THEN {n} END" if e else n) for n, (k, e, _, _) in COLUMNS.items() if k in (_LONG, "FLOAT")} | {"duration_ns": "end_time_ns - start_time_ns"}
_SIGNALS = {"missing": _sum(missing, NAMES), "invalid": _sum(violated, NAMES), "duration": "end_time_ns - start_time_ns", "error": "(status_code = 'STATUS_CODE_ERROR')::INT"}
_TRACE = "PARTITION BY trace_id ORDER BY start_time_ns NULLS FIRST, span_id NULLS FIRST ROWS BETWEEN"

ORACLES = {
    "span_recast": f"WITH {_spans()} SELECT * FROM s",
    "span_cast_only": f"WITH {_spans(False)} SELECT * FROM s",
    "span_completeness": profile(missing, MEAN),
    "span_completeness_by_agent": profile(missing, MEAN, "agent_id", ("agent_id",)),
    "span_correctness": profile(violated, MEAN),
    "span_correctness_by_day": profile(violated, MEAN, "day AS ts"),
    "span_violations_by_version": profile(violated, SUM, r"nullif(regexp_extract(nexus_distrib_ver, '^(\d+\.\d+)', 1), '') AS ver_minor"),
    "span_contamination": profile(trash, MEAN),
    "span_nulls": profile(lambda n: f"{n} IS NULL", SUM),
    "span_distribution": f"{WITH} SELECT count(*) AS n, {', '.join(f'round(quantile_cont(({e})::DOUBLE, {q}), 6) AS {n}__q{int(q * 100):02d}' for n, e in _QUANTILES.items() for q in (0.25, 0.5, 0.75, 0.9, 0.95))} FROM f",
    "span_verdict": f"""{WITH}, b AS ({_broken()}), k AS (SELECT count(*) AS n FROM f GROUP BY trace_id, span_id)
SELECT sum({_sum(lambda n: f'{n} IS NULL', MANDATORY)})::BIGINT AS null_violations, sum({_sum(missing, NAMES)})::BIGINT AS missing, sum({_sum(trash, NAMES)})::BIGINT AS trash_cells,
       sum({_sum(violated, NAMES)})::BIGINT AS rule_violations, greatest({', '.join(f'sum(({violated(n)})::INT)' for n in MANDATORY)})::BIGINT AS blocking_rule_violations,
       sum({_sum(violated, [n for n in NAMES if n not in MANDATORY])})::BIGINT AS advisory_rule_violations, (SELECT sum(n - 1) FROM k)::BIGINT AS duplicate_keys,
       (SELECT count(*) FROM b WHERE {' OR '.join(f'{c} > 1' for c in _INVARIANTS)})::BIGINT AS trace_breaks, false AS valid FROM f""",
    "span_criteria": f"""{WITH}, b AS ({_broken()}), k AS (SELECT count(*) AS n FROM f GROUP BY trace_id, span_id), t AS (SELECT trace_id, bool_or(rejected) AS bad FROM f GROUP BY trace_id),
v AS (SELECT greatest({', '.join(f'sum(({violated(n)})::INT)' for n in MANDATORY)})::BIGINT AS k2, sum({_sum(violated, [n for n in NAMES if n not in MANDATORY])}) AS soft,
  (SELECT count(*) FROM b WHERE {' OR '.join(f'{c} > 1' for c in _INVARIANTS)})::BIGINT AS k3, (SELECT sum(n - 1) FROM k)::BIGINT AS k4, (SELECT sum(bad::INT) FROM t)::BIGINT AS k5, (SELECT count(*) FROM t) AS traces,
  sum({_sum(lambda n: f'{n} IS NULL', MANDATORY)})::BIGINT AS k6 FROM f)
SELECT 'K2' AS code, k2 AS count, CASE WHEN k2 > 0 THEN 'bad' WHEN soft > 0 THEN 'warn' ELSE 'good' END AS tone FROM v
UNION ALL SELECT 'K3', k3, CASE WHEN k3 > 0 THEN 'bad' ELSE 'good' END FROM v UNION ALL SELECT 'K4', k4, CASE WHEN k4 > 0 THEN 'bad' ELSE 'good' END FROM v
UNION ALL SELECT 'K5', k5, CASE WHEN k5 / traces > 0.6 THEN 'bad' ELSE 'good' END FROM v UNION ALL SELECT 'K6', k6, CASE WHEN k2 + k3 + k4 + k6 > 0 THEN 'bad' ELSE 'good' END FROM v""",
    "span_consistency": f"{WITH} {_broken()}",
    "span_trace_consistency": f"{WITH}, b AS ({_broken()}) SELECT {', '.join(f'sum(({c} > 1)::INT)::BIGINT AS {c}' for c in _INVARIANTS)} FROM b",
    "span_tagged": f"{WITH} SELECT trace_id, span_id, rejected, count(*) AS n FROM f GROUP BY ALL",
    "span_rejection": _rejection(""),
    "span_rejection_by_agent": _rejection("agent_id"),
    "span_rejection_by_agent_day": _rejection("agent_id, day").replace("SELECT agent_id, day,", "SELECT agent_id, day AS ts,"),
    "span_trace_status": f"""{WITH}, b AS ({_broken()}), o AS (
  SELECT trace_id, session_id, nexus_distrib_ver, row_number() OVER ({_TRACE.replace(' ROWS BETWEEN', '')}) AS i, rejected FROM f)
SELECT b.trace_id, o.session_id, o.nexus_distrib_ver, spans, rejected, NOT ({' OR '.join(f'b.{c} > 1' for c in _INVARIANTS)}) AS consistent
FROM b JOIN o ON b.trace_id IS NOT DISTINCT FROM o.trace_id AND i = 1""",
    "span_flow": f"{WITH} SELECT four AS ts, {DISTINCT.format('trace_id')} AS traces, round(1 - avg(v_share), 9) AS validity, round(avg(a_share), 9) AS defect FROM f GROUP BY four",
    "span_assess": _assess(""),
    "span_assess_by_agent": _assess("agent_id"),
    "span_blame": f"""{WITH}, p AS (SELECT {', '.join(f'avg(({violated(n)})::INT::DOUBLE) AS {n}' for n in NAMES)} FROM f)
SELECT attr, round(violation_rate, 9) AS violation_rate FROM (UNPIVOT p ON {', '.join(NAMES)} INTO NAME attr VALUE violation_rate) WHERE violation_rate > 0""",
    "span_overview": f"""{WITH} SELECT count(*) AS spans, {DISTINCT.format('trace_id')} AS traces, {DISTINCT.format('session_id')} AS sessions, {DISTINCT.format('agent_id')} AS agents, min(agent_id) AS agent,
{DISTINCT.format('nexus_distrib_ver')} AS versions, min(nexus_distrib_ver) AS version, count(DISTINCT row(aef_kind, span_name, input_text, output_text)) AS unique_records,
min(start_time_ns) AS t0_ns, max(end_time_ns) AS t1_ns, round(avg((status_code = 'STATUS_CODE_ERROR')::INT::DOUBLE), 9) AS error_rate FROM f""",
    "span_bounds": f"{WITH} SELECT min(start_time_ns) AS t0_ns, max(end_time_ns) AS t1_ns FROM f",
    "span_trace_shape": f"""{WITH}, t AS (SELECT trace_id, count(*) AS spans, (max(end_time_ns) - min(start_time_ns)) / 1000000.0::DOUBLE AS dur_ms, bool_or(dialog) AS dialog FROM f GROUP BY trace_id)
SELECT count(*) AS traces, sum((spans = 1)::INT)::BIGINT AS singles, round(avg((spans = 1)::INT::DOUBLE), 6) AS single_share, round(quantile_cont(spans::DOUBLE, 0.5), 6) AS spans_median, max(spans) AS spans_max,
round(avg(dialog::INT::DOUBLE), 6) AS dialog_share, sum(dialog::INT)::BIGINT AS dialog_traces, round(quantile_cont(dur_ms, 0.5), 6) AS dur_ms_median,
round(list_sort(list(dur_ms))[1 + round(0.95 * (count(dur_ms) - 1))::INT], 6) AS dur_ms_p95 FROM t""",
    "span_composition": f"{WITH} SELECT aef_kind, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 9) AS share FROM f GROUP BY aef_kind",
    "span_degeneracy": f"{WITH}, p AS (SELECT count(*) AS n FROM f GROUP BY input_text, output_text) SELECT max(n) AS dominant_n, round(max(n) / sum(n), 9) AS dominant_share, count(*) AS unique_pairs FROM p",
    "span_repeats": f"""{WITH} SELECT aef_kind, span_name, count(*) AS n, {DISTINCT.format('input_text')} AS uniq_in, {DISTINCT.format('output_text')} AS uniq_out FROM f GROUP BY aef_kind, span_name
ORDER BY n DESC, coalesce(nullif(list_position(['llm', 'start_agent', 'chain', 'tool', 'retriever', 'input_request', 'output_request', 'kafka_produce', 'kafka_consume', 'other', 'guard'], aef_kind), 0), 99), span_name NULLS FIRST LIMIT 8""",
    "span_coverage": f"""{WITH} SELECT sum((aef_kind IN ('input_request', 'output_request'))::INT)::BIGINT AS http_spans, sum((aef_kind IN ('input_request', 'output_request') AND http_method = 'NONE')::INT)::BIGINT AS http_gap,
sum((aef_kind = 'llm')::INT)::BIGINT AS llm_spans, sum((aef_kind = 'llm' AND llm_model = '')::INT)::BIGINT AS llm_no_model, sum((aef_kind = 'llm' AND llm_total_tokens = -1)::INT)::BIGINT AS llm_no_tokens FROM f""",
    "span_traffic": f"{WITH} SELECT four AS ts, sum(dialog::INT)::BIGINT AS dialog_spans, sum((NOT dialog)::INT)::BIGINT AS tech_spans, round(avg((status_code = 'STATUS_CODE_ERROR')::INT::DOUBLE), 9) AS error_rate FROM f GROUP BY four",
    "span_mix": f"""{WITH}, k AS (SELECT k, k = 'dialog' AS is_dialog FROM (VALUES ('dialog'), ('other')) v(k)), b AS (SELECT DISTINCT four AS ts FROM f)
SELECT b.ts, k.k AS traces, (SELECT count(*) FROM f WHERE four IS NOT DISTINCT FROM b.ts AND dialog = k.is_dialog) AS n FROM b CROSS JOIN k""",
    "span_dialog_share": f"{WITH} SELECT four AS ts, round(sum(dialog::INT) / count(*), 9) AS dialog_share FROM f GROUP BY four",
    "span_dynamics": f"""{WITH}, x AS (SELECT trace_id, span_id, start_time_ns, {', '.join(f'({e})::BIGINT AS {n}' for n, e in _SIGNALS.items())} FROM f),
y AS (SELECT *, count(span_id) OVER u AS span_seq, {', '.join(f'sum({n}) OVER u AS {n}__cum, avg({n}) OVER r AS {n}__roll10' for n in _SIGNALS)} FROM x
  WINDOW u AS ({_TRACE} UNBOUNDED PRECEDING AND CURRENT ROW), r AS ({_TRACE} 9 PRECEDING AND CURRENT ROW))
SELECT max(span_seq) AS span_seq, count(*) AS n, trace_id, {', '.join(f'sum({n}__cum)::BIGINT AS {n}__cum, round(max({n}__cum / span_seq), 6) AS {n}__mean, round(max({n}__roll10), 6) AS {n}__roll10' for n in _SIGNALS)} FROM y GROUP BY trace_id""",
    "span_inflow_trend": f"""{WITH}, t AS (SELECT day, {DISTINCT.format('trace_id')} AS traces FROM f GROUP BY day), i AS (SELECT row_number() OVER (ORDER BY day) AS i, traces FROM t)
SELECT round(corr(i, traces), 9) AS trend, count(*) AS buckets FROM i""",
}


_KEYS = {"trace_id": "trace_id", "agent_id": "agent_id", "ver_minor": r"nullif(regexp_extract(nexus_distrib_ver, '^(\d+\.\d+)', 1), '')", "ts": "day"}


def _grouped(*held: str) -> str:
    keys = ", ".join(f"{e if k in held else 'NULL'} AS {k}" for k, e in _KEYS.items())
    cells = ", ".join(f"{MEAN.format(violated(n))} AS {n}" for n in NAMES if n not in _KEYS)
    return f"SELECT '{','.join(held)}' AS by, {keys}, count(*) AS n, {cells} FROM f{' GROUP BY ' + ', '.join(_KEYS[k] for k in held) if held else ''}"


ORACLES["span_profiles"] = WITH + " UNION ALL ".join(map(lambda held: _grouped(*held), [("trace_id",), ("agent_id",), ("ver_minor",), ("ts",), ("agent_id", "ts"), ()]))
ORACLES["span_state"] = f"""{WITH}, b AS ({_broken()}), t AS (SELECT trace_id, min(start_time_ns) AS start_ns, max(end_time_ns) AS end_ns, bool_or(dialog) AS dialog, bool_or(rejected) AS rejected FROM f GROUP BY trace_id)
SELECT b.trace_id, spans, start_ns, end_ns, dialog, rejected, {', '.join(f'b.{c} > 1 AS varies__{c}' for c in _INVARIANTS)} FROM b JOIN t ON b.trace_id IS NOT DISTINCT FROM t.trace_id"""
ORACLES["span_heavy"] = f"""{WITH} SELECT agent_id, aef_kind, status_code, count(*) AS n, round(count(*) / (SELECT count(*) FROM f), 9) AS share FROM f GROUP BY ALL
ORDER BY n DESC, agent_id NULLS FIRST, aef_kind NULLS FIRST, status_code NULLS FIRST LIMIT 5"""
ORACLES["span_dynamics_in_blocks"] = ORACLES["span_dynamics"]
ORACLES["span_differences"] = f"""WITH {_spans()}, l AS ({_conformed(False)}), d AS (
  SELECT 'left' AS side, * FROM (SELECT * FROM s EXCEPT ALL SELECT * FROM l) UNION ALL SELECT 'right', * FROM (SELECT * FROM l EXCEPT ALL SELECT * FROM s))
SELECT side, trace_id, span_id, count(*) AS times FROM d GROUP BY ALL"""
ORACLES["event_json"] = r"""
WITH t AS (SELECT event_id, CASE event_id % 7 WHEN 1 THEN left(props, length(props) - 1) WHEN 2 THEN props || '}' WHEN 3 THEN '[' || props || ', null]' ELSE props END AS text FROM events)
SELECT event_id, regexp_matches(text, '^\s*(\{[\s\S]*\}|\[[\s\S]*\])\s*$') AS shaped, json_valid(text) AS strict,
       CASE WHEN json_valid(text) THEN TRY_CAST(json_extract_string(text, '$.k') AS BIGINT) END AS k FROM t"""
_KIND_SEVERITY = {k: "critical" for k in ("output_request", "start_agent")} | {"llm": "important"} | {k: "moderate" for k in ("chain", "tool", "retriever", "kafka_produce", "kafka_consume", "other", "guard")}
_SMALL = {"shape": "span_trace_shape", "content": "span_degeneracy", "cov": "span_coverage", "comp": "span_composition", "v": "span_verdict", "r": "span_rejection", "blame": "span_blame", "trend": "span_inflow_trend"}
_TABLES = ", ".join(f"{name} AS ({ORACLES[query]})" for name, query in _SMALL.items())


def _problems(spans: str, traces: str) -> str:
    """The problems at level E over the small tables, under tolerances for spans and traces."""
    mandatory = ", ".join(f"'{n}'" for n in MANDATORY)
    rules = [
        ("single_spans", "critical", "K8", "FROM shape WHERE single_share >= 0.9"),
        ("few_dialogs", "critical", "K8", "FROM shape WHERE dialog_share < 0.05"),
        ("dominant_pair", "critical", "K8", "FROM content WHERE dominant_share >= 0.5"),
        *((f"no_{kind}", severity, "K8", f"WHERE NOT EXISTS (FROM comp WHERE aef_kind = '{kind}')") for kind, severity in _KIND_SEVERITY.items()),
        ("few_llm", "important", "K8", "FROM comp, shape WHERE aef_kind = 'llm' AND n < dialog_traces"),
        ("http_gap", "moderate", "K2", "FROM cov WHERE http_spans > 0 AND http_gap / http_spans >= 0.5"),
        ("llm_gap", "moderate", "K2", "FROM cov WHERE llm_spans > 0 AND llm_no_model / llm_spans >= 0.5"),
        ("rejection", "critical", "K5", "FROM r WHERE dropped / (dropped + kept) > 0.6"),
        ("worst_attributes", "important", "K2", f"WHERE EXISTS (FROM blame WHERE attr IN ({mandatory}) AND violation_rate >= 0.5)"),
        ("blocking", "important", "K2", f"FROM v WHERE blocking_rule_violations > {spans}"),
        ("duplicates", "important", "K4", "FROM v WHERE duplicate_keys > 0"),
        ("breaks", "important", "K3", "FROM v WHERE trace_breaks > 0"),
        ("nulls", "important", "K6", f"FROM v WHERE null_violations > {spans}"),
        ("schema", "moderate", "K1", ""),  # kafka_cluster and meta_tags are left out of the view of events
        ("inflow", "moderate", "K7", "FROM trend WHERE buckets >= 5 AND trend < -0.3"),
    ]
    return " UNION ALL ".join(f"SELECT '{name}' AS name, '{severity}' AS severity, '{code}' AS criteria, {code != 'K8'} AS affects_verdict {rest}" for name, severity, code, rest in rules)


def _status() -> str:
    cases = []
    for share, spans, traces in (("0%", "0", "0"), ("100%", "(SELECT count(*) FROM events)", "(SELECT traces FROM shape)")):
        valid = f"(SELECT null_violations <= {spans} AND blocking_rule_violations <= {spans} AND duplicate_keys <= {spans} AND trace_breaks <= {traces} FROM v)"
        pilot, ready = "EXISTS (FROM assess WHERE verdict IN ('ready', 'pilot'))", "NOT EXISTS (FROM assess WHERE verdict <> 'ready')"
        for scope in ("full", "quality"):
            deciding = f"(FROM ({_problems(spans, traces)}) WHERE affects_verdict{'' if scope == 'full' else " AND criteria <> 'K7'"}"
            red = f"NOT {valid} OR EXISTS {deciding} AND severity = 'critical')" + (f" OR NOT {pilot}" if scope == "full" else "")
            amber = f"EXISTS {deciding})" + (f" OR NOT {ready}" if scope == "full" else "")  # an advisory violation is always there, and the schema is degraded
            cases.append(f"SELECT '{share}' AS tolerance, '{scope}' AS scope, CASE WHEN {red} THEN 'red' WHEN {amber} THEN 'amber' ELSE 'green' END AS value, {valid} AS valid")
    return f"""WITH {_TABLES}, assess AS ({ORACLES['span_assess_by_agent']}), s AS ({' UNION ALL '.join(cases)})
SELECT tolerance, scope, value, CASE WHEN scope = 'quality' THEN CASE value WHEN 'green' THEN 'quality is confirmed' WHEN 'amber' THEN 'quality with remarks' ELSE 'quality checks failed' END
  ELSE CASE value WHEN 'green' THEN 'ready for monitoring' WHEN 'amber' THEN 'ready with remarks' ELSE CASE WHEN valid THEN 'not ready for monitoring' ELSE 'quality checks failed' END END END AS title FROM s"""


ORACLES["span_problems"] = f"WITH {_TABLES} {_problems('0', '0')}"
ORACLES["span_status"] = _status()
