"""A self-contained HTML report from small tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from datetime import datetime, timezone
from html import escape
from itertools import groupby
from math import isfinite
from typing import Any

from lumenspan.plans.spec import BY_NAME

#: Blocking attributes that the report lists; the whole table of attributes follows.
TOP_BLOCKING = 12
_COLORS = {"green": "#2e7d32", "amber": "#b26a00", "red": "#b3261e", "good": "#2e7d32", "warn": "#b26a00", "bad": "#b3261e", "muted": "#666"}
_STYLE = "body{font:15px/1.45 sans-serif;max-width:70em;margin:2em auto;padding:0 1em;color:#222}table{border-collapse:collapse;margin:.5em 0 1.5em}th,td{border:1px solid #ccc;padding:.25em .6em;text-align:left;vertical-align:top}th{background:#f3f3f3}.chip{color:#fff;border-radius:.6em;padding:.1em .7em}.bar{background:#4a78b5;height:.8em}svg{background:#fafafa;border:1px solid #ddd}"
_GLOSSARY = {
    "violation": "a value that is null or does not follow its attribute's rule",
    "trash": "a mark for a value that could not be cast to its attribute's type",
    "rejected trace": "a trace with a span that violates a mandatory attribute",
    "validity": "one minus the mean share of violated mandatory attributes",
    "presence": "one minus the mean share of null mandatory attributes",
    "retention": "share of spans in traces that are not rejected",
}


def _show(x: Any) -> str:
    if x is None:
        return "–"
    if isinstance(x, float):
        return f"{x:,.4g}"
    return escape(f"{x:,}" if isinstance(x, int) and not isinstance(x, bool) else str(x))


def _table(head: Iterable[str], rows: Iterable[Iterable[Any]]) -> str:
    body = "".join(f"<tr>{''.join(f'<td>{c if isinstance(c, _Markup) else _show(c)}</td>' for c in r)}</tr>" for r in rows)
    return f"<table><tr>{''.join(f'<th>{escape(h)}</th>' for h in head)}</tr>{body}</table>"


class _Markup(str):
    """Text that is HTML already."""


def _chip(text: str, tone: str) -> _Markup:
    return _Markup(f'<span class="chip" style="background:{_COLORS.get(tone, "#666")}">{escape(text)}</span>')


def _bar(share: float | None) -> _Markup:
    return _Markup(f'<div class="bar" style="width:{min(1.0, share or 0) * 12:.2f}em"></div>')


def _section(title: str, body: str) -> str:
    return f"<h2>{escape(title)}</h2>{body}"


def _when(ns: int | None) -> str:
    return "–" if ns is None else datetime.fromtimestamp(ns / 1e9, timezone.utc).strftime("%Y-%m-%d %H:%M UTC")


def _pairs(values: dict[str, Any]) -> str:
    return _table(("figure", "value"), values.items())


#: Size of a chart and of its margins, and the most marks on its axis of time.
_WIDTH, _HEIGHT, _FOOT, _MARKS = 700, 150, 20, 6
_STAMPS = {"1m": "%H:%M:%S", "5m": "%H:%M", "15m": "%H:%M", "1h": "%d.%m. %H:%M", "4h": "%d.%m."}


def stamp(at: datetime, grain: str) -> str:
    """A time as far as buckets of this grain tell it apart."""
    return at.strftime(_STAMPS.get(grain, "%d.%m."))


def _axis(times: list[datetime], grain: str, place: Callable[[int], float]) -> str:
    """Marks of time under a chart: the first, the last, and evenly spaced ones between, each text once."""
    n = min(len(times), _MARKS)
    marks = {stamp(times[i], grain): i for i in dict.fromkeys(round(k * (len(times) - 1) / (n - 1)) for k in reversed(range(n)))}
    anchor = lambda i: "start" if i == 0 else "end" if i == len(times) - 1 else "middle"
    return "".join(f'<text x="{place(i):.1f}" y="{_HEIGHT + _FOOT - 5}" font-size="11" fill="#666" text-anchor="{anchor(i)}">{escape(text)}</text>' for text, i in marks.items())


def _frame(title: str, note: str, body: str, keys: dict[str, str]) -> str:
    legend = ", ".join(f'<span style="color:{c}">{escape(k)}</span>' for k, c in keys.items())
    return f'<h3>{escape(title)}</h3><svg width="{_WIDTH}" height="{_HEIGHT + _FOOT}" viewBox="0 0 {_WIDTH} {_HEIGHT + _FOOT}">{body}</svg><div>{legend}{escape("; " + note if note else "")}</div>'


def _chart(title: str, rows: list[dict], series: dict[str, str], grain: str, note: str = "", mean: str | None = None) -> str:
    """Lines over time as inline SVG, with a dashed line at the mean of ``mean``; nothing for less than two buckets.

    Null values are gaps in a line, not zeros.
    """
    rows = [r for r in rows if r["ts"] is not None]
    if len(rows) < 2:
        return ""
    known = lambda s: [float(r[s]) for r in rows if r[s] is not None]
    top = max((x for s in series for x in known(s)), default=0) or 1.0
    x, y = lambda i: i * _WIDTH / (len(rows) - 1), lambda v: _HEIGHT - (_HEIGHT - 10) * v / top
    lines = ""
    for s, color in series.items():
        for known_run, run in groupby(enumerate(rows), lambda ir: ir[1][s] is not None):
            if known_run:
                points = " ".join(f"{x(i):.1f},{y(float(r[s])):.1f}" for i, r in run)
                lines += f'<polyline fill="none" stroke="{color}" stroke-width="2" stroke-linecap="round" points="{points}"/>'
    if mean and known(mean):
        at = y(sum(known(mean)) / len(known(mean)))
        lines += f'<line class="mean" x1="0" x2="{_WIDTH}" y1="{at:.1f}" y2="{at:.1f}" stroke="#999" stroke-dasharray="4 4"/>'
    return _frame(title, note, lines + _axis([r["ts"] for r in rows], grain, x), series)


def _stacked(title: str, rows: list[dict], name: str, colors: dict[str, str], grain: str) -> str:
    """Bars over time from rows in long form (ts, ``name``, n), the parts of a bucket on top of each other."""
    buckets: dict[datetime, dict[str, int]] = {}
    for r in sorted((r for r in rows if r["ts"] is not None), key=lambda r: r["ts"]):
        buckets.setdefault(r["ts"], {})[r[name]] = r["n"] or 0
    if len(buckets) < 2:
        return ""
    top, slot, bars = max(sum(b.values()) for b in buckets.values()) or 1, _WIDTH / len(buckets), ""
    width = max(1.0, min(36.0, slot - 2))
    for i, parts in enumerate(buckets.values()):
        base = float(_HEIGHT)
        for kind, color in colors.items():
            height = (_HEIGHT - 10) * parts.get(kind, 0) / top
            base -= height
            bars += f'<rect x="{(i + 0.5) * slot - width / 2:.1f}" y="{base:.1f}" width="{width:.1f}" height="{height:.1f}" fill="{color}"/>' if height else ""
    return _frame(title, "", bars + _axis(list(buckets), grain, lambda i: (i + 0.5) * slot), colors)


def trend_text(trend: float | None) -> str:
    """What the correlation of inflow with time says."""
    r = trend if trend is not None and isfinite(trend) else 0.0
    return f"{'rising' if r > 0.05 else 'falling' if r < -0.05 else 'steady'}, correlation with time {r:+.2f}"


def _schema(diff: dict) -> str:
    extra = f"<p>Columns outside the specification: {escape(', '.join(diff['extra']))}</p>" if diff["extra"] else ""
    return _table(("attribute", "mandatory", "expected", "found", "state"), ((r["attr"], r["mandatory"], r["expected"], r["found"], r["state"]) for r in diff["rows"] if r["state"] != "ok")) + extra


def _quantiles(row: dict) -> str:
    names = list(dict.fromkeys(k.rsplit("__q", 1)[0] for k in row if "__q" in k))
    levels = list(dict.fromkeys(k.rsplit("__q", 1)[1] for k in row if "__q" in k))
    return _table(("signal", *(f"q{x}" for x in levels)), ((n, *(row[f"{n}__q{x}"] for x in levels)) for n in names))


def _page(title: str, body: str) -> str:
    return f'<!doctype html><html lang="en"><head><meta charset="utf-8"><title>{escape(title)}</title><style>{_STYLE}</style></head><body><h1>{escape(title)}</h1>{body}</body></html>'


def _criteria(criteria: dict[str, dict]) -> str:
    return _table(
        ("criterion", "title", "checks", "violated by", "limits from", "result"),
        ((_Markup(f'<span id="{v["anchor"]}">{code}</span>'), v["title"], v["checks"], v["breach"], v["source"], _chip(v["result"], v["tone"])) for code, v in criteria.items()),
    )


def _problems(found: list[dict]) -> str:
    if not found:
        return "<p>None.</p>"
    links = lambda p: _Markup(", ".join(f'<a href="#criterion-{c.lower()}">{c}</a>' for c in p["criteria"]) + "".join(f', <a href="#rule-{escape(a)}">{escape(a)}</a>' for a in p["attributes"]))
    tone = {"critical": "bad", "important": "warn", "moderate": "muted"}
    return _table(("severity", "problem", "extent", "impact", "action", "criteria"), ((_chip(p["severity"], tone[p["severity"]]), p["title"], p["detail"], p["impact"], p["action"], links(p)) for p in found))


def _blocking(attributes: list[dict]) -> str:
    """The mandatory attributes that are violated, the worst first."""
    bad = sorted((a for a in attributes if a["mandatory"] and a["violations"]), key=lambda a: (-a["violated"], a["attr"]))
    if not bad:
        return "<p>No mandatory attribute is violated.</p>"
    shown = _table(("attribute", "violations", "share", "", "rule"), ((a["attr"], a["violations"], a["violated"], _bar(a["violated"]), BY_NAME[a["attr"]].rule.text) for a in bad[:TOP_BLOCKING]))
    return shown + (f"<p>{TOP_BLOCKING} of {len(bad)} attributes.</p>" if len(bad) > TOP_BLOCKING else "")


def stopped(title: str, detail: str, found: dict | None = None) -> str:
    more = "" if not found else _section("Criteria", _criteria(found["criteria"])) + _section("Data", _pairs(found["meta"])) + _section("Schema", _schema(found["schema"]))
    return _page(title, f"<p>{_chip('red', 'red')} {escape(detail)}</p>{more}")


def document(status: dict, found: dict, tables: dict[str, list[dict]]) -> str:
    metrics, one = found["metrics"], {k: v[0] for k, v in tables.items() if v}
    overview, ready, grain = metrics["overview"], found["readiness"], metrics["policy"]["grain"]
    seen = {"spans": overview["spans"], "traces": overview["traces"], "sessions": overview["sessions"], "agents": overview["agents"], "from": _when(overview["t0_ns"]), "to": _when(overview["t1_ns"]), "error rate": overview["error_rate"]}
    parts = [
        f"<p>{_chip(status['value'], status['value'])} significance {escape(metrics['policy']['level'])}, scope {escape(metrics['policy']['scope'])}</p>",
        _section("Data", _pairs(seen)),
        _section("Criteria", _criteria(found["criteria"])),
        _section("Problems", _problems([p for p in found["problems"] if p["affects_verdict"]])),
        _section("Diagnosis", _problems([p for p in found["problems"] if not p["affects_verdict"]])),
        _section("Schema", _schema(found["schema"])),
        _section("Integrity", _pairs(found["quality"]) + _pairs(metrics["rejection"]) + _pairs(metrics["trace_consistency"])),
        _section("Blocking violations", _blocking(found["attribute_quality"])),
        _section("Readiness", _table(ready[0].keys(), (r.values() for r in ready)) if ready else "<p>None.</p>"),
        _section(
            "Attributes",
            _table(
                ("attribute", "mandatory", "missing", "violated", "", "trash", "nulls", "rule"),
                ((_Markup(f'<span id="rule-{a["attr"]}">{a["attr"]}</span>'), a["mandatory"], a["missing"], a["violated"], _bar(a["violated"]), a["trash"], a["nulls"], BY_NAME[a["attr"]].rule.text) for a in found["attribute_quality"]),
            ),
        ),
        _section("Kinds", _table(("kind", "spans", "share", "", "priority", "state", "lost without it"), ((k["aef_kind"], k["n"], k["share"], _bar(k["share"]), k["priority"], k["state"], k["impact"]) for k in found["span_distribution"]))),
        _section("Traces", _pairs(metrics["trace_structure"]) + _pairs(metrics["content_repetition"]) + _pairs(metrics["coverage"])),
        _section("Repeats", _table(("kind", "name", "spans", "inputs", "outputs"), ((r["aef_kind"], r["span_name"], r["n"], r["uniq_in"], r["uniq_out"]) for r in tables["repeats"]))),
        _section("Values", _quantiles(one["distribution"])),
        _section(
            "Dynamics",
            _chart("Traces", tables["flow"], {"traces": "#4a78b5"}, grain, f"{trend_text(one['inflow']['trend'])}; the dashed line is the mean", "traces")
            + _chart("Validity and defects", tables["flow"], {"validity": "#2e7d32", "defect": "#b3261e"}, grain)
            + _stacked("Spans of dialogs and of other traces", tables["mix"], "traces", {"dialog": "#4a78b5", "other": "#999"}, grain)
            + _chart("Share of dialog spans", tables["dialog_share"], {"dialog_share": "#4a78b5"}, grain)
            + _chart("Rate of errors", tables["traffic"], {"error_rate": "#b3261e"}, grain),
        ),
        _section("Policy", _pairs(metrics["policy"]) + _pairs(metrics["gates"]) + _pairs(metrics["diagnostic_thresholds"])),
        _section("Terms", _pairs(_GLOSSARY)),
    ]
    return _page(status["title"].capitalize(), "".join(parts))
