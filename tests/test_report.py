"""The report: sections and charts from small tables, without Spark."""

import re
from datetime import datetime, timedelta, timezone

import pytest

from lumenspan.functions.scores import parameters
from lumenspan.plans import report, triage

START = datetime(2024, 1, 31, 22, tzinfo=timezone.utc)


def hours(count, **columns):
    return [{"ts": START + timedelta(hours=i)} | {k: v[i] for k, v in columns.items()} for i in range(count)]


@pytest.mark.parametrize(("grain", "text"), [("1m", "22:00:00"), ("5m", "22:00"), ("15m", "22:00"), ("1h", "31.01. 22:00"), ("4h", "31.01."), ("1d", "31.01.")])
def test_stamps_follow_the_grain(grain, text):
    assert report.stamp(START, grain) == text


def test_lines_have_gaps_where_values_are_null():
    svg = report._chart("Rate", hours(5, x=[0.5, None, 1.0, 0.0, None]), {"x": "#000"}, "1h")
    assert re.findall(r'points="([^"]*)"', svg) == ["0.0,80.0", "350.0,10.0 525.0,150.0"]
    assert re.findall(r">([0-9.: ]+)</text>", svg) == ["01.02. 02:00", "01.02. 01:00", "01.02. 00:00", "31.01. 23:00", "31.01. 22:00"]


def test_mean_is_of_known_values():
    svg = report._chart("Traces", hours(3, n=[4, None, 2]), {"n": "#000"}, "1d", "note <1>", "n")
    assert 'class="mean" x1="0" x2="700" y1="45.0"' in svg and "note &lt;1&gt;" in svg
    assert len(re.findall("<text", svg)) == 2  # days, each named once


@pytest.mark.parametrize("rows", [[], hours(1, n=[1]), [{"ts": None, "n": 1}, *hours(1, n=[2])]])
def test_less_than_two_buckets_make_no_chart(rows):
    assert report._chart("x", rows, {"n": "#000"}, "1h") == ""
    assert report._stacked("x", [r | {"kind": "a"} for r in rows], "kind", {"a": "#000"}, "1h") == ""


def test_bars_stand_on_each_other():
    rows = [r | {"kind": k} for k, v in (("b", [2, None]), ("a", [1, 4])) for r in hours(2, n=v)]
    bars = re.findall(r'y="([0-9.]+)" width="36.0" height="([0-9.]+)" fill="(#.)"', report._stacked("x", rows[::-1], "kind", {"a": "#1", "b": "#2"}, "1h"))
    assert bars == [("115.0", "35.0", "#1"), ("45.0", "70.0", "#2"), ("10.0", "140.0", "#1")]


def test_many_buckets_keep_few_marks():
    svg = report._chart("x", hours(72, n=list(range(72))), {"n": "#000"}, "1h")
    assert len(re.findall("<text", svg)) == 6 and svg.count("text-anchor=\"start\"") == svg.count("text-anchor=\"end\"") == 1


@pytest.mark.parametrize(("trend", "text"), [(None, "steady"), (float("nan"), "steady"), (0.05, "steady"), (0.06, "rising"), (-0.06, "falling")])
def test_trend_in_words(trend, text):
    assert report.trend_text(trend).startswith(text)


def test_criteria_say_what_breaches_them_and_why():
    limits = {"max_nulls": 1, "max_rules": 2000, "max_dups": 3, "max_breaks": 4}
    got = triage.explained(triage.only_schema(), "C", parameters("C"), limits)
    texts = {"K2": "more than 2,000 spans", "K3": "more than 4 traces", "K4": "more than 3 spans", "K5": "more than 30% of traces", "K6": "more than 1 in null_violations", "K7": "fewer than 10,000 traces", "K8": "none of input_request, output_request, start_agent"}
    assert set(got) == set(triage.CRITERIA) and all(text in got[code]["breach"] for code, text in texts.items())
    assert got["K5"]["source"] == got["K7"]["source"] == "significance level C" and got["K1"]["result"] == "violated"
    stopped = triage.explained(triage.only_schema(), "A", parameters("A"), {})
    assert "more than tolerated spans" in stopped["K4"]["breach"] and "2%" in stopped["K5"]["breach"]
    assert stopped["K4"]["breach"] in report._criteria(stopped)


def test_blocking_lists_the_worst_and_says_how_many():
    names = [a.name for a in report.BY_NAME.values() if a.mandatory]
    rows = [{"attr": n, "mandatory": True, "violations": i + 1, "violated": (i + 1) / 100} for i, n in enumerate(names)]
    page = report._blocking(rows)
    assert page.count("<tr>") == report.TOP_BLOCKING + 1 and names[0] not in re.findall("<td>([a-z_]+)</td>", page) and f"{report.TOP_BLOCKING} of {len(names)}" in page


def test_quantiles_are_a_row_a_signal():
    assert "<tr><td>a</td><td>1</td><td>2</td></tr><tr><td>b</td><td>–</td><td>4</td></tr>" in report._quantiles({"a__q25": 1, "a__q50": 2, "b__q25": None, "b__q50": 4})


def test_texts_are_escaped():
    assert "<script>" not in report._table(("<script>",), [("<script>",)]) + report.stopped("<script>", "<script>")
