"""Profiles under several sets of keys, and stored states of traces."""

import uuid

import pytest
from pyspark.sql import functions as F

from lumenspan.functions import dims as by
from lumenspan.operators import flags, quality, state
from lumenspan.plans.spec import INVARIANTS
from lumenspan.queries import _spans
from tests.compare import rows_of
from tests.test_spans import DAY, frame


def rows(df):
    return rows_of([r.asDict() for r in df.collect()], sorted(df.columns))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("flag", [flags.missing, flags.violation, flags.trash])
def test_sets_of_keys_equal_single_profiles(spark, flag):
    spans = frame(spark, {}, {"agent_id": None, "llm_model": "m"}, {"agent_id": "CX", "trace_id": None, "span_name": None}, {"start_time_ns": 6 * DAY, "http_status_code": -2}, {"llm_max_tokens": None})
    sets = {"": (), "agent_id": (by.agent(),), "agent_id,ts": (by.agent(), by.time("1d")), "trace_id": (by.trace(),)}
    got = quality.profiles(spans, flag, *sets.values()).cache()
    for name, dims in sets.items():
        want = quality.profile(spans, flag, quality.rate, *dims)
        others = {"trace_id", "agent_id", "ts"} - {d.name for d in dims}  # keys of other sets
        columns = [c for c in want.columns if c not in others]
        assert rows(got.filter(F.col("by") == name).select(columns)) == rows(want.select(columns))
    assert got.filter("by IS NULL").isEmpty()
    assert quality.profiles(frame(spark), flag, (by.agent(),), ()).isEmpty()


def test_sets_of_keys_take_one_scan(spark, sf):
    found = quality.profiles(_spans(spark, sf), flags.violation, (by.trace(),), (by.agent(),), ())
    assert plan(found).count("FileScan") == 1 and plan(found).count("Exchange") == 2


def mixed(spark):
    """Days of spans: traces that go on, change, end, lack their id, or have empty invariants."""
    one = lambda day, **more: more | {"start_time_ns": day * DAY, "end_time_ns": day * DAY + 5}
    return [
        frame(spark, one(1), one(1, trace_id=None), one(1, trace_id="", service_name=None), one(1, trace_id="T2")),
        frame(spark, one(2, service_version="2"), one(2, trace_id=None, agent_id="bad"), one(2, trace_id="", service_name="x")),
        frame(spark),
        frame(spark, one(3, trace_id="T3", service_name=None), one(3, trace_id="T3", service_name=None), one(3, aef_kind="tool", http_method="NONE", http_path="", http_status_code=-1, request_headers="", response_headers="")),
    ]


def test_states_of_days_equal_the_rollup_of_all_spans(spark):
    days = mixed(spark)
    stored = [f"state_{uuid.uuid4().hex}" for _ in days]
    try:
        table = state.begin(days[0], stored[0], 4)
        for spans, name in zip(days[1:], stored[1:]):
            table = state.advance(table, spans, name, 4)
        every = days[0].union(days[1]).union(days[3])
        assert rows(state.rolled(table)) == rows(quality.rollup(every))
        assert table.count() == 5 and {f"varies__{c}" for c in INVARIANTS} <= set(state.rolled(table).columns)
    finally:
        for name in stored:
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_what_is_stored_is_not_shuffled(spark):
    days = mixed(spark)
    stored = [f"state_{uuid.uuid4().hex}" for _ in range(2)]
    try:
        a, b = (state.begin(spans, name, 8) for spans, name in zip(days, stored))
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        assert "Exchange" not in plan(state.merged(a, b))
        text = plan(state.merged(a, state.trace_state(days[1])))
        # the stored side is printed first, down to its scan
        assert text.count("FileScan") == 1 and "Exchange" not in text[: text.index("FileScan")] and "Exchange hashpartitioning(trace_key" in text
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for name in stored:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
