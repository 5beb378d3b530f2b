"""Rules: every node of a tree in Spark's SQL, in DuckDB's SQL and in words."""

import duckdb
import pytest
from pyspark.sql import functions as F

from lumenspan.functions import rules as R
from lumenspan.operators import flags
from lumenspan.operators.recast import recast
from lumenspan.plans import oracle
from lumenspan.plans.spec import SPEC
from lumenspan.sources.spans import event_spans
from tests import rule_texts

TEXTS = [None, "", " ", "a", "b\\'", "it's", "a\nb", "AbC=", "CI12", "CE٣", "1.?.3", "1.٣.?", "1.2", "[]", "{}", " {\n} ", " [1] ", "{", '["x"]', '["x", "y\\""]　', '["x\\\n"]', '["x",]', "😀"]
NUMBERS = [None, -2, -1, 0, 1, 99, 100, 599, 600]


def verdicts(spark, rule, rows, kind):
    """What Spark and DuckDB say of ``x`` in rows of (x, y)."""
    frame = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"i int, x {kind}, y {kind}")
    got = [r[0] for r in frame.orderBy("i").select(F.expr(rule.holds("x"))).collect()]
    con = duckdb.connect()
    con.execute(f"CREATE TABLE t (i INT, x {kind}, y {kind})")
    con.executemany("INSERT INTO t VALUES (?, ?, ?)", [(i, *r) for i, r in enumerate(rows)])
    assert got == [r[0] for r in con.sql(f"SELECT {rule.sql('x', R.DUCKDB)} FROM t ORDER BY i").fetchall()]
    return got


@pytest.mark.parametrize("name", R.PATTERNS)
def test_forms_agree_in_both_engines(spark, name):
    got = verdicts(spark, R.Matches(name), [(t, t) for t in TEXTS], "string")
    assert got[0] is None and True in got and False in got


@pytest.mark.parametrize(
    ("rule", "kind", "holds", "text"),
    [
        (R.Anything(), "string", {*TEXTS}, "any value"),
        (R.NotEmpty(), "string", {*TEXTS} - {"", None}, "not empty"),
        (R.Equals("it's"), "string", {"it's"}, 'equals "it\'s"'),
        (R.Equals("b\\'"), "string", {"b\\'"}, None),
        (R.OneOf(("a", "b\\'")), "string", {"a", "b\\'"}, "one of a, b\\'"),
        (R.Either(R.Equals(""), R.OneOf(("a",))), "string", {"", "a"}, "equals '' or one of a"),
        (R.Where("y", ("a", "CI12"), R.Anything(), R.Equals("{}")), "string", {"a", "CI12", "{}"}, "if y is a or CI12: any value; else equals '{}'"),
        (R.AtLeast(0), "bigint", {0, 1, 99, 100, 599, 600}, "at least 0"),
        (R.AtLeastColumn("y"), "bigint", {*NUMBERS} - {None}, "at least y"),
        (R.Between(100, 599), "bigint", {100, 599}, "between 100 and 599"),
        (R.Equals(-1.0), "float", {-1}, "equals -1.0"),
        (R.Equals(False), "boolean", {False}, "equals False"),
        (R.NotBoth("x", "y"), "boolean", {False}, "not both x and y"),
    ],
)
def test_each_node(spark, rule, kind, holds, text):
    values = {"string": TEXTS, "bigint": NUMBERS, "float": NUMBERS, "boolean": [None, True, False]}[kind]
    values = [float(v) if kind == "float" and v is not None else v for v in values]
    got = verdicts(spark, rule, [(v, v) for v in values], kind)
    assert {v for v, ok in zip(values, got) if ok} == holds
    assert text is None or rule.text == text


def test_unlike_columns(spark):
    assert verdicts(spark, R.AtLeastColumn("y"), [(1, 2), (2, 1), (1, None), (None, 1)], "bigint") == [False, True, None, None]
    assert verdicts(spark, R.NotBoth("x", "y"), [(True, False), (None, False), (None, True)], "boolean") == [True, True, None]
    assert verdicts(spark, R.Where("y", ("a",), R.NotEmpty(), R.Equals("")), [("", "a"), ("x", "a"), ("x", None), (None, "a"), ("", "b")], "string") == [False, True, False, None, True]


def test_specification_in_trees_and_by_hand(spark, sf):
    """All attributes of the spans of ``events``, and of spans that are wrong everywhere, under trees and hand-written rules."""
    assert [(n, c[:3]) for n, c in oracle.COLUMNS.items()] == [(n, c[:3]) for n, c in rule_texts.COLUMNS.items()]
    spans = recast(event_spans(spark, sf)).limit(400)
    odd = [F.lit(v).try_cast(spans.schema[a.name].dataType).alias(a.name) for a, v in zip(SPEC, [x for x in TEXTS if x and x.isascii()] * 9)]
    kinds = spans.select(*[(F.col(a.name) if a.name in ("aef_kind", "status_code") else o) for a, o in zip(SPEC, odd)])
    rows = spans.union(kinds)
    found = rows.select("*", *[flags.violation(a).alias(f"bad__{a.name}") for a in SPEC]).toArrow()
    con = duckdb.connect()
    con.register("s", found)
    for a in SPEC:
        hand = f"coalesce(NOT ({a.name} IS NOT NULL AND ({rule_texts.COLUMNS[a.name][3]})), true)"
        tree, by_hand = zip(*con.sql(f"SELECT {oracle.violated(a.name)}, {hand} FROM s").fetchall())
        assert list(tree) == list(by_hand) == found[f"bad__{a.name}"].to_pylist(), a.name
