"""The most frequent values against a plain count."""

from collections import Counter

import pytest

from lumenspan.operators import heavy


def plain(rows, k):
    counts = Counter(rows)
    least_first = lambda v: tuple((x is not None, x or "") for x in v)
    return [(*v, n) for v, n in sorted(counts.items(), key=lambda x: (-x[1], least_first(x[0])))[:k]]


def got(df, k, tracked):
    return [tuple(r)[:3] for r in heavy.top(df, ["a", "b"], k, tracked).collect()]


@pytest.mark.parametrize("tracked", [16, 1000])
def test_top_equals_a_plain_count(spark, tracked):
    hot = [(None, "x")] * 900 + [("y", None)] * 700 + [("z", "z")] * 700
    rest = [(f"v{i % 997}", "r") for i in range(3000)]  # ties, with or without the sketch holding them
    df = spark.createDataFrame(hot + rest, "a string, b string").repartition(5)
    for k in (1, 3, 9):
        assert got(df, k, tracked) == plain(hot + rest, k)


def test_without_frequent_values_all_are_counted(spark):
    rows = [(f"v{i}", "r") for i in range(500)] + [("v7", "r")]
    df = spark.createDataFrame(rows, "a string, b string")
    assert got(df, 2, 16) == plain(rows, 2)


def test_few_or_no_values(spark):
    df = spark.createDataFrame([("a", None), ("a", None), (None, None)], "a string, b string")
    found = heavy.top(df, ["a", "b"], 5).collect()
    assert [(r.a, r.b, r.n) for r in found] == [("a", None, 2), (None, None, 1)] and abs(found[0].share - 2 / 3) < 1e-12
    assert heavy.top(df.limit(0), ["a", "b"], 5).isEmpty()
