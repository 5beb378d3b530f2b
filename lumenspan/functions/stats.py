"""Aggregates and buckets whose nulls and edges are defined."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DAY_NS = 86_400_000_000_000

#: Names of time grains and their seconds, from fine to coarse.
GRAINS = {"1m": 60, "5m": 300, "15m": 900, "1h": 3_600, "4h": 14_400, "1d": 86_400}
MOST_BUCKETS = 72


def pick_grain(span_days: float) -> str:
    """The finest grain that needs at most ``MOST_BUCKETS`` buckets, else a day."""
    seconds = max(0.0, span_days) * 86_400
    return next((name for name, size in GRAINS.items() if seconds / size <= MOST_BUCKETS), "1d")


def bucket(ns: Column, grain: str) -> Column:
    """Start of the bucket of a nanosecond time, as a timestamp. Whole numbers throughout; also right before 1970."""
    size = GRAINS[grain] * 1_000_000_000
    start = ns - F.pmod(ns, F.lit(size))
    return F.timestamp_micros(F.try_divide(start - F.pmod(start, F.lit(1000)), F.lit(1000)).cast("long"))


def rate(flag: Column) -> Column:
    """Mean of a boolean; nulls do not count."""
    return F.avg(flag.cast("double"))


def total(flag: Column) -> Column:
    """Sum of a boolean, 0 for nothing."""
    return F.coalesce(F.sum(flag.cast("long")), F.lit(0).cast("long"))


def distinct(c: Column) -> Column:
    """Distinct values with null as a value."""
    return F.count_distinct(c) + F.coalesce(F.max(c.isNull().cast("long")), F.lit(0))


def varies(c: Column) -> Column:
    """Whether a group has more than one value, null being one, without gathering the values."""
    return F.coalesce(F.min(c) != F.max(c), F.lit(False)) | ((F.count(c) > 0) & (F.count(c) < F.count(F.lit(1))))


def correlation(x: Column, y: Column) -> Column:
    """Pearson's correlation; null where one side is constant."""
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def digest(*columns: Column) -> Column:
    """128 bits that stand for the values, null being one, so that long texts need not travel as keys."""
    return F.unhex(F.md5(F.to_json(F.struct(*[c.alias(f"c{i}") for i, c in enumerate(columns)]))))


#: Size of a sketch of quantiles, four times the rank error that such a sketch keeps with 99 %, and the cells that the values in a bracket are dealt into.
SKETCH, MARGIN, CELLS = 8192, 0.0027, 1024


def _column(signal: str, level: float) -> str:
    return f"{signal}__q{round(level * 100):02d}"


def sketched(df: DataFrame, keys: list[Column], signals: dict[str, Column], levels: Sequence[float]) -> DataFrame:
    """Approximate quantiles by keys from bounded sketches, as ``quantiles``."""
    at = F.array(*map(F.lit, levels))
    body = [F.percentile_approx(c.cast("double"), at, F.lit(100_000)).alias(name) for name, c in signals.items()]
    found = df.groupBy(*keys).agg(*body) if keys else df.agg(*body)
    names = [c for c in found.columns if c not in signals]
    return found.select(*names, *[F.get(name, F.lit(i)).alias(_column(name, q)) for name in signals for i, q in enumerate(levels)])


def quantiles(df: DataFrame, keys: list[Column], signals: dict[str, Column], levels: Sequence[float], nearest: Sequence[float] = ()) -> DataFrame:
    """Exact quantiles by keys: columns ``signal__qNN``, linear between neighbours or, for levels in ``nearest``, the value at the nearest place.

    A first pass sketches every signal; the sketch brackets the places that are asked for. In a second pass each value falls into a bracket or
    a gap between brackets. Gaps are only counted; values in a bracket are counted by value and dealt into ``CELLS`` cells in order. Running counts of
    the cells are exact places, so that it shows which cell holds a place, and only such cells are searched: no task holds all values. A place
    that turns out to lie in a gap was missed by its bracket: its keys go through once more with a bracket around all values.
    """
    levels = sorted(levels)
    names = [f"_{i}" for i in range(len(signals))]
    wide = df.select(*keys, *[c.cast("double").alias(n) for n, c in zip(names, signals.values())])
    by = [c for c in wide.columns if c not in names]
    found = _selected(wide, by, names, brackets(wide, by, names, levels), len(levels), levels, nearest)
    missed = " OR ".join(f"({n}n > 0 AND {n}q{i} IS NULL)" for n in names for i in range(len(levels)))
    again = found.filter(missed).select(*by, F.lit(True).alias("again"))
    rest = same(wide, again, by, how="inner").drop("again")
    second = _selected(rest, by, names, whole_range(rest, by, names), 1, levels, nearest)
    cells = [f"{n}q{i}" for n in names for i in range(len(levels))]
    both = same(found, second.selectExpr(*[f"`{c}`" for c in by], *[f"{c} AS {c}b" for c in cells]), by)
    return both.selectExpr(*[f"`{c}`" for c in by], *[f"coalesce({n}q{i}, {n}q{i}b) AS `{_column(s, q)}`" for s, n in zip(signals, names) for i, q in enumerate(levels)])


def _grouped(df: DataFrame, by: list[str], body: list[Column]) -> DataFrame:
    return df.groupBy(*by).agg(*body) if by else df.agg(*body)


def brackets(wide: DataFrame, by: list[str], names: list[str], levels: Sequence[float]) -> DataFrame:
    """By keys for every signal the bracket of each level, from one sketch a signal."""
    body = [F.struct(F.count(n).alias("n"), F.kll_sketch_agg_double(n, F.lit(SKETCH)).alias("sketch")).alias(n) for n in names]

    def bracket(n: str, q: float) -> str:
        low, high = (f"kll_sketch_get_quantile_double({n}.sketch, {min(1.0, max(0.0, q + m))!r}D)" for m in (-MARGIN, MARGIN))
        return f"if({n}.n > 0, named_struct('low', {low}, 'high', {high}), NULL)"

    return _grouped(wide, by, body).selectExpr(*[f"`{c}`" for c in by], *[f"array({', '.join(bracket(n, q) for q in levels)}) AS {n}b" for n in names])


def whole_range(wide: DataFrame, by: list[str], names: list[str]) -> DataFrame:
    return _grouped(wide, by, [F.array(F.struct(F.min(n).alias("low"), F.max(n).alias("high"))).alias(f"{n}b") for n in names])


def _selected(wide: DataFrame, by: list[str], names: list[str], bounds: DataFrame, most: int, levels: Sequence[float], nearest: Sequence[float]) -> DataFrame:
    """By keys: for every signal its values ``n`` and the quantile of each level ``q``, null where it lies outside the ``most`` brackets."""
    placed = same(wide, bounds, by)

    lines = [F.when(F.col(n).isNotNull(), F.struct(F.lit(k).alias("signal"), F.col(n).alias("v"), F.col(f"{n}b").alias("b"))) for k, n in enumerate(names)]
    each = placed.select(*by, F.inline(F.array_compact(F.array(*lines))))
    # the place among gaps (even) and brackets (odd), in order
    brackets_of = [F.get("b", F.lit(i)) for i in range(most)]
    at = F.lit(2 * most)
    for i in reversed(range(most)):
        at = F.when(F.col("v") < brackets_of[i]["low"], 2 * i).when(F.col("v") <= brackets_of[i]["high"], 2 * i + 1).otherwise(at)
    held = each.withColumn("at", at).withColumn("x", F.get("b", F.floor(F.col("at") / 2).cast("int"))).withColumn("value", F.when(F.col("at") % 2 == 1, F.col("v")))
    cell = F.when(F.col("value").isNotNull(), F.coalesce(F.width_bucket("v", F.col("x.low"), F.col("x.high"), F.lit(CELLS)), F.lit(0)))
    long = held.select(*by, "signal", "at", cell.cast("long").alias("cell"), "value")
    counted = long.groupBy(*by, "signal", "at", "cell", "value").agg(F.count(F.lit(1)).alias("n"))
    cells = counted.groupBy(*by, "signal", "at", "cell").agg(F.sum("n").alias("n"), F.array_sort(F.collect_list(F.struct("value", "n"))).alias("held"))
    every = Window.partitionBy(*by, "signal")
    ranked = cells.select("*", F.sum("n").over(every.orderBy("at", "cell")).alias("to"), F.sum("n").over(every).alias("total"))

    def asked(i: int, q: float) -> Column:
        place = F.lit(float(q)) * (F.col("total") - 1)
        return F.struct(F.lit(i).alias("level"), (F.round(place) if q in nearest else place).alias("place"))

    inside = lambda place: (place < F.col("to")) & (place >= F.col("to") - F.col("n"))
    places = F.filter(F.array(*[asked(i, q) for i, q in enumerate(levels)]), lambda a: inside(F.floor(a["place"])) | inside(F.ceil(a["place"])))
    met = ranked.select(*by, "signal", "total", (F.col("to") - F.col("n")).alias("under"), "to", "n", "held", F.explode(places).alias("a")).select("*", "a.level", "a.place")

    def value(place: Column) -> Column:
        """The value at a place of the cell."""
        state = F.struct(F.col("under").alias("to"), F.lit(None).cast("double").alias("value"))
        step = lambda s, x: F.struct((s["to"] + x["n"]).alias("to"), F.when((s["to"] <= place) & (place < s["to"] + x["n"]), x["value"]).otherwise(s["value"]).alias("value"))
        return F.when(inside(place), F.aggregate("held", state, step)["value"])

    found = met.groupBy(*by, "signal", "total", "level", "place").agg(F.max(value(F.floor("place"))).alias("low"), F.max(value(F.ceil("place"))).alias("high"))
    between = (F.ceil("place") - F.col("place")) * F.col("low") + (F.col("place") - F.floor("place")) * F.col("high")
    told = found.withColumn("value", F.when(F.col("low") == F.col("high"), F.col("low")).otherwise(between))
    body = [F.expr(f"max(if(signal = {k}, total, NULL)) AS {n}n") for k, n in enumerate(names)]
    body += [F.expr(f"max(if(signal = {k} AND level = {i}, value, NULL)) AS {n}q{i}") for k, n in enumerate(names) for i in range(len(levels))]
    return _grouped(told, by, body)


def same(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """``left`` with the columns of ``right`` where ``keys`` agree, null being a value; without keys the one row of ``right``, if any, meets all."""
    other = right.select(*[F.col(c).alias(f"{c}_of") for c in keys], *[c for c in right.columns if c not in keys])
    if not keys:
        return left.crossJoin(F.broadcast(other))
    return left.join(other, reduce(and_, [left[c].eqNullSafe(other[f"{c}_of"]) for c in keys]), how).drop(*[f"{c}_of" for c in keys])
