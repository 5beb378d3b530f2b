"""Per-cell flags of spans and their sums along a row."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from lumenspan.functions.rules import literal
from lumenspan.plans.spec import MANDATORY, Attr


def is_error() -> Column:
    return F.col("status_code") == "STATUS_CODE_ERROR"


def is_llm() -> Column:
    return F.col("aef_kind") == "llm"


def is_http() -> Column:
    return F.col("aef_kind").isin("input_request", "output_request")


def is_kafka() -> Column:
    return F.col("aef_kind").isin("kafka_produce", "kafka_consume")


def is_dialog() -> Column:
    return F.col("aef_kind") == "input_request"


@dataclass(frozen=True)
class Flag:
    """A condition on one cell: ``sql`` is its text in Spark's SQL, calling it gives the column."""

    sql: Callable[[Attr], str]

    def __call__(self, attr: Attr) -> Column:
        return F.expr(self.sql(attr))


valid = Flag(lambda a: f"({a.name} IS NOT NULL AND ({a.rule.holds(a.name)}))")
#: Not valid; where the rule itself is null, that counts as a violation.
violation = Flag(lambda a: f"coalesce(NOT {valid.sql(a)}, true)")
missing = Flag(lambda a: f"{a.name} IS NULL" if a.empty is None else f"({a.name} IS NULL OR {a.name} = {literal(a.empty)})")
#: Whether the cell could not be cast; null for a null cell, and false for booleans, which have no trash value.
trash = Flag(lambda a: "false" if a.trash is None else f"{a.name} = {literal(a.trash)}")
null = Flag(lambda a: f"{a.name} IS NULL")


def across(flag: Flag, attrs: Iterable[Attr]) -> Column:
    """Number of flagged cells in the row; null if a flag is null."""
    return F.expr(" + ".join(f"cast({flag.sql(a)} AS bigint)" for a in attrs))


def share(flag: Flag, attrs: tuple[Attr, ...]) -> Column:
    return across(flag, attrs) / F.lit(len(attrs))


def blocking() -> Column:
    """Whether any mandatory attribute is violated."""
    return F.expr(" OR ".join(violation.sql(a) for a in MANDATORY))


def json_value(text: Column) -> Column:
    """The decoded value of a strict JSON text as a variant, null where it is none."""
    return F.when(is_json(text), F.try_parse_json(text))


def is_json(text: Column) -> Column:
    """Whether the text is strict JSON without repeated keys; null for null. The pattern ``json`` of the rules only looks at the brackets at its ends.

    The parser ignores what stands behind a value, so the text has to be both the only item of an array and the only value of an
    object, which nothing but one whole value can be.
    """
    item, value = (F.try_parse_json(F.concat(F.lit(a), text, F.lit(b))) for a, b in (("[", "]"), ('{"x":', "}")))
    return F.when(text.isNotNull(), item.isNotNull() & value.isNotNull())
