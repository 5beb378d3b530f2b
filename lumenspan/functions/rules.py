"""Attribute rules as small trees, from which Spark's SQL, DuckDB's SQL and the wording are rendered."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

_ITEM = r'"[^"\\]*+(?:\\[^\n][^"\\]*+)*+"'

#: Fixed values. Whole-string patterns for Java's engine: ``\z`` is the very end, ``(?U)`` gives Unicode digits and spaces,
#: and possessive quantifiers keep long texts off the stack.
PATTERNS = {
    "base64": r"\A[A-Za-z0-9+/]+={0,2}\z",
    "one_line": r"\A[^\n]+\z",
    "element": r"\AC[IE][0-9]+\z",
    "version": r"(?U)\A(\d+|\?)\.(\d+|\?)\.(\d+|\?)\z",
    "json_strings": rf"(?U)\A\[\s*{_ITEM}(?:\s*,\s*{_ITEM})*+\s*\]\z",
    "json": r"(?U)\A\s*(\{[\s\S]*\}|\[[\s\S]*\])\s*\z",
}


def automaton(pattern: str) -> str:
    """A pattern for an engine that neither goes back nor knows ``(?U)``: classes are spelt out, possessive marks dropped."""
    plain = pattern.removeprefix("(?U)").replace("*+", "*").replace(r"[\s\S]", "(?s:.)")
    return plain.replace(r"\d", r"\p{Nd}").replace(r"\s", r"[\t-\r\x{85}\p{Z}]")


def literal(value: object) -> str:
    """A value in Spark's SQL."""
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, float):
        return f"{value!r}D"
    return str(value) if isinstance(value, int) else "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def standard_literal(value: object) -> str:
    """A value in standard SQL."""
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    return repr(value) if isinstance(value, float) else literal(value)


@dataclass(frozen=True)
class Dialect:
    """What differs between the engines that judge a rule."""

    value: Callable[[object], str]
    form: Callable[[str, str], str]
    length: str

    def among(self, column: str, values: tuple[object, ...]) -> str:
        return f"{column} IN ({', '.join(map(self.value, values))})"


SPARK = Dialect(literal, lambda c, name: f"{c} RLIKE r'{PATTERNS[name]}'", "char_length")
DUCKDB = Dialect(standard_literal, lambda c, name: f"regexp_matches({c}, {standard_literal(automaton(PATTERNS[name]))})", "length")


def is_in(column: str, values: tuple[str, ...]) -> str:
    return SPARK.among(column, values)


class Rule:
    """A condition on a column. Null where the column is null, unless the rule does not look at it."""

    def sql(self, column: str, to: Dialect) -> str:
        raise NotImplementedError

    @property
    def text(self) -> str:
        raise NotImplementedError

    def holds(self, column: str) -> str:
        """The condition in Spark's SQL."""
        return self.sql(column, SPARK)


@dataclass(frozen=True)
class Anything(Rule):
    text = "any value"

    def sql(self, column: str, to: Dialect) -> str:
        return "true"


@dataclass(frozen=True)
class NotEmpty(Rule):
    text = "not empty"

    def sql(self, column: str, to: Dialect) -> str:
        return f"{to.length}({column}) > 0"


@dataclass(frozen=True)
class Matches(Rule):
    form: str

    def sql(self, column: str, to: Dialect) -> str:
        return to.form(column, self.form)

    @property
    def text(self) -> str:
        return f"has the form {self.form}"


@dataclass(frozen=True)
class Equals(Rule):
    value: object

    def sql(self, column: str, to: Dialect) -> str:
        return f"{column} = {to.value(self.value)}"

    @property
    def text(self) -> str:
        return f"equals {self.value!r}"


@dataclass(frozen=True)
class AtLeast(Rule):
    low: float

    def sql(self, column: str, to: Dialect) -> str:
        return f"{column} >= {to.value(self.low)}"

    @property
    def text(self) -> str:
        return f"at least {self.low}"


@dataclass(frozen=True)
class Between(Rule):
    low: float
    high: float

    def sql(self, column: str, to: Dialect) -> str:
        return f"{column} BETWEEN {to.value(self.low)} AND {to.value(self.high)}"

    @property
    def text(self) -> str:
        return f"between {self.low} and {self.high}"


@dataclass(frozen=True)
class OneOf(Rule):
    values: tuple[str, ...]

    def sql(self, column: str, to: Dialect) -> str:
        return to.among(column, self.values)

    @property
    def text(self) -> str:
        return "one of " + ", ".join(self.values)


@dataclass(frozen=True)
class AtLeastColumn(Rule):
    other: str

    def sql(self, column: str, to: Dialect) -> str:
        return f"{column} >= {self.other}"

    @property
    def text(self) -> str:
        return f"at least {self.other}"


@dataclass(frozen=True)
class NotBoth(Rule):
    first: str
    second: str

    def sql(self, column: str, to: Dialect) -> str:
        return f"NOT ({self.first} AND {self.second})"

    @property
    def text(self) -> str:
        return f"not both {self.first} and {self.second}"


@dataclass(frozen=True)
class Either(Rule):
    one: Rule
    two: Rule

    def sql(self, column: str, to: Dialect) -> str:
        return f"({self.one.sql(column, to)} OR {self.two.sql(column, to)})"

    @property
    def text(self) -> str:
        return f"{self.one.text} or {self.two.text}"


@dataclass(frozen=True)
class Where(Rule):
    """``then`` where ``column`` has one of ``values``, else ``otherwise``."""

    column: str
    values: tuple[str, ...]
    then: Rule
    otherwise: Rule

    def sql(self, column: str, to: Dialect) -> str:
        return f"CASE WHEN {to.among(self.column, self.values)} THEN {self.then.sql(column, to)} ELSE {self.otherwise.sql(column, to)} END"

    @property
    def text(self) -> str:
        return f"if {self.column} is {' or '.join(self.values)}: {self.then.text}; else {self.otherwise.text}"
