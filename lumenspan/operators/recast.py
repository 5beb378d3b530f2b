"""Bringing any table of spans to the 46 columns of the specification, and saying how far it was."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from lumenspan.functions.rules import is_in, literal
from lumenspan.plans.spec import SPEC, TYPES, Attr

_TRUE, _FALSE = ("true", "t", "1", "yes", "y"), ("false", "f", "0", "no", "n")
_NESTED = (T.ArrayType, T.StructType, T.MapType, T.VariantType)


def scalar(kind: T.DataType) -> bool:
    return not isinstance(kind, _NESTED)


def _boolean(c: str) -> str:
    token = f"lower(trim(cast({c} AS string)))"
    return f"CASE WHEN {is_in(token, _TRUE)} THEN true WHEN {is_in(token, _FALSE)} THEN false END"


def cast(c: str, source: T.DataType, attr: Attr) -> str:
    """Cast that gives null where the value has no place in the attribute's type or categories; in Spark's SQL."""
    target = TYPES[attr.type]
    if attr.domain:
        text = f"cast({c} AS string)"
        return f"CASE WHEN {is_in(text, attr.domain)} THEN {text} END"
    if source == target:
        return c
    if attr.type == "boolean":
        return _boolean(c)
    if attr.type == "long" and isinstance(source, (T.TimestampType, T.TimestampNTZType)):
        return f"unix_micros(cast({c} AS timestamp)) * 1000"
    if attr.type in ("long", "float") and isinstance(source, T.BooleanType):
        return f"cast(cast({c} AS int) AS {target.simpleString()})"
    return f"try_cast({c} AS {target.simpleString()})"


def _column(df: DataFrame, attr: Attr, strict: bool) -> str:
    kind = TYPES[attr.type].simpleString()
    empty = f"cast({literal(attr.empty)} AS {kind})"
    if attr.name not in df.columns or not scalar(df.schema[attr.name].dataType):
        return f"{empty} AS {attr.name}"
    value = cast(attr.name, df.schema[attr.name].dataType, attr)
    if strict:
        bad = empty if attr.trash is None else f"cast({literal(attr.trash)} AS {kind})"
        value = f"coalesce({value}, CASE WHEN {attr.name} IS NOT NULL THEN {bad} ELSE {empty} END)"
    return f"{value} AS {attr.name}"


def recast(df: DataFrame, strict: bool = True) -> DataFrame:
    """The 46 columns in order: absent or nested columns become the empty value and, if ``strict``, so do nulls, while what
    cannot be cast becomes trash. Otherwise values are only cast."""
    return df.selectExpr(*[_column(df, a, strict) for a in SPEC])


def schema_diff(df: DataFrame, ceiling_penalty: float = 0.12) -> dict:
    """How the columns of ``df`` stand to the specification; reads metadata only.

    States: ok, converted, absent and incompatible. A mandatory attribute that is absent or incompatible is critical; an
    optional one degrades and lowers the ceiling.
    """
    rows = []
    for attr in SPEC:
        if attr.name not in df.columns:
            state, found = "absent", None
        else:
            kind = df.schema[attr.name].dataType
            found = kind.simpleString()
            state = "incompatible" if not scalar(kind) else "ok" if kind == TYPES[attr.type] else "converted"
        rows.append({"attr": attr.name, "mandatory": attr.mandatory, "expected": attr.type, "found": found, "state": state})
    broken = [r for r in rows if r["state"] in ("absent", "incompatible")]
    soft = [r for r in broken if not r["mandatory"]]
    extra = sorted(set(df.columns) - {a.name for a in SPEC})
    ceiling = min(1.0, max(0.0, 1 - ceiling_penalty * len(soft)))
    return {
        "rows": rows,
        "extra": extra,
        "critical_ok": len(broken) == len(soft),
        "degraded": bool(broken),
        "ceiling": ceiling,
        "counts": {
            "expected": len(rows),
            "present": sum(r["state"] != "absent" for r in rows),
            "mandatory": sum(r["mandatory"] for r in rows),
            "mandatory_defects": len(broken) - len(soft),
            "optional_defects": len(soft),
            "extra": len(extra),
            "ceiling_percent": round(100 * ceiling),
        },
    }
