"""Tolerances: counts or percentages that are turned into counts."""

from __future__ import annotations

import re
from dataclasses import dataclass
from decimal import ROUND_CEILING, Decimal

from lumenspan.functions.scores import COMMON, LEVEL_FIELDS

GATES = ("max_nulls", "max_rules", "max_dups", "max_breaks")
_COUNT, _SHARE = re.compile(r"\d+"), re.compile(r"(\d+(?:\.\d+)?)\s*%")


@dataclass(frozen=True)
class Tolerance:
    """A count, or a share in percent of the rows that the gate looks at."""

    value: Decimal
    share: bool = False

    @staticmethod
    def parse(given: object) -> Tolerance:
        """Blank is zero; ``5`` is a count and ``0.1%`` a share. A fraction without a percent sign or a share above 100 % is
        an error."""
        text = "" if given is None else str(given).strip()
        if not text:
            return Tolerance(Decimal(0))
        if _COUNT.fullmatch(text):
            return Tolerance(Decimal(text))
        if (found := _SHARE.fullmatch(text)) and Decimal(found[1]) <= 100:
            return Tolerance(Decimal(found[1]), True)
        raise ValueError(f"a tolerance is a whole number or a percentage up to 100%, not {text!r}")

    def count(self, rows: int) -> int:
        """The tolerated count, rounded up."""
        return int((self.value / 100 * rows).to_integral_value(ROUND_CEILING)) if self.share else int(self.value)

    def __str__(self) -> str:
        return f"{self.value}%" if self.share else str(self.value)


def parse_gates(given: dict[str, object]) -> dict[str, Tolerance]:
    return {name: Tolerance.parse(given.get(name)) for name in GATES}


def resolve(gates: dict[str, Tolerance], spans: int, traces: int) -> dict[str, int]:
    """Shares are of all spans, that of breaks of all traces."""
    return {name: gate.count(traces if name == "max_breaks" else spans) for name, gate in gates.items()}


def overrides(given: dict[str, object]) -> dict[str, float]:
    """The policy parameters among ``given``, as numbers; blank ones are absent."""
    kinds = {name: int if name == "window_days" else float for name in (*COMMON, *LEVEL_FIELDS) if name != "ceiling_penalty"}
    return {k: kinds[k](v) for k, v in given.items() if k in kinds and v is not None and str(v).strip() != ""}
