"""The rule gate: one array of reasons per session, as a single column expression."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.rules import RULES, PersonaError, structure_rule


def gate(turns: Column, constraints: Mapping[str, str], name: str = "", min_turns: int = 2, max_turns: int = 16, rules: Mapping[str, Callable] = RULES) -> Column:
    """Reasons against a session, structure first, then one rule per constraint in table order.

    Empty if the session passes. A session without turns only gets the structural reason. Everything is
    a built-in expression, so the gate stays inside generated code and below no Python boundary.
    """
    checks = structure_rule(min_turns, max_turns)
    for key, value in constraints.items():
        if key not in rules:
            raise PersonaError(f"unknown constraint {key!r}; known: {list(rules)}")
        checks = checks + list(rules[key](name, value))
    reasons = F.array_distinct(F.array_compact(F.array(*(F.when(test(turns), F.lit(reason)) for reason, test in checks))))
    return F.when(F.size(turns) == 0, F.array(F.lit("empty"))).otherwise(reasons)
