"""SQL text for long generated expressions.

A ladder, a list of boxes or a list of centres becomes one ``expr`` call; built
from Column objects, each comparison would cost a round trip to the JVM.
"""

from __future__ import annotations


def literal(value) -> str:
    """SQL literal: doubles stay doubles, text is quoted."""
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, float):
        return f"{value!r}D" if value >= 0 else f"({value!r}D)"
    if isinstance(value, int):
        return str(value)
    escaped = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def case(branches: list[tuple[str, object]], otherwise) -> str:
    """CASE over (condition text, result) pairs."""
    whens = " ".join(f"WHEN {condition} THEN {literal(result)}" for condition, result in branches)
    return f"CASE {whens} ELSE {literal(otherwise)} END"
