"""SQL text of names and literals.

Expressions with many parts are written as SQL text: the JVM parses one string
instead of being called once per part, which keeps wide plans quick to build.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping


def text(value: object) -> str:
    """A literal: null, number, or quoted string."""
    if value is None:
        return "CAST(NULL AS STRING)"
    if isinstance(value, int | float) and not isinstance(value, bool):
        return str(value)
    escaped = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def name(column: str) -> str:
    """A quoted column name."""
    return "`" + column.replace("`", "``") + "`"


def struct(fields: Mapping[str, str]) -> str:
    """A struct of named expressions."""
    return "named_struct(" + ", ".join(f"{text(k)}, {e}" for k, e in fields.items()) + ")"


def rows(records: Iterable[Mapping[str, object]]) -> str:
    """An array of structs of literals, folded into one constant."""
    return "array(" + ", ".join(struct({k: text(v) for k, v in r.items()}) for r in records) + ")"
