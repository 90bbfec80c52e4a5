"""Column names in SQL text.

Wide projections are written as text: a Column object costs several calls into the JVM, and
a target of 77 columns over ten logs would need thousands of them.
"""

from __future__ import annotations

from collections.abc import Iterable


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def field(struct: str, name: str) -> str:
    return f"{quoted(struct)}.{quoted(name)}"


def first_value(values: Iterable[str], name: str) -> str:
    """The first of the SQL `values` that is not NULL, as `name`."""
    return f"coalesce({', '.join(values)}) AS {quoted(name)}"
