"""Independent SQL for every query, run by DuckDB on the same parquet tables."""

from __future__ import annotations

import re

from oracle.base import RELATIONS


def _needed(sql: str) -> list[str]:
    """Relations a statement uses, each after the ones it depends on."""
    found: list[str] = []

    def visit(text: str) -> None:
        for name in RELATIONS:
            if name not in found and re.search(rf"\b(?:FROM|JOIN)\s+{name}\b", text):
                visit(RELATIONS[name])
                if name not in found:
                    found.append(name)

    visit(sql)
    return found


def statement(sql: str, doubles: str = "") -> str:
    """A full statement: the relations in front, and named doubles rounded to six digits.

    The offset keeps values that sit on a rounding tie from splitting between engines.
    """
    body = f"SELECT * FROM ({sql})"
    if doubles:
        rounded = ", ".join(
            f"CAST(ROUND({name} + CAST(1e-9 AS DOUBLE), 6) AS DOUBLE) AS {name}" for name in doubles.split()
        )
        body = f"SELECT * REPLACE ({rounded}) FROM ({sql})"
    names = _needed(sql)
    if not names:
        return body
    texts = [sql, *(RELATIONS[name] for name in names)]
    relations = [f"{name} AS {_kind(name, texts)} ({RELATIONS[name]})" for name in names]
    return "WITH " + ",\n".join(relations) + "\n" + body


def _kind(name: str, texts: list[str]) -> str:
    """What several relations read is computed once."""
    uses = sum(len(re.findall(rf"\b(?:FROM|JOIN)\s+{name}\b", text)) for text in texts)
    return "MATERIALIZED" if uses > 1 else "NOT MATERIALIZED"
