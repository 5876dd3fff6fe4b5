"""Helpers for writing expressions as SQL text.

The functions of this package take and return SQL text and leave it to the
caller to wrap it with ``F.expr``. A nested expression then reaches the JVM in
one call, where building it from ``Column`` objects takes one call per node.
"""

from pyspark.sql import DataFrame


def literal(text: str) -> str:
    """``text`` as a SQL string literal."""
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def literals(texts) -> str:
    return ", ".join(map(literal, texts))


def cases(branches: dict[str, str], otherwise: str | None = None) -> str:
    """``CASE`` over ``condition -> result`` pairs."""
    body = " ".join(f"WHEN {condition} THEN {result}" for condition, result in branches.items())
    return f"CASE {body}{'' if otherwise is None else f' ELSE {otherwise}'} END"


def fill(template: str, *values: str) -> str:
    """Concatenation that fills the ``%s`` slots of a template; a null value prints as ``null``."""
    pieces = template.split("%s")
    parts = [literal(pieces[0])]
    for value, piece in zip(values, pieces[1:], strict=True):
        parts += [f"coalesce(CAST({value} AS STRING), 'null')", literal(piece)]
    return f"concat({', '.join(part for part in parts if part != literal(''))})"


def computed_once(df: DataFrame, expression: str, name: str) -> DataFrame:
    """Add a column whose expression runs once per row.

    A filter on a column drawn from a costly expression is normally pushed
    below it, where the expression runs again for every mention. A generated
    row is a step that filters do not cross.
    """
    return df.selectExpr("*", f"explode(array({expression})) AS {name}")
