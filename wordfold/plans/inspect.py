"""Plan inspection helpers (used by tests and when tuning a query)."""

from __future__ import annotations

import contextlib
import io

from pyspark.sql import DataFrame

# Physical nodes that mean rows leave the JVM for Python.
PYTHON_NODES = (
    "BatchEvalPython",
    "ArrowEvalPython",
    "MapInPandas",
    "MapInArrow",
    "FlatMapGroupsInPandas",
    "FlatMapCoGroupsInPandas",
    "PythonUDF",
)
# Physical nodes that pair every row with every row.
PAIRWISE_NODES = ("CartesianProduct", "BroadcastNestedLoopJoin")


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """The text ``df.explain(mode)`` prints."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def physical_tree(df: DataFrame) -> str:
    """Only the operator tree of the formatted physical plan."""
    text = plan_text(df, "formatted")
    tree = text.split("\n\n\n", 1)[0]
    return tree


def read_schemas(df: DataFrame) -> list[str]:
    """The ``ReadSchema`` of every scan in the plan."""
    return [line.split(":", 1)[1].strip() for line in plan_text(df).splitlines() if line.startswith("ReadSchema:")]
