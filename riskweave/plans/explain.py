"""Physical plan of a frame as a table: operators, joins, scans and what was pushed to them.

Built from the text that ``DataFrame.explain("formatted")`` prints, so only public API is used
and no job runs. Before a query has run, adaptive plans are shown as first planned.
"""

from __future__ import annotations

import io
import re
from contextlib import redirect_stdout

from pyspark.sql import DataFrame

SCHEMA = ("id int, operator string, detail string, depth int, pushed string, partitions string, "
          "columns string, keys string, codegen int")
# A line of the tree: nesting, an optional codegen mark, name, number.
NODE = re.compile(r"^([\s:|+*-]*?)(?:\*\s*)?([A-Z][\w ]*?)(?: (\S.*?))?\s*\((\d+)\)\s*$")
HEAD = re.compile(r"^\((\d+)\) (.+?)(?: \[codegen id : (\d+)\])?\s*$")
FIELD = re.compile(r"^(PushedFilters|PartitionFilters|ReadSchema|Left keys|Arguments|Keys)"
                   r"[^:]*: (.*)$")


def formatted(df: DataFrame) -> str:
    """The printed plan, without the numbers that differ from one planning to the next."""
    text = io.StringIO()
    with redirect_stdout(text):
        df.explain("formatted")
    return re.sub(r"#\d+L?|, \[plan_id=\d+\]", "", text.getvalue())


def operators(text: str) -> list[dict]:
    """Operators of a formatted plan, in the order of its tree."""
    tree, _, details = text.partition("\n\n")
    found: dict[int, dict] = {}
    for line in tree.splitlines():
        m = NODE.match(line)
        if m:
            found[int(m[4])] = {"id": int(m[4]), "operator": m[2].strip(), "detail": m[3],
                                "depth": len(m[1]) // 3, "pushed": None, "partitions": None,
                                "columns": None, "keys": None, "codegen": None}
    at = None
    for line in details.splitlines():
        if m := HEAD.match(line):
            at = found.get(int(m[1]))
            if at is not None and m[3]:
                at["codegen"] = int(m[3])
        elif at is not None and (m := FIELD.match(line)):
            inside = m[2].strip()
            if inside.startswith("[") and inside.endswith("]"):
                inside = inside[1:-1]
            name = {"PushedFilters": "pushed", "PartitionFilters": "partitions",
                    "ReadSchema": "columns", "Left keys": "keys", "Arguments": "keys",
                    "Keys": "keys"}[m[1]]
            at[name] = at[name] or inside or None
    return list(found.values())


def plan_rows(df: DataFrame) -> list[dict]:
    return operators(formatted(df))


def plan_table(df: DataFrame) -> DataFrame:
    """One row per operator: id, operator, detail, depth in the tree, pushed and partition
    filters and columns of scans, keys of joins, exchanges and aggregates, codegen span."""
    names = [part.split()[0] for part in SCHEMA.split(", ")]
    return df.sparkSession.createDataFrame(
        [tuple(row[n] for n in names) for row in plan_rows(df)], SCHEMA)


def count(df: DataFrame, operator: str) -> int:
    """Operators whose name begins so, such as ``Exchange`` or ``SortMergeJoin``."""
    return sum(row["operator"].startswith(operator) for row in plan_rows(df))
