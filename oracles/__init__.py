"""Plain SQL for the queries, to be run by DuckDB on the same tables.

``views.sql`` holds named helper views, ``queries.sql`` one statement per query. Each block starts with
``-- name: <name>``. A statement gets the views it uses, directly or through other views, as a WITH list.
"""

from __future__ import annotations

import re
from pathlib import Path

from placefolio.operators.extraction import PROMPT

# Where the queries are compared with their SQL.
COMPARED_DIR = "/root/testdata/sf0.01"
_HERE = Path(__file__).parent


def _blocks(file: str) -> dict[str, str]:
    parts = re.split(r"^-- name: (\w+)\s*$", (_HERE / file).read_text(encoding="utf-8"), flags=re.M)
    return {name: body.strip().rstrip(";") for name, body in zip(parts[1::2], parts[2::2])}


def load_oracles(sf_dir: str = COMPARED_DIR) -> dict[str, str]:
    """``sf_dir`` matters only to the query over files: SQL does not know which folder its tables lie in."""
    views = _blocks("views.sql")

    def needed(sql: str, seen: list[str]) -> list[str]:
        for name in views:
            if name not in seen and re.search(rf"\b{name}\b", sql):
                needed(views[name], seen)
                seen.append(name)
        return seen

    result = {}
    for name, sql in _blocks("queries.sql").items():
        names = needed(sql, [])
        own_views = sql.startswith("WITH ")
        parts = [f"{view} AS (\n{views[view]}\n)" for view in names]
        if names:
            sql = "WITH " + ",\n".join(parts) + (",\n" + sql.removeprefix("WITH ") if own_views else "\n" + sql)
        quoted = lambda text: "'" + text.replace("'", "''") + "'"
        result[name] = sql.replace(":prompt", quoted(PROMPT)).replace(":folder", quoted(f"{sf_dir}/*.parquet"))
    return result
