"""Collects queries and the SQL that must give the same rows."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from contract.standins import Tables, VIEWS

QUERIES: dict[str, Callable] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under ``name``."""

    def register(fn: Callable[[Tables], DataFrame]):
        def run(spark, sf_dir: str) -> DataFrame:
            return fn(Tables(spark, sf_dir))

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = with_views(sql)
        return fn

    return register


def with_views(sql: str) -> str:
    """Prefix ``sql`` with the stand-in views it mentions, in dependency order."""
    wanted: list[str] = []

    def visit(text: str) -> None:
        for name in VIEWS:
            if re.search(rf"\b{name}\b", text) and name not in wanted:
                visit(VIEWS[name])
                wanted.append(name)

    visit(sql)
    if not wanted:
        return sql
    heads = [f"{name} as ({VIEWS[name]})" for name in wanted]
    body = sql.strip()
    match = re.match(r"with\s+(recursive\s+)?", body, flags=re.IGNORECASE)
    recursive = ""
    if match:
        recursive = match.group(1) or ""
        return f"with {recursive}{', '.join(heads)}, {body[match.end():]}"
    return f"with {', '.join(heads)} {body}"


def r6(column: Column | str) -> Column:
    """Six decimals, without a negative zero."""
    column = F.col(column) if isinstance(column, str) else column
    return F.round(column, 6) + F.lit(0.0)


def big(column: Column | str) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return column.cast("bigint")
