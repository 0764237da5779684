"""Named queries and the SQL they must agree with."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.sqltext import CTES

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def with_tables(sql: str) -> str:
    """Prefix the derived tables a statement names, dependencies first."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name, body in CTES.items():
            if name not in needed and re.search(rf"\b{name}\b", text):
                visit(body)
                if name not in needed:
                    needed.append(name)

    visit(sql)
    if not needed:
        return sql
    parts = ",\n".join(f"{n} AS ({CTES[n].strip()})" for n in needed)
    body = sql.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {parts},\n{body[5:]}"
    return f"WITH {parts}\n{body}"


def query(name: str, sql: str | None = None):
    """Register a function of the tables under a name, with SQL where SQL can say it."""
    def add(fn):
        from checks.tables import Tables

        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = lambda spark, sf_dir: fn(Tables(spark, sf_dir))
        if sql is not None:
            SQL[name] = with_tables(sql)
        return fn
    return add


def fixed(df: DataFrame, digits: int = 4, skip: tuple[str, ...] = ()) -> DataFrame:
    """Round every double for comparison. The tiny shift decides exact ties the same way
    whatever the order values were added in."""
    cols: dict[str, Column] = {n: F.round(F.col(n) + F.lit(1e-9), digits)
                               for n, t in df.dtypes if t == "double" and n not in skip}
    return df.withColumns(cols) if cols else df
