"""Registered queries: a Spark plan over the given tables and, where SQL can say it, the SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from anemora.session import configure

Query = Callable[[SparkSession, str], DataFrame]

NUDGE = 1e-11
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round doubles for comparison across engines.

    A nudge far above summation noise and far below the last digit keeps exact halves from
    falling either way with the order of summation; adding zero folds -0.0 into 0.0.
    """
    return df.select(*[
        (F.round(F.col(f"`{name}`") + F.lit(NUDGE), digits) + F.lit(0.0)).alias(name) if kind == "double" else F.col(f"`{name}`")
        for name, kind in df.dtypes
    ])


def query(name: str, sql: str | None = None, doubles: str = "", digits: int = 6) -> Callable[[Query], Query]:
    """Register a query; ``doubles`` names the SQL columns to round like the Spark side."""
    def add(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return rounded(build(configure(spark), sf_dir), digits)

        run.__name__ = name
        run.__doc__ = build.__doc__
        QUERIES[name] = run
        if sql is not None:
            text = sql.strip()
            if doubles:
                replaced = ", ".join(f"round({c} + {NUDGE}, {digits}) + 0e0 AS {c}" for c in doubles.split())
                text = f"SELECT * REPLACE ({replaced}) FROM (\n{text}\n)"
            SQL[name] = text
        return build

    return add
