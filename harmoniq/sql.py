"""SQL surface: the canonical tables as temp views and a capped runner.

Spark SQL gives the whole operator set (joins of every kind, grouping
sets, windows, set operations) over the same tables; nothing is parsed
here beyond removing a trailing ';' so the cap can wrap the statement.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def register_views(tables: dict[str, DataFrame]) -> None:
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def run_sql(spark: SparkSession, text: str, cap: int | None = None) -> DataFrame:
    """Run one SELECT and cap the result.  The statement is wrapped as a
    subquery (a statement already ending in LIMIT keeps its own limit),
    never concatenated with ' LIMIT n'."""
    stmt = text.strip()
    while stmt.endswith(";"):
        stmt = stmt[:-1].rstrip()
    df = spark.sql(stmt)
    return df.limit(cap) if cap is not None else df
