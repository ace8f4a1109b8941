"""Batch audit of a query log: verdict, first offending table, bounded query."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weekloom.fixed_values import (
    ALLOWED_TABLES, BLOCKED_PATTERN, CTE_PATTERN, LIMIT_PATTERN, MESSAGE_MULTI, MESSAGE_READ_ONLY, MESSAGE_TABLE,
    READ_START_PATTERN, ROW_LIMIT, TABLE_PATTERN,
)

COMMA_JOIN_PATTERN = r"(?i)\bfrom\s+[A-Za-z0-9_.\"]+(?:\s+(?:as\s+)?[A-Za-z0-9_]+)?\s*,"


def normalise(query: Column) -> Column:
    """Outer white space and then trailing semicolons removed."""
    trimmed = F.regexp_replace(query, r"^\s+|\s+$", "")
    return F.regexp_replace(trimmed, ";+$", "")


def cte_names(query: Column) -> Column:
    return F.transform(F.regexp_extract_all(query, F.lit(CTE_PATTERN), F.lit(1)), F.upper)


def table_names(query: Column) -> Column:
    """Names after FROM or JOIN, as written."""
    return F.regexp_extract_all(query, F.lit(TABLE_PATTERN), F.lit(1))


def bounded(query: Column, limit: int = ROW_LIMIT) -> Column:
    """The query with a LIMIT at its end."""
    return F.when(query.rlike(LIMIT_PATTERN), query).otherwise(F.concat(query, F.lit(f" LIMIT {limit}")))


def audit_queries(
    log: DataFrame, query: str = "QUERY", allowed: Sequence[str] = tuple(ALLOWED_TABLES)
) -> DataFrame:
    """Add VERDICT, OFFENDER, ERROR, EXECUTED_SQL and COMMA_JOIN to a query log.

    A missing query is refused as not read-only.
    """
    text = F.col("_TEXT")
    ctes, tables = F.col("_CTES"), F.col("_TABLES")
    permitted = F.array(*[F.lit(t.upper()) for t in allowed])

    def unlisted(name: Column) -> Column:
        plain = F.upper(F.replace(name, F.lit('"'), F.lit("")))
        return ~F.array_contains(permitted, plain) & ~F.array_contains(ctes, plain)

    parsed = log.withColumn("_TEXT", normalise(F.col(query))).withColumns(
        {"_CTES": cte_names(text), "_TABLES": table_names(text)}
    ).withColumn("_OFFENDER", F.get(F.filter(tables, unlisted), F.lit(0)))
    read_only = text.rlike(READ_START_PATTERN) & ~text.rlike("(?i)" + BLOCKED_PATTERN)
    verdict = (
        F.when(text.contains(";"), "multi_statement")
        .when(~F.coalesce(read_only, F.lit(False)), "not_read_only")
        .when(F.col("_OFFENDER").isNotNull(), "table_not_allowed")
        .otherwise("accepted")
    )
    judged = parsed.withColumn("VERDICT", verdict)
    table_error = F.col("VERDICT") == "table_not_allowed"
    return judged.withColumns({
        "OFFENDER": F.when(table_error, F.col("_OFFENDER")),
        "ERROR": F.when(F.col("VERDICT") == "multi_statement", MESSAGE_MULTI)
        .when(F.col("VERDICT") == "not_read_only", MESSAGE_READ_ONLY)
        .when(table_error, F.format_string(MESSAGE_TABLE, F.col("_OFFENDER"))),
        "EXECUTED_SQL": F.when(F.col("VERDICT") == "accepted", bounded(text)),
        "COMMA_JOIN": text.rlike(COMMA_JOIN_PATTERN),
    }).drop("_TEXT", "_CTES", "_TABLES", "_OFFENDER")
