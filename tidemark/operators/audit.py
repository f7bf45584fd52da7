"""Audit of a table of SQL statements: which of them only read?"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import strip

# The words a statement may begin with, and the words it must not contain,
# in the order in which they are looked for.
READING = ("SELECT", "WITH", "DESCRIBE", "EXPLAIN")
FORBIDDEN = (
    "DROP", "DELETE", "UPDATE", "INSERT", "ALTER", "TRUNCATE", "CREATE", "ATTACH",
    "DETACH", "COPY", "INSTALL", "LOAD", "PRAGMA", "EXEC", "EXECUTE", "REPLACE",
)
DEFAULT_LIMIT, MAX_LIMIT = 50, 100


#: One scan tells apart strings, quoted names and comments (left out), words, and other signs.
_IGNORED = r"""'[^']*'|"[^"]*"|--[^\n]*|/\*(?s:.*?)\*/"""
_TOKEN = rf"({_IGNORED}|\w+|[^\w\s])"


def bare_statement(col: Column) -> Column:
    """The statement without code fence, outer white space and closing semicolons."""
    parts = F.split(strip(col), "```")
    # between the first two fences, where there are two, behind the name of the language
    named = F.get(parts, F.lit(1))
    fenced = F.when(F.lower(F.substring(named, 1, 3)) == "sql", F.substring(named, 4, 2**31 - 1)).otherwise(named)
    inside = F.when(F.size(parts) > 2, fenced).otherwise(col)
    return strip(F.rtrim(strip(inside), F.lit(";")))


def tokens(col: Column) -> Column:
    """The words and signs of a statement outside strings, quoted names and comments."""
    found = F.regexp_extract_all(col, F.lit(_TOKEN), F.lit(1))
    return F.filter(found, lambda t: ~F.substring(t, 1, 1).isin("'", '"') & ~t.rlike(r"^(--|/\*)") | (F.length(t) == 1))


def audit_statements(df: DataFrame, column: str) -> DataFrame:
    """Add ``statement``, ``is_safe``, ``reason`` (the first broken rule), ``detail`` (the
    word that broke it) and ``row_limit`` (the limit a safe statement would run with)."""
    cleaned = df.withColumn("statement", bare_statement(F.coalesce(column, F.lit(""))))
    code = cleaned.withColumn("_tokens", tokens(F.col("statement")))
    code = code.withColumn("_words", F.transform("_tokens", F.upper))
    opening = F.regexp_extract(F.coalesce(F.get("_words", F.lit(0)), F.lit("")), "^[A-Z]*", 0)
    broken = F.filter(F.array(*map(F.lit, FORBIDDEN)), lambda word: F.array_contains("_words", word))
    words = code.withColumns({"_first": opening, "_found": F.get(broken, F.lit(0))})
    reason = (
        F.when(F.col("statement") == "", F.lit("empty"))
        .when(F.array_contains("_tokens", ";"), F.lit("several statements"))
        .when(F.col("_first") == "", F.lit("unknown statement"))
        .when(~F.col("_first").isin(list(READING)), F.lit("statement type"))
        .when(F.col("_found").isNotNull(), F.lit("forbidden keyword"))
    )
    detail = F.when(F.col("reason") == "statement type", F.col("_first")).when(
        F.col("reason") == "forbidden keyword", F.col("_found")
    )
    last = F.try_element_at("_words", F.lit(-1))
    asked = F.when(F.try_element_at("_words", F.lit(-2)) == "LIMIT", last.try_cast("long"))
    limit = F.when(
        F.col("reason").isNull(), F.least(F.coalesce(asked, F.lit(DEFAULT_LIMIT)), F.lit(MAX_LIMIT))
    )
    return (
        words.withColumn("reason", reason)
        .withColumns(
            {"is_safe": F.col("reason").isNull(), "detail": detail, "row_limit": limit.cast("long")}
        )
        .drop("_tokens", "_words", "_first", "_found")
    )


def audit_counts(audited: DataFrame) -> DataFrame:
    return audited.groupBy("is_safe", "reason", "detail").agg(F.count("*").alias("statements"))
