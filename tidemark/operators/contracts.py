"""Data contracts: declarative rules evaluated as Spark jobs, one result row per rule."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numbers import round_even
from tidemark.operators.compare import union_all

NOT_NULL, PRIMARY_KEY, RANGE = "NOT_NULL", "PRIMARY_KEY", "CHECK_RANGE"
FOREIGN_KEY, ENUM = "FOREIGN_KEY", "ENUM_TAXONOMY"


@dataclass(frozen=True)
class Rule:
    table: str
    kind: str
    column: str
    target: str
    low: float | None = None
    high: float | None = None
    allowed: tuple[Any, ...] = ()
    parent: str | None = None
    parent_column: str | None = None
    allow_null: bool = True


def not_null(table: str, column: str) -> Rule:
    return Rule(table, NOT_NULL, column, column, allow_null=False)


def unique(table: str, column: str) -> Rule:
    return Rule(table, PRIMARY_KEY, column, column)


def in_range(
    table: str, column: str, low: float | None = None, high: float | None = None,
    allow_null: bool = True, target: str | None = None,
) -> Rule:
    """Closed range; either end may be open."""
    return Rule(table, RANGE, column, target or column, low=low, high=high, allow_null=allow_null)


def one_of(table: str, column: str, allowed: Iterable, allow_null: bool = True, target: str | None = None) -> Rule:
    return Rule(table, ENUM, column, target or column, allowed=tuple(sorted(allowed)), allow_null=allow_null)


def references(table: str, column: str, parent: str, parent_column: str, allow_null: bool = False) -> Rule:
    return Rule(
        table, FOREIGN_KEY, column, f"{column} -> {parent}.{parent_column}",
        parent=parent, parent_column=parent_column, allow_null=allow_null,
    )


class ContractViolation(RuntimeError):
    """Publication stopped because rules failed."""


def _missing(df: DataFrame, column: str) -> Column:
    """Null, or NaN in a floating-point column."""
    col = F.col(column)
    is_float = df.schema[column].dataType.typeName() in ("double", "float")
    return (col.isNull() | F.isnan(col)) if is_float else col.isNull()


def _texts(rule: Rule) -> tuple[Column, Column, Column]:
    """Details for failure, success and nothing to check, over ``checked`` and ``violations``."""
    bad, total = F.col("violations").cast("string"), F.col("checked").cast("string")
    bounds = f"[{rule.low}, {rule.high}]"
    return {
        NOT_NULL: (
            F.concat(bad, F.lit(" nulls found out of "), total, F.lit(" rows")),
            F.concat(F.lit("0 nulls across "), total, F.lit(" rows")),
            F.lit("0 nulls across 0 rows"),
        ),
        PRIMARY_KEY: (
            F.concat(bad, F.lit(" duplicate keys found")),
            F.concat(F.lit("All "), total, F.lit(" keys are unique")),
            F.lit("All 0 keys are unique"),
        ),
        RANGE: (
            F.concat(bad, F.lit(f" values outside bounds {bounds}")),
            F.concat(F.lit("All "), total, F.lit(f" values within bounds {bounds}")),
            F.lit("0 non-null values to check"),
        ),
        FOREIGN_KEY: (
            F.concat(bad, F.lit(" orphan FK values not found in parent table")),
            F.concat(F.lit("All "), total, F.lit(" foreign keys resolve to parent table")),
            F.lit("0 keys to check"),
        ),
        ENUM: (
            F.concat(bad, F.lit(f" values outside allowed enum set {list(rule.allowed)}")),
            F.concat(F.lit("All "), total, F.lit(" values match allowed categories")),
            F.lit("0 values to check"),
        ),
    }[rule.kind]


def _result(number: int, rule: Rule, missing: str | None = None) -> list[Column]:
    """The result columns of a rule over ``rows``, ``checked`` and ``violations``."""
    failed = F.lit(True) if missing else F.col("violations") > 0
    fail, ok, nothing = _texts(rule)
    rate = F.when(F.col("checked") > 0, (F.col("checked") - F.col("violations")) / F.col("checked") * 100)
    return [
        F.lit(number).alias("rule"),
        F.lit(rule.table).alias("table_name"),
        F.lit(rule.kind).alias("constraint_type"),
        F.lit(rule.target).alias("target"),
        F.when(failed, F.lit("FAIL")).otherwise(F.lit("PASS")).alias("status"),
        F.lit(0.0).alias("pass_rate_pct")
        if missing
        else round_even(F.coalesce(rate, F.lit(100.0)), 2).alias("pass_rate_pct"),
        F.col("violations").cast("long").alias("violations"),
        (
            F.lit(missing)
            if missing
            else F.when(failed, fail).when(F.col("checked") == 0, nothing).otherwise(ok)
        ).alias("details"),
        F.col("rows").alias("_rows"),
    ]


def _column_rules(df: DataFrame, rules: Sequence[tuple[int, Rule, str | None]]) -> list[DataFrame]:
    """NOT NULL, RANGE and ENUM rules of one table, and rules on missing columns, in a
    single aggregation over the table."""
    aggregates = [F.count("*").alias("rows")]
    for number, rule, missing in rules:
        if missing:
            continue
        col, absent = F.col(rule.column), _missing(df, rule.column)
        if rule.kind == NOT_NULL:
            broken, checked = absent, F.lit(True)
        else:
            checked = ~absent if rule.allow_null else F.lit(True)
            if rule.kind == RANGE:
                inside = F.lit(True)
                if rule.low is not None:
                    inside = inside & (col >= F.lit(rule.low))
                if rule.high is not None:
                    inside = inside & (col <= F.lit(rule.high))
            else:
                inside = col.isin(list(rule.allowed))
            broken = checked & (absent | ~inside)
        aggregates.append(F.count(F.when(checked, 1)).alias(f"c{number}"))
        aggregates.append(F.count(F.when(broken, 1)).alias(f"v{number}"))
    counted = df.agg(*aggregates)
    picks = [
        F.struct(
            F.lit(number).alias("n"),
            F.col("rows"),
            (F.col("rows") if missing else F.col(f"c{number}")).alias("checked"),
            (F.col("rows") if missing else F.col(f"v{number}")).alias("violations"),
        )
        for number, _, missing in rules
    ]
    # one row per rule out of the one row of counts; each branch below reads the constants
    # of its rule
    spread = counted.select(F.explode(F.array(*picks)).alias("r")).select("r.*")
    branches = [F.when(F.col("n") == number, F.struct(*_result(number, rule, missing))) for number, rule, missing in rules]
    return [spread.select(F.coalesce(*branches).alias("x")).select("x.*")]


def _unique_rule(df: DataFrame, number: int, rule: Rule) -> DataFrame:
    """Repeats of a key beyond its first row; all nulls are one key."""
    counts = df.groupBy(F.col(rule.column).alias("_key")).agg(F.count("*").alias("n"))
    total = counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("checked"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("violations"),
    )
    return total.select(*_result(number, rule))


def _reference_rule(child: DataFrame, parent: DataFrame, number: int, rule: Rule) -> DataFrame:
    """Orphans. The child is counted per key first, so the join has one row per key."""
    key = F.col(rule.column)
    counts = child.groupBy(key.alias("_key")).agg(F.count("*").alias("n"))
    parents = parent.select(F.col(rule.parent_column).alias("_parent")).filter("_parent IS NOT NULL").distinct()
    joined = counts.join(parents, F.col("_key") == F.col("_parent"), "left")
    checked = F.col("_key").isNotNull() if rule.allow_null else F.lit(True)
    total = joined.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.when(checked, F.col("n"))), F.lit(0)).alias("checked"),
        F.coalesce(F.sum(F.when(checked & F.col("_parent").isNull(), F.col("n"))), F.lit(0)).alias("violations"),
    )
    return total.select(*_result(number, rule))


def evaluate(tables: Mapping[str, DataFrame], rules: Sequence[Rule]) -> DataFrame:
    """One row per rule: table, constraint, target, status, pass rate, violations, details.

    Rules on absent or empty tables are skipped, and so are references to an absent or
    empty parent. The column rules of a table share one pass over it.
    """
    parts: list[DataFrame] = []
    single: dict[str, list[tuple[int, Rule, str | None]]] = {}
    for number, rule in enumerate(rules):
        df = tables.get(rule.table)
        if df is None or (rule.parent and rule.parent not in tables):
            continue
        if rule.parent and tables[rule.parent].isEmpty():
            continue
        missing = None
        if rule.column not in df.columns:
            missing = {
                ENUM: f"Column '{rule.column}' missing",
                FOREIGN_KEY: f"Child column '{rule.column}' missing",
            }.get(rule.kind, f"Column '{rule.column}' missing from DataFrame")
        elif rule.parent and rule.parent_column not in tables[rule.parent].columns:
            missing = f"Parent column '{rule.parent_column}' missing"
        if missing or rule.kind in (NOT_NULL, RANGE, ENUM):
            single.setdefault(rule.table, []).append((number, rule, missing))
        elif rule.kind == PRIMARY_KEY:
            parts.append(_unique_rule(df, number, rule))
        else:
            parts.append(_reference_rule(df, tables[rule.parent], number, rule))
    for table, group in single.items():
        parts += _column_rules(tables[table], group)
    if not parts:
        raise ValueError("no rule applies to the given tables")
    return union_all(parts).filter("_rows > 0").drop("_rows")


def scorecard(results: DataFrame) -> DataFrame:
    """Totals over rule results; health is 100 where there are no rules."""
    passed = F.count(F.when(F.col("status") == "PASS", 1))
    totals = results.agg(F.count("*").alias("total_constraints_evaluated"), passed.alias("passed_count"))
    total, ok = F.col("total_constraints_evaluated"), F.col("passed_count")
    return totals.select(
        F.when(total == ok, F.lit("PASSED")).otherwise(F.lit("FAILED")).alias("overall_status"),
        F.coalesce(round_even(F.try_divide(ok * 100, total), 2), F.lit(100.0)).alias("overall_health_score_pct"),
        total,
        ok,
        (total - ok).alias("failed_count"),
    )


def enforce(results: DataFrame) -> None:
    """Raise when a rule failed; call it before publishing. One row per rule is fetched."""
    failed = results.filter(F.col("status") == "FAIL").select("table_name", "target", "details").collect()
    if failed:
        lines = "; ".join(f"{r.table_name}.{r.target}: {r.details}" for r in failed)
        raise ContractViolation(f"{len(failed)} contract rules failed: {lines}")
