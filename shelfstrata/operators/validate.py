"""Validation reports: one row per check, computed in few passes over the table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from shelfstrata.functions.columns import named, sql_text
from shelfstrata.operators.rules import Contract, Relationship, Rule

REPORT_COLUMNS = (
    "table_name",
    "column_name",
    "rule_name",
    "passed",
    "failed_count",
    "total_count",
    "details",
)
RELATIONSHIP_REPORT_COLUMNS = (
    "table_relationship_name",
    "child_table",
    "child_column",
    "parent_table",
    "parent_column",
    "passed",
    "failed_count",
    "child_count",
    "details",
)


class QualityGateError(RuntimeError):
    """Raised when a report holds failed checks."""


def report(df: DataFrame, contract: Contract, counted: str | None = None) -> DataFrame:
    """All checks of a contract, in contract order.

    One pass and one row of partial counts per task for all row rules together; one shuffle of the
    key alone for each uniqueness rule, with counts merged before it.

    ``counted`` names a column that holds how many rows have the row's primary key (``keep_latest`` adds it);
    the uniqueness rule on that key then is one of the row rules.
    """
    return _in_order(_checks(df, contract, 0, counted))


def report_all(
    tables: Mapping[str, DataFrame], contracts: Sequence[Contract], counted: str | None = None
) -> DataFrame:
    """The reports of several tables in one DataFrame, in the order of the contracts."""
    missing = [c.table for c in contracts if c.table not in tables]
    if missing:
        raise ValueError(f"Tables to validate are missing: {missing}")
    parts, start = [], 0
    for contract in contracts:
        parts.append(_checks(tables[contract.table], contract, start, counted))
        start += len(contract.rules)
    return _in_order(reduce(DataFrame.unionByName, parts))


def _checks(df: DataFrame, contract: Contract, start: int, counted: str | None = None) -> DataFrame:
    numbered = list(enumerate(contract.rules, start))
    known = [r for r in contract.rules if counted and not r.is_row_rule and tuple(r.key_columns) == contract.primary_key]
    row_rules = [(i, r) for i, r in numbered if r.is_row_rule or r.is_missing(df) or r in known]
    parts = []
    if row_rules:
        failing = [
            (i, _is_duplicated(rule, counted) if rule in known and not rule.is_missing(df) else rule.fails(df))
            for i, rule in row_rules
        ]
        totals = df.agg(
            F.count(F.lit(1)).alias("total"),
            *[F.count_if(fails).alias(f"failed_{i}") for i, fails in failing],
        )
        checks = [_check(df, contract.table, rule, i, f"failed_{i}") for i, rule in row_rules]
        parts.append(totals.selectExpr(f"inline(array({', '.join(checks)}))"))
    for i, rule in numbered:
        if (i, rule) in row_rules:
            continue
        totals = _key_counts(df, rule.key_columns).agg(
            F.coalesce(F.sum("rows"), F.lit(0)).alias("total"),
            F.coalesce(F.sum(F.when(_is_duplicated(rule, "rows"), F.col("rows"))), F.lit(0)).alias("failed"),
        )
        check = _check(df, contract.table, rule, i, "failed")
        parts.append(totals.selectExpr(f"inline(array({check}))"))
    if not parts:
        raise ValueError(f"Contract has no rules: {contract.table}")
    return reduce(DataFrame.unionByName, parts)


def _key_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*[named(k) for k in keys]).agg(F.count(F.lit(1)).alias("rows"))


def _is_duplicated(rule: Rule, rows: str) -> Column:
    return reduce(
        lambda left, right: left & right,
        [named(k).isNotNull() for k in rule.key_columns],
        named(rows) > 1,
    )


def _check(df: DataFrame, table: str, rule: Rule, position: int, failed: str) -> str:
    """Struct of one line of the report, over columns ``total`` and ``failed``."""
    passed = "false" if rule.is_missing(df) else f"{failed} = 0"
    return (
        f"struct({position} as _position, {sql_text(table)} as table_name, "
        f"{sql_text(rule.column)} as column_name, {sql_text(rule.name)} as rule_name, "
        f"{passed} as passed, {failed} as failed_count, total as total_count, "
        f"{sql_text(rule.details(df))} as details)"
    )


def _in_order(checks: DataFrame) -> DataFrame:
    # One row per check, so one partition holds them all.
    return checks.repartition(1).sortWithinPartitions("_position").drop("_position")


def grade(checks: DataFrame, contracts: Sequence[Contract]) -> DataFrame:
    """Add ``severity``, ``failed_ratio`` and ``status`` (``pass``, ``warn`` or ``fail``).

    A check fails when the share of failing rows exceeds the rule's tolerance; a failed ``warn``
    rule only warns. A check on a missing column fails whatever its tolerance.
    """
    severity, tolerance = F.lit("error"), F.lit(0.0)
    for contract in contracts:
        for rule in contract.rules:
            if rule.severity == "error" and rule.tolerance == 0.0:
                continue
            mine = (
                (F.col("table_name") == contract.table)
                & (F.col("column_name") == rule.column)
                & (F.col("rule_name") == rule.name)
            )
            severity = F.when(mine, F.lit(rule.severity)).otherwise(severity)
            tolerance = F.when(mine, F.lit(rule.tolerance)).otherwise(tolerance)
    ratio = F.when(F.col("total_count") > 0, F.col("failed_count") / F.col("total_count")).otherwise(
        F.lit(0.0)
    )
    missing = ~F.col("passed") & (F.col("failed_count") == F.col("total_count"))
    missing = missing & F.col("details").startswith("Column does not exist")
    graded = checks.select(
        "*", severity.alias("severity"), ratio.alias("failed_ratio"), tolerance.alias("_tolerance")
    )
    status = (
        F.when(F.col("passed"), "pass")
        .when(~missing & (F.col("failed_ratio") <= F.col("_tolerance")), "pass")
        .when(F.col("severity") == "warn", "warn")
        .otherwise("fail")
    )
    return graded.select("*", status.alias("status")).drop("_tolerance")


def orphan_counts(child: DataFrame, child_column: str, parent: DataFrame, parent_column: str):
    """Distinct non-NULL child keys with their row count and whether the parent lacks them.

    Both sides are reduced to their distinct keys before they meet, so a key with very many rows
    is one row by then, and both reductions use the partitioning the join needs.
    """
    keys = (
        child.select(named(child_column).alias("key"))
        .filter("key is not null")
        .groupBy("key")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    known = (
        parent.select(named(parent_column).alias("key"))
        .filter("key is not null")
        .distinct()
        .select("key", F.lit(True).alias("_known"))
    )
    return keys.join(known, "key", "left").select(
        "key", "rows", F.col("_known").isNull().alias("is_orphan")
    )


def orphan_keys(
    child: DataFrame, child_column: str, parent: DataFrame, parent_column: str
) -> DataFrame:
    """Distinct non-NULL child keys the parent does not have."""
    keys = child.select(named(child_column).alias("child_key")).filter("child_key is not null")
    known = parent.select(named(parent_column).alias("parent_key"))
    return keys.distinct().join(known, F.col("child_key") == F.col("parent_key"), "left_anti")


def relationship_report(
    tables: Mapping[str, DataFrame],
    relationships: Sequence[Relationship],
    parents: Mapping[tuple[str, str], DataFrame] | None = None,
) -> DataFrame:
    """One row per relationship; counts are of distinct keys.

    A child table is passed over once for all its relationships; both sides are reduced to their distinct keys before
    they meet. ``parents`` may name, by table and column, other rows with the same keys that are cheaper to read.
    """
    if not relationships:
        raise ValueError("No relationships given")
    groups: dict[tuple, list] = {}
    for position, relationship in enumerate(relationships):
        child, parent = _sides(tables, relationship)
        place = (relationship.parent_table, relationship.parent_column)
        keys = (parents or {}).get(place, parent).select(named(relationship.parent_column).alias("key"))
        # Keys of one type share a column.
        types = (child.schema[relationship.child_column].dataType, keys.schema["key"].dataType)
        groups.setdefault((relationship.child_table, *types), []).append((position, relationship, keys))
    parts = [_related(tables[table], group) for (table, *_), group in groups.items()]
    return _in_order(reduce(DataFrame.unionByName, parts))


def _related(child: DataFrame, group: Sequence[tuple[int, Relationship, DataFrame]]) -> DataFrame:
    """The lines of the relationships of one child table, each with its position and the keys of its parent."""
    pairs = [F.struct(F.lit(p).alias("_position"), named(r.child_column).alias("key")) for p, r, _ in group]
    found = child.select(F.inline(F.array(*pairs))).filter("key is not null").distinct()
    known = reduce(DataFrame.unionByName, [keys.select(F.lit(p).alias("_position"), "key") for p, _, keys in group])
    known = known.filter("key is not null").distinct().select("_position", "key", F.lit(True).alias("_known"))
    mine = {p: F.col("_position") == p for p, _, _ in group}
    counted = found.join(known, ["_position", "key"], "left").agg(
        *[F.count_if(is_mine & F.col("_known").isNull()).alias(f"failed_{p}") for p, is_mine in mine.items()],
        *[F.count_if(is_mine).alias(f"children_{p}") for p, is_mine in mine.items()],
    )
    lines = [
        f"struct({p} as _position, {sql_text(r.name)} as table_relationship_name, "
        f"{sql_text(r.child_table)} as child_table, {sql_text(r.child_column)} as child_column, "
        f"{sql_text(r.parent_table)} as parent_table, {sql_text(r.parent_column)} as parent_column, "
        f"failed_{p} = 0 as passed, failed_{p} as failed_count, children_{p} as child_count, "
        f"{sql_text(r.details)} as details)"
        for p, r, _ in group
    ]
    return counted.selectExpr(f"inline(array({', '.join(lines)}))")


def _sides(
    tables: Mapping[str, DataFrame], relationship: Relationship
) -> tuple[DataFrame, DataFrame]:
    sides = []
    for role in ("child", "parent"):
        table = getattr(relationship, f"{role}_table")
        column = getattr(relationship, f"{role}_column")
        if table not in tables:
            raise ValueError(f"Missing {role} table of {relationship.name}: {table}")
        if column not in tables[table].columns:
            raise ValueError(f"Missing {role} column of {relationship.name}: {table}.{column}")
        sides.append(tables[table])
    return sides[0], sides[1]


def gate_summary(checks: DataFrame, relationships: DataFrame) -> DataFrame:
    """Two rows, one per kind of check: how many ran, how many failed."""
    kinds = [("column_checks", checks), ("relationship_checks", relationships)]
    return reduce(
        DataFrame.unionByName,
        [
            given.agg(
                F.lit(kind).alias("check_kind"),
                F.count(F.lit(1)).alias("checks"),
                F.count_if(~F.col("passed")).alias("failed_checks"),
            )
            for kind, given in kinds
        ],
    )


def enforce_gate(checks: DataFrame, relationships: DataFrame) -> None:
    """Raise when any check failed. Runs a job; pass reports already written to avoid a re-run."""
    failed = {row.check_kind: row.failed_checks for row in gate_summary(checks, relationships).collect()}
    if any(failed.values()):
        raise QualityGateError(
            f"Silver validation failed: {failed['column_checks']} column checks, "
            f"{failed['relationship_checks']} relationship checks"
        )
