"""Rows that break rules: select them, tag them, split them off, count them."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from shelfstrata.functions.columns import named, sql_text
from shelfstrata.operators.rules import Contract, Relationship, Rule


def failing_rows(df: DataFrame, rule: Rule) -> DataFrame:
    """The rows that break one rule, all columns, in the order of ``df``.

    A missing column fails all rows. For uniqueness these are all rows of each duplicated key.
    """
    if rule.is_row_rule or rule.is_missing(df):
        return df.filter(rule.fails(df))
    return df.join(_duplicated_keys(df, rule), rule.key_columns, "left_semi")


def _duplicated_keys(df: DataFrame, rule: Rule) -> DataFrame:
    # Counted with a partial aggregate, so that a key on very many rows is never held by one task. The
    # keys are shuffled again for the join, whose hot partitions can then be split.
    keys = [named(k) for k in rule.key_columns]
    present = reduce(lambda left, right: left & right, [k.isNotNull() for k in keys])
    counted = df.filter(present).groupBy(F.xxhash64(*keys).alias("_hash"), *keys).count()
    return counted.filter("count > 1").select(*keys)


def tag(
    failing: DataFrame, table: str, column: str, rule: str, reason: str
) -> DataFrame:
    """Add the six quarantine columns to rows that failed one check."""
    return _stamp(
        failing.select(
            "*",
            F.lit(table).alias("_quarantine_table_name"),
            F.lit(column).alias("_quarantine_column_name"),
            F.lit(rule).alias("_quarantine_rule_name"),
            F.lit(reason).alias("_quarantine_failure_reason"),
        )
    )


def _stamp(df: DataFrame) -> DataFrame:
    return df.select(
        "*",
        F.current_timestamp().alias("_quarantine_time"),
        F.current_date().alias("_quarantine_date"),
    )


def quarantine(df: DataFrame, contract: Contract) -> DataFrame:
    """Every row once for each rule it breaks, tagged with the rule.

    All row rules share one pass: one predicate tells clean rows, which have no reasons and vanish;
    the others are multiplied by the rules they break. Rows are not removed from ``df``.
    """
    row_rules = [r for r in contract.rules if r.is_row_rule or r.is_missing(df)]
    key_rules = [r for r in contract.rules if r not in row_rules]
    parts = []
    if row_rules:
        reasons = of_broken(df, row_rules, [_reason(df, contract, r) for r in row_rules])
        parts.append(df.select("*", F.inline(reasons)))
    for rule in key_rules:
        reason = F.array(_reason(df, contract, rule))
        parts.append(failing_rows(df, rule).select("*", F.inline(reason)))
    if not parts:
        raise ValueError(f"Contract has no rules: {contract.table}")
    return _stamp(reduce(DataFrame.unionByName, parts))


def _reason(df: DataFrame, contract: Contract, rule: Rule) -> Column:
    return F.expr(
        f"struct({sql_text(contract.table)} as _quarantine_table_name, "
        f"{sql_text(rule.column)} as _quarantine_column_name, "
        f"{sql_text(rule.name)} as _quarantine_rule_name, "
        f"{sql_text(rule.details(df))} as _quarantine_failure_reason)"
    )


def of_broken(df: DataFrame, rules: Sequence[Rule], values: Sequence[Column]) -> Column:
    """Array of the values of the rules a row breaks; NULL, and no array built, if it breaks none."""
    any_fails = reduce(lambda left, right: left | right, [r.fails(df) for r in rules])
    each = [F.when(r.fails(df), value) for r, value in zip(rules, values, strict=True)]
    return F.when(any_fails, F.array_compact(F.array(*each)))


def summarise(quarantined: DataFrame) -> DataFrame:
    """Quarantined rows per table, rule and column."""
    return quarantined.groupBy(
        F.col("_quarantine_table_name").alias("table_name"),
        F.col("_quarantine_rule_name").alias("rule_name"),
        F.col("_quarantine_column_name").alias("column_name"),
    ).agg(F.count(F.lit(1)).alias("row_count"))


def flag(df: DataFrame, contract: Contract) -> DataFrame:
    """Add ``_broken_rules``: the row rules of severity ``error`` each row breaks, as
    ``rule:column``. An empty array marks a clean row. No shuffle, so it serves streams too."""
    rules = [r for r in contract.rules if r.is_row_rule or r.is_missing(df)]
    rules = [r for r in rules if r.severity == "error"]
    if not rules:
        return df.select("*", F.array().cast("array<string>").alias("_broken_rules"))
    names = [F.lit(f"{r.name}:{r.column}") for r in rules]
    broken = F.coalesce(of_broken(df, rules, names), F.array().cast("array<string>"))
    return df.select("*", broken.alias("_broken_rules"))


def split_clean(df: DataFrame, contract: Contract) -> tuple[DataFrame, DataFrame]:
    """The rows that break no ``error`` row rule, and the others with what they break.

    Uniqueness is left to ``keep_latest``, which settles it before validation.
    """
    flagged = flag(df, contract)
    clean = flagged.filter(F.size("_broken_rules") == 0).drop("_broken_rules")
    return clean, flagged.filter(F.size("_broken_rules") > 0)


def orphan_rows(child: DataFrame, parent: DataFrame, relationship: Relationship) -> DataFrame:
    """Child rows whose key is not NULL and not a key of the parent, tagged for quarantine."""
    key = named(relationship.child_column)
    known = parent.select(named(relationship.parent_column).alias("_parent_key"))
    orphans = child.filter(key.isNotNull()).join(
        known, key == F.col("_parent_key"), "left_anti"
    )
    return tag(
        orphans,
        relationship.child_table,
        relationship.child_column,
        "relationship",
        relationship.details,
    )
