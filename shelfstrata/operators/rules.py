"""Declarative rules of a table and the predicates that find rows breaking them."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F, types as T

from shelfstrata.functions.columns import named

NOT_NULL = "not_null"
UNIQUE = "unique"
MIN_VALUE = "min_value"
ACCEPTED_VALUES = "accepted_values"
REGEX = "regex"

RULE_NAMES = (NOT_NULL, UNIQUE, MIN_VALUE, ACCEPTED_VALUES, REGEX)


@dataclass(frozen=True)
class Rule:
    """One rule on one column. ``severity`` is ``error`` or ``warn``; ``tolerance`` is the share
    of rows that may fail before the check counts as failed in a graded report."""

    column: str
    name: str
    argument: Any = None
    severity: str = "error"
    tolerance: float = 0.0

    def __post_init__(self) -> None:
        if self.name not in RULE_NAMES:
            raise ValueError(f"Unsupported validation rule: {self.name}")
        if self.severity not in ("error", "warn"):
            raise ValueError(f"Unsupported severity: {self.severity}")
        if isinstance(self.argument, list):
            object.__setattr__(self, "argument", tuple(self.argument))

    @property
    def key_columns(self) -> list[str]:
        """Columns a uniqueness rule counts together; the rule's own column otherwise."""
        return list(self.argument) if self.name == UNIQUE and self.argument else [self.column]

    @property
    def is_row_rule(self) -> bool:
        return self.name != UNIQUE

    def is_missing(self, df: DataFrame) -> bool:
        return any(c not in df.columns for c in self.key_columns)

    def details(self, df: DataFrame) -> str:
        # The texts of the report.
        if self.is_missing(df):
            return f"Column does not exist: {self.column}"
        if self.name == MIN_VALUE:
            return f"Minimum value check: >= {self.argument}"
        if self.name == ACCEPTED_VALUES:
            return f"Accepted values: {list(self.argument)}"
        if self.name == REGEX:
            return f"Regex pattern: {self.argument}"
        return "Null check" if self.name == NOT_NULL else "Uniqueness check"

    def fails(self, df: DataFrame) -> Column:
        """Predicate that is true, never NULL, on a row that breaks the rule.

        NULL passes every rule but ``not_null``. A missing column fails every row. A uniqueness
        rule has no such predicate: see ``failing_rows`` and ``report``.
        """
        if self.is_missing(df):
            return F.lit(True)
        column = named(self.column)
        if self.name == NOT_NULL:
            return column.isNull()
        if self.name == MIN_VALUE:
            if isinstance(df.schema[self.column].dataType, T.StringType):
                column = column.try_cast("double")
            return F.coalesce(column < F.lit(self.argument), F.lit(False))
        if self.name == ACCEPTED_VALUES:
            return column.isNotNull() & ~column.isin(list(self.argument))
        if self.name == REGEX:
            return column.isNotNull() & ~column.rlike(self.argument)
        raise ValueError(f"No row predicate for rule: {self.name}")


@dataclass(frozen=True)
class Contract:
    """The rules of one table, in the order they are reported."""

    table: str
    primary_key: tuple[str, ...]
    rules: tuple[Rule, ...] = field(default_factory=tuple)

    @staticmethod
    def of(
        table: str, primary_key: Sequence[str], columns: Mapping[str, Iterable[Any]]
    ) -> "Contract":
        """Build from ``column -> rules``, a rule being a name or a one-entry mapping."""
        rules = [_parse(column, rule) for column, given in columns.items() for rule in given]
        return Contract(table, tuple(primary_key), tuple(rules))

    @staticmethod
    def from_dict(document: Mapping[str, Any]) -> "Contract":
        """Build from a parsed contract document (``table``, ``primary_key``, ``columns``)."""
        columns = {c: (spec or {}).get("rules", []) for c, spec in document["columns"].items()}
        return Contract.of(document["table"], document.get("primary_key", []), columns)

    def with_key_rules(self) -> "Contract":
        """Add what the primary key implies: no NULL in it, no two rows sharing it."""
        declared = {(rule.name, tuple(rule.key_columns)) for rule in self.rules}
        implied = [Rule(c, NOT_NULL) for c in self.primary_key]
        if len(self.primary_key) == 1:
            implied.append(Rule(self.primary_key[0], UNIQUE))
        elif self.primary_key:
            implied.append(Rule(",".join(self.primary_key), UNIQUE, self.primary_key))
        added = [r for r in implied if (r.name, tuple(r.key_columns)) not in declared]
        return Contract(self.table, self.primary_key, (*self.rules, *added))


@dataclass(frozen=True)
class Relationship:
    """Every non-NULL child key must be a key of the parent."""

    name: str
    child_table: str
    child_column: str
    parent_table: str
    parent_column: str

    @property
    def details(self) -> str:
        return (
            f"{self.child_table}.{self.child_column} must exist in "
            f"{self.parent_table}.{self.parent_column}"
        )


def _parse(column: str, rule: Any) -> Rule:
    if isinstance(rule, Rule):
        return rule
    if isinstance(rule, str):
        return Rule(column, rule)
    if isinstance(rule, Mapping) and len(rule) == 1:
        ((name, argument),) = rule.items()
        return Rule(column, name, argument)
    raise ValueError(f"Unsupported rule format: {rule}")
