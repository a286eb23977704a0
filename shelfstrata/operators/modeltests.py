"""Tests of models, with the counting unit of each kind of test.

They count otherwise than the contract checks: duplicated keys instead of rows, distinct bad values
instead of rows, orphan rows instead of orphan keys.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, functions as F

from shelfstrata.functions.columns import named, sql_text
from shelfstrata.operators.rules import ACCEPTED_VALUES, MIN_VALUE, NOT_NULL, REGEX, UNIQUE, Rule
from shelfstrata.operators.validate import orphan_counts

ACCEPTED_RANGE = "accepted_range"
RELATIONSHIPS = "relationships"

_UNITS = {
    NOT_NULL: "rows",
    REGEX: "rows",
    ACCEPTED_RANGE: "rows",
    RELATIONSHIPS: "rows",
    UNIQUE: "keys",
    ACCEPTED_VALUES: "values",
}


#: Repeated hashes of a column that are broadcast at most, 8 bytes each.
FEW = 500_000


@dataclass(frozen=True)
class ModelTest:
    """A test on a column of a model. ``argument`` is a pattern, the accepted values, the least
    value, or the parent model and column, as the kind of test needs."""

    model: str
    column: str
    name: str
    argument: Any = None

    def __post_init__(self) -> None:
        if self.name not in _UNITS:
            raise ValueError(f"Unsupported model test: {self.name}")

    @property
    def unit(self) -> str:
        return _UNITS[self.name]

    @property
    def is_row_test(self) -> bool:
        """Whether it can be judged row by row, in one pass with others."""
        return self.unit == "rows" and self.name != RELATIONSHIPS

    @property
    def rule(self) -> Rule:
        name = MIN_VALUE if self.name == ACCEPTED_RANGE else self.name
        return Rule(self.column, name, self.argument)


def columns_read(tests: Sequence[ModelTest]) -> list[tuple[str, str, bool]]:
    """Model and column of each test and of each parent, and whether it takes a pass of its own."""
    own = [(t.model, t.column, not t.is_row_test) for t in tests]
    return own + [(*t.argument, True) for t in tests if t.name == RELATIONSHIPS]


def model_test_report(models: Mapping[str, DataFrame], tests: Sequence[ModelTest]) -> DataFrame:
    """One row per test: model, column, test, unit, failures, passed.

    The row tests of a model share one pass over it; every other test reads one column.
    """
    numbered = list(enumerate(tests))
    parts = []
    for model in dict.fromkeys(test.model for test in tests):
        df = models[model]
        mine = [(i, t) for i, t in numbered if t.model == model]
        row_tests = [(i, t) for i, t in mine if t.is_row_test]
        if row_tests:
            counted = df.agg(
                *[F.count_if(t.rule.fails(df)).alias(f"failures_{i}") for i, t in row_tests]
            )
            results = [_result(i, t, f"failures_{i}") for i, t in row_tests]
            parts.append(counted.selectExpr(f"inline(array({', '.join(results)}))"))
        for i, test in mine:
            if (i, test) in row_tests:
                continue
            counted = _failing_units(models, test).agg(
                F.coalesce(F.sum("failures"), F.lit(0)).alias("failures")
            )
            parts.append(counted.selectExpr(f"inline(array({_result(i, test, 'failures')}))"))
    results = reduce(DataFrame.unionByName, parts)
    # One row per test, so one partition holds them all.
    return results.repartition(1).sortWithinPartitions("_position").drop("_position")


def _failing_units(models: Mapping[str, DataFrame], test: ModelTest) -> DataFrame:
    df = models[test.model]
    if test.name == RELATIONSHIPS:
        parent, parent_column = test.argument
        counted = orphan_counts(df, test.column, models[parent], parent_column)
        return counted.filter("is_orphan").select(F.col("rows").alias("failures"))
    column = named(test.column)
    if test.name == UNIQUE:
        groups = _duplicated(df.filter(column.isNotNull()).select(column.alias("key")))
    else:
        groups = df.filter(test.rule.fails(df)).select(column).distinct()
    return groups.select(F.lit(1).alias("failures"))


def _duplicated(keys: DataFrame) -> DataFrame:
    """The keys that occur more than once. Only hashes, of 48 bits, are shuffled for all rows; keys are told apart where a hash occurs
    more than once, which it also does where different keys share it.

    Up to ``FEW`` such hashes are broadcast, so that no other key is shuffled; if there are more, all keys are grouped. Which it
    is, a subquery decides before the keys are read.
    """
    hashed = keys.select("key", F.shiftrightunsigned(F.xxhash64("key"), 16).alias("hash"))
    repeated = hashed.groupBy("hash").count().filter("count > 1").select("hash")
    many = repeated.agg((F.count(F.lit(1)) > FEW).alias("many")).scalar()
    found = hashed.filter(~many).join(F.broadcast(repeated.filter(~many)), "hash", "left_semi")
    return found.select("key").union(keys.filter(many)).groupBy("key").count().filter("count > 1")


def _result(position: int, test: ModelTest, failures: str) -> str:
    return (
        f"struct({position} as _position, {sql_text(test.model)} as model_name, "
        f"{sql_text(test.column)} as column_name, {sql_text(test.name)} as test_name, "
        f"{sql_text(test.unit)} as unit, bigint({failures}) as failures, {failures} = 0 as passed)"
    )
