"""The values that break a rule most often, over all quarantined rows of all runs.

A first pass keeps a count-min sketch per check: every value adds to one cell in each of ``depth`` lanes of ``width``
cells. A cell holds at least the rows of each of its values, so a value with a share of the failing rows has that share in
all its cells: none is missed. With N failing rows of a check, a cell's count is more than e / width * N too high with a
probability of at most exp(-depth) per value. Sketches are added up cell by cell, so those of earlier runs are stored
and merged without reading their rows again. A second pass counts exactly the values whose cells are all full enough.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from shelfstrata.functions.columns import named
from shelfstrata.operators.quarantine import failing_rows, of_broken
from shelfstrata.operators.rules import Contract, Rule

CHECK = ("table_name", "rule_name", "column_name")
WIDTH = 2048
DEPTH = 4


def offending(quarantined: DataFrame) -> DataFrame:
    """Per quarantined row its check and, as text, the value of the column that the check is about.

    NULL is a value too. Tables of one entity, or of several if cut down to what this returns, may be united.
    """
    columns = [c for c in quarantined.columns if not c.startswith("_")]
    about = F.col("_quarantine_column_name")
    values = [F.when(about == c, named(c).cast("string")) for c in columns]
    return quarantined.select(
        F.col("_quarantine_table_name").alias("table_name"),
        F.col("_quarantine_rule_name").alias("rule_name"),
        about.alias("column_name"),
        F.coalesce(F.lit(None).cast("string"), *values).alias("value"),
    )


def failing_values(df: DataFrame, contract: Contract) -> DataFrame:
    """What ``offending`` gives for the quarantine of ``df``, without building it: rows with equal values may come as one, which
    ``_rows`` counts.

    Values alone leave the scan. For uniqueness a key is counted and is its own value, so that no whole row is shuffled.
    """
    table = F.lit(contract.table)
    row_rules = [r for r in contract.rules if r.is_row_rule or r.is_missing(df)]
    parts = []
    if row_rules:
        told = [F.struct(F.lit(r.name).alias("rule_name"), F.lit(r.column).alias("column_name"), _value(df, r).alias("value")) for r in row_rules]
        broken = df.select(F.inline(of_broken(df, row_rules, told)))
        parts.append(broken.select(table.alias("table_name"), "*", F.lit(1).cast("long").alias("_rows")))
    for rule in contract.rules:
        if rule in row_rules:
            continue
        if rule.column in df.columns and rule.column not in rule.key_columns:
            failing = failing_rows(df, rule).select("*", F.lit(1).cast("long").alias("_rows"))
        else:
            keys = [named(k) for k in rule.key_columns]
            present = reduce(lambda left, right: left & right, [k.isNotNull() for k in keys])
            failing = df.filter(present).groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).filter("_rows > 1")
        check = [table.alias("table_name"), F.lit(rule.name).alias("rule_name"), F.lit(rule.column).alias("column_name")]
        parts.append(failing.select(*check, _value(df, rule).alias("value"), "_rows"))
    if not parts:
        raise ValueError(f"Contract has no rules: {contract.table}")
    return reduce(DataFrame.unionByName, parts)


def _value(df: DataFrame, rule: Rule) -> Column:
    known = rule.column in df.columns and not rule.column.startswith("_")
    return named(rule.column).cast("string") if known else F.lit(None).cast("string")


def _rows_of(values: DataFrame) -> list[str]:
    return [c for c in values.columns if c == "_rows"]


def _counted(values: DataFrame) -> Column:
    """How many failing rows the rows of a group stand for."""
    return F.sum("_rows") if "_rows" in values.columns else F.count(F.lit(1))


def _cells(width: int, depth: int) -> Column:
    lanes = [F.lit(n * width) + F.pmod(F.xxhash64(F.lit(n), "value"), F.lit(width)) for n in range(depth)]
    return F.array(*[cell.cast("int") for cell in lanes])


def value_sketch(values: DataFrame, width: int = WIDTH, depth: int = DEPTH) -> DataFrame:
    """The cells of each check that hold rows: at most ``width * depth`` for a check."""
    cells = values.select(*CHECK, *_rows_of(values), F.explode(_cells(width, depth)).alias("cell"))
    return cells.groupBy(*CHECK, "cell").agg(_counted(values).alias("rows"))


def merged(*sketches: DataFrame) -> DataFrame:
    """One sketch of all rows of several, which must have the same width and depth."""
    together = reduce(DataFrame.unionByName, sketches)
    return together.groupBy(*CHECK, "cell").agg(F.sum("rows").alias("rows"))


def frequent_values(
    values: DataFrame, sketch: DataFrame, share: float = 0.01, width: int = WIDTH, depth: int = DEPTH
) -> DataFrame:
    """Values with at least ``share`` of the rows that fail a check: exact row count, exact share, and the sketch's estimate.

    ``values`` are the rows that ``sketch`` was taken of, each standing for as many as ``_rows`` tells if it has that column; further
    columns are ignored. Full cells are at most
    ``depth / share`` per check, a bound that holds for any number of rows, so they are broadcast.
    """
    if not 0 < share <= 1:
        raise ValueError(f"Share must be in (0, 1]: {share}")
    totals = sketch.filter(F.col("cell") < width).groupBy(*CHECK).agg(F.sum("rows").alias("check_rows"))
    full = sketch.join(totals, list(CHECK)).filter(F.col("rows") >= F.col("check_rows") * F.lit(share))
    full = full.groupBy(*CHECK, "check_rows").agg(F.map_from_entries(F.collect_list(F.struct("cell", "rows"))).alias("_full"))
    found = values.select(*CHECK, "value", *_rows_of(values), _cells(width, depth).alias("_cells")).join(F.broadcast(full), list(CHECK))
    found = found.select(
        *CHECK, "value", "check_rows", *_rows_of(values), F.transform("_cells", lambda cell: F.try_element_at("_full", cell)).alias("_held")
    ).filter(F.forall("_held", lambda rows: rows.isNotNull()))
    counted = found.groupBy(*CHECK, "check_rows", "value").agg(
        _counted(values).alias("row_count"), F.first(F.array_min("_held")).alias("estimate")
    )
    return counted.filter(F.col("row_count") >= F.col("check_rows") * F.lit(share)).select(
        *CHECK, "value", "row_count", (F.col("row_count") / F.col("check_rows")).alias("share"), "estimate"
    )
