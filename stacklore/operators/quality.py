"""Declared data tests. Every test has a DataFrame of violations; a suite has a report.

The failure counts follow the usual column-test rules: `not_null` and `expression` count
rows, `unique` counts repeated values, `accepted_values` counts distinct foreign values,
`relationships` counts child rows. NULL fails `not_null` only.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stacklore.operators.joins import keep_keys


@dataclass(frozen=True)
class NotNull:
    column: str
    kind = "not_null"


@dataclass(frozen=True)
class Unique:
    column: str
    kind = "unique"


@dataclass(frozen=True)
class AcceptedValues:
    column: str
    values: tuple
    kind = "accepted_values"


@dataclass(frozen=True)
class Relationships:
    column: str
    to: str
    field: str
    kind = "relationships"


@dataclass(frozen=True)
class ExpressionIsTrue:
    column: str
    expression: str
    kind = "expression_is_true"


Test = NotNull | Unique | AcceptedValues | Relationships | ExpressionIsTrue


def not_null(df: DataFrame, column: str) -> DataFrame:
    """Rows in which `column` is NULL."""
    return df.filter(F.col(column).isNull())


def unique(df: DataFrame, column: str) -> DataFrame:
    """Values met more than once, with their count."""
    counted = df.filter(F.col(column).isNotNull()).groupBy(column)
    return counted.agg(F.count(F.lit(1)).alias("n_records")).filter("n_records > 1")


def accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Values outside the list, with their count."""
    foreign = df.filter(~F.col(column).isin(*values))
    return foreign.groupBy(column).agg(F.count(F.lit(1)).alias("n_records"))


def relationships(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Child rows whose key has no parent row.

    Only distinct child keys meet the parent, so a hot key is one row there. The orphaned
    keys are few in a sound table; when their count allows they are broadcast to the child
    scan and child rows are not shuffled.
    """
    orphans = _orphan_keys(child.select(column).distinct(), column, parent, field)
    return keep_keys(child, orphans, column)


def _orphan_keys(keys: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Rows of `keys` (one per child key) without a parent; NULL is no orphan."""
    parents = parent.select(F.col(field).alias("_pk"))
    present = keys.filter(F.col(column).isNotNull())
    return present.join(parents, F.col(column) == F.col("_pk"), "left_anti")


def expression_is_true(df: DataFrame, column: str, expression: str) -> DataFrame:
    """Rows for which `column expression` is false."""
    return df.filter(~F.expr(f"(`{column}` {expression})"))


def violations(tables: Mapping[str, DataFrame], table: str, test: Test) -> DataFrame:
    """Violating rows (or values) of one declared test."""
    df = tables[table]
    match test:
        case NotNull():
            return not_null(df, test.column)
        case Unique():
            return unique(df, test.column)
        case AcceptedValues():
            return accepted_values(df, test.column, test.values)
        case Relationships():
            return relationships(df, test.column, tables[test.to], test.field)
        case ExpressionIsTrue():
            return expression_is_true(df, test.column, test.expression)


def report(tables: Mapping[str, DataFrame], suite: Mapping[str, Sequence[Test]]) -> DataFrame:
    """(table_name, column_name, test_name, failures), one row per declared test.

    Per table: one aggregate scan for all row-wise tests, one scan with one shuffle for
    all uniqueness tests, one anti-join per foreign key.
    """
    parts: list[DataFrame] = []
    for table, tests in suite.items():
        df = tables[table]
        rowwise = [t for t in tests if isinstance(t, (NotNull, AcceptedValues, ExpressionIsTrue))]
        uniques = [t for t in tests if isinstance(t, Unique)]
        if rowwise:
            parts.append(_rowwise_report(df, table, rowwise))
        if uniques:
            parts.append(_unique_report(df, table, uniques))
        for test in tests:
            if isinstance(test, Relationships):
                parts.append(_relationship_report(df, table, test, tables[test.to]))
    return reduce(DataFrame.unionByName, parts)


def enforce(result: DataFrame) -> None:
    """Raise when a report holds failures. The report has one row per declared test."""
    failed = result.filter("failures > 0").collect()
    if failed:
        lines = [f"{r.table_name}.{r.column_name} {r.test_name}: {r.failures}" for r in failed]
        raise AssertionError("data tests failed: " + "; ".join(sorted(lines)))


def _entry(table: str, test: Test, failures: Column) -> Column:
    return F.struct(
        F.lit(table).alias("table_name"),
        F.lit(test.column).alias("column_name"),
        F.lit(test.kind).alias("test_name"),
        failures.cast("bigint").alias("failures"),
    )


def _rowwise_report(df: DataFrame, table: str, tests: Sequence[Test]) -> DataFrame:
    def failing(test: Test) -> Column:
        column = F.col(test.column)
        match test:
            case NotNull():
                return F.count(F.when(column.isNull(), 1))
            case AcceptedValues():
                return F.count_distinct(F.when(~column.isin(*test.values), column))
            case _:
                return F.count(F.when(~F.expr(f"(`{test.column}` {test.expression})"), 1))

    one_row = df.agg(*(failing(t).alias(f"_{i}") for i, t in enumerate(tests)))
    entries = [_entry(table, t, F.col(f"_{i}")) for i, t in enumerate(tests)]
    return one_row.select(F.inline(F.array(*entries)))


def _unique_report(df: DataFrame, table: str, tests: Sequence[Unique]) -> DataFrame:
    cells = F.array(
        *(
            F.struct(F.lit(i).alias("_test"), F.col(t.column).cast("string").alias("_value"))
            for i, t in enumerate(tests)
        )
    )
    repeated = (
        df.select(F.inline(cells))
        .filter(F.col("_value").isNotNull())
        .groupBy("_test", "_value")
        .agg(F.count(F.lit(1)).alias("_n"))
        .filter("_n > 1")
    )
    one_row = repeated.agg(
        *(F.count(F.when(F.col("_test") == i, 1)).alias(f"_{i}") for i in range(len(tests)))
    )
    entries = [_entry(table, t, F.col(f"_{i}")) for i, t in enumerate(tests)]
    return one_row.select(F.inline(F.array(*entries)))


def _relationship_report(
    child: DataFrame, table: str, test: Relationships, parent: DataFrame
) -> DataFrame:
    # Count child rows per key before the join: a hot key is one row there.
    keys = child.groupBy(test.column).agg(F.count(F.lit(1)).alias("_n"))
    orphans = _orphan_keys(keys, test.column, parent, test.field)
    one_row = orphans.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("_f"))
    return one_row.select(F.inline(F.array(_entry(table, test, F.col("_f")))))
