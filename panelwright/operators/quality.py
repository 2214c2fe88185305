"""Declared constraints as checks that return the offending keys or counts."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, IntegralType, LongType, NumericType, StringType

from panelwright.schema import NAME_LENGTH, TABLES, TableSpec


def key_duplicates(df: DataFrame, key: Sequence[str], count: str = "n_rows") -> DataFrame:
    """Keys held by more than one row. A key with a null in it conflicts with none."""
    names = [f"`{k}`" for k in key]
    return (
        df.dropna(how="any", subset=list(key))
        .groupBy(*names)
        .agg(F.count(F.lit(1)).alias(count))
        .where(F.col(count) > 1)
    )


def foreign_key_orphans(
    fact: DataFrame, foreign_key: str, dimension: DataFrame, dimension_key: str, count: str = "n_rows"
) -> DataFrame:
    """Foreign-key values without a dimension row, with the number of rows that carry them.

    The fact is counted per key before the anti-join: a hot key costs one row per task.
    """
    used = (
        fact.where(F.col(f"`{foreign_key}`").isNotNull())
        .groupBy(f"`{foreign_key}`")
        .agg(F.count(F.lit(1)).alias(count))
    )
    known = dimension.select(F.col(f"`{dimension_key}`").alias("_known"))
    return used.join(known, used[f"`{foreign_key}`"] == known["_known"], "left_anti")


def _column_counts(df: DataFrame, tests: Mapping[str, Column], count: str) -> DataFrame:
    """One pass over the rows; one output row per column with at least one hit."""
    one_row = df.agg(*[F.count_if(t).alias(c) for c, t in tests.items()])
    long = one_row.unpivot([], [F.col(f"`{c}`") for c in tests], "column_name", count)
    return long.where(F.col(count) > 0)


def null_violations(df: DataFrame, columns: Sequence[str], count: str = "n_rows") -> DataFrame:
    """Rows with a null, per column that must not have one."""
    return _column_counts(df, {c: F.col(f"`{c}`").isNull() for c in columns}, count)


def misfit(name: str, kind: DataType) -> Column:
    """The value does not fit a declared numeric(p,s) or text length."""
    c = F.col(f"`{name}`")
    if isinstance(kind, StringType):
        return F.char_length(c) > NAME_LENGTH
    return c.isNotNull() & c.try_cast(kind).isNull()


def precision_violations(df: DataFrame, types: Mapping[str, DataType], count: str = "n_rows") -> DataFrame:
    """Values that do not fit the declared numeric(p,s) or text length, per column."""
    return _column_counts(df, {n: misfit(n, k) for n, k in types.items()}, count)


def audit(panel: Mapping[str, DataFrame], specs: Mapping[str, TableSpec] = TABLES) -> DataFrame:
    """All declared rules over the tables present: (table_name, rule, detail, n_rows).

    Each table is read once and all rules share one shuffle. A row becomes one entry for each rule it
    has a say in: its key, its references, the keys by which others refer to it, and what it violates.
    Entries are counted by rule and value, inside each task first; a key counted twice is repeated, a
    reference counted without a row that it could mean is an orphan. A hot value is one entry a task.
    """
    rules = [r for name in panel for r in _rules(specs[name], panel, specs)]
    entries = []
    for name, df in panel.items():
        said = [e for number, rule in enumerate(rules) for e in rule.entries(name, df, number, panel)]
        if said:
            entries.append(df.select(F.explode(F.filter(F.array(*said), lambda e: e.isNotNull())).alias("e")).select("e.*"))
    if not entries:
        return next(iter(panel.values())).sparkSession.createDataFrame([], _REPORT)
    counted = reduce(DataFrame.unionByName, entries).groupBy("rule", "value").agg(
        F.sum("own").alias("n_rows"), F.min("own").alias("alone")
    )

    def of(values: Sequence[object]) -> Column:
        return F.element_at(F.array(*map(F.lit, values)), F.col("rule") + 1)

    needed = of([r.least for r in rules])
    orphan = (F.col("alone") == 1) | ~of([r.refers is not None for r in rules])
    return counted.where((F.col("n_rows") >= needed) & orphan).select(
        of([r.table for r in rules]).alias("table_name"),
        of([r.label for r in rules]).alias("rule"),
        F.array_join("value", ", ").alias("detail"),
        "n_rows",
    )


_REPORT = "table_name string, rule string, detail string, n_rows long"


@dataclass(frozen=True)
class _Rule:
    """One rule of a table; ``least`` rows with one value make a finding."""

    table: str
    label: str
    least: int
    columns: tuple[str, ...]
    test: Callable[[DataFrame, str], Column] | None = None  # what violates it, for rules on single values
    refers: tuple[str, str] | None = None

    def entries(self, name: str, df: DataFrame, number: int, panel: Mapping[str, DataFrame]) -> list[Column]:
        """What rows of the table say about this rule: (rule, value, own), null where nothing."""

        def entry(value: list[Column], when: Column, own: int) -> Column:
            return F.when(when, F.struct(F.lit(number).alias("rule"), F.array(*value).alias("value"), F.lit(own).alias("own")))

        found = []
        if self.test:
            if name == self.table:
                found = [entry([F.lit(c)], self.test(df, c), 1) for c in self.columns]
            return found
        sides = [(self.columns, 1)] if name == self.table else []
        if self.refers and name == self.refers[0]:
            sides.append(((self.refers[1],), 0))
        for columns, own in sides:
            kinds = self._compared(panel) if self.refers else [df.schema[c].dataType for c in columns]
            value = [F.col(f"`{c}`").cast(k).cast("string") for c, k in zip(columns, kinds)]
            whole = reduce(Column.__and__, [v.isNotNull() for v in value])
            found.append(entry(value, whole, own))
        return found

    def _compared(self, panel: Mapping[str, DataFrame]) -> list[DataType]:
        """The type in which a reference and the key that it means are the same text."""
        a, b = panel[self.table].schema[self.columns[0]].dataType, panel[self.refers[0]].schema[self.refers[1]].dataType
        if isinstance(a, IntegralType) and isinstance(b, IntegralType):
            return [LongType()]
        return [a if a == b or not isinstance(a, NumericType) else DecimalType(38, 10)]


def _rules(spec: TableSpec, panel: Mapping[str, DataFrame], specs: Mapping[str, TableSpec]) -> list[_Rule]:
    df = panel[spec.name]
    present = [f for f in spec.columns if f.name in df.columns]
    required = tuple(f.name for f in present if not f.nullable)
    kinds = {f.name: f.dataType for f in present if isinstance(f.dataType, (DecimalType, StringType))}
    rules = [_Rule(spec.name, "unique key", 2, spec.key)] if set(spec.key) <= set(df.columns) else []
    if required:
        rules.append(_Rule(spec.name, "not null", 1, required, lambda df, c: F.col(f"`{c}`").isNull()))
    if kinds:
        rules.append(_Rule(spec.name, "precision", 1, tuple(kinds), lambda df, c: misfit(c, kinds[c])))
    for fk, target in spec.foreign_keys.items():
        if target[0] in panel and fk in df.columns:
            rules.append(_Rule(spec.name, f"{fk} in {target[0]}", 1, (fk,), refers=target))
    return rules
