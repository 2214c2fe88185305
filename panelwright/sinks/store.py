"""The panel's tables as Parquet folders under one root, facts partitioned by year."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, DataFrameWriter, Row, SparkSession
from pyspark.sql import functions as F

from panelwright.operators.keys import dense_keys
from panelwright.operators.merge import insert_ignore, merge_rows
from panelwright.operators.quality import key_duplicates
from panelwright.schema import TABLES, TableSpec
from panelwright.session import remove_folder, shared_folder


def conform(df: DataFrame, table: str) -> DataFrame:
    """The table's columns that ``df`` has, cast to the types the store keeps.

    A value that does not fit its type fails the job, as it would fail an insert, and so
    does a null in the partition column.
    """
    spec = TABLES[table]
    kept = spec.kept

    def typed(name: str) -> Column:
        c = F.col(f"`{name}`").cast(kept[name].dataType)
        if name == spec.partition:
            missing = F.raise_error(F.lit(f"null {name} in {table}")).cast("int")
            c = F.when(c.isNull(), missing).otherwise(c)
        return c.alias(name)

    return df.select(*[typed(c) for c in spec.columns.fieldNames() if c in df.columns])


#: Years a fact may hold: what bounds the list of partitions that an upsert reads.
YEARS = (1000, 3000)


class RepeatedKey(ValueError):
    """A batch that a primary key would refuse."""


def _key_text(spec: TableSpec, row: Row) -> str:
    return ", ".join(f"{k}={row[k]!r}" for k in spec.key)


def _refuse_repeats(spec: TableSpec, batch: DataFrame) -> None:
    found = key_duplicates(batch, spec.key).first()
    if found:
        raise RepeatedKey(f"{found.n_rows} rows for {spec.name} have {_key_text(spec, found)}")


def year_digests(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """Per year what its rows hold whatever their order: their number, and two sums of hashes of 64 bits each.

    A null hashes unlike the absence of a column, so that a value that moves to another column shows.
    """
    values = [F.struct(F.lit(i), F.col(f"`{c}`"), F.col(f"`{c}`").isNull()) for i, c in enumerate(spec.columns.fieldNames())]
    sums = [F.sum(F.xxhash64(F.lit(seed), *values).cast("decimal(20,0)")) for seed in (1, 2)]
    return rows.groupBy(F.col(f"`{spec.partition}`").alias("year")).agg(
        F.count(F.lit(1)).alias("n_rows"), *[s.cast("decimal(38,0)").alias(f"sum_{i}") for i, s in enumerate(sums)]
    )


def changed_years(before: DataFrame, after: DataFrame) -> list[int]:
    """Years with another digest, or that one side lacks; as many rows as a batch has years."""
    counted = before.unionByName(after).groupBy("year", "n_rows", "sum_0", "sum_1").agg(F.count(F.lit(1)).alias("n_sides"))
    return sorted(y for (y,) in counted.where("n_sides = 1").select("year").distinct().collect())


class PanelStore:
    """Create, read, append, insert-ignore and upsert the declared tables."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, table: str) -> str:
        return f"{self.root}/{TABLES[table].folder}"

    def create(self, *tables: str) -> None:
        """Create the tables that do not exist yet."""
        for table in tables or TABLES:
            spec = TABLES[table]
            empty = [F.lit(None).cast(c.dataType).alias(c.name) for c in spec.kept]
            writer = self.spark.range(0).select(*empty).write.mode("ignore")
            if spec.partition:
                writer = writer.partitionBy(spec.partition)
            writer.parquet(self.path(table))

    def read(self, table: str) -> DataFrame:
        spec = TABLES[table]
        rows = self.spark.read.schema(spec.kept).parquet(self.path(table))
        return rows.select(*[f"`{c}`" for c in spec.columns.fieldNames()])

    def panel(self) -> dict[str, DataFrame]:
        return {table: self.read(table) for table in TABLES}

    def append(self, table: str, rows: DataFrame) -> None:
        """Add rows with new keys; a key that repeats, in the batch or in the table, raises."""
        spec = TABLES[table]
        with self._staged(spec, conform(rows, table)) as incoming:
            _refuse_repeats(spec, incoming)
            same = [incoming[f"`{k}`"] == F.col(f"old.`{k}`") for k in spec.key]
            old = self.read(table)
            if spec.partition:
                old = old.where(F.col(f"`{spec.partition}`").isin(self._years(spec, incoming)))
            clash = incoming.join(old.alias("old"), same, "left_semi").first()
            if clash:
                raise RepeatedKey(f"{spec.name} has {_key_text(spec, clash)} already")
            self._write(spec, self._numbered(table, incoming), "append")

    def insert_ignore(self, table: str, rows: DataFrame) -> None:
        """Append the rows whose natural key is not there yet."""
        new = insert_ignore(self.read(table), conform(rows, table), TABLES[table].key)
        with self._staged(TABLES[table], new) as staged:
            self._write(TABLES[table], self._numbered(table, staged), "append")

    def upsert(self, table: str, rows: DataFrame, mode: str = "keep_old") -> list[int]:
        """Merge rows into a fact, rewriting only the years that change. A key that repeats raises.

        The incoming rows are written once to the shared folder, split by year, so the plan
        that produces them runs once. Old and new rows of the touched years then meet in
        one full outer join on the key; other years are neither read nor written. A year whose
        merged rows are those it had, by their digest, is not written: a load repeated writes
        nothing. The years written are returned. Years that change are merged a second time as
        they are written, the others are not. As with a database sequence, a row that only
        updates uses up its provisional number.
        Years outside ``YEARS`` raise, so a garbled year column cannot become a list of folders.
        """
        spec = TABLES[table]
        with self._staged(spec, conform(rows, table)) as incoming:
            _refuse_repeats(spec, incoming)
            year, years = F.col(f"`{spec.partition}`"), self._years(spec, incoming)
            numbered = self._numbered(table, incoming)
            old = self.read(table)

            def merged(some: list[int]) -> DataFrame:
                within = year.isin(some)
                return merge_rows(old.where(within), numbered.where(within), spec.key, mode, keep=(spec.surrogate,))

            before = year_digests(old.where(year.isin(years)), spec)
            after = year_digests(merged(years).select(*[f"`{c}`" for c in old.columns]), spec)
            changed = changed_years(before, after)
            if changed:
                self._write(spec, merged(changed), "overwrite")
            return changed

    def _years(self, spec: TableSpec, batch: DataFrame) -> list[int]:
        """Years of a batch, by one aggregate over its partition column; as a literal filter they prune the table
        before its files are listed for reading."""
        year = F.col(f"`{spec.partition}`")
        odd = batch.where(~year.between(*YEARS)).first()
        if odd:
            raise ValueError(f"{spec.name}: {spec.partition} {odd[spec.partition]} is not within {YEARS}")
        return [y for (y,) in batch.select(year).distinct().collect()]

    def write_report(self, table: str, found: DataFrame) -> None:
        """What a load left out, kept beside the table in place of the report before: (kind, name, n_rows)."""
        found.write.mode("overwrite").parquet(self._report_path(table))

    def report(self, table: str) -> DataFrame:
        return self.spark.read.schema("kind string, name string, n_rows long").parquet(self._report_path(table))

    def _report_path(self, table: str) -> str:
        return f"{self.root}/reports/{TABLES[table].folder}"

    @contextmanager
    def _staged(self, spec: TableSpec, rows: DataFrame) -> Iterator[DataFrame]:
        """The rows written once to the shared folder: checks, numbering and merging read them
        more than once, and what produced them should not run again. Removed when done."""
        path = shared_folder(self.spark)
        _writer(rows, spec).parquet(path)
        try:
            yield self.spark.read.schema(rows.schema).parquet(path)
        finally:
            remove_folder(self.spark, path)

    def _numbered(self, table: str, rows: DataFrame) -> DataFrame:
        """Give rows without one a surrogate key above the largest in use."""
        spec = TABLES[table]
        if not spec.surrogate or spec.surrogate in rows.columns:
            return rows
        largest = self.read(table).agg(F.coalesce(F.max(spec.surrogate), F.lit(0))).scalar()
        return dense_keys(rows, spec.key, spec.surrogate, start=largest + 1)

    def _write(self, spec: TableSpec, rows: DataFrame, mode: str) -> None:
        full = rows.select(
            *[
                F.col(f"`{c.name}`") if c.name in rows.columns else F.lit(None).cast(c.dataType).alias(c.name)
                for c in spec.kept
            ]
        )
        writer = _writer(full, spec).mode(mode).option("partitionOverwriteMode", "dynamic")
        writer.parquet(self.path(spec.name))


def _writer(rows: DataFrame, spec: TableSpec) -> DataFrameWriter:
    """Facts go into year folders. Rebalancing gathers a year's rows into few files, yet
    splits a year too large for one task."""
    if not spec.partition:
        return rows.write
    return rows.hint("rebalance", spec.partition).write.partitionBy(spec.partition)
