"""Lake tables in Spark's own catalog: schema, partitioning and properties are the catalog's.

Every write is one of Spark's statements (create, insert by name, overwrite of the touched partitions). A table grows with its
batches: new top-level columns are added to the catalog's schema and cost nothing; new nested fields or wider types need
the old rows in the new form, so the table is written once more and takes the old one's name.
"""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citylake.operators.dedup import dedup_first
from citylake.operators.schema import conform, merge_schemas, same_schema
from citylake.operators.upsert import check_unique, last_rows, upsert

#: Table property that names the key columns.
KEY = "citylake.primary_key"


class Tables:
    """Tables of one database; ``location`` is its folder on shared storage (else the warehouse decides)."""

    def __init__(self, spark: SparkSession, database: str, location: str | None = None, fmt: str = "parquet"):
        self.spark, self.database, self.fmt = spark, database, fmt
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`" + (f" LOCATION '{location}'" if location else ""))

    def name(self, table: str) -> str:
        return f"`{self.database}`.`{table}`"

    def exists(self, table: str) -> bool:
        return self.spark.catalog.tableExists(self.name(table))

    def read(self, table: str) -> DataFrame:
        return self.spark.table(self.name(table))

    def partitions(self, table: str) -> list[str]:
        return [c.name for c in self.spark.catalog.listColumns(self.name(table)) if c.isPartition]

    def primary_key(self, table: str) -> list[str]:
        rows = self.spark.sql(f"SHOW TBLPROPERTIES {self.name(table)}").collect()
        return next((r["value"].split(",") for r in rows if r["key"] == KEY), [])

    def _set_key(self, table: str, keys: Sequence[str]) -> None:
        if keys:
            self.spark.sql(f"ALTER TABLE {self.name(table)} SET TBLPROPERTIES ('{KEY}' = '{','.join(keys)}')")

    # -- create ------------------------------------------------------------------------------
    def _write(self, df: DataFrame, table: str, partition_by: Sequence[str]) -> None:
        writer = df.write.format(self.fmt)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        # a catalog that lives in the session keeps partitions' old paths when a table is renamed: there they are found by listing
        track = "true" if self.spark.conf.get("spark.sql.catalogImplementation") == "hive" else "false"
        with self._setting("spark.sql.hive.manageFilesourcePartitions", track):
            writer.saveAsTable(self.name(table))

    def create(self, table: str, schema: T.StructType, *, partition_by: Sequence[str] = (), primary_key: Sequence[str] = ()) -> DataFrame:
        """An empty table, if it is absent. A primary key is checked when it is set on a table that has rows."""
        if not self.exists(table):
            self._write(self.spark.createDataFrame([], schema), table, partition_by)
        if primary_key and self.primary_key(table) != list(primary_key):
            check_unique(self.read(table), list(primary_key))
            self._set_key(table, primary_key)
        return self.read(table)

    def replace(self, df: DataFrame, table: str, *, partition_by: Sequence[str] | None = None, primary_key: Sequence[str] | None = None) -> None:
        """The table's rows become those of ``df``, which may read the table itself. Partitioning and key stay unless given. The new
        rows are written, and checked, before the old table goes; a failure until then leaves the old one."""
        have = self.exists(table)
        by = list(partition_by if partition_by is not None else self.partitions(table) if have else ())
        keys = list(primary_key if primary_key is not None else self.primary_key(table) if have else ())
        fresh = f"{table}__{uuid.uuid4().hex}"
        try:
            self._write(df, fresh, by)
            if keys:
                check_unique(self.read(fresh), keys)
                self._set_key(fresh, keys)
        except Exception:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name(fresh)}")
            raise
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name(table)}")
        self.spark.sql(f"ALTER TABLE {self.name(fresh)} RENAME TO {self.name(table)}")

    # -- grow and append -----------------------------------------------------------------------
    def grow(self, table: str, schema: T.StructType) -> None:
        """Widen the table so that rows of ``schema`` fit."""
        old = self.read(table).schema
        new = merge_schemas(old, schema)
        if same_schema(old, new):
            return
        first, added = T.StructType(new.fields[:len(old.fields)]), new.fields[len(old.fields):]
        if same_schema(old, first):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in added)
            self.spark.sql(f"ALTER TABLE {self.name(table)} ADD COLUMNS ({columns})")
        else:
            self.replace(conform(self.read(table), new), table)

    def append(self, df: DataFrame, table: str, *, grow: bool = True, partition_by: Sequence[str] = ()) -> None:
        """Add rows, columns matched by name. Columns and nested fields that the table lacks are added (or, without ``grow``, are an
        error); what the rows lack is NULL. Keys that the table or the rows hold twice are an error, and nothing is written."""
        if not self.exists(table):
            self._write(df, table, partition_by)
            return
        keys = self.primary_key(table)
        if keys:
            check_unique(df, keys)
            if not self._held(table, df, keys).isEmpty():
                raise ValueError(f"rows with keys that {table!r} holds already")
        if grow:
            self.grow(table, df.schema)
        self._insert(df, table)

    def _insert(self, df: DataFrame, table: str) -> None:
        self.spark.sql(f"INSERT INTO {self.name(table)} BY NAME SELECT * FROM {{rows}}", rows=conform(df, self.read(table).schema))

    @contextlib.contextmanager
    def _setting(self, key: str, value: str):
        old = self.spark.conf.get(key)
        self.spark.conf.set(key, value)
        try:
            yield
        finally:
            self.spark.conf.set(key, old)

    def replace_partitions(self, df: DataFrame, table: str) -> None:
        """Partitions that ``df`` has rows of are replaced by these rows; others stay. ``df`` mustn't read the table."""
        if not self.partitions(table):
            raise ValueError(f"table {table!r} has no partitions")
        self.grow(table, df.schema)
        with self._setting("spark.sql.sources.partitionOverwriteMode", "dynamic"):
            conform(df, self.read(table).schema).write.insertInto(self.name(table), overwrite=True)

    def rewrite_partitions(self, df: DataFrame, table: str) -> None:
        """``replace_partitions`` by rows that may come from the table itself: they are written aside first."""
        aside = f"{table}__{uuid.uuid4().hex}"
        try:
            self._write(df, aside, ())
            self.replace_partitions(self.read(aside), table)
        finally:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name(aside)}")

    # -- keyed writes ------------------------------------------------------------------------
    def _held(self, table: str, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
        mine = rows.select(*[F.col(f"`{k}`").alias(f"_b{i}") for i, k in enumerate(keys)]).distinct()
        on = [F.col(f"`{k}`").eqNullSafe(F.col(f"_b{i}")) for i, k in enumerate(keys)]
        return self.read(table).select(*[F.col(f"`{k}`") for k in keys]).join(mine, on, "left_semi")

    def insert_new(self, df: DataFrame, table: str, keys: Sequence[str], *, order: Sequence[str] = ()) -> None:
        """Append rows whose key the table lacks; of rows with one key the first in ``order``. Rerunning is a no-op."""
        rows = dedup_first(df, list(keys), list(order))
        if not self.exists(table):
            self._write(rows, table, ())
            self._set_key(table, keys)
            return
        held = self._held(table, rows, keys).select(*[F.col(f"`{k}`").alias(f"_h{i}") for i, k in enumerate(keys)])
        fresh = rows.join(held, [F.col(f"`{k}`").eqNullSafe(F.col(f"_h{i}")) for i, k in enumerate(keys)], "left_anti")
        self.grow(table, rows.schema)
        self._insert(fresh, table)

    def upsert(self, df: DataFrame, table: str, keys: Sequence[str], *, order: Sequence[str] | None = None) -> None:
        """Rows replace those of the same key, others are added; of updates with one key the last in ``order`` wins. A table that is
        partitioned by key columns is rewritten only in the partitions that the updates touch."""
        keys = list(keys)
        spare = [c for c in order or () if c not in keys]
        if not self.exists(table):
            self._write(last_rows(df, keys, order).drop(*spare), table, ())
            self._set_key(table, keys)
            return
        target = self.read(table)
        by = self.partitions(table)
        if not by or not set(by) <= set(keys):
            self.replace(upsert(target, df, keys, order=order).select(*target.columns), table)
            return
        touched = df.select(*[F.col(f"`{c}`").alias(f"_t{i}") for i, c in enumerate(by)]).distinct()
        part = target.join(touched, [F.col(f"`{c}`").eqNullSafe(F.col(f"_t{i}")) for i, c in enumerate(by)], "left_semi")
        self.rewrite_partitions(upsert(part, df, keys, order=order).select(*target.columns), table)
