"""A zone of the lake: named parquet tables under one root on any Hadoop file system.

Writes go to a staging folder first and are swapped in with file-system renames, so a table can be
rebuilt from itself (upsert) without a plan that reads and overwrites the same path. A table's schema,
partitioning and primary key are properties of the table: they lie in a file beside its data and hold for
every later read and write.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citylake.operators.dedup import dedup_first
from citylake.operators.upsert import check_unique, last_rows, upsert

PROPERTIES = "_table.json"


class Zone:
    def __init__(self, spark: SparkSession, root: str, fmt: str = "parquet"):
        self.spark, self.root, self.fmt = spark, root.rstrip("/"), fmt

    # -- file system ---------------------------------------------------------------------------
    def _fs(self, path: str):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def path(self, name: str) -> str:
        return f"{self.root}/{name}.{self.fmt}"

    def exists(self, name: str) -> bool:
        fs, p = self._fs(self.path(name))
        return bool(fs.exists(p)) or self.recover(name)

    def recover(self, name: str) -> bool:
        """Finish an interrupted swap: when the table path is missing but ``overwrite`` had moved
        the previous copy aside (a crash between its two renames), move the newest such copy back."""
        fs, final = self._fs(self.path(name))
        if fs.exists(final):
            return False
        _, staging = self._fs(f"{self.root}/_staging")
        if not fs.exists(staging):
            return False
        aside = [st for st in fs.listStatus(staging) if st.getPath().getName().startswith(f"{name}-old-")]
        if not aside:
            return False
        newest = max(aside, key=lambda st: st.getModificationTime())
        fs.mkdirs(final.getParent())
        return bool(fs.rename(newest.getPath(), final))

    # -- properties ----------------------------------------------------------------------------
    def _put(self, folder: str, schema: T.StructType, partition_by: Sequence[str], primary_key: Sequence[str]) -> None:
        fs, p = self._fs(f"{folder}/{PROPERTIES}")
        out = fs.create(p, True)
        try:
            out.write(bytearray(json.dumps({"schema": schema.jsonValue(), "partition_by": list(partition_by),
                                            "primary_key": list(primary_key)}).encode()))
        finally:
            out.close()

    def properties(self, name: str) -> dict:
        """``schema`` (StructType or None), ``partition_by`` and ``primary_key`` of the table. For a
        table written by others the partitioning is read from its folders."""
        self.recover(name)
        fs, p = self._fs(f"{self.path(name)}/{PROPERTIES}")
        if fs.exists(p):
            jvm = self.spark.sparkContext._jvm
            stream = fs.open(p)
            try:
                raw = json.loads(jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
            finally:
                stream.close()
            return {**raw, "schema": T.StructType.fromJson(raw["schema"])}
        columns, (fs, folder) = [], self._fs(self.path(name))
        while fs.exists(folder):
            below = [st.getPath() for st in fs.listStatus(folder) if st.isDirectory() and "=" in st.getPath().getName()]
            if not below:
                break
            folder = below[0]
            columns.append(folder.getName().split("=")[0])
        return {"schema": None, "partition_by": columns, "primary_key": []}

    # -- read / write --------------------------------------------------------------------------
    def read(self, name: str, schema: T.StructType | None = None) -> DataFrame:
        """The table with the types it was written with, partition columns included."""
        schema = schema or self.properties(name)["schema"]
        reader = self.spark.read.format(self.fmt)
        if schema is None:
            return reader.load(self.path(name))
        return reader.schema(schema).load(self.path(name)).select(*[F.col(f"`{c}`") for c in schema.fieldNames()])

    def overwrite(self, df: DataFrame, name: str, *, partition_by: Sequence[str] | None = None,
                  primary_key: Sequence[str] | None = None) -> str:
        """Replace the table: write a staged copy, then swap it in. Partitioning and primary key stay as
        they are unless given; a primary key is checked on the staged copy."""
        if (partition_by is None or primary_key is None) and self.exists(name):
            old = self.properties(name)
            partition_by = old["partition_by"] if partition_by is None else partition_by
            primary_key = old["primary_key"] if primary_key is None else primary_key
        partition_by, primary_key = list(partition_by or ()), list(primary_key or ())
        staged = f"{self.root}/_staging/{name}-{uuid.uuid4().hex}"
        w = df.write.format(self.fmt).mode("errorifexists")
        if partition_by:
            w = w.partitionBy(*partition_by)
        fs, final = self._fs(self.path(name))
        _, src = self._fs(staged)
        try:
            w.save(staged)
            if primary_key:
                check_unique(self.spark.read.format(self.fmt).schema(df.schema).load(staged), primary_key)
            self._put(staged, df.schema, partition_by, primary_key)
        except Exception:
            fs.delete(src, True)  # a failed job leaves neither a half table nor its staging copy
            raise
        if fs.exists(final):
            _, old = self._fs(f"{self.root}/_staging/{name}-old-{uuid.uuid4().hex}")
            if not fs.rename(final, old):
                raise OSError(f"could not move {final} aside")
            if not fs.rename(src, final):
                fs.rename(old, final)
                raise OSError(f"could not swap in {staged}")
            fs.delete(old, True)
        else:
            fs.mkdirs(final.getParent())
            if not fs.rename(src, final):
                raise OSError(f"could not swap in {staged}")
        return self.path(name)

    def align(self, df: DataFrame, name: str) -> DataFrame:
        """Rows of ``df`` in the table's column order; a column the rows lack is NULL of the table's
        type (records with differing keys land in one table); extra columns are an error."""
        if not self.exists(name):
            return df
        schema = self.read(name).schema
        extra = [c for c in df.columns if c not in schema.fieldNames()]
        if extra:
            raise ValueError(f"columns {extra} are not in table {name!r}")
        return df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) if f.name in df.columns
                           else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])

    def append(self, df: DataFrame, name: str, *, partition_by: Sequence[str] | None = None) -> str:
        """Add rows, in the table's partitioning (``partition_by`` is for a table that doesn't exist yet).
        Rows that would break the table's primary key are an error, and nothing is written."""
        if not self.exists(name):
            return self.overwrite(df, name, partition_by=partition_by)
        table = self.properties(name)
        if partition_by is not None and list(partition_by) != table["partition_by"]:
            raise ValueError(f"table {name!r} is partitioned by {table['partition_by']}")
        df = self.align(df, name)
        if table["primary_key"]:
            check_unique(df, table["primary_key"])
            if not self._held(name, df, table["primary_key"]).isEmpty():
                raise ValueError(f"rows with keys that {name!r} holds already")
        return self._add(df, name, table["partition_by"])

    def _add(self, df: DataFrame, name: str, partition_by: Sequence[str]) -> str:
        w = df.write.format(self.fmt).mode("append")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.save(self.path(name))
        return self.path(name)

    def _held(self, name: str, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
        """Keys of the table that ``rows`` has too. The batch's distinct keys are the small side; the
        engine broadcasts them if their size allows, and the table is then not shuffled."""
        mine = rows.select(*[F.col(f"`{k}`").alias(f"_b{i}") for i, k in enumerate(keys)]).distinct()
        on = [F.col(f"`{k}`").eqNullSafe(F.col(f"_b{i}")) for i, k in enumerate(keys)]
        return self.read(name).select(*[F.col(f"`{k}`") for k in keys]).join(mine, on, "left_semi")

    def ensure_table(self, name: str, schema: T.StructType, *, primary_key: Sequence[str] = (),
                     partition_by: Sequence[str] = ()) -> DataFrame:
        """Create an empty table with ``schema`` when absent. The primary key becomes a property that every
        write keeps, so an existing table is checked only once, when it has none yet."""
        if not self.exists(name):
            self.overwrite(self.spark.createDataFrame([], schema), name, partition_by=partition_by, primary_key=primary_key)
        df = self.read(name)
        table = self.properties(name)
        if primary_key and table["primary_key"] != list(primary_key):
            check_unique(df, primary_key)
            self._put(self.path(name), table["schema"] or df.schema, table["partition_by"], primary_key)
        return df

    def insert_new(self, name: str, rows: DataFrame, keys: Sequence[str], *, order: Sequence[str] = ()) -> str:
        """Append only rows whose key is not in the table yet (first wins across runs; rerunning the same rows
        is a no-op). Of rows that share a key the first in ``order`` stays; ties, or no order, fall to
        the row's content. The first write makes ``keys`` the primary key."""
        keys = list(keys)
        rows = dedup_first(rows, keys, list(order))
        if not self.exists(name):
            return self.overwrite(rows, name, primary_key=keys)
        rows = self.align(rows, name)
        held = self._held(name, rows, keys).select(*[F.col(f"`{k}`").alias(f"_h{i}") for i, k in enumerate(keys)])
        fresh = rows.join(held, [F.col(f"`{k}`").eqNullSafe(F.col(f"_h{i}")) for i, k in enumerate(keys)], "left_anti")
        return self._add(fresh, name, self.properties(name)["partition_by"])

    def upsert(self, name: str, updates: DataFrame, keys: Sequence[str], *, order: Sequence[str] | None = None) -> str:
        """``INSERT OR REPLACE`` by key: updates replace rows with the same key, others are inserted. Among
        updates with one key the last in ``order`` wins; without an order a repeated key is an error.
        An order column that the table lacks isn't stored.

        A table partitioned by key columns is rewritten only in the partitions the updates touch: these are merged
        into a staged copy, which then replaces them. Other tables are rewritten whole.
        """
        keys = list(keys)
        if not self.exists(name):
            rows = last_rows(updates, keys, order)
            return self.overwrite(rows.drop(*[c for c in order or () if c not in keys]), name, primary_key=keys)
        table, target = self.properties(name), self.read(name)
        by = table["partition_by"]
        if not by or not set(by) <= set(keys):
            return self.overwrite(upsert(target, updates, keys, order=order).select(*target.columns), name)
        touched = updates.select(*[F.col(f"`{c}`").alias(f"_t{i}") for i, c in enumerate(by)]).distinct()
        part = target.join(touched, [F.col(f"`{c}`").eqNullSafe(F.col(f"_t{i}")) for i, c in enumerate(by)], "left_semi")
        staged = f"{self.root}/_staging/{name}-{uuid.uuid4().hex}"
        fs, src = self._fs(staged)
        try:
            upsert(part, updates, keys, order=order).select(*target.columns).write.format(self.fmt).save(staged)
            (self.spark.read.format(self.fmt).schema(target.schema).load(staged).write.format(self.fmt).mode("overwrite")
             .option("partitionOverwriteMode", "dynamic").partitionBy(*by).save(self.path(name)))
        finally:
            fs.delete(src, True)
        return self.path(name)
