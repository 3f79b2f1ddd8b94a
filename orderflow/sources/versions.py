"""A store of tables whose changes become visible together: Parquet files, and lists of them.

A change writes files for what it changes in some tables and then one list that names these and
all untouched files of all tables; the old files stay until :meth:`Store.expire`. The list is one
small Parquet file that Spark's commit moves to its place, so readers see the version before or
the whole new one. Lists have one row per file: like Spark's own file index they fit the driver.
One writer at a time; one that comes after another has published the same number is refused.

Layout: ``<table>/commit=<id>/[<by>=<value>/]part-*.parquet`` and
``versions/version=<number>/part-*.parquet``.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, StructType

from orderflow.session import remove_folder, stage

_LIST = "table string, file string, schema string, by string, version int"
_VERSIONS = "versions"


class VersionConflict(RuntimeError):
    """Another writer has published the next version; read the tables again and repeat."""


@dataclass(frozen=True)
class Table:
    """A table in a version: its files (below its folder), schema and partition column."""

    files: tuple[str, ...]
    schema: StructType
    by: str | None


@dataclass
class Store:
    """The tables below ``path``."""

    spark: SparkSession
    path: str

    def __post_init__(self) -> None:
        self.path = self.path.rstrip("/")

    def _lists(self) -> DataFrame | None:
        try:
            return self.spark.read.schema(_LIST).parquet(f"{self.path}/{_VERSIONS}")
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return None
            raise

    def numbers(self) -> list[int]:
        """The versions that can be read, oldest first."""
        lists = self._lists()
        return [] if lists is None else sorted(
            r[0] for r in lists.select("version").distinct().collect())

    def tables(self, number: int | None = None) -> tuple[int, dict[str, Table]]:
        """A version's number and tables; the newest for ``None``, -1 and nothing before any."""
        known = self.numbers()
        if number is None:
            number = known[-1] if known else -1
        elif number not in known:
            raise ValueError(f"no version {number} in {self.path}")
        if number < 0:
            return number, {}
        rows = self._lists().where(F.col("version") == F.lit(number)).collect()
        found: dict[str, Table] = {}
        for name in {r["table"] for r in rows}:
            mine = [r for r in rows if r["table"] == name]
            files = tuple(sorted(r["file"] for r in mine if r["file"]))
            found[name] = Table(files, StructType.fromJson(json.loads(mine[0]["schema"])),
                                mine[0]["by"])
        return number, found

    def scan(self, name: str, table: Table, files: Iterable[str]) -> DataFrame:
        """The rows of some of a table's files."""
        paths = [f"{self.path}/{name}/{f}" for f in files]
        if not paths:
            return self.spark.createDataFrame([], table.schema)
        return (self.spark.read.schema(table.schema).option("basePath", f"{self.path}/{name}")
                .parquet(*paths).select(table.schema.names))

    def read(self, name: str, number: int | None = None) -> DataFrame:
        """A table's rows in a version, the newest for ``None``; partitions are pruned."""
        tables = self.tables(number)[1]
        if name not in tables:
            raise ValueError(f"no table {name} in {self.path}")
        return self.scan(name, tables[name], tables[name].files)

    def change(self) -> Change:
        """A change of the newest version."""
        return Change(self, *self.tables())

    def expire(self, keep: int = 2) -> list[int]:
        """Delete all but the newest ``keep`` versions and the data only they name.

        Returns the deleted versions; their readers fail from now on. A commit's data goes when
        no kept version names a file of it. What a failed writer left, no version ever named; it
        stays.
        """
        known = self.numbers()
        gone = known[:max(len(known) - max(keep, 1), 0)]
        if not gone:
            return []
        commit = F.concat("table", F.lit("/"), F.regexp_extract("file", "^(commit=[^/]+)/", 1))
        named = self._lists().where("file IS NOT NULL").withColumn("commit", commit)
        old = F.col("version").isin(gone)
        kept = {r[0] for r in named.where(~old).select("commit").distinct().collect()}
        dropped = {r[0] for r in named.where(old).select("commit").distinct().collect()} - kept
        for number in gone:
            remove_folder(self.spark, f"{self.path}/{_VERSIONS}/version={number}")
        for folder in dropped:
            remove_folder(self.spark, f"{self.path}/{folder}")
        return gone


@dataclass
class Change:
    """Changes of some tables on top of version ``number``; nobody sees them before `publish`."""

    store: Store
    number: int
    tables: dict[str, Table] = field(default_factory=dict)

    def _table(self, name: str) -> Table:
        if name not in self.tables:
            raise ValueError(f"no table {name} in {self.store.path}")
        return self.tables[name]

    def _written(self, name: str, rows: DataFrame, by: str | None) -> tuple[str, ...]:
        """Write rows as a commit of their own; its files."""
        commit = f"commit={uuid.uuid4().hex}"
        target = f"{self.store.path}/{name}/{commit}"
        if by is None:
            rows.write.parquet(target)
        else:
            rows.hint("rebalance", by).write.partitionBy(by).parquet(target)
        found = rows.sparkSession.read.schema(rows.schema).parquet(target).inputFiles()
        return tuple(f"{commit}/{f.split(f'/{commit}/', 1)[1]}" for f in found)

    def read(self, name: str) -> DataFrame:
        """A table's rows as this change leaves them so far."""
        table = self._table(name)
        return self.store.scan(name, table, table.files)

    @staticmethod
    def _cast(rows: DataFrame, table: Table) -> DataFrame:
        return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in table.schema])

    def replace_all(self, name: str, rows: DataFrame, by: str | None = None) -> Change:
        """The table, new or not, has these rows and columns, partitioned by a whole number."""
        if by is not None and not isinstance(rows.schema[by].dataType, IntegralType):
            raise ValueError(f"{by} is no whole-number column")
        ordered = rows.select(*[c for c in rows.columns if c != by], *([by] if by else []))
        self.tables[name] = Table(self._written(name, ordered, by), ordered.schema, by)
        return self

    def append(self, name: str, rows: DataFrame) -> Change:
        """Add rows to a table, which is made if there is none."""
        if name not in self.tables:
            return self.replace_all(name, rows)
        table = self._table(name)
        files = self._written(name, self._cast(rows, table), table.by)
        self.tables[name] = Table((*table.files, *files), table.schema, table.by)
        return self

    def replace_partitions(self, name: str, new: DataFrame, values: Sequence[int]) -> Change:
        """Replace the partitions ``values`` by the rows of ``new`` in them.

        Partitions without new rows end up empty, other partitions' files stay. ``new`` may be
        computed from the table.
        """
        table = self._table(name)
        wanted = [int(v) for v in values]
        rows = self._cast(new, table).where(F.col(table.by).isin(wanted))
        gone = [f"/{table.by}={v}/" for v in wanted]
        left = [f for f in table.files if not any(g in f for g in gone)]
        self.tables[name] = Table((*left, *self._written(name, rows, table.by)), table.schema,
                                  table.by)
        return self

    def touched(self, name: str, keys: DataFrame) -> list[str]:
        """The files that hold a key of ``keys``, found by reading the key columns only.

        When ``keys`` has the partition column too, only its partitions are looked into.
        """
        table = self._table(name)
        names = [c for c in keys.columns if c != table.by]
        files = table.files
        if table.by in keys.columns:
            # at most one per partition of the table
            parts = {f"/{table.by}={r[0]}/" for r in keys.select(table.by).distinct().collect()}
            files = tuple(f for f in files if any(p in f for p in parts))
        if not files:
            return []
        place = F.regexp_extract("_metadata.file_path", f"/{name}/(commit=[^/]+/.*)$", 1)
        held = self.store.scan(name, table, files).select(*names, place.alias("_file"))
        found = held.join(keys.select(*names).distinct(), names, "left_semi")
        return [r[0] for r in found.select("_file").distinct().collect()]  # at most ``files``

    def upsert(self, name: str, updates: DataFrame, key: str, *, stays: bool = False) -> Change:
        """Replace all rows of the keys in ``updates`` by the rows there.

        Only files that hold such a key are rewritten, without these keys' rows; the updates,
        among them rows of new keys, join them. So what is read beyond the key column, and what is
        written, grows with the changes, not with the table. A key may have several rows on
        either side; rows with a null key are always added. ``updates`` may be computed from the
        table. ``stays`` promises that rows never change their partition: then only the
        partitions of the updates are looked into.
        """
        table = self._table(name)
        updates = stage(self._cast(updates, table), "updates")
        looked = updates.select(key, table.by) if stays else updates.select(key)
        touched = self.touched(name, looked.distinct())
        kept = self.store.scan(name, table, touched).join(
            updates.select(key).distinct(), key, "left_anti")
        files = self._written(name, kept.select(table.schema.names).unionByName(updates), table.by)
        left = sorted(set(table.files) - set(touched))
        self.tables[name] = Table((*left, *files), table.schema, table.by)
        return self

    def publish(self) -> int:
        """Make all changes visible at once; the new version's number."""
        number = self.number + 1
        # a table without files has a row without one
        rows = [(name, f, t.schema.json(), t.by) for name, t in self.tables.items()
                for f in t.files or (None,)]
        target = f"{self.store.path}/{_VERSIONS}/version={number}"
        try:
            (self.store.spark.createDataFrame(
                rows, "table string, file string, schema string, by string")
             .coalesce(1).write.mode("errorifexists").parquet(target))
        except AnalysisException as error:
            if error.getCondition() == "PATH_ALREADY_EXISTS":
                raise VersionConflict(f"version {number} of {self.store.path} exists") from error
            raise
        return number
