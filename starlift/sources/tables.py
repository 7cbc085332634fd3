"""Layer tables: reading, probing and writing them through the session catalog.

Under a root folder the files are what lasts: a table that an earlier process wrote is
registered in the catalog of this one when it is first asked for.
"""

from __future__ import annotations

from datetime import date
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starlift.config import LakeConfig
from starlift.functions.expressions import moment, month_of
from starlift.operators.staging import discard, new_folder, stage
from starlift.sources.ledger import Ledger
from starlift.sources.loads import (
    APPENDS,
    COLUMN,
    NULL_VALUE,
    REPLACES_PARTITIONS,
    REPLACES_TABLE,
    LoadFolders,
    base,
    shown,
)

LAYERS = ("bronze", "silver", "gold")

# Dated tables, the column that dates them, and their partition column.
# ``order_month`` exists only in storage: reads prune by it and drop it.
DATED = {
    ("bronze", "orders"): ("order_date", "order_month"),
    ("silver", "order_sales"): ("order_date", "order_month"),
    ("gold", "fact_sales"): ("order_date", "order_month"),
    ("silver", "stocks_snapshot"): ("dt_stock", "dt_stock"),
    ("gold", "fato_stocks"): ("date_sk", "date_sk"),
}

# Types of the partition columns, which files do not tell.
PARTITION_TYPES = {"order_month": "int", "dt_stock": "date", "date_sk": "bigint"}

# Tables that increments are compared with by their ids. Their files are written
# in the order of the id, so that most row groups lie outside the range of an increment, and
# with Bloom filters of it, so that single ids are found without reading the rest of the range.
ORDERED = {("bronze", "order_items"): "order_id"}

# Column order of a table whose partition column is not its last one.
COLUMN_ORDER = {
    ("gold", "fato_stocks"): ("product_sk", "store_sk", "date_sk", "quantity", "data_criacao_registro"),
}


def observed(seen: Observation) -> int | None:
    """The count ``n`` of a plan that has run; None where the part of the plan that counted
    was dropped while it ran, because it had turned out to be empty."""
    try:
        return seen.get.get("n")
    except Py4JJavaError:
        return None


class Lake:
    """The tables of one lake in one session."""

    def __init__(self, spark: SparkSession, config: LakeConfig):
        self.spark = spark
        self.config = config
        self.ledger = Ledger(spark, f"{config.landing_dir}/_ledger")
        self._folders: dict[tuple[str, str], LoadFolders] = {}
        self._seen: dict[tuple[str, str], frozenset[tuple[int, str]]] = {}
        self._footers: SparkSession | None = None

    def create_databases(self) -> None:
        for layer in LAYERS:
            database = self.config.database(layer)
            place = f" LOCATION '{self.config.root}/{layer}'" if self.config.root else ""
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`{place}")

    def name(self, layer: str, table: str) -> str:
        return f"{self.config.database(layer)}.{table}"

    def place(self, layer: str, table: str) -> str:
        """The table's folder, in the session's warehouse where the lake has no root."""
        if self.config.root:
            return f"{self.config.root.rstrip('/')}/{layer}/{table}"
        database = self.spark.catalog.getDatabase(self.config.database(layer))
        return f"{database.locationUri.rstrip('/')}/{table}"

    @property
    def _by_load(self) -> bool:
        """Whether writes are load folders; other formats keep their own account of them."""
        return self.config.table_format in ("parquet", "orc")

    @property
    def counts_writes(self) -> bool:
        """Whether ``append_new`` and ``overwrite`` tell the number of rows."""
        return self._by_load

    def _loads(self, layer: str, table: str) -> LoadFolders:
        if (layer, table) not in self._folders:
            self._folders[(layer, table)] = LoadFolders(self.spark, self.place(layer, table))
        return self._folders[(layer, table)]

    def exists(self, layer: str, table: str) -> bool:
        """Whether the table is there: in the catalog, or in its folder, where an earlier
        process left it. Any failure is raised, not read as 'no'."""
        if self._by_load and self._place_known(layer) and self._shows(layer, table):
            return True
        return self.spark.catalog.tableExists(self.name(layer, table))

    def _place_known(self, layer: str) -> bool:
        return bool(self.config.root) or self.spark.catalog.databaseExists(self.config.database(layer))

    def _shows(self, layer: str, table: str, schema: T.StructType | None = None) -> bool:
        """Make the catalog show the loads that have ended, no others; False if there are none.

        One listing of the folder tells whether anything has changed since the last look.
        ``schema`` is that of a load that has just ended; else it is read from the files.
        """
        loads = self._loads(layer, table).ended()
        name, pairs = self.name(layer, table), frozenset(shown(loads))
        if not loads or (not pairs and schema is None and not self.spark.catalog.tableExists(name)):
            return False  # a write that had no rows
        there = self.spark.catalog.tableExists(name)
        if there and schema is None and self._seen.get((layer, table)) == pairs:
            return True
        if not there or (schema is not None and self._columns(layer, table) != self._stored(schema, layer, table)):
            if schema is None:
                number, value = max(pairs)
                files = self._loads(layer, table).folder(number)
                reader = self.spark.read.format(self.config.table_format).option("basePath", files)
                schema = reader.load(f"{files}/{value}" if value else files).schema
            self._create(layer, table, schema)
        listed = self._listed(name)
        self._alter(layer, table, "ADD IF NOT EXISTS", pairs - listed)
        self._alter(layer, table, "DROP IF EXISTS", listed - pairs)
        self._seen[(layer, table)] = pairs
        return True

    def _stored(self, schema: T.StructType, layer: str, table: str) -> dict[str, str]:
        """The columns that files hold, and their types."""
        partition = DATED.get((layer, table), (None, None))[1]
        return {field.name: field.dataType.simpleString() for field in schema if field.name not in (partition, COLUMN)}

    def _columns(self, layer: str, table: str) -> dict[str, str]:
        return self._stored(self.spark.table(self.name(layer, table)).schema, layer, table)

    def _create(self, layer: str, table: str, schema: T.StructType) -> None:
        """The table without partitions, in place of one of other columns."""
        self.create_databases()
        name, partition = self.name(layer, table), DATED.get((layer, table), (None, None))[1]
        columns = [f"`{column}` {kind}" for column, kind in self._stored(schema, layer, table).items()]
        columns.append(f"`{COLUMN}` int")
        by = f"`{COLUMN}`"
        if partition:
            columns.append(f"`{partition}` {PARTITION_TYPES[partition]}")
            by += f", `{partition}`"
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")  # the files stay: the table is an external one
        self.spark.sql(
            f"CREATE TABLE {name} ({', '.join(columns)}) USING {self.config.table_format} "
            f"PARTITIONED BY ({by}) LOCATION '{self.place(layer, table)}'"
        )

    def _listed(self, name: str) -> frozenset[tuple[int, str]]:
        """The partitions in the catalog, as (load, partition folder)."""
        found = [row["partition"].partition("/") for row in self.spark.sql(f"SHOW PARTITIONS {name}").collect()]
        return frozenset((int(load.partition("=")[2]), value) for load, _, value in found)

    def _alter(self, layer: str, table: str, change: str, pairs: frozenset[tuple[int, str]]) -> None:
        ordered, most = sorted(pairs), 500
        for start in range(0, len(ordered), most):
            specs = [f"PARTITION ({self._spec(*pair)})" for pair in ordered[start : start + most]]
            joined = (" " if change.startswith("ADD") else ", ").join(specs)
            self.spark.sql(f"ALTER TABLE {self.name(layer, table)} {change} {joined}")

    @staticmethod
    def _spec(number: int, folder: str) -> str:
        if not folder:
            return f"{COLUMN}={number}"
        column, _, value = folder.partition("=")
        return f"{COLUMN}={number}, `{column}`=" + ("null" if value == NULL_VALUE else f"'{value}'")

    def _table(self, layer: str, table: str) -> DataFrame:
        self.exists(layer, table)  # registers it; reading a missing one raises below
        rows = self.spark.table(self.name(layer, table))
        if COLUMN not in rows.columns:
            return rows
        # The condition makes the planner list the files, so that it knows the table's size,
        # and hides what an overwrite is about to take out of the catalog.
        start = base(self._loads(layer, table).ended())
        return rows.filter(F.col(COLUMN) >= start)

    def read(self, layer: str, table: str, above: date | None = None) -> DataFrame:
        """The table's own columns; with ``above`` only rows dated after that day.

        The month condition repeats the day condition in terms of the partition
        column, so whole partitions are skipped before any file is opened.
        """
        rows = self._table(layer, table)
        column, partition = DATED.get((layer, table), (None, None))
        if above is not None:
            rows = rows.filter(F.col(column) > moment(above))
            if partition != column:
                rows = rows.filter(F.col(partition) >= above.year * 100 + above.month)
        if (layer, table) in COLUMN_ORDER:
            return rows.select(*COLUMN_ORDER[(layer, table)])
        return rows.drop(COLUMN) if partition in (None, column) else rows.drop(COLUMN, partition)

    def partition_values(self, layer: str, table: str) -> DataFrame:
        """The values of the partition column, NULL left out: from the catalog where it
        keeps partitions, so that no data file is opened, else from the rows."""
        partition = DATED[(layer, table)][1]
        stored = self._table(layer, table).select(partition)
        if self.config.table_format not in ("parquet", "orc"):
            return stored.distinct().dropna()
        listed = self.spark.sql(f"SHOW PARTITIONS {self.name(layer, table)}")
        value = F.regexp_extract("partition", f"(?:^|/){partition}=([^/]*)$", 1)
        return listed.select(value.try_cast(stored.schema[0].dataType).alias(partition)).distinct().dropna()

    def watermark(self, layer: str, table: str) -> date | None:
        """The latest day stored in a dated table; None when it holds no dated row, which
        is not the same as no row: see ``is_empty``.

        Of the newest partition only the files' footers are read, where the type of the
        column has its greatest value there.
        """
        column, partition = DATED[(layer, table)]
        newest = self.partition_values(layer, table).agg(F.max(partition).alias("value")).first()["value"]
        if newest is None or partition == column:
            return newest
        if not self._by_load:
            stored = self._table(layer, table).filter(F.col(partition) == newest)
            return stored.agg(F.max(column).alias("mark")).first()["mark"]
        return self._greatest(layer, table, newest).agg(F.max("mark").alias("mark")).first()["mark"]

    def _greatest(self, layer: str, table: str, value: int) -> DataFrame:
        """The latest day of one partition in each load that shows, from the files' footers.
        Every row of a dated partition has a day, and the writer keeps its statistics.

        A load is read with the columns of its own files: Spark takes a footer's columns by
        their places, and these may differ from those of the table."""
        column, partition = DATED[(layer, table)]
        loads, folder = self._loads(layer, table), f"{partition}={value}"
        reader = self._footer_session().read.format(self.config.table_format)
        found = [reader.load(f"{loads.folder(number)}/{name}") for number, name in shown(loads.ended()) if name == folder]
        return reduce(DataFrame.union, [load.agg(F.max(column).alias("mark")) for load in found])

    def _footer_session(self) -> SparkSession:
        """A session of its own: the settings that push aggregates down to footers also change
        how tables are read, which other threads must not see."""
        if self._footers is None:
            session = self.spark.newSession()
            for key, value in self.spark.conf.getAll.items():  # such as keys of a store
                if session.conf.get(key, None) != value:
                    session.conf.set(key, value)
            listed = session.conf.get("spark.sql.sources.useV1SourceList").split(",")
            session.conf.set("spark.sql.sources.useV1SourceList", ",".join(name for name in listed if name not in ("parquet", "orc")))
            for name in ("parquet", "orc"):
                session.conf.set(f"spark.sql.{name}.aggregatePushdown", "true")
            self._footers = session
        return self._footers

    def is_empty(self, layer: str, table: str) -> bool:
        return self._table(layer, table).isEmpty()

    def append(self, rows: DataFrame, layer: str, table: str, gather: bool = True) -> None:
        """Add rows, creating the table when it is missing. They show when all are written.

        Without ``gather`` they are written where they are: for rows of a few partition values,
        of which each task writes few files anyway."""
        self._write(rows, layer, table, APPENDS, gather=gather)

    def append_new(self, rows: DataFrame, layer: str, table: str) -> int:
        """Add an increment and tell its number of rows: no load if it has none, few files if
        it has few. The rows are counted while they are written."""
        if (layer, table) not in ORDERED:
            # Rows of a dated table are gathered by its partitions, once.
            rows = rows if (layer, table) in DATED else rows.hint("rebalance")
            return self._write(rows, layer, table, APPENDS, unless_empty=True)
        # Dealing by ranges looks at the rows twice, so they are written aside before.
        folder = new_folder(self.spark, f"new-{table}")
        try:
            column = ORDERED[(layer, table)]
            staged = stage(rows, table, folder).repartitionByRange(column).sortWithinPartitions(column)
            return self._write(staged, layer, table, APPENDS, unless_empty=True)
        finally:
            discard(self.spark, folder)

    def overwrite(self, rows: DataFrame, layer: str, table: str, gather: bool = True) -> int:
        """Replace the whole table and tell its number of rows. The earlier rows are read until the new ones are complete,
        and their files stay until the next load, for readers that have begun on them."""
        return self._write(rows, layer, table, REPLACES_TABLE, gather=gather)

    def replace_partitions(self, rows: DataFrame, layer: str, table: str, gather: bool = True) -> None:
        """Replace just the partitions that ``rows`` has, creating the table when missing."""
        self._write(rows, layer, table, REPLACES_PARTITIONS, gather=gather)

    def _write(
        self, rows: DataFrame, layer: str, table: str, replaces: str, unless_empty: bool = False, gather: bool = True
    ) -> int:
        name, partition = self.name(layer, table), DATED.get((layer, table), (None, None))[1]
        there = self.exists(layer, table)
        if there and replaces != REPLACES_TABLE:
            rows = self._conformed(rows, layer, table)
        seen = Observation()
        laid_out = self._laid_out(rows, layer, table, gather).observe(seen, F.count(F.lit(1)).alias("n"))
        writer = laid_out.write.format(self.config.table_format)
        writer = writer.partitionBy(partition) if partition else writer
        if (layer, table) in ORDERED:
            writer = writer.options(**self._filters(ORDERED[(layer, table)]))
        if not self._by_load:
            if unless_empty and rows.isEmpty():
                return 0
            if there and replaces == REPLACES_PARTITIONS:
                laid_out.select(*self.spark.table(name).columns).write.option("partitionOverwriteMode", "dynamic").insertInto(name, overwrite=True)
                return 0
            place = self.place(layer, table) if self.config.root else None
            writer = writer.option("path", place) if place else writer
            writer.mode("overwrite" if replaces == REPLACES_TABLE else "append").saveAsTable(name)
            return 0
        self.create_databases()
        loads = self._loads(layer, table)
        number = loads.begin(replaces)
        writer.mode("append").save(loads.folder(number))
        n = observed(seen)
        if n is None:
            schema = laid_out.drop(partition).schema if partition else laid_out.schema
            n = self.spark.read.schema(schema).format(self.config.table_format).load(loads.folder(number)).count()
        if unless_empty and not n:
            loads.give_up(number)
            return 0
        loads.end(number)
        self._shows(layer, table, schema=laid_out.schema)
        return n

    def _filters(self, column: str) -> dict[str, str]:
        """Options for a Bloom filter of a column in each row group or stripe."""
        if self.config.table_format == "orc":
            return {"orc.bloom.filter.columns": column, "orc.bloom.filter.fpp": "0.01"}
        return {f"parquet.bloom.filter.enabled#{column}": "true", f"parquet.bloom.filter.adaptive.enabled#{column}": "true"}

    def _conformed(self, rows: DataFrame, layer: str, table: str) -> DataFrame:
        """``rows`` with the stored types, in the stored order."""
        stored = self.read(layer, table).schema
        if sorted(rows.columns) != sorted(stored.names):
            raise ValueError(f"{layer}.{table} has the columns {stored.names}, not {rows.columns}")
        return rows.select(*[F.col(field.name).cast(field.dataType) for field in stored])

    def _laid_out(self, rows: DataFrame, layer: str, table: str, gather: bool) -> DataFrame:
        """Rows gathered by partition value before the write, in order of their day.

        Without this every task would write a file per month. ``rebalance`` lets AQE
        split a month that holds much of the table and merge the small ones. The order
        keeps each day in few row groups of its month.
        """
        column, partition = DATED.get((layer, table), (None, None))
        if partition is None:
            return rows
        if partition == column:
            return rows.hint("rebalance", F.col(partition)) if gather else rows
        rows = rows.withColumn(partition, month_of(column))
        rows = rows.hint("rebalance", F.col(partition)) if gather else rows
        return rows.sortWithinPartitions(partition, column)

    def preview(self, layer: str, table: str, rows: int = 5) -> DataFrame:
        return self.read(layer, table).limit(rows)

    def count(self, layer: str, table: str) -> int:
        return self.read(layer, table).count()

    def drop(self) -> None:
        """Drop the lake's databases with all their tables. Files under a root folder stay."""
        for layer in LAYERS:
            if not self.config.root and self._place_known(layer):
                for table in self.spark.catalog.listTables(self.config.database(layer)):
                    if not table.isTemporary:
                        LoadFolders(self.spark, self.place(layer, table.name)).remove()
            self.spark.sql(f"DROP DATABASE IF EXISTS `{self.config.database(layer)}` CASCADE")
