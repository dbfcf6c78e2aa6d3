"""The star schema and the marts as partitioned parquet under one root folder."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewmill.schemas import TABLES, Table
from viewmill.sources.buckets import bucketed_folders, forget_buckets, read_buckets, write_buckets
from viewmill.sources.commits import Folders, OpenLoads


class StarStore:
    """Reads and writes the tables of :data:`viewmill.schemas.TABLES` below ``root``.

    What loads write carries a ``load_id`` partition and becomes visible all at once, in every table, when the load is
    committed (see :class:`OpenLoads`). Loads only ever add; the rejected views of a load are replaced when it is
    repeated. Facts, their increments and marts are also partitioned by ``sk_date``.

    One writer at a time is assumed, and any number of readers. A table shows the loads committed when it was read; of
    tables that belong together read the facts first, then dimensions, which may only have more.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.folders = Folders(spark, self.root)
        self.loads = OpenLoads(self.folders)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def init(self) -> StarStore:
        """Create every table that does not exist yet; existing ones are left alone."""

        for name in TABLES:
            self.folders.make(self.path(name))
        return self

    def _committed(self, name: str, paths: list[str]) -> DataFrame:
        """Rows of committed loads in files of a table. The schema is declared, never inferred.

        Files are listed when the table is read, so loads that are open before or after that are left out; if any began
        or ended meanwhile, the files are listed again.
        """
        reader = self.spark.read.schema(TABLES[name].stored_schema).option("basePath", self.path(name))
        if "load_id" not in TABLES[name].partitions:
            return reader.parquet(*paths)
        while True:
            before = self.loads.state()
            rows = reader.parquet(*paths)
            if self.loads.state() == before:
                hidden = self.loads.hidden_in(before)
                return rows.filter(~F.col("load_id").isin(hidden)) if hidden else rows

    def read(self, name: str) -> DataFrame:
        """A whole table, its partition columns included."""
        return self._committed(name, [self.path(name)])

    def read_days(self, name: str, days: Iterable[int]) -> DataFrame:
        """The given ``sk_date`` partitions; only their folders are listed, not the whole table."""
        folders = self.folders.matching(f"{self.path(name)}/sk_date={{{','.join(str(d) for d in days)}}}")
        return self._committed(name, folders) if folders else self.read(name).filter(F.lit(False))

    def _load_folders(self, name: str, load_id: str) -> list[str]:
        folder = f"load_id={self.folders.escaped(load_id)}"
        days = "sk_date=*/" if "sk_date" in TABLES[name].partitions else ""
        return self.folders.matching(f"{self.path(name)}/{days}{folder}")

    def read_loads(self, name: str, load_ids: Iterable[str]) -> DataFrame:
        """The files of the given loads, committed or not; only their folders are listed."""
        folders = [folder for load_id in load_ids for folder in self._load_folders(name, load_id)]
        reader = self.spark.read.schema(TABLES[name].stored_schema).option("basePath", self.path(name))
        return reader.parquet(*folders) if folders else self.read(name).filter(F.lit(False))

    def read_parts(self, name: str, load_ids: Iterable[str] | None = None) -> list[DataFrame]:
        """The committed rows of a table, or of some of its loads, in parts: each load that lies in buckets by itself, so
        that a join on the key leaves it where it is, and all others together."""
        table = TABLES[name]
        while True:
            before = self.loads.state()
            hidden = set(self.loads.hidden_in(before))
            folders = bucketed_folders(self.folders, f"{self.path(name)}/load_id=*")
            dealt = {self.folders.unescaped(folder.rsplit("load_id=", 1)[1]): folder for folder in folders}
            chosen = {i: f for i, f in dealt.items() if i not in hidden and (load_ids is None or i in set(load_ids))}
            parts = [read_buckets(self.spark, self.folders, f, table.key, table.schema) for f in chosen.values()]
            if load_ids is None:
                rest = self.read(name)
                rest = rest.filter(~F.col("load_id").isin(list(dealt))) if dealt else rest
            else:
                rest = self.read_loads(name, [i for i in load_ids if i not in dealt and i not in hidden])
            if self.loads.state() == before:
                return [*parts, rest.select(*table.columns)]

    def begin_load(self, load_id: str, replaces: list[str] | None = None) -> str:
        """Open a load and return the name that its rows carry; ``replaces`` are loads that count until it is committed.

        Rows of an attempt that failed are removed: nobody has seen them. If the load is committed already, what a
        repetition adds is a load of its own, named ``load_id+1`` and so on.
        """
        name, repeated = load_id, 0
        begun = self.loads.open_in(self.loads.state())
        while name not in begun and self._load_folders("loads", name):
            repeated += 1
            name = f"{load_id}+{repeated}"
        self.loads.begin(name, replaces)
        if name in begun:
            self.delete_load(name)
        return name

    def delete_load(self, load_id: str) -> None:
        """Delete all files of a load that no reader counts, but for rejected views."""
        for table, declared in TABLES.items():
            if "load_id" in declared.partitions and table != "rejected_views":
                for folder in self._load_folders(table, load_id):
                    forget_buckets(self.spark, self.folders, folder)
                    self.folders.delete(folder)

    def commit_load(self, load_id: str) -> None:
        """Show a load to readers, in all tables at once."""
        self.loads.commit(load_id)

    def drop_folder(self, folder: str) -> None:
        """Delete an intermediate table."""
        self.folders.delete(folder)

    def table(self, name: str) -> DataFrame:
        """The declared columns of a table, without storage bookkeeping."""
        return self.read(name).select(*TABLES[name].columns)

    def fact_for_day(self, sk_date: int) -> DataFrame:
        name = "fact_product_views"
        return self.read_days(name, [sk_date]).select(*TABLES[name].columns)

    def add_rows(self, name: str, rows: DataFrame, load_id: str) -> None:
        """Add ``rows`` to table ``name`` under ``load_id``; nothing that is stored goes."""
        self._write(name, rows, load_id, "append")

    def add_as_is(self, name: str, rows: DataFrame, load_id: str, layout: Mapping[str, str] | None = None) -> None:
        """As :meth:`add_rows`, with the partitions of ``rows`` as files and writer options ``layout``."""
        table = TABLES[name]
        (
            rows.withColumn("load_id", F.lit(load_id))
            .select(*table.stored_schema.names)
            .write.mode("append")
            .options(**(layout or {}))
            .partitionBy(*table.partitions)
            .parquet(self.path(name))
        )

    def add_buckets(
        self, name: str, rows: DataFrame, load_id: str, count: int, layout: Mapping[str, str] | None = None
    ) -> None:
        """As :meth:`add_rows` for a table without days, in ``count`` buckets of the table's key."""
        table = TABLES[name]
        folder = f"{self.path(name)}/load_id={self.folders.escaped(load_id)}"
        write_buckets(self.folders, rows.select(*table.columns), folder, table.key, count, layout)

    def replace_load(self, name: str, rows: DataFrame, load_id: str) -> None:
        """Make ``rows``, which may be none, the content of load ``load_id`` in a table without days."""
        self.drop_folder(f"{self.path(name)}/load_id={self.folders.escaped(load_id)}")
        self._write(name, rows, load_id, "append")

    def _write(self, name: str, rows: DataFrame, load_id: str, mode: str) -> None:
        """Files are laid out by a rebalance: partitions are merged or split to the advisory size, and a
        day with most of the rows is written by several tasks.
        """
        table: Table = TABLES[name]
        by = [c for c in table.partitions if c != "load_id"]
        (
            rows.select(*table.columns)
            .hint("rebalance", *by)
            .withColumn("load_id", F.lit(load_id))
            .write.mode(mode)
            .partitionBy(*table.partitions)
            .parquet(self.path(name))
        )

    def write_days(self, name: str, rows: DataFrame) -> None:
        """Replace the ``sk_date`` partitions that occur in ``rows``; all others stay."""
        (
            rows.select(*TABLES[name].columns)
            .hint("rebalance", "sk_date")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("sk_date")
            .parquet(self.path(name))
        )

    def clear_day(self, name: str, sk_date: int) -> None:
        """Leave an ``sk_date`` partition without rows."""
        columns = [c for c in TABLES[name].columns if c != "sk_date"]
        empty = self.read(name).filter(F.lit(False)).select(*columns)
        empty.write.mode("overwrite").parquet(f"{self.path(name)}/sk_date={sk_date}")
