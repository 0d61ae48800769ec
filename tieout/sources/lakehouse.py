"""Tables by layer and name, as directories or as catalog tables, published by pointer.

A job writes each table once, into a folder (or catalog table) named by its run, which is
where it stays. What makes the run's tables current is one small change at the end: a row
per table is added to a log of publications, one file for the whole run (or one view whose
definition lists them). So tables change all together or not at all, nothing is renamed or
copied, and a frame over replaced tables stays valid until `expire` removes them.

    root/published/                      the log: version, run, layer, table
    root/gold/recon_detail/run_ab12.../  the data of a run
    catalog.gold.published_tables        the log, a view of constants
    catalog.gold.recon_detail__run_ab12  the data of a run
    catalog.gold.recon_detail            a view of the newest, set after the log
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tieout import schemas
from tieout.functions.casts import conform
from tieout.session import run_folder

LAYERS = ("bronze", "silver", "quarantine", "gold")
LOG = "version bigint, run string, layer string, table string"
Runs = dict[tuple[str, str], str]


@dataclass(frozen=True)
class Lakehouse:
    """Resolves tables; `root` for directories, else `catalog`, which must have views.

    Reads see the tables that were current when this object was first used, and what it
    publishes itself; `refresh` takes up what others published. `work` is the folder for
    intermediate tables. It must be shared storage. `table_format` is any format the
    session can write and read back.
    """

    spark: SparkSession
    root: str | None = None
    catalog: str | None = None
    work: str | None = None
    table_format: str = "parquet"
    _held: dict[str, Runs] = field(default_factory=dict, compare=False, repr=False)

    def __post_init__(self) -> None:
        if (self.root is None) == (self.catalog is None):
            raise ValueError("give either a root folder or a catalog")

    def target(self, layer: str, table: str) -> str:
        """The name of a table, which no publication changes."""
        if self.catalog is not None:
            return f"{self.catalog}.{layer}.{table}"
        return f"{self.root.rstrip('/')}/{layer}/{table}"

    def location(self, layer: str, table: str) -> str:
        """Where its current data are; the name itself if it was never published."""
        run = self.runs().get((layer, table))
        return self.target(layer, table) if run is None else self.place(layer, table, run)

    def place(self, layer: str, table: str, run: str) -> str:
        between = "/" if self.catalog is None else "__"
        return f"{self.target(layer, table)}{between}{run}"

    def create_layers(self) -> None:
        if self.catalog is not None:
            for layer in LAYERS:
                self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.catalog}.{layer}")

    # --- reading and writing ---------------------------------------------------------

    def write(
        self, df: DataFrame, layer: str, table: str, partition_by: Sequence[str] = ()
    ) -> DataFrame:
        """Replace the table and return it as stored."""
        with self.staged() as stage:
            stage.write(df, layer, table, partition_by)
        return self.read(layer, table)

    def read(self, layer: str, table: str) -> DataFrame:
        schema = schemas.declared(layer, table)
        if self.catalog is not None:
            stored = self.spark.table(self.location(layer, table))
        else:
            reader = self.spark.read.format(self.table_format).schema(schema)
            stored = reader.load(self.location(layer, table))
        return stored.select(*schema.fieldNames())

    def register_views(self) -> None:
        """Name every stored table for SQL, as `layer_table`: gold_recon_detail."""
        for layer, table in schemas.TABLES:
            self.read(layer, table).createOrReplaceTempView(f"{layer}_{table}")

    def scratch(self) -> "Scratch":
        return Scratch(self.spark, f"{self.work_folder()}/scratch-{uuid.uuid4().hex}")

    def work_folder(self) -> str:
        if self.work is not None:
            return self.work
        if self.root is not None:
            return f"{self.root.rstrip('/')}/_work"
        return run_folder(self.spark)

    # --- publications ----------------------------------------------------------------

    @contextmanager
    def staged(self) -> Iterator["Staged"]:
        """Tables written inside become current together at the end, if nothing raised.

        Intermediate tables are removed then. After a failure everything is left
        for inspection, and the current tables are as they were.
        """
        run = f"run_{uuid.uuid4().hex}"
        stage = Staged(
            self.spark,
            self.root,
            self.catalog,
            f"{self.work_folder()}/{run}",
            self.table_format,
            {"runs": self.refresh()},
            run,
        )
        yield stage
        if stage.written:
            self.publish(run, stage.written)
        remove(self.spark, stage.work)

    def publish(self, run: str, tables: Sequence[tuple[str, str]]) -> None:
        """Make the run's data of these tables, all written already, the current ones.

        Of two runs that publish at once, the one with the greater name wins, for all
        tables that both have. In a catalog only one may publish at a time.
        """
        version = 1 + max((entry["version"] for entry in self.newest()), default=0)
        entries = [(version, run, layer, table) for layer, table in tables]
        if self.catalog is None:
            # One row group of one task: its file appears when the job commits.
            made = self.spark.createDataFrame(entries, LOG).coalesce(1)
            made.write.mode("append").json(self.log_name())
        else:
            self.write_catalog_log([*map(tuple, self.log().collect()), *entries])
        self._held["runs"] = self.runs() | {table: run for table in tables}
        if self.catalog is not None:
            self.name_tables(tables)

    def name_tables(self, tables: Sequence[tuple[str, str]] | None = None) -> None:
        """Point the catalog's plain names at the current tables, all of them by default.

        They follow the log one by one; `read` goes by the log alone. A job that died
        before this is mended by calling it, or by the next publication.
        """
        for layer, table in tables or self.runs():
            name, stored = self.target(layer, table), self.location(layer, table)
            self.spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {stored}")

    def runs(self) -> Runs:
        """The run of every published table, as of the first use or `refresh`."""
        held = self._held.get("runs")
        return self.refresh() if held is None else held

    def refresh(self) -> Runs:
        """Take up what others published."""
        held = {(e["layer"], e["table"]): e["run"] for e in self.newest()}
        self._held["runs"] = held
        return held

    def expire(self, keep: int = 1, unpublished: bool = False) -> list[str]:
        """Remove the data of all but the newest `keep` publications of each table.

        Frames over them become invalid. `unpublished` also removes what failed runs
        left, and must not be used while another job writes. Returns what was removed.
        """
        log = sorted(self.log().collect(), key=lambda e: (e["version"], e["run"]), reverse=True)
        published: dict[tuple[str, str], list[str]] = {}
        for entry in log:
            published.setdefault((entry["layer"], entry["table"]), []).append(entry["run"])
        gone = []
        for layer, table in schemas.TABLES | schemas.REJECTS:
            known = published.get((layer, table), [])
            stored = self.stored_runs(layer, table)
            drop = [r for r in stored if r in known[keep:] or (unpublished and r not in known)]
            gone += [self.place(layer, table, run) for run in drop]
        for place in gone:
            if self.catalog is not None:
                self.spark.sql(f"DROP TABLE {place}")
            else:
                remove(self.spark, place)
        return gone

    def stored_runs(self, layer: str, table: str) -> list[str]:
        """Runs whose data of a table are there, published or not."""
        if self.catalog is None:
            return [n for n in folders(self.spark, self.target(layer, table)) if n.startswith("run_")]
        tables = self.spark.sql(f"SHOW TABLES IN {self.catalog}.{layer} LIKE '{table}__run_*'")
        return [row["tableName"].removeprefix(f"{table}__") for row in tables.collect()]

    def log_name(self) -> str:
        if self.catalog is not None:
            return f"{self.catalog}.gold.published_tables"
        return f"{self.root.rstrip('/')}/published"

    def log(self) -> DataFrame:
        """(version, run, layer, table) of all publications."""
        try:
            if self.catalog is not None:
                return self.spark.table(self.log_name())
            return self.spark.read.schema(LOG).json(self.log_name())
        except AnalysisException as missing:
            if missing.getCondition() not in ("PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND"):
                raise
            return self.spark.createDataFrame([], LOG)

    def newest(self) -> list:
        """The last publication of every table."""
        last = F.max(F.struct("version", "run")).alias("last")
        per_table = self.log().groupBy("layer", "table").agg(last)
        return per_table.select("layer", "table", "last.*").collect()

    def write_catalog_log(self, entries: Sequence[tuple]) -> None:
        rows = ", ".join(f"({v}L, '{run}', '{layer}', '{table}')" for v, run, layer, table in entries)
        self.spark.sql(
            f"CREATE OR REPLACE VIEW {self.log_name()} AS"
            f" SELECT * FROM VALUES {rows} AS log(version, run, layer, table)"
        )


@dataclass(frozen=True)
class Staged(Lakehouse):
    """A lakehouse whose writes are not seen outside yet; it reads its own first.

    What it does not write is read as it was when the job began.
    """

    run: str = ""
    written: dict[tuple[str, str], Sequence[str]] = field(default_factory=dict)

    def location(self, layer: str, table: str) -> str:
        if (layer, table) in self.written:
            return self.place(layer, table, self.run)
        return super().location(layer, table)

    def write(
        self, df: DataFrame, layer: str, table: str, partition_by: Sequence[str] = ()
    ) -> DataFrame:
        declared = conform(df, schemas.declared(layer, table), f"{layer}.{table}")
        writer = declared.write.mode("overwrite").format(self.table_format)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        place = self.place(layer, table, self.run)
        if self.catalog is not None:
            writer.saveAsTable(place)
        else:
            writer.save(place)
        self.written[layer, table] = partition_by
        return self.read(layer, table)


def _path(spark: SparkSession, path: str):
    """A path and its file system, for listing and removing folders."""
    of = spark._jvm.org.apache.hadoop.fs.Path(path)
    return of, of.getFileSystem(spark._jsc.hadoopConfiguration())


def folders(spark: SparkSession, folder: str) -> list[str]:
    """Names of the folders in a folder, none if it is not there."""
    path, files = _path(spark, folder)
    if not files.exists(path):
        return []
    return [f.getPath().getName() for f in files.listStatus(path) if f.isDirectory()]


def remove(spark: SparkSession, folder: str) -> None:
    path, files = _path(spark, folder)
    files.delete(path, True)


#: Spark's own switch, of 4.1, by which a query's shuffle files go when it ends.
FREES_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@dataclass(frozen=True)
class Scratch:
    """Intermediate tables of a run, written to shared storage and read back.

    A written table has a known size. The planner broadcasts it below
    spark.sql.autoBroadcastJoinThreshold and otherwise plans a sort-merge join,
    whose skewed partitions AQE splits; no hint is needed. It also ends the
    lineage in a way that survives losing executors. With `frees_shuffles`, the
    shuffle files of a table are removed as soon as it is written.
    """

    spark: SparkSession
    root: str
    frees_shuffles: bool = False
    _paths: dict[DataFrame, str] = field(default_factory=dict, compare=False, repr=False)

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}-{uuid.uuid4().hex}"
        with self.freeing():
            df.write.mode("error").parquet(path)
        stored = self.spark.read.schema(df.schema).parquet(path)
        self._paths[stored] = path
        return stored

    def drop(self, stored: DataFrame) -> None:
        """Remove a table that `keep` returned and nothing reads any more."""
        if path := self._paths.pop(stored, None):
            remove(self.spark, path)

    @contextmanager
    def freeing(self) -> Iterator[None]:
        before = self.spark.conf.get(FREES_SHUFFLES, None)
        if not self.frees_shuffles or before == "true":
            yield
            return
        self.spark.conf.set(FREES_SHUFFLES, "true")
        try:
            yield
        finally:
            if before is None:
                self.spark.conf.unset(FREES_SHUFFLES)
            else:
                self.spark.conf.set(FREES_SHUFFLES, before)
