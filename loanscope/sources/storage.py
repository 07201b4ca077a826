"""Layered tables of one build, scratch space and the published run."""

from __future__ import annotations

import atexit
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanscope.sources.publication import (
    LEASE_SECONDS,
    Lease,
    Retention,
    current_version,
    opened,
    publish_version,
    sweep,
)

#: Bytes of a row group of a clustered table, before compression: a bucket has several.
ROW_GROUP_BYTES = 16 << 20
#: Folder of the runs below a root.
RUNS = "runs"


def new_run_id() -> str:
    return uuid.uuid4().hex[:12]


def scratch_dir(spark: SparkSession, purpose: str, root: str | None = None) -> str:
    """A fresh folder that every executor can reach, deleted when the driver ends.

    It lies under the given root, else in the shared folder named by
    ``spark.checkpoint.dir``, else in the warehouse.
    """
    shared = root or spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        warehouse = spark.conf.get("spark.sql.warehouse.dir", None)
        if not warehouse:
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        shared = f"{warehouse.rstrip('/')}/_scratch"
    path = f"{shared.rstrip('/')}/loanscope-{purpose}-{new_run_id()}"
    atexit.register(delete, spark, path)
    return path


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder, if the session can still do it."""
    context = spark.sparkContext
    if context._jsc is not None:
        folder = context._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)


_METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"
#: Bytes of code beyond which the JIT compiler leaves a method to the interpreter.
JIT_METHOD_BYTES = 8000
_limited: dict[SparkSession, list] = {}
_limited_lock = threading.Lock()


@contextmanager
def compiled_methods(spark: SparkSession) -> Iterator[None]:
    """Lets Spark cut generated code into methods that the JIT compiler takes, while jobs run.

    A projection of many parsed or rendered fields becomes one method of more bytes than that
    by default, and each row is then interpreted. Blocks may run side by side; the last one to
    end restores what the session had.
    """
    with _limited_lock:
        held = _limited.setdefault(spark, [0, spark.conf.get(_METHOD_LIMIT, None)])
        held[0] += 1
        if held[1] is None or int(held[1]) > JIT_METHOD_BYTES:
            spark.conf.set(_METHOD_LIMIT, JIT_METHOD_BYTES)
    try:
        yield
    finally:
        with _limited_lock:
            held[0] -= 1
            if not held[0]:
                del _limited[spark]
                if held[1] is None:
                    spark.conf.unset(_METHOD_LIMIT)
                else:
                    spark.conf.set(_METHOD_LIMIT, held[1])


def written(table: DataFrame, path: str) -> DataFrame:
    """Store a table and continue from the stored copy."""
    with compiled_methods(table.sparkSession):
        table.write.mode("errorifexists").parquet(path)
    return table.sparkSession.read.schema(table.schema).parquet(path)


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Size of the files below a folder, from their listing."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load(path)
    )
    return files.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]


@dataclass(frozen=True)
class RunStore:
    """Tables of one run, each written once under ``<root>/runs/<run_id>``."""

    spark: SparkSession
    root: str
    run_id: str

    @property
    def path(self) -> str:
        return f"{self.root}/{RUNS}/{self.run_id}"

    def lease(self, seconds: float = LEASE_SECONDS) -> Lease:
        """Keeps the run's files while it is built or read."""
        return Lease(self.spark, self.root, self.run_id, seconds)

    def table_path(self, name: str) -> str:
        return f"{self.path}/{name.replace('.', '/')}"

    def write(self, name: str, table: DataFrame) -> DataFrame:
        return written(table, self.table_path(name))

    def write_clustered(
        self, name: str, table: DataFrame, by: str, order: list[str], buckets: int,
        row_group_bytes: int = ROW_GROUP_BYTES,
    ) -> DataFrame:
        """Store a table hash-clustered by a column and return its bucketed view.

        Inside a bucket rows lie in the given order, in row groups of the given size: a filter
        on the first column of the order reads those row groups whose range holds the value.

        Expects rows already hash-partitioned by the column into as many
        partitions as buckets; each task then writes one file. Later joins and
        windows by the column need no exchange. The catalog entry is only needed
        while this session reads the buckets; see :meth:`forget`. Files below the
        path read as a plain table any time.
        """
        entry = self._catalog_name(name)
        (
            table.write.format("parquet")
            .bucketBy(buckets, by)
            .sortBy(*order)
            .option("parquet.block.size", row_group_bytes)
            .option("path", self.table_path(name))
            .mode("errorifexists")
            .saveAsTable(entry)
        )
        return self.spark.table(entry)

    def forget(self, name: str) -> None:
        """Drop the catalog entry of a clustered table; its files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self._catalog_name(name)}")

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.table_path(name))

    def _catalog_name(self, name: str) -> str:
        return f"loanscope_{self.run_id}_{name.replace('.', '_')}"


def publish(store: RunStore) -> None:
    """Make a run the current one."""
    publish_version(store.spark, store.root, store.run_id)


def current_run(spark: SparkSession, root: str) -> RunStore | None:
    """The run published last, or None. See :func:`opened_run` for reading it at length."""
    latest = current_version(spark, root)
    return RunStore(spark, root, latest) if latest else None


@contextmanager
def opened_run(spark: SparkSession, root: str, seconds: float = LEASE_SECONDS) -> Iterator[RunStore]:
    """The run published last, which no later build drops while the block runs."""
    with opened(spark, root, RUNS, seconds) as version:
        if version is None:
            raise FileNotFoundError(f"no published run under {root}")
        yield RunStore(spark, root, version)


def drop_former_runs(spark: SparkSession, root: str, retention: Retention = Retention()) -> list[str]:
    """Delete runs that are superseded, rejected or abandoned; see :func:`sweep`."""
    return sweep(spark, root, RUNS, retention)
