"""Intermediate tables in the folder that all executors share.

A written table cuts the lineage: when an executor is lost, later steps read the
files again instead of repeating earlier work.
"""

from __future__ import annotations

import atexit
import gc
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; where that is unset, one in the warehouse."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"


class Workspace:
    """Tables of one operator run below one fresh folder.

    Used as a context manager it deletes its folder at the end, apart from the
    tables named by :meth:`keep`. Those are deleted when the driver process ends,
    because the caller reads them lazily.
    """

    def __init__(self, spark: SparkSession, purpose: str):
        self.spark = spark
        self.path = f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex[:12]}"
        self._written: set[str] = set()
        self._kept: set[str] = set()

    def table(self, name: str, rows: DataFrame) -> DataFrame:
        """Write a table and return it as read from its files."""
        where = f"{self.path}/{name}"
        rows.write.mode("errorifexists").parquet(where)
        self._written.add(name)
        return self.spark.read.schema(rows.schema).parquet(where)

    def keep(self, name: str, rows: DataFrame) -> DataFrame:
        """Like :meth:`table`, for a result that outlives the workspace."""
        if not self._kept:
            atexit.register(self._delete_kept)
        self._kept.add(name)
        return self.table(name, rows)

    def release(self) -> None:
        """Let Spark delete the shuffle files of steps whose results are written.

        It does so once the driver has collected the garbage of their plans, which may be
        long after in a driver with little to do. The scheduler holds the last job until
        the next one, hence the small job.
        """
        self.spark.range(1).count()
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()

    def drop(self, *names: str) -> None:
        """Delete tables that nothing reads any more."""
        for name in names:
            self._delete(f"{self.path}/{name}")
            self._written.discard(name)

    def __enter__(self) -> Workspace:
        return self

    def __exit__(self, *_) -> None:
        self.drop(*(self._written - self._kept))
        if not self._kept:
            self._delete(self.path)

    def _delete_kept(self) -> None:
        if self.spark.sparkContext._jsc is not None:  # else the session was stopped
            self._delete(self.path)

    def _delete(self, where: str) -> None:
        context = self.spark.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(where)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
