"""Which version below a root counts, who reads it, and which versions may go.

All of it is told by the names of empty files, so a record is there or not and never half
written:

* ``published/<number>.<version>``: publications in order; the largest number counts.
* ``claims/<number>``: a number that a writer took. Creating it fails if it exists, so of two
  writers one gets the number and the other the next.
* ``leases/<version>/<token>.<expiry>``: somebody reads or builds the version until then.
* ``dropping/<version>``: the version is being deleted.

A reader writes its lease and then looks for the mark; a sweep writes the mark and then looks
for leases. Whichever comes second sees the other, so no reader loses files that it opened.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

#: Seconds that a lease lasts unless it is renewed.
LEASE_SECONDS = 6 * 3600


class Folder:
    """Names in a folder, through the file system that Spark uses for it."""

    def __init__(self, spark: SparkSession, path: str):
        context = spark.sparkContext
        self._jvm = context._jvm
        self.path = path
        self._fs = self._at("").getFileSystem(context._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def names(self) -> list[str]:
        """Names of what lies in the folder; none if it does not exist."""
        if not self._fs.exists(self._at("")):
            return []
        found = [status.getPath().getName() for status in self._fs.listStatus(self._at(""))]
        return sorted(n for n in found if not n.startswith((".", "_")))

    def has(self, name: str) -> bool:
        return self._fs.exists(self._at(name))

    def modified(self, name: str) -> float:
        """Seconds since 1970 of the last change to an entry itself."""
        return self._fs.getFileStatus(self._at(name)).getModificationTime() / 1000

    def create(self, name: str) -> bool:
        """Create an empty file; False if it exists.

        Of several writers one succeeds: the local file system and HDFS create a file or
        fail in one step, as do object stores with conditional puts.
        """
        self._fs.mkdirs(self._at(""))
        path = self._at(name)
        if self._fs.getUri().getScheme() == "file":
            return self._jvm.java.io.File(path.toUri().getPath()).createNewFile()
        try:
            self._fs.create(path, False).close()
        except Exception:
            if self._fs.exists(path):
                return False
            raise
        return True

    def delete(self, name: str = "") -> None:
        """Delete an entry, or the folder, with all that it holds."""
        self._fs.delete(self._at(name), True)


def _records(spark: SparkSession, root: str) -> list[tuple[int, str]]:
    names = Folder(spark, f"{root}/published").names()
    return sorted((int(number), version) for number, _, version in (n.partition(".") for n in names))


def publish_version(spark: SparkSession, root: str, version: str) -> int:
    """Make a version the current one below a root; returns its number.

    Writers that meet get different numbers, and the version with the larger one is current.
    A writer that ends between its claim and its record leaves a gap in the numbers.
    """
    records, claims = (Folder(spark, f"{root}/{name}") for name in ("published", "claims"))
    number = 0
    while True:
        taken = [n for n, _ in _records(spark, root)] + [int(n) for n in claims.names()]
        number = max([number, *taken]) + 1
        if not claims.create(_number(number)):
            continue
        # Else somebody took, published and released this number since the look above.
        if all(n < number for n, _ in _records(spark, root)):
            break
        claims.delete(_number(number))
    records.create(f"{_number(number)}.{version}")
    claims.delete(_number(number))
    return number


def _number(number: int) -> str:
    return f"{number:012d}"


def current_version(spark: SparkSession, root: str) -> str | None:
    """The version published last below a root, or None."""
    records = _records(spark, root)
    return records[-1][1] if records else None


class Lease:
    """Keeps a version from being dropped until it expires or is released."""

    def __init__(self, spark: SparkSession, root: str, version: str, seconds: float = LEASE_SECONDS):
        self._folder = Folder(spark, f"{root}/leases/{version}")
        self._token, self._seconds, self._name = uuid.uuid4().hex[:12], seconds, None
        self.renew()

    def renew(self) -> None:
        """Last as long as at the start from now on."""
        former, self._name = self._name, f"{self._token}.{int(time.time() + self._seconds)}"
        self._folder.create(self._name)
        if former not in (None, self._name):
            self._folder.delete(former)

    def release(self) -> None:
        self._folder.delete(self._name)

    def __enter__(self) -> Lease:
        return self

    def __exit__(self, *_) -> None:
        self.release()


@contextmanager
def opened(
    spark: SparkSession, root: str, folder: str, seconds: float = LEASE_SECONDS
) -> Iterator[str | None]:
    """The current version, or None, with a lease on it for as long as the block runs."""
    while (version := current_version(spark, root)) is not None:
        with Lease(spark, root, version, seconds):
            dropping = Folder(spark, f"{root}/dropping").has(version)
            if not dropping and Folder(spark, f"{root}/{folder}").has(version):
                yield version
                return
        if current_version(spark, root) == version and not dropping:
            raise FileNotFoundError(f"published version {version} has no files under {root}/{folder}")
        time.sleep(0.1)
    yield None


def leased(spark: SparkSession, root: str, version: str, now: float) -> bool:
    names = Folder(spark, f"{root}/leases/{version}").names()
    return any(int(name.partition(".")[2]) >= now for name in names)


@dataclass(frozen=True)
class Retention:
    """How many published versions stay, and the seconds since its last change before a
    version that is not among them may go."""

    keep: int = 3
    grace_seconds: float = 86400.0

    def __post_init__(self):
        if self.keep < 1:
            raise ValueError("at least the current version stays")


def sweep(
    spark: SparkSession, root: str, folder: str, retention: Retention = Retention(), now: float | None = None
) -> list[str]:
    """Drop the versions below ``<root>/<folder>`` that nothing needs; returns their names.

    What stays: the versions published last, those under a lease, and those changed within
    the grace time, such as runs of builds that go on. The rest goes: superseded versions,
    and rejected or abandoned ones, which no record names. A sweep that ended half-way is
    finished by the next one.
    """
    now = time.time() if now is None else now
    versions, marks = Folder(spark, f"{root}/{folder}"), Folder(spark, f"{root}/dropping")
    records = _records(spark, root)
    latest = list(dict.fromkeys(version for _, version in reversed(records)))[: retention.keep]
    unneeded = [v for v in versions.names() if v not in latest]
    half_done = set(marks.names())
    changed = _last_changes(spark, versions, [v for v in unneeded if v not in half_done])
    dropped = []
    for version in unneeded:
        if version not in half_done and changed[version] > now - retention.grace_seconds:
            continue
        marks.create(version)
        if leased(spark, root, version, now):
            marks.delete(version)
            continue
        versions.delete(version)
        Folder(spark, f"{root}/leases/{version}").delete()
        dropped.append(version)
    published = Folder(spark, f"{root}/published")
    for number, version in records:
        if version in dropped or version in half_done - set(unneeded):
            published.delete(f"{_number(number)}.{version}")
    for version in {*dropped, *(half_done - set(versions.names()))}:
        marks.delete(version)
    claims = Folder(spark, f"{root}/claims")
    for name in claims.names():
        if records and int(name) < records[-1][0]:
            claims.delete(name)
    return dropped


def _last_changes(spark: SparkSession, versions: Folder, names: list[str]) -> dict[str, float]:
    """Seconds since 1970 of the last change to any file of a version, from one listing."""
    changed = {name: versions.modified(name) for name in names}
    if names:
        files = (
            spark.read.format("binaryFile")
            .option("recursiveFileLookup", "true")
            .load([f"{versions.path}/{name}" for name in names])
        )
        rest = F.substring_index("path", f"{versions.path.rstrip('/').rsplit('/', 1)[-1]}/", -1)
        version = F.substring_index(rest, "/", 1).alias("version")
        latest = files.select(version, F.col("modificationTime").cast("double").alias("at"))
        for row in latest.groupBy("version").agg(F.max("at").alias("at")).collect():
            if row.version in changed:
                changed[row.version] = max(changed[row.version], row.at)
    return changed
