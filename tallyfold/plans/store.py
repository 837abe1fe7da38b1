"""Durable steps in a folder that driver and executors share: staged publication, manifests, a writer lock.

A dataset version is written to a staging folder, checked, renamed to a name of its own, and only then named
by a manifest; a reader that follows the manifest never sees a part of it.  All file work goes through
Hadoop's file system, so any store that Spark reads will do.

A small JSON text (a manifest, a watermark) is a series of numbered files: a new one is written under a
temporary name and renamed to a number that no file has.  Nothing is ever replaced, so a crash at any point
leaves the old text or the new one.
"""

from __future__ import annotations

import json
import re
import threading
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

MANIFEST = "MANIFEST.json"
#: Numbered texts that stay for readers which have listed the folder but not read yet.
KEPT_TEXTS = 3


class Folder:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._Path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._fs = self._Path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def path(self, name: str):
        return self._Path(f"{self.root}/{name}")

    def exists(self, name: str) -> bool:
        return self._fs.exists(self.path(name))

    def delete(self, name: str) -> None:
        self._fs.delete(self.path(name), True)

    def rename(self, old: str, new: str) -> None:
        if not self._fs.rename(self.path(old), self.path(new)):
            raise OSError(f"cannot rename {old} to {new}")

    def names(self) -> list[str]:
        """What the folder holds directly."""
        at = self._Path(self.root)
        return sorted(s.getPath().getName() for s in self._fs.listStatus(at)) if self._fs.exists(at) else []

    def _numbers(self, name: str) -> list[int]:
        found = (re.fullmatch(re.escape(name) + r"\.(\d{12})", x) for x in self.names())
        return sorted(int(m[1]) for m in found if m)

    def write_text(self, name: str, text: str) -> None:
        out = self._fs.create(self.path(name), True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()

    def read_text(self, name: str) -> str:
        opened = self._fs.open(self.path(name))
        try:
            return self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(opened, "UTF-8")
        finally:
            opened.close()

    def write_json(self, name: str, value: dict) -> None:
        """Readers see the old or the new text, whenever the writer stops."""
        body, numbers = json.dumps(value, sort_keys=True, indent=1, default=str), self._numbers(name)
        temporary = f"_{name}.{uuid.uuid4().hex}"
        self.write_text(temporary, body)
        self.rename(temporary, f"{name}.{(numbers[-1] + 1 if numbers else 1):012d}")
        for n in numbers[: 1 - KEPT_TEXTS]:
            self.delete(f"{name}.{n:012d}")

    def read_json(self, name: str) -> dict | None:
        numbers = self._numbers(name)
        if not numbers:
            return None
        return json.loads(self.read_text(f"{name}.{numbers[-1]:012d}"))

    def delete_json(self, name: str) -> None:
        """The newest goes last: until then a reader sees it."""
        for n in self._numbers(name):
            self.delete(f"{name}.{n:012d}")

    def lock(self, name: str = "_LOCK", lease: float = 120.0) -> "WriterLock":
        return WriterLock(self, name, lease)


class WriterLock:
    """One writer: a file that is created atomically, renewed while it is held, and removed at the end.

    A writer that died stops renewing; after ``lease`` seconds without a sign of it the next one moves the file
    away (a rename that one of several succeeds in) and takes over.  ``check`` raises if that happened to us.
    """

    def __init__(self, folder: Folder, name: str, lease: float):
        self.folder, self.name, self.lease, self.owner = folder, name, lease, uuid.uuid4().hex
        self._end = threading.Event()

    def _age(self) -> float | None:
        fs, at = self.folder._fs, self.folder.path(self.name)
        if not fs.exists(at):
            return None
        return time.time() - fs.getFileStatus(at).getModificationTime() / 1000

    def __enter__(self) -> "WriterLock":
        fs, at = self.folder._fs, self.folder.path(self.name)
        fs.mkdirs(self.folder.path("."))
        if not fs.createNewFile(at):
            age = self._age()
            if age is not None and age <= self.lease:
                raise RuntimeError(f"another writer holds {self.folder.root}/{self.name}")
            if age is not None:
                gone = f"_stale-{uuid.uuid4().hex}"
                fs.rename(at, self.folder.path(gone))
                self.folder.delete(gone)
            if not fs.createNewFile(at):
                raise RuntimeError(f"another writer holds {self.folder.root}/{self.name}")
        self.folder.write_text(self.name, self.owner)
        threading.Thread(target=self._renew, daemon=True).start()
        return self

    def _renew(self) -> None:
        while not self._end.wait(self.lease / 4):
            self.folder._fs.setTimes(self.folder.path(self.name), int(time.time() * 1000), -1)

    def check(self) -> None:
        if self._age() is None or self.folder.read_text(self.name) != self.owner:
            raise RuntimeError(f"the lock {self.folder.root}/{self.name} was taken over")

    def __exit__(self, *_) -> None:
        self._end.set()
        if self._age() is not None and self.folder.read_text(self.name) == self.owner:
            self.folder.delete(self.name)


# ---- published versions ------------------------------------------------------------------------------


class WriteMismatch(RuntimeError):
    """The rows that were written are not the rows that were planned."""


def checksum(df: DataFrame):
    """A sum over hashes of rows: the same for the same rows in any order."""
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    as_text = lambda c: F.to_json(F.struct(F.col(f"`{c}`")))  # noqa: E731  (maps and variants have no hash of their own)
    parts = [as_text(c) if "map<" in k or "variant" in k else F.col(f"`{c}`") for c, k in kinds.items()]
    return F.coalesce(F.sum(F.xxhash64(*parts).cast("decimal(38,0)")), F.lit(0)).cast("string")


def manifest(folder: Folder) -> dict | None:
    """What is published; None before the first publication.  A folder with versions but without a
    manifest is an error, never an empty table."""
    m = folder.read_json(MANIFEST)
    if m is None and any(x.startswith(("v=", "d=")) for x in folder.names()):
        raise RuntimeError(f"{folder.root} holds versions but no manifest")
    return m if m is not None and m.get("version") is not None else None


def _open(folder: Folder) -> None:
    """Says that the folder is in use before the first version is moved into it."""
    if manifest(folder) is None and folder.read_json(MANIFEST) is None:
        folder.write_json(MANIFEST, {"version": None})


def publish(df: DataFrame, root: str, version: str, check: Callable[[DataFrame], None] | None = None, partition_by: list[str] | None = None, planned: int | None = None) -> str:
    """Write a version, check what was written, rename it into place and name it in the manifest last.

    Rows and checksum are taken while writing; the files must hold as many rows, and ``planned`` if it is given
    (the checked write: a row that got lost on the way stops the publication).
    """
    folder = Folder(df.sparkSession, root)
    with folder.lock() as lock:
        _open(folder)
        staged = f"_staging/{uuid.uuid4().hex}"
        seen = Observation()
        writer = df.observe(seen, F.count(F.lit(1)).alias("rows"), checksum(df).alias("checksum")).write.mode("overwrite")
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(f"{folder.root}/{staged}")
        written = df.sparkSession.read.schema(df.schema).parquet(f"{folder.root}/{staged}")
        n, sent = written.count(), seen.get
        if n != sent["rows"] or (planned is not None and n != planned):
            folder.delete(staged)
            raise WriteMismatch(f"{n} rows written, {sent['rows']} sent, {planned} planned")
        if check is not None:
            check(written)
        place, k = f"v={version}", 0
        while folder.exists(place):
            k += 1
            place = f"v={version}.{k}"
        lock.check()
        folder.rename(staged, place)
        folder.write_json(MANIFEST, {"version": version, "folder": place, "rows": n, "checksum": sent["checksum"], "schema": json.loads(df.schema.json())})
    return f"{folder.root}/{place}"


def current(spark: SparkSession, root: str) -> DataFrame:
    """The version that the manifest names."""
    folder = Folder(spark, root)
    m = manifest(folder)
    if m is None:
        raise FileNotFoundError(f"nothing is published in {root}")
    if "buckets" in m:
        return _buckets(folder, m, sorted(m["buckets"]))
    return spark.read.schema(StructType.fromJson(m["schema"])).parquet(f"{folder.root}/{m['folder']}")


def verify_published(spark: SparkSession, root: str) -> None:
    """Reads the published version again and holds rows and checksum against the manifest."""
    m, df = manifest(Folder(spark, root)), current(spark, root)
    got = df.agg(F.count(F.lit(1)).alias("rows"), checksum(df).alias("checksum")).first()
    if (got["rows"], got["checksum"]) != (m["rows"], m["checksum"]):
        raise WriteMismatch(f"{root}: {got['rows']} rows with checksum {got['checksum']}, the manifest says {m['rows']} and {m['checksum']}")


def expire(spark: SparkSession, root: str) -> list[str]:
    """Delete the data folders that the manifest does not name; what went."""
    folder = Folder(spark, root)
    with folder.lock():
        m = manifest(folder)
        if m is None:
            return []
        named = set(m["buckets"].values()) if "buckets" in m else {m["folder"]}
        gone = [x for x in folder.names() if x.startswith(("v=", "d=")) and x not in named]
        for x in gone:
            folder.delete(x)
        folder.delete("_staging")
    return gone


def replace_scope(df: DataFrame, path: str, scope: str) -> None:
    """Overwrite only the partitions of the scopes in ``df``."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(scope).parquet(path)


# ---- tables that change in part ----------------------------------------------------------------------

BUCKET = "_bucket"


def _buckets(folder: Folder, m: dict, wanted: list[str]) -> DataFrame:
    paths = [f"{folder.root}/{m['buckets'][b]}/{BUCKET}={b}" for b in wanted if b in m["buckets"]]
    schema = StructType.fromJson(m["schema"])
    return folder.spark.read.schema(schema).parquet(*paths) if paths else folder.spark.createDataFrame([], schema)


def rewrite_buckets(changes: DataFrame, root: str, version: str, keys: list[str], merge: Callable[[DataFrame, DataFrame], DataFrame], buckets: int = 64) -> int:
    """Merge changes into a table that lies in hash buckets of its keys; only touched buckets are read and written.

    ``merge(old, changes)`` gives the new rows of the touched buckets.  The manifest maps each bucket to the folder
    of the version that last wrote it (as many entries as buckets).  Returns the number of buckets written.
    """
    folder = Folder(changes.sparkSession, root)
    with folder.lock() as lock:
        _open(folder)
        m = manifest(folder) or {"buckets": {}, "n": buckets, "schema": json.loads(changes.schema.json())}
        place = F.pmod(F.xxhash64(*keys), F.lit(m["n"])).cast("string")
        touched = sorted(r.b for r in changes.select(place.alias("b")).distinct().collect())  # at most one a bucket
        if touched:
            merged = merge(_buckets(folder, m, touched), changes).select(*changes.columns)
            new = f"d={version}.{uuid.uuid4().hex}"
            merged.withColumn(BUCKET, place).repartition(min(m["n"], max(len(touched), 1)), BUCKET).write.partitionBy(BUCKET).parquet(f"{folder.root}/{new}")
            # a bucket without rows left has no folder
            have = {s.getPath().getName().partition("=")[2] for s in folder._fs.listStatus(folder.path(new)) if s.isDirectory()}
            m["buckets"] = {b: f for b, f in m["buckets"].items() if b not in touched} | {b: new for b in touched if b in have}
        lock.check()
        folder.write_json(MANIFEST, {"version": version, "n": m["n"], "buckets": m["buckets"], "schema": m["schema"]})
    return len(touched)
