"""Intermediate tables on shared storage, small files in a folder of any store that Spark writes to, and a lease among drivers."""

from __future__ import annotations

import json
import tempfile
import threading
import time
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Stores whose rename fails where the target exists, in one step. A local disk is linked to instead; every other store gets the
#: file by a create that fails where there is one, and shows it when it is closed.
RENAMES = {"hdfs", "webhdfs", "swebhdfs", "viewfs", "ofs"}


def workspace(spark: SparkSession, name: str) -> str:
    """A new folder on shared storage, under spark.checkpoint.dir; a temporary one where that is unset and all is on this machine."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="mosaique-")
    return f"{root.rstrip('/')}/mosaique/{name}-{uuid.uuid4().hex}"


def kept(df: DataFrame, name: str = "kept") -> DataFrame:
    """df as a table on shared storage: it is computed once, and what reads it survives lost executors."""
    path = workspace(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class FileSystem:
    """Whole small files by name in one folder, through the Hadoop file system."""

    def __init__(self, spark: SparkSession, folder: str):
        self._jvm, self._gateway, self.folder = spark._jvm, spark.sparkContext._gateway, folder.rstrip("/")
        self._path, self._conf = spark._jvm.org.apache.hadoop.fs.Path, spark._jsc.hadoopConfiguration()
        self._fs = self._path(self.folder).getFileSystem(self._conf)
        self._fs.mkdirs(self._path(self.folder))
        self.scheme = self._fs.getUri().getScheme()

    def at(self, name: str):
        return self._path(f"{self.folder}/{name}")

    def names(self) -> list[str]:
        return sorted(x.getPath().getName() for x in self._fs.listStatus(self._path(self.folder)) if not x.getPath().getName().startswith("."))

    def read(self, name: str) -> bytes:
        stream = self._fs.open(self.at(name))
        try:
            return bytes(stream.readAllBytes())
        finally:
            stream.close()

    def _write(self, builder, content: bytes) -> None:
        stream = builder.build()
        stream.write(content)
        stream.close()

    def create(self, name: str, content: bytes) -> bool:
        """Writes a file that is not there yet, whole and in one step: of several drivers that try, one succeeds. False: it is there."""
        try:
            if self.scheme != "file" and self.scheme not in RENAMES:
                # opt: a store that knows no such condition checks when the file is opened.
                self._write(self._fs.createFile(self.at(name)).overwrite(False).opt("fs.option.create.conditional.overwrite", True), content)
                return True
            aside = self.at(f".new-{uuid.uuid4().hex}")
            self._write(self._fs.createFile(aside).overwrite(False), content)
            try:
                if self.scheme == "file":
                    local = [self._jvm.java.io.File(self._fs.makeQualified(p).toUri().getPath()).toPath() for p in (self.at(name), aside)]
                    self._jvm.java.nio.file.Files.createLink(*local)
                else:
                    rename = self._jvm.org.apache.hadoop.fs.Options.Rename
                    how = self._gateway.new_array(rename, 1)
                    how[0] = rename.NONE
                    self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self._conf).rename(aside, self.at(name), how)
            finally:
                self._fs.delete(aside, False)
            return True
        except Exception as e:
            if "Exist" in f"{type(getattr(e, 'java_exception', e))} {e}" and self._fs.exists(self.at(name)):
                return False
            raise

    def put(self, name: str, content: bytes) -> None:
        """Writes a file, over one that may be there."""
        self._write(self._fs.createFile(self.at(name)).overwrite(True), content)

    def delete(self, name: str) -> None:
        self._fs.delete(self.at(name), True)


class LeaseHeld(RuntimeError):
    """Another driver holds the lease."""


class Lease:
    """Held by one driver at a time: `with Lease(spark, folder) as number:`; whoever comes second gets LeaseHeld at once.

    Each holder has a file with a number of its own, one above the last. It says until when the lease holds and is renewed while
    the holder lives; a driver that died frees the lease when that time is over. The number fences: what the holder writes names
    it, so that a driver that wakes late, after another has taken over, is refused there. Clocks of drivers only decide when a
    lease is over, not who may write."""

    NAME = "lease-"
    #: Seconds a lease holds; it is renewed three times as often.
    SECONDS = 120.0

    def __init__(self, spark: SparkSession, folder: str, seconds: float = SECONDS, patience: float = 0):
        """patience: seconds for which a lease that another driver holds is waited for."""
        self._files, self.seconds, self.patience, self.number = FileSystem(spark, folder), seconds, patience, None
        self._name, self._over, self._thread = uuid.uuid4().hex, threading.Event(), None

    def _file(self, number: int) -> str:
        return f"{self.NAME}{number:012d}"

    def _content(self, until: float) -> bytes:
        return json.dumps({"holder": self._name, "until": until}).encode()

    def newest(self) -> int:
        return max((int(x.removeprefix(self.NAME)) for x in self._files.names() if x.startswith(self.NAME)), default=0)

    def acquire(self) -> int:
        last = self.newest()
        if last and json.loads(self._files.read(self._file(last)) or b'{"until": 0}')["until"] > time.time():
            raise LeaseHeld("another run holds the lease")
        if not self._files.create(self._file(last + 1), self._content(time.time() + self.seconds)):
            raise LeaseHeld("another run has just taken the lease")
        self.number = last + 1
        if last > 1:  # the one in front stays, so that a number is never given twice
            self._files.delete(self._file(last - 1))
        return self.number

    def renew(self) -> None:
        """Holds on; LeaseHeld where another driver has taken over meanwhile."""
        if self.newest() != self.number:
            raise LeaseHeld("the lease was over and is another run's")
        self._files.put(self._file(self.number), self._content(time.time() + self.seconds))

    def release(self) -> None:
        if self.newest() == self.number:
            self._files.put(self._file(self.number), self._content(0))

    def _keep(self) -> None:
        while not self._over.wait(self.seconds / 3):
            try:
                self.renew()
            except LeaseHeld:
                return

    def __enter__(self) -> int:
        give_up = time.time() + self.patience
        while True:
            try:
                number = self.acquire()
                break
            except LeaseHeld:
                if time.time() >= give_up:
                    raise
                time.sleep(min(0.2, self.patience))
        self._over.clear()
        self._thread = threading.Thread(target=self._keep, daemon=True)
        self._thread.start()
        return number

    def __exit__(self, *_) -> None:
        self._over.set()
        self._thread.join()
        self.release()
