"""Folders on whatever file system the cluster uses, and scratch tables.

File operations go through Hadoop's FileSystem, so a path may be HDFS, an object
store or a local disk.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession


class Folder:
    """A folder reached through Hadoop's FileSystem API."""

    def __init__(self, spark: SparkSession, path: str):
        self._spark = spark
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.path = path.rstrip("/")
        self._fs = self._at().getFileSystem(self._conf)

    def _at(self, *names: str):
        return self._jvm.org.apache.hadoop.fs.Path("/".join([self.path, *names]))

    def within(self, *names: str) -> str:
        return "/".join([self.path, *names])

    def folder(self, *names: str) -> Folder:
        return Folder(self._spark, self.within(*names))

    def exists(self, *names: str) -> bool:
        return self._fs.exists(self._at(*names))

    def names(self) -> list[str]:
        """Names right under the folder; none when it does not exist."""
        if not self.exists():
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._at()))

    def read(self, name: str) -> str:
        stream = self._fs.open(self._at(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def publish(self, name: str, text: str) -> bool:
        """Create a file whole or not at all; False when it is already there."""
        draft = self._at(f".{name}.{uuid.uuid4().hex}")
        stream = self._fs.create(draft, False)
        try:
            stream.write(bytearray(text, "utf-8"))
        finally:
            stream.close()
        files = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri(), self._conf)
        no_overwrite = self._spark.sparkContext._gateway.new_array(
            self._jvm.org.apache.hadoop.fs.Options.Rename, 0
        )
        try:
            files.rename(self._fs.makeQualified(draft), self._fs.makeQualified(self._at(name)), no_overwrite)
            return True
        except Exception as error:  # py4j wraps the Java exception
            self._fs.delete(draft, False)
            if "FileAlreadyExistsException" in str(error):
                return False
            raise

    def remove(self, *names: str) -> None:
        self._fs.delete(self._at(*names), True)


@lru_cache(maxsize=1)
def _own_folder() -> str:
    path = tempfile.mkdtemp(prefix="stowage-")
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    return path


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors can reach, named by ``spark.checkpoint.dir``.

    Only a local session, where driver and executors are one process, may do
    without the setting; it has a folder that lasts as long as the process.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return _own_folder()


class Scratch:
    """Tables written during one operation, in a folder of their own under ``root``, by default the shared folder."""

    def __init__(self, spark: SparkSession, root: str | None = None):
        self._spark = spark
        self._folder = Folder(spark, f"{root or shared_folder(spark)}/stowage-{uuid.uuid4().hex}")
        self._tables = 0

    def table(self, df: DataFrame, name: str) -> DataFrame:
        """``df`` written as Parquet and read back: evaluated once, lineage cut."""
        self._tables += 1
        path = self._folder.within(f"{self._tables:03d}-{name}")
        df.write.parquet(path)
        return self._spark.read.schema(df.schema).parquet(path)

    def remove(self) -> None:
        self._folder.remove()
