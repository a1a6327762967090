"""A commit log of finished versions, kept as small files without any Spark job.

Version ``n`` of a table is the file ``<table>/_versions/<n>.json``. A file is written in full
under another name first and then given its own, which fails if that name is taken: of several
writers one gets a number, the others list again and take the next. The newest number is the
current version.

Naming is a hard link on a local disk and a rename elsewhere. The file system must not replace an
existing file by a rename (HDFS and the stores that follow its contract do not).
"""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

_FOLDER = "_versions"


def hadoop_path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def file_system(spark: SparkSession, path: str):
    return hadoop_path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def java_error(e: Py4JJavaError) -> str:
    """The class name of a Java exception, without its package."""
    return e.java_exception.getClass().getSimpleName()


class VersionLog:
    def __init__(self, spark: SparkSession, table: str):
        self.spark = spark
        self.folder = f"{table.rstrip('/')}/{_FOLDER}"
        self.fs = file_system(spark, self.folder)

    def _file(self, name: str):
        return hadoop_path(self.spark, f"{self.folder}/{name}")

    def _version(self, number: int):
        return self._file(f"{number:012d}.json")

    def numbers(self) -> list[tuple[int, int]]:
        """(number, time of entry in ms) of every finished version, ascending."""
        try:
            found = self.fs.listStatus(hadoop_path(self.spark, self.folder))
        except Py4JJavaError as e:
            if java_error(e) == "FileNotFoundException":
                return []
            raise
        named = [(s.getPath().getName(), s.getModificationTime()) for s in found]
        return sorted((int(n[:-5]), t) for n, t in named if n.endswith(".json")
                      and n[:-5].isdigit())

    def read(self, number: int) -> dict:
        stream = self.fs.open(self._version(number))
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return {"number": number, **json.loads(text)}

    def latest(self) -> dict | None:
        """The current version, by one listing and one small file."""
        while found := self.numbers():
            try:
                return self.read(found[-1][0])
            except Py4JJavaError as e:      # a newer one came and this one expired meanwhile
                if java_error(e) != "FileNotFoundException":
                    raise
        return None

    def enter(self, entry: dict) -> int:
        """Enter a finished version under the next free number."""
        self.fs.mkdirs(hadoop_path(self.spark, self.folder))
        draft = self._file(f".{uuid.uuid4().hex}.draft")
        out = self.fs.create(draft, False)
        try:
            out.write(json.dumps(entry).encode())
        finally:
            out.close()
        try:
            while True:
                found = self.numbers()
                number = found[-1][0] + 1 if found else 1
                if self._name(draft, self._version(number)):
                    return number
        finally:
            self.fs.delete(draft, False)

    def _name(self, draft, final) -> bool:
        """Give a complete file its name; False if the name is taken."""
        try:
            if self.fs.getScheme() == "file":
                paths = self.spark._jvm.java.nio.file.Paths
                link = paths.get(final.toUri().getPath(), self._no_more())
                self.spark._jvm.java.nio.file.Files.createLink(
                    link, paths.get(draft.toUri().getPath(), self._no_more()))
                return True
            return bool(self.fs.rename(draft, final))
        except Py4JJavaError as e:
            if java_error(e) == "FileAlreadyExistsException":
                return False
            raise

    def _no_more(self):
        return self.spark.sparkContext._gateway.new_array(self.spark._jvm.java.lang.String, 0)

    def remove(self, number: int) -> None:
        self.fs.delete(self._version(number), False)
