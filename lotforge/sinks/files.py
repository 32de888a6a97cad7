"""Small text files beside the tables, through the file system that Spark itself uses."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _is(error: Py4JJavaError, name: str) -> bool:
    return error.java_exception.getClass().getSimpleName() == name


class TextFiles:
    """Files are written once, whole: a reader sees none or all of one."""

    def __init__(self, spark: SparkSession) -> None:
        context = spark.sparkContext
        self._jvm, self._gateway = context._jvm, context._gateway
        self._conf = context._jsc.hadoopConfiguration()

    def _at(self, path: str):
        place = self._jvm.org.apache.hadoop.fs.Path(path)
        system = place.getFileSystem(self._conf)
        return system, system.makeQualified(place)

    def read(self, path: str) -> str | None:
        """The text of a file; None if there is no such file."""
        system, place = self._at(path)
        try:
            stream = system.open(place)
        except Py4JJavaError as error:
            if _is(error, "FileNotFoundException"):
                return None
            raise
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def names(self, folder: str) -> list[str]:
        """Names in a folder, sorted; none if there is no such folder."""
        system, place = self._at(folder)
        try:
            return sorted(entry.getPath().getName() for entry in system.listStatus(place))
        except Py4JJavaError as error:
            if _is(error, "FileNotFoundException"):
                return []
            raise

    def remove(self, folder: str) -> None:
        """Delete a folder with all it holds; none is fine."""
        system, place = self._at(folder)
        system.delete(place, True)

    def create(self, path: str, text: str) -> bool:
        """Write a file unless it exists; of several writers at once exactly one gets True.

        The text goes to a file of its own, which a rename that never overwrites then publishes.
        """
        return self._moved(path, text, overwrite=False)

    def replace(self, path: str, text: str) -> None:
        self._moved(path, text, overwrite=True)

    def _moved(self, path: str, text: str, overwrite: bool) -> bool:
        system, target = self._at(path)
        system.mkdirs(target.getParent())
        hidden = f"_{target.getName()}.{uuid.uuid4().hex}"
        draft = self._jvm.org.apache.hadoop.fs.Path(target.getParent(), hidden)
        stream = system.create(draft, True)
        try:
            stream.write(text.encode())
        finally:
            stream.close()
        rename = self._jvm.org.apache.hadoop.fs.Options.Rename
        how = self._gateway.new_array(rename, 1)
        how[0] = rename.OVERWRITE if overwrite else rename.NONE
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), self._conf)
        try:
            context.rename(draft, target, how)
        except Py4JJavaError as error:
            system.delete(draft, False)
            if _is(error, "FileAlreadyExistsException"):
                return False
            raise
        return True
