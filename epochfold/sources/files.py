"""Directory operations on the file system a replica lives on, through Hadoop."""

from __future__ import annotations

import re

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

# On these a directory rename is one metadata operation. Elsewhere it may be a copy.
RENAMING_SCHEMES = frozenset({"file", "hdfs", "viewfs", "webhdfs"})


class Files:
    """``renames`` says whether a rename is cheap; if not, none is made."""

    def __init__(self, spark: SparkSession, root: str):
        self._gateway = spark.sparkContext._gateway
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._path(root).getFileSystem(self._conf)
        self.renames = self.scheme() in RENAMING_SCHEMES

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def scheme(self) -> str:
        return self._fs.getUri().getScheme()

    def qualified(self, path: str) -> str:
        """The path with its file system, however it was given."""
        return self._fs.makeQualified(self._path(path)).toString()

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def names(self, path: str) -> list[str]:
        """Names of the entries of a directory; none if it does not exist."""
        if not self.exists(path):
            return []
        try:
            return [s.getPath().getName() for s in self._fs.listStatus(self._path(path))]
        except Py4JJavaError:
            if self.exists(path):
                raise
            return []

    def glob(self, base: str, pattern: str) -> list[str]:
        """Paths below ``base`` that match a pattern, by as many levels as it has."""
        plain = re.sub(r"([\\*?\[\]{}^])", r"\\\1", base)
        found = self._fs.globStatus(self._path(f"{plain}/{pattern}"))
        paths = self._jvm.org.apache.hadoop.fs.FileUtil.stat2Paths(found)
        levels = pattern.count("/") + 1
        return ["/".join(path.toString().split("/")[-levels:]) for path in paths or ()]

    def usage(self, path: str) -> tuple[int, int]:
        """Bytes and number of files below a directory."""
        summary = self._fs.getContentSummary(self._path(path))
        return summary.getLength(), summary.getFileCount()

    def delete(self, path: str) -> None:
        """Delete a file or directory, if it exists."""
        if not self._fs.delete(self._path(path), True) and self.exists(path):
            raise OSError(f"could not delete {path}")

    def delete_if_empty(self, path: str) -> None:
        """Delete a directory that holds nothing; leave any other as it is."""
        try:
            self._fs.delete(self._path(path), False)
        except Py4JJavaError:
            if self.exists(path) and not self.names(path):
                raise

    def make(self, path: str) -> None:
        self._fs.mkdirs(self._path(path))

    def move(self, source: str, target: str) -> None:
        """Rename a file or directory. The target's parent is there, the target is not."""
        try:
            done = self._fs.rename(self._path(source), self._path(target))
        except Py4JJavaError as error:
            raise OSError(f"could not move {source} to {target}") from error
        if not done:
            raise OSError(f"could not move {source} to {target}")

    def create(self, path: str, text: str) -> bool:
        """Write a small file unless there is one; tell whether it was written."""
        try:
            out = self._fs.create(self._path(path), False)
        except Py4JJavaError:
            if self.exists(path):
                return False
            raise
        try:
            out.write(bytearray(text, "utf-8"))
        finally:
            out.close()
        return True

    def write_text(self, path: str, text: str) -> None:
        """Write a small file that is either there in full or not at all, old or new.

        A draft replaces it in one step where a rename is cheap. Elsewhere, as in object stores, a
        file that is written appears when it is closed.
        """
        out = self._fs.create(self._path(path + ".draft" if self.renames else path), True)
        try:
            out.write(bytearray(text, "utf-8"))
        finally:
            out.close()
        if self.renames:
            self._replace(path + ".draft", path)

    def _replace(self, source: str, target: str) -> None:
        kind = getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename")
        options = self._gateway.new_array(kind, 1)
        options[0] = kind.OVERWRITE
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self._conf)
        context.rename(self._path(source), self._path(target), options)

    def read_text(self, path: str) -> str:
        try:
            stream = self._fs.open(self._path(path))
        except Py4JJavaError as error:
            if self.exists(path):
                raise
            raise FileNotFoundError(path) from error
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
