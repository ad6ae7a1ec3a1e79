"""File operations on whatever file system a path belongs to, through Hadoop's API."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

STAGING = ".staging-"
COPY_BYTES = 1 << 20


def shared_folder(spark: SparkSession) -> str | None:
    """A new folder under ``spark.checkpoint.dir``, or None where the session names none."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    return f"{root.rstrip('/')}/panelspan-{uuid.uuid4().hex}" if root else None


class Files:
    """Rename, delete and measure; works on local, HDFS and object-store paths."""

    def __init__(self, spark: SparkSession) -> None:
        self._io = spark._jvm.org.apache.commons.io.IOUtils
        self._hadoop_io = spark._jvm.org.apache.hadoop.io.IOUtils
        self._path_class = spark._jvm.org.apache.hadoop.fs.Path
        self._conf = spark._jsc.hadoopConfiguration()

    def _open(self, path: str):
        hadoop_path = self._path_class(str(path))
        return hadoop_path.getFileSystem(self._conf), hadoop_path

    def exists(self, path: str) -> bool:
        fs, at = self._open(path)
        return fs.exists(at)

    def total_bytes(self, path: str) -> int:
        """Bytes of all files of a path, which may be a pattern; 0 if there are none."""
        fs, at = self._open(path)
        found = fs.globStatus(at) or []
        return sum(fs.getContentSummary(status.getPath()).getLength() for status in found)

    def make_folder(self, path: str) -> None:
        fs, at = self._open(path)
        fs.mkdirs(at)

    def qualified(self, path: str) -> str:
        """The full path, with its file system."""
        fs, at = self._open(path)
        return fs.makeQualified(at).toString()

    def rename(self, source: str, target: str) -> None:
        """Move ``source`` to ``target``, which must not exist."""
        fs, at = self._open(source)
        _, to = self._open(target)
        if fs.exists(to) or not fs.rename(at, to):
            raise OSError(f"Could not rename {source} to {target}")

    def delete(self, path: str) -> None:
        fs, at = self._open(path)
        fs.delete(at, True)

    def part_files(self, folder: str) -> list[str]:
        """The data files that a Spark write left in a folder."""
        fs, at = self._open(folder)
        found = [status.getPath() for status in fs.listStatus(at)]
        return sorted(p.toString() for p in found if p.getName().startswith("part-"))

    def join_files(self, parts: list[str], target: str) -> None:
        """Write the bytes of several files, one after the other, to a new one.

        They pass through this program in small blocks.
        """
        fs, at = self._open(target)
        out = fs.create(at, False)
        try:
            for part in parts:
                source, path = self._open(part)
                stream = source.open(path)
                try:
                    self._hadoop_io.copyBytes(stream, out, COPY_BYTES, False)
                finally:
                    stream.close()
        finally:
            out.close()

    def staging_folder(self, target: str) -> str:
        """A new hidden sibling of ``target``, on the same file system."""
        fs, at = self._open(target)
        return f"{fs.makeQualified(at).getParent().toString()}/{STAGING}{uuid.uuid4().hex}"

    def hidden_folders(self, target: str) -> list[str]:
        """The staging folders beside ``target``."""
        fs, at = self._open(target)
        if not fs.exists(at.getParent()):
            return []
        found = [status.getPath() for status in fs.listStatus(at.getParent())]
        return sorted(p.toString() for p in found if p.getName().startswith(STAGING))

    def write(self, path: str, text: str) -> None:
        """Create a small file, which is whole as soon as it can be seen."""
        fs, at = self._open(path)
        _, part = self._open(f"{path}.part")
        stream = fs.create(part, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        if not fs.rename(part, at):
            raise OSError(f"Could not create {path}")

    def read(self, path: str) -> str:
        """The text of a small file."""
        fs, at = self._open(path)
        stream = fs.open(at)
        try:
            return self._io.toString(stream, "UTF-8")
        finally:
            stream.close()

    def name(self, path: str) -> str:
        _, at = self._open(path)
        return at.getName()
