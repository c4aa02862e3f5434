"""The few folder operations that table changes and copies need."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

#: What the folder of a table's snapshot begins with.
SNAPSHOT = "/_snapshot-"


class Files:
    """Folder operations on whatever file system a folder is on."""

    def __init__(self, spark: SparkSession, root: str):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._conf = spark._jsc.hadoopConfiguration()
        self._root = self._path(root).getFileSystem(self._conf)

    def _fs(self, name: str):
        path = self._path(name)
        if path.toUri().getScheme() is None:
            path = self._root.makeQualified(path)
        return path, path.getFileSystem(self._conf)

    def create(self, name: str, text: str) -> bool:
        """Create a small file; False if it is there already."""
        path, fs = self._fs(name)
        try:
            stream = fs.create(path, False)
        except Py4JJavaError:
            if fs.exists(path):
                return False
            raise
        stream.write(bytearray(text.encode()))
        stream.close()
        return True

    def write(self, name: str, text: str) -> None:
        """Put a small file in its place as a whole."""
        path, fs = self._fs(name)
        part, _ = self._fs(f"{name}-{uuid.uuid4().hex}")
        stream = fs.create(part, False)
        stream.write(bytearray(text.encode()))
        stream.close()
        if not fs.rename(part, path):
            raise OSError(f"cannot write {name}")

    def read(self, name: str) -> str | None:
        """A small file's text, or None if there is none."""
        path, fs = self._fs(name)
        if not fs.exists(path):
            return None
        stream = fs.open(path)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def exists(self, name: str) -> bool:
        path, fs = self._fs(name)
        return fs.exists(path)

    def data_files(self, folder: str) -> list[str]:
        """Files right in ``folder`` that Spark would read."""
        path, fs = self._fs(folder)
        return [
            status.getPath().toUri().getPath()
            for status in fs.listStatus(path)
            if status.isFile() and status.getPath().getName()[0] not in "_."
        ]

    def delete(self, name: str) -> None:
        path, fs = self._fs(name)
        fs.delete(path, True)

    def plain(self, name: str) -> str:
        """The path part of a folder name, without scheme and host."""
        path, fs = self._fs(name)
        return fs.makeQualified(path).toUri().getPath()

    def snapshots(self, root: str) -> list[str]:
        path, fs = self._fs(root)
        return [
            status.getPath().toUri().getPath()
            for status in fs.listStatus(path)
            if status.isDirectory() and status.getPath().getName().startswith(SNAPSHOT[1:])
        ]

    def leaves(self, folder: str) -> list[str]:
        """Folders below ``folder`` that hold files."""
        path, fs = self._fs(folder)
        found, listing = set(), fs.listFiles(path, True)
        while listing.hasNext():
            parent = listing.next().getPath().getParent().toUri().getPath()
            if parent != folder:
                found.add(parent)
        return sorted(found)
