"""Small-file access through the Hadoop file system the session is set up for."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Files:
    def __init__(self, spark: SparkSession) -> None:
        self._jvm = spark._jvm
        self._gateway = spark.sparkContext._gateway
        self._conf = spark._jsc.hadoopConfiguration()

    def _at(self, path: str):
        target = self._jvm.org.apache.hadoop.fs.Path(path)
        return target.getFileSystem(self._conf), target

    def exists(self, path: str) -> bool:
        fs, target = self._at(path)
        return fs.exists(target)

    def names(self, folder: str) -> list[str]:
        fs, target = self._at(folder)
        if not fs.exists(target):
            return []
        return sorted(status.getPath().getName() for status in fs.listStatus(target))

    def size(self, path: str) -> int:
        """Bytes of the files at and below ``path``."""
        fs, target = self._at(path)
        return fs.getContentSummary(target).getLength()

    def read_text(self, path: str) -> str:
        fs, target = self._at(path)
        stream = fs.open(target)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def replace_text(self, path: str, text: str) -> None:
        """Write beside ``path`` and rename over it: readers see the old or the new text.
        The rename is atomic where the file system's is; on an object store it is a copy."""
        fs, target = self._at(path)
        hadoop = self._jvm.org.apache.hadoop.fs
        draft = hadoop.Path(
            target.getParent(), f".{target.getName()}.{self._jvm.java.util.UUID.randomUUID()}"
        )
        stream = fs.create(draft, False)
        try:
            stream.write(text.encode("utf-8"))
        finally:
            stream.close()
        kind = getattr(self._jvm, "org.apache.hadoop.fs.Options$Rename")
        options = self._gateway.new_array(kind, 1)
        options[0] = kind.OVERWRITE
        context = hadoop.FileContext.getFileContext(fs.getUri(), self._conf)
        context.rename(fs.makeQualified(draft), fs.makeQualified(target), options)

    def stamp(self, paths: list[str]) -> str:
        """Names, lengths and times of the files at ``paths`` or in the folders there."""
        seen = []
        for path in paths:
            fs, target = self._at(path)
            for status in fs.listStatus(target) if fs.exists(target) else []:
                seen.append(f"{status.getPath()}:{status.getLen()}:{status.getModificationTime()}")
        return "\n".join(seen)

    def make_temporary(self, folder: str) -> None:
        """Make a folder that is deleted, with all it holds, when the JVM ends."""
        fs, target = self._at(folder)
        if not fs.exists(target):
            fs.mkdirs(target)
            fs.deleteOnExit(target)

    def delete(self, path: str) -> bool:
        fs, target = self._at(path)
        return fs.delete(target, True)
