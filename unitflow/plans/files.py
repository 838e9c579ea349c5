"""Small files in whatever file system Hadoop knows: read, replaced at once, moved, locked. Driver-side; tables go through Spark."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Files:
    """The file system of ``root``; names are relative to it."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, str(root).rstrip("/")
        self.jvm = spark._jvm
        self.conf = spark._jsc.hadoopConfiguration()
        self.fs = self.path("").getFileSystem(self.conf)

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def at(self, name: str) -> str:
        return f"{self.root}/{name}"

    def exists(self, name: str) -> bool:
        return self.fs.exists(self.path(name))

    def make(self, name: str) -> None:
        self.fs.mkdirs(self.path(name))

    def delete(self, name: str) -> None:
        self.fs.delete(self.path(name), True)

    def names(self, name: str = "") -> list[str]:
        return sorted(x.getPath().getName() for x in self.fs.listStatus(self.path(name))) if self.exists(name) else []

    def read(self, name: str) -> str | None:
        """None where there is no such file."""
        if not self.exists(name):
            return None
        stream = self.fs.open(self.path(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        """Readers see the old text or the new, whole."""
        part = f"{name}.part"
        out = self.fs.create(self.path(part), True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        self.move(part, name)

    def move(self, a: str, b: str) -> None:
        """To the name ``b``; a file or an empty folder of that name is replaced at once."""
        rename = getattr(self.jvm, "org.apache.hadoop.fs.Options$Rename")
        how = self.spark.sparkContext._gateway.new_array(rename, 1)
        how[0] = rename.OVERWRITE
        uri = self.path("").makeQualified(self.fs.getUri(), self.fs.getWorkingDirectory()).toUri()
        self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(uri, self.conf).rename(self.path(a), self.path(b), how)

    def claim(self, name: str) -> bool:
        """Make a file that must not be there yet; of several callers one gets it."""
        try:
            self.fs.create(self.path(name), False).close()
            return True
        except Exception:
            if self.exists(name):
                return False
            raise
