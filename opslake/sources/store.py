"""A table as versioned folders and one small pointer file.

A new version is written beside the old ones, and then the pointer is replaced by a rename, which is atomic: readers see the old version or the new one.
The pointer holds the number of the batch that made the version, so a batch that is repeated after a failure changes nothing.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession


class TableStore:
    """One writer at a time, any number of readers. Old versions stay for readers that have begun; vacuum() takes them away."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._jvm, self._conf = spark._jvm, spark._jsc.hadoopConfiguration()
        self._fs = self._at("_current").getFileSystem(self._conf)

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")

    def state(self) -> dict | None:
        """{'version': folder, 'batch': number} of the current version; None before the first one."""
        if not self._fs.exists(self._at("_current")):
            return None
        source = self._fs.open(self._at("_current"))
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8"))
        finally:
            source.close()

    def read(self) -> DataFrame | None:
        """The current version as it is now, also after later ones."""
        now = self.state()
        return self.spark.read.parquet(f"{self.path}/{now['version']}") if now else None

    def swap(self, df: DataFrame, batch: int) -> bool:
        """Makes the rows the current version, unless this batch or a later one has done so. A failure before the rename leaves all as it was."""
        now = self.state()
        if now and now["batch"] >= batch:
            return False
        version = f"v{batch}-{uuid.uuid4().hex}"
        df.write.parquet(f"{self.path}/{version}")
        draft = self._at(f"_draft-{uuid.uuid4().hex}")
        out = self._fs.create(draft, True)
        try:
            out.write(bytearray(json.dumps({"version": version, "batch": batch}).encode()))
        finally:
            out.close()
        rename = getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename")
        options = self.spark.sparkContext._gateway.new_array(rename, 1)
        options[0] = rename.OVERWRITE
        self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self._conf).rename(draft, self._at("_current"), options)
        return True

    def vacuum(self) -> int:
        """Deletes the versions that aren't current, and drafts that failed; how many. Only where no reader still uses them."""
        now, gone = self.state(), 0
        for status in self._fs.listStatus(self._fs.makeQualified(self._jvm.org.apache.hadoop.fs.Path(self.path))):
            name = status.getPath().getName()
            if now and name not in ("_current", now["version"]) and name.startswith(("v", "_draft-")):
                gone += self._fs.delete(status.getPath(), True)
        return gone
