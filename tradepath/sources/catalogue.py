"""A catalogue of tables that are written once per load and read by everything after it.

An entry says under which load a table was written, where, and with which schema. A table is
written under a path of its own first and entered afterwards, so a load that dies leaves no entry and
the next one writes the table anew; readers never see half a table. If two loads write the same
table at once, the earlier entry counts for all.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Iterable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tradepath.sources.workspace import _filesystem, remove

ENTRY = "load string, name string, path string, schema string, entered_at timestamp"


def file_state(spark: SparkSession, folder: str) -> str:
    """A checksum of the names, sizes and times of the files below a folder: the load that they
    are. Only file names go through the driver, as in any read of them."""
    filesystem, place = _filesystem(spark, folder)
    found = filesystem.listFiles(place, True)
    files = []
    while found.hasNext():
        f = found.next()
        files.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return hashlib.sha256(repr(sorted(files)).encode()).hexdigest()[:32]


class LoadCatalogue:
    """Tables below a folder, each once per load. An entry is a small JSON file, which is moved into
    place when it is complete."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self._known: dict[tuple[str, str], DataFrame] = {}

    def _log(self, load: str, name: str) -> str:
        key = hashlib.sha256(f"{load}\0{name}".encode()).hexdigest()[:32]
        return f"{self.folder}/_entries/entry={key}"

    def entries(self) -> DataFrame:
        """All entries, the earliest of each load and table."""
        filesystem, place = _filesystem(self.spark, f"{self.folder}/_entries")
        if not filesystem.exists(place):
            return self.spark.createDataFrame([], ENTRY)
        rows = self.spark.read.schema(ENTRY).json(f"{self.folder}/_entries")
        return rows.groupBy("load", "name").agg(
            F.min(F.struct("entered_at", "path", "schema")).alias("e")).select(
            "load", "name", "e.path", "e.schema", "e.entered_at")

    def _entered(self, load: str, name: str) -> DataFrame | None:
        filesystem, place = _filesystem(self.spark, self._log(load, name))
        if not filesystem.exists(place):
            return None
        files = sorted(
            (f.getPath().getName(), f.getPath()) for f in filesystem.listStatus(place)
            if f.getPath().getName().endswith(".json"))
        if not files:
            return None
        stream = filesystem.open(files[0][1])
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        entry = json.loads(text)
        schema = StructType.fromJson(json.loads(entry["schema"]))
        return self.spark.read.schema(schema).parquet(entry["path"])

    def _enter(self, load: str, name: str, path: str, schema: StructType) -> None:
        now = datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%S.%fZ")
        entry = json.dumps({"load": load, "name": name, "path": path, "schema": schema.json(),
                            "entered_at": now})
        label = f"{now.replace(':', '')}-{uuid.uuid4().hex}"
        filesystem, draft = _filesystem(self.spark, f"{self._log(load, name)}/_{label}")
        stream = filesystem.create(draft, False)
        stream.write(bytearray(entry.encode()))
        stream.close()
        if not filesystem.rename(draft, _filesystem(
                self.spark, f"{self._log(load, name)}/{label}.json")[1]):
            raise OSError(f"cannot enter {name} of load {load}")

    def table(self, load: str, name: str, derive: Callable[[], DataFrame]) -> DataFrame:
        """The table of a load: read if the load has it, else derived, written and entered."""
        key = (load, name)
        if key not in self._known:
            found = self._entered(load, name)
            if found is None:
                rows = derive()
                path = f"{self.folder}/{name}/{uuid.uuid4().hex}"
                rows.write.parquet(path)
                self._enter(load, name, path, rows.schema)
                found = self._entered(load, name)
            self._known[key] = found
        return self._known[key]

    def prune(self, keep: Iterable[str]) -> list[str]:
        """Remove the tables of all other loads; their entries go with them. Returns the removed
        paths. Only for loads that nothing reads any more."""
        keep = list(keep)
        rows = self.spark.read.schema(ENTRY).json(f"{self.folder}/_entries").withColumn(
            "_file", F.col("_metadata.file_path"))
        old = rows.where(~F.col("load").isin(keep)).select("path", "_file").collect()
        for row in old:
            remove(self.spark, row["_file"])  # first the entry, so that nobody is sent to the table
            remove(self.spark, row["path"])
        self._known = {k: v for k, v in self._known.items() if k[0] in keep}
        return sorted({row["path"] for row in old})
