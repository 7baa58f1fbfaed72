"""Published snapshots: a refresh is seen as a whole or not at all.

Tables are written to folders of their own, ``<table>/v=<version>``, which no
reader looks into; a small manifest, ``_snapshots/<number>.json``, is renamed into
place at the end and names the folders that make up the snapshot. Readers take
the greatest manifest when they open the warehouse and keep it, so a refresh
that is running, or has failed between two tables, changes nothing for them.
One refresh of a warehouse runs at a time.

A table in months (the fact) names a folder for each month, so a refresh may
keep months of earlier versions. All file access is Hadoop's, on any store.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

FOLDER = "_snapshots"


@dataclass
class Snapshots:
    spark: SparkSession
    root: str

    def _path(self, *parts: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path("/".join([self.root.rstrip("/"), *parts]))

    def _fs(self):
        return self._path().getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def numbers(self) -> list[int]:
        """The published snapshots, oldest first."""
        fs, folder = self._fs(), self._path(FOLDER)
        if not fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(folder)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def manifest(self, number: int | None = None) -> dict:
        """A snapshot's manifest, by default the latest; empty if there is none."""
        numbers = self.numbers()
        if not numbers:
            return {"number": 0, "tables": {}, "audit": {}}
        name = f"{numbers[-1] if number is None else number:08d}.json"
        stream = self._fs().open(self._path(FOLDER, name))
        try:
            text = self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return json.loads(text)

    def begin(self) -> str:
        """A version that no refresh, published or failed, has used."""
        return f"{self.manifest()['number'] + 1:08d}-{uuid.uuid4().hex[:8]}"

    def publish(self, tables: dict, audit: dict | None = None) -> int:
        """Switch readers to ``tables``: name -> {"path": folder} or {"months": {month: {"path": ...}}}."""
        fs, number = self._fs(), self.manifest()["number"] + 1
        text = json.dumps({"number": number, "tables": tables, "audit": audit or {}}, sort_keys=True)
        draft, final = self._path(FOLDER, f".{uuid.uuid4().hex}"), self._path(FOLDER, f"{number:08d}.json")
        fs.mkdirs(self._path(FOLDER))
        stream = fs.create(draft)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        if fs.exists(final) or not fs.rename(draft, final):
            raise RuntimeError(f"snapshot {number} of {self.root} was published by another refresh")
        return number

    def read(self, entry: dict, fmt: str = "parquet") -> DataFrame:
        """One table of a manifest."""
        reader = self.spark.read.format(fmt)
        if "months" not in entry:
            return reader.load(f"{self.root}/{entry['path']}")
        paths = [f"{self.root}/{m['path']}" for m in entry["months"].values()]
        return reader.schema(entry["schema"]).option("basePath", f"{self.root}/{entry['base']}").load(paths).drop("v")
