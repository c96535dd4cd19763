"""Tables that can be replaced, with other columns too, without ever being half replaced.

A table is a folder. Every write puts its rows into a new folder inside and then, last of all, a small manifest that names
the version, its schema and the folders that hold its rows. Readers start from the newest manifest, so a write that
fails leaves what was there before, and a reader keeps the version it started with. A version number can be taken
once only: of two writers that began from the same version, one is refused.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Version:
    number: int
    schema: T.StructType
    folders: tuple[str, ...]


class VersionedTable:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._system = self._path(self.folder).getFileSystem(spark._jsc.hadoopConfiguration())

    def _manifest(self, number: int) -> str:
        return f"{self.folder}/manifest-{number:010d}.json"

    def versions(self) -> list[int]:
        """The version numbers that can be read, in order."""
        if not self._system.exists(self._path(self.folder)):
            return []
        names = [status.getPath().getName() for status in self._system.listStatus(self._path(self.folder))]
        return sorted(int(n[len("manifest-"): -len(".json")]) for n in names if n.startswith("manifest-") and n.endswith(".json"))

    def version(self, number: int | None = None) -> Version:
        """A version's manifest; the newest when no number is given."""
        known = self.versions()
        if not known or (number is not None and number not in known):
            raise ValueError(f"{self.folder} has no version {number or 'yet'}; there are {known}")
        number = known[-1] if number is None else number
        text = self.spark.read.text(self._manifest(number), wholetext=True).first()["value"]
        described = json.loads(text)
        return Version(number, T.StructType.fromJson(described["schema"]), tuple(described["folders"]))

    def read(self, number: int | None = None) -> DataFrame:
        """The rows of a version; a column that came later is NULL in rows written before it."""
        version = self.version(number)
        if not version.folders:
            return self.spark.createDataFrame([], version.schema)
        return self.spark.read.schema(version.schema).parquet(*[f"{self.folder}/{name}" for name in version.folders])

    def _commit(self, number: int, schema: T.StructType, folders: list[str]) -> int:
        """Write the manifest under another name and move it into place; a number that is taken is refused."""
        text = json.dumps({"version": number, "schema": schema.jsonValue(), "folders": folders})
        draft = self._path(f"{self.folder}/draft-{uuid.uuid4().hex}")
        out = self._system.create(draft, False)
        out.write(bytearray(text.encode()))
        out.close()
        target = self._path(self._manifest(number))
        if self._system.exists(target) or not self._system.rename(draft, target):
            self._system.delete(draft, False)
            raise RuntimeError(f"version {number} of {self.folder} was written by somebody else meanwhile")
        return number

    def write(self, df: DataFrame, *, mode: str = "overwrite", overwrite_schema: bool = False) -> int:
        """Make ``df`` the next version, or add its rows to the newest; the version's number.

        Other columns or types than the newest version's are refused unless ``overwrite_schema`` (when replacing), or unless
        they only add columns (when appending).
        """
        if mode not in ("overwrite", "append"):
            raise ValueError(f"mode must be 'overwrite' or 'append', got {mode!r}")
        known = self.versions()
        newest = self.version(known[-1]) if known else None
        schema = T.StructType([T.StructField(f.name, f.dataType) for f in df.schema.fields])
        if newest and mode == "overwrite" and not overwrite_schema and _types(schema) != _types(newest.schema):
            raise ValueError(f"the columns of {self.folder} are {_types(newest.schema)}, not {_types(schema)}; overwrite_schema replaces them")
        if newest and mode == "append":
            changed = {n: k for n, k in _types(schema).items() if _types(newest.schema).get(n, k) != k}
            if changed:
                raise ValueError(f"columns {sorted(changed)} have other types in {self.folder}")
            schema = T.StructType([*newest.schema.fields, *[f for f in schema.fields if f.name not in newest.schema.names]])
        name = f"rows-{uuid.uuid4().hex}"
        df.write.parquet(f"{self.folder}/{name}")
        kept = list(newest.folders) if newest and mode == "append" else []
        return self._commit((newest.number if newest else 0) + 1, schema, [*kept, name])

    def drop_older(self, keep: int = 1) -> None:
        """Delete all versions but the newest ``keep``, and rows that no remaining version names."""
        known = self.versions()
        for number in known[:-keep]:
            self._system.delete(self._path(self._manifest(number)), False)
        used = {name for number in known[-keep:] for name in self.version(number).folders}
        for status in self._system.listStatus(self._path(self.folder)):
            name = status.getPath().getName()
            if name.startswith(("rows-", "draft-")) and name not in used:
                self._system.delete(status.getPath(), True)


def _types(schema: T.StructType) -> dict[str, str]:
    return {f.name: f.dataType.simpleString() for f in schema.fields}


def history(table: VersionedTable) -> DataFrame:
    """version, column, type: the columns of every version that can be read."""
    rows = [(v, f.name, f.dataType.simpleString()) for v in table.versions() for f in table.version(v).schema.fields]
    return table.spark.createDataFrame(rows, "version int, column string, type string").orderBy("version", F.col("column"))
