"""Where intermediate tables go when a plan has to be cut, and when they go away."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, which the driver and every executor share.

    Only a local session may leave it unset; it then gets a folder in its warehouse. A session on a cluster is refused
    without it unless the warehouse itself is in a shared store, so no folder of one machine is ever used there.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    on_this_machine = warehouse.startswith("file:") or ":" not in warehouse
    if on_this_machine and not spark.sparkContext.master.startswith(("local[", "local-cluster")) and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{warehouse}/kalends-scratch"


def _path(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


#: Folders written so far, in order; ``temporary`` drops those written inside its block.
_WRITTEN: list[str] = []


@contextmanager
def temporary(spark: SparkSession, *, keep: Callable[[str], bool] = lambda folder: False) -> Iterator[None]:
    """Drop the intermediate tables written inside the block when it ends, but those whose folder ``keep`` accepts.

    For results that are written out or counted inside the block: a lazy result that leaves it has lost its tables.
    """
    before = len(_WRITTEN)
    try:
        yield
    finally:
        written = _WRITTEN[before:]
        del _WRITTEN[before:]
        for name in written:
            if keep(name):
                _WRITTEN.append(name)
            else:
                path, system = _path(spark, name)
                system.delete(path, True)


class Scratch:
    """Tables written to the shared folder for as long as they are needed.

    As a context manager it deletes them at the end of the block, which suits results that are
    written inside it. Without one they stay until the application ends, which is what a lazy
    result needs: it may be read at any time.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.folders: list[str] = []

    def folder(self, label: str) -> str:
        """A new folder name, deleted with the scratch or when the application ends."""
        name = f"{shared_folder(self.spark)}/{label}-{uuid.uuid4().hex}"
        path, system = _path(self.spark, name)
        system.deleteOnExit(path)
        self.folders.append(name)
        _WRITTEN.append(name)
        return name

    def keep(self, df: DataFrame, label: str) -> DataFrame:
        """Write ``df`` as Parquet and return the written table.

        Later passes over the result all see the same rows, read only the columns they need,
        and do not depend on executors that held the shuffle.
        """
        name = self.folder(label)
        df.write.parquet(name)
        return self.spark.read.schema(df.schema).parquet(name)

    def drop(self) -> None:
        for name in self.folders:
            path, system = _path(self.spark, name)
            system.delete(path, True)
        self.folders.clear()

    def __enter__(self) -> "Scratch":
        return self

    def __exit__(self, *_) -> None:
        self.drop()


def materialise(df: DataFrame, label: str) -> DataFrame:
    """``Scratch.keep`` for a lazy result: the table is deleted when the application ends."""
    return Scratch(df.sparkSession).keep(df, label)
