"""Writing results as tables or folders."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

_IDENTIFIER = r"[A-Za-z_]\w*"
_TABLE_NAME = re.compile(rf"{_IDENTIFIER}(?:\.{_IDENTIFIER})*", re.ASCII)


def check_table_name(name: str) -> str:
    """Return ``name`` if it is a plain identifier, or several joined by dots."""
    if not _TABLE_NAME.fullmatch(name):
        raise ValueError(f"{name!r} is not a table name: use letters, digits and _, with dots between the parts")
    return name


def write_table(
    df: DataFrame, target: str, *, fmt: str = "parquet", mode: str = "overwrite",
    overwrite_schema: bool = False, partition_by: list[str] | None = None,
) -> None:
    """Write ``df``, replacing what was there.

    A ``target`` with a slash is a folder, any other is a catalog table. ``fmt`` names an
    installed format; ``overwrite_schema`` passes on the option of that name, which the
    formats with a schema of their own (such as delta) need to accept other columns.
    """
    writer = df.write.format(fmt).mode(mode)
    if overwrite_schema:
        writer = writer.option("overwriteSchema", "true")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if "/" in target:
        writer.save(target)
    else:
        writer.saveAsTable(check_table_name(target))


def write_text_csv(df: DataFrame, path: str) -> None:
    """Write columns of text as comma-separated UTF-8 files with a header row, without quotes, for ``read_text_csv``.

    The files are compressed: text of a wide table takes several times the space of what it says.
    """
    (df.write.option("header", True).option("quote", "").option("emptyValue", "")
     .option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").csv(path))
