"""Sources by the names that models use for them: two or three parts, wherever the tables really are.

A model says ``Sales.SalesOrderHeader`` or ``AdventureWorksDW.dbo.DimProduct``. ``Names`` maps the leading parts to a
namespace of the session's catalog and checks a table's columns against the declared ones when it is read, before any
plan uses them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kalends.sources.sinks import check_table_name


class Names:
    """``namespaces``: leading parts of a name -> namespace of the catalog; ``schemas``: full name -> declared columns."""

    def __init__(self, spark: SparkSession, namespaces: dict[str, str], schemas: dict[str, str | T.StructType] | None = None):
        self.spark = spark
        self.namespaces = {check_table_name(k).lower(): check_table_name(v) for k, v in namespaces.items()}
        self.schemas = {
            check_table_name(k).lower(): T.StructType.fromDDL(v) if isinstance(v, str) else v for k, v in (schemas or {}).items()
        }

    def located(self, name: str) -> str:
        """The catalog's name for a model's name: the longest known leading parts are replaced; case does not matter."""
        parts = check_table_name(name).split(".")
        for length in range(len(parts) - 1, 0, -1):
            namespace = self.namespaces.get(".".join(parts[:length]).lower())
            if namespace is not None:
                return ".".join([namespace, *parts[length:]])
        return name

    def table(self, name: str) -> DataFrame:
        """A table or view by its name, with its declared columns where they are declared.

        Columns that are missing, or hold another kind of value than can be widened to the declared type, are all
        named in one error; columns that are not declared are left out.
        """
        located = self.located(name)
        if not self.spark.catalog.tableExists(located):
            raise ValueError(f"no table or view {located!r} (for {name!r})")
        df = self.spark.table(located)
        declared = self.schemas.get(name.lower())
        if declared is None:
            return df
        found = {f.name.lower(): f for f in df.schema.fields}
        wrong = [f"{f.name} is missing" for f in declared.fields if f.name.lower() not in found]
        wrong += [
            f"{f.name} is {found[f.name.lower()].dataType.simpleString()}, not {f.dataType.simpleString()}"
            for f in declared.fields if f.name.lower() in found and not _fits(found[f.name.lower()].dataType, f.dataType)
        ]
        if wrong:
            raise ValueError(f"{name}: " + "; ".join(wrong))
        return df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in declared.fields])


_WIDTHS = [T.ByteType, T.ShortType, T.IntegerType, T.LongType]


def _fits(given: T.DataType, declared: T.DataType) -> bool:
    """Whether every value of ``given`` is one of ``declared``."""
    if given == declared:
        return True
    if type(given) in _WIDTHS and type(declared) in _WIDTHS:
        return _WIDTHS.index(type(given)) <= _WIDTHS.index(type(declared))
    if isinstance(given, T.DecimalType) and isinstance(declared, T.DecimalType):
        return declared.scale >= given.scale and declared.precision - declared.scale >= given.precision - given.scale
    if isinstance(given, T.DateType) and isinstance(declared, (T.TimestampType, T.TimestampNTZType)):
        return True
    return isinstance(given, T.FloatType) and isinstance(declared, T.DoubleType)
