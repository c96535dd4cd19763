"""Reading the inputs: the flat CSV, catalog tables, Parquet folders, databases over JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = T.DecimalType(19, 4)

# The columns of the flat sales table, in file order, with their types.
FLAT_SCHEMA = T.StructType([
    T.StructField("SalesOrderNumber", T.StringType()),
    T.StructField("SalesOrderLineNumber", T.LongType()),
    T.StructField("OrderDate", T.TimestampNTZType()),
    T.StructField("DueDate", T.TimestampNTZType()),
    T.StructField("ShipDate", T.TimestampNTZType()),
    T.StructField("ClienteID", T.LongType()),
    T.StructField("NombreCliente", T.StringType()),
    T.StructField("TerritorioID", T.LongType()),
    T.StructField("Territorio", T.StringType()),
    T.StructField("Pais", T.StringType()),
    T.StructField("ProductoID", T.LongType()),
    T.StructField("Producto", T.StringType()),
    T.StructField("Color", T.StringType()),
    T.StructField("StandardCost", MONEY),
    T.StructField("ListPrice", MONEY),
    T.StructField("Subcategoria", T.StringType()),
    T.StructField("Categoria", T.StringType()),
    T.StructField("VendedorID", T.LongType()),
    T.StructField("NombreVendedor", T.StringType()),
    T.StructField("OrderQty", T.LongType()),
    T.StructField("UnitPrice", MONEY),
    T.StructField("UnitPriceDiscount", T.DoubleType()),
    T.StructField("LineTotal", MONEY),
])


def cast_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the columns of ``schema`` with its types; a value that does not fit becomes NULL."""
    return df.select(*[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in schema.fields])


def count_rejects(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Per column, how many values are present but do not fit the declared type, in one row."""
    return df.agg(*[
        F.count_if(F.col(f"`{f.name}`").isNotNull() & F.col(f"`{f.name}`").try_cast(f.dataType).isNull()).alias(f.name)
        for f in schema.fields
    ])


def read_text_csv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """A comma-separated UTF-8 file with a header row, as text; quotes are ordinary characters.

    The header is checked against ``columns``, so a file in another order is refused.
    """
    text = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return (
        spark.read.schema(text)
        .option("header", True).option("sep", ",").option("encoding", "UTF-8")
        .option("quote", "").option("enforceSchema", False)
        .csv(path)
    )


def read_flat_csv(spark: SparkSession, path: str) -> DataFrame:
    """The flat sales table from CSV, with its declared types."""
    return cast_columns(read_text_csv(spark, path, FLAT_SCHEMA.fieldNames()), FLAT_SCHEMA)


def read_parquet(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Parquet files with a declared schema: no file is opened to plan the query."""
    return spark.read.schema(schema).parquet(path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A table of the session's catalog, by its one-, two- or three-part name."""
    return spark.table(name)


def jdbc_options(
    url: str, table: str, *, key: str | None = None, first: int | None = None, last: int | None = None,
    partitions: int = 1, fetch_rows: int = 10_000,
) -> dict[str, str]:
    """Options of a JDBC read; with ``key`` and its range the table is read in parallel slices."""
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_rows)}
    if key is not None:
        if first is None or last is None or partitions < 1:
            raise ValueError("a parallel read needs the first and last key and at least one partition")
        options |= {
            "partitionColumn": key, "lowerBound": str(first), "upperBound": str(last),
            "numPartitions": str(partitions),
        }
    return options


def read_jdbc(spark: SparkSession, url: str, table: str, **slices) -> DataFrame:
    """A database table; filters and column selection are pushed to the database."""
    return spark.read.format("jdbc").options(**jdbc_options(url, table, **slices)).load()
