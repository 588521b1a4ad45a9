"""Scans: files, table folders, catalog tables, warehouse tables over JDBC."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from dqspark.operators.names import unlike
from dqspark.session import stored
from dqspark.sources.buckets import read_buckets
from dqspark.sources.files import child_folders
from dqspark.sources.snapshots import read_snapshot


def read_csv(
    spark: SparkSession, path: str, schema: StructType | str | None = None, multi_line: bool = False
) -> DataFrame:
    """Headered CSV. Without a schema all columns are text, so no pass over the data infers types.

    Every file's header must have the names of the schema, or of the first file, in their order: one that has them
    otherwise raises when it is read, and does not fill the wrong columns. Fields too many are dropped and values that
    cannot be read are NULL; ``read_csv_checked`` keeps such rows apart. ``multi_line`` keeps line breaks inside quotes, at the price of one
    task per file.
    """
    reader = spark.read.options(header=True, escape='"', multiLine=multi_line, enforceSchema=False)
    return (reader.schema(schema) if schema else reader).csv(path)


def read_csv_checked(
    spark: SparkSession, path: str, schema: StructType | str, multi_line: bool = False
) -> tuple[DataFrame, DataFrame]:
    """The rows of a headered CSV that fit the schema, and those that do not, as ``(line, file)``.

    A row does not fit that has fields too many or too few, or a value that its type cannot hold. All columns are read
    and written once below the shared folder, as Spark finds out about a field only when it parses it. Headers are
    checked as in ``read_csv``.
    """
    typed = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    line = unlike(typed.names, "_line")
    known = StructType([*typed.fields, StructField(line, StringType())])
    reader = spark.read.options(header=True, escape='"', multiLine=multi_line, enforceSchema=False, mode="PERMISSIVE")
    rows = reader.option("columnNameOfCorruptRecord", line).schema(known).csv(path)
    file = unlike(known.names, "_file")
    held = stored(rows.withColumn(file, F.input_file_name()), "csv")
    fits = F.col(line).isNull()
    return held.filter(fits).drop(line, file), held.filter(~fits).select(F.col(line).alias("line"), F.col(file).alias("file"))


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A table folder: of any format Spark reads, or ``snapshot`` or ``buckets`` for tables that are upserted."""
    own = {"snapshot": read_snapshot, "buckets": read_buckets}
    return own[fmt](spark, path) if fmt in own else spark.read.format(fmt).load(path)


def read_catalog(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def load_tables(
    spark: SparkSession, base: str, names: Iterable[str], fmt: str = "parquet", suffix: str = ""
) -> dict[str, DataFrame]:
    """Several table folders below one base, by name."""
    return {name: read_table(spark, f"{base}/{name}{suffix}", fmt) for name in names}


def register(df: DataFrame, name: str) -> DataFrame:
    """Expose a frame to SQL under a name; nothing is computed or stored."""
    df.createOrReplaceTempView(name)
    return df


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str | None = None,
    bounds: tuple[str, str] | None = None,
    partitions: int = 64,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """A warehouse table. With a partition column and its bounds the read is split over tasks."""
    return spark.read.format("jdbc").options(
        **jdbc_options(url, table, partition_column, bounds, partitions, properties)
    ).load()


def jdbc_options(
    url: str,
    table: str,
    partition_column: str | None = None,
    bounds: tuple[str, str] | None = None,
    partitions: int = 64,
    properties: dict[str, str] | None = None,
) -> dict[str, str]:
    if (partition_column is None) != (bounds is None):
        raise ValueError("partition_column and bounds go together")
    options = {"url": url, "dbtable": table, "fetchsize": "10000", **(properties or {})}
    if partition_column:
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(partitions),
        }
    return options


def register_results(spark: SparkSession, path: str, prefix: str = "dq_") -> list[str]:
    """Make every result folder below ``path`` a catalog table named ``prefix`` + folder.

    Called again, it finds the folders, partitions and columns that were appended since; a column is NULL in older rows.
    A column whose type has changed raises.
    """
    names = []
    for folder in child_folders(spark, path):
        name = prefix + folder.rstrip("/").rsplit("/", 1)[-1]
        if not spark.catalog.tableExists(name):
            spark.catalog.createTable(name, path=folder, source="parquet")
        _add_columns(spark, name, spark.read.option("mergeSchema", True).parquet(folder).schema)
        if any(part.isPartition for part in spark.catalog.listColumns(name)):
            spark.catalog.recoverPartitions(name)
        spark.catalog.refreshTable(name)
        names.append(name)
    return names


def _add_columns(spark: SparkSession, name: str, found: StructType) -> None:
    """Give a table the columns that its files have and it lacks."""
    known = {f.name.lower(): f.dataType for f in spark.table(name).schema}
    new = [f for f in found if f.name.lower() not in known]
    for f in found:
        if known.get(f.name.lower(), f.dataType) != f.dataType:
            raise ValueError(f"{name}.{f.name} is {known[f.name.lower()].simpleString()}, its files have {f.dataType.simpleString()}")
    if new:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new)
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({columns})")
