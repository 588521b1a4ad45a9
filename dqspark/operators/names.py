"""Column names."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import DataType, StructField, StructType


def unlike(columns: Iterable[str], name: str) -> str:
    """A column name made from ``name`` that no given column has, whatever the case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def quoted(name: str) -> Column:
    """A column by its plain name, whatever dots or backticks that holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def _case_matters(spark: SparkSession) -> bool:
    return spark.conf.get("spark.sql.caseSensitive") == "true"


def has_columns(df: DataFrame, names: Iterable[str]) -> bool:
    """Whether the frame has columns of these names, by the session's rule on case."""
    if _case_matters(df.sparkSession):
        return set(names) <= set(df.columns)
    return {n.lower() for n in names} <= {c.lower() for c in df.columns}


class AnyCase(StructType):
    """A schema whose fields are found whatever the case of their name."""

    def __getitem__(self, key) -> StructField:
        if isinstance(key, str) and key not in self.names:
            key = next((n for n in self.names if n.lower() == key.lower()), key)
        return super().__getitem__(key)


def schema_of(df: DataFrame) -> StructType:
    """The schema, to be looked into by the session's rule on case."""
    return df.schema if _case_matters(df.sparkSession) else AnyCase(df.schema.fields)


def type_of(df: DataFrame, column: str) -> DataType:
    return schema_of(df)[column].dataType
