"""CSV files with a header, read with a fixed schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillscope import schemas
from tillscope.tables import Tables

# Spark's own name: with it a line is judged by all its columns, whichever are selected.
CORRUPT = "_corrupt_record"

# File name of each entity.
FILES = {
    "customers": "customers.csv",
    "merchants": "merchants.csv",
    "transactions": "transactions.csv",
    "reviews": "reviews.csv",
    "tickets": "support_tickets.csv",
}


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Typed rows; a malformed line keeps its text in an extra column, and what could be read."""
    schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType(), True)])
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("mode", "PERMISSIVE")
        .option("escape", '"')
        .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
        .csv(path)
    )


def read_raw_csv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """All columns as text, for data whose types the cleansing step settles."""
    schema = T.StructType([T.StructField(c, T.StringType(), True) for c in columns])
    return read_csv(spark, path, schema)


def write_csv(df: DataFrame, path: str) -> None:
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("escape", '"')
        .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
        .csv(path)
    )


def split_corrupt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(clean rows, quarantined lines) of a written table; Spark cannot query the text
    column alone straight from CSV files."""
    clean = df.where(F.col(CORRUPT).isNull()).drop(CORRUPT)
    return clean, df.where(F.col(CORRUPT).isNotNull())


def read_entities(spark: SparkSession, folder: str) -> Tables:
    """The five entities of a data folder, malformed lines included."""
    return Tables(
        **{
            name: read_csv(spark, f"{folder}/{file}", schemas.ENTITIES[name])
            for name, file in FILES.items()
        }
    )
