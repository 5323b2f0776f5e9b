"""Customer table scans and sinks, and the catalog."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_DOUBLES = ("tenure", "MonthlyCharges", "TotalCharges")

# The column order of the customer file.
CUSTOMER_COLUMNS = (
    "customerID", "gender", "SeniorCitizen", "Partner", "Dependents", "tenure", "PhoneService",
    "MultipleLines", "InternetService", "OnlineSecurity", "OnlineBackup", "DeviceProtection",
    "TechSupport", "StreamingTV", "StreamingMovies", "Contract", "PaperlessBilling",
    "PaymentMethod", "MonthlyCharges", "TotalCharges", "Churn",
)
CUSTOMER_SCHEMA = T.StructType(
    [T.StructField(c, T.DoubleType() if c in _DOUBLES else T.StringType(), True) for c in CUSTOMER_COLUMNS]
)


def read_customers(spark: SparkSession, path: str, schema: T.StructType = CUSTOMER_SCHEMA) -> DataFrame:
    """Customer CSV with a header and a fixed schema; ``NA`` is null, an unreadable number is null."""
    return spark.read.csv(path, header=True, sep=",", schema=schema, nullValue="NA")


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def read_with_fallback(
    spark: SparkSession, name: str, path: str, schema: T.StructType = CUSTOMER_SCHEMA
) -> DataFrame:
    """The table if it exists and has rows, else the CSV file under the same fixed schema."""
    if spark.catalog.tableExists(name):
        df = spark.table(name)
        if not df.isEmpty():
            return df
    return read_customers(spark, path, schema)


def write_csv(df: DataFrame, path: str, files: int | None = None) -> None:
    """Overwrite ``path`` with CSV and header; ``files`` asks for that many files (one makes one task write all)."""
    out = df if files is None else df.coalesce(files)
    out.write.mode("overwrite").csv(path, header=True, nullValue="NA", emptyValue='""', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


def create_table_once(df: DataFrame, name: str) -> bool:
    """Create a Parquet table unless the name is taken; returns whether it was created."""
    if df.sparkSession.catalog.tableExists(name):
        return False
    df.write.format("parquet").mode("ignore").saveAsTable(name)
    return True


def replace_table(df: DataFrame, name: str) -> None:
    """Replace a Parquet table. A location conflict is raised, never cleared by deleting files."""
    df.write.format("parquet").mode("overwrite").saveAsTable(name)


def append_table(df: DataFrame, name: str, partition_by=()) -> None:
    """Append rows; a partitioned target is written in files of even size, a partition with most rows in many."""
    if partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
        df.write.format("parquet").mode("append").partitionBy(*partition_by).saveAsTable(name)
    else:
        df.write.format("parquet").mode("append").saveAsTable(name)


def write_batch(df: DataFrame, name: str, batch: str, partition_by=()) -> None:
    """Write the rows of one batch of a stream under its key, replacing whatever that batch has written before.

    A batch that is tried again, after it ended or after it died half-way, so adds nothing twice. The table is
    partitioned by ``batch`` and then by ``partition_by``.
    """
    spark = df.sparkSession
    layout = ["batch", *partition_by]
    rest = [c for c in df.columns if c not in layout]
    df = df.withColumn("batch", F.lit(batch)).select(*rest, *layout)
    if not spark.catalog.tableExists(name):
        df.limit(0).write.format("parquet").partitionBy(*layout).saveAsTable(name)
    view = f"batch_{uuid.uuid4().hex}"
    df.drop("batch").hint("rebalance", *[F.col(c) for c in partition_by]).createOrReplaceTempView(view)
    if not re.fullmatch(r"[\w.-]+", batch):
        raise ValueError(f"a batch key holds letters, digits, '_', '-' and '.': {batch!r}")
    spec = ", ".join([f"batch = '{batch}'", *[f"`{c}`" for c in partition_by]])
    try:
        spark.sql(f"INSERT OVERWRITE TABLE {name} PARTITION ({spec}) SELECT * FROM {view}")
    finally:
        spark.catalog.dropTempView(view)


def register(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def databases(spark: SparkSession) -> DataFrame:
    return spark.sql("SHOW DATABASES")


def tables(spark: SparkSession, database: str) -> DataFrame:
    return spark.sql("SHOW TABLES IN IDENTIFIER(:db)", args={"db": database})


def describe(spark: SparkSession, name: str, formatted: bool = True) -> DataFrame:
    """Columns and, when ``formatted``, storage details of a table as rows (col_name, data_type, comment)."""
    what = "DESCRIBE TABLE EXTENDED" if formatted else "DESCRIBE TABLE"
    return spark.sql(f"{what} IDENTIFIER(:name)", args={"name": name})


def to_json_records(df: DataFrame, name: str = "record", keep=()) -> DataFrame:
    """Each row as one JSON object, beside the columns ``keep``; null fields are kept as null."""
    return df.select(*keep, F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias(name))
