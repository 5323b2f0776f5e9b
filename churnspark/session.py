"""Session helpers: where intermediate tables go, and how a frame is written once and read back."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@lru_cache(maxsize=1)
def _local_scratch() -> str:
    path = tempfile.mkdtemp(prefix="churnspark-")
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder that ``spark.checkpoint.dir`` names.

    Only a ``local`` master may leave the setting out; a cluster without it is an error, because a
    machine-local folder would be lost with its machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = _local_scratch()
    return f"{base.rstrip('/')}/churnspark/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` once to the shared folder and return the written table.

    Used where several passes must see the same rows in the same places (range partitions are chosen by
    sampling) or where a costly frame feeds more than one job. Survives the loss of any executor.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


# A table estimated at no more than this is broadcast; a larger one goes through an ordinary join.
BROADCAST_BYTES = 64 * 1024 * 1024
_WIDE_VALUE = 64  # assumed bytes of a text, array or map value; other types take at most 16


def broadcast_rows(df: DataFrame) -> int:
    """How many rows of this schema fit the broadcast limit."""
    plain = (T.NumericType, T.BooleanType, T.DatetimeType)
    width = sum(16 if isinstance(f.dataType, plain) else _WIDE_VALUE for f in df.schema.fields)
    return BROADCAST_BYTES // max(width, 16)


def broadcast_if_small(df: DataFrame) -> DataFrame:
    """Hint a broadcast only when the rows of ``df`` fit the limit; otherwise leave the join to Spark.

    The check reads no more rows than fit, plus one. Call it on a written table.
    """
    limit = broadcast_rows(df)
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def as_columns(cols) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def work_database(spark: SparkSession) -> str:
    """A database under the shared folder for tables that the queries write; one per application."""
    name = "churnspark_" + spark.sparkContext.applicationId.replace("-", "_")
    if not spark.catalog.databaseExists(name):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{scratch_path(spark, 'tables')}'")
    return name


def work_table(spark: SparkSession, name: str) -> str:
    """A table name that is not yet taken."""
    return f"{work_database(spark)}.{name}_{uuid.uuid4().hex}"
