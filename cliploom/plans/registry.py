"""Where queries and their SQL are registered, and what they share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Settings
from .bindings import duck

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
S = Settings()


def query(sql: str | None = None, **bindings: str):
    """Registers a query with its SQL; bindings are put before it by name."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            parts = [f"{name} AS ({duck(text)})" for name, text in bindings.items()]
            listed = ", ".join(parts)
            ORACLE_SQL[f.__name__] = sql.replace("WITH+ RECURSIVE", f"WITH RECURSIVE {listed}").replace("WITH+", f"WITH {listed}")
        return f

    return add


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(df: DataFrame, *columns: str, places: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, places) for c in columns})


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below the folder that driver and executors share, or, where none is
    told and all runs in one process, below a temporary one."""
    found = spark.conf.get("spark.checkpoint.dir", "")
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = f"file://{tempfile.gettempdir()}"
    return f"{found.rstrip('/')}/cliploom-{name}-{uuid.uuid4().hex}"
