"""Session settings, shared scratch space and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_local_roots: dict[str, str] = {}


def configure(spark: SparkSession) -> SparkSession:
    """All times are UTC; every other setting stays the cluster's own."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local-mode session (tests) may fall back to a temporary folder; on
    a cluster an unset folder is an error, since a machine-local path would be
    lost with its machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    sc = spark.sparkContext
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder")
    if sc.applicationId not in _local_roots:
        _local_roots[sc.applicationId] = tempfile.mkdtemp(prefix="tidings-")
    return _local_roots[sc.applicationId]


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder; never reused between calls."""
    return f"{shared_root(spark)}/tidings/{name}-{uuid.uuid4().hex}"


def within(df: DataFrame, rows: int) -> bool:
    """Whether ``df`` has at most ``rows`` rows; reads no more than one beyond."""
    return df.limit(rows + 1).count() <= rows


def small(df: DataFrame, rows: int) -> DataFrame:
    """``df`` for a broadcast when it has at most ``rows`` rows, else unchanged
    (the join then shuffles).  Meant for tables already written."""
    return F.broadcast(df) if within(df, rows) else df


def materialize(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` to the shared folder, with options of the writer, and read it back.

    This cuts lineage (iterative jobs), survives executor loss, and gives the
    next plan real file sizes to choose join strategies from.
    """
    path = scratch(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
