"""Intermediate tables, in the shared folder the cluster names in ``spark.checkpoint.dir``.

A written table cuts the lineage: it survives lost executors, and branches that read it see the same
rows.  It costs one job, where ``checkpoint`` would run the plan twice, and is read by column.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local: dict[str, str] = {}
_probed: set[tuple[str, str]] = set()


def _probe(spark: SparkSession, folder: str) -> None:
    """Fail early, with a reason, if what executors write to the folder does not reach the driver."""
    path = f"{folder.rstrip('/')}/probe-{uuid.uuid4().hex}"
    spark.range(8, numPartitions=8).write.parquet(path)
    if spark.read.schema("id bigint").parquet(path).count() != 8:
        raise RuntimeError(f"{folder} is not shared by the driver and the executors")


def _shared_folder(spark: SparkSession) -> str:
    """The configured folder, checked once per application; in local mode without one, a temporary one.

    The temporary folder goes when the process ends.  A configured one belongs to the caller.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    app = spark.sparkContext.applicationId
    if folder:
        if (app, folder) not in _probed:
            _probe(spark, folder)
            _probed.add((app, folder))
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    if app not in _local:
        _local[app] = tempfile.mkdtemp(prefix="logweft-")
        atexit.register(shutil.rmtree, _local[app], ignore_errors=True)
    return _local[app]


def new_folder(spark: SparkSession, name: str) -> str:
    """A path for one written table that no earlier run has used."""
    return f"{_shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def settle(rows: DataFrame, name: str = "settled") -> DataFrame:
    """Evaluate ``rows`` once, into a written table, before several branches of a query use them."""
    path = new_folder(rows.sparkSession, name)
    rows.write.option("compression", "zstd").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
