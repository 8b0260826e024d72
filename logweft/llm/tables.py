"""Reading the tables the operators work on, and the shape their inputs are brought into.

Every operator first selects the columns it needs under names of its own, so further columns of an
input, whatever they are called, neither clash nor travel.  A null text counts as the empty text.  A
null id is an ordinary value: its row is worked on and comes back with a null id.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import logweft

#: Rows of a few numbers each up to which a table is broadcast.
BROADCAST_ROWS = 1_000_000

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give this library to the Python workers of ``spark``, once per application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(logweft.__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="logweft-code-")  # on the driver; Spark serves it to the workers
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    context.addPyFile(shutil.make_archive(f"{folder}/logweft", "zip", root.parent, root.name))
    _shipped.add(context.applicationId)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def slices(batches, rows: int = 256):
    """Arrow batches of at most ``rows`` rows, so that long texts are Python objects for a moment only."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def texts(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id bigint, text string) of a document table, null texts as empty ones."""
    return docs.select(
        F.col(id_column).cast("bigint").alias("doc_id"),
        F.coalesce(F.col(text_column), F.lit("")).alias("text"),
    )


def fold(id_column: Column | str, folds: int) -> Column:
    """The fold of a row: crc32 of its id as text, modulo ``folds`` (a null id as empty text)."""
    column = F.col(id_column) if isinstance(id_column, str) else id_column
    return F.crc32(F.coalesce(column.cast("string"), F.lit(""))) % folds


def free(rows: DataFrame, name: str) -> str:
    """``name``, made longer until ``rows`` has no column of that name."""
    taken = {c.lower() for c in rows.columns}
    while name.lower() in taken:
        name += "_"
    return name


def bounded(rows: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``rows``, a table of few narrow columns read from files, ready to broadcast if it is small.

    Above ``limit`` rows Spark chooses the join; the result is the same.
    """
    return F.broadcast(rows) if rows.limit(limit + 1).count() <= limit else rows
