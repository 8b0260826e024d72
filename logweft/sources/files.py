"""File scans: log text, template and label CSVs, truth sequences.

Schemas are explicit, so a scan never costs an inference pass.  Rows of a text or CSV source carry
their place in the input (``LINE_ORDER``), because one-second log times leave ties that only line
order can break.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# File, then split within the file, then a counter that grows within a split.
LINE_ORDER = ("file", "split_start", "line_no")
# Files' splits up to which the table of their line counts is broadcast.
SPLITS = 500_000


def _place() -> list:
    return [
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split_start"),
        F.monotonically_increasing_id().alias("line_no"),
    ]


def read_log(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One ``value`` row per log line, with its ``LINE_ORDER`` columns."""
    return spark.read.text(path).select("value", *_place())


def line_order(rows: DataFrame) -> tuple[str, ...]:
    """The columns that give line order: ``line_number`` where rows have it."""
    return ("line_number",) if "line_number" in rows.columns else LINE_ORDER


def number_lines(rows: DataFrame) -> DataFrame:
    """Add ``line_number``, one bigint in line order over all files, to rows with ``LINE_ORDER``.

    If ``rows`` has every line, it is the line's number, from 0; else numbers of missing lines may be left
    out.  Lines are counted per split, the counts of a split's predecessors are summed over a table with
    a row for each split, and lines are shifted by them.  ``rows`` is read twice, so pass a settled table.
    """
    split = ["file", "split_start"]
    sizes = rows.groupBy(*split).agg(F.min("line_no").alias("low"), F.max("line_no").alias("high"))
    before = Window.orderBy(*split).rowsBetween(Window.unboundedPreceding, -1)
    upto = F.coalesce(F.sum(F.col("high") - F.col("low") + 1).over(before), F.lit(0))
    shifts = sizes.select(*split, (upto - F.col("low")).alias("shift"))
    small = sizes.limit(SPLITS + 1).count() <= SPLITS
    joined = rows.join(F.broadcast(shifts) if small else shifts, split)
    return joined.select(*[F.col(c) for c in rows.columns], (F.col("line_no") + F.col("shift")).alias("line_number"))


def read_templates(spark: SparkSession, path: str) -> DataFrame:
    """Templates with ``priority``, an orderable value that follows the file order."""
    rows = spark.read.schema("EventId string, EventTemplate string").csv(path, header=True)
    return rows.select(F.struct(*_place()).alias("priority"), "EventId", "EventTemplate")


def read_labels(spark: SparkSession, path: str) -> DataFrame:
    """Label rows as text, with ``label_order`` following the file order."""
    rows = spark.read.schema("BlockId string, Label string").csv(path, header=True)
    return rows.select("BlockId", "Label", F.struct(*_place()).alias("label_order"))


def read_truth(spark: SparkSession, path: str) -> DataFrame:
    """Published event sequences, one ``events`` array per block, from Parquet."""
    return spark.read.schema("events array<string>").parquet(path)


def truth_event_counts(truth: DataFrame) -> DataFrame:
    """How often each event occurs over all truth sequences."""
    return (
        truth.select(F.explode("events").alias("EventId"))
        .groupBy("EventId")
        .agg(F.count("*").alias("expected"))
    )
