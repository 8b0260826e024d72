"""Anomaly labels of blocks.

Labels are reduced to one row per block before they meet a block, so a block id repeated in the label
table costs neither a skewed join nor a fan-out of intermediate rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rows one generator call may produce.
FAN_OUT = 10_000


def label_counts(labels: DataFrame) -> DataFrame:
    """Per block, how many label rows are normal, anomalous and neither."""
    return labels.groupBy("BlockId").agg(
        F.count_if(F.col("Label") == 0).alias("normal"),
        F.count_if(F.col("Label") == 1).alias("anomaly"),
        F.count_if(F.col("Label").isNull()).alias("other"),
    )


def first_labels(labels: DataFrame) -> DataFrame:
    """Per block, the label that comes first in the label table."""
    return labels.groupBy("BlockId").agg(F.min_by("Label", "label_order").alias("Label"))


def label_rows(labels: DataFrame) -> DataFrame:
    """(BlockId, Label, copies): the label table with equal rows folded together."""
    kinds = F.array(
        F.struct(F.lit(0).alias("Label"), F.col("normal").alias("copies")),
        F.struct(F.lit(1).alias("Label"), F.col("anomaly").alias("copies")),
        F.struct(F.lit(None).cast("int").alias("Label"), F.col("other").alias("copies")),
    )
    return label_counts(labels).select(
        "BlockId", F.inline(F.filter(kinds, lambda k: k["copies"] > 0))
    )


def repeat_rows(rows: DataFrame, copies: Column) -> DataFrame:
    """Repeat each row ``copies`` times, generating at most ``FAN_OUT`` rows per call."""
    batches = F.sequence(F.lit(0), F.floor((copies - 1) / FAN_OUT).cast("int"))
    batched = rows.withColumn("_n", copies).withColumn("_batch", F.explode(batches))
    left = F.least(F.lit(FAN_OUT), F.col("_n") - F.col("_batch") * FAN_OUT)
    return batched.withColumn("_copy", F.explode(F.sequence(F.lit(1), left.cast("int")))).drop(
        "_n", "_batch", "_copy"
    )


def attach_labels(blocks: DataFrame, rows: DataFrame) -> DataFrame:
    """Left join to ``label_rows``: NULL without a label, and a block once per row of the label table."""
    joined = blocks.join(rows, "BlockId", "left")
    return repeat_rows(joined, F.coalesce("copies", F.lit(1))).drop("copies")


def attach_first_label(blocks: DataFrame, first: DataFrame) -> DataFrame:
    """Left join to ``first_labels``, 0 where there is none."""
    return blocks.join(first, "BlockId", "left").withColumn("Label", F.coalesce("Label", F.lit(0)))
