"""Partition layouts of the grouping step.  Every layout gives the same answer.

A layout of the session lasts for one query.  ``store`` writes lines in a layout that stays.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweft.operators.blocks import block_spans, order_columns, span_latency
from logweft.operators.skew import BlockProfile, StoredLines, profile_blocks
from logweft.sources.scratch import new_folder, settle

# The widths that are compared, in eighths of the cluster's cores.
SHUFFLE_WIDTHS = (1, 2, 4, 8, 16, 32, 64)


def cores(lines: DataFrame, eighths: int) -> int:
    """That many eighths of the session's cores, as a number of partitions; never below two."""
    return max(2, eighths * lines.sparkSession.sparkContext.defaultParallelism // 8)


LAYOUTS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "repartition": lambda lines: lines.repartition(cores(lines, 16)),
    "up": lambda lines: lines.repartition(cores(lines, 32)),
    "down": lambda lines: lines.repartition(cores(lines, 32)).repartition(cores(lines, 8)),
    "coalesce": lambda lines: lines.repartition(cores(lines, 32)).coalesce(cores(lines, 8)),
}


def latency_at_width(parsed: DataFrame, width: int) -> DataFrame:
    """Block latency with the grouping shuffle ``width`` eighths of the cores wide.

    Spans are combined first, so the wide shuffle moves one row per block, and a hot block is one row.
    """
    regrouped = (
        block_spans(parsed)
        .repartition(cores(parsed, width), "BlockId")
        .groupBy("BlockId")
        .agg(F.min("block_start").alias("block_start"), F.max("block_end").alias("block_end"))
    )
    return regrouped.select("BlockId", span_latency().alias("latency"))


def bucketed(rows: DataFrame, buckets: int, *order: str, folder: str | None = None) -> DataFrame:
    """``rows`` written in ``buckets`` files by a hash of BlockId, each sorted by ``order``, as a table.

    Tables of one number of buckets join on BlockId, and each groups and orders by it, without a shuffle.
    The files go to ``folder``, or to the shared scratch folder.
    """
    spark, name = rows.sparkSession, f"by_block_{uuid.uuid4().hex}"
    path = folder or new_folder(spark, "by_block")
    # The same hash deals rows to tasks and to buckets, so each task writes one file.
    dealt = rows.repartition(buckets, "BlockId")
    dealt.write.bucketBy(buckets, "BlockId").sortBy(*order).option("path", path).saveAsTable(name)
    return spark.table(name)


def store(parsed: DataFrame, buckets: int | None = None, profile: BlockProfile | None = None) -> StoredLines:
    """Write parsed lines by block, once, for all later block operators.

    Choose ``buckets`` so that one is a task's worth of lines; without it there are as many as the
    session has shuffle partitions.  Oversized blocks go to a plain table beside the buckets.
    """
    spark = parsed.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    profile = profile or profile_blocks(parsed)
    ordinary = bucketed(profile.ordinary(parsed), buckets, *order_columns(parsed))
    hot = settle(profile.oversized(parsed), "hot") if profile.hot else ordinary.limit(0)
    return StoredLines(ordinary, hot, profile)
