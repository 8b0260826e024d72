"""Lines to blocks: order within a block, time gaps, block records, latency.

Two routes lead to the same rows.  Ordinary blocks take one shuffle by block id, one sort and one
window.  Blocks above the profile's limit are range-sorted over many tasks instead: each task orders
its slice, and per-slice totals, one small row each, shift the slices into place.

(BlockId, segment) is the key of a record, which holds at most ``segment_lines`` lines, so no array grows
with the largest block.  Segment 0 has the first lines of a block, segment 1 the next, and so on, at every
size.  ``latency`` is the sum of a record's own intervals, so sums over a block's segments are those of the
block.  A label belongs to the block: count blocks by their segment 0.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logweft.operators.labels import (
    attach_first_label,
    attach_labels,
    first_labels,
    label_counts,
    label_rows,
)
from logweft.operators.skew import BlockProfile, StoredLines, parts_of, profile_blocks
from logweft.sources.files import line_order, number_lines
from logweft.sources.scratch import settle

# Lines of a record where the caller names no other length.
SEGMENT_LINES = 100_000
RECORD_COLUMNS = (
    "BlockId",
    "segment",
    "events",
    "intervals",
    "latency",
    "levels",
    "components",
    "pids",
    "Label",
)


def _seconds(later: Column | str, earlier: Column | str) -> Column:
    """Whole seconds between two times, 0 if either is missing."""
    later, earlier = (F.col(c) if isinstance(c, str) else c for c in (later, earlier))
    return F.coalesce((later - earlier).cast("interval second").cast("bigint"), F.lit(0).cast("bigint"))


def order_columns(parsed: DataFrame) -> list[str]:
    """What ordering the lines of a block needs."""
    return ["BlockId", "timestamp", *line_order(parsed)]


def _order_in_task(parsed: DataFrame) -> DataFrame:
    """Number the lines of each block with one window; a block stays in one task."""
    ordered = Window.partitionBy("BlockId").orderBy("timestamp", *line_order(parsed))
    return parsed.select(
        "*",
        F.row_number().over(ordered).cast("bigint").alias("seq_num"),
        F.lag("timestamp").over(ordered).alias("prev_timestamp"),
    )


def _order_in_slices(parsed: DataFrame, slices: int) -> DataFrame:
    """Number the lines of each block with the block spread over range partitions."""
    ranged = parsed.repartitionByRange(slices, *order_columns(parsed))
    # The slice ids come from sampled bounds, so they are fixed on disk before two branches use them.
    sliced = settle(ranged.withColumn("slice", F.spark_partition_id()), "slices")
    in_slice = Window.partitionBy("BlockId", "slice").orderBy("timestamp", *line_order(parsed))
    numbered = sliced.select(
        "*",
        F.row_number().over(in_slice).cast("bigint").alias("row"),
        F.lag("timestamp").over(in_slice).alias("prev"),
    )
    # One row per slice and block: at most one per slice plus one per hot block.
    totals = sliced.groupBy("BlockId", "slice").agg(
        F.count("*").alias("n"), F.max("timestamp").alias("hi")
    )
    in_order = Window.partitionBy("BlockId").orderBy("slice")
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    places = totals.select(
        "BlockId",
        "slice",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"),
        # Missing times sort first, so the last time of a slice is its largest.
        F.lag("hi").over(in_order).alias("slice_prev"),
    )
    placed = numbered.join(F.broadcast(places), ["BlockId", "slice"])
    return placed.select(
        *parsed.columns,
        (F.col("row") + F.col("offset")).alias("seq_num"),
        F.when(F.col("row") == 1, F.col("slice_prev")).otherwise(F.col("prev")).alias("prev_timestamp"),
    )


def by_route(
    parsed: DataFrame | StoredLines,
    profile: BlockProfile | None,
    finish: Callable[[DataFrame, BlockProfile | None], DataFrame],
    prepare: Callable[[DataFrame, BlockProfile | None], DataFrame] = lambda rows, hot: rows,
) -> DataFrame:
    """Order the lines of each route, finish each, and put the results together.

    ``prepare(lines, hot)`` and ``finish(ordered, hot)`` run per route, with the profile on that of the
    oversized blocks and None on the other, so that the ordinary route keeps its partitioning by
    block id from one step to the next.  ``parsed`` should have only the
    columns that these need.  Without a profile it is written first, so that text is parsed once: the
    profile, the line numbers, which then stand for file and split in every sort, and the lines are
    read from there.  Stored lines have their profile and are taken apart already.
    """
    if profile is None and not isinstance(parsed, StoredLines):
        parsed = settle(parsed, "lines")
        profile = profile_blocks(parsed)
        parsed = number_lines(parsed) if "line_number" not in parsed.columns else parsed
    if isinstance(parsed, StoredLines):
        profile, ordinary, oversized = parsed.profile, parsed.ordinary, parsed.hot
    else:
        ordinary = profile.ordinary(parsed)
        oversized = profile.oversized(parsed) if profile.hot else None
    result = finish(_order_in_task(prepare(ordinary, None)), None)
    if profile.hot:
        rows = prepare(oversized, profile)
        result = result.unionByName(finish(_order_in_slices(rows, profile.slices), profile))
    return result


def _with_interval(ordered: DataFrame) -> DataFrame:
    return ordered.withColumn("interval_seconds", _seconds("timestamp", "prev_timestamp"))


def sequence_events(parsed: DataFrame, profile: BlockProfile | None = None) -> DataFrame:
    """Add each line's place in its block and the time of the line before it.

    Lines are ordered by time, missing times first, and by line order within a second.
    """
    columns = [*parsed.columns, "seq_num", "prev_timestamp"]
    return by_route(parsed, profile, lambda ordered, hot: ordered.select(*columns))


def event_intervals(parsed: DataFrame, profile: BlockProfile | None = None) -> DataFrame:
    """``sequence_events`` plus ``interval_seconds``, 0 for the first line of a block."""
    return _with_interval(sequence_events(parsed, profile))


def segment_of(segment_lines: int) -> Column:
    return F.expr(f"(seq_num - 1) div {segment_lines}").alias("segment")


def _assemble(ordered: DataFrame, segment_lines: int) -> DataFrame:
    lines = F.sort_array(
        F.collect_list(
            F.struct("seq_num", "EventId", "interval_seconds", "level", "component", "pid")
        )
    )
    grouped = (
        _with_interval(ordered)
        .withColumn("segment", segment_of(segment_lines))
        .groupBy("BlockId", "segment")
        .agg(lines.alias("lines"), F.sum("interval_seconds").alias("latency"))
    )

    # A field of an array of structs is the array of that field, in the same order.
    return grouped.select(
        "BlockId",
        "segment",
        F.col("lines.EventId").alias("events"),
        F.col("lines.interval_seconds").alias("intervals"),
        "latency",
        F.col("lines.level").alias("levels"),
        F.col("lines.component").alias("components"),
        F.col("lines.pid").alias("pids"),
    )


def _records(
    parsed: DataFrame,
    labels: DataFrame,
    profile: BlockProfile | None,
    segment_lines: int,
    reduce: Callable[[DataFrame], DataFrame],
    attach: Callable[[DataFrame, DataFrame], DataFrame],
) -> DataFrame:
    needed = parsed.select(*order_columns(parsed), "EventId", "level", "component", "pid")

    def finish(ordered: DataFrame, hot: BlockProfile | None) -> DataFrame:
        reduced = hot.only_hot(reduce, labels) if hot else reduce(labels)
        return attach(_assemble(ordered, segment_lines), reduced).select(*RECORD_COLUMNS)

    return by_route(needed, profile, finish)


def block_records(
    parsed: DataFrame,
    labels: DataFrame,
    profile: BlockProfile | None = None,
    segment_lines: int = SEGMENT_LINES,
) -> DataFrame:
    """Block records with their label, NULL if there is none; a repeated label repeats the record.

    ``levels``, ``components`` and ``pids`` are aligned with ``events``.
    """
    return _records(parsed, labels, profile, segment_lines, label_rows, attach_labels)


def block_records_default0(
    parsed: DataFrame,
    labels: DataFrame,
    profile: BlockProfile | None = None,
    segment_lines: int = SEGMENT_LINES,
) -> DataFrame:
    """Block records with the first label the block has, 0 if it has none or an unknown one."""
    return _records(parsed, labels, profile, segment_lines, first_labels, attach_first_label)


def block_spans(parsed: DataFrame) -> DataFrame:
    """First and last time of each block: no ordering and no arrays, combined before the shuffle."""
    return parsed.groupBy("BlockId").agg(
        F.min("timestamp").alias("block_start"), F.max("timestamp").alias("block_end")
    )


def span_latency(end: str = "block_end", start: str = "block_start") -> Column:
    """Sum of a block's intervals.  They telescope, because missing times come first and count 0."""
    return _seconds(end, start)


def label_copies(labels: DataFrame) -> DataFrame:
    """(BlockId, copies): how many rows of the record table a labelled block has."""
    total = F.col("normal") + F.col("anomaly") + F.col("other")
    return label_counts(labels).select("BlockId", total.alias("copies"))


def block_latency(parsed: DataFrame | StoredLines, labels: DataFrame | None = None) -> DataFrame:
    """(BlockId, latency), plus ``copies`` of the block in the record table if labels are given."""
    result = None
    for rows in parts_of(parsed):
        one = block_spans(rows).select("BlockId", span_latency().alias("latency"))
        if labels is not None:
            joined = one.join(label_copies(labels), "BlockId", "left")
            one = joined.withColumn("copies", F.coalesce("copies", F.lit(1)))
        result = one if result is None else result.unionByName(one)
    return result
