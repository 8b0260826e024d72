"""Analyses of parsed lines.

Each is one map-side-combined aggregate, then work on its few rows.  All of them also take
``activity_counts``, the same lines already counted, so that several analyses can share one scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SEVERE = ("ERROR", "WARN")


def activity_counts(parsed: DataFrame) -> DataFrame:
    """Lines by component, level and hour of day."""
    hour = F.hour("timestamp").alias("hour")
    return parsed.groupBy("component", "level", hour).agg(F.count("*").alias("count"))


#: Which columns a row of ``grouped_counts`` is grouped by.
BY_LEVEL, BY_HOUR, BY_COMPONENT, BY_BLOCK = "component, level", "hour", "component", "block, component"


def grouped_counts(parsed: DataFrame, blocks: bool = False) -> DataFrame:
    """All counts that the analyses of lines need, from one scan and one shuffle, by grouping sets.

    Rows (grouping, component, level, hour, count, severe): ``grouping`` says by which columns; ``severe``
    counts errors and warnings.  With ``blocks`` there are also the rows of ``plans.blocks.component_pairs``
    of lines that name a block, with BlockId, pair_start and pair_end.  Settle it and take it apart with
    ``of_grouping``.
    """
    keys = ["component", "level", "hour"] + (["BlockId"] if blocks else [])
    sets = [["component", "level"], ["hour"], ["component"]] + ([["BlockId", "component"]] if blocks else [])
    names = [BY_LEVEL, BY_HOUR, BY_COMPONENT, BY_BLOCK]
    named = F.lit(None)
    for columns, name in zip(sets, names):
        # A bit of the id is set where a key is left out.
        left_out = sum(1 << (len(keys) - 1 - i) for i, key in enumerate(keys) if key not in columns)
        named = F.when(F.grouping_id() == left_out, name).otherwise(named)
    severe = F.count_if(F.col("level").isin(*SEVERE))
    measures = [F.count("*").alias("count"), severe.alias("severe")]
    rows = parsed.withColumn("hour", F.hour("timestamp"))
    if blocks:
        measures += [F.min("timestamp").alias("pair_start"), F.max("timestamp").alias("pair_end")]
    grouped = rows.groupingSets([[F.col(c) for c in columns] for columns in sets], *keys)
    found = grouped.agg(named.alias("grouping"), *measures)
    # Lines without a block are in no pair.
    return found.filter((F.col("grouping") != BY_BLOCK) | (F.col("BlockId") != "")) if blocks else found


def of_grouping(counts: DataFrame, grouping: str) -> DataFrame:
    """The rows of one grouping of ``grouped_counts``, with the columns the analyses know them by."""
    rows = counts.filter(F.col("grouping") == grouping)
    if grouping == BY_BLOCK:
        return rows.select("BlockId", "component", F.col("count").alias("n"), "pair_start", "pair_end")
    return rows.select(*grouping.split(", "), "count", "severe")


def top_severe(counts: DataFrame, k: int = 10) -> DataFrame:
    """Components by their errors and warnings, from the component rows of ``grouped_counts``."""
    rows = of_grouping(counts, BY_COMPONENT).filter("severe > 0").select("component", F.col("severe").alias("count"))
    return rows.orderBy(F.desc("count"), "component").limit(k)


def _lines(rows: DataFrame) -> Column:
    counted = "count" in rows.columns
    return (F.sum("count") if counted else F.count("*")).alias("count")


def error_frequencies(rows: DataFrame, limit: int | None = None) -> DataFrame:
    """Error and warning lines by component and level, most frequent first."""
    severe = rows.filter(F.col("level").isin(*SEVERE))
    counts = level_counts(severe).orderBy(F.desc("count"), "component", "level")
    return counts if limit is None else counts.limit(limit)


def hourly_activity(rows: DataFrame) -> DataFrame:
    """Lines by hour of day; lines without a time are in the NULL hour."""
    hour = F.col("hour") if "hour" in rows.columns else F.hour("timestamp").alias("hour")
    return rows.groupBy(hour).agg(_lines(rows)).orderBy("hour")


def peak_hours(hourly: DataFrame, k: int = 3) -> DataFrame:
    return hourly.orderBy(F.desc("count"), F.asc_nulls_last("hour")).limit(k)


def level_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("component", "level").agg(_lines(rows))


def level_shares(counts: DataFrame) -> DataFrame:
    """``level_counts`` with the component's total and each level's percentage of it."""
    total = F.sum("count").over(Window.partitionBy("component"))
    return counts.withColumn("total", total).withColumn(
        "percentage", F.col("count") / F.col("total") * 100
    )


def level_distribution(rows: DataFrame) -> DataFrame:
    return level_shares(level_counts(rows)).orderBy("component", F.desc("count"), "level")


def top_components(rows: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` components with the most lines."""
    counts = rows.groupBy("component").agg(_lines(rows))
    return counts.orderBy(F.desc("count"), "component").limit(k)


def level_distribution_top(counts: DataFrame, k: int = 10) -> DataFrame:
    """Level shares of the ``k`` busiest components.

    ``counts`` is used twice, so pass a settled table of counts rather than parsed lines.
    """
    busiest = top_components(counts, k).select("component")
    kept = counts.join(F.broadcast(busiest), "component", "left_semi")  # k rows
    return level_shares(level_counts(kept))


def distinct_components(rows: DataFrame) -> DataFrame:
    return rows.select("component").distinct()
